"""Near-duplicates, removal of repeats, components and nearest neighbours against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import plan
from pyspark.sql import functions as F

from shelfwise.llm.components import connected_components
from shelfwise.llm.idsets import without_ids
from shelfwise.llm.near_dedup import _candidate_links, _exact_links, matches_needed, near_duplicates, signatures
from shelfwise.llm.nearest import nearest
from shelfwise.llm.repeats import repeat_report, repeated_spans, repeated_windows, without_repeats
from shelfwise.llm.suffixes import adjacent_prefixes, eight_bytes, two_stage_order
from shelfwise.llm.texts import prefix_hashes, span_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, c string, signature string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "clash", "clash") for i, t in rows], SCHEMA)


def words(seed, n):
    draw = random.Random(seed)
    return [f"w{draw.randrange(5000)}" for _ in range(n)]


def corpus():
    base, rows = words(1, 120), []
    for i in range(30):  # near copies of one text, some of them linked only by way of others
        copy = list(base)
        for k in range(i % 6):
            copy[(17 * i + 31 * k) % 120] = f"x{i}_{k}"
        rows.append((100 + i, " ".join(copy)))
    rows += [(i, " ".join(words(i, 60))) for i in range(20)]
    rows += [(40 + i, " ".join(words(7, 60)).upper()) for i in range(3)]
    rows += [(60, None), (61, ""), (62, " \t\n"), (63, "two words"), (64, "Two  WORDS"), (65, "é É"), (66, "É é")]
    rows += [(63, "two words"), (None, "two words"), (None, None), (70, " ".join(words(99, 30000)))]
    return rows


def shingle_set(text):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))} if parts else set()


def brute_components(rows, percent=85):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingle_set(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, many in sets.items() for s in many if s]
    for k, (i, a) in enumerate(flat):
        for j, b in flat[k + 1 :]:
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("list_block,set_block", [(1024, 1 << 19), (4, 300)])
def test_near_duplicates(spark, list_block, set_block):
    rows = corpus()
    found = near_duplicates(frame(spark, rows), list_block=list_block, set_block=set_block).collect()
    assert len(found) == len(rows)
    expected = brute_components(rows)
    assert Counter(r.n_shingles for r in found) == Counter(len(shingle_set(t)) for _, t in rows)
    for r in found:
        assert r.component_id == (expected[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_blocks_of_short_texts_are_bounded_by_members(spark):
    base = words(11, 20)  # one word varies at the end, so the texts share 15 of 17 shingles
    rows = [(i, " ".join(base[:19] + [f"v{i}"])) for i in range(300)]
    keys = signatures(frame(spark, rows)).select(F.col("doc_id").alias("c"), "set_key", "n_shingles", F.lit(0).cast("long").alias("g"))
    members = spark.createDataFrame(keys.collect(), keys.schema)
    sent = {}
    for most in (1024, 32):
        links = _exact_links(frame(spark, rows), members, 85, 5, 1 << 19, most)
        sent[most] = links.collect()
        assert {r.component for r in connected_components(links).collect()} == {0}
    # a block of k members returns k - 1 links: one block of all, or many of about 32 that meet pairwise
    assert len(sent[1024]) == 299 and len(sent[32]) > 299
    found = near_duplicates(frame(spark, rows), member_block=32).collect()
    assert len(found) == 300 and {r.component_id for r in found} == {0}


def test_exploded_tables_are_not_broadcast(spark, tmp_path):
    """Spark takes postings for as large as their classes: it would send them all to the driver."""
    rows = spark.range(50).select(
        F.col("id").alias("c"), F.col("id").cast("string").cast("binary").alias("set_key"), F.lit(9).cast("long").alias("n_shingles"), F.lit(0).cast("long").alias("g"),
        F.transform(F.sequence(F.lit(0), F.lit(47)), lambda k: (k * 64 + F.col("id") % 8).cast("int")).alias("signature"),
    )
    rows.write.parquet(str(tmp_path / "classes"))
    classes = spark.read.parquet(str(tmp_path / "classes"))
    links = plan(_candidate_links(classes, 48, 29, 8))
    assert "Broadcast" not in links and links.count("SortMergeJoin") == 2
    texts = frame(spark, [(i, f"{i} a b c d e f") for i in range(50)])
    exact = plan(_exact_links(texts, classes.drop("signature"), 80, 5, 100, 10))
    assert re.search(r"SortMergeJoin \[c#\d+L, set_key#\d+\]", exact)
    assert "BroadcastHashJoin" not in plan(repeated_spans(texts, 20))


def test_all_texts_of_one_id_are_linked(spark):
    a, b, d, long = (words(s, n) for s, n in ((21, 40), (22, 40), (23, 40), (24, 400)))
    near = lambda text, k: " ".join([*text[:-1], f"end{k}"])
    rows = [(1, " ".join(a)), (3, " ".join(b)), (4, " ".join(d))]
    rows += [(5, " ".join(x)) for x in (a, b, d)] + [(5, "own words of the id five")]  # classes 1, 3, 4 and its own
    short = words(25, 40)
    rows += [(20, " ".join(long)), (20, near(short, 0))] + [(21 + k, near(short, 1 + k)) for k in range(3)]
    rows += [(30 + k, near(long, k)) for k in range(3)]  # one id with a short and a long text, both with near copies
    expected = brute_components(rows)
    assert {expected[i] for i in (1, 3, 4, 5)} == {1} and {expected[i] for i in (20, 21, 22, 23, 30, 31, 32)} == {20}
    for blocks in ({}, {"set_block": 50, "member_block": 2}):
        found = near_duplicates(frame(spark, rows), **blocks).collect()
        assert len(found) == len(rows) and {(r.doc_id, r.component_id) for r in found} == set(expected.items())


def test_a_text_without_words_belongs_to_its_id(spark):
    text = " ".join(words(31, 40))
    found = near_duplicates(frame(spark, [(1, text), (5, text), (5, ""), (6, None)])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == [(1, 36, 1, True), (5, 0, 1, False), (5, 36, 1, False), (6, 0, 6, True)]


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    assert [r.kept for r in near_duplicates(frame(spark, [(1, None)])).collect()] == [True]


def test_threshold_is_binomial():
    assert matches_needed(48, 85) < 48 * 0.85
    assert matches_needed(48, 85, 0.5) >= matches_needed(48, 85, 1e-9)


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 200), (300, 200), (7, 7)] + [(400, 400 + i) for i in range(1, 40)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(51))
    assert found[300] == 100 and found[439] == 400


def test_without_ids(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    gone = spark.range(0, 100, 7)
    assert sorted(r.k for r in without_ids(df, "k", gone).collect()) == [i for i in range(100) if i % 7]
    helpers = ("possible", "_bucket", "_bits", "_key", "_row", "_id")
    named = df.select("k", *(F.lit(n).alias(n) for n in helpers))
    left = without_ids(named, "k", gone)
    assert left.columns == named.columns and sorted(r.k for r in left.collect()) == [i for i in range(100) if i % 7]
    assert {tuple(r)[1:] for r in left.collect()} == {helpers}


def test_suffix_order_and_windows():
    draw = random.Random(5)
    for _ in range(80):
        length = draw.choice([3, 8, 9, 20])
        alphabet = draw.choice([b"ab", b"abc", bytes(range(256)), b"a"])
        texts = [bytes(draw.choice(alphabet) for _ in range(draw.randint(1, 60))) for _ in range(draw.randint(1, 6))]
        texts.append(texts[0][3:] + b"b" + texts[0][:30])
        counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
        for t, starts in zip(texts, repeated_windows(texts, [1] * len(texts), length)):
            assert list(starts) == [i for i in range(len(t) - length + 1) if counts[t[i : i + length]] > 1]
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        n, at = len(data), np.arange(len(data))
        words_ = eight_bytes(data, 600)
        same = span_hashes(prefix_hashes(data), at, np.minimum(at + 500, n))
        order = two_stage_order(data, np.ones(n, bool), 500, same, words_)
        assert order.tolist() == sorted(range(n), key=lambda i: joined[i:])
        for a, b, lcp in zip(order, order[1:], adjacent_prefixes(words_, order, 16)):
            x, y = joined[a:].ljust(900, b"\0"), joined[b:].ljust(900, b"\0")
            assert lcp == next((k for k in range(16) if x[k] != y[k]), 16)


def repeat_rows():
    shared, other = " ".join(words(3, 60)), " ".join(words(4, 60))
    rows = [(i, f"{' '.join(words(50 + i, 40))} {shared[: 150 + 10 * i]} tail {i}") for i in range(12)]
    rows += [(20, other), (21, other), (22, "a" * 700), (23, "ab" * 130 + " end"), (24, "é" * 150), (25, None), (26, "")]
    rows += [(27, other[:199]), (30, "same row " * 40), (30, "same row " * 40), (None, other + "!"), (31, " ".join(words(8, 9000)))]
    return rows


@pytest.mark.parametrize("hot,sort_bytes", [(20_000, 2_000_000), (2, 500)])
def test_repeats(spark, hot, sort_bytes):
    rows = repeat_rows()
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    expected = []
    for (doc_id, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 199):
            if counts[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        left = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        expected.append((doc_id or -1, len(t), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    found = repeat_report(frame(spark, rows), hot=hot, sort_bytes=sort_bytes).collect()
    assert sorted((r[0] or -1, *r[1:]) for r in found) == sorted(expected)


def test_cut_texts_keep_rows_and_columns(spark):
    df = frame(spark, repeat_rows())
    cut = without_repeats(df)
    assert cut.schema.names == df.schema.names
    rows = cut.collect()
    assert len(rows) == df.count() and {r.c for r in rows} == {"clash"}
    assert {r.doc_id: r.text for r in rows}[20] == "" and {r.doc_id: r.text for r in rows}[25] is None
    assert without_repeats(frame(spark, [])).collect() == []
    helpers = ("possible", "_a", "_b", "_k", "_bucket", "_bits", "_froms", "_tos", "_row", "h", "p", "q", "n", "at", "spans")
    named = df.select("doc_id", *(F.lit(n).alias(n) for n in helpers), "text")
    again = without_repeats(named)
    assert again.columns == named.columns and {tuple(r)[1:-1] for r in again.collect()} == {helpers}
    assert Counter((r.doc_id, r.text) for r in again.collect()) == Counter((r.doc_id, r.text) for r in rows)


def test_nearest(spark):
    draw = np.random.default_rng(2)
    vectors = draw.standard_normal((400, 24)).astype(np.float32)
    vectors[100:180] = vectors[100]  # copies of one vector, and ties by id
    rows = [(int(i), [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    bad = [(1000, None, 0), (1020, [], 0), (1040, [0.0] * 24, 0), (1060, [None] + [1.0] * 23, 0), (1080, [float("nan")] * 24, 0), (None, [1.0] * 24, 0)]
    odd = [(2000, [1.0, 2.0], 0), (2001, [3.0, 1.0], 0)]
    df = spark.createDataFrame(rows + rows[:40] + bad + odd, "vec_id long, embedding array<float>, ids int")
    found = {}
    for r in nearest(df, query_block=7, candidate_block=90).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    exact = vectors.astype(np.float64)
    hits = 0
    for q in range(0, 400, 20):
        scores = exact @ exact[q]
        best = [i for i in np.lexsort((np.arange(400), -scores)) if i != q][:20]
        assert [r for r, _, _ in found[q]] == list(range(1, 21))
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in found[q])
        hits += len({v for _, v, _ in found[q]} & set(best))
    assert hits >= 0.99 * 20 * 20
    assert [v for _, v, _ in found[2000]] == [2001]
    assert set(found) == {*range(0, 400, 20), 2000}
