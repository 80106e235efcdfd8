"""The prefix trie, the n-gram join and the alignment of two tokenizers against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.checks import run
from shelfwise.llm.alignment import Tokenizers, align
from shelfwise.llm.ngram_join import Order, ngram_components, prefix_length
from shelfwise.llm.queries import ORACLES, QUERIES
from shelfwise.llm.trie import DoubleArray, prefix_trie

CHAT = "conv_id long, turn long, role string, text string, key string, depth int, weight string"


def chat(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0, "clash") for r in rows], CHAT)


def brute_trie(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])  # the remainder has the sign of c
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = Counter(), Counter()
    for node in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * words
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in members.items()
    )


def chat_rows(seed=3, convs=400):
    draw = random.Random(seed)
    openings = [[("system", "be kind"), ("user", f"question {k} about this")] for k in range(3)] + [[]]
    rows = []
    for c in range(convs):
        if c % 37 == 5:
            continue
        turns = list(draw.choice(openings)) + [(draw.choice(["user", "assistant"]), draw.choice(["yes", "no", "a b\tc", f"own {c}"])) for _ in range(draw.randrange(5))]
        rows += [(c, t, *said) for t, said in enumerate(turns)]
    rows += [(1000 + c, t, "user", "same") for c in range(60) for t in range(6)]  # copies
    rows += [(2000, t, "user", f"long {t}") for t in range(500)] + [(2001, t, "user", f"long {t}") for t in range(490)]
    rows += [(3000, None, "user", "first"), (3000, 0, None, None), (3000, 0, None, None), (3000, 0, "a", "tie"), (3001, 7, "user", "x" * 50_000), (None, 0, "user", "lost")]
    rows += [(-7, 0, "user", "below zero"), (40, 0, "user", "again")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [200_000, 40, 1])
def test_prefix_trie(spark, limit):
    rows = chat_rows()
    found = prefix_trie(chat(spark, rows), limit).collect()
    assert sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in found) == brute_trie(rows)
    assert all((r.parent_conv_id is None) == (r.depth == 0) for r in found)


def test_prefix_trie_of_little(spark):
    assert prefix_trie(chat(spark, [])).collect() == []
    assert prefix_trie(chat(spark, [(None, 0, "user", "lost")])).collect() == []
    rows = [(1, 0, "user", "gone")]  # CRC-32 of '1' modulo 4 is 3: its turn goes, and there is no conversation 0
    assert zlib.crc32(b"1") % 4 and brute_trie(rows)[0][:6] == (1, 0, -1, 1, 0, 1)
    assert sorted((r[0], r[1], -1, *r[3:]) for r in prefix_trie(chat(spark, rows)).collect()) == brute_trie(rows)


def test_double_array():
    draw = random.Random(9)
    for alphabet in (2, 30, 3000):
        paths = sorted({tuple(draw.randrange(alphabet) for _ in range(draw.randint(1, 7))) for _ in range(500)})
        lengths = np.array([len(p) for p in paths])
        trie = DoubleArray(lengths, np.array([c for p in paths for c in p]))
        nodes = {}
        for p in paths:
            at = 0
            for d, c in enumerate(p, 1):
                at = int(trie.step(np.array([at]), np.array([c]))[0])
                assert at > 0 and nodes.setdefault(at, p[:d]) == p[:d]
        assert len(nodes) == len({p[:d] for p in paths for d in range(1, len(p) + 1)}) == int((trie.check >= 0).sum() - 1)
        assert all((trie.step(np.array([at]), np.array([alphabet + 5])) == -1).all() for at in list(nodes)[:50])


DOCS = "doc_id long, text string, block long, kind int, pair string, n_a string"
ODD = [None, "", " ", "a", "a ", " a", "  a  b", "a😀漢 \n\x00<s> <|endoftext|> </s>", "one ▁ sign", "é" * 60, "a\x1c b \x85 c", "don't can's 's  's",
       "x" * 3000, "日本 語\tテ\r\nキ", "👩‍🔬 é ﬁ ½", "﻿a b c ​", "same words here", "same words here", "long " * 20_000]


def brute_alignment(texts):
    """For each text its tokens' byte ends by decoding, all overlapping pairs, and the counts over all texts."""
    t = Tokenizers.load()
    rows, counts = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = t.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = t.b.encode(text) if text else []
        if not text or b"".join(t.a_bytes[i] for i in a) != raw or b"".join(t.b_bytes[i] for i in b) != raw:
            rows.append(None)
            continue
        of = [[k for k, i in enumerate(ids) for _ in range(sizes[i])] for ids, sizes in ((a, t.a_sizes), (b, t.b_sizes))]
        links = sorted(set(zip(*of)))
        parts, x, y = [], 0, 0
        for n in range(1, len(raw) + 1):
            if n == len(raw) or (of[0][n] != of[0][n - 1] and of[1][n] != of[1][n - 1]):
                i, j = of[0][n - 1] + 1, of[1][n - 1] + 1
                parts.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
                x, y = i, j
        pairs = [(a[i], b[j]) for i, j in links]
        counts.update(pairs)
        rows.append((len(a), len(b), len(parts), pairs, hashlib.sha256(";".join(parts).encode()).hexdigest()))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return [
        (r[0], r[1], r[2], len(r[3]), sum(counts[p] == top[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), r[4]) if r else (0, 0, 0, 0, 0, 0, "")
        for r in rows
    ]


def test_alignment(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("text").limit(60).collect()
    texts = ODD + [r.text for r in docs if len(r.text) < 4000]
    ids = [None, *range(5), 5, 5, *range(8, len(texts))]
    df = spark.createDataFrame([(i, t, 1, 2, "clash", "clash") for i, t in zip(ids, texts)], DOCS).repartition(3)
    expected = sorted(((i, *r) for i, r in zip(ids, brute_alignment(texts))), key=repr)
    for block_bytes in (20_000_000, 500):
        assert sorted((tuple(r) for r in align(df, block_bytes=block_bytes).collect()), key=repr) == expected
    assert align(df.filter("false")).collect() == []
    assert [tuple(r) for r in align(df.filter("text = ''")).collect()] == [(0, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_in_small_blocks(spark, monkeypatch):
    from shelfwise.llm import alignment

    texts = [f"word{i % 7} other{i % 5} <|endoftext|> é{i}" for i in range(60)]
    blocks = alignment._Block(0)
    for i, t in enumerate(texts):
        blocks.add(i, t)
    assert blocks.full(500) and not blocks.full()
    monkeypatch.setattr(alignment, "ENCODE_CHARS", 10)
    batches = list(blocks.batches(Tokenizers.load()))
    assert [tuple(c[k].as_py() for c in batches[1].columns[3:8]) for k in range(60)] == [(r[0], r[1], r[2], r[3], r[6]) for r in brute_alignment(texts)]


WIDE = "doc_id long, text string, k long, n long, prefix string, cells string, possible string, _bucket int, token string"


def wide(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "clash", "clash", "clash", 3, "clash") for i, t in rows], WIDE)


def grams(text):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(parts[i : i + 4]) for i in range(max(1, len(parts) - 3))} if parts else set()


def brute_grams(rows, percent=85):
    """(doc_id, n_shingles, component_id); rows that share an id are one document."""
    ids = {i for i, _ in rows if i is not None}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, grams(t)) for i, t in rows if i is not None]
    sets = [(i, s) for i, s in sets if s]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(grams(t)), find(i) if i is not None else None) for i, t in rows), key=repr)


def gram_corpus():
    draw = random.Random(12)
    said = lambda n, pool=4000: [f"w{draw.randrange(pool)}" for _ in range(n)]
    rows = []
    for group in range(4):  # copies that drift apart, so that many are linked only by way of others
        text = said(150)
        for i in range(25):
            rows.append((100 * group + i, " ".join(text)))
            text = list(text)
            text[draw.randrange(150)] = f"x{group}_{i}"
    passage = said(60)  # in many texts that aren't alike, of which some are
    for i in range(40):
        own = said(random.Random(i // 2).randrange(20, 90))
        rows.append((1000 + i, " ".join(own + passage)))
        rows.append((1100 + i, " ".join([*own, *passage, "tail"])))
    edge = said(80)  # similarities close to the threshold on both sides
    for i in range(12):
        rows.append((2000 + i, " ".join(edge[: 80 - i] + [f"e{i}_{k}" for k in range(i)])))
    rows += [(3000, None), (3001, ""), (3002, " \n\t"), (3003, "two words"), (3004, "Two  WORDS"), (3005, "é É x"), (3006, "É é x"), (3003, "two words"), (None, "two words"), (None, None)]
    rows += [(3100, " ".join(said(30_000, 50_000)))]
    rows += [(3101, rows[-1][1] + " more"), (3200, " ".join(edge[:70])), (3200, ""), (3200, rows[0][1]), (3201, rows[30][1]), (3201, rows[60][1])]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,slot_bits", [(1024, 23), (3, 8)])
def test_ngram_components(spark, block, slot_bits):
    rows = gram_corpus()
    found = ngram_components(wide(spark, rows), block=block, slot_bits=slot_bits).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_grams(rows)


def test_ngram_components_of_little(spark):
    assert ngram_components(wide(spark, [])).collect() == []
    assert [tuple(r) for r in ngram_components(wide(spark, [(1, None)])).collect()] == [(1, 0, 1)]
    assert sorted(map(tuple, ngram_components(wide(spark, [(5, "a b"), (4, "A B")])).collect())) == [(4, 1, 4), (5, 1, 4)]


def test_mixed_lists_are_searched_in_full(spark):
    """No star: pairs of different components come from the lists alone, spanning and all of them."""
    from shelfwise.llm import ngram_join

    draw = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(w if draw.random() > 0.02 else f"v{i}_{n}" for n, w in enumerate(base))) for i in range(60)]
    expected = brute_grams(rows)
    stars = ngram_join._stars
    try:
        ngram_join._stars = lambda lists: stars(lists).filter("false")
        found = ngram_components(wide(spark, rows), block=7).collect()
    finally:
        ngram_join._stars = stars
    assert sorted((tuple(r) for r in found), key=repr) == expected


def test_fragments_hold_each_ngram_once():
    draw = np.random.default_rng(1)
    elements = np.unique(draw.integers(0, 2**64, 5000, dtype=np.uint64))
    order = Order(draw.integers(0, 9, 1 << 10).astype(np.uint8), 8)
    segments = dict(order.segments(elements))
    assert len(segments) == 8 and np.array_equal(np.sort(np.concatenate(list(segments.values()))), elements)
    of = order.fragments(np.arange(1 << 10, dtype=np.uint64) << np.uint64(54))  # one element of each slot
    counted = [(np.exp2(order.table[of == f]) * (order.table[of == f] > 0)).sum() for f in range(8)]
    assert max(counted) < 1.5 * min(counted)
    ranks = [(int(order.ranks(np.array([e]))[0]), int(e)) for e in elements]
    assert [int(e) for e in order.prefix(elements, 40)] == [e for _, e in sorted(ranks)[:40]]
    assert [prefix_length(n, 85) for n in (1, 6, 7, 100)] == [1, 1, 2, 16]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_sql(spark, tables, name):
    con = run.connect(tables)
    expected = con.execute(ORACLES[name]).fetchall()
    found = QUERIES[name](spark, tables)
    assert [c[0] for c in con.description] == found.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_alignment_encodes_little_at_once(monkeypatch):
    """What the tokenizers return for a unit takes far more memory than its text."""
    from shelfwise.llm import alignment

    sizes, align = [], alignment._align
    monkeypatch.setattr(alignment, "_align", lambda t, units: (sizes.append(sum(map(len, units))), align(t, units))[1])
    units = [f"word{i}" for i in range(20_000)]
    assert alignment.Aligned(Tokenizers.load(), units).valid.all()
    assert sum(sizes) == sum(map(len, units)) and max(sizes) < 60_000


def test_alignment_encodes_units_in_runs(monkeypatch):
    """Many units at a call, as one text with single spaces, and each unit's tokens as if it were alone."""
    from shelfwise.llm import alignment

    tokenizers = Tokenizers.load()
    given = []
    encode = tokenizers.encode_b
    monkeypatch.setattr(tokenizers, "encode_b", lambda runs: (given.extend(runs), encode(runs))[1], raising=False)
    units = [f"wörd{i}," for i in range(1000)]
    alignment.Aligned(tokenizers, units)
    assert given == [" ".join(units)]
    odd = ["a", "\tb", "c\n", "d  e", "日本", "\x1c", "</s>", "f ", " g", "é", "0̈", "h", "̈i"]
    together = alignment.Aligned(tokenizers, odd + ["▁", "j"])
    alone = [alignment.Aligned(tokenizers, [u]) for u in odd + ["▁", "j"]]
    assert together.texts == [t for a in alone for t in a.texts] and together.valid.tolist() == [bool(a.valid[0]) for a in alone]
    assert together.counts.tolist() == [a.counts[0].tolist() for a in alone]
    assert np.array_equal(together.pairs, np.concatenate([a.pairs for a in alone]))
    texts = ["a b", " a", "a ", "a  b c", "x\ny z", "a \n b", "　 a b", "a  b"]
    assert [alignment._split(t) for t in texts] == [alignment._UNITS.split(t) for t in texts]


def test_classes_that_share_many_lists_are_paired_in_one(spark):
    """Twelve lists hold nearly the same classes; each pair of different components comes once, none is lost."""
    from shelfwise.llm import ngram_join

    classes = spark.createDataFrame([(k, 100, bytes([1] * 256)) for k in range(24)], "k long, n long, cells binary")
    members = {token: [k for k in range(24) if k != token] for token in range(12)}
    lists = spark.createDataFrame([(t, k) for t, ks in members.items() for k in ks], "token long, k long")
    parts = spark.createDataFrame([(k, k // 2) for k in range(24)], "k long, g long")
    expected = {(a, b) for ks in members.values() for a in ks for b in ks if a < b and a // 2 != b // 2}
    for block in (5, 1024):
        found = [tuple(r) for r in ngram_join._pairs_by_list(lists, classes, parts, 85, block, False).collect()]
        assert sorted(found) == sorted(expected)  # before, each came from ten lists or more
        spanned = {tuple(r) for r in ngram_join._mixed_pairs(lists, classes, parts, 85, block, True).collect()}
        assert spanned < expected


def test_pairs_beyond_the_first_lists_are_found(spark, monkeypatch):
    """A row carries few of its lists: pairs may come more than once then, and all of them come."""
    from shelfwise.llm import ngram_join

    monkeypatch.setattr(ngram_join, "FIRST_LISTS", 1)
    classes = spark.createDataFrame([(k, 100, bytes([1] * 256)) for k in range(6)], "k long, n long, cells binary")
    lists = spark.createDataFrame([(0, 0), (0, 1), (1, 2), (1, 3), *((t, k) for t in (2, 3) for k in range(6))], "token long, k long")
    parts = spark.createDataFrame([(k, k) for k in range(6)], "k long, g long")
    found = [tuple(r) for r in ngram_join._pairs_by_list(lists, classes, parts, 85, 1024, False).collect()]
    assert set(found) == {(a, b) for a in range(6) for b in range(a + 1, 6)}
    first = pa.array([[5, 9], [5], [9, 12], None, [1, 12]], pa.list_(pa.int64()))
    x, y = np.array([0, 0, 2, 0, 1]), np.array([1, 2, 4, 4, 3])
    assert ngram_join._paired_before(x, y, first, 12, columns=1).tolist() == [True, True, False, False, False]
    assert ngram_join._paired_before(x, y, first, 9).tolist() == [True, False, False, False, False]


def test_lists_hold_classes_of_similar_size(spark):
    """A class alone with its size in a list can't be linked there; its posting goes no further."""
    from shelfwise.llm import ngram_join

    rows = [(1, 100, [7, 8]), (2, 110, [7, 8]), (3, 900, [7, 9]), (4, 20, [8, 9]), (5, 21, [9])]
    classes = spark.createDataFrame(rows, "k long, n long, prefix array<long>")
    found = {(r.token, r.k, r.copies) for r in ngram_join._lists(classes, 85).collect()}
    assert found == {(7, 1, 2), (7, 2, 2), (9, 4, 1), (9, 5, 1)}  # before, 3 and 4 were posted with those of other sizes


def test_the_most_alike_connect_components(spark):
    """Of the pairs that would connect two components, that of the largest possible overlap is tried."""
    from shelfwise.llm import ngram_join

    cells = {0: [1] * 240 + [0] * 16, 1: [1] * 256, 2: [0] * 10 + [1] * 246, 3: [1] * 255 + [0]}
    classes = spark.createDataFrame([(k, sum(c), bytes(c)) for k, c in cells.items()], "k long, n long, cells binary")
    lists = spark.createDataFrame([(5, k) for k in cells], "token long, k long")
    parts = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 2)], "k long, g long")
    assert [tuple(r) for r in ngram_join._mixed_pairs(lists, classes, parts, 85, 1024, True).collect()] == [(1, 3)]  # before, (0, 2)
