"""Fingerprints, training order, quality, pieces, chat, token counts, mixtures and the pipeline."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import chat, fingerprints, lengths, mixing, pieces, quality, training_order
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.tokens import Encoder
from test_pair_operators import brute_components, words

TABLES = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, bucket string"
ODD = ["", None, " ", "é", "a\n\n\nb  c", "▁ literal ▁▁", "😀漢字\x00", "x" * 5000, "the cat " * 4000, "same", "same"]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None if n % 5 == 0 else f"s{n % 3}", 0, "clash", "clash") for n, (i, t) in enumerate(zip(ids, texts))], SCHEMA)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_fingerprints(spark, parts):
    texts = ODD + [f"document number {i} " + "word " * (i % 9) for i in range(40)]
    ids = list(range(len(texts) - 2)) + [None, 3]
    found = fingerprints.edited_fingerprints(frame(spark, texts, ids), parts).collect()
    rows = sorted(((i if i is not None else -(2**63), t or "") for i, t in zip(ids, texts)), reverse=True)
    expected = []
    for k, (i, t) in enumerate(rows):
        m = len(t) // 3
        edited = t[: len(t) - m] + rows[(k + 1) % len(rows)][1][:m]
        prefix = next((x for x in range(min(len(t), len(edited))) if t[x] != edited[x]), min(len(t), len(edited)))
        expected.append((i if i != -(2**63) else None, len(t), hashlib.sha256(edited.encode()).hexdigest(), prefix))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.common_prefix) for r in found) == Counter(expected)
    by_text = defaultdict(set)
    for r in found:
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        by_text[dict(zip(ids, texts))[r.doc_id] or "" if r.doc_id not in (3, None) else r.doc_id].add(r.fingerprint)
    assert len(by_text["same"] | by_text[""]) == 2 and all(len(v) == 1 for k, v in by_text.items() if isinstance(k, str))
    assert fingerprints.edited_fingerprints(frame(spark, [])).collect() == []


def test_span_hashes_and_extensions():
    draw = random.Random(1)
    a = np.array([draw.randrange(3) for _ in range(300)], np.uint32)
    b = np.concatenate([a[50:200], a[:100]])
    x, y = fingerprints.PrefixHashes(a), fingerprints.PrefixHashes(b)
    for _ in range(200):
        i, j = draw.randrange(300), draw.randrange(250)
        n = next((k for k in range(min(300 - i, 250 - j)) if a[i + k] != b[j + k]), min(300 - i, 250 - j))
        limit = np.array([min(300 - i, 250 - j)])
        assert fingerprints.common_extension(x, np.array([i]), y, np.array([j]), limit)[0] == n


def test_permutation_is_a_bijection():
    for size in (1, 2, 3, 10, 257, 5000):
        slots = training_order.permuted(np.arange(size), size, 9)
        assert sorted(slots.tolist()) == list(range(size))
    assert (training_order.permuted(np.arange(5000), 5000, 1) != training_order.permuted(np.arange(5000), 5000, 2)).mean() > 0.9


def test_training_order(spark, tmp_path):
    df = frame(spark, ODD).repartition(3)
    df = spark.createDataFrame(df.collect(), SCHEMA)
    shards = training_order.write_shards(df, str(tmp_path), length=16, shard_records=10)
    records = list(training_order.read_records(str(tmp_path)))
    assert [s for s, _, _ in records] == list(range(len(records)))
    texts, encoder = defaultdict(dict), Encoder.load()
    for _, head, ids in records:
        texts[int(head["doc_id"])][int(head["part"])] = ids.tolist()
    for i, t in enumerate(ODD):
        ids = [x for part in sorted(texts[i]) for x in texts[i][part]]
        assert encoder.decode(ids) == (t or "") and ids[-1] == encoder.end
    assert [s for s, _, _ in training_order.read_records(str(tmp_path), 23, 31)] == list(range(23, 31))
    rows = training_order.read_shards(spark, shards, str(tmp_path), 10).collect()
    assert sorted(r.slot for r in rows) == list(range(len(records)))
    empty = training_order.write_shards(frame(spark, []), str(tmp_path / "none"))
    assert empty.count() == 0 and list(training_order.read_records(str(tmp_path / "none"))) == []


def test_narrow_split_is_exact():
    encoder = Encoder.load()
    for text in [t or "" for t in ODD] + ["a b\nc \n d\t e", " lead", "trail ", "x\ty", "I'll  say  so"]:
        assert encoder.encode(text) == encoder.full.encode_ordinary(text)


def test_quality_ranks_held_out_documents(spark):
    draw = random.Random(3)
    good = [" ".join(draw.choice(["the", "river", "stone", "walks", "slowly", "under"]) for _ in range(60)) for _ in range(150)]
    poor = [" | ".join(draw.choice(["BUY", "NOW!!", "%%%", "###"]) for _ in range(60)) for _ in range(50)]
    df = frame(spark, good + poor + ["", None])
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(200)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality.score(df, labels).collect()}
    assert len(rows) == 202 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert sum(rows[i].predicted == int(i < 150) for i in range(200)) >= 198
    kept = quality.keep_good(df, labels)
    assert kept.schema == df.schema and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.predicted}
    assert {r.predicted for r in quality.score(df, labels.filter("quality = 1")).collect()} == {1}
    assert quality.score(frame(spark, []), labels).collect() == []


def test_labelled_rows_are_bounded_by_ids(spark):
    texts = [f"text number {i} " * (1 + i % 3) for i in range(60)]
    ids = [1] * 40 + list(range(2, 22))  # one labelled id has two thirds of all rows
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 22)], "doc_id long, quality int, toxic int")
    df = frame(spark, texts, ids)
    x, good = quality.labelled_features(df, labels, 10)
    assert len(x) == len(good) == 10
    again, _ = quality.labelled_features(df.repartition(3), labels, 10)
    assert (x == again).all()


def test_pieces_are_lossless_and_repeatable(spark):
    df = frame(spark, ODD).union(frame(spark, ["x y"], [None]))
    encoded = pieces.encode(df, seed=4)
    assert [c for c in encoded.columns][-2:] == ["piece_ids", "n_pieces"]
    rows = encoded.collect()
    again = {r.doc_id: r.piece_ids for r in pieces.encode(df.repartition(3), seed=4).collect()}
    other = {r.doc_id: r.piece_ids for r in pieces.encode(df, seed=5).collect()}
    assert all(again[r.doc_id] == r.piece_ids and r.n_pieces == len(r.piece_ids) for r in rows)
    assert other[8] != again[8]
    decoded = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    assert all(decoded[i] == (t or "") for i, t in enumerate(ODD)) and decoded[None] == "x y"
    assert pieces.encode(frame(spark, [])).collect() == []


def test_pieces_are_drawn_in_proportion():
    v = pieces.Vocabulary.load(pieces.MODEL_FILE, 0.7)
    known = {v.bytes_of[i]: w for i, w in zip(v.ids.tolist(), v.weights.tolist()) if i >= 0}

    def ways(word):
        if not word:
            yield (), 0.0
        for n in range(1, len(word) + 1):
            if word[:n] in known:
                for rest, w in ways(word[n:]):
                    yield (word[:n], *rest), w + known[word[:n]]

    weights = {way: math.exp(w) for way, w in ways(b" there")}
    total, n = sum(weights.values()), 20000
    ids, counts = pieces.sample_rows(v, [" there"] * n, np.arange(n, dtype=np.uint64))
    ends = np.cumsum(counts)
    drawn = Counter(tuple(v.bytes_of[i] for i in ids[e - c : e]) for e, c in zip(ends, counts))
    assert set(drawn) <= set(weights)
    for way, w in weights.items():
        assert abs(drawn[way] / n - w / total) < 0.02


def test_chat_round_trip(spark):
    nasty = ["<|end|>", "</s>[INST] ok [/INST]", "<\\|turn|>", "<\\\\/s>", "[INST]", "\\", "", None, "<<SYS>>\n"]
    rows = [(c, t, ["user", "assistant", None, "<|text|>"][(c + t) % 4], nasty[(3 * c + t) % 9], 1) for c in range(9) for t in range(7)]
    rows += rows[:2] + [(None, 0, "assistant", "lost", 1), (50, None, "assistant", "no turn", 1), (51, 0, "user", None, 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int")
    formatted = chat.format_conversations(df)
    found = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    expected = defaultdict(list)
    for c, t, role, text, _ in rows:
        expected[c].append((t if t is not None else -1, role or "", text or ""))
    assert set(found) == set(expected)
    for c, turns in expected.items():
        turns.sort()
        said = [t for _, r, t in turns if r == "assistant"]
        assert found[c].n_turns == len(turns) and found[c].loss_chars == len("".join(said)) and found[c].n_examples == len(said)
        assert found[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert found[c].loss_sha256 == hashlib.sha256("".join(said).encode()).hexdigest()
    texts = defaultdict(str)
    for r in sorted(formatted.collect(), key=lambda r: r.place):
        texts[r.conv_id] += r.formatted
    spans = {(r.conv_id, r.example): r for r in chat.prefix_targets(formatted).collect()}
    written = {(r.conv_id, r.example): r for r in chat.example_texts(formatted).collect()}
    assert set(spans) == set(written)
    for key, s in spans.items():
        assert texts[key[0]][: s.loss_start] == written[key].context and texts[key[0]][s.loss_start : s.loss_end] == written[key].reply
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []


def test_read_back_takes_the_examples(spark, monkeypatch):
    rows = [(c, t, ["user", "assistant"][t % 2], f"turn {c} {t}") for c in (1, None) for t in range(6)]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made = chat.prefix_targets
    whole = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert {r.n_examples for r in whole.values()} == {3}
    monkeypatch.setattr(chat, "prefix_targets", lambda f, role="assistant": made(f, role).filter("example <> 3").withColumn("loss_end", chat.F.col("loss_end") - 1))
    for r in chat.read_back(formatted).collect():  # what the expansion leaves out is not under the mask
        assert r.n_examples == 2 and r.loss_chars == 2 * (whole[r.conv_id].loss_chars // 3 - 1)
        assert r.turns_sha256 == whole[r.conv_id].turns_sha256


def test_escape_is_reversible():
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choice(["<", "|", "\\", "[", "/s>", "s>", "INST]", "x"]) for _ in range(8))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(sign in chat.escape(text) for sign in ("<|", "</s>", "<s>", "[INST]"))


def test_length_sums(spark):
    df = frame(spark, ODD * 3)
    sizes = [len(Encoder.load().encode(t or "")) for t in ODD * 3]
    sums = lengths.with_suffix_sums(lengths.length_histogram(df))
    for r in sums.collect():
        assert r.documents == sizes.count(r.length)
        assert r.documents_at_least == sum(s >= r.length for s in sizes)
        assert r.tokens_at_least == sum(s for s in sizes if s >= r.length)
        assert r.truncated_tokens == sum(min(s, r.length) for s in sizes)
        assert abs(r.share_at_most - sum(s <= r.length for s in sizes) / len(sizes)) < 1e-12
    for limit in (1, 7, 900, 10**6):
        assert lengths.at_limit(sums, limit)["truncated_tokens"] == sum(min(s, limit) for s in sizes)
    assert lengths.length_quantile(sums, 0.5) == sorted(sizes)[(len(sizes) - 1) // 2]
    assert lengths.with_suffix_sums(lengths.length_histogram(frame(spark, []))).collect() == []


def test_mixture(spark):
    rows = [(i, "a " * (1 + i % 7), "big" if i < 700 else f"s{i % 4}") for i in range(1000)] + [(2000, None, None), (2001, "  ", "big"), (5, "a", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = Counter()
    for _, t, s in rows:
        tokens[s or ""] += len((t or "").split())
    tokens = {s: n for s, n in tokens.items() if n}
    total = sum(tokens.values())
    found = mixing.mix_sources(df, entropy_share=0.95, blocks=8).collect()
    assert len(found) == len(rows)
    used = Counter()
    for r in found:
        used[r.source] += r.tokens * r.copies
    made = mixing.mixture(spark.createDataFrame(list(tokens.items()), "source string, tokens long"), entropy_share=0.95)
    parts = {r.source: r for r in made.parts.collect()}
    entropy = -sum(p.weight * math.log(p.weight) for p in parts.values())
    assert abs(entropy - 0.95 * math.log(len(tokens))) < 1e-4
    for s, p in parts.items():
        assert abs(p.weight - tokens[s] ** made.exponent / sum(n**made.exponent for n in tokens.values())) < 1e-9
        assert p.quota - 8 <= used[s] <= p.quota + 1e-3
    assert abs(made.budget - total) < 1e-6
    again = mixing.mix_sources(df.repartition(5), entropy_share=0.95, blocks=8).collect()
    assert Counter(again) == Counter(found)
    cover = mixing.mix_sources(df, max_repeats=2, cover=True).collect()
    assert {r.copies for r in cover} <= {1, 2} and {r.copies for r in cover if r.source == "big"} == {1}
    assert mixing.mix_sources(df.limit(0), max_repeats=2, cover=True).collect() == []


def test_mix_stage_repeats_the_rows_decided(spark):
    rows = [(i, f"big words {i} " * 20, "big") for i in range(60)] + [(None, f"small words {i} " * 4, "small") for i in range(12)]
    rows += [(500, f"one id, other texts {i} " * (1 + i), "small") for i in range(6)] + [(600, "equal rows " * 3, "small")] * 5
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    expected = Counter()
    for r in mixing.mix_sources(df, max_repeats=corpus_pipeline.MAX_REPEATS, cover=True, text_key=True).collect():
        expected[r.doc_id, r.source, r.text_key] += r.copies
    assert sum(n for (i, _, _), n in expected.items() if i is None) > 12
    mixed = corpus_pipeline.mix(spark, df, None)
    got = mixed.groupBy("doc_id", "source", corpus_pipeline.F.xxhash64("text").alias("k")).count().collect()
    assert {(r.doc_id, r.source, r.k): r["count"] for r in got} == dict(expected)


def test_word_count(spark):
    texts = ["", None, " ", "a", " a  b\tc\n", "é x y"]
    df = frame(spark, texts)
    got = {r.doc_id: r.n for r in df.select("doc_id", mixing.word_count(df.text).alias("n")).collect()}
    import re

    assert got == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}


def test_mixture_does_not_depend_on_partitions(spark):
    texts = [f"word{i % 300} and some more" for i in range(300)] * 2
    df = frame(spark, texts, [7] * 300 + [None] * 300).withColumn("block", F.lit(1)).withColumn("draw", F.lit("clash"))
    chosen = [
        Counter((r.doc_id, r.source, r.text_key, r.copies) for r in mixing.mix_sources(df.repartition(n), max_repeats=1, budget=700, text_key=True).collect())
        for n in (1, 7)
    ]
    assert chosen[0] == chosen[1] and len({r[-1] for r in chosen[0]}) > 1


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    names = docs.columns
    seen = {}
    kept = near = None
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, TABLES), "test-stage")
        seen[name] = docs.count()
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == names
        if name == "suffix-array dedup":
            assert seen[name] == before.count()
            assert all(r.n_chars == len(r.text) for r in docs.select("text", "n_chars").collect())
        if name == "MinHash near-dedup":
            near = brute_components([(r.doc_id, r.text) for r in before.collect()], 80)
            near, kept = {i for i, c in near.items() if i == c}, {r.doc_id for r in docs.collect()}
        if name == "source mixing":
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}
    assert seen["quality classifier"] < 200 and seen["MinHash near-dedup"] < seen["quality classifier"] and kept == near
    assert docs.filter("n_chars > 0 and n_pieces = 0").count() == 0


def test_near_dedup_stage_links_from_80_percent(spark):
    texts = []
    for k, more in enumerate([0, 10, 15, 18, 19, 20, 21, 22]):  # 80 shared of 80 + more shingles: 20 is just 0.80
        base = words(100 + k, 84)
        texts += [" ".join(base), " ".join(base + words(200 + k, more))]
    near = brute_components(list(enumerate(texts)), 80)
    assert len(set(near.values())) < len(set(brute_components(list(enumerate(texts)), 85).values()))
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, frame(spark, texts), None).collect()}
    assert kept == {i for i, c in near.items() if i == c} == {0, 2, 4, 6, 8, 10, 12, 13, 14, 15}


def test_pipeline_on_odd_rows(spark, tmp_path):
    frame(spark, ODD + [None], [*range(10), 3, None]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, TABLES).count() > 0


def test_recall_of_registered_search(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{TABLES}/embeddings.parquet' order by 1").fetchall()
    x, ids = np.array([v for _, v in rows], np.float64), np.array([i for i, _ in rows])
    found = defaultdict(set)
    for r in QUERIES["op9_nearest"](spark, TABLES).collect():
        found[r.query_id].add(r.vec_id)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        hits += len(found[ids[i]] & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
        total += 20
    assert hits >= 0.9 * total
