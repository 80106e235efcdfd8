"""Document quality by Bradley-Terry ranking: scores such that labelled good texts beat bad ones.

The chance that document i is better than j is the logistic function of s(i) - s(j), where s is
linear in features of the text. The weights maximise that likelihood over pairs of a good and a
bad labelled text; a pair enters by the difference of its features, so no intercept is needed.
The cut between the two classes is the quantile of the labelled scores at the share of bad texts.

Only the fit runs on the driver, over at most ``max_labelled`` feature rows (picked by a hash of
the document id); every document is scored in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.idsets import mark_possible
from shelfwise.llm.texts import shingles, text_chunks, word_spans

#: Bound on the labelled rows of a fit: 12,000 feature rows are 50 MB.
MAX_LABELLED = 12_000
#: A score at the cut.
CUT_SCORE = 0.3
HELD_OUT_OF = 5

_BINS = 1024
_TRIGRAM = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_MARK = np.isin(np.arange(256), [b for b in range(33, 127) if not chr(b).isalnum()])
N_FEATURES = _BINS + 9


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row for each text: hashed byte trigrams (square roots of shares) and shares of kinds of text."""
    n = len(offsets) - 1
    made = np.zeros((n, N_FEATURES), np.float32)
    sizes = np.diff(offsets)
    some = np.maximum(sizes, 1)
    owner = np.repeat(np.arange(n), sizes)
    if len(data) > 2:
        d = data.astype(np.uint32)
        h = (d[:-2] * _TRIGRAM[0] + d[1:-1] * _TRIGRAM[1] + d[2:] * _TRIGRAM[2]) >> np.uint32(22)
        inside = owner[:-2] == owner[2:]
        counts = np.bincount((owner[:-2] * _BINS + h)[inside], minlength=n * _BINS).reshape(n, _BINS)
        made[:, :_BINS] = np.sqrt(counts / np.maximum(1, counts.sum(1, keepdims=True)))
    for k, kind in enumerate((_UPPER, _DIGIT, _SPACE, _MARK)):
        total = np.concatenate([[0], np.cumsum(kind[data])])
        made[:, _BINS + k] = np.sqrt((total[offsets[1:]] - total[offsets[:-1]]) / some)
    starts, ends, rows = word_spans(data, offsets)
    words = np.diff(rows)
    some_words = np.maximum(words, 1)
    letters = np.concatenate([[0], np.cumsum(ends - starts)])
    made[:, _BINS + 4] = (letters[rows[1:]] - letters[rows[:-1]]) / some_words / 10
    distinct = np.array([len(s) for s in shingles(data, offsets, 5)])
    made[:, _BINS + 5] = distinct / np.maximum(1, words - 4)
    made[:, _BINS + 6] = np.array([len(s) for s in shingles(data, offsets, 1)]) / some_words
    made[:, _BINS + 7] = np.log1p(words) / 10
    made[:, _BINS + 8] = sizes == 0
    return made


def fit_ranking(rows: np.ndarray, good: np.ndarray, rounds: int = 400, penalty: float = 1e-4, pairs: int = 4096, seed: int = 3):
    """(weights, scale, cut): s(x) = x @ weights; ``cut`` and ``scale`` map s to a score of 0 to 1.

    Without both kinds of labels every text gets the same score, above the cut.
    """
    good = np.asarray(good, bool)
    if good.all() or not good.any():
        return np.zeros(rows.shape[1]), 1.0, -1.0
    spread = rows.std(0)
    used = spread > 1e-6
    scaled = np.where(used, rows / np.where(used, spread, 1), 0).astype(np.float32)
    best, worst = np.flatnonzero(good), np.flatnonzero(~good)
    draw = np.random.Generator(np.random.PCG64(seed))
    w = np.zeros(rows.shape[1], np.float64)
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0.02
    for t in range(1, rounds + 1):
        apart = scaled[draw.choice(best, pairs)] - scaled[draw.choice(worst, pairs)]
        lost = 1 / (1 + np.exp(np.clip(apart @ w.astype(np.float32), -30, 30)))
        slope = -(lost @ apart) / pairs + penalty * w
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w -= step * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    w = np.where(used, w / np.where(used, spread, 1), 0)
    scores = np.sort(rows @ w)
    at = len(worst)  # the quantile at the share of bad texts, between two labelled scores
    cut = float(scores[at - 1] + scores[min(at, len(scores) - 1)]) / 2
    scale = float(max(1e-6, np.median(scores) - cut))
    return w, scale, cut


def to_unit(raw: np.ndarray, scale: float, cut: float) -> np.ndarray:
    """Scores of 0 to 1 in the order of the raw ones, ``CUT_SCORE`` at the cut."""
    return 1 / (1 + np.exp(-np.clip(2 * (raw - cut) / scale, -40, 40)) * (1 - CUT_SCORE) / CUT_SCORE)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def labelled_features(documents: DataFrame, labels: DataFrame, max_labelled: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels of a bounded sample, in the order of the ids."""
    picked = (
        labels.filter("doc_id is not null and quality is not null")
        .filter(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(max_labelled)
    )
    docs = mark_possible(documents.select("doc_id", "text"), "doc_id", picked.select("label_id")).filter("possible")
    # rows that repeat an id are one labelled row, so that the bound holds for what comes to the driver
    one = docs.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select("doc_id", "t.text")
    rows = one.join(picked, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "quality")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                x = features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i).cast(pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["doc_id", "quality", "x"],
                )

    found = rows.select(F.col("doc_id").cast("long"), "text", F.col("quality").cast("int")).mapInArrow(task, "doc_id long, quality int, x binary").toArrow()
    order = np.lexsort((found["quality"].to_numpy(), found["doc_id"].to_numpy()))
    x = np.frombuffer(b"".join(found["x"].to_pylist()), np.float32).reshape(-1, N_FEATURES)
    return x[order], found["quality"].to_numpy()[order] > 0


def score(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``documents`` (doc_id, text; others unused).

    Labels are learnt from ``labels`` (doc_id, quality), but for documents held out by their id.
    Null or empty texts are scored like any text; a null doc_id is not held out. A document with
    several labels counts as good if one says so.
    """
    weights, scale, cut = fit_ranking(*labelled_features(documents, labels, max_labelled))
    weights = weights.astype(np.float64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.zeros(0)]
            for _, _, data, offsets in text_chunks(batch.column(1)):
                made.append(to_unit(features(data, offsets) @ weights, scale, cut))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(made), pa.float64())], names=["doc_id", "score"]
            )

    scored = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= CUT_SCORE).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``documents`` whose text scores at least ``CUT_SCORE``, with all their columns."""
    weights, scale, cut = fit_ranking(*labelled_features(documents, labels, max_labelled))
    weights = weights.astype(np.float64)
    at = documents.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.zeros(0)]
            for _, _, data, offsets in text_chunks(batch.column(at)):
                made.append(to_unit(features(data, offsets) @ weights, scale, cut))
            yield batch.filter(pa.array(np.concatenate(made) >= CUT_SCORE))

    return documents.mapInArrow(task, documents.schema)
