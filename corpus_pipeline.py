"""A corpus pipeline: documents pass through the stages one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.idsets import without_ids
from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.near_dedup import near_duplicates
from shelfwise.llm.pieces import encode
from shelfwise.llm.quality import keep_good
from shelfwise.llm.repeats import without_repeats
from shelfwise.session import materialize

#: A source is used this often at most, and at least once, so no document is lost in mixing.
MAX_REPEATS = 2.0
#: Texts whose shingle sets agree by so much are near-duplicates in this stage; op1 asks for more.
NEAR_PERCENT = 80


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents; n_chars counts the characters of the text as it is."""
    return docs.select("doc_id", "text", "lang", "source", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality score rejects go."""
    return _documents(keep_good(_documents(docs), spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: that of the smallest id.

    Rows that share an id are one document, so one of them stays; the one with the longest text,
    then the last in the order of the other columns. Rows without an id stay.
    """
    found = materialize(near_duplicates(docs, percent=NEAR_PERCENT), "near-duplicates")
    dropped = found.filter("not kept").select("doc_id").distinct()
    docs = without_ids(docs, "doc_id", materialize(dropped, "dropped"))
    if found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").limit(1).count():
        named = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.struct(F.length("text"), "text", "lang", "source")).alias("x"))
        one = named.select("doc_id", "x.text", "x.lang", "x.source")
        docs = one.union(docs.filter("doc_id is null").select(one.columns))
    return _documents(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur more than once are cut out of the texts."""
    return _documents(without_repeats(_documents(docs)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture uses it."""
    used = mix_sources(docs, max_repeats=MAX_REPEATS, cover=True, text_key=True)
    # equal rows (id, source and text) are repeated together: one of them as often as all of them are to be
    again = used.groupBy(F.col("doc_id").alias("_id"), F.xxhash64("source").alias("_source"), F.col("text_key").alias("_text")).agg(
        F.sum(F.col("copies") - 1).alias("_more"), F.count(F.lit(1)).alias("_rows")
    )
    again = materialize(again.filter("_more > 0"), "copies")
    source = F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (source == F.col("_source")) & (F.xxhash64("text") == F.col("_text"))
    repeated = docs.join(again, same)
    if again.filter("_rows > 1").limit(1).count():
        repeated = repeated.dropDuplicates(["_id", "_source", "_text"])
    extra = repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_more"))))
    return _documents(docs).union(_documents(extra))


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as sampled pieces: doc_id, lang, source, n_chars, piece_ids, n_pieces."""
    return encode(_documents(docs))


STAGES = [
    ("quality classifier", reject_poor),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", cut_repeats),
    ("source mixing", mix),
    ("SentencePiece encoding", segment),
]

#: Learnt scores, sampled pieces and byte-wise digests have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents; what each stage returns is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{i}")
    return docs
