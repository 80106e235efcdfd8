"""Scans: CSV, columnar layers, catalog tables and audit records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfwise import schemas

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, keep_corrupt: bool = False
) -> DataFrame:
    """CSV files with a header. Without a schema the types are inferred in an extra pass."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def split_rejected(rows: DataFrame, required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of a CSV scan with ``keep_corrupt``, from the same scan.

    A row is rejected if a value does not fit its column ('malformed') or a ``required`` column is missing
    ('no <column>', the first one). Rejected rows keep the line as it was, the reason and the file.
    """
    values = [c for c in rows.columns if c != CORRUPT]
    # a scan only checks the columns that it is asked for; the second test is never true but asks for all
    unfit = F.col(CORRUPT).isNotNull() | (F.size(F.array(*[F.col(c).cast("string") for c in values])) < len(values))
    reason = F.when(unfit, "malformed")
    for name in required:
        reason = reason.when(F.col(name).isNull(), f"no {name}")
    marked = rows.select("*", reason.alias("_reason"), F.col("_metadata.file_name").alias("_file"))
    line = F.coalesce(CORRUPT, F.to_csv(F.struct(*values)))
    rejected = marked.filter("_reason is not null").select(line.alias("line"), F.col("_reason").alias("reason"), F.col("_file").alias("file"))
    return marked.filter("_reason is null").select(*values), rejected


def read_raw(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Raw sales and products below ``root``."""
    return (
        read_csv(spark, f"{root}/sales/*.csv", schemas.RAW_SALES),
        read_csv(spark, f"{root}/products/*.csv", schemas.PRODUCTS),
    )


def read_layer(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A columnar dataset. Pass the schema to keep text partition values as text."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_refined(spark: SparkSession, path: str) -> DataFrame:
    """The refined layer. Its date, text where it comes from the names of folders, is a date."""
    stored = read_layer(spark, path)
    return stored.withColumn("date", F.col("date").try_cast("date")) if "date" in stored.columns else stored


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make each DataFrame readable by name in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_audit(
    spark: SparkSession, path: str, days: int | None = None, as_of=None, whole_files: bool = False,
    by_day: bool = False,
) -> DataFrame:
    """Audit records of the last ``days`` days before ``as_of``; those unreadable or undated are left out.

    ``whole_files`` reads files that hold one indented document each; the default is
    one record a line, which splits across tasks. ``by_day`` says that the records lie in a folder for
    each day; folders of earlier days are then not read.
    """
    day = [T.StructField(schemas.AUDIT_DAY, T.DateType())] if by_day else []
    schema = T.StructType([*schemas.AUDIT_RECORD.fields, T.StructField(CORRUPT, T.StringType()), *day])
    records = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", whole_files)
        .json(path)
        .filter(F.col(CORRUPT).isNull() & F.col("timestamp").isNotNull())
        .drop(CORRUPT)
    )
    if by_day and days is not None:
        records = records.filter(F.col(schemas.AUDIT_DAY) >= _cutoff(days, as_of).cast("date"))
    records = records.drop(schemas.AUDIT_DAY)
    return records if days is None else recent_records(records, days, as_of)


def recent_records(records: DataFrame, days: int, as_of=None) -> DataFrame:
    return records.filter(F.col("timestamp").try_cast("timestamp") >= _cutoff(days, as_of))


def _cutoff(days: int, as_of=None) -> Column:
    now = F.current_timestamp() if as_of is None else as_of
    return F.timestamp_add("DAY", F.lit(-days), now.cast("timestamp"))
