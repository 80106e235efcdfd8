"""Sinks and table maintenance."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Curated datasets and the columns each is partitioned by.
CURATED_LAYOUT = {
    "sales_by_product": ("category",),
    "sales_by_county": ("county",),
    "sales_by_category": (),
    "top_items_per_county": ("county",),
    "comprehensive_view": ("county",),
}
REFINED_LAYOUT = ("date", "county")

# Sketched layouts for larger tables: partition columns, bucket columns, bucket count.
BUCKETED_LAYOUTS = {
    "sales_data": (("year", "month", "county"), ("product_id",), 50),
    "customer_data": (("county", "registration_year"), ("customer_id",), 100),
    "product_data": (("category", "subcategory"), ("product_id",), 25),
}


def gather(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together before a write, so that files are few.

    A rebalance, not a plain repartition: adaptive execution splits a partition value
    that holds much of the table over many tasks and joins the small ones.
    """
    return df.hint("rebalance", *partition_cols)


def write_layer(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
    max_records_per_file: int | None = None,
) -> None:
    """Write a dataset; overwriting replaces the schema with the data."""
    writer = gather(df, partition_cols).write.format(fmt).mode(mode)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def write_refined(df: DataFrame, path: str, partition_cols: Sequence[str] = REFINED_LAYOUT) -> None:
    write_layer(df, path, partition_cols)


def layout_by_size(df: DataFrame, grains: Mapping[str, Column], rest: Sequence[str], least_rows: int) -> str | None:
    """The finest of ``grains`` (name and expression, finest first) whose partitions, by it and ``rest``, hold enough rows.

    Partitions that are smaller than ``least_rows`` on average cost more to list and open than to read. All
    grains are measured in one pass, with approximate counts; None if even the coarsest is too fine.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.approx_count_distinct(F.struct(grain, *rest)).alias(name) for name, grain in grains.items()],
    ).first()
    return next((name for name in grains if counts["n"] >= least_rows * counts[name]), None)


def write_refined_by_size(
    df: DataFrame, path: str, date: str = "date", rest: Sequence[str] = ("county",), least_rows: int = 100_000
) -> list[str]:
    """The refined layer partitioned by days, else months, else years, whichever has partitions of enough rows.

    Gives the partition columns. The date itself stays a column where the partitions are coarser.
    """
    grains = {date: F.col(date), "month": F.date_format(date, "yyyy-MM"), "year": F.date_format(date, "yyyy")}
    grain = layout_by_size(df, grains, rest, least_rows)
    columns = [*([grain] if grain else []), *rest]
    if grain and grain != date:
        df = df.withColumn(grain, grains[grain])
    write_layer(df, path, columns)
    return columns


def write_curated(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Write the curated datasets below ``root``; gives the path of each.

    The writes are submitted together: most are too small to fill a cluster alone.
    """
    paths = {name: f"{root}/{name}" for name in tables}
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        writes = [pool.submit(write_layer, df, paths[name], CURATED_LAYOUT[name]) for name, df in tables.items()]
        for write in writes:
            write.result()
    return paths


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition_cols: Sequence[str] = (),
    max_records_per_file: int | None = None,
    fmt: str = "parquet",
) -> None:
    """Rewrite a dataset of many small files to a new path with fewer files."""
    df = spark.read.format(fmt).load(source)
    write_layer(df, target, partition_cols, fmt, "errorifexists", max_records_per_file)


def compact_small(
    spark: SparkSession, path: str, small_bytes: int, partition_cols: Sequence[str] = (), schema: T.StructType | None = None
) -> tuple[int, int]:
    """Pack the files below ``small_bytes`` of a Parquet dataset in place; gives how many there were and are now.

    The sizes come from the files' metadata, and larger files are neither read nor touched. The packed files
    are written to a hidden folder first, then moved in, and only then are the small ones deleted; a run that
    dies before moving leaves the dataset as it was. Nobody else may write to the dataset meanwhile.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    stored = reader.parquet(path)
    small = stored.filter(F.col("_metadata.file_size") < small_bytes)
    names = [row.p for row in small.select(F.col("_metadata.file_path").alias("p")).distinct().toLocalIterator()]
    if len(names) < 2:
        return len(names), len(names)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    staged = jvm.org.apache.hadoop.fs.Path(root, f"_packed-{uuid.uuid4().hex}")
    write_layer(small, staged.toString(), partition_cols, mode="errorifexists")
    base, moved = files.makeQualified(staged).toString(), 0
    listing = files.listFiles(staged, True)
    while listing.hasNext():
        made = listing.next().getPath()
        if made.getName().startswith(("_", ".")):
            continue
        target = jvm.org.apache.hadoop.fs.Path(root, made.toString()[len(base) + 1 :])
        files.mkdirs(target.getParent())
        if not files.rename(made, target):
            raise OSError(f"could not move {made} to {target}")
        moved += 1
    for name in names:
        files.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)), False)
    files.delete(staged, True)
    return len(names), moved


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def _columns_ddl(df: DataFrame, partition_cols: Sequence[str]) -> str:
    ordered = [c for c in df.columns if c not in partition_cols] + list(partition_cols)
    types = dict(df.dtypes)
    return ", ".join(f"`{c}` {types[c]}" for c in ordered)


def create_table(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str] = (),
    location: str | None = None,
    fmt: str = "parquet",
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the columns of ``df``, managed or at ``location``."""
    clauses = [f"CREATE TABLE IF NOT EXISTS {name} ({_columns_ddl(df, partition_cols)}) USING {fmt}"]
    if partition_cols:
        clauses.append("PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_cols) + ")")
    if location:
        clauses.append(f"LOCATION '{location}'")
    df.sparkSession.sql(" ".join(clauses))


def create_external_table(
    spark: SparkSession, name: str, location: str, schema_of: DataFrame, partition_cols: Sequence[str] = ()
) -> None:
    """A table over existing files, with the partitions found there."""
    create_table(schema_of, name, partition_cols, location)
    if partition_cols:
        spark.catalog.recoverPartitions(name)


def insert_partitions(
    df: DataFrame, name: str, partition_cols: Sequence[str], overwrite: bool = False
) -> None:
    """Insert with dynamic partitions; ``overwrite`` replaces just the partitions that ``df`` has.

    An overwrite goes to the table's files with the mode as an option of this one write, and the table then
    learns of new partitions: the session's setting, which other inserts see, stays as it is.
    """
    spark = df.sparkSession
    if not overwrite:
        ordered = [c for c in df.columns if c not in partition_cols] + list(partition_cols)
        gather(df.select(*ordered), partition_cols).write.insertInto(name)
        return
    detail = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    table = spark.table(name)
    rows = gather(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema]), partition_cols)
    writer = rows.write.format(detail["Provider"]).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_cols).save(detail["Location"])
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def create_table_as(
    df: DataFrame, name: str, partition_cols: Sequence[str] = (), location: str | None = None
) -> None:
    """A table of the rows of ``df``, managed or at ``location``."""
    writer = gather(df, partition_cols).write.format("parquet")
    if location:
        writer = writer.option("path", location)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.saveAsTable(name)


def write_bucketed(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str],
    bucket_cols: Sequence[str],
    buckets: int,
    location: str | None = None,
) -> None:
    """A table laid out by partition and bucket: joins on the bucket columns need no shuffle.

    The rows of one bucket of one partition are gathered first (and split again by the
    rebalance if they are many), so that few files are written.
    """
    number = F.pmod(F.hash(*bucket_cols), F.lit(buckets))
    gathered = gather(df.withColumn("_bucket", number), [*partition_cols, "_bucket"]).drop("_bucket")
    writer = gathered.write.format("parquet").mode("overwrite")
    if location:
        writer = writer.option("path", location)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.bucketBy(buckets, *bucket_cols).sortBy(*bucket_cols).saveAsTable(name)


def write_layout(
    df: DataFrame, name: str, layout: str, location: str | None = None, least_rows: int = 100_000
) -> list[str]:
    """A table by one of ``BUCKETED_LAYOUTS``, with as many of its partition columns as the rows fill.

    Each partition holds a file for each bucket, so the longest beginning of the partition columns is taken
    whose files get ``least_rows`` rows on average; buckets stay as they are. Gives the partition columns.
    """
    partition_cols, bucket_cols, buckets = BUCKETED_LAYOUTS[layout]
    grains = {str(n): F.struct(*partition_cols[:n]) for n in range(len(partition_cols), 0, -1)}
    taken = list(partition_cols[: int(layout_by_size(df, grains, (), least_rows * buckets) or 0)])
    write_bucketed(df, name, taken, bucket_cols, buckets, location)
    return taken
