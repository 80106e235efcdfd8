"""As-of joins, sketches, target means, splits by time, file layouts and rejected rows on small tables."""

import datetime
import os
import random
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F, types as T

from shelfwise.operators import joins, sketches
from shelfwise.plans import encoding, forecasting
from shelfwise.sources import readers, sinks

DAY = datetime.date(2023, 11, 5)


def days(n):
    return DAY + datetime.timedelta(days=n)


@pytest.fixture
def lookups(spark):
    draw = random.Random(8)
    left = [(draw.choice(["a", "b", "c", "none", None]), days(draw.randrange(500)) if draw.random() > 0.05 else None, i) for i in range(300)]
    right = [(draw.choice(["a", "a", "a", "b", "c", None]), days(draw.randrange(500)) if draw.random() > 0.05 else None, draw.randrange(5), draw.choice([None, 1.5])) for _ in range(200)]
    return (
        left, right,
        spark.createDataFrame(left, "k string, date date, i int"),
        spark.createDataFrame(right, "k string, date date, v int, w double"),
    )


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("ranged", [True, False])
def test_asof_join_brings_each_row_its_own_date(lookups, strict, ranged):
    left, right, lefts, rights = lookups
    made = joins.asof_join(lefts, rights, ["k"], ["v", "w"], strict=strict, range_of=F.date_trunc("month", "date") if ranged else None)
    expected = []
    for k, d, i in left:
        known = [(rd, v, w is not None, w) for rk, rd, v, w in right if None not in (k, d, rd) and rk == k and (rd < d or rd == d and not strict)]
        rd, v, _, w = max(known, key=lambda r: r[:3]) if known else (None,) * 4
        expected.append((k, d, i, rd, v, w))
    assert rows(made) == sorted(expected, key=repr)
    assert made.columns == ["k", "date", "i", "found_date", "v", "w"]


def test_asof_join_shuffles_once_and_keeps_names(spark, lookups):
    _, _, lefts, rights = lookups
    assert plan(joins.asof_join(lefts, rights, ["k"], ["v"])).count("Exchange") == 1
    clashing = lefts.select("k", "date", F.lit(1).alias("_left"), F.lit(2).alias("_right"), F.lit(3).alias("_k0"), F.lit(4).alias("_found"))
    assert joins.asof_join(clashing, rights, ["k"], ["v"]).filter("_left = 1 and _k0 = 3").count() == 300
    assert joins.asof_join(lefts.limit(0), rights, ["k"], ["v"], range_of=F.year("date")).collect() == []
    assert joins.asof_join(lefts, rights.limit(0), ["k"], ["v"]).filter("v is null").count() == 300


def test_sketches_merge_like_sets(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("g"), (F.col("id") % 5).alias("h"), (F.col("id") % 6000).alias("x"))
    stored = sketches.distinct_sketches(df, ["g", "h"], ["x"])
    for keys in (["g"], ["h"], []):
        exact = {tuple(r[:-1]): r[-1] for r in df.groupBy(*keys).agg(F.count_distinct("x")).collect()}
        for r in sketches.sketch_counts(sketches.merge_sketches(stored, keys, ["x"]), ["x"]).collect():
            assert abs(r[-1] - exact[tuple(r[:-1])]) <= 5 * sketches.standard_error() * exact[tuple(r[:-1])]


def test_target_means_leave_out_their_own_fold(spark):
    draw = random.Random(5)
    data = [(i, draw.choice(["x", "y", "z", None]), draw.randrange(100)) for i in range(400)]
    df = spark.createDataFrame(data, "i int, c string, q int")
    means = encoding.fit_target_means(df, ["c"], "q", ["i"], folds=4, prior_rows=3)
    folded = {r.i: r.f for r in df.select("i", encoding.fold_of(["i"], 4).alias("f")).collect()}

    def mean(value, without):
        some = [(c, q) for i, c, q in data if folded[i] != without]
        own = [q for c, q in some if c == value]
        return (sum(own) + 3 * sum(q for _, q in some) / len(some)) / (len(own) + 3)

    for r in means.for_training(df).collect():
        assert abs(r.c_mean - mean(r.c, folded[r.i])) < 1e-9
    others = spark.createDataFrame([(1, "x"), (2, "new"), (3, None)], "i int, c string")
    assert all(abs(r.c_mean - mean(r.c, None)) < 1e-9 for r in means.for_others(others).collect())
    empty = encoding.fit_target_means(df.limit(0), ["c"], "q", ["i"])
    assert {r.c_mean for r in empty.for_others(others).collect()} == {0.0}


def test_target_means_tell_many_products_apart(spark):
    """At 2,000 products, each with a level of its own: 64 shared places against one mean."""
    df = spark.range(24_000).select(
        (F.col("id") % 2000).cast("string").alias("product_id"),
        F.date_add(F.lit(DAY), (F.col("id") / 2000).cast("int")).alias("date"),
        F.pmod(F.xxhash64(F.col("id") % 2000), F.lit(100)).cast("long").alias("quantity"),
        F.lit(0.0).alias("zero"),
    )
    train, test = forecasting.split_rows(df, ["product_id", "date"])
    options = {"feature_columns": ["zero"], "names": ["linear_regression"]}
    hashed = forecasting.train_models(train, test, with_categories=True, **options).metrics["linear_regression"]["rmse"]
    means = forecasting.train_models(train, test, target_means=["product_id"], **options)
    assert means.metrics["linear_regression"]["rmse"] < 20 < 25 < hashed
    assert means.feature_columns[-1] == "product_id_mean"
    assert abs(means.predict(test).agg(F.avg(F.col("prediction") - F.col("quantity"))).first()[0]) < 2


def test_rolling_folds_never_train_on_later_days(spark):
    df = spark.range(100).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"), F.lit(1).alias("fold"))
    used = forecasting.rolling_folds(df.drop("fold"), 3, 10, F.lit(days(99)))
    sides = defaultdict(list)
    for r in used.collect():
        sides[r.fold, r.side].append((r.date - DAY).days)
    for f in range(3):
        assert sorted(sides[f, "test"]) == list(range(90 - 10 * f, 100 - 10 * f))
        assert sorted(sides[f, "train"]) == list(range(90 - 10 * f))
    assert plan(used).count("Range") == 1 and "Exchange" not in plan(used)


def test_fit_partitions_follow_the_rows():
    assert [forecasting.fit_partitions(n) for n in (0, 16_000_000, 16_000_001, 10**12)] == [16, 16, 17, 10**6]


def test_layout_follows_the_size(spark, tmp_path):
    df = spark.range(4000).select(F.date_add(F.lit(DAY), (F.col("id") % 400).cast("int")).alias("date"), F.lit("Nyeri").alias("county"), "id")
    for least, columns in ((5, ["date", "county"]), (100, ["month", "county"]), (1000, ["year", "county"]), (10**6, ["county"])):
        path = str(tmp_path / f"refined-{least}")
        assert sinks.write_refined_by_size(df, path, least_rows=least) == columns
        stored = readers.read_refined(spark, path)
        assert rows(stored.select(df.columns)) == rows(df)
        if "month" in columns:
            assert "PartitionFilters: [isnotnull(month" in plan(spark.read.parquet(path).filter("month = '2024-02'"))


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_small_files_are_packed(spark, tmp_path):
    path = str(tmp_path / "grown")
    large = spark.range(200_000).select("id", F.rand(1).alias("x"), (F.col("id") % 2).cast("string").alias("county"))
    sinks.write_layer(large, path, ["county"])
    kept = _files(path)
    limit = min(os.path.getsize(f) for f in kept)
    for n in range(6):
        large.filter(F.col("id") < 50).withColumn("id", F.col("id") + 1_000_000 * n).coalesce(1).write.mode("append").partitionBy("county").parquet(path)
    before = rows(spark.read.parquet(path).groupBy("county").agg(F.count("*"), F.sum("id")))
    were, are = sinks.compact_small(spark, path, limit, ["county"], large.schema)
    after = _files(path)
    assert were == 12 and are <= 2 and len(after) == len(kept) + are
    assert kept.items() <= after.items()
    assert rows(spark.read.parquet(path).groupBy("county").agg(F.count("*"), F.sum("id"))) == before
    assert not [d for d in os.listdir(path) if d.startswith("_packed")]
    assert sinks.compact_small(spark, path, 1, ["county"], large.schema) == (0, 0)


def test_inserts_at_once_keep_each_others_partitions(spark, sales):
    sinks.create_table(sales, "sales_at_once", ["county"])
    sinks.insert_partitions(sales, "sales_at_once", ["county"])
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    def reload(county):
        part = sales.filter(F.col("county") == county).withColumn("quantity", F.lit(1000))
        sinks.insert_partitions(part, "sales_at_once", ["county"], overwrite=True)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(reload, ["Nyeri", "Kitui"]))
    found = {r.county: r.q for r in spark.table("sales_at_once").groupBy("county").agg(F.sum("quantity").alias("q")).collect()}
    assert found == {"Nyeri": 3000, "Kitui": 1000, "Isiolo": 3}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    sinks.insert_partitions(sales.limit(0), "sales_at_once", ["county"], overwrite=True)
    assert spark.table("sales_at_once").count() == 5
    spark.sql("DROP TABLE sales_at_once")


def test_rejected_rows_keep_their_line_and_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text("id,n,day\na,1,2024-01-01\nb,x,2024-01-02\n,3,2024-01-03\n")
    (tmp_path / "two.csv").write_text("id,n,day\nc,4,never\nd,,2024-01-04\n")
    schema = T.StructType.fromDDL("id string, n int, day date")
    good, rejected = readers.split_rejected(readers.read_csv(spark, str(tmp_path), schema, keep_corrupt=True), ("id", "n"))
    assert rows(good.select("id", "n")) == [("a", 1)]
    assert rows(rejected.select("reason", "file")) == [("malformed", "one.csv"), ("malformed", "two.csv"), ("no id", "one.csv"), ("no n", "two.csv")]
    assert {r.line for r in rejected.filter("reason = 'malformed'").collect()} == {"b,x,2024-01-02", "c,4,never"}
