import json

from conftest import rows
from pyspark.sql import functions as F

from shelfwise.streaming import windows


def put(path, number, events):
    lines = [json.dumps({"timestamp": t, "county": c, "amount": a}) for t, c, a in events]
    (path / f"{number}.txt").write_text("\n".join(lines) + "\n")


def run_once(spark, source, out, state):
    stream = windows.read_events(spark, "text", path=str(source))
    result = windows.windowed_sales(windows.parse_events(stream))
    running = windows.write_windows(result, str(out), str(state), available_now=True)
    running.awaitTermination()
    return spark.read.schema(result.schema).parquet(str(out))


def test_stream_emits_closed_windows_once_and_drops_late_events(spark, tmp_path):
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    source.mkdir()
    put(source, 1, [
        ("2023-01-01T00:01:00Z", "x", 1.5), ("2023-01-01T00:02:00Z", "x", 2.5), ("2023-01-01T00:07:00Z", "y", 1),
        ("2023-01-01T01:12:00Z", "x", 9),
    ])
    first = run_once(spark, source, out, state)
    assert rows(first.select("county", "transaction_count", "total_sales")) == rows(
        spark.createDataFrame([("x", 2, 4.0), ("y", 1, 1.0)], "county string, n long, total double")
        .withColumn("total", F.col("total").cast("decimal(28,2)"))
    )
    put(source, 2, [("2023-01-01T00:03:00Z", "x", 100), ("2023-01-01T03:00:00Z", "x", 1)])
    second = run_once(spark, source, out, state)
    totals = {(r.window_start.hour, r.window_start.minute, r.county): float(r.total_sales) for r in second.collect()}
    assert totals == {(0, 0, "x"): 4.0, (0, 5, "y"): 1.0, (1, 10, "x"): 9.0}


def late_once(spark, source, out, state):
    stream = windows.read_events(spark, "text", path=str(source))
    running = windows.write_late_events(windows.parse_events(stream), str(out), str(state), available_now=True)
    running.awaitTermination()
    return windows.late_events(spark, str(out))


def test_late_events_are_kept_across_restarts(spark, tmp_path):
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    source.mkdir()
    put(source, 1, [("2023-01-01T00:01:00Z", "x", 1.5), ("2023-01-01T01:12:00Z", "x", 9), (None, "x", 4)])
    assert late_once(spark, source, out, state).count() == 0
    # the mark stands at 00:12: the window to 00:10 is closed, that to 00:15 is not
    put(source, 2, [("2023-01-01T00:09:59Z", "x", 100), ("2023-01-01T00:11:00Z", "y", 2), ("2023-01-01T03:00:00Z", "x", 1)])
    second = late_once(spark, source, out, state).collect()
    assert [(r.county, float(r.amount), r.batch) for r in second] == [("x", 100.0, 1)]
    # older events alone do not move the mark back
    put(source, 3, [("2023-01-01T01:30:00Z", "z", 7)])
    late_once(spark, source, out, state)
    put(source, 4, [("2023-01-01T01:54:00Z", "z", 8), ("2023-01-01T02:10:00Z", "z", 9)])
    fourth = late_once(spark, source, out, state).collect()
    assert sorted((float(r.amount), r.batch) for r in fourth) == [(7.0, 2), (8.0, 3), (100.0, 1)]


def test_unreadable_payload_gives_nulls(spark):
    df = spark.createDataFrame([("not json",), ('{"county": "x", "amount": 1.25}',)], "value string")
    parsed = windows.parse_events(df).collect()
    assert [r.county for r in parsed] == [None, "x"]
