import datetime
import json

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F, types as T

from shelfwise import schemas
from shelfwise.operators import audit, protection, quality, segments
from shelfwise.plans import curate
from shelfwise.sources import readers


def test_checks(sales):
    dirty = sales.unionByName(
        sales.limit(1).withColumns({"product_id": F.lit(""), "price": F.lit(-1).cast("decimal(12,2)")})
    )
    result = {r.check: r for r in quality.quality_checks(dirty, min_rows=6).collect()}
    assert not result["min_rows_check"].passed and result["min_rows_check"].actual == 6
    assert result["no_negative_prices_check"].actual == 1
    assert result["no_null_product_ids_check"].actual == 1
    assert result["valid_dates_check"].passed
    assert quality.quality_verdict(quality.quality_checks(dirty)).first().overall_status == "FAILED"
    good = quality.quality_verdict(quality.quality_checks(sales, min_rows=4)).first()
    assert (good.passed, good.overall_status, good.failed_checks) == (True, "PASSED", 0)


def test_date_check_needs_a_date_and_reads_text(spark, sales):
    assert quality.quality_checks(sales.drop("date")).count() == 3
    text = sales.withColumn("date", F.lit("no date"))
    result = {r.check: r for r in quality.quality_checks(text).collect()}
    assert result["valid_dates_check"].actual == 5


def test_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, None)], "a int, b string")
    assert rows(quality.null_profile(df)) == [("a", 4, 1), ("b", 4, 3)]
    assert quality.duplicate_count(df).first() == (4, 3, 1)
    assert quality.duplicate_count(df.limit(0)).first() == (0, 0, 0)


def test_issues(spark):
    df = spark.createDataFrame(
        [(-1.0, 0, None), (1.0, 1, ""), (1.0, 0, "x")], "total_revenue double, total_quantity long, product_name string"
    )
    assert rows(quality.quality_issues(df)) == [
        ("Negative revenue", 1), ("Null product names", 2), ("Zero quantity", 2)
    ]


def test_breaking_changes(spark):
    old = T.StructType.fromDDL("a int, b string, c double")
    new = T.StructType.fromDDL("a bigint, c double, d string")
    found = audit.breaking_changes(audit.schema_rows(spark, "t", old), audit.schema_rows(spark, "t", new))
    assert rows(found.select("field", "description")) == [
        ("a", "Type change for a: int -> bigint"), ("b", "Removed field: b")
    ]
    gone = audit.schema_rows(spark, "other", old)
    assert audit.breaking_changes(gone, audit.schema_rows(spark, "t", new)).count() == 0
    verdicts = audit.schema_compatibility(
        audit.schema_rows(spark, "t", old).unionByName(gone), audit.schema_rows(spark, "t", new)
    )
    assert rows(verdicts) == [("other", 0, 0, True), ("t", 1, 1, False)]
    record = audit.schema_change_record(spark, "job", "t", old, new).first()
    assert record.impact_analysis.breaking_changes == ["Removed field: b", "Type change for a: int -> bigint"]
    assert record.impact_analysis.backward_compatible is False
    same = audit.schema_change_record(spark, "job", "t", old, old).first()
    assert same.impact_analysis.breaking_changes == [] and same.impact_analysis.backward_compatible


def test_audit_round_trip(spark, sales, tmp_path):
    path = str(tmp_path / "audit")
    for status in ("SUCCESS", "FAILED", "PARTIAL"):
        audit.append_audit(audit.run_record(spark, "job", ["in"], "out", ["a", "b"], {"rows": 5}, status), path)
    audit.append_audit(audit.quality_record(quality.quality_checks(sales), "job"), path)
    audit.append_audit(
        audit.schema_change_record(spark, "job", "t", sales.schema, sales.drop("price").schema), path
    )
    (tmp_path / "audit" / "broken.json").write_text('{"job_name": "half\n')
    records = readers.read_audit(spark, path, days=7)
    assert records.count() == 5
    summary = audit.audit_summary(records, 7).first()
    assert summary.asDict() == {
        "period_days": 7, "total_jobs": 3, "successful_jobs": 1, "failed_jobs": 2, "total_transformations": 6,
        "quality_checks_passed": 0, "quality_checks_failed": 1,
    }
    quality_row = records.filter("overall_status is not null").first()
    assert quality_row.compliance.audit_required and not quality_row.compliance.quality_standards
    assert quality_row.checks["min_rows_check"].actual == 5
    later = F.lit(datetime.datetime.now() + datetime.timedelta(days=8))
    assert readers.read_audit(spark, path, days=7, as_of=later).count() == 0


def test_audit_by_day_reads_only_the_days_asked_for(spark, tmp_path):
    path = str(tmp_path / "days")
    for day in range(1, 29):
        record = audit.run_record(spark, f"job{day}", ["in"], "out", ["a"], {}, "SUCCESS" if day % 2 else "FAILED")
        audit.append_audit(record.withColumn("timestamp", F.lit(f"2024-02-{day:02d}T10:30:00")), path, by_day=True)
    undated = audit.run_record(spark, "undated", [], "", [], {}).withColumn("timestamp", F.lit("never"))
    audit.append_audit(undated, path, by_day=True)
    last = F.lit("2024-02-28T10:30:00")
    recent = readers.read_audit(spark, path, days=7, as_of=last, by_day=True)
    assert recent.columns == [f.name for f in schemas.AUDIT_RECORD.fields]
    assert sorted(r.job_name for r in recent.collect()) == [f"job{day}" for day in range(21, 29)]
    scan = next(line for line in plan(recent).splitlines() if "FileScan json" in line)
    assert "PartitionFilters: [isnotnull(day" in scan
    assert readers.read_audit(spark, path, by_day=True).count() == 29
    assert audit.audit_summary(recent, 7).first().failed_jobs == 4


def test_a_run_that_raises_leaves_a_failed_record(spark, tmp_path):
    path = str(tmp_path / "runs")
    with pytest.raises(ZeroDivisionError):
        with audit.recorded_run(spark, path, "job", ["in"], "out", ["a", "b"]) as metrics:
            metrics["rows"] = 5
            metrics["rows"] / 0
    with audit.recorded_run(spark, path, "job", ["in"], "out", ["a"]) as metrics:
        metrics["rows"] = 7
    failed, done = sorted(readers.read_audit(spark, path).collect(), key=lambda r: r.status)
    assert (failed.status, done.status) == ("FAILED", "SUCCESS")
    assert failed.metrics == {"rows": "5", "error": "ZeroDivisionError: division by zero"}
    assert done.metrics == {"rows": "7"} and failed.transformations == ["a", "b"]
    summary = audit.audit_summary(readers.read_audit(spark, path)).first()
    assert (summary.total_jobs, summary.successful_jobs, summary.failed_jobs) == (2, 1, 1)


def test_the_error_of_a_run_outlives_an_audit_that_fails(spark, tmp_path):
    (tmp_path / "file").write_text("")
    with pytest.raises(KeyError):
        with audit.recorded_run(spark, str(tmp_path / "file" / "below"), "job", [], "", []):
            raise KeyError("missing")
    with pytest.raises(KeyError):
        with audit.recorded_run(spark, None, "job", [], "", []):
            raise KeyError("missing")


def test_jobs_record_their_failures(spark, tmp_path):
    with pytest.raises(Exception):
        curate.run_curate(spark, str(tmp_path / "none"), str(tmp_path / "curated"), str(tmp_path / "audit"))
    record = readers.read_audit(spark, str(tmp_path / "audit" / "runs")).first()
    assert (record.job_name, record.status) == ("curate", "FAILED") and "AnalysisException" in record.metrics["error"]


def test_audit_documents_of_many_lines(spark, tmp_path):
    (tmp_path / "run.json").write_text(
        json.dumps({"job_name": "j", "timestamp": "2023-01-01T00:00:00", "status": "SUCCESS",
                    "transformations": ["x"]}, indent=2)
    )
    (tmp_path / "bad.json").write_text("{")
    records = readers.read_audit(spark, str(tmp_path), whole_files=True)
    assert records.count() == 1
    assert audit.audit_summary(records).first().total_jobs == 1


def test_empty_summary(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    summary = audit.audit_summary(readers.read_audit(spark, str(tmp_path))).first()
    assert (summary.total_jobs, summary.total_transformations) == (0, 0)


def test_encryption(spark):
    key = F.unhex(F.lit("00112233445566778899aabbccddeeff"))
    df = spark.createDataFrame([("ann", 1.5), (None, None)], "name string, balance double")
    hidden = protection.encrypt_columns(df, ["name", "balance"], key)
    first = hidden.first()
    assert first.name != "ann" and dict(hidden.dtypes)["balance"] == "string"
    assert rows(protection.decrypt_columns(hidden, {"name": "string", "balance": "double"}, key)) == rows(df)
    other = F.unhex(F.lit("ff112233445566778899aabbccddeeff"))
    with pytest.raises(Exception):
        protection.decrypt_columns(hidden, {"name": "string"}, other).collect()


def test_rfm_and_segments(spark):
    data = [(c, datetime.date(2023, 1, 1 + c % 28), 10.0 * c) for c in range(40)] * 2
    purchases = spark.createDataFrame(data, "customer_id int, date date, amount double")
    table = segments.rfm(purchases, "2023-02-01")
    row = table.filter("customer_id = 3").first()
    assert (row.recency, row.frequency, row.monetary_value) == (28, 2, 60.0)
    segmented = segments.fit_segments(table).transform(table)
    profile = segments.segment_profile(segmented).collect()
    assert len(profile) == 5 and sum(r.customer_count for r in profile) == 40
