"""Rejected rows and unparsed values: nothing is lost, and the gate counts them."""

import pytest
from pyspark.sql import functions as F
from test_operators import load, raw  # noqa: F401

from tarifa.operators import rejects, upsert
from tarifa.operators.quality import QualityError
from tarifa.operators.staging import stage_flights
from tarifa.plans import refresh
from tarifa.plans.queries import damaged
from tarifa.session import new_path
from tarifa.sources.tables import append_bronze


def counts(report):
    return {(r["kind"], r["name"]): r["found_rows"] for r in report.collect()}


def test_kept_and_rejected_are_the_input(spark, raw):  # noqa: F811
    for rows in (raw, damaged(raw), raw.limit(0)):
        audited = rejects.audit(rows)
        found = counts(rejects.summary(audited))
        assert found["rows", "kept"] == stage_flights(rows).count()
        assert found["rows", "kept"] + found["rows", "rejected"] == found["rows", "input"] == rows.count() == audited.count()
        wrong = audited.where(F.col("kept") != (F.size("reasons") == 0))
        assert wrong.isEmpty()


def test_values_are_reported_with_their_text(spark, raw):  # noqa: F811
    one = damaged(raw.where("LEGID like '%7' AND TOTALFARE > 0 AND SEATSREMAINING >= 0")).limit(1).withColumn("TRAVELDURATION", F.lit("PT2H5M"))
    cases = {
        "SEARCHDATE": "2024-13-01", "FLIGHTDATE": "x", "BASEFARE": "1.2.3", "TOTALFARE": "99999999999", "SEATSREMAINING": "3000000000",
        "TOTALTRAVELDISTANCE": "far", "ELAPSEDDAYS": "-", "TRAVELDURATION": "PTXHYM",
    }
    for name, text in cases.items():
        row = rejects.audit(one.withColumn(name, F.lit(text))).first()
        assert [tuple(u) for u in row["unparsed"]] == [(name, text)]
        assert row["kept"] == (name not in ("SEARCHDATE", "FLIGHTDATE", "TOTALFARE", "SEATSREMAINING"))
        for blank in (None, "", "  "):
            row = rejects.audit(one.withColumn(name, F.lit(blank).cast("string"))).first()
            assert row["unparsed"] == []
    row = rejects.audit(one.withColumns({"LEGID": F.lit(None).cast("string"), "TOTALFARE": F.lit("0"), "SEATSREMAINING": F.lit("-1")})).first()
    assert row["leg_id"] is None and row["reasons"] == ["no leg_id", "no positive total_fare", "no seats_remaining"]


def test_load_stores_its_rejects(spark, raw):  # noqa: F811
    table, path = new_path(spark, "staging"), new_path(spark, "rejects")
    rows = load(raw, "1", "2024-01-05").withColumn("TOTALFARE", F.when(F.col("LEGID").like("%2"), 0).otherwise(F.col("TOTALFARE")))
    upsert.load_batch(spark, table, rows.withColumn("TOTALFARE", F.col("TOTALFARE").cast("decimal(10,2)")), "a", path)
    kept = spark.read.parquet(f"{path}/rows")
    found = counts(spark.read.parquet(f"{path}/summary"))
    assert found["rows", "rejected"] == kept.where("NOT kept").count() > 0
    assert found["rows", "input"] == rows.count()
    assert found["reason", "no positive total_fare"] >= rows.where("LEGID like '%2'").count()


def test_gate(spark):
    root = new_path(spark, "warehouse")
    refresh.ingest(spark, root, 40, "2025-03-01", seed=1)
    bad = spark.read.parquet(f"{root}/raw").drop("SEARCHMONTH").limit(10)
    append_bronze(bad.withColumn("SEATSREMAINING", F.lit(-1)).withColumn("LEGID", F.concat(F.lit("f"), F.substring("LEGID", 2, 15))), f"{root}/raw")
    with pytest.raises(QualityError, match="10 of 50 rows rejected; no seats_remaining: 10"):
        refresh.refresh(spark, root, "strict", most_rejected=0.1)
    assert refresh.refresh(spark, root, "lenient", most_rejected=0.5) == "lenient"
