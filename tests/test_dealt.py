"""Loads that reduce rows to one per id deal them while they are a few numbers; staged rows do not move by id after that."""

import re

from pyspark.sql import functions as F
from tarifa.operators import upsert
from tarifa.operators.staging import stage_flights
from tarifa.plans import queries
from tarifa.plans.tables import Tables
from tarifa.session import new_path
from tarifa.sources.itineraries import raw_flights

HASHED = r"Exchange hashpartitioning\((\w+)#"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def settled(spark, folder, dealt):
    return upsert.one_per_key(stage_flights(raw_flights(spark, folder, dealt=dealt)).drop("loaded_at"))


def test_dealt_rows_are_not_dealt_again(spark, folder):
    """The same rows as without dealing, and no shuffle by the id of a staged row."""
    plain, dealt = settled(spark, folder, False), settled(spark, folder, True)
    assert "leg_id" in re.findall(HASHED, plan_of(plain).replace("LEGID", "leg_id"))
    assert set(re.findall(HASHED, plan_of(dealt))) <= {"leg", "l_orderkey", "o_orderkey"}
    assert plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty()


def test_upsert_moves_ids_only(spark, folder):
    """F8: of the stored batch only the ids meet the first load, which stays where it was dealt."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(queries.QUERIES["incremental_upsert"](Tables(spark, folder)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(leg_id#") == 1 and "ReadSchema: struct<leg_id:string>" in plan


def test_batch_of_the_key_filter_moves_ids_only(spark, folder, monkeypatch):
    """ids are reduced without the rows they came with."""
    plans = []
    monkeypatch.setattr(queries, "save", lambda df, name, kept=queries.save: plans.append(plan_of(df)) or kept(df, name))
    queries.QUERIES["month_key_filter"](Tables(spark, folder))
    assert len(plans) == 1 and "Window" not in plans[0] and "segments" not in plans[0]


def test_a_load_stores_and_moves_a_fresh_row_once(spark, folder, monkeypatch):
    """fresh rows are published from where they were stored, beside the kept rows of their months, and are not laid out again."""
    laid_out = []
    write = upsert.write_months
    monkeypatch.setattr(upsert, "write_months", lambda df, path, laid_out_=False, **k: laid_out.append((df.count(), k)) or write(df, path, **k))
    raw = raw_flights(spark, folder, dealt=True)
    early = raw.where(F.col("SEARCHDATE") < F.lit("2025-01-01").cast("date"))
    path = new_path(spark, "staging")
    upsert.load_batch(spark, path, early, "one", dealt=early)
    rows = upsert.read_staging(spark, path)
    assert [k for _, k in laid_out] == [{}, {"laid_out": True}] and laid_out[0][0] == 0 and laid_out[1][0] == rows.count()
    expected = upsert.one_per_key(stage_flights(early))
    stored, expected = (df.drop("loaded_at") for df in (rows, expected))
    assert stored.exceptAll(expected.select(stored.columns)).isEmpty() and expected.select(stored.columns).exceptAll(stored).isEmpty()
