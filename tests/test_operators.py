"""Properties of the table operators on small frames and on the derived itineraries."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarifa.fixed_values import ENCODED_FEATURES, FEATURES, GENERATED_AIRPORTS
from tarifa.functions.fare_codes import scoring_features
from tarifa.operators import cleaning, encoding, metrics, pricing, quality, quantiles, sampling, training, upsert
from tarifa.operators.staging import stage_flights
from tarifa.plans import refresh
from tarifa.plans.tables import Tables
from tarifa.session import new_path, path_exists, save
from tarifa.sources import generator, seeds, tables
from tarifa.sources.itineraries import raw_flights
from tarifa.sources.requests import read_requests
from tarifa.streaming.loads import stream_into_staging


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def raw(spark, folder):
    return save(raw_flights(spark, folder), "raw")


@pytest.fixture(scope="module")
def derived(spark, folder):
    return Tables(spark, folder)


@pytest.mark.parametrize("kind", ["spread", "repeated", "outlier", "one"])
def test_quantiles_equal_numpy(spark, kind):
    draw = random.Random(5)
    values = {
        "spread": [draw.uniform(-50, 50) for _ in range(997)],
        "repeated": [float(draw.choice([1, 1, 1, 2, 7])) for _ in range(500)],
        "outlier": [float(i % 40) for i in range(400)] + [1e12],
        "one": [4.0],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    assert quantiles.quantiles(df, "x", shares) == pytest.approx(np.quantile(values, shares).tolist())
    # Nearest: half-way positions go up.
    ranks = [int(np.floor(s * (len(values) - 1) + 0.5)) for s in shares]
    assert quantiles.quantiles(df, "x", shares, "nearest") == [sorted(values)[r] for r in ranks]


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert quantiles.quantiles(empty, "x", [0.5]) == [None]
    assert cleaning.trim_above(empty, "x").count() == 0


def test_approximate_quantiles(spark):
    df = spark.range(1001).withColumn("x", F.col("id") * 1.0)
    assert quantiles.approximate_quantiles(df, "x", [0.25, 0.75]) == pytest.approx([250, 750], abs=2)


def test_codes_are_ranks_and_can_be_undone(spark):
    words = ["b", "a", "ab", "abc", "", None, "é", "z", "aa", "B", "None!"]
    df = spark.createDataFrame([(w, "x") for w in words], "word string, other string")
    codes = save(encoding.fit_codes(df, ["word", "other"]), "codes")
    texts = sorted("None" if w is None else w for w in words)
    found = {r["value"]: r["code"] for r in codes.where("feature = 'word'").collect()}
    assert found == {text: i for i, text in enumerate(texts)}
    coded = encoding.encode(df, codes, ["word"])
    back = encoding.decode(coded, codes, ["word"])
    assert sorted(r["word"] for r in back.collect()) == texts
    unseen = spark.createDataFrame([("new",)], "word string")
    assert encoding.encode(unseen, codes, ["word"]).first()["word"] == 0


def test_upsert_twice_is_upsert_once(spark, raw):
    staged = stage_flights(raw).drop("loaded_at")
    cut = F.lit("2025-01-01").cast("date")
    target = save(upsert.one_per_key(staged.where(F.col("search_date") < cut)), "target")
    batch = save(upsert.one_per_key(staged.withColumn("total_fare", F.col("total_fare") + 1)), "batch")
    once = save(upsert.upsert(target, batch), "once")
    assert rows_of(upsert.upsert(once, batch)) == rows_of(once)
    assert once.count() == once.select("leg_id").distinct().count()


def test_one_per_key_prefers_the_newest(spark):
    day = dt.date(2024, 1, 1)
    rows = [("a", day, 1), ("a", day + dt.timedelta(1), 9), ("a", day + dt.timedelta(1), 5), ("b", day, None)]
    df = spark.createDataFrame(rows, "leg_id string, search_date date, n int")
    assert rows_of(upsert.one_per_key(df)) == [("a", day + dt.timedelta(1), 5), ("b", day, None)]


def test_one_hot_key_is_cut_before_the_shuffle(spark, raw):
    plan = upsert.one_per_key(stage_flights(raw))._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_empty_target_lets_all_rows_in(spark, raw):
    empty = stage_flights(raw).limit(0)
    assert upsert.since_mark(raw, upsert.newest_date(empty)).count() == raw.count()


def as_map(spark, path):
    return {r["leg_id"]: (r["search_date"], r["total_fare"]) for r in upsert.read_staging(spark, path).collect()}


def test_load_moves_rows_between_months_and_repeats_safely(spark, raw):
    table = new_path(spark, "staging")
    first = raw.where("LEGID like '1%'").withColumn("SEARCHDATE", F.lit("2024-01-15").cast("date"))
    first = first.withColumn("FLIGHTDATE", F.lit("2024-05-01").cast("date"))
    upsert.load_batch(spark, table, first, "one")
    before = as_map(spark, table)
    assert before
    # The whole month is quoted again in the next one: its folder must end up empty.
    later = first.withColumn("SEARCHDATE", F.lit("2024-02-01").cast("date"))
    upsert.load_batch(spark, table, later, "two")
    after = as_map(spark, table)
    assert after.keys() == before.keys()
    assert {day for day, _ in after.values()} == {dt.date(2024, 2, 1)}
    for _ in range(2):
        upsert.load_batch(spark, table, later, "two")
        upsert.load_batch(spark, table, later, "three")
    assert as_map(spark, table) == after
    # Older rows are ignored.
    upsert.load_batch(spark, table, first, "four")
    assert as_map(spark, table) == after


def load(raw, prefix, day):
    """Raw rows whose id starts with ``prefix``, searched on ``day``."""
    rows = raw.where(F.col("LEGID").startswith(prefix)).withColumn("SEARCHDATE", F.lit(day).cast("date"))
    return rows.withColumn("FLIGHTDATE", F.lit("2024-05-01").cast("date"))


def prefixes(found):
    return {key[0] for key in found}


@pytest.mark.parametrize("failing", ["_publish", "_store_merged"])
def test_interrupted_load_is_repeated(spark, raw, monkeypatch, failing):
    """A load that fails while merging or publishing loses nothing, under its own id and under the next."""
    for retry in ("two", "three"):
        table = new_path(spark, "staging")
        upsert.load_batch(spark, table, load(raw, "2", "2024-01-15"), "one")
        before = as_map(spark, table)
        with monkeypatch.context() as patched:
            patched.setattr(upsert, failing, lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                upsert.load_batch(spark, table, load(raw, "3", "2024-03-01"), "two")
        later = load(raw, "3", "2024-03-01") if retry == "two" else load(raw, "4", "2024-03-02")
        upsert.load_batch(spark, table, later, retry)
        after = as_map(spark, table)
        assert before.items() <= after.items()
        lost = failing == "_store_merged" and retry == "three"
        assert prefixes(after) == {"2", "3" if retry == "two" else "4"} | (set() if lost else {"3"})


def test_reused_ids_cannot_revert_later_loads(spark, raw):
    table = new_path(spark, "staging")
    for prefix, day, name in (("1", "2024-01-01", "a"), ("2", "2024-02-01", "b"), ("3", "2024-02-02", "c")):
        upsert.load_batch(spark, table, load(raw, prefix, day), name)
    before = as_map(spark, table)
    upsert.load_batch(spark, table, load(raw, "2", "2024-02-01"), "b")
    assert as_map(spark, table) == before
    with pytest.raises(ValueError, match="other input"):
        upsert.load_batch(spark, table, load(raw, "4", "2024-02-03"), "b")
    assert as_map(spark, table) == before


def test_tables_without_success_markers_keep_their_rows(spark, raw):
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        table = new_path(spark, "staging")
        upsert.load_batch(spark, table, load(raw, "1", "2024-01-01"), "a")
        upsert.load_batch(spark, table, load(raw, "2", "2024-01-02"), "b")
        assert prefixes(as_map(spark, table)) == {"1", "2"}
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_stored_batches_are_removed(spark, raw):
    table = new_path(spark, "staging")
    upsert.load_batch(spark, table, load(raw, "1", "2024-01-01"), "a")
    ledger = upsert.Ledger(spark, table)
    assert [r["state"] for r in ledger.rows] == ["merged", "published"]
    assert not path_exists(spark, ledger.rows[0]["stored"])


def test_new_checkpoint_starts_new_loads(spark, raw):
    """Three arrivals, then a checkpoint that numbers its batches from 0 again."""
    landing, other, table = (new_path(spark, n) for n in ("landing", "landing", "staging"))
    checkpoints = [new_path(spark, "checkpoint") for _ in range(2)]
    days = (("1", "2024-01-01"), ("2", "2024-01-02"), ("3", "2024-02-01"))
    for prefix, day in days:
        load(raw, prefix, day).write.mode("append").parquet(landing)
        stream_into_staging(spark, landing, table, checkpoints[0]).awaitTermination()
    before = as_map(spark, table)
    load(raw, "4", "2024-02-02").write.parquet(other)
    stream_into_staging(spark, other, table, checkpoints[1]).awaitTermination()
    after = as_map(spark, table)
    assert before.items() <= after.items() and prefixes(after) == {"1", "2", "3", "4"}


def test_daily_load_reads_new_days_only(spark, raw):
    path = new_path(spark, "raw")
    for day in ("2024-01-01", "2024-02-02", "2024-02-03"):
        tables.append_bronze(load(raw, "1", day), path)
    arrived = upsert.since_mark(tables.read_bronze(spark, path), dt.date(2024, 2, 3))
    assert arrived.schema.names == raw.schema.names
    plan = arrived._jdf.queryExecution().executedPlan().toString()
    assert "SEARCHMONTH" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(SEARCHDATE,2024-02-03)" in plan
    assert arrived.select("SEARCHDATE").distinct().collect() == [(dt.date(2024, 2, 3),)]
    files = new_path(spark, "raw")
    raw.write.parquet(files)
    plan = upsert.since_mark(spark.read.parquet(files), dt.date(2024, 1, 3))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(SEARCHDATE,2024-01-03)" in plan


def test_generated_rows_keep_their_ranges(spark):
    batch = generator.generate_batch(spark, 2000, "2025-03-01", seed=9)
    assert rows_of(batch) == rows_of(generator.generate_batch(spark, 2000, "2025-03-01", seed=9))
    other = generator.generate_batch(spark, 2000, "2025-03-01")
    assert batch.join(other, "LEGID", "left_semi").count() == 0
    rows = batch.collect()
    assert len({r.LEGID for r in rows}) == 2000
    for r in rows:
        ends = [r.STARTINGAIRPORT, r.DESTINATIONAIRPORT]
        stops = r.SEGMENTSDEPARTUREAIRPORTCODE.split("||")
        assert len(set(ends + stops)) == len(stops) + 1 and set(ends + stops) <= set(GENERATED_AIRPORTS)
        assert 1 <= (r.FLIGHTDATE - r.SEARCHDATE).days <= 90 and 1 <= r.SEATSREMAINING <= 150
        assert 50 <= r.BASEFARE <= 800 and 1.09 <= r.TOTALFARE / r.BASEFARE <= 1.21
        assert (len(stops) == 1) == r.ISNONSTOP
        departures = [int(t) for t in r.SEGMENTSDEPARTURETIMEEPOCHSECONDS.split("||")]
        arrivals = [int(t) for t in r.SEGMENTSARRIVALTIMEEPOCHSECONDS.split("||")]
        if not r.ISNONSTOP:
            assert 2700 <= departures[1] - arrivals[0] <= 7200
        assert sum(map(int, r.SEGMENTSDISTANCE.split("||"))) == r.TOTALTRAVELDISTANCE
    share = sum(r.ISNONSTOP for r in rows) / len(rows)
    assert 0.55 < share < 0.65
    assert {len(set(x)) for x in [[r.STARTINGAIRPORT for r in rows]]} == {16}


def test_samples_and_splits(spark):
    df = spark.range(20000).select(F.col("id").alias("key"))
    part = sampling.sample_rows(df, 0.3)
    assert 0.28 < part.count() / 20000 < 0.32
    assert rows_of(part) == rows_of(sampling.sample_rows(df.repartition(3), 0.3))
    train, test = sampling.split_train_test(df, test_share=0.1)
    assert train.count() + test.count() == 20000 and 0.08 < test.count() / 20000 < 0.12
    assert train.join(test, "key", "left_semi").count() == 0


def test_split_of_a_sample_keeps_its_share(spark):
    df = spark.range(40000).select(F.col("id").alias("key"))
    marked = sampling.mark_test_rows(sampling.sample_rows(df, 0.3), 0.1)
    assert 0.09 < marked.where("is_test").count() / marked.count() < 0.11


def test_null_hour_leaves_the_night_to_the_fare_code(spark, tmp_path):
    """A request that names no hour gets the default; a null hour stays."""
    base = {"searchDate": "2025-03-01", "flightDate": "2025-03-20", "startingAirport": "JFK", "destinationAirport": "LAX"}
    lines = [{**base, "request_id": "absent"}, {**base, "request_id": "null", "departureHour": None}, {**base, "request_id": "late", "departureHour": 23}]
    path = tmp_path / "requests.json"
    path.write_text("\n".join(json.dumps({**line, "fareBasisCode": "YN"}) for line in lines))
    filled = pricing.with_defaults(read_requests(spark, str(path)))
    found = {r["request_id"]: r["departureHour"] for r in filled.collect()}
    assert found == {"absent": 10, "null": None, "late": 23}
    valid = filled.where(pricing.is_valid_request())
    night = scoring_features(F.col("fareBasisCode"), F.col("departureHour"), F.col("flightDate"))["is_night_fare_proxy"]
    found = {r[0]: r[1] for r in valid.select("request_id", night).collect()}
    assert found == {"absent": 0, "null": 1, "late": 1}


def test_malformed_csv_stops_the_conversion(spark, tmp_path):
    schema = "a int, b string"
    path, out = tmp_path / "in.csv", new_path(spark, "parquet")
    path.write_text('a,b\n1,"two\nlines"\n2,x\n')
    assert tables.csv_to_parquet(spark, str(path), out, schema) == 2
    assert rows_of(spark.read.parquet(out)) == [(1, "two\nlines"), (2, "x")]
    path.write_text("a,b\n1,x\nno number,y\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.csv_to_parquet(spark, str(path), new_path(spark, "parquet"), schema)


def test_equal_rows_are_sampled_one_by_one(spark):
    df = spark.range(10000).select(F.lit("same").alias("a"), F.lit(None).cast("int").alias("b"))
    part = sampling.sample_rows(df, 0.3)
    assert 0.28 < part.count() / 10000 < 0.32 and part.columns == df.columns


def test_long_value_lists_are_numbered_in_several_ranges(spark):
    """Also where all values share their first characters and none repeats."""
    df = spark.range(20000).select(F.format_string("KLM-%06d", F.col("id")).alias("word"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        codes = encoding.fit_codes(df, ["word"])
        assert codes.where(F.col("value") != F.format_string("KLM-%06d", F.col("code"))).count() == 0
        assert codes.count() == 20000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


def test_metrics_equal_numpy(spark):
    draw = np.random.default_rng(1)
    y, p = draw.normal(300, 80, 500), draw.normal(300, 80, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "total_fare double, prediction double")
    row = metrics.regression_metrics(df).first()
    assert row.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-6)
    assert row.mae == pytest.approx(np.abs(y - p).mean(), abs=1e-6)
    assert row.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()), abs=1e-6)
    constant = spark.createDataFrame([(1.0, 2.0)], "total_fare double, prediction double")
    assert metrics.regression_metrics(constant).first().r2 is None


def test_prices_stay_in_bounds(derived):
    priced = pricing.price_requests(derived.valid_requests).where("final_price is not null")
    outside = priced.where(
        ~F.col("final_price").between(
            F.floor(F.col("ml_prediction") * 0.7), F.ceil(F.col("ml_prediction") * 1.5)
        )
        | ~F.col("demand").between(-0.2, 0.5)
        | ~F.col("inventory").between(-0.25, 0.5)
        | ~F.col("competition").between(-0.2, 0.1)
        | ~F.col("time").between(-0.1, 0.5)
    )
    assert priced.count() > 0 and outside.count() == 0


def test_feature_order_is_complete(derived):
    featured = pricing.request_features(derived.valid_requests)
    vectors = featured.select(encoding.feature_columns())
    assert vectors.columns == FEATURES and len(FEATURES) == 23
    assert set(dict(vectors.dtypes).values()) == {"double"}
    assert set(ENCODED_FEATURES) <= set(FEATURES)


def test_stored_model_predicts_the_same(spark, derived):
    encoded, codes = derived.prepared
    model = training.fit(encoded, training.boosted_trees(trees=2, depth=3))
    path = new_path(spark, "model")
    training.save_model(model, codes, path)
    loaded, loaded_codes = training.load_model(spark, path)
    assert rows_of(loaded_codes) == rows_of(codes)
    assert rows_of(training.score(loaded, encoded)) == rows_of(training.score(model, encoded))


def test_schema_sync(spark):
    old = spark.createDataFrame([(1, "x")], "id int, gone string")
    new = spark.createDataFrame([(2, 5)], "id int, added int")
    assert tables.sync_schema(old, new).columns == ["id", "added"]
    assert rows_of(tables.sync_schema(old, new)) == [(1, None), (2, 5)]


def test_csv_conversion_counts_records(spark):
    path, out = new_path(spark, "csv"), new_path(spark, "parquet")
    df = spark.createDataFrame([("a, b", "line\nbreak"), ('"q"', None), (" x ", "y")], "u string, v string")
    tables.write_csv(df, path)
    assert tables.csv_to_parquet(spark, path, out, df.schema, multi_line=True) == 3
    assert rows_of(spark.read.parquet(out)) == rows_of(df)


def test_empty_append_adds_no_rows(spark):
    empty = generator.generate_batch(spark, 5).limit(0)
    assert tables.append_bronze(empty, new_path(spark, "raw")) == 0


def test_seeds(spark):
    assert seeds.airports(spark).count() == 22 and seeds.holidays(spark).count() == 27
    path = new_path(spark, "seed")
    tables.write_csv(seeds.airports(spark), path)
    assert rows_of(seeds.airports(spark, path)) == rows_of(seeds.airports(spark))


def test_checks_find_and_stop(spark):
    airlines = spark.createDataFrame([("AA", "x"), ("AA", None), (None, "y")], "airline_code string, airline_name string")
    ml = spark.createDataFrame(
        [(1.0, 2, "Boston", 0), (1.0, 2, "Boston", 2), (1.0, 2, "Boston", 2)],
        "total_fare double, days_until_flight int, origin_city string, is_holiday int",
    )
    report = quality.check_tables({"airlines": airlines, "ml_features": ml})
    failed = {tuple(r)[:3]: r["failures"] for r in report.where("failures > 0").collect()}
    assert failed == {
        ("airlines", "airline_code", "not_null"): 1,
        ("airlines", "airline_name", "not_null"): 1,
        ("airlines", "airline_code", "unique"): 1,
        ("ml_features", "is_holiday", "accepted_values"): 1,
    }
    with pytest.raises(quality.QualityError):
        quality.enforce(report)
    quality.enforce(report, allow=failed)


def test_clustered_files_split_a_hot_key(spark):
    hot = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").cast("string").alias("row"))
    path = new_path(spark, "hot")
    tables.write_clustered(hot, path, ["k"], spread=["row"], partitions=4)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 4 and max(f["count"] for f in files) < 2000


def test_daily_run(spark):
    root = new_path(spark, "warehouse")
    assert refresh.ingest(spark, root, 400, "2025-03-01", seed=1) == 400
    first = refresh.refresh(spark, root, "day1")
    assert refresh.read_gold(spark, root, "flight_prices").count() == 400
    refresh.ingest(spark, root, 300, "2025-03-02", seed=2)
    assert (first, refresh.refresh(spark, root, "day2")) == ("day1", "day2")
    assert refresh.read_gold(spark, root, "flight_prices").count() == 700
    assert refresh.read_gold(spark, root, "ml_features").count() == 700
    model = f"{root}/model"
    refresh.train(spark, root, model, sample=1.0, trees=2, depth=3)
    requests = spark.createDataFrame(
        [("a", "2025-03-01", "2025-03-20", "JFK", "LAX", 10), ("b", "soon", "2025-03-20", "JFK", "LAX", 10)],
        "request_id string, searchDate string, flightDate string, startingAirport string, "
        "destinationAirport string, seatsRemaining int",
    )
    from tarifa import schemas

    missing = {f.name: F.lit(None).cast(f.dataType) for f in schemas.REQUEST if f.name not in requests.columns}
    answers = {r["request_id"]: r for r in refresh.price(spark, requests.withColumns(missing), model, ["request_id"]).collect()}
    assert answers["a"]["success"] and answers["a"]["dynamic_price"] > 0
    assert answers["b"]["error"] == "Invalid input: searchDate"


def test_failed_checks_are_not_published(spark, monkeypatch):
    root = new_path(spark, "warehouse")
    refresh.ingest(spark, root, 50, "2025-03-01")
    refresh.refresh(spark, root, "good")
    monkeypatch.setattr(quality, "ACCEPTED", {"ml_features": {"is_holiday": [7]}})
    refresh.ingest(spark, root, 50, "2025-03-02", seed=3)
    with pytest.raises(quality.QualityError):
        refresh.refresh(spark, root, "bad")
    assert refresh.read_gold(spark, root, "flight_prices").count() == 50
