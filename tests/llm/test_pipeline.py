"""The pipeline, stage by stage against brute force, and the contract of its module."""

from cases import TEXTS, empty, frame
from test_copies import first_kept, groups_expected
from test_documents import contamination_expected, ordered, packed_ids

import __spark_entry__ as contract
import corpus_pipeline as pipeline


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def check_stages(spark, docs, folder):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    stages = dict(pipeline.STAGES)
    known = stages["language"](spark, docs, folder)
    lettered = [p for p in pairs(docs) if any(c.isalpha() for c in p[1] or "")]
    kept = pairs(known)
    assert known.columns == docs.columns and set(kept) <= set(lettered) and len(kept) >= 0.8 * len(lettered)

    shorter = stages["lines"](spark, known, folder)
    assert shorter.columns == docs.columns
    assert ordered(pairs(shorter)) == first_kept(kept, 10)
    assert all(r["n_chars"] == len(r["text"]) for r in shorter.collect())

    single = stages["near_copies"](spark, shorter, folder)
    wanted, _ = groups_expected(pairs(shorter))
    assert single.columns == docs.columns
    assert sorted((i is None, i or 0) for i, _ in pairs(single)) == wanted

    clean = stages["benchmark"](spark, single, folder)
    wanted = [i for i, _, hit, _ in contamination_expected(pairs(single), bench, 10) if not hit]
    assert clean.columns == docs.columns and ordered(i for i, _ in pairs(clean)) == ordered(wanted)

    found, wanted = packed_ids(spark, clean)
    assert found == wanted
    pieces = stages["packing"](spark, clean, folder)
    assert {p["doc_id"] for p in pieces.collect()} == {i for i, _ in pairs(clean)}


def test_stages(spark, folder):
    check_stages(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)


def test_hard_cases(spark, folder):
    short = [t if len(t[1] or "") < 50_000 else (t[0], t[1][:600]) for t in TEXTS]
    check_stages(spark, frame(spark, short), folder)


def test_empty_table(spark, folder):
    docs = empty(spark)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_run(spark, folder):
    found = pipeline.run(spark, folder)
    ends = found.groupBy("sequence_id").sum("length").collect()
    sizes = sorted(r[1] for r in ends)
    assert all(s == 4096 for s in sizes[1:]) and 0 < sizes[0] <= 4096
    assert [n for n, _ in pipeline.STAGES] == ["language", "lines", "near_copies", "benchmark", "packing"]


def test_registered():
    names = contract.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(contract.oracle_sql()) <= set(names)


def test_oracles(spark, folder):
    from check import compare, open_tables

    with open_tables(folder) as connection:
        for name in ("op7_line_dedup", "op8_benchmark_decontamination"):
            assert compare(spark, connection, folder, name).startswith("ok")
