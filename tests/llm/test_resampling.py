"""Resampling against brute force in plain Python, and the search for the cutoff against sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from cases import TEXTS, empty, frame
from pyspark.sql import functions as F
from test_documents import lower, whole

from tarifa.llm import resampling


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def runs_of(text, least, most):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def expected(texts, target, percent, least_words, least=1, most=1, buckets=10_000):
    bucket = lambda run: zlib.crc32(run.encode()) % buckets
    source = Counter(bucket(r) for _, t in texts for r in runs_of(t, least, most))
    wanted = Counter(bucket(r) for t in target for r in runs_of(t, least, most))
    s_all, t_all = float(source.total() + buckets), float(wanted.total() + buckets)
    gain = [math.floor(1000 * math.log((wanted[b] + 1.0) * s_all / ((source[b] + 1.0) * t_all))) for b in range(buckets)]
    rows = []
    for i, text in texts:
        own = [gain[bucket(r)] for r in runs_of(text, least, most)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(words_of(text)), len(own), weight, score, None])
    able = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = place
    return sorted(map(tuple, rows), key=str)


def found(df):
    assert df.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("percent, least_words, least, most, buckets", [(10, 20, 1, 1, 10_000), (50, 1, 1, 2, 7), (100, 0, 2, 3, 100)])
def test_against_brute_force(spark, folder, percent, least_words, least, most, buckets):
    table = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    # One id in many rows, equal and unequal, around the cutoff.
    repeated = [(7, f"one two three {'four ' * (i % 3)}") for i in range(60)] + [(None, "no id " * (1 + i % 4)) for i in range(20)]
    for texts, target in ((TEXTS + repeated, ["a LINE that many", None, ""]), (whole(spark, folder), table), (TEXTS, [])):
        goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
        df = resampling.resample(frame(spark, texts), goal, percent, least_words, least, most, buckets)
        assert found(df) == expected(texts, target, percent, least_words, least, most, buckets)


def test_empty_tables_and_kept_columns(spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(empty(spark), nothing).count() == 0
    # Two rows long enough for a tenth of them to be none.
    assert resampling.resample(frame(spark, TEXTS[:12]), nothing).filter("rank is not null").count() == 0
    # ``score`` of the input gives way to the new one.
    df = resampling.resample(frame(spark), nothing, 50, 1, keep=["text", "score", "lang"])
    assert df.columns == ["doc_id", "text", "lang", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str) == sorted(TEXTS, key=str)


@pytest.mark.parametrize("halvings", [1, 4])
def test_cutoff(spark, halvings):
    rng = random.Random(5)
    for spread in (0, 3, 1 << 62):
        values = [rng.randint(-spread, spread) for _ in range(300)]
        rows = spark.createDataFrame([(v,) for v in values], "v long")
        for wanted in (1, 2, 150, 300):
            at, above = resampling.cutoff(rows, F.col("v"), wanted, min(values), max(values), halvings)
            assert at == sorted(values, reverse=True)[wanted - 1] and above == sum(v > at for v in values)


def test_features_in_parts():
    text = ("Der Text, und noch 1 Wort äöü " * 5).encode()
    for least, most in ((1, 1), (1, 3), (2, 2), (3, 4)):
        for chunk in (1, 5, 17, 1000):
            parts = list(resampling.features(text, least, most, chunk))
            assert sum(n for n, _ in parts) == len(words_of(text.decode()))
            joined = Counter(c for _, own in parts for c in own.tolist())
            assert joined == Counter(zlib.crc32(r.encode()) for r in runs_of(text.decode(), least, most))
