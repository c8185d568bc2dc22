"""Removal of repeated byte strings against a direct search."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarifa.llm import induced, suffixes


def expected(texts, length):
    """(bytes, removed, spans, kept) per text, by counting every window."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        hit = np.zeros(len(d) + 1, int)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                hit[i] += 1
                hit[i + length] -= 1
        gone = np.cumsum(hit[:-1]) > 0 if len(d) else np.zeros(0, bool)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, kept))
    return out


def run(spark, texts, length, gram, shard_contexts=1000):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int")
    found = suffixes.drop_repeats(df.repartition(3), length, gram, shard_contexts)
    assert set(found.columns) == {"doc_id", "text", "n_bytes", "n_removed", "spans", "kept"}
    rows = found.select("doc_id", "n_bytes", "n_removed", F.size("spans"), "kept").orderBy("doc_id").collect()
    return [(r[1], r[2], r[3], bytes(r[4])) for r in rows]


def pool(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    common, other = word(30), word(25)
    texts = [word(rng.randint(0, 60)) + rng.choice(["", common, other, common[3:20]]) + word(rng.randint(0, 40)) for _ in range(40)]
    texts += [None, "", "a" * 70, "ab" * 40, texts[0], texts[0], common + common, "é" * 30, "a" * 19, "a" * 20, "a" * 21]
    return texts


@pytest.mark.parametrize("seed, length, gram, limit", [(1, 20, 8, 1000), (2, 12, 4, 1000), (3, 20, 8, 2), (4, 21, 21, 1000), (5, 16, 1, 3)])
def test_against_direct_search(spark, monkeypatch, seed, length, gram, limit):
    """Also with shards that refuse frequent anchors, and blocks that cut texts."""
    monkeypatch.setattr(suffixes, "BLOCK", 48)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 300)
    texts = pool(seed)
    assert run(spark, texts, length, gram, limit) == expected(texts, length)


def test_whole_table(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    texts = [r["text"] for r in rows]
    assert run(spark, texts, suffixes.LENGTH, suffixes.GRAM) == expected(texts, suffixes.LENGTH)


def test_empty_table(spark):
    assert run(spark, [], 20, 8) == []


@pytest.mark.parametrize("wide", [2048, 0])
def test_suffix_arrays(monkeypatch, wide):
    monkeypatch.setattr(induced, "WIDE", wide)
    rng = random.Random(0)
    for _ in range(200):
        symbols = rng.choice([1, 2, 4, 40])
        text = np.array([rng.randint(1, symbols) for _ in range(rng.randint(0, 50))] + [0])
        order = induced.suffix_array(text, symbols + 1)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        shared = induced.common_prefixes(text, order, 1000)
        for a, b in zip(order[1:], order):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert shared[a] == n

