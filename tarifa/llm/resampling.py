"""Importance resampling towards a target distribution.

Hashed features of all documents and of the target give one gain per bucket, an array of fixed length that every task holds. Adding it
up over a document's features gives its weight, and a draw from the Gumbel distribution, made of its id, turns taking the highest
scores into sampling without replacement. Scores are stored once. The cutoff is found by halving the range of the scores with counts
over the stored rows, and among rows of the cutoff score by halving the range of their ids; the rows above it alone are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tarifa.llm.decontaminate import _WORD_BYTES
from tarifa.llm.text import ROW, map_texts, only, texts, with_columns
from tarifa.session import save

BUCKETS = 10_000
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
# Text whose words are Python objects at once; a longer word is held whole.
CHUNK = 1 << 20
# Halvings that one job decides, by counting at all thresholds they may ask for.
HALVINGS = 4


def features(text: bytes, least: int = 1, most: int = 1, chunk: int = CHUNK) -> Iterator[tuple[int, np.ndarray]]:
    """In parts: how many words begin there, and the CRC-32 of all runs of ``least`` to ``most`` words that end there."""
    text = text.translate(_WORD_BYTES)
    at, before = 0, []
    while at < len(text):
        end = text.find(b" ", at + chunk)
        end = len(text) if end < 0 else end
        fresh = text[at:end].split()
        words = [*before, *fresh]
        crcs, found = list(map(zlib.crc32, words)), []
        for size in range(1, most + 1):
            if size > 1:
                crcs = [zlib.crc32(word, zlib.crc32(b" ", crc)) for crc, word in zip(crcs, words[size - 1 :])]
            if size >= least:
                # Runs that end before this part were counted with the last one.
                found += crcs[max(0, len(before) - size + 1) :]
        yield len(fresh), np.array(found, np.int64)
        at, before = end, words[max(0, len(words) - most + 1) :]


def bucket_counts(docs: DataFrame, buckets: int, least: int, most: int) -> np.ndarray:
    """The features in each bucket over all of ``docs``; at most ``buckets`` rows reach the driver."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(buckets, np.int64)
        for text in texts(batch):
            for _, crcs in features(text, least, most):
                total += np.bincount(crcs % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])

    counted = map_texts(only(docs, "text"), each, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[counted["bucket"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of a bucket's share in the target and in the source, both smoothed by one, rounded down."""
    size = len(source)
    s_all, t_all = float(source.sum() + size), float(target.sum() + size)
    ratios = [(t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, least: int, most: int) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``n_features`` and ``weight``, the mean gain of the features, rounded down."""
    known = docs.sparkSession.sparkContext.broadcast(gain)
    schema = with_columns(docs, n_words=LongType(), n_features=LongType(), weight=LongType())
    plain = [n for n in schema.names if n not in ("n_words", "n_features", "weight")]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in texts(batch):
            n_words = n = total = 0
            for fresh, crcs in features(text, least, most):
                n_words += fresh
                n += len(crcs)
                total += int(known.value[crcs % len(known.value)].sum())
            rows.append((n_words, n, total // n if n else 0))
        columns = [pa.array(c, pa.int64()) for c in (list(zip(*rows)) or [(), (), ()])]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in plain), *columns], schema.names)

    return map_texts(docs, each, schema)


def cutoff(rows: DataFrame, value: Column, wanted: int, low: int, high: int, halvings: int = HALVINGS) -> tuple[int, int]:
    """The largest integer that at least ``wanted`` rows reach, and how many exceed it.

    ``value`` lies between ``low`` and ``high``, and all rows together are enough. One job counts exactly at every threshold that the
    next ``halvings`` steps may ask for; rows outside the range still in question are not counted again.
    """
    above, high = 0, high + 1
    while high - low > 1:
        steps = min(1 << halvings, high - low)
        asked = [low + (high - low) * i // steps for i in range(1, steps)]
        inside = rows.filter((value >= F.lit(low)) & (value < F.lit(high)))
        counts = inside.agg(*[F.count_if(value >= F.lit(t)).alias(f"n{i}") for i, t in enumerate(asked)]).first()
        reached = [t for t, n in zip(asked, counts) if above + n >= wanted]
        missed = [(t, n) for t, n in zip(asked, counts) if above + n < wanted]
        low = reached[-1] if reached else low
        if missed:
            high, above = missed[0][0], above + missed[0][1]
    return low, above


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    least: int = 1,
    most: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the columns in ``keep``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``.

    Features are all runs of ``least`` to ``most`` words. Of the rows with at least ``least_words`` words ``percent`` in a hundred
    (rounded down) are drawn, those with the highest scores; ties go to the smaller ``doc_id``. ``rank`` numbers them from 1 and is
    null elsewhere. ``doc_id`` is an integer; without one a row draws as if its id were the empty text and loses every tie. Rows of
    one id have the same draw; among their ties fewer features come first, and rows that agree in that as well differ in nothing
    that is returned but columns of ``keep``. Null and empty texts have no features and weight 0. An empty target leaves the smoothed
    share of the source alone; an empty table gives an empty result. New columns replace kept ones of the same name.
    """
    gain = gains(bucket_counts(docs, buckets, least, most), bucket_counts(target, buckets, least, most))
    new = ("n_words", "n_features", "weight", "score", "rank", ROW)
    kept = ["doc_id", *[c for c in keep if c not in new and c != "doc_id"]]
    # ``text`` is the operator's input and may be kept as well.
    rows = weighed(docs.select(*kept, *["text"] * ("text" not in kept)).withColumn("text", F.col("text").cast("string")), gain, least, most)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))
    columns = [*kept, "n_words", "n_features", "weight"]
    scored = rows.select(*columns, (F.col("weight") + noise).alias("score")).withColumn(ROW, F.monotonically_increasing_id())
    stored = save(scored, "scores")

    can = stored.filter(F.col("n_words") >= least_words)
    n, low, high = can.agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    wanted = percent * n // 100
    if not wanted:
        return stored.select(*columns, "score", F.lit(None).cast("long").alias("rank"))
    score, above = cutoff(can, F.col("score"), wanted, low, high)
    tied = can.filter(F.col("score") == score)
    # Descending, and without the overflow of a sign change.
    falling = F.bitwise_not(F.col("doc_id").cast("long"))
    known, low, high = tied.agg(F.count("doc_id"), F.min(falling), F.max(falling)).first()
    if known >= wanted - above:
        last, _ = cutoff(tied.filter("doc_id is not null"), falling, wanted - above, low, high)
        within = falling >= F.lit(last)
    else:
        within = F.lit(True)
    chosen = (F.col("n_words") >= least_words) & ((F.col("score") > score) | ((F.col("score") == score) & within))
    chosen = F.coalesce(chosen, F.lit(False))
    ranked = _ranked(stored.filter(chosen))
    # Rows that agree in score and id may exceed the number by a few.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = stored.filter(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns, "score", "rank").unionByName(rest.select(*columns, "score", "rank"))


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` numbered by falling score, then id: sorted in ranges, which are numbered after one another.

    The row number ends the key, so rows of one score and id may lie in several ranges.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc(ROW)]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = save(ordered.withColumn("_at", F.monotonically_increasing_id()), "drawn")
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base"))
    # One row per range, so small whatever the documents hold.
    numbered = placed.withColumn("_part", part).join(F.broadcast(bases), "_part")
    return numbered.withColumn("rank", F.col("_base") + at + 1)
