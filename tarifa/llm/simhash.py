"""SimHash near-dedup with covering locality-sensitive hashing.

Every bit position gets a non-zero vector of ``radius + 1`` bits, in turn. Each non-zero vector v of that length gives one table: its mask
holds the positions whose vector has an odd number of bits in common with v. If two fingerprints differ in at most ``radius``
positions, some v is orthogonal to the vectors of all of them, so the pair agrees on every bit of that table's mask and meets
in its bucket: no pair within the radius is lost.

Buckets hold distinct fingerprints only. A bucket with more than ``BUCKET`` of them is not compared pairwise: its fingerprints are
dealt again by covering masks over the bits that are still free, which loses no pair either.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tarifa.llm.graph import components
from tarifa.llm.text import ROW, ascii_words, map_texts, only, texts
from tarifa.session import new_path, save

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
BITS = 64
# Distinct fingerprints that one bucket compares pairwise.
BUCKET = 64
# Shingle hashes whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(words: list[bytes], size: int = SHINGLE_WORDS) -> int:
    """The SimHash of word shingles, repeats included, as an unsigned number; 0 without words."""
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(size))) if len(words) >= size else [words]
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    count = max(1, len(words) - size + 1)
    return majority(np.fromiter(map(digest, map(b" ".join, shingles)), np.uint64, count))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of some 64-bit hashes, as an unsigned number; 0 without hashes."""
    rows, ones = hashes.astype(">u8").view(np.uint8).reshape(-1, 8), np.zeros(BITS, np.int64)
    for start in range(0, len(rows), CHUNK):
        ones += np.unpackbits(rows[start : start + CHUNK], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number, per row."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(ascii_words(t), size) for t in texts(batch)], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return map_texts(only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast(LongType())), each, "doc_id long, fp long")


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions such that any ``radius`` of the positions miss some mask."""
    # The unit vectors come first, so that more than ``radius`` positions give no empty mask.
    vectors = sorted(range(1, 2 ** (radius + 1)), key=lambda v: (v.bit_count() > 1, v))
    dealt = [(p, vectors[i % len(vectors)]) for i, p in enumerate(positions)]
    return [sum(1 << p for p, own in dealt if (own & v).bit_count() % 2) for v in sorted(vectors)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _deal(fps: DataFrame, radius: int, depth: int) -> DataFrame:
    """Rows (``mask``, ``fp``) dealt by the masks of one more level; ``mask`` holds the positions fixed so far."""
    parents = [0]
    for level in range(depth + 1):
        free = {taken: [p for p in range(BITS) if not taken >> p & 1] for taken in parents}
        pairs = sorted({(taken, taken | mask) for taken in parents for mask in covering_masks(free[taken], radius)})
        parents = sorted({child for _, child in pairs})
    if depth == 0:
        first = F.array(*[F.lit(_signed(child)) for _, child in pairs])
        dealt = fps.select(F.explode(first).alias("mask"), "fp")
    else:
        masks = fps.sparkSession.createDataFrame([(_signed(a), _signed(b)) for a, b in pairs], "mask long, child long")
        # A few hundred rows at the deepest level, whatever the data.
        dealt = fps.join(F.broadcast(masks), "mask").select(F.col("child").alias("mask"), "fp")
    return dealt.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).distinct()


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``a`` < ``b`` of fingerprints that differ in at most ``radius`` bits: all of them, each once.

    ``fps`` has one column ``fp`` without repeats. A bucket of more than ``bucket`` fingerprints is dealt again by masks over its
    free bits until so few bits are free that no bucket can be larger.
    """
    spark = fps.sparkSession
    found = spark.createDataFrame([], "a long, b long")
    left, depth = fps.withColumn("mask", F.lit(0).cast("long")), 0
    while True:
        dealt = _deal(left, radius, depth)
        sizes = dealt.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = save(dealt.join(sizes, ["mask", "key"]), "buckets")
        # With one free bit more than the radius, a bucket holds few fingerprints at most and cannot be dealt further.
        small = (F.col("n") <= bucket) | (F.lit(BITS) - F.bit_count("mask") <= radius + 1)
        a = shared.filter(small).select("mask", "key", F.col("fp").alias("a"))
        b = a.withColumnRenamed("a", "b")
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
        pairs = a.join(b, ["mask", "key"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")
        found = found.unionByName(pairs)
        left, depth = shared.filter(~small).select("mask", "fp"), depth + 1
        if left.isEmpty():
            return found.distinct()


def similar(
    docs: DataFrame,
    size: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    bucket: int = BUCKET,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fingerprint`` (16 lowercase hex digits) and ``component_id``.

    Fingerprints that differ in at most ``radius`` bits are linked; ``component_id`` is the smallest ``doc_id`` that links reach, the
    row's own included. Null, empty and wordless texts have fingerprint zero, which links like any other. Texts of fewer than
    ``size`` words are one shingle. A null ``doc_id`` is a row like any other, but never a component's name unless all its rows
    lack an id. Repeated rows share a component. Other columns are not read. An empty table gives an empty result.
    """
    stored = save(fingerprints(docs, size), "fingerprints")
    return named(stored, radius, bucket).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def named(stored: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Rows of a stored fingerprint table with their ``component_id``."""
    least = save(stored.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    labels = components(links(least.select("fp"), radius, bucket))
    grouped = least.join(labels, least["fp"] == labels["node"], "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    names = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    return stored.join(grouped.join(names, "label").select("fp", "component_id"), "fp")


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest ``doc_id``, the first such row if it is repeated.

    Rows without an id come last. Columns and their order stay, whatever their names.
    """
    spark = docs.sparkSession
    path = new_path(spark, "numbered")
    names = [f"c{i}" for i in range(len(docs.columns))]
    docs.toDF(*names).withColumn(ROW, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    text, doc_id = (names[docs.columns.index(c)] for c in ("text", "doc_id"))
    # Rows stand in for ids: the component is named by its first row in the order of ids.
    prints = fingerprints(rows.select(F.col(ROW).alias("doc_id"), F.col(text).alias("text")), size)
    stored = save(prints, "fingerprints")
    found = named(stored, radius, bucket).select(F.col("doc_id").alias(ROW), "component_id")
    ranked = found.join(rows.select(ROW, F.col(doc_id).alias("id")), ROW)
    first = ranked.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", ROW)).alias("first")
    )
    return rows.join(first.select(F.col(f"first.{ROW}").alias(ROW)), ROW, "left_semi").select(
        *[F.col(n).alias(c) for n, c in zip(names, docs.columns)]
    )
