"""Exact removal of long repeated byte strings with sharded suffix arrays.

Which windows of ``LENGTH`` bytes can repeat is found without comparing texts: every window has an anchor, the ``GRAM``-byte string
inside it with the smallest hash (the last one in a tie), so equal windows have equal anchors at equal places. Consecutive windows with
one anchor form a context. Contexts whose anchor string occurs once hold no repeat. Equal contexts are counted; different contexts
with one anchor string are dealt to shards by it. Each shard builds a suffix array over its contexts by induced sorting and
marks the windows whose permuted common prefix reaches ``LENGTH``. Each window belongs to one context, so a match is never a
window with itself, wherever the two lie.

An anchor string with very many different contexts is not left to one shard: its windows are hashed, 128 bits each, and counted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tarifa.llm.induced import common_prefixes, suffix_array
from tarifa.llm.text import ROW, slices, texts, with_columns
from tarifa.session import new_path, save

LENGTH = 400
GRAM = 160
# Windows that one step looks at, and bytes of contexts in one shard on average.
BLOCK = 1 << 19
SHARD_BYTES = 1 << 20
# Different contexts of one anchor string that a shard takes.
SHARD_CONTEXTS = 1000
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POSITION_BITS = np.uint64(21)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    out[1:] = base
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Hashes of all strings of one length in a block of bytes."""

    def __init__(self, size: int):
        self.up, self.down = _powers(_BASE, size + 1), _powers(_INVERSE, size + 1)

    def __call__(self, data: np.ndarray, length: int) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=total[1:])
        found = (total[length:] - total[:-length]) * self.down[: len(data) - length + 1]
        found = (found ^ (found >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return found ^ (found >> np.uint64(29))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values, from running minima inside and across blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def contexts(block: bytes, ends: np.ndarray, length: int, gram: int, rolling: Rolling) -> tuple[np.ndarray, ...]:
    """First window, windows and anchor hash of each context in a block of texts that end at ``ends``."""
    data = np.frombuffer(block, np.uint8)
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = rolling(data, gram)
    mask = (np.uint64(1) << _POSITION_BITS) - np.uint64(1)
    keyed = (grams & ~mask) | (mask - np.arange(len(grams), dtype=np.uint64))
    anchor = (mask - (sliding_least(keyed, length - gram + 1) & mask)).astype(np.int64)
    start = np.arange(len(anchor))
    owner = np.searchsorted(ends, start, side="right")
    inside = start + length <= ends[np.minimum(owner, len(ends) - 1)]
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    run = np.cumsum(fresh) - 1
    sizes = np.bincount(run, inside).astype(np.int64)
    first = np.flatnonzero(fresh)
    kept = sizes > 0
    return first[kept], sizes[kept], grams[anchor[first[kept]]]


def _blocks(values: list[bytes], length: int, block: int):
    """Blocks of at most about ``block`` windows: row number and offset of each text part, and the parts."""
    parts, size = [], 0
    for i, value in enumerate(values):
        for at in range(0, max(1, len(value) - length + 1), block):
            part = value[at : at + block + length - 1]
            if len(part) < length:
                continue
            if size + len(part) > block and parts:
                yield parts
                parts, size = [], 0
            parts.append((i, at, part))
            size += len(part)
    if parts:
        yield parts


_CONTEXT = "gram long, one long, two long, first long, bytes int"


def find_contexts(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``ROW``, anchor hash ``gram``, 128 bits of context hash (``one``, ``two``), ``first`` byte and size in ``bytes``."""

    size = BLOCK

    def run(batches):
        rolling = Rolling(size + 2 * length)
        for piece in slices(batches):
            numbers = np.array(piece.column(ROW).to_pylist(), np.int64)
            for parts in _blocks(texts(piece), length, size):
                block = b"".join(p for _, _, p in parts)
                ends = np.cumsum([len(p) for _, _, p in parts])
                first, windows, grams = contexts(block, ends, length, gram, rolling)
                sizes = windows + length - 1
                owner = np.searchsorted(ends, first, side="right")
                begins = ends - np.array([len(p) for _, _, p in parts])
                digests = b"".join(xxhash.xxh3_128_digest(block[a:b]) for a, b in zip(first.tolist(), (first + sizes).tolist()))
                halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                offset = np.array([at for _, at, _ in parts], np.int64)
                row = numbers[np.array([i for i, _, _ in parts], np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row[owner]), pa.array(grams.view(np.int64)), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                        pa.array(first - begins[owner] + offset[owner]), pa.array(sizes.astype(np.int32)),
                    ],
                    [ROW, "gram", "one", "two", "first", "bytes"],
                )

    return rows.select(ROW, "text").mapInArrow(run, f"{ROW} long, {_CONTEXT}")


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, which of its windows of ``length`` bytes also starts elsewhere in the parts."""
    sizes = np.array([len(p) for p in parts], np.int64)
    # Parts end in a symbol below all bytes; the text ends in the smallest.
    data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int64) + 2
    ends = np.cumsum(sizes + 1)
    data[ends - 1] = 1
    text = np.append(data, 0)
    order = suffix_array(text, 258)
    shared = common_prefixes(text, order, length)
    room = np.repeat(ends, sizes + 1) - 1 - np.arange(len(data))
    # A prefix of ``length`` bytes inside a part holds no end, so neither does its match.
    own = shared[:-1] >= length
    marked = np.zeros(len(text), bool)
    long = np.flatnonzero(np.append(own & (room >= length), False))
    marked[long] = True
    place = np.empty(len(text), np.int64)
    place[order] = np.arange(len(text))
    marked[order[place[long] - 1]] = True
    marked[:-1] &= room >= length
    return [marked[e - s - 1 : e - 1][: max(0, s - length + 1)] for e, s in zip(ends.tolist(), sizes.tolist())]


def _spans(windows: np.ndarray, first: int, length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by marked windows of a context that starts at ``first``."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], windows.astype(np.int8), [0]]))).reshape(-1, 2)
    return [(first + int(a), first + int(b) - 1 + length) for a, b in edges]


def _sources(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of ``wanted`` contexts (``ROW``, ``first``, ``bytes`` and more), cut from their texts."""
    others = [c for c in wanted.columns if c != ROW]
    listed = wanted.groupBy(ROW).agg(F.collect_list(F.struct(*others)).alias("_wanted"))
    joined = rows.select(ROW, "text").join(listed, ROW)
    fields = wanted.schema

    def cut(batches):
        for piece in slices(batches):
            out = {c: [] for c in (ROW, *others, "part")}
            for row, text, asked in zip(piece.column(ROW).to_pylist(), texts(piece), piece.column("_wanted").to_pylist()):
                for one in asked:
                    for c in others:
                        out[c].append(one[c])
                    out[ROW].append(row)
                    out["part"].append(text[one["first"] : one["first"] + one["bytes"]])
            kinds = {"bytes": pa.int32(), "part": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()], list(out))

    schema = f"{ROW} long, " + ", ".join(f"{c} {fields[c].dataType.simpleString()}" for c in others) + ", part binary"
    return joined.mapInArrow(cut, schema)


def repeats(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """``ROW``, ``first`` and ``end`` of byte ranges that windows found elsewhere cover; ranges may overlap.

    ``rows`` is a stored table with ``ROW`` and ``text``.
    """
    found = save(find_contexts(rows, length, gram), "contexts")
    # Stored, so that the joins below shuffle both sides and adaptive execution can split a frequent anchor string.
    twice = save(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "shared_grams")
    shared = save(found.join(twice, "gram"), "shared_contexts")
    key = ["gram", "one", "two"]
    distinct = save(
        shared.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(ROW, "first", "bytes")).alias("at")), "distinct_contexts"
    )
    kinds = save(distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "gram_kinds")
    asked = distinct.join(kinds, "gram").select(
        F.col(f"at.{ROW}").alias(ROW), "gram", F.col("at.first").alias("first"), F.col("at.bytes").alias("bytes"), "n", "kinds"
    )
    parts = save(_sources(rows, asked), "context_bytes")
    whole = shared.join(distinct.filter("n > 1").select(*key), key).select(ROW, "first", (F.col("first") + F.col("bytes")).alias("end"))
    # A stage of its own, for the same reason: one context may occur in a third of the texts.
    whole = save(whole, "whole_contexts")
    few, many = parts.filter(F.col("kinds") <= shard_contexts), parts.filter(F.col("kinds") > shard_contexts)
    return whole.unionByName(_in_shards(few, length)).unionByName(_by_window(many, length))


_SPAN = f"{ROW} long, first long, end long"


def _in_shards(parts: DataFrame, length: int) -> DataFrame:
    size = parts.agg(F.sum("bytes")).first()[0] or 0
    shards = size // SHARD_BYTES + 1

    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        marked = repeated_windows(rows["part"].tolist(), length)
        spans = [
            (row, *span)
            for row, first, n, own in zip(rows[ROW].tolist(), rows["first"].tolist(), rows["n"].tolist(), marked)
            if n == 1  # contexts that occur again are covered whole
            for span in _spans(own, first, length)
        ]
        return pd.DataFrame(spans, columns=[ROW, "first", "end"]).astype("int64")

    shard = F.pmod(F.xxhash64("gram"), F.lit(shards))
    return parts.withColumn("shard", shard).groupBy("shard").applyInPandas(mark, _SPAN)


def _by_window(parts: DataFrame, length: int) -> DataFrame:
    """Windows of contexts with a very frequent anchor string: equal ones by hash."""

    def windows(batches):
        for piece in slices(batches, "part"):
            for row, first, n, part in zip(*(piece.column(c).to_pylist() for c in (ROW, "first", "n", "part"))):
                digests = b"".join(xxhash.xxh3_128_digest(part[i : i + length]) for i in range(len(part) - length + 1))
                halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                size = len(halves)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(size, row, np.int64)), pa.array(np.arange(first, first + size)), pa.array(np.full(size, n, np.int64)),
                        pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                    ],
                    [ROW, "first", "n", "one", "two"],
                )

    hashed = save(
        parts.select(ROW, "first", "n", "part").mapInArrow(windows, f"{ROW} long, first long, n long, one long, two long"), "windows"
    )
    again = hashed.groupBy("one", "two").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("one", "two")
    return hashed.filter("n = 1").join(again, ["one", "two"]).select(ROW, "first", (F.col("first") + length).alias("end"))


def drop_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """``docs`` without the bytes that lie in a string of ``length`` bytes that also starts elsewhere.

    Adds ``n_bytes``, ``n_removed``, ``spans`` (removed ranges, maximal, as byte offsets) and ``kept`` (the remaining bytes;
    ``text`` stays as it was, because a cut may split a character). All copies go, the first one too; overlapping copies inside one
    text count; matches never cross texts. Null and empty texts have no bytes. Null and repeated ids need no care; repeated rows
    of at least ``length`` bytes remove each other. Input columns with the names of the new ones are replaced. An empty table gives
    an empty result.
    """
    new = ("n_bytes", "n_removed", "spans", "kept", ROW)
    source = docs.drop(*new).withColumn("text", F.col("text").cast("string"))
    path = new_path(docs.sparkSession, "texts")
    source.withColumn(ROW, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    found = repeats(rows, length, gram, shard_contexts)
    spans = found.groupBy(ROW).agg(F.collect_set(F.struct("first", "end")).alias("_found"))
    joined = rows.join(spans, ROW, "left").drop(ROW)
    span = StructType([StructField("first", LongType()), StructField("end", LongType())])
    schema = with_columns(source, n_bytes=LongType(), n_removed=LongType(), spans=ArrayType(span), kept=BinaryType())

    def cut(batches):
        for piece in slices(batches):
            sizes, removed, merged, kept = [], [], [], []
            for text, own in zip(texts(piece), piece.column("_found").to_pylist()):
                ranges = merge([(x["first"], x["end"]) for x in own or ()])
                sizes.append(len(text))
                removed.append(sum(b - a for a, b in ranges))
                merged.append([{"first": a, "end": b} for a, b in ranges])
                edges = [0, *(x for pair in ranges for x in pair), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            arrays = [piece.column(n) for n in schema.names[:-4]]
            arrays += [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(merged, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return joined.mapInArrow(cut, schema)


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out
