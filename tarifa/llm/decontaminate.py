"""Benchmark decontamination by winnowing.

Of every window of consecutive k-grams only those with the smallest hash are kept as fingerprints, in documents and benchmark items
alike. With k-grams of ``k`` words and windows of ``span - k + 1`` k-grams, any shared run of ``span`` words holds the same
smallest hash on both sides, so a join of the fingerprints finds every such run; it is then extended word by word over the text.

Items shorter than ``span`` words are matched whole: their fingerprint is the hash of all their words, and documents give the
hashes of all their runs of that length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tarifa.llm.text import ROW, map_texts, only, texts, with_columns
from tarifa.session import save

SPAN_WORDS = 10
GRAM_WORDS = 5
# Bits of the map of benchmark fingerprints that all tasks hold: 2 MB, whatever the benchmark's size.
MAP_BITS = 24
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Word bytes: digits, letters (lower-cased) and everything outside ASCII; all other bytes separate.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def item_words(text: bytes) -> list[bytes]:
    r"""Lower-cased (A-Z) runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``."""
    return text.translate(_WORD_BYTES).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words; the length takes part."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total = total * _FACTOR + hashes[i : i + count]
    return (total ^ (total >> np.uint64(29))) * _FACTOR


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """The distinct hashes that are smallest in some window of ``window`` consecutive ones; none if there are fewer."""
    count = len(grams) - window + 1
    if count <= 0:
        return grams[:0]
    least = grams[:count]
    for i in range(1, window):
        least = np.minimum(least, grams[i : i + count])
    return np.unique(least)


def _prints(words: list[bytes], span: int, gram: int, short: list[int]) -> np.ndarray:
    hashes = word_hashes(words)
    found = [winnow(gram_hashes(hashes, gram), span - gram + 1)]
    found += [np.unique(gram_hashes(hashes, size)) for size in short]
    return np.unique(np.concatenate(found))


def benchmark_prints(items: DataFrame, span: int, gram: int) -> DataFrame:
    """``print`` and ``item_id`` with ``text`` for every fingerprint of an item; ``size`` is the item's words if fewer than ``span``."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for number, text in zip(batch.column("item").to_pylist(), texts(batch)):
            words = item_words(text)
            size = len(words) if len(words) < span else 0
            if words:
                own = _prints(words, span, gram, []) if not size else gram_hashes(word_hashes(words), size)
                rows += [(number, int(p), size) for p in own.view(np.int64)]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())],
            ["item", "print", "size"],
        )

    return map_texts(only(items, "item", "text"), each, "item long, print long, size int")


def _bit_map(prints: DataFrame) -> np.ndarray:
    """One bit per value of a fingerprint's last ``MAP_BITS`` bits; the words gathered, as Arrow columns, are bounded by the map's size."""
    at = F.col("print").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    words = prints.select(F.shiftright(at, 5).alias("word"), F.expr("shiftleft(1L, cast(print & 31 as int))").alias("bits"))
    # Rows as Python objects would take the driver 300 MB for a full map.
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (MAP_BITS - 5), np.uint32)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return bits


def contamination(
    docs: DataFrame,
    items: DataFrame,
    span: int = SPAN_WORDS,
    gram: int = GRAM_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted ids as text) and ``spans`` (hit runs as word offsets).

    A word is hit if it lies inside an occurrence of ``span`` consecutive words of an item, or of a whole item that has fewer
    words. Words are runs of ASCII letters and digits and of characters outside ASCII, with A-Z lower-cased; null texts have
    none. Items without words never match; equal items are all reported; a repeated ``item_id`` is reported once. Every row is
    judged alone, so null and repeated ids need no care. Input columns with the names of the new ones are replaced. An empty
    benchmark hits nothing; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts_of_items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    numbered = save(texts_of_items.withColumn("item", F.monotonically_increasing_id()), "items")
    prints = save(benchmark_prints(numbered, span, gram), "item_prints")
    # At most span - 1 different lengths.
    short = sorted(r[0] for r in prints.filter("size > 0").select("size").distinct().collect())
    rows = _sifted(docs, _bit_map(prints), span, gram, short)

    pairs = (
        rows.select(ROW, F.explode("_prints").alias("print"))
        .join(prints.select("print", "item"), "print")
        .select(ROW, "item")
        .distinct()
        .join(numbered, "item")
        .groupBy(ROW)
        .agg(F.collect_list(F.struct("item_id", "text")).alias("_items"))
    )
    hits = rows.filter("_prints is not null").select(ROW, "text").join(pairs, ROW)
    found = hits.mapInArrow(_extender(span), f"{ROW} long, {_FOUND}")
    joined = rows.join(found, ROW, "left")
    nothing = {"n_hit": F.lit(0), "n_items": F.lit(0), "items": F.array().cast("array<string>"), "spans": F.array().cast(_SPANS)}
    plain = [c for c in docs.columns if c not in _NEW]
    return joined.select(
        *plain,
        "n_words",
        *[F.coalesce(c, empty.cast(joined.schema[c].dataType)).alias(c) for c, empty in nothing.items()],
    )


_SPANS = "array<struct<first:bigint,end:bigint>>"
_FOUND = f"n_hit long, n_items long, items array<string>, spans {_SPANS}"
_NEW = ("n_words", "n_hit", "n_items", "items", "spans", ROW, "_prints")


def _sifted(docs: DataFrame, bits: np.ndarray, span: int, gram: int, short: list[int]) -> DataFrame:
    """``docs``, stored, with a row number, ``n_words`` and ``_prints``: the fingerprints that the map holds, null if none."""
    known = docs.sparkSession.sparkContext.broadcast(bits)
    source = docs.drop(*_NEW).withColumn("text", F.col("text").cast("string"))
    schema = with_columns(source, n_words=LongType(), _prints=ArrayType(LongType()))

    def sift(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, found = [], []
        for value in texts(batch):
            words = item_words(value)
            own = _prints(words, span, gram, short)
            at = (own & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)
            own = own[(known.value[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1]
            counts.append(len(words))
            found.append(own.view(np.int64) if len(own) else None)
        arrays = [*batch.columns, pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    return save(map_texts(source, sift, schema).withColumn(ROW, F.monotonically_increasing_id()), "sifted")


def occurrences(words: list[bytes], items: list[tuple[str, bytes]], span: int) -> tuple[np.ndarray, set[str]]:
    """Which words lie inside an occurrence of a window of the items, and the items whose windows occur."""
    windows: dict[tuple[bytes, ...], set[str]] = {}
    for number, text in items:
        own = item_words(text)
        size = min(span, len(own))
        for run in zip(*(own[i:] for i in range(size))):
            windows.setdefault(run, set()).add(number)
    hit, seen = np.zeros(len(words) + 1, np.int64), set()
    for size in {len(run) for run in windows}:
        for at, run in enumerate(zip(*(words[i:] for i in range(size)))):
            if run in windows:
                seen |= windows[run]
                hit[at] += 1
                hit[at + size] -= 1
    return np.cumsum(hit[:-1]) > 0, seen


def _extender(span: int):
    """Extend the hits of each row over its whole text."""

    def run(batches):
        for batch in batches:
            out = []
            for text, items in zip(texts(batch), batch.column("_items").to_pylist()):
                named = [(i["item_id"], i["text"].encode()) for i in items]
                hit, seen = occurrences(item_words(text), named, span)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                spans = [{"first": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                # An item without an id has a text of its own to match but no name to report.
                names = sorted(i for i in seen if i is not None)
                out.append((int(hit.sum()), len(names), names, spans))
            columns = list(zip(*out)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), *arrays], [ROW, "n_hit", "n_items", "items", "spans"])

    return run
