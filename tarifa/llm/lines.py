"""Line dedup: lines that occur in many documents are looked up in sharded minimal perfect hashes.

Document counts per line key are aggregated over all documents. The keys that are frequent enough are dealt to shards by hash, and
each shard builds a minimal perfect hash over its keys: levels of bit arrays in which every key has a bit of its own. The rank of
that bit indexes two compact arrays, fingerprints and counts. Documents probe the arrays; lines are never joined with lines.

A key is known by 128 bits of hash: 64 place it, 64 are its fingerprint.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from tarifa.llm.text import ROW, map_texts, only, texts, with_columns
from tarifa.session import new_path, save

MIN_DOCUMENTS = 10
MIN_CODE_POINTS = 1
# Keys of one shard, on average.
SHARD_KEYS = 1 << 16
# Arrays up to this size go to every executor whole; larger ones are probed where they lie.
BROADCAST_BYTES = 32 << 20
# Copies of a shard's arrays among which probes are spread when they come to the shards.
SALTS = 16
BITS_PER_KEY = 2
LEVELS = 64
_SHARD = "shard int, keys long, sizes binary, bits binary, prints binary, counts binary, owners binary"


def line_keys(text: bytes) -> list[bytes]:
    """Per line, the line without white space at both ends and with A-Z lower-cased."""
    return [line.strip() for line in text.lower().split(b"\n")]


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode()) >= least)


def _hashes(keys: list[bytes]) -> np.ndarray:
    """Two unsigned 64-bit numbers per key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2).astype(np.uint64)


def _mix(values: np.ndarray, level: int) -> np.ndarray:
    """The place hash of a level: a 64-bit finalizer after adding the level's constant."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_hash(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit counts per level, the bits of all levels, and the index of every key; the keys are distinct."""
    sizes, bits = [], []
    index, left, done = np.empty(len(places), np.int64), np.arange(len(places)), 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, BITS_PER_KEY * len(left))
        at = (_mix(places[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(alone) - 1
        own = alone[at]
        index[left[own]] = done + rank[at[own]]
        done += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~own]
    if len(left):
        raise ValueError(f"{len(left)} keys share all places")
    return np.array(sizes, np.int64), np.concatenate([*bits, np.zeros(0, bool)]), index


class Shard:
    """The arrays of one shard, ready to be probed."""

    def __init__(self, row):
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)[: int(self.sizes.sum())]
        # One running count per 64 bits would do; a whole array of ranks is simple and bounded by the shard's size.
        self.rank = np.cumsum(self.bits, dtype=np.int32) - 1
        self.prints = np.frombuffer(row["prints"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.owners = np.frombuffer(row["owners"], np.int64)

    def gone(self, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whether each key is held, unless its row is the document that keeps it."""
        gone = self.probe(hashes) > 0
        if len(self.owners):
            gone[gone] = self.probe(hashes[gone], self.owners) != rows[gone]
        return gone

    def probe(self, hashes: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        """The count of each key, or its entry in ``values``; 0 for keys the shard does not hold."""
        values = self.counts if values is None else values
        found = np.zeros(len(hashes), np.int64)
        left, start = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            at = start + (_mix(hashes[left, 0], level) % np.uint64(size)).astype(np.int64)
            own = self.bits[at]
            index = self.rank[at[own]]
            same = self.prints[index] == hashes[left[own], 1]
            found[left[own][same]] = values[index[same]]
            left, start = left[~own], start + int(size)
            if not len(left):
                break
        return found


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes[:, 0] >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def _owners(batch: pa.RecordBatch) -> list[int]:
    """A 64-bit number per row that stands for its id and text."""
    ids = batch.column("doc_id").to_pylist()
    return [xxhash.xxh3_64_intdigest(t, xxhash.xxh3_64_intdigest(repr(i))) for i, t in zip(ids, texts(batch))]


def line_owners(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS) -> DataFrame:
    """Rows of :func:`line_counts` with ``owner``, the number of the key's first document by id, null last, then by number."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, owners = batch.column("doc_id").to_pylist(), np.array(_owners(batch), np.uint64)
        ranks = [(i is None, 0 if i is None else i, o) for i, o in zip(ids, owners.tolist())]
        order = np.array(sorted(range(len(ids)), key=ranks.__getitem__), np.int64)
        values = texts(batch)
        own = [[k for k in set(line_keys(values[at])) if _long_enough(k, min_code_points)] for at in order]
        hashes = _hashes([k for keys in own for k in keys])
        # The first of equal keys is that of the first document, as the documents are in order.
        halves, first, n = np.unique(hashes, axis=0, return_index=True, return_counts=True)
        at = np.repeat(order, [len(keys) for keys in own])[first]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(halves[:, 0].view(np.int64)), pa.array(halves[:, 1].view(np.int64)), pa.array(n.astype(np.int64)),
                batch.column("doc_id").take(pa.array(at)), pa.array(owners[at].view(np.int64)),
            ],
            ["place", "print", "n", "doc_id", "owner"],
        )

    partial = map_texts(only(docs, "doc_id", "text"), count, f"place long, print long, n long, doc_id {kind}, owner long")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "owner"))
    found = partial.groupBy("place", "print").agg(F.sum("n").alias("n"), first.alias("first"))
    return found.select("place", "print", "n", F.col("first.owner").alias("owner"))


def line_counts(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS) -> DataFrame:
    """``place``, ``print`` (the two halves of the key's hash) and ``n``, the documents that hold the key, for every key."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [k for t in texts(batch) for k in set(line_keys(t)) if _long_enough(k, min_code_points)]
        halves, n = np.unique(_hashes(keys), axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(halves[:, 0].view(np.int64)), pa.array(halves[:, 1].view(np.int64)), pa.array(n.astype(np.int64))],
            ["place", "print", "n"],
        )

    partial = map_texts(only(docs, "text"), count, "place long, print long, n long")
    return partial.groupBy("place", "print").agg(F.sum("n").alias("n"))


def line_index(frequent: DataFrame) -> tuple[DataFrame, int]:
    """The sharded hash over rows of :func:`line_counts` or :func:`line_owners`, stored, and its number of shards."""
    shards = frequent.count() // SHARD_KEYS + 1
    owned = "owner" in frequent.columns

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        places = rows["place"].to_numpy(np.int64).view(np.uint64)
        sizes, bits, index = build_hash(places)
        prints, counts = np.empty(len(rows), np.uint64), np.empty(len(rows), np.int64)
        prints[index] = rows["print"].to_numpy(np.int64).view(np.uint64)
        counts[index] = rows["n"].to_numpy(np.int64)
        owners = np.empty(len(rows) if owned else 0, np.int64)
        if owned:
            owners[index] = rows["owner"].to_numpy(np.int64)
        return pd.DataFrame(
            {
                "shard": [int(key[0])],
                "keys": [len(rows)],
                "sizes": [sizes.tobytes()],
                "bits": [np.packbits(bits).tobytes()],
                "prints": [prints.tobytes()],
                "counts": [counts.tobytes()],
                "owners": [owners.tobytes()],
            }
        )

    shard = F.expr(f"cast(pmod(shiftrightunsigned(place, 33), {shards}) as int)")
    keyed = frequent.withColumn("shard", shard)
    return save(keyed.groupBy("shard").applyInPandas(build, _SHARD), "line_index"), shards


def drop_common_lines(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_code_points: int = MIN_CODE_POINTS,
    broadcast_bytes: int = BROADCAST_BYTES,
    keep_first: bool = False,
) -> DataFrame:
    r"""``docs`` without the lines whose key occurs in at least ``min_documents`` documents.

    Texts are split at ``\n``. A line's key is the line without ``[\x20\x09-\x0D]`` at both ends and with A-Z lower-cased; keys of
    fewer than ``min_code_points`` code points never count. Adds ``n_lines`` and ``n_dropped``; input columns with these names
    are replaced, all others stay. A null text is one empty line and comes back as an empty text, as does a text that loses
    every line. Documents are rows: repeated rows and ids count once each. An empty table gives an empty result.

    With ``keep_first`` the first document that holds a common line, by ``doc_id`` with null last, keeps all its occurrences, so
    that a text with many copies stays whole in one of them. Of different texts with one id a hash decides; rows that repeat the
    id and the text of that document are the same document and keep the line too.
    """
    counts = line_owners if keep_first else line_counts
    counted = counts(docs, min_code_points).filter(F.col("n") >= min_documents)
    index, shards = line_index(save(counted, "line_counts"))
    size = index.agg(F.sum(F.expr("length(bits) + length(prints) + length(counts) + length(owners)"))).first()[0] or 0
    if size <= broadcast_bytes:
        return _drop_with_copies(docs, index, shards, keep_first)
    return _drop_at_shards(docs, index, shards, keep_first)


def _row_owners(batch: pa.RecordBatch, keep_first: bool) -> np.ndarray:
    """The number of every row as in :func:`line_owners`; zeros if no document keeps lines."""
    return np.array(_owners(batch), np.uint64).view(np.int64) if keep_first else np.zeros(batch.num_rows, np.int64)


def _keep(batch: pa.RecordBatch, columns: list[str], hits) -> pa.RecordBatch:
    """The batch with the lines removed that ``hits`` marks, given all lines' keys."""
    lines = [t.split(b"\n") for t in texts(batch)]
    sizes = np.array([len(x) for x in lines], np.int64)
    gone = hits(sizes)
    stops = np.cumsum(sizes)
    kept, dropped = [], []
    for own, stop in zip(lines, stops):
        mark = gone[stop - len(own) : stop]
        dropped.append(int(mark.sum()))
        kept.append(b"\n".join([x for x, g in zip(own, mark) if not g] if mark.any() else own))
    arrays = {name: batch.column(name) for name in batch.schema.names}
    arrays |= {"text": pa.array(kept, pa.binary()).cast(pa.string()), "n_lines": pa.array(sizes), "n_dropped": pa.array(dropped, pa.int64())}
    return pa.RecordBatch.from_arrays([arrays[c] for c in columns], columns)


def _output(docs: DataFrame):
    # ``text`` keeps its place; the two counts come last.
    schema = with_columns(docs, n_lines=LongType(), n_dropped=LongType())
    schema["text"].dataType = StringType()
    return schema


def _all_keys(batch: pa.RecordBatch) -> list[bytes]:
    return [key for t in texts(batch) for key in line_keys(t)]


def _drop_with_copies(docs: DataFrame, index: DataFrame, shards: int, keep_first: bool) -> DataFrame:
    schema = _output(docs)
    columns = schema.names
    # At most ``broadcast_bytes``, as measured before.
    arrays = docs.sparkSession.sparkContext.broadcast([row.asDict() for row in index.collect()])
    ready: dict[int, Shard] = {}

    def drop(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not ready:
            ready.update((row["shard"], Shard(row)) for row in arrays.value)

        def hits(sizes: np.ndarray) -> np.ndarray:
            hashes = _hashes(_all_keys(batch))
            gone, owner = np.zeros(len(hashes), bool), _shard_of(hashes, shards)
            rows = np.repeat(_row_owners(batch, keep_first), sizes)
            for number, shard in ready.items():
                own = np.flatnonzero(owner == number)
                gone[own] = shard.gone(hashes[own], rows[own])
            return gone

        return _keep(batch, columns, hits)

    return map_texts(docs.withColumn("text", F.col("text").cast("string")), drop, schema)


def _drop_at_shards(docs: DataFrame, index: DataFrame, shards: int, keep_first: bool) -> DataFrame:
    """The same without copies of the arrays: key hashes travel to salted shards, marks travel back to the stored rows."""
    schema = _output(docs)
    columns = schema.names
    spark = docs.sparkSession
    path = new_path(spark, "line_rows")
    numbered = docs.withColumn("text", F.col("text").cast("string")).withColumn(ROW, F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)

    def asked(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = {ROW: [], "shard": [], "lines": [], "hashes": [], "owner": []}
        owners = _row_owners(batch, keep_first).tolist()
        for row, text, holder in zip(batch.column(ROW).to_pylist(), texts(batch), owners):
            hashes = _hashes(line_keys(text))
            owner = _shard_of(hashes, shards)
            for number in np.unique(owner):
                lines = np.flatnonzero(owner == number)
                out[ROW].append(row)
                out["shard"].append(int(number))
                out["lines"].append(lines.astype(np.int64).tobytes())
                out["hashes"].append(hashes[lines].tobytes())
                out["owner"].append(holder)
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    read = [ROW, "text", *(["doc_id"] if keep_first else [])]
    asks = map_texts(rows.select(*read), asked, f"{ROW} long, shard int, lines binary, hashes binary, owner long")
    asks = asks.withColumn("salt", F.expr(f"cast(pmod({ROW}, {SALTS}) as int)"))
    copies = index.withColumn("salt", F.explode(F.expr(f"sequence(0, {SALTS - 1})")))

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(right):
            shard = Shard(right.iloc[0])
            for row, lines, hashes, holder in zip(left[ROW], left["lines"], left["hashes"], left["owner"]):
                hashes = np.frombuffer(hashes, np.uint64).reshape(-1, 2)
                gone = shard.gone(hashes, np.full(len(hashes), holder, np.int64))
                if gone.any():
                    found.append((row, np.frombuffer(lines, np.int64)[gone].tobytes()))
        return pd.DataFrame(found, columns=[ROW, "gone"])

    keys = ["shard", "salt"]
    marks = asks.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(answer, f"{ROW} long, gone binary")
    marks = marks.groupBy(ROW).agg(F.collect_list("gone").alias("gone"))
    joined = rows.join(marks, ROW, "left").drop(ROW)

    def drop(batch: pa.RecordBatch) -> pa.RecordBatch:
        def hits(sizes: np.ndarray) -> np.ndarray:
            gone, starts = np.zeros(int(sizes.sum()), bool), np.cumsum(sizes) - sizes
            for start, own in zip(starts, batch.column("gone").to_pylist()):
                for lines in own or ():
                    gone[start + np.frombuffer(lines, np.int64)] = True
            return gone

        return _keep(batch, columns, hits)

    return map_texts(joined, drop, schema)
