"""Near copies by the similarity of their word shingles.

Equal sets of shingles are one node. SimHash comes first: nodes whose fingerprints are within two bits are one component, and each is
compared with the first of its component. MinHash bands then find the nodes that may have a near copy further off; most have none. Among
those an exact prefix filter proposes pairs: each set is ordered by rising frequency of its shingles and only its rarest ones are keys, so
texts that share a common passage do not meet. Exact sets of 64-bit shingle hashes confirm the pairs of both ways, so a link always means
the stated similarity. Pairs that links already connect are not compared.
SimHash alone loses links: at similarity 0.8 fingerprints differ in about ten bits, and covering a radius of r bits takes 2^(r+1) - 1
tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm import simhash
from tarifa.llm.decontaminate import MAP_BITS, _bit_map, gram_hashes, word_hashes
from tarifa.llm.graph import components
from tarifa.llm.text import ROW, ascii_words, map_texts, texts
from tarifa.session import new_path, save

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Of pairs with similarity 0.8, 1 - (1 - 0.8 ** 5) ** 25 = 0.99995 share a band; of more similar ones, more.
BANDS = 25
BAND_ROWS = 5
SEED = 42
# Nodes of a bucket, on the average over nodes, at which all of them are centres and the rounds end: few after the first round, more
# after some, when most pairs left are ruled out by their sizes and places, which are compared in less time than a round takes.
EVEN = 16
LATER_EVEN = 2048
EARLY_ROUNDS = 3
# Shingle hashes that are permuted at once.
CHUNK = 1 << 12

_RANDOM = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS, 1), np.uint64)
_FLIPS, _FACTORS = _RANDOM[0], _RANDOM[1] | np.uint64(1)


def shingles(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct 64-bit hashes of the text's word shingles in order; a text of fewer words is one shingle."""
    words = ascii_words(text)
    return np.unique(gram_hashes(word_hashes(words), min(size, len(words)))) if words else np.empty(0, np.uint64)


def bands(own: np.ndarray) -> list[int]:
    """One signed 64-bit key per band of MinHash values; none without shingles."""
    if not len(own):
        return []
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(own), CHUNK):
        least = np.minimum(least, ((own[start : start + CHUNK] ^ _FLIPS) * _FACTORS).min(axis=1))
    keys = [xxhash.xxh3_64_intdigest(row.tobytes(), seed) for seed, row in enumerate(least.reshape(BANDS, BAND_ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def similarity(a: bytes, b: bytes) -> float:
    """Shared part of two stored sets of shingles."""
    one, two = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    shared = len(np.intersect1d(one, two, assume_unique=True))
    return shared / (len(one) + len(two) - shared)


def _sets(rows: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node`` and ``own``, its set of shingles, for the rows of ``rows`` that ``nodes`` names, stored."""
    # Most rows share no bucket; a map of bounded size spares their sets, and the joins drop those it lets through.
    bits = rows.sparkSession.sparkContext.broadcast(_bit_map(nodes.select(F.xxhash64("node").alias("print"))))
    asked = rows.withColumn("print", F.xxhash64(ROW).bitwiseAND(F.lit((1 << MAP_BITS) - 1)))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.column("print").to_numpy()
        found = np.flatnonzero(bits.value[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1))
        batch = batch.take(pa.array(found, pa.int64()))
        own = pa.array([shingles(t, size).tobytes() for t in texts(batch)], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(ROW), own], ["node", "own"])

    return save(map_texts(asked.select(ROW, "text", "print"), each, "node long, own binary"), "shingles")


def _compared(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (``a``, ``b``) with their similarity ``j``, stored."""

    def compare(batches):
        for batch in batches:
            j = [similarity(x.as_py(), y.as_py()) for x, y in zip(batch.column("left"), batch.column("right"))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(j, pa.float64())], ["a", "b", "j"])

    joined = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    return save(joined.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long, j double"), "compared")


def _tokens(sets: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """``node``, ``n`` (shingles of the set) and ``gram`` for every shingle, or for those that ``bits`` does not rule out."""
    known = None if bits is None else sets.sparkSession.sparkContext.broadcast(bits)

    def each(batches):
        for batch in batches:
            for node, own in zip(batch.column("node").to_pylist(), batch.column("own")):
                grams = np.frombuffer(own.as_py(), np.int64)
                size = len(grams)
                if known is not None:
                    at = grams & np.int64((1 << MAP_BITS) - 1)
                    grams = grams[(known.value[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1]
                numbers = pa.array(np.full(len(grams), node)), pa.array(np.full(len(grams), size, np.int32)), pa.array(grams)
                yield pa.RecordBatch.from_arrays(list(numbers), ["node", "n", "gram"])

    return sets.mapInArrow(each, "node long, n int, gram long")


def prefixes(sets: DataFrame, least: float) -> DataFrame:
    """``key``, ``node``, ``n``, ``at`` and ``own``: the rarest shingles of every set that occur in another one too, with their
    places, and the share of the set that no other one holds.

    The shingles of a set are ordered by the number of sets that hold them, then by value. Two sets of at least ``least`` similarity
    have one in common among the first ``n - ceil(least * n) + 1`` of each. What many texts share comes last, so it makes no key
    unless a set has little else.
    """
    held = save(_tokens(sets).groupBy("gram").agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), "held")
    common = _tokens(sets, _bit_map(held.select(F.col("gram").alias("print")))).join(held, "gram")
    listed = common.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("held", "gram"))).alias("grams"))
    # Shingles of one set alone come before these.
    alone = F.col("n") - F.size("grams")
    length = F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1 - alone
    kept = listed.filter(length > 0).select("node", "n", alone.alias("alone"), F.slice("grams", 1, length.cast("int")).alias("grams"))
    return kept.select("node", "n", "alone", F.posexplode("grams").alias("place", "one")).select(
        F.col("one.gram").alias("key"), "node", "n", (F.col("alone") + F.col("place")).alias("at"), (F.col("alone") / F.col("n")).alias("own")
    )


def alike(nodes: DataFrame, radius: int = simhash.RADIUS) -> DataFrame:
    """``a`` and ``b``: each of ``nodes`` (``node``, ``fp``) with the smallest node of its SimHash component, stored.

    One pair per node whatever the size of a component. A fingerprint may agree by chance, so the pairs are to be compared.
    """
    found = simhash.named(nodes.select(F.col("node").alias("doc_id"), "fp"), radius)
    return save(found.select(F.col("component_id").alias("a"), F.col("doc_id").alias("b")).filter("a < b"), "alike")


def linked(rows: DataFrame, dealt: DataFrame, proposed: DataFrame, size: int, least: float) -> DataFrame:
    """``node`` and ``label``, the smallest node of its group, of all nodes that share a band with another or are in ``proposed``.

    Groups are what pairs of at least ``least`` connect. ``rows`` has ``_row`` and ``text``; ``dealt`` has ``key``, a band, and
    ``node``, a row's number; the pairs ``proposed`` (``a``, ``b``) are compared first. Nodes meet in buckets, one for every shingle among their rarest. In every round the buckets compare some
    of their nodes, the centres, with those of their nodes that are not in their group yet and whose sizes and places in the order
    allow the similarity: at first the node with the smallest share of shingles of its own, as the most typical one is like most
    others, then about twice as many each time, in the order of a hash. So a pair is compared unless other links connect it, and after
    the last round, in which all nodes of the buckets left are centres, none is left. Buckets choose alike, and a large group of near
    copies costs a few comparisons per node.
    """
    crowded = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = dealt.join(crowded, "key").select("node").unionByName(proposed.select(F.explode(F.array("a", "b")).alias("node")))
    labels = save(met.distinct().withColumn("label", F.col("node")), "labels")
    sets = _sets(rows, labels, size)
    done = _compared(sets, proposed)
    labels = _relabelled(labels, done.filter(F.col("j") >= least))
    keyed = save(prefixes(sets, least), "prefixes")
    # The share of the hash range below a node: about ``place * nodes`` of the bucket come before it.
    place = F.shiftrightunsigned(F.xxhash64("node"), 11).cast("double") / float(1 << 53)
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1")
    shared = save(keyed.join(sizes, "key").withColumn("place", place), "buckets")
    turn = 0
    while True:
        held = shared.join(labels, "node")
        ends = F.min(F.struct("own", "place")).alias("first"), F.min("label").alias("low"), F.max("label").alias("high")
        split = held.groupBy("key").agg(*ends).filter("low <> high").select("key", "first")
        open_ = save(held.join(split, "key"), "open")
        most, squares, count = open_.agg(F.max("nodes"), F.sum("nodes"), F.count(F.lit(1))).first()
        if most is None:
            return labels
        even = 0 if turn == 0 else EVEN if turn <= EARLY_ROUNDS else LATER_EVEN
        last = turn >= np.ceil(np.log2(most + 1)) or squares <= even * count
        # Which round makes a node a centre: 0 the first of its bucket, later ones by their place.
        later = F.greatest(F.lit(1), F.ceil(F.log2(F.col("place") * F.col("nodes") + 1)))
        members = open_.withColumn("turn", F.when(F.struct("own", "place") == F.col("first"), 0).otherwise(later).cast("int"))
        members = members.select("key", "node", "label", "n", "at", "turn").filter(F.col("turn") >= turn)
        centres = (members if last else members.filter(F.col("turn") == turn)).select("key", *[F.col(c).alias(f"{c}_x") for c in ("node", "label", "n", "at")])
        fits = F.least(F.col("n") - F.col("at"), F.col("n_x") - F.col("at_x")) >= least / (1 + least) * (F.col("n") + F.col("n_x")) - 1e-9
        met = centres.join(members, "key").filter((F.col("label") != F.col("label_x")) & fits)
        pairs = met.select(F.least("node_x", "node").alias("a"), F.greatest("node_x", "node").alias("b")).distinct()
        found = _compared(sets, pairs.join(done.select("a", "b"), ["a", "b"], "left_anti"))
        done = done.unionByName(found)
        labels = _relabelled(labels, found.filter(F.col("j") >= least))
        if last:
            return labels
        turn += 1


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after joining the groups that ``links`` connect."""
    of = links.join(labels.toDF("a", "of_a"), "a").join(labels.toDF("b", "of_b"), "b")
    merged = components(of.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct()).toDF("label", "to")
    return save(labels.join(merged, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")


def keep_one(
    docs: DataFrame,
    size: int = SHINGLE_WORDS,
    least: float = SIMILARITY,
) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest ``doc_id``, the first such row if it is repeated.

    SimHash proposes copies, see ``alike``, and an exact join finds the others, see ``linked``. Documents are linked if the Jaccard similarity of their sets of ``size``-word shingles, known by 64-bit hashes, is at least
    ``least``; groups are what links connect. A text of fewer words is one shingle; null, empty and wordless texts are one group.
    Rows without an id come last. Columns and their order stay, whatever their names. The bands are chosen for ``least`` 0.8.
    """
    spark = docs.sparkSession
    path = new_path(spark, "numbered")
    names = [f"c{i}" for i in range(len(docs.columns))]
    docs.toDF(*names).withColumn(ROW, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    text, doc_id = (names[docs.columns.index(c)] for c in ("text", "doc_id"))
    rows = stored.select(ROW, F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [shingles(t, size) for t in texts(batch)]
        digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in own], pa.binary())
        keys = pa.array([bands(s) for s in own], pa.list_(pa.int64()))
        fps = pa.array(np.array([simhash.majority(s) for s in own], np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("id"), digests, fps, keys], [ROW, "id", "digest", "fp", "bands"])

    kind = rows.schema["id"].dataType.simpleString()
    prints = save(map_texts(rows, each, f"{ROW} long, id {kind}, digest binary, fp long, bands array<long>"), "bands")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", ROW)).alias("first")
    sets = save(prints.groupBy("digest").agg(F.min(ROW).alias("node"), F.first("fp").alias("fp"), first).select("node", "fp", "first"), "sets")
    dealt = prints.join(sets.select(F.col("node").alias(ROW)), ROW, "left_semi")
    dealt = dealt.select(F.explode("bands").alias("key"), F.col(ROW).alias("node"))
    labels = linked(rows, dealt, alike(sets), size, least)
    named = sets.join(labels, "node", "left").select(F.coalesce("label", "node").alias("label"), "first")
    chosen = named.groupBy("label").agg(F.min("first").alias("first")).select(F.col(f"first.{ROW}").alias(ROW))
    return stored.join(chosen, ROW, "left_semi").select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
