"""Language identification by Bayesian fusion of text, declared language, address suffix and host.

Per row the log posterior of a language adds up

* the text: a model of byte trigrams per language, learned from all rows by their declared language;
* the declaration: P(declared | language), from counts of declared against text language;
* the address suffix: P(suffix | language), from counts per suffix;
* the host: P(language | host), smoothed towards its parent domain, which is smoothed towards the whole table. The row itself is
  left out of its host's counts.

All counts are grouped aggregations over all rows. Hosts are joined once, as one table that already carries what parent and suffix
contribute; a host with a third of the rows is one row of that table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType

from tarifa.llm.text import ROW, map_texts, slices, texts, with_columns
from tarifa.session import save

LANGUAGES = ("de", "en", "es", "fr")
# The class of texts unlike any of the languages: its trigrams are all equally likely.
UNKNOWN = "und"
UNKNOWN_PRIOR = 1e-3
BUCKET_BITS = 15
# Trigrams of one text overlap and repeat, so their evidence levels off at this many independent ones.
TEXT_EVIDENCE = 60.0
HOST_STRENGTH = 10.0
PARENT_STRENGTH = 50.0
COUNT_SMOOTHING = 1.0
MIN_PROBABILITY = 0.5


def trigram_buckets(text: bytes) -> np.ndarray:
    """The bucket of every byte trigram of the lower-cased text, digits and ASCII punctuation left out."""
    data = np.frombuffer(b" " + text.lower().translate(None, _SKIPPED) + b" ", np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64)
    joined = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    return ((joined * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


_SKIPPED = bytes(b for b in range(33, 127) if not (65 <= b <= 90 or 97 <= b <= 122))


def trigram_counts(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """``declared``, ``bucket`` and ``n`` over all rows that declare one of the languages."""

    def run(batches):
        totals = {name: np.zeros(1 << BUCKET_BITS, np.int64) for name in languages}
        for piece in slices(batches):
            for name, text in zip(piece.column("declared").to_pylist(), texts(piece)):
                if name in totals:
                    totals[name] += np.bincount(trigram_buckets(text), minlength=1 << BUCKET_BITS)
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                ["declared", "bucket", "n"],
            )

    counted = docs.select("declared", "text").mapInArrow(run, "declared string, bucket int, n long")
    return counted.groupBy("declared", "bucket").agg(F.sum("n").alias("n"))


def text_model(counts: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Natural log probabilities, one row per language and a last one that is flat; bounded by languages times buckets."""
    found = counts.toPandas()
    table = np.full((len(languages) + 1, 1 << BUCKET_BITS), 0.0)
    for i, name in enumerate(languages):
        own = found[found["declared"] == name]
        table[i, own["bucket"].to_numpy(np.int64)] = own["n"].to_numpy(np.float64)
    table += COUNT_SMOOTHING * 0.01
    return np.log(table / table.sum(axis=1, keepdims=True))


def text_evidence(text: bytes, model: np.ndarray) -> np.ndarray:
    """Log likelihood of each language, levelled off, relative to the best; zeros without letters."""
    buckets = trigram_buckets(text)
    if len(buckets) <= 1:
        return np.zeros(len(model))
    total = model[:, buckets].sum(axis=1) if len(buckets) < 1 << 16 else model @ np.bincount(buckets, minlength=model.shape[1])
    found = total / (1 + len(buckets) / TEXT_EVIDENCE)
    return found - found.max()


def _declared(value: Column, languages: tuple[str, ...]) -> Column:
    """The primary subtag in lower case, ``other`` if it is none of the languages, ``none`` if absent."""
    tag = F.lower(F.regexp_extract(F.trim(value), "^([A-Za-z]+)", 1))
    return F.when(value.isNull() | (tag == ""), "none").when(tag.isin(*languages), tag).otherwise("other")


def address_parts(url: Column) -> dict[str, Column]:
    """``host``, ``parent`` (its last two labels) and ``suffix`` (its last label) of an address; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    return {
        "host": host,
        "parent": F.regexp_extract(host, r"([^.]*\.?[^.]+)$", 1),
        "suffix": F.when(host.contains("."), F.substring_index(host, ".", -1)),
    }


def page_fields(html: Column) -> dict[str, Column]:
    """``declared`` (the ``lang`` of the ``html`` element) and ``text`` (what stands outside tags, scripts, styles and comments)."""
    visible = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    lang = F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1)
    return {"declared": F.when(lang != "", lang), "text": F.regexp_replace(visible, r"(?s)<[^>]*>", " ")}


def identify(docs: DataFrame, languages: tuple[str, ...] = LANGUAGES, min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """``docs`` with ``language``, ``probability``, ``text_language`` and ``kept``.

    ``docs`` has ``text`` and the evidence columns ``declared``, ``host``, ``parent`` and ``suffix``, all text and all nullable; missing
    evidence adds nothing. ``language`` is the most probable one, the first by name in a tie, or ``und``. A row is kept if its
    language is known with at least ``min_probability`` and its text has a letter: null, empty and letterless texts are
    not kept, and their language comes from the other evidence. Repeated rows count as often as they occur. The evidence
    columns are not returned; input columns with the names of the new ones are replaced. An empty table gives an empty result.
    """
    classes = [*languages, UNKNOWN]
    new = ("language", "probability", "text_language", "kept")
    plain = [c for c in docs.columns if c not in (*new, "declared", "host", "parent", "suffix")]
    source = docs.drop(*new).withColumn("text", F.col("text").cast("string"))
    source = source.withColumn("declared", _declared(F.col("declared").cast("string"), languages))
    host = F.coalesce(F.col("host").cast("string"), F.lit(""))
    source = source.withColumn("host", host).withColumn("parent", F.coalesce(F.col("parent").cast("string"), host))
    model = text_model(trigram_counts(source, languages), languages)

    scored = save(_scored(source, model).withColumn(ROW, F.monotonically_increasing_id()), "language_evidence")
    best = F.array_position("_text", F.array_max("_text")) - 1
    known = scored.withColumn("_best", F.when(F.col("_letters"), best.cast("int")))
    tally = [F.coalesce(F.sum((F.col("_best") == i).cast("double")), F.lit(0.0)).alias(f"_h{i}") for i in range(len(languages))]
    hosts = _host_table(known.groupBy("host", "parent", "suffix").agg(*tally), languages)
    declared = _declared_table(known, languages)

    joined = known.join(hosts, ["host", "parent"]).filter(F.col("suffix").eqNullSafe(F.col("_suffix")))
    own = [(F.col("_best") == i).cast("double") for i in range(len(languages))]
    own = [F.coalesce(c, F.lit(0.0)) for c in own]
    total = sum((F.col(f"_h{i}") - own[i] for i in range(len(languages))), F.lit(0.0)) + HOST_STRENGTH
    evidence = []
    for i, name in enumerate(languages):
        prior = (F.col(f"_h{i}") - own[i] + HOST_STRENGTH * F.col(f"_p{i}")) / total
        said = F.element_at(F.create_map(*[F.lit(x) for pair in declared[name].items() for x in pair]), F.col("declared"))
        evidence.append(F.col("_text")[i] + F.log(prior) + F.col(f"_s{i}") + said)
    evidence.append(F.col("_text")[len(languages)] + F.lit(float(np.log(UNKNOWN_PRIOR))))
    top = F.array_max("_all")
    weights = F.transform("_all", lambda x: F.exp(x - F.array_max(F.col("_all"))))
    named = F.array(*[F.lit(c) for c in classes])
    posterior = joined.withColumn("_all", F.array(*evidence)).select(
        *plain,
        F.element_at(named, F.array_position("_all", top).cast("int")).alias("language"),
        (1.0 / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)).alias("probability"),
        F.when(F.col("_letters"), F.element_at(named, F.col("_best") + 1)).alias("text_language"),
        "_letters",
    )
    kept = F.col("_letters") & (F.col("language") != UNKNOWN) & (F.col("probability") >= min_probability)
    return posterior.withColumn("kept", kept).drop("_letters")


def _scored(source: DataFrame, model: np.ndarray) -> DataFrame:
    shared = source.sparkSession.sparkContext.broadcast(model)
    schema = with_columns(source, _text=ArrayType(DoubleType()), _letters=BooleanType())

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = texts(batch)
        found = [text_evidence(t, shared.value) for t in values]
        letters = [any(c.isalpha() for c in t.decode()) for t in values]
        arrays = [batch.column(n) for n in schema.names[:-2]]
        arrays += [pa.array(found, pa.list_(pa.float64())), pa.array(letters, pa.bool_())]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    return map_texts(source, each, schema)


def _host_table(hosts: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """Per host its counts ``_h``, the smoothed shares ``_p`` of its parent, and the log likelihoods ``_s`` of its suffix."""
    index = range(len(languages))
    hosts = save(hosts.withColumnRenamed("suffix", "_suffix"), "host_counts")
    sums = [F.sum(f"_h{i}").alias(f"_n{i}") for i in index]
    whole = [float(x or 0.0) for x in hosts.agg(*sums).first()]
    shares = [(x + COUNT_SMOOTHING) / (sum(whole) + COUNT_SMOOTHING * len(languages)) for x in whole]
    parents = hosts.groupBy("parent").agg(*sums)
    count = sum((F.col(f"_n{i}") for i in index), F.lit(0.0))
    parents = parents.select(
        "parent", *[((F.col(f"_n{i}") + PARENT_STRENGTH * shares[i]) / (count + PARENT_STRENGTH)).alias(f"_p{i}") for i in index]
    )
    # P(suffix | language) against P(suffix): what the suffix adds to the prior, smoothed to nothing where it is rare.
    suffixes = hosts.filter("_suffix is not null").groupBy("_suffix").agg(*sums)
    suffixes = suffixes.select(
        "_suffix",
        *[
            F.log((F.col(f"_n{i}") + PARENT_STRENGTH * shares[i]) / (count + PARENT_STRENGTH) / shares[i]).alias(f"_s{i}")
            for i in index
        ],
    )
    joined = hosts.join(parents, "parent").join(suffixes, "_suffix", "left")
    return joined.fillna(0.0, [f"_s{i}" for i in index])


def _declared_table(known: DataFrame, languages: tuple[str, ...]) -> dict[str, dict[str, float]]:
    """Log P(declared | text language), by language; at most a few values each. An absent declaration says nothing."""
    values = [*languages, "other"]
    pairs = known.filter("_best is not null and declared <> 'none'").groupBy("_best", "declared").count().collect()
    counts = {(languages[r["_best"]], r["declared"]): r["count"] for r in pairs if r["_best"] < len(languages)}
    out = {}
    for name in languages:
        row = {v: counts.get((name, v), 0) + COUNT_SMOOTHING for v in values}
        total = sum(row.values())
        out[name] = {v: float(np.log(n / total)) for v, n in row.items()} | {"none": 0.0}
    return out
