"""The registered queries of the document operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.llm import credentials, decontaminate, language, licenses, lines, packing, ppm, quality, resampling, rules, simhash, subvectors, suffixes
from tarifa.llm.oracles import ORACLES  # noqa: F401
from tarifa.sources.tables import read_table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _remainder(parts: int) -> Column:
    """The CRC-32 of the id as text, modulo ``parts``; -1 without an id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(parts)), F.lit(-1))


def document_evidence(docs: DataFrame) -> DataFrame:
    """``docs`` with the evidence columns of language identification: their declared language and, as host, their source."""
    nothing = F.lit(None).cast("string")
    return docs.withColumns({"declared": F.col("lang"), "host": F.col("source"), "parent": nothing, "suffix": nothing})


def document_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return language.identify(document_evidence(docs)).drop("text").withColumn("probability", F.round("probability", 9))


def page_languages(spark: SparkSession, folder: str) -> DataFrame:
    """The same over web pages, with declared markup language, host, parent domain and address suffix."""
    pages = read_table(spark, folder, "pages")
    fields = {**language.page_fields(F.col("html")), **language.address_parts(F.col("url"))}
    found = language.identify(pages.select("page_id", *[c.alias(n) for n, c in fields.items()]))
    return found.drop("text").withColumn("probability", F.round("probability", 9))


def licenses_found(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read_table(spark, folder, "documents"))


def scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = _remainder(5) == 1
    found = ppm.score(read_table(spark, folder, "documents"), ~held_out)
    return found.withColumn("held_out", ~F.col("train")).drop("train")


def repeats_dropped(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.drop_repeats(read_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def rules_judged(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.judge(read_table(spark, folder, "documents").select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *counts, "base_failed", "kept", F.round("posterior", 9).alias("posterior"))


def quality_scored(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    held_out = _remainder(4) == 2
    model = quality.fit(docs, read_table(spark, folder, "labels"), ~held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def packed(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, folder, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def lines_dropped(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_common_lines(read_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def contaminated(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.similar(read_table(spark, folder, "documents"))


def clustered(spark: SparkSession, folder: str) -> DataFrame:
    return subvectors.cluster(read_table(spark, folder, "embeddings"))


def secrets_found(spark: SparkSession, folder: str) -> DataFrame:
    found = credentials.scan(read_table(spark, folder, "documents").select("doc_id", "text"))

    def base(span: Column) -> Column:
        return span["kind"].isin(*credentials.BASE_KINDS)

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(listed(F.filter("secrets", base)), 256).alias("base_sha256")
    return found.select("doc_id", *map(count, credentials.BASE_KINDS), digest, listed(F.col("secrets")).alias("spans"))


def resampled(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")).drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": document_languages,
    "op2_license_scan": licenses_found,
    "op3_packing": packed,
    "op4_ppm_score": scores,
    "op5_suffix_array_dedup": repeats_dropped,
    "op6_quality_rules": rules_judged,
    "op7_line_dedup": lines_dropped,
    "op8_benchmark_decontamination": contaminated,
    "op9_simhash_near_dedup": near_copies,
    "op10_quality_classifier": quality_scored,
    "op11_centroid_clustering": clustered,
    "op12_secret_scan": secrets_found,
    "op13_importance_resampling": resampled,
    "pages_language_id": page_languages,
}
