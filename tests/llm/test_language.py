"""Language identification: accuracy, its evidence one by one, and the hard cases."""

import numpy as np
import pytest
from cases import TEXTS, empty, frame
from pyspark.sql import functions as F

from tarifa.llm import language, queries

NAMES = {
    "en": "the cat and the dog were in the house with all of their friends and that was good",
    "de": "der hund und die katze waren im haus mit allen ihren freunden und das war gut",
    "fr": "le chat et le chien étaient dans la maison avec tous leurs amis et cela était bon",
    "es": "el gato y el perro estaban en la casa con todos sus amigos y eso era bueno",
}


def evidence(spark, rows):
    schema = "doc_id long, text string, declared string, host string, parent string, suffix string"
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema).repartition(3)


def table(spark):
    """Rows of four languages on hosts of their own, enough to learn from."""
    rows = []
    for name, text in NAMES.items():
        words = text.split()
        for i in range(30):
            turned = " ".join(words[i % len(words) :] + words[: i % len(words)])
            rows.append((turned, name, f"{name}{i % 3}.example.{name}", f"example.{name}", name))
    return rows


def test_every_evidence_counts(spark):
    rows = table(spark) + [
        ("xq zk", "fr", None, None, None),  # the declaration alone
        ("w", None, "de0.example.de", "example.de", "de"),  # the host
        ("w", None, "new.example.es", "example.es", "es"),  # its parent and suffix
        ("w", None, "other.org.fr", "org.fr", "fr"),  # the suffix
        (NAMES["de"] * 3, "fr", "fr0.example.fr", "example.fr", "fr"),  # a long text against the rest
        ("", "de", None, None, None), (None, None, None, None, None), ("12 34 !!", "en", None, None, None),
        (NAMES["en"], "EN-us", "en0.example.en", "example.en", "en"), (NAMES["en"], "klingon", None, None, None),
    ]
    found = {r["doc_id"]: r for r in language.identify(evidence(spark, rows)).collect()}
    own = list(NAMES)
    assert all(found[i]["language"] == own[i // 30] and found[i]["kept"] for i in range(120))
    assert [found[120 + i]["language"] for i in range(5)] == ["fr", "de", "es", "fr", "de"]
    assert found[125]["language"] == "de" and not found[125]["kept"]
    assert not found[126]["kept"] and not found[127]["kept"]
    assert found[128]["language"] == found[129]["language"] == "en"
    assert all(0 < r["probability"] <= 1 for r in found.values())


def test_hierarchy_of_priors(spark):
    """A new host of a known parent gets a prior between the parent's share and the whole table's."""
    rows = table(spark) + [("w", None, "fresh.example.de", "example.de", None), ("w", None, "fresh.unseen.zz", "unseen.zz", None)]
    found = {r["doc_id"]: r for r in language.identify(evidence(spark, rows)).collect()}
    assert found[120]["language"] == "de" and found[120]["probability"] > found[121]["probability"]


def test_cases(spark):
    df = queries.document_evidence(frame(spark))
    rows = language.identify(df).collect()
    assert len(rows) == len(TEXTS)
    blank = {i for i, t in TEXTS if not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in rows if r["text_language"] is None} == blank
    assert not any(r["kept"] for r in rows if r["doc_id"] in blank)
    assert language.identify(queries.document_evidence(empty(spark))).count() == 0


def test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = queries.document_languages(spark, folder).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert np.mean([r["language"] == r["lang"] for r in rows]) > 0.97
    assert np.mean([r["text_language"] == r["lang"] for r in rows]) > 0.95
    assert np.mean([r["kept"] for r in rows]) > 0.97


def test_pages(spark, folder):
    rows = queries.page_languages(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/pages.parquet").count()
    assert np.mean([r["kept"] for r in rows]) > 0.97


def test_addresses_and_markup(spark):
    urls = {
        "https://user@Blog.Example.CO.uk:80/a?b#c": ("blog.example.co.uk", "co.uk", "uk"),
        "http://host/": ("host", "host", None), "nonsense": (None, None, None), None: (None, None, None), "": (None, None, None),
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    parts = language.address_parts(F.col("url"))
    found = {r["url"]: (r["host"], r["parent"], r["suffix"]) for r in df.select("url", *[c.alias(n) for n, c in parts.items()]).collect()}
    assert found == urls
    html = "<!DOCTYPE html><HTML class=x lang='de-AT'><script>var t='<p>no</p>';</script><!-- no --><p>ja\n<b>gut</b></p></HTML>"
    row = spark.createDataFrame([(html,), ("plain",), (None,)], "html string")
    fields = language.page_fields(F.col("html"))
    found = [tuple(r) for r in row.select(*[c.alias(n) for n, c in fields.items()]).collect()]
    assert (found[0][0], found[0][1].split()) == ("de-AT", ["ja", "gut"])
    assert found[1:] == [(None, "plain"), (None, None)]


@pytest.mark.parametrize("text", [b"", b"a", b"ab", b"some words", b"\xc3\xa9" * 40])
def test_text_evidence_is_relative(text):
    model = np.log(np.full((5, 1 << language.BUCKET_BITS), 2.0**-language.BUCKET_BITS))
    assert language.text_evidence(text, model).tolist() == [0.0] * 5
