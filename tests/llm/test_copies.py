"""Copied texts in the pipeline: one document of each group stays, with its text."""

import random

import pytest
from cases import TEXTS, empty, frame
from test_documents import SPACE, lower, ordered, whole, words_of

import corpus_pipeline as pipeline
from tarifa.llm import copies, lines

GROUPS = [[(1000 * g + i, f"first line of text {g}\n}}\nsecond line of text {g}\n}}\nend of {g}") for i in range(12)] for g in range(3)]
OTHERS = [(None, GROUPS[0][0][1]), (7000, "own line\n}\nlast"), (7000, "other line of the same id\n}"), (7001, None), (7002, "")]


def first_kept(texts, least_documents):
    """Brute force for distinct pairs of id and text."""
    holders = {}
    for i, text in texts:
        for key in {lower(x.strip(SPACE)) for x in (text or "").split("\n")} - {""}:
            holders.setdefault(key, []).append((i is None, i or 0, text))
    out = []
    for i, text in texts:
        kept = []
        for line in (text or "").split("\n"):
            own = holders.get(lower(line.strip(SPACE)), [])
            if len(own) < least_documents or min(own) == (i is None, i or 0, text):
                kept.append(line)
        out.append((i, "\n".join(kept)))
    return ordered(out)


@pytest.mark.parametrize("size", [lines.BROADCAST_BYTES, 0])
def test_first_document_keeps_common_lines(spark, size):
    texts = [row for group in GROUPS for row in group] + OTHERS
    found = lines.drop_common_lines(frame(spark, texts), broadcast_bytes=size, keep_first=True)
    assert ordered((r["doc_id"], r["text"]) for r in found.collect()) == first_kept(texts, 10)


def test_copied_texts_survive_once(spark, folder):
    stages = dict(pipeline.STAGES)
    # Without the braces that all groups share.
    groups = [[(i, t.replace("}", "mid of " + t[-1])) for i, t in group] for group in GROUPS]
    docs = frame(spark, [row for group in groups for row in group])
    kept = stages["near_copies"](spark, stages["lines"](spark, docs, folder), folder)
    texts = [(r["doc_id"], r["text"]) for r in kept.collect() if r["text"]]
    assert ordered(texts) == ordered(group[0] for group in groups)


def groups_expected(texts):
    """Brute force over all pairs; also how many unequal ones are similar."""
    sets = []
    for _, text in texts:
        words = words_of(text)
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    label, similar = list(range(len(sets))), 0

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b)):
                similar += a != b
                label[root(i)] = root(j)
    first = {}
    for at, (i, _) in enumerate(texts):
        first[root(at)] = min(first.get(root(at), (True, 0)), (i is None, i or 0))
    return sorted(first.values()), similar


def varied(rng):
    """Families of texts with some words of a common text replaced, from almost equal to hardly alike."""
    texts = []
    for family in range(6):
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(30):
            own = list(words)
            for at in rng.sample(range(len(own)), rng.randrange(9)):
                own[at] = f"new{rng.randrange(10**6)}"
            texts.append((family * 100 + len(texts), " ".join(own)))
    return texts


def test_one_of_each_group(spark, folder):
    """Against all pairs: none of those that are similar enough is lost, and short texts that share a line stay apart."""
    shared = [(9000 + i, f"the same opening line for all of them\nthen {i}") for i in range(5)]
    for texts in (varied(random.Random(8)) + shared, TEXTS, whole(spark, folder)):
        wanted, _ = groups_expected(texts)
        kept = copies.keep_one(frame(spark, texts))
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == wanted
    assert copies.keep_one(empty(spark)).count() == 0


def test_stage_finds_similar_texts(spark, folder):
    texts = varied(random.Random(9))
    wanted, similar = groups_expected(texts)
    kept = dict(pipeline.STAGES)["near_copies"](spark, frame(spark, texts), folder)
    assert similar > 200 and sorted((False, r["doc_id"]) for r in kept.collect()) == wanted


def test_simhash_proposes_copies(spark, folder, monkeypatch):
    """The stage links texts by SimHash components and an exact check; equal fingerprints of unlike sets link nothing."""
    texts = varied(random.Random(10))
    wanted, _ = groups_expected(texts)
    asked, named = [], copies.simhash.named
    monkeypatch.setattr(copies.simhash, "named", lambda *a, **k: asked.append(1) or named(*a, **k))
    kept = dict(pipeline.STAGES)["near_copies"](spark, frame(spark, texts), folder)
    assert asked and sorted((False, r["doc_id"]) for r in kept.collect()) == wanted
    nodes = spark.createDataFrame([(1, 7), (2, 7), (3, 6), (4, -1), (5, 7)], "node long, fp long")
    assert sorted(map(tuple, copies.alike(nodes).collect())) == [(1, 2), (1, 3), (1, 5)]
    monkeypatch.setattr(copies.simhash, "majority", lambda hashes: 5)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in copies.keep_one(frame(spark, texts)).collect()) == wanted
