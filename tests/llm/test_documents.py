"""Document operators against brute force, over the hard cases and whole small tables."""

import binascii
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import BENCH, TEXTS, empty, frame
from pyspark.sql import functions as F

from tarifa.llm import decontaminate, graph, licenses, lines, packing, quality, queries, rules, simhash
from tarifa.llm.templates import TEMPLATES

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def whole(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def ordered(rows):
    return sorted(rows, key=str)


# Packing


def packed_ids(spark, df):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    pieces = packing.pack(df, queries.tokenizer_path(), 64).collect()
    total = sum(p["length"] for p in pieces)
    stream = {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] > 0
        assert p["offset"] + p["length"] <= 64
        filled = min(64, total - 64 * p["sequence_id"])
        assert p["padded_to"] == (filled if filled & (filled - 1) == 0 else 64)
        stream[p["sequence_id"], p["offset"]] = p, ids
    at, docs, current = 0, [], None
    for (sequence, offset), (p, ids) in sorted(stream.items(), key=lambda x: x[0]):
        assert sequence * 64 + offset == at
        at += len(ids)
        if p["start"] == 0:
            current = [p["doc_id"], p["doc_tokens"], []]
            docs.append(current)
        assert p["start"] == len(current[2]) and (p["doc_id"], p["doc_tokens"]) == (current[0], current[1])
        current[2].extend(ids.tolist())
    assert all(n == len(ids) for _, n, ids in docs)
    encode = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
    return ordered((i, ids) for i, _, ids in docs), ordered((r["doc_id"], encode(r["text"])) for r in df.collect())


def test_packing_round_trip(spark, folder):
    extra = ["It's we'll 'S <|endoftext|> a<|ENDOFTEXT|>b, 3.14!! İ ΣΑΣ. ǅ", "é. ,́", "a" * 500 + "."]
    for df in (frame(spark, TEXTS + list(enumerate(extra, 500))), spark.read.parquet(f"{folder}/documents.parquet")):
        found, wanted = packed_ids(spark, df)
        assert found == wanted


def test_packed_sequences(spark):
    pieces = packing.pack(frame(spark), queries.tokenizer_path(), 128)
    rows = packing.sequences(pieces).collect()
    assert all(len(r["ids"]) == 512 for r in rows if r["sequence_id"] < len(rows) - 1)
    assert packing.pack(empty(spark), queries.tokenizer_path()).count() == 0


# Line dedup


def lines_expected(texts, least_documents, least_points):
    split = [(t or "").split("\n") for _, t in texts]
    keys = [[lower(x.strip(SPACE)) for x in s] for s in split]
    seen = Counter(k for own in keys for k in set(own))
    out = []
    for (i, _), s, own in zip(texts, split, keys):
        gone = [len(k) >= least_points and seen[k] >= least_documents for k in own]
        out.append((i, len(s), sum(gone), "\n".join(x for x, g in zip(s, gone) if not g)))
    return ordered(out)


@pytest.mark.parametrize("size", [lines.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("documents, points", [(10, 1), (2, 0), (2, 9)])
def test_line_dedup(spark, folder, size, documents, points):
    """With the arrays copied to all tasks, and probed where they lie."""
    for texts in (TEXTS, whole(spark, folder)):
        found = lines.drop_common_lines(frame(spark, texts), documents, points, size)
        assert found.columns[-2:] == ["n_lines", "n_dropped"] and found.columns.count("n_lines") == 1
        rows = ordered((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect())
        assert rows == lines_expected(texts, documents, points)
    assert lines.drop_common_lines(empty(spark), documents, points, size).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (1, 2, 1000, 70_000):
        places = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        sizes, bits, index = lines.build_hash(places)
        assert sorted(index.tolist()) == list(range(len(places))) and bits.sum() == len(places)


# Benchmark decontamination


def contamination_expected(texts, items, span):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    out = []
    for i, text in texts:
        own = words(text)
        hit, names = set(), set()
        for name, item in items:
            w = words(item)
            size = min(span, len(w))
            runs = {tuple(w[a : a + size]) for a in range(len(w) - size + 1)} if w else set()
            for a in range(len(own) - size + 1):
                if tuple(own[a : a + size]) in runs:
                    hit |= set(range(a, a + size))
                    names.add(str(name))
        out.append((i, len(own), len(hit), tuple(sorted(names))))
    return ordered(out)


def test_decontamination(spark, folder):
    items = [(1, BENCH), (2, "tiny item"), (3, None), (4, ""), (10, BENCH), (5, "one"), (6, "a b c d e f g h i"), (7, "word " * 40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    long = [t if len(t[1] or "") < 50_000 else (t[0], t[1][:500]) for t in TEXTS]
    table = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    short = [t for t in whole(spark, folder) if len(t[1]) < 6000]
    for texts, use in ((long, items), (short, table)):
        df = frame(spark, texts)
        found = decontaminate.contamination(df, spark.createDataFrame(use, "item_id long, text string"))
        rows = ordered((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect())
        assert rows == contamination_expected(texts, use, 10)
        assert set(df.columns) <= set(found.columns)
        spans = found.select("n_hit", F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.first)").alias("n"))
        assert spans.filter("n <> n_hit").count() == 0
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    assert decontaminate.contamination(frame(spark), bench.limit(0)).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("gram", [1, 5, 10])
def test_winnowing_guarantee(gram):
    """Every shared run of the span's length gives a shared fingerprint."""
    rng = random.Random(gram)
    for _ in range(200):
        word = lambda: rng.choice([b"a", b"b", b"c"])
        run = [word() for _ in range(10)]
        texts = [[word() for _ in range(rng.randint(0, 9))] + run + [word() for _ in range(rng.randint(0, 9))] for _ in range(2)]
        a, b = (decontaminate._prints(t, 10, gram, []) for t in texts)
        assert set(a.tolist()) & set(b.tolist())


# SimHash


def fingerprint(text):
    words = [w.encode() for w in words_of(text)]
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_expected(values, radius):
    names = list(dict.fromkeys(values))
    label = {v: v for v in names}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= radius:
                label[root(a)] = root(b)
    return [root(v) for v in values]


def similar_expected(texts, radius):
    prints = [fingerprint(t) for _, t in texts]
    roots = components_expected(prints, radius)
    least = {}
    for (i, _), r in zip(texts, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return ordered((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(texts, prints, roots))


@pytest.mark.parametrize("radius, bucket", [(2, 64), (2, 1), (5, 2)])
def test_similar(spark, folder, radius, bucket):
    short = [t if len(t[1] or "") < 50_000 else (t[0], t[1][:900]) for t in TEXTS]
    for texts in (short, whole(spark, folder)):
        found = simhash.similar(frame(spark, texts), radius=radius, bucket=bucket).collect()
        assert ordered(tuple(r) for r in found) == similar_expected(texts, radius)
    assert simhash.similar(empty(spark)).count() == 0


@pytest.mark.parametrize("bucket", [64, 4])
def test_links_of_a_crowd(spark, bucket):
    """Many fingerprints around one centre: buckets are dealt again, and no pair is lost."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 500:
        values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {tuple(sorted(r)) for r in simhash.links(df, 2, bucket).collect()}
    wanted = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert found == wanted


def test_keep_one(spark, folder):
    for texts in (TEXTS, whole(spark, folder)):
        df = frame(spark, texts)
        kept = simhash.keep_one(df)
        assert kept.columns == df.columns
        rows = kept.collect()
        prints = [fingerprint(t) for _, t in texts]
        roots = components_expected(prints, 2)
        assert len(rows) == len(set(roots))
        first = {}
        for (i, _), r in zip(texts, roots):
            first[r] = min(first.get(r, (True, 0)), (i is None, i or 0))
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted(first.values())
    assert simhash.keep_one(empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(200)] + [(500 + i, 500) for i in range(50)] + [(900, 900)]
    rng.shuffle(chain)
    found = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{500 + i: 500 for i in range(50)}, 900: 900}


# License scans


def test_licenses(spark):
    body = "some words before the license " * 3
    texts = [
        (i, f"{body}{TEMPLATES[name]}\nand {body}after") for i, name in enumerate(TEMPLATES, 200)
    ] + [(300, TEMPLATES["MIT"].replace("merge, publish", "merge publish or even share").replace("sublicense", "")), (301, TEMPLATES["ISC"].upper() * 2)]
    found = licenses.scan(frame(spark, TEXTS + texts))
    names = {}
    for r in found.collect():
        names.setdefault(r["doc_id"], []).append(r)
        words = decontaminate.item_words(dict(TEXTS + texts)[r["doc_id"]].encode())
        template = decontaminate.item_words(TEMPLATES[r["license"]].encode())
        span = Counter(words[r["first_word"] : r["end_word"]])
        assert r["n_matched"] <= sum((span & Counter(template)).values())
        assert r["coverage"] == pytest.approx(r["n_matched"] / len(template), abs=1e-6) and r["coverage"] >= licenses.MIN_COVERAGE
    for i, name in enumerate(TEMPLATES, 200):
        own = {r["license"]: r for r in names[i]}
        size = len(decontaminate.item_words(TEMPLATES[name].encode()))
        assert own[name]["coverage"] == 1 and own[name]["end_word"] - own[name]["first_word"] == size
    assert names[300][0]["license"] == "MIT" and 0.95 < names[300][0]["coverage"] < 1
    assert [r["license"] for r in names[301]].count("ISC") == 2
    assert not set(names) - {i for i, _ in texts}
    assert licenses.scan(empty(spark)).count() == 0


def test_alignment_is_a_longest_subsequence():
    rng = random.Random(2)
    for _ in range(100):
        a, b = ([rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(1, 12))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        pairs = licenses.matches(a, b)
        assert len(pairs) == best[-1, -1] and all(a[i] == b[j] for i, j in pairs)
        assert pairs == sorted(set(pairs)) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)


# Quality rules


def counts_expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(runs)
    covered = {i + j for i, r in enumerate(runs) if seen[r] > 1 for j in range(3)}
    earlier, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in earlier
            earlier.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered)


def test_rules(spark, folder):
    for texts in (TEXTS, whole(spark, folder)):
        df = frame(spark, texts)
        found = rules.judge(df)
        rows = found.collect()
        assert len(rows) == len(texts) and set(found.columns) >= set(df.columns)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        got = ordered((r["doc_id"], *(r[n] for n in names)) for r in rows)
        assert got == ordered((i, *counts_expected(t)) for i, t in texts)
        for r in rows:
            failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
            assert r["base_failed"] == failed and r["kept"] == (not failed and r["posterior"] >= 0.5)
    assert rules.judge(empty(spark)).count() == 0


def test_estimate_recovers_accuracies():
    rng = np.random.default_rng(4)
    good = rng.random(20_000) < 0.7
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.6]
    votes = np.stack([np.where(rng.random(len(good)) < 0.2, 1, np.where((rng.random(len(good)) < a) == good, 2, 0)) for a in accuracy], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, rates, share = rules.estimate(patterns, counts.astype(float))
    assert share == pytest.approx(0.7, abs=0.03)
    for r, a in enumerate(accuracy):
        assert rates[r, 1, 2] / (rates[r, 1, 2] + rates[r, 1, 0]) == pytest.approx(a, abs=0.03)
    table = {tuple(p): q for p, q in zip(patterns.tolist(), posterior)}
    right = np.mean([(table[tuple(v)] >= 0.5) == g for v, g in zip(votes.tolist(), good)])
    assert right > 0.93


def test_rules_agree_with_labels(spark, folder):
    judged = rules.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = judged.join(labels, "doc_id").filter("n_words >= 50").select("kept", "quality").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in rows]) > 0.9


# Quality classifier


def test_classifier(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = queries.quality_scored(spark, folder)
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (binascii.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    right = [(r["predicted"] == known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert len(right) > 50 and np.mean(right) > 0.95


def test_classifier_cases(spark):
    labels = spark.createDataFrame([(0, 1), (9, 0), (9, None), (11, 1), (15, 0), (None, 1)], "doc_id long, quality int")
    model = quality.fit(frame(spark), labels, F.lit(True))
    found = quality.score(frame(spark), model)
    rows = found.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(abs(sum(r["attention"]) - 1) < 1e-4 for r in rows)
    assert quality.score(empty(spark), model).count() == 0
    alone = quality.fit(empty(spark), labels, F.lit(True))
    assert quality.score(frame(spark), alone).select("score").distinct().count() == 1


def test_gradients():
    rng = np.random.default_rng(1)
    x, starts, y = rng.normal(size=(7, quality.FEATURES)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])
    shapes = {"W": (quality.FEATURES, 3), "b": (3,), "V": (3, 2), "U": (3, 2), "q": (2,), "c": (3,), "d": ()}
    w = {k: rng.normal(size=s) * 0.5 for k, s in shapes.items()}

    def loss():
        p = quality._forward(w, x, starts)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, grad in quality._gradients(w, x, starts, y).items():
        flat = w[name].reshape(-1) if w[name].shape else None
        for i in range(min(3, grad.size)):
            old = float(flat[i]) if flat is not None else float(w[name])
            values = []
            for step in (1e-5, -1e-5):
                if flat is not None:
                    flat[i] = old + step
                else:
                    w[name] = np.array(old + step)
                values.append(loss())
            if flat is not None:
                flat[i] = old
            else:
                w[name] = np.array(old)
            assert np.ravel(grad)[i] == pytest.approx((values[0] - values[1]) / 2e-5, abs=1e-5)


def test_passages_of_a_long_text(monkeypatch):
    text = b"some words and more words in lines\n" * 3000
    plain = quality.bags([text, b"", b" ", b"one"])
    monkeypatch.setattr(quality, "LONG_TEXT", 20_000)
    cut = quality.bags([text, b"", b" ", b"one"])
    assert [len(b) for b in plain] == [len(b) for b in cut] == [210, 1, 1, 1]
    assert all(np.allclose(a, b, rtol=0, atol=1e-12) for a, b in zip(plain, cut))


def test_passages_are_their_text_alone():
    """Neighbours, their order and the white space between them change no feature of a text."""
    own = [(t or "").encode() for _, t in TEXTS] + [b"\n \n lead and trail \n\n", b"a " * 250 + b"\t\t"]
    alone = [quality.bags([t])[0] for t in own]
    blanks = [x for t in own for x in (t, b"\n" * 3000, b" \t" * 50)]
    for batch, step in ((own, 1), (own[::-1], 1), (blanks, 3)):
        found = quality.bags(batch)[::step]
        wanted = alone[::-1] if batch == own[::-1] else alone
        assert all(len(a) == len(b) and np.allclose(a, b, rtol=0, atol=1e-12) for a, b in zip(found, wanted))


def test_scores_are_functions_of_the_text(spark):
    labels = spark.createDataFrame([(0, 1), (9, 0), (11, 1), (15, 0)], "doc_id long, quality int")
    model = quality.fit(frame(spark), labels, F.lit(True))
    scores = lambda texts: {r["doc_id"]: r["score"] for r in quality.score(frame(spark, texts), model).collect() if r["doc_id"] is not None}
    wanted = scores(TEXTS)
    followed = [x for t in TEXTS for x in (t, (10_000 + len(t[1] or ""), "\n" * 3000))]
    for texts in (TEXTS[::-1], followed):
        found = scores(texts)
        assert all(abs(found[i] - s) < 1e-12 for i, s in wanted.items())


def test_training_rows_are_bounded():
    bag = np.random.default_rng(3).random((1001, quality.FEATURES))
    small = quality.pooled(bag, 10)
    assert small.shape == (10, quality.FEATURES) and np.allclose(small[0], bag[:100].mean(axis=0))
    assert quality.pooled(bag[:9], 10) is not None and np.array_equal(quality.pooled(bag[:9], 10), bag[:9])

