"""Language-model scores against a model kept in plain dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tarifa.llm import ppm

END = 256


def events(words):
    """Per word, and for the end, the symbols with their chains of contexts, longest first."""
    before = b"   "
    for word in [*words, None]:
        far, near = ppm.pair(before[0], before[1]), ppm.pair(before[1], before[2])
        if word is None:
            yield "first", [(far, before[2]), (before[2],), ()], END, None
            return
        yield "first", [(far, before[2]), (before[2],), ()], word[0], None
        spelled = word + b" "
        yield "second", [(near, word[0]), (word[0],), ()], spelled[1], word
        for i in range(2, len(spelled)):
            yield "rest", word[:i], spelled[i], word
        before = (before + b" " + word)[-3:]


def low_chain(before):
    return [(ppm.pair(before[-3], before[-2]), before[-1]), (before[-1],), ()]


class Model:
    """Counts of the training texts, and probabilities from their definition."""

    def __init__(self, texts):
        self.counts = {"first": defaultdict(Counter), "second": defaultdict(Counter), "rest": defaultdict(Counter), "low": defaultdict(Counter)}
        seen = set()
        for text in texts:
            words = text.encode().lower().split()
            for kind, chain, symbol, word in events(words):
                if kind == "rest":
                    if len(chain) < ppm.MAX_ORDER:
                        self.counts[kind][chain][symbol] += 1
                else:
                    for context in chain:
                        self.counts[kind][context][symbol] += 1
            seen.update(words)
        for word in seen:
            spelled = b"  " + word + b" "
            for i in range(3, len(spelled)):
                for context in low_chain(spelled[:i]):
                    self.counts["low"][context][spelled[i]] += 1

    def chain(self, kind, contexts, symbol):
        p, hidden = 1.0, set()
        for context in contexts:
            live = {s: n for s, n in self.counts[kind].get(context, {}).items() if s not in hidden}
            if not live:
                continue
            total, distinct = sum(live.values()), len(live)
            if symbol in live:
                return p * live[symbol] / (total + distinct)
            p *= distinct / (total + distinct)
            hidden |= set(live)
        return p / max(1, 257 - len(hidden))

    def score(self, text):
        words, total = text.encode().lower().split(), 0.0
        for kind, chain, symbol, word in events(words):
            if kind != "rest":
                total += math.log10(self.chain(kind, chain, symbol))
                continue
            low = low_chain(b"  " + chain)
            live = self.counts["rest"].get(chain, {}) if len(chain) < ppm.MAX_ORDER else {}
            t, d = sum(live.values()), len(live)
            if symbol in live:
                total += math.log10(live[symbol] / (t + d))
            else:
                p = self.chain("low", low, symbol)
                if live:
                    p *= d / (t + d) / (1 - sum(self.chain("low", low, s) for s in live))
                total += math.log10(p)
        return total


TEXTS = [
    (1, "The cat sat on the mat. The CAT sat"), (2, "a the cat on a hat"), (3, ""), (4, None), (5, "  \n\t "), (6, "ünïcode ünï the"),
    (7, "x" * 60 + " tail"), (8, "zebra unseen words here"), (9, "the the the the"), (9, "the the the the"), (None, "no id here"),
    (11, "x" * 59 + "y x"), (12, "cats sat mats"),
]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def expected(rows):
    train = [t or "" for i, t in rows if not held_out(i)]
    model = Model(train)
    counts = Counter(w for t in train for w in t.encode().lower().split())
    total, distinct = sum(counts.values()) + len(train), len(counts) + bool(train)
    below = total + 0.5 * (distinct + 1)
    out = []
    for i, text in rows:
        words = (text or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 0.5) / below) for w in words) + math.log10((len(train) + 0.5) / below)
        out.append((i, len(words) + 1, sum(counts[w] > 0 for w in words) + bool(train), total, base, model.score(text or "")))
    return out


def check(found, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    found = sorted((tuple(r) for r in found), key=key)
    wanted = sorted(wanted, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    for a, b in zip(found, wanted):
        assert a[4:] == pytest.approx(b[4:], rel=1e-4, abs=1e-4), (a, b)


def run(df):
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    found = ppm.score(df, F.coalesce(remainder != 1, F.lit(True)))
    return found.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()


@pytest.mark.parametrize("top, size", [(200_000, 100_000), (3, 4)])
def test_scores(spark, monkeypatch, top, size):
    """Also with few words kept at hand and many small ranges, so that prefixes cross borders."""
    monkeypatch.setattr(ppm, "TOP_WORDS", top)
    monkeypatch.setattr(ppm, "RANGE_WORDS", size)
    df = spark.createDataFrame([(i, t, "x") for i, t in TEXTS], "doc_id long, text string, score string")
    check(run(df), expected(TEXTS))


def test_whole_table(spark, folder, monkeypatch):
    monkeypatch.setattr(ppm, "TOP_WORDS", 500)
    monkeypatch.setattr(ppm, "RANGE_WORDS", 1000)
    df = spark.read.parquet(f"{folder}/documents.parquet")
    check(run(df), expected([(r["doc_id"], r["text"]) for r in df.collect()]))


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []
