"""The posterior of language identification against its definition, in plain Python over all evidence."""

import math
from collections import Counter, defaultdict

import pytest

from tarifa.llm import language

LANGUAGES = ("de", "en")
TEXTS = {
    "de": "der hund und die katze sind nicht im haus und der garten ist gross",
    "en": "the dog and the cat are not in the house and the garden is large",
}


def rows():
    """Text, declared, host, parent, suffix: agreeing, contradicting, missing and rare evidence."""
    out = []
    for i in range(30):
        own = "de" if i % 3 else "en"
        words = TEXTS[own].split()
        text = " ".join(words[i % 5 :] + words[: i % 4])
        declared = [own, own.upper() + "-AT", None, "fr", "en", ""][i % 6]
        host = ["a.one.de", "b.one.de", "two.com", None][i % 4]
        parent = {"a.one.de": "one.de", "b.one.de": "one.de", "two.com": "two.com", None: None}[host]
        suffix = None if host is None else host.split(".")[-1]
        out.append((i, text, declared, host, parent, suffix))
    extra = [(100, None, "de", "a.one.de", "one.de", "de"), (101, "", None, None, None, None), (102, "123 456", "en", "two.com", "two.com", "com"),
             (103, "漢字漢字漢字漢字", None, "rare.org", "rare.org", "org"), (104, "der the", "de", "a.one.de", "one.de", "de")]
    return out + extra + [extra[-1]]


def declared_of(value):
    tag = "".join(c for c in (value or "").strip().split("-")[0]).lower()
    return "none" if not tag else tag if tag in LANGUAGES else "other"


def expected(table):
    size = 1 << language.BUCKET_BITS
    counts = {name: Counter() for name in LANGUAGES}
    for _, text, declared, *_ in table:
        if declared_of(declared) in counts:
            counts[declared_of(declared)].update(language.trigram_buckets((text or "").encode()).tolist())
    smooth = language.COUNT_SMOOTHING * 0.01
    totals = {n: sum(c.values()) + smooth * size for n, c in counts.items()}

    def evidence(text):
        buckets = language.trigram_buckets((text or "").encode()).tolist()
        if len(buckets) <= 1:
            return [0.0] * (len(LANGUAGES) + 1)
        sums = [sum(math.log((counts[n][b] + smooth) / totals[n]) for b in buckets) for n in LANGUAGES]
        sums.append(-len(buckets) * math.log(size))
        sums = [s / (1 + len(buckets) / language.TEXT_EVIDENCE) for s in sums]
        return [s - max(sums) for s in sums]

    seen = []
    for i, text, declared, host, parent, suffix in table:
        own, letters = evidence(text), any(c.isalpha() for c in text or "")
        best = own.index(max(own)) if letters else None
        seen.append((i, own, letters, best, declared_of(declared), host or "", parent or host or "", suffix))
    k = range(len(LANGUAGES))
    by = lambda at: defaultdict(Counter, {v: Counter(s[3] for s in seen if s[at] == v and s[3] in k) for v in {s[at] for s in seen}})
    hosts, parents, suffixes = by(5), by(6), by(7)
    whole = Counter(s[3] for s in seen if s[3] in k)
    shares = [(whole[i] + language.COUNT_SMOOTHING) / (sum(whole.values()) + language.COUNT_SMOOTHING * len(LANGUAGES)) for i in k]
    smoothed = lambda c, i: (c[i] + language.PARENT_STRENGTH * shares[i]) / (sum(c.values()) + language.PARENT_STRENGTH)
    said = Counter((s[3], s[4]) for s in seen if s[3] in k and s[4] != "none")

    def declaration(i, value):
        if value == "none":
            return 0.0
        values = [*LANGUAGES, "other"]
        row = {v: said[i, v] + language.COUNT_SMOOTHING for v in values}
        return math.log(row[value] / sum(row.values()))

    out = []
    for i, own, letters, best, declared, host, parent, suffix in seen:
        counted = {j: hosts[host][j] - (best == j) for j in k}
        total = sum(counted.values()) + language.HOST_STRENGTH
        logs = [
            own[j]
            + math.log((counted[j] + language.HOST_STRENGTH * smoothed(parents[parent], j)) / total)
            + (math.log(smoothed(suffixes[suffix], j) / shares[j]) if suffix is not None else 0.0)
            + declaration(j, declared)
            for j in k
        ]
        logs.append(own[-1] + math.log(language.UNKNOWN_PRIOR))
        top = max(logs)
        name = [*LANGUAGES, language.UNKNOWN][logs.index(top)]
        probability = 1 / sum(math.exp(x - top) for x in logs)
        kept = letters and name != language.UNKNOWN and probability >= language.MIN_PROBABILITY
        out.append((i, name, probability, [*LANGUAGES, language.UNKNOWN][best] if letters else None, kept))
    return sorted(out, key=str)


def test_posterior(spark):
    table = rows()
    df = spark.createDataFrame(table, "id long, text string, declared string, host string, parent string, suffix string")
    found = language.identify(df.repartition(3), LANGUAGES).select("id", "language", "probability", "text_language", "kept").collect()
    wanted = expected(table)
    found = sorted(map(tuple, found), key=str)
    assert len(found) == len(wanted)
    assert [(f[0], f[1], f[3], f[4]) for f in found] == [(w[0], w[1], w[3], w[4]) for w in wanted]
    assert [f[2] for f in found] == pytest.approx([w[2] for w in wanted], abs=1e-9)
    assert {w[1] for w in wanted} == {"de", "en", "und"}
