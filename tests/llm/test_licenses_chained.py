"""Licenses with words inserted or removed in the middle are found whole."""

import random

import pytest

from tarifa.llm import licenses
from tarifa.llm.decontaminate import item_words
from tarifa.llm.templates import TEMPLATES

INDEX = licenses.Index(TEMPLATES)


def scanned(words):
    return {f[0]: f for f in licenses.scan_text(b" ".join(words), INDEX, licenses.MIN_COVERAGE)}


@pytest.mark.parametrize("name", list(TEMPLATES))
@pytest.mark.parametrize("count", [10, 20, 40, 70, 100, 200, 500, 20_000])
def test_inserted_and_removed_words(name, count):
    words = item_words(TEMPLATES[name].encode())
    if count > max(20, len(words)) and len(words) < 60:
        pytest.skip("half a notice of few words shares too few fingerprints for a step across more words than it has")
    half = len(words) // 2
    around = [b"around%d" % i for i in range(50)]
    found = scanned(around + words[:half] + [b"new%d" % i for i in range(count)] + words[half:] + around)[name]
    assert found[1:] == (50, 50 + len(words) + count, len(words), 1)
    if count <= 0.3 * len(words):
        left = words[: half - count // 2] + words[half - count // 2 + count :]
        found = scanned(around + left + around)[name]
        assert found[3] == len(left) and found[1:3] == (50, 50 + len(left))


def test_pairs_ascend_and_match():
    rng = random.Random(4)
    for name, template in INDEX.words.items():
        words = [w for w in template if rng.random() < 0.9] * 2
        for at in sorted(rng.sample(range(len(words)), 5)):
            words[at:at] = [b"x"] * rng.randrange(20)
        for own, chain in INDEX.chains(words):
            pairs = licenses.filled(INDEX.words[own], words, chain)
            assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
            assert all(INDEX.words[own][i] == words[j] for i, j in pairs)


def longest(a, b):
    """The length of the longest common subsequence, by the textbook."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_coverage_is_that_of_the_best_alignment():
    """Against a full alignment of template and text, with words changed, removed and inserted everywhere, and
    two long insertions."""
    rng = random.Random(13)
    for name, template in INDEX.words.items():
        if len(template) < 60:
            continue
        for _ in range(3):
            words = []
            for at, word in enumerate(template):
                draw = rng.random()
                words += [] if draw < 0.04 else [b"changed"] if draw < 0.08 else [word]
                wide = {len(template) // 3: 90, 2 * len(template) // 3: 300}.get(at, 0)
                words += [b"in%d" % rng.randrange(50) for _ in range(wide or rng.choice([0] * 30 + [3]))]
            found = scanned([b"around"] * 30 + words + [b"around"] * 30)
            wanted = longest(template, words)
            assert name in found and wanted - 0.02 * len(template) <= found[name][3] <= wanted
            assert 30 <= found[name][1] < found[name][2] <= 30 + len(words)


def test_copies_with_insertions_stay_apart():
    words = item_words(TEMPLATES["MIT"].encode())
    half = len(words) // 2
    one = words[:half] + [b"new%d" % i for i in range(150)] + words[half:] + [b"between"] * 400
    found = [f for f in licenses.scan_text(b" ".join(one * 3), INDEX, licenses.MIN_COVERAGE) if f[0] == "MIT"]
    assert [f[3] for f in sorted(found, key=lambda f: f[1])] == [len(words)] * 3


def test_many_copies():
    words = item_words(TEMPLATES["MIT"].encode())
    found = licenses.scan_text(b" ".join(words * 30), INDEX, licenses.MIN_COVERAGE)
    assert [f[3] for f in found if f[0] == "MIT"] == [len(words)] * 30
