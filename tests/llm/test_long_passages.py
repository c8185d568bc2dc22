"""Passages longer than the limit of a text that is described at once enter the features with all their bytes."""

import random

import numpy as np

from tarifa.llm import quality


def test_giant_words(monkeypatch):
    rng = random.Random(6)
    giant = bytes(rng.choices(b"ABCDEFGHIJKLMNOP", k=30_000)) + b"0123456789" * 5_000
    plain = b" some words, of any kind. " * 70
    texts = [giant, b" \n" + giant + b" ", plain + giant + plain, giant + b"\t" + giant + plain, b" " * 60_000, b"short one"]
    wanted = [quality.bags([t])[0] for t in texts]
    monkeypatch.setattr(quality, "LONG_TEXT", 4_000)
    monkeypatch.setattr(quality, "PASSAGE_CHUNK", 1_000)
    found = [quality.bags([t])[0] for t in texts]
    assert [len(f) for f in found] == [len(w) for w in wanted]
    for one, two in zip(found, wanted):
        np.testing.assert_allclose(one, two, rtol=1e-9, atol=1e-12)
