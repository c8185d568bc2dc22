"""The ids of words by the tokenizer's model, and how many words a task remembers."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tarifa.llm import packing, queries


@pytest.fixture
def encoder(monkeypatch):
    monkeypatch.setattr(packing, "_encoders", {})
    return lambda: packing._encoder(queries.tokenizer_path())


def test_words_as_the_tokenizer_has_them(encoder, monkeypatch):
    """Also when most words are forgotten again, and with parts of one word."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "KNOWN_WORDS", 40)
    rng = random.Random(3)
    marks = "".join(map(chr, range(1, 128))) + "ßàéöøÿ×÷ÀÉÞªºµŁſıΣςǺ   ǅ"
    plain = ["the", "été.", "straße,", "it's", "A.B", "'ll", "<|endoftext|>", "x<|endoftext|>y", "<|ENDOFTEXT|>", "14,5", "k" * 60]
    words = plain + ["".join(rng.choices(marks, k=rng.randrange(1, 9))) for _ in range(400)]
    texts = [None, "", " \t"] + ["".join(w + rng.choice([" ", "\n", "  ", "\r\n"]) for w in rng.choices(words, k=30)) for _ in range(200)]
    encode, tokenizer = encoder(), Tokenizer.from_file(queries.tokenizer_path())
    for start in (0, 50, 100, 150, 0):
        own = texts[start : start + 53]
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encode(pa.array(["left out", *own], pa.string())[1:])]
        assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in own]


def test_remembered_words_are_bounded(encoder):
    """Distinct words without end, with a mark each: a task holds less than two tasks of an executor can afford."""
    encode, letters = encoder(), "abcdefgh"
    encode(pa.array(["a"]))
    tracemalloc.start()
    try:
        for i in range(8):
            words = (f"{''.join(letters[int(d)] for d in oct(j)[2:])}," for j in range(i * 80_000 + 10**6, (i + 1) * 80_000 + 10**6))
            encode(pa.array([" ".join(words)]))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 120 << 20
