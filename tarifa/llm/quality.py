"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages and only the document has a label. Each passage is encoded (features, then one hidden layer), gated
attention gives it a weight, and the document is scored from the weighted sum of its passage encodings. Training takes a bounded
sample of labelled documents; scoring runs over all passages of all documents inside the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType

from tarifa.llm.text import map_texts, texts, with_columns

PASSAGE_WORDS = 100
# Labelled documents that training takes at most, chosen by a hash of their id.
TRAINING_DOCUMENTS = 3000
# Rows of features that a training document gives at most; neighbouring passages of a longer one are averaged.
TRAINING_PASSAGES = 64
THRESHOLD = 0.7
HIDDEN = 16
GATES = 8
EPOCHS = 200
STEP = 0.02
DECAY = 1e-4
SEED = 7

# Byte classes whose shares describe a passage.
_GROUPS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\x0b\x0c\r", b"\n", b".", b",", b"!?", b"'\"-:;()",
    b"#*$%&", b"|<>", b"/\\@=_+~^{}[]`", bytes(range(128, 256)), bytes(range(0, 9)),
)
_CLASSES = np.stack([np.isin(np.arange(256), list(group)) for group in _GROUPS], axis=1).astype(np.float64)
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
FEATURES = len(_GROUPS) + 10
# Longer texts are described in parts, so that the arrays of one part stay small.
LONG_TEXT = 8 << 20
# Bytes of a passage longer than that which are counted at once.
PASSAGE_CHUNK = 1 << 20


def bags(texts_: list[bytes], size: int = PASSAGE_WORDS) -> list[np.ndarray]:
    """Per text, one row of features per passage of ``size`` words; a text without words is one passage of zeros."""
    if sum(map(len, texts_)) > LONG_TEXT and len(texts_) > 1:
        half = len(texts_) // 2
        return bags(texts_[:half], size) + bags(texts_[half:], size)
    if texts_ and len(texts_[0]) > LONG_TEXT:
        parts = [_long_passage(p) if len(p) > LONG_TEXT else bags([p], size)[0] for p in _parts(texts_[0], size)]
        return [np.concatenate(parts)]
    words = [t.split() for t in texts_]
    runs = [w[i : i + size] for w in words for i in range(0, len(w), size)]
    counts = np.array([-(-len(w) // size) for w in words], np.int64)
    found = np.zeros((len(runs), FEATURES))
    if runs:
        found[:, : len(_GROUPS) + 6] = _shares(texts_, words, size)
        found[:, len(_GROUPS) + 6 :] = [_repetition(run) for run in runs]
    rows = np.split(found, np.cumsum(counts)[:-1])
    return [r if len(r) else np.zeros((1, FEATURES)) for r in rows]


def _word_starts(text: bytes) -> np.ndarray:
    blank = np.concatenate([[True], _BLANK[np.frombuffer(text, np.uint8)]])
    return np.flatnonzero(blank[:-1] & ~blank[1:])


def _parts(text: bytes, size: int) -> list[bytes]:
    """A long text cut where passages start, into parts of about half ``LONG_TEXT``; a passage alone may be longer."""
    cuts = _word_starts(text)[::size]
    number = cuts // (LONG_TEXT // 2)
    firsts = cuts[np.flatnonzero(np.diff(number, prepend=-1))] if len(cuts) else cuts
    edges = [0, *firsts[1:].tolist(), len(text)]
    parts = [text[a:b] for a, b in zip(edges, edges[1:])]
    return [cut for p in parts for cut in ([p] if len(p) <= LONG_TEXT else _passages(p, size))]


def _passages(text: bytes, size: int) -> list[bytes]:
    edges = [0, *_word_starts(text)[::size][1:].tolist(), len(text)]
    return [text[a:b] for a, b in zip(edges, edges[1:])]


def _long_passage(text: bytes) -> np.ndarray:
    """The features of one passage, tallied chunk by chunk so that only small arrays are held besides the text."""
    words = text.split()
    if not words:
        return np.zeros((1, FEATURES))
    data = np.frombuffer(text, np.uint8)[len(text) - len(text.lstrip()) :]
    tally = np.zeros((1, 256), np.int64)
    for start in range(0, len(data), PASSAGE_CHUNK):
        tally[0] += np.bincount(data[start : start + PASSAGE_CHUNK], minlength=256)
    lengths = np.array([len(w) for w in words], np.int64)
    return np.column_stack([_described(tally, lengths, np.zeros(1, np.int64)), [_repetition(words)]])


def _shares(texts_: list[bytes], words: list[list[bytes]], size: int) -> np.ndarray:
    """Byte classes, spread of bytes and word lengths of all passages."""
    data = np.frombuffer(b"\n".join(texts_), np.uint8)
    blank = np.concatenate([[True], _BLANK[data], [True]])
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    lengths = np.flatnonzero(~blank[:-1] & blank[1:]) - starts
    first = np.concatenate([np.arange(0, len(w), size) + before for w, before in zip(words, np.cumsum([0, *map(len, words[:-1])]))])
    first = first.astype(np.int64)
    own = np.repeat(np.arange(len(texts_)), [-(-len(w) // size) for w in words])
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts_]) - 1
    begins = starts[first]
    # A passage ends where the next one of its text begins, the last one with its text, whatever comes after that.
    ends = np.where(np.diff(own, append=-1) == 0, np.append(begins[1:], 0), ends_of_texts[own])
    gaps = np.append(begins[1:], len(data)) - ends
    place = np.stack([np.arange(len(first), dtype=np.int32), np.full(len(first), len(first), np.int32)], axis=1)
    owner = np.repeat(place.ravel(), np.stack([ends - begins, gaps], axis=1).ravel())
    at = owner * np.int64(256) + data[begins[0] :]
    return _described(np.bincount(at, minlength=256 * (len(first) + 1)).reshape(-1, 256)[:-1], lengths, first)


def _described(tally: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of passages from their byte counts, the lengths of all words and the number of each passage's first word."""
    total = tally.sum(axis=1, keepdims=True)
    rate = tally / total
    spread = -(rate * np.log(np.where(tally, rate, 1))).sum(axis=1)
    n = np.diff(np.append(first, len(lengths)))
    mean = np.add.reduceat(lengths, first) / n
    square = np.add.reduceat(lengths.astype(np.float64) ** 2, first) / n
    return np.column_stack(
        [
            rate @ _CLASSES, spread, np.log1p(n), mean, np.sqrt(np.maximum(0, square - mean**2)),
            np.sqrt(np.maximum.reduceat(lengths, first)), np.add.reduceat((lengths <= 2).astype(np.int64), first) / n,
        ]
    )


def _repetition(words: list[bytes]) -> tuple[float, ...]:
    n = len(words)
    return (
        len(set(words)) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        sum(map(bytes.isupper, words)) / n,
        sum(map(bytes.isalpha, words)) / n,
    )


@dataclass
class Model:
    """Weights of the network and the scaling of its features."""

    center: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, features: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of label 1 per bag, and the attention weight of every passage."""
        parts = _forward(self.weights, self.scaled(features), starts)
        return parts["p"], parts["a"]

    def scaled(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.center) / self.scale, -8, 8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    sizes = np.diff(np.append(starts, len(x)))
    owner = np.repeat(np.arange(len(starts)), sizes)
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    s = (t * g) @ w["q"]
    e = np.exp(s - np.maximum.reduceat(s, starts)[owner])
    a = e / np.add.reduceat(e, starts)[owner]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return {"owner": owner, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["c"] + w["d"])}


def _gradients(w, x, starts, y):
    f = _forward(w, x, starts)
    h, t, g, a, z, owner = f["h"], f["t"], f["g"], f["a"], f["z"], f["owner"]
    up = (f["p"] - y) / len(y)
    dz = up[:, None] * w["c"]
    ds_raw = (dz[owner] * h).sum(axis=1)
    ds = a * (ds_raw - np.add.reduceat(a * ds_raw, starts)[owner])
    dt, dg = ds[:, None] * w["q"] * g * (1 - t**2), ds[:, None] * w["q"] * t * g * (1 - g)
    dh = (a[:, None] * dz[owner] + dt @ w["V"].T + dg @ w["U"].T) * (1 - h**2)
    return {
        "W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "q": ((t * g) * ds[:, None]).sum(axis=0),
        "c": z.T @ up, "d": np.array(up.sum()),
    }


def train(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Fit the network by Adam on all documents at once; one class or no bags gives the smoothed share of label 1 as every score."""
    rng = np.random.default_rng(SEED)
    w = {
        "W": rng.normal(0, 0.3, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATES)),
        "U": rng.normal(0, 0.3, (HIDDEN, GATES)), "q": np.zeros(GATES) + 0.1, "c": np.zeros(HIDDEN), "d": np.zeros(()),
    }
    share = (labels.sum() + 1) / (len(labels) + 2)
    w["d"] = np.array(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), w)
    x = np.concatenate(rows)
    starts = np.cumsum([0, *map(len, rows[:-1])])
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-6, w)
    x = model.scaled(x)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(val) for k, val in w.items()}
    for epoch in range(1, epochs + 1):
        for k, grad in _gradients(w, x, starts, labels).items():
            grad = grad + DECAY * w[k]
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad**2
            w[k] = w[k] - STEP * (m[k] / (1 - 0.9**epoch)) / (np.sqrt(v[k] / (1 - 0.999**epoch)) + 1e-8)
    return model


def pooled(bag: np.ndarray, most: int = TRAINING_PASSAGES) -> np.ndarray:
    """A bag of at most ``most`` rows: the means of runs of neighbouring passages, of equal length but for one passage."""
    if len(bag) <= most:
        return bag
    starts = np.arange(most) * len(bag) // most
    return np.add.reduceat(bag, starts, axis=0) / np.diff(starts, append=len(bag))[:, None]


def fit(docs: DataFrame, labels: DataFrame, use: Column, limit: int = TRAINING_DOCUMENTS) -> Model:
    """Train on at most ``limit`` labelled documents for which ``use`` (over ``doc_id``) holds.

    Labels of one id are averaged and rounded; null labels are left out. The sample is a hash order of ids, so it is the same in each
    run. Of several rows of one id one is taken, the first by its features. What comes to the driver is bounded by ``limit`` and
    ``TRAINING_PASSAGES``: rows of features, never texts.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg((F.avg("quality") >= 0.5).cast("int").alias("label")).filter(use)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = "doc_id long, label int, sizes int, features binary"

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [pooled(bag) for bag in bags(texts(batch))]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                batch.column("label"),
                pa.array([len(b) for b in found], pa.int32()),
                pa.array([b.astype(np.float32).tobytes() for b in found], pa.binary()),
            ],
            ["doc_id", "label", "sizes", "features"],
        )

    encoded = map_texts(source.join(chosen, "doc_id"), encode, schema)
    first = encoded.groupBy("doc_id").agg(F.min(F.struct("sizes", "features", "label")).alias("first"))
    sample = first.select("doc_id", "first.*").toPandas()
    sample = sample.sort_values(["doc_id", "features"])
    rows = [np.frombuffer(f, np.float32).reshape(-1, FEATURES).astype(np.float64) for f in sample["features"]]
    return train(rows, sample["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (probability of good), ``predicted`` (1 from ``threshold`` on) and ``attention`` per passage.

    Only the text is used. Null, empty and blank texts are one empty passage and get a score too. Every row is scored alone: its
    neighbours in a batch change nothing but the last digits, and null and repeated ids need no care. Input columns with the names of the new ones are replaced. An empty table gives an empty result.
    """
    source = docs.withColumn("text", F.col("text").cast("string"))
    schema = with_columns(source, score=DoubleType(), predicted=IntegerType(), attention=ArrayType(FloatType()))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = bags(texts(batch))
        starts = np.cumsum([0, *map(len, own[:-1])])
        found, weights = model.scores(np.concatenate(own), starts)
        arrays = [batch.column(n) for n in schema.names[:-3]]
        arrays += [
            pa.array(found),
            pa.array((found >= threshold).astype(np.int32)),
            pa.array(np.split(weights.astype(np.float32), starts[1:]), pa.list_(pa.float32())),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    return map_texts(source, each, schema)
