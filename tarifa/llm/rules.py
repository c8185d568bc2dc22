"""Quality rules as weak supervision.

Every rule votes good, votes bad or abstains. Expectation-maximisation over all documents estimates how often each rule casts each
vote on good and on bad documents, without labels, and the posterior probability of good replaces the demand that every rule pass.
Documents enter the estimation as counts of vote patterns, of which there are at most three to the number of rules.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tarifa.llm.text import map_texts, texts, with_columns
from tarifa.session import save

MIN_WORDS = 50
REPEAT_WINDOW = 3
SYMBOLS = b"#*$%&|<>"
MIN_POSTERIOR = 0.5
ROUNDS = 200
SMOOTHING = 1.0
# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = frozenset(
    "the of and to in is that it for was der die und das ist nicht mit le la les et est que dans de los las y en el un".split()
)
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_ended", "n_function", "n_letter_words",
)


def repeated_words(words: list, size: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of ``size`` words found at least twice, the first one included."""
    runs = list(zip(*(words[i:] for i in range(size))))
    seen = Counter(runs)
    if len(seen) == len(runs):
        return 0
    mark = np.zeros(len(words) + 1, np.int32)
    twice = np.flatnonzero(np.fromiter(map(seen.__getitem__, runs), np.int64, len(runs)) > 1)
    np.add.at(mark, twice, 1)
    np.add.at(mark, twice + size, -1)
    return int((np.cumsum(mark) > 0).sum())


_FUNCTION = frozenset(word.encode() for word in FUNCTION_WORDS)
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122))
_SPACE = np.isin(_BYTES, list(b" \t\n\x0b\x0c\r"))
_CONTINUES = (_BYTES & 0xC0) == 0x80
_SYMBOL = np.isin(_BYTES, list(SYMBOLS))


def text_counts(text: bytes) -> tuple[int, ...]:
    """The ``COUNTS`` of one text; letters and capitals are those of ASCII."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    tally = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    ended = sum(line.rstrip()[-1:] in b".!?:;" for line in lines)
    bare = [word.strip(b".,;:!?") for word in words]
    return (
        len(words), int(tally[~_SPACE & ~_CONTINUES].sum()), int(tally[_SYMBOL].sum()), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), int(tally[_UPPER].sum()), int(tally[_LETTER].sum()), ended,
        sum(word.lower() in _FUNCTION for word in bare), sum(word.isalpha() or not word.isascii() for word in bare),
    )


def count_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``COUNTS``."""
    source = docs.withColumn("text", F.col("text").cast("string"))
    schema = with_columns(source, **dict.fromkeys(COUNTS, LongType()))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([text_counts(t) for t in texts(batch)], np.int64).reshape(-1, len(COUNTS))
        arrays = [batch.column(n) for n in schema.names[: -len(COUNTS)]]
        return pa.RecordBatch.from_arrays(arrays + [pa.array(found[:, i]) for i in range(len(COUNTS))], schema.names)

    return map_texts(source, each, schema)


def _rule(value: Column, good: Column, bad: Column) -> Column:
    """2 for good, 0 for bad, 1 for neither or for a value that is not defined."""
    return F.when(value.isNull(), 1).when(bad, 0).when(good, 2).otherwise(1)


def votes() -> dict[str, Column]:
    """The rules' votes as 0 (bad), 1 (abstains) and 2 (good)."""
    ratios = {
        "length": F.col("n_words"),
        "word_length": F.try_divide("word_chars", "n_words"),
        "symbols": F.try_divide("n_symbols", "n_words"),
        "duplicate_lines": F.try_divide("n_dup_lines", "n_lines"),
        "repeated_words": F.try_divide("n_repeat_words", "n_words"),
        "capitals": F.try_divide("n_upper", "n_letters"),
        "line_ends": F.try_divide("n_ended", "n_lines"),
        "function_words": F.try_divide("n_function", "n_words"),
        "letter_words": F.try_divide("n_letter_words", "n_words"),
    }
    limits = {
        "length": lambda x: (x >= 80, x < 50),
        "word_length": lambda x: (x.between(3, 9), (x < 2) | (x > 13)),
        "symbols": lambda x: (x <= 0.05, x > 0.25),
        "duplicate_lines": lambda x: (x <= 0.1, x > 0.3),
        "repeated_words": lambda x: (x <= 0.2, x > 0.4),
        "capitals": lambda x: (x <= 0.2, x > 0.5),
        "line_ends": lambda x: (x >= 0.5, x < 0.1),
        "function_words": lambda x: (x >= 0.05, x < 0.01),
        "letter_words": lambda x: (x >= 0.8, x < 0.5),
    }
    return {name: _rule(value, *limits[name](value)) for name, value in ratios.items()}


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good per vote pattern, P(vote | class) by rule, and P(good).

    ``patterns`` holds votes 0, 1, 2, one row per pattern. The start is each pattern's share of good among its votes.
    """
    if not len(patterns):
        return np.empty(0), np.empty((0, 2, 3)), 0.5
    good, bad = (patterns == 2).sum(axis=1), (patterns == 0).sum(axis=1)
    # One vote for bad weighs as much as the good votes of two rules: few documents fail several rules at once.
    posterior = (good + 1.0) / (good + 2.0 * bad + 2.0)
    hot = np.stack([patterns == v for v in range(3)], axis=2).astype(float)
    rates, share = None, 0.5
    for _ in range(rounds):
        weights = np.stack([(1 - posterior) * counts, posterior * counts])
        share = float((weights[1].sum() + SMOOTHING) / (counts.sum() + 2 * SMOOTHING))
        rates = np.einsum("cp,prv->rcv", weights, hot) + SMOOTHING
        rates /= rates.sum(axis=2, keepdims=True)
        logs = np.einsum("prv,rcv->pc", hot, np.log(rates)) + np.log([1 - share, share])
        after = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if np.abs(after - posterior).max() < 1e-9:
            posterior = after
            break
        posterior = after
    return posterior, rates, share


def judge(docs: DataFrame, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """``docs`` with the ``COUNTS``, ``votes`` (one digit per rule), ``posterior``, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words repeat. ``kept``: not that, and the posterior
    probability of good is at least ``min_posterior``. Null, empty and blank texts have no words and fail. Every row is judged
    alone, so null and repeated ids need no care; repeated rows weigh in the estimation as often as they occur. Input columns
    with the names of the new ones are replaced. An empty table gives an empty result.
    """
    marked = ("votes", "posterior", "base_failed", "kept")
    counted = count_texts(docs.drop(*marked)).withColumn("votes", F.concat(*[v.cast("string") for v in votes().values()]))
    stored = save(counted, "rule_votes")
    # At most 3 to the number of rules.
    patterns = stored.groupBy("votes").count().toPandas().sort_values("votes")
    digits = np.array([[int(d) for d in v] for v in patterns["votes"]], np.int64).reshape(len(patterns), len(votes()))
    posterior, _, _ = estimate(digits, patterns["count"].to_numpy(float))
    rows = [(v, float(p)) for v, p in zip(patterns["votes"], posterior)]
    table = docs.sparkSession.createDataFrame(rows, "votes string, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = stored.join(F.broadcast(table), "votes").withColumn("base_failed", failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= min_posterior))
    return judged.select(*[c for c in stored.columns if c != "votes"], *marked)
