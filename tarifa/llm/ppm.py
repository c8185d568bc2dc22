"""Language-model scores by prediction by partial matching over bytes.

A text is the bytes of its lower-cased words, a space after each, then one end symbol. The model is a trie of byte contexts:

* the first symbol of a word is predicted from the last three bytes of the word before, then the last one, then none;
* the second from the last two bytes of the word before with the first byte, then the first byte, then none;
* each later one from the whole word so far (up to ``MAX_ORDER`` bytes), then its last three bytes, the last one, none.

A context escapes to the next shorter one with probability d / (t + d), where t counts its symbols in training and d the distinct
ones, and symbols that the longer context offered are excluded from the shorter. What is left goes evenly to symbols never seen. Two bytes before a word's own or its neighbour's last
byte are known by their remainder only, so that the tables of these contexts are bounded by the alphabet.

From the third symbol on a word's code length depends on the word alone, so it is computed once per distinct word: words are sorted
into ranges, each range holds its part of the trie as runs of equal prefixes, and the few prefixes that cross a range's borders are
summed over ranges first. Documents then add up word scores: the ``TOP_WORDS`` most frequent words, a table of bounded size, are added
where the text is read, and only the other words travel to the vocabulary.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.llm.text import ROW, ascii_words, slices, texts
from tarifa.session import save

SYMBOLS = 257
END = 256
SPACE = 32
MAX_ORDER = 24
TOP_WORDS = 200_000
TOP_WORD_BYTES = 48
# Distinct words that a task counts before it passes them on, and words of one range of the vocabulary.
COUNTED_WORDS = 300_000
RANGE_WORDS = 100_000
_WORD, _FIRST, _SECOND = 0, 1, 2


def _code(a: np.ndarray, b: np.ndarray, s: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) * SYMBOLS + b) * SYMBOLS + s


def pair(a, b):
    """Two bytes as a number below ``SYMBOLS``."""
    return (a * 31 + b * 7) % SYMBOLS


def boundary_codes(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of first and second symbols over texts given as words, and the text each belongs to; the end is a first symbol."""
    blocks = [b"    " + b" ".join(w) + b" " for w in words]
    data = np.frombuffer(b"".join(blocks), np.uint8).astype(np.int64)
    ends = np.cumsum([len(b) for b in blocks])
    space = data == SPACE
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    owner = np.searchsorted(ends, starts, side="right")
    count = np.array([len(w) for w in words])
    last = ends - np.where(count > 0, 0, 1)  # where the next word would start; a text without words is spaces only
    at, symbol = np.concatenate([starts, last]), np.concatenate([data[starts], np.full(len(last), END)])
    first = _code(pair(data[at - 4], data[at - 3]), data[at - 2], symbol)
    second = _code(pair(data[starts - 3], data[starts - 2]), data[starts], data[starts + 1])
    return first, np.concatenate([owner, np.arange(len(words))]), second, owner


def blend(code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log10 probability of every coded event (a, b, symbol): context (a, b), then (b), then none, with exclusion.

    ``code`` is distinct and sorted; ``n`` counts training events and may be 0. Counts of shorter contexts are sums of the longer
    ones, so the symbols of a context are among those of the next shorter one.
    """
    context, s = code // SYMBOLS, code % SYMBOLS
    b = context % SYMBOLS
    mid = np.zeros((SYMBOLS, SYMBOLS))
    np.add.at(mid, (b, s), n)
    bottom = mid.sum(axis=0)
    _, at = np.unique(context, return_inverse=True)
    seen = n > 0
    t2, d2 = np.bincount(at, n)[at], np.bincount(at, seen)[at]
    hidden2 = np.bincount(at, np.where(seen, mid[b, s], 0))[at]
    d1 = (mid > 0).sum(axis=1)
    t1_live, d1_live = mid.sum(axis=1)[b] - hidden2, d1[b] - d2
    hidden1 = ((mid > 0) * bottom).sum(axis=1)
    d0 = int((bottom > 0).sum())
    t0_live, d0_live = bottom.sum() - hidden1[b], d0 - d1[b]
    with np.errstate(divide="ignore", invalid="ignore"):
        log = np.zeros(len(code))
        open_ = np.ones(len(code), bool)
        for count, total, distinct in ((n, t2, d2), (mid[b, s], t1_live, d1_live), (bottom[s], t0_live, d0_live)):
            here = open_ & (count > 0)
            log = np.where(here, log + np.log10(count / (total + distinct)), log)
            open_ &= ~here
            log = np.where(open_ & (distinct > 0), log + np.log10(distinct / (total + distinct)), log)
    return np.where(open_, log - np.log10(max(1, SYMBOLS - d0)), log)


class Table:
    """Log probabilities by code: a row for every context and a column for every symbol that occurs; bounded by the alphabet, not by the corpus."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        order = np.argsort(code)
        code, n = code[order], n[order]
        contexts, rows = np.unique(code // SYMBOLS, return_inverse=True)
        symbols, columns = np.unique(code % SYMBOLS, return_inverse=True)
        self.rows, self.columns = np.zeros(SYMBOLS * SYMBOLS, np.int32), np.zeros(SYMBOLS, np.int32)
        self.rows[contexts], self.columns[symbols] = np.arange(len(contexts)), np.arange(len(symbols))
        self.values = np.zeros((max(1, len(contexts)), max(1, len(symbols))), np.float32)
        self.values[rows, columns] = blend(code, n.astype(np.float64))

    def __call__(self, code: np.ndarray) -> np.ndarray:
        return self.values[self.rows[code // SYMBOLS], self.columns[code % SYMBOLS]]


def _table(rows: DataFrame) -> Table:
    found = rows.select("code", "n").toPandas()
    return Table(found["code"].to_numpy(np.int64), found["n"].to_numpy(np.int64))


def count_events(docs: DataFrame) -> DataFrame:
    """``kind``, ``word``, ``code`` and ``n``: training counts of words and of first and second symbols, 0 for those of other texts only.

    ``docs`` has ``text`` and ``train``.
    """

    def run(batches):
        trained: Counter = Counter()
        others: set[bytes] = set()
        for piece in slices(batches):
            train = np.array(piece.column("train").to_pylist(), bool)
            words = [ascii_words(t) for t in texts(piece)]
            for own, use in zip(words, train):
                if use:
                    trained.update(own)
                else:
                    others.update(own)
            first, first_text, second, second_text = boundary_codes(words)
            for kind, code, owner in ((_FIRST, first, first_text), (_SECOND, second, second_text)):
                values, n = np.unique(code * 2 + train[owner], return_counts=True)
                yield _events(kind, [None] * len(values), values >> 1, np.where(values & 1, n, 0))
            if len(trained) + len(others) > COUNTED_WORDS:
                yield _words(trained, others)
                trained, others = Counter(), set()
        yield _words(trained, others)

    def _words(trained: Counter, others: set[bytes]) -> pa.RecordBatch:
        new = [w for w in others if w not in trained]
        n = np.concatenate([np.fromiter(trained.values(), np.int64, len(trained)), np.zeros(len(new), np.int64)])
        return _events(_WORD, [*trained, *new], np.zeros(len(n), np.int64), n)

    events = docs.select("text", "train").mapInArrow(run, "kind int, word binary, code long, n long")
    return events.groupBy("kind", "word", "code").agg(F.sum("n").alias("n"))


def _events(kind: int, words: list, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(n), kind, np.int32)), pa.array(words, pa.binary()), pa.array(code), pa.array(n.astype(np.int64))],
        ["kind", "word", "code", "n"],
    )


class Trie:
    """The words of one range, sorted, with the symbols that follow each prefix."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words = [words[i] for i in order]
        self.order = np.array(order, np.int64)
        self.counts = counts[self.order].astype(np.float64)
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        # A space after each word, so that the byte at a word's length is its closing symbol.
        self.data = np.frombuffer(b" ".join(self.words) + b" ", np.uint8).astype(np.int64)

    def levels(self, depth_from: int, depth_to: int):
        """For each depth: the words that reach it, their prefix's number, and their symbol's number among all prefixes' symbols."""
        active = np.arange(len(self.words))
        node_start = np.arange(len(active)) == 0
        for depth in range(depth_to):
            keep = self.lengths[active] >= depth
            active, node_start = _narrow(active, node_start, keep)
            if not len(active):
                return
            symbol = self.data[self.starts[active] + depth]
            # The closing space sorts before any byte of a word that may follow, as the shorter word comes first.
            symbol = np.where(self.lengths[active] == depth, -1, symbol)
            child_start = node_start | (np.diff(symbol, prepend=-2) != 0)
            if depth >= depth_from:
                yield depth, active, np.cumsum(node_start) - 1, np.cumsum(child_start) - 1, np.where(symbol < 0, SPACE, symbol)
            node_start = child_start

    def borders(self) -> list[bytes]:
        """Prefixes that other ranges may share: those of the first and of the last word."""
        ends = {w[:i] for w in (self.words[0], self.words[-1]) for i in range(2, min(len(w), MAX_ORDER - 1) + 1)}
        return sorted(ends)


def _narrow(active: np.ndarray, starts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drop words that end earlier; a run that loses its first word starts at the next."""
    run = np.cumsum(starts) - 1
    active, run = active[keep], run[keep]
    return active, np.diff(run, prepend=-1) != 0


def low_codes(trie: Trie) -> tuple[np.ndarray, np.ndarray]:
    """Codes (bytes before, symbol) from every word's second symbol on, and the word each belongs to."""
    sizes = trie.lengths
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
    place = trie.starts[owner] + at
    third, second = (np.where(at >= n, trie.data[np.maximum(place - n, 0)], SPACE) for n in (3, 2))
    return _code(pair(third, second), trie.data[place - 1], trie.data[place]), owner


def border_counts(trie: Trie) -> dict[bytes, tuple[np.ndarray, np.ndarray]]:
    """For each border prefix the symbols that follow it in training and their counts."""
    wanted = trie.borders()
    found = {}
    for depth, active, node, child, symbol in trie.levels(2, MAX_ORDER):
        for prefix in [p for p in wanted if len(p) == depth]:
            for at in (0, len(active) - 1):
                if trie.words[active[at]][:depth] == prefix:
                    own = np.flatnonzero(node == node[at])
                    symbols, index = np.unique(symbol[own], return_inverse=True)
                    found[prefix] = symbols, np.bincount(index, trie.counts[active[own]])
    return found


def word_scores(trie: Trie, low: Table, shared: dict[bytes, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log10 probability of each word's symbols from the third on, in the order of ``trie.words``.

    ``shared`` holds the training counts of the prefixes that cross the range's borders, over all ranges.
    """
    codes, owner = low_codes(trie)
    low_log = low(codes).astype(np.float64)
    offset = np.cumsum(trie.lengths) - trie.lengths
    total = np.zeros(len(trie.words))
    # Past the longest context only the short ones are left.
    deep = (np.arange(len(owner)) - offset[owner] + 1) >= MAX_ORDER
    np.add.at(total, owner[deep], low_log[deep])
    for depth, active, node, child, symbol in trie.levels(2, MAX_ORDER):
        first_child = np.flatnonzero(np.diff(child, prepend=-1))
        first_node = np.flatnonzero(np.diff(node, prepend=-1))
        count = np.add.reduceat(trie.counts[active], first_child)
        log = low_log[offset[active] + depth - 1]
        rate = np.where(count > 0, 10 ** log[first_child], 0)
        parent = node[first_child]
        t, d = np.bincount(parent, count), np.bincount(parent, count > 0)
        covered = np.bincount(parent, rate)
        for at in {0, len(active) - 1}:
            prefix = trie.words[active[at]][:depth]
            if prefix in shared:
                symbols, n = shared[prefix]
                here = np.flatnonzero(parent == node[at])
                match = dict(zip(symbols.tolist(), n.tolist()))
                count[here] = [match.get(x, 0) for x in symbol[first_child[here]].tolist()]
                live = symbols[n > 0]
                t[node[at]], d[node[at]] = n.sum(), len(live)
                near = pair(prefix[-3] if len(prefix) > 2 else SPACE, prefix[-2])
                codes_here = _code(np.full(len(live), near), np.full(len(live), prefix[-1]), live)
                covered[node[at]] = (10 ** low(codes_here).astype(np.float64)).sum()
        count, t, d, covered = count[child], t[node], d[node], covered[node]
        with np.errstate(divide="ignore", invalid="ignore"):
            known = np.log10(count / (t + d))
            rest = np.maximum(1 - covered, 1e-9)
            escaped = np.where(t > 0, np.log10(d / (t + d)) - np.log10(rest), 0.0) + log
        total[active] += np.where(count > 0, known, escaped)
    return total


def score_words(vocabulary: DataFrame) -> DataFrame:
    """``word``, ``n`` and ``rest`` (the log10 probability of its symbols from the third on) for every distinct word."""
    ranges = max(1, vocabulary.count() // RANGE_WORDS)
    ranged = vocabulary.repartitionByRange(ranges, "word").withColumn("part", F.spark_partition_id())
    ranged = save(ranged, "vocabulary")

    def survey(rows: pd.DataFrame) -> pd.DataFrame:
        trie = Trie(rows["word"].tolist(), rows["n"].to_numpy())
        out = [("border", p, int(s), int(c)) for p, (symbols, n) in border_counts(trie).items() for s, c in zip(symbols, n)]
        codes, owner = low_codes(trie)
        values, at = np.unique(codes, return_inverse=True)
        seen = np.bincount(at, trie.counts[owner] > 0).astype(np.int64)
        out += [("low", b"", int(v), int(c)) for v, c in zip(values, seen)]
        found = pd.DataFrame(out, columns=["kind", "prefix", "code", "n"])
        found["part"] = rows["part"].iloc[0]
        return found

    schema = "kind string, prefix binary, code long, n long, part int"
    surveyed = save(ranged.groupBy("part").applyInPandas(survey, schema), "vocabulary_survey")
    low = _table(surveyed.filter("kind = 'low'").groupBy("code").agg(F.sum("n").alias("n")))
    shared_low = vocabulary.sparkSession.sparkContext.broadcast(low)
    borders = surveyed.filter("kind = 'border'")
    whole = borders.groupBy("prefix", "code").agg(F.sum("n").alias("n"))
    needed = borders.select("part", "prefix").distinct().join(whole, "prefix")

    def finish(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["word", "n", "rest"])
        trie = Trie(rows["word"].tolist(), rows["n"].to_numpy())
        shared = {p: (g["code"].to_numpy(np.int64), g["n"].to_numpy(np.float64)) for p, g in own.groupby("prefix")}
        return pd.DataFrame({"word": trie.words, "n": trie.counts.astype(np.int64), "rest": word_scores(trie, shared_low.value, shared)})

    found = ranged.groupBy("part").cogroup(needed.groupBy("part")).applyInPandas(finish, "word binary, n long, rest double")
    return save(found, "word_scores")


def frequent(words: DataFrame) -> DataFrame:
    """The most frequent short words, ``TOP_WORDS`` at most: those from a count on that a histogram of a few hundred bins gives."""
    binned = words.filter((F.length("word") <= TOP_WORD_BYTES) & (F.col("n") > 0)).withColumn("bin", F.floor(8 * F.log2("n")))
    least, size = None, 0
    for row in sorted(binned.groupBy("bin").count().collect(), reverse=True):
        size += row["count"]
        if size > TOP_WORDS:
            break
        least = row["bin"]
    return binned.filter(F.lit(False) if least is None else F.col("bin") >= least)


def score(docs: DataFrame, train: Column) -> DataFrame:
    """Per row: ``doc_id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``train`` marks the rows to learn from; all rows are scored. Tokens are lower-cased (A-Z) runs of ``[^\\x20\\x09-\\x0D]`` and one
    end. ``base_score`` is the smoothed unigram log10 probability, ``score`` the model's. Null, empty and blank texts are an end
    alone. Null and repeated ids and repeated rows are scored like any other row; other columns are not read. Without training rows
    every symbol is equally likely. An empty table gives an empty result.
    """
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    events = save(count_events(source), "events")
    vocabulary = events.filter(F.col("kind") == _WORD).select("word", "n")
    first, second = (_table(events.filter(F.col("kind") == kind)) for kind in (_FIRST, _SECOND))
    known, tokens = vocabulary.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    ends = events.filter((F.col("kind") == _FIRST) & (F.col("code") % SYMBOLS == END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, distinct = tokens + ends, known + (ends > 0)
    words = score_words(vocabulary)
    below = total + 0.5 * (distinct + 1)
    words = words.select("word", (F.col("n") > 0).cast("long").alias("known"), F.log10((F.col("n") + 0.5) / below).alias("base"), "rest", "n")
    top = frequent(words).select("word", "known", "base", "rest").toPandas()
    model = docs.sparkSession.sparkContext.broadcast(
        (first, second, top["word"].tolist(), top[["known", "base", "rest"]].to_numpy(np.float64))
    )
    end_base, end_known = float(np.log10((ends + 0.5) / below)), int(ends > 0)
    ready: dict[bytes, int] = {}

    def read(batches):
        first, second, names, values = model.value
        if not ready:
            ready.update(zip(names, range(len(names))))
        table = np.vstack([values, np.zeros((1, 3))])
        for piece in slices(batches):
            words = [ascii_words(t) for t in texts(piece)]
            a, a_owner, b, b_owner = boundary_codes(words)
            sums = np.bincount(a_owner, first(a), len(words)) + np.bincount(b_owner, second(b), len(words))
            known, base = np.full(len(words), end_known, np.int64), np.full(len(words), end_base)
            asked, rows, times = [], [], []
            numbers = piece.column(ROW).to_pylist()
            for i, own in enumerate(words):
                at = np.array(list(map(ready.get, own, [len(names)] * len(own))), np.int64)
                k, x, r = table[at].sum(axis=0)
                known[i] += int(k)
                base[i] += x
                sums[i] += r
                if (at == len(names)).any():
                    others = Counter(w for w in own if w not in ready)
                    asked += others
                    times += others.values()
                    rows += [numbers[i]] * len(others)
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.concat_arrays([piece.column(c), pa.nulls(len(rows), piece.column(c).type)]) for c in ("doc_id", "train")],
                    pa.array(numbers + rows, pa.int64()),
                    pa.array([None] * len(words) + asked, pa.binary()),
                    pa.array([1] * len(words) + times, pa.int64()),
                    pa.array([len(w) + 1 for w in words] + [None] * len(rows), pa.int64()),
                    pa.array(known.tolist() + [None] * len(rows), pa.int64()),
                    pa.array(base.tolist() + [None] * len(rows), pa.float64()),
                    pa.array(sums.tolist() + [None] * len(rows), pa.float64()),
                ],
                ["doc_id", "train", ROW, "word", "times", "n_tokens", "known", "base", "sum"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, train boolean, {ROW} long, word binary, times long, n_tokens long, known long, base double, sum double"
    numbered = source.withColumn(ROW, F.monotonically_increasing_id())
    parts = save(numbered.mapInArrow(read, schema), "document_parts")
    asked = parts.filter("word is not null").select(ROW, "word", "times").join(words.drop("n"), "word").groupBy(ROW).agg(
        *[F.sum(F.col("times") * F.col(c)).alias(f"_{c}") for c in ("known", "base", "rest")]
    )
    found = parts.filter("word is null").join(asked, ROW, "left")
    return found.select(
        "doc_id",
        "train",
        "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        (F.col("sum") + F.coalesce("_rest", F.lit(0.0))).alias("score"),
    )
