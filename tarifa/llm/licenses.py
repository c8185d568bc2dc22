"""License scans: an inverted index of winnowed fingerprints proposes templates, banded alignment confirms them.

The templates are a fixed list, so their index is small and travels with the task. Documents are winnowed like the templates;
fingerprints that both have give pairs of positions, and pairs in order of both are chained across inserted and removed words: first
between neighbours, then over any distance, at a cost that grows with it. The words between two pairs of a chain, and beside its ends,
are aligned in a band along the pairs.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.decontaminate import gram_hashes, item_words, word_hashes
from tarifa.llm.templates import TEMPLATES
from tarifa.llm.text import map_texts, only, texts

GRAM_WORDS = 2
WINDOW = 2
# Words that the alignment goes beyond a chain's ends at most, besides those that the template still has.
BAND = 6
# Words of a document between neighbours, at most; for a template of fewer words its own, but no less than SHORT_GAP.
GAP = 64
SHORT_GAP = 24
# Hits that a wider step costs besides the logarithm of its width in gaps, so that a part of fewer hits is not worth the step.
STEP_COST = 3
MIN_COVERAGE = 0.7
# Shared fingerprints that make a candidate, as a share of the template's words; one at least.
MIN_HITS = 0.1


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """The positions whose hash is the smallest of some window, the last one in a tie; all of fewer grams than a window count as one."""
    if not len(grams):
        return np.empty(0, np.int64)
    window = min(window, len(grams))
    frames = np.lib.stride_tricks.sliding_window_view(grams[::-1], window)
    last = len(grams) - 1 - (np.arange(len(frames)) + frames.argmin(axis=1))
    return np.unique(last)


class Index:
    """Template words, and the template positions of every winnowed fingerprint."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: item_words(text.encode()) for name, text in templates.items()}
        self.places: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, words in self.words.items():
            grams = gram_hashes(word_hashes(words), GRAM_WORDS)
            for at in winnowed(grams, WINDOW).tolist():
                self.places[int(grams[at])].append((name, at))
        self.known = np.array(sorted(self.places), np.uint64)

    def chains(self, words: list[bytes]) -> list[tuple[str, np.ndarray]]:
        """Candidates: template, and the positions in document and template of hits that ascend in both."""
        grams = gram_hashes(word_hashes(words), GRAM_WORDS)
        kept = winnowed(grams, WINDOW)
        kept = kept[np.isin(grams[kept], self.known)]
        hits: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for at in kept.tolist():
            for name, place in self.places[int(grams[at])]:
                hits[name].append((at, place))
        found = []
        for name, values in hits.items():
            least = max(1, int(MIN_HITS * len(self.words[name])))
            gap = min(GAP, max(SHORT_GAP, len(self.words[name])))
            all_hits, parts, few = np.array(values, np.int64), [], min(least, STEP_COST + 1)
            for group in np.split(all_hits, np.flatnonzero(np.diff(all_hits[:, 0]) > gap) + 1):
                while len(np.unique(group[:, 1])) >= few:
                    own = chained(group, few, gap)
                    if not own:
                        break
                    parts += [group[chain] for chain in own]
                    group = np.delete(group, np.concatenate(own), axis=0)
            found += [(name, chain) for chain in joined(parts, gap) if len(chain) >= least]
        return found


def joined(parts: list[np.ndarray], gap: int) -> list[np.ndarray]:
    """Chains of ``parts`` that ascend in document and template, over any distance; every part is in one of them.

    A chain counts its hits, less the costs of its steps, so the nearest of equal continuations is taken.
    """
    if len(parts) < 2:
        return parts
    parts = sorted(parts, key=lambda p: tuple(p[0]))
    begin, end, size = np.array([p[0] for p in parts]), np.array([p[-1] for p in parts]), np.array([len(p) for p in parts])
    score, before = size.astype(np.float64), np.full(len(parts), -1)
    for k in range(1, len(parts)):
        width = begin[k, 0] - end[:k, 0]
        fits = (width > 0) & (begin[k, 1] > end[:k, 1])
        gain = np.where(fits, score[:k] - STEP_COST - np.log2(1 + np.maximum(width, 0) / gap), 0)
        best = k - 1 - int(gain[::-1].argmax())
        # A step that costs more than it brings to either side is not taken.
        if gain[best] > 0 and score[k] > STEP_COST + np.log2(1 + width[best] / gap):
            score[k], before[k] = score[k] + gain[best], best
    used, found = np.zeros(len(parts), bool), []
    for k in np.argsort(-score, kind="stable").tolist():
        chain = []
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append(parts[k])
            k = int(before[k])
        if chain:
            found.append(np.concatenate(chain[::-1]))
    return found


def chained(hits: np.ndarray, least: int, gap: int = GAP) -> list[np.ndarray]:
    """Rows of ``hits`` (document and template position, by the former) that form chains of ``least`` hits or more, none in two.

    A chain counts its hits and loses less than one for every change of diagonal.
    """
    at, place, score, before = hits[:, 0], hits[:, 1], np.ones(len(hits)), np.full(len(hits), -1)
    starts = np.searchsorted(at, at - gap)
    for k in range(1, len(hits)):
        own = slice(starts[k], k)
        turn = np.abs(at[k] - at[own] - (place[k] - place[own]))
        gain = score[own] - np.where(turn > 0, 0.5 + 0.4 * turn / (turn + gap), 0)
        gain[(at[own] >= at[k]) | (place[own] >= place[k])] = 0
        if len(gain) and gain.max() > 0:
            # The nearest of equal ones.
            best = len(gain) - 1 - int(gain[::-1].argmax())
            score[k], before[k] = 1 + gain[best], starts[k] + best
    used, found = np.zeros(len(hits), bool), []
    for k in np.argsort(-score, kind="stable").tolist():
        chain = []
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append(k)
            k = int(before[k])
        if len(chain) >= least:
            found.append(np.array(chain[::-1]))
    return found


def matches(template: list[bytes], words: list[bytes]) -> list[tuple[int, int]]:
    """Longest common subsequence: pairs of positions, in order, as late in ``words`` as can be."""
    if not template or not words:
        return []
    numbers = {w: n for n, w in enumerate(dict.fromkeys(words))}
    own = np.array([numbers[w] for w in words])
    score = np.zeros((len(template) + 1, len(words) + 1), np.int32)
    for i, word in enumerate(template):
        score[i + 1, 1:] = np.maximum.accumulate(np.maximum(score[i, 1:], score[i, :-1] + (own == numbers.get(word, -1))))
    pairs, i, j = [], len(template), len(words)
    while i and j:
        if template[i - 1] == words[j - 1] and score[i, j] == score[i - 1, j - 1] + 1:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif score[i, j] == score[i - 1, j]:
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


def filled(template: list[bytes], words: list[bytes], chain: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of template and document positions: the words of a chain's hits, and alignments between them and beside the ends."""
    pairs: list[tuple[int, int]] = []
    for at, place in chain.tolist():
        if not pairs:
            start = max(0, at - place - BAND)
            pairs = [(i, start + j) for i, j in matches(template[:place], words[start:at])]
            done, upto = place, at
        elif place > done and at > upto:
            pairs += [(done + i, upto + j) for i, j in between(template[done:place], words[upto:at])]
            done, upto = place, at
        # Words of a gram that an earlier one has used are not paired again.
        for step in range(GRAM_WORDS):
            if place + step >= done and at + step >= upto:
                pairs.append((place + step, at + step))
                done, upto = place + step + 1, at + step + 1
    rest, tail = template[done:][::-1], words[upto : upto + len(template) - done + BAND]
    pairs += [(len(template) - 1 - i, upto + len(tail) - 1 - j) for i, j in reversed(matches(rest, tail[::-1]))]
    return pairs


def between(template: list[bytes], words: list[bytes]) -> list[tuple[int, int]]:
    """Alignment of the words between two hits. Of a wide run of words only a band along either hit takes part."""
    band = len(template) + BAND
    if len(words) <= 2 * band:
        return matches(template, words)
    skipped = len(words) - 2 * band
    return [(i, j if j < band else j + skipped) for i, j in matches(template, words[:band] + words[-band:])]


def scan_text(text: bytes, index: Index, min_coverage: float) -> list[tuple[str, int, int, int, float]]:
    """Per finding: template, first word, word past the last, matched words, coverage; overlapping ones of a template give the best."""
    words = item_words(text)
    found = []
    for name, chain in index.chains(words):
        pairs = filled(index.words[name], words, chain)
        coverage = len(pairs) / len(index.words[name])
        if coverage >= min_coverage:
            found.append((name, pairs[0][1], pairs[-1][1] + 1, len(pairs), coverage))
    found.sort(key=lambda f: (f[0], -f[3], f[2] - f[1], f[1]))
    best: list[tuple[str, int, int, int, float]] = []
    for one in found:
        if not any(one[0] == b[0] and one[1] < b[2] and b[1] < one[2] for b in best):
            best.append(one)
    return best


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per license found in a document.

    Columns: ``doc_id``, ``license``, ``first_word`` and ``end_word`` (the span, as word offsets of the document), ``n_matched``
    (template words aligned) and ``coverage`` (their share of the template). Words are runs of ASCII letters and digits and of
    characters outside ASCII, with A-Z lower-cased. Several findings of one template in a text are reported if their spans do not
    overlap; of overlapping ones the one with most words, then the shortest, then the first. Words inserted into a license may be any
    number, if the parts beside them share more than ``STEP_COST`` fingerprints. An empty table gives an empty result. Null and empty texts give no row; null
    and repeated ids and repeated rows are scanned like any other; other columns are not read.
    """
    made: list[Index] = []

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Index(templates))
        values = texts(batch)
        found = [(i, *f) for i, text in enumerate(values) for f in scan_text(text, made[0], min_coverage)]
        columns = list(zip(*found)) or [()] * 6
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        names = ["doc_id", "license", "first_word", "end_word", "n_matched", "coverage"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(arrays[0]), *arrays[1:]], names)

    source = only(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_texts(
        source, each, f"doc_id {kind}, license string, first_word long, end_word long, n_matched long, coverage double"
    ).withColumn("coverage", F.round("coverage", 6))
