"""Secret scans: an Aho-Corasick automaton over keywords, anchored expressions at its hits, then checksums inside the tokens.

Plain texts hold few keywords, so the expressions run at a few places only. Runs of hexadecimal digits have no keyword: every run of
32 bytes covers four bytes at multiples of eight, and only where four neighbours of those are digits the run is measured.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tarifa.llm.text import map_texts, texts, with_columns

HEX_DIGITS = 32
_STRIDE = 8
# Bytes that one call of the automaton gets.
CHUNK = 1 << 23

# Alphabets and generators of published checksum formats.
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = b"qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATORS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def has_crc(token: bytes) -> bool:
    """A four-letter prefix, 30 characters, and their CRC-32 as six base-62 digits."""
    if len(token) != 40:
        return False
    value = 0
    for digit in token[34:]:
        value = value * 62 + BASE62.index(digit)
    return value == zlib.crc32(token[4:34])


def has_bech32(token: bytes) -> bool:
    """A prefix, ``1`` and 58 characters of which the last six are the BCH checksum of all."""
    prefix, _, data = token.lower().rpartition(b"1")
    if len(data) != 58 or any(c not in BECH32 for c in data):
        return False
    total = 1
    for value in [*(c >> 5 for c in prefix), 0, *(c & 31 for c in prefix), *map(BECH32.index, data)]:
        top = total >> 25
        total = (total & 0x1FFFFFF) << 5 ^ value
        for i, generator in enumerate(BECH32_GENERATORS):
            total ^= generator if top >> i & 1 else 0
    return total == 1


@dataclass(frozen=True)
class Kind:
    """Matches of ``pattern`` count, leftmost first and without overlaps, if ``group`` has ``least`` characters and ``valid`` holds."""

    name: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    least: int
    group: int = 0
    valid: Callable[[bytes], bool] | None = None


_HEX_RUN = re.compile(rb"[0-9a-f]+")

# Keywords are in lower case and found in either case; the pattern decides about the case.
KINDS = (
    Kind(
        "assign",
        (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
        re.compile(rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
        8,
        2,
    ),
    Kind("access", (b"akia",), re.compile(rb"AKIA[A-Z0-9]+"), 16),
    Kind("hex", (), _HEX_RUN, HEX_DIGITS),
    Kind("github", (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"), re.compile(rb"gh[pousr]_[A-Za-z0-9]+"), 40, 0, has_crc),
    Kind("npm", (b"npm_",), re.compile(rb"npm_[A-Za-z0-9]+"), 40, 0, has_crc),
    Kind("age", (b"age-secret-key-1",), re.compile(rb"AGE-SECRET-KEY-1[A-Z0-9]+"), 74, 0, has_bech32),
)
BASE_KINDS = ("assign", "access", "hex")

_IS_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))
_machines: dict = {}


def _machine(kinds: tuple[Kind, ...]):
    """The automaton over all keywords of ``kinds``; built once per task process."""
    if kinds not in _machines:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for number, kind in enumerate(kinds):
            for keyword in kind.keywords:
                machine.add_word(keyword.decode("latin-1"), (number, len(keyword)))
        machine.make_automaton()
        _machines[kinds] = machine
    return _machines[kinds]


def keyword_starts(blob: bytes, kinds: tuple[Kind, ...], chunk: int = CHUNK) -> list[list[int]]:
    """Per kind, where its keywords start, in order."""
    machine, found = _machine(kinds), [[] for _ in kinds]
    overlap = max(len(k) for kind in kinds for k in kind.keywords) - 1
    for begin in range(0, len(blob), chunk):
        piece = blob[begin : begin + chunk + overlap].lower().decode("latin-1")
        for end, (number, length) in machine.iter(piece):
            start = end - length + 1
            if start < chunk:
                found[number].append(begin + start)
    return [sorted(starts) for starts in found]


def hex_starts(blob: bytes) -> Iterable[int]:
    """Starts, in order, of the runs of hexadecimal digits that may have ``HEX_DIGITS``."""
    sampled = _IS_HEX[np.frombuffer(blob, np.uint8)[::_STRIDE]]
    count = len(sampled) - HEX_DIGITS // _STRIDE + 1
    together = sampled[: max(count, 0)].copy()
    for i in range(1, HEX_DIGITS // _STRIDE):
        together &= sampled[i : i + count]
    end = 0
    for at in (np.flatnonzero(together) * _STRIDE).tolist():
        if at >= end:
            # Fewer than eight steps: had the run begun earlier, the sampled byte before this one would have met it.
            while at > 0 and _IS_HEX[blob[at - 1]]:
                at -= 1
            end = _HEX_RUN.match(blob, at).end()
            yield at


def matches(blob: bytes, kinds: tuple[Kind, ...] = KINDS) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of all matches in ``blob``, in order; offsets are bytes."""
    out = []
    starts = keyword_starts(blob, kinds)
    for number, kind in enumerate(kinds):
        end = 0
        for start in starts[number] if kind.keywords else hex_starts(blob):
            # A keyword inside the match before it is part of that one, which may itself be too short to count.
            match = kind.pattern.match(blob, start) if start >= end else None
            if match:
                end = match.end()
                if len(match[kind.group]) >= kind.least and (kind.valid is None or kind.valid(match[0])):
                    out.append((start, number, end))
    return sorted(out)


def _points(text: bytes, offsets: list[int]) -> dict[int, int]:
    """The code points before each byte offset."""
    known, before, points = {}, 0, 0
    for offset in sorted(set(offsets)):
        points += len(text[before:offset].decode())
        known[offset], before = points, offset
    return known


def _masked(text: bytes, spans: list[tuple[int, int, int]], mask: bytes) -> bytes:
    """``text`` with every maximal covered run replaced by ``mask``."""
    out, at = [], 0
    runs: list[list[int]] = []
    for start, _, end in spans:
        if runs and start < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    for start, end in runs:
        out += [text[at:start], mask]
        at = end
    return b"".join([*out, text[at:]])


_SPANS = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, mask: str | None = None) -> DataFrame:
    """``docs`` with ``secrets``: kind, start and end (code points, end exclusive) of each, by start, then in the order of ``kinds``.

    Matches of one kind do not overlap, those of different kinds may; equal places count once per kind. With ``mask`` it replaces
    every covered run in ``text``. Texts are read whole, whatever their length; null and empty ones hold nothing, and null stays
    null. Every row is judged alone, so null ids, repeated ids and repeated rows need no care. An input column named ``secrets`` is
    replaced, all others stay. An empty table gives an empty result.
    """
    schema = with_columns(docs, secrets=_SPANS)
    at = schema.names.index("text")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = texts(batch)
        # A line break ends every keyword and match, so texts can be searched together.
        blob = b"\n".join(values)
        begins = np.cumsum([0, *(len(v) + 1 for v in values)])
        own: list[list[tuple[int, int, int]]] = [[] for _ in values]
        for start, number, end in matches(blob, kinds):
            row = int(np.searchsorted(begins, start, side="right")) - 1
            own[row].append((start - int(begins[row]), number, end - int(begins[row])))
        del blob
        found = []
        for value, spans in zip(values, own):
            points = _points(value, [x for s, _, e in spans for x in (s, e)]) if spans else {}
            found.append([{"kind": kinds[n].name, "start": points[s], "end": points[e]} for s, n, e in spans])
        columns = [batch.column(name) for name in schema.names[:-1]]
        if mask is not None and any(own):
            hidden = [_masked(v, s, mask.encode()) if s else v for v, s in zip(values, own)]
            whole = batch.column("text").is_null().to_pylist()
            columns[at] = pa.array([None if gone else h.decode() for h, gone in zip(hidden, whole)], batch.column("text").type)
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, _ARROW_SPANS)], schema.names)

    return map_texts(docs, each, schema)
