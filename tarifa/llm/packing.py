"""Packing: concatenate all documents and cut the token stream into fixed windows.

Two passes. The first tokenizes each partition once and stores the ids with the running token count inside the partition. The
partition totals (one row per input split) give each partition its global offset by a prefix sum. The second pass only adds the
offset and cuts at multiples of the window; each piece is a boundary record that says which tokens of which document sit where.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarifa.llm.text import only, slices
from tarifa.session import new_path

SEQUENCE_TOKENS = 4096
END_OF_DOCUMENT = 2
# Words whose ids a task remembers as recent ones, with as many older ones, and the longest of them in bytes: about 100 MB at most.
KNOWN_WORDS = 250_000
KNOWN_WORD_BYTES = 48
# Words that the tokenizer takes at once.
CHUNK = 1000
# Lower-case letters that the tokenizer's normalizer leaves as they are, and what may follow: after a letter, ASCII punctuation is a
# token run of its own.
_LETTERS = "[a-z\u00df-\u00f6\u00f8-\u00ff]+"
_PLAIN = rf"^(?P<stem>{_LETTERS})(?P<tail>[!-/:-@\[-`{{-~]*)$"

_encoders: dict[str, Callable[[pa.Array], list[bytes]]] = {}


def _encoder(path: str) -> Callable[[pa.Array], list[bytes]]:
    """A function from an array of texts to their ids as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space, ignores case and never joins across white space or between letters and punctuation. So the
    ids of a text are those of its words, the ids of a word those of its stem and its trailing punctuation, and each is computed
    once as long as it is remembered. Stems of plain letters are words to the tokenizer's model as they stand.
    """
    if path in _encoders:
        return _encoders[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

    tokenizer = Tokenizer.from_file(path)
    splitter = Tokenizer(tokenizer.model)
    splitter.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    ends_word = np.zeros(tokenizer.get_vocab_size() + 1, bool)
    ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    letters = re.compile(_LETTERS)
    recent: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def alone(parts: list[str]) -> list[bytes]:
        return [np.array(item.ids, "<u4").tobytes() for item in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def together(parts: list[str]) -> list[bytes]:
        """Parts made of plain letters only: one word each, so the word ends in the ids of all tell them apart."""
        ids = np.array(splitter.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ends_word[ids]) + 1
        if len(ends) != len(parts):
            return alone(parts)
        data, stops = ids.tobytes(), (4 * ends).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def known(parts: list[str]) -> pa.Array:
        nonlocal recent, older
        found = list(map(recent.get, parts))
        places = [i for i, ids in enumerate(found) if ids is None]
        asked = [parts[i] for i in places]
        own = list(map(older.get, asked))
        missing = [part for part, ids in zip(asked, own) if ids is None]
        plain = [part for part in missing if letters.fullmatch(part)]
        fresh = {}
        for i in range(0, len(plain), CHUNK):
            fresh.update(zip(plain[i : i + CHUNK], together(plain[i : i + CHUNK])))
        others = [part for part in missing if part not in fresh]
        fresh.update(zip(others, alone(others)))
        for i, part, ids in zip(places, asked, own):
            found[i] = fresh[part] if ids is None else ids
        if len(recent) + len(asked) > KNOWN_WORDS:
            recent, older = {}, recent
        recent.update([(parts[i], found[i]) for i in places[:KNOWN_WORDS] if len(parts[i]) <= KNOWN_WORD_BYTES])
        return pa.array(found, pa.large_binary())

    def word_ids(words: pa.Array) -> pa.Array:
        # What may hold the text of a special token is matched as it stands.
        lower = pc.if_else(pc.match_substring(words, "<|"), words, pc.ascii_lower(words)).dictionary_encode()
        plain = pc.extract_regex(lower.dictionary, _PLAIN)
        stems = pc.coalesce(pc.struct_field(plain, "stem"), lower.dictionary).dictionary_encode()
        tails = pc.fill_null(pc.struct_field(plain, "tail"), "").dictionary_encode()
        parts = [known(own.dictionary.to_pylist()).take(own.indices) for own in (stems, tails)]
        return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.large_binary())).take(lower.indices)

    def encode(column: pa.Array) -> list[bytes]:
        words = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        coded = words.values.dictionary_encode()
        # The ids of all words in order, and where each text ends among them.
        joined = word_ids(coded.dictionary).take(coded.indices)
        ends = np.frombuffer(joined.buffers()[1], np.int64)[words.offsets.to_numpy()].tolist()
        data = memoryview(joined.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]

    _encoders[path] = encode
    return encode


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = END_OF_DOCUMENT) -> DataFrame:
    """Per document: ``part``, ``before`` (tokens before it in its partition), ``tokens`` and ``ids`` (binary, unsigned 32-bit)."""

    def run(batches):
        encode = _encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for piece in slices(batches):
            ids = [found + end for found in encode(piece.column("text"))]
            tokens = np.array([len(found) // 4 for found in ids], np.int64)
            ends = before + np.cumsum(tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(ends - tokens),
                    pa.array(tokens),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "part", "before", "tokens", "ids"],
            )
            before = int(ends[-1])

    source = only(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, part int, before long, tokens long, ids binary")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = END_OF_DOCUMENT,
) -> DataFrame:
    """Boundary records of the packed stream, one per piece of a document in a sequence.

    Columns: ``doc_id``, ``start`` (the document's tokens before the piece), ``length``, ``ids`` (binary, little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` (place in the sequence) and ``padded_to`` (the length the sequence is
    padded to: ``sequence_tokens``, or its own length where that is a power of two). Only the last sequence can need padding.

    Null and empty texts give one piece that holds ``end_id`` alone; null and repeated ids and repeated rows are packed like any
    other row; other input columns are not read; an empty table gives no piece. A text of any length is cut across sequences.
    """
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    tokenize(docs, tokenizer_path, end_id).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    totals = stored.groupBy("part").agg(F.max(F.col("before") + F.col("tokens")).alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"),
        F.sum("total").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all"),
    )
    n = F.lit(sequence_tokens).cast("long")
    first, last = F.floor(F.col("at") / n), F.floor((F.col("at") + F.col("tokens") - 1) / n)
    # One row per input split of the first pass, so small whatever the documents hold.
    placed = stored.join(F.broadcast(offsets), "part").withColumn("at", F.col("base") + F.col("before"))
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(first, last)))
    start = F.greatest(F.lit(0), F.col("sequence_id") * n - F.col("at"))
    length = F.least(F.col("tokens"), (F.col("sequence_id") + 1) * n - F.col("at")) - start
    filled = F.least(n, F.col("all") - F.col("sequence_id") * n)
    is_power = filled.bitwiseAND(filled - 1) == 0
    return cut.select(
        "doc_id",
        start.alias("start"),
        length.alias("length"),
        F.substring("ids", (4 * start + 1).cast("int"), (4 * length).cast("int")).alias("ids"),
        F.col("tokens").alias("doc_tokens"),
        "sequence_id",
        (F.col("at") + start - F.col("sequence_id") * n).alias("offset"),
        F.when(is_power, filled).otherwise(n).alias("padded_to"),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` in order and ``padded_to``.

    A sequence holds at most ``sequence_tokens`` ids, so the group gathered per sequence is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda done, piece: F.concat(done, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.first("padded_to").alias("padded_to"))
