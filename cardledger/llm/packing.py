"""Packing: shortest-pack-first over the histogram of lengths.

Documents are tokenised once, in place; what moves from then on is one slim row per piece. A
document longer than a sequence is cut at multiples of the sequence's size, so only its last piece
is shorter. The lengths' histogram (at most `size` rows, whatever the corpus) goes to the driver,
where lengths are placed longest first into the packs with the least content, all equal packs at
once: a pattern and a count, never single documents. Pieces then find their place by their rank
among the pieces of their length.

Defined cases: a null or empty text is the closing id alone. Each row of the input is packed, so a
repeated row is packed again. An empty table gives no rows. Pieces of equal length are ranked by
document id, start and digest. Strings of special tokens inside a text get the ids that the tokenizer gives them.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from cardledger.llm.ranks import with_rank
from cardledger.llm.texts import as_bytes
from cardledger.sources.scratch import saved

SIZE = 2048
CLOSING_ID = 1
BLOCK_CHARS = 1 << 20  # a longer text is tokenised in parts cut where tokens never join

PIECES = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
        StructField("doc_tokens", LongType()),
    ]
)


Special = tuple[tuple[str, int], ...]


def special_tokens(tokenizer_path: str) -> Special:
    """The tokenizer file's special tokens with their ids; read once, and sent to the tasks."""
    with open(tokenizer_path, encoding="utf-8") as f:
        return tuple((t["content"], t["id"]) for t in json.load(f).get("added_tokens", []))


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str, special: Special = ()) -> tiktoken.Encoding:
    """The vocabulary as ranks: the same ids as the tokenizer file's, several times faster.

    Special tokens have their own ids where their strings stand in a text, as they have there.
    """
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = {number for _, number in special}
    ranks = {token: number for token, number in ranks.items() if number not in own}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def encode(enc: tiktoken.Encoding, text: str, tokenizer_path: str) -> np.ndarray:
    """Ids of a whole text. Between a letter and a following blank the pattern always cuts, so a very
    long text is tokenised in parts that end there, with the same ids as in one go. Runs of blanks
    too long for the pattern's stack are left to the slower tokenizer."""
    parts, at = [], 0
    while at < len(text):
        end = at + BLOCK_CHARS
        while end < len(text) and not (text[end - 1].isalpha() and text[end] == " "):
            end += 1
        try:
            parts.append(enc.encode_to_numpy(text[at:end], allowed_special="all"))
        except ValueError:
            parts.append(np.array(tokenizer(tokenizer_path).encode(text[at:end], add_special_tokens=False).ids))
        at = end
    return np.concatenate(parts).astype("<u4") if parts else np.zeros(0, "<u4")


@dataclass(frozen=True)
class Vocabulary:
    """Where a tokenizer's files are, and the pattern that cuts texts before it."""

    tokenizer_path: str
    ranks_path: str
    pattern: str


def pieces(docs: DataFrame, vocabulary: Vocabulary, size: int = SIZE, closing: int = CLOSING_ID) -> DataFrame:
    """PIECES: each document's ids, closed by `closing`, cut into pieces of at most `size`."""
    special = special_tokens(vocabulary.tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary.ranks_path, vocabulary.pattern, special)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), as_bytes(batch["text"])):
                ids = np.append(encode(enc, text.decode(), vocabulary.tokenizer_path), np.uint32(closing)).astype("<u4")
                for start in range(0, len(ids), size):
                    piece = ids[start : start + size]
                    row = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=PIECES.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def patterns(histogram: dict[int, int], size: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Shortest-pack-first: (((length, how many), ...) longest first, number of such packs).

    Lengths come longest first. Each goes to the packs with the most room left, as many as there are
    of them, and several times into a pack when pieces outnumber packs. What does not fit anywhere
    opens new packs. Work and result depend on the number of lengths, not of pieces.
    """
    by_room: list[dict[tuple, int]] = [{} for _ in range(size + 1)]

    def put(room: int, pattern: tuple, count: int) -> None:
        by_room[room][pattern] = by_room[room].get(pattern, 0) + count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        room = size
        while left and room >= length:
            while room >= length and not by_room[room]:
                room -= 1
            if room < length:
                break
            pattern, count = by_room[room].popitem()
            used = min(left, count)
            if used < count:
                put(room, pattern, count - used)
            put(room - length, pattern + ((length, 1),), used)
            left -= used
        if left:  # no pack has room: open new ones, each filled before the next is opened
            most = size // length
            packs, rest = divmod(left, most)
            if packs:
                put(size - most * length, ((length, most),), packs)
            if rest:
                put(size - rest * length, ((length, rest),), 1)
    out: dict[tuple, int] = {}
    for packs in by_room:
        for pattern, count in packs.items():
            merged: list[list[int]] = []
            for length, n in pattern:
                if merged and merged[-1][0] == length:
                    merged[-1][1] += n
                else:
                    merged.append([length, n])
            key = tuple(map(tuple, merged))
            out[key] = out.get(key, 0) + count
    return sorted(out.items(), reverse=True)


SLOTS = "length long, low long, high long, each long, base long, first long"


def slots(packed: list[tuple[tuple[tuple[int, int], ...], int]]) -> list[tuple[int, ...]]:
    """Ranges of ranks per length: rank r of [low, high) lies in pack first + (r - low) // each."""
    out, taken, first = [], {}, 0
    for pattern, count in packed:
        base = 0
        for length, each in pattern:
            low = taken.get(length, 0)
            taken[length] = low + each * count
            out.append((length, low, taken[length], each, base, first))
            base += length * each
        first += count
    return out


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """PIECES with sequence_id and offset. `cut` must be a table: it is read three times."""
    spark = cut.sparkSession
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.createDataFrame(slots(patterns(histogram, size)), SLOTS).withColumnRenamed("length", "_length")
    order = ["doc_id", "start", "ids_crc32"]
    ranked = with_rank(cut, ["length"], order, sum(histogram.values()), "_rank")
    within = F.col("_rank") - F.col("low")
    # At most a few ranges per length and step of room: bounded by `size`, whatever the corpus.
    return ranked.join(
        F.broadcast(table),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high")),
    ).select(
        *PIECES.names,
        (F.col("first") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + within % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: Vocabulary, size: int = SIZE) -> DataFrame:
    """Tokenise, cut and pack all rows of `docs`."""
    return pack(saved(pieces(docs, vocabulary, size), "pieces"), size)
