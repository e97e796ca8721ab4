"""The running-limit rule, where each verdict depends on the verdicts before it.

A row passes when amount + pending < room (limit less balance); a row that passes every rule adds
its amount to the pending balance of its card. No window can say that, so this is the one place
with row code: a fold over the rows of a card in arrival order, with the pending balance carried
from one Arrow batch to the next.

A card with very many rows is cut into chunks that are folded at the same time. For that the
pending balance at the start of each chunk must be known. It is found in rounds:

* Fold each chunk from a guess. All verdicts stay the same if the start moves by less than the
  smallest margin by which a verdict was reached, so one fold gives the end of the chunk for a
  whole interval of starts (a *piece* of the chunk's end-by-start function).
* Walk over the chunks of a card, with pieces only: as long as the balance lies in a known piece,
  the next start is known. Where it does not, fold that chunk again from there in the next round,
  and go on with the end of the nearest piece as the guess for later chunks.

The first chunk that had to be folded again had an exact start, so each round settles at least
one more chunk of every card, and the rounds end. As trajectories from different starts meet, they
end soon: a few rounds settle hundreds of chunks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from cardledger.operators.hot import HOT_ROWS
from cardledger.sources.scratch import saved, scratch_path

_PIECE = "card_id long, chunk long, start long, end long, down long, up long"
_WALK = "card_id long, chunk long, start long, settled int"
# Larger than any sum of millionths, and small enough to be added to one.
_FAR = 1 << 61


def fold_rows(
    amounts: Iterable[int],
    rooms: Iterable[int],
    guards: Iterable[bool],
    opens: Iterable[bool],
    pending: int,
) -> tuple[list[int], list[bool], int, int]:
    """Fold rows of one card from a given pending balance.

    `guards`: whether the pending balance counts for the row; `opens`: whether the row passes all
    other rules. Returns the pending balance after each row, whether the total rule failed, and by
    how much the start may go down (at most) and up (less than) without changing a verdict.
    """
    after, failed = [], []
    down, up = -_FAR, _FAR
    for amount, room, guard, is_open in zip(amounts, rooms, guards, opens):
        margin = room - amount - (pending if guard else 0)
        failed.append(margin <= 0)
        if is_open:
            if margin > 0:
                if guard and margin < up:
                    up = margin
                pending += amount
            elif guard and margin > down:
                down = margin
        after.append(pending)
    return after, failed, down, up


# What the fold reads, besides the columns it passes on.
_FOLDED = ["card_id", "_chunk", "amount_micros", "_room", "_guard", "_open"]


def fold_by_card(df: DataFrame, keep: list[str], order: list[str]) -> DataFrame:
    """The columns `keep` of `df` with `pending_micros` (after the row) and `total_fails`.

    `df` is partitioned by card_id, as `running_by_key` leaves it, and has amount_micros, `_room`
    (limit less balance), `_guard` and `_open` (see `fold_rows`).
    """
    no_chunk = F.when(F.col("card_id").isNull(), -1).otherwise(0).cast("long")
    rows = df.sortWithinPartitions("card_id", *order).withColumns(
        {"_chunk": no_chunk, "_start": F.lit(0).cast("long")}
    )
    return _fold(rows, keep)


def fold_by_chunk(
    df: DataFrame,
    keep: list[str],
    order: list[str],
    chunk_rows: int = HOT_ROWS,
) -> DataFrame:
    """As `fold_by_card`, for hot cards, with many tasks per card.

    `df` may be in any order; its column `position` numbers the rows of a card, from one.
    """
    number = F.floor((F.col("position") - 1) / F.lit(chunk_rows)).cast("long")
    # Rows without a card change nothing; negative chunks keep them apart from card 0.
    chunk = F.when(F.col("card_id").isNull(), -1 - number).otherwise(number)
    # Every round reads some of these rows. They are stored in folders of 64 chunk numbers, as
    # later rounds need few chunks.
    rows = df.withColumn("_chunk", chunk).withColumn("_folder", F.floor(F.col("_chunk") / 64))
    columns = dict.fromkeys([*_FOLDED, *order, *keep, "_folder"])
    rows = saved(rows.select(*columns).repartition("card_id", "_chunk"), "chunks", "_folder")

    starts = chunk_starts(rows, order).select(
        F.col("card_id").alias("_c"), F.col("chunk").alias("_k"), F.col("start").alias("_s")
    )
    same = (F.col("card_id") == F.col("_c")) & (F.col("_chunk") == F.col("_k"))
    rows = (
        # Broadcast: one start per chunk_rows rows of the table, at most.
        rows.join(F.broadcast(starts), same, "left")
        .withColumn("_start", F.coalesce("_s", F.lit(0)))
        .repartition("card_id", "_chunk")
        .sortWithinPartitions("card_id", "_chunk", *order)
    )
    return _fold(rows, keep)


def _fold(rows: DataFrame, keep: list[str]) -> DataFrame:
    # Arrow carries no more than the fold reads and the caller keeps.
    rows = rows.select(*dict.fromkeys([*_FOLDED, "_start", *keep]))
    schema = StructType(
        [rows.schema[c] for c in keep]
        + [StructField("pending_micros", LongType()), StructField("total_fails", BooleanType())]
    )
    return rows.mapInArrow(lambda batches: _fold_batches(batches, keep), schema)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """Stretches of a batch with the same card and chunk: (key, first row, end row)."""
    cards = batch.column("card_id").fill_null(0).to_numpy(zero_copy_only=False)
    chunks = batch.column("_chunk").to_numpy(zero_copy_only=False)
    if len(cards) == 0:
        return
    changes = ((cards[1:] != cards[:-1]) | (chunks[1:] != chunks[:-1])).nonzero()[0] + 1
    bounds = [0, *changes.tolist(), len(cards)]
    for lo, hi in zip(bounds, bounds[1:]):
        yield (int(cards[lo]), int(chunks[lo])), lo, hi


def _lists(batch: pa.RecordBatch) -> list[list]:
    return [batch.column(c).to_pylist() for c in ("amount_micros", "_room", "_guard", "_open")]


def _fold_batches(batches: Iterable[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    current, pending = None, 0
    for batch in batches:
        columns = _lists(batch)
        starts = batch.column("_start")
        after, failed = [], []
        for key, lo, hi in _runs(batch):
            if key != current:
                current, pending = key, starts[lo].as_py()
            got, over, _, _ = fold_rows(*(c[lo:hi] for c in columns), pending)
            after += got
            failed += over
            pending = got[-1]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in keep]
            + [pa.array(after, pa.int64()), pa.array(failed, pa.bool_())],
            names=[*keep, "pending_micros", "total_fails"],
        )


def _piece_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One piece per (card, chunk): its start and end, and how far the start may move."""
    current, piece = None, None

    def out(p):
        return pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) for v in p],
            names=["card_id", "chunk", "start", "end", "down", "up"],
        )

    for batch in batches:
        columns = _lists(batch)
        starts = batch.column("_start")
        for key, lo, hi in _runs(batch):
            if key != current:
                if piece:
                    yield out(piece)
                start = starts[lo].as_py()
                current, piece = key, [*key, start, start, -_FAR, _FAR]
            got, _, down, up = fold_rows(*(c[lo:hi] for c in columns), piece[3])
            piece[3:] = [got[-1], max(piece[4], down), min(piece[5], up)]
    if piece:
        yield out(piece)


def chunk_starts(rows: DataFrame, order: list[str]) -> DataFrame:
    """The pending balance at the start of every chunk: card_id, chunk, start."""
    spark = rows.sparkSession
    rows = rows.filter(F.col("card_id").isNotNull())
    to_fold = rows.select(
        "card_id", F.col("_chunk").alias("chunk"), F.lit(0).cast("long").alias("start")
    ).distinct()
    pieces = scratch_path(spark, "pieces")
    # The driver sees no rows in this loop, only whether a round left anything open.
    while True:
        _fold_pieces(rows, to_fold, order).write.mode("append").parquet(pieces)
        known = spark.read.schema(_PIECE).parquet(pieces)
        walked = saved(known.groupBy("card_id").applyInPandas(_walk, _WALK), "walk")
        to_fold = walked.filter(F.col("settled") == 0).select("card_id", "chunk", "start")
        if to_fold.isEmpty():
            return walked.select("card_id", "chunk", "start")


def _fold_pieces(rows: DataFrame, to_fold: DataFrame, order: list[str]) -> DataFrame:
    wanted = to_fold.select(
        F.col("card_id").alias("_c"),
        F.col("chunk").alias("_k"),
        F.floor(F.col("chunk") / 64).alias("_f"),
        F.col("start").alias("_start"),
    )
    same = (
        (F.col("_folder") == F.col("_f"))
        & (F.col("card_id") == F.col("_c"))
        & (F.col("_chunk") == F.col("_k"))
    )
    return (
        rows.join(F.broadcast(wanted), same)
        .select(*_FOLDED, "_start", *order)
        .repartition("card_id", "_chunk")
        .sortWithinPartitions("card_id", "_chunk", *order)
        .mapInArrow(_piece_batches, _PIECE)
    )


def _walk(pieces: pd.DataFrame) -> pd.DataFrame:
    """Carry the pending balance over the chunks of one card (one row per chunk and fold)."""
    card = int(pieces["card_id"].iloc[0])
    columns = [pieces[c].tolist() for c in ("chunk", "start", "end", "down", "up")]
    pending, out = 0, []
    for chunk, known in groupby(sorted(zip(*columns)), itemgetter(0)):

        def misfit(piece):
            shift = pending - piece[1]
            return not piece[3] <= shift < piece[4], abs(shift)

        piece = min(known, key=misfit)
        settled = not misfit(piece)[0]
        out.append((card, chunk, pending, int(settled)))
        pending = piece[2] + (pending - piece[1] if settled else 0)
    return pd.DataFrame(out, columns=["card_id", "chunk", "start", "settled"])
