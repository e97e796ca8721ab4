"""Records of CSV files with line breaks in quotes, read by many tasks per file.

Spark splits text files between lines, not between records. A line break ends a record only where an even
number of quotes came before it, so each block's lines are read twice: first to count its quotes (one row
per block), then, with the parity of the file's earlier blocks, to put lines together. Both are plain scans.
A record that is cut by a block's end is put together from its pieces, at most two a block, by a small
shuffle; this reads the lines once more, of which only those of blocks with such pieces go any further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardledger.sources.scratch import saved

# Blocks beyond the first of their file that one read may have: what is broadcast is a path and two numbers
# for each. At 128 MB a block this is 128 TB.
MOST_BLOCKS = 1_000_000

_WHOLE, _BEGUN, _INSIDE, _ENDED = 0, 1, 2, 3  # all of a record, or which part of it

_PIECES = "file string, block long, part int, first boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines in order, each with the file and the start of the block that it begins in."""
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _blocks(lines: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """(file, block, open, cut) of blocks that are not their file's first or have a piece of a record: does
    it begin within quotes, and has it a piece? And whether any has. The number of quotes before a place
    depends on the place alone, so it holds however a later scan is split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends_open = counted.withColumn("ends_open", F.sum("odd").over(upto) % 2 == 1)
    opened = F.col("ends_open") != (F.col("odd") == 1)
    found = ends_open.select("file", "block", opened.alias("open"), (opened | F.col("ends_open")).alias("cut"))
    found = saved(found.where("block > 0 or cut"), "blocks")
    n, n_cut = found.agg(F.count(F.lit(1)), F.count_if("cut")).first()
    if n > most:
        raise ValueError(f"{n} blocks, {most} at most: raise spark.sql.files.maxPartitionBytes")
    return found, n_cut > 0


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block, from lines in order (value, file, block, open)."""
    at, held, begins_open, first = None, [], False, False

    def pieces(records: list[str], parts: list[int], firsts: list[bool]) -> pa.RecordBatch:
        n = len(records)
        columns = [[at[0]] * n, [at[1]] * n, parts, firsts, records]
        types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["file", "block", "part", "first", "record"]
        )

    def rest() -> Iterator[pa.RecordBatch]:
        if held:
            part = _INSIDE if begins_open else _BEGUN
            yield pieces(["\n".join(held)], [part], [first])

    for batch in batches:
        files, blocks = batch["file"], batch["block"].to_numpy()
        codes = files.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(blocks)]):
            if hi == lo:
                continue
            if at != (files[int(lo)].as_py(), int(blocks[lo])):
                yield from rest()
                at, held = (files[int(lo)].as_py(), int(blocks[lo])), []
                begins_open, first = batch["open"][int(lo)].as_py(), at[1] == 0
                inside = begins_open
            value = batch["value"].slice(lo, hi - lo)
            odd = pc.count_substring(value, '"').to_numpy() % 2
            inside_after = (np.cumsum(odd) + inside) % 2 == 1
            inside = bool(inside_after[-1])
            text, ends = value.to_pylist(), np.flatnonzero(~inside_after)
            records, parts, firsts, begin = [], [], [], 0
            for end in ends.tolist():
                records.append("\n".join([*held, *text[begin : end + 1]]))
                parts.append(_ENDED if begins_open else _WHOLE)
                firsts.append(first)
                held, begins_open, first, begin = [], False, False, end + 1
            held.extend(text[begin:])
            yield pieces(records, parts, firsts)
    yield from rest()


def csv_records(spark: SparkSession, path: str, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """(record, header) of all CSV files at `path`: each record's text, and whether it is its file's first.

    Line breaks within quotes are part of a record; a quote is doubled within quotes and does not occur
    outside of them. Records of white space alone are left out. A file that ends within quotes is an error.
    """
    lines = _lines(spark, path)
    blocks, any_cut = _blocks(lines, most_blocks)
    lost = F.raise_error(F.lit("the files have changed while they were read")).cast("boolean")
    begins_open = F.when(F.col("block") == 0, F.lit(False)).otherwise(F.coalesce("open", lost))

    def pieces(blocks: DataFrame, how: str) -> DataFrame:
        known = lines.join(F.broadcast(blocks.select("file", "block", "open")), ["file", "block"], how)
        return known.select("value", "file", "block", begins_open.alias("open")).mapInArrow(_put_together, _PIECES)

    records = pieces(blocks, "left").where(F.col("part") == _WHOLE).select("record", "first")
    if any_cut:
        records = records.union(_mended(pieces(blocks.where("cut"), "inner").where(F.col("part") != _WHOLE)))
    records = records.where(F.col("record").rlike(r"\S"))
    return records.select(F.rtrim(F.col("record"), F.lit("\r")).alias("record"), F.col("first").alias("header"))


def _mended(pieces: DataFrame) -> DataFrame:
    """(record, first) of the records that lie in more than one block."""
    in_file = Window.partitionBy("file").orderBy("block", F.col("part") == _BEGUN)
    numbered = pieces.withColumn("number", F.sum((F.col("part") == _BEGUN).cast("long")).over(in_file))
    joined = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "part", "record"))).alias("pieces"),
        F.bool_or("first").alias("first"),
        F.bool_or(F.col("part") == _ENDED).alias("ended"),
    )
    text = F.array_join(F.col("pieces.record"), "\n")
    unfinished = F.raise_error(F.concat(F.col("file"), F.lit(" ends within quotes"))).cast("string")
    return joined.select(F.when(F.col("ended"), text).otherwise(unfinished).alias("record"), "first")
