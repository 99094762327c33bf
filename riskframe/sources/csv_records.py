"""Records of CSV files whose quoted text may hold line breaks, read by many tasks per file.

Whether a line break ends a record depends on all quotes before it. Each line is therefore read
as a function of one bit: entered at the start of a record or inside quoted text, does it end
inside quoted text? Such functions compose, so

1. a first scan gives one composed function per file block (two bits per line go to Python,
   no text);
2. a window over these few rows, in file order, gives the state in which each block begins;
3. a second scan cuts every block into records by itself. Where a record crosses a block's end
   its pieces, two per block at most, are put together by a shuffle of these pieces alone.

A line with balanced quotes keeps the state, one with an opening or closing quote turns it.
Quotes inside unquoted text (``5" pipe``) are letters.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import MAX_BROADCAST_ROWS
from ..session import cut_lineage

# Runs in executor Python workers, which need pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TEXT = r'[^"]*+(?:""[^"]*+)*+'                          # quoted text up to a lone quote
_FIELDS = rf'(?:(?:"{_TEXT}"[^,]*+|(?!")[^,]*+),)*+'     # whole fields, each with its comma
OPENS = rf'^{_FIELDS}"{_TEXT}\z'
STAYS = rf'^{_TEXT}(?:"[^,]*+,{_FIELDS}"{_TEXT})?\z'

WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3
#: A record in more pieces than this has a quote that nothing closes.
MOST_PIECES = 64


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, line, opens, stays) in file order: ``start`` is the offset of the block."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), "value")
    quoted = F.contains("value", F.lit('"'))
    return lines.select(
        "file", "start", F.col("value").cast("binary").alias("line"),
        (quoted & F.col("value").rlike(OPENS)).alias("opens"),
        (~quoted | F.col("value").rlike(STAYS)).alias("stays"))


def _segments(b: pa.RecordBatch) -> Iterator[tuple[int, int, tuple[int, int]]]:
    """Ranges of a batch's rows that belong to one file block."""
    file = b.column("file").to_numpy(zero_copy_only=False)
    start = b.column("start").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
    edges = [0, *cuts.tolist(), b.num_rows]
    for i, j in zip(edges, edges[1:]):
        if j > i:
            yield i, j, (int(file[i]), int(start[i]))


def _bits(b: pa.RecordBatch, name: str, i: int, j: int) -> np.ndarray:
    return b.column(name).slice(i, j - i).to_numpy(zero_copy_only=False).astype(np.int8)


def states_after(opens: np.ndarray, stays: np.ndarray, entry: int) -> np.ndarray:
    """State after every line: 1 inside quoted text. ``entry`` is the state before the first."""
    fixed = np.where(opens == stays, np.arange(len(opens)), -1)  # lines that forget the state
    last = np.maximum.accumulate(fixed)
    turns = np.concatenate(([0], np.cumsum((opens == 1) & (stays == 0))))
    since = np.where(last >= 0, turns[1:] - turns[last + 1], turns[1:])
    return np.where(last >= 0, opens[last], entry) ^ (since & 1)


def _block_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its state after the last line, entered in state 0 and in state 1."""
    ends: dict[tuple[int, int], list[int]] = {}
    for b in batches:
        for i, j, key in _segments(b):
            opens, stays = _bits(b, "opens", i, j), _bits(b, "stays", i, j)
            now = ends.setdefault(key, [0, 1])
            ends[key] = [int(states_after(opens, stays, s)[-1]) for s in now]
    if ends:
        file, start = zip(*ends)
        f0, f1 = zip(*ends.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(file, pa.int64()), pa.array(start, pa.int64()), pa.array(f0, pa.int32()),
             pa.array(f1, pa.int32())], ["file", "start", "f0", "f1"])


def block_entries(lines: DataFrame) -> DataFrame:
    """(file, start, entry): the state in which every file block begins; a row per block."""
    blocks = lines.select("file", "start", "opens", "stays").mapInArrow(
        _block_functions, "file bigint, start bigint, f0 int, f1 int")
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turn = ((F.col("f0") == 1) & (F.col("f1") == 0)).cast("int")
    counted = blocks.withColumn("turns", F.sum(turn).over(order))
    fixed = F.last(F.when(F.col("f0") == F.col("f1"), F.struct("f0", "turns")),
                   ignorenulls=True).over(before)
    known = counted.select("file", "start", fixed.alias("fixed"), F.coalesce(
        F.sum(turn).over(before), F.lit(0)).alias("turns"))
    since = F.col("turns") - F.coalesce("fixed.turns", F.lit(0))
    return known.select("file", "start", F.coalesce("fixed.f0", F.lit(0)).bitwiseXOR(
        since.bitwiseAND(F.lit(1)).cast("int")).alias("entry"))


class _Block:
    """Cuts the lines of one file block into records; lines come in several portions."""

    def __init__(self, key: tuple[int, int], entry: int):
        self.key, self.state, self.entry = key, entry, entry
        self.first = key[1] == 0 and not entry  # the next record is the file's first
        self.began = not entry                  # a record has begun in this block
        self.open: list[bytes] = []             # lines of the record that has not ended

    def add(self, lines: pa.Array, opens: np.ndarray, stays: np.ndarray):
        """(texts, roles, first of file) of the records that end in this portion."""
        after = states_after(opens, stays, self.state)
        ends = np.flatnonzero(after == 0) + 1
        self.state = int(after[-1])
        if not len(ends):
            self.open += lines.to_pylist()
            return None
        cut = pa.array(np.concatenate(([0], ends)), pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(cut, lines.slice(0, int(ends[-1]))), b"\n")
        roles = np.full(len(ends), WHOLE, np.int32)
        first = np.zeros(len(ends), bool)
        roles[0], first[0] = (WHOLE if self.began else HEAD), self.first
        if self.open:
            texts = pa.concat_arrays([pa.array([b"\n".join([*self.open, texts[0].as_py()])],
                                               texts.type), texts.slice(1)])
        self.first, self.began = False, True
        self.open = lines.slice(int(ends[-1])).to_pylist()
        return texts, roles, first

    def rest(self):
        """The record that goes on in the next block, if there is one."""
        if not self.open:
            return None
        return (pa.array([b"\n".join(self.open)], pa.binary()),
                np.array([TAIL if self.began else MIDDLE], np.int32), np.array([self.first]))


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = None

    def rows(got):
        texts, roles, first = got
        n = len(roles)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block.key[0], np.int64)),
             pa.array(np.full(n, block.key[1], np.int64)), pa.array(roles), pa.array(first),
             texts.cast(pa.binary())], ["file", "start", "role", "first", "text"])

    for b in batches:
        for i, j, key in _segments(b):
            if block is None or key != block.key:
                if block is not None and (got := block.rest()):
                    yield rows(got)
                block = _Block(key, int(b.column("entry")[i].as_py()))
            got = block.add(b.column("line").slice(i, j - i), _bits(b, "opens", i, j),
                            _bits(b, "stays", i, j))
            if got:
                yield rows(got)
    if block is not None and (got := block.rest()):
        yield rows(got)


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records put together from the pieces on both sides of block ends."""
    place = F.when(F.col("role") == TAIL, F.lit(1)).otherwise(F.lit(0))
    order = Window.partitionBy("file").orderBy("start", "place")
    of = pieces.withColumn("place", place).withColumn("begin", F.last(
        F.when(F.col("role") == TAIL, F.col("start")), ignorenulls=True).over(order))
    whole = of.groupBy("file", "begin").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", F.col("text").cast("string").alias(
            "text")))).alias("parts"), F.max("first").alias("first"))
    checked = F.when(F.size("parts") <= MOST_PIECES, F.col("parts")).otherwise(F.raise_error(F.lit(
        f"a quoted text runs over more than {MOST_PIECES} file blocks: its quote is not closed")))
    return whole.select("file", "first", F.array_join(
        F.transform(checked, lambda p: p["text"]), "\n").alias("record"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): the text of every CSV record without its line end, ``first`` for a
    file's first one (the header); empty lines between records are left out.

    When this is called, two scans find the states of the blocks and the records that cross
    their ends; both are kept in the checkpoint folder, and every use of the result reads the
    files once more. A compressed file is one block. The text of a block's unfinished record is
    held in memory by its task.
    """
    lines = file_lines(spark, path)
    entries = cut_lineage(block_entries(lines))
    keys = ["file", "start"]
    if entries.count() <= MAX_BROADCAST_ROWS:   # three numbers a row
        entered = lines.join(F.broadcast(entries), keys)
    else:  # too many blocks to send to every task: dealt by block, lines in their order
        entered = (lines.withColumn("at", F.monotonically_increasing_id()).join(entries, keys)
                   .repartition(*keys).sortWithinPartitions(*keys, "at").drop("at"))
    cut = entered.mapInArrow(_cut_blocks, "file bigint, start bigint, role int, first boolean, "
                                          "text binary")
    whole = cut.filter(F.col("role") == WHOLE).select("file", "first", F.col("text").cast(
        "string").alias("record"))
    records = whole.unionByName(cut_lineage(_stitched(cut.filter(F.col("role") != WHOLE))))
    return records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).filter(
        F.col("record") != "")
