"""Shared plumbing of the training-data operators: inputs, written tables, Arrow maps."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import checkpoint_dir


def text_or_empty(col: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """The written tables of one run: what is written inside ``with`` belongs to it.

    :meth:`delete` removes them, once what reads them is stored; tables that others wrote, such
    as those of lazy results made before, stay. Runs may be nested.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.outer = spark, [], None

    def __enter__(self) -> Scratch:
        self.outer = _RUN.set(self)
        return self

    def __exit__(self, *_) -> None:
        _RUN.reset(self.outer)

    def delete(self) -> None:
        _delete(self.spark, self.paths)
        own = _SCRATCH.get(self.spark.sparkContext.applicationId, [])
        own[:] = [p for p in own if p not in set(self.paths)]
        self.paths = []


ROWS_PER_BATCH = 1000


@contextmanager
def short_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH):
    """While this lasts, jobs hand Python workers Arrow batches of at most ``rows`` rows.

    Spark's own limit of 10,000 whole texts is some tens of MB, held by the executor and by the
    worker, once per core and column of texts.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_RUN: ContextVar[Scratch | None] = ContextVar("scratch", default=None)
_SCRATCH: dict[str, list[str]] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    This cuts the lineage: later jobs read files that every executor reaches, so a lost
    executor costs no recomputation, and values that depend on how the input was split
    (row numbers of a partition) are fixed once. The table stays until :func:`forget`, the end
    of its :class:`Scratch`, or :func:`release`.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with short_batches(spark):
        df.write.parquet(path)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    if _RUN.get():
        _RUN.get().paths.append(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        own = _SCRATCH.get(df.sparkSession.sparkContext.applicationId, [])
        if df.scratch_path in own:
            own.remove(df.scratch_path)
            if _RUN.get() and df.scratch_path in _RUN.get().paths:
                _RUN.get().paths.remove(df.scratch_path)
            _delete(df.sparkSession, [df.scratch_path])


def release(spark: SparkSession) -> None:
    """Delete all written tables of this application, whoever wrote them: for its end."""
    _delete(spark, _SCRATCH.pop(spark.sparkContext.applicationId, []))


def lookup(big: DataFrame, small: DataFrame, on: list[str], spread: Column, how: str = "inner",
           fan: int = 32, most_bytes: int = 8 << 20) -> DataFrame:
    """``big`` joined with ``small``, safe where one key holds a third of ``big``.

    ``small`` is written and measured: up to ``most_bytes`` of data it is broadcast. Beyond,
    every row of it is repeated for ``fan`` salts and rows of ``big`` take one by a hash of
    ``spread``, so a hot key is dealt to ``fan`` tasks.
    """
    table = written(small, "lookup")
    width = F.coalesce(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns]))),
                       F.lit(0)) + 16
    if (table.agg(F.sum(width).alias("b")).first()["b"] or 0) <= most_bytes:
        return big.join(F.broadcast(table), on, how)
    salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(fan - 1))))
    dealt = big.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(fan)).cast("int"))
    return dealt.join(salted, [*on, "__salt"], how).drop("__salt")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application (``addPyFile``)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    path = f"{tempfile.mkdtemp(prefix='riskframe-code-')}/riskframe.zip"  # the driver's own copy
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable on every executor."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def byte_blocks(texts: list[str], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges ``[i, j)`` of consecutive texts of about ``limit`` characters (one text at least)."""
    i = size = 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield i, len(texts)
