"""Helpers that the corpus operators share: written intermediate tables and size-checked joins."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side of a join may be broadcast; rows of such sides are a few numbers and short strings.
BROADCAST_ROWS = 50_000
#: Bytes of a batch that goes to a Python worker: whole texts are long, and 10,000 of them are too many at once.
BATCH_BYTES = 8 << 20
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: Tables made by written() in the innermost intermediates().
_MADE: list[list[DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; a temporary one only where none is set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="phenolith-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Bound batches for Python workers by BATCH_BYTES where the session has not set a bound of its own; a longer text is a batch alone."""
    if spark.conf.get(_BATCH, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


def trimmed() -> None:
    """Give freed memory of this worker process back: workers are reused, and what one operator needed would count for the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(run: Callable) -> Callable:
    """A function for mapInArrow whose worker gives its memory back when the task ends."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trimmed()

    return wrapped


def unused(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like the given ones that none of those taken equals, case apart."""
    have, out = {c.lower() for c in taken}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def written(df: DataFrame, name: str, keep: bool = False, **options: object) -> DataFrame:
    """df, written as Parquet in the shared folder and reread: its lineage ends there, so lost executors cost no rerun. keep: it outlives intermediates()."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/phenolith/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    if _MADE and not keep:
        _MADE[-1].append(out)
    return out


@contextmanager
def intermediates() -> Iterator[None]:
    """Tables made by written() inside are deleted at the end: only for plans that have run by then."""
    _MADE.append([])
    try:
        yield
    finally:
        for df in _MADE.pop():
            drop_written(df)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that have run: its cleaner waits for the driver's garbage collection, which may not come for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by written() that no later plan reads."""
    path = getattr(df, "_written_at", None)
    if path:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if a count shows at most limit rows, else unchanged: then Spark joins by shuffle and splits skewed keys."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed(rows: DataFrame) -> DataFrame:
    """(key, id, z): texts as Zstandard frames, which halves what a shuffle writes."""

    small_batches(rows.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                z = [press.compress(t.as_py() or b"") for t in part.column(2).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(z, pa.binary())], ["key", "id", "z"])

    return rows.mapInArrow(run, "key long, id long, z binary")
