"""Shared session helpers: where lineage is cut, and name-safe columns."""

from __future__ import annotations

import ctypes
import threading
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these six ASCII white-space characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    The cluster names it in ``spark.checkpoint.dir``; only a session without
    that setting (tests, a laptop) gets one under ``/tmp/checkpoints``.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        held = context._jsc.sc().getCheckpointDir()
        if held.isDefined():
            found = held.get()
        else:
            context.setCheckpointDir(f"/tmp/checkpoints/{uuid.uuid4().hex}")
            found = context._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the shared folder; it outlives lost executors.

    A written table, not a checkpoint: a checkpoint hands the constraints of
    its plan on, and over the rounds of a loop the optimizer's work on them
    grows without end.  The sizes of the files also tell the planner what to broadcast.
    """
    return stored(df, "cut")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back: for tables as large as the input."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    spark = tables[0].sparkSession
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Seconds after which an idle Python worker lets go of its caches; Spark itself ends it after a minute.
IDLE_SECONDS = 3.0

_timers: dict[int, threading.Timer] = {}


def give_back() -> None:
    """Gives freed memory back: glibc and Arrow keep it, and an executor has up to twice as many workers as cores."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def _let_go(cache: dict) -> None:
    cache.clear()
    give_back()


@contextmanager
def in_use(cache: dict):
    """Keeps what ``cache`` (a module's) holds from task to task, and empties it once no task has used it for a while."""
    if timer := _timers.pop(id(cache), None):
        timer.cancel()
    try:
        yield cache
    finally:
        timer = _timers[id(cache)] = threading.Timer(IDLE_SECONDS, _let_go, [cache])
        timer.daemon = True
        timer.start()


#: Rows of a batch sent to Python: whole texts, which the JVM and Python both hold several times.
ARROW_ROWS = 256


def bound_batches(spark: SparkSession) -> None:
    """Fewer rows an Arrow batch than Spark's 10,000, for plans that send whole texts to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would fold all of Unicode)."""
    return F.translate(text, _UPPER, _UPPER.lower())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
