"""Where intermediate results go when a plan has to be cut.

Everything lands in the shared folder that ``spark.checkpoint.dir`` names, so a
lost executor loses nothing.  Only a single-process local session without that
setting gets a folder of its own, one for the whole session.  Files stay until
whoever owns the folder removes them, but for tables written within `scratch`.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="meanline-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, store it reliably and drop its lineage."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/meanline/{name}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    The form to use for wide or large results: columnar, compressed, and later
    reads touch only the columns they ask for.
    """
    path = new_path(df.sparkSession, name)
    if blocks := _scratch.get():
        blocks[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Paths written within the blocks of `scratch` that are open in this thread, innermost last.
_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Remove what `shared_table` writes inside the block, in the same thread, when it ends.

    The block gets a function that stores a result for longer; only what went
    through it may be read afterwards.
    """
    outer = _scratch.get()
    own: list[str] = []
    token = _scratch.set((*outer, own))

    def keep(df: DataFrame, name: str) -> DataFrame:
        held = shared_table(df, name)
        path = own.pop()
        if outer:
            outer[-1].append(path)
        return held

    try:
        yield keep
    finally:
        _scratch.reset(token)
        failed = [error for path in own if (error := _removed(spark, path))]
        if failed:
            warnings.warn(f"{len(failed)} of {len(own)} intermediate tables are left: {failed[0]}", stacklevel=3)


def _removed(spark: SparkSession, path: str) -> str | None:
    """Remove one table; the reason if that fails, so that the others are removed all the same."""
    try:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception as error:
        return f"{path}: {type(error).__name__}"
    return None
