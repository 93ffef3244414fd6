"""Sinks S6-S8, S11: partition overwrite, write-then-swap, JSON lines."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from adpulse.session import shared_dir

#: Folders that ``materialize`` wrote inside the open ``scratch`` blocks, the innermost last.
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Own the scratch tables that the block makes: they are deleted when it ends.

    Only what this block (in this thread) stored goes, never what other queries
    of the session still read.  A result must be written before the block ends.
    Outside of any block scratch tables stay, as lazy results may read them.
    """
    made: list[str] = []
    token = _blocks.set((*_blocks.get(), made))
    try:
        yield made
    finally:
        _blocks.reset(token)
        for path in made:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, name)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder."""
    fs, p = _fs(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)]


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Whole-folder overwrite."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_partitions(df: DataFrame, path: str, partition_cols, clustered: bool = False) -> None:
    """Replace the partitions present in ``df`` and no others (a table that
    is fed partition by partition; ``replace_scope`` replaces a whole day or month).

    The rebalance hint lets AQE cluster rows by the partition values while
    splitting a hot partition value over several tasks, so each output folder
    gets a few right-sized files instead of one file per task.  Rows that are
    ``clustered`` by these columns already are not shuffled again.
    """
    df = df if clustered else df.hint("rebalance", *partition_cols)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols)
       .parquet(path))


def _beside(path: str, kind: str) -> str:
    """The hidden sibling of a folder: readers and partition discovery skip
    names that begin with ``_`` and hold no ``=``."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{kind}-{name.replace('=', '~')}"


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap of ``path`` that was cut short.

    A swap leaves one of three states: the target in place (at most leftovers
    beside it), or the target moved aside with a complete new folder (moved in
    now), or moved aside without one (moved back).
    """
    fs, target = _fs(spark, path)
    _, staged = _fs(spark, _beside(path, "new"))
    _, backup = _fs(spark, _beside(path, "old"))
    if not fs.exists(target) and fs.exists(backup):
        _, done = _fs(spark, _beside(path, "new") + "/_SUCCESS")
        source = staged if fs.exists(done) else backup
        if not fs.rename(source, target):
            raise OSError(f"could not restore {path}")
    for leftover in (staged, backup):
        if fs.exists(target) and fs.exists(leftover):
            fs.delete(leftover, True)


def recover_below(spark: SparkSession, path: str) -> None:
    """``recover`` for every partition folder below ``path`` that was being swapped."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("_old-"):
            recover(spark, f"{path}/{name[5:].replace('~', '=')}")
        elif status.isDirectory() and "=" in name:
            recover_below(spark, f"{path}/{name}")


def write_swap(df: DataFrame, path: str, partition_cols=()) -> None:
    """Overwrite a dataset that ``df`` itself reads.

    Writing straight into ``path`` would delete the input before it is read.
    The result is written completely to a hidden sibling first; then the old
    folder is moved aside, the new one moved into place, and only then is the
    old one deleted.  ``recover``, which the readers of such tables call, puts
    a complete table back whatever step a crash came after.
    """
    spark = df.sparkSession
    recover(spark, path)
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(_beside(path, "new"))
    fs, target = _fs(spark, path)
    _, backup = _fs(spark, _beside(path, "old"))
    if fs.exists(target) and not fs.rename(target, backup):
        raise OSError(f"could not move {path} aside")
    _, staged = _fs(spark, _beside(path, "new"))
    fs.mkdirs(target.getParent())
    if not fs.rename(staged, target):
        recover(spark, path)
        raise OSError(f"could not move the new {path} into place")
    recover(spark, path)


def scope_path(base: str, scope: dict) -> str:
    return "/".join([base.rstrip("/"), *(f"{k}={v}" for k, v in scope.items())])


def replace_scope(df: DataFrame, base: str, scope: dict, partition_cols=(), clustered: bool = False) -> None:
    """Make ``df`` the whole content of one scope (a day or a month) of a
    table with ``key=value`` folders, e.g. ``{"year": 2025, "month": 8}``.

    Everything the scope held before goes, also partitions and rows that the
    new result no longer has; an empty result leaves an empty scope.  Other
    scopes stay untouched.  Files are right-sized by AQE when ``partition_cols``
    spread the rows over folders, unless the rows are ``clustered`` by them already.
    """
    if partition_cols and not clustered:
        df = df.hint("rebalance", *partition_cols)
    write_swap(df, scope_path(base, scope), partition_cols)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line, null fields written as ``null``."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_search_csv(df: DataFrame, path: str) -> None:
    """Search list as CSV with a header; values keep their leading spaces."""
    (df.write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as Parquet under the shared scratch folder and return
    the table read back: later plans that use it twice scan it instead of
    recomputing it, and lineage is cut there (survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if blocks := _blocks.get():
        blocks[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
