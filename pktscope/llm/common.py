"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pktscope.session import remove_path, scratch_path

#: Word separators of every word rule in this package: space and \t..\r.
SPACES = " \t\n\x0b\x0c\r"
SPACES_RE = "[\\x20\\x09-\\x0D]+"


def by_value(module_name: str) -> None:
    """Ship the task functions of a module with the task, so executors need
    no installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


by_value(__name__)


#: Folders that the innermost ``temporary`` scopes own.
_SCOPES: list[list[str]] = []


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store: a bare one is on the cluster's default file
    system, not on the disk of whichever machine reads it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return where.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir`` (shared storage)."""
    path = qualified(spark, scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}"))
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def temporary(spark: SparkSession):
    """The folders that operators make inside the block are removed at its end.
    Results are lazy and read them, so they are to be written inside the block, to a
    folder named outside of it."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove_path(spark, path)


def land(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back: cuts the
    lineage, so a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column has it (Spark's
    names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its literal name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_key(text: str) -> Column:
    """Tells rows with one id and different texts apart (null: empty)."""
    return F.xxhash64(F.coalesce(col(text).cast("string"), F.lit("")))


def without(docs: DataFrame, dropped: DataFrame, id_col: str, text_col: str,
            also: str | None = None) -> DataFrame:
    """``docs`` without the rows whose (id, text key) is in ``dropped``
    (columns ``id``, ``key``, and ``host`` to be compared with column
    ``also``).  Nulls match nulls."""
    names = [fresh(docs.columns, n) for n in ("__gone_id", "__gone_key", "__gone_host")]
    gone = dropped.select("id", "key", *["host"] * bool(also)).toDF(*names[:2 + bool(also)])
    on = col(id_col).eqNullSafe(F.col(names[0])) & (text_key(text_col) == F.col(names[1]))
    if also:
        on = on & col(also).eqNullSafe(F.col(names[2]))
    return docs.join(gone, on, "left_anti")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``, which is evaluated once per
    row however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def open_fs(uri: str):
    """(pyarrow file system, path) of a folder on shared storage."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)
