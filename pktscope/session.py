"""Session helpers: a local session for tests and the bench, and the
shared checkpoint folder read from the session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "pktscope") -> SparkSession:
    """Local session used by tests and ``bench.py``.

    On a cluster, build the session with the cluster's own settings; the
    library only relies on AQE being on and the session time zone being UTC
    for display columns.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it.  Where it is unset, a private folder is made for a
    local master only (tests): on a cluster each executor would write to its
    own disk, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="pktscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - client sessions read the conf
        pass
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables on whatever store holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def observed(df: DataFrame, metrics: dict[str, Column], write) -> dict:
    """The values of aggregate ``metrics`` over the rows that ``write(df)``
    writes, gathered by the write itself.  Nothing may shuffle between ``df`` and
    the files, so each partition counts once even if its task is run again.
    A plan that Spark finds to be empty gives no values."""
    seen = Observation(f"written-{uuid.uuid4().hex}")
    write(df.observe(seen, *[m.alias(k) for k, m in metrics.items()]))
    return dict(seen.get)


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    jvm = spark._jvm.org.apache.hadoop.fs
    where = jvm.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).rename(where, jvm.Path(to)):
        raise OSError(f"could not rename {path} to {to}")


class Scratch:
    """One folder of intermediate tables below the shared checkpoint folder,
    deleted as a whole at the end of the job that owns it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        self._n = 0
        self.seen: dict[str, dict] = {}

    def land(self, df: DataFrame, name: str, metrics: dict[str, Column] | None = None) -> DataFrame:
        """Write ``df`` once as Parquet and read it back: cuts the lineage
        (survives executor loss) and lets several consumers read a columnar
        copy instead of recomputing the plan.  ``metrics`` (see ``observed``)
        are in ``seen[name]`` afterwards."""
        self._n += 1
        path = f"{self.path}/{self._n:02d}-{name}"
        if metrics:
            self.seen[name] = observed(df, metrics, lambda d: d.write.parquet(path))
        else:
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        remove_path(self.spark, self.path)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self.remove()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """A landed copy in a scratch folder of its own."""
    return Scratch(df.sparkSession, name).land(df, name)
