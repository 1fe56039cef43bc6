"""Session settings, reliable cut points and scratch locations."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the engine expects.  AQE merges small shuffle partitions and splits
# skewed join partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # A value that does not parse is an error, never a silent NULL.
    "spark.sql.ansi.enabled": "true",
    # Top-k per key is cut on the map side up to this k.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def sized_for(input_bytes: int, partition_mb: int = 128, split_mb: int = 128) -> dict[str, str]:
    """Shuffle and scan settings for an input of this size.

    A shuffle partition holds about ``partition_mb`` before AQE merges small
    ones, so that sorts and windows fit into executor memory; there is no upper
    limit on their number.  ``split_mb`` is the size of a scan task.
    """
    partitions = max(200, -(-input_bytes // (partition_mb * 2**20)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
    }


def build_session(
    app: str = "rankloom", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Session with the engine's settings; ``spark__sql__x="y"`` overrides one."""
    sizing = sized_for(input_bytes) if input_bytes else {}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **sizing, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is absent and the master
    is local (tests); on a cluster a missing setting is an error, because every
    executor would write to a disk of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder when the master is {master!r}")
        configured = tempfile.mkdtemp(prefix="rankloom-")
        spark.sparkContext.setCheckpointDir(configured)
    # With its scheme, so that readers outside Spark find the same folder.
    path = spark._jvm.org.apache.hadoop.fs.Path(configured)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


# The scopes open in this context (paths, and tables of the catalog); another thread or task has its own.
_open_scopes: ContextVar[tuple[tuple[list[str], list[str]], ...]] = ContextVar("open_scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/rankloom-{name}-{uuid.uuid4().hex}"
    for paths, _ in _open_scopes.get():
        paths.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the intermediate tables made inside the block when it ends.

    Results must be written or collected before that.  Tables made outside any
    scope stay until the shared folder is cleaned.  Scopes belong to the thread
    that opened them: a job in another thread keeps its own tables.
    """
    made: list[str] = []
    tables: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), (made, tables)))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in made:
            location = spark._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a table is read more than once and must be identical each time
    (range-partitioned row positions) or where recomputing it is expensive.
    The lineage ends at files that outlive lost executors, and being columnar
    they give later steps column pruning and real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """``df`` written in buckets of ``key``, sorted inside them, and read back.

    Joins on the key read the buckets as they lie: this side is not shuffled,
    however often it is joined.  ``buckets`` defaults to the number of shuffle
    partitions.  The catalog holds an external table until its scope ends.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"rankloom_{uuid.uuid4().hex}", scratch_path(spark, "buckets")
    for _, tables in _open_scopes.get():
        tables.append(name)
    # One task per bucket, so a bucket is one file.
    placed = df.repartition(buckets, df[key]).sortWithinPartitions(df[key])
    placed.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)
