"""Session settings and the two rules every job shares: what may be broadcast,
and where intermediate tables go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its bytes have a proven bound below this, or below a share of the
# smaller of the driver's and an executor's heap, as several may be held at once. The setting, in
# rows of ``ROW_BYTES``, replaces both.
BROADCAST_BYTES = 256 << 20
HEAP_SHARE = 32
# A zone-map row, with what a hash table adds to it.
ROW_BYTES = 64
SHARED_SETTING = "spark.checkpoint.dir"
BROADCAST_SETTING = "spark.cellwise.broadcastRows"


def local_session(
    app: str,
    cores: str = "8",
    memory: str = "12g",
    shuffle: str = "8",
    shared: str | None = None,
) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own settings."""
    builder = SparkSession.builder
    if shared:
        builder = builder.config(SHARED_SETTING, shared)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that all executors share, from ``spark.checkpoint.dir``.

    Only a local session may leave that unset; it then gets a folder beside its tables.
    """
    base = spark.conf.get(SHARED_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {SHARED_SETTING} to a folder all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        spark.conf.set(SHARED_SETTING, base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def removed(df: DataFrame) -> None:
    """Delete a table that ``written`` made and nobody reads any more."""
    base = df.sparkSession.conf.get(SHARED_SETTING).removeprefix("file:").strip("/")
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base in name:
            _delete(df.sparkSession, name)


# Tables of the runs that are under way, innermost last.
_RUNS: list[list[str]] = []


@contextmanager
def run_tables(spark: SparkSession) -> Iterator[None]:
    """Delete all tables that ``written`` makes within, when the run ends or fails."""
    _RUNS.append([])
    try:
        yield
    finally:
        for path in _RUNS.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, name: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    if _RUNS:
        _RUNS[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_rows(spark: SparkSession) -> int:
    """Rows of ``ROW_BYTES`` that may be broadcast."""
    rows = spark.conf.get(BROADCAST_SETTING, None)
    if rows is not None:
        return int(rows)
    context = spark.sparkContext
    heaps = [context._jvm.java.lang.Runtime.getRuntime().maxMemory()]
    if not context.master.startswith("local["):
        heaps.append(context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.executor.memory", "1g")))
    return min(BROADCAST_BYTES, min(heaps) // HEAP_SHARE) // ROW_BYTES


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions, for exchanges whose rows multiply later: those must not be merged."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(
    df: DataFrame, row_bound: int, row_bytes: int = ROW_BYTES, beyond: str | None = None
) -> DataFrame:
    """Mark ``df`` for broadcast if its proven bound in bytes allows it.

    That is ``row_bound`` rows of ``row_bytes``; pass the width of rows that hold more than a few
    numbers, or count the elements of their arrays as rows. A larger table is to be hashed if each
    of its shuffled parts stays within the bound, which spares the other side a sort; else Spark
    decides, or the hint ``beyond``: Spark goes by packed bytes, which say little of dense cells.
    """
    limit = broadcast_rows(df.sparkSession) * ROW_BYTES
    size = row_bound * row_bytes
    if size <= limit:
        return F.broadcast(df)
    if size / partitions(df.sparkSession) <= limit:
        return df.hint("shuffle_hash")
    return df if beyond is None else df.hint(beyond)
