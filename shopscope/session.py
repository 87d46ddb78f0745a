"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job needs for correct results (UTC wall clock, ANSI casts
# handled with try_*), plus adaptive execution for runtime re-planning.
# Broadcast policy: the planner never broadcasts on its own file-size
# estimate (compressed Parquet size can be far below the in-memory size);
# a join side is broadcast only when (a) the code hints it after a row-count
# bound (operators.sizing) or (b) adaptive execution has measured the
# shuffled side below the adaptive threshold at run time.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shopscope", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    Master, shuffle partitions and driver memory are set only when they are
    given, so those of ``spark-submit`` hold otherwise.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false") \
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local["):  # one process does all the work
        builder = builder.config("spark.driver.memory", os.environ.get("SHOPSCOPE_DRIVER_MEMORY", "16g"))
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


# Target input bytes per shuffle partition (the shuffled, projected rows are
# several times smaller), and a cap that keeps the driver's map-output
# tracking manageable on a large cluster.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 200_000


def partitions_for(input_bytes: int, cores: int, target: int = TARGET_PARTITION_BYTES) -> int:
    """Shuffle partitions for an input of ``input_bytes``: one per ``target``
    bytes, at least two per core, at most ``MAX_SHUFFLE_PARTITIONS``.
    Adaptive execution coalesces the excess at run time, so erring high is
    cheap; erring low makes tasks spill."""
    return min(MAX_SHUFFLE_PARTITIONS, max(2 * cores, -(-input_bytes // target)))


# Most order lines of a bucket on average: one task sorts a bucket's whole fact rows.
BUCKET_ROWS = 256 * 1024


def bucket_count(spark: SparkSession, rows: int = 0) -> int:
    """Buckets of a written table: the shuffle partitions, more if one would
    hold over ``BUCKET_ROWS`` of ``rows``, as far as Spark allows that many."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS)))


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Within, shuffles make ``n`` partitions, as many as the buckets they meet."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


_RAISED = "shopscope.shuffle.partitions"  # the session's own number, and what it was raised to


def raise_shuffle_partitions(spark: SparkSession, least: int) -> None:
    """From now on shuffles make at least ``least`` partitions, and no fewer than
    the session set itself; an earlier raise ends. Adaptive execution joins
    small partitions but splits none of an aggregate, so with a number that
    stays as it is a task's share would grow with the input."""
    now = spark.conf.get("spark.sql.shuffle.partitions")
    own, raised = spark.conf.get(_RAISED, f"{now} {now}").split()
    own = own if now == raised else now
    to = str(max(int(own), least))
    spark.conf.set("spark.sql.shuffle.partitions", to)
    spark.conf.set(_RAISED, f"{own} {to}")


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str, sort: Sequence[str]) -> None:
    """Overwrite a Parquet table bucketed on ``key``; rows should already lie by it."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(*sort).option("path", path) \
        .option("compression", "zstd").saveAsTable(table)


def read_bucketed(spark: SparkSession, table: str, path: str, buckets: int, key: str, sort: Sequence[str]) -> DataFrame:
    """Read a bucketed table; files of an earlier session are registered with their layout."""
    if not spark.catalog.tableExists(table):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet CLUSTERED BY ({key}) "
                  f"SORTED BY ({', '.join(sort)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def catalog_name(root: str, name: str) -> str:
    return f"shopscope_{name}_{hashlib.sha256(root.encode()).hexdigest()[:12]}"


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set shuffle partitions and the adaptive target size for an input size."""
    cores = spark.sparkContext.defaultParallelism
    n = partitions_for(input_bytes, cores)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * 1024 * 1024))
    return n


# Most bytes (compressed) that one task reads of a file or of coalesced shuffle
# blocks. Rows of a few narrow keys take many times that in memory, so larger
# defaults would let a task's hash maps and sorts grow with the input.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 32 * 1024 * 1024,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 * 1024 * 1024,
}


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", size.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit[:1] or "b")


def apply_required_conf(spark: SparkSession) -> None:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    for key, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for checkpoints and written tables.

    Taken from the session: ``spark.checkpoint.dir`` (or the folder given to
    ``setCheckpointDir``). Only a session that runs in this one process may go
    without: it uses ``SHOPSCOPE_SCRATCH`` or the temp folder of this machine.
    On a cluster a missing setting is an error, as each executor would write
    to a disk of its own.
    The path returned is the configured folder itself, not Spark's per-run
    sub-folder, so written tables can be found again by later runs.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/").rsplit("/", 1)[0]  # Spark adds a per-run uuid folder
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = os.environ.get("SHOPSCOPE_SCRATCH") or os.path.join(tempfile.gettempdir(), "shopscope-scratch")
    os.makedirs(local, exist_ok=True)
    sc.setCheckpointDir(local)
    return local
