"""Shared helpers: the work folder, staged tables, row keys, word pattern."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_BATCH_BYTES = 4 * 1024 * 1024
# Words are maximal runs of anything but space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a session that runs in this one process (``local[..]``) may go
    without; it gets a temporary folder. Anywhere else a missing setting is an
    error, as files on one machine would be lost to the others.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return sc.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application).

    Functions that run in tasks are pickled by reference, so that what they
    cache lives as long as a Python worker; the workers must be able to import
    them, also where the package is installed on the driver alone.
    """
    sc = spark.sparkContext
    # Texts are long and uneven: what a Python worker gets at a time is bounded in bytes.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    if getattr(sc, "_llm_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="llm-ship-"), "shopscope_tasks.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._llm_shipped = True


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the
    work, and what was not deterministic (row ids, sampled ranges) is fixed.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows (all, if fewer) with the smallest hash of ``key``.

    A cut of the hash that leaves about twice as many rows is applied before
    they are sorted, so each task passes on its share of 2 n, not n rows.
    """
    total = df.count()
    top = 1 << 31
    hashed = F.pmod(F.xxhash64(key), F.lit(top))
    cut = top if total <= 4 * n else int(top * 2 * n / total)
    return df.where(hashed < cut).orderBy(hashed, key).limit(n)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """One string per (doc_id, text); a null id differs from every value."""
    ident = F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.lit("n"))
    body = F.coalesce(F.concat(F.lit("t"), F.col(text)), F.lit("n"))
    return F.sha2(F.concat_ws("\x1f", ident, body), 256)


def keep_rows(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is in ``keys``, one of each identical key.

    The semi join and the removal of repeated rows share one shuffle on the
    key, which is unique up to fully repeated rows, so it does not skew.
    """
    return docs.join(keys.select(key), key, "left_semi").dropDuplicates([key])
