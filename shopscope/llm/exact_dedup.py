"""Exact dedup against a persistent digest index.

The index is a Parquet table of one row per distinct normalised text, bucketed
and sorted by the text's SHA-256. A new batch is grouped by digest (partial
aggregation, so a group of copies is combined before the shuffle), groups
already known are removed by a sort-merge anti join against the index (which
its buckets save from a shuffle), and the rest are appended. Every row of the
batch then learns its keeper through a join on the digest; both join sides are
plain shuffles of written tables, so adaptive execution splits a hot digest.

Cases: a null text counts as empty, and all empty texts are equal. Among equal
texts the smallest doc_id stays, a null id last; of fully repeated rows exactly
one is kept. Other columns of the input are ignored. An empty batch leaves the
index as it was and gives no rows. Running a batch again adds nothing twice,
since the anti join finds what was appended. What it keeps depends on the batch
id: the texts are in the index before the caller has written the result, so a
job that may be run again after a failure must give ``batch_id``. The rerun
under the same id then finds its own entries, keeps the same texts again, and
completes an append that broke off. Without an id each call is a batch of its
own, and a repeat counts as copies of what was there: none of it is kept.

One job at a time should write an index. Two that ingest at once may both
append a text; the index then holds its digest twice, and readers see the entry
of the smaller batch id: rows are never multiplied, and later batches agree on
one keeper. ``compact`` leaves that entry alone.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, keep_rows, new_path, row_key, stage, text_or_empty

# Runs of white space become one space; a lone space already is one, and
# leaving it unmatched spares the regex most of its work.
_RUNS = r"[\t-\r][ \t-\r]*| [ \t-\r]+"


def digest(text: str | Column) -> Column:
    """SHA-256 (hex) of the text with each white-space run as one space."""
    return F.sha2(F.regexp_replace(text_or_empty(text), _RUNS, " "), 256)


class DigestIndex:
    """Persistent table (digest, keep_id, batch), bucketed and sorted by digest.

    ``buckets`` counts only when the index is created (default: the session's
    shuffle partitions); it is recorded beside the data and read when the
    index is opened again, also by another session.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint",
                 buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.name = "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()
        meta = f"{self.path}/meta"
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(meta)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            row = spark.read.parquet(meta).first()
            self.buckets, id_type = row["buckets"], row["id_type"]
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(self.buckets, id_type)], "buckets int, id_type string") \
                .coalesce(1).write.parquet(meta)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id {id_type}, batch STRING) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}/data'")

    def table(self) -> DataFrame:
        """The entries, one per digest. Buckets hold all entries of a digest, so
        this needs no shuffle."""
        self.spark.catalog.refreshTable(self.name)
        first = F.min(F.struct("batch", F.col("keep_id").isNull().alias("no_id"), "keep_id")).alias("first")
        return self.spark.table(self.name).groupBy("digest").agg(first) \
            .select("digest", "first.keep_id", "first.batch")

    def ingest(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               carry: Column | None = None, batch_id: str | None = None) -> DataFrame:
        """Deduplicate a batch, append its new texts, return one row per row of it.

        ``batch_id`` names these rows for good: give it, and give it again when
        the same rows are run again after a failure. It must not be used for
        other rows. Default: a new one per call.

        Returns doc_id, keep_id, group_size (rows of this batch with the
        text), kept, text_sha256, and ``carry`` if given. Rows whose text an
        earlier batch brought are not kept; their keep_id is the indexed one.
        """
        columns = [F.col(doc_id).alias("doc_id"), digest(text).alias("digest"),
                   F.monotonically_increasing_id().alias("row_id")]
        if carry is not None:
            columns.append(carry.alias("carry"))
        rows = stage(docs.select(*columns), "digests")
        batch = uuid.uuid4().hex if batch_id is None else batch_id
        groups = stage(
            rows.groupBy("digest").agg(
                F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("first"),
                F.count("*").alias("group_size"))
            .select("digest", F.col("first.doc_id").alias("first_id"),
                    F.col("first.row_id").alias("first_row"), "group_size"), "digest-groups")
        self.spark.catalog.refreshTable(self.name)
        entries = self.spark.table(self.name)  # an anti join needs no distinct digests
        fresh = groups.join(entries.select("digest").hint("merge"), "digest", "left_anti")
        (fresh.select("digest", F.col("first_id").alias("keep_id"), F.lit(batch).alias("batch"))
         .repartition(self.buckets, "digest").write.insertInto(self.name))
        known = stage(
            groups.join(self.table().hint("merge"), "digest")
            .select("digest", "keep_id", "first_row", "group_size",
                    (F.col("batch") == batch).alias("fresh")), "digest-keepers")
        out = rows.join(known, "digest").select(
            "doc_id", "keep_id", "group_size",
            (F.col("fresh") & (F.col("row_id") == F.col("first_row"))).alias("kept"),
            F.col("digest").alias("text_sha256"),
            *([F.col("carry")] if carry is not None else []))
        return out

    def compact(self) -> "DigestIndex":
        """Rewrite the index at a new path with one sorted file per bucket, after many appends."""
        fresh = DigestIndex(self.spark, new_path(self.spark, "index"), buckets=self.buckets,
                            id_type=self.table().schema["keep_id"].dataType.simpleString())
        self.table().repartition(self.buckets, "digest").write.insertInto(fresh.name)
        return fresh


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, doc_id: str = "doc_id",
                text: str = "text", carry: Column | None = None, batch_id: str | None = None) -> DataFrame:
    """Deduplicate against ``index``, or against a new, empty one; ``batch_id`` as for ``DigestIndex.ingest``."""
    spark = docs.sparkSession
    if index is None:
        index = DigestIndex(spark, new_path(spark, "index"),
                            docs.schema[doc_id].dataType.simpleString())
    return index.ingest(docs, doc_id, text, carry, batch_id)


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts, columns unchanged."""
    key = free_name(docs, "_row_key")
    kept = exact_dedup(docs, doc_id=doc_id, text=text, carry=row_key(doc_id, text)) \
        .where("kept").select(F.col("carry").alias(key))
    return keep_rows(docs.withColumn(key, row_key(doc_id, text)), kept, key).select(*docs.columns)
