import os
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shopscope.session import build_session
    scratch = tempfile.mkdtemp(prefix="shopscope-tests-")
    spark = build_session("local[*]", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
    })
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield spark
    spark.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="shopscope-case-")


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]


def stage_csv(raw, folder):
    """Write small raw tables as one header CSV file each, in ingest order;
    quotes inside a value are doubled, as in the shop's exports."""
    from shopscope.schemas import RAW_CSV_SCHEMAS
    from shopscope.sources import csv_files
    for name, df in raw.items():
        cols = [F.col(c).cast("string").alias(c) for c in RAW_CSV_SCHEMAS[name].fieldNames()]
        df.orderBy("ingest_seq").select(*cols).coalesce(1).write.mode("overwrite") \
            .option("header", True).option("escape", '"').csv(f"{folder}/{csv_files.RAW_FILES[name]}")
