"""Raw CSV inputs: completeness check and typed-text scans.

Files are read with a declared all-text schema (no inference, so zip codes
keep their leading zeros and dirty values reach the lenient parsers in the
cleaning operators). Quoted text may hold line breaks and doubled quotes. Such
files cannot be split, so a large table should come as many files, which are
read in parallel. Each row gets ``ingest_seq``, its position in file order (by
path, then within the file), which keep-first rules use.
"""

from __future__ import annotations

import logging
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.schemas import RAW_CSV_SCHEMAS

log = logging.getLogger(__name__)

# Default file name of each raw table inside the input folder.
RAW_FILES = {name: f"{name}.csv" for name in RAW_CSV_SCHEMAS}
REQUIRED = tuple(RAW_FILES)


class MissingInputs(FileNotFoundError):
    def __init__(self, missing: list[str]):
        super().__init__("missing raw inputs: " + ", ".join(missing))
        self.missing = missing


def _scan(spark: SparkSession, path: str, name: str) -> DataFrame:
    return (spark.read.schema(RAW_CSV_SCHEMAS[name])
            .option("header", True).option("mode", "PERMISSIVE").option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .csv(path))


def missing_inputs(spark: SparkSession, folder: str, names=REQUIRED,
                   files: dict[str, str] | None = None) -> list[str]:
    """The raw files that are not present (path listing only, no data read)."""
    files = {**RAW_FILES, **(files or {})}
    missing = []
    for name in names:
        try:
            _scan(spark, f"{folder.rstrip('/')}/{files[name]}", name)
        except AnalysisException:
            missing.append(files[name])
    return missing


def read_raw(spark: SparkSession, folder: str, name: str, files: dict[str, str] | None = None) -> DataFrame:
    """One raw table as text columns plus ``ingest_seq``."""
    files = {**RAW_FILES, **(files or {})}
    df = _scan(spark, f"{folder.rstrip('/')}/{files[name]}", name)
    # A file is read whole by one task, so within it the generated id follows
    # the lines; its low 33 bits count the rows of a task.
    # The two ways to name a file differ in the slashes behind the scheme.
    paths = sorted(re.sub(":/+", ":/", p) for p in df.inputFiles())
    number = F.lit(0) if len(paths) < 2 else F.array_position(
        F.array(*[F.lit(p) for p in paths]), F.regexp_replace(F.col("_metadata.file_path"), ":/+", ":/"))
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumn("ingest_seq", number.cast("bigint") * F.lit(1 << 33) + in_task)


def read_all_raw(spark: SparkSession, folder: str, files: dict[str, str] | None = None,
                 optional: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """S1 + S2 + S3: every raw table; fail listing all missing required files.

    Tables named in ``optional`` are skipped with a warning when absent.
    """
    missing = missing_inputs(spark, folder, files=files)
    fatal = [f for n, f in {**RAW_FILES, **(files or {})}.items() if f in missing and n not in optional]
    if fatal:
        raise MissingInputs(fatal)
    out = {}
    for name in RAW_CSV_SCHEMAS:
        if {**RAW_FILES, **(files or {})}[name] in missing:
            log.warning("optional input %s not found; skipped", name)
            continue
        out[name] = read_raw(spark, folder, name, files)
    return out

