"""Key and value checks that a relational load would enforce, as reports.

Spark tables enforce no constraints, so each check returns the violations:
duplicate or null primary keys, foreign keys without a parent, numbers that do
not fit their declared precision, and text longer than its declared length.
Each check reads a table in one pass (one aggregate per table).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shopscope.functions.scalar import lenient_number

NULL_TEXT = "<null>"


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit(NULL_TEXT)) for k in keys])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def pk_violations(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """K1: keys that occur more than once or contain a null.

    Rows: table_name, key_value ('|'-joined, ``<null>`` for nulls), row_count,
    problem ('null key' or 'duplicate key').
    """
    parts = []
    for name, (df, keys) in tables.items():
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(g.filter((F.col("row_count") > 1) | any_null).select(
            F.lit(name).alias("table_name"), _key_text(keys).alias("key_value"), "row_count",
            F.when(any_null, "null key").otherwise("duplicate key").alias("problem")))
    return _union(parts)


def fk_orphans(links: Sequence[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """K2: child keys with no parent row, per distinct key.

    ``links`` holds (child name, child frame, column, parent name, parent
    frame, parent column). Null child keys are not violations. Child rows are
    counted per key before the join, so a frequent key is one row in it.
    Rows: child_table, column_name, parent_table, key_value, row_count.
    """
    parts = []
    for child_name, child, col, parent_name, parent, pcol in links:
        keys = parent.select(F.col(pcol).alias("_parent_key"))
        counts = child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(counts.join(keys, F.col(col) == F.col("_parent_key"), "left_anti").select(
            F.lit(child_name).alias("child_table"), F.lit(col).alias("column_name"),
            F.lit(parent_name).alias("parent_table"), F.col(col).cast("string").alias("key_value"),
            "row_count"))
    return _union(parts)


def _stacked(df: DataFrame, table: str, checks: Mapping[str, tuple[str, Column, Column]]) -> DataFrame:
    """One aggregate over ``df``, turned into one row per checked column."""
    aggs, pairs = [], []
    for i, (col, (declared, bad, extreme)) in enumerate(checks.items()):
        aggs += [F.count(F.when(bad, 1)).alias(f"_v{i}"), extreme.alias(f"_x{i}")]
        pairs.append(F.struct(F.lit(col).alias("column_name"), F.lit(declared).alias("declared"),
                              F.col(f"_v{i}").alias("violations"),
                              F.col(f"_x{i}").cast("string").alias("worst_value")))
    row = df.agg(*aggs)
    return (row.select(F.explode(F.array(*pairs)).alias("c"))
            .select(F.lit(table).alias("table_name"), "c.*")
            .filter(F.col("violations") > 0))


def number_rejects(raw: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Raw values that are numbers but do not fit the cleaned column's type.

    Cleaning reads them as missing (money then counts as 0), so this report is
    what shows them. Rows: table_name, column_name, declared, violations,
    worst_value (largest magnitude seen).
    """
    parts = []
    for name, (df, cols) in raw.items():
        checks = {}
        for col, target in cols.items():
            number = F.col(col).cast("string").try_cast("double")
            fits = lenient_number(col, target, df.schema[col].dataType)
            checks[col] = (target, number.isNotNull() & ~F.isnan(number) & fits.isNull(), F.max(F.abs(number)))
        parts.append(_stacked(df, name, checks))
    return _union(parts)


def scale_checks(columns: Mapping[str, tuple[int, int]]) -> dict[str, tuple[str, Column, Column]]:
    """Per column: declared type, overflow, largest magnitude."""
    return {c: (f"numeric({p},{s})",
                F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull(), F.max(F.abs(F.col(c))))
            for c, (p, s) in columns.items()}


def length_checks(columns: Mapping[str, int]) -> dict[str, tuple[str, Column, Column]]:
    """Per column: declared type, text too long, greatest length."""
    return {c: (f"varchar({n})", F.length(c) > n, F.max(F.length(c))) for c, n in columns.items()}


def scale_violations(tables: Mapping[str, tuple[DataFrame, Mapping[str, tuple[int, int]]]]) -> DataFrame:
    """K3: numbers that overflow their ``NUMERIC(precision, scale)``.

    Rows: table_name, column_name, declared, violations, worst_value (largest
    magnitude seen).
    """
    return _union([_stacked(df, name, scale_checks(cols)) for name, (df, cols) in tables.items()])


def length_violations(tables: Mapping[str, tuple[DataFrame, Mapping[str, int]]]) -> DataFrame:
    """K4: text longer than its ``VARCHAR(n)``.

    Rows: table_name, column_name, declared, violations, worst_value (longest
    length seen).
    """
    return _union([_stacked(df, name, length_checks(cols)) for name, (df, cols) in tables.items()])


# ---- the same checks, measured while a table is written ------------------------

MEASURED = ("table_name string, check_name string, column_name string, declared string, "
            "violations bigint, worst_value string, row_count bigint")


def measured(df: DataFrame, table: str, keys: Sequence[str] = (), sizes: Mapping[str, tuple[int, int]] | None = None,
             lengths: Mapping[str, int] | None = None) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """``df`` observed for rows, null keys (K1), overflows (K3) and lengths (K4).

    Returns the frame to write, and a function that, after the write, gives rows
    of ``MEASURED``: one per check, also where nothing is violated. Observe the
    frame of the write's last stage: a task of it counts once, even if it ran
    again after a lost executor.
    """
    checks = [("null key", c, "not null", F.col(c).isNull(), F.max(F.lit(None).cast("string"))) for c in keys]
    checks += [("scale", c, *check) for c, check in scale_checks(sizes or {}).items()]
    checks += [("length", c, *check) for c, check in length_checks(lengths or {}).items()]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, (_, _, _, bad, worst) in enumerate(checks):
        aggs += [F.count(F.when(bad, 1)).alias(f"v{i}"), worst.cast("string").alias(f"x{i}")]
    seen = Observation()

    def rows() -> list[tuple]:
        got = seen.get
        return [(table, "rows", None, None, 0, None, got["n"])] + [
            (table, kind, column, declared, got[f"v{i}"], got[f"x{i}"], got["n"])
            for i, (kind, column, declared, _, _) in enumerate(checks)]

    return df.observe(seen, *aggs), rows


def violations_of(measured_rows: DataFrame, check: str) -> DataFrame:
    """The violations that were measured, in the form of the reports above."""
    return measured_rows.where((F.col("check_name") == check) & (F.col("violations") > 0)) \
        .select("table_name", "column_name", "declared", "violations", "worst_value")
