"""Column functions with the exact semantics the marts need.

All of them are built from ``pyspark.sql.functions``; none is a Python UDF.
``title_case`` uses ``transform``, which Spark interprets outside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Leading or trailing whitespace in the Unicode sense (Python's str.strip).
_EDGE_SPACE = r"(?U)^\s+|\s+$"
# A run of letters or a run of anything else: the word model of str.title.
_LETTER_RUNS = r"(?U)(\p{L}+|[^\p{L}]+)"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove Unicode whitespace at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(col_of(c), _EDGE_SPACE, "")


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter of every letter run, lower-case the rest.

    Matches Python's ``str.title``: ``d'oeste`` -> ``D'Oeste``,
    ``mogi-guaçu`` -> ``Mogi-Guaçu``; ``initcap`` only splits on spaces.
    """
    runs = F.regexp_extract_all(F.lower(col_of(c)), F.lit(_LETTER_RUNS), 1)
    titled = F.transform(runs, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30)))
    return F.when(col_of(c).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(titled, ""))


def zero_fill(c: Column | str, width: int = 5) -> Column:
    """Left-pad with zeros up to ``width``; longer values are kept whole."""
    c = col_of(c).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def lenient_timestamp(c: Column | str, dtype: DataType | None = None) -> Column:
    """Parse to ``timestamp_ntz``; unparsable text becomes null."""
    c = col_of(c)
    if dtype is None or isinstance(dtype, StringType):
        return F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")
    return c.cast("timestamp_ntz")


def lenient_number(c: Column | str, target: str, dtype: DataType | None = None) -> Column:
    """Cast to ``target``; text that is not a number becomes null.

    Integers are read as decimals first, so ``1.0`` and ``1e3`` count.
    """
    c = col_of(c)
    if dtype is None or isinstance(dtype, StringType):
        text = c.cast("string")
        return (text.try_cast("decimal(38,10)") if target in ("int", "bigint") else text).try_cast(target)
    return c.try_cast(target)


def whole_days(start: Column | str, end: Column | str, mode: str = "floor") -> Column:
    """Whole days from ``start`` to ``end``.

    ``floor`` rounds toward minus infinity (a timedelta's day field);
    ``trunc`` rounds toward zero (the day field of an SQL interval).
    """
    micros = (F.unix_micros(col_of(end).cast("timestamp"))
              - F.unix_micros(col_of(start).cast("timestamp")))
    days = micros / F.lit(86_400_000_000)
    if mode == "floor":
        return F.floor(days)
    if mode == "trunc":
        return F.when(days < 0, F.ceil(days)).otherwise(F.floor(days))
    raise ValueError(f"unknown mode {mode!r}")


def false_if_null(cond: Column) -> Column:
    """A comparison flag where an unknown result counts as false."""
    return F.coalesce(cond, F.lit(False))


def sql_round(c: Column | str, digits: int) -> Column:
    """Round half away from zero, as SQL ``ROUND(numeric, n)``, returned as double.

    The value is first fixed to ten decimal places so that a double which is a
    binary neighbour of a decimal tie rounds like the exact decimal would.
    """
    return F.round(col_of(c).cast("decimal(38,10)"), digits).cast("double")


def even_round(c: Column | str, digits: int) -> Column:
    """Round half to even (pandas ``round`` and SQL ``ROUND`` on doubles)."""
    return F.bround(col_of(c).cast("decimal(38,10)"), digits).cast("double")


def mean(total: Column | str, count: Column | str) -> Column:
    """An average from an exact sum and a count, computed in double; null for no rows."""
    n = col_of(count).cast("double")
    return col_of(total).cast("double") / F.when(n != 0, n)


def percent(part: Column | str, whole: Column | str) -> Column:
    """``100 * part / whole`` in double, null when ``whole`` is 0 or null."""
    w = col_of(whole).cast("double")
    return F.lit(100.0) * col_of(part).cast("double") / F.when(w != 0, w)


def month_start(ts: Column | str) -> Column:
    """First instant of the month, kept as a wall-clock ``timestamp_ntz``."""
    return F.date_trunc("month", col_of(ts)).cast("timestamp_ntz")


def day_start(ts: Column | str) -> Column:
    return F.date_trunc("day", col_of(ts)).cast("timestamp_ntz")
