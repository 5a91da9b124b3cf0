"""Partitioned extraction: windows over a column, read in parallel, together exactly the table."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_WINDOWS = 100_000


def bounds(df: DataFrame, column: str) -> DataFrame:
    """One row: ``lo, hi, n_rows, n_values``; fewer values than rows means nulls."""
    return df.agg(
        F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("n_rows"), F.count(column).alias("n_values")
    )


def auto_step(low, high, parallelism: int = 5):
    """A step for about four windows per reader, never below a second, a day for dates, or one."""
    windows = 4 * parallelism
    if isinstance(low, datetime):
        seconds = (high - low).total_seconds()
        return timedelta(seconds=max(1, -(-seconds // windows)))
    if isinstance(low, date):
        return timedelta(days=max(1, -(-(high - low).days // windows)))
    return max(1, -(-(high - low + 1) // windows))


def windows(low, high, step) -> list[tuple]:
    """``(begin, end, is_last)`` of consecutive windows; all but the last are half-open."""
    if isinstance(low, date) and not isinstance(low, datetime) and step < timedelta(days=1):
        raise ValueError("windows over a date need a day at least")
    if high < low:
        return []
    if step <= (timedelta(0) if isinstance(step, timedelta) else 0):
        raise ValueError("the step must be positive")
    count = int((high - low) // step) + 1
    if count > MOST_WINDOWS:
        raise ValueError(f"{count} windows are more than {MOST_WINDOWS}")
    found = []
    for k in range(count):
        begin = low + k * step
        end = min(begin + step, high)
        if k and begin >= high:  # the last window is closed, so it holds the upper bound itself
            found[-1] = (found[-1][0], high, True)
            break
        found.append((begin, end, k == count - 1))
    return found


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    return str(value)


def predicates(column: str, low, high, step, nulls: bool = False) -> list[str]:
    """SQL conditions, one per reader; ``nulls`` adds one for rows without a value."""
    out = [
        f"{column} >= {_literal(a)} AND {column} {'<=' if last else '<'} {_literal(b)}" for a, b, last in windows(low, high, step)
    ]
    return [*out, f"{column} IS NULL"] if nulls else out


def plan(df: DataFrame, column: str, step=None, parallelism: int = 5, start=None, end=None, is_incremental: bool = False) -> list[str]:
    """Conditions for a column from its discovered bounds.

    Rows with a null are read by a condition of their own, unless the column is
    the incremental key and the bounds are the user's, in which case they are not read.
    """
    if start is not None and end is not None and is_incremental:
        return predicates(column, start, end, step or auto_step(start, end, parallelism))
    row = bounds(df, column).first()
    if row["lo"] is None:
        return [f"{column} IS NULL"] if row["n_rows"] else []
    low, high = (start if start is not None else row["lo"]), (end if end is not None else row["hi"])
    return predicates(column, low, high, step or auto_step(low, high, parallelism), nulls=row["n_values"] < row["n_rows"])


def extract_jdbc(spark: SparkSession, url: str, dbtable: str, conditions: list[str], properties: dict | None = None) -> DataFrame:
    """A JDBC table read by one task per condition."""
    return spark.read.jdbc(url, dbtable, predicates=conditions, properties=properties or {})


def any_of(conditions: list[str]) -> C:
    """The union of conditions as one filter, for file scans."""
    return F.expr(" OR ".join(f"({c})" for c in conditions) or "false")


def extract(df: DataFrame, column: str, conditions: list[str]) -> DataFrame:
    """A file table or view read by the conditions of ``plan``: one scan, whose splits are the parallelism.

    Windows follow one another, so all of them together are one interval, and the null rows if a condition asks for them.
    """
    inner = [c for c in conditions if not c.endswith(" IS NULL")]
    if not inner:
        return df.filter(any_of(conditions))
    low, high = inner[0].split(" AND ")[0], inner[-1].split(" AND ")[1]
    whole = F.expr(f"({low}) AND ({high})")
    return df.filter(whole | F.col(column).isNull() if len(inner) < len(conditions) else whole)


def window_number(column: C, low, step) -> C:
    """The number of the window that a value falls into."""
    if isinstance(step, timedelta):
        return F.floor((F.unix_micros(column.cast("timestamp")) - F.unix_micros(F.lit(low).cast("timestamp"))) / int(step.total_seconds() * 1e6))
    return F.floor((column - low) / step)
