"""Row filters and ordered limits over records and log events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.records import record_index


def recent(
    events: DataFrame, within: timedelta, as_of: Column | None = None, ts: str = "ts"
) -> DataFrame:
    """Events of the last ``within``, counted back from ``as_of``.

    Without ``as_of`` the newest event sets the end; a subquery that reads the one column
    yields the bound, and the scan gets it as a pushed filter. ``F.current_timestamp()``
    gives the live form.
    """
    if as_of is None:
        bound = events.select(F.max(ts) - F.lit(within)).scalar()
    else:
        bound = as_of - F.lit(within)
    return events.filter(F.col(ts) >= bound)


def containing(events: DataFrame, text: str, column: str = "message") -> DataFrame:
    """Rows whose column contains the text, case-sensitive."""
    return events.filter(F.col(column).contains(text))


def matching(
    events: DataFrame, pattern: str, column: str = "message", ignore_case: bool = False
) -> DataFrame:
    """Rows whose column matches a regular expression, alternation included."""
    return events.filter(F.col(column).rlike(f"(?i){pattern}" if ignore_case else pattern))


def pattern_counts(rows: DataFrame, pattern: str, column: str) -> DataFrame:
    """How many rows match a pattern and how many do not."""
    hit = F.col(column).rlike(pattern)
    return rows.agg(F.count_if(hit).alias("matching"), F.count_if(~hit).alias("other"))


def first_records(records: DataFrame, n: int, line: str = "foams") -> DataFrame:
    """The first ``n`` records in index order; lines that are no record come last."""
    return records.orderBy(record_index(F.col(line)).asc_nulls_last(), F.col(line)).limit(n)


def last_events(events: DataFrame, n: int, ts: str = "ts", *ties: str) -> DataFrame:
    """The newest ``n`` events."""
    return events.orderBy(F.col(ts).desc(), *(F.col(c).desc() for c in ties)).limit(n)
