"""Data-quality gate (Q1-Q7).

Checks return rows that fail (empty = pass), as the reference's tests do.
The per-column checks of a table fold into one aggregate pass
(``count_if`` per column) instead of one query per test; the report unions
everything into ``(check_name, table_name, column_name, failing_rows)`` and
the gate raises when any count is positive — a single action.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog as C


class DataQualityError(RuntimeError):
    def __init__(self, failures: list[tuple]):
        self.failures = failures
        super().__init__("data-quality checks failed: " + "; ".join(f"{f[0]}({f[1]}.{f[2]})={f[3]}" for f in failures))


def _as_of(as_of: str | dt.date | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def column_checks(df: DataFrame, table: str, not_null: Sequence[str] = (),
                  accepted: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Q1 + Q2 for one table in a single aggregate pass.

    ``not_null``: NULL count per column.  ``accepted``: rows outside the
    allowed list per column (NULL passes, as in three-valued logic).
    """
    accepted = dict(accepted or {})
    specs = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null]
    specs += [("accepted_values", c, F.count_if(~F.col(c).isin(list(v)))) for c, v in accepted.items()]
    agg = df.agg(*[e.alias(f"__c{i}") for i, (_, _, e) in enumerate(specs)])
    return agg.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(check).alias("check_name"),
                        F.lit(table).alias("table_name"),
                        F.lit(c).alias("column_name"),
                        F.col(f"__c{i}").cast("long").alias("failing_rows"),
                    )
                    for i, (check, c, _) in enumerate(specs)
                ]
            )
        ).alias("r")
    ).select("r.*")


def not_null_counts(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Q1: NULL count per column, all columns in one aggregate."""
    return column_checks(df, table, not_null=columns)


def accepted_values_counts(df: DataFrame, allowed: Mapping[str, Sequence[str]], table: str) -> DataFrame:
    """Q2: rows outside the allowed list per column (NULL passes)."""
    return column_checks(df, table, accepted=allowed)


def one_latest_violations(tall: DataFrame) -> DataFrame:
    """Q3: series whose count of latest rows is not exactly one."""
    return (
        tall.groupBy("series_id")
        .agg(F.count_if(F.col("is_latest") == F.lit(True)).alias("latest_count"))
        .filter(F.col("latest_count") != 1)
    )


def expected_series_missing(tall: DataFrame, expected: DataFrame) -> DataFrame:
    """Q4: expected series without a latest row (anti join)."""
    present = tall.filter(F.col("is_latest") == F.lit(True)).select("series_id").distinct()
    return expected.select("series_id").join(present, "series_id", "left_anti")


def expected_frame(spark: SparkSession, ids: Sequence[str] = C.EXPECTED_SERIES) -> DataFrame:
    return spark.createDataFrame([(s,) for s in ids], "series_id string")


def stale_series(tall: DataFrame, as_of: str | dt.date | None = None, months: int = C.STALE_MONTHS) -> DataFrame:
    """Q5: series whose latest date is more than ``months`` before ``as_of``."""
    limit = F.add_months(_as_of(as_of), -months)
    return (
        tall.filter((F.col("is_latest") == F.lit(True)) & (F.col("date") < limit))
        .groupBy("series_id", "indicator_name")
        .agg(F.max("date").alias("latest_date"))
    )


def duplicate_grain(df: DataFrame, keys: Sequence[str] = ("series_id", "date")) -> DataFrame:
    """Q7 (hardening): keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


TALL_NOT_NULL = ("date", "series_id", "indicator_name", "indicator_category", "value", "is_latest")
TALL_ACCEPTED = {"indicator_category": C.CATEGORIES, "signal": C.SIGNALS, "trend": C.TRENDS}
STAGED_NOT_NULL = ("date", "series_id", "value")
ENRICHED_NOT_NULL = ("date", "series_id", "indicator_name", "indicator_category", "value")


def _count_rows(df: DataFrame, check: str, table: str, column: str | None = None) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        F.col("failing_rows").cast("long"),
    )


def _stack(agg: DataFrame, specs: Sequence[tuple[str, str, str | None, str]]) -> DataFrame:
    """One row of counts → report rows; specs: (check, table, column, name of the count)."""
    row = lambda check, table, column, name: F.struct(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        F.coalesce(F.col(name), F.lit(0)).cast("long").alias("failing_rows"),
    )
    return agg.select(F.explode(F.array(*[row(*s) for s in specs])).alias("r")).select("r.*")


def _staged_checks(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Q1 of all staged tables: one pass over their union, grouped by table."""
    named = [df.select(F.lit(name).alias("t"), *STAGED_NOT_NULL) for name, df in staged.items()]
    counts = reduce(DataFrame.unionByName, named).agg(
        *[
            F.count_if((F.col("t") == name) & F.col(c).isNull()).alias(f"{name}__{c}")
            for name in staged
            for c in STAGED_NOT_NULL
        ]
    )
    return _stack(counts, [("not_null", name, c, f"{name}__{c}") for name in staged for c in STAGED_NOT_NULL])


def _tall_checks(tall: DataFrame, expected: DataFrame, as_of: str | dt.date | None, tables: Sequence[str],
                 months: int = C.STALE_MONTHS) -> DataFrame:
    """Q1-Q5 of the tall mart from one grouping by series: its few rows answer every check."""
    latest = F.col("is_latest") == F.lit(True)
    stale = latest & (F.col("date") < F.add_months(_as_of(as_of), -months))
    nulls = {c: F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in TALL_NOT_NULL}
    bad = {c: F.count_if(~F.col(c).isin(list(v))).alias(f"bad_{c}") for c, v in TALL_ACCEPTED.items()}
    series = tall.groupBy("series_id").agg(
        *nulls.values(),
        *bad.values(),
        F.count_if(latest).alias("n_latest"),
        # a series has one name, or few; a NULL name is a group too
        F.size(F.collect_set(F.when(stale, F.coalesce("indicator_name", F.lit("\0"))))).alias("n_stale"),
        F.lit(True).alias("present"),
    )
    each = series.join(expected.select("series_id", F.lit(True).alias("expected")), "series_id", "full_outer")
    counts = each.agg(
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in nulls],
        *[F.sum(f"bad_{c}").alias(f"bad_{c}") for c in bad],
        F.count_if(F.col("present") & (F.col("n_latest") != 1)).alias("one_latest"),
        F.count_if(F.col("expected") & (F.coalesce("n_latest", F.lit(0)) == 0)).alias("expected"),
        F.sum("n_stale").alias("stale"),
    )
    specs = [("not_null", t, c, f"null_{c}") for t in tables for c in (TALL_NOT_NULL if t == "time_series" else ENRICHED_NOT_NULL)]
    specs += [("accepted_values", "time_series", c, f"bad_{c}") for c in bad]
    specs += [
        ("one_latest", "time_series", "is_latest", "one_latest"),
        ("expected_present", "time_series", "series_id", "expected"),
        ("not_stale", "time_series", "date", "stale"),
    ]
    return _stack(counts, specs)


def quality_report(
    staged: Mapping[str, DataFrame],
    enriched: DataFrame,
    tall: DataFrame,
    overview: DataFrame,
    expected: DataFrame,
    as_of: str | dt.date | None = None,
    duplicate_groups: int | None = None,
) -> DataFrame:
    """Q6: every check of the pipeline as one small DataFrame.

    Passes: one over the staged tables, one over the tall mart, one over the wide mart, and one for the grain.
    ``enriched`` costs a pass only when it is another frame than ``tall``.  ``duplicate_groups``, when the caller
    already counted them in the enrichment window (see ``time_series_mart(grain_flag=…)``), replaces the grain's.
    """
    same = enriched is tall
    parts = [
        _staged_checks(staged),
        _tall_checks(tall, expected, as_of, ("enriched", "time_series") if same else ("time_series",)),
        not_null_counts(overview, ("date",), "overview"),
    ]
    if not same:
        parts.append(not_null_counts(enriched, ENRICHED_NOT_NULL, "enriched"))
    if duplicate_groups is None:
        parts.append(_count_rows(duplicate_grain(tall), "unique_grain", "time_series", "series_id,date"))
    else:
        parts.append(
            tall.sparkSession.createDataFrame(
                [("unique_grain", "time_series", "series_id,date", int(duplicate_groups))],
                "check_name string, table_name string, column_name string, failing_rows long",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def gate(report: DataFrame) -> list:
    """Raise :class:`DataQualityError` if any check has failing rows."""
    failures = [tuple(r) for r in report.filter(F.col("failing_rows") > 0).collect()]
    if failures:
        raise DataQualityError(failures)
    return failures
