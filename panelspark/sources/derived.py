"""Provider observations derived from the driver's fact tables.

No provider data is reachable offline, so the three raw observation tables
are *derived* from ``orders``, ``lineitem`` and ``events``: each catalog
series is bound to an aggregate of a fact table, in the provider's own date
format.  The work therefore grows with the fact tables.

Plan shape: each fact table is scanned once (only the used columns) and
reduced by one partially-aggregated shuffle to a month (or day) grain; the
quarterly and annual rows are rolled up from those exact integer partials, so
no second pass over the facts is needed.  Money is summed exactly as integer
cents, so values do not depend on summation order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog as C
from ..functions.dates import format_period

# Fixed ingestion timestamp of the derived tables (keeps reruns identical).
INGESTED_AT = "2026-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cents(c: str | Column) -> Column:
    """Money column (2 decimals) → exact integer cents."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c * F.lit(100.0)).cast("long")


def _dsum(c: str) -> Column:
    """Exact sum of a 2-decimal column, in integer cents.

    A ``long`` sum stays on Spark's fixed-width aggregation path, whereas
    ``sum(decimal(18,2))`` widens to ``decimal(28,2)`` and falls back to
    per-row BigDecimal objects.  ``double(cents) / 100`` equals the double of
    the exact decimal sum (both are the correctly rounded quotient).
    """
    return F.sum(cents(c))


def from_cents(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double") / F.lit(100.0)


def orders_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, o_orderpriority, price_sum dec, n)."""
    o = read_table(spark, sf_dir, "orders")
    return o.groupBy(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"), "o_orderpriority"
    ).agg(_dsum("o_totalprice").alias("price_sum"), F.count(F.lit(1)).alias("n"))


def lineitem_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, l_returnflag, ext_sum, disc_sum, tax_sum dec, n)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"), "l_returnflag"
    ).agg(
        _dsum("l_extendedprice").alias("ext_sum"),
        _dsum("l_discount").alias("disc_sum"),
        _dsum("l_tax").alias("tax_sum"),
        F.count(F.lit(1)).alias("n"),
    )


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, event_type, value_sum dec, n)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(
        _dsum("value").alias("value_sum"), F.count(F.lit(1)).alias("n")
    )


def _rollup(monthly: DataFrame, unit: str, keys: list[str], sums: list[str]) -> DataFrame:
    """Roll a month-grain partial up to quarter/year (exact: integer sums)."""
    if unit == "month":
        return monthly.withColumnRenamed("month", "period")
    return monthly.groupBy(F.trunc("month", unit).alias("period"), *keys).agg(
        *[F.sum(s).alias(s) for s in sums]
    )


def _d(c: str) -> Column:
    return F.col(c).cast("double")


# Binding of catalog series to fact aggregates.  Each entry:
# (series_id, fact, selector column, selector value or None for all rows,
#  numerator column, divide by row count?, multiplier, offset, period kinds)
# value = double(sum numerator) * multiplier / (double(sum n) if per-row else 1) + offset
RETIRED_A = C.Series("FRED", "LMUNRRTTCHM156N", "Unemployment Rate (retired)", "labour", "percent", "monthly")
ALL_SERIES = (*C.SERIES, RETIRED_A)

_SAW_TOOTH = "CAST(floor((year(month) * 12 + month(month)) / 2) AS BIGINT) % 40"

BINDINGS = (
    ("CLVMNACSAB1GQCH", "orders", "o_orderpriority", None, "price_sum", False, 1e-6, 0.0, "Q"),
    ("IRLTLT01CHM156N", "lineitem", "l_returnflag", None, "disc_sum", True, 100.0, 0.0, "M"),
    ("LMUNRRTTCHM156N", "lineitem", "l_returnflag", None, "tax_sum", True, 100.0, 0.0, "M"),
    ("snbgwdzid/SARON", "events", "event_type", "click", "value_sum", True, 1.0, 0.0, "D"),
    ("snbgwdzid/ZIGBL", "events", "event_type", "view", "value_sum", True, 1.0, 0.0, "D"),
    ("snbgwdzid/ZIG", "events", "event_type", "purchase", "value_sum", True, 1.0, 0.0, "D"),
    ("devkum/EUR1", "orders", "o_orderpriority", "5-LOW", "price_sum", True, 1e-5, 0.0, "M"),
    ("devkum/USD1", "orders", "o_orderpriority", "4-NOT SPECIFIED", "price_sum", True, 1e-5, 0.0, "MA"),
    ("KEI/CHE/B1GQ_Q/_T/GY", "orders", "o_orderpriority", "1-URGENT", "price_sum", False, 1e-6, 0.0, "MQA"),
    ("KEI/CHE/PRVM/C/GY", "orders", "o_orderpriority", "2-HIGH", "price_sum", False, 1e-6, 0.0, "MQA"),
    ("KEI/CHE/TOVM/G47/GY", "orders", "o_orderpriority", "3-MEDIUM", "price_sum", False, 1e-6, 0.0, "MQA"),
    ("KEI/CHE/EX/_T/G1", "lineitem", "l_returnflag", "R", "ext_sum", False, 1e-6, 0.0, "MQA"),
    ("KEI/CHE/EMP/_T/_Z", "lineitem", "l_returnflag", None, "n", False, 1e-3, 0.0, "MQA"),
    ("KEI/CHE/UNEMP/_T/_Z", "lineitem", "l_returnflag", None, "n_a", True, 100.0, 0.0, "MQA"),
    ("KEI/CHE/IRSTCI/_Z/_Z", "lineitem", "l_returnflag", None, "tax_sum", True, 100.0, 0.0, "MQA"),
    # A saw-tooth from -2 to 5.8 that stands still every second month, at every scale: every prices rule, both signs
    # of a denominator and a zero denominator occur.
    ("KEI/CHE/CP/_Z/GY", "lineitem", "l_returnflag", "A", _SAW_TOOTH, False, 0.2, -2.0, "MQA"),
)
_UNIT = {"D": None, "M": "month", "Q": "quarter", "A": "year"}


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _contributions(partial: DataFrame, fact: str, grain: str) -> DataFrame:
    """Explode each partial row into (series_id, kind, period, num, n) for every
    binding and period kind it feeds.  One pass; the array has a fixed size.

    The array is written as one SQL expression (parsed once by Catalyst)
    rather than assembled call by call from Python.
    """
    items = []
    for sid, f, sel, val, num, _, _, _, kinds in BINDINGS:
        if f != fact:
            continue
        hit = "true" if val is None else f"{sel} = {_sql_str(val)}"
        for k in kinds:
            unit = _UNIT[k]
            period = grain if unit is None else f"trunc({grain}, '{unit}')"
            items.append(
                f"IF({hit}, named_struct('series_id', {_sql_str(sid)}, 'kind', '{k}', 'period', {period}, "
                f"'num', CAST({num} AS BIGINT), 'n', n), NULL)"
            )
    return partial.selectExpr(f"explode(array({', '.join(items)})) AS c").filter("c IS NOT NULL").select("c.*")


def _value_expr() -> Column:
    """value = double(num) [/100 for money] * multiplier [/ double(n)] + offset, per series."""
    cases = []
    for sid, _, _, _, num, per_row, mul, off, _ in BINDINGS:
        base = "(CAST(num AS DOUBLE) / 100.0D)" if num.endswith("_sum") else "CAST(num AS DOUBLE)"
        e = f"{base} * CAST({mul!r} AS DOUBLE)"
        if per_row:
            e = f"{e} / CAST(n AS DOUBLE)"
        cases.append(f"WHEN {_sql_str(sid)} THEN {e} + CAST({off!r} AS DOUBLE)")
    return F.expr(f"CASE series_id {' '.join(cases)} END")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derived observations: (series_id, kind, period DATE, value DOUBLE).

    Each fact table is scanned once and aggregated to its finest grain; the
    partials (a few rows per month) fan out to every bound series and
    period kind, and one small aggregate sums them.
    """
    om = orders_monthly(spark, sf_dir)
    lm = lineitem_monthly(spark, sf_dir).withColumn(
        "n_a", F.when(F.col("l_returnflag") == "A", F.col("n")).otherwise(F.lit(0).cast("long"))
    )
    ed = events_daily(spark, sf_dir)
    contrib = (
        _contributions(om, "orders", "month")
        .unionByName(_contributions(lm, "lineitem", "month"))
        .unionByName(_contributions(ed, "events", "day"))
    )
    sums = contrib.groupBy("series_id", "kind", "period").agg(F.sum("num").alias("num"), F.sum("n").alias("n"))
    return sums.select("series_id", "kind", "period", _value_expr().alias("value"))


def _raw(spark: SparkSession, obs: DataFrame, source: str, date: Column) -> DataFrame:
    cat = spark.createDataFrame(
        [(s.series_id, s.source, s.indicator_name, s.indicator_category, s.unit, s.frequency) for s in ALL_SERIES],
        "series_id string, source string, indicator_name string, indicator_category string, unit string, "
        "frequency string",
    ).filter(F.col("source") == source)
    return obs.join(F.broadcast(cat), "series_id").select(
        date.alias("date"), "source", "series_id", "indicator_name", "indicator_category", "value", "unit",
        "frequency", F.lit(INGESTED_AT).cast("timestamp").alias("ingested_at"),
    )


def _period_string(kind: str = "kind", period: str = "period") -> Column:
    k = F.col(kind)
    return (
        F.when(k == "D", format_period(period, "D"))
        .when(k == "M", format_period(period, "M"))
        .when(k == "Q", format_period(period, "Q"))
        .when(k == "A", format_period(period, "A"))
    )


def raw_tables(spark: SparkSession, sf_dir: str, stage: bool = False) -> dict[str, DataFrame]:
    """Provider raw tables: A with DATE dates, B and C with period strings.

    B: 'YYYY-MM-DD' and 'YYYY-MM' (USD1 also carries annual 'YYYY' rows,
    which stage to a NULL date).  C: every series in 'YYYY-MM', 'YYYY-Qn'
    and 'YYYY' form, as the provider returns all frequencies.  ``stage``
    writes the shared observations once before the three tables read them.
    """
    obs = observations(spark, sf_dir)
    if stage:
        # Computed once and shared by the three tables (one pass over the facts).
        from ..session import stage_table

        obs = stage_table(obs, "observations")
    return {
        "iso": _raw(spark, obs, "FRED", F.col("period")),
        "mixed": _raw(spark, obs, "SNB", _period_string()),
        "periods": _raw(spark, obs, "OECD", _period_string()),
    }


# --------------------------------------------------------------------------
# Landed-file shapes derived from facts (inputs of the extract operators).
# --------------------------------------------------------------------------

# Provider-C dimension members per order priority.  5-LOW is landed with an
# adjustment the catalog does not ask for, so the extractor must drop it.
WIDE_DIMENSIONS = (
    ("1-URGENT", "B1GQ_Q", "_T", "Y", "GY"),
    ("2-HIGH", "PRVM", "C", "Y", "GY"),
    ("3-MEDIUM", "TOVM", "G47", "Y", "GY"),
    ("4-NOT SPECIFIED", "EX", "_T", "Y", "G1"),
    ("5-LOW", "EMP", "_T", "N", "_Z"),
)


def landed_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string wide frame like provider C's CSV, one row per period.

    FREQ is 'M'/'Q'/'A' by period kind, except that the 3-MEDIUM monthly rows
    carry no FREQ.  February observations are landed as ':' (missing
    marker) and August ones as '' so value coercion has work to do.
    """
    om = orders_monthly(spark, sf_dir)
    dims = spark.createDataFrame(
        list(WIDE_DIMENSIONS), "o_orderpriority string, MEASURE string, ACTIVITY string, ADJUSTMENT string, TRANSFORMATION string"
    )
    parts = []
    for unit, kind in (("month", "M"), ("quarter", "Q"), ("year", "A")):
        r = _rollup(om, unit, ["o_orderpriority"], ["price_sum", "n"])
        freq = F.lit(kind)
        if kind == "M":
            freq = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None).cast("string")).otherwise(freq)
        mon = F.month("period")
        obs = (
            F.when(mon == 2, F.lit(":"))
            .when(mon == 8, F.lit(""))
            .otherwise((from_cents("price_sum") / F.lit(1e6)).cast("string"))
        )
        parts.append(
            r.join(F.broadcast(dims), "o_orderpriority").select(
                F.lit("Key short-term economic indicators").alias("STRUCTURE_NAME"),
                "MEASURE",
                "ACTIVITY",
                "ADJUSTMENT",
                "TRANSFORMATION",
                freq.alias("FREQ"),
                format_period("period", kind).alias("TIME_PERIOD"),
                obs.alias("OBS_VALUE"),
                F.lit("Switzerland").alias("Reference area"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines like provider B's CSV: preamble, blank line, header, one line per event.

    Line shape: ``"<period>";"<event_type>";"<value>"``.  The prologue is fixed; the data lines are the events table
    itself, most by day, every tenth by year and every tenth by quarter (periods that staging cannot place).
    """
    ev = read_table(spark, sf_dir, "events")
    slot = F.pmod("event_id", F.lit(10))
    period = F.when(slot == 0, format_period("ts", "A")).when(slot == 1, format_period("ts", "Q")).otherwise(
        format_period("ts", "D")
    )
    data = ev.select(
        F.concat(
            F.lit('"'), period, F.lit('";"'), F.col("event_type"),
            F.lit('";"'), F.col("value").cast("string"), F.lit('"'),
        ).alias("value")
    )
    prologue = spark.createDataFrame(
        [('"CubeId";"events"',), ('"PublishingDate";"2024-02-01 09:00"',), ("",), ('"Date";"D0";"Value"',)], "value string"
    )
    return prologue.unionByName(data)


# Landed cube files: (file, cube, dimensions of a priority or event type before and after the code).
CUBE_CODES = (
    ("devkum.csv", "devkum", "5-LOW", "EUR1"),
    ("devkum.csv", "devkum", "4-NOT SPECIFIED", "USD1"),
    ("devkum.csv", "devkum", "2-HIGH", "GBP1"),
    ("rates.csv", "snbgwdzid", "click", "SARON"),
    ("rates.csv", "snbgwdzid", "view", "ZIGBL"),
    ("rates.csv", "snbgwdzid", "purchase", "ZIG"),
    ("rates.csv", "snbgwdzid", "error", "OTHER"),
)


def landed_cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of two landed provider-B files (file, value): currencies with two dimensions, rates with one.

    Currencies are monthly aggregates of orders with the code in the second dimension, rates are the events of a
    type.  Both hold members that the catalog does not track, and missing values.
    """
    codes = spark.createDataFrame(list(CUBE_CODES), "file string, cube string, member string, code string")
    q = lambda *cells: F.concat_ws(";", *[F.concat(F.lit('"'), c, F.lit('"')) for c in cells])
    om = orders_monthly(spark, sf_dir).join(F.broadcast(codes), F.col("o_orderpriority") == F.col("member"))
    value = F.when(F.month("month") == 2, F.lit("")).otherwise(from_cents("price_sum").cast("string"))
    currencies = om.select("file", q(format_period("month", "M"), F.lit("M0"), F.col("code"), value).alias("value"))
    ev = read_table(spark, sf_dir, "events").join(F.broadcast(codes), F.col("event_type") == F.col("member"))
    rates = ev.select("file", q(format_period("ts", "D"), F.col("code"), F.col("value").cast("string")).alias("value"))
    heads = spark.createDataFrame(
        [
            ("devkum.csv", '"CubeId";"devkum"'), ("devkum.csv", '"PublishingDate";"2024-02-01"'), ("devkum.csv", ""),
            ("devkum.csv", '"Date";"D0";"D1";"Value"'),
            ("rates.csv", '"CubeId";"snbgwdzid"'), ("rates.csv", '"Date";"D0";"Value"'),
        ],
        "file string, value string",
    )
    return heads.unionByName(currencies).unionByName(rates)
