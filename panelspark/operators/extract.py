"""Extraction of landed provider files into raw observation rows (M7).

One pass over the landed data for all catalog series: the catalog is a
small fixed table joined by broadcast (the reference filters the same frame
once per series).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog as C
from ..functions.numeric import is_valid_value, try_double


def _raw_select(date: Column, source: Column, series_id: Column, value: Column,
                ingested_at: Column | None) -> list[Column]:
    return [
        date.alias("date"),
        source.alias("source"),
        series_id.alias("series_id"),
        F.col("indicator_name"),
        F.col("indicator_category"),
        value.alias("value"),
        F.col("unit"),
        F.col("frequency"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("ingested_at"),
    ]


def catalog_frame(spark: SparkSession, series: Sequence[C.Series]) -> DataFrame:
    rows = [
        (s.source, s.series_id, s.indicator_name, s.indicator_category, s.unit, s.frequency,
         s.measure, s.activity, s.adjustment, s.transformation, s.cube, s.code)
        for s in series
    ]
    schema = ("source string, series_id string, indicator_name string, indicator_category string, unit string, "
              "frequency string, MEASURE string, ACTIVITY string, ADJUSTMENT string, TRANSFORMATION string, "
              "cube string, code string")
    return spark.createDataFrame(rows, schema)


def extract_wide(landed: DataFrame, catalog: DataFrame, area: str = "CHE",
                 ingested_at: Column | None = None) -> DataFrame:
    """Wide all-string frame (provider C) → raw rows for every catalog series.

    Match on the four dimension members; drop annual rows with a null-safe
    inequality (a missing FREQ passes); coerce OBS_VALUE and drop failures.
    """
    keys = ["MEASURE", "ACTIVITY", "ADJUSTMENT", "TRANSFORMATION"]
    cat = F.broadcast(catalog.select(*keys, "indicator_name", "indicator_category", "unit", "frequency"))
    value = try_double("OBS_VALUE")
    sid = F.concat_ws("/", F.lit("KEI"), F.lit(area), F.col("MEASURE"), F.col("ACTIVITY"), F.col("TRANSFORMATION"))
    return (
        landed.filter(~F.col("FREQ").eqNullSafe("A"))
        .join(cat, keys)
        .select(*_raw_select(F.col("TIME_PERIOD"), F.lit("OECD"), sid, value, ingested_at))
        .filter(is_valid_value("value"))
    )


# First fields of the lines that are no observation: preamble and header.
PREAMBLE = ("CubeId", "PublishingDate")
HEADER = "Date"
MAX_FIELDS = 8


def _cells(lines: DataFrame, text: str, file_col: str | None, max_fields: int) -> DataFrame:
    """(file, first, cells, n, value): each line split once; the value is its last field, coerced."""
    names = [f"c{i}" for i in range(max_fields + 1)]
    fields = F.from_csv(F.col(text), ", ".join(f"{n} string" for n in names), {"sep": ";", "quote": '"'})
    # Separators outside quotes tell how many fields a line has: an empty last field is a missing value.
    n = F.length(F.regexp_replace(F.regexp_replace(F.col(text), '"[^"]*"', ""), "[^;]", "")) + 1
    split = lines.filter(F.length(F.trim(F.col(text))) > 0).select(
        (F.col(file_col) if file_col else F.lit("")).alias("file"), n.alias("n"), fields.alias("f")
    )
    cells = F.transform(F.array(*[F.col(f"f.{c}") for c in names]), lambda x: F.trim(x))
    return split.select("file", "n", cells.alias("cells")).select(
        "file", "n", "cells", F.get("cells", F.lit(0)).alias("first"), try_double(F.get("cells", F.col("n") - 1)).alias("value")
    )


def _is_data() -> Column:
    return ~F.coalesce(F.col("first").isin(HEADER, *PREAMBLE), F.lit(False))


def _checked(flag: str, max_fields: int) -> Column:
    """TRUE; stops if the file of a data row has no header, or the row more fields than are read."""
    stop = F.raise_error(F.concat(F.lit("landed file without a usable header line: "), F.col("file"))).cast("boolean")
    return F.when(F.coalesce(flag, F.lit(False)) & (F.col("n") <= max_fields), F.lit(True)).otherwise(stop)


def _dims() -> Column:
    return F.slice("cells", F.lit(2), F.greatest(F.col("n") - 2, F.lit(0)))


def parse_delimited_lines(lines: DataFrame, text: str = "value", file_col: str | None = None,
                          max_fields: int = MAX_FIELDS) -> DataFrame:
    """``;``-separated quoted text with a preamble → (file, cube, date, dims, value).

    Every line that is not blank, preamble or header is data, whatever its period looks like; values that are no
    number are dropped.  A file's ``CubeId`` line names its cube (NULL without one).  Reading a file that has no
    header line raises, as does a row of more than ``max_fields`` fields.
    """
    cells = _cells(lines, text, file_col, max_fields)
    files = cells.groupBy("file").agg(
        F.max(F.col("first") == HEADER).alias("__header"),
        F.max(F.when(F.col("first") == "CubeId", F.get("cells", F.lit(1)))).alias("cube"),
    )
    return cells.filter(_is_data()).join(files, "file").filter(_checked("__header", max_fields)).filter(
        is_valid_value("value")
    ).select("file", "cube", F.col("first").alias("date"), _dims().alias("dims"), "value")


def _first_position(code: Column, dims: Column, max_dims: int) -> Column:
    """First dimension that holds the code in any row (an aggregate), or NULL."""
    at = [F.max(F.get(dims, F.lit(i)) == code) for i in range(max_dims)]
    return F.coalesce(*[F.when(hit, F.lit(i)) for i, hit in enumerate(at)])


def extract_delimited(lines: DataFrame, series: C.Series, text: str = "value", file_col: str | None = None,
                      ingested_at: Column | None = None, max_fields: int = MAX_FIELDS) -> DataFrame:
    """Landed lines of one provider-B series → raw rows.

    Per file, the first dimension position holding the series code in a row with a value decides the filter; a file
    where no position holds it is kept whole.  Header check and decision are one aggregate (one row per landed
    file), joined back without a hint, so its size decides how: the lines are read twice and never shuffled whole.
    """
    cells = _cells(lines, text, file_col, max_fields)
    valid = _is_data() & is_valid_value("value")
    files = cells.groupBy("file").agg(
        F.max(F.col("first") == HEADER).alias("__header"),
        _first_position(F.lit(series.code), F.when(valid, _dims()), max_fields - 2).alias("__pick"),
    )
    rows = cells.filter(_is_data()).join(files, "file").filter(_checked("__header", max_fields))
    member = rows.filter(
        is_valid_value("value") & (F.col("__pick").isNull() | (F.get(_dims(), F.col("__pick")) == F.lit(series.code)))
    )
    tagged = member.select(
        F.col("first").alias("date"),
        "value",
        F.lit(series.indicator_name).alias("indicator_name"),
        F.lit(series.indicator_category).alias("indicator_category"),
        F.lit(series.unit).alias("unit"),
        F.lit(series.frequency).alias("frequency"),
    )
    return tagged.select(
        *_raw_select(F.col("date"), F.lit(series.source), F.lit(f"{series.cube}/{series.code}"), F.col("value"),
                     ingested_at)
    )


def extract_cubes(lines: DataFrame, catalog: DataFrame, text: str = "value", file_col: str = "file",
                  ingested_at: Column | None = None) -> DataFrame:
    """Landed lines of all provider-B files → raw rows of every catalog series of their cubes, in one pass.

    The catalog (fixed, small) is joined by the cube that each file names.  Per (file, series) the first dimension
    holding the series code decides, as in `extract_delimited`.  A file in which none of its cube's codes occurs
    belongs whole to the cube's series if there is only one; if there are several, reading it raises.
    """
    cat = catalog.filter(F.col("cube").isNotNull()).select(
        "cube", "code", "source", "indicator_name", "indicator_category", "unit", "frequency"
    )
    cat = cat.join(cat.groupBy("cube").agg(F.count("*").alias("__series")), "cube")
    rows = parse_delimited_lines(lines, text, file_col).join(F.broadcast(cat), "cube")
    picks = rows.groupBy("file", "code").agg(_first_position(F.col("code"), F.col("dims"), MAX_FIELDS - 2).alias("__pick"))
    known = picks.groupBy("file").agg(F.count("__pick").alias("__known"))
    stop = F.raise_error(F.concat(F.lit("no series code of its cube in landed file "), F.col("file")))
    keep = (
        F.when(F.col("__pick").isNotNull(), F.get("dims", F.col("__pick")) == F.col("code"))
        .when(F.col("__known") > 0, F.lit(False))
        .when(F.col("__series") == 1, F.lit(True))
        .otherwise(stop.cast("boolean"))
    )
    member = rows.join(picks.join(known, "file"), ["file", "code"]).filter(keep)
    return member.select(
        *_raw_select(F.col("date"), F.col("source"), F.concat_ws("/", "cube", "code"), F.col("value"), ingested_at)
    )


def extract_iso(observations: DataFrame, catalog: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Provider A observations (series_id, date, value) → raw rows; NaN skipped.

    Name, category, unit and frequency come from the catalog (frequency is
    not hard-coded, so quarterly series stay quarterly).
    """
    cat = F.broadcast(catalog.select("series_id", "indicator_name", "indicator_category", "unit", "frequency"))
    return (
        observations.select("series_id", "date", "value").filter(is_valid_value("value"))
        .join(cat, "series_id")
        .select(*_raw_select(F.col("date").cast("date"), F.lit("FRED"), F.col("series_id"), F.col("value"),
                             ingested_at))
    )

