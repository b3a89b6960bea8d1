"""Per-series look-back windows: lag, rolling average, latest flag.

``plain``   one Window over ``partitionBy(key)``: one hash exchange, one sort.  A key's rows land in one task; for
            panels whose keys are known to be many and small.

``ranged``  (default) no key, timestamp or NULL key can land in one task.  The rows are range-partitioned on
            (key, order, tiebreak, hash of the row), so a series is cut wherever a range is full, also inside rows
            that tie on the order column.  Each range is sorted and written once to shared storage
            (``session.stage_table``) with the number of the range and the place of each row in it: the cuts are data
            from there on, and no later branch, retry, exchange reuse or adaptive re-plan can see others.

            The window then runs per (key, range).  Every look-back is at most ``L`` rows, so a range that begins
            inside a series needs only that series' last ``L`` rows before it.  The ends of the ranges, their first row
            and their last ``L`` ones, are found by place (one count per range, no window, no sort): at most
            ``ranges * (L + 1)`` rows.  They are copied to the ranges that need them (halo), and a marker row tells a
            range that its last series goes on (for the latest flag).

            There is no threshold: small and huge series take the same plan.  Writing cuts the lineage too: a lost
            executor recomputes from the ranges, and what the panel was computed from runs once.

Ordering is ``order ASC NULLS FIRST`` then the ``tiebreak`` columns, so NULL times take part in the window first, as
in the reference.  Rows that tie on all of these are ordered by a hash of the row; rows that are equal in every column
cannot be told apart and stay in one range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table

_PART, _KIND, _AT, _C, _TIE = "__part", "__kind", "__at", "__c", "__tie"
_HALO, _OWN, _MARK = 0, 1, 2
_PLACE_BITS = 33  # of monotonically_increasing_id: the rest is the partition


def _metrics(value: str, lags: Mapping[str, int], rolling: Mapping[str, int], latest: str | None,
             w: Window, order: str | None = None, order_lags: Mapping[str, int] | None = None) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for name, n in (order_lags or {}).items():
        out[name] = F.lag(order, n).over(w)
    for name, n in lags.items():
        out[name] = F.lag(value, n).over(w)
    for name, n in rolling.items():
        out[name] = F.avg(value).over(w.rowsBetween(-(n - 1), Window.currentRow))
    if latest:
        out[latest] = F.lead(F.lit(1)).over(w).isNull()
    return out


def lookback(lags: Mapping[str, int], rolling: Mapping[str, int], order_lags: Mapping[str, int] | None = None) -> int:
    return max([*lags.values(), *[n - 1 for n in rolling.values()], *(order_lags or {}).values(), 1])


def series_windows(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    lags: Mapping[str, int] | None = None,
    rolling: Mapping[str, int] | None = None,
    latest: str | None = None,
    tiebreak: Sequence[str] = (),
    strategy: str = "ranged",
    order_lags: Mapping[str, int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add lag / rolling-average / latest-flag columns computed per ``key``.

    ``lags`` maps output name → row offset; ``rolling`` maps output name → frame size in rows (current row
    included, partial frames at the start); ``order_lags`` are lags of the ordering column itself.
    ``partitions`` of the range exchange: ``spark.sql.shuffle.partitions`` unless given.
    """
    lags, rolling, order_lags = dict(lags or {}), dict(rolling or {}), dict(order_lags or {})
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not df.schema[c].dataType.typeName() == "map"])
    rows = df.withColumn(_TIE, tie)
    by = [order, *tiebreak, _TIE]
    ascending = [F.col(c).asc_nulls_first() for c in by]
    if strategy == "plain":
        w = Window.partitionBy(key).orderBy(*ascending)
        return rows.withColumns(_metrics(value, lags, rolling, latest, w, order, order_lags)).drop(_TIE)
    if strategy != "ranged":
        raise ValueError(strategy)

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_range = [F.col(c).asc_nulls_first() for c in (key, *by)]
    ranged = rows.repartitionByRange(n, *by_range).sortWithinPartitions(*by_range)
    placed = ranged.withColumn(_AT, F.monotonically_increasing_id()).withColumns(
        {_PART: F.shiftright(_AT, _PLACE_BITS).cast("int"), _AT: F.col(_AT).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))}
    )
    stored = stage_table(placed, "ranges")
    own = stored.drop(_AT).withColumn(_KIND, F.lit(_OWN))
    borders = _borders(stored, key, lookback(lags, rolling, order_lags))
    w = Window.partitionBy(key, _PART).orderBy((F.col(_KIND) == _MARK).asc(), *ascending)
    out = own.unionByName(borders).withColumns(_metrics(value, lags, rolling, latest, w, order, order_lags))
    return out.filter(F.col(_KIND) == _OWN).drop(_PART, _KIND, _TIE)


def _borders(stored: DataFrame, key: str, rows_back: int) -> DataFrame:
    """Halo and marker rows of every range that begins or ends inside a series."""
    columns = [c for c in stored.columns if c != _AT]
    sizes = stored.groupBy(F.col(_PART).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    placed = stored.join(F.broadcast(sizes), F.col(_PART) == F.col("__p"))  # one row for each range
    kinds = F.array(
        F.when(F.col(_AT) >= F.col("__n") - rows_back, F.lit(_HALO)), F.when(F.col(_AT) == 0, F.lit(_MARK))
    )
    ends = placed.filter((F.col(_AT) >= F.col("__n") - rows_back) | (F.col(_AT) == 0)).withColumn(_KIND, F.explode(F.array_compact(kinds)))
    # Number the ends of each series in order: a range's first row stands before its own last rows and behind those of
    # all earlier ranges.
    along = Window.partitionBy(key).orderBy(_PART, F.col(_KIND).desc(), _AT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn(_C, F.count_if(F.col(_KIND) == _HALO).over(along))
    before = ends.filter(F.col(_KIND) == _HALO)
    begins = ends.filter((F.col(_KIND) == _MARK) & (F.col(_C) > 0)).select(
        F.col(key).alias("__key"),
        F.col(_PART).alias("__to"),
        F.col(_C).alias("__upto"),
        F.explode(F.sequence(F.greatest(F.lit(1), F.col(_C) - rows_back + 1), F.col(_C))).alias("__back"),
    )
    needed = before.join(begins, (F.col(_C) == F.col("__back")) & F.col(key).eqNullSafe(F.col("__key")))
    # Each needed row goes to the range that begins; the very last one also marks the range it came from.
    target = F.explode(
        F.when(
            F.col("__back") == F.col("__upto"),
            F.array(F.struct(F.col("__to").alias("p"), F.lit(_HALO).alias("k")), F.struct(F.col(_PART).alias("p"), F.lit(_MARK).alias("k"))),
        ).otherwise(F.array(F.struct(F.col("__to").alias("p"), F.lit(_HALO).alias("k"))))
    )
    sent = needed.withColumn("__t", target).withColumns({_PART: F.col("__t.p"), _KIND: F.col("__t.k")})
    return sent.select(*columns, _KIND)
