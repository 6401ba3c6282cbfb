"""Lookups, semi and anti joins, event windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.functions.dates import good_friday
from lodgeframe.operators.ordered import SLICE, sliced, with_previous
from lodgeframe.operators.sizing import attach_by_key


def lookup_join(df: DataFrame, dimension: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join to a dimension; Spark broadcasts it if its size in bytes allows."""
    return df.join(dimension, key, "left")


def agg_join_back(
    df: DataFrame, facts: DataFrame, key: str, aggregates: Mapping[str, Column], missing=0
) -> DataFrame:
    """Aggregate the facts by key and attach them; keys without facts get ``missing``."""
    table = facts.groupBy(key).agg(*[agg.alias(n) for n, agg in aggregates.items()])
    return attach_by_key(df, table, [key]).fillna(missing, subset=list(aggregates))


def semi_join(df: DataFrame, chosen: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``chosen``.

    The distinct adds no shuffle of its own and shrinks hot keys before the join's shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(chosen.select(*keys).distinct(), keys, "left_semi")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left table that the right one lacks."""
    return left.subtract(right)


def key_differences(
    left: DataFrame, right: DataFrame, key: str, sides: tuple[str, str] = ("left", "right")
) -> DataFrame:
    """Trimmed keys found on one side only, with the side's name."""
    trimmed = [t.select(F.trim(F.col(key).cast("string")).alias(key)).distinct() for t in (left, right)]

    def only(a: DataFrame, b: DataFrame, side: str) -> DataFrame:
        return a.join(b, key, "left_anti").withColumn("side", F.lit(side))

    return only(*trimmed, sides[0]).unionByName(only(*reversed(trimmed), sides[1]))


def event_windows(years: DataFrame, year: str = "year") -> DataFrame:
    """(label, start, end) of every event in the given years."""
    y = F.col(year)

    def window(label: str, start: tuple[int, int], end: tuple[int, int], years_on: int = 0) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            F.make_date(y, F.lit(start[0]), F.lit(start[1])).alias("start"),
            F.make_date(y + years_on, F.lit(end[0]), F.lit(end[1])).alias("end"),
        )

    friday = good_friday(y)
    # Event windows drawn on the occupancy report.
    windows = [
        window("Feria de Málaga", (8, 15), (8, 22)),
        window("Puente de diciembre", (12, 6), (12, 8)),
        window("Zambombas flamencas", (12, 12), (12, 19)),
        window("Navidad", (12, 20), (1, 6), years_on=1),
        window("Noche de San Juan", (6, 23), (6, 23)),
        F.struct(
            F.lit("Semana Santa").alias("label"),
            F.date_sub(friday, 7).alias("start"),
            F.date_add(friday, 1).alias("end"),
        ),
    ]
    return years.select(F.inline(F.array(*windows)))


def interval_join(df: DataFrame, date: str, windows: DataFrame) -> DataFrame:
    """One row per (row, event) for dates inside an event window, ends included.

    Windows are unrolled to days first, which makes this an equality join.
    """
    days = windows.select(
        F.explode(F.sequence("start", "end")).alias(date), F.col("label").alias("event")
    )
    return df.join(days, date)

_SECOND = 1_000_000  # microseconds, the unit of bins over timestamps


def _place(df: DataFrame, column: str) -> tuple[Column, int]:
    """A column as a whole number that orders like it, and how many of them make one unit of a bin's width."""
    kind = df.schema[column].dataType.typeName()
    if kind == "timestamp":
        return F.unix_micros(F.col(column)), _SECOND
    if kind == "timestamp_ntz":  # by its fields: a zone's clock changes would put places out of order
        day, second = F.unix_date(F.col(column).cast("date")).cast("long"), F.expr(f"extract(SECOND FROM `{column}`)")
        return (day * 86400 + F.hour(column) * 3600 + F.minute(column) * 60) * _SECOND + (second * _SECOND).cast("long"), _SECOND
    if kind == "date":
        return F.unix_date(F.col(column)).cast("long"), 1
    if kind in ("byte", "short", "integer", "long"):
        return F.col(column).cast("long"), 1
    raise TypeError(f"{column}: bins are laid over timestamps, dates and whole numbers, not over {kind}")


def range_join(
    df: DataFrame, at: str, windows: DataFrame, widths: Sequence[int], start: str = "start", end: str = "end"
) -> DataFrame:
    """One row per (row, window) with start <= at <= end, by bins: an equality join, then the test of the ends.

    ``widths`` are bin widths from narrow to wide, in seconds for timestamps, days for dates, else in units of the
    column. A window is laid on the narrowest bins that are as long as it is, so it has two rows at most; only windows
    beyond the widest have more. A row has one key for each width. So minutes and years can stand in one table,
    and rows grow with windows and widths, not with the length of a window. A bin that very many rows fall in
    is split by the join. Nulls and windows that end before they start match nothing; columns of both sides stay,
    and may not share names.
    """
    point, unit = _place(df, at)
    first, other = _place(windows, start)
    last, _ = _place(windows, end)
    if unit != other or df.schema[at].dataType != windows.schema[start].dataType:
        raise TypeError(f"{at} and {start} are of different kinds")
    if not widths or any(w <= 0 for w in widths) or list(widths) != sorted(set(widths)):
        raise ValueError("widths must be positive and grow")
    wide = [w * unit for w in widths]

    def bin_of(place: Column, width: Column) -> Column:
        return place - F.pmod(place, width)

    keys = F.array(*(F.struct(F.lit(i).alias("width"), bin_of(point, F.lit(w)).alias("bin")) for i, w in enumerate(wide)))
    level = F.lit(len(wide) - 1)
    for i in reversed(range(len(wide) - 1)):
        level = F.when(last - first <= wide[i], F.lit(i)).otherwise(level)
    width = F.element_at(F.array(*map(F.lit, wide)), F.col("_level") + 1).cast("long")
    laid = windows.where(last >= first).withColumn("_level", level)
    laid = laid.withColumn("_bin", F.explode(F.sequence(bin_of(first, width), bin_of(last, width), width)))
    keyed = df.where(point.isNotNull()).withColumn("_key", F.explode(keys))
    same = (F.col("_key.width") == F.col("_level")) & (F.col("_key.bin") == F.col("_bin"))
    return keyed.join(laid, same & F.col(at).between(F.col(start), F.col(end))).drop("_key", "_level", "_bin")


def totals_after(
    df: DataFrame,
    at: str,
    windows: DataFrame,
    length: int,
    sums: Mapping[str, str] | None = None,
    distinct: Mapping[str, str] | None = None,
    start: str = "start",
    count: str = "n",
) -> DataFrame:
    """The windows with ``count``, sums and numbers of different values of the rows with start <= at <= start + length.

    The aggregate of ``range_join`` for windows of one length, in seconds for timestamps, days for dates, else in units
    of the column, without a row for each pair: the work grows with rows and windows, however many rows a window holds.
    Windows without rows and null starts are left out, as by the join; null values count for ``count`` only.

    Over bins as long as a window, each window is the end of a bin and the beginning of the next, so its sums are
    two running sums put together and nothing is subtracted. A value's row stands for the starts it is the first to
    be met from: after the value's row before it, and ``length`` before itself at most. Those stretches are disjoint, so the
    stretches that are open at a start are the different values of its window. Running sums are sliced.
    """
    sums, distinct = dict(sums or {}), dict(distinct or {})
    point, unit = _place(df, at)
    first, other = _place(windows, start)
    if unit != other or df.schema[at].dataType != windows.schema[start].dataType:
        raise TypeError(f"{at} and {start} are of different kinds")
    if length <= 0:
        raise ValueError("length must be positive")
    wide = F.lit(length * unit).cast("long")
    held, kinds = ["_n", *(f"_v{i}" for i in range(len(sums)))], [f"_c{i}" for i in range(len(distinct))]

    values = {f"_v{i}": F.col(c) for i, c in enumerate(sums.values())}
    named = {f"_d{i}": F.col(c) for i, c in enumerate(distinct.values())}
    points = df.select(point.alias("_p"), *(c.alias(k) for k, c in (values | named).items())).where("_p IS NOT NULL")
    starts = windows.select(first.alias("_p")).where("_p IS NOT NULL")
    tables = [
        points.select("_p", F.lit(1).cast("long").alias("_n"), *values),
        starts.select("_p", F.lit(True).alias("_from")),
        starts.select((F.col("_p") + wide).alias("_p"), F.lit(True).alias("_to")),
    ]
    for value, kind in zip(named, kinds):
        met = with_previous(points.select(value, "_p").where(F.col(value).isNotNull()).distinct(), value, ["_p"], ["_p"])
        opened = F.greatest(F.col("_p") - wide, F.col("prev._p") + 1)
        tables += [
            met.select(opened.alias("_p"), F.lit(1).cast("long").alias(kind)),
            met.select((F.col("_p") + 1).alias("_p"), F.lit(-1).cast("long").alias(kind)),
        ]
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table, True)
    marks = every.groupBy("_p").agg(*(F.sum(c).alias(c) for c in (*held, *kinds)), *(F.max(c).alias(c) for c in ("_from", "_to")))
    rows = sliced(marks.withColumn("_bin", F.col("_p") - F.pmod("_p", wide)), ["_p"])

    def both(a: Column, b: Column) -> Column:
        return F.coalesce(a + b, a, b)

    # What other slices hold of a bin; only the first and the last bin of a slice go on in others.
    parts = rows.groupBy(SLICE, "_bin").agg(*(F.sum(c).alias(c) for c in held))
    same = Window.partitionBy("_bin")
    sides = {
        "_before": same.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1),
        "_after": same.orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1),
    }
    carried = parts.select(
        F.col(SLICE), "_bin", F.count(F.lit(1)).over(same).alias("_parts"),
        *(F.sum(c).over(w).alias(side + c) for side, w in sides.items() for c in held),
    ).where("_parts > 1").drop("_parts")
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(SLICE).agg(F.lit(0).alias("_none"), *(F.sum(c).alias(c) for c in kinds))
    offsets = offsets.select(SLICE, *(F.sum(c).over(earlier).alias(f"_offset{c}") for c in kinds))

    inside = Window.partitionBy(SLICE, "_bin")
    up, down, through = inside.orderBy("_p"), inside.orderBy(F.desc("_p")), Window.partitionBy(SLICE).orderBy("_p")
    upto, downto, sofar = (w.rowsBetween(Window.unboundedPreceding, Window.currentRow) for w in (up, down, through))
    run = rows.withColumns(
        {
            **{f"_open{c}": F.sum(c).over(sofar) for c in kinds},
            **{f"_upto{c}": F.sum(c).over(upto) for c in held},
            **{f"_downto{c}": F.sum(c).over(downto) for c in held},
        }
    )
    run = run.where("_from OR _to").join(F.broadcast(carried), [SLICE, "_bin"], "left").join(F.broadcast(offsets), SLICE)
    begun = [both(F.col(f"_downto{c}"), F.col(f"_after{c}")).alias(c) for c in held]
    ended = [both(F.col(f"_upto{c}"), F.col(f"_before{c}")).alias(c) for c in held]
    opened = [both(F.col(f"_open{c}"), F.col(f"_offset{c}")).alias(c) for c in kinds]
    unknown = [F.lit(None).cast("long").alias(c) for c in kinds]
    halves = F.array(
        F.when(F.col("_from"), F.struct(F.col("_p").alias("_at"), *begun, *opened)),
        F.when(F.col("_to"), F.struct((F.col("_p") - wide).alias("_at"), *ended, *unknown)),
    )
    met = run.select(F.inline(F.array_compact(halves))).groupBy("_at").agg(
        F.sum("_n").alias(count),
        *(F.sum(f"_v{i}").alias(name) for i, name in enumerate(sums)),
        *(F.coalesce(F.max(c), F.lit(0)).alias(name) for c, name in zip(kinds, distinct)),
    )
    return attach_by_key(windows.withColumn("_at", first), met.where(F.col(count) > 0), ["_at"], "inner").drop("_at")
