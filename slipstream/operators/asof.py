"""As-of join: every left row with the right row of its key that is nearest (or last before, or first after).

Spark has no such join, and a window over all rows of a key would put a busy key into one task. Instead:

1. Both sides are put into one table, tagged, and shuffled once into ranges of key, clock and place. The bounds come from a
   sample of fixed size, so ranges hold about as many rows each, however unevenly keys and clocks are filled.
2. Inside a range, running windows up and down the clock carry the last right row before and the first right row
   after every left row. They stream over sorted rows.
3. Each range's last and first right row of a key are aggregated from the same shuffle; only these border rows, one for
   each range and key, are ordered per key, to carry a right row over the edges of ranges.

Of right rows with equal keys and clocks the later line wins.
"""

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slipstream.functions.jsonwalk import ORDER, bound
from slipstream.functions.parse import clock_seconds

#: Rows of the sample for each range that is wanted.
SAMPLE = 40
PLACE = [*ORDER, "key_pos"]


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str = "timestamp_ms",
    by: Sequence[str] = ("session_id", "racing_number"),
    strategy: str = "nearest",
    tolerance: int | None = None,
    place: Sequence[str] = PLACE,
    suffix: str = "_right",
    ranges: int | None = None,
) -> DataFrame:
    """All left rows, each with the chosen right row's columns or nulls.

    On equal distance the earlier right row counts. Right columns that clash get ``suffix``; keys, clock and
    ``place`` columns of the right side are not repeated. ``place`` identifies a row within its key; ``on`` counts
    in whole numbers. Rows with a null key or clock match nothing. ``ranges`` is the number of tasks, by default that
    of shuffles; it changes no result. With 0 rows are joined where they lie: sides that are bucketed by the keys then need no
    shuffle, and all rows of a key are one task's work.
    """
    if strategy not in ("nearest", "backward", "forward"):
        raise ValueError(f"unknown strategy {strategy!r}")
    by = list(by)
    if not by:
        raise ValueError("an as-of join needs at least one key column")
    keys = [f"_by{i}" for i in range(len(by))]
    cell = [*keys, "_range"] if ranges != 0 else keys
    values = [c for c in right.columns if c not in (*by, on, *place)]
    names = {c: c + suffix if c in left.columns else c for c in values}

    both = _tagged(left, right, on, by, values, place)
    if ranges != 0:
        ranges = ranges or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        where = both.select(*keys, "_at", "_is_left", "_place")
        both = both.withColumn("_range", _range_of(where, ranges)).repartition(ranges, "_range")
    reach = (Window.unboundedPreceding, Window.currentRow)
    up = Window.partitionBy(*cell).orderBy("_at", "_is_left", "_place").rowsBetween(*reach)
    down = Window.partitionBy(*cell).orderBy(F.desc("_at"), "_is_left", "_place").rowsBetween(*reach)
    found = both.select("*", F.max("_item").over(up).alias("_before"), F.max(_ahead(F.col("_item"))).over(down).alias("_after"))

    joined = found.filter("_is_left")
    if ranges != 0:
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_edge{c}")) for c in cell))
        joined = joined.join(_borders(both, cell), same, "left")
        edges = F.col("_edge_before"), F.col("_edge_after")
    else:
        edges = F.col("_before"), F.col("_after")
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in (*keys, "_at")))
    before = F.greatest(F.col("_before"), edges[0])
    # right rows at the very clock of a left row come before it, so only the way up has always seen them
    after = F.when(before["at"] == F.col("_at"), before).otherwise(_ahead(F.greatest(F.col("_after"), edges[1])))
    hit = {"backward": before, "forward": after, "nearest": _nearer(before, after, F.col("_at"))}[strategy]
    hit = F.when(known, hit)
    if tolerance is not None:
        hit = F.when(F.abs(hit["at"] - F.col("_at")) <= tolerance, hit)
    chosen = joined.select("_left", hit.alias("_hit"))
    return chosen.select(*[F.col(f"_left.{c}").alias(c) for c in left.columns], *[F.col(f"_hit.row.{c}").alias(n) for c, n in names.items()])


def _tagged(left: DataFrame, right: DataFrame, on: str, by: list[str], values: list[str], place: Sequence[str]) -> DataFrame:
    """Both sides in one table: keys, clock, place, and either the left row or the right item.

    Items are compared by clock, then place.
    """
    keys = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    where = F.struct(*[F.col(c) for c in place]).alias("_place")
    lefts = left.select(*keys, F.col(on).alias("_at"), where, F.struct(*[F.col(c) for c in left.columns]).alias("_left"))
    item = F.struct(F.col(on).cast("long").alias("at"), where.alias("place"), F.struct(*[F.col(c) for c in values]).alias("row"))
    rights = right.filter(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in (*by, on))))
    rights = rights.select(*keys, F.col(on).alias("_at"), where, item.alias("_item"))
    return lefts.withColumn("_is_left", F.lit(True)).unionByName(rights.withColumn("_is_left", F.lit(False)), allowMissingColumns=True)


def _ahead(item: Column) -> Column:
    """An item with its clock negated, so that the greatest one is the earliest; and back again."""
    return F.when(item.isNotNull(), F.struct((-item["at"]).alias("at"), item["place"].alias("place"), item["row"].alias("row")))


def _range_of(rows: DataFrame, ranges: int) -> Column:
    """The number of the range a row falls into, as an expression over the columns of ``rows``.

    The bounds are taken from the ``SAMPLE * ranges`` rows of least hash, in one pass over these columns. A row meets the
    bounds in two steps: the first bounds of groups of them, then those of its group.
    """
    picked = rows.orderBy(F.xxhash64(*rows.columns)).limit(SAMPLE * ranges)
    whole = F.struct(*[F.col(c) for c in rows.columns])
    listed = picked.agg(F.sort_array(F.collect_list(whole)).alias("all"))
    kind = listed.schema["all"].dataType.simpleString()
    sample = json.loads(listed.select(F.to_json("all")).first()[0])
    bounds = [sample[len(sample) * k // ranges] for k in range(1, ranges)] if sample else []
    if not bounds:
        return F.lit(0)
    size = int(len(bounds) ** 0.5) + 1
    groups = [bounds[k : k + size] for k in range(0, len(bounds), size)]
    heads = F.from_json(F.lit(json.dumps([g[0] for g in groups[1:]])), kind)
    fine = F.from_json(F.lit(json.dumps(groups)), f"array<{kind}>")

    def number(place: Column) -> Column:
        reached = lambda found: F.size(F.filter(found, lambda b: b <= place))
        return bound(reached(heads), lambda g: g * size + reached(F.get(fine, g)))

    return bound(whole, number)


def _borders(both: DataFrame, cell: list[str]) -> DataFrame:
    """Per range and key, the last right row of earlier ranges and the first of later ones.

    The whole row goes through the aggregates, so that this branch reads the very same shuffle as the windows.
    """
    whole = F.struct(*[F.col(c) for c in both.columns])
    right = ~F.col("_is_left")
    tail = F.max_by(whole, F.when(right, F.struct("_at", "_place")))["_item"]
    head = F.max_by(whole, F.when(right, F.struct(-F.col("_at"), "_place")))["_item"]
    ends = both.groupBy(*cell).agg(tail.alias("_tail"), head.alias("_head"))
    up = Window.partitionBy(*cell[:-1]).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*cell[:-1]).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(
        *[F.col(c).alias(f"_edge{c}") for c in cell],
        F.max("_tail").over(up).alias("_edge_before"),
        F.max(_ahead(F.col("_head"))).over(down).alias("_edge_after"),
    )


def _nearer(before: Column, after: Column, at: Column) -> Column:
    """The one of two items that is closer; the earlier one if they are equally far."""
    first = before["at"].isNotNull() & (after["at"].isNull() | (at - before["at"] <= after["at"] - at))
    return F.when(first, before).otherwise(after)


def telemetry_on_track(car: DataFrame, position: DataFrame, racing_number: int | None = None, ranges: int | None = None) -> DataFrame:
    """Telemetry with the nearest position of the same car, and a clock in whole seconds."""
    if racing_number is not None:
        car, position = (df.filter(F.col("racing_number") == racing_number) for df in (car, position))
    return asof_join(car, position, ranges=ranges).withColumn("timestamp_s", clock_seconds(F.col("timestamp_ms")))
