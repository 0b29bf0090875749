"""Order-sensitive rewrites over feed rows.

A session or car may hold a large share of all rows, so none of these sorts a whole session in one task.
Aggregates with partial combine (``max_by``, ``min``) do the work where they can; running values are
computed inside spans of consecutive lines, and only one row per span is ordered per session to carry a
value over span borders.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slipstream.functions.jsonwalk import ORDER

SPAN_LINES = 65_536


def fill_forward(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    out: str,
    order: Sequence[str],
    span_lines: int = SPAN_LINES,
) -> DataFrame:
    """Set ``out`` to the last non-null ``value`` up to and including the row, within ``keys``.

    ``order`` starts with ``block_no, line_no``. Rows are cut into spans of lines; the value a span ends
    with is an aggregate, and a running window over those (one row per span) carries it to later spans.
    """
    span = ["block_no", "_span"]
    rows = df.withColumn("_value", value).withColumn("_span", F.col("line_no") - F.pmod("line_no", F.lit(span_lines)))
    running = Window.partitionBy(*keys, *span).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_local", F.last("_value", ignorenulls=True).over(running))

    # The whole row goes through the aggregate, so that both branches read the very same shuffle and the
    # input is computed once.
    ends = local.groupBy(*keys, *span).agg(F.max_by(F.struct(*local.columns), F.struct(*order)).alias("_end"))
    ends = ends.select(*keys, *span, F.col("_end._local").alias("_end"))
    before = Window.partitionBy(*keys).orderBy(*span).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(c).alias(f"_at_{c}") for c in (*keys, *span)],
        F.last("_end", ignorenulls=True).over(before).alias("_carry"),
    ).filter("_carry IS NOT NULL")

    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in (*keys, *span)))
    names = df.columns if out in df.columns else [*df.columns, out]
    filled = F.coalesce("_local", "_carry").alias(out)
    return local.join(carried, same, "left").select(*[filled if c == out else F.col(c) for c in names])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in arrival order, as an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return last.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_entry(raw: DataFrame) -> DataFrame:
    """The first raw entry of each session: its opening snapshot."""
    rest = [c for c in raw.columns if c != "session_id"]
    first = raw.groupBy("session_id").agg(F.min_by(F.struct(*rest), F.struct(*ORDER)).alias("_row"))
    return first.select("session_id", "_row.*").select(*raw.columns)


def last_per_key_after_first_entry(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """:func:`last_per_key` without the rows of each session's first raw entry, from one read of ``df``.

    ``keys`` begin with ``session_id`` and hold the clock; every raw entry has a row. The first entry is the least place that
    any group has seen. Both branches read the very same shuffle: each asks for the row and the least place, lest one be
    pruned from its aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"), F.min(F.struct(*ORDER)).alias("_least"))
    seen = last.select("session_id", F.when(F.col("_row").isNotNull(), F.col("_least")).alias("_least"))
    firsts = seen.groupBy("session_id").agg(F.min("_least").alias("_first"))
    later = last.filter("_least IS NOT NULL").join(firsts, "session_id").filter(F.struct(*[F.col(f"_row.{c}") for c in ORDER]) > F.col("_first"))
    return later.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def patch_back(
    df: DataFrame, keys: Sequence[str], patched: str, is_insert: str, order: Sequence[str]
) -> DataFrame:
    """Keep inserts; each takes ``patched`` from the last other row between it and the next insert of its key.

    Rows that follow no insert are lost.
    """
    place = F.struct(*order)
    marked = fill_forward(df, keys, F.when(F.col(is_insert), place), "_insert", order)
    rest = [c for c in df.columns if c not in keys and c not in (patched, is_insert)]
    late = F.when(~F.col(is_insert), place)
    groups = (
        marked.filter("_insert IS NOT NULL")
        .groupBy(*keys, "_insert")
        .agg(
            F.max_by(F.struct(*rest, F.col(patched).alias("_own")), F.when(F.col(is_insert), place)).alias("_row"),
            F.max_by(F.struct(F.col(patched).alias("value")), late).alias("_patch"),
        )
    )
    value = F.when(F.col("_patch").isNotNull(), F.col("_patch.value")).otherwise(F.col("_row._own"))

    def column(name: str) -> Column:
        if name in keys:
            return F.col(name)
        return value.alias(name) if name == patched else F.col(f"_row.{name}").alias(name)

    return groups.select(*[column(c) for c in df.columns if c != is_insert])
