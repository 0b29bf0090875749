"""Walking loosely shaped JSON with built-in functions.

A payload is parsed once with a fixed schema whose polymorphic fields stay text. Objects are read as
``MAP<STRING,STRING>``, which keeps document order and leaves nested values as JSON text, so the next
level is parsed only for children that are kept.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = ["block_no", "line_no", "entry_no"]
ENTRY = ["session_id", *ORDER, "timestamp_ms"]
LINEAGE = ["session_id", *ORDER, "key_pos", "timestamp_ms"]


def is_object(text: Column) -> Column:
    return F.startswith(text, F.lit("{"))


def is_list(text: Column) -> Column:
    return F.startswith(text, F.lit("["))


def is_text(json: Column, field: str) -> Column:
    """Whether ``field`` of the object itself holds a JSON string: found through a list, a value keeps its quotes."""
    return F.startswith(F.get_json_object(F.concat(F.lit("["), json, F.lit("]")), f"$[*].{field}"), F.lit('"'))


#: Column of rows whose text was not judged yet: what to do with broken JSON, ``raise`` or ``drop``.
UNJUDGED = "_on_bad"


def broken_json(text: Column) -> Column:
    """Whether a text is no JSON object or list, cut off ones included. Nothing is built from it."""
    whole = F.from_json(text, "STRUCT<_odd: STRING>", {"columnNameOfCorruptRecord": "_odd"})
    listed = F.from_json(text, "ARRAY<STRING>")
    return F.when(F.startswith(text, F.lit("[")), listed.isNull()).otherwise(whole["_odd"].isNotNull() | ~F.startswith(text, F.lit("{")))


def sound(df: DataFrame, doubt: Column, source: str) -> DataFrame:
    """Rows of unjudged text whose text is sound. The refusal is a filter, so no choice of columns takes it away.

    ``doubt`` comes from a parse that is made anyway and is true for every broken text; only there the text is looked at
    again, to tell a broken one from one of another shape.
    """
    if UNJUDGED not in df.columns:
        return df
    complaint = F.raise_error(F.concat(F.lit("Malformed stream line (json): "), F.substring(source, 1, 80))).cast("boolean")
    refused = F.when(F.col(UNJUDGED) == "drop", F.lit(False)).otherwise(complaint)
    return df.filter(F.when(F.coalesce(doubt, F.lit(True)) & broken_json(F.col(source)), refused).otherwise(F.lit(True))).drop(UNJUDGED)


def judged(df: DataFrame, source: str = "payload") -> DataFrame:
    """Rows whose text is sound, by a parse of its own."""
    return sound(df, F.lit(True), source)


def once(value: Column) -> Column:
    """``value`` as a row of its own, so that a filter on it is not copied below it and evaluates it again."""
    return F.explode(F.array(value))


def parsed(df: DataFrame, schema: str, source: str = "payload", out: str = "p", keep: bool = False) -> DataFrame:
    """Parse with a schema of texts. Unjudged rows are judged by the same parse."""
    if UNJUDGED not in df.columns:
        rows = df.withColumn(out, F.from_json(source, schema))
    else:
        rows = parsed_strictly(df, schema, source, out)
    return rows if keep else rows.drop(source)


def parsed_strictly(df: DataFrame, schema: str, source: str, out: str = "p") -> DataFrame:
    """Parse with a fully typed schema in one pass; ``out._odd`` holds the text if any part did not fit.

    Callers read the typed values where ``_odd`` is null and take the text apart level by level elsewhere,
    so the usual shape costs one parse and no other shape is lost. Unjudged rows are judged by the same parse.
    """
    value = F.from_json(source, f"STRUCT<{schema}, _odd: STRING>", {"columnNameOfCorruptRecord": "_odd"})
    if UNJUDGED not in df.columns:
        return df.withColumn(out, value)
    return sound(df.select("*", once(value).alias(out)), F.col(f"{out}._odd").isNotNull(), source)


def mapped(raw: DataFrame, source: str = "payload", out: str = "m") -> DataFrame:
    """Raw entries with the top level of their payload as a map. Unjudged rows are judged by the same parse."""
    value = F.from_json(source, "MAP<STRING,STRING>")
    if UNJUDGED not in raw.columns:
        return raw.select(*ENTRY, value.alias(out))
    return sound(raw.select(*ENTRY, UNJUDGED, source, once(value).alias(out)), F.col(out).isNull(), source).drop(source)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def entries_of(json: Column, schema: str = "MAP<STRING,STRING>", field: str | None = None) -> Column:
    """Ordered entries of a JSON object text, or of one of its fields, inside an expression."""
    m = F.from_json(json, schema)
    return bound(m if field is None else m[field], ordered_entries)


def ordered_entries(m: Column) -> Column:
    """Entries of a map in document order; of equal keys the last value counts, at the first place."""
    keys, entries = F.map_keys(m), F.map_entries(m)
    distinct = F.array_distinct(keys)

    def last_of(key: Column) -> Column:
        return F.element_at(F.filter(entries, lambda e: e["key"] == key), -1)

    return F.when(F.size(keys) == F.size(distinct), entries).otherwise(F.transform(distinct, last_of))


def explode_map(
    df: DataFrame, m: str, pos: str = "key_pos", key: str = "key", value: str = "value", keep: Callable[[Column], Column] | None = None
) -> DataFrame:
    """One row per entry of map column ``m``; rows without entries go. With ``keep`` one row per entry that it is true for,
    and one without position, key and value where there is none."""
    entries = ordered_entries(F.col(m))
    if keep is None:
        rows = df.select("*", F.posexplode(entries).alias(pos, "_e"))
    else:
        placed = F.transform(entries, lambda e, i: F.struct(i.alias("pos"), e["key"].alias("key"), e["value"].alias("value")))
        rows = df.select("*", F.explode_outer(F.filter(placed, keep)).alias("_e")).withColumn(pos, F.col("_e.pos"))
    return rows.select("*", F.col("_e.key").alias(key), F.col("_e.value").alias(value)).drop("_e", m.split(".")[0])


def explode_objects(df: DataFrame, m: str, pos: str = "key_pos", key: str = "key", value: str = "value") -> DataFrame:
    """As :func:`explode_map`, keeping only children that are objects themselves."""
    return explode_map(df, m, pos, key, value).filter(is_object(F.col(value)))


def explode_items(
    df: DataFrame, text: str, pos: str = "key_pos", key: str = "key", value: str = "value", lists: bool = True
) -> DataFrame:
    """One row per child of JSON text that is an object or a list.

    A list child gets its 0-based index as key. With ``lists=False`` a list gives no rows.
    """
    source = F.col(text)
    shaped = df.select(
        "*",
        F.when(is_object(source), F.from_json(source, "MAP<STRING,STRING>")).alias("_map"),
        F.when(is_list(source), F.from_json(source, "ARRAY<STRING>")).alias("_list"),
    ).drop(text.split(".")[0])
    listed = F.transform(F.col("_list"), lambda v, i: F.struct(i.cast("string").alias("key"), v.alias("value")))
    items = F.coalesce(ordered_entries(F.col("_map")), listed) if lists else ordered_entries(F.col("_map"))
    rows = shaped.select("*", F.posexplode(items).alias(pos, "_e"))
    return rows.select("*", F.col("_e.key").alias(key), F.col("_e.value").alias(value)).drop("_e", "_map", "_list")


def explode_object_items(df: DataFrame, text: str, pos: str, key: str, value: str, lists: bool = True) -> DataFrame:
    return explode_items(df, text, pos, key, value, lists).filter(is_object(F.col(value)))
