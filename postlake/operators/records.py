"""Nested records: envelopes, dotted paths and the fixed, all-string and keep-all schemas."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.schemas import POST_FIELDS, VARIANT_FIELDS

VARIANT_DDL = ", ".join(f"{name}: {kind}" for name, kind in VARIANT_FIELDS.items())
RECORD_ORDER = ["file", "block", "row", "place"]


# Numbers are read with a fraction first, so that one that is not whole is seen as such.
_EXACT = "decimal(38,9)"


def _opens(text: Column) -> Column:
    return F.left(text, F.lit(1)).isin("[", "{")


def _text(doc: Column, path: str) -> Column:
    """The scalar at ``path`` as text, NULL for a list or an object."""
    value = F.try_variant_get(doc, path, "string")
    array = F.try_variant_get(doc, path, "array<variant>")
    fields = F.try_variant_get(doc, path, "map<string,variant>")
    container = _opens(value) & (array.isNotNull() | fields.isNotNull())
    return F.when(~container, value)


def unwrap_envelope(parsed: DataFrame) -> DataFrame:
    """One row per record: ``rec``, its ``place`` in its line, and ``whole``.

    A non-empty list under ``post`` holds the records, a non-empty object there is the one record.
    Otherwise the line itself is the record (``whole``), without the key ``post``. A line without a
    document gives no rows.
    """
    listed = F.try_variant_get("doc", "$.post", "array<variant>")
    single = F.try_variant_get("doc", "$.post", "map<string,variant>")
    wrapped = F.when(F.size(listed) > 0, listed).when(
        F.size(single) > 0, F.array(F.try_variant_get("doc", "$.post", "variant"))
    )
    itself = F.when(F.col("doc").isNotNull(), F.array("doc"))
    records = F.coalesce(wrapped, itself)
    keep = [c for c in parsed.columns if c not in ("line", "doc")]
    return parsed.select(
        *keep, wrapped.isNull().alias("whole"), F.posexplode(records).alias("place", "rec")
    )


def media_variants(record: str = "rec") -> Column:
    """The media variants of a record, NULL where it has none."""
    return F.try_variant_get(record, "$.media_asset.variants", f"array<struct<{VARIANT_DDL}>>")


def schema_fixed(
    records: DataFrame, fields: dict[str, str] | None = None, carry: list[str] | None = None
) -> DataFrame:
    """The record as the fixed post columns. Absent keys, lists, objects and values a column cannot
    hold are NULL. All columns come from one pass over the record; the rare record with a text that
    looks like a list or an object gets a second look for which columns really are one."""
    keep = [c for c in records.columns if c in (carry or RECORD_ORDER)]
    fields = fields or POST_FIELDS
    whole = {k for k, t in fields.items() if t in ("BIGINT", "INT")}
    texts = [k for k, t in fields.items() if t == "STRING"]
    shape = ", ".join(f"`{k}`: {_EXACT if k in whole else t}" for k, t in fields.items())
    read = records.select(
        *keep, "rec", F.try_variant_get("rec", "$", f"struct<{shape}>").alias("_r")
    )
    looks = F.exists(
        F.array(*[F.col(f"_r.{k}") for k in texts]).cast("array<string>"),
        lambda text: F.coalesce(_opens(text), F.lit(False)),
    )
    entries = F.map_filter(
        F.try_variant_get("rec", "$", "map<string,variant>"), lambda _, v: _opens(F.to_json(v))
    )
    read = read.withColumn("_open", F.when(looks, F.map_keys(entries)))

    def column(key: str) -> Column:
        value = F.col(f"_r.{key}")
        if key in whole:
            return F.when(value == F.floor(value), value.try_cast(fields[key]))
        if key in texts:
            return F.when(F.col("_open").isNull() | ~F.array_contains("_open", key), value)
        return value

    return read.select(*keep, *[column(k).alias(k) for k in fields])


def _paths_for(key: str) -> list[str]:
    """Variant paths a dotted key may stand for: the key itself, then nested objects and lists."""
    steps = [
        [f"[{part}]", f"['{part}']"] if part.isdigit() else [f"['{part}']"]
        for part in key.split(".")
    ]
    nested = ["$" + "".join(choice) for choice in itertools.product(*steps)]
    return nested if len(steps) == 1 else [f"$['{key}']", *nested]


def keep_keys(records: DataFrame, keys: list[str]) -> DataFrame:
    """The listed flattened keys as text, NULL where a record lacks one."""
    keep = [c for c in records.columns if c in RECORD_ORDER]

    def column(key: str) -> Column:
        found = F.coalesce(*[_text(F.col("rec"), path) for path in _paths_for(key)])
        return F.when(~F.col("whole"), found) if key == "post" else found

    return records.select(*keep, *[column(k).alias(k) for k in keys])


def schema_all_string(records: DataFrame, keys: list[str]) -> DataFrame:
    return keep_keys(records, sorted(keys))


def nesting(parsed: DataFrame) -> tuple[int, bool]:
    """(deepest nesting of any line, whether any key holds a dot).

    Escapes and string contents are cut from the JSON text, which leaves its brackets: far fewer
    distinct shapes than lines.
    """
    plain = F.replace(F.replace("line", F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    brackets = F.regexp_replace(F.regexp_replace(plain, '"[^"]*"', ""), r"[^\[\]{}]+", "")
    dotted = plain.rlike(r'\.[^"]*"\s*:')
    shapes = (
        parsed.select(brackets.alias("shape"), dotted.alias("dotted"))
        .groupBy("shape")
        .agg(F.max("dotted").alias("dotted"))
    )

    def step(state: Column, mark: Column) -> Column:
        now = state["now"] + F.when(mark.isin("[", "{"), 1).when(mark == "", 0).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(state["top"], now).alias("top"))

    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"))
    depth = F.aggregate(F.split("shape", ""), start, step, lambda state: state["top"])
    row = shapes.agg(F.max(depth).alias("depth"), F.max("dotted").alias("dotted")).first()
    return row["depth"] or 0, bool(row["dotted"])


def flatten_paths(
    records: DataFrame, keys: list[str], depth: int, dotted_keys: bool = True
) -> DataFrame:
    """``keys`` plus (path, value): one row per scalar, list elements by 0-based position.

    Empty containers vanish, JSON null stays a NULL value. Every level of nesting is one generator
    step without a shuffle. Where keys hold dots, two values may share a path: the one whose key
    sequence sorts last wins.
    """
    level = records.select(
        *keys, "whole", F.array().cast("array<string>").alias("trail"), F.col("rec").alias("v"),
        F.lit(True).alias("open"),
    )
    spark = records.sparkSession
    for _ in range(depth):
        exploded = spark.sql(
            "SELECT * FROM {level}, LATERAL variant_explode_outer(CASE WHEN open THEN v END) e",
            level=level,
        )
        # No element below means a scalar, which stays, or an empty container, which vanishes.
        below = F.col("pos").isNotNull()
        step = F.coalesce(F.col("key"), F.col("pos").cast("string"))
        level = exploded.where(below | ~F.col("open") | ~F.to_json("v").isin("[]", "{}")).select(
            *keys, "whole",
            F.when(below, F.concat("trail", F.array(step))).otherwise(F.col("trail")).alias("trail"),
            F.when(below, F.col("value")).otherwise(F.col("v")).alias("v"),
            below.alias("open"),
        )
    scalars = level.where("NOT (whole AND size(trail) = 1 AND trail[0] = 'post')").select(
        *keys, F.array_join("trail", ".").alias("path"),
        F.try_variant_get("v", "$", "string").alias("value"), "trail",
    )
    if not dotted_keys:
        return scalars.drop("trail")
    last = F.max_by("value", "trail").alias("value")
    return scalars.groupBy(*keys, "path").agg(last)


def schema_keep_all(records: DataFrame, flat: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` plus ``fields``, a MAP of every flattened path of a record to its value: any number of
    paths, and a row for each record, also for one without a value anywhere."""
    marks = records.select(*keys, F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("value"))
    entries = F.collect_list(F.when(F.col("path").isNotNull(), F.struct("path", "value")))
    grouped = flat.select(*keys, "path", "value").unionByName(marks).groupBy(*keys)
    return grouped.agg(F.map_from_entries(entries).alias("fields"))


def fields_as_columns(kept: DataFrame, paths: list[str]) -> DataFrame:
    """The listed paths of ``fields`` as text columns, NULL where a record lacks one."""
    others = [c for c in kept.columns if c != "fields"]
    return kept.select(*others, *[F.try_element_at("fields", F.lit(path)).alias(path) for path in paths])


def align_schema(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Cast to ``fields``: missing columns NULL, others dropped, bad values NULL."""
    return df.select(
        *[
            (F.col(f"`{k}`").try_cast(t) if k in df.columns else F.lit(None).cast(t)).alias(k)
            for k, t in fields.items()
        ]
    )


def union_aligned(frames: list[DataFrame], fields: dict[str, str]) -> DataFrame:
    merged = align_schema(frames[0], fields)
    for frame in frames[1:]:
        merged = merged.unionByName(align_schema(frame, fields))
    return merged
