"""JSON properties as VARIANT: parse, flatten to columns, or unfold to key/value rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_json_object(text: Column | str) -> Column:
    """True when the text is a JSON object; never NULL. What parses and starts with a
    brace is one, so no schema has to be worked out per row."""
    text = F.col(text) if isinstance(text, str) else text
    parses = F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{")
    return F.coalesce(parses, F.lit(False))


def parse_props(df: DataFrame, col: str, on_bad: str = "fail") -> DataFrame:
    """JSON text to VARIANT. Missing or broken JSON, or JSON that is not an object, stops
    the job (``'fail'``) or becomes NULL with ``{col}_ok`` false (``'quarantine'``)."""
    if on_bad not in ("fail", "quarantine"):
        raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")
    parsed, is_object = F.try_parse_json(col), is_json_object(col)
    if on_bad == "quarantine":
        return df.withColumn(f"{col}_ok", is_object).withColumn(col, F.when(is_object, parsed))
    bad = F.raise_error(
        F.concat(F.lit("not a JSON object: "), F.coalesce(F.col(col), F.lit("NULL")))
    ).cast("variant")
    return df.withColumn(col, F.when(is_object, parsed).otherwise(bad))


def props_schema(df: DataFrame, col: str) -> T.StructType:
    """Union of the keys and types seen in a VARIANT column: one aggregate, and only the
    schema text comes back. Values of clashing types get StringType."""
    return schema_from_text(df.agg(F.schema_of_variant_agg(col)).first()[0])


def schema_from_text(text: str | None) -> T.StructType:
    """The struct type a VARIANT schema text such as ``OBJECT<k: BIGINT>`` describes."""
    if not text or not text.startswith("OBJECT"):
        return T.StructType()
    # Outside of back-quoted names, rewrite the type words Spark's DDL does not have.
    pieces = re.split(r"(`(?:[^`]|``)*`)", text)
    for i in range(0, len(pieces), 2):
        pieces[i] = re.sub(r"\bOBJECT<", "STRUCT<", pieces[i])
        pieces[i] = re.sub(r"\b(VARIANT|VOID)\b", "STRING", pieces[i])
    parsed = T.DataType.fromDDL("".join(pieces))
    return parsed if isinstance(parsed, T.StructType) else T.StructType()


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType) and field.dataType.fields:
            yield from _leaves(field.dataType, here)
        else:
            yield here, field.dataType


def _step(key: str) -> str | None:
    """A path step in whichever quotes the key does not contain; NULL if in neither."""
    for quote in ('"', "'"):
        if quote not in key:
            return f"[{quote}{key}{quote}]"
    return None


def _leaf(col: Column, path: tuple[str, ...], kind: T.DataType) -> Column:
    steps = [_step(key) for key in path]
    if None in steps:  # a key with both kinds of quotes: go down by map look-ups
        for key in path:
            col = F.try_element_at(col.try_cast("map<string,variant>"), F.lit(key))
        steps = []
    where = "$" + "".join(steps)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(F.try_variant_get(col, where, "variant"))
    if isinstance(kind, T.DecimalType):
        kind = T.DoubleType()
    return F.try_variant_get(col, where, kind.simpleString())


def flatten_props(
    df: DataFrame, col: str, prefix: str = "prop_", schema: T.StructType | None = None
) -> DataFrame:
    """One column per leaf key, nested keys joined with a dot (``prop_size.unit``).

    Numbers with a fraction become DOUBLE, arrays their JSON text. All columns come from
    the same row of the same frame: there is no join. For very many keys use
    :func:`explode_props`.
    """
    schema = props_schema(df, col) if schema is None else schema
    rest = [F.col(f"`{c}`") for c in df.columns if c != col]
    flat = [
        _leaf(F.col(col), path, kind).alias(prefix + ".".join(path))
        for path, kind in _leaves(schema)
    ]
    return df.select(*rest, *flat)


def explode_props(df: DataFrame, col: str, key: str = "segment") -> DataFrame:
    """``segment, key, value``: one row per top-level property, values as text."""
    unfolded = df.select(key, col).lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col(col).outer())
    )
    return unfolded.select(key, "key", F.col("value").try_cast("string").alias("value"))


def frequent_keys(df: DataFrame, col: str, share: float = 0.01) -> list[str]:
    """Top-level keys of at least ``share`` of the objects, in order. Keys are counted
    exactly, with partial sums, wherever they fall; as many come to the driver as an
    object has keys on average, divided by ``share``, however many there are."""
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    objects = df.filter(F.col(col).isNotNull())
    keys = objects.select(F.explode(F.map_keys(F.col(col).try_cast("map<string,variant>"))).alias("key"))
    total = objects.agg(F.count(F.lit(1))).scalar()
    counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return sorted(r["key"] for r in counted.filter(F.col("n") >= F.lit(share) * total).collect())


def split_rare(df: DataFrame, col: str, frequent: list[str], rest: str) -> DataFrame:
    """``col`` with the frequent keys only, and the others with their values as text in the
    map ``rest``. Nothing is lost, and no schema grows with the number of keys."""
    every = F.col(col).try_cast("map<string,variant>")
    listed = F.array(*[F.lit(k) for k in frequent]).cast("array<string>")
    kept = F.map_filter(every, lambda k, _: F.array_contains(listed, k))
    others = F.map_filter(every, lambda k, _: ~F.array_contains(listed, k))
    return df.withColumns({
        rest: F.transform_values(others, lambda _, v: F.coalesce(v.try_cast("string"), F.to_json(v))),
        col: F.to_variant_object(kept),
    })


def flatten_frequent(
    df: DataFrame, col: str, share: float = 0.01, prefix: str = "prop_", rest: str = "prop_rest"
) -> DataFrame:
    """As :func:`flatten_props` for keys of at least ``share`` of the objects; the others are
    in ``rest``, which is empty for a row without any and NULL for one without an object. For
    tables with keys without number: columns and schema are bounded by ``share``."""
    parted = split_rare(df, col, frequent_keys(df, col, share), rest)
    flat = flatten_props(parted, col, prefix)
    return flat.select(*[f"`{c}`" for c in flat.columns if c != rest], rest)
