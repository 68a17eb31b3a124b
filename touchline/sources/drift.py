"""Schemas that drift between documents (H3): inferred by executors, merged, widened.

A provider's documents don't all have the same fields, nor the same kind of value in
a field. ``merged_schema`` infers every element's schema where it is read and merges
them in a partial aggregation, so a task sends one schema, as long as the list of fields
and not as the data. Whole numbers and fractions widen to double, objects merge field by
field at every level, and a field that holds an object here and a text there is read
as text. ``drift_union`` does the same for frames that are loaded already.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources.arrays import scan_array_documents

#: What the inferred schema of JSON values is called, and the type that holds it. Names in backquotes or before a colon are fields.
_KINDS = [("OBJECT<", "STRUCT<"), ("VARIANT", "STRING"), ("VOID", "STRING"), (r"DECIMAL\(\d+,\s?\d+\)", "DOUBLE"), ("FLOAT", "DOUBLE")]


def _type(text: str) -> T.DataType:
    """The Spark type of an inferred schema."""
    pattern = "`(?:[^`]|``)*`|" + "|".join(rf"\b{k}(?!\s*:)" for k, _ in _KINDS)

    def named(m: re.Match) -> str:
        return next((v for k, v in _KINDS if re.fullmatch(k, m[0])), m[0])

    return T.DataType.fromDDL(re.sub(pattern, named, text))


def document_schemas(elements: DataFrame) -> DataFrame:
    """``source_file, schema``: the merged schema of each document's elements, as text."""
    return elements.groupBy("source_file").agg(F.schema_of_variant_agg(F.try_parse_json("element")).alias("schema"))


def merged_schema(elements: DataFrame) -> T.StructType:
    """The schema that all texts ``element`` fit; texts that are no objects, or no JSON, take no part. None gives no fields."""
    value = F.try_parse_json("element")
    text = elements.filter(F.ltrim("element").startswith("{")).agg(F.schema_of_variant_agg(value)).first()[0]
    found = _type(text)
    return found if isinstance(found, T.StructType) else T.StructType()


def read_drifting(spark: SparkSession, path: str | list[str], folders: bool = False) -> DataFrame:
    """Array documents by the merged schema of all their elements, whatever they hold, and ``source_file``.

    Elements that are no objects have null fields.
    """
    elements = scan_array_documents(spark, path, folders=folders).filter(~F.col("unreadable"))
    schema = merged_schema(elements)
    parsed = elements.select(F.from_json("element", schema).alias("row"), "source_file") if schema.fields else elements.select("source_file")
    return parsed.select(*[F.col("row").getField(f.name).alias(f.name) for f in schema.fields], "source_file")


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: the wider number, an object with the
    fields of both, and text where the kinds have nothing in common."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f for f in b.fields}
        both = [T.StructField(f.name, merge_types(f.dataType, other[f.name].dataType) if f.name in other else f.dataType) for f in a.fields]
        return T.StructType(both + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in a.names])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType))
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def _fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as the type ``want``, nested fields included; missing ones are null."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        fields = [(_fitted(value.getField(f.name), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, have.elementType, want.elementType))
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(want)


def drift_union(frames: list[DataFrame]) -> DataFrame:
    """The rows of all frames under their merged schema, in the order in which fields first appear.

    The frames are united pairwise, so the plan is as deep as the logarithm of their number.
    """
    schema = reduce(merge_types, [f.schema for f in frames])

    def fit(frame: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in frame.schema.fields}
        return frame.select(*[(_fitted(F.col(f"`{f.name}`"), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])

    fitted = [fit(f) for f in frames]
    while len(fitted) > 1:
        fitted = [fitted[i].union(fitted[i + 1]) if i + 1 < len(fitted) else fitted[i] for i in range(0, len(fitted), 2)]
    return fitted[0]
