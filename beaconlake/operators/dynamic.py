"""JSON feeds without a declared schema.

Two forms: `records` keeps each record as VARIANT (schema on read), `extract` infers one
schema over all records with an aggregate and casts to it. Streams keep records, and a
schema that `widened` lets each batch widen (`streaming.ingest.start_dynamic`).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.functions import strict
from beaconlake.operators import feeds

# Keys that may hold the record array, in order of preference.
RECORD_KEYS = ("data", "features", "items", "result", "results", "observations")

# A nested object with more keys than this has ids for keys: it stays VARIANT.
MOST_NESTED_KEYS = 200

# In a schema text, names are quoted or stand before a colon; what is left of these are types.
_NAME_OR_OBJECT = r"`(?:[^`]|``)*`|[A-Za-z0-9_]+(?=:)|OBJECT(?=<)"


RECORDS = "source string, seq bigint, fetched_at timestamp, pos int, record variant"


def record_array(doc: Column) -> Column:
    """The root array, else the first of the known keys that holds an array."""
    return F.coalesce(strict.elements(doc, "$"), *[strict.elements(doc, f"$.{key}") for key in RECORD_KEYS])


def records(payloads: DataFrame) -> DataFrame:
    """One row per record that is a JSON object; `record` is VARIANT."""
    parsed = payloads.select("source", "seq", "fetched_at", F.explode(feeds.payload_itself(strict.parse("payload"))).alias("doc"))
    found = parsed.select("source", "seq", "fetched_at", F.posexplode(record_array(F.col("doc"))).alias("pos", "record"))
    return found.where(strict.json_type(F.col("record"), "$").startswith("OBJECT"))


def record_type(merged: str | None) -> T.StructType | None:
    """The type of records from what `schema_of_variant_agg` says of them; None if they are no objects."""
    if merged is None or not merged.startswith("OBJECT<"):
        return None
    return T.DataType.fromDDL(re.sub(_NAME_OR_OBJECT, lambda m: "STRUCT" if m[0] == "OBJECT" else m[0], merged))


def infer_schema(found: DataFrame) -> str:
    """One struct type for all records; any mix of numbers becomes double, a value that is always null a string.

    The aggregate merges schemas per task first; only the merged text reaches the driver.
    """
    kind = record_type(found.agg(F.schema_of_variant_agg("record")).first()[0])
    if kind is None:
        raise ValueError("no record array with objects in the payloads")
    return _ddl(kind)


_NUMBERS = (T.LongType, T.DoubleType, T.DecimalType)


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type for the values of both: members of either object, any mix of numbers as double, else VARIANT."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        members = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            members[f.name] = widened(members[f.name], f.dataType) if f.name in members else f.dataType
        return T.StructType([T.StructField(name, members[name]) for name in sorted(members)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        return T.DoubleType()
    return T.VariantType()


def typed(found: DataFrame, kind: T.StructType | str) -> DataFrame:
    """Records as columns of a type, in its order."""
    schema = kind if isinstance(kind, str) else _ddl(kind)
    return found.select(*feeds.LINEAGE, F.try_variant_get("record", "$", schema).alias("r")).select(*feeds.LINEAGE, "r.*")


def _ddl(kind: T.DataType, nested: bool = False) -> str:
    if isinstance(kind, T.StructType):
        if nested and len(kind.fields) > MOST_NESTED_KEYS:
            return "VARIANT"
        members = (f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType, True)}" for f in kind.fields)
        return f"STRUCT<{', '.join(members)}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_ddl(kind.elementType, True)}>"
    if isinstance(kind, T.DecimalType):
        return "DOUBLE"
    return "STRING" if isinstance(kind, T.NullType) else kind.simpleString()


def extract(payloads: DataFrame, schema: str | None = None) -> DataFrame:
    """Records as typed columns in name order. Without `schema` it is inferred first."""
    found = records(payloads)
    return typed(found, schema or infer_schema(found))
