"""The five destination types: inference from JSON, widening, and binding of values.

BOOLEAN, BIGINT, DOUBLE, JSON and VARCHAR; an unknown type (only nulls seen) widens to any other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPES = ("BOOLEAN", "BIGINT", "DOUBLE", "JSON", "VARCHAR")
SPARK_TYPES = {"BOOLEAN": "boolean", "BIGINT": "bigint", "DOUBLE": "double", "JSON": "string", "VARCHAR": "string"}


def inferred(json: Column, path: str) -> Column:
    """The type of a value inside a JSON text; null if the value is null or absent."""
    kind = F.schema_of_variant(F.variant_get(F.try_parse_json(json), path, "variant"))
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
        .when(kind == "BOOLEAN", "BOOLEAN").when(kind == "BIGINT", "BIGINT")
        .when(kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), "DOUBLE")
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), "JSON").otherwise("VARCHAR")
    )


def widened(kinds: Column) -> Column:
    """The least type that holds all of an array of types."""
    kinds = F.array_distinct(F.filter(kinds, lambda k: k.isNotNull()))
    numbers = F.size(F.array_except(kinds, F.array(F.lit("BIGINT"), F.lit("DOUBLE")))) == 0
    return F.when(F.size(kinds) == 0, F.lit(None).cast("string")).when(F.size(kinds) == 1, kinds[0]).when(numbers, "DOUBLE").otherwise("VARCHAR")


def normalized(type_name: Column) -> Column:
    """An existing destination type as one of the five."""
    t = F.upper(type_name)
    return (
        F.when(t.isin("TINYINT", "SMALLINT", "INTEGER", "INT", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"), "BIGINT")
        .when(t.isin("DOUBLE", "FLOAT", "REAL"), "DOUBLE").when(t == "BOOLEAN", "BOOLEAN").when(t == "JSON", "JSON").otherwise("VARCHAR")
    )


def source_type(formatted: Column) -> Column:
    """A source column's type, by its formatted name, as a destination type."""
    t = F.regexp_replace(F.lower(formatted), r"\(.*", "")
    return (
        F.when(t.isin("boolean", "bool"), "BOOLEAN").when(t.isin("smallint", "integer", "bigint", "int2", "int4", "int8", "serial", "bigserial", "smallserial"), "BIGINT")
        .when(t.isin("real", "double precision", "numeric", "decimal", "float4", "float8"), "DOUBLE").when(t.isin("json", "jsonb"), "JSON").otherwise("VARCHAR")
    )


def bound(value: Column, kind: str) -> Column:
    """A value given as text, as the destination type; text that the number types can't hold becomes null, and any text
    but true, t and 1 is false."""
    if kind == "BOOLEAN":
        return F.when(value.isNotNull(), F.lower(F.trim(value)).isin("true", "t", "1"))
    if kind == "BIGINT":
        return F.when(F.lower(value) == "true", F.lit(1)).when(F.lower(value) == "false", F.lit(0)).otherwise(value.try_cast("bigint"))
    return value.try_cast("double") if kind == "DOUBLE" else value
