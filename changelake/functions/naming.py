"""Identifiers of destination tables and columns in snake case."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake_case(name: str) -> str:
    """Camel humps become underscores, everything else that isn't a letter, digit or underscore too; runs collapse."""
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    name = re.sub(r"[^A-Za-z0-9_]+", "_", name).lower()
    name = re.sub(r"__+", "_", name).rstrip("_") or "_"
    return f"_{name}" if name[0].isdigit() else name


def snake_case_column(name: Column) -> Column:
    """snake_case() as an expression."""
    out = F.regexp_replace(F.trim(name), "([a-z0-9])([A-Z])", "$1_$2")
    out = F.lower(F.regexp_replace(out, "[^A-Za-z0-9_]+", "_"))
    out = F.regexp_replace(F.regexp_replace(out, "__+", "_"), "_+$", "")
    out = F.when(out == "", "_").otherwise(out)
    return F.when(out.rlike("^[0-9]"), F.concat(F.lit("_"), out)).otherwise(out)


def destination_table(prefix: str, schema: str, table: str) -> str:
    return snake_case(f"{prefix}_{schema}_{table}")


def stream_event_id(lsn: Column, tx: Column, order: Column) -> Column:
    return F.concat_ws(":", lsn.cast("string"), tx.cast("string"), order.cast("string"))


def snapshot_event_id(epoch: Column, schema: Column, table: Column, ordinal: Column) -> Column:
    return F.concat(F.lit("snap:"), epoch.cast("string"), F.lit(":"), schema, F.lit("."), table, F.lit(":"), ordinal.cast("string"))
