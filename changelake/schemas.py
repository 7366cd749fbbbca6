"""Column names and fixed vocabularies of the change data model."""

from pyspark.sql import types as T

#: Operation codes of change events.
SNAPSHOT_READ, INSERT, UPDATE, DELETE, TRUNCATE, MESSAGE = "r", "c", "u", "d", "t", "m"

#: Fixed value: stands for a large column that an update did not send.
UNAVAILABLE = "__debezium_unavailable_value"

#: The columns that every destination table carries besides the row itself, and their types.
APPLIER_COLUMNS = {
    "cdcf_commit_id": T.LongType(),
    "cdcf_event_id": T.StringType(),
    "cdcf_total_order": T.LongType(),
    "dbz_op": T.StringType(),
    "dbz_lsn": T.LongType(),
    "dbz_tx_id": T.LongType(),
    "dbz_schema": T.StringType(),
    "dbz_table": T.StringType(),
    "dbz_source_ts_ms": T.LongType(),
}

SOURCE = T.StructType().add("schema", "string").add("table", "string").add("lsn", "long").add("txId", "long").add("ts_ms", "long").add("snapshot", "string")
TRANSACTION = T.StructType().add("id", "string").add("total_order", "long").add("data_collection_order", "long")
#: An envelope with its row images left as text, since their columns differ from table to table.
ENVELOPE = (
    T.StructType().add("op", "string").add("before", "string").add("after", "string").add("source", SOURCE).add("transaction", TRANSACTION)
    .add("ts_ms", "long").add("status", "string").add("id", "string").add("event_count", "long")
    .add("data_collections", T.ArrayType(T.StructType().add("data_collection", "string").add("event_count", "long")))
)
