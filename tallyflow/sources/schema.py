"""The bronze read contract, JSON Schema ``properties`` -> ``StructType``.

The registry document is read once per run on the driver; only the resulting
schema travels to the executors with the read plan.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import types as T

# --- fixed values: stored bronze column order (amount was appended last) -------
BRONZE_COLUMNS = (
    "event_id",
    "merchant_id",
    "user_id",
    "amount_usd",
    "currency",
    "status",
    "event_timestamp",
    "source_file",
    "country",
    "amount",
)

# --- fixed values: JSON Schema type name -> Spark type -----------------------
JSON_TYPE_TO_SPARK = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "double": T.DoubleType(),
    "integer": T.LongType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
}

# The read contract we ship. ``amount`` carries no ``type``: it is a decimal
# string in v3 and must not be read as a double (a double read turns every v3
# string amount into null).
PAYMENT_EVENT_CONTRACT: dict[str, Any] = {
    "$schema": "http://json-schema.org/draft-07/schema#",
    "title": "PaymentEvent",
    "type": "object",
    "properties": {
        "event_id": {"type": "string"},
        "merchant_id": {"type": "string"},
        "user_id": {"type": "string"},
        "amount_usd": {"type": "number"},
        "amount": {"description": "decimal string in the transaction currency"},
        "currency": {"type": "string"},
        "status": {"type": "string"},
        "event_timestamp": {"type": "string"},
        "source_file": {"type": "string"},
        "country": {"type": "string"},
    },
}


def _spark_type(spec: Any) -> T.DataType:
    """Map one property spec. Untyped or unknown types become strings; a union
    type list uses its first non-null member."""
    kind = spec.get("type") if isinstance(spec, dict) else spec
    if isinstance(kind, list):
        kind = next((k for k in kind if k != "null"), None)
    return JSON_TYPE_TO_SPARK.get(kind, T.StringType()) if kind else T.StringType()


def schema_from_registry(definition: dict[str, Any] | str) -> T.StructType:
    """All properties, in document order, all nullable."""
    if isinstance(definition, str):
        definition = json.loads(definition)
    props = definition.get("properties", {})
    return T.StructType(
        [T.StructField(name, _spark_type(spec), True) for name, spec in props.items()]
    )


def bronze_read_schema(definition: dict[str, Any] | str | None = None) -> T.StructType:
    """Read schema for raw payment JSON; both monetary fields must be present."""
    schema = schema_from_registry(definition or PAYMENT_EVENT_CONTRACT)
    missing = {"amount", "amount_usd"} - set(schema.fieldNames())
    if missing:
        raise ValueError(f"read contract lacks monetary fields: {sorted(missing)}")
    return schema
