"""In-memory bronze rows shaped like the stored bronze table."""

from pyspark.sql import types as T

BRONZE_STRING_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType(), True)
        for c in (
            "event_id",
            "merchant_id",
            "user_id",
            "amount",
            "amount_usd",
            "currency",
            "status",
            "event_timestamp",
            "source_file",
            "country",
        )
    ]
)

VALID = {
    "event_id": "evt-1",
    "merchant_id": "mrc_0001",
    "user_id": "usr_000001",
    "amount": "10.50",
    "amount_usd": None,
    "currency": "USD",
    "status": "captured",
    "event_timestamp": "2026-10-09T12:00:00Z",
    "source_file": "raw/part-0.json.gz",
    "country": "BR",
}


def row(**changes):
    r = dict(VALID)
    r.update(changes)
    return r


def bronze(spark, rows, schema=BRONZE_STRING_SCHEMA):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
