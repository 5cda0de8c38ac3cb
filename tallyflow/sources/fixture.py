"""Payments-shaped bronze rows derived from the supplied ``events`` table.

The test data has no payments, so every query derives a bronze table from
``events(event_id, ts, user_id, event_type, value, props)``. The derivation
steers dirty values and duplicates by ``event_id`` so that every rejection
reason, every normalisation and four kinds of duplicates occur at every scale.

Design: one scan of ``events`` and no shuffle. The four duplicate kinds are
produced by exploding a one- or two-element array per row (instead of a
union of five filtered re-reads of the source), so the fixture costs one
narrow pass however large ``events`` is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.sources.schema import BRONZE_COLUMNS

# --- fixed values: fixture mappings -------------------------------------------
CURRENCY_BY_MOD7 = ("USD", "EUR", "BRL", "GBP", "JPY", "CAD", "MXN")
STATUS_BY_EVENT_TYPE = (
    ("purchase", "captured"),
    ("view", "captured"),
    ("signup", "authorized"),
    ("error", "failed"),
)
STATUS_OTHER = "refunded"
TIES = {"currency": 60, "status": 80, "country": 100, "amount": 120, "time": 140, "currency_code": 160, "status_code": 180}
COUNTRY_BY_MOD7 = ("US", "BR", "GB", "DE", "JP", "MX", "CA")


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad with zeros to ``width``; never truncates longer text."""
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), "0")


def _case(key: Column, pairs, default=None) -> Column:
    expr = None
    for k, v in pairs:
        cond = key == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def payments_bronze(events: DataFrame, with_delivery: bool = False) -> DataFrame:
    """Bronze rows in stored column order (plus ``delivered_at`` when asked:
    the source event time, used as the landing hour)."""
    n = F.col("event_id")  # the source id; below, the steering column "n"
    base = events.select(
        n.alias("n"),
        F.concat(F.lit("evt_"), zero_pad(n.cast("string"), 8)).alias("event_id"),
        F.concat(
            F.lit("mrc_"),
            zero_pad(
                (F.regexp_extract("props", "([0-9]+)", 1).try_cast("int") % 5 + 1).cast(
                    "string"
                ),
                4,
            ),
        ).alias("merchant_id"),
        F.concat(F.lit("usr_"), zero_pad(F.col("user_id").cast("string"), 6)).alias(
            "user_id"
        ),
        F.col("value").cast("decimal(18,2)").cast("string").alias("amt"),
        "value",
        _case(n % 7, list(enumerate(CURRENCY_BY_MOD7))).alias("cur"),
        _case(F.col("event_type"), STATUS_BY_EVENT_TYPE, STATUS_OTHER).alias("st"),
        F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")).alias("t0"),
        F.when(n % 200 == 33, "")
        .when(n % 41 == 0, "FR")
        .when(n % 3 == 0, F.lit(None).cast("string"))
        .otherwise(_case(n % 7, list(enumerate(COUNTRY_BY_MOD7))))
        .alias("country"),
        F.col("ts").alias("delivered_at"),
    )
    n = F.col("n")
    m200 = n % 200
    clean = base.select(
        "n",
        "event_id",
        "merchant_id",
        "user_id",
        F.when((m200 == 4) | (n % 10 == 3), F.lit(None).cast("string"))
        .when(m200.isin(6, 26), "banana")
        .when(m200 == 7, "-1")
        .when(m200 == 8, "0.001")
        .otherwise(F.col("amt"))
        .alias("amount"),
        F.when((n % 10 == 3) | (m200 == 26), F.col("value"))
        .when(m200 == 27, F.lit(99.99).cast("double"))
        .alias("amount_usd"),
        F.when(n % 50 == 1, F.lit(None).cast("string"))
        .when(m200 == 11, "XYZ")
        .when(m200 == 31, "")
        .when(n % 5 == 2, F.concat(F.lit(" "), F.lower("cur"), F.lit(" ")))
        .otherwise(F.col("cur"))
        .alias("currency"),
        F.when(m200.isin(2, 9), " ")
        .when(m200 == 12, "banana")
        .when(n % 4 == 1, F.concat(F.lit(" "), F.upper("st"), F.lit(" ")))
        .otherwise(F.col("st"))
        .alias("status"),
        F.when(m200 == 14, F.lit(None).cast("string"))
        .when(m200 == 22, " ")
        .when(m200 == 16, "banana")
        .when(m200 == 28, F.concat("t0", F.lit("-03:00")))
        .otherwise(F.concat("t0", F.lit("Z")))
        .alias("event_timestamp"),
        F.concat(F.lit("raw/part-"), (n % 4).cast("string"), F.lit(".json.gz")).alias(
            "source_file"
        ),
        "country",
        "delivered_at",
    )

    # copy 0 is the row itself; every fifth row also gets one duplicate whose
    # kind depends on n % 20 (0: other user, 5: newer but invalid status,
    # 10: newer with another amount, 15: exact copy from a greater path).
    # Of the first kind, seven n % 200 instead tie on time and user and differ in
    # one later field of the tie-break payload each.
    m20 = n % 20
    dup = F.col("copy") == 1
    tie = {k: dup & (m200 == v) for k, v in TIES.items()}
    later = F.replace(F.col("event_timestamp"), F.lit("Z"), F.lit("-01:00"))
    rows = clean.withColumn(
        "copy",
        F.explode(
            F.when(n % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ),
    )
    out = rows.select(
        F.when(~dup & (m200 == 17), "").otherwise(F.col("event_id")).alias("event_id"),
        F.when(~dup & (m200 == 18), F.lit(None).cast("string"))
        .otherwise(F.col("merchant_id"))
        .alias("merchant_id"),
        F.when(~dup & m200.isin(19, 9), " ")
        .when(dup & (m20 == 0) & ~m200.isin(*TIES.values()), "usr_999999")
        .otherwise(F.col("user_id"))
        .alias("user_id"),
        "amount_usd",
        F.when(tie["currency"], F.concat("currency", F.lit(" ")))
        .when(tie["currency_code"], "MXN")
        .otherwise(F.col("currency"))
        .alias("currency"),
        F.when(dup & (m20 == 5), "banana")
        .when(tie["status"], F.concat("status", F.lit(" ")))
        .when(tie["status_code"], "refunded")
        .otherwise(F.col("status"))
        .alias("status"),
        F.when(dup & m20.isin(5, 10), later)
        .when(tie["time"], F.replace(F.col("event_timestamp"), F.lit("Z"), F.lit("+00:00")))
        .otherwise(F.col("event_timestamp"))
        .alias("event_timestamp"),
        F.when(dup & (m20 == 15), "raw/part-9.json.gz")
        .otherwise(F.col("source_file"))
        .alias("source_file"),
        F.when(tie["country"], "ZZ").otherwise(F.col("country")).alias("country"),
        F.when(dup & (m20 == 10), "77.77").when(tie["amount"], "55.55").otherwise(F.col("amount")).alias("amount"),
        "delivered_at",
    )
    cols = list(BRONZE_COLUMNS) + (["delivered_at"] if with_delivery else [])
    return out.select(*cols)


def bronze_from_dir(spark: SparkSession, sf_dir: str, with_delivery: bool = False):
    return payments_bronze(load_events(spark, sf_dir), with_delivery=with_delivery)


def outbound_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbound candidates: the bronze rows as a producer would receive them, with
    some amounts, users and versions that only the producer contract tells apart."""
    m200 = F.regexp_extract("event_id", "([0-9]+)$", 1).try_cast("int") % 200
    amount = F.when(m200 == 35, "1.0000000000000000001").when(m200 == 36, "12345678901234567").when(m200 == 39, "1e-3")
    amount = amount.when(m200 == 40, "0.0000000000000000000001").when(m200 == 41, "1.10e1").when(m200 == 42, "0.00e5")
    bronze = bronze_from_dir(spark, sf_dir).drop("source_file")
    return bronze.withColumns(
        {
            "amount": amount.otherwise(F.col("amount")),
            "user_id": F.when(m200 == 38, F.lit(None)).otherwise(F.col("user_id")),
            "schema_version": F.when(m200 == 37, 2).when(m200 == 43, 3),
        }
    )


def open_lines(outbound: DataFrame) -> DataFrame:
    """The outbound events as JSON lines (``line``) with fields that no schema names:
    nested objects and lists, and names that the library uses for columns of its own."""
    n = F.length("event_id") + F.coalesce(F.length("country"), F.lit(0))
    core = F.to_json(F.struct(*(c for c in outbound.columns if c != "country")))
    note = F.concat(
        F.lit(',"digits":{"number":true,"of":['), n, F.lit("," + "2.5,null]},"), F.lit('"contract_reasons":["none"],"event_id_generated":"no",'),
        F.lit('"source_file":"gateway-'), n, F.lit('","extras":{"a":'), n, F.lit(',"b":"x"},"line":null}'),
    )
    return outbound.select(F.concat(F.substr(core, F.lit(1), F.length(core) - 1), note).alias("line"))
