"""Outbound events: the producer contract applied to a table or stream.

The upstream gateway validates and serialises one event at a time; here the
same contract runs as column expressions over a whole DataFrame, so it
partitions with the data and needs no Python per row.

C1 ``contract_violations``  strict v3 checks with a reason list
C2 ``normalize_contract``    defaults, upper-case currency, UTC times
C3 ``to_ndjson``             one compact JSON line per event
C4 ``oversize_events``       lines over the 1 MiB record limit
C5 ``route_by_merchant``     co-locate each merchant's events before landing

Events may carry fields of any name beside the contract's: as columns of the table
(every name but those of the contract is an extra, ``source_file`` too), or, where the
names are not known, as one ``extras`` column of ``read_open``. No column that these
functions work with can take the place of an extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyflow.functions import columns as C
from tallyflow.functions import domain
from tallyflow.session import scratch_path

# --- fixed values: producer field order of the serialised event; extras follow
CORE_FIELDS = (
    "event_id",
    "merchant_id",
    "user_id",
    "amount",
    "currency",
    "status",
    "event_timestamp",
    "schema_version",
    "ingest_source",
)


def _opt(df: DataFrame, name: str, dtype: str) -> Column:
    """An optional input column, typed null when the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def with_contract_columns(events: DataFrame) -> DataFrame:
    """Add the optional contract columns (``schema_version``, ``ingest_source``,
    ``amount_usd``) as nulls when absent, so every rule can reference them."""
    return events.select(
        *[F.col(c) for c in events.columns],
        *[
            _opt(events, c, t).alias(c)
            for c, t in (
                ("schema_version", "int"),
                ("ingest_source", "string"),
                ("amount_usd", "double"),
            )
            if c not in events.columns
        ],
    )


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def amount_digits(text: Column) -> dict[str, Column]:
    """What the digits of a number's text say, without ever rounding it:
    ``number`` (it is one), ``zero``, ``negative``, ``whole`` (digits before the
    point) and ``places`` (after it, trailing zeros not counted). An exponent
    moves the point; one beyond the integer range counts as its sign's extreme."""
    number = F.coalesce(text.rlike(NUMBER), F.lit(False))
    mantissa = F.regexp_extract(text, r"^[+-]?([0-9.]*)", 1)
    exponent_text = F.regexp_extract(text, r"[eE]([+-]?[0-9]+)$", 1)
    far = F.when(exponent_text.startswith("-"), F.lit(-1_000_000)).otherwise(F.lit(1_000_000))
    exponent = F.when(exponent_text == "", F.lit(0)).otherwise(F.coalesce(exponent_text.try_cast("int"), far))
    exponent = F.greatest(F.least(exponent, F.lit(1_000_000)), F.lit(-1_000_000))
    fraction = F.regexp_extract(mantissa, r"\.([0-9]*)$", 1)
    digits = F.regexp_replace(mantissa, r"\.", "")
    shown = F.regexp_replace(digits, "0+$", "")  # without trailing zeros
    scale = F.length(fraction) - exponent - (F.length(digits) - F.length(shown))
    significant = F.length(F.regexp_replace(shown, "^0+", ""))
    return {
        "number": number,
        "zero": shown == "",
        "negative": text.startswith("-"),
        "whole": F.greatest(significant - scale, F.lit(0)),
        "places": F.greatest(scale, F.lit(0)),
    }


def unused(name: str, taken: list[str]) -> str:
    """``name`` with as many underscores as make it a new one."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def contract_rules(digits: str) -> list[tuple[str, Column]]:
    """The contract's rules in reporting order, over the amount's digits in that column."""
    amount = F.col("amount").cast("string")
    d = {name: F.col(f"`{digits}`.{name}") for name in ("number", "zero", "negative", "whole", "places")}
    counted = d["number"] & ~d["zero"]
    return [
        ("missing_merchant_id", F.col("merchant_id").isNull()),
        ("missing_user_id", F.col("user_id").isNull()),
        ("missing_amount", amount.isNull()),
        ("invalid_amount", amount.isNotNull() & ~d["number"]),
        ("amount_not_positive", d["number"] & (d["zero"] | d["negative"])),
        ("amount_too_many_digits", counted & (d["whole"] > domain.CONTRACT_AMOUNT_WHOLE_DIGITS)),
        ("amount_too_many_decimals", counted & (d["places"] > domain.CONTRACT_AMOUNT_PLACES)),
        ("invalid_currency_length", F.col("currency").isNotNull() & (F.length("currency") != 3)),
        ("invalid_status", F.col("status").isNull() | ~F.col("status").isin(*domain.VALID_STATUSES)),
        ("invalid_event_timestamp", F.col("event_timestamp").isNotNull() & C.event_time_utc("event_timestamp").isNull()),
        ("unsupported_schema_version", F.col("schema_version") < domain.CONTRACT_SCHEMA_VERSION),
        ("legacy_amount_usd", F.col("amount_usd").isNotNull()),
    ]


def contract_violations(events: DataFrame, reasons: str = "contract_reasons") -> DataFrame:
    """Every input column plus ``reasons`` (empty when valid), a name that no input
    column may have. Empty ids are allowed here (unlike silver); amounts are rejected,
    never rounded, beyond 16 whole or 2 fractional digits; the status is exact-case;
    ``amount_usd`` is forbidden."""
    e = with_contract_columns(events)
    columns = e.columns
    if unused(reasons, columns) != reasons:
        raise ValueError(f"the events have a column {reasons!r}: choose another name for the reasons")
    digits = unused("digits", columns)
    e = e.withColumn(digits, F.struct(*(c.alias(n) for n, c in amount_digits(F.col("amount").cast("string")).items())))
    e = e.select(*_cols(columns), C.reasons(contract_rules(digits)).alias(reasons))
    # as in silver: the observation keeps later filters above the rules, which would
    # otherwise be worked out once for each reference to them
    return e.observe(Observation(), F.count(F.lit(1)).alias("rows"))


def _cols(names) -> list[Column]:
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


GENERATED = ("event_id_generated", "event_timestamp_generated")
EXTRAS = "extras"


def read_open(lines: DataFrame, line: str = "line") -> DataFrame:
    """Events from JSON lines with fields of any name: the contract's own fields as text
    (``schema_version`` as a number) and all others, whatever their types, in one
    ``extras`` column, a map of variants. A line that is no JSON object has only nulls."""
    kinds = {"schema_version": "int", "amount_usd": "double"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in (*CORE_FIELDS, "amount_usd"))
    whole = lines.select(F.from_json(line, schema).alias("core"), F.from_json(line, "map<string,variant>").alias("all"))
    own = F.map_filter("all", lambda name, _: ~name.isin(*CORE_FIELDS, "amount_usd"))
    return whole.select("core.*", own.alias(EXTRAS))


def normalize_contract(events: DataFrame, fill_defaults: bool = True) -> DataFrame:
    """The producer's defaults and normalisation on valid events.

    Deterministic part: currency null -> USD then upper-case, schema version
    3, ingest source ``payment_gateway``, event time parsed with offsets
    honoured and zone-less text read as UTC. With ``fill_defaults`` a missing
    ``event_id`` gets ``uuid()`` and a missing time gets the query's
    ``current_timestamp()``; both are non-deterministic across runs, so the
    flags ``event_id_generated``/``event_timestamp_generated`` mark them (an input column
    of such a name is an error, an entry of ``extras`` is not). All other columns stay.
    """
    if taken := set(GENERATED) & set(events.columns):
        raise ValueError(f"the events have columns {sorted(taken)}: pass them in {EXTRAS!r}")
    reasons = unused("contract_reasons", events.columns)
    e = contract_violations(events, reasons).where(F.size(reasons) == 0)
    extras = _cols(c for c in events.columns if c not in CORE_FIELDS and c != "amount_usd")
    ts = C.event_time_utc("event_timestamp")
    event_id, event_ts = F.col("event_id"), ts
    if fill_defaults:
        event_id = F.coalesce(event_id, F.expr("uuid()"))
        event_ts = F.coalesce(ts, F.current_timestamp())
    return e.select(
        event_id.alias("event_id"),
        "merchant_id",
        "user_id",
        F.col("amount").cast("string").alias("amount"),
        F.upper(F.coalesce(F.col("currency"), F.lit(domain.DEFAULT_CURRENCY))).alias(
            "currency"
        ),
        "status",
        event_ts.alias("event_timestamp"),
        F.coalesce(
            F.col("schema_version"), F.lit(domain.CONTRACT_SCHEMA_VERSION)
        ).alias("schema_version"),
        F.coalesce(
            F.col("ingest_source"), F.lit(domain.CONTRACT_INGEST_SOURCE)
        ).alias("ingest_source"),
        *extras,
        F.col("event_id").isNull().alias("event_id_generated"),
        F.col("event_timestamp").isNull().alias("event_timestamp_generated"),
    )


def iso_utc(ts: str | Column) -> Column:
    """``2026-09-19T04:10:49.856450Z``; the fraction is omitted when zero."""
    ts = C.col_(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(frac)


def to_ndjson(normalized: DataFrame) -> DataFrame:
    """One compact JSON object per event, producer field order, amount kept
    as text with its given scale, extras after the core fields, null fields
    omitted. The entries of an ``extras`` map come last, nulls included (the producer
    sent them); an entry named like a field that is there already is left out.
    Returns ``event_id``, ``merchant_id`` (routing key) and ``line``."""
    columns = [c for c in normalized.columns if c not in CORE_FIELDS and c not in GENERATED]
    is_map = EXTRAS in columns and normalized.schema[EXTRAS].dataType.typeName() == "map"
    if is_map:
        columns.remove(EXTRAS)
    fields = [iso_utc("event_timestamp").alias("event_timestamp") if c == "event_timestamp" else F.col(c) for c in CORE_FIELDS]
    line = F.to_json(F.struct(*fields, *_cols(columns)))
    if is_map:
        more = F.map_filter(EXTRAS, lambda name, _: ~name.isin(*CORE_FIELDS, *columns))
        joined = F.concat(F.substr(line, F.lit(1), F.length(line) - 1), F.lit(","), F.substr(F.to_json(more), F.lit(2)))
        line = F.when(F.coalesce(F.size(more), F.lit(0)) > 0, joined).otherwise(line)
    return normalized.select("event_id", "merchant_id", line.alias("line"))


def oversize_events(lines: DataFrame, limit: int = domain.MAX_RECORD_BYTES) -> DataFrame:
    """C4: record size in bytes with its newline, and whether it exceeds one record."""
    size = F.octet_length("line") + 1
    return lines.select(
        "event_id",
        "merchant_id",
        size.alias("line_bytes"),
        (size > limit).alias("is_oversize"),
    )


SAMPLE_PER_PARTITION = 100


def split_points(rows: DataFrame, key: str, partitions: int) -> list[str]:
    """At most ``partitions - 1`` keys that cut the rows into stretches of about equal
    length. Keys are sampled by a hash of their own, so the same rows give the same
    points, however they lie; the driver gets about ``SAMPLE_PER_PARTITION`` distinct
    keys, each with its count, for every partition."""
    every = max(1, rows.count() // (partitions * SAMPLE_PER_PARTITION))
    sampled = rows.where(F.pmod(F.xxhash64(key), F.lit(every)) == 0).groupBy(key).count().orderBy(key).collect()
    total, points, passed = sum(r["count"] for r in sampled), [], 0
    for r in sampled:
        passed += r["count"]
        if passed * partitions >= total * (len(points) + 1) and len(points) < partitions - 1:
            points += [r[key]] * (min(partitions - 1, passed * partitions // total) - len(points))
    return sorted(set(points))


def route_by_merchant(lines: DataFrame, partitions: int, order: str = "event_id") -> DataFrame:
    """Co-locate each merchant's events.

    Rows go to partitions by explicit boundaries on ``(merchant_id, order)``: a merchant's
    events lie in one contiguous run of partitions, in their order, and a merchant with a
    third of all rows is split across several instead of landing in one task (a plain
    hash on ``merchant_id`` would put it whole in one). The boundaries follow from the
    rows alone (``split_points``): a second run routes alike. What is upstream runs once;
    its rows are written to scratch, and the sample reads two of their columns."""
    spark = lines.sparkSession
    path = scratch_path(spark, "routed")
    lines.write.parquet(path)
    rows = spark.read.schema(lines.schema).parquet(path)
    merchant, place = F.coalesce("merchant_id", F.lit("")), F.coalesce(F.col(order).cast("string"), F.lit(""))
    key = unused("key", rows.columns)
    rows = rows.withColumn(key, F.concat(merchant, F.lit("\0"), place))
    points = split_points(rows.select(key), key, partitions)
    steps = F.lit([1 << b for b in reversed(range(len(points).bit_length()))] or [0])
    bounds = F.lit(points or [""])

    def below(at: Column, step: Column) -> Column:  # how many boundaries are smaller than the key
        return F.when((step > 0) & (F.get(bounds, at + step - 1) < F.col(key)), at + step).otherwise(at)

    rows = rows.withColumn(unused("part", rows.columns), F.aggregate(steps, F.lit(0), below))
    rows = rows.repartitionById(partitions, rows.columns[-1]).sortWithinPartitions("merchant_id", order)
    return rows.select(*_cols(lines.columns))
