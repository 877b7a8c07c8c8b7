"""Messages: flat row -> JSON envelope, and envelope -> flat typed row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.columns import finite, iso_time_utc, known_text, strict_time
from txnrisk.schema import CORRUPT, METADATA_FIELDS, PAYLOAD_FIELDS, SILVER_FIELDS, envelope_schema

# Message source name and transport size limits in bytes.
SOURCE = "paysim-enhanced-v1"
STREAM_LIMIT = 1024 * 1024
QUEUE_LIMIT = 256 * 1024
V2_ONLY = "ip_risk_score"


def build_envelope(
    df: DataFrame, producer_id: str, produced_at: Column | str, body: str = "body"
) -> DataFrame:
    """Add the JSON message of each flat transaction row.

    ``event_time`` and ``arrival_time`` are ISO texts. NaN and infinities are
    written as null; a v1 message has no field that only v2 defines.
    """
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    stamp = F.lit(produced_at) if isinstance(produced_at, str) else produced_at
    meta = {
        name: F.col(name)
        for name in METADATA_FIELDS
        if name not in ("producer_id", "produced_at", "source")
    } | {"producer_id": F.lit(producer_id), "produced_at": stamp, "source": F.lit(SOURCE)}

    def value(column: str) -> Column:
        if column not in df.columns:
            return F.lit(None).cast("string")
        return finite(F.col(column)) if column in numeric else F.col(column)

    v1 = [value(col).alias(name) for name, (col, _) in PAYLOAD_FIELDS.items() if name != V2_ONLY]
    v2 = [*v1, value(V2_ONLY).alias(V2_ONLY)]
    metadata = F.struct(*[meta[name].alias(name) for name in METADATA_FIELDS])

    def text(payload: list[Column]) -> Column:
        whole = F.struct(metadata.alias("metadata"), F.struct(*payload).alias("payload"))
        return F.to_json(whole, {"ignoreNullFields": "false"})

    message = F.when(F.col("schema_version") == "v2", text(v2)).otherwise(text(v1))
    return df.withColumn(body, message)


def split_oversize(
    df: DataFrame, max_bytes: int = STREAM_LIMIT, body: str = "body"
) -> tuple[DataFrame, DataFrame]:
    """(messages that fit, rejected messages with their size and a reason)."""
    size = F.octet_length(body)
    fits = df.where(F.coalesce(size <= max_bytes, F.lit(True)))
    rejects = df.where(size > max_bytes).select(
        "*", size.alias("body_bytes"), F.lit(f"larger than {max_bytes} bytes").alias("reason")
    )
    return fits, rejects


def routing_attributes(df: DataFrame, body: str = "body") -> DataFrame:
    """What a consumer may filter on without reading the whole body."""
    # Attribute name and where it is in the message.
    paths = {
        "event_id": "metadata.event_id",
        "schema_version": "metadata.schema_version",
        "is_fraud": "payload.isFraud",
        "customer_id": "payload.nameOrig",
    }
    parsed = df if "envelope" in df.columns else parse_messages(df, body)
    kept = [c for c in df.columns if c != "envelope"]
    return parsed.select(*kept, *[F.col(f"envelope.{p}").alias(f"attr_{n}") for n, p in paths.items()])


def parse_messages(df: DataFrame, body: str = "body") -> DataFrame:
    """Parse the body once. Adds ``envelope``; NULL parts mean an unusable message.

    The parsed value comes out of a one-element array: later filters are not
    pushed below that, where each condition would parse the body again.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(body, envelope_schema(), options)
    return df.select("*", F.explode(F.array(parsed)).alias("envelope"))


def is_dead_letter() -> Column:
    """A message no retry can read: bad JSON, or one of the two blocks is missing."""
    e = F.col("envelope")
    broken = e[CORRUPT].isNotNull() | e["metadata"].isNull() | e["payload"].isNull()
    return F.coalesce(broken, F.lit(True))


def is_skipped() -> Column:
    """A readable message without an event id is skipped, not retried."""
    return F.coalesce(F.col("envelope.metadata.event_id"), F.lit("")) == ""


def split_dead_letter(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(parsed messages, dead letters with the original body)."""
    parsed = df if "envelope" in df.columns else parse_messages(df, body)
    dead = parsed.where(is_dead_letter()).drop("envelope")
    return parsed.where(~is_dead_letter()), dead.withColumn("reason", F.lit("unreadable message"))


def message_status(df: DataFrame, body: str = "body", missing_id: str = "skipped") -> DataFrame:
    """Add ``status``: ``dead_letter``, ``parsed``, or ``missing_id`` for a
    message without an event id (the batch consumer calls that a dead letter)."""
    parsed = df if "envelope" in df.columns else parse_messages(df, body)
    status = F.when(is_dead_letter(), "dead_letter").when(is_skipped(), missing_id).otherwise("parsed")
    return parsed.withColumn("status", status)


def _typed(path: str, kind: str) -> Column:
    text = known_text(F.col(f"envelope.{path}"))
    if kind == "string":
        return text
    # a whole number may arrive as 365, 365.0 or "365"
    number = finite(text.try_cast("double"))
    return number if kind == "double" else number.try_cast(kind)


def flatten(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 39 typed columns of a parsed message; times are still text."""
    columns = [_typed(path, kind).alias(name) for name, path, kind in SILVER_FIELDS]
    return parsed.select(*(keep or []), *columns)


def parse_times(df: DataFrame, fallback: Column | None = None) -> DataFrame:
    """Replace the time texts by zone-less UTC timestamps.

    Without ``fallback`` only the strict pattern counts and anything else is
    NULL (batch path). With it, any ISO time counts, and a bad event time
    becomes the arrival time, then ``fallback`` (online path).
    """
    read = strict_time if fallback is None else iso_time_utc
    event, arrival = read(F.col("event_time_text")), read(F.col("arrival_time_text"))
    if fallback is not None:
        event = F.coalesce(event, arrival, fallback)
    others = [c for c in df.columns if c not in ("event_time_text", "arrival_time_text")]
    return df.select(*others, event.alias("event_time"), arrival.alias("arrival_time"))


def parse_envelope(
    df: DataFrame, body: str = "body", fallback: Column | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Messages -> typed rows. Dead letters and messages without an id are left
    out here; :func:`message_status` and :func:`split_dead_letter` account for them."""
    usable = message_status(df, body).where("status = 'parsed'")
    return parse_times(flatten(usable, keep), fallback)


def assert_envelope(df: DataFrame, body: str = "body", max_null_share: float = 0.5) -> None:
    """Stop the run when the input does not look like envelopes at all."""
    parsed = parse_messages(df, body)
    broken = F.col("envelope.metadata").isNull() | F.col("envelope.payload").isNull()
    row = parsed.agg(F.count("*").alias("n"), F.count_if(broken).alias("broken")).first()
    if row.n and row.broken > max_null_share * row.n:
        raise ValueError(f"{row.broken} of {row.n} messages lack metadata or payload")
