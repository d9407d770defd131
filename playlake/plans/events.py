"""J1 stg_events: clean and de-duplicate the raw JSON event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.config import RunWindow
from playlake.functions import parse, scrub_ad_id, start_of_day
from playlake.functions.json import any_suspicious, json_fields, looks_nested, resolve_scalar, suspicious_node
from playlake.functions.time import timestamp_from_millis
from playlake.operators.topk import top1_per_key

TOP_FIELDS = ["event_id", "event_name", "properties", "timestamp"]
PROPERTY_FIELDS = ["user_id", "device_id", "platform", "app_version", "os_version", "country", "city", "language",
                   "device_manufacturer", "device_brand", "device_model", "adid", "idfa", "idfv", "af_id",
                   "ftue_step", "ftue_value", "territory"]

PAYLOAD_MD5 = "payload_md5"
STG_EVENTS_COLUMNS = [
    "event_timestamp", "event_name", "event_id", "user_id", "device_id", "platform", "app_version",
    "os_version", "country", "city", "language", "device_manufacturer", "device_brand", "device_model",
    "adid", "idfa", "idfv", "af_id", "territory", "event_properties", "event_source",
]


def scan_event_log(raw: DataFrame, window: RunWindow) -> DataFrame:
    """Rows with ``date(publish_time)`` in [start, end): a plain range on the
    column itself, so it reaches the Parquet scan as a pushed filter."""
    pt = F.col("publish_time")
    return raw.filter((pt >= start_of_day(window.start)) & (pt < start_of_day(window.end)))


def extract_ids(raw: DataFrame) -> DataFrame:
    """event_id, event_name, event_timestamp, event_properties (JSON text) and the payload's hash of each log row.

    One ``from_json`` pass; the exact VARIANT path runs only for an id or name that looks
    like an object or array, and the hash fallback for ``event_id`` parses only rows
    without an id.
    """
    t = raw.select(json_fields(F.col("data"), TOP_FIELDS).alias("_t"), F.col("data").alias("_payload"))
    ids = [F.col("_t.event_id"), F.col("_t.event_name")]
    t = t.withColumn("_dv", F.when(F.col("_t.event_id").isNull() | any_suspicious(ids), parse(F.col("_payload"))))
    t = t.select("*", *[suspicious_node(F.col(f"_t.{n}"), F.col("_dv"), n).alias(f"_n_{n}")
                        for n in ("event_id", "event_name")])
    event_id = F.coalesce(resolve_scalar(F.col("_t.event_id"), F.col("_n_event_id")), F.sha1(F.to_json(F.col("_dv"))))
    return t.select(
        timestamp_from_millis(F.col("_t.timestamp").cast("bigint")).alias("event_timestamp"),
        resolve_scalar(F.col("_t.event_name"), F.col("_n_event_name")).alias("event_name"),
        event_id.alias("event_id"),
        F.col("_t.properties").alias("event_properties"),
        F.md5(F.col("_payload")).alias("_tie"))


def extract_properties(ids: DataFrame) -> DataFrame:
    """The typed property columns of ``ids`` (rows of ``extract_ids``): one ``from_json`` pass over the
    properties, and the VARIANT path only for values that look like objects or arrays.

    The values are resolved and cleaned as one array: an expression for each of the columns would make
    a generated method too long for the JVM to compile, and every row would be interpreted."""
    rest = ["event_timestamp", "event_name", "event_id", "event_properties", "_tie"]
    t = ids.select(*rest, json_fields(F.col("event_properties"), PROPERTY_FIELDS).alias("_p"))
    raw = [F.col(f"_p.{n}") for n in PROPERTY_FIELDS]
    t = t.withColumn("_pv", F.when(F.exists(F.array(*raw), looks_nested), parse(F.col("event_properties"))))
    resolved = [F.when(looks_nested(v), resolve_scalar(v, F.variant_get(F.col("_pv"), f"$.{n}", "variant"))).otherwise(v)
                for n, v in zip(PROPERTY_FIELDS, raw)]
    top = t.select(*rest, F.transform(F.array(*resolved), lambda v: F.struct(
        v.alias("raw"), F.when(F.trim(v) != F.lit(""), F.trim(v)).alias("clean"))).alias("_r"))

    def prop(name: str, form: str = "clean"):
        return F.get("_r", F.lit(PROPERTY_FIELDS.index(name)))[form]

    raw_platform = prop("platform", "raw")
    ftue_territory = F.when(prop("ftue_step", "raw") == "territory", prop("ftue_value")).otherwise(prop("territory"))
    return top.select(
        "event_timestamp", "event_name", "event_id", prop("user_id").alias("user_id"), prop("device_id").alias("device_id"),
        F.lower(prop("platform")).alias("platform"),
        *[prop(c).alias(c) for c in (
            "app_version", "os_version", "country", "city", "language",
            "device_manufacturer", "device_brand", "device_model")],
        scrub_ad_id(prop("adid", "raw"), raw_platform, "android").alias("adid"),
        scrub_ad_id(prop("idfa", "raw"), raw_platform, "ios").alias("idfa"),
        prop("idfv").alias("idfv"),
        prop("af_id").alias("af_id"),
        ftue_territory.alias("territory"),
        "event_properties",
        "_tie",
    )


def extract_events(raw: DataFrame) -> DataFrame:
    """JSON payload -> typed event columns, a row for each log row."""
    return extract_properties(extract_ids(raw))


def stg_events(raw: DataFrame, seed: DataFrame, window: RunWindow, keep_tie: bool = False) -> DataFrame:
    """Latest copy of each event in the window, with its event source.

    De-duplication keeps the newest ``event_timestamp`` per ``event_id`` (ties:
    the larger MD5 of the payload, so the payload itself never enters the
    exchange) as a partial aggregation.  It comes before the properties are extracted, so the
    exchange carries their JSON text only, and copies are not parsed.  An
    unknown event name gets a NULL source.
    """
    ids = extract_ids(scan_event_log(raw, window))
    latest = extract_properties(top1_per_key(ids, ["event_id"], ["event_timestamp", "_tie"], descending=True))
    out = latest.join(seed.select("event_name", "event_source"), on="event_name", how="left")
    if keep_tie:  # incremental consumers re-apply the same tie-break later
        return out.select(*STG_EVENTS_COLUMNS, F.col("_tie").alias(PAYLOAD_MD5))
    return out.select(*STG_EVENTS_COLUMNS)
