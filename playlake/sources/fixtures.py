"""Adapters: the driver's ``events`` table -> the reference's raw source tables.

The reference reads an event log with a JSON payload, two install reports from a
mobile measurement partner and three ad-platform tables.  The test data has one
``events`` table (event_id, ts, user_id, event_type, value, props {"k": n});
these functions derive every raw source from it with row-wise expressions only
(no shuffles), so each source grows with the events table.  ``dn`` (= user_id
div 3) is the device number: three users share a device.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "events"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{EVENTS}.parquet")


def _k() -> Column:
    return F.from_json("props", "k int")["k"]


def _dn() -> Column:
    return F.expr("user_id div 3")


def _s(c: Column) -> Column:
    return c.cast("string")


def _jstr(c: Column) -> Column:
    """A JSON string literal (test values hold no quotes or backslashes)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _base(ev: DataFrame) -> DataFrame:
    return ev.select("event_id", "ts", "user_id", "event_type", "value", _k().alias("k"), _dn().alias("dn"))


def raw_event_log(events: DataFrame) -> DataFrame:
    """The stream-delivery envelope: publish_time, subscription_name, message_id,
    attributes, data (JSON text, keys sorted, no spaces).  Rows with
    ``event_id % 50 = 0`` are delivered twice, the copy one second older."""
    b = _base(events)
    dup = b.filter(F.col("event_id") % 50 == 0).withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 SECOND"))
    rows = b.unionByName(dup)
    k, dn, ts = F.col("k"), F.col("dn"), F.col("ts")
    day = F.dayofmonth(ts)
    name = (F.when(F.col("event_type") == "click", "Screen View")
            .when(F.col("event_type") == "view", "App Opened")
            .when(F.col("event_type") == "signup", "Registration Completed")
            .when(F.col("event_type") == "purchase", "Prize Won")
            .otherwise("Unmapped Event"))
    platform = F.when(dn % 2 == 0, F.lit("Android")).otherwise(F.lit("iOS"))
    platform = F.when(k % 10 == 0, F.concat(F.lit(" "), platform, F.lit(" "))).otherwise(platform)
    user = F.when((F.col("event_type") == "view") | (dn % 10 == 3), F.lit("")).otherwise(
        F.concat(F.lit("u"), _s(F.col("user_id"))))
    dob = F.when(F.col("event_type") == "signup", F.concat(
        F.lit('"date_of_birth":"1990-01-'), F.lpad(_s(k % 28 + 1), 2, "0"), F.lit('",'))).otherwise(F.lit(""))
    props = F.concat(
        F.lit('{"adid":'), _jstr(F.when(dn % 6 == 4, F.concat(F.lit("g"), _s(dn)))
                                 .otherwise(F.lit("00000000-0000-0000-0000-000000000000"))),
        F.lit(',"af_id":'), _jstr(F.when(dn % 3 == 0, F.concat(F.lit("af"), _s(dn))).otherwise(F.lit(""))),
        F.lit(',"app_version":'), _jstr(F.concat(F.lit("1."), _s(F.floor(day / 10)))),
        F.lit(',"city":'), _jstr(F.concat(F.lit("city"), _s(k % 7))),
        F.lit(',"country":'), _jstr(F.when(k % 5 == 0, F.lit(" ")).otherwise(F.concat(F.lit("C"), _s(k % 4)))),
        F.lit(","), dob,
        F.lit('"device_brand":'), _jstr(F.concat(F.lit("b"), _s(dn % 4))),
        F.lit(',"device_id":'), _jstr(F.concat(F.lit(" d"), _s(dn), F.lit(" "))),
        F.lit(',"device_model":{"nested":'), _s(dn), F.lit("}"),
        F.lit(',"ftue_step":'), _jstr(F.when(k % 20 == 1, F.lit("territory")).otherwise(F.lit("none"))),
        F.lit(',"ftue_value":'), _jstr(F.concat(F.lit("T"), _s(k % 3))),
        F.lit(',"idfa":"0000-0000"'),
        F.lit(',"idfv":'), _jstr(F.when(dn % 6 == 1, F.concat(F.lit("v"), _s(dn))).otherwise(F.lit(""))),
        F.lit(',"language":null'),
        F.lit(',"os_version":'), F.when(day >= 15, F.lit("15")).otherwise(F.lit("14")),
        F.lit(',"platform":'), _jstr(platform),
        F.lit(',"territory":'), _jstr(F.concat(F.lit("R"), _s(k % 3))),
        F.lit(',"user_id":'), _jstr(user),
        F.lit("}"),
    )
    omit_id = (F.col("event_id") % 97 == 0) & (F.col("event_id") % 50 != 0)
    id_part = F.when(omit_id, F.lit("")).otherwise(
        F.concat(F.lit('"event_id":'), _jstr(F.concat(F.lit("e"), _s(F.col("event_id")))), F.lit(",")))
    millis = F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts) / 1000)
    data = F.concat(F.lit("{"), id_part, F.lit('"event_name":'), _jstr(name), F.lit(',"properties":'), props,
                    F.lit(',"timestamp":'), _s(millis), F.lit("}"))
    return rows.select(
        ts.alias("publish_time"),
        F.lit("analytics-events").alias("subscription_name"),
        F.col("event_id").cast("decimal(38,9)").alias("message_id"),
        F.lit("{}").alias("attributes"),
        data.alias("data"),
    )


def _mmp(events: DataFrame) -> DataFrame:
    b = _base(events).filter(F.col("event_type") == "signup")
    k, dn, ts = F.col("k"), F.col("dn"), F.col("ts")
    media = (F.when(k % 4 == 0, F.lit("Facebook Ads")).when(k % 4 == 1, F.lit("googleadwords_int"))
             .when(k % 4 == 2, F.lit("unityads_int")).otherwise(F.lit("")))
    nul = F.lit(None).cast("string")
    return b.select(
        (k % 4 == 3).alias("_organic"),
        _s(ts - F.make_dt_interval(F.lit(0), k, F.lit(0), F.lit(0))).alias("installtime"),
        _s(ts).alias("eventtime"),
        media.alias("mediasource"),
        F.when(k % 7 == 0, nul).otherwise(F.concat(F.lit("ch"), _s(k % 2))).alias("channel"),
        F.when(k % 11 == 0, nul).otherwise(F.concat(F.lit("c"), _s(k % 5))).alias("campaign"),
        F.when(k % 13 == 0, nul).otherwise(F.concat(F.lit("a"), _s(k % 3))).alias("adset"),
        F.concat(F.lit("ad"), _s(k % 6)).alias("ad"),
        F.lit("video").alias("adtype"),
        F.concat(F.lit("af"), _s(dn)).alias("appsflyerid"),
        F.concat(F.lit("g"), _s(dn)).alias("advertisingid"),
        nul.alias("idfa"),
        F.concat(F.lit("v"), _s(dn)).alias("idfv"),
        F.when(dn % 2 == 0, F.lit("Android")).otherwise(F.lit("iOS")).alias("platform"),
        ts.alias("extraction_date"),
    )


def organic_installs_report(events: DataFrame) -> DataFrame:
    return _mmp(events).filter("_organic").drop("_organic")


def paid_installs_report(events: DataFrame) -> DataFrame:
    return _mmp(events).filter(~F.col("_organic")).drop("_organic")


def ad_insights(events: DataFrame) -> DataFrame:
    """Facebook-style daily insights, from click events."""
    b = _base(events).filter(F.col("event_type") == "click")
    k = F.col("k")
    return b.select(
        F.to_date("ts").alias("DateStart"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("c"), _s(k % 5))).alias("CampaignName"),
        F.concat(F.lit("a"), _s(k % 3)).alias("AdSetName"),
        k.cast("bigint").alias("Clicks"),
        (k * 10).cast("bigint").alias("Impressions"),
        F.col("value").cast("decimal(18,6)").alias("Spend"),
        F.when(k % 2 == 0, k.cast("bigint")).alias("Reach"),
    )


def google_ad_group_stats(events: DataFrame) -> DataFrame:
    b = _base(events).filter(F.col("event_type") == "error")
    k = F.col("k")
    return b.select(
        F.col("ts").alias("partition_time"),
        (k % 4).cast("bigint").alias("ad_group_id"),
        (k % 6).cast("bigint").alias("campaign_id"),
        k.cast("bigint").alias("metrics_clicks"),
        (k * 20).cast("bigint").alias("metrics_impressions"),
        F.round(F.col("value") * 1e6).cast("bigint").alias("metrics_cost_micros"),
    )


def google_ad_groups(events: DataFrame) -> DataFrame:
    b = _base(events).filter(F.col("event_type") == "view")
    k = F.col("k")
    old = F.when(F.dayofmonth("ts") < 25, F.lit("_old")).otherwise(F.lit(""))
    return b.select((k % 3).cast("bigint").alias("ad_group_id"),
                    F.concat(F.lit("a"), _s(k % 3), old).alias("ad_group_name"),
                    F.col("ts").alias("partition_time"),
                    F.when(k % 11 != 0, (k % 6).cast("bigint")).alias("campaign_id"))


def google_campaigns(events: DataFrame) -> DataFrame:
    b = _base(events).filter(F.col("event_type") == "purchase")
    k = F.col("k")
    old = F.when(F.dayofmonth("ts") < 25, F.lit("_old")).otherwise(F.lit(""))
    return b.select((k % 5).cast("bigint").alias("campaign_id"),
                    F.concat(F.lit("c"), _s(k % 5), old).alias("campaign_name"),
                    F.col("ts").alias("partition_time"))
