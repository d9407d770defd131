"""Cost and installs: J5 stg_facebook_ads, J6 stg_google_ads, J7 int_ad_platform,
J8 int_daily_installs_attributed, J18 fct_user_acquisition_daily."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.config import Settings
from playlake.functions import ntz
from playlake.operators.topk import top1_per_key
from playlake.operators.upsert import upsert

MONEY = "decimal(18,6)"  # money is summed exactly, then reported as DOUBLE
AD_PLATFORM_COLUMNS = ["date", "campaign_name", "ad_group", "channel", "clicks", "impressions", "spend", "reach"]
MART_KEYS = ["date", "channel", "campaign_name", "ad_group"]
MART_COLUMNS = [*MART_KEYS, "total_clicks", "total_impressions", "total_spend", "total_reach", "total_installs"]


def stg_facebook_ads(insights: DataFrame) -> DataFrame:
    """Daily totals per campaign and ad set."""
    return insights.groupBy(F.col("DateStart").alias("date"), F.col("CampaignName").alias("campaign_name"),
                            F.col("AdSetName").alias("ad_group")).agg(
        F.sum("Clicks").alias("clicks"), F.sum("Impressions").alias("impressions"),
        F.sum(F.col("Spend").cast(MONEY)).cast("double").alias("spend"), F.sum("Reach").alias("reach"))


def latest_names(snapshots: DataFrame, id_col: str, name_col: str, as_of: dt.datetime, days: int) -> DataFrame:
    """Newest name per id among snapshots with partition time in [as_of - days, as_of]."""
    pt = F.col("partition_time")
    recent = snapshots.filter(pt.between(ntz(as_of - dt.timedelta(days=days)), ntz(as_of)))
    return top1_per_key(recent.select(id_col, "partition_time", name_col), [id_col], ["partition_time", name_col],
                        descending=True).select(id_col, name_col)


def stg_google_ads(stats: DataFrame, ad_groups: DataFrame, campaigns: DataFrame, as_of: dt.datetime,
                   settings: Settings = Settings()) -> DataFrame:
    """Stats with their latest names; cost micros -> currency."""
    days = settings.name_snapshot_lookback_days
    ag = latest_names(ad_groups, "ad_group_id", "ad_group_name", as_of, days)
    cp = latest_names(campaigns, "campaign_id", "campaign_name", as_of, days)
    j = stats.join(ag, on="ad_group_id", how="left").join(cp, on="campaign_id", how="left")
    return j.groupBy(F.to_date("partition_time").alias("date"), "campaign_name",
                     F.col("ad_group_name").alias("ad_group")).agg(
        F.sum("metrics_clicks").alias("clicks"), F.sum("metrics_impressions").alias("impressions"),
        (F.sum("metrics_cost_micros") / F.lit(1000000)).alias("spend"))


def int_ad_platform(facebook: DataFrame, google: DataFrame) -> DataFrame:
    """One cost stream with a channel label (google has no reach)."""
    fb = facebook.withColumn("channel", F.lit("facebook"))
    gg = google.withColumn("channel", F.lit("google")).withColumn("reach", F.lit(None).cast("bigint"))
    return fb.select(*AD_PLATFORM_COLUMNS).unionByName(gg.select(*AD_PLATFORM_COLUMNS))


def int_daily_installs(attribution: DataFrame) -> DataFrame:
    """Installs per day, channel, campaign, ad group ('Unknown ...' for NULLs)."""
    ms = F.col("mediasource")
    channel = F.when(ms == "Facebook Ads", "facebook").when(ms == "googleadwords_int", "google").otherwise(ms)
    return attribution.groupBy(
        F.to_date("installtime").alias("install_date"), channel.alias("channel"),
        F.coalesce("campaign", F.lit("Unknown Campaign")).alias("campaign_name"),
        F.coalesce("adset", F.lit("Unknown Adgroup")).alias("ad_group")).agg(
        F.count("unique_id").alias("total_installs"))


def fct_user_acquisition_daily(ad_platform: DataFrame, daily_installs: DataFrame,
                               target: DataFrame | None = None) -> DataFrame:
    """Cost full-outer-joined with installs on the four keys (NULL keys never
    match, so such rows stay apart); missing measures become 0."""
    ad = ad_platform.groupBy(*MART_KEYS).agg(
        F.sum("clicks").alias("c"), F.sum("impressions").alias("i"),
        F.sum(F.col("spend").cast(MONEY)).alias("s"), F.sum("reach").alias("r"))
    ins = daily_installs.groupBy(F.col("install_date").alias("date"), "channel", "campaign_name", "ad_group").agg(
        F.sum("total_installs").alias("n"))
    a, b = ad.alias("a"), ins.alias("b")
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in MART_KEYS]
    j = a.join(b, cond, "full")
    out = j.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in MART_KEYS],
                   F.coalesce("a.c", F.lit(0)).cast("bigint").alias("total_clicks"),
                   F.coalesce("a.i", F.lit(0)).cast("bigint").alias("total_impressions"),
                   F.coalesce("a.s", F.lit(0)).cast("double").alias("total_spend"),
                   F.coalesce("a.r", F.lit(0)).cast("bigint").alias("total_reach"),
                   F.coalesce("b.n", F.lit(0)).cast("bigint").alias("total_installs"))
    return upsert(target, out, MART_KEYS)
