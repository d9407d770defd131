"""The event-source seed: maps an event name to 'frontend' or 'backend'."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's seed table (event_name, event_source), 35 rows,
# in the order of the seed file.
EVENT_SOURCES = [
    ("Visual Customization Item Used", "frontend"),
    ("User Challenged", "frontend"),
    ("Tutorial Step Reached", "frontend"),
    ("Trophies Won", "backend"),
    ("Trophies Lost", "backend"),
    ("Show Started", "frontend"),
    ("Show Completed", "frontend"),
    ("Show Activity Completed", "frontend"),
    ("Show Abandoned", "frontend"),
    ("Session Started", "frontend"),
    ("Screen View", "frontend"),
    ("Registration Step Completed", "frontend"),
    ("Registration Started", "frontend"),
    ("Registration Completed", "frontend"),
    ("Referral Code Used", "frontend"),
    ("Prize Won", "backend"),
    ("Low FPS Detected", "frontend"),
    ("Level Updated", "frontend"),
    ("Leaderboard Updated", "backend"),
    ("Items Used", "frontend"),
    ("IAP Product Purchased", "frontend"),
    ("General Action Performed", "frontend"),
    ("Game Round Started", "frontend"),
    ("Game Round Completed", "frontend"),
    ("Game Round Abandoned", "frontend"),
    ("Game Product Purchased", "frontend"),
    ("Friend Removed", "backend"),
    ("Friend Added", "backend"),
    ("FTUE Step Configured", "frontend"),
    ("Error Encountered", "frontend"),
    ("Chat Used", "frontend"),
    ("App Rating Submitted", "frontend"),
    ("App Rating Popup Shown", "frontend"),
    ("App Opened", "frontend"),
    ("Account Deleted", "frontend"),
]


def event_sources(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """The seed as a DataFrame; read from ``csv_path`` when given (header row)."""
    if csv_path:
        return spark.read.option("header", True).schema("event_name string, event_source string").csv(csv_path)
    # the built-in rows are few by construction; a file of any size is left to the planner
    return F.broadcast(spark.createDataFrame(EVENT_SOURCES, "event_name string, event_source string"))
