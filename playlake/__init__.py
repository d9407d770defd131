"""playlake: mobile-game telemetry analytics as PySpark DataFrame jobs.

Every job is a function ``DataFrame(s) -> DataFrame`` built from Spark Column
expressions, joins, windows and aggregations; see ``playlake.plans``.
"""

from playlake.config import Settings, RunWindow

__all__ = ["Settings", "RunWindow"]
