"""routeflow: a layered route-analytics pipeline on Spark (raw -> curated -> enriched, views, checks)."""

__version__ = "0.1.0"
