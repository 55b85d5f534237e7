"""SQL views of the dashboard queries (S11): the same plans under fixed names."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import dashboards, traffic

DASHBOARD_VIEWS = {
    "active_airports_30d": dashboards.active_airports_30d,
    "airport_traffic_share": dashboards.airport_traffic_share,
    "passenger_metrics_30d": dashboards.passenger_metrics_30d,
    "passenger_groups_revenue": dashboards.passenger_groups_revenue,
}


def create_views(spark: SparkSession, booking=None, history=None, as_of=None, prefix: str = "") -> list[str]:
    """Register temporary views that SQL can query; the plans stay lazy.

    `booking` (booking-model tables) gives `airport_traffic`, `history` (vault
    tables) the four dashboard views. Returns the names."""
    made = []
    if booking is not None:
        traffic.airport_traffic(booking).createOrReplaceTempView(f"{prefix}airport_traffic")
        made.append(f"{prefix}airport_traffic")
    if history is not None:
        for name, plan in DASHBOARD_VIEWS.items():
            plan(history, as_of).createOrReplaceTempView(f"{prefix}{name}")
            made.append(f"{prefix}{name}")
    return made
