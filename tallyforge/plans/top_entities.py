"""The most active entities of each region, and activity totals with gaps kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.numbers import ratio, total
from tallyforge.operators.joins import full_outer_to_entities
from tallyforge.operators.ranking import top_exact, top_with_ties


def activity_per_entity(
    activities: DataFrame,
    key: str,
    measure: str,
    day: str,
    routes: DataFrame | None = None,
    route_key: str | None = None,
    places: int | None = None,
) -> DataFrame:
    """Total and number of active days per entity, in one pass.

    Where the measure lives in a route table, it is looked up by ``route_key`` first. Repeated
    activities count each time.
    """
    facts = activities if routes is None else activities.join(routes, route_key)
    return facts.groupBy(key).agg(
        total(measure, places).alias("total"), F.count_distinct(day).alias("active_days")
    )


def with_daily_average(per_entity: DataFrame, places: int | None = 2) -> DataFrame:
    return per_entity.withColumn("daily_average", ratio("total", "active_days", places))


def top_per_region(
    per_entity: DataFrame,
    entities: DataFrame,
    key: str,
    region: str,
    n: int = 5,
    ties: bool = True,
    keep_inactive: bool = False,
) -> DataFrame:
    """Entities of rank 1..n in their region by total, then by daily average.

    The activity is already reduced to one row per entity, so a busy entity is no hot key in the
    join. ``ties=False`` keeps exactly n, the key deciding among equals.
    """
    joined = entities.join(per_entity, key, "left" if keep_inactive else "inner")
    order = [F.desc("total"), F.desc("daily_average")]
    if ties:
        return top_with_ties(joined, region, order, n)
    return top_exact(joined, region, [*order, F.asc(key)], n)


def unify(activities: DataFrame, entities: DataFrame, key: str, routes: DataFrame, route_key: str) -> DataFrame:
    """Entities, activities and routes as one table, keeping entities without activity,
    activities without a known entity and activities without a known route."""
    return full_outer_to_entities(activities, entities, key).join(routes, route_key, "left")
