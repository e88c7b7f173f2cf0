"""Flight states: positional snapshot arrays to typed rows, silver and gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import epoch_to_ts, round2, strip, truthy

# Positions in a state array.
POSITIONS = {
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "geo_altitude": 13,
    "velocity": 9,
    "heading": 10,
    "vertical_rate": 11,
}
ICAO24, CALLSIGN, COUNTRY, SEEN_AT, ON_GROUND = 0, 1, 2, 4, 8

REQUIRED = [
    "latitude", "longitude", "baro_altitude", "geo_altitude", "velocity", "heading", "vertical_rate",
]


def flight_states(snapshots: DataFrame) -> DataFrame:
    """Twelve typed columns per state; a snapshot without states yields no rows.

    States without a time are left out, as the table requires one.
    """
    state = F.col("state")

    def at(position: int) -> Column:
        return F.get(state, F.lit(position))

    seen_at = at(SEEN_AT).try_cast("bigint")
    return (
        snapshots.select(F.explode("states").alias("state"))
        .where(seen_at.isNotNull())
        .select(
            epoch_to_ts(seen_at).alias("event_time"),
            at(ICAO24).alias("icao24"),
            F.coalesce(strip(at(CALLSIGN)), F.lit("")).alias("callsign"),
            at(COUNTRY).alias("origin_country"),
            *[at(i).try_cast("double").alias(name) for name, i in POSITIONS.items()],
            truthy(at(ON_GROUND)).alias("on_ground"),
        )
    )


def stamped(states: DataFrame) -> DataFrame:
    """With the load time in UTC, which is one value for all rows of a query."""
    now = F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    return states.withColumn("ingested_at", now)


def silver_flights(raw: DataFrame) -> DataFrame:
    """Rows that have all required readings; NaN is a reading."""
    known = F.lit(True)
    for name in REQUIRED:
        known = known & F.col(name).isNotNull()
    return raw.where(known)


def gold_flight_summary(silver: DataFrame) -> DataFrame:
    on_ground = F.col("on_ground")
    airborne = F.count_if(on_ground == 0)
    return (
        silver.groupBy("origin_country")
        .agg(
            F.count("*").alias("total_flights"),
            airborne.alias("airborne_flights"),
            F.count_if(on_ground == 1).alias("grounded_flights"),
            round2(airborne / F.count("*") * 100).alias("airborne_percentage"),
            round2(F.avg("velocity") * 3.6).alias("avg_velocity_kmh"),
            round2(F.avg("baro_altitude")).alias("avg_altitude"),
        )
        .orderBy(F.desc("total_flights"), "origin_country")
    )
