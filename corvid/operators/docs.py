"""Document-collection queries (DOC) re-expressed as Spark jobs over nested tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_one(docs: DataFrame, predicate: Column, order: list) -> DataFrame:
    """First matching document in a key order (``find_one``)."""
    return docs.where(predicate).orderBy(*order).limit(1)


def find(docs: DataFrame, predicate: Column, order: list, n: int, hidden: list[str]) -> DataFrame:
    """``find(filter, {_id: 0}).sort(...).limit(n)``: top-n in order, fields hidden after the cut."""
    return docs.where(predicate).orderBy(*order).limit(n).drop(*hidden)


def count_by(docs: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """``$group {_id: key, n: {$sum: 1}}`` with missing keys skipped."""
    return docs.where(key.isNotNull()).groupBy(key.alias(name)).agg(F.count("*").alias("n"))


def unwind_match_sum(docs: DataFrame, array_col: str, match: Column, group: str, measure: str,
                     name: str = "total") -> DataFrame:
    """``$unwind`` + ``$match`` + ``$group/$sum`` = explode, filter, aggregate."""
    items = docs.select(group, F.explode(array_col).alias("item"))
    return items.where(match).groupBy(group).agg(F.sum(f"item.{measure}").alias(name))


STATION_PAYLOAD = ("network STRUCT<id: STRING, location: STRUCT<city: STRING, country: STRING>, "
                   "stations: ARRAY<STRUCT<id: STRING, name: STRING, free_bikes: INT, empty_slots: INT>>>")


def flatten_stations(raw: DataFrame, json_col: str = "json") -> DataFrame:
    """Bike-network payload -> one row per station with the network's city; missing
    counts become 0."""
    parsed = raw.select(F.from_json(F.col(json_col), STATION_PAYLOAD).alias("p"))
    st = parsed.select(F.col("p.network.location.city").alias("city"), F.explode("p.network.stations").alias("s"))
    return st.select("city", F.col("s.name").alias("name"),
                     F.coalesce("s.free_bikes", F.lit(0)).alias("free_bikes"),
                     F.coalesce("s.empty_slots", F.lit(0)).alias("empty_slots"))


WEATHER_PAYLOAD = ("temperature DOUBLE, windspeed DOUBLE, winddirection DOUBLE, weathercode INT, time STRING, "
                   "city STRING, local_timestamp STRING, timestamp STRING")


def enrich_weather(raw: DataFrame, json_col: str = "json", city: Column | None = None) -> DataFrame:
    """Weather payload with its city and event time; producers name the time field either
    ``local_timestamp`` or ``timestamp``, both are accepted."""
    w = raw.select("*", F.from_json(F.col(json_col), WEATHER_PAYLOAD).alias("w"))
    ev_time = F.try_to_timestamp(F.coalesce(F.col("w.local_timestamp"), F.col("w.timestamp")))
    return w.select("*", F.coalesce(F.col("w.city"), city if city is not None else F.lit(None)).alias("city"),
                    ev_time.alias("event_time"), F.col("w.temperature").alias("temperature")).drop("w")
