"""Nearest-neighbour style lookups: gazetteer geocoding (forward by
normalised name, reverse by great-circle distance, ``geo``) and k-nearest-
neighbour classification (``knn``).

One plan for every size: reference tables are met by equi-joins on cells,
rings or names, never shipped whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geo import EARTH_KM, geocode_reverse, haversine_km
from .knn import knn_classify

__all__ = ["EARTH_KM", "geocode_forward", "geocode_reverse", "haversine_km", "knn_classify", "normalise_name"]


def normalise_name(c: Column) -> Column:
    """Trim, collapse inner whitespace, upper-case."""
    return F.upper(F.regexp_replace(F.trim(c), r"\s+", " "))


def geocode_forward(df: DataFrame, place: str, gazetteer: DataFrame, name: str = "name") -> DataFrame:
    """Attach the gazetteer row whose normalised name equals the normalised
    place (left join: unknown places keep nulls). An equi-join: Catalyst/AQE
    broadcast the gazetteer when it is small and shuffle-join it when not."""
    g = gazetteer.withColumn("_k", normalise_name(F.col(name)))
    return df.withColumn("_k", normalise_name(F.col(place))).join(g, "_k", "left").drop("_k")
