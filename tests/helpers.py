"""Small trip tables written row by row."""

from __future__ import annotations

from contextlib import redirect_stdout
from datetime import datetime
from io import StringIO

from pyspark.sql import DataFrame, SparkSession

from tripcohorts.schemas import TRIP_SCHEMA, ZONE_SCHEMA

USUAL = dict(
    tpep_pickup_datetime=datetime(2025, 3, 10, 8, 0),
    fare_amount=10.0,
    tip_amount=2.0,
    trip_distance=1.0,
    PULocationID=50,
    DOLocationID=60,
    payment_type=1,
)


def trip(**changes) -> dict:
    """A usual card trip of both studies' baseline, with some columns changed."""
    return {**USUAL, **changes}


def trips(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(f.name) for f in TRIP_SCHEMA) for r in rows], TRIP_SCHEMA)


def zones(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (id, borough, zone)."""
    return spark.createDataFrame([(i, b, z, b) for i, b, z in rows], ZONE_SCHEMA)


def values(frame: DataFrame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]


def explained(frame: DataFrame) -> str:
    text = StringIO()
    with redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()
