"""External catalog tables over files that stay where they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripcohorts.functions.cohorts import MONTH_PARTITION
from tripcohorts.schemas import TRIP_SCHEMA, ZONE_SCHEMA
from tripcohorts.sources.tables import QUOTED_CSV, USED_COLUMNS, check_files, schema_problems

TRIPS_TABLE = "yellow_taxi_trips"
ZONES_TABLE = "taxi_zone_lookup"


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}")


def create_external_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    file_format: str,
    location: str,
    options: dict[str, str] | None = None,
    partitions: Sequence[str] = (),
) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS with fixed columns over an existing folder.

    Columns in ``partitions`` are folder names. The folders there are made known to the catalog each
    time, so a filter on them lists and reads only its own; folders added later need another call.
    """
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    option_list = ", ".join(f"'{k}' = {_text(v)}" for k, v in (options or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {file_format}"
        + (f" OPTIONS ({option_list})" if option_list else "")
        + (f" PARTITIONED BY ({', '.join(map(_quoted, partitions))})" if partitions else "")
        + f" LOCATION {_text(location)}"
    )
    if partitions:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def qualified(database: str, table: str) -> str:
    return f"{_quoted(database)}.{_quoted(table)}"


def register_tables(
    spark: SparkSession, database: str, trips_location: str, zones_location: str, month_folders: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Database plus both tables; safe to repeat. Returns the tables by qualified name.

    Trip files that lack a column the studies read are refused, and a lookup whose header has other
    names, or another order, fails when it is read. With ``month_folders`` the trips are
    laid out as ``sinks.monthly`` does, and the table has the month as its partition column.
    """
    check_files(spark, [trips_location], TRIP_SCHEMA)
    create_database(spark, database)
    by_month = T.StructType([*TRIP_SCHEMA.fields, T.StructField(MONTH_PARTITION, T.IntegerType())])
    trips = create_external_table(
        spark,
        qualified(database, TRIPS_TABLE),
        by_month if month_folders else TRIP_SCHEMA,
        "parquet",
        trips_location,
        partitions=[MONTH_PARTITION] if month_folders else [],
    )
    checked = {**QUOTED_CSV, "enforceSchema": "false"}
    return trips, create_external_table(spark, qualified(database, ZONES_TABLE), ZONE_SCHEMA, "csv", zones_location, checked)


def registered_tables(spark: SparkSession, database: str, month_folders: bool = False) -> tuple[DataFrame, DataFrame]:
    """The tables of a database, which others may have made: refused if the studies cannot read them.

    Their columns are looked at, and not each file. ``month_folders`` asks for a partition column.
    """
    trips, zones = (spark.table(qualified(database, name)) for name in (TRIPS_TABLE, ZONES_TABLE))
    wanted = T.StructType([f for f in TRIP_SCHEMA.fields if f.name in USED_COLUMNS])
    problems = [*schema_problems(trips, wanted), *schema_problems(zones, ZONE_SCHEMA)]
    if month_folders:
        columns = spark.catalog.listColumns(qualified(database, TRIPS_TABLE))
        if not any(c.name == MONTH_PARTITION and c.isPartition for c in columns):
            problems.append(f"the trips have no folders by {MONTH_PARTITION}")
    if problems:
        raise ValueError(f"{database}: {'; '.join(problems)}")
    return trips, zones


def _quoted(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
