"""Trip and zone tables, read through explicit schemas."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcohorts.schemas import TRIP_SCHEMA, ZONE_SCHEMA

#: Columns of trips that the studies read.
USED_COLUMNS = (
    "tpep_pickup_datetime",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
)
PROBLEMS_SHOWN = 10
UNREACHED = "its store is known to Spark only"
QUOTED_CSV = {"header": "true", "sep": ",", "quote": '"'}


def read_trips(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType = TRIP_SCHEMA,
    used: Sequence[str] = USED_COLUMNS,
) -> DataFrame:
    """One table over many Parquet files; paths may be globs.

    Every file must hold the ``used`` columns in their types, or
    reading fails: a missing column would otherwise read as NULL. Other columns may differ from
    file to file, since only selected columns are decoded.
    """
    check_files(spark, paths, schema, used)
    return spark.read.schema(schema).parquet(*paths)


def check_files(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, used: Sequence[str] = USED_COLUMNS
) -> None:
    """Fails with what keeps Parquet files from being read: one Spark job, whatever their number.

    The first PROBLEMS_SHOWN problems by file name and the number of the others come to the driver.
    For stores that only Spark can read, its own job that merges all footers has to do: it
    finds columns of another type, and those that no file has.
    """
    wanted = T.StructType([f for f in schema.fields if f.name in used])
    found, total = Observation(), F.count("*").alias("total")
    problems = file_problems(spark, paths, wanted)
    first = problems.observe(found, total).orderBy("path", "place").limit(PROBLEMS_SHOWN).collect()
    if any(r["problem"] == UNREACHED for r in first):
        merged = schema_problems(spark.read.option("mergeSchema", "true").parquet(*paths), wanted)
        if merged:
            raise ValueError("; ".join(f"{', '.join(paths)}: {problem}" for problem in merged))
    elif first:
        more = found.get["total"] - len(first)
        raise ValueError("; ".join(f"{r['path']}: {r['problem']}" for r in first) + (f"; and {more} more" if more else ""))


def file_problems(spark: SparkSession, paths: Sequence[str], wanted: T.StructType) -> DataFrame:
    """path, place (of the column), problem: all that keeps Parquet files from being read as ``wanted``."""
    names = F.array(*[F.lit(f.name) for f in wanted])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in wanted])
    asked = footers(spark, paths, [f.name for f in wanted]).select("path", "kinds", F.posexplode(names).alias("place", "name"))
    found, expected = F.try_element_at("kinds", F.lower("name")), F.get(types, F.col("place"))
    problem = F.when(found.isNull(), F.concat(F.lit("missing column "), "name")).when(
        F.regexp_replace(found, "_ntz$", "") != F.regexp_replace(expected, "_ntz$", ""),
        F.concat(F.lit("column "), "name", F.lit(" is "), found, F.lit(", not "), expected),
    )
    # a file that Arrow cannot read says why
    problem = F.coalesce(F.try_element_at("kinds", F.lit("")), problem)
    return asked.select("path", "place", problem.alias("problem")).filter("problem is not null")


def footers(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """path and kinds (lower-case name to type) of some columns, from the footer of each Parquet file.

    Files are listed as a table, without their content, and their footers are read where its rows are.
    For a file that cannot be read, kinds hold the reason under an empty name. The function takes all
    it needs along, for workers need not have this package.
    """
    asked, unreached = {name.lower() for name in columns}, UNREACHED

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as arrow
        from pyarrow import fs, parquet
        from pyspark.sql.pandas.types import from_arrow_type

        unsigned = {"uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)"}

        def kind(given: arrow.DataType) -> str:
            if arrow.types.is_dictionary(given):
                given = given.value_type
            try:
                return unsigned.get(str(given)) or from_arrow_type(given, prefer_timestamp_ntz=True).simpleString()
            except Exception:  # no type of Spark
                return str(given)

        def opened(path: str):
            scheme, colon, rest = path.partition(":")
            if not colon or scheme == "file":
                return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
            store, _, inside = rest.removeprefix("//").partition("/")
            system, root = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{store}/")
            return system, f"{root.rstrip('/')}/{inside}"

        def kinds(path: str) -> list[tuple[str, str]]:
            try:
                system, name = opened(path)
            except (OSError, arrow.ArrowInvalid):
                return [("", unreached)]
            try:
                with system.open_input_file(name) as file:
                    schema = parquet.read_schema(file)
            except (OSError, arrow.ArrowException) as problem:
                return [("", f"its footer cannot be read ({str(problem).splitlines()[0][:200]})")]
            return list({f.name.lower(): kind(f.type) for f in schema if f.name.lower() in asked}.items())

        result = arrow.schema([("path", arrow.string()), ("kinds", arrow.map_(arrow.string(), arrow.string()))])
        for batch in batches:
            names = batch.column("path").to_pylist()
            yield arrow.RecordBatch.from_arrays(
                [arrow.array(names, arrow.string()), arrow.array([kinds(n) for n in names], result.field("kinds").type)], schema=result
            )

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path")
    return listed.mapInArrow(read, "path string, kinds map<string, string>")


def read_zones(spark: SparkSession, path: str, infer_types: bool = False) -> DataFrame:
    """The zone lookup from CSV, by the names in its header row, in any order.

    ``infer_types`` takes types from the values, which costs an extra pass.
    """
    reader = spark.read.options(**QUOTED_CSV)
    table = reader.option("inferSchema", str(infer_types)).csv(path)
    missing = [f.name for f in ZONE_SCHEMA.fields if f.name.lower() not in map(str.lower, table.columns)]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    if infer_types:
        return table.select(*[F.col(f.name) for f in ZONE_SCHEMA.fields])
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ZONE_SCHEMA.fields])


def schema_problems(frame: DataFrame, expected: T.StructType) -> list[str]:
    """What keeps a table from being read as ``expected``; empty when nothing does.

    Column names are compared as Spark resolves them, without case. Both timestamp types
    count as one: every calendar function here accepts either.
    """
    actual = {f.name.lower(): f.dataType for f in frame.schema.fields}
    problems = []
    for field in expected.fields:
        found = actual.get(field.name.lower())
        if found is None:
            problems.append(f"missing column {field.name}")
        elif _kind(found) != _kind(field.dataType):
            problems.append(
                f"column {field.name} is {found.simpleString()}, not {field.dataType.simpleString()}"
            )
    return problems


def _kind(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return data_type.simpleString()
