"""Reading result tables back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripcohorts.schemas import RESULT_SCHEMAS
from tripcohorts.sources.tables import QUOTED_CSV


def read_result(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A result folder (all CSV parts) or single CSV file, quoted or not.

    ``schema`` is a StructType or the name of a result table. A missing path gives an empty
    table of that schema. Text such as N/A stays text.
    """
    typed = RESULT_SCHEMAS[schema] if isinstance(schema, str) else schema
    try:
        return (
            spark.read.options(**QUOTED_CSV, enforceSchema="false", pathGlobFilter="*.csv")
            .schema(typed)
            .csv(path)
        )
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], typed)
