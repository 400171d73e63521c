"""Writing grouped result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_single_csv(result: DataFrame, path: str, quote_all: bool = False) -> None:
    """Replace ``path`` by one CSV part with a header, in the order of ``result``.

    For grouped results only: their rows are groups, which the last shuffle already brought
    down to a handful, so one task writes them. Trips go through ``sinks.monthly``.
    """
    result.coalesce(1).write.mode("overwrite").options(header="true", quoteAll=str(quote_all).lower()).csv(path)
