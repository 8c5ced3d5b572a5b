"""Counts of what a job removes or rejects (P7, P10, F4), taken in the scan
that does the work (``DataFrame.observe``): no second pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskspan.functions.clean import convert_types, converted


def counted_filter(df: DataFrame, condition: Column) -> tuple[DataFrame, Observation]:
    """The rows that meet ``condition``, and an observation with ``rows``,
    ``kept`` and ``removed`` (also where it is unknown), known after the first
    action on the rows."""
    seen = Observation()
    keep = F.coalesce(condition, F.lit(False))
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(keep).alias("kept"), F.count_if(~keep).alias("removed"))
    return counted.filter(keep), seen


def counted_convert(df: DataFrame, conversions: dict) -> tuple[DataFrame, Observation]:
    """``convert_types`` and an observation with the number of values of each
    converted column that were there and failed."""
    seen = Observation()
    failed = [F.count_if(F.col(f"`{c}`").isNotNull() & new.isNull()).alias(c) for c, new in converted(df, conversions).items()]
    return convert_types(df.observe(seen, *failed) if failed else df, conversions), seen


def counts(seen: Observation, step: str) -> list[tuple[str, str, int]]:
    """(step, what, count) of an observation whose rows were used."""
    return [(step, k, int(v)) for k, v in sorted(seen.get.items())]
