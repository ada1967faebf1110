"""Exploding arrays without evaluating them twice.

For an inner ``explode``, Catalyst infers ``size(arr) > 0 AND arr IS NOT
NULL`` and pushes that filter below the projection, so a costly array
expression (tokenising a whole text) runs once in the filter and again in
the projection.  The outer generator has no inferred filter; dropping the
one null row of an empty array afterwards gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, arr, alias: str, *cols) -> DataFrame:
    """(*cols, alias) for every element (elements are never null here)."""
    return df.select(*cols, F.explode_outer(arr).alias(alias)).where(F.col(alias).isNotNull())


def posexplode_rows(df: DataFrame, arr, pos: str, alias: str, *cols, keep_empty: bool = False) -> DataFrame:
    """(*cols, pos, alias); ``keep_empty`` keeps one null row for an empty
    or null array (documents without tokens)."""
    out = df.select(*cols, F.posexplode_outer(arr).alias(pos, alias))
    return out if keep_empty else out.where(F.col(pos).isNotNull())

