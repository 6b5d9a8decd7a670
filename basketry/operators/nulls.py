"""Null handling: profiles and fills driven by the schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import fixed_values as fv
from basketry.operators.ordered import group_mode
from basketry.operators.quantile import attach_row, column_quantiles, number, scalars
from basketry.session import cut_lineage

_TIMES = (T.TimestampNTZType, T.TimestampType, T.DateType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _hole(df: DataFrame, name: str) -> Column:
    """Whether a value is missing: null, or NaN in a floating column."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls, infinities) for every column, from one aggregate pass; NaN is as null."""
    numbers = set(numeric_columns(df))
    inf = F.lit(float("inf"))
    cells = []
    for name in df.columns:
        endless = (F.count_if(F.abs(F.col(name).cast("double")) == inf)
                   if name in numbers else F.lit(0).cast("long"))
        cells.append(F.struct(F.lit(name).alias("column"), F.count_if(_hole(df, name)).alias("nulls"),
                              endless.alias("infinities")))
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and NaN numbers take the column's median."""
    found = column_quantiles(df, columns, [0.5], [""])
    return attach_row(df, found, "__fill").withColumns(
        {c: F.coalesce(number(c), F.col(f"__fill.{c}")) for c in columns}).drop("__fill")


def _columns_with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    counts = df.agg(*[F.count_if(_hole(df, c)).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] > 0]


def fill_by_type(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls by type: numbers by median, times and Booleans by mode, texts by 'unknown'.

    Arrays and maps become empty ones; structs and binaries stay. NaN is as null. The rows are read three
    times (null counts, fills, result), so they are written to the checkpoint folder first: this runs
    Spark jobs. Medians and modes are computed only for columns that hold nulls, and stored as one row, so
    the result may be read several times. Listed numbers come out as doubles. A column without any value
    keeps its nulls.
    """
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema}
    numbers = [c for c in columns if isinstance(kinds[c], T.NumericType)]
    times = [c for c in columns if isinstance(kinds[c], (*_TIMES, T.BooleanType))]
    out = {c: number(c) for c in numbers}
    out.update({c: F.coalesce(F.col(c), F.array().cast(kinds[c])) for c in columns if isinstance(kinds[c], T.ArrayType)})
    out.update({c: F.coalesce(F.col(c), F.create_map().cast(kinds[c])) for c in columns if isinstance(kinds[c], T.MapType)})
    out.update({c: F.coalesce(F.col(c), F.lit(fv.UNKNOWN)) for c in columns
                if isinstance(kinds[c], T.StringType)})
    if not numbers and not times:
        return df.withColumns(out)
    df = cut_lineage(df)
    holes = _columns_with_nulls(df, numbers + times)
    if not holes:
        return df.withColumns(out)
    out.update({c: F.coalesce(out.get(c, F.col(c)), F.col(f"__fill.{c}")) for c in holes})
    row = cut_lineage(_fill_row(df, [c for c in numbers if c in holes], [c for c in times if c in holes]))
    return attach_row(df, row, "__fill").withColumns(out).drop("__fill")


def _fill_row(df: DataFrame, numbers: Sequence[str], times: Sequence[str]) -> DataFrame:
    """Medians and modes as one row."""
    row = column_quantiles(df, numbers, [0.5], [""]) if numbers else df.sparkSession.range(1).drop("id")
    for c in times:
        row = row.withColumn(c, scalars(group_mode(df, [], c, c))[c])
    return row
