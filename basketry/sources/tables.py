"""Readers and sinks: CSV, parquet, JSON, and model folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.temporal import parse_time
from basketry.sources.schemas import BEHAVIOUR_TABLES, RAW_TABLES

def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             columns: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Headed CSV, matched to the declared columns by name; others are not parsed.

    Nothing is inferred. Text that is no time reads as null; text that is no
    number fails. ``multi_line`` allows line breaks inside quotes, but such a
    file cannot be split over tasks.
    """
    frame = spark.read.options(header=True, multiLine=multi_line, quote='"', escape='"').csv(path)
    wanted = [f for f in schema if columns is None or f.name in columns]
    lacking = [f.name for f in wanted if f.name not in frame.columns]
    if lacking:
        raise ValueError(f"{path} lacks the columns {lacking}")
    cells = [parse_time(f.name) if isinstance(f.dataType, T.TimestampNTZType)
             else F.col(f.name).cast(f.dataType) for f in wanted]
    return frame.select(*[c.alias(f.name) for c, f in zip(cells, wanted)])


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 columns: list[str] | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    frame = reader.parquet(path)
    return frame.select(*columns) if columns else frame


def read_commerce(spark: SparkSession, raw_dir: str, behaviour_dir: str,
                  files: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """All tables of a commerce data folder under the names the plans take.

    ``files`` gives the CSV file of a table where it is not ``{table}.csv``.
    """
    files = files or {}
    tables = {name: read_csv(spark, f"{raw_dir}/{files.get(name, f'{name}.csv')}", schema,
                             multi_line=name == "reviews")
              for name, schema in RAW_TABLES.items() if name != "behavioral_sessions"}
    for name, schema in BEHAVIOUR_TABLES.items():
        key = "profile" if name == "customer_profile" else name
        tables[key] = read_parquet(spark, f"{behaviour_dir}/{name}.parquet", schema)
    return tables


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    """Report sink: one JSON object per row."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def save_model(model: PipelineModel, metrics: DataFrame, path: str) -> None:
    """A fitted pipeline and its metrics row, side by side."""
    model.write().overwrite().save(f"{path}/pipeline")
    write_parquet(metrics, f"{path}/metrics")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/metrics")
