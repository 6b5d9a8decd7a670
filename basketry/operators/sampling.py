"""Splits and samples that give the same rows on every run and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.labels import hash_uniform


def time_split(df: DataFrame, time: str, date: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the date, and rows from the date on."""
    cut = F.lit(date).cast("timestamp_ntz")
    return df.where(F.col(time) < cut), df.where(F.col(time) >= cut)


def split_label(key: str, test_share: float = 0.2, seed: int = 42) -> Column:
    """'train' or 'test' by a hash of the key."""
    draw = hash_uniform(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.when(draw < test_share, "test").otherwise("train")


def fold_number(key: str, folds: int = 5, seed: int = 42) -> Column:
    draw = hash_uniform(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.floor(draw * folds).cast("int")


def stable_sample(df: DataFrame, key: str, size: int, seed: int = 123) -> DataFrame:
    """``size`` rows without replacement: those whose seeded key hash is smallest."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return df.orderBy(F.md5(text), F.col(key)).limit(size)
