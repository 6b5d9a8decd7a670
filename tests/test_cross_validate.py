"""Cross-validation computes its rows once."""

from pyspark.sql import functions as F

from basketry.plans import models


def test_rows_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x)

    rows = spark.range(60, numPartitions=2).select(F.col("id").alias("order_id"), counted("id").alias("x"))
    mean, spread = models.cross_validate(rows.withColumn("target_log", F.col("x") * 2 + 1), ["x"], models.linear(), "order_id")
    assert seen.value <= 120  # once for each of the two columns at most
    assert mean < 1e-6 and spread < 1e-6
