"""Checks on scored tables: flag budget, completeness, and the result table itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratascore.operators.segment import flag_rate


def flag_budget(df: DataFrame, share: float = 0.20, prediction: str = "prediction") -> DataFrame:
    """Flagged rows against ``floor(share * n)``; passes only if strictly below."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(prediction) == 1).alias("n_flagged"))
    limit = F.floor(F.lit(share) * F.col("n")).cast("bigint")
    return counts.withColumn("flag_limit", limit).withColumn("within_budget", F.col("n_flagged") < F.col("flag_limit"))


def budget_attribution(df: DataFrame, segment: str = "cluster", prediction: str = "prediction") -> DataFrame:
    """Which segments use the budget, largest first."""
    return flag_rate(df, segment, prediction).filter(F.col("n_flagged") > 0).orderBy(F.desc("n_flagged"), segment)


def submission(df: DataFrame, key: str = "id", prediction: str = "prediction") -> DataFrame:
    return df.select(key, F.col(prediction).cast("int").alias("flag"))


def output_check(inputs: DataFrame, result: DataFrame, key: str = "id", flag: str = "flag") -> DataFrame:
    """Keys lost, added, doubled or without a flag. One shuffle of the two key columns."""
    a = inputs.select(F.col(key), F.lit(1).alias("wanted"), F.lit(0).alias("got"), F.lit(0).alias("no_flag"))
    b = result.select(F.col(key), F.lit(0).alias("wanted"), F.lit(1).alias("got"),
                      F.col(flag).isNull().cast("int").alias("no_flag"))
    per_key = a.unionByName(b).groupBy(key).agg(*[F.sum(c).alias(c) for c in ("wanted", "got", "no_flag")])
    return per_key.agg(
        F.coalesce(F.sum("wanted"), F.lit(0)).alias("n_input"),
        F.coalesce(F.sum("got"), F.lit(0)).alias("n_output"),
        F.count_if((F.col("wanted") > 0) & (F.col("got") == 0)).alias("n_lost"),
        F.count_if((F.col("wanted") == 0) & (F.col("got") > 0)).alias("n_added"),
        F.count_if(F.col("got") > F.greatest(F.col("wanted"), F.lit(1))).alias("n_doubled"),
        F.coalesce(F.sum("no_flag"), F.lit(0)).alias("n_without_flag"),
    )
