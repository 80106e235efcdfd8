"""Customer recency, frequency and monetary value, and segments of them."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.calendar import as_day
from shelfwise.functions.measures import mean

RFM_COLUMNS = ("recency", "frequency", "monetary_value")


def rfm(purchases: DataFrame, as_of=None, customer: str = "customer_id") -> DataFrame:
    """Last purchase, number of purchases, their total, and days since the last one."""
    return (
        purchases.groupBy(customer)
        .agg(
            F.max("date").alias("last_purchase_date"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("amount").cast("double").alias("monetary_value"),
        )
        .withColumn("recency", F.datediff(as_day(as_of), "last_purchase_date"))
    )


def fit_segments(customers: DataFrame, k: int = 5, seed: int = 42) -> PipelineModel:
    """K-Means over the scaled columns. Pass a stored table: the fit reads it many times."""
    stages = [
        VectorAssembler(inputCols=list(RFM_COLUMNS), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled_features"),
        KMeans(featuresCol="scaled_features", k=k, seed=seed),
    ]
    return Pipeline(stages=stages).fit(customers)


def segment_profile(segmented: DataFrame) -> DataFrame:
    """Size and mean values of each segment."""
    return segmented.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean("recency").alias("avg_recency"),
        mean("frequency").alias("avg_frequency"),
        mean("monetary_value").alias("avg_monetary"),
    )
