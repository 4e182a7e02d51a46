"""Product names that still need a category, their scoring, and the sales overview."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import ts
from tidemark.operators.aggregates import amount, units
from tidemark.operators.joins import unseen

SALE_KEY = ["branch_office_id", "product_id", "family_group_id"]
LAGS = {1: "sale_one_cw_ago", 2: "sale_two_cw_ago"}


def product_names(products: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct "group product" names; null where either part is missing."""
    named = groups.select("branch_office_id", "family_group_id", F.col("name").alias("_group"))
    return (
        products.join(named, ["branch_office_id", "family_group_id"], "left")
        .select(F.concat("_group", F.lit(" "), "name").alias("product_name"))
        .distinct()
    )


def unscored_names(products: DataFrame, groups: DataFrame, scored: DataFrame) -> DataFrame:
    """Names without a prediction yet."""
    return unseen(product_names(products, groups), scored, "product_name")


def score_with_pipeline(names: DataFrame, model, labels: Sequence[str], as_of: datetime) -> DataFrame:
    """Predictions of a fitted Spark ML pipeline (text column ``product_name``).

    ``labels`` names the classes in index order.
    """
    label = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int") + 1)
    return model.transform(names).select(
        "product_name", label.alias("prediction"), ts(as_of).alias("predicted_at")
    )


def score_with_callable(
    names: DataFrame, load: Callable[[], Callable[[list[str]], Sequence[str]]], as_of: datetime
) -> DataFrame:
    """Predictions of any ``predict(list of names)``; ``load`` runs once per task."""

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for batch in batches:
            names_ = batch["product_name"].tolist()
            yield pd.DataFrame({"product_name": names_, "prediction": list(predict(names_))})

    out = names.select("product_name").mapInPandas(scored, "product_name string, prediction string")
    return out.withColumn("predicted_at", ts(as_of))


def category_pipeline(text: str = "product_name", label: str = "label"):
    """Default classifier: words hashed to features, multinomial logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_words", pattern="[^\\p{L}\\p{N}]+"),
            HashingTF(inputCol="_words", outputCol="_features", numFeatures=1 << 12),
            LogisticRegression(featuresCol="_features", labelCol=label, maxIter=20),
        ]
    )


def score_new_names(
    products: DataFrame, groups: DataFrame, scored: DataFrame, score: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Rows to append to the predictions: unscored names through ``score``."""
    return score(unscored_names(products, groups, scored))


def real_outlets(outlets: DataFrame) -> DataFrame:
    return outlets.where(F.col("is_test_office") == 0)


def product_overview(
    outlets: DataFrame,
    sales: DataFrame,
    groups: DataFrame,
    products: DataFrame,
    predictions: DataFrame,
    as_of: date,
) -> DataFrame:
    """Sales per outlet and product with recent weeks and the predicted category.

    Sales are read once and summed per (outlet, product, group), totals and weeks together,
    before any dimension is joined, so the large table is shuffled once, in combined form.
    """
    monday = as_of - timedelta(days=as_of.weekday())
    sold, at = F.col("count") > 0, F.col("timestamp")
    recent = (at >= ts(as_of - timedelta(days=7))) & (at < ts(as_of))
    # Sums of whole weeks: week lags of the same read, by the Monday they start on.
    weeks = {
        name: F.sum(F.when((at >= ts(monday - timedelta(weeks=n))) & (at < ts(monday - timedelta(weeks=n - 1))), F.col("count")))
        for n, name in LAGS.items()
    }
    summed = sales.withColumn("_units", units("total_money")).groupBy(*SALE_KEY).agg(
        F.min(F.when(sold, at)).cast("date").alias("first_sale"),
        F.max(F.when(sold, at)).cast("date").alias("last_sale"),
        F.sum(F.when(sold, F.col("count"))).alias("total_count"),
        F.sum(F.when(sold, F.col("_units"))).alias("_money"),
        F.sum(F.when(recent, F.col("count"))).alias("sale_current_week"),
        *[total.alias(name) for name, total in weeks.items()],
    ).where("total_count is not null")
    offices = real_outlets(outlets).select("branch_office_id", F.col("name").alias("outlet_name"))
    families = groups.select("branch_office_id", "family_group_id", F.col("name").alias("family_group"))
    named = products.select("branch_office_id", "product_id", F.col("name").alias("product"))
    wide = (
        summed.join(offices, "branch_office_id")
        .join(families, ["branch_office_id", "family_group_id"])
        .join(named, ["branch_office_id", "product_id"])
        .withColumn("_name", F.concat("family_group", F.lit(" "), "product"))
    )
    category = predictions.select(F.col("product_name").alias("_name"), F.col("prediction").alias("product_category"))
    return (
        wide.join(category, "_name", "left")
        .groupBy(
            "branch_office_id", "outlet_name", "family_group_id", "family_group", "product_id", "product",
            "sale_current_week", "sale_one_cw_ago", "sale_two_cw_ago", "product_category",
        )
        .agg(
            F.min("first_sale").alias("first_sale"),
            F.max("last_sale").alias("last_sale"),
            F.sum("total_count").alias("total_count"),
            amount("sum(_money)").cast("double").alias("total_revenue"),
        )
    )
