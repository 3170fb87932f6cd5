"""Home-win model on Spark ML: scaling, logistic regression, metrics, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestry.plans.features import FEATURES, LABEL
from contestry.session import materialize


@dataclass(frozen=True)
class Scaling:
    """Mean and population standard deviation per feature."""

    mean: dict[str, float]
    std: dict[str, float]

    def columns(self) -> dict[str, Column]:
        """Centred and scaled features; a constant feature is only centred."""
        return {c: (F.col(c) - self.mean[c]) / (self.std[c] or 1.0) for c in self.mean}

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.columns())


def fit_scaling(df: DataFrame, columns: Sequence[str] = FEATURES) -> Scaling:
    """One aggregation; only two numbers per feature reach the driver."""
    row = df.agg(
        *(F.avg(c).alias(f"mean_{c}") for c in columns),
        *(F.stddev_pop(c).alias(f"std_{c}") for c in columns),
    ).first()
    return Scaling({c: row[f"mean_{c}"] for c in columns}, {c: row[f"std_{c}"] for c in columns})


@dataclass(frozen=True)
class HomeWinModel:
    """Fitted model: scaling, weights of the scaled features, intercept."""

    scaling: Scaling
    weights: dict[str, float]
    intercept: float

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with the home-win probability and the predicted label.

        A plain column expression, so scoring stays in generated code.
        """
        margin = F.lit(self.intercept)
        for name, scaled in self.scaling.columns().items():
            margin = margin + scaled * self.weights[name]
        scored = df.withColumn("HomeWinProb", 1 / (1 + F.exp(-margin)))
        return scored.withColumn("prediction", F.when(F.col("HomeWinProb") > 0.5, 1).otherwise(0))


def fit_home_win(train: DataFrame, penalty: float = 1.0, max_iter: int = 1000) -> HomeWinModel:
    """Logistic regression with an L2 penalty on standardised features.

    The loss is averaged over rows, so an inverse penalty strength C = ``penalty``
    on the summed loss is ``regParam = 1 / (C * rows)``.
    """
    scaling = fit_scaling(train)
    regression = LogisticRegression(
        labelCol=LABEL,
        maxIter=max_iter,
        regParam=1.0 / (penalty * train.count()),
        elasticNetParam=0.0,
        standardization=False,
    )
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fitted = regression.fit(assembler.transform(scaling.apply(train)).select("features", LABEL))
    weights = dict(zip(FEATURES, (float(w) for w in fitted.coefficients)))
    return HomeWinModel(scaling, weights, float(fitted.intercept))


def confusion(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy(F.col(LABEL).alias("label"), "prediction").agg(F.count("*").alias("rows"))


def classification_report(predicted: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means.

    All from the confusion counts, at most one row per pair of classes.
    """
    cells = materialize(confusion(predicted), "confusion")
    by_class = (
        cells.select(
            F.explode(
                F.array(
                    F.struct(F.col("label").alias("class"), F.col("rows").alias("support"), F.lit(0).alias("predicted")),
                    F.struct(F.col("prediction").alias("class"), F.lit(0).alias("support"), F.col("rows").alias("predicted")),
                )
            ).alias("c"),
            F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0).alias("hits"),
        )
        .groupBy("c.class")
        .agg(
            F.sum("c.support").alias("support"),
            F.sum("c.predicted").alias("predicted"),
            # each right cell is seen once as a label and once as a prediction
            (F.sum("hits") / 2).alias("hits"),
        )
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))

    scores = by_class.select(
        F.col("class").cast("string").alias("class"),
        ratio("hits", "predicted").alias("precision"),
        ratio("hits", "support").alias("recall"),
        (2 * F.col("hits") / (F.col("support") + F.col("predicted"))).alias("f1"),
        "support",
        "hits",
    )
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    accuracy = F.sum("hits") / total
    means = {
        "accuracy": [accuracy] * 3,
        "macro avg": [F.avg(m) for m in measures],
        "weighted avg": [F.sum(F.col(m) * F.col("support")) / total for m in measures],
    }
    rows = scores.select("class", *measures, "support")
    for name, values in means.items():
        summary = scores.agg(
            *(v.alias(m) for v, m in zip(values, measures)), total.alias("support")
        )
        rows = rows.unionByName(summary.withColumn("class", F.lit(name)))
    return rows


def next_round_probabilities(model: HomeWinModel, features: DataFrame, digits: int | None = 2) -> DataFrame:
    """Home-win probability of coming contests and its complement.

    The complement is the probability of "no home win", so it includes draws.
    Contests without both ratings cannot be scored and stay out.
    """
    scored = model.predict(features.na.drop(subset=list(FEATURES))).drop("prediction")
    scored = scored.withColumn("AwayWinProb", 1 - F.col("HomeWinProb"))
    if digits is None:
        return scored
    return scored.withColumns({c: F.round(c, digits) for c in ("HomeWinProb", "AwayWinProb")})
