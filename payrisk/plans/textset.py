"""Text data set for a risk classifier, split, baseline training and evaluation."""

from __future__ import annotations

from string import Formatter

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, RegexTokenizer, SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.functions.rules import risky
from payrisk.functions.values import is_train
from payrisk.session import scratch_path

TRAIN, VALIDATION = "train", "validation"


# The sentence about a payment, and what stands for missing fields.
SENTENCE = (
    "Transaction from country {country} with amount {amount} EUR. Status: {status}. "
    "Risk score evaluation: {puntuacion_riesgo}."
)
MISSING = {"country": "UNKNOWN", "amount": "0.0", "status": "unknown", "puntuacion_riesgo": "0"}


def sentence(leak_free: bool = False) -> Column:
    """One payment as a sentence. ``leak_free`` omits the status and score that make the label."""
    template = SENTENCE.split(" Status:")[0] if leak_free else SENTENCE
    pieces = []
    for text, name, _, _ in Formatter().parse(template):
        pieces.append(F.lit(text))
        if name:
            pieces.append(F.coalesce(F.col(name).cast("string"), F.lit(MISSING[name])))
    return F.concat(*pieces)


def text_set(report: DataFrame, leak_free: bool = False, keep_id: bool = False) -> DataFrame:
    """(text, label), label 1 for declined or risky payments; rows lacking either are dropped."""
    columns = [
        sentence(leak_free).alias("text"),
        risky(F.col("puntuacion_riesgo")).cast("int").alias("label"),
    ]
    if keep_id:
        columns.insert(0, F.col("payment_id"))
    return report.select(*columns).filter("text IS NOT NULL AND label IS NOT NULL")


def with_part(rows: DataFrame) -> DataFrame:
    """Add ``part``, 'train' for about 80 % of the payments and 'validation' for the others."""
    chosen = is_train(F.coalesce("payment_id", F.lit("")))
    return rows.withColumn("part", F.when(chosen, TRAIN).otherwise(VALIDATION))


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, validation), disjoint and complete. A filter each, no shuffle."""
    parts = with_part(rows)
    return tuple(parts.filter(F.col("part") == p).drop("part") for p in (TRAIN, VALIDATION))


def baseline(
    features: int = 1 << 14, iterations: int = 20, max_tokens: int | None = None
) -> Pipeline:
    """Tokens, hashed counts, logistic regression. The model size does not depend on the data.

    Texts are taken whole; ``max_tokens`` cuts them, as models with a fixed input length do."""
    kept = "all_tokens" if max_tokens is None else f"slice(all_tokens, 1, {max_tokens})"
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="all_tokens", pattern=r"\W+"),
            SQLTransformer(statement=f"SELECT *, {kept} AS tokens FROM __THIS__"),
            HashingTF(inputCol="tokens", outputCol="features", numFeatures=features),
            LogisticRegression(maxIter=iterations, labelCol="label", featuresCol="features"),
        ]
    )


def train(rows: DataFrame, **how) -> PipelineModel:
    """Fit the baseline, with its parameters. ``rows`` are read once per iteration, so give a stored
    or cached table.

    The model is stored and read back: a freshly fitted one holds on to the session, and cannot be
    sent to executors once the session has observed row counts.
    """
    path = scratch_path(rows.sparkSession, "model")
    save(baseline(**how).fit(rows), path)
    return PipelineModel.load(path)


def evaluation(predicted: DataFrame) -> DataFrame:
    """Validation rows, rows per label, accuracy, and whether it beats the commoner label's share."""
    right = (F.col("prediction") == F.col("label")).cast("double")
    positive = F.count_if(F.col("label") == 1)
    total = F.count(F.lit(1))
    return predicted.agg(
        total.alias("n_rows"),
        positive.alias("n_label_1"),
        (total - positive).alias("n_label_0"),
        (F.avg(right) > F.greatest(positive, total - positive) / total).alias("beats_majority"),
    )


def accuracy(model: Transformer, rows: DataFrame) -> float:
    scored = model.transform(rows).withColumn("label", F.col("label").cast("double"))
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
