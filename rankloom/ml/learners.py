"""Ranker families on Spark ML: linear, factorization machine, dense tower."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import FMClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import Interaction, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.encode import encode_token
from rankloom.operators.vocab import coverage_vocabulary, token_frequency


# Ids of a category that get a slot of their own, at most.
MOST_IDS = 1 << 16


def learn_ids(df: DataFrame, categories: Sequence[str], rate: float | None = None, most: int = MOST_IDS) -> DataFrame:
    """``field, token, id``: ids from 1 for the values of raw categories, the most frequent first.

    With a ``rate`` only the head that covers this share of the rows has ids, and
    ``most`` ids at most: so the width of a one-hot block is that of the table,
    whatever numbers or words the values are.  Store it before use.
    """
    values = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("token")) for c in categories])
    counts = token_frequency(df.select(F.explode(values).alias("v")).select("v.field", "v.token"), by=["field"])
    rates = {c: rate if rate is not None else 2.0 for c in categories}  # above 1: all of them
    return coverage_vocabulary(counts, rates, by="field").filter(F.col("id") <= most).select("field", "token", "id")


def apply_ids(df: DataFrame, ids: DataFrame, categories: Sequence[str]) -> DataFrame:
    """The categories as dense ids; 0 for a value without one, NULL and blank included."""
    for c in categories:
        text = df.withColumn(c, F.col(c).cast("string"))
        df = encode_token(text, ids.filter(F.col("field") == c), c, c).withColumn(c, F.col(c).cast("int"))
    return df


def wide_stages(categories: Sequence[str], numerics: Sequence[str], out: str = "features") -> list:
    """One-hot ids next to standardized numbers in one vector.

    Category columns hold dense ids (see ``learn_ids``), for the highest id is the width; an id unseen in training gets a
    slot of its own.
    """
    hot = [f"_hot_{c}" for c in categories]
    stages = []
    if categories:
        stages.append(
            OneHotEncoder(inputCols=list(categories), outputCols=hot, dropLast=False, handleInvalid="keep")
        )
    if numerics:
        stages.append(VectorAssembler(inputCols=list(numerics), outputCol="_numbers"))
        stages.append(StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True))
    stages.append(VectorAssembler(inputCols=[*hot, *(["_scaled"] if numerics else [])], outputCol=out))
    return stages


def cross_stage(columns: Sequence[str], out: str = "crossed") -> Interaction:
    """Explicit product features of numeric or vector columns."""
    return Interaction(inputCols=list(columns), outputCol=out)


def fit_linear(df, categories, numerics, label="label", l1: float = 0.0, l2: float = 0.01, steps: int = 50) -> PipelineModel:
    """Logistic regression with elastic-net weights ``l1`` and ``l2``."""
    total = l1 + l2
    learner = LogisticRegression(
        labelCol=label, regParam=total, elasticNetParam=l1 / total if total else 0.0, maxIter=steps
    )
    return Pipeline(stages=[*wide_stages(categories, numerics), learner]).fit(df)


def fit_fm(df, categories, numerics, label="label", factors: int = 4, l2: float = 0.01, steps: int = 50, seed: int = 777):
    """Factorization machine."""
    learner = FMClassifier(
        labelCol=label, factorSize=factors, regParam=l2, maxIter=steps, stepSize=0.05, seed=seed
    )
    return Pipeline(stages=[*wide_stages(categories, numerics), learner]).fit(df)


def fit_mlp(df, categories, numerics, label="label", hidden: Sequence[int] = (8,), steps: int = 50, seed: int = 777):
    """Dense tower; Spark's hidden units are sigmoids, without dropout or batch normalization."""
    prepare = Pipeline(stages=wide_stages(categories, numerics)).fit(df)
    ready = prepare.transform(df)
    width = ready.schema["features"].metadata["ml_attr"]["num_attrs"]
    learner = MultilayerPerceptronClassifier(
        labelCol=label, layers=[width, *hidden, 2], maxIter=steps, seed=seed, blockSize=128
    )
    return PipelineModel(stages=[*prepare.stages, learner.fit(ready)])


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str], out: str = "pred") -> DataFrame:
    """Probability of the positive class."""
    return model.transform(df).select(*keep, F.get(vector_to_array("probability"), F.lit(1)).alias(out))


def ctcvr(df: DataFrame, ctr: str = "pctr", cvr: str = "pcvr", out: str = "pctcvr") -> DataFrame:
    """Probability of click and conversion as the product of both."""
    return df.withColumn(out, F.col(ctr) * F.col(cvr))
