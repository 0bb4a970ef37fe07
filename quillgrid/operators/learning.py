"""Line features and layout classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODELS = {"rf": RandomForestClassifier, "gbt": GBTClassifier, "dt": DecisionTreeClassifier, "lr": LogisticRegression, "nb": NaiveBayes, "svc": LinearSVC}


def line_features(boxes: DataFrame, by: str = "image_id") -> DataFrame:
    """Span, mean and population deviation of horizontal (orient H) and vertical (V) line boxes, their number and lengths."""
    out = []
    for name, orient, length in (("horiz", "H", F.col("x_max") - F.col("x_min")), ("vert", "V", F.col("y_max") - F.col("y_min"))):
        only = lambda c, o=orient: F.when(F.col("orient") == o, c)
        for side in ("x_min", "x_max", "y_min", "y_max"):
            out.append((F.min if side.endswith("min") else F.max)(only(F.col(side))).cast("double").alias(f"{name}_span_{side}"))
            out.append(F.avg(only(F.col(side))).alias(f"{name}_line_{side}_mean"))
            out.append(F.stddev_pop(only(F.col(side))).alias(f"{name}_line_{side}_std"))
        out.append(F.avg(only(length)).alias(f"avg_{name}_line_length"))
        out.append(F.stddev_pop(only(length)).alias(f"std_{name}_line_length"))
        out.append(F.count(only(F.lit(1))).cast("double").alias(f"{name}_char_count"))
    return boxes.groupBy(by).agg(*out)


def balanced(rows: DataFrame, label: str, per_class: int, seed: int = 123) -> DataFrame:
    """About per_class rows of each class, seeded."""
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    return rows.sampleBy(label, {k: min(1.0, per_class / n) for k, n in counts.items()}, seed)


def train(rows: DataFrame, features: Sequence[str], label: str = "y", model: str = "rf", seed: int = 123) -> tuple[PipelineModel, DataFrame]:
    """Mean imputing, then a classifier; 70 percent learn, the rest comes back scored."""
    learn, rest = rows.randomSplit([0.7, 0.3], seed)
    kind = MODELS[model](labelCol=label, featuresCol="features", **({"seed": seed} if model in ("rf", "gbt", "dt") else {}))
    filled = [f"{c}_" for c in features]
    fitted = Pipeline(stages=[Imputer(inputCols=list(features), outputCols=filled), VectorAssembler(inputCols=filled, outputCol="features"), kind]).fit(learn)
    return fitted, predict(fitted, rest)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds pred and confidence, the probability of what was predicted."""
    out = model.transform(rows)
    p = vector_to_array("probability") if "probability" in out.columns else F.array(F.lit(1.0), F.lit(1.0))
    return out.withColumn("pred", F.col("prediction").cast("int")).withColumn("confidence", F.get(p, F.col("prediction").cast("int")))
