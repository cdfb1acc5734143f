"""Scoring with a Spark ML model (L1-L5) and the score threshold.

The scorer is any fitted Spark ML model whose ``transform`` yields a
``probability`` vector; ``malicious_score`` is the class-1 probability.  The
original detector shipped no model and no training code, so
``train_forest`` fits a random forest on labels supplied by the caller; the
fixture's labels come from a stated rule and say nothing about detection
quality.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..config import staged
from .assembler import SessionAssembler
from .matrix import assemble_features


def score_filter(scored: DataFrame, threshold: float = S.DEFAULT_THRESHOLD) -> DataFrame:
    """Keep sessions whose ``malicious_score`` is strictly above
    ``threshold``."""
    return scored.filter(F.col(S.SCORE) > F.lit(float(threshold)))


#: The most labelled rows that a forest is fitted to.
TRAINING_ROWS = 200_000
#: Training rows in a task, about.
TASK_ROWS = 5_000


def train_forest(
    features: DataFrame,
    label_col: str = "label",
    num_trees: int = 20,
    max_depth: int = 6,
    seed: int = 42,
    max_rows: int = TRAINING_ROWS,
    feature_subset: str = "auto",
) -> RandomForestClassificationModel:
    """Fit a random forest on the assembled 1,337-wide feature vector.

    ``features`` is the output of ``session_features`` plus a 0/1 label
    column.  At most about ``max_rows`` labelled rows are used, chosen by a
    hash of the session id, so what training keeps in memory is bounded
    however large the input.  Training is distributed by Spark ML
    (per-partition statistics, tree-level aggregation); nothing is collected
    to the driver.
    """
    labelled = features.filter(F.col(label_col).isNotNull())
    count = labelled.count()
    share = min(1.0, max_rows / max(1, count))
    chosen = labelled if share == 1.0 else labelled.filter(F.pmod(F.xxhash64(S.SESSION_ID), F.lit(1 << 30)) < int(share * (1 << 30)))
    inputs = assemble_features(chosen).select("features", F.col(label_col).cast("double").alias(label_col))
    rf = RandomForestClassifier(
        featuresCol="features",
        labelCol=label_col,
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        featureSubsetStrategy=feature_subset,
    )
    # The forest makes several passes (metadata, split finding, binning) over
    # the bounded, sparse matrix; written once, it is neither derived again
    # nor lost with an executor.
    # Dealt evenly: the forest keeps 1,337 whole numbers of each row.
    parts = max(1, -(-min(count, max_rows) // TASK_ROWS))
    model = rf.fit(staged(inputs.repartition(parts), "training"))
    # The training summary holds the session, which cannot be shipped to
    # executors once an observation was used in it; scoring needs no summary.
    model._java_obj.setSummary(features.sparkSession._jvm.scala.Option.empty())
    return model


def load_model(spark: SparkSession, path: str):
    """L1: load a fitted model: a ``PipelineModel`` or a single forest,
    whichever the saved metadata names."""
    kind = json.loads(spark.read.text(f"{path}/metadata").first()[0])["class"].rsplit(".", 1)[-1]
    kinds = {c.__name__: c for c in (PipelineModel, RandomForestClassificationModel)}
    if kind not in kinds:
        raise ValueError(f"{path} holds a {kind}, not one of {', '.join(kinds)}")
    return kinds[kind].load(path)


def score_sessions(features: DataFrame, model) -> DataFrame:
    """L2-L3: attach ``prediction`` (class at 0.5) and ``malicious_score``
    (class-1 probability) to every session in one pass: the assembled vector
    rides along the session's own columns, so nothing is re-aligned by row
    position.  Model inputs are imputed (±inf/NaN/NULL -> 0) first.  A pipeline
    that begins with a ``SessionAssembler`` does that itself."""
    stages = getattr(model, "stages", [model])
    if not any(s.hasParam("probabilityCol") for s in stages):
        raise ValueError("the scorer must produce class probabilities")
    base = features.drop(S.SCORE) if S.SCORE in features.columns else features
    assembles = any(isinstance(s, SessionAssembler) for s in stages)
    out = model.transform(base if assembles else assemble_features(base))
    return out.select(
        *[F.col(c) for c in base.columns],
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias(S.SCORE),
    )
