import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlens import schema as S
from flowlens.functions.text import byte_counts, text_entropy, text_flatten
from flowlens.operators import matrix as mx
from flowlens.operators import text_features as tf
from flowlens.operators.features import session_features
from flowlens.operators.scoring import load_model, score_sessions, train_forest
from flowlens.plans.detect import detect_alerts

from .helpers import session_row, sessions_df

T0 = 1_700_000_000_000


def _rows(n=240):
    """Sessions that send more than they receive are the positive ones."""
    out = []
    for i in range(n):
        up = i % 2
        out.append(
            session_row(i, src=f"10.0.0.{i % 3}", dst=f"d{i % 4}", start=T0 + i * 1000, transmitted_packets=50 + i if up else 3,
                        received_packets=4 if up else 60 + i, user_agent=["curl é", "", None, "Mozilla/5.0"][i % 4], score=0.0)
        )
    return out


@pytest.fixture(scope="module")
def features(spark):
    feats = session_features(sessions_df(spark, _rows()))
    return feats.withColumn("label", (F.col("Total_Fwd_Packets") > F.col("Total_Backward_Packets")).cast("int"))


def test_the_sparse_vector_is_the_dense_one(features):
    """Against the columns it is made of, one by one."""
    vec = mx.assemble_features(features).select(S.SESSION_ID, F.col("features"), vector_to_array("features").alias("v"))
    got = {r[S.SESSION_ID]: (r["features"], r["v"]) for r in vec.collect()}
    flat = mx.impute_features(tf.flatten_text_fields(features))
    cols = [*S.NUMERIC_MODEL_FEATURES, *[c for f in S.TEXT_FIELDS for c in (F.length(f), text_entropy(F.col(f)))], *[byte_counts(F.col(f)) for f in S.TEXT_FIELDS]]
    n = len(S.NUMERIC_MODEL_FEATURES) + 2 * len(S.TEXT_FIELDS)
    for r in flat.select(S.SESSION_ID, *cols).collect():
        want = [float(x) for x in r[1 : n + 1]]
        for counts in r[n + 1 :]:
            total = max(1, sum(counts))
            want += [float(np.float32(c / total)) for c in counts]
        sparse, dense = got[r[0]]
        assert len(dense) == mx.MODEL_WIDTH and np.allclose(dense, want, rtol=1e-12, atol=0)
        assert len(sparse.indices) < 250


def test_train_save_load_score_detect(spark, features, workdir):
    model = train_forest(features.filter(F.col(S.SESSION_ID) % 5 != 0), num_trees=5, max_depth=4, feature_subset="onethird")
    model.write().overwrite().save(f"{workdir}/m")
    loaded = load_model(spark, f"{workdir}/m")
    rows = lambda m: sorted(map(tuple, score_sessions(features, m).select(S.SESSION_ID, "label", "prediction", S.SCORE).collect()))
    scored = rows(loaded)
    assert scored == rows(model)
    held = [r for r in scored if r[0] % 5 == 0]
    assert held and all(r[1] == r[2] and (r[3] > 0.5) == bool(r[2]) for r in held)
    alerts = detect_alerts(sessions_df(spark, _rows()), model=loaded).collect()
    assert alerts and all(r["score"] > 0.8 for r in alerts)


def test_training_rows_are_bounded(features):
    model = train_forest(features, num_trees=2, max_depth=2, max_rows=60)
    assert model.numFeatures == mx.MODEL_WIDTH


def test_load_model_names_a_wrong_kind(spark, features, workdir):
    from pyspark.ml.feature import Binarizer

    Binarizer(inputCol="a", outputCol="b").save(f"{workdir}/b")
    with pytest.raises(ValueError, match="Binarizer"):
        load_model(spark, f"{workdir}/b")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load_model(spark, f"{workdir}/none")


def test_unigram_wide_is_the_long_form(features):
    wide = tf.unigram_wide(features).collect()
    long = {(r[S.SESSION_ID], r["field"], r["byte_value"]): r["frequency"] for r in tf.unigram_long(features).collect()}
    seen = 0
    for r in wide:
        for f in S.TEXT_FIELDS:
            for i in range(S.UNIGRAM_BINS):
                v = r[f"{f}_u{i}"]
                assert abs(v - long.get((r[S.SESSION_ID], f, i), 0.0)) < 1e-6
                seen += v > 0
    assert seen == len(long)


def test_flatten_of_a_null_is_an_empty_text(spark):
    df = spark.createDataFrame([(None,), ("x",)], "t string").select(text_flatten(F.col("t")).alias("t"))
    assert [r["t"] for r in df.collect()] == ["", "x"]


def test_a_saved_pipeline_assembles_and_scores_the_same(spark, features, workdir):
    """L1/L4: the loaded pipeline takes flat features; direct scoring, with
    the assembly outside, gives the same scores."""
    from pyspark.ml import PipelineModel

    from flowlens.operators.assembler import SessionAssembler, detector_pipeline

    labelled = features.withColumn("label", (F.col("Total_Fwd_Packets") > F.col("Total_Backward_Packets")).cast("int"))
    forest = train_forest(labelled, num_trees=3, max_depth=3)
    detector_pipeline(forest).write().overwrite().save(f"{workdir}/p")
    loaded = load_model(spark, f"{workdir}/p")
    assert isinstance(loaded, PipelineModel) and isinstance(loaded.stages[0], SessionAssembler)
    rows = lambda df: sorted(map(tuple, df.select(S.SESSION_ID, "prediction", S.SCORE).collect()))
    want = rows(score_sessions(features, forest))
    assert rows(score_sessions(features, loaded)) == want and len(want) > 0
    raw = loaded.transform(features.drop(S.SCORE))
    assert "features" in raw.columns and raw.count() == len(want)


def test_training_rows_are_dealt_evenly(features, monkeypatch):
    from flowlens.operators import scoring

    sizes = []

    def kept(df, name):
        sizes.extend(n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
        return staged(df, name)

    staged = scoring.staged
    monkeypatch.setattr(scoring, "staged", kept)
    monkeypatch.setattr(scoring, "TASK_ROWS", 20)
    train_forest(features.coalesce(1), num_trees=2, max_depth=2)
    assert len(sizes) == -(-sum(sizes) // 20) > 1
    assert max(sizes) <= 30
