"""Model matrix: feature selection, imputation and vector assembly.

The 1,337 model inputs are 57 scalars and five times 256 byte frequencies,
assembled into one sparse ML vector in one Arrow round trip -- no 1,280
``withColumn`` calls and no schema wide enough to lose whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import impute
from ..functions.text import model_vector, text_flatten
from .text_features import text_features

#: Scalar model inputs in model order: 41 flow/flag/entropy, 6 content-length,
#: then ``<field>_len``, ``<field>_entropy`` per text field.
SCALAR_MODEL_INPUTS = S.NUMERIC_MODEL_FEATURES + [
    name for f in S.TEXT_FIELDS for name in (f"{f}_len", f"{f}_entropy")
]
MODEL_WIDTH = len(SCALAR_MODEL_INPUTS) + S.UNIGRAM_BINS * len(S.TEXT_FIELDS)  # 1,337


def _keys(df: DataFrame) -> list[str]:
    return [c for c in (S.SESSION_ID, S.SCORE) if c in df.columns]


def model_features(features: DataFrame) -> DataFrame:
    """The 52 model columns (47 numeric + 5 text) in model order, plus the
    row key."""
    return features.select(*_keys(features), *S.MODEL_FEATURES)


def impute_features(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL, NaN and +/-inf become 0.0 in every listed numeric column
    (default: the 47 numeric model features), in one projection."""
    cols = cols or S.NUMERIC_MODEL_FEATURES
    return df.withColumns({c: impute(F.col(c)) for c in cols})


def model_inputs(features: DataFrame) -> DataFrame:
    """Model columns with text features added and every scalar imputed."""
    selected = model_features(features)
    with_text = text_features(selected)
    return impute_features(with_text, SCALAR_MODEL_INPUTS)


def assemble_features(features: DataFrame, output: str = "features") -> DataFrame:
    """L4: append one ``VectorUDT`` of the 1,337 inputs in model order.

    Built from the flat session features in a single projection: imputed
    numeric features, then ``len``/``entropy`` per flattened text field, then
    the five 256-bin unigram vectors, as a sparse vector (most bins are zero).
    Every input column is kept, so a model ``transform`` carries the session
    through and no join by position or key is needed afterwards.
    """
    flat = [text_flatten(F.col(f), features.schema[f].dataType) for f in S.TEXT_FIELDS]
    numbers = F.array(*[impute(F.col(c)) for c in S.NUMERIC_MODEL_FEATURES])
    return features.withColumn(output, model_vector(numbers, flat, len(S.NUMERIC_MODEL_FEATURES)))
