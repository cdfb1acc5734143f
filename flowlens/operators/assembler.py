"""L4 as a stage of a saved pipeline: from flat session features to the vector.

``SessionAssembler`` has no state but its parameters and is saved with Spark
ML's own persistence, so a ``PipelineModel`` of it and a fitted model carries
everything between session features and a score: whoever loads it needs no
assembly of their own, and cannot assemble in another order.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from .matrix import assemble_features


class SessionAssembler(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Appends the model vector (``matrix.assemble_features``)."""

    def __init__(self, outputCol: str = "features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return assemble_features(dataset, self.getOutputCol())


def detector_pipeline(model) -> PipelineModel:
    """A fitted model with the assembly of its inputs in front."""
    return PipelineModel([SessionAssembler(outputCol=model.getFeaturesCol()), model])
