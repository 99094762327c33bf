"""Persisted scoring surface.

``Scorer.save`` writes the Spark ML ``PipelineModel`` and the frozen
FeaturePlan side by side; ``Scorer.load`` restores both; ``Scorer.score``
checks the required raw columns up front and appends ``probability`` and
``prediction`` to the caller's id columns. Scoring is a stateless projection,
so the same Scorer works on a batch or a streaming DataFrame.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .model import predict
from .plans.feature_plan import FeaturePlan


class MissingFeatures(ValueError):
    """Raised when raw inputs the model needs are absent."""


class Scorer:
    def __init__(self, model: PipelineModel, plan: FeaturePlan):
        self.model = model
        self.plan = plan

    @staticmethod
    def _paths(path: str) -> tuple[str, str]:
        return os.path.join(path, "pipeline"), os.path.join(path, "plan")

    def save(self, path: str) -> None:
        m, p = self._paths(path)
        self.model.write().overwrite().save(m)
        self.plan.save(SparkSession.getActiveSession(), p)

    @classmethod
    def load(cls, path: str, spark: SparkSession | None = None) -> "Scorer":
        spark = spark or SparkSession.getActiveSession()
        m, p = cls._paths(path)
        try:
            model = PipelineModel.load(m)
            plan = FeaturePlan.load(spark, p)
        except Exception as e:  # Spark reports a missing path by several exception types
            if not any(x in str(e) for x in ("PATH_NOT_FOUND", "does not exist", "No such file",
                                             "InvalidInputException")):
                raise
            raise FileNotFoundError(f"no model artifact under {path}: {e}") from e
        return cls(model, plan)

    def required_columns(self) -> list[str]:
        return list(self.plan.raw_inputs)

    def check(self, df: DataFrame) -> None:
        missing = [c for c in self.required_columns() if c not in df.columns]
        if missing:
            raise MissingFeatures(f"missing raw feature columns: {missing}")

    def score(self, df, threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
        """Input id columns + probability + prediction.

        ``df`` is a DataFrame (batch or streaming) or a list of raw application
        dicts (typed with the raw schema; absent keys become NULL).
        """
        if isinstance(df, list):
            from .sources.loans import records_to_table
            df = records_to_table(SparkSession.getActiveSession(), df)
        elif not isinstance(df, DataFrame):
            raise TypeError("input must be a DataFrame or a list of dicts")
        self.check(df)
        keep = keep if keep is not None else [c for c in ("id",) if c in df.columns]
        return predict(self.model, df, threshold, keep)
