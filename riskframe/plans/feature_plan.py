"""FeaturePlan: the column routing decided once on training data, then frozen.

Fitting is one schema walk plus one skewness aggregate; the plan is saved with
the model so scoring never re-derives it.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..features.transformers import (CountBinarizer, CreditHistoryCalculator, EmpLengthConverter,
                                     OrdinalLevelEncoder, SkewedNumericScaler,
                                     StandardNumericScaler, feature_names_out, one_hot_stages)
from ..operators.clean import column_kind
from ..schema import COUNT_BINARY_COLUMNS, NON_FEATURE_COLUMNS, ORDINAL_COLUMNS, PLAN_SKEW_THRESHOLD

FEATURES_COL = "features"


@dataclass
class FeaturePlan:
    raw_inputs: list[str] = field(default_factory=list)
    skewed: list[str] = field(default_factory=list)
    standard: list[str] = field(default_factory=list)
    ordinal: list[str] = field(default_factory=list)
    one_hot: list[str] = field(default_factory=list)
    skew: dict = field(default_factory=dict)
    use_issue_date: bool = True

    # --- persistence (small JSON, written through Spark so any shared FS works) --
    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, s: str) -> "FeaturePlan":
        return cls(**json.loads(s))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1) \
            .write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeaturePlan":
        return cls.from_json(spark.read.text(path).first()["value"])

    # --- routing table --------------------------------------------------------
    def groups(self) -> list[tuple[str, str]]:
        return ([(c, "skewed") for c in self.skewed] + [(c, "standard") for c in self.standard]
                + [(c, "ordinal") for c in self.ordinal] + [(c, "one_hot") for c in self.one_hot])

    def engineering_stages(self) -> list:
        return [EmpLengthConverter(), CreditHistoryCalculator(), CountBinarizer()]

    def preprocessing_stages(self) -> list:
        stages: list = []
        if self.skewed:
            stages.append(SkewedNumericScaler(inputCols=self.skewed))
        if self.standard:
            stages.append(StandardNumericScaler(inputCols=self.standard))
        if self.ordinal:
            stages.append(OrdinalLevelEncoder(inputCols=self.ordinal))
        stages += one_hot_stages(self.one_hot)
        assembled = self.skewed + self.standard + self.ordinal + [f"{c}__ohe" for c in self.one_hot]
        stages.append(VectorAssembler(inputCols=assembled, outputCol=FEATURES_COL,
                                      handleInvalid="keep"))
        return stages


def feature_columns(df: DataFrame, use_issue_date: bool = True,
                    exclude=NON_FEATURE_COLUMNS) -> list[str]:
    """X: every column except label/status/split helpers (P9); ``issue_d`` kept by default (Q1)."""
    drop = set(exclude) | ({"issue_d"} if not use_issue_date else set()) | {"side", "label", "id"}
    return [c for c in df.columns if c not in drop]


def fit_plan(train: DataFrame, use_issue_date: bool = True,
             skew_threshold: float = PLAN_SKEW_THRESHOLD) -> FeaturePlan:
    """Route post-engineering columns into skewed / standard / ordinal / one-hot.

    Skew is the population g1 of the *original* numeric columns; new numeric
    features (emp_length_num, credit_hist_years, *_binary) always go to standard.
    """
    x_cols = feature_columns(train, use_issue_date)
    plan = FeaturePlan(raw_inputs=x_cols, use_issue_date=use_issue_date)
    post = feature_names_out(plan.engineering_stages(), x_cols)
    kinds = {f.name: column_kind(f.dataType) for f in train.schema.fields}
    # An engineered column is routed only if what it is made from is there: a count's flag
    # needs the count, the history needs both dates.
    binary = {f"{c}_binary" for c in COUNT_BINARY_COLUMNS if c in x_cols}
    new_numeric = binary | ({"emp_length_num"} if "emp_length" in x_cols else set())
    if {"issue_d", "earliest_cr_line"} <= set(x_cols):
        new_numeric.add("credit_hist_years")
    numeric = [c for c in post if c in new_numeric or (kinds.get(c) == "numeric")]
    categorical = [c for c in post if kinds.get(c) == "categorical" and c not in new_numeric]
    orig_numeric = [c for c in x_cols if kinds.get(c) == "numeric"]
    skew: dict = {}
    if orig_numeric:
        from ..operators.profile import skew_partition
        skew = {r["column"]: r["skew"] for r in skew_partition(train, orig_numeric).collect()}
    plan.skewed = [c for c in numeric if c not in binary and skew.get(c) is not None
                   and abs(skew[c]) > skew_threshold]
    plan.standard = [c for c in numeric if c not in plan.skewed]
    plan.ordinal = [c for c in ORDINAL_COLUMNS if c in categorical]
    plan.one_hot = [c for c in categorical if c not in plan.ordinal]
    plan.skew = {c: v for c, v in skew.items()}
    return plan


def plan_frame(spark: SparkSession, plan: FeaturePlan) -> DataFrame:
    """(column, group, position) routing table of a plan."""
    rows = [(c, g, i) for i, (c, g) in enumerate(plan.groups())]
    return spark.createDataFrame(rows, "column string, group string, position int")
