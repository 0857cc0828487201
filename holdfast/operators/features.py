"""Feature projections and fitted preparation as pyspark.ml stages."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.customer import band, collapse, count_yes
from holdfast.functions.numeric import lenient_number
from holdfast.operators.cumulative import column_quantiles
from holdfast.sources.contract import ADDON_COLUMNS, TELCO, Contract

# Feature names in output order.
NUMERIC_FEATURES = [
    "tenure",
    "MonthlyCharges",
    "TotalCharges",
    "SeniorCitizen",
    "num_addon_services",
    "avg_charges_per_month",
    "has_internet",
    "is_automatic_payment",
]
CATEGORICAL_FEATURES = [
    "gender",
    "Partner",
    "Dependents",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
    "tenure_bucket",
]

MAX_LEVELS = 10_000


def with_label(df: DataFrame, contract: Contract = TELCO) -> DataFrame:
    """Replace the target by a 0/1 ``label``."""
    label = (F.col(contract.target) == contract.positive).cast("double").alias("label")
    return df.select(*(c for c in df.columns if c != contract.target), label)


def domain_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw records to 8 numeric and 16 categorical columns, in declared order.

    Stateless and row-wise: the same projection serves training, batch scoring and
    streams. Only the columns in ``keep`` pass through beside the features.
    """
    tenure = F.col("tenure").cast("double")
    months = F.when(tenure < 1, 1.0).otherwise(tenure)
    total = lenient_number(F.col("TotalCharges"))
    automatic = F.coalesce(F.col("PaymentMethod").ilike("%automatic%"), F.lit(False))
    numeric = {
        "tenure": tenure,
        "MonthlyCharges": F.col("MonthlyCharges").cast("double"),
        "TotalCharges": total,
        "SeniorCitizen": F.col("SeniorCitizen").cast("double"),
        "num_addon_services": count_yes(ADDON_COLUMNS).cast("double"),
        "avg_charges_per_month": total / months,
        "has_internet": (~F.col("InternetService").eqNullSafe("No")).cast("double"),
        "is_automatic_payment": automatic.cast("double"),
    }
    collapsed = {c: collapse(F.col(c)) for c in (*ADDON_COLUMNS, "MultipleLines")}
    categorical = {
        **{c: F.col(c) for c in CATEGORICAL_FEATURES if c != "tenure_bucket"},
        **collapsed,
        "tenure_bucket": band(F.col("tenure"), missing="nan"),
    }
    return df.select(
        *keep,
        *(numeric[c].alias(c) for c in NUMERIC_FEATURES),
        *(categorical[c].alias(c) for c in CATEGORICAL_FEATURES),
    )


def coerce_records(df: DataFrame) -> DataFrame:
    """Loosely typed records to the types the record contract expects.

    Charge text that is no number, blanks included, counts as 0.0; flags and months are
    cast to integers and become NULL, hence quarantined, where that is impossible.
    """
    return df.withColumns(
        {
            "TotalCharges": lenient_number(F.col("TotalCharges")),
            "SeniorCitizen": F.col("SeniorCitizen").try_cast("int"),
            "tenure": F.col("tenure").try_cast("int"),
        }
    )


def widen_integers(df: DataFrame) -> DataFrame:
    """Integer columns as doubles, so 12 and 12.0 are the same input to a model."""
    whole = {"tinyint", "smallint", "int", "bigint"}
    return df.select(
        *(F.col(c).cast("double").alias(c) if t in whole else F.col(c) for c, t in df.dtypes)
    )


# ------------------------------------------------------------------ fitted statistics


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, rows) of many categorical columns from one scan and one shuffle."""
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        )
    )
    return (
        df.select(F.explode(pairs).alias("p"))
        .groupBy(F.col("p.column").alias("column"), F.col("p.value").alias("value"))
        .agg(F.count("*").alias("rows"))
    )


def fit_levels(df: DataFrame, columns: Sequence[str], limit: int = MAX_LEVELS) -> dict:
    """``column -> (most frequent value, sorted values)``; the smaller value wins a tie.

    For a column per level, which suits some thousand levels; :mod:`holdfast.operators.levels`
    encodes any number of them.
    """
    found = category_counts(df, columns).where(F.col("value").isNotNull())
    allowed = limit * len(columns)
    rows = found.limit(allowed + 1).collect()
    if len(rows) > allowed:
        raise ValueError("too many values for a column each: use holdfast.operators.levels")
    out = {}
    for c in columns:
        counts = {r["value"]: r["rows"] for r in rows if r["column"] == c}
        mode = min(counts, key=lambda v: (-counts[v], v)) if counts else None
        out[c] = (mode, sorted(counts))
    return out


def numeric_pairs(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, value) rows of many numeric columns."""
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
            for c in columns
        )
    )
    return df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.feature", "p.value")


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact interpolated medians of all columns together, without a per-column sort."""
    return {r["feature"]: r["q0"] for r in column_quantiles(df, columns, [0.5]).collect()}


def fit_moments(df: DataFrame, fills: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation after imputation, one aggregate for all columns."""
    filled = {c: F.coalesce(F.col(c), F.lit(fill)) for c, fill in fills.items()}
    row = df.agg(
        *(F.avg(e).alias(f"m_{c}") for c, e in filled.items()),
        *(F.stddev_pop(e).alias(f"s_{c}") for c, e in filled.items()),
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in fills}


def prepare_statistics(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict:
    """Everything the preparation step learns, as plain values of bounded size."""
    medians = fit_medians(df, numeric)
    fills = {c: medians.get(c, 0.0) for c in numeric}
    moments = fit_moments(df, fills)
    return {
        "numeric": [
            {"name": c, "median": fills[c], "mean": moments[c][0], "scale": moments[c][1] or 1.0}
            for c in numeric
        ],
        "categorical": [
            {"name": c, "mode": mode, "levels": levels}
            for c, (mode, levels) in fit_levels(df, categorical).items()
        ],
    }


def prepared_columns(statistics: dict) -> list[tuple[str, Column]]:
    """(name, expression) of every prepared feature.

    Numeric: median fill, then centre and scale. Categorical: most frequent fill, then
    one column per level; a two-level column keeps only its second level, and a value
    unknown to the fit is zero in all of them.
    """
    out = []
    for s in statistics["numeric"]:
        filled = F.coalesce(F.col(s["name"]).cast("double"), F.lit(s["median"]))
        out.append((s["name"], (filled - F.lit(s["mean"])) / F.lit(s["scale"])))
    for s in statistics["categorical"]:
        levels = s["levels"][1:] if len(s["levels"]) == 2 else s["levels"]
        value = F.coalesce(F.col(s["name"]).cast("string"), F.lit(s["mode"]))
        out += [(f"{s['name']}_{v}", (value == v).cast("double")) for v in levels]
    return out


def dummies(df: DataFrame, columns: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """0/1 columns for every level but the alphabetically first; NULL is zero in all."""
    levels = fit_levels(df, columns)
    return df.select(
        *keep,
        *(
            F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)).alias(f"{c}_{v}")
            for c in columns
            for v in levels[c][1][1:]
        ),
    )


# ------------------------------------------------------------------ pipeline stages


class DomainFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """:func:`domain_features` as a pipeline stage; ``keep`` columns pass if present."""

    keep = Param(Params._dummy(), "keep", "columns to pass through", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, keep: list[str] | None = None):
        super().__init__()
        self._setDefault(keep=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = [c for c in self.getOrDefault(self.keep) if c in dataset.columns]
        return domain_features(dataset, kept)


class _PrepareParams(Params):
    numeric = Param(Params._dummy(), "numeric", "numeric inputs", TypeConverters.toListString)
    categorical = Param(
        Params._dummy(), "categorical", "categorical inputs", TypeConverters.toListString
    )
    keep = Param(Params._dummy(), "keep", "columns to pass through", TypeConverters.toListString)


class Prepare(Estimator, _PrepareParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learn imputation, scaling and encoding; anything not listed is dropped."""

    @keyword_only
    def __init__(
        self,
        *,
        numeric: list[str] | None = None,
        categorical: list[str] | None = None,
        keep: list[str] | None = None,
    ):
        super().__init__()
        self._setDefault(numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES, keep=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PrepareModel:
        learned = prepare_statistics(
            dataset, self.getOrDefault(self.numeric), self.getOrDefault(self.categorical)
        )
        return PrepareModel(
            statistics=json.dumps(learned), keep=list(self.getOrDefault(self.keep))
        )


class PrepareModel(Model, _PrepareParams, DefaultParamsReadable, DefaultParamsWritable):
    statistics = Param(
        Params._dummy(), "statistics", "learned values as JSON", TypeConverters.toString
    )

    @keyword_only
    def __init__(self, *, statistics: str | None = None, keep: list[str] | None = None):
        super().__init__()
        self._setDefault(keep=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.statistics))

    @property
    def feature_names(self) -> list[str]:
        return [name for name, _ in prepared_columns(self.learned)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = [c for c in self.getOrDefault(self.keep) if c in dataset.columns]
        columns = prepared_columns(self.learned)
        return dataset.select(*kept, *(e.alias(name) for name, e in columns))


class Assemble(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """All columns but ``keep`` as one ``features`` vector; the names stay in its metadata."""

    keep = Param(Params._dummy(), "keep", "columns that are no features", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, keep: list[str] | None = None):
        super().__init__()
        self._setDefault(keep=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = [c for c in self.getOrDefault(self.keep) if c in dataset.columns]
        names = [c for c in dataset.columns if c not in kept]
        assembled = VectorAssembler(inputCols=names, outputCol="features").transform(dataset)
        return assembled.select(*kept, "features")


def feature_stages(keep: Sequence[str] = ("customerID", "label")) -> list:
    """Stages from raw records to a features vector."""
    kept = list(keep)
    return [DomainFeatures(keep=kept), Prepare(keep=kept), Assemble(keep=kept)]


def feature_pipeline(keep: Sequence[str] = ("customerID", "label")) -> Pipeline:
    return Pipeline(stages=feature_stages(keep))
