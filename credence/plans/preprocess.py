"""F5 (full preprocess), F7 (feature spec) and the parameter bundle.

Order, as in the reference: P5 features -> P9 column check -> F1 median
impute -> P13 categoricals to strings -> F2 standardise -> F3/F4 encode.
Fitting runs three small jobs (medians, scaler, dictionaries); the
transform is one lazy plan with literal parameters and broadcast dictionary
joins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from ..functions.columns import categorical_str
from ..functions.features import build_features
from ..operators.cumulative import exact_percentiles
from ..operators.encode import Dictionary, dictionary_from_distinct, encode, fit_dictionaries
from ..operators.impute import fit_medians, impute
from ..operators.scale import fit_scaler, standardize
from ..session import materialize


def feature_info(extra_features: list[str] | None = None) -> dict:
    """the feature spec record."""
    return {
        "numerical_features": list(spec.NUMERICAL_FEATURES),
        "categorical_features": list(spec.CATEGORICAL_FEATURES),
        "boolean_features": list(spec.BOOLEAN_FEATURES),
        "all_features": list(spec.ALL_FEATURES) + list(extra_features or []),
        "target": spec.TARGET,
    }


FEATURE_INFO_SCHEMA = T.StructType([
    T.StructField("numerical_features", T.ArrayType(T.StringType())),
    T.StructField("categorical_features", T.ArrayType(T.StringType())),
    T.StructField("boolean_features", T.ArrayType(T.StringType())),
    T.StructField("all_features", T.ArrayType(T.StringType())),
    T.StructField("target", T.StringType()),
])


def feature_info_frame(spark: SparkSession, info: dict | None = None) -> DataFrame:
    """F7 as a one-row metadata table."""
    info = info or feature_info()
    return spark.createDataFrame([tuple(info[f.name] for f in FEATURE_INFO_SCHEMA.fields)],
                                 FEATURE_INFO_SCHEMA)


@dataclass
class PrepParams:
    """Fitted preprocessing parameters."""
    medians: dict[str, float | None]
    scaler: dict[str, tuple[float | None, float]]
    dictionary: Dictionary
    info: dict = field(default_factory=feature_info)


def check_columns(df: DataFrame, require_target: bool = True) -> None:
    """Error naming every missing column; error when the label is absent."""
    if require_target and spec.TARGET not in df.columns:
        raise KeyError(f"Target column '{spec.TARGET}' not found.")
    missing = [c for c in spec.NUMERICAL_FEATURES + spec.CATEGORICAL_FEATURES + spec.BOOLEAN_FEATURES
               if c not in df.columns]
    if missing:
        raise KeyError(f"Missing expected columns in data: {missing}")


def _categoricals_to_str(df: DataFrame) -> DataFrame:
    return df.withColumns({c: categorical_str(c) for c in spec.CATEGORICAL_FEATURES})


def output_order(df: DataFrame) -> list[str]:
    """Keys first (kept out of the vector), model features, label last."""
    keys = [c for c in (spec.KEY, spec.TS) if c in df.columns]
    label = [spec.TARGET] if spec.TARGET in df.columns else []
    return keys + list(spec.ALL_FEATURES) + label


def fit_params(featured: DataFrame, median_method: str = "exact") -> PrepParams:
    """Fit medians, scaler and dictionaries on a feature-built frame.

    One scan: every numeric and categorical column is stacked and counted
    per distinct ``(feature, value)``; that table (distinct values, far
    smaller than the data) is checkpointed and feeds all three fits:
    medians by weighted exact percentiles, the scaler as weighted moments of
    the imputed values (shifted by the median for numerical stability), and
    the dictionaries from the distinct categories."""
    if median_method != "exact":
        med = fit_medians(featured, spec.NUMERICAL_FEATURES, median_method)
        imputed = _categoricals_to_str(impute(featured, med))
        scaler = fit_scaler(imputed, spec.NUMERICAL_FEATURES)
        dictionary = Dictionary(fit_dictionaries(imputed, spec.CATEGORICAL_FEATURES))
        return PrepParams(med, scaler, dictionary)

    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("num"),
                        F.lit(None).cast("string").alias("cat")) for c in spec.NUMERICAL_FEATURES]
    entries += [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("num"),
                         categorical_str(c).alias("cat")) for c in spec.CATEGORICAL_FEATURES]
    long = featured.select(F.explode(F.array(*entries)).alias("s")).select("s.*")
    counts = materialize(long.groupBy("feature", "num", "cat").agg(F.count(F.lit(1)).alias("w")))

    numeric = counts.where(F.col("cat").isNull())
    found = {r["feature"]: r["median"] for r in exact_percentiles(
        numeric, "feature", "num", [0.5], ["median"], weight_col="w").collect()}
    med = {c: found.get(c) for c in spec.NUMERICAL_FEATURES}

    known = {c: v for c, v in med.items() if v is not None}
    center = F.create_map(*[x for c, v in known.items() for x in (F.lit(c), F.lit(float(v)))]) \
        if known else F.create_map().cast("map<string,double>")
    d = F.col("num") - F.try_element_at(center, F.col("feature"))   # imputed rows contribute d = 0
    w = F.col("w").cast("double")
    moments = numeric.groupBy("feature").agg(
        F.sum(w).alias("n"), F.sum(w * d).alias("s1"), F.sum(w * d * d).alias("s2")).collect()
    scaler = {}
    for r in moments:
        m = med.get(r["feature"])
        if m is None or r["s1"] is None:
            scaler[r["feature"]] = (None, 1.0)
            continue
        mean_d = r["s1"] / r["n"]
        var = max(r["s2"] / r["n"] - mean_d * mean_d, 0.0)
        std = var ** 0.5
        scaler[r["feature"]] = (m + mean_d, 1.0 if std == 0.0 else std)
    scaler = {c: scaler.get(c, (None, 1.0)) for c in spec.NUMERICAL_FEATURES}

    categories = counts.where(F.col("cat").isNotNull()).select("feature", F.col("cat").alias("category"))
    dictionary = Dictionary(dictionary_from_distinct(categories))
    return PrepParams(med, scaler, dictionary)


def preprocess(df: DataFrame, params: PrepParams | None = None, impute_with: str = "batch",
               median_method: str = "exact", require_target: bool = True, fit_rows=None
               ) -> tuple[DataFrame, PrepParams]:
    """F5. ``params=None`` fits on ``df`` (fit_scalers=True); otherwise the
    stored scaler and dictionaries are applied. Medians are those of the
    batch (``impute_with='batch'``, reference semantics, SURVEY D4) or the
    stored ones (``'stored'``, used by streams).

    ``fit_rows`` (a boolean Column, e.g. ``col('split') == 'train'``) fits
    the parameters on those rows only (SURVEY D5 ``fit_scope='train'``); by
    default they are fitted on the whole batch, as the reference does."""
    featured = build_features(df)
    check_columns(featured, require_target)
    if params is None:
        fit_on = featured if fit_rows is None else featured.where(fit_rows)
        params = fit_params(fit_on, median_method)
        fills = params.medians if fit_rows is None else fit_medians(featured, spec.NUMERICAL_FEATURES,
                                                                     median_method)
    elif impute_with == "stored":
        fills = params.medians
    else:
        fills = fit_medians(featured, spec.NUMERICAL_FEATURES, median_method)
    out = _categoricals_to_str(impute(featured, fills))
    out = standardize(out, params.scaler)
    out = encode(out, params.dictionary, spec.CATEGORICAL_FEATURES)
    return out.select(*output_order(out)), params
