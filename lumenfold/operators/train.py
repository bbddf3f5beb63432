"""Learners, presets, tuned fits, out-of-fold predictions, importance, blends and leaderboards."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lumenfold.functions.hashing import hash_share
from lumenfold.functions.skew import lookup_join
from lumenfold.operators import features as E, trees as TR
from lumenfold.operators.confidence import Calibration, calibrate_classes, calibrate_regression, with_confidence, with_quantiles
from lumenfold.operators.joins import apply_encoding
from lumenfold.operators.metrics import (ASCENDING, DEFAULT_METRIC, binary_metrics, multiclass_metrics, problem_metrics, regression_metrics, top_class)
from lumenfold.operators.profile import numeric_columns, string_columns
from lumenfold.operators.roles import ColumnRoles, assign_folds, split_holdout
from lumenfold.session import cut_lineage

# Model codes by tier, profiles, and the presets (profile, advanced, normal, simple, features, blend).
ADVANCED = ["LGB", "XGB", "NN", "ET", "LR", "RF", "CB"]
NORMAL = ["LGB", "XGB", "NN", "ET", "LR", "RF", "NBC", "CB"]
SIMPLE = ["DT", "LR"]
PROFILES = ["quick", "normal", "advanced"]
NO_AXES = [m for m in E.MODULES if m not in ("pca", "kmean")]
PRESETS = {
    "base": ("normal", ADVANCED, NORMAL, SIMPLE, NO_AXES, True),
    "quick": ("quick", [m for m in ADVANCED if m != "NN"], [m for m in NORMAL if m != "NN"], ["DT"], NO_AXES, False),
    "ultra": ("quick", ["XGB"], ["XGB"], ["LR"], NO_AXES, False),
    "nano": ("quick", ["LR"], ["LR"], [], [], False),
}
TREE_CODES = ("XGB", "LGB", "CB", "ET")
GRID_SIZE = {"quick": 1, "normal": 4, "advanced": 12}
SEED, MAX_FOLDS = 7, 50


@dataclass(frozen=True)
class TrainingConfig:
    """What to fit: profile, models per tier, feature modules, blending, and a cap on the number of features."""

    profile: str = "quick"
    advanced: Sequence[str] = ("XGB", "LR")
    normal: Sequence[str] = ("XGB", "LR")
    simple: Sequence[str] = ()
    features: Sequence[str] = tuple(E.DEFAULT_MODULES)
    with_blend: bool = False
    features_kept: int | None = None

    def __post_init__(self):
        for name, given, known in (("advanced", self.advanced, ADVANCED), ("normal", self.normal, NORMAL),
                                   ("simple", self.simple, SIMPLE), ("features", self.features, E.MODULES),
                                   ("profile", [self.profile], PROFILES)):
            unknown = [g for g in given if g not in known]
            if unknown:
                raise ValueError(f"unknown {name}: {unknown}")

    @classmethod
    def preset(cls, name: str) -> "TrainingConfig":
        return cls(*PRESETS[name])


def learner(code: str, problem: str, n_features: int, n_classes: int = 2, weight: str | None = None):
    """Spark estimator for a model code; boosted and extra trees are those of operators.trees."""
    regress = problem == "regression"
    if code == "LR":
        out = LinearRegression(regParam=1e-3) if regress else LogisticRegression(
            regParam=1e-3, family="binomial" if n_classes == 2 else "multinomial")
    elif code == "DT":
        out = (DecisionTreeRegressor if regress else DecisionTreeClassifier)(maxDepth=5, seed=SEED)
    elif code == "RF":
        out = (RandomForestRegressor if regress else RandomForestClassifier)(numTrees=20, maxDepth=5, seed=SEED)
    elif code == "NN" and not regress:
        return MultilayerPerceptronClassifier(layers=[n_features, 8, n_classes], maxIter=40, seed=SEED)
    else:
        raise ValueError(f"no learner {code} for {problem}")
    return out.setWeightCol(weight) if weight else out


def param_grid(estimator, code: str, profile: str):
    """1, 4 or 12 settings depending on the profile."""
    size = GRID_SIZE[profile]
    grid = ParamGridBuilder()
    if size == 1:
        return grid.build()
    if code == "LR":
        grid = grid.addGrid(estimator.regParam, [1e-3, 1e-1]).addGrid(estimator.elasticNetParam, [0.0, 0.5])
        extra = (estimator.maxIter, [20, 50, 100])
    elif code == "NN":
        first, _, last = estimator.getLayers()
        grid = grid.addGrid(estimator.layers, [[first, 8, last], [first, 16, last]]).addGrid(estimator.maxIter, [40, 80])
        extra = (estimator.tol, [1e-6, 1e-4, 1e-3])
    else:
        grid = grid.addGrid(estimator.maxDepth, [4, 7]).addGrid(estimator.minInstancesPerNode, [1, 10])
        extra = (estimator.maxBins, [16, 32, 64])
    return (grid.addGrid(*extra) if size == 12 else grid).build()


def tree_grid(code: str, profile: str) -> list[dict]:
    """1, 4 or 12 settings of the tree learners."""
    if GRID_SIZE[profile] == 1:
        return [{}]
    most = GRID_SIZE[profile] == 12
    if code == "ET":
        axes = {"depth": [3, 4, 6, 7] if most else [4, 7], "trees": [10, 20, 30] if most else [10, 30]}
    else:
        axes = {"leaves": [8, 16]} if code == "LGB" else {"depth": [3, 5]}
        axes |= {"step": [0.1, 0.3], **({"rounds": [8, 12, 20]} if most else {})}
    return [dict(zip(axes, values)) for values in product(*axes.values())]


# --- encoding a table into one vector -----------------------------------------------------------------------------

@dataclass
class Encoder:
    """Fitted feature modules of one training table: lookups for string columns, calendar parts, counts, products, vectors of texts
    and of all numbers. Text columns are left to the text modules if one is chosen."""

    roles: ColumnRoles
    modules: Sequence[str]
    numeric: list[str]
    strings: list[str]
    dates: list[str]
    frequency: dict[str, DataFrame] = field(default_factory=dict)
    target: dict[str, DataFrame] = field(default_factory=dict)
    target_mean: float = 0.0
    inputs: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    vectors: list[E.VectorColumns] = field(default_factory=list)

    def _common(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        out, names = df.fillna(0.0, subset=self.numeric), list(self.numeric)
        if "Counter" in self.modules:
            out = E.counter(out, self.numeric, [*self.strings, *self.texts])
            names += ["n_null", "n_zero", "n_negative", "n_positive", "n_empty", "n_filled"]
        for c in self.dates if "Date" in self.modules else []:
            parts = [f"{c}_{p}" for p in ("year", "month", "weekday", "yearday")]
            out = E.date_features(out, c).fillna(0, subset=parts).withColumn(f"{c}_missing", F.col(c).isNull().cast("double"))
            names += [*parts, f"{c}_missing"]
        if "poly" in self.modules:
            out = E.polynomial(out, self.numeric)
            names += [n for n in out.columns if "_x_" in n and n not in df.columns]
        for v in self.vectors:
            out = v.apply(out)
            names += v.names
        for c, m in self.frequency.items():
            out = apply_encoding(out, m, c, f"{c}_freq", 0.0)
            names.append(f"{c}_freq")
        return out, names

    def train(self, df: DataFrame) -> DataFrame:
        out, names = self._common(df)
        if self.target:
            out = assign_folds(out, 5, [self.roles.id], self.roles.fold, "_tenc_fold")
            for c in self.target:
                out = E.target_encode_train(out, c, "_y", "_tenc_fold")
                names.append(f"{c}_tenc")
        self.inputs = self.inputs or names
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        out, _ = self._common(df)
        for c, m in self.target.items():
            out = apply_encoding(out, m, c, f"{c}_tenc", self.target_mean)
        return out


def fit_encoder(df: DataFrame, roles: ColumnRoles, modules: Sequence[str]) -> Encoder:
    """Fit the chosen modules; df carries the numeric target as _y."""
    used = [c for c in roles.features(df.columns) if not c.startswith("_")]
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    enc = Encoder(roles, modules, [c for c in numeric_columns(df) if c in used], [c for c in string_columns(df) if c in used],
                  [c for c in dates if c in used or c == roles.time])
    if any(m in E.TEXT_MODULES for m in modules):
        enc.texts = E.text_columns(df, enc.strings)
        enc.strings = [c for c in enc.strings if c not in enc.texts]
        enc.vectors = [E.fit_text_columns(df, c, m) for m in modules if m in E.TEXT_MODULES for c in enc.texts]
    if enc.numeric:
        filled = df.fillna(0.0, subset=enc.numeric)
        enc.vectors += [v for m in modules if m in E.AXIS_MODULES for v in [E.fit_axis_columns(filled, enc.numeric, m)] if v is not None]
    if "freq" in modules:
        enc.frequency = {c: cut_lineage(E.frequency_map(df, c)) for c in enc.strings}
    if "tenc" in modules and enc.strings:
        enc.target = {c: cut_lineage(E.target_map(df, c, "_y")) for c in enc.strings}
        enc.target_mean = float(df.agg(F.avg("_y")).first()[0])
    return enc


@dataclass
class FittedModel:
    """A fitted model with everything needed to score a raw table."""

    name: str
    code: str
    problem: str
    roles: ColumnRoles
    encoder: Encoder
    stages: PipelineModel
    classes: list[str]
    params: dict
    fit_seconds: float
    calibration: Calibration | None = None

    def score_encoded(self, encoded: DataFrame) -> DataFrame:
        out = self.stages.transform(encoded)
        if self.problem != "regression":
            if "_p" not in out.columns:
                out = out.withColumn("_p", vector_to_array("probability"))
            total = F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)
            for i, c in enumerate(self.classes):
                out = out.withColumn(f"pred_{c}", F.col("_p")[i] / total)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """One output row per input row: the input columns plus prediction (and pred_<class>)."""
        out = self.score_encoded(self.encoder.apply(df))
        if self.problem == "regression":
            return out.select(*df.columns, "prediction")
        label = F.element_at(F.array(*[F.lit(c) for c in self.classes]), F.col("prediction").cast("int") + 1)
        return out.select(*df.columns, label.alias("prediction"), *[f"pred_{c}" for c in self.classes])

    def with_confidence(self, df: DataFrame) -> DataFrame:
        """transform, with <target>_quantile=q columns (regression) or confidence and credibility (classes)."""
        if self.calibration is None:
            raise ValueError("the model was fitted without calibration")
        scored = self.transform(df)
        if self.problem == "regression":
            return with_quantiles(scored, self.calibration, self.roles.target)
        return with_confidence(scored, self.calibration, {c: f"pred_{c}" for c in self.classes})


def calibrate(model: FittedModel, train: DataFrame, modules: Sequence[str], k: int = 5) -> FittedModel:
    """The model with the calibration of an out-of-fold table of its own learner and settings."""
    oof = cut_lineage(cross_validation(train, model.roles, model.problem, model.code, k, modules))
    if model.problem == "regression":
        model.calibration = calibrate_regression(oof, model.roles.target)
    else:
        model.calibration = calibrate_classes(oof, model.roles.target, {c: f"pred_{c}" for c in model.classes})
    return model


def _target_classes(df: DataFrame, roles: ColumnRoles, problem: str) -> list[str]:
    if problem == "regression":
        return []
    rows = df.select(F.col(roles.target).cast("string").alias("c")).where(F.col("c").isNotNull()).distinct().collect()
    classes = sorted(r["c"] for r in rows)
    if len(classes) < 2:
        raise ValueError("the target needs two classes or more")
    if problem == "classification" and len(classes) != 2:
        raise ValueError("classification needs two classes")
    return classes


def with_label(df: DataFrame, roles: ColumnRoles, classes: Sequence[str]) -> DataFrame:
    """Add _y: the numeric target, or the class number."""
    t = F.col(roles.target)
    y = t.cast("double") if not classes else F.coalesce(*[F.when(t.cast("string") == c, float(i)) for i, c in enumerate(classes)])
    return df.withColumn("_y", y).where(F.col("_y").isNotNull())


def _search_folds(df: DataFrame, roles: ColumnRoles) -> tuple[DataFrame, int]:
    """df with _cv_fold numbered from 0, and the number of folds: the user's folds (NULL is one of them), else three by key hash."""
    if roles.fold:
        values = sorted((r[0] for r in df.select(roles.fold).distinct().collect()), key=lambda v: (v is not None, v))
        if len(values) > 1:
            number = F.coalesce(*[F.when(F.col(roles.fold).eqNullSafe(F.lit(v)), i) for i, v in enumerate(values)])
            return df.withColumn("_cv_fold", number), len(values)
    return assign_folds(df, 3, [roles.id], None, "_cv_fold"), 3


def by_weight(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Rows repeated in proportion to their weight, about as many as before: for learners without weights. The remainder of a
    weight decides by the row's hash whether one more copy is made."""
    ratio = F.coalesce(F.col(roles.weight).cast("double"), F.lit(0.0)) / df.agg(F.avg(roles.weight)).first()[0]
    copies = F.floor(ratio) + (hash_share(roles.id, salt="weight") < ratio - F.floor(ratio)).cast("long")
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).drop("_copy")


def _search_trees(encoded: DataFrame, roles: ColumnRoles, problem: str, profile: str, given: dict) -> dict:
    """The setting of least mean squared error (of numbers) or log loss (of classes) over the folds; one aggregate a fold and setting."""
    folded, folds = _search_folds(encoded, roles)
    folded = cut_lineage(folded)
    losses = []
    for settings in tree_grid(given["code"], profile):
        total = 0.0
        for f in range(folds):
            stage = TR.fit_trees(folded.where(F.col("_cv_fold") != f), **given, **settings)
            scored = stage.transform(folded.where(F.col("_cv_fold") == f))
            loss = (F.pow(F.col("prediction") - F.col("_y"), 2) if problem == "regression"
                    else -F.ln(F.greatest(F.col("_p")[F.col("_y").cast("int")], F.lit(1e-15))))
            total += scored.agg(F.avg(loss)).first()[0] or 0.0
        losses.append((total, len(losses), settings))
    return min(losses)[2]


def fit_model(train: DataFrame, roles: ColumnRoles, problem: str, code: str, modules: Sequence[str] = ("freq", "Date"),
              profile: str | None = None, encoder: Encoder | None = None, encoded: DataFrame | None = None,
              name: str | None = None, cap: int | None = None, confidence: bool = False) -> FittedModel:
    """Fit one model. A profile searches its grid by cross-validation over key-hash folds; None takes the defaults.

    With confidence, the model also keeps what its out-of-fold scores say about its errors.
    """
    if confidence:
        return calibrate(fit_model(train, roles, problem, code, modules, profile, encoder, encoded, name, cap), train, modules)
    start = time.time()
    roles.check(train.columns)
    classes = _target_classes(train, roles, problem)
    if encoder is None:
        labelled = with_label(train, roles, classes)
        encoder = fit_encoder(labelled, roles, modules)
        encoded = encoder.train(labelled)
        if cap is not None:
            keep = E.select_features(encoded, "_y", encoder.inputs, n=cap).collect()
            encoder.inputs = sorted(r["feature"] for r in keep)
    grid = GRID_SIZE[profile] if profile else 1
    if code in TREE_CODES:
        given = dict(inputs=encoder.inputs, code=code, problem=problem, n_classes=len(classes), weight=roles.weight, strings=encoder.strings, order=[roles.id])
        params = {} if grid == 1 else _search_trees(encoded, roles, problem, profile, given)
        return FittedModel(name or code, code, problem, roles, encoder, TR.fit_trees(encoded, **given, **params), classes, params, time.time() - start)
    est = learner(code, problem, len(encoder.inputs), max(2, len(classes)), None if code == "NN" else roles.weight)
    est = est.setLabelCol("_y").setFeaturesCol("_features")
    if code == "NN" and roles.weight:
        encoded = by_weight(encoded, roles)
    steps = [VectorAssembler(inputCols=encoder.inputs, outputCol="_raw", handleInvalid="keep"),
             StandardScaler(inputCol="_raw", outputCol="_features", withMean=True)]
    pipe = Pipeline(stages=[*steps, est])
    if grid == 1:
        fitted, params = pipe.fit(encoded), {}
    else:
        folded, folds = _search_folds(encoded, roles)
        folded = cut_lineage(folded)  # read by every fold and setting
        judge = (RegressionEvaluator(labelCol="_y") if problem == "regression" else
                 BinaryClassificationEvaluator(labelCol="_y") if len(classes) == 2 else
                 MulticlassClassificationEvaluator(labelCol="_y", metricName="logLoss"))
        search = CrossValidator(estimator=pipe, estimatorParamMaps=param_grid(est, code, profile), evaluator=judge,
                                numFolds=folds, parallelism=4, foldCol="_cv_fold", seed=SEED)
        found = search.fit(folded)
        fitted = found.bestModel
        best = min(range(len(found.avgMetrics)), key=lambda i: found.avgMetrics[i] * (-1 if judge.isLargerBetter() else 1))
        params = {p.name: v for p, v in search.getEstimatorParamMaps()[best].items()}
    return FittedModel(name or code, code, problem, roles, encoder, fitted, classes, params, time.time() - start)


@dataclass
class NaiveBayesModel:
    """Categorical naive Bayes over the string columns, fitted once."""

    counts: BayesCounts
    problem: str
    roles: ColumnRoles
    fit_seconds: float = 0.0
    params: dict = field(default_factory=dict)

    @property
    def classes(self) -> list[str]:
        return self.counts.classes

    @classmethod
    def fit(cls, train: DataFrame, problem: str, roles: ColumnRoles, columns: Sequence[str]) -> NaiveBayesModel:
        start = time.time()
        counts = fit_naive_bayes(train, roles.target, columns, roles.weight)
        return cls(counts, problem, roles, time.time() - start)

    def transform(self, df: DataFrame) -> DataFrame:
        scored = df.join(score_naive_bayes(self.counts, df, self.roles.id), self.roles.id)
        label = F.element_at(F.array(*[F.lit(c) for c in self.classes]), F.array_position("probabilities", F.array_max("probabilities")).cast("int"))
        return scored.select(*df.columns, label.alias("prediction"), *[F.col("probabilities")[i].alias(f"pred_{c}") for i, c in enumerate(self.classes)])


def problem_metric(scored: DataFrame, roles: ColumnRoles, problem: str, classes: Sequence[str], metric: str) -> float:
    """One metric of a scored table."""
    if problem == "regression":
        return float(regression_metrics(scored, roles.target, "prediction", weight=roles.weight, names=[metric]).first()[0])
    if problem == "classification":
        rows = scored.withColumn("_hit", F.col(roles.target).cast("string") == classes[1])
        return float(binary_metrics(rows, "_hit", f"pred_{classes[1]}", weight=roles.weight, names=[metric]).first()[0])
    probs = {c: F.col(f"pred_{c}") for c in classes}
    return float(multiclass_metrics(scored, roles.target, probs, weight=roles.weight, names=[metric]).first()[0])


def cross_validation(df: DataFrame, roles: ColumnRoles, problem: str, code: str, k: int = 5,
                     modules: Sequence[str] = ("freq", "Date")) -> DataFrame:
    """Out-of-fold table: every row scored by a model that did not see its fold; encoders are fitted per fold too.

    The table is stored once. One model is fitted for each fold, so a column of folds may hold MAX_FOLDS values at most.
    """
    folded = cut_lineage(assign_folds(df, k, [roles.id], roles.fold, "fold"))  # every fold's model reads it several times
    inner = ColumnRoles(**{**roles.__dict__, "fold": "fold"})
    values = sorted((r[0] for r in folded.select("fold").distinct().limit(MAX_FOLDS + 1).collect()), key=lambda v: (v is not None, v))
    if len(values) > MAX_FOLDS:
        raise ValueError(f"more than {MAX_FOLDS} folds")
    classes, parts = _target_classes(df, roles, problem), []
    for f in values:
        held = F.col("fold").eqNullSafe(F.lit(f))  # rows without a fold are a fold of their own
        rest = folded.where(~held)
        if code == "NBC":
            model = NaiveBayesModel.fit(rest, problem, inner, [c for c in string_columns(df) if c in roles.features(df.columns)])
        else:
            model = fit_model(rest, inner, problem, code, modules)
        scored = model.transform(folded.where(held))
        # a class that the other folds lack has probability 0
        missing = {f"pred_{c}": F.lit(0.0) for c in classes if f"pred_{c}" not in scored.columns}
        parts.append(scored.withColumns(missing).select(*folded.columns, "prediction", *[f"pred_{c}" for c in classes]))
    return reduce(DataFrame.unionByName, parts)


def feature_importance(model: FittedModel, df: DataFrame | None = None, metric: str | None = None) -> DataFrame:
    """(feature, importance), largest first: tree importance, |standardised coefficient|, else loss without the feature."""
    core = model.stages.stages[-1]
    names = model.encoder.inputs
    if hasattr(core, "featureImportances"):
        values = core.featureImportances.toArray().tolist()
    elif hasattr(core, "coefficientMatrix"):
        values = abs(core.coefficientMatrix.toArray()).mean(axis=0).tolist()
    elif hasattr(core, "coefficients"):
        values = abs(core.coefficients.toArray()).tolist()
    elif df is not None:
        return neutral_importance(model, df, metric or DEFAULT_METRIC[model.problem])
    else:
        raise ValueError("this model needs a table to measure importance")
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(names, [float(v) for v in values])), "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature")


def neutral_importance(model: FittedModel, df: DataFrame, metric: str) -> DataFrame:
    """Loss of the metric when a feature is held at its mean: its information is gone and no row has to move."""
    encoded = cut_lineage(model.encoder.apply(df))
    base = problem_metric(model.score_encoded(encoded), model.roles, model.problem, model.classes, metric)
    sign = 1 if metric in ASCENDING else -1
    rows = []
    for f in model.encoder.inputs:
        flat = encoded.withColumn(f, encoded.select(F.avg(f)).scalar())
        loss = problem_metric(model.score_encoded(flat), model.roles, model.problem, model.classes, metric)
        rows.append((f, sign * (loss - base)))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def blend(predictions: dict[str, DataFrame], scores: dict[str, float], key: str, value: str, top: int = 3,
          smaller_is_better: bool = True) -> DataFrame:
    """Mean prediction of the best models by score."""
    order = sorted(predictions, key=lambda n: (scores[n] if smaller_is_better else -scores[n], n))[:top]
    out = predictions[order[0]].select(key, F.col(value).alias("_b0"))
    for i, name in enumerate(order[1:], 1):
        out = out.join(predictions[name].select(key, F.col(value).alias(f"_b{i}")), key)
    mean = sum((F.col(f"_b{i}") for i in range(1, len(order))), F.col("_b0")) / len(order)
    return out.select(key, mean.alias(value))


@dataclass
class BlendModel:
    """Weighted mean of fitted models."""

    members: dict[str, object]
    weights: dict[str, float]
    problem: str
    roles: ColumnRoles
    classes: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """One output row per input row; the members' columns are added one after the other, so their scores never have to be joined."""
        values = ["prediction"] if self.problem == "regression" else [f"pred_{c}" for c in self.classes]
        out, used = df, [(n, w) for n, w in self.weights.items() if w > 0]
        for i, (name, _) in enumerate(used):
            out = self.members[name].transform(out)
            out = out.withColumnsRenamed({v: f"_b{i}_{j}" for j, v in enumerate(values)}).drop(*(["prediction"] if self.classes else []))
        means = {v: sum((w * F.col(f"_b{i}_{j}") for i, (_, w) in enumerate(used)), F.lit(0.0)) for j, v in enumerate(values)}
        if self.classes:
            return out.withColumns(means).select(*df.columns, top_class({c: F.col(f"pred_{c}") for c in self.classes}).alias("prediction"), *values)
        return out.select(*df.columns, means["prediction"].alias("prediction"))


def blend_weights(oof: dict[str, DataFrame], roles: ColumnRoles, problem: str, classes: Sequence[str], rounds: int = 20) -> dict[str, float]:
    """Greedy selection with replacement over the out-of-fold scores: shares of the models whose mean has the least squared error.

    One aggregate gives all products of scores and truth; from it the error of any mean of models follows, so the choice
    itself reads no row.
    """
    names = sorted(oof)
    values = ["prediction"] if problem == "regression" else [f"pred_{c}" for c in classes]
    weight = F.lit(1.0) if roles.weight is None else F.col(roles.weight).cast("double")
    wide = None
    for i, n in enumerate(names):
        extra = [] if i else [F.col(roles.target).alias("_t"), weight.alias("_w")]
        one = oof[n].select(roles.id, *extra, *[F.col(f"`{v}`").alias(f"_v{i}_{j}") for j, v in enumerate(values)])
        wide = one if wide is None else wide.join(one, roles.id)
    truth = [F.col("_t").cast("double")] if problem == "regression" else [(F.col("_t").cast("string") == c).cast("double") for c in classes]
    wide = wide.withColumns({f"_v{len(names)}_{j}": t for j, t in enumerate(truth)})
    size = len(names) + 1
    cells = [(a, b) for a in range(size) for b in range(a + 1)]
    row = wide.agg(*[F.sum(F.col("_w") * sum((F.col(f"_v{a}_{j}") * F.col(f"_v{b}_{j}") for j in range(len(values))), F.lit(0.0))).alias(f"g{a}_{b}")
                     for a, b in cells]).first()
    gram = [[float(row[f"g{max(a, b)}_{min(a, b)}"] or 0.0) for b in range(size)] for a in range(size)]

    def error(counts):
        x = [c / sum(counts) for c in counts] + [-1.0]
        return sum(x[a] * x[b] * gram[a][b] for a in range(size) for b in range(size))

    counts, least = [0] * len(names), math.inf
    for _ in range(rounds):
        tries = [(error([c + (i == j) for j, c in enumerate(counts)]), i) for i in range(len(names))]
        if min(tries)[0] >= least:
            break
        least, best = min(tries)
        counts[best] += 1
    return {n: c / sum(counts) for n, c in zip(names, counts)}


class Models(dict):
    """Fitted models by name, and their blend if there is one."""

    blend: BlendModel | None = None


LEADERBOARD = ("name string, code string, tier string, metric string, score double, params map<string,string>, "
               "fit_seconds double, predict_seconds double, tags array<string>")


def fit_experiment(df: DataFrame, roles: ColumnRoles, problem: str, config: TrainingConfig = TrainingConfig(),
                   metric: str | None = None, holdout_share: float = 0.2) -> tuple[DataFrame, dict[str, FittedModel]]:
    """Fit every model of the configuration; (leaderboard, models). The features are encoded once for all models; a blend is models.blend."""
    metric = metric or DEFAULT_METRIC[problem]
    train, holdout = split_holdout(df, holdout_share, [roles.id])
    train, holdout = cut_lineage(train), cut_lineage(holdout)
    classes = _target_classes(train, roles, problem)
    labelled = with_label(train, roles, classes)
    modules = list(config.features)
    encoder = fit_encoder(labelled, roles, modules)
    encoded = cut_lineage(encoder.train(labelled))
    if config.features_kept:
        keep = E.select_features(encoded, "_y", encoder.inputs, n=config.features_kept).collect()
        encoder.inputs = sorted(r["feature"] for r in keep)
    ready = cut_lineage(encoder.apply(holdout))
    plans = [(c, "simple", None) for c in config.simple] + [(c, "normal", None) for c in config.normal] \
        + [(c, "advanced", config.profile) for c in config.advanced]
    models, rows = Models(), []
    for code, tier, profile in plans:
        if code in ("NBC", "NN") and problem == "regression" or code == "NBC" and not encoder.strings:
            continue  # classifiers only; naive Bayes needs a category
        name, start = f"{code}-{tier}", time.time()
        if code == "NBC":
            model = NaiveBayesModel.fit(train, problem, roles, encoder.strings)
            fit_seconds, start = model.fit_seconds, time.time()
            scored = model.transform(holdout)
        else:
            model = fit_model(train, roles, problem, code, modules, profile, encoder, encoded, name)
            fit_seconds, start = model.fit_seconds, time.time()
            scored = model.score_encoded(ready)
        score = problem_metric(scored, roles, problem, classes, metric)
        rows.append([name, code, tier, metric, score, {k: str(v) for k, v in model.params.items()}, fit_seconds,
                     time.time() - start])
        models[name] = model
    if config.with_blend and len(models) > 1:
        # members and shares come from out-of-fold scores of the training rows; the holdout only judges
        start = time.time()
        codes = {name: name.split("-")[0] for name in models}
        tables = {code: cut_lineage(cross_validation(train, roles, problem, code, 3, modules)) for code in sorted(set(codes.values()))}
        weights = blend_weights({name: tables[code] for name, code in codes.items()}, roles, problem, classes)
        model = BlendModel(dict(models), weights, problem, roles, classes)
        fit_seconds, start = time.time() - start, time.time()
        score = problem_metric(model.transform(holdout), roles, problem, classes, metric)
        rows.append(["blend", "blend", "blend", metric, score, {k: str(w) for k, w in weights.items()}, fit_seconds, time.time() - start])
        models.blend = model
    sign = 1 if metric in ASCENDING else -1
    best = min(rows, key=lambda r: sign * r[4])[0]
    fastest = min(rows, key=lambda r: r[7])[0]
    lines = [(*r, [t for t, n in (("best", best), ("fastest", fastest)) if n == r[0]]) for r in rows]
    return df.sparkSession.createDataFrame(lines, LEADERBOARD), models


def fit_regression(df, roles, config=TrainingConfig(), metric="rmse"):
    return fit_experiment(df, roles, "regression", config, metric)


def fit_classification(df, roles, config=TrainingConfig(), metric="auc"):
    return fit_experiment(df, roles, "classification", config, metric)


def fit_multiclassification(df, roles, config=TrainingConfig(), metric="log_loss"):
    return fit_experiment(df, roles, "multiclassification", config, metric)


def fit_images(df: DataFrame, images: DataFrame, roles: ColumnRoles, problem: str, config=TrainingConfig(features=("Counter",)),
               metric: str | None = None):
    """Table rows joined to the measures of their image (columns of features.image_features), then a normal fit."""
    measures = E.image_features(images).select(
        F.col("filename").alias(roles.filename), "width", "height", "channels", "bytes",
        *[F.try_element_at("channel_mean", F.lit(i + 1)).alias(f"mean_{i}") for i in range(3)],
        *[F.try_element_at("channel_std", F.lit(i + 1)).alias(f"std_{i}") for i in range(3)])
    return fit_experiment(df.join(measures, roles.filename), roles, problem, config, metric)


# --- models stated in SQL terms -----------------------------------------------------------------------------------

def linear_fit(df: DataFrame, x: str, y: str, weight: str | None = None) -> DataFrame:
    """(slope, intercept) of a one-feature least-squares line by the linear regression learner."""
    ready = VectorAssembler(inputCols=[x], outputCol="_f").transform(df)
    est = LinearRegression(featuresCol="_f", labelCol=y, solver="normal")
    model = (est.setWeightCol(weight) if weight else est).fit(ready)
    return df.sparkSession.createDataFrame([(float(model.coefficients[0]), float(model.intercept))],
                                           "slope double, intercept double")


@dataclass
class BayesCounts:
    """The counts of a categorical naive Bayes: classes with their rows, and per column a table (value, seen) with the rows of
    the value in each class it occurs in, and the number of values. Classes are never columns."""

    classes: list[str]
    rows: list[float]
    columns: list[str]
    tables: list[DataFrame]
    kinds: list[int]


def fit_naive_bayes(train: DataFrame, target: str, columns: Sequence[str], weight: str | None = None) -> BayesCounts:
    """One long aggregate (column, value, class, rows); a weight column makes rows count by their weight."""
    cells = F.array(*[F.struct(F.lit(j).alias("j"), F.col(c).cast("string").alias("value")) for j, c in enumerate(columns)])
    one = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    long = cut_lineage(train.where(F.col(target).isNotNull()).select(F.col(target).cast("string").alias("class"), one.alias("w"), F.explode(cells).alias("e"))
                       .groupBy("e.j", "e.value", "class").agg(F.sum("w").alias("n")))
    total = {r["class"]: r["n"] for r in long.where("j = 0").groupBy("class").agg(F.sum("n").alias("n")).collect()}  # as many as output columns
    seen = cut_lineage(long.groupBy("j", "value").agg(F.map_from_entries(F.collect_list(F.struct("class", "n"))).alias("seen")))
    kinds = {r["j"]: r["n"] for r in seen.groupBy("j").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(total)
    return BayesCounts(classes, [total[c] for c in classes], list(columns), [seen.where(F.col("j") == j).drop("j") for j in range(len(columns))],
                       [kinds.get(j, 0) for j in range(len(columns))])


def score_naive_bayes(counts: BayesCounts, df: DataFrame, row_id: str) -> DataFrame:
    """(id, probabilities in the order of the classes) with Laplace 1; one lookup per column, no row blow-up."""
    classes, n = F.array(*[F.lit(c) for c in counts.classes]), sum(counts.rows)
    keys = df.select(row_id, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_k{j}") for j, c in enumerate(counts.columns)],
                     *[F.col(c).isNull().alias(f"_n{j}") for j, c in enumerate(counts.columns)])
    logs = F.array(*[F.lit(math.log(r / n)) for r in counts.rows])
    for j, (seen, kinds) in enumerate(zip(counts.tables, counts.kinds)):
        look = seen.select(F.coalesce("value", F.lit("")).alias(f"_k{j}"), F.col("value").isNull().alias(f"_n{j}"), F.col("seen").alias(f"_s{j}"))
        keys = lookup_join(keys, look, [f"_k{j}", f"_n{j}"])
        unseen = F.array(*[F.lit(-math.log(r + kinds)) for r in counts.rows])
        found = F.transform(classes, lambda c: F.ln(1 + F.coalesce(F.try_element_at(F.col(f"_s{j}"), c), F.lit(0.0))))
        logs = F.zip_with(F.zip_with(logs, unseen, lambda a, b: a + b), found, lambda a, b: a + b)
    top = keys.select(row_id, logs.alias("_l")).select(row_id, F.transform("_l", lambda x: F.exp(x - F.array_max("_l"))).alias("_o"))
    total = F.aggregate("_o", F.lit(0.0), lambda a, x: a + x)
    return top.select(row_id, F.transform("_o", lambda x: x / total).alias("probabilities"))


def naive_bayes(train: DataFrame, df: DataFrame, target: str, columns: Sequence[str], row_id: str, weight: str | None = None) -> DataFrame:
    """(id, pred_<class>): categorical naive Bayes."""
    counts = fit_naive_bayes(train, target, columns, weight)
    return score_naive_bayes(counts, df, row_id).select(row_id, *[F.col("probabilities")[i].alias(f"pred_{c}") for i, c in enumerate(counts.classes)])


# --- models from outside ------------------------------------------------------------------------------------------

def score_external_onnx(df: DataFrame, model: bytes, inputs: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """Score a table with a user's ONNX model: one session per task, batches of rows; adds the output columns."""
    missing = [c for c in inputs if c not in df.columns]
    if missing:
        raise ValueError(f"the model needs columns {missing}")
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*df.schema.fields, *[T.StructField(o, T.DoubleType()) for o in outputs]])

    def run(batches):
        import numpy as np
        import onnxruntime
        session = onnxruntime.InferenceSession(shared.value, providers=["CPUExecutionProvider"])
        name = session.get_inputs()[0].name
        for b in batches:
            result = np.asarray(session.run(None, {name: b[list(inputs)].to_numpy(dtype=np.float32)})[-1])
            yield b.assign(**{o: result.reshape(len(b), -1)[:, i].astype(float) for i, o in enumerate(outputs)})
    return df.mapInPandas(run, schema)


def evaluate_external(holdout: DataFrame, predictions: dict[str, DataFrame], key: str, target: str, value: str | dict[str, str],
                      problem: str = "regression", metrics: Sequence[str] | None = None) -> DataFrame:
    """Metrics of supplied predictions, one row per model. value: the column of a prediction or probability, or one column for each class."""
    if not predictions:
        raise ValueError("at least one model is required")
    classes = list(value) if isinstance(value, dict) else [""]
    columns = [value[c] if isinstance(value, dict) else value for c in classes]
    rows = None
    for name, table in predictions.items():
        one = table.select(key, *[F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(columns)]).withColumn("model", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    joined = rows.join(holdout.select(key, target), key)
    scores = {c: f"_p{i}" for i, c in enumerate(classes)} if isinstance(value, dict) else "_p0"
    return problem_metrics(joined, target, scores, problem, ["model"], metrics)
