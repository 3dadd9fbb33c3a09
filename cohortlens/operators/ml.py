"""Regression pipelines on Spark MLlib.

The pipeline mirrors the reference's four steps — deterministic features ->
group aggregates -> preprocessor -> model — as ``pyspark.ml`` stages. Fitted
state of the custom stages is a handful of scalars (modes, medians) stored as
Params, or small lookup tables stored as parquet, so ``PipelineModel``
save/load round-trips. The three boosted-tree profiles are configurations of
MLlib's ``GBTRegressor``, not the original libraries.
"""

from __future__ import annotations

import json
import os

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions.features import DeterministicFeatures, map_label
from cohortlens.operators import encode as E
from cohortlens.operators import groupagg as G
from cohortlens.session import cut_lineage, written


# ---------------------------------------------------------------- custom stages
class _Fitted(Params):
    fittedValues = Param(Params._dummy(), "fittedValues", "fitted value per input column",
                         TypeConverters.toListString)


class ModeImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """M1: most-frequent imputation for string columns (ties -> smallest value).

    ``nullPolicy='category'`` keeps nulls as their own category instead (T9)."""

    nullPolicy = Param(Params._dummy(), "nullPolicy", "mode | category", TypeConverters.toString)

    def __init__(self, inputCols: list[str] | None = None, nullPolicy: str = "mode"):
        super().__init__()
        self._setDefault(nullPolicy="mode")
        self._set(inputCols=inputCols or [], nullPolicy=nullPolicy)

    def _fit(self, df: DataFrame) -> "ModeImputerModel":
        cols = self.getInputCols()
        if self.getOrDefault(self.nullPolicy) == "category":
            vals = [K.MISSING_GROUP] * len(cols)
        else:
            m = df.sparkSession.range(1).select(E.fit_modes(df, cols).alias("m")).first()["m"]
            vals = [m[c] if m[c] is not None else K.MISSING_GROUP for c in cols]
        model = ModeImputerModel()
        model._set(inputCols=cols, fittedValues=vals)
        return model


class ModeImputerModel(Model, HasInputCols, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        fill = dict(zip(self.getInputCols(), self.getOrDefault(self.fittedValues)))
        return df.select(*[(F.coalesce(F.col(c).cast("string"), F.lit(fill[c])).alias(c)
                            if c in fill else F.col(c)) for c in df.columns])


class MedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """M2: exact median imputation (not approxQuantile). A column without any value is an
    error, not a silent constant."""

    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        self._set(inputCols=inputCols or [])

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        cols = self.getInputCols()
        m = E.collect_medians(df, cols)
        empty = [c for c in cols if m[c] is None]
        if empty:
            raise ValueError(f"no value to take a median of: {empty}")
        model = MedianImputerModel()
        model._set(inputCols=cols, fittedValues=[repr(float(m[c])) for c in cols])
        return model


class MedianImputerModel(Model, HasInputCols, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        fill = {c: float(v) for c, v in zip(self.getInputCols(),
                                            self.getOrDefault(self.fittedValues))}
        return df.select(*[(F.coalesce(F.col(c).cast("double"), F.lit(fill[c])).alias(c)
                            if c in fill else F.col(c)) for c in df.columns])


MAX_VOCAB_ROWS = 100_000   # proven bound on what CategoricalPrep pulls to the driver


class CategoricalPrep(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """M1 + M4/M5 input in ONE data pass: (column, value) counts give each string
    column's mode (ties -> smallest) and its sorted vocabulary.

    ``transform`` imputes nulls with the mode (or keeps them as a category,
    ``nullPolicy='category'``, T9) and writes ``<col>__idx`` for the indexed
    columns: position in the learned vocabulary, unseen -> len(vocab), with
    nominal ML metadata so ``OneHotEncoder`` needs no extra scan. Vocabularies of
    these low-cardinality roles are small (the same data ``StringIndexer`` keeps)."""

    imputeCols = Param(Params._dummy(), "imputeCols", "columns to impute", TypeConverters.toListString)
    indexCols = Param(Params._dummy(), "indexCols", "columns to index", TypeConverters.toListString)
    ordinalCols = Param(Params._dummy(), "ordinalCols",
                        "indexed columns coded as plain ordinals (unknown -> -1)",
                        TypeConverters.toListString)
    nullPolicy = Param(Params._dummy(), "nullPolicy", "mode | category", TypeConverters.toString)
    fitted = Param(Params._dummy(), "fitted", "json: modes and vocabularies", TypeConverters.toString)

    def __init__(self, imputeCols: list[str] | None = None, indexCols: list[str] | None = None,
                 nullPolicy: str = "mode", ordinalCols: list[str] | None = None):
        super().__init__()
        self._setDefault(nullPolicy="mode", fitted="{}", imputeCols=[], indexCols=[],
                         ordinalCols=[])
        self._set(imputeCols=imputeCols or [], indexCols=indexCols or [], nullPolicy=nullPolicy,
                  ordinalCols=ordinalCols or [])

    def _fit(self, df: DataFrame) -> "CategoricalPrepModel":
        imp, idx = self.getOrDefault(self.imputeCols), self.getOrDefault(self.indexCols)
        cols = list(dict.fromkeys(imp + idx))
        sub = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
        counts = sub.unpivot([], cols, "column", "value").where(F.col("value").isNotNull()) \
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")) \
            .limit(MAX_VOCAB_ROWS + 1).collect()
        if len(counts) > MAX_VOCAB_ROWS:
            raise ValueError(f"categorical vocabularies exceed {MAX_VOCAB_ROWS} values; route "
                             "high-cardinality columns through encode.fit_vocab (join-based)")
        by_col: dict[str, list] = {c: [] for c in cols}
        for r in counts:
            by_col[r["column"]].append((r["value"], r["n"]))
        category = self.getOrDefault(self.nullPolicy) == "category"
        modes = {}
        for c in imp:
            if category or not by_col[c]:
                modes[c] = K.MISSING_GROUP
            else:
                modes[c] = min(by_col[c], key=lambda vn: (-vn[1], vn[0]))[0]
        vocab = {}
        for c in idx:
            vals = {v for v, _ in by_col[c]}
            if c in modes and modes[c] == K.MISSING_GROUP and (category or not vals):
                vals.add(K.MISSING_GROUP)
            vocab[c] = sorted(vals)
        m = CategoricalPrepModel()
        m._set(imputeCols=imp, indexCols=idx, ordinalCols=self.getOrDefault(self.ordinalCols),
               fitted=json.dumps({"modes": modes, "vocab": vocab}, sort_keys=True))
        return m


class CategoricalPrepModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    imputeCols = CategoricalPrep.imputeCols
    indexCols = CategoricalPrep.indexCols
    ordinalCols = CategoricalPrep.ordinalCols
    fitted = CategoricalPrep.fitted

    def __init__(self):
        super().__init__()
        self._setDefault(fitted="{}", imputeCols=[], indexCols=[], ordinalCols=[])

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault(self.fitted))
        modes, vocab = st["modes"], st["vocab"]
        out = [(F.coalesce(F.col(c).cast("string"), F.lit(modes[c])).alias(c) if c in modes
                else F.col(c)) for c in df.columns]
        ordinal = set(self.getOrDefault(self.ordinalCols))
        for c, vals in vocab.items():
            src = F.coalesce(F.col(c).cast("string"), F.lit(modes[c])) if c in modes \
                else F.col(c).cast("string")
            pos = map_label({v: i for i, v in enumerate(vals)}, src)
            if c in ordinal:
                # M4: learned ordinal code, unknown -> -1 (a plain numeric feature)
                out.append(F.coalesce(pos, F.lit(-1)).cast("double").alias(f"{c}__idx"))
                continue
            code = F.coalesce(pos, F.lit(len(vals))).cast("double")
            meta = {"ml_attr": {"type": "nominal", "name": f"{c}__idx",
                                "vals": list(vals) + ["__unknown"]}}
            out.append(code.alias(f"{c}__idx", metadata=meta))
        return df.select(*out)


class OrdinalEncoderExplicit(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """M3: explicit-order ordinal codes (unknown -> -1) into ``<col>_ord``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        orders = {"fami_estratovivienda": K.STRATUM_ORDER,
                  "fami_educacionmadre": K.EDUCATION_ORDER,
                  "fami_educacionpadre": K.EDUCATION_ORDER}
        return df.select("*", *[E.ordinal_explicit(c, o).cast("double").alias(f"{c}_ord")
                                for c, o in orders.items() if c in df.columns])


class GroupAggregatesStage(Estimator, MLReadable, MLWritable):
    """W5/Y2 as a pipeline stage (see ``groupagg.GroupAggregates``)."""

    def _fit(self, df: DataFrame) -> "GroupAggregatesStageModel":
        m, d = G.fit_lookups(df)
        # one row per municipality / department, reused by every later stage: written once to
        # the shared folder, so nothing stays cached after the fit; the five fallbacks become
        # literals, so later plans carry no subqueries. Tables, unlike checkpoints, have a size the
        # planner knows: while that is small the wide rows meet them by broadcast, neither shuffled
        # nor sorted by a key of few values
        m, d = written(m, "mcpio"), written(d, "depto")
        return GroupAggregatesStageModel(m, d, G.collect_fallbacks(m, d))

    def write(self) -> MLWriter:
        return _ParamsOnlyWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ParamsOnlyReader(cls)


class GroupAggregatesStageModel(Model, MLReadable, MLWritable):
    def __init__(self, mcpio_lookup: DataFrame | None = None,
                 depto_lookup: DataFrame | None = None, fallbacks: dict | None = None):
        super().__init__()
        self.mcpio_lookup = mcpio_lookup
        self.depto_lookup = depto_lookup
        self.fallbacks = fallbacks

    def _transform(self, df: DataFrame) -> DataFrame:
        flag = G.TRAIN_FLAG if G.TRAIN_FLAG in df.columns else False
        return G.apply_lookups(df, self.mcpio_lookup, self.depto_lookup, leave_one_out=flag,
                               fallbacks=self.fallbacks)

    def write(self) -> MLWriter:
        return _LookupWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LookupReader(cls)


class _ParamsOnlyWriter(MLWriter):
    def __init__(self, inst):
        super().__init__()
        self.inst = inst

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.inst, path, self.sparkSession)


class _ParamsOnlyReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        return self.cls()


class _LookupWriter(_ParamsOnlyWriter):
    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.inst, path, self.sparkSession,
                                         extraMetadata={"fallbacks": self.inst.fallbacks})
        self.inst.mcpio_lookup.write.mode("overwrite").parquet(os.path.join(path, "mcpio"))
        self.inst.depto_lookup.write.mode("overwrite").parquet(os.path.join(path, "depto"))


class _LookupReader(_ParamsOnlyReader):
    def load(self, path: str):
        spark = SparkSession.getActiveSession()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        return self.cls(spark.read.parquet(os.path.join(path, "mcpio")),
                        spark.read.parquet(os.path.join(path, "depto")), meta.get("fallbacks"))


# ---------------------------------------------------------------- models
# FIXED VALUES: the reference's fixed settings (name, value)
RIDGE_ALPHA = 50.0
LASSO_ALPHA = 50.0
LASSO_MAX_ITER = 2000
TREE_DEPTH = 8
FOREST_TREES = 400
FOREST_DEPTH = 12
BOOSTED_ROUNDS = 400
BOOSTED_DEPTH = 6


def make_model(name: str, params: dict | None = None, label: str = K.TARGET):
    """MLlib learner for a reference model name; params use MLlib names, plus
    ``alpha`` for ridge and lasso (the reference's own penalty).

    The reference's ridge minimises sum of squares + alpha |w|^2; MLlib's half the mean square
    + regParam / (2 s) |w|^2 with s the label's standard deviation: regParam = alpha s / n, set
    when the rows are known (``set_penalty``). Both lassos use half the mean square and |w| in
    label units: regParam = alpha."""
    p = dict(params or {})
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": "prediction"}
    if name == "linear":
        return LinearRegression(regParam=0.0, solver="normal", **common, **p)
    if name == "ridge":
        alpha = p.pop("alpha", RIDGE_ALPHA)
        model = LinearRegression(elasticNetParam=0.0, standardization=False, **common, **p)
        model.ridge_alpha = None if "regParam" in p else alpha
        return model
    if name == "lasso":
        alpha = p.pop("alpha", LASSO_ALPHA)
        return LinearRegression(elasticNetParam=1.0, standardization=False, **common,
                                **{"maxIter": LASSO_MAX_ITER, "regParam": alpha, **p})
    if name == "tree":
        return DecisionTreeRegressor(seed=K.SEED, **common, **{"maxDepth": TREE_DEPTH, **p})
    if name == "forest":
        return RandomForestRegressor(seed=K.SEED, **common, **{
            "numTrees": FOREST_TREES, "maxDepth": FOREST_DEPTH, "featureSubsetStrategy": "all", **p})
    if name in GBT_PROFILES:
        return GBTRegressor(seed=K.SEED, **common, **{**GBT_PROFILES[name], **p})
    raise ValueError(f"unknown model {name!r}")


def label_stats(df: DataFrame, label: str = K.TARGET) -> tuple[int, float]:
    r = df.agg(F.count(F.lit(1)), F.stddev_pop(label)).first()
    return r[0], r[1] or 0.0


def set_penalty(model, n_rows: int, label_std: float):
    """Ridge penalty for the rows of this fit (all other learners stay as they are)."""
    if getattr(model, "ridge_alpha", None) is not None:
        model.setRegParam(model.ridge_alpha * label_std / max(n_rows, 1))
    return model


# Boosted trees: MLlib GBTRegressor settings standing in for gradient boosting and the three
# booster libraries. Rounds and depth default to the reference's; a caller that wants fewer
# rounds passes maxIter, which its result records.
GBT_PROFILES: dict[str, dict] = {
    "gbt_plain": {"maxIter": BOOSTED_ROUNDS, "maxDepth": BOOSTED_DEPTH, "stepSize": 0.1},
    "gbt_profile_a": {"maxIter": BOOSTED_ROUNDS, "maxDepth": BOOSTED_DEPTH, "stepSize": 0.1, "subsamplingRate": 0.8,
                      "minInstancesPerNode": 20},
    "gbt_profile_b": {"maxIter": BOOSTED_ROUNDS, "maxDepth": BOOSTED_DEPTH, "stepSize": 0.1, "subsamplingRate": 0.75,
                      "minInstancesPerNode": 20, "featureSubsetStrategy": "0.7"},
    "gbt_profile_c": {"maxIter": BOOSTED_ROUNDS, "maxDepth": BOOSTED_DEPTH, "stepSize": 0.1},
}

LINEAR = {"linear", "ridge", "lasso"}


def make_scaler() -> StandardScaler:
    return StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)


def feature_columns() -> dict[str, list[str]]:
    return {
        "ordinal": [f"{c}_ord" for c in K.ORDINAL_COLS],
        "binary": list(K.BINARY_COLS),
        "nominal": list(K.NOMINAL_LOW_COLS),
        "numeric": list(K.NUMERIC_COLS),
    }


def build_pipeline(model_name: str, params: dict | None = None, columns: list[str] | None = None,
                   null_policy: str = "mode") -> Pipeline:
    """Deterministic -> group aggregates -> preprocessor -> model.

    ``columns``: input columns present (roles absent from the input are skipped).
    """
    cols = set(columns or [])
    present = (lambda xs: [c for c in xs if c in cols]) if columns else (lambda xs: list(xs))
    fc = feature_columns()
    det_out = set(K.DETERMINISTIC_NUMERIC_COLS)
    ordinal_src = present(K.ORDINAL_COLS)
    binary = present(fc["binary"])
    nominal = present(fc["nominal"])
    numeric = [c for c in fc["numeric"] if c in det_out or c in K.GROUP_NUMERIC_COLS]
    stages = [DeterministicFeatures(), GroupAggregatesStage(),
              CategoricalPrep(imputeCols=ordinal_src + binary + nominal,
                              indexCols=binary + nominal, ordinalCols=binary,
                              nullPolicy=null_policy),
              OrdinalEncoderExplicit(),
              MedianImputer(inputCols=numeric)]
    oh_out = [f"{c}__oh" for c in nominal]
    stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in nominal], outputCols=oh_out,
                                dropLast=True))
    assembled = [f"{c}_ord" for c in ordinal_src] + [f"{c}__idx" for c in binary] + oh_out + numeric
    stages.append(VectorAssembler(inputCols=assembled, outputCol="raw_features",
                                  handleInvalid="keep"))
    model = make_model(model_name, params)
    if model_name in LINEAR:
        stages.append(make_scaler())
    else:
        model.setFeaturesCol("raw_features")
    stages.append(model)
    return Pipeline(stages=stages)


BASELINE_NUMERIC = ["capital_tecnologico"]


def baseline_rows(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    """M11 input: the categorical columns present, one numeric feature and the target, with
    incomplete rows dropped once, before any split: every model sees the same rows."""
    cats = [c for c in K.ORDINAL_COLS + K.BINARY_COLS + K.NOMINAL_LOW_COLS if c in df.columns]
    out = DeterministicFeatures().transform(df)
    keep = ["estu_consecutivo", *cats, *BASELINE_NUMERIC, target]
    # written first: the filter is over plain columns, not over every column's expression
    return cut_lineage(out.select(*keep)).na.drop(subset=[*cats, *BASELINE_NUMERIC, target])


def build_baseline_pipeline(model_name: str, params: dict | None = None, columns: list[str] | None = None) -> Pipeline:
    """The EDA baseline encoder over ``baseline_rows``: one-hot of the categorical columns
    (unknown -> zero vector), the numeric feature as it is."""
    cats = [c for c in K.ORDINAL_COLS + K.BINARY_COLS + K.NOMINAL_LOW_COLS if columns is None or c in columns]
    prep = CategoricalPrep(imputeCols=[], indexCols=cats, nullPolicy="category")
    oh = OneHotEncoder(inputCols=[f"{c}__idx" for c in cats], outputCols=[f"{c}__oh" for c in cats], dropLast=True)
    asm = VectorAssembler(inputCols=[f"{c}__oh" for c in cats] + BASELINE_NUMERIC, outputCol="features")
    return Pipeline(stages=[prep, oh, asm, make_model(model_name, params)])


def fit_stages(stages: list, data: DataFrame) -> tuple[list, DataFrame, list[DataFrame]]:
    """Fit stages in order (as ``Pipeline.fit`` does) and return (fitted stages,
    transformed frame, persisted frames to release). The frame right after the
    group-aggregate join is persisted, so later estimators do not each re-run
    the lookup joins."""
    held: list[DataFrame] = []
    cur, fitted = data, []
    for st in stages:
        m = st.fit(cur) if isinstance(st, Estimator) else st
        fitted.append(m)
        cur = m.transform(cur)
        if isinstance(m, GroupAggregatesStageModel):
            cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(cur)
    return fitted, cur, held


def fit_train(pipeline: Pipeline, train: DataFrame, cut: bool = True) -> PipelineModel:
    """Fit with leave-one-out group features on the training rows only (Hard 1).

    The training frame is checkpointed once into the shared checkpoint folder, unless it
    is a filter of a frame that is (``cut=False``): then it is read from there, not copied.
    The preprocessing stages are fitted with ``fit_stages`` (one lookup join per
    fit) and the learner — which may make many passes — reads a persisted
    (features, label) frame, alone: the rows behind it are released before. A lost cached
    block is recomputed from the reliable checkpoint, not from the source joins. Persisted
    frames are released after."""
    stages = pipeline.getStages()
    learner = stages[-1]
    data = train.withColumn(G.TRAIN_FLAG, F.lit(True))
    if cut:
        data = cut_lineage(data)
    fitted, cur, held = fit_stages(stages[:-1], data)
    try:
        fc, lc = learner.getFeaturesCol(), learner.getLabelCol()
        feats = cur.select(fc, F.col(lc).cast("double").alias(lc)) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        held.append(feats)
        feats.count()
        while len(held) > 1:
            held.pop(0).unpersist()
        if getattr(learner, "ridge_alpha", None) is not None:
            set_penalty(learner, *label_stats(feats, lc))
        return PipelineModel(fitted + [learner.fit(feats)])
    finally:
        for h in held:
            h.unpersist()


def predict(model, df: DataFrame, label: str = K.TARGET, id_col: str = "estu_consecutivo",
            keep: list[str] | None = None) -> DataFrame:
    """Batch predictions as (id, y_true, y_pred, keep...)."""
    out = model.transform(df.drop(G.TRAIN_FLAG) if G.TRAIN_FLAG in df.columns else df)
    extra = [c for c in (keep or []) if c in out.columns]
    return out.select(id_col, F.col(label).cast("double").alias("y_true"),
                      F.col("prediction").alias("y_pred"), *extra)
