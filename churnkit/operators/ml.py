"""Model training, tuning, scoring and model-based importance as Spark ML jobs.

These replace the hosted AutoML service calls.  Training data stays
distributed (``pyspark.ml`` estimators); the driver only loops over a small
grid of pipelines, parameter maps, folds or features, and collects metric
rows.  Splits are hash based (``sampling``), so every run sees the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StructType

from churnkit.functions.scalar import col_, unit_hash
from churnkit.operators import trees
from churnkit.operators.histogram import METRICS, add, columns, empty, metrics, score_edges
from churnkit.operators.metrics import present, weighted_binary_metrics
from churnkit.operators.packed import SCHEMA, merge_tree, packed, unpacked
from churnkit.operators.sampling import group_fold
from churnkit.operators.scorer import scorer
from churnkit.operators.splits import duration_masks, duration_windows, fold_masks, in_window
from churnkit.operators.util import materialize, run_all

FEATS = "features"


def estimator(kind: str, label: str, weight: str | None = None, **params):
    """``lr`` (elastic net logistic regression), ``rf`` or ``gbt``."""
    common = {"featuresCol": FEATS, "labelCol": label}
    if weight:
        common["weightCol"] = weight
    if kind == "lr":
        return LogisticRegression(maxIter=params.pop("maxIter", 30), **common, **params)
    if kind == "rf":
        return RandomForestClassifier(numTrees=params.pop("numTrees", 20), maxDepth=params.pop("maxDepth", 5),
                                      seed=params.pop("seed", 7), **common, **params)
    if kind == "gbt":
        return GBTClassifier(maxIter=params.pop("maxIter", 10), maxDepth=params.pop("maxDepth", 3),
                             seed=params.pop("seed", 7), **common, **params)
    raise ValueError(f"unknown model kind {kind}")


def preparation(features: Sequence[str], schema: StructType) -> list:
    """Stages that turn raw columns into the feature vector without losing a
    row: numbers with 0 for missing (null or NaN), then an indicator of
    missing for each, then one-hot categories of the other columns, in which
    missing and unseen values have places of their own."""
    numeric = [f for f in features if isinstance(schema[f].dataType, (NumericType, BooleanType))]
    other = [f for f in features if f not in numeric]
    quoted = {f: f"`{f}`" for f in features}
    value = [f"nvl(nanvl(CAST({quoted[f]} AS DOUBLE), NULL), 0D) AS _value{i}" for i, f in enumerate(numeric)]
    missing = [f"CAST(nanvl(CAST({quoted[f]} AS DOUBLE), NULL) IS NULL AS DOUBLE) AS _missing{i}" for i, f in enumerate(numeric)]
    text = [f"nvl(concat('=', CAST({quoted[f]} AS STRING)), 'missing') AS _text{i}" for i, f in enumerate(other)]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join([*value, *missing, *text])} FROM __THIS__")]
    inputs = [f"_value{i}" for i in range(len(numeric))] + [f"_missing{i}" for i in range(len(numeric))]
    if other:
        n = range(len(other))
        stages += [StringIndexer(inputCols=[f"_text{i}" for i in n], outputCols=[f"_index{i}" for i in n], handleInvalid="keep"),
                   OneHotEncoder(inputCols=[f"_index{i}" for i in n], outputCols=[f"_hot{i}" for i in n], dropLast=False,
                                 handleInvalid="keep")]
        inputs += [f"_hot{i}" for i in n]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=FEATS, handleInvalid="keep")]


#: Kinds that draw their features at random from all places, so that a place more or less gives other models.
DRAWN = ("rf",)


def feature_places(vec: DataFrame, features: Sequence[str]) -> tuple[dict[str, list[int]], list[str]]:
    """(places of each feature in the vectors that its preparation made, the numeric features)."""
    numeric = [f for f in features if isinstance(vec.schema[f].dataType, (NumericType, BooleanType))]
    other = [f for f in features if f not in numeric]
    places: dict[str, list[int]] = {f: [] for f in features}
    for group in vec.schema[FEATS].metadata["ml_attr"].get("attrs", {}).values():
        for attr in group:
            kind, i = re.match(r"_(value|missing|hot)([0-9]+)", attr["name"]).groups()
            places[(other if kind == "hot" else numeric)[int(i)]].append(attr["idx"])
    return places, numeric


def idle_places(vec: DataFrame, places: dict[str, list[int]], numeric: Sequence[str]) -> set[int]:
    """Places of the indicators of missing that are 0 in every row."""
    if not numeric:
        return set()
    most = vec.agg(*[F.max(f"_missing{i}") for i in range(len(numeric))]).first()
    return {places[f][1] for f, m in zip(numeric, most) if not m}


def place_slicer(features: Sequence[str], places: dict[str, list[int]], numeric: Sequence[str], idle: set[int]) -> list:
    """The stage that takes the features' places out of the vector without the idle ones, in the order of a preparation of
    their own; none for all places in their order."""
    own = [places[f] for f in features if f in numeric]
    order = [p[0] for p in own] + [p[1] for p in own] + [i for f in features if f not in numeric for i in places[f]]
    order = [i for i in order if i not in idle]
    if list(features) == list(places) and len(order) == sum(map(len, places.values())):
        return []
    return [VectorSlicer(inputCol=FEATS, outputCol="sliced", indices=order)]


def fit(kind: str, features: Sequence[str], label: str, train: DataFrame, weight: str | None = None,
        **params) -> PipelineModel:
    """Every training row with a label counts, whatever features it misses.
    The training input is a written table: estimators read it a few times and
    keep their own compact form of it, so the vectors are not cached.
    Indicators that are 0 in every row are left out where they change nothing."""
    prepared = Pipeline(stages=preparation(features, train.schema)).fit(train)
    vec = prepared.transform(train.where(col_(label).isNotNull()))
    slicer = []
    if kind not in DRAWN:
        places, numeric = feature_places(vec, features)
        slicer = place_slicer(features, places, numeric, idle_places(vec, places, numeric))
    numeric = [f for f in features if isinstance(train.schema[f].dataType, (NumericType, BooleanType))]
    # without categories the vector's places are columns
    plain = F.array(*[F.col(f"_{c}{i}") for c in ("value", "missing") for i in range(len(numeric))]) if len(numeric) == len(features) else None
    return PipelineModel(stages=[*prepared.stages, *slicer, fit_vectors(vec, slicer, kind, label, weight, params, plain)])


def fit_vectors(vec: DataFrame, slicer: Sequence, kind: str, label: str, weight: str | None, params: dict, plain: Column | None = None):
    """The model of a kind on the vectors, or on the places that ``slicer`` takes out of them; ``plain`` is the vector as an array,
    where there is a cheaper one than the vector's own."""
    est = estimator(kind, label, weight, **dict(params))
    if slicer:
        est = est.setFeaturesCol("sliced")
    model = trees.fit(est, vec, vector_to_array(FEATS) if plain is None else plain, label, list(slicer[0].getIndices()) if slicer else None)
    if model is None:
        for s in slicer:
            vec = s.transform(vec)
        model = est.fit(vec.select(est.getFeaturesCol(), label, *([weight] if weight else [])))
    return model


def probability(scored: DataFrame, out: str = "p1") -> DataFrame:
    """Positive-class probability as a plain double column."""
    return scored.withColumn(out, vector_to_array("probability")[1])


def evaluate(model: PipelineModel, df: DataFrame, label: str, weight: str | None = None,
             by: Sequence[str] = ()) -> DataFrame:
    """Leaderboard metrics of a fitted pipeline on ``df`` (exact AUC etc.).
    The metrics read the scores once, so the model runs once."""
    s = probability(model.transform(df)).select(*by, label, "p1", *([weight] if weight else []))
    return weighted_binary_metrics(s, label, "p1", w=weight, by=by)


@dataclass
class VectorTable:
    """Rows with their feature vectors, written once, on which any number of models over subsets of the features is
    fitted and scored."""

    prepared: PipelineModel
    rows: DataFrame
    places: dict[str, list[int]]  # of each feature in the vector
    numeric: list[str]  # features of two places, the value and an indicator of missing
    idle: set[int]  # places of indicators that are 0 in every row

    def slicer(self, features: Sequence[str], kind: str) -> list:
        """The stage that takes the features' places out of the vector; none for all of them in their order.  An
        indicator of missing that is 0 in every row has no coefficient and no split: only models that draw their
        features at random read it."""
        return place_slicer(features, self.places, self.numeric, set() if kind in DRAWN else self.idle)


def vector_table(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = (), fit_on: DataFrame | None = None,
                 folders: str | None = None) -> VectorTable:
    """Prepare ``features`` once.  Categories are those of ``fit_on`` (default: all rows); no label is looked at.  With
    ``folders`` each value of that column is a folder of its own, so that a filter on it reads no other rows."""
    features = list(dict.fromkeys(features))
    prepared = Pipeline(stages=preparation(features, df.schema)).fit(df if fit_on is None else fit_on)
    vec = prepared.transform(df)
    places, numeric = feature_places(vec, features)
    flags = [f"_missing{i}" for i in range(len(numeric))]
    rows = materialize(vec.select(*[col_(c) for c in dict.fromkeys([*keep, label])], FEATS, *flags), folders)
    return VectorTable(prepared, rows.drop(*flags), places, numeric, idle_places(rows, places, numeric))


@dataclass
class Fit:
    """One model: what it is fitted on and scored on, as filters of the vector table; ``keys`` name its metrics."""

    keys: dict
    kind: str
    features: Sequence[str]
    params: dict
    train: Column
    held: Column


def run_fits(table: VectorTable, fits: Sequence[Fit], label: str, weight: str | None = None, by: Sequence[str] = (),
             parallelism: int = 3) -> tuple[DataFrame, list[PipelineModel]]:
    """Fit all models from driver threads, and compute all metrics of all held-out scores in one grouped job that reads
    them once: ``(keys..., by..., metrics...)``, and the fitted models."""

    def one(f: Fit) -> PipelineModel:
        slicer = table.slicer(f.features, f.kind)
        rows = table.rows.where(f.train & col_(label).isNotNull())
        return PipelineModel(stages=[*slicer, fit_vectors(rows, slicer, f.kind, label, weight, f.params)])

    models = run_all(one, fits, parallelism)
    keys = list(dict.fromkeys(tuple(f.keys.values()) for f in fits))
    scored = None
    for f, m in zip(fits, models):
        part = probability(m.transform(table.rows.where(f.held))).select(
            F.lit(keys.index(tuple(f.keys.values()))).alias("_fit"), *by, label, "p1", *([weight] if weight else []))
        scored = part if scored is None else scored.unionByName(part)
    # a number for each fit is what is shuffled and sorted; its keys come back by their place
    board = weighted_binary_metrics(scored, label, "p1", w=weight, by=["_fit", *by])
    named = [F.element_at(F.array(*[F.lit(k[i]) for k in keys]), F.col("_fit") + 1).alias(name) for i, name in enumerate(fits[0].keys)]
    board = board.select(*named, *[c for c in board.columns if c != "_fit"])
    return board, [PipelineModel(stages=[*table.prepared.stages, *m.stages]) for m in models]


def hash_partition(df: DataFrame, key: str, validation: float = 0.2, holdout: float = 0.1,
                   seed: int = 0) -> DataFrame:
    u = unit_hash(key, seed)
    return df.withColumn("partition", F.when(u < holdout, "holdout").when(u < holdout + validation, "validation")
                         .otherwise("training"))


@dataclass
class Candidate:
    model_id: str
    kind: str
    features: tuple[str, ...]
    params: dict


def candidate_table(df: DataFrame, features: Sequence[str], label: str, key: str, weight: str | None = None, seed: int = 0) -> VectorTable:
    """Vectors with the hash partition of each row, a folder for each partition; categories are those of the training rows.
    Only where there are categories to learn is ``df`` read twice, and written before."""
    parted = hash_partition(df, key, seed=seed)
    if not all(isinstance(df.schema[f].dataType, (NumericType, BooleanType)) for f in features):
        parted = materialize(parted)
    return vector_table(parted, features, label, ["partition", *([weight] if weight else [])],
                        parted.where("partition = 'training'"), "partition")


def train_candidates(df: DataFrame, candidates: Sequence[Candidate], label: str, key: str,
                     weight: str | None = None, seed: int = 0, parallelism: int = 3,
                     table: VectorTable | None = None) -> tuple[DataFrame, dict]:
    """Fit every candidate on the training partition; metrics on validation
    and holdout.  Vectors of all candidates' features are written once; a
    candidate with fewer features takes its places out of them.  Rounds on
    the same rows share a ``table`` made by ``candidate_table``.  Returns a long leaderboard
    ``(model_id, model_type, n_features, partition, metric columns...)`` and
    the fitted models."""
    if table is None:
        features = list(dict.fromkeys(f for c in candidates for f in c.features))
        table = candidate_table(df, features, label, key, weight, seed)
    training = F.col("partition") == "training"
    fits = [Fit({"model_id": c.model_id, "model_type": c.kind, "n_features": len(c.features)}, c.kind, c.features, c.params,
                training, ~training) for c in candidates]
    board, models = run_fits(table, fits, label, weight, ["partition"], parallelism)
    return board, {c.model_id: m for c, m in zip(candidates, models)}


def tune_grid(df: DataFrame, kind: str, features: Sequence[str], label: str, key: str,
              grid: Sequence[dict], weight: str | None = None, seed: int = 0, parallelism: int = 3) -> DataFrame:
    """Each parameter map fitted on the same hash training partition and
    scored on the same validation partition (not random CV), on vectors written once."""
    part = F.col("partition")
    parted = hash_partition(df, key, seed=seed).where(part != "holdout")
    table = vector_table(parted, features, label, ["partition", *([weight] if weight else [])])
    fits = [Fit({"grid_id": i, "params": str(sorted(p.items()))}, kind, features, p, part == "training", part == "validation")
            for i, p in enumerate(grid)]
    return run_fits(table, fits, label, weight, parallelism=parallelism)[0]


#: More distinct folds than this are taken for a wrong column, not for folds.
MAX_FOLDS = 1000


def backtest_score(df: DataFrame, kind: str, features: Sequence[str], label: str, fold_col: str,
                   weight: str | None = None, **params) -> DataFrame:
    """Fit on all other folds, score each fold: metrics per fold.  More than ``MAX_FOLDS`` folds are refused; rows
    without a fold are in no model."""
    table = vector_table(df, features, label, [fold_col, *([weight] if weight else [])])
    folds = [r[0] for r in table.rows.select(fold_col).where(col_(fold_col).isNotNull()).distinct().limit(MAX_FOLDS + 1).collect()]
    if len(folds) > MAX_FOLDS:
        raise ValueError(f"{fold_col} has more than {MAX_FOLDS} values")
    fits = [Fit({"fold": f}, kind, features, params, col_(fold_col) != f, col_(fold_col) == f) for f in sorted(folds)]
    return run_fits(table, fits, label, weight)[0]


def batch_score(model: PipelineModel, df: DataFrame, features: Sequence[str], threshold: float,
                passthrough: Sequence[str], positive_class: str = "1", label_name: str = "churned") -> DataFrame:
    """Scores in the prediction-table layout: class probabilities, label at
    ``threshold``, threshold, positive class, status, pass-through columns.
    Rows missing a feature are not dropped: they get a status and null
    scores.  One pass over the rows; stateless, so it also runs on a streaming DataFrame."""
    complete = F.lit(True)
    for f in features:
        there = col_(f).isNotNull()
        if isinstance(df.schema[f].dataType, NumericType):
            there = there & ~F.isnan(col_(f).cast("double"))
        complete = complete & there
    s = probability(model.transform(df.withColumn("_complete", complete)))
    p1 = F.when(F.col("_complete"), F.col("p1"))
    return s.select(*passthrough, p1.alias(f"{label_name}_1_PREDICTION"),
                    (1 - p1).alias(f"{label_name}_0_PREDICTION"),
                    (p1 >= F.lit(float(threshold))).cast("double").alias(f"{label_name}_PREDICTION"),
                    F.when(F.col("_complete"), "OK").otherwise("missing feature").alias("prediction_status"),
                    F.lit(float(threshold)).alias("THRESHOLD"), F.lit(positive_class).alias("POSITIVE_CLASS"))


#: Rows (those of the smallest hashes) whose blends place the edges of the histograms, into which all rows are counted.
EDGE_ROWS = 20_000
#: Blend combinations are a list that people choose from; more of them than this are refused.
MAX_COMBINATIONS = 100_000


def _combinations(combos: DataFrame, model_col: str) -> list[tuple]:
    """``(combo_id, models)`` of a combination table."""
    rows = combos.groupBy("combo_id").agg(F.sort_array(F.collect_set(model_col)).alias("m")).limit(MAX_COMBINATIONS + 1).collect()
    if len(rows) > MAX_COMBINATIONS:
        raise ValueError(f"more than {MAX_COMBINATIONS} combinations")
    return sorted((r["combo_id"], list(r["m"])) for r in rows)


def blend_metrics(preds: DataFrame, combos: DataFrame, methods: Sequence[str], row: Sequence[str], label: str,
                  model_col: str = "model", p_col: str = "p", bins: int = 1024) -> DataFrame:
    """``(combo_id, method, metrics...)`` of every blend, judged on ``label``, without a row per row and combination.

    Predictions ``(row..., label, model, p)`` are shuffled once, to one row
    with a column per model; a task blends them in numpy and keeps a score
    histogram per combination and method, merged up a tree.  What is
    shuffled after the first step grows with tasks and bins, not with rows times
    combinations."""
    sets = _combinations(combos, model_col)
    models = sorted({m for _, ms in sets for m in ms})
    if not models:
        return preds.sparkSession.createDataFrame([], f"combo_id string, method string, {columns()}")
    p = F.nanvl(col_(p_col).cast("double"), F.lit(None).cast("double"))
    wide = materialize(preds.groupBy(*row).agg(
        F.max((col_(label) >= 1).cast("double")).alias("_y"), F.min(F.xxhash64(*map(col_, row))).alias("_o"),
        *[F.max(F.when(col_(model_col) == m, p)).alias(f"_m{i}") for i, m in enumerate(models)]).drop(*row))
    return _histogram_metrics(wide, sets, models, methods, bins)


def wide_blend_metrics(wide: DataFrame, models: Sequence[str], combos: DataFrame, methods: Sequence[str], model_col: str = "model",
                       bins: int = 1024) -> DataFrame:
    """``blend_metrics`` of a written table that holds a row's predictions side by side: ``_y`` (label, 0 or 1), ``_o`` (a hash of
    the row) and ``_m0``, ``_m1``, ... in the order of ``models``.  Nothing is shuffled but histograms."""
    sets = _combinations(combos, model_col)
    if not sets:
        return wide.sparkSession.createDataFrame([], f"combo_id string, method string, {columns()}")
    return _histogram_metrics(wide, sets, list(models), methods, bins)


def _histogram_metrics(wide: DataFrame, sets: list[tuple], models: list[str], methods: Sequence[str], bins: int) -> DataFrame:
    places = [(c, np.array([models.index(m) for m in ms])) for c, ms in sets]
    how = {"AVG": np.nanmean, "MED": np.nanmedian, "MIN": np.nanmin, "MAX": np.nanmax}

    def blended(batch):
        """Every blend's scores and their labels, of the rows that have both."""
        x = np.stack([batch[f"_m{i}"].to_numpy(zero_copy_only=False) for i in range(len(models))], 1).astype(np.float64)
        y = batch["_y"].to_numpy(zero_copy_only=False).astype(np.float64)
        for c, (_, at) in enumerate(places):
            own = x[:, at]
            some = ~np.isnan(own).all(1) & ~np.isnan(y)
            for i, method in enumerate(methods):
                if some.any():
                    yield c * len(methods) + i, how[method](own[some], axis=1), y[some]

    few = wide.orderBy("_o").limit(EDGE_ROWS).toArrow().combine_chunks()
    shares = np.arange(1, bins) / bins
    edges = {t: np.unique(np.quantile(v, shares, method="nearest")) for b in few.to_batches(EDGE_ROWS) for t, v, _ in blended(b)}
    edges = {t: edges.get(t, np.empty(0)) for t in range(len(places) * len(methods))}

    def count(batches):
        totals = {t: empty(e) for t, e in edges.items()}
        for b in batches:
            if b.num_rows:
                for t, v, y in blended(b):
                    add(totals[t], edges[t], v, y, np.ones(len(v)))
        yield packed(totals)

    merged = merge_tree(wide.drop("_o").mapInArrow(count, SCHEMA), np.add)

    def finish(batches):
        for b in batches:
            rows = [(places[t // len(methods)][0], methods[t % len(methods)], *metrics(data).values()) for t, data in unpacked(b)]
            kinds = [pa.string(), pa.string(), *[pa.float64()] * len(METRICS)]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=["combo_id", "method", *METRICS])

    return merged.mapInArrow(finish, f"combo_id string, method string, {columns()}")


def blend_all(preds: DataFrame, combos: DataFrame, methods: Sequence[str], row: Sequence[str],
              model_col: str = "model", p_col: str = "p", extra: dict | None = None, p_cols: dict[str, str] | None = None) -> DataFrame:
    """Blend long predictions ``(row..., model, p)`` over each combination
    ``(combo_id, model)``: ``(combo_id, row..., method, p)`` for AVG, MED, MIN
    and MAX; ``extra`` adds per-row aggregates (e.g. the label).

    The predictions are shuffled once, to bring a row's models together; each
    combination then is array arithmetic in that row.  Predictions that stand
    side by side (``p_cols`` names each model's column, ``extra`` then are
    columns) are not shuffled."""
    if p_cols is not None:
        return _blend_wide(preds, _combinations(combos, model_col), methods, row, extra or {}, p_cols)
    one = preds.groupBy(*row).agg(F.collect_list(F.struct(col_(model_col).alias("m"), col_(p_col).alias("p"))).alias("_preds"),
                                  *[v.alias(k) for k, v in (extra or {}).items()])
    sets = _combinations(combos, model_col)
    # every row has an output for every combination of the short list
    listed = F.array(*[F.struct(F.lit(c).alias("combo_id"), F.array(*map(F.lit, m)).alias("members")) for c, m in sets])
    own = F.transform(F.filter("_preds", lambda x: F.array_contains(F.col("_c.members"), x["m"]) & x["p"].isNotNull()), lambda x: x["p"])
    each = (one.select("*", F.explode(listed).alias("_c")).withColumn("_p", F.array_sort(own)).where(F.size("_p") > 0)
            .withColumn("combo_id", F.col("_c.combo_id")))
    n = F.size("_p")
    at = lambda k: F.element_at("_p", k.cast("int"))
    how = {"AVG": F.aggregate("_p", F.lit(0.0), lambda a, x: a + x) / n, "MIN": F.element_at("_p", 1), "MAX": F.element_at("_p", -1),
           "MED": F.lit(0.5) * at(F.floor((n + 1) / 2)) + F.lit(0.5) * at(F.floor(n / 2) + 1)}
    out = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), how[m].alias("p")) for m in methods])).alias("r")
    return each.select("combo_id", *row, *(extra or {}), out).select("combo_id", *row, *(extra or {}), "r.method", "r.p")


def _blend_wide(wide: DataFrame, sets: list[tuple], methods: Sequence[str], row: Sequence[str], extra: dict, p_cols: dict[str, str]) -> DataFrame:
    own = [(c, [col_(p_cols[m]) for m in ms if m in p_cols]) for c, ms in sets]
    own = [(c, ps) for c, ps in own if ps]
    # a combination's predictions in their order, nulls first
    ready = wide.select(*row, *[v.alias(k) for k, v in extra.items()], *[F.sort_array(F.array(*ps)).alias(f"_s{i}") for i, (_, ps) in enumerate(own)],
                        *[sum((p.isNotNull().cast("int") for p in ps), F.lit(0)).alias(f"_n{i}") for i, (_, ps) in enumerate(own)])
    out = []
    for i, (c, ps) in enumerate(own):
        n = F.col(f"_n{i}")
        at = lambda k, i=i, n=n, size=len(ps): F.get(f"_s{i}", (size - n + k - 1).cast("int"))
        total = F.lit(0.0)
        for k in range(len(ps)):
            total = total + F.coalesce(F.get(f"_s{i}", F.lit(k)), F.lit(0.0))
        how = {"AVG": F.try_divide(total, n), "MIN": at(1), "MAX": at(n),
               "MED": F.lit(0.5) * at(F.floor((n + 1) / 2)) + F.lit(0.5) * at(F.floor(n / 2) + 1)}
        out += [F.struct(F.lit(c).alias("combo_id"), F.lit(m).alias("method"), F.when(n > 0, how[m]).alias("p")) for m in methods]
    if not out:
        return wide.select(F.lit("").alias("combo_id"), *row, *[v.alias(k) for k, v in extra.items()], F.lit("").alias("method"), F.lit(0.0).alias("p")).limit(0)
    return ready.select(*row, *extra, F.explode(F.array(*out)).alias("r")).where("r.p IS NOT NULL").select("r.combo_id", *row, *extra, "r.method", "r.p")


def side_by_side(models: dict[str, PipelineModel], df: DataFrame, keep: Sequence[str], features: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``keep`` and every model's probability of a row in one pass, and each model's column."""
    columns = {m: f"_p{i}" for i, m in enumerate(models)}
    used = [c for c in dict.fromkeys(features) if c not in set(keep)]
    out = df.select(*[col_(c) for c in [*keep, *used]])
    for i, (name, model) in enumerate(models.items()):
        done = [*keep, *list(columns.values())[:i]]
        out = probability(model.transform(out), columns[name]).select(*[col_(c) for c in [*done, columns[name], *used]])
    return out.select(*[col_(c) for c in [*keep, *columns.values()]]), columns


def blend(preds: DataFrame, combos: DataFrame, method: str, row: Sequence[str],
          model_col: str = "model", p_col: str = "p") -> DataFrame:
    """``blend_all`` by one method."""
    return blend_all(preds, combos, [method], row, model_col, p_col)


def stack(preds_wide: DataFrame, inputs: Sequence[str], label: str, key: Sequence[str], method: str = "GLM",
          weight: str | None = None, folds: int = 3, params: dict | None = None) -> tuple[PipelineModel, DataFrame]:
    """Stacked blender (GLM, ENET or RF) on out-of-fold predictions: rows of
    a fold (hash of ``key``) are scored by the blender fitted on the other
    folds.  Returns the blender fitted on all rows, and the scored rows.
    ``params`` override the blender's own."""
    kind, own = {"GLM": ("lr", {}), "ENET": ("lr", {"regParam": 0.01, "elasticNetParam": 0.5}),
                 "RF": ("rf", {})}[method]
    base = materialize(preds_wide.withColumn("_fold", group_fold(key, folds)))

    def one(k):
        return fit(kind, inputs, label, base if k is None else base.where(F.col("_fold") != k), weight, **own | (params or {}))

    final, *models = run_all(one, [None, *range(folds)])
    out = None
    for k, m in enumerate(models):
        part = probability(m.transform(base.where(F.col("_fold") == k))).select(*preds_wide.columns, "p1")
        out = part if out is None else out.unionByName(part)
    return final, out


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str,
                           key: str, metric: str = "auc", buckets: int | None = None, seed: int = 1,
                           bins: int = 1024, trained_on: Sequence[str] | None = None) -> DataFrame:
    """Drop of ``metric`` when one feature's values are shuffled, over all rows.

    Rows are dealt at random (by a hash of their place in the written table,
    so equal rows spread) to ``buckets`` tasks (default: the session's shuffle partitions).  The fitted
    model goes to the tasks as arrays; a task scores an Arrow batch once as
    it is and once for each feature with that column moved on by one
    row, and keeps a score histogram per feature.  Histograms are merged up
    a tree; no row is copied per feature.  Features that the model does
    not use (``trained_on`` names those it was fitted on, if others) score 0.
    Returns ``(featureName, impactUnnormalized, impactNormalized)``."""
    features = list(features)
    used = list(features if trained_on is None else trained_on)
    base = materialize(df.where(present(label)).select(*[col_(c) for c in dict.fromkeys([*used, label])]))
    arrays = scorer(model, used, base)
    edges = score_edges(probability(model.transform(base)), "p1", bins)
    rows = base.select(*arrays.inputs(), (col_(label) >= 1).cast("double").alias("_y"),
                       F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)).alias("_o"))
    rows = rows.repartition(buckets, "_o") if buckets else rows.repartition("_o")
    moved = [f for f in features if f in used]

    def count(batches):
        totals = [empty(edges) for _ in range(len(moved) + 1)]
        for b in batches:
            if not b.num_rows:
                continue
            y, w = b["_y"].to_numpy(), np.ones(b.num_rows)
            parts = {f: arrays.places(f, b[f]) for f in arrays.features}
            add(totals[0], edges, arrays.score(parts), y, w)
            for total, f in zip(totals[1:], moved):
                add(total, edges, arrays.score({**parts, f: np.roll(parts[f], 1, 0)}), y, w)
        yield packed(dict(enumerate(totals)))

    found = merge_tree(rows.sortWithinPartitions("_o").mapInArrow(count, SCHEMA), np.add).collect()  # a histogram per feature
    measured = {r["tile"]: metrics(np.frombuffer(r["data"])) for r in found}
    ref = measured.get(0, {}).get(metric)
    sign = 1 if metric not in ("logloss", "rmse") else -1
    impact = {f: 0.0 for f in features if f not in moved}
    for i, f in enumerate(moved, 1):
        value = measured.get(i, {}).get(metric)
        impact[f] = None if value is None or ref is None else sign * (ref - value)
    top = max((v for v in impact.values() if v is not None), default=None)
    return df.sparkSession.createDataFrame(
        [(f, impact[f], impact[f] / top if top and impact[f] is not None else None) for f in features],
        "featureName string, impactUnnormalized double, impactNormalized double")


def contribution_impact(df: DataFrame, coefficients: dict[str, float]) -> DataFrame:
    """Mean absolute contribution ``|coef * (x - mean)|`` per feature of a
    linear model with these coefficients (the linear case of SHAP impact);
    one pass for the means, one for the contributions; missing values count
    for nothing."""
    features = list(coefficients)
    means = df.agg(*[F.avg(col_(f)).alias(f"m{i}") for i, f in enumerate(features)])
    joined = df.select(*[col_(f) for f in features], F.lit(0).alias("_g")).join(
        F.broadcast(means.withColumn("_g", F.lit(0))), "_g")  # one row
    one = joined.agg(*[F.avg(F.abs(F.lit(float(coefficients[f])) * (col_(f) - F.col(f"m{i}")))).alias(f"c{i}")
                       for i, f in enumerate(features)])
    arr = F.array(*[F.struct(F.lit(f).alias("featureName"), F.col(f"c{i}").alias("impactUnnormalized"))
                    for i, f in enumerate(features)])
    return one.select(F.explode(arr).alias("r")).select("r.*")


def linear_impact(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``contribution_impact`` with a fitted linear model's coefficients (numeric features come first in its vector)."""
    return contribution_impact(df, dict(zip(features, model.stages[-1].coefficients.toArray().tolist())))


def select_until_stable(train_eval: Callable[[Sequence[str]], float], select: Callable[[float], Sequence[str]],
                        ratio: float = 0.95, lives: int = 3, min_ratio: float = 0.01,
                        higher_is_better: bool = True, start: float | None = None) -> list[tuple]:
    """Repeat selection at ``ratio``; when a round does not improve, lose a
    life and square the ratio; stop at ``ratio <= min_ratio`` or no lives.
    Returns history rows ``(round, ratio, n_features, metric, improved, lives)``."""
    best = start
    hist = []
    rnd = 0
    seen: dict[tuple, float] = {}  # the same feature list gives the same model: fit it once
    while lives > 0 and ratio > min_ratio:
        feats = list(select(ratio))
        key = tuple(feats)
        if key not in seen:
            seen[key] = train_eval(feats)
        m = seen[key]
        improved = best is None or (m > best if higher_is_better else m < best)
        if improved:
            best = m
        else:
            lives -= 1
            ratio = ratio * ratio
        hist.append((rnd, float(ratio), len(feats), float(m), bool(improved), lives))
        rnd += 1
        if improved and len(feats) <= 1:
            break
    return hist


def add_one_back(df: DataFrame, clusters: Sequence[tuple[int, Sequence[str]]], all_features: Sequence[str],
                 label: str, key: str, kind: str = "lr", metric: str = "logloss", **params) -> DataFrame:
    """For each cluster, fit on (features outside the cluster) + one member,
    for every member; metrics in one table; best member per cluster (the first
    by name where metrics are equal).  All fits take their places out of the
    same vectors."""
    tasks = [(int(cid), f, [x for x in all_features if x not in set(members)]) for cid, members in clusters for f in members]
    if not tasks:
        return df.sparkSession.createDataFrame([], "cluster int, feature string, metric double, best boolean")
    part = F.col("partition")
    table = vector_table(hash_partition(df, key), list(dict.fromkeys([*all_features, *(f for _, f, _ in tasks)])), label, ["partition"])
    fits = [Fit({"cluster": cid, "feature": f}, kind, [*stub, f], params, part == "training", part == "validation") for cid, f, stub in tasks]
    out = run_fits(table, fits, label)[0].select("cluster", "feature", F.col(metric).alias("metric"))
    lower = metric in ("logloss", "rmse")
    w = Window.partitionBy("cluster").orderBy(F.col("metric").asc() if lower else F.col("metric").desc(), "feature")
    return out.withColumn("best", F.row_number().over(w) == 1)


def _fold_vectors(df: DataFrame, date: str, folds: DataFrame, features: Sequence[str], label: str, weight: str | None,
                  windows: DataFrame | None = None) -> tuple[VectorTable, list, list]:
    """Vectors of all rows with a role, written once, with a bit per fold (and per training window)."""
    rows, ids = fold_masks(df, date, folds)
    masks, pairs = ["train_mask", "validation_mask"], []
    if windows is not None:
        rows, pairs = duration_masks(rows, date, windows)
        masks.append("duration_mask")
    used = F.lit(False)
    for m in masks:
        used = used | F.exists(m, lambda w: w != 0)
    return vector_table(rows.where(used), features, label, [*masks, *([weight] if weight else [])]), ids, pairs


def backtest_time(df: DataFrame, date: str, folds: DataFrame, kind: str, features: Sequence[str], label: str,
                  weight: str | None = None, **params) -> DataFrame:
    """Time backtests: for each fold, fit on its training rows (before the
    gap) and score its validation window.  Every row is written once, with a
    bit per fold for each role."""
    table, ids, _ = _fold_vectors(df, date, folds, features, label, weight)
    fits = [Fit({"fold": int(f)}, kind, features, params, in_window("train_mask", k), in_window("validation_mask", k))
            for k, f in enumerate(ids)]
    return run_fits(table, fits, label, weight)[0]


def duration_grid_score(df: DataFrame, date: str, folds: DataFrame, months: Sequence[int], kind: str,
                        features: Sequence[str], label: str, weight: str | None = None, **params) -> DataFrame:
    """Training-duration search: for each fold and each duration, fit on the
    last ``d`` months before the gap and score the fold's validation window;
    a bit per (fold, duration) marks a row's training windows."""
    table, ids, pairs = _fold_vectors(df, date, folds, features, label, weight, duration_windows(folds, months))
    fits = [Fit({"fold": int(f), "months": int(m)}, kind, features, params, in_window("duration_mask", k),
                in_window("validation_mask", ids.index(f))) for k, (f, m) in enumerate(pairs)]
    return run_fits(table, fits, label, weight)[0]


def tune_on_backtests(df: DataFrame, date: str, folds: DataFrame, kind: str, features: Sequence[str], label: str,
                      grid: Sequence[dict], weight: str | None = None) -> DataFrame:
    """Every parameter map on every time fold (fit on the fold's training
    rows, score its validation window); per-fold metrics plus the mean AUC
    per map.  All fits read the same vectors."""
    table, ids, _ = _fold_vectors(df, date, folds, features, label, weight)
    fits = [Fit({"grid_id": g, "params": str(sorted(p.items())), "fold": int(f)}, kind, features, p,
                in_window("train_mask", k), in_window("validation_mask", k)) for g, p in enumerate(grid) for k, f in enumerate(ids)]
    out = run_fits(table, fits, label, weight)[0]
    return out.withColumn("mean_auc", F.avg("auc").over(Window.partitionBy("grid_id")))
