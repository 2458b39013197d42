"""The leaderboard as one long table, and the model iteration that runs on it.

A row of the board is a value keyed by ``(model_id, fold, segment, metric)``
with its model's attributes.  ``Board.upsert`` writes only what is new or
differs, as a new version of the table, so a step that is repeated changes
nothing, and a killed run goes on where it was.  Feature impacts are rows
too (segment = the feature), so nothing is fitted again to know them.

``iterate`` fits start models, runs repository entries similar to the best,
refits the best on features selected by their ensembled impacts, tunes,
blends, and marks the distinct models worth keeping.  A step chooses among models of
earlier steps only, so its choices are the same when it is repeated.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions.scalar import col_
from churnkit.operators import impact as im, joins as jn, leaderboard as lbo, ml
from churnkit.operators.util import materialize
from churnkit.sources.io import current_version, read_table, replace_table

KEYS = ["model_id", "fold", "segment", "metric"]
ATTRIBUTES = ["step", "model_category", "model_type", "kind", "params", "features", "n_features"]
SCHEMA = ("model_id string, fold string, segment string, metric string, value double, step int, model_category string, "
          "model_type string, kind string, params string, features string, n_features int")
ALL = "all"


class Board:
    """The long table in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        if current_version(self.spark, self.path) is None:
            return self.spark.createDataFrame([], SCHEMA)
        return read_table(self.spark, self.path)

    def upsert(self, rows: DataFrame) -> int:
        """Put rows in by their key; a row that is there with the same value is left alone.  Of rows with one key the
        greatest value counts.  Returns how many rows were new or differed; without any, nothing is written."""
        columns = [*KEYS, "value", *ATTRIBUTES]
        one = rows.groupBy(*KEYS).agg(F.max(F.struct("value", *ATTRIBUTES)).alias("r")).select(*KEYS, "r.*").select(*columns)
        new, old = materialize(one), self.rows()
        there = old.select(*KEYS, F.col("value").alias("_v"), F.lit(True).alias("_there"))
        differs = F.col("_there").isNull() | ~F.col("value").eqNullSafe(F.col("_v"))
        changed = materialize(new.join(there, KEYS, "left").where(differs).select(*columns))
        n = changed.count()
        if n:
            replace_table(old.join(changed.select(*KEYS), KEYS, "left_anti").select(*columns).unionByName(changed), self.path)
        return n

    def models(self, score: str = "auc", fold: str = "validation", before: int | None = None) -> DataFrame:
        """One row per model: attributes, ``score``, log loss and RMSE on a fold; those of earlier steps when asked."""
        own = self.rows().where((F.col("fold") == fold) & (F.col("segment") == ALL))
        if before is not None:
            own = own.where(F.col("step") < before)
        value = lambda m: F.max(F.when(F.col("metric") == m, F.col("value")))
        return own.groupBy("model_id", *ATTRIBUTES).agg(value(score).alias("score"), value("logloss").alias("logloss"), value("rmse").alias("rmse"))


def model_id(kind: str, features: Sequence[str], params: dict) -> str:
    """The same for the same model, whichever step asks for it."""
    return f"{kind}-{hashlib.md5(json.dumps([list(features), sorted(params.items())]).encode()).hexdigest()[:10]}"


class Iteration:
    """Steps on one board over one written vector table, made when a step first needs it: where the board holds all that the
    steps ask for, no row is read."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, key: str, path: str, n_keep: int = 3, seed: int = 0):
        self.spark, self.label, self.key = df.sparkSession, label, key
        self.features, self.n_keep = list(features), n_keep
        self.df, self.seed = df, seed
        self.board = Board(self.spark, path)
        self.fitted: dict[str, object] = {}
        self.changes = 0

    @cached_property
    def parted(self) -> DataFrame:
        return materialize(ml.hash_partition(self.df, self.key, seed=self.seed))

    @cached_property
    def table(self) -> ml.VectorTable:
        # a fit reads the training rows alone, its scores the others
        return ml.vector_table(self.parted, self.features, self.label, ["partition"], folders="partition")

    def _put(self, rows: DataFrame) -> None:
        self.changes += self.board.upsert(rows)

    def _attributes(self, step: int, category: str, name: str, kind: str, params: str, features: Sequence[str]) -> list:
        return [F.lit(step).alias("step"), F.lit(category).alias("model_category"), F.lit(name).alias("model_type"), F.lit(kind).alias("kind"),
                F.lit(params).alias("params"), F.lit(",".join(features)).alias("features"), F.lit(len(features)).alias("n_features")]

    def _fit(self, specs: Sequence[tuple[str, str, Sequence[str], dict]]) -> tuple[DataFrame, dict]:
        part = F.col("partition")
        fits = [ml.Fit({"model_id": model_id(k, f, p)}, k, f, p, part == "training", part != "training") for _, k, f, p in specs]
        board, models = ml.run_fits(self.table, fits, self.label, by=["partition"])
        return board, {f.keys["model_id"]: m for f, m in zip(fits, models)}

    def run(self, step: int, specs: Sequence[tuple[str, str, Sequence[str], dict]]) -> None:
        """Fit the models ``(name, kind, features, params)`` that the board lacks and put their metrics on it."""
        known = {r[0] for r in self.board.rows().select("model_id").distinct().collect()}
        todo = list({model_id(k, f, p): (n, k, f, p) for n, k, f, p in specs if model_id(k, f, p) not in known}.values())
        if not todo:
            return
        metrics, models = self._fit(todo)
        self.fitted |= models
        names = [c for c in metrics.columns if c not in ("model_id", "partition")]
        rows = None
        for name, kind, feats, params in todo:
            one = metrics.where(F.col("model_id") == model_id(kind, feats, params)).select(
                "model_id", F.col("partition").alias("fold"), F.lit(ALL).alias("segment"),
                F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])).alias("m"),
                *self._attributes(step, "model", name, kind, json.dumps(params, sort_keys=True), feats)).select("*", "m.*").drop("m")
            rows = one if rows is None else rows.unionByName(one)
        self._put(rows)

    def best(self, before: int, n: int | None = None, blends: bool = False) -> list:
        """The best models of the steps before, by validation AUC."""
        models = self.board.models(before=before).where("score IS NOT NULL")
        if not blends:
            models = models.where("model_category = 'model'")
        return models.orderBy(F.col("score").desc(), "model_id").limit(n or self.n_keep).collect()

    def _model(self, row):
        """A fitted model of the board; fitted again where this run has not (fits are repeatable)."""
        if row["model_id"] not in self.fitted:
            feats, params = row["features"].split(","), json.loads(row["params"])
            self.fitted |= self._fit([(row["model_type"], row["kind"], feats, params)])[1]
        return self.fitted[row["model_id"]]

    def similar(self, step: int, repository: Sequence[tuple[str, str, dict]]) -> None:
        """Repository entries whose name holds the first two words of a best model's name, on all features."""
        names = self.spark.createDataFrame([(n,) for n, _, _ in repository], "model_type string")
        top = self.spark.createDataFrame([(r["model_type"],) for r in self.best(step)], "model_type string")
        near = {r[0] for r in jn.similar_models(names, top).collect()}
        self.run(step, [(n, k, self.features, p) for n, k, p in repository if n in near])

    def impacts(self, step: int) -> None:
        """Permutation impacts of the best models that the board does not hold yet, as rows per feature."""
        have = {r[0] for r in self.board.rows().where("metric = 'impact'").select("model_id").distinct().collect()}
        for r in self.best(step):
            if r["model_id"] in have:
                continue
            val = self.parted.where("partition = 'validation'")
            imp = ml.permutation_importance(self._model(r), val, r["features"].split(","), self.label, self.key, trained_on=self.features)
            rest = [F.lit(r[a]).alias(a) for a in ATTRIBUTES]
            self._put(imp.select(F.lit(r["model_id"]).alias("model_id"), F.lit("validation").alias("fold"), F.col("featureName").alias("segment"),
                                 F.lit("impact").alias("metric"), F.col("impactUnnormalized").alias("value"), *rest))

    def reduce(self, step: int, ratio: float) -> None:
        """The best models refitted on the features that hold ``ratio`` of their impacts: ensembled, and each its own."""
        self.impacts(step)
        top = self.best(step)
        ids = [r["model_id"] for r in top]
        imp = (self.board.rows().where((F.col("metric") == "impact") & F.col("model_id").isin(ids))
               .select("model_id", F.col("segment").alias("featureName"), F.greatest("value", F.lit(0.0)).alias("impactUnnormalized"),
                       F.lit(None).cast("string").alias("redundantWith")))
        models = self.spark.createDataFrame([(r["model_id"], r["features"]) for r in top], "model_id string, featurelist_name string")
        lists = im.reduced_lists(im.normalise_impacts(imp), im.scope_table(models), ratio)
        found = {tuple(f for f in self.features if f in set(r["fs"])) for r in lists.groupBy("scope").agg(F.collect_set("featureName").alias("fs")).collect()}
        self.run(step, [(r["model_type"], r["kind"], list(fs), json.loads(r["params"])) for r in top for fs in sorted(found)])

    def tune(self, step: int, grids: dict[str, Sequence[dict]]) -> None:
        """The best models with every parameter map of their kind."""
        self.run(step, [(r["model_type"], r["kind"], r["features"].split(","), {**json.loads(r["params"]), **p})
                        for r in self.best(step) for p in grids.get(r["kind"], [])])

    def blend(self, step: int, methods: Sequence[str], size: int) -> None:
        """All blends of 2 to ``size`` best models, on both held-out folds."""
        top = self.best(step)
        ids = self.spark.createDataFrame([(r["model_id"],) for r in top], "model_id string")
        combos = materialize(jn.model_combinations(ids, size).select(F.array_join("combo", "+").alias("combo_id"), F.explode("combo").alias("model")))
        known = {r[0] for r in self.board.rows().where("model_category = 'blend'").select("model_id").distinct().collect()}
        wanted = {f"{m}({r[0]})" for r in combos.select("combo_id").distinct().collect() for m in methods}
        if wanted <= known or len(top) < 2:
            return
        # a row's predictions stand side by side, so no row is shuffled
        row, y = F.xxhash64(F.monotonically_increasing_id()).alias("_o"), (F.col(self.label) >= 1).cast("double").alias("_y")
        done = ["partition", "_o", "_y"]
        held = self.parted.where("partition <> 'training'").select("partition", row, y, *[col_(f) for f in self.features])
        for i, r in enumerate(top):
            held = ml.probability(self._model(r).transform(held), f"_p{i}").withColumn(f"_m{i}", F.nanvl(f"_p{i}", F.lit(None).cast("double")))
            done.append(f"_m{i}")
            held = held.select(*done, *[col_(f) for f in self.features])
        wide = materialize(held.select(*done))
        for fold in ("validation", "holdout"):
            got = ml.wide_blend_metrics(wide.where(F.col("partition") == fold).drop("partition"), [r["model_id"] for r in top], combos, methods)
            names = [c for c in got.columns if c not in ("combo_id", "method")]
            self._put(got.select(
                F.concat("method", F.lit("("), "combo_id", F.lit(")")).alias("model_id"), F.lit(fold).alias("fold"), F.lit(ALL).alias("segment"),
                F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names])).alias("m"),
                F.lit(step).alias("step"), F.lit("blend").alias("model_category"), F.concat("method", F.lit(" Blender")).alias("model_type"),
                F.lit("blend").alias("kind"), F.lit("{}").alias("params"), F.col("combo_id").alias("features"),
                (F.size(F.split("combo_id", r"\+"))).alias("n_features")).select("*", "m.*").drop("m"))

    def keep(self) -> None:
        """Mark the best distinct models (equal scores on all metrics are duplicates) with 1, the others with 0."""
        models = materialize(self.board.models())
        marks = lbo.retention(models, self.n_keep, "score", False, ["model_category", "score", "logloss", "rmse"])
        self._put(models.join(marks, "model_id").select(
            "model_id", F.lit("validation").alias("fold"), F.lit("retention").alias("segment"), F.lit("kept").alias("metric"),
            (F.col("action") == "keep").cast("double").alias("value"), *ATTRIBUTES))


def iterate(df: DataFrame, features: Sequence[str], label: str, key: str, path: str, start: Sequence[tuple[str, str, dict]],
            repository: Sequence[tuple[str, str, dict]] = (), ratio: float | None = 0.95, grids: dict[str, Sequence[dict]] | None = None,
            methods: Sequence[str] = ("AVG",), blend_size: int = 3, n_keep: int = 3) -> tuple[DataFrame, int]:
    """The whole iteration on the board at ``path``; returns the board and how many of its rows changed."""
    it = Iteration(df, features, label, key, path, n_keep)
    it.run(1, [(n, k, it.features, p) for n, k, p in start])
    it.similar(2, repository)
    if ratio:
        it.reduce(3, ratio)
    it.tune(4, grids or {})
    if methods:
        it.blend(5, methods, blend_size)
    it.keep()
    return it.board.rows(), it.changes
