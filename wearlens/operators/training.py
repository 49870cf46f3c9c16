"""Failure-risk models: leak-free pipelines, cross-fitted calibration and the experiment grid."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from functools import partial, reduce
from math import log
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from wearlens.contract import DEFAULT_WINDOWS, SEED, SENSORS, feature_names
from wearlens.operators.cleaning import action_tier
from wearlens.operators.forest import ALL, BoundedForest, Sample, grow_forests
from wearlens.operators.isotonic import IsotonicMap
from wearlens.operators.metrics import best_threshold, brier, confusion, ranking_metrics, rates
from wearlens.operators.rolling import rolling_features
from wearlens.operators.splits import class_weights, reference_sample, stratified_folds, stratified_split
from wearlens.operators.whole import Features, Rows, grow_fits, qualified, score_columns
from wearlens.session import new_folder
from wearlens.sources.files import append_rows, training_frame

UNBOUNDED_DEPTH = 30  # the deepest tree MLlib grows
MODEL_NAME = "component-failure"


@dataclass(frozen=True)
class Config:
    """One experiment. ``trees``, ``depth`` and ``min_leaf`` describe the forest."""

    name: str
    trees: int = 300
    depth: int | None = 8
    min_leaf: int = 3
    class_weight: str | None = "balanced"
    scaler: str = "standard"
    calibration: str = "sigmoid"
    rolling: bool = True
    windows: tuple[int, ...] = DEFAULT_WINDOWS

    def numeric(self) -> list[str]:
        return [*SENSORS, *(feature_names(windows=self.windows) if self.rolling else [])]


# --- fixed values: the twelve experiments ---------------------------------------------------
GRID = [
    Config("baseline_no_rolling", rolling=False),
    Config("baseline_rolling"),
    Config("small_forest", trees=150, depth=6, min_leaf=5),
    Config("large_forest", trees=500, depth=12, min_leaf=1),
    Config("deep_unbounded", depth=None, min_leaf=1),
    Config("balanced_subsample", class_weight="balanced_subsample"),
    Config("no_class_weight", class_weight=None),
    Config("minmax_scaler", scaler="minmax"),
    Config("isotonic_calibration", calibration="isotonic"),
    Config("conservative_leaves", depth=6, min_leaf=5),
    Config("wide_windows", windows=(5, 10)),
    Config("narrow_windows", windows=(2, 3)),
]


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: iterative fits must not recompute ``df``."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def pipeline(config: Config, numeric: list[str], seed: int = SEED) -> Pipeline:
    """Scaled numerics, one-hot type (an unseen type becomes the zero vector), then the forest."""
    scalers = {
        "standard": StandardScaler(inputCol="__num", outputCol="__scaled", withMean=True),
        "minmax": MinMaxScaler(inputCol="__num", outputCol="__scaled"),
    }
    forest = RandomForestClassifier(
        featuresCol="__x",
        labelCol="label",
        predictionCol="__pred",
        rawPredictionCol="__raw",
        probabilityCol="__prob",
        numTrees=config.trees,
        maxDepth=UNBOUNDED_DEPTH if config.depth is None else config.depth,
        minInstancesPerNode=config.min_leaf,
        seed=seed,
        maxMemoryInMB=1024,  # more nodes per pass over the rows
    )
    if config.class_weight:
        forest = forest.setWeightCol("__weight")
    return Pipeline(
        stages=[
            StringIndexer(inputCol="type", outputCol="__ix", handleInvalid="keep"),
            OneHotEncoder(inputCol="__ix", outputCol="__hot", dropLast=True),
            VectorAssembler(inputCols=numeric, outputCol="__num"),
            scalers[config.scaler],
            VectorAssembler(inputCols=["__scaled", "__hot"], outputCol="__x"),
            forest,
        ]
    )


def label_counts(df: DataFrame, by: str) -> dict[object, tuple[int, int]]:
    """Negatives and positives per part: a driver-side table of folds or splits."""
    rows = df.groupBy(by).agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n")).collect()
    return {r[by]: (r["n"] - r["pos"], r["pos"]) for r in rows}


def weighted(df: DataFrame, counts: tuple[int, int] | None = None) -> DataFrame:
    """Add ``__weight``, inverse to class frequency. Also stands in for per-bootstrap weights.

    ``counts`` are the negatives and positives of ``df`` where the caller knows them already.
    """
    if counts is None:
        weights = {r["label"]: r["weight"] for r in class_weights(df).collect()}  # one row per class
        w0, w1 = weights.get(0, 1.0), weights.get(1, 1.0)
    else:
        w0, w1 = (sum(counts) / (2.0 * c) if c else 1.0 for c in counts)
    return df.withColumn("__weight", F.when(F.col("label") == 1, w1).otherwise(w0))


def fit(
    df: DataFrame, config: Config, numeric: list[str] | None = None, seed: int = SEED,
    counts: tuple[int, int] | None = None,
) -> PipelineModel:
    numeric = numeric or config.numeric()
    data = weighted(df, counts) if config.class_weight else df
    return pipeline(config, numeric, seed).fit(data)


def together(spark: SparkSession, tasks: list, parallelism: int) -> list:
    """Run independent driver-side fits at once; Spark shares the executors between their jobs."""
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda task: task()), tasks)


def score(model: PipelineModel | Whole, df: DataFrame, out: str = "score") -> DataFrame:
    """Add the probability of failure. Rows with a null feature raise: audit them first."""
    if isinstance(model, Whole):
        return model.score(df, out)
    keep = df.columns
    return model.transform(df).select(*keep, vector_to_array("__prob")[1].alias(out))


@dataclass
class Calibrated:
    """Cross-fitted ensemble: per fold a model and the map fitted on the rows it did not see."""

    method: str
    members: list[tuple[PipelineModel, object]] = field(default_factory=list)

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        keep = df.columns
        for i, (model, _) in enumerate(self.members):
            df = score(model, df, f"__s{i}")
        return _mean_of_maps(df, [(f"__s{i}", m) for i, (_, m) in enumerate(self.members)], self.method, out).select(*keep, out)


def _mean_of_maps(df: DataFrame, scores: list[tuple[str, object]], method: str, out: str) -> DataFrame:
    """Add the mean of the columns' calibrated scores; a column without a map counts as it is."""
    for i, (column, mapping) in enumerate(scores):
        if mapping is None:
            df = df.withColumn(f"__p{i}", F.col(column))
        elif method == "sigmoid":
            a, b = mapping
            df = df.withColumn(f"__p{i}", 1.0 / (1.0 + F.exp(-(F.lit(a) * F.col(column) + F.lit(b)))))
        else:
            df = mapping.transform(df, column, f"__p{i}")
    mean = sum((F.col(f"__p{i}") for i in range(len(scores))), F.lit(0.0)) / len(scores)
    return df.withColumn(out, mean).drop(*[f"__p{i}" for i in range(len(scores))])


@dataclass
class Whole:
    """Forests grown on all rows, with the map that calibrates each (none: the plain score); their mean is the score.

    A member is (fit, trees, map): the first ``trees`` of a fit in ``path``.
    """

    features: Features
    path: str
    method: str
    members: list[tuple[int, int, object]]

    def wanted(self) -> dict:
        return {f"__{fit}_{trees}": [(None, fit, trees)] for fit, trees, _ in self.members}

    def mapped(self, raw: DataFrame, out: str = "score") -> DataFrame:
        """The score from a frame that holds the members' plain scores."""
        return _mean_of_maps(raw, [(f"__{fit}_{trees}", m) for fit, trees, m in self.members], self.method, out)

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        return self.mapped(score_columns(df, self.features, self.path, self.wanted()), out).select(*df.columns, out)

    def save(self, spark: SparkSession, path: str) -> None:
        fits = spark.read.parquet(self.path)
        mine = reduce(lambda a, b: a | b, [(F.col("fit") == fit) & (F.col("tree") < trees) for fit, trees, _ in self.members])
        fits.filter(mine).write.mode("overwrite").partitionBy("fit").parquet(f"{path}/trees")
        for i, (_, _, mapping) in enumerate(self.members):
            if isinstance(mapping, IsotonicMap):
                mapping.save(f"{path}/map-{i}")
        maps = [list(m) if isinstance(m, tuple) else None for _, _, m in self.members]
        f = self.features
        row = (f.numeric, f.types, [e.tolist() for e in f.edges], self.method, [m[0] for m in self.members], [m[1] for m in self.members], maps, [m[2] is not None for m in self.members])
        kinds = "numeric array<string>, types array<string>, edges array<array<double>>, method string, fits array<int>, trees array<int>, maps array<array<double>>, mapped array<boolean>"
        spark.createDataFrame([row], kinds).write.mode("overwrite").parquet(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Whole:
        r = spark.read.parquet(f"{path}/features").first()
        maps = [None if not known else tuple(m) if m else IsotonicMap(spark, f"{path}/map-{i}") for i, (m, known) in enumerate(zip(r.maps, r.mapped))]
        features = Features(list(r.numeric), list(r.types), [np.array(e) for e in r.edges])
        return cls(features, qualified(spark, f"{path}/trees"), r.method, list(zip(r.fits, r.trees, maps)))


def _sigmoid(held_out: DataFrame, counts: tuple[int, int]) -> tuple[float, float]:
    """Platt's map on smoothed targets; a soft target is two weighted rows."""
    neg, pos = counts
    target = F.when(F.col("label") == 1, (pos + 1.0) / (pos + 2.0)).otherwise(1.0 / (neg + 2.0))
    merged = held_out.groupBy("score", "label").agg(F.count(F.lit(1)).alias("rows"))
    both = merged.select(
        "score",
        F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("y"), (target * F.col("rows")).alias("w")),
                F.struct(F.lit(0.0).alias("y"), ((1 - target) * F.col("rows")).alias("w")),
            )
        ).alias("r"),
    ).select("score", "r.y", "r.w")
    rows = VectorAssembler(inputCols=["score"], outputCol="x").transform(both)
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=0.0).fit(rows)
    return float(model.coefficients[0]), float(model.intercept)


def _sigmoids(scored: DataFrame, counts: dict[str, tuple[int, int]]) -> dict[str, tuple[float, float]]:
    """Platt's maps on smoothed targets of all groups ``g`` of (g, score, label): Newton steps, an aggregate each.

    The driver holds a line per group.
    """
    points = materialize(scored.groupBy("g", "score", "label").agg(F.count(F.lit(1)).alias("n")), "platt")
    s, n, z, q, gap, curve = (F.col(c) for c in ("score", "n", "__z", "__q", "__gap", "__curve"))
    best: dict[str, tuple] = {}  # a, b, loss, step, size
    asked = {g: (0.0, log((pos + 1) / (neg + 1))) for g, (neg, pos) in counts.items()}
    for _ in range(200):
        if not asked:
            break
        lines = [(g, a, b, 1.0 / (counts[g][0] + 2.0), (counts[g][1] + 1.0) / (counts[g][1] + 2.0)) for g, (a, b) in asked.items()]
        now = points.sparkSession.createDataFrame(lines, "g string, a double, b double, t0 double, t1 double")
        at = points.join(F.broadcast(now), "g").withColumn("__t", F.when(F.col("label") == 1, F.col("t1")).otherwise(F.col("t0")))
        at = at.withColumn("__z", F.col("a") * s + F.col("b")).withColumn("__q", 1.0 / (1.0 + F.exp(-z)))
        at = at.withColumns({"__gap": n * (q - F.col("__t")), "__curve": n * F.greatest(q * (1.0 - q), F.lit(1e-12))})
        loss = n * (F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - F.col("__t") * z)
        sums = at.groupBy("g").agg(*[F.sum(c).alias(f"v{i}") for i, c in enumerate((loss, gap * s, gap, curve * s * s, curve * s, curve))])
        for r in sums.collect():
            g, (a, b) = r["g"], asked.pop(r["g"])
            if g in best and r["v0"] > best[g][2]:  # too far: half the step
                a0, b0, least, step, size = best[g]
                if size > 1e-10:
                    best[g] = a0, b0, least, step, size / 2
            else:
                h = np.array([[r["v3"] + 1e-10, r["v4"]], [r["v4"], r["v5"] + 1e-10]])
                best[g] = a, b, r["v0"], np.linalg.solve(h, np.array([r["v1"], r["v2"]])), 1.0
            a0, b0, _, step, size = best[g]
            if 1e-9 < size * np.abs(step).max() / (1.0 + max(abs(a0), abs(b0))):
                asked[g] = (float(a0 - size * step[0]), float(b0 - size * step[1]))
    return {g: (float(best[g][0]), float(best[g][1])) for g in counts}


def _folds(df: DataFrame, folds: int, seed: int) -> tuple[DataFrame, dict]:
    """The written fold table and its label counts per fold; every fold needs both classes."""
    parted = materialize(stratified_folds(df, folds, seed=seed), "folds")
    counts = label_counts(parted, "fold")
    lacking = [i for i in range(folds) if 0 in counts.get(i, (0, 0))]
    if lacking:
        raise ValueError(f"folds {lacking} hold one class only; use fewer folds or more data")
    return parted, counts


def _others(counts: dict, i: int) -> tuple[int, int]:
    rest = [c for k, c in counts.items() if k != i]
    return sum(c[0] for c in rest), sum(c[1] for c in rest)


def fit_calibrated(
    df: DataFrame, config: Config, folds: int = 5, numeric: list[str] | None = None, seed: int = SEED,
    parallelism: int = 4,
) -> Calibrated:
    """Every row is scored by the fold model that did not train on it, and calibrates that model only."""
    parted, counts = _folds(df, folds, seed)

    def member(i: int):
        model = fit(parted.filter(F.col("fold") != i), config, numeric, seed, _others(counts, i))
        held_out = score(model, parted.filter(F.col("fold") == i)).select("label", "score")
        return model, _sigmoid(held_out, counts[i]) if config.calibration == "sigmoid" else IsotonicMap.fit(held_out)

    return Calibrated(config.calibration, together(df.sparkSession, [partial(member, i) for i in range(folds)], parallelism))


def _alike(config: Config) -> tuple:
    """What trees see of a config; their number aside, and neither scaling nor calibration."""
    return config.depth, config.min_leaf, config.class_weight


def cross_fitted(
    parted: dict[object, tuple[DataFrame, dict]], runs: list[tuple[object, Config, list[str]]], folds: int, seed: int = SEED,
    parallelism: int = 4, plain: bool = False,
) -> list[tuple[Whole, Whole | None]]:
    """Per run the forests of all folds, grown on all other rows and calibrated on all of their own.

    ``parted`` holds fold tables and their counts; a run is (table's key, config, numeric features). Runs whose
    trees would be equal share them. With ``plain`` a forest on all folds' rows comes along, not calibrated.
    """
    spark = next(iter(parted.values()))[0].sparkSession
    rows = {(key, tuple(names)): None for key, _, names in runs}
    rows = {k: Rows.of(parted[k[0]][0], list(k[1])) for k in rows}
    made: dict[tuple, Config] = {}
    for key, config, names in runs:
        k = (key, tuple(names), _alike(config))
        made[k] = config if k not in made or made[k].trees < config.trees else made[k]
    every = [*([ALL] if plain else []), *range(folds)]
    fits = {(k, fold): i for i, (k, fold) in enumerate((k, fold) for k in made for fold in every)}
    path = grow_fits(spark, [(rows[k[:2]], made[k], fold) for k, fold in fits], seed)
    forests = [((key, tuple(names), _alike(config)), config.trees) for key, config, names in runs]
    column = {f: f"__h{i}" for i, f in enumerate(dict.fromkeys(forests))}

    held: dict[tuple, DataFrame] = {}  # every row's score by the forest that did not see it
    for k, r in rows.items():
        wanted = {name: [(i, fits[f[0], i], f[1]) for i in range(folds)] for f, name in column.items() if f[0][:2] == k}
        scored = score_columns(parted[k[0]][0].select("label", "fold", "type", *k[1]), r.features, path, wanted)
        held[k] = materialize(scored.select("label", "fold", *wanted), "held-out")

    maps: dict[tuple, object] = {}
    sigmoid = {f for f, (_, config, _) in zip(forests, runs) if config.calibration == "sigmoid"}
    if sigmoid:
        parts = [
            df.select("label", F.explode(F.array(*[F.struct(F.concat_ws("/", F.lit(column[f]), "fold").alias("g"), F.col(column[f]).alias("score")) for f in mine])).alias("r")).select("r.g", "r.score", "label")
            for k, df in held.items() if (mine := [f for f in column if f in sigmoid and f[0][:2] == k])
        ]
        found = _sigmoids(reduce(DataFrame.unionByName, parts), {f"{column[f]}/{i}": parted[f[0][0]][1][i] for f in sigmoid for i in range(folds)})
        maps |= {("sigmoid", f, i): found[f"{column[f]}/{i}"] for f in sigmoid for i in range(folds)}
    others = [(f, i) for f in dict.fromkeys(f for f, (_, c, _) in zip(forests, runs) if c.calibration != "sigmoid") for i in range(folds)]

    def own(f: tuple, i: int) -> IsotonicMap:
        return IsotonicMap.fit(held[f[0][:2]].filter(F.col("fold") == i).select("label", F.col(column[f]).alias("score")))

    fitted = together(spark, [partial(own, f, i) for f, i in others], parallelism) if others else []
    maps |= {("isotonic", f, i): m for (f, i), m in zip(others, fitted)}
    out = []
    for f, (_, config, _) in zip(forests, runs):
        method = "sigmoid" if config.calibration == "sigmoid" else "isotonic"
        features = rows[f[0][:2]].features
        members = [(fits[f[0], i], f[1], maps[method, f, i]) for i in range(folds)]
        bare = Whole(features, path, method, [(fits[f[0], ALL], f[1], None)]) if plain else None
        out.append((Whole(features, path, method, members), bare))
    return out


def raw_scores(models: list[Whole], df: DataFrame) -> DataFrame:
    """``df`` with the plain scores of all members of models on the same features, each once."""
    return score_columns(df, models[0].features, models[0].path, {k: v for m in models for k, v in m.wanted().items()})


def fit_whole(df: DataFrame, config: Config, numeric: list[str] | None = None, seed: int = SEED) -> Whole:
    """One forest on all rows of ``df``, not calibrated."""
    rows = Rows.of(df, numeric or config.numeric())
    return Whole(rows.features, grow_fits(df.sparkSession, [(rows, config, ALL)], seed), config.calibration, [(0, config.trees, None)])


def cross_validated(
    df: DataFrame, config: Config, folds: int = 5, numeric: list[str] | None = None, seed: int = SEED,
    parallelism: int = 4, fit_rows: int | None = None,
) -> DataFrame:
    """``fold, rows, positives, pr_auc, reason``: the whole pipeline is refitted inside each fold.

    A fit takes all rows of the other folds; ``fit_rows`` bounds them by a hash of their id. All held-out rows are scored.
    """
    parted, _ = _folds(df, folds, seed)
    names = numeric or config.numeric()

    if fit_rows is not None:
        parts = [Sample.of(parted.filter(F.col("fold") != i), names, fit_rows, None, seed) for i in range(folds)]
        grown = grow_forests(df.sparkSession, [(config, s, [ALL]) for s in parts], new_folder(df.sparkSession, "trees"), seed)
        models = [BoundedForest.calibrated(s, config.calibration, g) for s, g in zip(parts, grown)]
    else:  # each fold's bins come from its own rows, so each has its own written rows
        rows = together(df.sparkSession, [partial(Rows.of, parted.filter(F.col("fold") != i).drop("fold"), names) for i in range(folds)], parallelism)
        path = grow_fits(df.sparkSession, [(r, config, i) for i, r in enumerate(rows)], seed)
        models = [Whole(r.features, path, config.calibration, [(i, config.trees, None)]) for i, r in enumerate(rows)]

    parts = [m.score(parted.filter(F.col("fold") == i).select("fold", "label", "type", *names)).select("fold", "label", "score") for i, m in enumerate(models)]
    scored = materialize(reduce(DataFrame.unionByName, parts), "scores")
    rows = scored.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"))
    return ranking_metrics(scored, ["fold"]).drop("rows", "positives").join(rows, "fold").select("fold", "rows", "positives", "pr_auc", "reason")


def cv_summary(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(F.avg("pr_auc").alias("mean"), F.stddev_pop("pr_auc").alias("std"), F.count("pr_auc").alias("folds"))


def calibration_effect(
    df: DataFrame, config: Config, folds: int = 5, numeric=None, seed: int = SEED, fit_rows: int | None = None
) -> DataFrame:
    """``kind, rows, positives, brier_score`` on the whole test split, without and with calibration.

    Fits take all training rows; ``fit_rows`` bounds them by a hash of their id.
    """
    split = materialize(stratified_split(df, seed=seed), "split")
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    names = numeric or config.numeric()
    if fit_rows is not None:
        sample = Sample.of(train, names, fit_rows, folds, seed)
        grown = grow_forests(df.sparkSession, [(config, sample, [ALL, *range(folds)])], new_folder(df.sparkSession, "trees"), seed)[0]
        plain = BoundedForest.calibrated(sample, config.calibration, {ALL: grown.pop(ALL)}).score(test)
        mapped = BoundedForest.calibrated(sample, config.calibration, grown).score(test)
    else:
        ((calibrated, bare),) = cross_fitted({0: _folds(train, folds, seed)}, [(0, config, names)], folds, seed, plain=True)
        raw = raw_scores([calibrated, bare], test.select("label", "type", *names))
        raw = materialize(raw.drop("type", *names), "raw-scores")
        plain, mapped = bare.mapped(raw), calibrated.mapped(raw)
    both = [x.select("label", "score", F.lit(kind).alias("kind")) for x, kind in ((plain, "uncalibrated"), (mapped, "calibrated"))]
    return both[0].unionByName(both[1]).groupBy("kind").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"), brier().alias("brier_score")
    )


def feature_table(df: DataFrame, windows=DEFAULT_WINDOWS) -> DataFrame:
    """The training frame with rolling features for one set of windows."""
    return training_frame(rolling_features(df, windows=windows), [*SENSORS, *feature_names(windows=windows)])


def run_grid(
    df: DataFrame, configs: list[Config] = GRID, batch_id: str = "batch", folds: int = 5, seed: int = SEED,
    runs_path: str | None = None, parallelism: int = 4, fit_rows: int | None = None, models_path: str | None = None,
) -> DataFrame:
    """Fit every config and return one run row each; the split is by id, the same for all.

    Fits take all training rows; ``fit_rows`` bounds them by a hash of their id. All other rows are evaluated.
    With ``models_path`` every run's model and threshold are stored there under its run id, the
    column ``path``, from where a promoted version is loaded.

    Feature tables are written once per distinct window set, all runs are evaluated together.
    """
    # experiments without rolling features read a column subset of any window set's table
    tables = {
        w: materialize(stratified_split(feature_table(df, w), seed=seed), "features")
        for w in dict.fromkeys(c.windows for c in configs)
    }

    models: dict[int, Whole | BoundedForest] = {}
    raw: dict[tuple, DataFrame] = {}
    if fit_rows is not None:  # all runs and folds in one job; runs of the same features share a sample
        features = {(c.windows, tuple(c.numeric())): None for c in configs}
        samples = {k: Sample.of(tables[k[0]].filter("split = 'train'"), list(k[1]), fit_rows, folds, seed) for k in features}
        mine = [samples[c.windows, tuple(c.numeric())] for c in configs]
        grown = grow_forests(df.sparkSession, [(c, s, list(range(folds))) for c, s in zip(configs, mine)], new_folder(df.sparkSession, "trees"), seed)
        models = {i: BoundedForest.calibrated(s, c.calibration, g) for i, (c, s, g) in enumerate(zip(configs, mine, grown))}

    else:
        parted = {w: _folds(t.filter("split = 'train'"), folds, seed) for w, t in tables.items()}
        made = cross_fitted(parted, [(c.windows, c, c.numeric()) for c in configs], folds, seed, parallelism)
        models = {i: m for i, (m, _) in enumerate(made)}
        for w, names in dict.fromkeys((c.windows, tuple(c.numeric())) for c in configs):  # shared trees score once
            same = [models[i] for i, c in enumerate(configs) if (c.windows, tuple(c.numeric())) == (w, names)]
            rows = tables[w].filter("split <> 'train'").select("split", "label", "type", *names)
            raw[w, names] = materialize(raw_scores(same, rows).drop("type", *names), "raw-scores")

    def evaluate(seq: int, config: Config) -> DataFrame:
        if fit_rows is None:
            return models[seq].mapped(raw[config.windows, tuple(config.numeric())]).select(F.lit(seq).alias("seq"), "split", "label", "score")
        table = tables[config.windows].select("unit_id", "type", "label", "split", *config.numeric())
        return models[seq].score(table.filter("split <> 'train'")).select(F.lit(seq).alias("seq"), "split", "label", "score")

    parts = together(df.sparkSession, [partial(evaluate, i, c) for i, c in enumerate(configs)], parallelism)
    scored = reduce(DataFrame.unionByName, parts)
    scored = materialize(scored, "scores")
    # one threshold per run, chosen on validation rows only
    chosen = best_threshold(scored.filter("split = 'validation'"), groups=["seq"]).select("seq", "threshold")
    at = scored.join(F.broadcast(chosen), "seq")  # one row per config
    report = rates(confusion(at, F.col("threshold"), ["seq", "split"]))
    ranks = ranking_metrics(scored, ["seq", "split"]).drop("reason")
    error = scored.groupBy("seq", "split").agg(brier().alias("brier_score"))
    whole = report.join(ranks, ["seq", "split"]).join(error, ["seq", "split"])
    names = {"validation": "val", "test": "test"}
    measured = [
        "pr_auc", "roc_auc", "f2_score", "recall", "precision", "brier_score", "expected_cost_per_1000", "tn", "fp", "fn", "tp",
    ]
    wide = whole.groupBy("seq").agg(
        *[F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{p}_{m}") for s, p in names.items() for m in measured]
    )
    params = df.sparkSession.createDataFrame(
        [
            (seq, f"{batch_id}-{seq:02d}", c.name, batch_id, {k: str(v) for k, v in {**asdict(c), "n_numeric": len(c.numeric())}.items()})
            for seq, c in enumerate(configs)
        ],
        "seq int, run_id string, name string, batch_id string, params map<string,string>",
    )
    rows = params.join(chosen, "seq").join(wide, "seq")
    if models_path:
        for r in chosen.collect():  # one row per config
            run_id = f"{batch_id}-{r['seq']:02d}"
            save_model(df.sparkSession, models[r["seq"]], r["threshold"], f"{models_path}/{run_id}", run_id)
        rows = rows.withColumn("path", F.concat(F.lit(f"{models_path}/"), F.col("run_id")))
    if runs_path:
        append_rows(rows, runs_path, batch_id)
    return rows


def with_actions(scored: DataFrame, version: str, name: str = MODEL_NAME) -> DataFrame:
    """The response columns of a scored frame."""
    return scored.withColumns(
        {
            "failure_probability": F.col("score"),
            "recommended_action": action_tier("score"),
            "model_name": F.lit(name),
            "model_version": F.lit(str(version)),
        }
    ).drop("score")


def reference_window(df: DataFrame, scoring, n: int | None = None, seed: int = 13) -> DataFrame:
    """The scored reference of the drift job: all rows or a sample, rolling features, predictions."""
    features = rolling_features(reference_sample(df.select("unit_id", "type", *SENSORS), n, seed=seed))
    return scoring(features).select("unit_id", *SENSORS, "type", F.col("score").alias("prediction"))


# --- model store ---------------------------------------------------------------------------

META = "method string, members int, threshold double, version string, a array<double>, b array<double>"


def save_model(spark: SparkSession, model: Calibrated | Whole | BoundedForest, threshold: float, path: str, version: str) -> None:
    """The ensemble and its operating threshold, stored together."""
    if isinstance(model, Whole | BoundedForest):
        model.save(spark, f"{path}/forest")
        spark.createDataFrame([("whole" if isinstance(model, Whole) else "bounded", len(model.members), float(threshold), version, [], [])], META).write.mode("overwrite").parquet(f"{path}/meta")
        return
    maps = [m for _, m in model.members]
    a, b = ([m[0] for m in maps], [m[1] for m in maps]) if model.method == "sigmoid" else ([], [])
    for i, (member, mapping) in enumerate(model.members):
        member.write().overwrite().save(f"{path}/member-{i}")
        if model.method != "sigmoid":
            mapping.save(f"{path}/map-{i}")
    row = [(model.method, len(model.members), float(threshold), version, a, b)]
    spark.createDataFrame(row, META).write.mode("overwrite").parquet(f"{path}/meta")


def load_model_at(spark: SparkSession, path: str) -> tuple[Calibrated | Whole | BoundedForest, float, str]:
    meta = spark.read.schema(META).parquet(f"{path}/meta").first()
    if meta["method"] in ("bounded", "whole"):
        kind = Whole if meta["method"] == "whole" else BoundedForest
        return kind.load(spark, f"{path}/forest"), meta["threshold"], meta["version"]
    members = []
    for i in range(meta["members"]):
        if meta["method"] == "sigmoid":
            mapping = (meta["a"][i], meta["b"][i])
        else:
            mapping = IsotonicMap(spark, f"{path}/map-{i}")
        members.append((PipelineModel.load(f"{path}/member-{i}"), mapping))
    return Calibrated(meta["method"], members), meta["threshold"], meta["version"]


def load_model(spark: SparkSession, aliases: DataFrame, versions: DataFrame, alias: str = "production"):
    """Resolve alias to version to stored model; raises when the alias was never set."""
    from wearlens.operators.runs import alias_target

    row = alias_target(aliases, alias).join(versions, "version").first()
    if row is None:
        raise LookupError(f"no model has the alias {alias!r}")
    return load_model_at(spark, row["path"])
