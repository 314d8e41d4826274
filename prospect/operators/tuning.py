"""Parameter grids, cross validation and sweeps.

* Folds come from a hash of the row's id, so they don't move with partitioning.
* ``grid_search`` fits one ensemble for all candidates that differ in their number of trees only, at the
  largest number: a boosted model of k trees is the first k trees of a longer run (same seed), and so a
  forest's first k trees are a forest of k. A forest is fitted once for all depths, too: MLlib grows all trees level by
  level and draws a node's features when its level is reached, so smaller depths are the same trees cut there
  (as long as a level's statistics fit ``maxMemoryInMB``; beyond, cut trees are still grown alike, with other draws). The scores of all candidates of a fold stand side by side in one
  table, and their areas under ROC are computed exactly in one pass (``metrics.auc_many``).
* A row's scores after every wanted number of trees are one running sum over its leaves' values, so plans
  don't grow with the number of trees or counts.
* Results are small ``(parameters, metric)`` frames.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.operators import boosting
from prospect.operators.features import encoding_stages, labelled
from prospect.operators.metrics import auc_many
from prospect.operators.models import REFERENCE_PARAMS, Trainer, fit_partitions, make_classifier, train_pipeline
from prospect.operators.sampling import fold_index
from prospect.session import checkpoint_root, scratch_path, stored
from prospect.spec import TableSpec


def param_grid(estimator, grid: dict[str, list]) -> list:
    """H1: ``{"maxIter": [20, 40, 60]}`` -> list of param maps."""
    b = ParamGridBuilder()
    for k, vs in grid.items():
        b = b.addGrid(estimator.getParam(k), vs)
    return b.build()


def cv_plan(train: DataFrame, key: str, maps: list, folds: int = 3, fold_seed: int = 4201) -> DataFrame:
    """H1/H2 work plan: one row per (candidate, fold) with its parameters and the sizes of the fit
    and validation parts.

    Fold sizes come from one global aggregate (partial counts per task, no shuffle of rows); the
    grid is a handful of parameter structs exploded next to them, so no join is needed.
    """
    fold = fold_index(key, folds, fold_seed)
    sizes = train.agg(F.count(F.lit(1)).alias("_n"),
                      *[F.count_if(fold == f).alias(f"_v{f}") for f in range(folds)])
    names = sorted({p.name for m in maps for p in m})
    grid = F.array(*[F.struct(F.lit(i).alias("candidate"),
                              *[F.lit({p.name: v for p, v in m.items()}.get(n)).alias(n) for n in names])
                     for i, m in enumerate(maps)])
    per_fold = F.array(*[F.struct(F.lit(f).alias("fold"), F.col(f"_v{f}").alias("valid_rows")) for f in range(folds)])
    out = sizes.select("_n", F.explode(grid).alias("g"), F.explode(per_fold).alias("f"))
    return out.select("g.*", "f.fold", (F.col("_n") - F.col("f.valid_rows")).alias("train_rows"), "f.valid_rows")


def cross_validate(train: DataFrame, spec: TableSpec, name: str, grid: dict[str, list], folds: int = 3,
                   seed: int = 420, parallelism: int = 4, fold_seed: int = 4201, **params):
    """H2/H3: k-fold CV of encoding stages + any classifier by exact AUC; returns (cv model, report frame).

    The encoders are refitted inside every fold, once for all candidates, so no fold sees statistics of its
    own test part. The inputs are kept once, partitioned by id and sorted inside, so fits don't depend on the
    input's layout; a fold's learners read its encoded rows.
    """
    checkpoint_root(train.sparkSession)
    clf = make_classifier(name, **params)
    maps = param_grid(clf, grid)
    evaluator = BinaryClassificationEvaluator(numBins=0)
    keep = [c for c in (spec.id, *spec.categorical, *spec.numeric) if c in train.columns]
    data = stored(labelled(train, spec).select("label", *keep, fold_index(spec.id, folds, fold_seed).alias("_fold")), "cv-rows")
    data = data.repartition(fit_partitions(data.count()), spec.id).sortWithinPartitions(spec.id).persist(StorageLevel.MEMORY_AND_DISK)

    def encoded(rows: DataFrame, *others: DataFrame):
        """The encoders fitted on ``rows``, and the encoded ``rows`` and ``others``."""
        model = Pipeline(stages=encoding_stages(spec)).fit(rows)
        return model, [model.transform(x).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK) for x in (rows, *others)]

    areas = []
    workers = ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(maps))))
    try:
        for fold in range(folds):
            _, (fit, valid) = encoded(data.where(F.col("_fold") != fold), data.where(F.col("_fold") == fold))
            areas.append(list(workers.map(lambda m, a=fit, b=valid: evaluator.evaluate(clf.fit(a, m).transform(b)), maps)))
            fit.unpersist()
            valid.unpersist()
        means = [float(np.mean([a[i] for a in areas])) for i in range(len(maps))]
        encoders, (rows,) = encoded(data)
        best = clf.fit(rows, maps[int(np.argmax(means))])
        rows.unpersist()
    finally:
        workers.shutdown()
        data.unpersist()
    model = CrossValidatorModel(PipelineModel(stages=[*encoders.stages, best]), means)
    return model, _report(train.sparkSession, [{p.name: v for p, v in m.items()} for m in maps], means)


def _report(spark: SparkSession, candidates: list[dict], areas: list[float]) -> DataFrame:
    """``(candidate, params, avg_auc, is_best)``; ties: the first candidate."""
    best = max(range(len(areas)), key=lambda i: (areas[i], -i))
    return spark.createDataFrame([(i, json.dumps(c, sort_keys=True), float(a), i == best) for i, (c, a) in enumerate(zip(candidates, areas, strict=True))],
                                 "candidate int, params string, avg_auc double, is_best boolean")


#: The parameter that counts the trees, which one fit covers for all its values.
TREE_COUNT = {"gbt": "maxIter", "rf": "numTrees"}


#: Rows times trees of a forest up to which fits run side by side (4 bytes each in MLlib's bootstrap).
MOST_DRAWS = 100_000_000


def candidates_of(grid: dict[str, list]) -> list[dict]:
    """H1: every combination, the first parameter slowest."""
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def grid_search(train: DataFrame, spec: TableSpec, name: str, grid: dict[str, list], folds: int = 3, fold_seed: int = 4201,
                parallelism: int = 12, oversample=None, **params) -> DataFrame:
    """H1-H3 for tree ensembles: ``(candidate, params, avg_auc, is_best)`` by k-fold cross validation.

    ``folds`` x (combinations without the number of trees, for forests also without the depth) fits, run concurrently;
    encoders, bins and oversampling are fitted on the fold's own training rows.
    """
    count = TREE_COUNT[name]
    counts = sorted(set(grid.get(count) or [REFERENCE_PARAMS[name][count]]))
    # A forest's trees grown to a smaller depth are its deep ones cut there (see ``leaf_values``).
    depths = sorted(set(grid["maxDepth"])) if name == "rf" and grid.get("maxDepth") else []
    shared = {count, "maxDepth"} if depths else {count}
    others = candidates_of({k: v for k, v in grid.items() if k not in shared})
    largest = {count: counts[-1], **({"maxDepth": depths[-1]} if depths else {})}
    rows = stored(train.withColumn("_fold", fold_index(spec.id, folds, fold_seed)), "grid-rows")
    areas: dict[tuple[int, int, int], list[float]] = {}
    names = {(i, d, k): f"c{i}_{d}_{k}" for i in range(len(others)) for d in range(len(depths or [0])) for k in counts}
    by_name = {v: k for k, v in names.items()}
    workers = ThreadPoolExecutor(max_workers=max(1, parallelism))

    # A forest's bootstrap follows the partitions, boosted trees don't.
    together = min(parallelism, folds * len(others)) if name == "gbt" else 1

    def trainer(fold: int) -> Trainer:
        return Trainer(rows.where(F.col("_fold") != fold).drop("_fold"), spec, oversample=oversample, together=together)

    trainers = list(workers.map(trainer, range(folds)))
    try:
        every = [{**REFERENCE_PARAMS[name], **params, **o, **largest} for o in others]
        if name == "gbt" and all(map(boosting.takes, every)) and all(workers.map(lambda t: t.boosting_rows() is not None, trainers)):
            fitted = list(workers.map(lambda t: boosting.fit(t.boosting_rows(), every), trainers))
        else:
            jobs = [(t, o) for t in trainers for o in others]
            # MLlib keeps a number a tree with every row of a forest's fit: large fits come one after another.
            draws = max(t.n_rows for t in trainers) * counts[-1] if name == "rf" else 0
            one = lambda j: j[0].fit(name, **{**params, **j[1], **largest}).stages[-1]
            models = list(map(one, jobs) if draws > MOST_DRAWS else workers.map(one, jobs))
            fitted = [models[a:a + len(others)] for a in range(0, len(models), len(others))]
        for fold, t in enumerate(trainers):
            x = t.features(rows.where(F.col("_fold") == fold))
            # The areas read the scores twice; the models are large, so every row is scored once.
            x = stored(score_columns(fitted[fold], x, counts, names, t.features_col, depths), "grid-scores")
            for r in auc_many(x, list(by_name), digits=12).collect():
                areas.setdefault(by_name[r["score"]], []).append(r["auc"] if r["auc"] is not None else 0.0)
    finally:
        for t in trainers:
            t.close()
        workers.shutdown()
    found = []
    for c in candidates_of(grid):
        key = (others.index({k: v for k, v in c.items() if k not in shared}), depths.index(c["maxDepth"]) if depths else 0, c.get(count, counts[-1]))
        found.append(sum(areas[key]) / folds)
    return _report(train.sparkSession, candidates_of(grid), found)


def fit_best(train: DataFrame, spec: TableSpec, name: str, report: DataFrame, **params):
    """H3: the best candidate of a report fitted on all rows: (model, its parameters as rows)."""
    best = json.loads(report.where("is_best").first()["params"])
    model = train_pipeline(train, spec, name, **{**params, **best})
    return model, parameter_rows(train.sparkSession, model.stages[-1])


def parameter_rows(spark: SparkSession, model) -> DataFrame:
    """``(param, value)`` of a fitted classifier, values as JSON text."""
    rows = sorted((p.name, json.dumps(v, default=str)) for p, v in model.extractParamMap().items())
    return spark.createDataFrame(rows, "param string, value string")


def best_parameters(spark: SparkSession, cv_model) -> DataFrame:
    """H3: ``(param, value)`` of the best model's classifier, values as JSON text."""
    return parameter_rows(spark, cv_model.bestModel.stages[-1])


def leaf_values(model, depths: list[int] | None = None) -> np.ndarray:
    """(trees, leaves) what each leaf adds to the score: a boosted tree's weighted prediction, or a forest
    tree's share of class 1. Leaves stand in preorder, as ``leafCol`` numbers them; read from the model's
    own saved node table. With ``depths``, of a forest: (depths, trees, leaves), the values that the leaf's rows get in
    the same trees grown to each depth only: the node at that depth, or the topmost one above it whose
    rows all end in the same class there, as MLlib merges such leaves."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "ensemble")
    model.write().overwrite().save(path)
    boosted = "GBT" in type(model).__name__
    if boosted and depths:
        raise ValueError("the trees of a boosted model depend on those before, grown to the model's own depth")
    node = F.col("nodeData")
    value = node["prediction"] if boosted else node["impurityStats"][1] / F.greatest(F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, x: a + x), F.lit(1e-300))
    nodes = spark.read.parquet(f"{path}/data")
    if not depths:
        nodes = nodes.where(node["leftChild"] < 0)
    table = nodes.select("treeID", node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
                         node["prediction"].alias("prediction"), value.alias("value")).toArrow()
    t = {c: table[c].to_numpy() for c in table.column_names}
    order = np.lexsort((t["id"], t["treeID"]))
    t = {c: x[order] for c, x in t.items()}
    starts = np.searchsorted(t["treeID"], np.arange(len(model.treeWeights) + 1))
    trees = [{c: x[a:b] for c, x in t.items()} for a, b in zip(starts, starts[1:])]
    out = np.zeros((len(depths or [0]), len(trees), max(int((x["left"] < 0).sum()) for x in trees)))
    for i, tree in enumerate(trees):
        for j, depth in enumerate(depths or [0]):
            x = _cut_values(tree, depth) if depths else tree["value"] * (model.treeWeights[i] if boosted else 1.0)
            out[j, i, :len(x)] = x
    return out if depths else out[0]


def _cut_values(tree: dict[str, np.ndarray], depth: int) -> np.ndarray:
    """The value of every leaf (preorder) in the tree cut at ``depth``."""
    left, right, kind = tree["left"], tree["right"], tree["prediction"]
    level = np.zeros(len(left), dtype=int)
    for n in range(len(left)):  # ids are in preorder: a node stands before its children
        if left[n] >= 0:
            level[left[n]] = level[right[n]] = level[n] + 1
    ends = (left < 0) | (level >= depth)
    for n in range(len(left) - 1, -1, -1):
        if not ends[n]:
            a, b = left[n], right[n]
            ends[n] = ends[a] and ends[b] and kind[a] == kind[b]
    at = np.arange(len(left))
    for n in range(len(left)):
        if left[n] >= 0:
            at[left[n]], at[right[n]] = (at[n], at[n]) if ends[n] else (left[n], right[n])
    return tree["value"][at[left < 0]]


def running_scores(model, x: DataFrame, counts: list[int], out: str, features: str = "features", depths: list[int] | None = None) -> DataFrame:
    """Add ``out``: array<double>, the score of the first k trees for every k of ``counts`` (boosting: the
    margin, forest: the mean share of class 1); with ``depths``, of the trees cut at each of them, one depth after another."""
    values = leaf_values(model, depths)
    mean = "GBT" not in type(model).__name__
    shared = x.sparkSession.sparkContext.broadcast(values if depths else values[None])  # as large as the model
    at = np.array(counts) - 1

    @F.arrow_udf("array<double>")
    def scores(leaves: pa.Array) -> pa.Array:
        table = shared.value
        trees = table.shape[1]
        leaf = leaves.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, trees)
        total = np.concatenate([np.cumsum(one[np.arange(trees), leaf], axis=1)[:, at] / (at + 1 if mean else 1) for one in table], axis=1)
        offsets = np.arange(0, total.size + 1, total.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(total.ravel()))

    leaf = "_leaf"
    quiet = model.copy({model.leafCol: leaf, model.predictionCol: "", model.probabilityCol: "", model.rawPredictionCol: ""})
    marked = quiet.setFeaturesCol(features).transform(x)
    return marked.withColumn(out, scores(vector_to_array(F.col(leaf)))).drop(leaf)


def score_columns(models: list, x: DataFrame, counts: list[int], names: dict[tuple[int, int, int], str], features: str = "features",
                  depths: list[int] | None = None) -> DataFrame:
    """``label`` and one score column for every (model, depth of ``depths``, count) of ``names``, in one projection."""
    if isinstance(models[0], boosting.Boosted):
        x = boosting.margins(models, x, counts, "_all", features)
        return x.select("label", *[F.col("_all")[i * len(counts) + counts.index(k)].alias(n) for (i, _, k), n in names.items()])
    for i, m in enumerate(models):
        x = running_scores(m, x, counts, f"_r{i}", features, depths)
    at = {(d, k): i for i, (d, k) in enumerate(product(range(len(depths or [0])), counts))}
    return x.select("label", *[F.col(f"_r{i}")[at[d, k]].alias(n) for (i, d, k), n in names.items()])


def tree_prefix_scores(model, x: DataFrame, counts: list[int], features: str = "features",
                       threshold: float = 0.5) -> DataFrame:
    """H6: accuracy / recall / precision of the first ``k`` trees of a fitted GBT for every ``k``.

    Margin of ``k`` trees = sum of ``weight_i * tree_i(x)``; probability = 1 / (1 + exp(-2 margin))
    (logistic loss). Every row's running margins are unpivoted and counted in one aggregate.
    """
    counts = sorted(set(counts))
    have = len(model.treeWeights)
    m = running_scores(model, x, [min(k, have) for k in counts], "_margins", features)
    return _by_position(m.select("label", F.posexplode("_margins").alias("pos", "margin")), counts, threshold)


def _by_position(margins: DataFrame, names: list, threshold: float = 0.5) -> DataFrame:
    """``(trees, accuracy, recall, precision)`` of ``(label, pos, margin)`` rows; ``trees`` = names[pos]."""
    pred = 1.0 / (1.0 + F.exp(-2.0 * F.col("margin"))) > threshold
    yes = F.col("label") == 1
    e = margins.groupBy("pos").agg(F.count_if(yes & pred).alias("tp"), F.count_if(~yes & pred).alias("fp"),
                                   F.count_if(yes & ~pred).alias("fn"), F.count_if(~yes & ~pred).alias("tn"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pos") + 1)
    return e.select(
        name.alias("trees"),
        F.round((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")), 6).alias("accuracy"),
        F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), 6).alias("recall"),
        F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), 6).alias("precision"))


#: Models whose scores of a hold-out row stand side by side in one pass.
MODELS_A_PASS = 10


def sweep(train_x: DataFrame, holdout_x: DataFrame, rates: list[float], trees: list[int], max_depth: int = 3,
          seed: int = 420, parallelism: int = 16, features: str = "features") -> DataFrame:
    """GBT over learning rates x tree counts; one fit per rate (at the largest count), smaller
    counts from its prefixes. All fits grow in step (``boosting``) and are scored in one pass over the hold-out; where the
    features have too many values for that, fits run concurrently, and ``MODELS_A_PASS`` of them are scored in one pass. ``(rate, trees, accuracy, recall, precision, is_best)``: a row a parameter is the
    curve, ``is_best`` marks the highest accuracy (C23; ties: the first by rate, then trees)."""
    counts = sorted(set(trees))
    checkpoint_root(train_x.sparkSession)

    settings = [{"maxIter": counts[-1], "stepSize": rate, "maxDepth": max_depth, "seed": seed} for rate in rates]

    def fit(params: dict):
        return make_classifier("gbt", features=features, **params).fit(train_x)

    training = boosting.Rows.of(train_x, features) if all(map(boosting.takes, settings)) else None
    if training is not None:
        models = boosting.fit(training, settings)
    else:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            models = list(ex.map(fit, settings))
    rows = []
    a_pass = MODELS_A_PASS if training is None else len(models)
    for a in range(0, len(models), a_pass):
        x = holdout_x
        some = models[a:a + a_pass]
        if training is not None:
            x = boosting.margins(some, x, counts, "_m", features)
        for i, m in enumerate(some if training is None else []):
            if len(counts) == 1:  # the model's own margin
                own = m.copy({m.rawPredictionCol: f"_w{i}", m.probabilityCol: "", m.predictionCol: ""})
                x = own.transform(x).withColumn(f"_m{i}", F.array(vector_to_array(F.col(f"_w{i}"))[1])).drop(f"_w{i}")
            else:
                x = running_scores(m, x, counts, f"_m{i}", features)
        every = F.col("_m") if training is not None else F.flatten(F.array(*[F.col(f"_m{i}") for i in range(len(some))]))
        names = list(range(len(some) * len(counts)))
        for r in _by_position(x.select("label", F.posexplode(every).alias("pos", "margin")), names).collect():
            i, k = divmod(r["trees"], len(counts))
            rows.append((float(rates[a + i]), int(counts[k]), r["accuracy"], r["recall"], r["precision"]))
    rows.sort()
    best = max(range(len(rows)), key=lambda i: (rows[i][2] if rows[i][2] is not None else -1.0, -i))
    return train_x.sparkSession.createDataFrame(
        [(*r, i == best) for i, r in enumerate(rows)],
        "rate double, trees int, accuracy double, recall double, precision double, is_best boolean")
