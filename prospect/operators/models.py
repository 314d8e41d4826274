"""Classifiers, training, batch scoring and model comparison.

Training fits the encoding stages on the training rows, then persists only the narrow
``(label, features)`` frame that the iterative learners read many times, so the scan, joins and
windows upstream run once per fit instead of once per iteration. The rows are hash-partitioned by
their id, into partitions whose number grows with the rows, and sorted inside them, so a fit doesn't
depend on the input's layout or the cluster. Numerics enter tree learners as at most ``BINS`` quantile
bins, so that the split candidates, and with them decision and boosted trees, don't depend on the number
of partitions either (a forest's bootstrap is drawn partition by partition and does). The fitted feature
stages and the classifier are saved together as one ``PipelineModel`` without the label, which scores new rows, labelled or
not, as a single narrow projection (no shuffle).
"""

from __future__ import annotations

from threading import Lock

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospect.operators import boosting
from prospect.operators.features import bin_borders, encoding_stages, feature_count, labelled
from prospect.session import checkpoint_root, stored
from prospect.spec import CONTACTS, TableSpec

# The classifier settings of the original notebooks.
REFERENCE_PARAMS = {
    "lr": {"maxIter": 20},
    "dt": {"maxDepth": 30, "maxBins": 50},
    "rf": {"numTrees": 20, "maxDepth": 30, "seed": 420},
    "gbt": {"maxIter": 60, "stepSize": 0.01, "maxDepth": 5, "seed": 420},
    "svc": {},
    "mlp": {"hidden": [100, 100, 100], "tol": 1e-7, "seed": 420},
}


#: Depth from which boosted fits write their margins to the shared folder after every tree, not after ten.
DEEP_BOOSTED = 10


#: Depth from which trees and forests keep the node of every row between levels.
DEEP_NODE_IDS = 10


def make_classifier(name: str, n_features: int | None = None, features: str = "features", **params):
    """Estimator by short name with the original settings, overridable by ``params``."""
    p = {**REFERENCE_PARAMS[name], **params}
    common = {"labelCol": "label", "featuresCol": features}
    if name == "lr":
        return LogisticRegression(**common, **p)
    # Deep trees keep each row's node: the same tree, but no pass sends all trees made so far to every task.
    # Shallow ones are small; many of them would keep as many numbers a row, several times over.
    if name == "dt":
        return DecisionTreeClassifier(**common, **{"cacheNodeIds": p["maxDepth"] >= DEEP_NODE_IDS, **p})
    if name == "rf":
        return RandomForestClassifier(**common, **{"cacheNodeIds": p["maxDepth"] >= DEEP_NODE_IDS, **p})
    if name == "gbt":
        # Every task is sent the trees since the last checkpoint of the margins; deep ones are large.
        often = {"checkpointInterval": 1} if p["maxDepth"] >= DEEP_BOOSTED else {}
        return GBTClassifier(**common, **{**often, **p})
    if name == "svc":
        return LinearSVC(**common, **p)
    if name == "mlp":
        if n_features is None:
            raise ValueError("mlp needs the feature count (read it from the vector metadata)")
        hidden = p.pop("hidden")
        return MultilayerPerceptronClassifier(**common, layers=[n_features, *hidden, 2], **p)
    raise ValueError(name)


#: Rows of a training partition. The multilayer perceptron works far longer on a row.
ROWS_A_PARTITION = 20_000
ROWS_A_PARTITION_MLP = 2_000


#: Partitions up to which those sizes hold, and rows of a partition of larger tables. An iterative learner runs some
#: hundred jobs, and each brings a task result a partition to the driver and shuffles all node statistics a partition.
SMALL_PARTITIONS = 24
MOST_ROWS_A_PARTITION = 400_000
MOST_ROWS_A_PARTITION_MLP = 100_000


def train_partitions(n_rows: int, rows_a_partition: int = ROWS_A_PARTITION) -> int:
    return max(1, -(-n_rows // rows_a_partition))


def fit_partitions(n_rows: int, rows_a_partition: int = ROWS_A_PARTITION, most_rows: int = MOST_ROWS_A_PARTITION,
                   together: int = 1) -> int:
    """Partitions of a training table of ``n_rows``, of which ``together`` fits are read side by side: many small ones up
    to ``SMALL_PARTITIONS``, shared among the fits; of larger tables as many as keep ``most_rows`` a partition."""
    few = min(train_partitions(n_rows, rows_a_partition), SMALL_PARTITIONS)
    return max(-(-few // max(1, together)), train_partitions(n_rows, most_rows))


class Trainer:
    """Fit encoders once on training rows, then any number of classifiers on the cached features.

    ``binned`` numerics suit the tree learners, plain ones the others. ``oversample`` turns the labelled
    training rows into more (see ``smote.oversampled``) after the encoders have been fitted on the rows
    as they are; only the learner sees the new ones. ``together`` fits at a time read the rows (for
    learners that don't depend on the number of partitions).
    """

    def __init__(self, train: DataFrame, spec: TableSpec, handle_invalid: str = "keep", scale: bool = False,
                 partitions: int | None = None, binned: bool = True, oversample=None, together: int = 1):
        # Iterative learners cut their lineage every few iterations into the shared folder.
        checkpoint_root(train.sparkSession)
        self.spec = spec
        # The encoder fits (imputer means, category counts) and the learners read these rows again
        # and again: keep the narrow input once, in its fixed layout, instead of its joins per pass.
        keep = [c for c in (spec.id, *spec.categorical, *spec.numeric) if c in train.columns]
        rows = stored(labelled(train, spec).where(F.col("label").isNotNull()).select("label", *keep), "train-rows")
        borders = bin_borders(rows, list(spec.numeric)) if binned and spec.numeric else None
        stages = encoding_stages(spec, handle_invalid=handle_invalid, borders=borders)
        if scale:
            stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=False, withStd=True))
        self.features_model = Pipeline(stages=stages).fit(rows)
        if oversample is not None:
            rows = stored(oversample(rows), "train-oversampled")
        sizes = (ROWS_A_PARTITION_MLP, MOST_ROWS_A_PARTITION_MLP) if scale else (ROWS_A_PARTITION, MOST_ROWS_A_PARTITION)
        self.n_rows = rows.count()
        partitions = partitions or fit_partitions(self.n_rows, *sizes, together)
        rows = rows.repartition(partitions, spec.id).sortWithinPartitions(*rows.columns)
        x = self.features_model.transform(rows)
        self.features_col = "scaled" if scale else "features"
        self.x = x.select("label", self.features_col).persist(StorageLevel.MEMORY_AND_DISK)
        self.n_features = feature_count(x, "features")
        self._lock, self._boosting = Lock(), None

    def boosting_rows(self):
        """The rows as ``boosting.fit`` takes them, read once for all fits; ``None`` if it can't."""
        with self._lock:
            if self._boosting is None:
                self._boosting = (boosting.Rows.of(self.x, self.features_col),)
            return self._boosting[0]

    def features(self, df: DataFrame, *keep: str) -> DataFrame:
        """Label (where ``df`` has one), features and the columns ``keep`` of other rows."""
        x = self.features_model.transform(labelled(df, self.spec) if self.spec.label in df.columns else df)
        return x.select(*[c for c in ("label",) if c in x.columns], self.features_col, *keep)

    def fit(self, name: str, **params) -> PipelineModel:
        clf = make_classifier(name, self.n_features, features=self.features_col, **params)
        settings = {**REFERENCE_PARAMS[name], **params}
        rows = self.boosting_rows() if name == "gbt" and boosting.takes(settings) else None
        if rows is not None:
            model = boosting.as_model(boosting.fit(rows, [settings], squares=True)[0], clf, self.x.sparkSession)
        else:
            model = clf.fit(self.x)
        return PipelineModel(stages=[*self.features_model.stages, model])

    def close(self) -> None:
        self.x.unpersist()


#: Learners that take binned numerics.
TREES = ("dt", "rf", "gbt")


def train_pipeline(train: DataFrame, spec: TableSpec, name: str = "gbt", partitions: int | None = None, oversample=None,
                   **params) -> PipelineModel:
    """Encoding stages + classifier fitted on ``train`` as one saved-able model."""
    t = Trainer(train, spec, scale=(name == "mlp"), partitions=partitions, binned=name in TREES, oversample=oversample)
    try:
        return t.fit(name, **params)
    finally:
        t.close()


def unfitted_pipeline(spec: TableSpec, name: str = "gbt", **params) -> Pipeline:
    """The whole estimator (encoding and classifier) before any fit, to be saved and fitted
    elsewhere on rows that ``labelled`` has given a label."""
    return Pipeline(stages=[*encoding_stages(spec), make_classifier(name, **params)])


def score(df: DataFrame, model: PipelineModel, id_col: str | None = None, spec: TableSpec = CONTACTS) -> DataFrame:
    """``(id, label, prediction, p1)``; ``p1`` is the class-1 probability (raw margin for SVM).
    Rows of a table without the label column are scored all the same and have no ``label``."""
    out = model.transform(labelled(df, spec) if spec.label in df.columns else df)
    if "probability" in out.columns:
        p1 = vector_to_array("probability")[1]
    else:
        p1 = vector_to_array("rawPrediction")[1]
    keep = [c for c in (id_col, "label") if c and c in out.columns]
    return out.select(*keep, "prediction", p1.alias("p1"))


def save(model: PipelineModel, path: str) -> None:
    """Overwrite-save a (fitted or unfitted) pipeline."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """Load a fitted pipeline."""
    return PipelineModel.load(path)


def load_classifier(path: str):
    """Load a lone fitted classifier with its *model* class, read from the saved metadata
    (the original loaded the estimator class, whose result cannot ``transform``)."""
    from pyspark import SparkContext
    from pyspark.ml import classification as C
    from pyspark.ml.util import DefaultParamsReader
    meta = DefaultParamsReader.loadMetadata(path, SparkContext.getOrCreate())
    return getattr(C, meta["class"].rsplit(".", 1)[-1]).load(path)
