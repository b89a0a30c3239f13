"""Training and scoring.

A forest of two classes is grown by MLlib as regression trees on 0 and 1: their variance is half
the Gini impurity, so the splits are those of classification, a leaf's mean is the chance of
the second class, and MLlib merges only leaves whose chances are equal. (Its classifiers merge
all neighbours that predict the same class, and the chances with them.) What MLlib cannot do,
several classes with their chances, other criteria, splits at every value, larger limits of
rows and depth, is grown by ``trees``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from numbers import Real

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from rowmill.functions import join_path, new_folder, quoted, require_columns, stored
from rowmill.operators.newton import LinearModel, fit_newton, load_linear, save_linear
from rowmill.operators.trees import (
    TreeModel, TreeSettings, fit_trees, load_trees, save_trees, walk,
)

# Algorithm names and default hyper-parameters.
ALGORITHMS = ("random_forest", "logistic_regression")
FOREST_DEFAULTS = {
    "n_estimators": 100,
    "max_depth": 10,
    "min_samples_split": 2,
    "min_samples_leaf": 1,
    "random_state": 42,
}
LOGISTIC_DEFAULTS = {"C": 1.0, "solver": "lbfgs", "max_iter": 1000, "random_state": 42}

# Names of the solvers, MLlib's and the one by Newton steps.
SOLVERS = ("lbfgs", "newton-cholesky")

# Split criteria by either name.
IMPURITIES = {"gini": "gini", "entropy": "entropy", "log_loss": "entropy"}

# Accepted for compatibility; the cluster decides parallelism and logging.
WITHOUT_EFFECT = ("n_jobs", "verbose")
FOREST_OPTIONS = (*FOREST_DEFAULTS, "criterion", "max_features", "bootstrap", "max_samples",
                  "max_bins", "class_weight", "memory_mb", "cache_nodes", "checkpoint_interval",
                  *WITHOUT_EFFECT)
LOGISTIC_OPTIONS = (*LOGISTIC_DEFAULTS, "penalty", "l1_ratio", "fit_intercept", "tol",
                    "class_weight", "aggregation_depth", *WITHOUT_EFFECT)
MAX_TREE_DEPTH = 30

# Rows are laid out in one partition per so many rows and at least so many partitions, unless
# the caller names a number. A forest depends on it, so it never comes from the session.
ROWS_PER_PARTITION = 250_000
LEAST_PARTITIONS = 8


class ForestModel(RandomForestRegressionModel):
    """Fitted forest that wraps its trees in Python objects when asked for them, not
    when it is created: for 100 trees that takes seconds."""

    @property
    def trees(self):
        return super().trees


class Forest(RandomForestRegressor):
    """Forest whose fit returns a ForestModel."""

    def _create_model(self, java_model):
        return ForestModel(java_model)


def check_algorithm(algorithm: str) -> None:
    """Raise ValueError for anything but the known algorithms."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm!r}; use one of {list(ALGORITHMS)}")


def _merged(defaults: Mapping, options: Sequence[str], params: Mapping | None) -> dict:
    unknown = sorted(set(params or {}) - set(options))
    if unknown:
        raise TypeError(f"unknown model parameters: {unknown}")
    return {**defaults, **(params or {})}


def forest_params(params: Mapping | None = None) -> dict:
    """The parameters of a forest with their defaults; ValueError for impossible ones."""
    p = _merged(FOREST_DEFAULTS, FOREST_OPTIONS, params)
    depth, least = p["max_depth"], p["min_samples_split"]
    if depth is not None and (not isinstance(depth, int) or depth < 0):
        raise ValueError(f"max_depth must be None or 0 at least, got {depth}")
    if not (isinstance(least, int) and least >= 2 or isinstance(least, float) and 0 < least <= 1):
        raise ValueError(f"min_samples_split must be 2 rows at least or a share of them, got {least}")
    if not isinstance(p["min_samples_leaf"], int) or p["min_samples_leaf"] < 1:
        raise ValueError("min_samples_leaf must be a number of rows")
    criterion = p.setdefault("criterion", "gini")
    if criterion not in IMPURITIES:
        raise ValueError(f"unknown criterion {criterion!r}")
    share = p.setdefault("max_samples", None)
    if share is not None and not isinstance(share, float):
        raise ValueError("max_samples must be a share of the rows")
    p.setdefault("max_features", "sqrt")
    p.setdefault("bootstrap", True)
    p.setdefault("max_bins", 32)
    return p


def needs_own_trees(params: Mapping | None, n_classes: int) -> bool:
    """Whether a forest is beyond MLlib's regression trees."""
    p = forest_params(params)
    deep = p["max_depth"] is None or p["max_depth"] > MAX_TREE_DEPTH
    other = p["min_samples_split"] != 2 or p["max_bins"] is None or IMPURITIES[p["criterion"]] != "gini"
    return n_classes > 2 or deep or other


def forest_settings(params: Mapping | None = None) -> dict:
    """MLlib settings of a forest of two classes.

    Splits are searched over ``max_bins`` quantile bins per feature.
    """
    p = forest_params(params)
    share, max_features = p["max_samples"], p["max_features"]
    return {
        "numTrees": p["n_estimators"],
        "maxDepth": p["max_depth"],
        "minInstancesPerNode": p["min_samples_leaf"],
        "seed": p["random_state"],
        "impurity": "variance",
        "featureSubsetStrategy": "all" if max_features is None else str(max_features),
        "bootstrap": p["bootstrap"],
        "maxBins": p["max_bins"],
        "subsamplingRate": 1.0 if share is None else share,
        # more nodes per pass over the rows than MLlib's default allows
        "maxMemoryInMB": p.get("memory_mb", 1024),
        "cacheNodeIds": p.get("cache_nodes", False),
        "checkpointInterval": p.get("checkpoint_interval", 10),
    }


def tree_settings(params: Mapping | None, n_rows: int, n_features: int) -> TreeSettings:
    """Settings of a forest of our own growing."""
    p = forest_params(params)
    least, looked = p["min_samples_split"], p["max_features"]
    if looked in (None, "all", "auto"):
        number = n_features
    elif looked in ("sqrt", "log2"):
        number = int(math.sqrt(n_features) if looked == "sqrt" else math.log2(n_features))
    elif isinstance(looked, (int, float)):
        number = int(looked * n_features) if isinstance(looked, float) else looked
    else:
        raise ValueError(f"unknown max_features {looked!r}")
    return TreeSettings(
        trees=p["n_estimators"], depth=p["max_depth"],
        min_split=max(2, math.ceil(least * n_rows)) if isinstance(least, float) else least,
        min_leaf=p["min_samples_leaf"], features=min(n_features, max(1, number)), bins=p["max_bins"],
        bootstrap=p["bootstrap"], share=1.0 if p["max_samples"] is None else p["max_samples"],
        criterion=IMPURITIES[p["criterion"]], seed=p["random_state"],
    )


def logistic_settings(rows: float, params: Mapping | None = None) -> dict:
    """MLlib settings of a penalised regression for ``rows`` training rows, or for their
    weight if rows are weighted.

    MLlib minimises the mean loss, so a penalty of 1/C on the summed loss becomes
    1/(C * rows). The intercept is not penalised.
    """
    p = _merged(LOGISTIC_DEFAULTS, LOGISTIC_OPTIONS, params)
    if p["solver"] not in SOLVERS:
        raise ValueError(f"unknown solver {p['solver']!r}; use one of {list(SOLVERS)}")
    penalty = p.get("penalty", "l2")
    if p["solver"] != "lbfgs" and penalty not in ("l2", None):
        raise ValueError(f"the solver {p['solver']} takes the penalty l2 or None, got {penalty!r}")
    shares = {"l2": 0.0, "l1": 1.0, None: 0.0, "elasticnet": p.get("l1_ratio")}
    if penalty not in shares:
        raise ValueError(f"unknown penalty {penalty!r}; use one of {list(shares)}")
    if penalty == "elasticnet" and not (
        isinstance(p.get("l1_ratio"), Real) and 0 <= p["l1_ratio"] <= 1
    ):
        raise ValueError("the elasticnet penalty needs l1_ratio between 0 and 1")
    if not isinstance(p["C"], Real) or p["C"] <= 0:
        raise ValueError(f"C must be positive, got {p['C']}")
    return {
        "regParam": 0.0 if penalty is None else 1.0 / (p["C"] * max(rows, 1)),
        "elasticNetParam": float(shares[penalty]),
        "standardization": False,
        "fitIntercept": p.get("fit_intercept", True),
        "maxIter": p["max_iter"],
        "tol": p.get("tol", 1e-9),
        "aggregationDepth": p.get("aggregation_depth", 2),
    }


def check_params(algorithm: str, params: Mapping | None = None) -> None:
    """Reject a wrong algorithm or parameter before any data is read."""
    check_algorithm(algorithm)
    if algorithm == "random_forest":
        forest_params(params)
    else:
        logistic_settings(1, params)


def canonical_layout(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows placed by key hash and ordered by key inside each partition.

    Bagging draws per partition, so a forest depends on the layout; with this one
    it depends on rows, seed and partition count only. A fixed count is not
    coalesced at run time.
    """
    return df.repartition(partitions, F.col(quoted(key))).sortWithinPartitions(F.col(quoted(key)))


def class_table(rows: DataFrame, target: str) -> DataFrame:
    """(value, n): the classes in ascending order. A model holds numbers for each class, so
    there are as few of them as a model can have."""
    counts = rows.groupBy(F.col(quoted(target)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("value")


def class_weights(classes: Sequence, counts: Sequence[int], given) -> list[float] | None:
    """A weight per class: None, "balanced" (rows / (classes * rows of the class)) or a
    mapping from class to weight, 1 where it names none."""
    if given is None:
        return None
    if given == "balanced":
        return [sum(counts) / (len(counts) * n) for n in counts]
    if not isinstance(given, Mapping):
        raise ValueError(f"class_weight must be None, 'balanced' or a mapping, got {given!r}")
    unknown = [c for c in given if c not in classes]
    if unknown:
        raise ValueError(f"class_weight names classes the rows lack: {unknown}")
    return [float(given.get(c, 1.0)) for c in classes]


def _literal(value, kind: str) -> str:
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind})"


def train_model(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    algorithm: str = "random_forest",
    params: Mapping | None = None,
    partitions: int | None = None,
) -> PipelineModel | TreeModel | LinearModel:
    """Fit a classifier on classes of any type; predictions are of the same type.

    Classes are numbered in ascending order. The rows are laid out by key in
    ``partitions`` parts, by default a number that follows from the rows alone, and kept for
    the duration of the fit, in memory or on executor disks; lost ones are read again. The
    model remembers classes and partitions.
    """
    check_params(algorithm, params)
    require_columns(df, [key, target, *features])
    columns = [F.col(quoted(c)) for c in (key, target, *features)]
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    found = class_table(df, target).collect()
    classes, counts = [r["value"] for r in found], [r["n"] for r in found]
    if any(c is None for c in classes):
        raise ValueError(f"{target} has missing values")
    partitions = partitions or max(LEAST_PARTITIONS, -(-sum(counts) // ROWS_PER_PARTITION))
    kind = df.schema[target].dataType.simpleString()
    names = "array(" + ", ".join(_literal(c, kind) for c in classes) + ")"
    weights = class_weights(classes, counts, (params or {}).get("class_weight"))
    label = F.expr(f"CAST(array_position({names}, {quoted(target)}) - 1 AS DOUBLE)")
    if algorithm == "random_forest" and needs_own_trees(params, len(classes)):
        settings = tree_settings(params, sum(counts), len(features))
        return fit_trees(df, features, label, key, classes, kind, settings, weights)
    if algorithm == "logistic_regression" and (params or {}).get("solver") == "newton-cholesky":
        p = logistic_settings(1, params)
        return fit_newton(
            df, features, label, classes, kind, p["regParam"], p["fitIntercept"], weights, p["maxIter"], p["tol"]
        )
    laid_out = canonical_layout(df.select(*columns), key, partitions)
    ready = assembler.transform(laid_out).select(label.alias("_label"), "_features")
    if weights:
        weight = F.get(F.lit(weights), F.col("_label").cast("int"))
        ready = ready.withColumn("_weight", weight)
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if algorithm == "random_forest":
            estimator = Forest(**forest_settings(params))
        else:
            total = sum(n * w for n, w in zip(counts, weights or [1.0] * len(counts)))
            estimator = LogisticRegression(**logistic_settings(total, params))
        if weights:
            estimator = estimator.setWeightCol("_weight")
        estimator = estimator.setFeaturesCol("_features").setLabelCol("_label")
        if algorithm == "random_forest":
            # of two classes the mean is the second one's chance; one alone is certain
            number = "1" if len(classes) == 1 else "IF(_chance > 0.5D, 2, 1)"
            chances = "array(1D)" if len(classes) == 1 else "array(1D - _chance, _chance)"
            fitted = estimator.setPredictionCol("_chance").fit(ready)
        else:
            estimator = estimator.setRawPredictionCol("_raw").setProbabilityCol("_probability")
            number, chances = "CAST(_prediction AS INT) + 1", "CAST(NULL AS ARRAY<DOUBLE>)"
            fitted = estimator.setPredictionCol("_prediction").fit(ready)
    finally:
        ready.unpersist()
    named = SQLTransformer(
        statement=f"SELECT *, element_at({names}, {number}) AS _class, {chances} AS _chances, "
        f"{int(partitions)} AS _partitions FROM __THIS__"
    )
    return PipelineModel([assembler, fitted, named])


def _transformed(model: PipelineModel | TreeModel | LinearModel, df: DataFrame) -> DataFrame:
    """The table with ``_class`` and ``_chances``."""
    if isinstance(model, TreeModel):
        found = walk(model.nodes, df, model.key, model.features)
        found = found.select(F.col(quoted(model.key)).alias("_key"), F.col("chances").alias("_chances"))
        joined = df.join(found, F.col(quoted(model.key)) == F.col("_key"))
        # of equal chances the first class
        best = F.array_position("_chances", F.array_max("_chances")).cast("int")
        return joined.withColumn("_class", F.get(model.class_array(), best - 1))
    if isinstance(model, LinearModel):
        both = df.withColumn("_chance", model.chance()).withColumn("_chances", F.array(1 - F.col("_chance"), "_chance"))
        return both.withColumn("_class", F.get(model.class_array(), (F.col("_chance") > 0.5).cast("int")))
    found = model.transform(df)
    if "_probability" in found.columns:
        found = found.withColumn("_chances", vector_to_array("_probability"))
    return found


def predict(model: PipelineModel | TreeModel | LinearModel, df: DataFrame) -> DataFrame:
    """Add ``y_pred``, the class label as it was in training."""
    columns = [F.col(quoted(c)) for c in df.columns]
    return _transformed(model, df).select(*columns, F.col("_class").alias("y_pred"))


def predict_proba(model: PipelineModel | TreeModel | LinearModel, df: DataFrame) -> DataFrame:
    """Add ``y_proba``, an array with the probabilities of the classes in ascending order."""
    columns = [F.col(quoted(c)) for c in df.columns]
    return _transformed(model, df).select(*columns, F.col("_chances").alias("y_proba"))


def score(model: PipelineModel | TreeModel | LinearModel, df: DataFrame) -> DataFrame:
    """Add ``y_pred`` and ``y_pred_proba``, the probability of the second class in
    ascending order, in one pass."""
    columns = [F.col(quoted(c)) for c in df.columns]
    return _transformed(model, df).select(
        *columns,
        F.col("_class").alias("y_pred"),
        F.get("_chances", F.lit(1)).alias("y_pred_proba"),
    )


def store_model(model: PipelineModel | TreeModel | LinearModel, path: str) -> None:
    """Write a fitted model, replacing an older one of either kind."""
    if isinstance(model, TreeModel):
        _folder(model.nodes.sparkSession, path, delete=True)
        save_trees(model, path)
    elif isinstance(model, LinearModel):
        _folder(SparkSession.active(), path, delete=True)
        save_linear(SparkSession.active(), model, path)
    else:
        model.write().overwrite().save(path)


def read_model(spark: SparkSession, path: str) -> PipelineModel | TreeModel | LinearModel:
    """A model written by store_model."""
    if _folder(spark, join_path(path, "nodes")):
        return load_trees(spark, path)
    if _folder(spark, join_path(path, "linear")):
        return load_linear(spark, path)
    return PipelineModel.load(path)


def _folder(spark: SparkSession, path: str, delete: bool = False) -> bool:
    """Whether the folder exists, in whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files.delete(folder, True) if delete else files.exists(folder)


def forest_nodes(model: PipelineModel | TreeModel) -> DataFrame:
    """The node table (tree, node, feature, threshold, n, chances) of a forest, numbered and
    read as ``trees`` describes; a forest that MLlib has grown is exported once, by level."""
    if isinstance(model, TreeModel):
        return model.nodes
    forest = next((s for s in model.stages if isinstance(s, RandomForestRegressionModel)), None)
    if forest is None:
        raise ValueError("the model is no forest")
    spark = SparkSession.active()
    folder = new_folder(spark)
    forest.write().save(folder)
    saved = stored(spark.read.parquet(join_path(folder, "data")).select(F.col("treeID").alias("tree"), "nodeData.*"))
    chance = F.col("prediction")
    found, numbered = [], saved.where("id = 0").select("tree", F.col("id").alias("own"), F.lit(1).cast("long").alias("node"))
    while not numbered.isEmpty():
        here = stored(numbered.join(saved.withColumnRenamed("id", "own"), ["tree", "own"]))
        inner = F.col("leftChild") >= 0
        found.append(here.select(
            "tree", "node",
            F.when(inner, F.col("split.featureIndex")).cast("int").alias("feature"),
            F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
            F.col("rawCount").cast("long").alias("n"), F.array(1 - chance, chance).alias("chances"),
        ))
        sides = F.array(
            F.struct(F.col("leftChild").alias("own"), (2 * F.col("node")).alias("node")),
            F.struct(F.col("rightChild").alias("own"), (2 * F.col("node") + 1).alias("node")),
        )
        numbered = here.where(inner).select("tree", F.inline(sides))
    nodes = found[0]
    for level in found[1:]:
        nodes = nodes.unionByName(level)
    return stored(nodes)
