"""Forests grown level by level with grouped counts, and scored by joining a node table.

For the rows of a node the best split of a feature follows from the class counts of its
distinct values: each value's counts are summed up to it, and the rest lies above. One
level is one aggregation over (tree, node, feature, value). The prefix sums run inside ranges
of values, and one row per range carries what lies before, so neither a root nor a feature
with many distinct values is the work of one task. Nothing is binned unless bins are asked
for, and no leaf is merged with another.

A forest is a table (tree, node, feature, threshold, chances): node 1 is a root, 2 n and
2 n + 1 are the children of n, rows with a value up to the threshold go to 2 n, and leaves have
no feature. Rows are scored by joining it once per level. Which rows a tree draws and which
features a node looks at depends on digests of seed, tree and key or node only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rowmill.functions import join_path, quoted, require_columns, stored

#: Node numbers are 64-bit: a tree ends here, whatever depth is asked for.
DEEPEST = 61
#: Rows of a range of values, and ranges of a feature, at most.
ROWS_PER_RANGE, MAX_RANGES = 100_000, 4096
#: Accuracy of the quantiles that bins and ranges are cut at.
ACCURACY = 100_000
NODES = "tree int, node long, feature int, threshold double, n long, chances array<double>"


@dataclass(frozen=True)
class TreeSettings:
    """Parameters of a forest; ``bins`` None searches every value, ``features`` is the number
    that a node looks at, ``share`` the rows a tree draws (with replacement: on average)."""

    trees: int
    depth: int | None
    min_split: int
    min_leaf: int
    features: int
    bins: int | None
    bootstrap: bool
    share: float
    criterion: str
    seed: int


@dataclass(frozen=True)
class TreeModel:
    """A fitted forest: its stored node table, classes in ascending order, and the columns
    that it reads. ``key`` tells the scored rows apart."""

    nodes: DataFrame
    key: str
    features: Sequence[str]
    classes: Sequence[str]
    class_type: str

    def class_array(self) -> Column:
        return F.array(*[F.lit(c).cast(self.class_type) for c in self.classes])


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that follows from the digest of seed and parts."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def draws(settings: TreeSettings, key: Column, tree: Column) -> Column:
    """How often a tree draws a row: Poisson distributed with replacement, else 0 or 1."""
    u = uniform(settings.seed, tree, key)
    if not settings.bootstrap:
        return F.lit(1) if settings.share >= 1 else (u < settings.share).cast("int")
    total, term, steps = 0.0, math.exp(-settings.share), []
    for k in range(1, 64):
        total += term
        term *= settings.share / k
        if total >= 1 - 1e-12:
            break
        steps.append((u >= total).cast("int"))
    return sum(steps[1:], steps[0])


def node_features(settings: TreeSettings, n_features: int) -> Column:
    """The features that (tree, node) looks at: those with the smallest digests."""
    every = F.sequence(F.lit(0), F.lit(n_features - 1))
    if settings.features >= n_features:
        return every
    drawn = F.transform(every, lambda f: F.struct(uniform(settings.seed, F.col("tree"), F.col("node"), f).alias("u"), f.alias("f")))
    return F.transform(F.slice(F.array_sort(drawn), 1, settings.features), lambda s: s["f"])


def value_cuts(rows: DataFrame, n_features: int, parts: int) -> list[list[float]]:
    """Of each feature the distinct values at the parts' inner quantiles: parts - 1 at most."""
    shares = [i / parts for i in range(1, parts)]
    found = rows.select(F.posexplode("x").alias("f", "v")).groupBy("f").agg(
        F.sort_array(F.array_distinct(F.percentile_approx("v", shares, ACCURACY))).alias("cuts")
    )
    by_feature = {r["f"]: r["cuts"] for r in found.collect()}  # a row per feature
    return [by_feature.get(f, []) for f in range(n_features)]


def place_in(cuts: Column, value: Column) -> Column:
    """How many of the cuts lie below the value."""
    return F.size(F.filter(cuts, lambda c: c < value))


def _impurity_kept(counts: list[Column], total: Column, criterion: str) -> Column:
    """What a side adds to a split's score: the higher the sum, the purer the sides."""
    def add(terms: list[Column]) -> Column:
        return sum(terms[1:], terms[0])

    if criterion == "gini":
        return F.try_divide(add([c * c for c in counts]), total)
    return add([F.when(c > 0, c * F.log(F.try_divide(c, total))).otherwise(F.lit(0.0)) for c in counts])


def best_splits(
    state: DataFrame, open_nodes: DataFrame, n_classes: int, settings: TreeSettings,
    weights: Sequence[float] | None, ranges: list[list[float]] | None,
) -> DataFrame:
    """(tree, node, feature, threshold, left, right, n_left, n_right): the split with the
    highest score of each open node that has one; of equal ones that of the first feature,
    then the lowest. ``left`` and ``right`` count the draws by class, n the rows."""
    names = [f"c{i}" for i in range(n_classes)]
    node = ["tree", "node"]
    looked = state.join(open_nodes.select(*node, "features"), node).select(
        *node, "label", "w", "x", F.explode("features").alias("feature")
    )
    valued = looked.select(*node, "feature", "label", "w", F.get("x", F.col("feature")).alias("v"))
    per_value = valued.groupBy(*node, "feature", "v").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(F.col("label") == i, F.col("w")).otherwise(F.lit(0))).alias(c) for i, c in enumerate(names)],
    )
    feature, sums = [*node, "feature"], ["n", *names]
    if ranges is None:
        per_value = per_value.withColumn("r", F.lit(0))
    else:
        # a literal of MAX_RANGES numbers per feature at most
        cuts = F.get(F.array(*[F.array(*[F.lit(c) for c in own]).cast("array<double>") for own in ranges]), F.col("feature"))
        per_value = stored(per_value.withColumn("r", place_in(cuts, F.col("v"))))
    upward = Window.partitionBy(*feature, "r").orderBy("v")
    upto = upward.rowsBetween(Window.unboundedPreceding, 0)
    running = per_value.select(
        *feature, "r", "v", F.lead("v").over(upward).alias("next"), *[F.sum(c).over(upto).alias(c) for c in sums]
    )
    if ranges is not None:
        totals = per_value.groupBy(*feature, "r").agg(F.min("v").alias("_low"), *[F.sum(c).alias(f"_{c}") for c in sums])
        order = Window.partitionBy(*feature).orderBy("r")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select(
            *feature, "r", F.lead("_low").over(order).alias("_next"),
            *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in sums],
        )
        running = running.join(carried, [*feature, "r"]).select(
            *feature, "v", F.coalesce("next", "_next").alias("next"), *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums]
        )
    whole = open_nodes.select(*node, F.col("n").alias("_all"), F.col("counts"))
    split = running.where("next IS NOT NULL").join(whole, node)
    split = split.where((F.col("n") >= settings.min_leaf) & (F.col("_all") - F.col("n") >= settings.min_leaf))
    scale = weights or [1.0] * n_classes
    left = [F.col(c).cast("double") * F.lit(s) for c, s in zip(names, scale)]
    right = [(F.get("counts", F.lit(i)) - F.col(c)).cast("double") * F.lit(s) for i, (c, s) in enumerate(zip(names, scale))]
    score = _impurity_kept(left, sum(left[1:], left[0]), settings.criterion) + _impurity_kept(
        right, sum(right[1:], right[0]), settings.criterion
    )
    middle = (F.col("v") + F.col("next")) / 2
    # between neighbours without a number between them the lower one cuts
    threshold = F.when(middle < F.col("next"), middle).otherwise(F.col("v"))
    chosen = split.groupBy(*node).agg(
        F.max_by(
            F.struct("feature", threshold.alias("threshold"), F.array(*names).alias("left"), F.col("n").alias("n_left"),
                     "counts", F.col("_all")),
            F.struct(score, -F.col("feature"), -F.col("v")),
        ).alias("s")
    )
    return chosen.select(
        *node, "s.feature", "s.threshold", "s.left", F.zip_with("s.counts", "s.left", lambda a, b: a - b).alias("right"),
        "s.n_left", (F.col("s._all") - F.col("s.n_left")).alias("n_right"),
    )


def grow(
    rows: DataFrame, n_features: int, n_classes: int, settings: TreeSettings, weights: Sequence[float] | None = None
) -> DataFrame:
    """The stored node table of a forest on rows (key, label, x): label is the class number,
    x the array of feature values. A level is two passes over the draws of nodes that are still
    open; leaves drop out. Levels are stored, so a lost executor costs a re-read."""
    n_rows = rows.count()
    bins = value_cuts(rows, n_features, settings.bins) if settings.bins else None
    if bins:
        cuts = F.array(*[F.array(*[F.lit(c) for c in own]).cast("array<double>") for own in bins])
        coded = F.transform("x", lambda v, f: place_in(F.get(cuts, f), v).cast("double"))
        rows = stored(rows.select("key", "label", coded.alias("x")))
    parts = min(MAX_RANGES, -(-n_rows // ROWS_PER_RANGE))
    ranges = value_cuts(rows, n_features, parts) if parts > 1 and not bins else None
    trees = F.explode(F.sequence(F.lit(0), F.lit(settings.trees - 1))).alias("tree")
    state = rows.select(trees, "key", "label", "x").withColumn("w", draws(settings, F.col("key"), F.col("tree")))
    state = stored(state.where("w > 0").select("tree", F.lit(1).cast("long").alias("node"), "label", "w", "x"))
    per_class = [F.sum(F.when(F.col("label") == i, F.col("w")).otherwise(F.lit(0))) for i in range(n_classes)]
    totals = stored(
        state.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.array(*per_class).alias("counts"))
    )
    limit = DEEPEST if settings.depth is None else min(settings.depth, DEEPEST)
    scale = F.array(*[F.lit(float(s)) for s in (weights or [1.0] * n_classes)])
    weighed = F.zip_with("counts", scale, lambda n, s: n * s)
    # a class weight may be 0, and then all of a leaf's
    size = F.aggregate(weighed, F.lit(0.0), lambda a, b: a + b)
    chances = F.transform(weighed, lambda n: F.coalesce(F.try_divide(n, size), F.lit(1.0 / n_classes)))
    levels = []
    for depth in range(limit + 1):
        mixed = F.size(F.filter("counts", lambda n: n > 0)) > 1
        can = mixed & (F.col("n") >= max(settings.min_split, 2)) if depth < limit else F.lit(False)
        wide = totals.where(can).withColumn("features", node_features(settings, n_features))
        found = None
        if depth < limit and not totals.where(can).isEmpty():
            found = stored(best_splits(state, stored(wide), n_classes, settings, weights, ranges))
        columns = ["tree", "node", "feature", "threshold", "n", chances.alias("chances")]
        if found is None:
            ended = totals.withColumns({"feature": F.lit(None).cast("int"), "threshold": F.lit(None).cast("double")})
            levels.append(ended.select(*columns))
            break
        levels.append(
            totals.join(found.select("tree", "node", "feature", "threshold"), ["tree", "node"], "left").select(*columns)
        )
        above = (F.get("x", F.col("feature")) > F.col("threshold")).cast("long")
        state = stored(
            state.join(found.select("tree", "node", "feature", "threshold"), ["tree", "node"])
            .select("tree", (2 * F.col("node") + above).alias("node"), "label", "w", "x")
        )
        sides = F.array(
            F.struct((2 * F.col("node")).alias("node"), F.col("n_left").alias("n"), F.col("left").alias("counts")),
            F.struct((2 * F.col("node") + 1).alias("node"), F.col("n_right").alias("n"), F.col("right").alias("counts")),
        )
        totals = stored(found.select("tree", F.inline(sides)))
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    if bins:
        cuts = F.array(*[F.array(*[F.lit(c) for c in own]).cast("array<double>") for own in bins])
        bound = F.get(F.get(cuts, F.col("feature")), F.floor("threshold").cast("int"))
        nodes = nodes.withColumn("threshold", bound)
    return stored(nodes.select("tree", "node", "feature", "threshold", "n", "chances"))


def walk(nodes: DataFrame, df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(key, chances): the mean over the trees of the chances at the leaf of each row.

    One join with the node table per level; Spark broadcasts it while it is small. A missing
    feature value fails the query, a key held by several rows too.
    """
    require_columns(df, [key, *features])
    shape = nodes.agg(F.max("node"), F.max("tree"), F.max(F.size("chances"))).first()
    depth, n_trees, n_classes = int(shape[0]).bit_length() - 1, shape[1] + 1, shape[2]
    values = F.array(*[F.col(quoted(c)).cast("double") for c in features])
    trees = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree")
    at = df.select(F.col(quoted(key)).alias("key"), values.alias("x")).select("key", "x", trees)
    at = at.withColumn("node", F.lit(1).cast("long"))
    inner = nodes.where("feature IS NOT NULL").select("tree", "node", "feature", "threshold")
    for level in range(depth):
        here = inner.where((F.col("node") >= 1 << level) & (F.col("node") < 1 << (level + 1)))
        value = F.get("x", F.col("feature"))
        known = F.when(value.isNotNull() & ~F.isnan(value), value).otherwise(
            F.raise_error(F.lit("a feature to be scored is missing")).cast("double")
        )
        child = 2 * F.col("node") + (known > F.col("threshold")).cast("long")
        at = at.join(here, ["tree", "node"], "left").select(
            "key", "x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(child).alias("node")
        )
    leaves = nodes.where("feature IS NULL").select("tree", "node", "chances")
    ended = at.join(leaves, ["tree", "node"]).select("key", "chances")
    means = [F.avg(F.get("chances", F.lit(i))) for i in range(n_classes)]
    found = ended.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.array(*means).alias("chances"))
    once = F.when(F.col("n") == n_trees, F.col("chances")).otherwise(
        F.raise_error(F.lit(f"{key} is not unique among the rows to score")).cast("array<double>")
    )
    return found.select(F.col("key").alias(key), once.alias("chances"))


def fit_trees(
    df: DataFrame, features: Sequence[str], label: Column, key: str, classes: Sequence, class_type: str,
    settings: TreeSettings, weights: Sequence[float] | None = None,
) -> TreeModel:
    """A forest on a table; ``label`` is the number of a row's class."""
    values = [F.col(quoted(c)).cast("double") for c in features]
    missing = values[0].isNull() | F.isnan(values[0])
    for v in values[1:]:
        missing = missing | v.isNull() | F.isnan(v)
    whole = F.when(~missing, F.array(*values)).otherwise(
        F.raise_error(F.lit("a feature of a training row is missing")).cast("array<double>")
    )
    rows = stored(df.select(F.col(quoted(key)).alias("key"), label.cast("int").alias("label"), whole.alias("x")))
    nodes = grow(rows, len(features), len(classes), settings, weights)
    return TreeModel(nodes, key, tuple(features), tuple(map(str, classes)), class_type)


def save_trees(model: TreeModel, path: str) -> None:
    """Write the node table and a row that describes the model, replacing an older one."""
    spark = model.nodes.sparkSession
    schema = "key string, features array<string>, classes array<string>, class_type string"
    about = spark.createDataFrame([(model.key, list(model.features), list(model.classes), model.class_type)], schema)
    model.nodes.write.mode("overwrite").parquet(join_path(path, "nodes"))
    about.coalesce(1).write.mode("overwrite").json(join_path(path, "about"))


def load_trees(spark: SparkSession, path: str) -> TreeModel:
    """A model written by save_trees."""
    schema = "key string, features array<string>, classes array<string>, class_type string"
    about: Mapping = spark.read.schema(schema).json(join_path(path, "about")).first().asDict()
    nodes = spark.read.schema(NODES).parquet(join_path(path, "nodes"))
    return TreeModel(nodes, about["key"], tuple(about["features"]), tuple(about["classes"]), about["class_type"])
