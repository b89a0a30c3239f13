"""Forests of our own growing: every split against a plain search, scoring against SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from rowmill.operators import models, trees
from rowmill.sources import artifacts

FEATURES = ["a", "b", "c"]
EXACT = {"n_estimators": 1, "bootstrap": False, "max_features": None, "max_bins": None}


def made(n, seed, classes=2, values=40):
    """(id, a, b, c, target): the classes follow a and b, with noise and repeated values."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.randint(0, values) / 8, rng.gauss(0, 1), float(rng.randint(0, 3))
        target = int(a + b > 2.5) if classes == 2 else min(classes - 1, int(a + abs(b)) % classes)
        out.append((i, a, b, c, target if rng.random() < 0.85 else rng.randrange(classes)))
    return out


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, target int").repartition(parts)


def grown(rows, depth, min_split=2, min_leaf=1, n_classes=2):
    """The nodes of one tree as {node: (feature, threshold, n, counts)}, by trying every split."""
    def gini(part):
        return sum(sum(r[4] == k for r in part) ** 2 for k in range(n_classes)) / len(part)

    out = {}

    def grow(node, part, left):
        counts = [sum(r[4] == k for r in part) for k in range(n_classes)]
        best = None
        if left and len(part) >= min_split and sum(c > 0 for c in counts) > 1:
            for f in range(3):
                values = sorted({r[1 + f] for r in part})
                for v, w in zip(values, values[1:]):
                    low, high = [r for r in part if r[1 + f] <= v], [r for r in part if r[1 + f] > v]
                    if min(len(low), len(high)) >= min_leaf:
                        key = (gini(low) + gini(high), -f, -v)
                        if best is None or key > best[0]:
                            best = key, f, (v + w) / 2, low, high
        out[node] = (best and best[1], best and best[2], len(part), counts)
        if best:
            grow(2 * node, best[3], left - 1)
            grow(2 * node + 1, best[4], left - 1)

    grow(1, rows, depth)
    return out


def nodes_of(model):
    return {r["node"]: (r["feature"], r["threshold"], r["n"], r["chances"]) for r in model.nodes.collect()}


def fit(spark, rows, **params):
    return models.train_model(table(spark, rows), FEATURES, "target", "id", params={**EXACT, **params})


@pytest.mark.parametrize("params", [
    {"max_depth": 3}, {"max_depth": 40, "min_samples_split": 30}, {"max_depth": None, "min_samples_leaf": 12}, {"max_depth": 0},
])
@pytest.mark.parametrize("classes", [2, 4])
def test_exact_splits_equal_a_plain_search(spark, params, classes):
    rows = made(150, 1, classes)
    wanted = grown(rows, params["max_depth"] if params["max_depth"] is not None else 60,
                   params.get("min_samples_split", 2), params.get("min_samples_leaf", 1), classes)
    found = nodes_of(fit(spark, rows, **params))
    assert found.keys() == wanted.keys()
    for node, (feature, threshold, n, counts) in wanted.items():
        assert found[node][:3] == (feature, threshold, n)
        assert found[node][3] == pytest.approx([c / n for c in counts])


def test_ranges_of_values_change_nothing(spark, monkeypatch):
    rows = made(200, 2, values=400)
    before = nodes_of(fit(spark, rows, max_depth=3))
    monkeypatch.setattr(trees, "ROWS_PER_RANGE", 17)
    assert nodes_of(fit(spark, rows, max_depth=3)) == before


def test_bins_limit_the_cuts(spark):
    rows = made(300, 3)
    binned = nodes_of(fit(spark, rows, max_depth=4, max_bins=4, min_samples_split=3))
    cuts = {}
    for feature, threshold, _, _ in binned.values():
        if feature is not None:
            cuts.setdefault(feature, set()).add(threshold)
    assert cuts and all(len(c) <= 3 for c in cuts.values())
    values = [{r[1 + f] for r in rows} for f in range(3)]
    assert all(c <= values[f] for f, c in cuts.items())


def test_a_forest_depends_on_rows_and_seed_only(spark):
    rows = made(120, 4)
    params = {**EXACT, "n_estimators": 5, "bootstrap": True, "max_features": "sqrt", "max_depth": 3}

    def fitted(df, **changes):
        model = models.train_model(df, FEATURES, "target", "id", params={**params, **changes})
        return {(r["tree"], r["node"]): tuple(r)[2:5] for r in model.nodes.collect()}

    first = fitted(table(spark, rows))
    assert first == fitted(table(spark, rows[::-1], 7))
    assert first != fitted(table(spark, rows), random_state=1)
    assert {t for t, _ in first} == set(range(5)) and len({first[t, 1] for t in range(5)}) > 1


def test_draws_have_the_wanted_mean(spark):
    settings = models.tree_settings({"max_samples": 0.5}, 10, 3)
    drawn = spark.range(4000).select(trees.draws(settings, F.col("id"), F.lit(3)).alias("w"))
    found = drawn.agg(F.avg("w"), F.max("w")).first()
    assert 0.45 < found[0] < 0.55 and found[1] > 1


def test_class_weights_and_entropy(spark):
    rows = made(200, 5)
    plain = fit(spark, rows, max_depth=2, criterion="entropy")
    heavy = fit(spark, rows, max_depth=2, class_weight={1: 50.0})
    df = table(spark, rows)

    def mean(model):
        return models.score(model, df).agg(F.avg("y_pred_proba")).first()[0]

    assert mean(heavy) > mean(plain)


WALK = """WITH RECURSIVE placed AS (
    SELECT id, x, tree, CAST(1 AS BIGINT) AS node FROM rows, (SELECT DISTINCT tree FROM nodes)
    UNION ALL
    SELECT id, x, tree, 2 * n.node + CAST(x[feature + 1] > threshold AS BIGINT)
    FROM placed JOIN nodes n USING (tree, node) WHERE feature IS NOT NULL)
  SELECT id, avg(chances[2]) AS p FROM placed JOIN nodes n USING (tree, node) WHERE feature IS NULL GROUP BY id"""


def test_a_hundred_trees_of_64_features_as_a_relation(spark, sf_dir):
    """MLlib's forest, its exported nodes walked here and by recursive SQL: the same scores."""
    names = [f"e{i:02d}" for i in range(64)]
    source = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), (F.col("label") < 5).cast("int").alias("target"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(names)],
    )
    model = models.train_model(source, names, "target", "id")
    nodes = models.forest_nodes(model)
    assert nodes.agg(F.countDistinct("tree")).first()[0] == 100
    scored = {r["id"]: r for r in models.score(model, source).select("id", "y_pred", "y_pred_proba").collect()}
    walked = {r["id"]: r["chances"] for r in trees.walk(nodes, source, "id", names).collect()}
    con = duckdb.connect()
    con.register("nodes", nodes.toArrow())
    con.register("rows", source.select("id", F.array(*names).alias("x")).toArrow())
    by_sql = dict(con.sql(WALK).fetchall())
    assert scored.keys() == walked.keys() == by_sql.keys()
    for i, row in scored.items():
        assert walked[i][1] == pytest.approx(row["y_pred_proba"], abs=1e-12)
        assert by_sql[i] == pytest.approx(row["y_pred_proba"], abs=1e-12)
        assert row["y_pred"] == int(walked[i][1] > walked[i][0])


def test_leaf_chances_are_the_shares_of_the_leaf(spark):
    """Neighbouring leaves that predict the same class keep their own chances."""
    rows = [(i, float(i % 10), 0.0, 0.0, int(i % 10 == 0 and i % 40 == 0 or i % 100 == 5)) for i in range(400)]
    params = {"n_estimators": 1, "max_depth": 1, "bootstrap": False, "max_features": None}
    model = models.train_model(table(spark, rows), FEATURES, "target", "id", params=params)
    scores = {r[0] for r in models.score(model, table(spark, rows)).select("y_pred_proba").distinct().collect()}
    assert len(scores) == 2 and max(scores) < 0.5


def test_saving_and_scoring(spark, tmp_path):
    rows = [(*r[:4], r[4]) for r in made(100, 6, 3)]
    df = table(spark, rows).withColumn("target", F.concat(F.lit("k"), "target"))
    model = models.train_model(df, FEATURES, "target", "id", params={"n_estimators": 4, "max_depth": 3})
    path = str(tmp_path / "deep" / "m")
    binary = models.train_model(df.where("target < 'k2'"), FEATURES, "target", "id", params={"n_estimators": 2})
    for m in (binary, model, binary, model):  # either kind replaces the other
        artifacts.save_model(m, path)
    again = artifacts.load_model(path)
    first = {r["id"]: tuple(r) for r in models.score(model, df).collect()}
    assert {r["id"]: tuple(r) for r in models.score(again, df).collect()} == first
    chances = models.predict_proba(model, df).select("id", "y_proba").collect()
    assert all(sum(r["y_proba"]) == pytest.approx(1) and len(r["y_proba"]) == 3 for r in chances)
    right = models.predict(model, df).agg(F.avg((F.col("y_pred") == F.col("target")).cast("int"))).first()[0]
    assert right > 0.5
    with pytest.raises(Exception, match="not unique"):
        models.score(model, df.union(df)).collect()
    with pytest.raises(Exception, match="missing"):
        models.score(model, df.withColumn("a", F.lit(None).cast("double"))).collect()


def test_one_class_and_missing_features(spark):
    rows = [(i, float(i), 0.0, 0.0, 7) for i in range(10)]
    for params in ({}, EXACT):
        model = models.train_model(table(spark, rows), FEATURES, "target", "id", params={"n_estimators": 2, **params})
        assert {r["y_pred"] for r in models.predict(model, table(spark, rows)).collect()} == {7}
    with pytest.raises(Exception, match="missing"):
        fit(spark, [*made(20, 7), (99, None, 0.0, 0.0, 1)])
