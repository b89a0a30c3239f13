import numpy as np
import pytest
from conftest import plan
from pyspark.sql import functions as F

from rowmill.operators import scaling, selection
from rowmill.operators.moments import moments


def f_by_hand(x, y):
    groups = [x[y == v] for v in np.unique(y)]
    between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in groups) / (len(groups) - 1)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(x) - len(groups))
    return between / within


@pytest.fixture
def items(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_returnflag", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )


FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def test_scores_match_the_formula(items):
    pdf = items.toPandas()
    scores = {r["feature"]: r["f_score"] for r in
              selection.anova_f(items, FEATURES, "l_returnflag").collect()}
    for c in FEATURES:
        assert scores[c] == pytest.approx(
            f_by_hand(pdf[c].to_numpy(), pdf["l_returnflag"].to_numpy()), rel=1e-9
        )


def edge_table(spark):
    return spark.createDataFrame(
        [(i % 2, 0.1, float(i % 2), float(i), float(i), None) for i in range(10)],
        "y int, flat double, apart double, left double, right double, nothing double",
    )


def test_edge_cases_and_ties(spark):
    df = edge_table(spark)
    names = ["flat", "apart", "left", "right", "nothing"]
    ranked = {r["feature"]: r for r in selection.select_k_best(df, names, "y", 2).collect()}
    assert ranked["flat"]["f_score"] is None
    assert ranked["apart"]["f_score"] == float("inf") and ranked["apart"]["rank"] == 1
    # Equal scores: the later column wins.
    assert (ranked["right"]["rank"], ranked["left"]["rank"]) == (2, 3)
    assert ranked["right"]["selected"] == 1 and ranked["left"]["selected"] == 0
    assert ranked["nothing"]["f_score"] is None
    assert {ranked["flat"]["rank"], ranked["nothing"]["rank"]} == {4, 5}


def test_names_come_in_column_order(spark):
    df = edge_table(spark)
    chosen, names = selection.preprocess_features(df, ["right", "apart", "flat"], "y", "left", 2)
    assert names == ["right", "apart"]
    assert set(chosen.columns) == {"y", "left", "apart", "right"}


def test_too_large_k_keeps_all_and_warns(items):
    with pytest.warns(UserWarning):
        ranked = selection.select_k_best(items, FEATURES, "l_returnflag", 9)
    assert selection.selected_names(ranked) == FEATURES
    with pytest.raises(ValueError):
        selection.select_k_best(items, FEATURES, "l_returnflag", 0)


def test_scaling_does_not_change_the_choice(items):
    scaled, _ = scaling.normalize_features(items, FEATURES)
    before = selection.selected_names(selection.select_k_best(items, FEATURES, "l_returnflag", 2))
    after = selection.selected_names(selection.select_k_best(scaled, FEATURES, "l_returnflag", 2))
    assert before == after


def test_layout_does_not_change_the_scores(items):
    one = {r["feature"]: r["f_score"] for r in
           selection.anova_f(items.repartition(1), FEATURES, "l_returnflag").collect()}
    many = {r["feature"]: r["f_score"] for r in
            selection.anova_f(items.repartition(9), FEATURES, "l_returnflag").collect()}
    assert one == pytest.approx(many, rel=1e-9)


def test_top_features_are_the_first_by_position(items):
    ranked = selection.select_k_best(items, FEATURES, "l_returnflag", 3)
    top = [r["feature"] for r in selection.top_features(ranked, 2).collect()]
    assert sorted(top, key=FEATURES.index) == selection.selected_names(ranked)[:2]


def test_projection_reads_only_the_selected_columns(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = plan(selection.project_selected(table, ["l_tax", "l_quantity"], ["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_tax:double>" in text


def test_class_statistics_are_folded_before_the_shuffle(items):
    text = plan(moments(items, FEATURES, ["l_returnflag"]))
    assert "partial_var_pop" in text or "partial_central_moment" in text or "partial_avg" in text


def test_many_classes(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("y"), (F.col("id") % 7).cast("double").alias("x"))
    found = selection.anova_f(df, ["x"], "y").first()["f_score"]
    rows = df.toPandas()
    groups = rows.groupby("y")["x"]
    between = (groups.count() * (groups.mean() - rows["x"].mean()) ** 2).sum() / 19_999
    within = ((rows["x"] - groups.transform("mean")) ** 2).sum() / 40_000
    assert found == pytest.approx(between / within)


def test_feature_names_with_spaces(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 5.0), (1, 7.0)], "y int, `mean area` double")
    assert selection.anova_f(df, ["mean area"], "y").select(F.col("feature")).first()[0] == "mean area"
