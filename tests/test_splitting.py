import hashlib

import pytest
from conftest import plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowmill.operators import splitting


def quotas_of(spark, counts, size):
    """{class: (rows, train, test)}"""
    df = spark.createDataFrame(counts, "value long, rows long")
    return {r["value"]: tuple(r)[1:] for r in splitting.class_quotas(df, size).collect()}


def test_quotas_of_the_known_table(spark):
    assert [q[2] for q in quotas_of(spark, [(0, 357), (1, 212)], 0.3).values()] == [107, 64]
    assert sum(q[1] for q in quotas_of(spark, [(0, 357), (1, 212)], 0.2).values()) == 455


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    counts=st.lists(st.integers(2, 10**13), min_size=1, max_size=8),
    share=st.floats(0.01, 0.99),
)
def test_quotas_add_up(spark, counts, share):
    total = sum(counts)
    try:
        quotas = quotas_of(spark, list(enumerate(counts)), share)
    except ValueError:
        return
    n_train, n_test = splitting.side_sizes(total, share)
    assert sum(q[1] for q in quotas.values()) == n_train
    assert sum(q[2] for q in quotas.values()) == n_test
    by_rest = sorted(quotas, key=lambda v: (-(counts[v] * n_train % total), v))
    extra = n_train - sum(n * n_train // total for n in counts)
    for v, (rows, train, test) in quotas.items():
        assert train + test == rows == counts[v]
        assert train == rows * n_train // total + (v in by_rest[:extra])


@pytest.mark.parametrize(
    "counts,size",
    [
        ([(0, 5), (1, 1)], 0.5),
        ([(0, 5), (None, 5)], 0.5),
        ([(0, 3), (1, 3), (2, 3)], 0.1),
        ([(0, 5)], 1.0),
        ([(0, 5)], 0),
        ([(0, 5)], 5),
        ([], 0.5),
    ],
)
def test_impossible_splits_raise(spark, counts, size):
    with pytest.raises(ValueError):
        quotas_of(spark, counts, size)


def test_very_many_classes(spark):
    df = spark.range(450_000).select("id", F.format_string("c%d", F.col("id") % 150_000).alias("c"))
    train, test = splitting.train_test_split(df, "id", "c", 1 / 3)
    assert (train.count(), test.count()) == (300_000, 150_000)
    assert train.groupBy("c").count().where("count <> 2").isEmpty()


def test_repeated_keys_never_miss_a_quota(spark):
    df = spark.range(10_000).select((F.col("id") % 50).alias("k"), (F.col("id") % 100 < 50).alias("c"))
    with pytest.raises(ValueError, match="k is not unique"):
        splitting.stratified_split(df, "k", "c", 0.33)
    twice = spark.range(400).select((F.col("id") % 200).alias("k"), F.lit("x").alias("c"))
    assigned = splitting.stratified_split(twice, "k", "c", 0.25)
    assert assigned.where("split = 'train'").count() == 300


def test_a_class_without_a_cut_fails(events):
    cuts = splitting.split_cuts(events.where("event_type <> 'view'"), "event_id", "event_type")
    with pytest.raises(Exception, match="no cut for this class of event_type: view"):
        splitting.assign_split(events, cuts, "event_id", "event_type").collect()


def by_ranking(df, key, target, size, seed):
    """The split by sorting each class in Python."""
    members = {}
    for r in df.select(key, target).collect():
        digest = hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest()
        members.setdefault(r[1], []).append((digest, r[0]))
    counts = [(v, len(m)) for v, m in members.items()]
    table = df.sparkSession.createDataFrame(counts, "value string, rows long")
    train = set()
    for q in splitting.class_quotas(table, size).collect():
        train |= {k for _, k in sorted(members[q["value"]])[: q["train"]]}
    return train


@pytest.mark.parametrize("sigmas", [6.0, 1.0, 0.01, 0.0])
def test_narrow_brackets_find_the_same_cut(events, sigmas):
    assigned = splitting.stratified_split(
        events, "event_id", "event_type", 0.3, 42, sigmas or 1e-6
    )
    train = {r["event_id"] for r in assigned.where("split = 'train'").collect()}
    assert train == by_ranking(events, "event_id", "event_type", 0.3, 42)


def test_a_class_holding_most_rows(events):
    skewed = events.withColumn(
        "c", F.when(F.col("event_id") < 10, "rare").otherwise("common")
    )
    assigned = splitting.stratified_split(skewed, "event_id", "c", 0.3, 1, sigmas=0.5)
    train = {r["event_id"] for r in assigned.where("split = 'train'").collect()}
    assert train == by_ranking(skewed, "event_id", "c", 0.3, 1)


def test_membership_depends_on_key_and_seed_only(events):
    def train_keys(df, seed=42):
        train, _ = splitting.train_test_split(df, "event_id", "event_type", 0.3, seed)
        return {r["event_id"] for r in train.select("event_id").collect()}

    first = train_keys(events)
    assert first == train_keys(events.repartition(7).drop("ts").withColumn("extra", F.lit(1)))
    assert first != train_keys(events, seed=123)


def test_sides_are_disjoint_complete_and_balanced(events):
    train, test = splitting.train_test_split(events, "event_id", "event_type", 0.2)
    found = splitting.split_overlap(train, test, "event_id").first()
    assert found["n_overlap"] == 0
    assert found["n_train"] + found["n_test"] == found["n_total"] == events.count()
    assert found["n_test"] == 200
    assigned = splitting.stratified_split(events, "event_id", "event_type", 0.2)
    for r in splitting.split_balance(assigned, "event_type").collect():
        assert abs(r["share"] - r["train_share"]) < 0.05
        assert abs(r["share"] - r["test_share"]) < 0.05


def test_overlap_is_counted(spark):
    a, b = spark.range(5).toDF("k"), spark.range(3, 9).toDF("k")
    assert tuple(splitting.split_overlap(a, b, "k").first()) == (5, 6, 9, 2)


def test_absolute_test_size(events):
    _, test = splitting.train_test_split(events, "event_id", "event_type", 17)
    assert test.count() == 17


def test_missing_keys_raise(events):
    gaps = events.withColumn("event_id", F.when(F.col("event_id") > 3, F.col("event_id")))
    with pytest.raises(ValueError, match="4 rows have no event_id"):
        splitting.stratified_split(gaps, "event_id", "event_type")


def test_a_class_without_training_rows(spark):
    rows = [(i, "big") for i in range(96)] + [(100 + i, c) for i, c in enumerate(["b", "b", "c", "c"])]
    df = spark.createDataFrame(rows, "k long, c string")
    assigned = splitting.stratified_split(df, "k", "c", 0.95)
    quotas = {r["c"]: r["n_train"] for r in splitting.split_quota(df, "c", 0.95).collect()}
    found = {r["c"]: r["n"] for r in assigned.where("split='train'").groupBy("c").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert found == {c: n for c, n in quotas.items() if n}


def test_assignment_shuffles_nothing(events):
    cuts = splitting.split_cuts(events, "event_id", "event_type", 0.3)
    text = plan(splitting.assign_split(events, cuts, "event_id", "event_type"))
    assert "Exchange hashpartitioning" not in text and "Window" not in text
    assert text.count("Exchange") == text.count("BroadcastExchange")
