"""Binds the operators to the test tables: one query per operator, and the SQL that
must give the same rows.

Doubles are rounded on both sides, since the two engines add in different orders;
``+ 0e0`` turns a rounded -0.0 into 0.0.
"""

from __future__ import annotations

import math
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, functions as F  # noqa: E402

from rowmill.functions import match_flag, new_folder, stored  # noqa: E402
from rowmill.operators import comparison, metrics, models, prepare, profiles  # noqa: E402
from rowmill.operators import scaling, selection, splitting  # noqa: E402
from rowmill.operators.moments import long_features  # noqa: E402
from rowmill.operators.ranges import dense_index  # noqa: E402
from rowmill.plans.config import JobConfig  # noqa: E402
from rowmill.plans.job import run_job  # noqa: E402
from rowmill.sources import artifacts  # noqa: E402
from rowmill.sources.tables import (  # noqa: E402
    Catalog,
    Dataset,
    read_labeled,
    write_dataset,
    write_stage,
)

try:
    import corpus_pipeline
    from rowmill.llm import queries as corpus
except ModuleNotFoundError as absent:
    # only where the corpus part is left out; anything else that is missing is an error
    if absent.name not in ("corpus_pipeline", "rowmill.llm"):
        raise
    corpus = None

SMOKE_DIR = "/root/testdata/sf0.001"
ITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DIMENSIONS = 64
EMBEDDING_FEATURES = [f"e{i:02d}" for i in range(DIMENSIONS)]
K = 20


# ---------------------------------------------------------------------------
# Inputs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def rounded(column: str | Column, digits: int = 6) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, digits) + F.lit(0.0)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, target (label below 5) and one double column per dimension."""
    dims = [
        F.get("embedding", F.lit(i)).cast("double").alias(c)
        for i, c in enumerate(EMBEDDING_FEATURES)
    ]
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", (F.col("label") < 5).cast("int").alias("target"), *dims
    )


def gapped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with missing cells: errors have no value, signups no user."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") != "signup", F.col("user_id")).alias("user_id"),
    )


GAPPED = """gapped AS (
  SELECT event_id, event_type,
         CASE WHEN event_type <> 'error' THEN value END AS value,
         CASE WHEN event_type <> 'signup' THEN user_id END AS user_id
  FROM events)"""


def banded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gapped events whose features repeat: the user and the value in bands of ten."""
    return gapped_events(spark, sf_dir).select(
        "event_id", "event_type", F.floor(F.col("value") / 10).alias("band"), "user_id"
    )


BANDED = GAPPED + """, banded AS (
  SELECT event_id, event_type, CAST(floor(value / 10) AS BIGINT) AS band, user_id FROM gapped)"""


def stored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("y_true"), F.col("toxic").alias("y_pred")
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(documents, "doc_id")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs over the same documents: a first one, an echo with scores off by a
    rounding, one with other predictions and scores, one with other labels."""
    score = F.col("n_chars").cast("double")

    def run(name: str, y_true: Column, y_pred: Column, proba: Column) -> Column:
        return F.struct(
            F.lit(name).alias("run_id"),
            y_true.cast("int").alias("y_true"),
            y_pred.cast("int").alias("y_pred"),
            proba.alias("y_pred_proba"),
        )

    quality, toxic = F.col("quality"), F.col("toxic")
    return (
        scored_documents(spark, sf_dir)
        .select(
            "doc_id",
            F.explode(
                F.array(
                    run("first", quality, toxic, score),
                    run("echo", quality, toxic, score * F.lit(1.000000000001)),
                    run("longer", quality, F.col("n_chars") > 2000, -score),
                    run("swapped", toxic, toxic, score),
                )
            ).alias("run"),
        )
        .select("doc_id", "run.*")
    )


RUNS = """runs AS (
  SELECT doc_id, 'first' AS run_id, quality AS y_true, toxic AS y_pred,
         CAST(n_chars AS DOUBLE) AS y_pred_proba FROM labels JOIN documents USING (doc_id)
  UNION ALL
  SELECT doc_id, 'echo', quality, toxic, CAST(n_chars AS DOUBLE) * 1.000000000001e0
  FROM labels JOIN documents USING (doc_id)
  UNION ALL
  SELECT doc_id, 'longer', quality, CAST(n_chars > 2000 AS INTEGER), -CAST(n_chars AS DOUBLE)
  FROM labels JOIN documents USING (doc_id)
  UNION ALL
  SELECT doc_id, 'swapped', toxic, toxic, CAST(n_chars AS DOUBLE)
  FROM labels JOIN documents USING (doc_id))"""

LONG_EMBEDDINGS = """e AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
         CAST(unnest(range(len(embedding))) AS INTEGER) AS position FROM embeddings)"""

F_SCORES = LONG_EMBEDDINGS + """, c AS (
  SELECT position, label, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM e GROUP BY ALL),
g AS (
  SELECT position, sum(n * m) / sum(n) AS gm, sum(n) AS rows, count(*) AS k, sum(n * v) AS ssw
  FROM c GROUP BY position),
f AS (
  SELECT position, 'e' || lpad(CAST(position AS VARCHAR), 2, '0') AS feature,
         (sum(n * (m - gm) ** 2) / (k - 1)) / (ssw / (rows - k)) AS f_score
  FROM c JOIN g USING (position) GROUP BY position, k, ssw, rows),
ranked AS (
  SELECT *, CAST(row_number() OVER (ORDER BY f_score DESC, position DESC) AS INTEGER) AS rank
  FROM f)"""

QUOTAS = """counts AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
total AS (
  SELECT sum(n) AS rows, sum(n) - CAST(ceil(0.3e0 * sum(n)) AS BIGINT) AS n_train FROM counts),
shares AS (
  SELECT event_type, n, (n * n_train) // rows AS share, (n * n_train) % rows AS rest,
         n_train FROM counts, total),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY rest DESC, event_type) AS place,
         n_train - sum(share) OVER () AS missing FROM shares),
quota AS (
  SELECT event_type, CAST(n AS BIGINT) AS n,
         CAST(share + CASE WHEN place <= missing THEN 1 ELSE 0 END AS BIGINT) AS n_train
  FROM ordered)"""

SPLIT = QUOTAS + """, assigned AS (
  SELECT event_id, event_type, value,
         CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id))
                   <= n_train THEN 'train' ELSE 'test' END AS split
  FROM events JOIN quota USING (event_type))"""

REPORT = """cells AS (SELECT quality AS t, toxic AS p, count(*) AS n FROM labels GROUP BY ALL),
values_found AS (SELECT t AS v FROM cells UNION SELECT p FROM cells),
classes AS (
  SELECT v, coalesce((SELECT sum(n) FROM cells WHERE t = v AND p = v), 0) AS tp,
         coalesce((SELECT sum(n) FROM cells WHERE t = v), 0) AS support,
         coalesce((SELECT sum(n) FROM cells WHERE p = v), 0) AS predicted
  FROM values_found),
rates AS (
  SELECT row_number() OVER (ORDER BY v) AS position, CAST(v AS VARCHAR) AS label,
         coalesce(tp / nullif(predicted, 0), 0e0) AS precision,
         coalesce(tp / nullif(support, 0), 0e0) AS recall,
         coalesce(2 * tp / nullif(predicted + support, 0), 0e0) AS f1, support, tp
  FROM classes),
report AS (
  SELECT position, label, precision, recall, f1, support FROM rates
  UNION ALL
  SELECT count(*) + 1, 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM rates
  UNION ALL
  SELECT count(*) + 2, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM rates
  UNION ALL
  SELECT count(*) + 3, 'weighted avg', sum(precision * support) / sum(support),
         sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
  FROM rates)"""

RUN_METRICS = RUNS + """, cells AS (
  SELECT run_id, count(*) AS n, sum(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END) AS hits,
         sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN y_true = 1 AND y_pred = 0 THEN 1 ELSE 0 END) AS fn,
         sum(CASE WHEN y_true = 0 AND y_pred = 0 THEN 1 ELSE 0 END) AS tn
  FROM runs GROUP BY run_id),
scores AS (
  SELECT run_id, y_pred_proba, sum(y_true) AS pos, sum(1 - y_true) AS neg
  FROM runs GROUP BY run_id, y_pred_proba),
won AS (
  SELECT run_id, pos, neg,
         pos * (coalesce(sum(neg) OVER (PARTITION BY run_id ORDER BY y_pred_proba
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + neg / 2e0) AS u
  FROM scores),
areas AS (
  SELECT run_id, sum(u) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS roc_auc
  FROM won GROUP BY run_id),
evaluated AS (
  SELECT run_id, CAST(n AS BIGINT) AS n, round(hits / n, 6) + 0e0 AS accuracy,
         round(coalesce(tp / nullif(tp + fp, 0), 0e0), 6) + 0e0 AS precision,
         round(coalesce(tp / nullif(tp + fn, 0), 0e0), 6) + 0e0 AS recall,
         round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0e0), 6) + 0e0 AS f1,
         round(roc_auc, 6) + 0e0 AS roc_auc, CAST(tn AS BIGINT) AS tn,
         CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp
  FROM cells JOIN areas USING (run_id))"""

COMPARED = RUNS + """, pairs AS (
  SELECT coalesce(o.run_id, '') AS run_id, o.y_true IS NOT DISTINCT FROM f.y_true AS labels,
         o.y_pred IS NOT DISTINCT FROM f.y_pred AS preds,
         coalesce(abs(f.y_pred_proba - o.y_pred_proba)
                  <= 1e-10 + 1e-8 * abs(o.y_pred_proba), false) AS scores
  FROM (SELECT * FROM runs WHERE run_id = 'first') f
  FULL JOIN (SELECT * FROM runs WHERE run_id <> 'first') o USING (doc_id)),
agreed AS (
  SELECT run_id, bool_and(labels) AS same_labels,
         bool_and(labels) AND bool_and(preds) AS same_predictions,
         bool_and(labels) AND bool_and(scores) AS same_scores
  FROM pairs WHERE run_id <> '' GROUP BY run_id)"""

RATES = ["accuracy", "precision", "recall", "f1"]
CELLS = ["tn", "fp", "fn", "tp"]


# ---------------------------------------------------------------------------
# Sources and sinks


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item table in raw form: a label with two values and four features."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "R", "M").otherwise("B").alias("diagnosis"),
        *ITEM_FEATURES,
    )


RAW_ITEMS = """SELECT l_orderkey,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target,
  l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem"""


def load_labeled(spark, sf_dir):
    folder = new_folder(spark)
    write_dataset(raw_items(spark, sf_dir), folder, "csv")
    return read_labeled(spark, folder, key="l_orderkey")


def load_label_fallback(spark, sf_dir):
    folder = new_folder(spark)
    raw = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("target"), F.col("toxic").cast("double").alias("toxic")
    )
    write_dataset(raw, folder, "csv")
    return read_labeled(spark, folder, key="doc_id")


def named_datasets(spark, sf_dir):
    catalog = Catalog(
        spark,
        new_folder(spark),
        {"events_json": Dataset("json", "a/events.json"), "events": Dataset("csv", "b/events")},
    )
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    catalog.write("events_json", events)
    catalog.write("events", catalog.read("events_json", events.schema))
    return catalog.read("events", events.schema)


def write_stage_table(spark, sf_dir):
    cleaned = prepare.clean_data(banded_events(spark, sf_dir), ["band", "user_id"], "event_id")
    return write_stage(cleaned, new_folder(spark))


def write_metrics_json(spark, sf_dir):
    folder = new_folder(spark)
    evaluated = metrics.binary_metrics(stored_predictions(spark, sf_dir))
    artifacts.write_metrics_json(evaluated.select(*RATES), folder)
    stored = spark.read.schema(", ".join(f"{c} double" for c in RATES)).json(folder)
    return stored.select(*[rounded(c).alias(c) for c in RATES])


def write_confusion_csv(spark, sf_dir):
    folder = new_folder(spark)
    matrix = metrics.confusion_matrix(stored_predictions(spark, sf_dir), labels=[0, 1])
    artifacts.write_confusion_csv(matrix, folder)
    schema = "actual string, `Predicted 0` bigint, `Predicted 1` bigint"
    return spark.read.schema(schema).csv(folder, header=True)


def write_predictions(spark, sf_dir):
    folder = new_folder(spark)
    artifacts.write_predictions(stored_predictions(spark, sf_dir), folder, ["doc_id"])
    schema = "doc_id bigint, y_true int, y_pred int, match int"
    return spark.read.schema(schema).csv(folder, header=True)


def write_report_text(spark, sf_dir):
    folder = new_folder(spark)
    report = metrics.classification_report(stored_predictions(spark, sf_dir))
    artifacts.write_report_text(report, folder)
    return spark.read.text(folder).select(F.col("value").alias("line"))


def save_load_scaler(spark, sf_dir):
    folder = new_folder(spark)
    fitted = scaling.fit_scaler(table(spark, sf_dir, "lineitem"), ITEM_FEATURES)
    artifacts.save_scaler(fitted, folder)
    return scaler_columns(artifacts.load_scaler(spark, folder))


def save_load_model(spark, sf_dir):
    folder = new_folder(spark)
    model, _, everything = fitted_model(spark, sf_dir, "random_forest")
    artifacts.save_model(model, folder)
    before = models.score(model, everything)
    after = models.score(artifacts.load_model(folder), everything)
    kept = ["vec_id", "y_pred", "y_pred_proba"]
    both = before.select(*kept).join(
        after.select("vec_id", F.col("y_pred").alias("p"), F.col("y_pred_proba").alias("s")),
        "vec_id",
    )
    same = (F.col("y_pred") == F.col("p")) & (F.col("y_pred_proba") == F.col("s"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("n_changed"))


def write_run_result(spark, sf_dir):
    folder = new_folder(spark)
    results = runs(spark, sf_dir)
    for name in ("first", "echo", "longer", "swapped", "first"):
        one = results.where(F.col("run_id") == name).drop("run_id")
        artifacts.write_run_result(one, folder, name, "doc_id")
    return artifacts.read_run_results(spark, folder)


# ---------------------------------------------------------------------------
# Projections, cleaning and joins


def derive_binary_target(spark, sf_dir):
    labelled = prepare.derive_binary_target(raw_items(spark, sf_dir), "diagnosis", "M")
    return labelled.select("l_orderkey", "target", *ITEM_FEATURES)


def drop_columns(spark, sf_dir):
    shaped = prepare.label_table(raw_items(spark, sf_dir), "l_orderkey")
    return shaped.select(*prepare.feature_names(shaped, "l_orderkey", "target"))


def ranked_embedding_features(spark, sf_dir):
    return selection.select_k_best(embeddings(spark, sf_dir), EMBEDDING_FEATURES, "label", K)


def project_selected(spark, sf_dir):
    source = embeddings(spark, sf_dir)
    chosen, names = selection.preprocess_features(source, EMBEDDING_FEATURES, "label", "vec_id", K)
    # Turned to long form only because the chosen names are not known to the SQL.
    return chosen.unpivot(["vec_id"], names, "feature", "value")


def match_flags(spark, sf_dir):
    flag = match_flag(F.col("y_true"), F.col("y_pred")).alias("match")
    return stored_predictions(spark, sf_dir).select("doc_id", "y_true", "y_pred", flag)


def encode_order_status(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return prepare.encode_target(orders, "o_orderstatus")


def encode_part_type(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return prepare.encode_target(parts, "p_type")


def encode_numeric(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return prepare.encode_target(labels, "quality")


def drop_incomplete(spark, sf_dir):
    return prepare.drop_incomplete(gapped_events(spark, sf_dir), ["value", "user_id"])


def dedup_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return prepare.dedup_rows(events, ["user_id", "event_type"], "event_id")


def index_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return dense_index(events, "event_id")


def clean_data(spark, sf_dir):
    return prepare.clean_data(
        banded_events(spark, sf_dir), ["band", "user_id"], "event_id", "index"
    )


def attach_target(spark, sf_dir):
    features = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return comparison.attach_target(
        features, table(spark, sf_dir, "labels"), "doc_id", partial=True
    )


def join_predictions(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    truth = labels.select("doc_id", F.col("quality").alias("y_true"))
    called = labels.select("doc_id", F.col("toxic").alias("y_pred"))
    return comparison.join_predictions(truth, called, "doc_id", check=True)


def apply_params(spark, sf_dir):
    orders = table(spark, sf_dir, "lineitem")
    params = scaling.fit_scaler(orders, ITEM_FEATURES)
    names = F.get(F.array(*[F.lit(c) for c in ITEM_FEATURES]), F.col("position"))
    values = long_features(orders, ITEM_FEATURES, ["l_orderkey", "l_linenumber"])
    scaled = scaling.apply_params(values.withColumn("feature", names).drop("position"), params)
    kept = ["l_orderkey", "l_linenumber", "feature"]
    return scaled.select(*kept, rounded("scaled", 5).alias("scaled"))


# ---------------------------------------------------------------------------
# Feature statistics, selection and split


def scaler_columns(scaler: DataFrame) -> DataFrame:
    values = [rounded(c, 4).alias(c) for c in ("mean", "std")]
    return scaler.select("feature", *values)


def fit_scaler(spark, sf_dir):
    return scaler_columns(scaling.fit_scaler(table(spark, sf_dir, "lineitem"), ITEM_FEATURES))


def apply_scaler(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", *ITEM_FEATURES)
    scaled = scaling.apply_scaler(items, scaling.fit_scaler(items, ITEM_FEATURES))
    return scaled.select("l_orderkey", *[rounded(c, 5).alias(c) for c in ITEM_FEATURES])


def split_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return splitting.stratified_split(events, "event_id", "event_type", 0.3, 42)


def fit_train_apply_test(spark, sf_dir):
    assigned = split_events(spark, sf_dir)
    train = assigned.where(F.col("split") == "train")
    test = assigned.where(F.col("split") == "test")
    _, fitted = scaling.normalize_features(train, ["value"])
    scaled, _ = scaling.normalize_features(test, ["value"], fitted, fit=False)
    return scaled.select("event_id", "event_type", rounded("value", 5).alias("value"))


def anova_f(spark, sf_dir):
    scores = selection.anova_f(embeddings(spark, sf_dir), EMBEDDING_FEATURES, "label")
    return scores.select("position", "feature", rounded("f_score").alias("f_score"))


def f_score_edge_cases(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.lit(0.1).alias("flat"),
        (F.col("event_type") == "click").cast("double").alias("apart"),
        "value",
        (F.col("event_type") == "click").cast("int").alias("target"),
    )
    ranked = selection.select_k_best(events, ["flat", "apart", "value"], "target", 2)
    return ranked.select(
        "feature",
        "rank",
        "selected",
        F.col("f_score").isNull().alias("no_score"),
        F.coalesce(F.col("f_score") == float("inf"), F.lit(False)).alias("infinite"),
    )


def select_k_best(spark, sf_dir):
    ranked = ranked_embedding_features(spark, sf_dir)
    return ranked.select("position", "feature", "rank", "selected")


def top_features(spark, sf_dir):
    return selection.top_features(ranked_embedding_features(spark, sf_dir))


def stratified_split(spark, sf_dir):
    return split_events(spark, sf_dir).select("event_id", "event_type", "split")


def split_quota(spark, sf_dir):
    return splitting.split_quota(table(spark, sf_dir, "events"), "event_type", 0.3)


# ---------------------------------------------------------------------------
# Evaluation


def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(stored_predictions(spark, sf_dir))


def confusion_matrix_many(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("y_true"),
        F.when(F.col("value") > 50, "view").otherwise(F.col("event_type")).alias("y_pred"),
    )
    return metrics.confusion_matrix(events)


def binary_metrics(spark, sf_dir):
    evaluated = metrics.binary_metrics(stored_predictions(spark, sf_dir))
    return evaluated.select("n", *[rounded(c).alias(c) for c in RATES], *CELLS)


def roc_auc(spark, sf_dir):
    area = metrics.roc_auc(scored_documents(spark, sf_dir), "quality", "n_chars")
    return area.select(rounded("roc_auc").alias("roc_auc"))


def classification_report(spark, sf_dir):
    report = metrics.classification_report(stored_predictions(spark, sf_dir))
    return report.select(
        "position",
        "label",
        *[rounded(c).alias(c) for c in ("precision", "recall", "f1")],
        "support",
    )


def train_accuracy(spark, sf_dir):
    found = metrics.train_accuracy(stored_predictions(spark, sf_dir))
    return found.select(rounded("accuracy").alias("accuracy"))


def metrics_by_run(spark, sf_dir):
    evaluated = metrics.metrics_by_run(runs(spark, sf_dir))
    return evaluated.select(
        "run_id", "n", *[rounded(c).alias(c) for c in [*RATES, "roc_auc"]], *CELLS
    )


# ---------------------------------------------------------------------------
# Models whose fit has a form in SQL: one split, and a regression on two coefficients

STUMP = {"n_estimators": 1, "max_depth": 1, "bootstrap": False, "max_features": None}
BANDS = ["band", "user_band"]


def event_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with two features of at most 25 values each, so every cut is a candidate."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.least(F.floor(F.col("value") / 20), F.lit(24)).cast("double").alias("band"),
        (F.col("user_id") % 20).cast("double").alias("user_band"),
    )


def event_stump(spark, sf_dir):
    events = event_bands(spark, sf_dir)
    return models.train_model(events, BANDS, "event_type", "event_id", params=STUMP), events


def predict_classes(spark, sf_dir):
    model, events = event_stump(spark, sf_dir)
    return models.predict(model, events).select("event_id", "event_type", "y_pred")


def predict_class_proba(spark, sf_dir):
    model, events = event_stump(spark, sf_dir)
    found = models.predict_proba(model, events)
    chances = [rounded(F.col("y_proba")[i]).alias(f"p{i}") for i in range(5)]
    return found.select("event_id", *chances)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    click = F.when(F.col("event_type") == "click", "yes").otherwise("no")
    return event_bands(spark, sf_dir).withColumn("click", click)


def train_click_stump(spark, sf_dir):
    rows = clicks(spark, sf_dir)
    model = models.train_model(rows, BANDS, "click", "event_id", params=STUMP)
    scored = models.score(model, rows).withColumnRenamed("click", "y_true")
    found = metrics.binary_metrics(scored, score="y_pred_proba", positive="yes")
    return found.select("n", *[rounded(c).alias(c) for c in [*RATES, "roc_auc"]], *CELLS)


def click_regression(spark, sf_dir):
    rows = clicks(spark, sf_dir)
    fitted = models.train_model(
        rows, ["band"], "click", "event_id", "logistic_regression", {"tol": 1e-12}
    )
    return fitted, rows


def train_click_regression(spark, sf_dir):
    fitted, rows = click_regression(spark, sf_dir)
    found = fitted.stages[1]
    return rows.agg(F.count(F.lit(1)).alias("n")).select(
        "n",
        rounded(F.lit(float(found.coefficients[0])), 4).alias("coefficient"),
        rounded(F.lit(float(found.intercept)), 4).alias("intercept"),
    )


def click_scores(spark, sf_dir):
    fitted, rows = click_regression(spark, sf_dir)
    found = models.score(fitted, rows)
    return found.select("event_id", "y_pred", rounded("y_pred_proba", 4).alias("y_pred_proba"))


EXACT_TREE = {"n_estimators": 1, "max_depth": 3, "bootstrap": False, "max_features": None, "max_bins": None}
EXACT_FOREST = {"n_estimators": 20, "max_depth": 4, "min_samples_split": 5, "max_bins": None}


def train_exact_tree(spark, sf_dir):
    source = embeddings(spark, sf_dir).drop("label")
    model = models.train_model(source, EMBEDDING_FEATURES, "target", "vec_id", params=EXACT_TREE)
    chance = rounded(F.get("chances", F.lit(1))).alias("chance")
    return model.nodes.select("node", "feature", rounded("threshold").alias("threshold"), "n", chance)


def exact_forest_scores(spark, sf_dir):
    source = embeddings(spark, sf_dir).drop("label")
    model = models.train_model(source, EMBEDDING_FEATURES, "target", "vec_id", params=EXACT_FOREST)
    score = rounded("y_pred_proba").alias("y_pred_proba")
    return models.score(model, source).select("vec_id", "target", "y_pred", score)


def run_job_stump(spark, sf_dir):
    rows = event_bands(spark, sf_dir)
    source = rows.select("event_id", (F.col("event_type") < "f").cast("int").alias("target"), *BANDS)
    config = JobConfig(n_features=2, random_forest=STUMP)
    found = run_job(source, "event_id", "target", new_folder(spark), config, BANDS).metrics
    return found.select("n", *[rounded(c).alias(c) for c in [*RATES, "roc_auc"]], *CELLS)


EVENT_BANDS = """bands AS (
  SELECT event_id, event_type, least(floor(value / 20), 24) + 0e0 AS band,
         user_id % 20 + 0e0 AS user_band FROM events)"""


def stump_sql(rows: str) -> str:
    """The best cut of rows (event_id, y, band, user_band) by Gini, and the class counts on
    either side of it: leaves (below, y, n) and the cut (j, t)."""
    return f"""long AS (
  SELECT event_id, y, 0 AS j, band AS x FROM {rows} UNION ALL
  SELECT event_id, y, 1, user_band FROM {rows}),
steps AS (
  SELECT j, x, lead(x) OVER (PARTITION BY j ORDER BY x) AS above
  FROM (SELECT DISTINCT j, x FROM long)),
sides AS (
  SELECT s.j, (s.x + s.above) / 2 AS t, long.x <= s.x AS below, y, count(*) AS n
  FROM long JOIN steps s ON long.j = s.j WHERE s.above IS NOT NULL GROUP BY ALL),
pure AS (
  SELECT j, t, below, sum(n * n) / CAST(sum(n) AS DOUBLE) AS g FROM sides GROUP BY ALL),
cut AS (SELECT j, t FROM pure GROUP BY j, t ORDER BY sum(g) DESC, j, t LIMIT 1),
leaves AS (SELECT below, y, n, n / CAST(sum(n) OVER (PARTITION BY below) AS DOUBLE) AS p
           FROM sides JOIN cut USING (j, t))"""


BELOW = "CASE WHEN cut.j = 0 THEN band ELSE user_band END <= cut.t"


# A digest's first 12 hexadecimal digits as a number in [0, 1).
UNIFORM = "CAST('0x' || substr(md5({}), 1, 12) AS BIGINT) / 281474976710656e0"


def forest_sql(trees: int, depth: int, min_split: int, looked: int, bootstrap: bool, seed: int = 42) -> str:
    """Trees on the embeddings, level by level: draws (tree, key, y, x, w), and of each level i
    the totals t{i} and best splits b{i} of its nodes; nodes has them all."""
    u = UNIFORM.format(f"'{seed}:' || tree || ':' || vec_id")
    total, term, steps = 0.0, math.exp(-1.0), []
    for k in range(1, 64):
        total += term
        term *= 1.0 / k
        if total >= 1 - 1e-12:
            break
        steps.append(f"CAST({u} >= {total!r}e0 AS INTEGER)")
    w = " + ".join(steps) if bootstrap else "1"
    parts = [f"""s0 AS MATERIALIZED (SELECT * FROM (
      SELECT tree, CAST(1 AS BIGINT) AS node, vec_id, CAST(label < 5 AS INTEGER) AS y,
             CAST(embedding AS DOUBLE[]) AS x, {w} AS w FROM embeddings, range({trees}) t(tree)) WHERE w > 0)"""]
    drawn = UNIFORM.format(f"'{seed}:' || tree || ':' || node || ':' || f")
    for i in range(depth + 1):
        parts.append(f"""t{i} AS MATERIALIZED (
  SELECT tree, node, count(*) AS n, sum(w * (1 - y)) AS c0, sum(w * y) AS c1 FROM s{i} GROUP BY tree, node)""")
        if i == depth:
            break
        parts.append(f"""b{i} AS MATERIALIZED (
  SELECT tree, node, f, v, nxt FROM (
    SELECT tree, node, f, v, nxt, low_n, n, CAST(low0 AS DOUBLE) AS l0, CAST(low1 AS DOUBLE) AS l1,
           CAST(c0 - low0 AS DOUBLE) AS r0, CAST(c1 - low1 AS DOUBLE) AS r1 FROM (
      SELECT tree, node, f, v, lead(v) OVER up AS nxt, sum(k) OVER up AS low_n,
             sum(k0) OVER up AS low0, sum(k1) OVER up AS low1 FROM (
        SELECT tree, node, f, x[f + 1] AS v, count(*) AS k, sum(w * (1 - y)) AS k0, sum(w * y) AS k1
        FROM s{i} JOIN (
          SELECT tree, node, f FROM t{i}, range({DIMENSIONS}) g(f)
          WHERE n >= {min_split} AND c0 > 0 AND c1 > 0
          QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY {drawn}, f) <= {looked})
        USING (tree, node) GROUP BY ALL)
      WINDOW up AS (PARTITION BY tree, node, f ORDER BY v)) JOIN t{i} USING (tree, node))
  WHERE nxt IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY
    (l0 * l0 + l1 * l1) / (l0 + l1) + (r0 * r0 + r1 * r1) / (r0 + r1) DESC, f, v) = 1),
c{i} AS MATERIALIZED (
  SELECT tree, node, f, CASE WHEN (v + nxt) / 2 < nxt THEN (v + nxt) / 2 ELSE v END AS cut FROM b{i}),
s{i + 1} AS MATERIALIZED (
  SELECT tree, 2 * node + CAST(x[f + 1] > cut AS BIGINT) AS node, vec_id, y, x, w FROM s{i} JOIN c{i} USING (tree, node))""")
    every = " UNION ALL ".join(
        f"SELECT tree, node, n, c0, c1, {'f, cut' if i < depth else 'NULL AS f, NULL AS cut'} FROM t{i}"
        + (f" LEFT JOIN c{i} USING (tree, node)" if i < depth else "")
        for i in range(depth + 1)
    )
    parts.append(f"""nodes AS MATERIALIZED (
  SELECT tree, node, n, f, cut, c1 / CAST(c0 + c1 AS DOUBLE) AS p FROM ({every}))""")
    return ",\n".join(parts)


FOREST_SCORES = """walked AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x, tree, CAST(1 AS BIGINT) AS node
  FROM embeddings, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT vec_id, label, x, tree, 2 * n.node + CAST(x[f + 1] > cut AS BIGINT)
  FROM walked JOIN nodes n USING (tree, node) WHERE f IS NOT NULL),
scored AS (SELECT vec_id, any_value(label) AS label, avg(p) AS p FROM walked JOIN nodes USING (tree, node)
           WHERE f IS NULL GROUP BY vec_id)"""


def newton_sql(steps: int = 12) -> str:
    """Newton steps for the loss of (x, n, k) plus w * w / 2, unrolled: the last is s{steps}."""
    parts = ["s0 AS (SELECT 0e0 AS w, 0e0 AS b)"]
    for i in range(steps):
        parts.append(f"""g{i} AS (
  SELECT w, b, x, n, k, 1 / (1 + exp(-(w * x + b))) AS p FROM folded, s{i}),
h{i} AS (
  SELECT any_value(w) AS w, any_value(b) AS b, sum((n * p - k) * x) + any_value(w) AS gw,
         sum(n * p - k) AS gb, sum(n * p * (1 - p) * x * x) + 1 AS ww,
         sum(n * p * (1 - p) * x) AS wb, sum(n * p * (1 - p)) AS bb FROM g{i}),
s{i + 1} AS (
  SELECT w - (bb * gw - wb * gb) / (ww * bb - wb * wb) AS w,
         b - (ww * gb - wb * gw) / (ww * bb - wb * wb) AS b FROM h{i})""")
    return ",\n".join(parts)


def gram_newton_sql(rows: str, size: int, steps: int = 9, first: int = 30, further: int = 9) -> str:
    """Newton steps for the loss of rows (k, y, x) plus half the squared length of the
    coefficients: w{steps} has them by position, the intercept behind the others. The Gram
    matrix is inverted by z <- z (2 I - h z), from the last step's inverse on."""
    parts = [f"""xs AS MATERIALIZED (
  SELECT k, y, CAST(unnest(range(len(x) + 1)) AS INTEGER) AS i, unnest(list_append(x, 1e0)) AS v FROM {rows}),
w0 AS MATERIALIZED (SELECT DISTINCT i, 0e0 AS v FROM xs)"""]
    inverse = ""
    for s in range(steps):
        parts.append(f"""p{s} AS MATERIALIZED (
  SELECT k, any_value(y) AS y, 1 / (1 + exp(-sum(x.v * w.v))) AS p FROM xs x JOIN w{s} w USING (i) GROUP BY k),
g{s} AS MATERIALIZED (
  SELECT i, sum(x.v * (p - p{s}.y)) + any_value(CASE WHEN i < {size} THEN w.v ELSE 0 END) AS v
  FROM xs x JOIN p{s} USING (k) JOIN w{s} w USING (i) GROUP BY i),
h{s} AS MATERIALIZED (
  SELECT a.i, b.i AS j, sum(a.v * b.v * p * (1 - p)) + any_value(CASE WHEN a.i = b.i AND a.i < {size} THEN 1 ELSE 0 END) AS v
  FROM xs a JOIN p{s} USING (k) JOIN xs b USING (k) GROUP BY a.i, b.i)""")
        if not inverse:
            inverse = f"z{s}_0"
            parts.append(f"""{inverse} AS MATERIALIZED (
  SELECT i, j, v / (SELECT max(r) ** 2 FROM (SELECT sum(abs(v)) AS r FROM h{s} GROUP BY i)) AS v FROM h{s})""")
        for t in range(first if s == 0 else further):
            better = f"z{s}_{t + 1}"
            parts.append(f"""m{s}_{t} AS MATERIALIZED (
  SELECT a.i, b.j, CASE WHEN a.i = b.j THEN 2 ELSE 0 END - sum(a.v * b.v) AS v
  FROM h{s} a JOIN {inverse} b ON a.j = b.i GROUP BY a.i, b.j),
{better} AS MATERIALIZED (
  SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {inverse} a JOIN m{s}_{t} b ON a.j = b.i GROUP BY a.i, b.j)""")
            inverse = better
        parts.append(f"""w{s + 1} AS MATERIALIZED (
  SELECT w.i, any_value(w.v) - sum(z.v * g.v) AS v
  FROM w{s} w JOIN {inverse} z ON z.i = w.i JOIN g{s} g ON g.i = z.j GROUP BY w.i)""")
    parts.append(f"fitted AS MATERIALIZED (SELECT i, v FROM w{steps})")
    return ",\n".join(parts)


def chances_sql(rows: str) -> str:
    """(k, y, p) of rows (k, y, x) under fitted."""
    return f"""(SELECT k, any_value(y) AS y, 1 / (1 + exp(-(sum(c.v * f.v) + (SELECT arg_max(v, i) FROM fitted)))) AS p
    FROM (SELECT k, y, CAST(unnest(range(len(x))) AS INTEGER) AS i, unnest(x) AS v FROM {rows}) c
    JOIN fitted f USING (i) GROUP BY k)"""


# The embeddings, split by their target as the queries split them.
SPLIT_EMBEDDINGS = """every AS MATERIALIZED (
  SELECT vec_id AS k, CAST(label < 5 AS INTEGER) AS y, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
class_counts AS (SELECT y, count(*) AS n FROM every GROUP BY y),
sizes AS (SELECT sum(n) - CAST(ceil(0.3e0 * sum(n)) AS BIGINT) AS n_train, sum(n) AS rows FROM class_counts),
class_shares AS (SELECT y, n, (n * n_train) // rows AS share, (n * n_train) % rows AS rest, n_train
           FROM class_counts, sizes),
class_quota AS (SELECT y, share + CASE WHEN row_number() OVER (ORDER BY rest DESC, y)
            <= n_train - sum(share) OVER () THEN 1 ELSE 0 END AS quota FROM class_shares),
assigned AS MATERIALIZED (
  SELECT e.*, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || k)) <= quota AS training
  FROM every e JOIN class_quota USING (y)),
train AS MATERIALIZED (SELECT k, y, x FROM assigned WHERE training),
test AS MATERIALIZED (SELECT k, y, x FROM assigned WHERE NOT training)"""

# The job's own preparation: features scaled and chosen on all rows, in their own order.
JOB_EMBEDDINGS = f"""{SPLIT_EMBEDDINGS},
values_of AS MATERIALIZED (
  SELECT k, y, training, unnest(x) AS v, CAST(unnest(range(len(x))) AS INTEGER) AS i FROM assigned),
centres AS MATERIALIZED (SELECT i, avg(v) AS mean, stddev_pop(v) AS std FROM values_of GROUP BY i),
by_class AS (SELECT i, y, count(*) AS n, avg(v) AS m, var_pop(v) AS s FROM values_of GROUP BY i, y),
scores_of AS (
  SELECT i, sum(n * (m - mean) ** 2) / (sum(n * s) / (sum(n) - 2)) AS f FROM by_class JOIN centres USING (i) GROUP BY i),
chosen AS MATERIALIZED (SELECT i FROM scores_of ORDER BY f DESC, i DESC LIMIT {K}),
scaled AS MATERIALIZED (
  SELECT k, y, training, list((v - mean) / std ORDER BY i) AS x
  FROM values_of JOIN centres USING (i) JOIN chosen USING (i) GROUP BY k, y, training),
scaled_train AS MATERIALIZED (SELECT k, y, x FROM scaled WHERE training),
scaled_test AS MATERIALIZED (SELECT k, y, x FROM scaled WHERE NOT training)"""


REGRESSION = f"""{EVENT_BANDS},
folded AS (SELECT band AS x, count(*) AS n, sum(CAST(event_type = 'click' AS INTEGER)) AS k
           FROM bands GROUP BY band),
{newton_sql()}"""

SCORED_METRICS = """cells AS (
  SELECT count(*) AS n, sum(CAST(y = hit AS INTEGER)) AS hits,
         sum(CAST(hit = 1 AND y = 1 AS INTEGER)) AS tp, sum(CAST(hit = 1 AND y = 0 AS INTEGER)) AS fp,
         sum(CAST(hit = 0 AND y = 1 AS INTEGER)) AS fn, sum(CAST(hit = 0 AND y = 0 AS INTEGER)) AS tn
  FROM scored),
by_score AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY p),
won AS (
  SELECT sum(pos * (neg / 2e0 + coalesce((SELECT sum(neg) FROM by_score o WHERE o.p < s.p), 0)))
         / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS roc_auc FROM by_score s)
SELECT n, round(hits / n, 6) + 0e0 AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0e0), 6) + 0e0 AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0e0), 6) + 0e0 AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0e0), 6) + 0e0 AS f1,
       round(roc_auc, 6) + 0e0 AS roc_auc, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp,
       CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp
FROM cells, won"""

MODEL_SQL = {
    "predict_classes": f"""WITH {EVENT_BANDS}, rows AS (SELECT *, event_type AS y FROM bands),
      {stump_sql("rows")},
      called AS (SELECT below, y, row_number() OVER (PARTITION BY below ORDER BY n DESC, y) AS place
                 FROM leaves)
      SELECT event_id, event_type, called.y AS y_pred
      FROM bands, cut JOIN called ON place = 1 AND called.below = ({BELOW})""",
    "predict_class_proba": f"""WITH {EVENT_BANDS}, rows AS (SELECT *, event_type AS y FROM bands),
      {stump_sql("rows")},
      ranked AS (SELECT event_type AS y, row_number() OVER (ORDER BY event_type) - 1 AS i
                 FROM (SELECT DISTINCT event_type FROM events)),
      wide AS (SELECT below, """ + ", ".join(
        f"round(coalesce(max(CASE WHEN i = {i} THEN p END), 0), 6) + 0e0 AS p{i}" for i in range(5)
    ) + f""" FROM leaves JOIN ranked USING (y) GROUP BY below)
      SELECT event_id, p0, p1, p2, p3, p4 FROM bands, cut JOIN wide ON wide.below = ({BELOW})""",
    "train_click_stump": f"""WITH {EVENT_BANDS},
      rows AS (SELECT *, CAST(event_type = 'click' AS INTEGER) AS y FROM bands),
      {stump_sql("rows")},
      chance AS (SELECT below, coalesce(max(CASE WHEN y = 1 THEN p END), 0e0) AS p
                 FROM leaves GROUP BY below),
      scored AS (SELECT y, p, CAST(p > 0.5 AS INTEGER) AS hit
                 FROM rows, cut JOIN chance ON chance.below = ({BELOW})),
      {SCORED_METRICS}""",
    "train_click_regression": f"""WITH {REGRESSION}
      SELECT CAST((SELECT sum(n) FROM folded) AS BIGINT) AS n,
             round(w, 4) + 0e0 AS coefficient, round(b, 4) + 0e0 AS intercept FROM s12""",
    "click_scores": f"""WITH {REGRESSION},
      chance AS (SELECT event_id, 1 / (1 + exp(-(w * band + b))) AS p FROM bands, s12)
      SELECT event_id, CASE WHEN p > 0.5 THEN 'yes' ELSE 'no' END AS y_pred,
             round(p, 4) + 0e0 AS y_pred_proba FROM chance""",
    "train_logistic_regression": f"""WITH {SPLIT_EMBEDDINGS},
      {gram_newton_sql("train", DIMENSIONS)},
      scored AS MATERIALIZED (SELECT y, p, CAST(p > 0.5 AS INTEGER) AS hit FROM {chances_sql("train")}),
      {SCORED_METRICS}""",
    "predict_proba": f"""WITH {SPLIT_EMBEDDINGS},
      {gram_newton_sql("train", DIMENSIONS)}
      SELECT k AS vec_id, y AS target, round(1 - p, 6) + 0e0 AS p0, round(p, 6) + 0e0 AS p1
      FROM {chances_sql("test")}""",
    "positive_score": f"""WITH {SPLIT_EMBEDDINGS},
      {gram_newton_sql("train", DIMENSIONS)}
      SELECT k AS vec_id, CAST(p > 0.5 AS INTEGER) AS y_pred, round(p, 6) + 0e0 AS y_pred_proba
      FROM {chances_sql("test")}""",
    "run_job_logistic": f"""WITH {JOB_EMBEDDINGS},
      {gram_newton_sql("scaled_train", K)},
      scored AS MATERIALIZED (SELECT y, p, CAST(p > 0.5 AS INTEGER) AS hit FROM {chances_sql("scaled_test")}),
      {SCORED_METRICS}""",
    "train_exact_tree": f"""WITH {forest_sql(1, 3, 2, DIMENSIONS, False)}
      SELECT node, CAST(f AS INTEGER) AS feature, round(cut, 6) + 0e0 AS threshold, n,
             round(p, 6) + 0e0 AS chance FROM nodes""",
    "exact_forest_scores": f"""WITH RECURSIVE {forest_sql(20, 4, 5, 8, True)},
      {FOREST_SCORES}
      SELECT vec_id, CAST(label < 5 AS INTEGER) AS target, CAST(p > 0.5 AS INTEGER) AS y_pred,
             round(p, 6) + 0e0 AS y_pred_proba FROM scored""",
    "run_job_stump": f"""WITH {EVENT_BANDS},
      cleaned AS (SELECT min(event_id) AS event_id, band, user_band,
                    arg_min(CAST(event_type < 'f' AS INTEGER), event_id) AS y
                  FROM bands WHERE band IS NOT NULL AND user_band IS NOT NULL GROUP BY band, user_band),
      counts AS (SELECT y, count(*) AS n FROM cleaned GROUP BY y),
      total AS (SELECT sum(n) - CAST(ceil(0.3e0 * sum(n)) AS BIGINT) AS n_train, sum(n) AS rows FROM counts),
      shares AS (SELECT y, n, (n * n_train) // rows AS share, (n * n_train) % rows AS rest, n_train
                 FROM counts, total),
      quota AS (SELECT y, share + CASE WHEN row_number() OVER (ORDER BY rest DESC, y)
                  <= n_train - sum(share) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
      assigned AS (SELECT c.*, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || event_id))
                     <= quota AS training FROM cleaned c JOIN quota USING (y)),
      rows AS (SELECT * FROM assigned WHERE training),
      {stump_sql("rows")},
      chance AS (SELECT below, coalesce(max(CASE WHEN y = 1 THEN p END), 0e0) AS p
                 FROM leaves GROUP BY below),
      scored AS (SELECT y, p, CAST(p > 0.5 AS INTEGER) AS hit
                 FROM assigned, cut JOIN chance ON chance.below = ({BELOW}) WHERE NOT training),
      {SCORED_METRICS}""",
}


# ---------------------------------------------------------------------------
# Models and the whole job


def fitted_model(spark, sf_dir, algorithm, params=None):
    """Model fitted on the training side; both sides with key and target."""
    source = embeddings(spark, sf_dir).drop("label")
    assigned = splitting.stratified_split(source, "vec_id", "target", 0.3, 42)
    train = assigned.where(F.col("split") == "train").drop("split")
    model = models.train_model(train, EMBEDDING_FEATURES, "target", "vec_id", algorithm, params)
    return model, train, assigned


# The solver with the same result however the rows are laid out.
NEWTON = {"solver": "newton-cholesky", "tol": 1e-13}


def training_metrics(spark, sf_dir, algorithm, params=None):
    """Metrics on the training side; scored once, since the area reads scores again."""
    model, train, _ = fitted_model(spark, sf_dir, algorithm, params)
    scored = models.score(model, train).withColumnRenamed("target", "y_true")
    kept = stored(scored.select("vec_id", "y_true", "y_pred", "y_pred_proba"))
    return metrics.binary_metrics(kept, score="y_pred_proba")


def rounded_metrics(found: DataFrame) -> DataFrame:
    return found.select("n", *[rounded(c).alias(c) for c in [*RATES, "roc_auc"]], *CELLS)


def train_random_forest(spark, sf_dir):
    return training_metrics(spark, sf_dir, "random_forest")


def train_logistic_regression(spark, sf_dir):
    return rounded_metrics(training_metrics(spark, sf_dir, "logistic_regression", NEWTON))


def held_out(assigned: DataFrame) -> DataFrame:
    return assigned.where(F.col("split") == "test").drop("split")


def predict(spark, sf_dir):
    model, _, assigned = fitted_model(spark, sf_dir, "random_forest")
    return models.predict(model, held_out(assigned)).select("vec_id", "target", "y_pred")


def predict_proba(spark, sf_dir):
    model, _, assigned = fitted_model(spark, sf_dir, "logistic_regression", NEWTON)
    chances = [rounded(F.get("y_proba", F.lit(i))).alias(f"p{i}") for i in range(2)]
    return models.predict_proba(model, held_out(assigned)).select("vec_id", "target", *chances)


def positive_score(spark, sf_dir):
    model, _, assigned = fitted_model(spark, sf_dir, "logistic_regression", NEWTON)
    found = models.score(model, held_out(assigned))
    return found.select("vec_id", "y_pred", rounded("y_pred_proba").alias("y_pred_proba"))


def whole_job(spark, sf_dir, **changes):
    source = embeddings(spark, sf_dir).drop("label")
    config = JobConfig().with_changes(**changes)
    return run_job(source, "vec_id", "target", new_folder(spark), config, EMBEDDING_FEATURES)


def run_job_forest(spark, sf_dir):
    return whole_job(spark, sf_dir).metrics


def run_job_logistic(spark, sf_dir):
    found = whole_job(
        spark, sf_dir, algorithm="logistic_regression", logistic_regression=NEWTON, fit_on="all"
    ).metrics
    return rounded_metrics(found)


# ---------------------------------------------------------------------------
# Comparison of runs, profiles


def compare_labels(spark, sf_dir):
    return comparison.compare_labels(runs(spark, sf_dir), "first", "doc_id")


def compare_predictions(spark, sf_dir):
    return comparison.compare_predictions(runs(spark, sf_dir), "first", "doc_id")


def compare_scores(spark, sf_dir):
    return comparison.compare_scores(runs(spark, sf_dir), "first", "doc_id")


def run_summary(spark, sf_dir):
    summary = comparison.run_summary(runs(spark, sf_dir), "first", "doc_id")
    flags = ["same_labels", "same_predictions", "same_scores"]
    return summary.select(
        "run_id", "n", *[rounded(c).alias(c) for c in [*RATES, "roc_auc"]], *CELLS, *flags
    )


def run_summary_from_states(spark, sf_dir):
    """The same summary from what was stored with each run as it came."""
    folder, results = new_folder(spark), runs(spark, sf_dir)
    for name in ("first", "echo", "longer", "swapped"):
        artifacts.write_run_result(results.where(F.col("run_id") == name).drop("run_id"), folder, name, "doc_id")
        artifacts.write_run_state(spark, folder, name, "doc_id")
    summary = artifacts.summarise_runs(spark, folder, "first", "doc_id")
    flags = ["same_labels", "same_predictions", "same_scores"]
    return summary.select(
        "run_id", "n", *[rounded(c).alias(c) for c in [*RATES, "roc_auc"]], *CELLS, *flags
    )


def class_distribution(spark, sf_dir):
    found = profiles.class_distribution(table(spark, sf_dir, "events"), "event_type")
    return found.select("event_type", "n", rounded("share").alias("share"))


def feature_profile(spark, sf_dir):
    found = profiles.feature_profile(table(spark, sf_dir, "lineitem"), ITEM_FEATURES)
    values = [rounded(c, 4).alias(c) for c in ("mean", "std")]
    return found.select("feature", "n", "n_missing", *values)


def profile_summary(spark, sf_dir):
    found = profiles.profile_summary(table(spark, sf_dir, "lineitem"), ITEM_FEATURES)
    return found.select(
        "n_rows",
        "n_features",
        rounded("mean_of_means", 4).alias("mean_of_means"),
        rounded("mean_of_stds", 4).alias("mean_of_stds"),
    )


def prediction_distribution(spark, sf_dir):
    return profiles.prediction_distribution(stored_predictions(spark, sf_dir))


def split_overlap(spark, sf_dir):
    assigned = split_events(spark, sf_dir)
    train = assigned.where(F.col("split") == "train")
    return splitting.split_overlap(train, assigned.where(F.col("split") == "test"), "event_id")


def null_counts(spark, sf_dir):
    return profiles.null_counts(gapped_events(spark, sf_dir))


def split_balance(spark, sf_dir):
    found = splitting.split_balance(split_events(spark, sf_dir), "event_type")
    shares = [rounded(c).alias(c) for c in ("share", "train_share", "test_share")]
    return found.select("event_type", *shares)


# ---------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The whole job on the smoke tables: one row of metrics."""
    return run_job_forest(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator."""
    own = {
        "load_labeled": load_labeled,
        "load_label_fallback": load_label_fallback,
        "read_write_dataset": named_datasets,
        "write_stage": write_stage_table,
        "write_metrics_json": write_metrics_json,
        "write_confusion_csv": write_confusion_csv,
        "write_predictions": write_predictions,
        "write_report_text": write_report_text,
        "save_load_model": save_load_model,
        "save_load_scaler": save_load_scaler,
        "write_run_result": write_run_result,
        "derive_binary_target": derive_binary_target,
        "drop_columns": drop_columns,
        "project_selected": project_selected,
        "match_flag": match_flags,
        "positive_score": positive_score,
        "encode_target": encode_order_status,
        "encode_target_part_type": encode_part_type,
        "encode_target_numeric": encode_numeric,
        "drop_incomplete": drop_incomplete,
        "dedup_rows": dedup_rows,
        "dense_index": index_events,
        "clean_data": clean_data,
        "attach_target": attach_target,
        "join_predictions": join_predictions,
        "apply_params": apply_params,
        "fit_scaler": fit_scaler,
        "apply_scaler": apply_scaler,
        "fit_train_apply_test": fit_train_apply_test,
        "anova_f": anova_f,
        "f_score_edge_cases": f_score_edge_cases,
        "select_k_best": select_k_best,
        "top_features": top_features,
        "stratified_split": stratified_split,
        "split_quota": split_quota,
        "confusion_matrix": confusion_matrix,
        "confusion_matrix_many_classes": confusion_matrix_many,
        "binary_metrics": binary_metrics,
        "roc_auc": roc_auc,
        "classification_report": classification_report,
        "train_accuracy": train_accuracy,
        "metrics_by_run": metrics_by_run,
        "train_random_forest": train_random_forest,
        "train_logistic_regression": train_logistic_regression,
        "predict": predict,
        "predict_proba": predict_proba,
        "run_job": run_job_forest,
        "run_job_logistic": run_job_logistic,
        "compare_labels": compare_labels,
        "compare_predictions": compare_predictions,
        "compare_scores": compare_scores,
        "run_summary": run_summary,
        "run_summary_from_states": run_summary_from_states,
        "class_distribution": class_distribution,
        "feature_profile": feature_profile,
        "profile_summary": profile_summary,
        "prediction_distribution": prediction_distribution,
        "split_overlap": split_overlap,
        "null_counts": null_counts,
        "split_balance": split_balance,
        "predict_classes": predict_classes,
        "predict_class_proba": predict_class_proba,
        "train_click_stump": train_click_stump,
        "train_click_regression": train_click_regression,
        "click_scores": click_scores,
        "run_job_stump": run_job_stump,
        "train_exact_tree": train_exact_tree,
        "exact_forest_scores": exact_forest_scores,
    }
    return own | (corpus.QUERIES | {"pipeline": corpus_pipeline.run} if corpus else {})


def per_feature(expression: str, separator: str = ", ") -> str:
    """The expression once per item feature, with {c} standing for its name."""
    return separator.join(expression.format(c=c) for c in ITEM_FEATURES)


def oracle_sql() -> dict[str, str]:
    """SQL for every query but those whose result comes from an iterative fit."""
    binary = """SELECT {columns} FROM (
      SELECT CAST(count(*) AS BIGINT) AS n,
             round(avg(CASE WHEN quality = toxic THEN 1e0 ELSE 0e0 END), 6) + 0e0 AS accuracy,
             round(coalesce(sum(quality * toxic) / nullif(sum(toxic), 0), 0e0), 6) + 0e0 AS precision,
             round(coalesce(sum(quality * toxic) / nullif(sum(quality), 0), 0e0), 6) + 0e0 AS recall,
             round(coalesce(2 * sum(quality * toxic) / nullif(sum(quality) + sum(toxic), 0), 0e0), 6)
               + 0e0 AS f1,
             CAST(sum((1 - quality) * (1 - toxic)) AS BIGINT) AS tn,
             CAST(sum((1 - quality) * toxic) AS BIGINT) AS fp,
             CAST(sum(quality * (1 - toxic)) AS BIGINT) AS fn,
             CAST(sum(quality * toxic) AS BIGINT) AS tp
      FROM labels)"""
    scaler = per_feature(
        "SELECT '{c}' AS feature, round(avg({c}), 4) + 0e0 AS mean, "
        "round(stddev_pop({c}), 4) + 0e0 AS std FROM lineitem",
        " UNION ALL ",
    )
    predictions = """SELECT doc_id, quality AS y_true, toxic AS y_pred,
        CAST(quality = toxic AS INTEGER) AS match FROM labels"""
    cleaned = f"""WITH {BANDED}, kept AS (
        SELECT *, row_number() OVER (PARTITION BY band, user_id ORDER BY event_id) AS place
        FROM banded WHERE band IS NOT NULL AND user_id IS NOT NULL)
      SELECT event_id, event_type, band, user_id{{index}} FROM kept WHERE place = 1"""
    encoded = """SELECT {key}, {label},
        CAST(dense_rank() OVER (ORDER BY {label}) - 1 AS INTEGER) AS code FROM {table}"""
    own = {
        "load_labeled": RAW_ITEMS,
        "load_label_fallback": """SELECT doc_id, quality AS target,
            CAST(toxic AS DOUBLE) AS toxic FROM labels""",
        "read_write_dataset": "SELECT event_id, event_type, value FROM events",
        "write_stage": cleaned.format(index=""),
        "write_metrics_json": binary.format(columns=", ".join(RATES)),
        "write_confusion_csv": """SELECT 'Actual ' || quality AS actual,
            CAST(sum(1 - toxic) AS BIGINT) AS "Predicted 0",
            CAST(sum(toxic) AS BIGINT) AS "Predicted 1" FROM labels GROUP BY quality""",
        "write_predictions": predictions,
        "write_report_text": f"""WITH {REPORT}
          SELECT '             ' || ' precision    recall  f1-score   support' AS line
          UNION ALL SELECT '' UNION ALL SELECT ''
          UNION ALL
          SELECT format('{{:>12}} ', label)
              || CASE WHEN precision IS NULL THEN '          '
                      ELSE format('{{:>10.2f}}', precision) END
              || CASE WHEN recall IS NULL THEN '          ' ELSE format('{{:>10.2f}}', recall) END
              || format('{{:>10.2f}}{{:>10}}', f1, CAST(support AS BIGINT))
          FROM report""",
        "save_load_model": """SELECT CAST(count(*) AS BIGINT) AS n,
            CAST(0 AS BIGINT) AS n_changed FROM embeddings""",
        "save_load_scaler": scaler,
        "write_run_result": f"""WITH {RUNS} SELECT doc_id, run_id, y_true, y_pred, y_pred_proba
          FROM runs""",
        "derive_binary_target": RAW_ITEMS,
        "drop_columns": "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
        "project_selected": f"""WITH {F_SCORES}
          SELECT vec_id, feature, x AS value FROM e JOIN ranked USING (position)
          WHERE rank <= {K}""",
        "match_flag": predictions,
        "encode_target": encoded.format(key="o_orderkey", label="o_orderstatus", table="orders"),
        "encode_target_part_type": encoded.format(key="p_partkey", label="p_type", table="part"),
        "encode_target_numeric": "SELECT doc_id, quality, quality AS code FROM labels",
        "drop_incomplete": f"""WITH {GAPPED} SELECT event_id, event_type, value, user_id
          FROM gapped WHERE value IS NOT NULL AND user_id IS NOT NULL""",
        "dedup_rows": """SELECT event_id, user_id, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS p
            FROM events) WHERE p = 1""",
        "dense_index": """SELECT event_id, event_type,
            CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS index FROM events""",
        "clean_data": cleaned.format(
            index=", CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS index"
        ),
        "attach_target": """SELECT doc_id, lang, n_chars, quality, toxic
            FROM documents JOIN labels USING (doc_id)""",
        "join_predictions": predictions,
        "apply_params": per_feature(
            "SELECT l_orderkey, l_linenumber, '{c}' AS feature, "
            "round(({c} - (SELECT avg({c}) FROM lineitem)) "
            "/ (SELECT stddev_pop({c}) FROM lineitem), 5) + 0e0 AS scaled FROM lineitem",
            " UNION ALL ",
        ),
        "fit_scaler": scaler,
        "apply_scaler": "SELECT l_orderkey, " + per_feature(
            "round(({c} - (SELECT avg({c}) FROM lineitem)) "
            "/ (SELECT stddev_pop({c}) FROM lineitem), 5) + 0e0 AS {c}"
        ) + " FROM lineitem",
        "fit_train_apply_test": f"""WITH {SPLIT}, params AS (
            SELECT avg(value) AS mean, stddev_pop(value) AS std FROM assigned
            WHERE split = 'train')
          SELECT event_id, event_type, round((value - mean) / std, 5) + 0e0 AS value
          FROM assigned, params WHERE split = 'test'""",
        "anova_f": f"""WITH {F_SCORES}
          SELECT position, feature, round(f_score, 6) + 0e0 AS f_score FROM f""",
        "f_score_edge_cases": """WITH named AS (
            SELECT unnest(['flat', 'apart', 'value']) AS feature,
                   unnest([0.1e0, CASE WHEN event_type = 'click' THEN 1e0 ELSE 0e0 END, value]) AS x,
                   event_type = 'click' AS target FROM events),
          c AS (SELECT feature, target, count(*) AS n, avg(x) AS m, var_pop(x) AS v,
                       min(x) AS low, max(x) AS high FROM named GROUP BY feature, target),
          g AS (SELECT feature, min(low) = max(high) AS no_score,
                       bool_and(low = high) AND min(low) <> max(high) AS infinite FROM c
                GROUP BY feature),
          r AS (SELECT *, CAST(row_number() OVER (
                  ORDER BY CASE WHEN no_score THEN 2 WHEN infinite THEN 0 ELSE 1 END) AS INTEGER)
                  AS rank FROM g)
          SELECT feature, rank, CAST(rank <= 2 AS INTEGER) AS selected, no_score, infinite
          FROM r""",
        "select_k_best": f"""WITH {F_SCORES} SELECT position, feature, rank,
            CAST(rank <= {K} AS INTEGER) AS selected FROM ranked""",
        "top_features": f"""WITH {F_SCORES} SELECT position, feature FROM ranked
            WHERE rank <= {K} ORDER BY position LIMIT 5""",
        "stratified_split": f"WITH {SPLIT} SELECT event_id, event_type, split FROM assigned",
        "split_quota": f"""WITH {QUOTAS}
            SELECT event_type, n, n_train, n - n_train AS n_test FROM quota""",
        "confusion_matrix": """WITH v AS (SELECT quality AS v FROM labels UNION
              SELECT toxic FROM labels)
          SELECT t.v AS y_true, p.v AS y_pred, CAST(count(doc_id) AS BIGINT) AS n
          FROM v t CROSS JOIN v p LEFT JOIN labels ON quality = t.v AND toxic = p.v
          GROUP BY ALL""",
        "confusion_matrix_many_classes": """WITH called AS (
            SELECT event_type AS y_true,
                   CASE WHEN value > 50 THEN 'view' ELSE event_type END AS y_pred FROM events),
          cells AS (SELECT y_true, y_pred, count(*) AS n FROM called GROUP BY ALL),
          v AS (SELECT y_true AS v FROM cells UNION SELECT y_pred FROM cells)
          SELECT t.v AS y_true, p.v AS y_pred, CAST(coalesce(n, 0) AS BIGINT) AS n
          FROM v t CROSS JOIN v p LEFT JOIN cells ON y_true = t.v AND y_pred = p.v""",
        "binary_metrics": binary.format(columns=", ".join(["n", *RATES, *CELLS])),
        "roc_auc": """WITH s AS (
            SELECT n_chars, sum(quality) AS pos, sum(1 - quality) AS neg
            FROM labels JOIN documents USING (doc_id) GROUP BY n_chars),
          u AS (SELECT pos, neg, pos * (coalesce(sum(neg) OVER (ORDER BY n_chars
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + neg / 2e0) AS won FROM s)
          SELECT round(sum(won) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0), 6) + 0e0
            AS roc_auc FROM u""",
        "classification_report": f"""WITH {REPORT}
          SELECT CAST(position AS BIGINT) AS position, label, round(precision, 6) + 0e0 AS precision,
                 round(recall, 6) + 0e0 AS recall, round(f1, 6) + 0e0 AS f1,
                 CAST(support AS BIGINT) AS support FROM report""",
        "train_accuracy": """SELECT round(avg(CASE WHEN quality = toxic THEN 1e0 ELSE 0e0 END), 6)
            + 0e0 AS accuracy FROM labels""",
        "metrics_by_run": f"WITH {RUN_METRICS} SELECT * FROM evaluated",
        "compare_labels": f"WITH {COMPARED} SELECT run_id, same_labels FROM agreed",
        "compare_predictions": f"WITH {COMPARED} SELECT run_id, same_predictions FROM agreed",
        "compare_scores": f"WITH {COMPARED} SELECT run_id, same_scores FROM agreed",
        "run_summary": f"""WITH {RUN_METRICS}, {COMPARED.removeprefix(RUNS + ', ')}
          SELECT * FROM evaluated LEFT JOIN agreed USING (run_id)""",
        "class_distribution": """SELECT event_type, CAST(count(*) AS BIGINT) AS n,
            round(count(*) / (SELECT count(*) FROM events), 6) + 0e0 AS share
            FROM events GROUP BY event_type""",
        "feature_profile": per_feature(
            "SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS n, "
            "CAST(count(*) - count({c}) AS BIGINT) AS n_missing, round(avg({c}), 4) + 0e0 AS mean, "
            "round(stddev_samp({c}), 4) + 0e0 AS std FROM lineitem",
            " UNION ALL ",
        ),
        "profile_summary": "WITH p AS (" + per_feature(
            "SELECT avg({c}) AS mean, stddev_samp({c}) AS std FROM lineitem", " UNION ALL "
        ) + """) SELECT (SELECT CAST(count(*) AS BIGINT) FROM lineitem) AS n_rows,
            CAST(count(*) AS BIGINT) AS n_features, round(avg(mean), 4) + 0e0 AS mean_of_means,
            round(avg(std), 4) + 0e0 AS mean_of_stds FROM p""",
        "prediction_distribution": """SELECT toxic AS y_pred, CAST(count(*) AS BIGINT) AS n
            FROM labels GROUP BY toxic""",
        "split_overlap": f"""WITH {SPLIT}
          SELECT CAST(count(*) FILTER (split = 'train') AS BIGINT) AS n_train,
                 CAST(count(*) FILTER (split = 'test') AS BIGINT) AS n_test,
                 CAST(count(DISTINCT event_id) AS BIGINT) AS n_total,
                 (SELECT CAST(count(*) AS BIGINT) FROM (
                    SELECT event_id FROM assigned WHERE split = 'train' INTERSECT
                    SELECT event_id FROM assigned WHERE split = 'test')) AS n_overlap
          FROM assigned""",
        "null_counts": f"WITH {GAPPED} " + " UNION ALL ".join(
            f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS n_missing FROM gapped"
            for c in ("event_id", "event_type", "value", "user_id")
        ),
        "split_balance": f"""WITH {SPLIT} SELECT event_type,
            round(count(*) / sum(count(*)) OVER (), 6) + 0e0 AS share,
            round(count(*) FILTER (split = 'train')
              / sum(count(*) FILTER (split = 'train')) OVER (), 6) + 0e0 AS train_share,
            round(count(*) FILTER (split = 'test')
              / sum(count(*) FILTER (split = 'test')) OVER (), 6) + 0e0 AS test_share
          FROM assigned GROUP BY event_type""",
    }
    own["run_summary_from_states"] = own["run_summary"]
    return own | MODEL_SQL | (corpus.ORACLES if corpus else {})
