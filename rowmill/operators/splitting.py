"""Exact stratified train/test split.

Rows are ordered at random by a digest of their key, and each class gives its
lowest digests to the training side. The class quotas are exact, so all that has
to be found is one digest per class: the cut. Digests are spread evenly, so the
cut lies within a few standard deviations of the quota's share of the digest
range. One pass counts the rows below that bracket (a grouped count, combined
inside each task) and keeps the digests inside it, of the order of the square
root of the class size; ranking those gives the cut. If it is not among them the
bracket is widened. With the cuts known, membership is a comparison per row.

Counts, quotas and cuts are tables with a row per class, so any number of classes
can be split; the driver gets their totals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowmill.functions import key_hash, quoted, require_columns, settled
from rowmill.operators.ranges import dense_index

# Half width of the first bracket in standard deviations of the cut's position.
SIGMAS = 6.0
# Hex digits that place a bracket's ends; 'g' is above every hex digest.
BRACKET_DIGITS = 12


def side_sizes(rows: int, test_size: float | int) -> tuple[int, int]:
    """(train, test) row counts; a float is a share, rounded up for the test side."""
    if isinstance(test_size, bool) or test_size <= 0:
        raise ValueError(f"test_size must be positive, got {test_size}")
    if isinstance(test_size, int):
        test = test_size
    elif test_size < 1:
        test = math.ceil(test_size * rows)
    else:
        raise ValueError(f"a fractional test_size must be below 1, got {test_size}")
    if test >= rows:
        raise ValueError(f"test_size={test_size} leaves no training rows out of {rows}")
    return rows - test, test


def class_quotas(counts: DataFrame, test_size: float | int) -> DataFrame:
    """(value, rows, train, test) from a settled table (value, rows) of class counts.

    Training rows are the proportional share rounded down, and one more for the largest
    remainders (ties by class value) until the total is met.
    """
    found = counts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("classes"),
        F.count_if(F.col("value").isNull()).alias("missing"),
        F.count_if(F.col("rows") < 2).alias("lonely"),
        F.min_by(F.col("value").cast("string"), "rows").alias("least"),
    ).first()
    if found["missing"]:
        raise ValueError("the class column has missing values")
    if found["lonely"]:
        raise ValueError(
            f"{found['lonely']} classes with fewer than 2 rows cannot be split, "
            f"among them {found['least']}"
        )
    if not found["total"]:
        raise ValueError("the table has no rows to split")
    n_train, n_test = side_sizes(found["total"], test_size)
    if min(n_train, n_test) < found["classes"]:
        raise ValueError(
            f"{n_train} training and {n_test} test rows cannot hold {found['classes']} classes each"
        )
    # Whole-number arithmetic, exact for any row count.
    product = f"CAST(rows AS DECIMAL(18, 0)) * CAST({n_train} AS DECIMAL(18, 0))"
    total = f"CAST({found['total']} AS DECIMAL(18, 0))"
    shares = counts.select(
        "value", "rows",
        F.expr(f"CAST({product} div {total} AS BIGINT)").alias("_share"),
        F.expr(f"{product} % {total}").alias("_rest"),
    )
    missing = n_train - shares.agg(F.sum("_share")).first()[0]
    placed = dense_index(shares, [F.desc("_rest"), F.asc("value")], "_place")
    train = F.col("_share") + (F.col("_place") < missing).cast("long")
    return placed.select("value", "rows", train.alias("train"), (F.col("rows") - train).alias("test"))


def class_counts(df: DataFrame, target: str, key: str | None = None) -> DataFrame:
    """Settled (value, rows); a missing key raises, since it would fall on no side for sure."""
    absent = F.count_if(F.col(quoted(key)).isNull()) if key else F.lit(0)
    counts = settled(
        df.groupBy(F.col(quoted(target)).alias("value")).agg(
            F.count(F.lit(1)).alias("rows"), absent.cast("long").alias("absent")
        )
    )
    if key and (without := counts.agg(F.sum("absent")).first()[0]):
        raise ValueError(f"{without} rows have no {key}")
    return counts.select("value", "rows")


def split_quota(df: DataFrame, target: str, test_size: float | int = 0.2) -> DataFrame:
    """(class, n, n_train, n_test): one row per class."""
    quotas = class_quotas(class_counts(df, target), test_size)
    names = [("value", target), ("rows", "n"), ("train", "n_train"), ("test", "n_test")]
    return quotas.select(*[F.col(c).alias(name) for c, name in names])


def _with_bracket(quotas: DataFrame, sigmas: float) -> DataFrame:
    """Digests [low, high) expected to hold the cut of each class."""
    rows, share = F.col("rows"), F.col("train") / F.col("rows")
    margin = F.lit(sigmas) * F.sqrt(rows * share * (1 - share)) + 1
    steps = 16**BRACKET_DIGITS

    def digits(place: Column) -> Column:
        return F.lpad(F.lower(F.hex(place.cast("long"))), BRACKET_DIGITS, "0")

    low = F.greatest(F.floor((F.col("train") - margin) / rows * steps), F.lit(0))
    high = F.ceil((F.col("train") + margin) / rows * steps)
    return quotas.select(
        F.col("value").alias("_class"),
        F.col("train").alias("_wanted"),
        digits(low).alias("_low"),
        F.when(high < steps, digits(high)).otherwise(F.lit("g")).alias("_high"),
    )


def split_cuts(
    df: DataFrame,
    key: str,
    target: str,
    test_size: float | int = 0.2,
    seed: int = 42,
    sigmas: float = SIGMAS,
) -> DataFrame:
    """(class, cut): the highest training digest of each class, '' if it trains nothing.

    Reads class and key of the table twice: for the class counts and for the cuts. Rows
    that share a key share a digest; if such rows stand at a cut and only some of them
    belong below it, no cut meets the quota, and ValueError is raised.
    """
    require_columns(df, [key, target])
    quotas = settled(class_quotas(class_counts(df, target, key), test_size))
    hashed = df.select(F.col(quoted(target)).alias("_class"), key_hash(key, seed).alias("_hash"))

    cuts = quotas.where("train = 0").select(F.col("value").alias("_class"), F.lit("").alias("cut"))
    pending = quotas.where("train > 0")
    left = pending.count()
    while left:
        inside = F.when(F.col("_hash") >= F.col("_low"), F.col("_hash"))
        counted = (
            hashed.join(_with_bracket(pending, sigmas), "_class")
            .where(F.col("_hash") < F.col("_high"))
            .groupBy("_class", "_wanted", inside.alias("_digest"))
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        # The rows below the bracket are one row here, and come first.
        upward = Window.partitionBy("_class").orderBy(F.col("_digest").asc_nulls_first())
        upto = F.sum("_rows").over(upward.rowsBetween(Window.unboundedPreceding, 0))
        found = settled(
            counted.withColumn("_upto", upto)
            .where(F.col("_digest").isNotNull() & (F.col("_upto") >= F.col("_wanted")))
            .where(F.col("_upto") - F.col("_rows") < F.col("_wanted"))
            .select("_class", F.col("_digest").alias("cut"), (F.col("_upto") - F.col("_wanted")).alias("_over"))
        )
        done = found.agg(F.count(F.lit(1)), F.count_if(F.col("_over") > 0)).first()
        if done[1]:
            raise ValueError(
                f"{key} is not unique: rows with the same key stand at the cut of {done[1]} "
                "classes, so their quotas cannot be met"
            )
        cuts = cuts.unionByName(found.select("_class", "cut"))
        pending = pending.join(
            found.select(F.col("_class").alias("value")), "value", "left_anti"
        )
        left -= done[0]
        sigmas *= 8
    return settled(cuts.select(F.col("_class").alias(target), "cut"))


def assign_split(
    df: DataFrame, cuts: DataFrame, key: str, target: str, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Add 'train' or 'test' to every row. The cuts have one row per class, which Spark
    broadcasts while that is small. A row of a class without a cut fails the query."""
    small = cuts.select(F.col(quoted(target)).alias("_class"), "cut")
    joined = df.join(small, F.col(quoted(target)) == F.col("_class"), "left")
    known = F.when(F.col("cut").isNotNull(), F.col("cut")).otherwise(
        F.raise_error(
            F.concat(
                F.lit(f"no cut for this class of {target}: "),
                F.coalesce(F.col(quoted(target)).cast("string"), F.lit("missing")),
            )
        ).cast("string")
    )
    side = F.when(key_hash(key, seed) <= known, F.lit("train")).otherwise(F.lit("test"))
    return joined.select(*[F.col(quoted(c)) for c in df.columns], side.alias(name))


def stratified_split(
    df: DataFrame,
    key: str,
    target: str,
    test_size: float | int = 0.2,
    seed: int = 42,
    sigmas: float = SIGMAS,
) -> DataFrame:
    """Table with a ``split`` column; class quotas are met exactly."""
    cuts = split_cuts(df, key, target, test_size, seed, sigmas)
    return assign_split(df, cuts, key, target, seed)


def train_test_split(
    df: DataFrame, key: str, target: str, test_size: float | int = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) tables; the target stays in the row."""
    assigned = stratified_split(df, key, target, test_size, seed)
    return (
        assigned.where(F.col("split") == "train").drop("split"),
        assigned.where(F.col("split") == "test").drop("split"),
    )


def split_overlap(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """(n_train, n_test, n_total, n_overlap): counts of both sides, of their
    distinct keys and of keys on both sides. One shuffle of the keys."""
    sides = train.select(F.col(quoted(key)), F.lit(1).alias("_train"), F.lit(0).alias("_test"))
    sides = sides.unionByName(
        test.select(F.col(quoted(key)), F.lit(0).alias("_train"), F.lit(1).alias("_test"))
    )
    per_key = sides.groupBy(F.col(quoted(key))).agg(
        F.sum("_train").alias("_train"), F.sum("_test").alias("_test")
    )
    return per_key.agg(
        F.coalesce(F.sum("_train"), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum("_test"), F.lit(0)).alias("n_test"),
        F.count(F.lit(1)).alias("n_total"),
        F.count_if((F.col("_train") > 0) & (F.col("_test") > 0)).alias("n_overlap"),
    )


def split_balance(assigned: DataFrame, target: str) -> DataFrame:
    """(class, share, train_share, test_share) from one grouped count."""
    in_train = F.count_if(F.col("split") == "train")
    counts = assigned.groupBy(F.col(quoted(target))).agg(
        F.count(F.lit(1)).alias("_all"),
        in_train.alias("_train"),
        F.count_if(F.col("split") == "test").alias("_test"),
    )
    counts = settled(counts)
    names = (("_all", "share"), ("_train", "train_share"), ("_test", "test_share"))
    totals = counts.agg(*[F.sum(c) for c, _ in names]).first()
    return counts.select(
        F.col(quoted(target)),
        *[
            F.try_divide(F.col(c).cast("double"), F.lit(total).cast("double")).alias(n)
            for (c, n), total in zip(names, totals)
        ],
    )
