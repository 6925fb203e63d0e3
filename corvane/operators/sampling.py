"""Unions, shuffles, samples and splits that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored


def union_common(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, in the columns they share; ValueError if they share none."""
    common = [c for c in a.columns if c in b.columns]
    if not common:
        raise ValueError("no common columns")
    return a.select(common).unionByName(b.select(common))


def hash_order(key: str, seed: int = 42) -> Column:
    """A seeded order that every engine can repeat: the md5 of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(hash_order(key, seed), key)


#: Hexadecimal digits of the hash that each histogram looks at: 65,536 buckets; more entries refine the bucket that is reached.
DIGITS = (4,)


def first_in_hash_order(df: DataFrame, label: str, key: str, quotas: DataFrame, seed: int = 42) -> DataFrame:
    """df with __in: whether a row is among the first __quota of its label in hash order; quotas (__label, __quota) has a row a label and is broadcast.

    No row is sorted or moved: a histogram of hashes for each label tells the bucket in which the quota is reached, and the
    few rows of that bucket (a 65,536th of the label's) give the last hash and key that are in.
    Of rows that share the last key as many as are wanted are in.
    """
    rows = df.withColumn("__hash", hash_order(key, seed))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    state, known = quotas.where("__quota > 0").select("__label", F.col("__quota").cast("long").alias("__left"), F.lit("").alias("__prefix")), 0
    for digits in DIGITS:
        facts = F.broadcast(state)  # one row a label
        near = rows.select(label, "__hash").join(facts, same(label, "__label") & F.startswith("__hash", "__prefix"))
        counts = near.groupBy("__label", "__left", F.substring("__hash", 1, known + digits).alias("__bucket")).agg(F.count("*").alias("__n"))
        upto = F.sum("__n").over(Window.partitionBy("__label").orderBy("__bucket"))
        reached = counts.withColumn("__upto", upto).where((F.col("__upto") >= F.col("__left")) & (F.col("__upto") - F.col("__n") < F.col("__left")))
        state = stored(reached.select("__label", (F.col("__left") - F.col("__upto") + F.col("__n")).alias("__left"), F.col("__bucket").alias("__prefix")))
        known += digits
    last = rows.select(label, "__hash", F.col(key).alias("__key")).join(F.broadcast(state), same(label, "__label") & F.startswith("__hash", "__prefix"))
    last = last.groupBy("__label", "__left", "__hash", "__key").agg(F.count("*").alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy("__label").orderBy("__hash", "__key"))
    ends = last.withColumn("__upto", upto).where((F.col("__upto") >= F.col("__left")) & (F.col("__upto") - F.col("__n") < F.col("__left")))
    ends = stored(ends.select(F.col("__label").alias("__of"), F.col("__hash").alias("__last"), F.col("__key").alias("__last_key"), (F.col("__left") - F.col("__upto") + F.col("__n")).alias("__some"), (F.col("__n") > 1).alias("__tied")))
    judged = rows.join(F.broadcast(ends), same(label, "__of"), "left")
    at_end = F.coalesce((F.col("__hash") == F.col("__last")) & F.col(key).eqNullSafe(F.col("__last_key")), F.lit(False))
    before = F.coalesce(F.col("__hash") < F.col("__last"), F.lit(False))
    plain = judged.where(~(at_end & F.col("__tied"))).withColumn("__in", before | at_end)
    tied = judged.where(at_end & F.col("__tied")).withColumn("__in", F.row_number().over(Window.partitionBy("__of", "__hash", key).orderBy("__hash")) <= F.col("__some"))
    return plain.unionByName(tied).drop("__hash", "__of", "__last", "__last_key", "__some", "__tied")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows, the first in hash order and in it (all, if there are fewer). They are found without a sort of the table, and none pass through the driver."""
    one = df.withColumn("__all", F.lit(0))
    quotas = one.groupBy("__all").agg(F.least(F.count("*"), F.lit(n)).alias("__quota")).withColumnRenamed("__all", "__label")
    return first_in_hash_order(one, "__all", key, quotas, seed).where("__in").drop("__all", "__in").orderBy(hash_order(key, seed), key)


def stratified_split(df: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """df with part: "sample" for exactly n rows, dealt to labels by largest remainder, and "rest". n must leave a rest.

    Quotas come from one small aggregate per label; rows then go in hash order within their label.
    """
    counts = stored(df.groupBy(label).agg(F.count("*").alias("__n")))
    total = counts.agg(F.sum("__n")).first()[0] or 0
    if not 0 < n < total:
        raise ValueError(f"n must be between 0 and {total}, not {n}")
    exact = F.col("__n") * n
    quotas = counts.withColumns({"__q": F.floor(exact / total), "__r": exact % total})
    short = quotas.agg((F.lit(n) - F.sum("__q")).alias("__short"))
    # One row a label: labels of a split are few, as quotas of at least a row need them to be.
    ranked = quotas.join(F.broadcast(short), F.lit(True)).withColumn("__i", F.row_number().over(Window.orderBy(F.desc("__r"), F.col(label).cast("string"))))
    quotas = ranked.select(F.col(label).alias("__label"), (F.col("__q") + F.when(F.col("__i") <= F.col("__short"), 1).otherwise(0)).alias("__quota"))
    return first_in_hash_order(df, label, key, quotas, seed).withColumn("part", F.when(F.col("__in"), "sample").otherwise("rest")).drop("__in")
