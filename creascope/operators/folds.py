"""Group-wise fold assignment: all rows of a group share a fold, folds have similar sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Hex digits of a key's digest that part groups of equal size: 4096 windows per size.
DIGITS = 3


def hash_fold(column: str, k: int):
    return F.pmod(F.xxhash64(column), F.lit(k)).cast("int")


def group_folds(df: DataFrame, group: str, k: int = 5) -> DataFrame:
    """(group, fold) for every group, NULL included.

    Groups are ranked by size, largest first, then by three digits of the key's MD5 digest, then by
    key, and dealt to the folds 0 to k-1, k-1 to 0 and so on; folds differ by at most the largest
    group. The rank adds up what comes before a size, before the digits within it, and within
    these, so no task orders all groups; one task adds up the distinct sizes, of which n rows
    have at most sqrt(2 n).
    """
    sizes = df.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_n"))
    digits = F.substring(F.md5(F.col("_group").cast("string").cast("binary")), 1, DIGITS)
    sizes = sizes.withColumn("_digits", F.coalesce(digits, F.lit("")))
    counted = sizes.groupBy("_n", "_digits").agg(F.count("*").alias("_m"))

    def before(total: str, window):
        return F.coalesce(F.sum(total).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    larger = counted.groupBy("_n").agg(F.sum("_m").alias("_m")).select(
        "_n", before("_m", Window.orderBy(F.desc("_n"))).alias("_larger"))
    earlier = counted.select("_n", "_digits", before("_m", Window.partitionBy("_n").orderBy("_digits")).alias("_earlier"))
    within = F.row_number().over(Window.partitionBy("_n", "_digits").orderBy("_group")) - 1
    turn = F.pmod(F.col("_larger") + F.col("_earlier") + F.col("_within"), F.lit(2 * k))
    ranked = sizes.withColumn("_within", within).join(earlier, ["_n", "_digits"]).join(larger, "_n")
    return ranked.select(
        F.col("_group").alias(group), F.when(turn < k, turn).otherwise(2 * k - 1 - turn).cast("int").alias("fold"))


def assign_group_folds(df: DataFrame, group: str, k: int = 5, method: str = "balanced") -> DataFrame:
    """Add ``fold`` in 0..k-1: ``balanced`` deals groups by size, ``hash`` needs no state per group."""
    if method == "hash":
        return df.withColumn("fold", hash_fold(group, k))
    placed = group_folds(df, group, k).withColumnRenamed(group, "_group")
    return df.join(placed, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
