"""Joins whose large side may hold a key very often."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(left: DataFrame, right: DataFrame, key: str, counts: DataFrame | None = None, how: str = "left") -> DataFrame:
    """Joins on ``key``, with a key that fills more than one shuffle partition dealt over several.

    ``right`` holds few rows per key.  A key with more ``left`` rows than an even share of one
    partition gets as many salts as it fills partitions, and its ``right`` rows a copy for each.
    So few keys can be that frequent: fewer than there are partitions, and the copies are at
    most twice as many.  Only their hashes are sent around.  ``counts`` (``key, n``) saves
    counting the rows again.  A null key matches nothing.  Rows equal in all columns but maps
    get the same salt, so rows of a frequent key should carry what tells them apart.
    """
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if counts is None:
        counts = left.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = max(1, total // parts)
    hot = counts.filter((F.col("n") > share) & F.col(key).isNotNull()).select(
        F.xxhash64(key).alias("_hash"), F.ceil(F.col("n") / share).cast("int").alias("_salts")
    )
    # Two frequent keys of one hash share the larger number of salts.
    hot = F.broadcast(hot.groupBy("_hash").agg(F.max("_salts").alias("_salts")))
    salted = left.withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left")
    # Salts come from the rows themselves, so that a task run again after a loss deals them alike.
    content = [F.col(f"`{name}`") for name, kind in left.dtypes if "map<" not in kind]  # maps can't be hashed
    dealt = F.pmod(F.xxhash64(*content), F.coalesce("_salts", F.lit(1)))
    salted = salted.withColumn("_salt", dealt.cast("int"))
    copies = right.withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left")
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
    return salted.drop("_hash", "_salts").join(copies.drop("_hash", "_salts"), [key, "_salt"], how).drop("_salt")
