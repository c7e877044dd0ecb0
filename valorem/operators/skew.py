"""Joins on keys of which a few may hold a large share of the rows.

``hot_keys`` finds those keys with a frequent-items sketch (``approx_top_k``):
each task sketches its rows and the sketches are merged, so the pass shuffles
one sketch per task whatever the data. A sketch of ``tracked`` counters misses
no key with more than about 3.5 / tracked of the rows. ``spread_join`` then
deals a hot key's rows over as many salts as its share asks for, and copies
the other side's rows of that key alone; all other rows have salt 0 and are
neither copied nor dealt. The sketch decides where rows meet and never which:
a key that it misses or counts too high is joined all the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem.session import materialize

#: Counters of a sketch; rows of the result are at most MOST, so it can be broadcast.
TRACKED = 1 << 14
MOST = 4096


def hot_keys(df: DataFrame, key: str, partitions: int, share: float = 0.25, tracked: int = TRACKED, most: int = MOST) -> DataFrame:
    """hot_key, salts: keys with over ``share`` of a partition's even part of the rows, and the parts they are dealt into.

    Nulls don't count. At most ``most`` rows, which holds all such keys
    while partitions / share is below it. The result is written once, so
    both sides of a join see the same salts.
    """
    top = df.agg(F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("rows"))
    found = top.select(F.inline("top"), "rows").select(F.col("item").alias("hot_key"), F.ceil(F.col("count") * partitions / (F.col("rows") * share)).cast("int").alias("salts"))
    return materialize(found.filter("hot_key is not null and salts > 1").coalesce(1))


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, spread_by: str, how: str = "left") -> DataFrame:
    """``left.join(right, key, how)`` (left or inner) with ``left``'s hot keys dealt by a hash of its column ``spread_by``.

    Rows of ``left`` without a key meet nothing and are dealt by that hash too.
    """
    if how not in ("left", "inner"):
        raise ValueError("rows of the right side are copied: only left and inner joins")
    taken = {c.lower() for c in left.columns + right.columns}
    salt = "_salt"
    while salt in taken:
        salt += "_"
    k = F.col(f"`{key}`")
    hot = F.broadcast(hot)
    dealt = F.xxhash64(F.col(f"`{spread_by}`"))
    many = (left.join(hot, k == F.col("hot_key"), "left")
            .withColumn(salt, F.when(k.isNull(), dealt).when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(dealt, F.col("salts"))).cast("long"))
            .drop("hot_key", "salts"))
    few = (right.join(hot, k == F.col("hot_key"), "left")
           .withColumn(salt, F.explode(F.expr("if(salts is null, array(0L), sequence(0L, salts - 1L))")))
           .drop("hot_key", "salts"))
    return many.join(few, [key, salt], how).drop(salt)
