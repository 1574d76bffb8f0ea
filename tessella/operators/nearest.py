"""The nearest string of another table by edit ratio, exact, without comparing all pairs.

The ratio of two strings is 1 - distance / longer length. Two strings at distance d
share all but 2 d of either one's two-character grams, so of any 2 d + 1 grams of the
one the other holds one at least. A first probe with the rarest grams of a string
finds some near string; its ratio bounds the distance that a better one can have, and
a second probe with as many of the rarest grams as that bound asks for finds every
better one. Strings that the other table holds themselves need neither, and strings with too few grams meet the strings of the lengths that can still
win. All are equi-joins, on the string, a gram or a length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 2
FIRST = 3


def grams(text: Column) -> Column:
    """The distinct two-character grams."""
    places = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def ratio(a: Column, b: Column, distance: Column) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - distance / longer)


def _best(pairs: DataFrame) -> DataFrame:
    """a, best: the highest ratio of each string, ties to the least string. Pairs: a, b."""
    scored = pairs.withColumn("distance", F.levenshtein("a", "b"))
    rank = F.struct((-ratio(F.col("a"), F.col("b"), F.col("distance"))).alias("r"), "b", "distance")
    return scored.groupBy("a").agg(F.min(rank).alias("best"))


def nearest(left: DataFrame, key: str, right: DataFrame, other: str) -> DataFrame:
    """One row per distinct string of ``left``: key, nearest, distance, ratio; null where ``right`` has no string."""
    a = left.select(F.col(key).cast("string").alias("a")).where("a is not null").distinct()
    b = right.select(F.col(other).cast("string").alias("b")).where("b is not null").distinct().checkpoint()
    # Only an equal string has ratio 1, so those that have one are done.
    same = a.join(b, F.col("a") == F.col("b"), "left_semi").select("a", F.struct(F.lit(-1.0).alias("r"), F.col("a").alias("b"), F.lit(0).alias("distance")).alias("best"))
    a = a.join(b, F.col("a") == F.col("b"), "left_anti").checkpoint()
    index = b.select("b", F.explode(grams(F.col("b"))).alias("g"))
    df = index.groupBy("g").agg(F.count("*").alias("n"))
    own = a.select("a", F.explode_outer(grams(F.col("a"))).alias("g")).join(df, "g", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")))  # a string's own grams
    asking = own.groupBy("a").agg(F.filter(order, lambda x: x["g"].isNotNull()).alias("gs")).checkpoint()

    def probe(rows: DataFrame, some: Column) -> DataFrame:
        return rows.select("a", F.explode(some).alias("x")).where("x.n > 0").select("a", F.col("x.g").alias("g")).join(index, "g").select("a", "b").distinct()

    held = F.filter("gs", lambda x: x["n"] > 0)
    first = _best(probe(asking, F.slice(held, 1, FIRST)))
    found = asking.join(first, "a", "left").withColumn("r", F.coalesce(-F.col("best.r"), F.lit(0.0))).checkpoint()
    # A string of ratio r or more has a length between r and 1 / r of this one's; its distance is at most 1 - r of the longer.
    most = F.when(F.col("r") > 0, F.floor((1 - F.col("r")) * F.length("a") / F.col("r") + 1e-9)).otherwise(F.lit(1 << 20))
    found = found.withColumn("need", (GRAM * most + 1).cast("int"))
    enough = F.size("gs") >= F.col("need")
    second = _best(probe(found.where(enough), F.slice("gs", F.lit(1), F.col("need"))))
    low, high = F.ceil(F.length("a") * F.col("r") - 1e-9), F.floor(F.length("a") / F.col("r") + 1e-9)
    lengths = b.select("b", F.length("b").alias("len"))
    able = lengths.groupBy("len").agg(F.count("*").alias("_n")).select("len")
    rest = found.where(~enough).select("a", F.when(F.col("r") > 0, low).otherwise(0).alias("low"), F.when(F.col("r") > 0, high).otherwise(F.lit((1 << 31) - 1)).alias("high"))
    # The lengths that occur are few numbers; each string takes those it can still win with.
    reach = rest.join(F.broadcast(able), F.col("len").between(F.col("low"), F.col("high"))).select("a", "len")
    third = _best(reach.join(lengths, "len").select("a", "b"))
    every = found.select("a", "best").union(second).union(third).union(same).groupBy("a").agg(F.min("best").alias("best"))
    return every.select(F.col("a").alias(key), F.col("best.b").alias("nearest"), F.col("best.distance").alias("distance"), F.round(-F.col("best.r"), 6).alias("ratio"))
