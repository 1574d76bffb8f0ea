"""Quality rules with robust multivariate outliers, in DataFrame expressions only.

Base statistics of each whole text (see :func:`text_statistics`) give a vector
of four transformed ratios. For every language and source the minimum covariance
determinant (MCD) is estimated: from two robust starts, C-steps keep the share
``SUPPORT`` of the rows that is closest by Mahalanobis distance and re-estimate
location and floored scatter; of the two results the one with the smaller determinant
stays. C-steps go on until no group's determinant falls any more. A row is
rejected if its squared distance, scaled by the group's median to be consistent
at the normal distribution, exceeds ``CUTOFF``, the 0.9999 quantile of the
chi-square distribution with ``DIM`` degrees of freedom.

Repeats are counted against ``LINES`` lines and ``REPEATS`` words more than a
text has, so one repeated line in a short text is no extreme share. The scatter
of a dimension has a floor, the spread that a statistic may have within texts of
one kind where most show none of it: a departure of under 4.85 floors in one
statistic alone rejects nothing, a larger one does, in every dimension.

The texts are read once. The statistics (a few numbers a row) are written to the
shared folder; every C-step is a partial aggregation over them, with one result
row per group, so a group that holds a third of all rows costs its share of
sums and no more. The distance that bounds the support comes from a mergeable
quantile sketch (relative rank error 1e-4).

Rows of a group with fewer than ``LEAST_ROWS`` rows that pass the base rules are
held against an estimate over their whole language (all its sources), and if that
is as small, over the whole table; only a smaller table rejects nothing.
Scatter gets a floor per dimension, so statistics that are constant in a group
do not make it singular.

Defined cases: null text counts as empty (all counts 0, fails the base rules);
null language or source is a group value like any other; a null doc_id stays
null; repeated rows count each; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, cut, read_table

SPACES = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50
DIM = 4
FLOORS = (0.05, 0.075, 0.1, 0.1)
LINES, REPEATS = 10, 200
SUPPORT = 0.75
C_STEPS = 12
STILL = 1e-6
LEAST_ROWS = 60
MOST_BROADCAST = 100_000  # groups; their parameters are some 160 bytes each
CHI2_MEDIAN = 3.3567  # of 4 degrees of freedom
CUTOFF = 23.51
STARTS = (0, 1)
X = [f"x{i}" for i in range(DIM)]
MU = [f"m{i}" for i in range(DIM)]
LOW = [(i, j) for i in range(DIM) for j in range(i + 1)]


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more; ``hashes`` has one number per window."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    follower = F.slice(placed, F.lit(2), F.greatest(F.size(hashes), F.lit(1)))
    pairs = F.zip_with(placed, follower, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    steps = F.zip_with(
        places, F.slice(places, F.lit(2), F.greatest(F.size(hashes), F.lit(1))),
        lambda p, q: F.least(F.lit(3), F.coalesce(q - p, F.lit(3))),
    )
    total = F.aggregate(steps, F.lit(0), lambda acc, n: acc + n)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(total).cast("long")


def text_statistics(docs: DataFrame, text_col: str = "text", *keep: str) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words of whole texts.

    Windows of three words are compared by a 64-bit hash.
    """
    text = clean_text(F.col(text_col))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select(
        *keep, F.array_remove(F.split(text, SPACES + "+", -1), "").alias("_words"), lines.alias("_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        *keep, "n_symbols", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    n = F.greatest(F.size("_h") - 2, F.lit(0))
    triples = F.arrays_zip(F.slice("_h", F.lit(1), n).alias("a"), F.slice("_h", F.lit(2), n).alias("b"), F.slice("_h", F.lit(3), n).alias("c"))
    windows = counted.withColumn("_h", F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"])))
    return windows.withColumn("n_repeat_words", _repeated_words(F.col("_h"))).drop("_h")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics; 0 where a text has no words."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p(F.col("word_chars") / words),
        F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + LINES)),
        F.sqrt(F.col("n_repeat_words") / (F.col("n_words") + REPEATS)),
    ]


def _sent(groups: DataFrame, few: bool) -> DataFrame:
    """A table with a row or two for each group, broadcast where groups are few, so that no rows are dealt by group."""
    return F.broadcast(groups) if few else groups


def _grouped(stats: DataFrame) -> tuple[DataFrame, bool]:
    """Add g_lang, g_source: the pool of which the estimates hold for the row; and pools: those it is estimated in.

    Also whether there are at most MOST_BROADCAST groups.
    """
    counts = stats.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("_n"))
    langs = counts.groupBy(F.col("lang").alias("_l")).agg(F.sum("_n").alias("_m"), F.min("_n").alias("_least"))
    rest = langs.agg(F.max(F.col("_m") < LEAST_ROWS).alias("_rest"))
    keys = counts.join(langs, F.col("lang").eqNullSafe(F.col("_l"))).crossJoin(rest).select(
        F.col("lang").alias("_kl"), F.col("source").alias("_ks"), "_n", "_m", "_least", "_rest"
    )
    keys = cut(keys, "group-sizes")
    few = keys.count() <= MOST_BROADCAST
    joined = stats.join(_sent(keys, few), F.col("lang").eqNullSafe(F.col("_kl")) & F.col("source").eqNullSafe(F.col("_ks")))
    own, by_lang = F.col("_n") >= LEAST_ROWS, F.col("_m") >= LEAST_ROWS
    name = lambda c: F.concat(F.lit("="), F.coalesce(F.col(c), F.lit("\x00")))
    pool = lambda lang, source: F.struct(lang.alias("g_lang"), source.alias("g_source"))
    every = F.lit("*")
    # A language or the table is estimated only if a smaller group needs it.
    pools = F.array(
        F.when(own, pool(name("lang"), name("source"))),
        F.when(by_lang & (F.col("_least") < LEAST_ROWS), pool(name("lang"), every)),
        F.when(F.col("_rest"), pool(every, every)),
    )
    out = joined.select(
        *stats.columns,
        F.when(by_lang, name("lang")).otherwise("*").alias("g_lang"),
        F.when(own, name("source")).otherwise("*").alias("g_source"),
        F.filter(pools, lambda p: p.isNotNull()).alias("pools"),
    )
    return out, few


def _factor(params: DataFrame) -> DataFrame:
    """Columns s{i}{j} (scatter) become l{i}{j} (its Cholesky factor) and log_det."""
    for i in range(DIM):
        for j in range(i + 1):
            inner = reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
            rest = F.col(f"s{i}{j}") - inner
            entry = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
            params = params.withColumn(f"l{i}{j}", entry)
    det = reduce(lambda a, b: a + b, [2 * F.log(F.col(f"l{i}{i}")) for i in range(DIM)])
    return params.withColumn("log_det", det).drop(*(f"s{i}{j}" for i, j in LOW))


def _with_distance(rows: DataFrame) -> DataFrame:
    """Add d2 by forward substitution."""
    for i in range(DIM):
        inner = reduce(lambda a, b: a + b, [F.col(f"l{i}{j}") * F.col(f"y{j}") for j in range(i)], F.lit(0.0))
        rows = rows.withColumn(f"y{i}", (F.col(X[i]) - F.col(MU[i]) - inner) / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", reduce(lambda a, b: a + b, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIM)]))


def _scatter(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Location and floored scatter of rows by keys, as sums that combine before the shuffle."""
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), *(F.sum(x).alias(f"t_{x}") for x in X),
        *(F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q{i}{j}") for i, j in LOW),
    )
    mean = lambda i: F.col(f"t_{X[i]}") / F.col("n")
    own = [
        (F.col(f"q{i}{j}") / F.col("n") - mean(i) * mean(j) + (F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0))).alias(f"s{i}{j}")
        for i, j in LOW
    ]
    return _factor(sums.select(*keys, *(mean(i).alias(MU[i]) for i in range(DIM)), *own))


def _starts(rows: DataFrame, few: bool) -> DataFrame:
    """Two starts: medians with diagonal scatter, and moments of the rows near the medians."""
    keys = ["g_lang", "g_source"]
    mid = rows.groupBy(*keys).agg(*(F.percentile_approx(X[i], 0.5, 10000).alias(f"c{i}") for i in range(DIM)))
    mid = cut(mid, "mcd-medians")
    near = rows.join(_sent(mid, few), keys)
    spread = near.groupBy(*keys).agg(
        *(F.percentile_approx(F.abs(F.col(X[i]) - F.col(f"c{i}")), 0.5, 10000).alias(f"a{i}") for i in range(DIM))
    )
    both = cut(mid.join(spread, keys), "mcd-spreads")
    variance = lambda i: F.pow(1.4826 * F.col(f"a{i}"), 2) + FLOORS[i] ** 2
    diagonal = _factor(both.select(
        *keys, *(F.col(f"c{i}").alias(MU[i]) for i in range(DIM)),
        *((variance(i) if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i, j in LOW),
    ))
    far = F.greatest(*(F.abs(F.col(X[i]) - F.col(f"c{i}")) / F.sqrt(variance(i)) for i in range(DIM)))
    central = _scatter(rows.join(_sent(both, few), keys).where(far <= 1.5), keys)
    return cut(diagonal.withColumn("start", F.lit(0)).unionByName(central.withColumn("start", F.lit(1))), "mcd-start")


def estimate_mcd(rows: DataFrame, few: bool, c_steps: int = C_STEPS) -> DataFrame:
    """Per group (g_lang, g_source): location, Cholesky factor, and the consistency scale.

    At most ``c_steps`` C-steps are made; ``few`` tells that the groups' parameters may be broadcast.
    """
    keys = ["g_lang", "g_source", "start"]
    params = _starts(rows, few)
    for _ in range(c_steps):
        measured = _with_distance(rows.join(_sent(params, few), ["g_lang", "g_source"]))
        bound = measured.groupBy(*keys).agg(F.percentile_approx("d2", SUPPORT, 10000).alias("bound"))
        # The bound joins the few parameters, not the rows, so that no rows are dealt by group after an aggregation.
        held = cut(params.join(bound, keys), "mcd-bound")
        inside = _with_distance(rows.join(_sent(held, few), ["g_lang", "g_source"]))
        before = params.select(*keys, F.col("log_det").alias("_before"))
        params = cut(_scatter(inside.where("d2 <= bound"), keys), "mcd-step")
        if params.join(before, keys).where(F.col("_before") - F.col("log_det") > STILL).isEmpty():
            break
    best = params.groupBy("g_lang", "g_source").agg(F.min_by(F.struct(*params.columns), F.struct("log_det", "start")).alias("p")).select("p.*")
    best = cut(best.drop("start"), "mcd-best")
    scale = _with_distance(rows.join(_sent(best, few), ["g_lang", "g_source"])).groupBy("g_lang", "g_source").agg(
        F.percentile_approx("d2", 0.5, 10000).alias("median"), F.count("*").alias("n_rows")
    )
    scaled = best.join(scale, ["g_lang", "g_source"])
    return cut(scaled.withColumn("scale", F.greatest(F.col("median") / CHI2_MEDIAN, F.lit(1.0))).where(F.col("n_rows") >= LEAST_ROWS), "mcd")


def judge(docs: DataFrame, cutoff: float = CUTOFF, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per document the base statistics, base_failed, distance (null without estimate) and kept."""
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"),
    )
    stats = text_statistics(source, "text", "doc_id", "lang", "source")
    stats = cut(stats.withColumn("base_failed", base_failed()), "statistics")
    grouped, few = _grouped(stats)
    grouped = cut(grouped.select("*", *(v.alias(x) for v, x in zip(vector(), X, strict=True))), "vectors")
    usable = grouped.where(~F.col("base_failed")).select(F.inline("pools"), *X)
    params = estimate_mcd(usable, few)
    measured = _with_distance(grouped.drop("pools").join(_sent(params, few), ["g_lang", "g_source"], "left"))
    distance = F.col("d2") / F.col("scale")
    kept = ~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return measured.select(*names, distance.alias("distance"), kept.alias("kept"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"))
