"""Relational queries over the test tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lint
from ..operators import metrics, nearest
from ..operators import relational as rel
from .tables import table


def _branded(spark: SparkSession, sf_dir: str, n: int, where: str = "true") -> DataFrame:
    """doc (order) and label (brand) of lines, joined in n partitions."""
    lines = table(spark, sf_dir, "lineitem").where(where).select("l_orderkey", "l_partkey").repartition(n, "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand").repartition(n, "p_partkey")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(F.col("l_orderkey").alias("doc"), F.col("p_brand").alias("label"))


def _partitions(spark: SparkSession, sf_dir: str) -> int:
    return rel.partitions_for(table(spark, sf_dir, "lineitem"))


def _order_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc (order) and label (brand), distinct."""
    n = _partitions(spark, sf_dir)
    return _branded(spark, sf_dir, n).repartition(n, "doc").distinct()


BRANDS = "b as (select distinct l_orderkey as doc, p_brand as label from lineitem join part on l_partkey = p_partkey)"


def _predicted(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Labels predicted from the lines with a high quantity, a wrong label added to some orders."""
    right = _branded(spark, sf_dir, n, "l_quantity > 20")
    wrong = table(spark, sf_dir, "orders").where("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("doc"), F.lit("Brand#11").alias("label"))
    return right.union(wrong)


PREDICTED = """p as (select distinct l_orderkey as doc, p_brand as label from lineitem join part on l_partkey = p_partkey where l_quantity > 20
  union select o_orderkey, 'Brand#11' from orders where o_orderkey % 7 = 0)"""
CELLS = f"""{BRANDS}, {PREDICTED}, c as (select coalesce(b.doc, p.doc) as doc, coalesce(b.label, p.label) as label,
  (b.doc is not null)::int as t, (p.doc is not null)::int as p from b full join p on b.doc = p.doc and b.label = p.label)"""
PER_LABEL = f"""{CELLS}, n as (select label, sum(t * p) as tp, sum(t) as support, sum(p) as n_predicted from c group by label having sum(t) > 0),
  s as (select label, support, n_predicted, case when n_predicted > 0 then tp / n_predicted else 0 end as pr, tp / support as rc, tp from n)"""


def label_frequency(spark, sf_dir):
    return _order_brands(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))


def catalog_summary(spark, sf_dir):
    from ..operators.mapreduce import summarise

    return summarise(table(spark, sf_dir, "part").where("p_brand is not null"), "p_partkey", ["p_name", "p_size"])


def row_routing_split(spark, sf_dir):
    from ..operators.mapreduce import route

    docs = table(spark, sf_dir, "documents").withColumn("key", F.when(F.col("lang") == "de", "").otherwise(F.col("lang")))
    special, rest = route(docs, "key")
    both = special.withColumn("route", F.lit("special")).unionByName(rest.withColumn("route", F.lit("rest")))
    return both.groupBy("route", "source").agg(F.count("*").alias("n"))


def prune_empty(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, "null").otherwise(F.col("p_type")).alias("kind"))
    return parts.select("p_partkey", lint.pruned(F.col("kind"), parts.schema["kind"].dataType).alias("kind"))


def full_outer_merge_ranked_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"), "c_custkey", "c_name")
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("k"), "s_suppkey", "s_name")
    merged = rel.full_merge(c, s, "k", ("a", "b"), ([F.col("c_custkey")], [F.col("s_suppkey")]))
    ranked = merged.withColumn("rank", rel.combined_rank(F.when(F.col("a").isNotNull(), F.col("k") % 4), F.when(F.col("b").isNotNull(), F.col("k") % 3)))
    return rel.numbered_ids(ranked, [F.col("rank"), F.col("k")]).select("id", "k", "rank", F.col("a.c_name").alias("c_name"), F.col("b.s_name").alias("s_name"))


def merge_statistics(spark, sf_dir):
    """Customers with orders against seven times the suppliers' numbers."""
    c = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey")
    q = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 7).alias("k"), "s_name")
    return rel.merge_statistics(rel.full_merge(c, q, "k", ("a", "b"), ([F.col("o_orderkey")], [F.col("s_name")])), "a", "b")


def level_rank(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    level = F.regexp_extract("o_orderpriority", "^([0-9])", 1)
    rank = rel.level_rank(level, {"1": 0, "2": 1, "3": 2, "4": 3, "5": 5})
    return o.groupBy(rank.alias("rank")).agg(F.count("*").alias("n"))


def priority_lookup_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    special = p.where("p_size < 10").groupBy(F.concat_ws("|", "p_brand", "p_type").alias("name")).agg(F.min("p_name").alias("value"))
    general = p.where("p_size > 25").groupBy(F.col("p_brand").alias("name")).agg(F.max("p_name").alias("value"))
    return rel.priority_lookup(p.select("p_partkey", "p_brand", "p_type"), special.unionByName(general), "p_brand", F.col("p_type"), "name", "value").select("p_partkey", "value")


def dangling_references(spark, sf_dir):
    good = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return rel.dangling(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", good, "c_custkey")


def unused_overrides(spark, sf_dir):
    return rel.dangling(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'"), "o_custkey")


def known_reference_filter(spark, sf_dir):
    good = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return rel.known(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", good, "c_custkey")


def reference_state(spark, sf_dir):
    cat = table(spark, sf_dir, "nation").where("n_nationkey < 15")
    renames = table(spark, sf_dir, "nation").where("n_nationkey between 15 and 19").select(F.col("n_nationkey").alias("old"))
    rows = rel.reference_state(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", cat, "n_nationkey", renames)
    return rows.groupBy("state").agg(F.count("*").alias("n"))


def _renames(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    split = n.where("n_nationkey % 6 = 0").select(F.col("n_name").alias("old"), F.explode(F.array(F.concat("n_name", F.lit("-1")), F.concat("n_name", F.lit("-2")))).alias("new"))
    join = n.where("n_nationkey % 6 = 1").select(F.col("n_name").alias("old"), F.concat(F.lit("REGION"), F.col("n_regionkey").cast("string")).alias("new"))
    drop = n.where("n_nationkey % 6 = 2").select(F.col("n_name").alias("old"), F.lit(None).cast("string").alias("new"))
    return split.union(join).union(drop)


RENAMES = """r as (select n_name as old, unnest([n_name || '-1', n_name || '-2']) as new from nation where n_nationkey % 6 = 0
  union all select n_name, 'REGION' || n_regionkey from nation where n_nationkey % 6 = 1 union all select n_name, null from nation where n_nationkey % 6 = 2)"""


def rename_split_join(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    refs = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == n["n_nationkey"]).select(F.col("n_regionkey").alias("owner"), F.col("n_name").alias("ref"))
    return rel.rename_references(refs, "owner", "ref", _renames(spark, sf_dir)).select("owner", F.array_join("ref", ",").alias("refs"))


def rename_checks(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    renames = n.select(F.concat("n_name", F.when(F.col("n_nationkey") % 4 == 0, "?").otherwise("")).alias("old"), F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).otherwise(F.lower("n_name")).alias("new"))
    return rel.rename_checks(renames, n, "n_name")


def rewrite_catalog(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_name", F.format_string("gp%04d", F.col("n_nationkey")).alias("id"))
    extra = spark.createDataFrame([("ATLANTIS", "LOST")], "old string, new string")
    return rel.rewrite_catalog(n, "n_name", "id", _renames(spark, sf_dir).union(extra), "gp9999")


PATTERNS = {"ends-ing": "ing[ .,]", "long": "[a-z]{14}", "number": "[0-9]{3}", "quote": '["(]', "the-of": " the .* of "}


def regex_label_join(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    labels = d.select("doc_id", F.explode(rel.pattern_labels(d, F.col("text"), PATTERNS)).alias("label"))
    return labels.groupBy("label").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


def closest_name(spark, sf_dir):
    """For each word of the benchmark the nearest word of the pages."""
    words = lambda name, column: table(spark, sf_dir, name).select(F.explode(F.regexp_extract_all(F.lower(column), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return nearest.nearest(words("benchmark", "text"), "word", words("pages", "html"), "word")


def rare_label_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), F.col("o_custkey").alias("label"))
    return rel.rare_labels_dropped(o, "doc", "label", 10).groupBy("label").agg(F.count("*").alias("n"))


def cooccurrence_top10(spark, sf_dir):
    pairs = rel.pair_counts(_order_brands(spark, sf_dir), "doc", "label")
    top = pairs.orderBy(F.col("n").desc(), "a", "b").limit(10)
    return top.select("a", "b", "n", F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").alias("samples"))


def duplicate_groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))
    return rel.duplicate_groups(d, "digest", "doc_id")


def first_occurrence(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))
    return rel.later_duplicates(d, "digest", [F.col("doc_id")]).select("doc_id", "place")


def second_highest_labels(spark, sf_dir):
    n = _partitions(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").repartition(n, "o_orderkey")
    brands = _branded(spark, sf_dir, n).repartition(n, "doc")
    each = brands.join(orders, F.col("doc") == F.col("o_orderkey")).select("o_custkey", F.col("label").alias("p_brand"), "o_orderkey").distinct()
    counts = each.repartition(n, "o_custkey").groupBy("o_custkey", "p_brand").agg(F.count("*").alias("n"))
    return rel.second_highest(counts, "o_custkey", "p_brand", "n")


def set_relation_buckets(spark, sf_dir):
    n = _partitions(spark, sf_dir)
    return metrics.set_relations(_branded(spark, sf_dir, n), _predicted(spark, sf_dir, n), "doc", "label", n)


def multilabel_metrics(spark, sf_dir):
    n = _partitions(spark, sf_dir)
    return metrics.summary(_branded(spark, sf_dir, n), _predicted(spark, sf_dir, n), "doc", "label", n)


def per_label_prf(spark, sf_dir):
    n = _partitions(spark, sf_dir)
    return metrics.per_label(_branded(spark, sf_dir, n), _predicted(spark, sf_dir, n), "doc", "label", n)


def merge_candidates(spark, sf_dir):
    """Users by the types of their events; predicted are the types of their later events."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.col("event_type").alias("label"), "ts")
    later = e.withColumn("_first", F.min("ts").over(Window.partitionBy("doc"))).where("ts > _first")
    return metrics.merge_candidates(e, later, "doc", "label", rate=0.5).withColumn("shown", F.concat_ws(",", "shown"))


def set_overlap_jaccard(spark, sf_dir):
    """Brands as labels, the hundred customers that order most of each as its features."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    weights = lines.groupBy(F.col("p_brand").alias("label"), F.col("o_custkey").alias("feature")).agg(F.sum("l_quantity").alias("weight"))
    return metrics.overlap_jaccard(metrics.top_weights(weights, "label", "feature", "weight"), "label", "feature")


def top_weights(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", "p_partkey", (F.col("p_retailprice") - 1200).alias("w"))
    return metrics.top_weights(p, "p_brand", "p_partkey", "w", 5).select("p_brand", "p_partkey", F.round("w", 4).alias("w"), "place")


def upsert_by_key(spark, sf_dir):
    old = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_name")
    new = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", F.upper("c_mktsegment").alias("c_name"))
    return rel.upsert(old, new, "c_custkey")


def _pairs(spark, sf_dir, status=None):
    """Customers and the priorities of their orders, of all orders or of those with a status."""
    o = table(spark, sf_dir, "orders")
    return (o if status is None else o.where(F.col("o_orderstatus") == status)).select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v")).distinct()


def insert_ignore(spark, sf_dir):
    return rel.insert_ignore(_pairs(spark, sf_dir, "F"), _pairs(spark, sf_dir, "O"))


def insert_feedback(spark, sf_dir):
    return rel.insert_feedback(_pairs(spark, sf_dir, "F"), _pairs(spark, sf_dir, "O"))


def pair_stats(spark, sf_dir):
    return rel.pair_stats(_pairs(spark, sf_dir), "k")


def key_stats(spark, sf_dir):
    return rel.key_stats(_pairs(spark, sf_dir), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), "k", "v").select("k", "n", "present", F.array_join("kinds", ",").alias("kinds"))


def union_labels(spark, sf_dir):
    return rel.union_labels(_pairs(spark, sf_dir, "F"), _pairs(spark, sf_dir, "O"), key="k", label="v").select("k", F.array_join("labels", ",").alias("labels"))


def except_labels(spark, sf_dir):
    return rel.except_labels(_pairs(spark, sf_dir, "F"), _pairs(spark, sf_dir, "O"), "k", "v").select("k", F.array_join("labels", ",").alias("labels"))


def set_difference(spark, sf_dir):
    """Customers with an urgent finished order against those with an urgent open one."""
    urgent = lambda status: _pairs(spark, sf_dir, status).where("v = '1-URGENT'")
    return rel.set_difference(urgent("F"), urgent("O"), "k")


def intersect_keys(spark, sf_dir):
    return rel.intersection(_pairs(spark, sf_dir, "F"), _pairs(spark, sf_dir, "O"))


def union_all_arrays(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.md5("text").alias("digest"), F.lit("document").alias("kind"))
    return d.unionByName(table(spark, sf_dir, "benchmark").select(F.md5("text").alias("digest"), F.lit("benchmark").alias("kind")))


def unpivot_carry_forward(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("t1"), F.when(F.col("o_orderkey") % 20 == 0, F.col("o_orderpriority")).alias("t2"),
        F.col("o_orderstatus").alias("t3"), F.lit("a").alias("v1"), F.lit(None).cast("string").alias("v2"), F.when(F.col("o_orderkey") % 3 == 0, "c").alias("v3"),
    )
    rows = rel.numbered_to_rows(o, "o_orderkey", {"t": ["t1", "t2", "t3"], "v": ["v1", "v2", "v3"]})
    return rows.withColumn("v", rel.carry_forward(F.col("v"), "o_orderkey", "pos"))


def override_fixup(spark, sf_dir):
    t = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    o = t.where("n_nationkey % 4 = 0").select("n_nationkey", F.when(F.col("n_nationkey") == 8, F.col("n_name")).otherwise(F.concat(F.lit("New "), F.col("n_name"))).alias("new"))
    return rel.override(t, o, "n_nationkey", "n_name", "new")


def mode_per_group(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return rel.mode_per_group(c, "c_nationkey", "c_mktsegment")


def constant_positions(spark, sf_dir):
    return rel.sorted_positions(table(spark, sf_dir, "part"), "p_name").select("pos", F.col("p_name").alias("name"))


def distinct_check(spark, sf_dir):
    """Customers of all orders: the later rows of each."""
    return rel.later_duplicates(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", [F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "place")


def least_most_frequent(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("label")).agg(F.count("*").alias("n"))
    return rel.extremes(counts, "label", "n", 10)


def hardest_labels(spark, sf_dir):
    n = _partitions(spark, sf_dir)
    scores = metrics.per_label(_branded(spark, sf_dir, n), _predicted(spark, sf_dir, n), "doc", "label", n)
    return metrics.hardest(scores, 10).select("label", "f1", "support")


def inverted_suggestions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("name")).agg(F.collect_set("o_orderpriority").alias("suggested"))
    return rel.inverted(o, "name", "suggested").select("item", F.size("names").alias("n"), F.md5(F.array_join("names", ",")).alias("digest"))


def merged_rows(spark, sf_dir):
    """Parts of a name and brand as predecessors of one row."""
    p = table(spark, sf_dir, "part").select(F.concat_ws("|", "p_name", "p_brand").alias("new"), "p_partkey", F.array("p_type", "p_brand").alias("items"))
    return rel.merged_rows(p, "new", "p_partkey", "items").select("new", F.col("first").alias("id"), F.array_join("items", ",").alias("items"))


def checked_lookup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return rel.checked_lookup(o, c, "o_custkey", "c_custkey").select("o_orderkey", "c_name")


def both_blank(spark, sf_dir):
    """Rows by whether both, one or none of two texts are blank."""
    blank = lambda c, p: F.when(F.col("p_size") % p == 0, "  ").otherwise(F.col(c))
    p = table(spark, sf_dir, "part").select("p_partkey", blank("p_name", 2).alias("a"), blank("p_type", 3).alias("b"))
    rows, errors = rel.paired(p, "a", "b")
    return rows.select("p_partkey", F.lit("row").alias("route")).unionByName(errors.select("p_partkey", F.lit("error").alias("route")))


SIDES = "f as (select distinct o_custkey as k, o_orderpriority as v from orders where o_orderstatus = 'F'), n as (select distinct o_custkey as k, o_orderpriority as v from orders where o_orderstatus = 'O')"
QUERIES = {
    "label_frequency": (label_frequency, f"with {BRANDS} select label, count(*) as n from b group by label"),
    "catalog_summary": (catalog_summary, "select p_partkey, cast(json_object('p_name', p_name, 'p_size', p_size) as varchar) as summary from part where p_brand is not null"),
    "row_routing_split": (row_routing_split, "select case when lang = 'de' then 'special' else 'rest' end as route, source, count(*) as n from documents group by all"),
    "prune_empty": (prune_empty, "select p_partkey, case when p_size % 3 in (0, 1) then null else p_type end as kind from part"),
    "full_outer_merge_ranked_ids": (full_outer_merge_ranked_ids, """with c as (select c_nationkey as k, arg_max(c_name, c_custkey) as c_name from customer where c_acctbal > 9000 group by 1),
      s as (select s_nationkey as k, arg_max(s_name, s_suppkey) as s_name from supplier where s_acctbal > 0 group by 1),
      m as (select coalesce(c.k, s.k) as k, c_name, s_name, case when c.k is not null then c.k % 4 end as ra, case when s.k is not null then s.k % 3 end as rb from c full join s on c.k = s.k),
      r as (select *, coalesce(ra, rb) + coalesce(rb, ra) as rank from m)
      select printf('gp%04d', row_number() over (order by rank, k)) as id, k, rank, c_name, s_name from r"""),
    "merge_statistics": (merge_statistics, """with m as (select c.k as a, q.k as b from (select distinct o_custkey as k from orders) c full join (select s_suppkey * 7 as k from supplier) q on c.k = q.k)
      select count_if(a is not null and b is not null) as n_both, count_if(a is not null and b is null) as n_only_a,
        count_if(a is null and b is not null) as n_only_b, count(*) as n_total from m"""),
    "level_rank": (level_rank, "select case substr(o_orderpriority, 1, 1) when '1' then 0 when '2' then 1 when '3' then 2 when '4' then 3 when '5' then 5 end as rank, count(*) as n from orders group by 1"),
    "priority_lookup_join": (priority_lookup_join, """with s as (select p_brand || '|' || p_type as name, min(p_name) as value from part where p_size < 10 group by 1),
      g as (select p_brand as name, max(p_name) as value from part where p_size > 25 group by 1)
      select p_partkey, coalesce(s.value, g.value) as value from part left join s on p_brand || '|' || p_type = s.name left join g on p_brand = g.name"""),
    "dangling_references": (dangling_references, "select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)"),
    "unused_overrides": (unused_overrides, "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')"),
    "known_reference_filter": (known_reference_filter, "select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0)"),
    "reference_state": (reference_state, "select case when c_nationkey < 15 then 'known' when c_nationkey <= 19 then 'renamed' else 'unknown' end as state, count(*) as n from customer group by 1"),
    "rename_split_join": (rename_split_join, f"""with {RENAMES}, f as (select n_regionkey as owner, n_name as ref from supplier join nation on s_nationkey = n_nationkey),
      j as (select distinct owner, case when r.old is null then ref else r.new end as t from f left join r on ref = r.old)
      select owner, coalesce(string_agg(t, ',' order by t), '') as refs from j group by owner"""),
    "rename_checks": (rename_checks, """with r as (select n_name || case when n_nationkey % 4 = 0 then '?' else '' end as old, case when n_nationkey % 3 = 0 then n_name else lower(n_name) end as new from nation),
      n as (select new, count(*) as c from r group by new), p as (select r.old, r.new, case when r.old not in (select n_name from nation) then 'missing' when c = 1 and r.old = r.new then 'no-op' end as problem from r join n on r.new = n.new)
      select * from p where problem is not null"""),
    "rewrite_catalog": (rewrite_catalog, f"""with {RENAMES}, x as (select * from r union all select 'ATLANTIS', 'LOST'), n as (select n_name, printf('gp%04d', n_nationkey) as id from nation)
      select n_name, id from n where n_name not in (select old from x)
      union all select new, coalesce(min(id), 'gp9999') from x left join n on old = n_name where new is not null group by new"""),
    "regex_label_join": (regex_label_join, " union all ".join(f"""select '{k}' as label, count(*) as n, sum(doc_id)::bigint as ids from documents where regexp_matches(text, '{p}')""" for k, p in PATTERNS.items())),
    "closest_name": (closest_name, """with a as (select distinct unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from benchmark), b as (select distinct unnest(regexp_extract_all(lower(html), '[a-z]+')) as o from pages),
      d as (select word, o, levenshtein(word, o) as distance, greatest(length(word), length(o)) as longer from a, b)
      select word, o as nearest, distance::int as distance, round(1 - distance / longer, 6) as ratio from d qualify row_number() over (partition by word order by 1 - distance / longer desc, o) = 1"""),
    "rare_label_filter": (rare_label_filter, "select o_custkey as label, count(*) as n from orders group by 1 having count(distinct o_orderkey) >= 10"),
    "cooccurrence_top10": (cooccurrence_top10, f"""with {BRANDS}, j as (select x.label as a, y.label as b, x.doc as doc from b x join b y on x.doc = y.doc and x.label < y.label),
      q as (select *, row_number() over (partition by a, b order by doc) as rn from j)
      select a, b, count(*) as n, string_agg(case when rn <= 3 then doc::varchar end, ',' order by doc) as samples from q group by a, b order by n desc, a, b limit 10"""),
    "duplicate_groups": (duplicate_groups, "select md5(text) as digest, count(*) as n, min(doc_id) as first, max(doc_id) as last from documents group by 1 having count(*) > 1"),
    "first_occurrence": (first_occurrence, "select doc_id, row_number() over (partition by text order by doc_id) as place from documents qualify place > 1"),
    "second_highest_labels": (second_highest_labels, """with n as (select o_custkey, p_brand, count(distinct o_orderkey) as n from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey group by all)
      select o_custkey, p_brand, n from n qualify dense_rank() over (partition by o_custkey order by n desc) = 2 and n > 1"""),
    "set_relation_buckets": (set_relation_buckets, f"""with {CELLS}, d as (select doc, sum(t * p) as hits, sum(t) as t, sum(p) as p from c group by doc)
      select count_if(hits = t and hits = p) as n_perfect, count_if(not (hits = t and hits = p) and hits > 0) as n_partial, count_if(hits = 0) as n_miss, count_if(p > t) as n_over, count_if(p < t) as n_under from d"""),
    "multilabel_metrics": (multilabel_metrics, f"""with {PER_LABEL}, m as (select avg(case when tp > 0 then 2 * pr * rc / (pr + rc) else 0 end) as macro_f1, count(*) as nl from s),
      d as (select doc, sum(t * p) as hits, sum(t) as t, sum(p) as p, count(*) as either from c group by doc),
      a as (select count(*) as nd, sum(hits) as tp, sum(t) as nt, sum(p) as np, avg(hits / either) as jaccard, avg(case when hits = either then 1.0 else 0 end) as exact_ratio, sum(either - hits) as wrong from d)
      select round(wrong / (nd * nl), 6) as hamming, round(jaccard, 6) as jaccard, round(exact_ratio, 6) as exact_ratio, round(tp / np, 6) as micro_precision, round(tp / nt, 6) as micro_recall,
        round(2 * tp / (nt + np), 6) as micro_f1, round(macro_f1, 6) as macro_f1, round(nt / nd, 6) as true_cardinality, round(np / nd, 6) as predicted_cardinality from a, m"""),
    "per_label_prf": (per_label_prf, f"""with {PER_LABEL} select label, round(pr, 6) as precision, round(rc, 6) as recall, round(case when tp > 0 then 2 * pr * rc / (pr + rc) else 0 end, 6) as f1,
      support::bigint as support, n_predicted::bigint as n_predicted from s"""),
    "merge_candidates": (merge_candidates, """with o as (select distinct user_id as doc, event_type as label from events), n as (select label, count(*) as n from o group by label having count(*) >= 10),
      h as (select o.label, doc, n, row_number() over (partition by o.label order by md5(o.label || '|' || doc), doc) as place from o join n using (label) qualify place <= 100),
      z as (select label, count(*) as size, any_value(n) as n from h group by label),
      p as (select distinct user_id as d, event_type as b from (select *, min(ts) over (partition by user_id) as first from events) where ts > first),
      j as (select label as a, b, doc, row_number() over (partition by label, b order by place) as rn from h join p on d = doc and label < b),
      g as (select a, b, count(*) as shared, string_agg(case when rn <= 3 then doc::varchar end, ',' order by rn) as shown from j group by a, b)
      select a, b, shared, x.n as n_a, y.n as n_b, round(shared / x.size, 6) as rate_ab, round(shared / y.size, 6) as rate_ba, round((shared / x.size + shared / y.size) / 2, 6) as rate, shown
      from g join z x on x.label = a join z y on y.label = b where (shared / x.size + shared / y.size) / 2 >= 0.5"""),
    "set_overlap_jaccard": (set_overlap_jaccard, """with w as (select p_brand as label, o_custkey as feature, sum(l_quantity) as weight from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey group by all),
      f as (select label, feature from w where weight <> 0 qualify row_number() over (partition by label order by abs(weight) desc, feature) <= 100), n as (select label, count(*) as n from f group by label having count(*) >= 10),
      j as (select x.label as a, y.label as b, count(*) as shared from f x join f y on x.feature = y.feature and x.label < y.label group by all)
      select a, j.b, shared, round(shared / (na.n + nb.n - shared), 6) as jaccard from j join n na on a = na.label join n nb on j.b = nb.label where shared / (na.n + nb.n - shared) > 0.05"""),
    "top_weights": (top_weights, """select p_brand, p_partkey, round(p_retailprice - 1200, 4) as w, row_number() over (partition by p_brand order by abs(p_retailprice - 1200) desc, p_partkey) as place
      from part where p_retailprice - 1200 <> 0 qualify place <= 5"""),
    "upsert_by_key": (upsert_by_key, """select c_custkey, case when c_mktsegment = 'BUILDING' then upper(c_mktsegment) else c_name end as c_name from customer where c_acctbal > 0 or c_mktsegment = 'BUILDING'"""),
    "insert_ignore": (insert_ignore, f"with {SIDES} from f union from n"),
    "insert_feedback": (insert_feedback, f"with {SIDES} select n.k, count(*) as attempted, count_if(f.k is null) as inserted, count_if(f.k is not null) as duplicates from n left join f on n.k = f.k and n.v = f.v group by 1"),
    "pair_stats": (pair_stats, "with p as (select distinct o_custkey as k, o_orderpriority as v from orders) select count(*) as n_pairs, count(distinct k) as n_keys, round(count(*) / count(distinct k), 2) as mean from p"),
    "key_stats": (key_stats, """with p as (select distinct o_custkey as k, o_orderpriority as v from orders)
      select c_custkey as k, count(v) as n, count(v) > 0 as present, coalesce(string_agg(v, ',' order by v), '') as kinds from customer left join p on c_custkey = k group by 1"""),
    "union_labels": (union_labels, f"with {SIDES}, u as (from f union from n) select k, string_agg(v, ',' order by v) as labels from u group by 1"),
    "except_labels": (except_labels, f"""with {SIDES}, u as (select k from f union select k from n)
      select u.k, coalesce(string_agg(case when n.k is null then f.v end, ',' order by f.v), '') as labels from u left join f on u.k = f.k left join n on f.k = n.k and f.v = n.v group by 1"""),
    "set_difference": (set_difference, f"""with {SIDES}, a as (select k from f where v = '1-URGENT'), b as (select k from n where v = '1-URGENT')
      select k, 'missing' as side from a where k not in (from b) union all select k, 'invalid' from b where k not in (from a)"""),
    "intersect_keys": (intersect_keys, f"with {SIDES} from f intersect from n"),
    "union_all_arrays": (union_all_arrays, "select md5(text) as digest, 'document' as kind from documents union all select md5(text), 'benchmark' from benchmark"),
    "unpivot_carry_forward": (unpivot_carry_forward, """with o as (from orders)
      select o_orderkey, 0 as pos, o_orderstatus as t, 'a' as v from o where o_orderstatus is not null
      union all select o_orderkey, 1, o_orderpriority, 'a' from o where o_orderkey % 20 = 0
      union all select o_orderkey, 2, o_orderstatus, case when o_orderkey % 3 = 0 then 'c' else 'a' end from o where o_orderkey % 20 = 0"""),
    "override_fixup": (override_fixup, "select n_nationkey, case when n_nationkey % 4 = 0 and n_nationkey <> 8 then 'New ' || n_name else n_name end as n_name, n_nationkey = 8 as no_op from nation"),
    "mode_per_group": (mode_per_group, "select c_nationkey, c_mktsegment, count(*) as n from customer group by c_nationkey, c_mktsegment qualify row_number() over (partition by c_nationkey order by count(*) desc, c_mktsegment) = 1"),
    "constant_positions": (constant_positions, "select row_number() over (order by p_name) - 1 as pos, p_name as name from (select distinct p_name from part)"),
    "distinct_check": (distinct_check, "select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as place from orders qualify place > 1"),
    "least_most_frequent": (least_most_frequent, """with n as (select l_suppkey as label, count(*) as n from lineitem group by 1)
      (select 'least' as side, label, n from n order by n, label limit 10) union all (select 'most', label, n from n order by n desc, label limit 10)"""),
    "hardest_labels": (hardest_labels, f"""with {PER_LABEL}, f as (select label, round(case when tp > 0 then 2 * pr * rc / (pr + rc) else 0 end, 6) as f1, support::bigint as support from s)
      select * from f where support >= 3 order by f1, label limit 10"""),
    "inverted_suggestions": (inverted_suggestions, """with p as (select distinct o_orderpriority as item, o_custkey::varchar as name from orders)
      select item, count(*)::int as n, md5(string_agg(name, ',' order by name)) as digest from p group by 1"""),
    "merged_rows": (merged_rows, """with p as (select p_name || '|' || p_brand as new, p_partkey, p_type, p_brand from part),
      u as (select new, unnest([p_type, p_brand]) as item, p_partkey, unnest([0, 1]) as i from p), d as (select new, item, min((p_partkey, i)) as place from u group by all)
      select new, (select min(p_partkey) from p where p.new = d.new) as id, string_agg(item, ',' order by place) as items from d group by new"""),
    "checked_lookup": (checked_lookup, "select o_orderkey, c_name from orders join customer on o_custkey = c_custkey"),
    "both_blank": (both_blank, "select p_partkey, case when p_size % 2 <> 0 and p_size % 3 <> 0 then 'row' else 'error' end as route from part where p_size % 6 <> 0"),
}
