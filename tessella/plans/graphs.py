"""Graph queries on prerequisite lists derived from the parts, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph
from .tables import table


def _graph(spark, sf_dir):
    """Of N parts, k must come after (7k+3) mod N and before (13k+1) mod N; the list orders them by (11k) mod N."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"))
    n = parts.count()
    nodes = parts.select("node", F.array((F.col("node") * 7 + 3) % n).alias("before"), F.array((F.col("node") * 13 + 1) % n).alias("after"))
    return nodes, parts.select(((F.col("node") * 11) % n).alias("pos"), "node")


def _rings(spark, sf_dir):
    """Parts in rings of four, every second ring leading into the next."""
    node = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("src"))
    ring = node.select("src", F.when(F.col("src") % 4 == 3, F.col("src") - 3).otherwise(F.col("src") + 1).alias("dst"))
    return ring.unionByName(node.where("src % 8 = 0").select("src", (F.col("src") + 4).alias("dst")))


def order_violations(spark, sf_dir):
    return graph.violations(*_graph(spark, sf_dir))


def violation_scores(spark, sf_dir):
    return graph.violation_scores(*_graph(spark, sf_dir))


def cascade_impact(spark, sf_dir):
    return graph.cascade_impact(*_graph(spark, sf_dir)).select("node", "item", "kind", "impact")


def backward_cuts(spark, sf_dir):
    return graph.backward_cuts(*_graph(spark, sf_dir))


def lists_after_cuts(spark, sf_dir):
    left = graph.without_cuts(*_graph(spark, sf_dir))
    return left.select("node", F.size("before").alias("n_before"), F.size("after").alias("n_after"))


def cut_report(spark, sf_dir):
    return graph.cut_report(*_graph(spark, sf_dir), "cuts_only")


def cut_report_json(spark, sf_dir):
    return graph.cut_report(*_graph(spark, sf_dir), "json")


def cut_report_dict(spark, sf_dir):
    return graph.cut_report(*_graph(spark, sf_dir), "dict")


def _names(spark, sf_dir):
    """Customers with orders as nodes, each after the one seven above and before the one fourteen above; a list of seven times the suppliers' numbers."""
    k = F.col("node")
    nodes = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("node")).distinct().withColumns({"before": F.array(k + 7), "after": F.array(k + 14)})
    return nodes, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pos"), (F.col("s_suppkey") * 7).alias("node"))


def constraint_names(spark, sf_dir):
    return graph.constraint_names(*_names(spark, sf_dir))


def constraint_summary(spark, sf_dir):
    return graph.constraint_summary(*_names(spark, sf_dir))


def reachability(spark, sf_dir):
    """Each part leads to the one of half its number."""
    edges = table(spark, sf_dir, "part").where("p_partkey > 1").select(F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 2).alias("dst"))
    return graph.reachability(edges).groupBy("src").agg(F.count("*").alias("n"), F.sum("dst").alias("total"))


def scc_cycles(spark, sf_dir):
    return graph.cycles(_rings(spark, sf_dir))


def cut_verification(spark, sf_dir):
    """Rings as lists of what follows, in the order of the parts: each ring's last edge runs backwards."""
    edges = _rings(spark, sf_dir)
    nodes = edges.groupBy(F.col("src").alias("node")).agg(F.array().cast("array<bigint>").alias("before"), F.collect_list("dst").alias("after"))
    order = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.col("p_partkey").alias("node"))
    return graph.verification(nodes, order)


EDGES = """n as (select count(*) as n from part), k as (select p_partkey as node, n from part, n), o as (select node, (node * 11) % n as pos from k),
  c as (select node, (node * 7 + 3) % n as item, 'before' as kind from k union all select node, (node * 13 + 1) % n, 'after' from k),
  p as (select c.*, a.pos as node_pos, b.pos as item_pos from c join o a on c.node = a.node join o b on c.item = b.node),
  v as (select *, abs(node_pos - item_pos) as distance from p where case kind when 'before' then item_pos > node_pos else item_pos < node_pos end),
  e as (select case kind when 'before' then item else node end as src, case kind when 'before' then node else item end as dst, * from p),
  m as (select node, item, kind, case kind when 'before' then node_pos - 0.5 else node_pos + 1.5 end as at from v),
  z as (select e.*, case kind when 'before' then item_pos else node_pos end as a, case kind when 'before' then node_pos else item_pos end as b from e),
  i as (select m.node, m.item, m.kind, sum((z.a > z.b)::int - ((case when z.src = m.item then m.at else z.a end) > (case when z.dst = m.item then m.at else z.b end))::int)::bigint as impact
    from m join z on (z.src = m.item or z.dst = m.item) and z.src <> z.dst group by all)"""
RING = """r as (select p_partkey as src, case when p_partkey % 4 = 3 then p_partkey - 3 else p_partkey + 1 end as dst from part
  union all select p_partkey, p_partkey + 4 from part where p_partkey % 8 = 0)"""
JSON = """'{{"before' || {0} || '":' || b || ',"after' || {0} || '":' || a || '}}' as report"""
LISTS = """l as (select node, {0} as b, {1} as a from (select k.node, list(item::varchar order by item::varchar) filter (kind = 'before') as bs, list(item::varchar order by item::varchar) filter (kind = 'after') as xs
  from k left join {2} using (node) group by k.node))"""
QUOTE = """'[' || coalesce(array_to_string(list_transform({0}, lambda x: '{1}' || x || '{1}'), '{2}'), '') || ']'"""
KEPT = "(select * from p where (node, item, kind) not in (select node, item, kind from v)) w"
VERIFIED = f"""with recursive {RING}, t as (select src, dst from r union select t.src, r.dst from t join r on t.dst = r.src),
  s as (select distinct x.src, least(x.src, (select min(y.dst) from t y where y.src = x.src and exists (select 1 from t w where w.src = y.dst and w.dst = x.src))) as component from t x where x.src = x.dst)
  select count_if(dst < src) as original_violations, (select count(distinct component) from s) as original_cycles, count_if(dst < src) as cuts_needed, 0::bigint as new_violations, 0::bigint as new_cycles, true as is_dag_consistent, true as is_dag_acyclic from r"""
QUERIES = {
    "order_violations": (order_violations, f"with {EDGES} select node, item, kind, node_pos, item_pos, distance from v"),
    "violation_scores": (violation_scores, f"""with {EDGES} select node, item, kind, node_pos, item_pos, distance, impact,
      round(2.0 * (2 + 2) + 5.0 * impact + 1 / (1 + distance)::double + 0.5 * (select n - least(node_pos, item_pos) from n)::double / (select n from n), 9)::double as score from v join i using (node, item, kind)"""),
    "cascade_impact": (cascade_impact, f"with {EDGES} select node, item, kind, impact from i"),
    "backward_cuts": (backward_cuts, f"with {EDGES} select case kind when 'before' then item else node end as src, case kind when 'before' then node else item end as dst, node || '.' || kind as field from v"),
    "lists_after_cuts": (lists_after_cuts, f"with {EDGES} select k.node, (1 - count(*) filter (v.kind = 'before'))::int as n_before, (1 - count(*) filter (v.kind = 'after'))::int as n_after from k left join v using (node) group by k.node"),
    "cut_report": (cut_report, f"""with {EDGES}, {LISTS.format(QUOTE.format('bs', '"', ','), QUOTE.format('xs', '"', ','), 'v')} select node, {JSON.format("'_deletes'")} from l where node in (select node from v)"""),
    "cut_report_json": (cut_report_json, f"""with {EDGES}, {LISTS.format(QUOTE.format('bs', '"', ','), QUOTE.format('xs', '"', ','), KEPT)} select node, {JSON.format("''")} from l"""),
    "cut_report_dict": (cut_report_dict, f"""with {EDGES}, {LISTS.format(QUOTE.format('bs', "''", ', '), QUOTE.format('xs', "''", ', '), KEPT)} select node, '{{''before'': ' || b || ', ''after'': ' || a || '}}' as report from l"""),
    "constraint_names": (constraint_names, """with u as (select distinct o_custkey as node from orders), l as (select s_suppkey * 7 as node from supplier)
      select node, 'missing' as state from u where node not in (from l) union all select node, 'invalid' from l where node not in (from u)"""),
    "constraint_summary": (constraint_summary, """with u as (select distinct o_custkey as node from orders), l as (select s_suppkey * 7 as node from supplier)
      select (select count(*) from u where node in (from l) and node + 7 in (from l)) as violations, (select count(*) from u where node not in (from l)) as missing_items, (select count(*) from l where node not in (from u)) as invalid_items"""),
    "reachability": (reachability, "with recursive r as (select p_partkey as src, p_partkey // 2 as dst from part where p_partkey > 1 union all select src, dst // 2 from r where dst > 1) select src, count(*) as n, sum(dst)::bigint as total from r group by src"),
    "scc_cycles": (scc_cycles, f"""with recursive {RING}, t as (select src, dst from r union select t.src, r.dst from t join r on t.dst = r.src)
      select x.src as node, least(min(x.dst), x.src) as component from t x join t y on x.src = y.dst and x.dst = y.src where x.src <> x.dst group by x.src"""),
    "cut_verification": (cut_verification, VERIFIED),
}
