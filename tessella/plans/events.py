"""Event queries, batch and streaming, each with its oracle SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import mapreduce
from ..streaming import events as ev
from .tables import table


def _slots(spark, sf_dir):
    """Views begin a slot (a user), purchases finish it, errors end it."""
    kind = F.when(F.col("event_type") == "view", "BEGIN").when(F.col("event_type") == "purchase", "FINISH").when(F.col("event_type") == "error", "ERROR")
    at = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("slot_key"), (F.col("event_id") % 4).alias("item_type"), kind.alias("type"), at.alias("time"), F.col("event_id").alias("seq"))
    return e.where("type is not null")


def event_slot_elapsed(spark, sf_dir):
    return ev.slot_elapsed(_slots(spark, sf_dir))


def event_type_totals(spark, sf_dir):
    return ev.type_totals(ev.slot_elapsed(_slots(spark, sf_dir)))


def newest_n(spark, sf_dir):
    return ev.retained(table(spark, sf_dir, "events").select("event_id", "ts", "user_id"), "ts", "event_id", 50).select("event_id", "user_id")


def _stream(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    # A file stream takes folders or patterns; a pattern finds the table be it a file or a folder of files.
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf_dir}/event[s].parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(spark, name, stream, plan):
    """Run ``plan`` over a stream with a closing event, to its end."""
    name = f"{name}_{uuid.uuid4().hex[:8]}"
    folder = ev.stream_folder(spark)
    with_room, close = ev.closed(stream, "ts", "1 day", f"{folder}/{name}")
    return ev.run_available(plan(with_room), name, folder, close)


def event_stream_tumbling(spark, sf_dir):
    out = _drained(spark, "tumbling", _stream(spark, sf_dir), lambda s: ev.tumbling(s, "ts", "1 day", "event_type"))
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 3).alias("total"))


def event_stream_session(spark, sf_dir):
    out = _drained(spark, "session", _stream(spark, sf_dir), lambda s: ev.sessions(s, "ts", "6 hours", "user_id"))
    return out.select("user_id", F.unix_seconds("start").alias("start"), "n")


IDLE = 7200.0  # seconds after its end at which a slot is forgotten


def _slot_events(e):
    kind = F.when(F.col("event_type") == "view", "BEGIN").when(F.col("event_type") == "purchase", "FINISH").when(F.col("event_type") == "error", "ERROR")
    at = F.unix_seconds("ts").cast("double")
    # The closing event has neither user nor type.
    own = e.select(F.col("user_id").cast("string").alias("slot_key"), F.col("event_id").cast("string").alias("item"), kind.alias("type"), at.alias("time"), F.col("event_id").alias("seq"), "ts")
    return own.withColumn("item_type", (F.col("seq") % 4).cast("string")).drop("item")


def event_stream_slots(spark, sf_dir):
    """Totals per item type from the stateful reducer, which forgets idle slots."""
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, ev.ROCKSDB)
    try:
        out = _drained(spark, "slots", _stream(spark, sf_dir), lambda s: ev.slot_stream(_slot_events(s), IDLE))
    finally:
        spark.conf.set(store, before)
    return out.groupBy("item_type").agg(F.sum("n").alias("n"), F.round(F.sum("elapsed"), 3).alias("elapsed"))


def event_slot_batch(spark, sf_dir):
    """The same totals from the table."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ev.type_totals(ev.slot_elapsed(_slot_events(e), IDLE))


def event_window_batch(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ev.tumbling(e, "ts", "1 day", "event_type").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 3).alias("total"))


def event_session_batch(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ev.sessions(e, "ts", "6 hours", "user_id").select("user_id", F.unix_seconds("start").alias("start"), "n")


def props_json_extract(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.groupBy("event_type").agg(F.sum(k).alias("total"), F.count(k).alias("n"))


def chat_turn_fold(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    order = F.struct("turn", "role", "text")
    line = F.concat(F.col("role"), F.lit(":"), F.length("text").cast("string"))
    return mapreduce.fold(c, ["conv_id"], F.lit(""), line, lambda acc, x: F.concat(acc, F.lit("|"), x), order).withColumnRenamed("folded", "history")


def chain_of_stages(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    stages = {"short": lambda c: F.when(F.length(c) > 12, c), "upper": F.upper, "same": lambda c: F.when(~c.startswith("B"), c)}
    return mapreduce.map_stages(p, stages, "p_name")


def memo_touch(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("caller"), F.col("event_id").alias("at"))
    memo = e.select("key").distinct().select("key", F.md5("key").alias("value"), F.lit(0).cast("long").alias("last_access"), F.array(F.lit("init")).alias("callers"))
    return mapreduce.memo_touch(memo, e.where("caller <> 'view'")).select("key", "value", "last_access", F.array_join("callers", ",").alias("callers"))


SLOTS = """s as (select user_id as slot_key, event_id % 4 as item_type, case event_type when 'view' then 'BEGIN' when 'purchase' then 'FINISH' when 'error' then 'ERROR' end as type,
    floor(epoch(ts)) as time, event_id as seq from events where event_type in ('view', 'purchase', 'error')),
  l as (select *, coalesce(time - lag(time) over w, 0) as elapsed, first_value(item_type) over w as first, last_value(case type when 'BEGIN' then item_type end ignore nulls) over
    (partition by slot_key order by time, seq rows between unbounded preceding and 1 preceding) as begun from s window w as (partition by slot_key order by time, seq)),
  r as (select slot_key, coalesce(begun, first) as item_type, type, time, elapsed from l where type in ('FINISH', 'ERROR'))"""
FORGETFUL = f"""w as (select user_id as slot_key, event_id % 4 as item_type, case event_type when 'view' then 'BEGIN' when 'purchase' then 'FINISH' else 'ERROR' end as type,
    floor(epoch(ts)) as time, event_id as seq from events where event_type in ('view', 'purchase', 'error')),
  k as (select *, coalesce(lag(type) over s <> 'BEGIN' and time - lag(time) over s > 7200, false)::int as fresh from w window s as (partition by slot_key order by time, seq)),
  f as (select *, sum(fresh) over (partition by slot_key order by time, seq) as life from k),
  l as (select *, coalesce(time - lag(time) over s, 0) as elapsed, first_value(item_type) over s as first, last_value(case type when 'BEGIN' then item_type end ignore nulls) over
    (partition by slot_key, life order by time, seq rows between unbounded preceding and 1 preceding) as begun from f window s as (partition by slot_key, life order by time, seq))"""
IDLE_TOTALS = f"with {FORGETFUL} select coalesce(begun, first)::varchar as item_type, count(*) as n, round(sum(elapsed), 3)::double as elapsed from l where type <> 'BEGIN' group by 1"
DAYS = "select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 3) as total from events group by 1, 2"
SESSIONS = """with g as (select user_id, ts, coalesce(ts - lag(ts) over (partition by user_id order by ts) >= interval 6 hours, true)::int as fresh from events),
      n as (select *, sum(fresh) over (partition by user_id order by ts) as k from g) select user_id, floor(epoch(min(ts)))::bigint as start, count(*) as n from n group by user_id, k"""
QUERIES = {
    "event_slot_elapsed": (event_slot_elapsed, f"with {SLOTS} select slot_key, item_type, type, time::double as time, elapsed::double as elapsed from r"),
    "event_type_totals": (event_type_totals, f"with {SLOTS} select item_type, count(*) as n, round(sum(elapsed), 3)::double as elapsed from r group by 1"),
    "event_stream_slots": (event_stream_slots, IDLE_TOTALS),
    "event_slot_batch": (event_slot_batch, IDLE_TOTALS),
    "newest_n": (newest_n, "select event_id, user_id from events order by ts desc, event_id limit 50"),
    "event_stream_tumbling": (event_stream_tumbling, DAYS),
    "event_window_batch": (event_window_batch, DAYS),
    "event_session_batch": (event_session_batch, SESSIONS),
    "event_stream_session": (event_stream_session, SESSIONS),
    "props_json_extract": (props_json_extract, "select event_type, sum((props->>'k')::int)::bigint as total, count(props->>'k') as n from events group by 1"),
    "chat_turn_fold": (chat_turn_fold, "select conv_id, '|' || string_agg(role || ':' || length(text), '|' order by turn, role, text) as history from conversations group by 1"),
    "chain_of_stages": (chain_of_stages, """select p_partkey, case when length(p_name) > 12 and not starts_with(upper(p_name), 'B') then upper(p_name) else p_name end as p_name,
      length(p_name) > 12 and not starts_with(upper(p_name), 'B') and upper(p_name) <> p_name as changed from part"""),
    "memo_touch": (memo_touch, """with k as (select distinct user_id from events), t as (select user_id, max(event_id) as seen, list_sort(list_append(list(distinct event_type), 'init')) as c from events where event_type <> 'view' group by 1)
      select k.user_id::varchar as key, md5(k.user_id::varchar) as value, coalesce(seen, 0) as last_access, coalesce(array_to_string(c, ','), 'init') as callers from k left join t on k.user_id = t.user_id"""),
}
