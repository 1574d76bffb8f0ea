"""Relational, graph, map, source, sink and stream operators on small literals."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tessella.operators import graph, mapreduce, metrics, models, nearest
from tessella.operators import relational as rel
from tessella.operators import vocabulary
from tessella.sources import readers, writers
from tessella.streaming import events


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_full_merge_last_row_wins(spark):
    a = spark.createDataFrame([("x", 1, "a1"), ("x", 2, "a2"), ("y", 1, "a3")], "k string, n int, v string")
    b = spark.createDataFrame([("x", 1, "b1"), ("z", 1, "b2")], "k string, n int, v string")
    merged = rel.full_merge(a, b, "k", ("a", "b"), ([F.col("n")], [F.col("n")]))
    assert rows(merged.select("k", "a.v", F.col("b.v").alias("w")), "k") == [("x", "a2", "b1"), ("y", "a3", None), ("z", None, "b2")]


def test_numbered_ids_over_many_partitions(spark):
    df = spark.range(500).withColumn("r", F.col("id") % 7)
    got = rel.numbered_ids(df.withColumnRenamed("id", "k"), [F.col("r"), F.col("k")]).orderBy("r", "k").collect()
    assert [r.id for r in got] == [f"gp{i:04d}" for i in range(1, 501)]


def test_unknown_level_raises(spark):
    df = spark.createDataFrame([("N5",), ("odd",)], "l string")
    with pytest.raises(Exception, match="unknown level"):
        df.select(rel.level_rank(F.col("l"), {"N5": 0})).collect()


def test_carry_forward_and_gap(spark):
    df = spark.createDataFrame([("a", "x", None, "z", "1", None, None)], "k string, t1 string, t2 string, t3 string, v1 string, v2 string, v3 string")
    assert rows(rel.numbered_to_rows(df, "k", {"t": ["t1", "t2", "t3"], "v": ["v1", "v2", "v3"]})) == [("a", 0, "x", "1")]


def test_empty_sets(spark):
    none = spark.createDataFrame([], "k string, l string")
    some = spark.createDataFrame([("a", "x")], "k string, l string")
    assert rows(rel.except_labels(none, some, "k", "l")) == [("a", [])]
    assert rows(rel.union_labels(none, some, key="k", label="l")) == [("a", ["x"])]
    assert rel.pair_counts(none, "k", "l").count() == 0


def test_graph(spark):
    """Expectations follow the rules in words: ``before`` holds what must precede the node, ``after`` what must follow it."""
    nodes = spark.createDataFrame([("a", ["c"], ["b"]), ("b", [], []), ("c", ["zz"], []), ("d", [], ["a", "c"]), ("e", ["d"], [])], "node string, before array<string>, after array<string>")
    order = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c"), (3, "d"), (4, "x")], "pos int, node string")
    assert rows(graph.edges_of(nodes)) == [("a", "b"), ("c", "a"), ("d", "a"), ("d", "c"), ("d", "e")]
    expected = [("a", "b", "after", 1, 0, 1), ("a", "c", "before", 1, 2, 1), ("d", "a", "after", 3, 1, 2), ("d", "c", "after", 3, 2, 1)]
    assert rows(graph.violations(nodes, order)) == expected
    # b moves behind a and c; c before a; a and c behind d (and x): each simulated by hand.
    impact = {(r.node, r.item): r.impact for r in graph.cascade_impact(nodes, order).collect()}
    assert impact == {("a", "b"): 1, ("a", "c"): 1, ("d", "a"): 2, ("d", "c"): 1}
    scores = {(r.node, r.item): r.score for r in graph.violation_scores(nodes, order).collect()}
    assert scores[("a", "b")] == pytest.approx(2 * (2 + 0) + 5 * 1 + 1 / 2 + 0.5 * 5 / 5)
    assert scores[("d", "a")] == pytest.approx(2 * (2 + 2) + 5 * 2 + 1 / 3 + 0.5 * 4 / 5)
    lists = dict(a=["c"], b=[], c=["zz"], d=[], e=["d"]), dict(a=["b"], b=[], c=[], d=["a", "c"], e=[])
    for (node, item), n in impact.items():
        kind = "before" if (node, item) == ("a", "c") else "after"
        moved, _ = graph.move(["b", "a", "c", "d", "x"], node, item, kind)
        assert n == 4 - len(graph.broken(moved, *lists))
    assert rows(graph.constraint_names(nodes, order)) == [("e", "missing"), ("x", "invalid")]
    assert rows(graph.constraint_summary(nodes, order)) == [(4, 1, 1)]
    assert rows(graph.cut_report(nodes, order)) == [("a", '{"before_deletes":["c"],"after_deletes":["b"]}'), ("d", '{"before_deletes":[],"after_deletes":["a","c"]}')]
    assert rows(graph.cut_report(nodes, order, "json"))[2] == ("c", '{"before":["zz"],"after":[]}')
    assert rows(graph.cut_report(nodes, order, "dict"))[4] == ("e", "{'before': ['d'], 'after': []}")
    assert graph.cut_report(nodes, order, "summary").collect()[2].report == "Constraint cuts needed: 4"
    with pytest.raises(ValueError):
        graph.cut_report(nodes, order, "other")


def test_cycles_and_reach(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "d"), ("f", "a"), ("g", "g"), ("h", "i")]
    df = spark.createDataFrame(edges, "src string, dst string")
    assert rows(graph.cycles(df)) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d")]
    from_h = spark.createDataFrame([("h",), ("d",)], "src string")
    assert rows(graph.reachability(df, from_h)) == [("d", "d"), ("d", "e"), ("h", "i")]
    assert graph.cycles(df.limit(0)).count() == 0


def test_reorder():
    before, after = {"a": ["b"], "b": [], "c": ["a"], "d": []}, {"a": [], "b": [], "c": [], "d": ["a"]}
    out, changes = graph.reorder(["a", "old", "b", "d"], before, after)
    assert changes[0] == "remove old" and changes[1] == "insert c at 1"
    # a scores 9.75 to go behind d, b 7.83 to go before a; neither move is judged again.
    assert out == ["c", "d", "b", "a"] and changes[2:] == ["move a after d to 3", "move b before a to 2"]
    assert graph.insertion(["x", "y", "z"], {"x"}, {"z"}, "constraint_based") == 1
    assert graph.insertion(["x", "y", "z"], set(), {"z"}, "constraint_based") == 0
    assert graph.insertion(["x", "y", "z"], {"z"}, {"y"}, "constraint_based") == 1
    assert graph.insertion(["x", "y", "z"], set(), set(), "best_position") == 0
    assert graph.insertion(["x", "y", "z"], set(), set(), "end") == 3
    with pytest.raises(ValueError):
        graph.insertion(["a"], set(), set(), "nowhere")


def test_stages_and_hooks(spark):
    df = spark.createDataFrame([(1, "keep"), (2, "skip"), (3, None)], "i int, s string")
    out = mapreduce.map_stages(df, {"up": F.upper}, "s", preprocess=lambda c: F.when(c != "skip", c))
    assert rows(out, "i") == [(1, "KEEP", True), (2, "skip", False), (3, None, False)]

    async def wrong(c):
        return c

    with pytest.raises(ValueError):
        mapreduce.map_stages(df, {"x": wrong}, "s")
    mapped = mapreduce.map_documents(df.withColumn("p", F.lit("f")), lambda s, p: s + p if s else None, "p", "s")
    assert rows(mapped.select("i", "s", "changed"), "i") == [(1, "keepf", True), (2, "skipf", True), (3, None, False)]


def test_protected_fields(spark):
    df = spark.createDataFrame([(1, "secret", "text")], "i int, a string, b string")
    out = mapreduce.protect(df, ["a"], lambda d: d.withColumn("b", F.coalesce("a", F.lit("gone"))))
    assert rows(out) == [(1, "secret", "gone")]


def test_repair_loop_stops(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 99)], "i int, need int").withColumn("have", F.lit(0))
    step = lambda d: d.withColumn("have", F.col("have") + 1)
    left = lambda d: d.withColumn("problems", F.when(F.col("have") < F.col("need"), F.array(F.lit("more"))).otherwise(F.array().cast("array<string>")))
    out = mapreduce.repair_loop(df, step, left, rounds=4)
    assert rows(out.select("i", "round", F.size("problems")), "i") == [(1, 1, 0), (2, 3, 0), (3, 4, 1)]


def test_memo(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "i int, s string")
    memo = spark.createDataFrame([("a", "A!")], "key string, value string")
    out, grown = mapreduce.memo_lookup(df, memo, F.col("s"), lambda d: d.withColumn("value", F.upper("s")))
    assert rows(out.select("i", "value")) == [(1, "A!"), (2, "B"), (3, "B")]
    assert rows(grown) == [("a", "A!"), ("b", "B")]


def test_enrichment(spark):
    df = spark.createDataFrame([("x",), ("bad",)], "s string")
    out = mapreduce.enrich_documents(df, lambda p: "no json" if p == "bad" else '{"n": 1}', F.col("s"), "n int")
    assert rows(out.select("s", "answer.n")) == [("bad", None), ("x", 1)]


def test_yaml_round_trip(spark, tmp_path):
    (tmp_path / "gp1-a-b.yaml").write_text("name: a\nitems: [1, 2]\nnote: |\n  two\n  lines\n")
    (tmp_path / "gp2-bad.yaml").write_text("a: [")
    files = readers.whole_files(spark, f"file://{tmp_path}")
    docs = readers.parse_yaml(files, "name string, items array<int>, note string")
    got = {r.name: r for r in docs.collect()}
    assert got["gp1-a-b.yaml"].doc.items == [1, 2] and got["gp2-bad.yaml"].doc is None and got["gp2-bad.yaml"].error
    text = writers.yaml_text(docs.where("error is null").selectExpr("name as file", "doc.items as items", "doc.note as note"), "file")
    assert "note: |" in text.first().yaml
    assert readers.whole_files(spark, f"file://{tmp_path}/none").count() == 0
    assert rows(readers.contents_map(files).select(F.size("contents"))) == [(2,)]


def test_json_xml_tsv(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "b.json").write_text("not json")
    df = readers.read_json_arrays(spark, [f"file://{tmp_path}/a.json", f"file://{tmp_path}/b.json"], "a int")
    got = df.collect()
    assert sorted(r.a for r in got if r.a is not None) == [1, 2] and sum(r._corrupt_record is not None for r in got) == 1
    (tmp_path / "w.xml").write_text("<d><entry><id>1</id><keb>x</keb><keb>y</keb></entry><entry><id>2</id></entry></d>")
    assert rows(readers.read_xml(spark, f"file://{tmp_path}/w.xml", "entry", "id int, keb array<string>")) == [(1, ["x", "y"]), (2, None)]
    (tmp_path / "v.tsv").write_text("word\treading\tsense 1\tsense 2\tsense 3\nw\tr\ta\t\tc\n")
    assert rows(readers.vocabulary(readers.read_tsv(spark, f"file://{tmp_path}/v.tsv"), "N5")) == [("w", "r", ["a", "c"], "N5")]


def test_zip_round_trip(spark, tmp_path):
    made = writers.zip_by_group(spark.createDataFrame([("g", "a.txt", "1"), ("g", "b.txt", "x"), ("h", "c.txt", "3")], "g string, name string, data string"), "g", "name", "data")
    assert rows(writers.write_files(made.withColumn("file", F.concat("g", F.lit(".zip"))), "file", "archive", f"file://{tmp_path}/z").select("name")) == [("g.zip",), ("h.zip",)]
    (tmp_path / "z" / "bad.zip").write_text("no zip")
    entries = readers.zip_entries(spark, f"file://{tmp_path}/z")
    assert entries.where("error is not null").count() == 1
    out = readers.map_entries(entries.where("error is null"), lambda b: str(int(b) + 1).encode())
    got = {r.entry: (r.data and bytes(r.data), r.error) for r in out.collect()}
    assert got["a.txt"] == (b"2", None) and got["b.txt"][0] is None and "ValueError" in got["b.txt"][1]
    with zipfile.ZipFile(io.BytesIO((tmp_path / "z" / "h.zip").read_bytes())) as z:
        assert z.namelist() == ["c.txt"]


def test_changed_rows_only(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, None)], "k int, v string")
    assert rows(writers.changed_rows(new, old, "k", ["v"])) == [(2, "c"), (3, None)]
    path = f"file://{tmp_path}/t"
    writers.write_changed(old, path, "k")
    writers.write_changed(writers.changed_rows(new, old, "k", ["v"]), path, "k")
    assert rows(spark.read.parquet(path).select("k", "v"), "k") == [(1, "a"), (2, "c"), (3, None)]


def test_flashcards_and_html(spark):
    fields = "u001f".join(["name", "desc", "meaning"] + [""] * 6 + ["j1", "e1", "", ""])
    card = readers.flashcards(spark.createDataFrame([(fields,)], "f string"), "f").first().card
    assert (card.name, card.meaning, [tuple(e) for e in card.examples]) == ("name", "meaning", [("j1", "e1")])
    html = "<table><tr><th>A</th><td> b </td></tr><tr><td>c</td></tr></table>"
    assert spark.createDataFrame([(html,)], "h string").select(readers.html_bullets(F.col("h"))).first()[0] == "- A | b\n- c"
    page = spark.createDataFrame([("<title>x (JLPT N3)</title><script id=grammar-data>{}</script><li>a</li>",)], "h string")
    assert tuple(readers.html_record(page, "h").select("title", "jlpt", "payload", "items").first()) == ("x (JLPT N3)", "N3", "{}", ["a"])


def test_slot_reducer(spark):
    data = [("s", "t", "BEGIN", 1.0, 1), ("s", "t", "FINISH", 3.5, 2), ("s", "t", "FINISH", 4.0, 3), ("u", "t", "ERROR", 9.0, 4)]
    df = spark.createDataFrame(data, "slot_key string, item_type string, type string, time double, seq long")
    assert rows(events.slot_elapsed(df).select("slot_key", "time", "elapsed")) == [("s", 3.5, 2.5), ("s", 4.0, 0.5), ("u", 9.0, 0.0)]


def test_slot_stream(spark, tmp_path):
    """Eviction by event time and the closing totals equal the batch form, whatever the batches."""
    data = [
        ("s", "BEGIN", "a", 1.0), ("s", "FINISH", "b", 3.5), ("u", "ERROR", "c", 9.0), ("s", "FINISH", "b", 4.5), ("s", "ERROR", "d", 9.5), ("v", "BEGIN", "a", 10.0),
        ("v", "OTHER", "a", 10.5), ("u", "FINISH", "e", 11.0), ("v", "FINISH", "z", 30.0), ("s", "BEGIN", "a", 40.0), ("s", "FINISH", "a", 41.25), ("w", "BEGIN", "a", 50.0), ("x", "FINISH", "a", 49.5), ("x", "BEGIN", "a", 51.0),
    ]
    schema = "slot_key string, type string, item_type string, time double, seq long"
    table = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], schema).withColumn("ts", F.timestamp_millis((F.col("time") * 1000).cast("long")))
    table.repartition(4, "seq").write.parquet(f"{tmp_path}/in")
    for k in range(4):
        table.where((F.col("seq") / 4).cast("int") == k).coalesce(1).write.parquet(f"{tmp_path}/ordered/part={k}")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/ordered")
    store, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(store, events.ROCKSDB)
    try:
        with_room, close = events.closed(stream, "ts", "1 second", f"{tmp_path}/c")
        out = events.run_available(events.slot_stream(with_room, 2.0), "slots", str(tmp_path), close)
    finally:
        spark.conf.set(store, before)
    got = out.groupBy("slot_key", "item_type").agg(F.sum("n").alias("n"), F.sum("elapsed").alias("elapsed"))
    want = events.slot_elapsed(table, 2.0).groupBy("slot_key", "item_type").agg(F.count("*").alias("n"), F.sum("elapsed").alias("elapsed"))
    assert rows(got) == rows(want) == [("s", "a", 3, 4.75), ("s", "d", 1, 0.0), ("u", "c", 2, 2.0), ("v", "a", 1, 20.0), ("x", "a", 1, 0.0)]
    assert rows(events.slot_elapsed(table).where("slot_key = 's'").select("item_type", "elapsed"), "elapsed") == [("a", 1.0), ("a", 1.25), ("a", 2.5), ("a", 5.0)]
    assert out.where("why = 'evicted'").count() >= 2 and out.where("why = 'closed'").count() <= 1


def test_slot_state_calls_do_not_grow_with_slots():
    """A bucket's state is read and written whole: as many calls for many slots and events as for few."""
    import pandas as pd

    class State:
        def __init__(self, calls):
            self.calls, self.held = calls, []

        def exists(self):
            self.calls.append("exists")
            return bool(self.held)

        def get(self):
            self.calls.append("get")
            return iter(self.held) if self.many else self.held[0]

        def appendValue(self, value):  # noqa: N802
            self.calls.append("append")
            self.held.append(value)

        def appendList(self, values):  # noqa: N802
            self.calls.append("append")
            self.held += values

        def put(self, values):
            self.calls.append("put")
            self.held = list(values)

        def update(self, value):
            self.calls.append("update")
            self.held = [value]

        def clear(self):
            self.calls.append("clear")
            self.held = []

    class Handle:
        def __init__(self):
            self.calls, self.timers = [], set()

        def state(self, many):
            made = State(self.calls)
            made.many = many
            return made

        def getListState(self, name, schema):  # noqa: N802
            return self.state(True)

        def getValueState(self, name, schema):  # noqa: N802
            return self.state(False)

        def registerTimer(self, at):  # noqa: N802
            self.calls.append("timer")
            self.timers.add(at)

    class Mark:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):  # noqa: N802
            return self.ms

    def run(n):
        handle, slots = Handle(), events.Slots(2.0)
        slots.init(handle)
        rows = [(f"s{k}", "ab"[k % 2], kind, at, at * n + k) for at, kind in ((1, "BEGIN"), (2, "FINISH"), (3, "ERROR"), (9, "FINISH")) for k in range(n)]
        part = pd.DataFrame([(s, i, kind, float(at), seq) for s, i, kind, at, seq in rows], columns=["slot_key", "item_type", "type", "time", "seq"])
        list(slots.handleInputRows((0,), iter([part]), Mark(0)))
        out = []
        for ms in (2500, 4500, 8000, events.BEYOND_MS):
            if any(t <= ms for t in handle.timers):
                handle.timers = {t for t in handle.timers if t > ms}
                out += [r for frame in slots.handleExpiredTimer((0,), Mark(ms), None) for r in frame.itertuples(index=False, name=None)]
        return sorted(out), len(handle.calls)

    (few, calls), (many, more) = run(3), run(300)
    assert few == sorted(r for k in range(3) for r in ((f"s{k}", "ab"[k % 2], 2, 2.0, "evicted"), (f"s{k}", "ab"[k % 2], 1, 0.0, "closed")))
    assert len(many) == 600 and more == calls


def test_slot_stream_with_many_slots_in_a_bucket(spark, tmp_path):
    import random

    rng = random.Random(4)
    data = [(rng.choice([*(f"s{k}" for k in range(25)), None]), rng.choice(["BEGIN", "FINISH", "ERROR", "OTHER", None]), rng.choice("abc"), rng.randint(4, 400) / 4, i) for i in range(500)]
    data.sort(key=lambda r: r[3] + rng.random() * 3)  # late by less than the delay
    table = spark.createDataFrame(data, "slot_key string, type string, item_type string, time double, seq long").withColumn("ts", F.timestamp_millis((F.col("time") * 1000).cast("long")))
    place = {r[4]: k for k, r in enumerate(data)}
    for k in range(3):
        table.where(F.col("seq").isin([s for s, at in place.items() if at * 3 // len(data) == k])).coalesce(1).write.parquet(f"{tmp_path}/in/part={k}")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    store, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(store, events.ROCKSDB)
    try:
        with_room, close = events.closed(stream, "ts", "5 seconds", f"{tmp_path}/c")
        out = events.run_available(events.slot_stream(with_room, 2.0, buckets=2), "slots", str(tmp_path), close)
    finally:
        spark.conf.set(store, before)
    got = out.groupBy("slot_key", "item_type").agg(F.sum("n").alias("n"), F.sum("elapsed").alias("elapsed"))
    want = events.slot_elapsed(table.fillna("", ["slot_key"]), 2.0).groupBy("slot_key", "item_type").agg(F.count("*").alias("n"), F.sum("elapsed").alias("elapsed"))
    assert rows(got) == rows(want)
    assert out.where("why = 'evicted'").count() > 0


def test_event_stream_reads_a_folder_of_files(spark, tmp_path):
    from tessella.plans import events as plans

    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    table.repartition(3).write.parquet(f"{tmp_path}/many/events.parquet")
    (tmp_path / "one").mkdir()
    (tmp_path / "one/events.parquet").write_bytes(next((tmp_path / "many/events.parquet").glob("part-*.parquet")).read_bytes())
    counted = lambda d, name: events.run_available(plans._stream(spark, f"{tmp_path}/{d}"), name, str(tmp_path)).count()
    assert counted("many", "a") == table.count()
    assert 0 < counted("one", "b") < table.count()


def test_bounded_label_samples(spark):
    """Samples are the rows of least hash; rates count the samples' rows only."""
    import hashlib

    truth = [(d, "a") for d in range(300)] + [(d, "b") for d in range(250, 290)] + [(d, "c") for d in range(5)]
    predicted = [(d, "b") for d in range(280)] + [(d, "z") for d in range(300)]
    frame = lambda r: spark.createDataFrame(r, "doc int, label string")
    sample = sorted(range(300), key=lambda d: hashlib.md5(f"a|{d}".encode()).hexdigest())[:100]
    shared = [d for d in sample if d < 280]
    got = metrics.merge_candidates(frame(truth), frame(predicted), "doc", "label", rate=0.1).collect()
    assert [tuple(r) for r in got] == [("a", "b", len(shared), 300, 40, round(len(shared) / 100, 6), round(len(shared) / 40, 6), round((len(shared) / 100 + len(shared) / 40) / 2, 6), shared[:3])]


def test_nearest_strings_equal_all_pairs(spark):
    import random

    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    right = [word(rng.randint(0, 12)) for _ in range(120)] + ["zz", "q"]
    left = [word(rng.randint(0, 14)) for _ in range(60)] + right[:5] + ["", "x", "yyyyyyyy", "zzz", right[7] + "ab", None]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def score(a, b):
        d = distance(a, b)
        return (-(1 - d / max(len(a), len(b))) if a or b else -1.0, b, d)

    one = lambda r, c: spark.createDataFrame([(x,) for x in r], f"{c} string")
    got = {r["k"]: (r["nearest"], r["distance"], r["ratio"]) for r in nearest.nearest(one(left, "k"), "k", one([*right, None], "o"), "o").collect()}
    want = {}
    for a in {x for x in left if x is not None}:
        r, b, d = min(score(a, b) for b in set(right))
        want[a] = (b, d, round(-r, 6))
    assert got == want
    assert [tuple(r) for r in nearest.nearest(one(["a"], "k"), "k", one([None], "o"), "o").collect()] == [("a", None, None, None)]


def test_models(spark):
    docs = spark.createDataFrame([(i, "good fine nice" if i % 2 else "bad poor awful", i % 2) for i in range(60)], "i long, t string, y int")
    scored = models.one_label(docs, "t", "y")(docs)
    assert scored.where("(score >= 0.5) <> (y = 1)").count() == 0
    assert 5 < models.hash_split(docs, "i", 0.3).where("held_out").count() < 35
    half = docs.withColumn("y", F.when(F.col("i") < 30, F.col("y")))
    assert models.self_training(half, "t", "y", confident=0.6).where("y is null").count() < 30
    vectors = spark.createDataFrame([(i, [float(i % 3), float(i % 5), 0.0]) for i in range(30)], "k long, v array<double>")
    assert models.intrinsic_dimension(vectors, "v")[0.99] == 2
    scores = spark.createDataFrame([(1, "a", 0.9), (1, "b", 0.2), (2, "a", 0.1)], "d int, label string, score double")
    assert rows(models.predict_labels(scores, "d", 0.5, "z")) == [(1, ["a"]), (2, ["z"])]


def test_lookups_and_merges(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "i int, k string")
    table = spark.createDataFrame([("a", 10)], "key string, v int")
    assert rows(rel.checked_lookup(left.where("k = 'a'"), table, "k", "key").select("i", "v")) == [(1, 10)]
    with pytest.raises(Exception, match="no match for b"):
        rel.checked_lookup(left, table, "k", "key").collect()
    groups = spark.createDataFrame([("x", i) for i in (5, 3, 9, 1)] + [("y", 2)], "k string, m int")
    assert rows(rel.duplicate_groups(groups, "k", "m", most=3)) == [("x", 4, 1, 9, [1, 3, 5])]
    assert rows(rel.numbered(groups, [F.col("m")], "pos").select("pos", "m")) == [(0, 1), (1, 2), (2, 3), (3, 5), (4, 9)]
    assert rel.with_marker(spark.createDataFrame([(["ichi1"],), ([],), (None,)], "m array<string>"), "m").count() == 1


def test_model_bundle(spark, tmp_path):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    points = spark.createDataFrame([([0.0, 1.0],), ([1.0, 0.0],)], "v array<double>").select(array_to_vector("v").alias("features"))
    fitted = KMeans(k=2, seed=1).fit(points)
    models.save_bundle(f"file://{tmp_path}/b", {"themes": fitted}, {"threshold": 0.5}, spark)
    loaded, settings = models.load_bundle(f"file://{tmp_path}/b", spark)
    assert settings == {"threshold": 0.5}
    assert [list(c) for c in loaded["themes"].clusterCenters()] == [list(c) for c in fitted.clusterCenters()]


def test_annotated_words(spark):
    entries = spark.createDataFrame([("犬", "いぬ", ["dog, hound (big)"]), ("カメラ", "かめら", ["camera"]), ("走る", "はしる", ["to run, to jog"]), (None, "x", ["y"])], "word string, reading string, senses array<string>")
    index = vocabulary.dictionary_index(entries)
    assert ("犬|いぬ", ["dog", "hound"]) in rows(index) and ("いぬ", ["dog", "hound"]) in rows(index)
    assert ("走る|はしる", ["jog", "run"]) in [(k, [s.strip() for s in v]) for k, v in rows(index)]
    lines = [(1, "Dogs hound the camera, running!", ["犬|いぬ", "かめら"]), (2, "", []), (3, None, ["かめら"]), (4, "the dog", [])]
    got = vocabulary.annotated(spark.createDataFrame(lines, "i int, e string, k array<string>"), "i", "e", "k", index)
    assert rows(got) == [(1, "Dogs[犬|いぬ] hound[犬|いぬ] the camera[かめら], running!"), (2, ""), (3, None), (4, "the dog")]
    tokens = [(["私", "、", "犬", "。"], ["代名詞", vocabulary.SYMBOL, "名詞", vocabulary.SYMBOL])]
    struct = F.transform(F.arrays_zip("surface", "pos"), lambda t: t)
    assert rows(spark.createDataFrame(tokens, "surface array<string>, pos array<string>").select(vocabulary.spaced(struct).alias("s"))) == [("私、犬。",)]


def test_constraint_violations(spark):
    data = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, "b", " "), (4, None, "y")], "k int, t string, m string")
    found = vocabulary.constraint_violations(data, "k", ["t"], ["m"])
    assert rows(found) == [("m", "missing", None, 2, 2), ("t", "duplicate", "a", 1, 2)]
    with pytest.raises(ValueError, match="missing m"):
        vocabulary.require_valid(found)
    vocabulary.require_valid(vocabulary.constraint_violations(data.where("k = 1"), "k", ["t"], ["m"]))


def test_dictionary_xml(spark, tmp_path):
    (tmp_path / "d.xml").write_text("""<D><entry><ent_seq> 7 </ent_seq><k_ele><keb>犬</keb><ke_pri>news1</ke_pri><ke_pri>ichi1</ke_pri></k_ele><r_ele><reb>いぬ</reb><re_pri>ichi1</re_pri></r_ele>
      <sense><pos>n</pos><gloss xml:lang="eng">dog</gloss><gloss>dog</gloss><example><ex_sent xml:lang="jpn"> 犬だ。 </ex_sent><ex_sent xml:lang="eng">A dog.</ex_sent></example>
      <example><ex_sent xml:lang="jpn">猫だ。</ex_sent></example></sense><sense><pos>adj</pos><pos>n</pos></sense></entry>
      <entry><ent_seq>8</ent_seq><k_ele><keb>稀</keb></k_ele></entry></D>""", encoding="utf-8")  # fmt: skip
    entries = readers.read_xml(spark, str(tmp_path / "d.xml"), "entry", readers.ENTRY)
    assert rows(readers.dictionary_entries(entries)) == [("7", ["犬"], ["いぬ"], ["ichi1", "news1"], ["adj", "n"], ["dog", "dog"])]
    assert rows(readers.example_pairs(entries)) == [("犬だ。", "A dog.")]


def test_files_by_stem_lists_summaries_and_publishing(spark, tmp_path):
    files = spark.createDataFrame([("in/a.yaml",), ("in/b.yaml",)], "path string")
    others = spark.createDataFrame([("x/notes/a.txt",), ("x/hints/a.json",), ("x/notes/c.txt",)], "path string")
    assert rows(readers.by_stem(files, others)) == [("in/a.yaml", ["--hints=x/hints/a.json", "--notes=x/notes/a.txt"]), ("in/b.yaml", [])]
    writers.write_file_list(others, "path", f"{tmp_path}/list")
    assert sorted(readers.file_list(spark, f"{tmp_path}/list")) == sorted(r.path for r in others.collect())
    one = spark.createDataFrame([(3, "é")], "n int, name string")
    assert writers.write_summary(one, str(tmp_path)) and rows(spark.read.json(f"{tmp_path}/summary")) == [(3, "é")]
    assert not writers.write_summary(one.where("n > 3"), f"{tmp_path}/none") and not (tmp_path / "none").exists()
    (tmp_path / "f.txt").write_text("x")
    with pytest.warns(UserWarning, match="does not exist"):
        assert writers.publish(spark, [f"{tmp_path}/f.txt", f"{tmp_path}/g.txt"], f"{tmp_path}/out") == [f"{tmp_path}/g.txt"]
    assert (tmp_path / "out" / "f.txt").read_text() == "x"


def test_retries_and_variants():
    calls = []

    def shaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise ValueError("RESOURCE_EXHAUSTED" if len(calls) == 1 else "no")
        return prompt.upper()

    assert mapreduce.retrying(shaky, backoff=0)("a") == "A" and len(calls) == 3
    with pytest.raises(ZeroDivisionError):
        mapreduce.retrying(lambda p: 1 / 0, retries=2)("a")
    with pytest.raises(RuntimeError):
        mapreduce.retrying(lambda p: (_ for _ in ()).throw(ValueError("RESOURCE_EXHAUSTED")), retries=2, backoff=0)("a")
    accept = lambda a: a if a.endswith("1") else 1 / 0
    assert mapreduce.variants(lambda p: p, accept)("p") == "p1"
    assert mapreduce.variants(lambda p: p, lambda a: 1 / 0, tries=2)("p") is None
    with pytest.raises(ZeroDivisionError):
        mapreduce.variants(lambda p: p, lambda a: 1 / 0)("p")


def test_neighbours_in_small_blocks_and_no_block_through_the_driver(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(5)
    v = rng.normal(size=(230, 6))
    v[50:70] = v[3]  # copies
    spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").write.parquet(f"{tmp_path}/v")
    table = spark.read.parquet(f"{tmp_path}/v")
    u = v / np.sqrt((v * v).sum(1, keepdims=True))
    cosine = np.round(u @ u.T, 5)
    want = []
    for q in range(0, 230, 5):
        best = sorted((-cosine[q, j], j) for j in range(230) if j != q)[:4]
        want += [(q, r, j, round(-c, 5)) for r, (c, j) in enumerate(best, 1)]
    for each, queries_each in ((9, 4), (1000, 1000)):
        got = models.neighbours(table, table.where("id % 5 = 0"), "id", "v", 4, each, queries_each)
        assert [(r["query"], r["rank"], r["id"], round(r["cosine"], 5)) for r in got.orderBy("query", "rank").collect()] == want
        assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_grams_are_counted_where_they_are_made(spark):
    docs = spark.createDataFrame([(i, f"a b c{i % 3} a b") for i in range(9)], "doc_id long, text string")
    weights = models.tf_idf(models.word_grams(docs, "doc_id", "text"), "doc_id", 9, max_df=1.0)
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning(doc_id" in line and "term" in line]
    assert weights.where("term = 'a b'").count() == 9


def test_reachability_sends_no_pairs_through_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    plans, before = [], DataFrame.checkpoint

    def kept(self, *args, **kw):
        out = before(self, *args, **kw)
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(DataFrame, "checkpoint", kept)
    edges = spark.createDataFrame([(i, i // 2) for i in range(2, 20)], "src long, dst long")
    found = graph.reachability(edges)
    assert rows(found.where("src = 19")) == [(19, 1), (19, 2), (19, 4), (19, 9)]
    # Sizes are known at run time only: without the hint a round may turn its joins into broadcasts.
    assert sum("SortMergeJoin" in p for p in plans) > 3 and not any("Broadcast" in p for p in plans)


def test_annotated_words_stay_with_their_document(spark):
    """Only different keys and their senses become rows; occurrences of words do not."""
    index = spark.createDataFrame([("a|r", ["x", "y"]), ("b|r", ["x"])], "key string, senses array<string>")
    rows = spark.createDataFrame([(1, "X ys, xing x", ["a|r", "b|r", "a|r", None]), (2, None, ["a|r"]), (3, "x", None), (4, "", [])], "i int, e string, k array<string>")
    out = vocabulary.annotated(rows, "i", "e", "k", index)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 2
    assert {r["i"]: r["annotated"] for r in out.collect()} == {1: "X[a|r] ys[a|r], xing[a|r] x[a|r]", 2: None, 3: "x", 4: ""}


def test_partitions_follow_the_rows(spark, monkeypatch):
    """A task's share stays the same as the tables grow, whatever number of partitions the session has."""
    from tessella.operators import relational
    from tessella.plans import relational as plans

    small = "/root/testdata/sf0.001"
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert relational.partitions_for(spark.range(1000)) == few
    monkeypatch.setattr(relational, "ROWS_EACH", 100)
    n = relational.partitions_for(spark.read.parquet(f"{small}/lineitem.parquet"))
    assert n > 2 * few
    for query in (plans.second_highest_labels, plans.set_relation_buckets, plans.multilabel_metrics):
        plan = query(spark, small)._jdf.queryExecution().executedPlan().toString()
        assert f", {n}), REPARTITION_BY_NUM" in plan and f", {few}), ENSURE_REQUIREMENTS" not in plan.split("[label", 1)[0]


def test_label_pairs_meet_in_one_aggregation_and_nulls_stay_apart(spark):
    from tessella.operators import metrics

    truth = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (None, "a"), (3, "c")], "d int, l string")
    predicted = spark.createDataFrame([(1, "b"), (1, "b"), (1, "a"), (2, None), (None, "a"), (4, "c"), (3, "c"), (3, "d")], "d int, l string")
    out = metrics.set_relations(truth, predicted, "d", "l")
    # 1 is perfect, 3 partial; 2, 4 and the document without a name share nothing.
    assert out.first().asDict() == {"n_perfect": 1, "n_partial": 1, "n_miss": 3, "n_over": 2, "n_under": 0}
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_strings_with_an_equal_one_are_not_probed(spark, monkeypatch):
    """Probing all strings, most of which the other table has, took most of the time."""
    from tessella.operators import nearest

    scored = []
    best = nearest._best
    monkeypatch.setattr(nearest, "_best", lambda pairs: scored.append({r["a"] for r in pairs.collect()}) or best(pairs))
    left = spark.createDataFrame([(w,) for w in ("stone", "stone", "", "brick", "woods", None)], "w string")
    right = spark.createDataFrame([(w,) for w in ("stone", "stones", "", "bricks", "trick", "wood", None)], "o string")
    rows = {r["w"]: (r["nearest"], r["distance"], r["ratio"]) for r in nearest.nearest(left, "w", right, "o").collect()}
    assert rows == {"stone": ("stone", 0, 1.0), "": ("", 0, 1.0), "brick": ("bricks", 1, 0.833333), "woods": ("wood", 1, 0.8)}
    assert set().union(*scored) == {"brick", "woods"}
