"""Queries that write whole tables by a sink and read them back by its source, each with its oracle SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import lint
from ..operators import mapreduce
from ..sources import readers, writers
from ..streaming.events import stream_folder
from .tables import table


def _folder(spark, label):
    """A new folder that driver and executors share."""
    root = stream_folder(spark)
    return f"{root if ':' in root else 'file://' + root}/{label}-{uuid.uuid4().hex}"


def _write(rows, name, data, folder):
    """Write one file a row; the count runs the sink."""
    writers.write_files(rows, name, data, folder).agg(F.sum("n_bytes")).collect()


def yaml_documents(spark, sf_dir):
    """A YAML file per supplier, every seventh one broken, read back with its name and keys."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(
        k, F.col("s_name").alias("grammar_point"), F.concat(F.lit("first: ü\n"), "s_name", F.lit("\n  third ")).alias("note"),
        F.when(k % 2 == 0, F.array(F.lit("yes"), F.lit("1"), F.col("s_name"))).alias("tags"), F.struct(F.col("s_nationkey").alias("nation")).alias("place"),
    )
    out = writers.yaml_text(s, "s_suppkey").withColumn("data", F.when(F.col("key").cast("long") % 7 == 0, F.lit("a: [")).otherwise(F.col("yaml")))
    folder = _folder(spark, "yaml")
    _write(out.withColumn("name", F.concat("key", F.lit("-a-b.yaml"))), "name", "data", folder)
    read = readers.parse_yaml(readers.whole_files(spark, folder, "*.yaml"), "s_suppkey long, grammar_point string, note string, tags array<string>, place struct<nation: int>")
    named = lint.key_from_name(F.col("name"))
    kept = F.substring_index("path", "/", -1) == F.col("name")
    return read.select(
        named["id"].cast("long").alias("k"), named["grammar_point"].alias("rest"), kept.alias("kept"), F.col("error").isNull().alias("good"), "doc.s_suppkey", "doc.grammar_point",
        F.md5("doc.note").alias("note"), F.array_join("doc.tags", ",").alias("tags"), F.col("doc.place.nation").alias("nation"),
    )


def yaml_key_order(spark, sf_dir):
    """The keys of YAML files in two orders, as read."""
    k = F.col("s_suppkey")
    data = F.when(k % 2 == 0, F.concat(F.lit("name: "), "s_name", F.lit("\nat: {z: 1, a: 2}\n"))).otherwise(F.concat(F.lit("at: {a: 2, z: 1, m: 3}\nname: "), "s_name", F.lit("\n")))
    folder = _folder(spark, "order")
    _write(table(spark, sf_dir, "supplier").select(F.concat(k.cast("string"), F.lit(".yaml")).alias("name"), data.alias("data")), "name", "data", folder)
    read = readers.yaml_json(readers.whole_files(spark, folder))
    keys = lambda json: F.array_join(F.json_object_keys(json), ",")
    return read.select(F.get_json_object("json", "$.name").alias("s_name"), keys(F.col("json")).alias("keys"), keys(F.get_json_object("json", "$.at")).alias("inner"))


def json_arrays(spark, sf_dir):
    """A JSON file per supplier: an array of two, every fifth file cut short; read back as rows."""
    k = F.col("s_suppkey")
    one = lambda i: F.struct(k.alias("k"), F.lit(i).alias("i"), F.concat(F.lit("é\n"), "s_name").alias("name"))
    whole = F.to_json(F.array(one(0), one(1)), {"pretty": "true"})
    data = F.when(k % 5 == 0, F.substring(whole, 1, 8)).otherwise(whole)
    folder = _folder(spark, "json")
    _write(table(spark, sf_dir, "supplier").select(F.concat(k.cast("string"), F.lit(".json")).alias("name"), data.alias("data")), "name", "data", folder)
    rows = readers.read_json_arrays(spark, [folder], "k long, i int, name string")
    return rows.select("k", "i", F.substring_index("name", "\n", -1).alias("name"), F.col("_corrupt_record").isNotNull().alias("corrupt"))


def tsv_vocabulary(spark, sf_dir):
    """All parts as a compressed table with tabs and a header, read back as words with their senses."""
    k = F.col("p_partkey")
    senses = [F.when(k % n == 0, F.lit("")).otherwise(F.col(c)).alias(f"sense {i}") for i, (n, c) in enumerate(((2, "p_brand"), (3, "p_type"), (5, "p_name")), 1)]
    p = table(spark, sf_dir, "part").select(k.cast("string").alias("word"), F.concat(F.lit("よ"), "p_name").alias("reading"), *senses)
    folder = _folder(spark, "tsv")
    p.write.csv(folder, sep="\t", header=True, compression="gzip")
    return readers.vocabulary(readers.read_tsv(spark, folder), "N5").select(F.col("word").cast("long").alias("word"), "reading", F.array_join("senses", "|").alias("senses"), "jlpt")


def _entries(spark, sf_dir):
    """All parts as dictionary entries in compressed XML files, read back."""
    k, name, kind = F.col("p_partkey"), F.col("p_name"), F.col("p_type")
    none = F.lit(None).cast("array<string>")
    marks = F.when(k % 4 != 0, F.array(kind, F.col("p_brand"), kind))
    said = lambda lang, s: F.struct(s.alias("_VALUE"), F.lit(lang).alias("_xml:lang"))
    japanese = said("jpn", F.concat(F.lit("日"), k.cast("string")))
    sentences = F.when(k % 3 != 0, F.array(japanese, said("eng", F.concat(F.lit(" A "), name, F.lit(". "))))).otherwise(F.array(japanese))
    example = F.array(F.struct(sentences.alias("ex_sent")))
    sense = lambda pos, gloss, example: F.struct(F.array(*map(F.lit, pos)).alias("pos"), F.array(*gloss).alias("gloss"), example.alias("example"))
    entries = table(spark, sf_dir, "part").select(
        k.cast("string").alias("ent_seq"), F.array(F.struct(name.alias("keb"), marks.alias("ke_pri")), F.struct(kind.alias("keb"), none.alias("ke_pri"))).alias("k_ele"),
        F.array(F.struct(F.concat(F.lit("よ&"), name).alias("reb"), none.alias("re_pri"))).alias("r_ele"),
        F.array(sense("vn", [name, kind], F.lit(None).cast("array<struct<ex_sent array<struct<_VALUE string, `_xml:lang` string>>>>")), sense("n", [F.col("p_brand")], example)).alias("sense"),
    )
    folder = _folder(spark, "xml")
    writers.write_xml(entries, folder, "entry", "dictionary")
    return readers.read_xml(spark, folder, "entry", readers.ENTRY)


def xml_dictionary(spark, sf_dir):
    out = readers.dictionary_entries(_entries(spark, sf_dir))
    return out.select(F.col("id").cast("long").alias("id"), *[F.array_join(c, "|").alias(c) for c in ("words", "readings", "frequencies", "pos", "translations")])


def xml_examples(spark, sf_dir):
    return readers.example_pairs(_entries(spark, sf_dir))


def flashcard_fields(spark, sf_dir):
    """The lines of every text as the fields of a card after nine others: pairs of a sentence and its translation."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    fields = F.concat(F.array("source", "lang", F.lit("m")), F.array_repeat(F.lit("-"), 6), F.split("text", "\n"))
    cards = readers.flashcards(d.select("doc_id", F.array_join(fields, "u001f").alias("fields")), "fields")
    pairs = F.transform("card.examples", lambda e: F.concat(e["japanese"], F.lit("="), F.coalesce(e["english"], F.lit(""))))
    return cards.select("doc_id", "card.name", "card.description", "card.meaning", F.size("card.examples").alias("n"), F.md5(F.array_join(pairs, "\n")).alias("digest"))


def listed_files(spark, sf_dir):
    """The list of all pages' files, written and read back, each with its companions of the same stem."""
    k = F.col("page_id").cast("string")
    pages = table(spark, sf_dir, "pages")
    folder = _folder(spark, "list")
    writers.write_file_list(pages.select(F.concat(F.lit("in/p"), k, F.lit(".html")).alias("path")), "path", folder)
    notes = pages.where("page_id % 2 = 0").select(F.concat(F.lit("x/notes/p"), k, F.lit(".txt")).alias("path"))
    hints = pages.where("page_id % 3 = 0").select(F.concat(F.lit("x/hints/p"), k, F.lit(".json")).alias("path"))
    return readers.by_stem(readers.listed(spark, folder), notes.unionByName(hints)).select("path", F.array_join("arguments", " ").alias("arguments"))


def summary_file(spark, sf_dir):
    """Totals of all orders, written as a summary and read back."""
    o = table(spark, sf_dir, "orders")
    folder = _folder(spark, "summary")
    writers.write_summary(o.agg(F.count("*").alias("n"), F.max("o_custkey").alias("most"), F.countDistinct("o_orderpriority").alias("kinds")), folder)
    return spark.read.schema("n long, most long, kinds long").json(f"{folder}/summary")


def character_levels(spark, sf_dir):
    """The words of every text as a line of parts with commas, a level each."""
    words = F.array_join(F.split("text", " "), ", ")
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("line"), words.alias("value"))
    return readers.kanji_levels(lines).groupBy("level").agg(F.count("*").alias("n"), F.countDistinct("kanji").alias("kinds"))


def changed_documents(spark, sf_dir):
    """Every eleventh text changed; only changed rows are left."""
    old = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    new = old.withColumn("text", F.when(F.col("doc_id") % 11 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return writers.changed_rows(new, old, "doc_id", ["text", "lang"]).select("doc_id", F.md5("text").alias("digest"))


def changed_partitions(spark, sf_dir):
    """Orders by priority; a second write of the changed ones replaces their priorities' partitions only."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    folder = _folder(spark, "parts")
    writers.write_changed(o, folder, "o_orderpriority")
    writers.write_changed(o.where("o_orderpriority like '1%' and o_orderstatus <> 'F'"), folder, "o_orderpriority")
    return spark.read.parquet(folder).groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total"))


def sentence_prompts(spark, sf_dir):
    """A prompt for every document, written as text files and read back."""
    made = writers.prompt("In {lang} {{x}}: <{text}> {lang}", lang=F.col("lang"), text=F.md5(F.coalesce("text", F.lit(""))))
    folder = _folder(spark, "prompts")
    table(spark, sf_dir, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit("\t"), made).alias("value")).write.text(folder)
    parts = F.split("value", "\t", 2)
    return spark.read.text(folder).select(parts[0].cast("long").alias("doc_id"), parts[1].alias("prompt"))


def report_lines(spark, sf_dir):
    """A line for every order of a late status, written as a report and read back."""
    folder = _folder(spark, "report")
    late = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    writers.report(late, F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(": "), "o_orderpriority"), folder)
    return spark.read.text(folder).select(F.col("value").alias("line"))


def repaired_rows(spark, sf_dir):
    """Rows that need as many rounds as their key says are repaired until none has a problem, or the rounds end."""
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 7).alias("need"), F.lit(0).alias("got"))
    told = F.when(F.col("got") < F.col("need"), F.array(F.lit("not yet"))).otherwise(F.array().cast("array<string>"))
    out = mapreduce.repair_loop(p, lambda rows: rows.withColumn("got", F.col("got") + 1), lambda rows: rows.withColumn("problems", told))
    return out.select("p_partkey", "got", "round", F.size("problems").alias("n"))


SUPPLIER = "select s_suppkey as k, s_suppkey % 7 <> 0 as good, * from supplier"
XML = "select *, p_partkey as id from part"
QUERIES = {
    "yaml_documents": (yaml_documents, f"""with s as ({SUPPLIER}) select k, 'a-b' as rest, true as kept, good, case when good then k end as s_suppkey, case when good then s_name end as grammar_point,
      case when good then md5('first: ü' || chr(10) || s_name || chr(10) || '  third ') end as note, case when good and k % 2 = 0 then 'yes,1,' || s_name end as tags, case when good then s_nationkey end as nation from s"""),
    "yaml_key_order": (yaml_key_order, "select s_name, case when s_suppkey % 2 = 0 then 'name,at' else 'at,name' end as keys, case when s_suppkey % 2 = 0 then 'z,a' else 'a,z,m' end as \"inner\" from supplier"),
    "json_arrays": (json_arrays, """select s_suppkey as k, i::int as i, s_name as name, false as corrupt from supplier, (values (0), (1)) v(i) where s_suppkey % 5 <> 0
      union all select null, null, null, true from supplier where s_suppkey % 5 = 0"""),
    "tsv_vocabulary": (tsv_vocabulary, """select p_partkey as word, 'よ' || p_name as reading, array_to_string(list_filter([case when p_partkey % 2 <> 0 then p_brand end, case when p_partkey % 3 <> 0 then p_type end,
      case when p_partkey % 5 <> 0 then p_name end], lambda x: x is not null), '|') as senses, 'N5' as jlpt from part"""),
    "xml_dictionary": (xml_dictionary, f"""with p as ({XML}) select id, p_name || '|' || p_type as words, 'よ&' || p_name as readings, least(p_type, p_brand) || '|' || greatest(p_type, p_brand) as frequencies,
      'n|v' as pos, p_name || '|' || p_type || '|' || p_brand as translations from p where id % 4 <> 0"""),
    "xml_examples": (xml_examples, "select '日' || p_partkey as japanese, 'A ' || p_name || '.' as english from part where p_partkey % 3 <> 0"),
    "flashcard_fields": (flashcard_fields, """with l as (select doc_id, source, lang, string_split(text, chr(10)) as l from documents where text is not null),
      e as (select *, list_filter(list_transform(range(0, 15), lambda i: {'j': l[2 * i + 1], 'e': l[2 * i + 2]}), lambda p: p.j is not null and p.j <> '') as e from l)
      select doc_id, source as name, lang as description, 'm' as meaning, len(e)::int as n, md5(coalesce(array_to_string(list_transform(e, lambda p: p.j || '=' || coalesce(p.e, '')), chr(10)), '')) as digest from e"""),
    "listed_files": (listed_files, """select distinct 'in/p' || page_id || '.html' as path, concat_ws(' ', case when page_id % 3 = 0 then '--hints=x/hints/p' || page_id || '.json' end,
      case when page_id % 2 = 0 then '--notes=x/notes/p' || page_id || '.txt' end) as arguments from pages"""),
    "summary_file": (summary_file, "select count(*) as n, max(o_custkey) as most, count(distinct o_orderpriority) as kinds from orders"),
    "character_levels": (character_levels, """with w as (select doc_id, unnest(string_split(text, ' ')) as w from documents), p as (select doc_id, trim(unnest(string_split(w, ','))) as w from w)
      select doc_id as level, count(*) as n, count(distinct w) as kinds from p where w <> '' group by 1"""),
    "changed_documents": (changed_documents, "select doc_id, md5(text || '!') as digest from documents where doc_id % 11 = 0 and text is not null"),
    "changed_partitions": (changed_partitions, """select o_orderpriority, o_orderstatus, count(*) as n, sum(o_orderkey)::bigint as total from orders
      where o_orderpriority not like '1%' or o_orderstatus <> 'F' group by 1, 2"""),
    "sentence_prompts": (sentence_prompts, "select doc_id, 'In ' || lang || ' {{x}}: <' || md5(coalesce(text, '')) || '> ' || lang as prompt from documents"),
    "report_lines": (report_lines, "select 'order ' || o_orderkey || ': ' || o_orderpriority as line from orders where o_orderstatus = 'P'"),
    "repaired_rows": (repaired_rows, """with r as (select p_partkey, p_partkey % 7 as need, least(greatest(p_partkey % 7, 1), 5)::int as got from part)
      select p_partkey, got, got as round, case when got < need then 1 else 0 end as n from r"""),
}
