"""Document sources: directories of YAML or JSON, tables in XML, HTML, TSV, archives and file lists."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions import text as tx


def whole_files(spark: SparkSession, folder: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """path, name, content of a folder's files; an absent folder gives no rows."""
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        found = reader.text(folder, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "path string, name string, content string")
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("content"))


def yaml_json(files: DataFrame) -> DataFrame:
    """path, name, json (keys in the file's order; null for a file that is not YAML) and error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        for batch in batches:
            rows = []
            for path, name, content in zip(batch["path"], batch["name"], batch["content"], strict=True):
                try:
                    rows.append((path, name, json.dumps(yaml.load(content, Loader=loader), ensure_ascii=False, default=str), None))
                except yaml.YAMLError as e:
                    rows.append((path, name, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "name", "json", "error"])

    return files.select("path", "name", "content").mapInPandas(run, "path string, name string, json string, error string")


def parse_yaml(files: DataFrame, schema: str) -> DataFrame:
    """path, name and doc (a struct of ``schema``; null for a file that is not YAML) and error."""
    return yaml_json(files).withColumn("doc", F.from_json("json", schema, {"mode": "PERMISSIVE"})).drop("json")


def read_json_arrays(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The items of files that hold a JSON array; files that are not JSON give a row with _corrupt_record."""
    full = T._parse_datatype_string(schema).add("_corrupt_record", "string")
    return spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").json(paths)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True)


def vocabulary(rows: DataFrame, jlpt: str) -> DataFrame:
    """word, reading, senses (non-empty, in order) and level of vocabulary rows."""
    senses = F.filter(F.array("sense 1", "sense 2", "sense 3"), lambda s: s != "")
    return rows.select("word", "reading", senses.alias("senses"), F.lit(jlpt).alias("jlpt"))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def file_list(spark: SparkSession, path: str) -> list[str]:
    """The paths of a list file (driver side: a list of files, not their rows)."""
    return [r.value for r in spark.read.text(path).where("trim(value) <> ''").collect()]


def listed(spark: SparkSession, path: str) -> DataFrame:
    """path of every line of a list of any size that is not blank."""
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path <> ''")


def with_provenance(rows: DataFrame, name_col: str) -> DataFrame:
    return rows.withColumn("source_path", F.input_file_name()).withColumn("original_name", F.col(name_col))


def cleaned(content: Column) -> Column:
    return tx.normal_spacing(content)


def contents_map(files: DataFrame) -> DataFrame:
    """One row with a map from file name to content."""
    entries = F.array_sort(F.collect_list(F.struct("name", "content")))
    return files.agg(F.map_from_entries(entries).alias("contents"))


def zip_entries(spark: SparkSession, path: str) -> DataFrame:
    """archive, entry, data of zip files; a file that is no archive gives one row with an error."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for info in z.infolist():
                            if not info.is_dir():
                                yield pd.DataFrame([(path, info.filename, z.read(info), None)], columns=["archive", "entry", "data", "error"])
                except zipfile.BadZipFile as e:
                    yield pd.DataFrame([(path, None, None, str(e))], columns=["archive", "entry", "data", "error"])

    return files.mapInPandas(run, "archive string, entry string, data binary, error string")


def map_entries(entries: DataFrame, process) -> DataFrame:
    """Apply ``process(bytes) -> bytes`` to each entry; a failure is recorded, not dropped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for archive, entry, data in zip(batch["archive"], batch["entry"], batch["data"], strict=True):
                try:
                    rows.append((archive, entry, process(bytes(data)), None))
                except Exception as e:  # noqa: BLE001  any failure of a user function belongs to its entry
                    rows.append((archive, entry, None, repr(e)))
            yield pd.DataFrame(rows, columns=["archive", "entry", "data", "error"])

    return entries.select("archive", "entry", "data").mapInPandas(run, "archive string, entry string, data binary, error string")


def flashcards(rows: DataFrame, fields: str) -> DataFrame:
    """Cards of a field string with unit separators: name, meaning, examples (pairs of fields from the tenth on)."""
    f = F.split(F.col(fields), "u001f")
    pairs = F.transform(F.sequence(F.lit(9), F.lit(37), F.lit(2)), lambda i: F.struct(F.get(f, i).alias("japanese"), F.get(f, i + 1).alias("english")))
    return rows.withColumn("card", F.struct(F.get(f, F.lit(0)).alias("name"), F.get(f, F.lit(1)).alias("description"), F.get(f, F.lit(2)).alias("meaning"),
        F.filter(pairs, lambda p: p["japanese"] != "").alias("examples")))


def html_bullets(html: Column) -> Column:
    """Table rows as markdown bullets."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), tx.strip_tags)
    return F.array_join(F.transform(rows, lambda r: F.concat(F.lit("- "), F.array_join(cells(r), " | "))), "\n")


def html_record(pages: DataFrame, html: str) -> DataFrame:
    """title, jlpt, script payload, list items and links of a page."""
    page = F.col(html)
    title = tx.strip_tags(F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1))
    return pages.withColumns({
        "title": F.nullif(title, F.lit("")), "jlpt": F.nullif(F.regexp_extract(title, r"\(JLPT (N[0-9])\)", 1), F.lit("")),
        "payload": F.nullif(F.regexp_extract(page, r"(?is)<script[^>]*id=[\"']?grammar-data[\"']?[^>]*>(.*?)</script>", 1), F.lit("")),
        "items": F.transform(F.regexp_extract_all(page, F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1)), tx.strip_tags),
        "links": F.regexp_extract_all(page, F.lit(r"href=\"([^\"]*)\""), F.lit(1)),
    })


def kanji_levels(lines: DataFrame) -> DataFrame:
    """level and kanji of lines of comma-separated characters, one line per level (in order of ``line``)."""
    return lines.select("line", F.explode(F.split("value", ",")).alias("kanji")).select(F.col("line").alias("level"), F.trim("kanji").alias("kanji")).where("kanji <> ''")


def sample_rows(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """A repeatable sample of n rows."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


# What a dictionary's XML entries hold, for read_xml.
ENTRY = (
    "ent_seq string, k_ele array<struct<keb string, ke_pri array<string>>>, r_ele array<struct<reb string, re_pri array<string>>>, "
    "sense array<struct<pos array<string>, gloss array<string>, example array<struct<ex_sent array<struct<_VALUE string, `_xml:lang` string>>>>>>"
)


def dictionary_entries(entries: DataFrame) -> DataFrame:
    """id, words, readings, frequencies, pos and translations of entries with a frequency marker.

    Frequencies and parts of speech are distinct and sorted, the others stand as in the entry; texts are trimmed, empty ones left out.
    """
    none = F.array().cast("array<string>")

    def texts(column: Column) -> Column:
        return F.transform(F.filter(F.coalesce(column, none), lambda t: t.isNotNull() & (t != "")), tx.trim_space)

    def nested(items: str, field: str) -> Column:
        return texts(F.flatten(F.transform(F.coalesce(items, F.array()), lambda e: F.coalesce(e[field], none))))

    unique = lambda c: F.array_sort(F.array_distinct(c))
    out = entries.select(
        tx.trim_space(F.col("ent_seq")).alias("id"), texts(F.col("k_ele.keb")).alias("words"), texts(F.col("r_ele.reb")).alias("readings"),
        unique(F.concat(nested("k_ele", "ke_pri"), nested("r_ele", "re_pri"))).alias("frequencies"),
        unique(nested("sense", "pos")).alias("pos"), nested("sense", "gloss").alias("translations"),
    )
    return out.where(F.size("frequencies") > 0)


def example_pairs(entries: DataFrame) -> DataFrame:
    """japanese and english of examples that have a sentence in both languages, trimmed; a sentence without text is empty."""
    examples = entries.select(F.explode("sense").alias("s")).select(F.explode("s.example").alias("e")).select(F.col("e.ex_sent").alias("x"))
    first = lambda lang: F.get(F.filter("x", lambda s: s["_xml:lang"] == lang), F.lit(0))
    both = examples.select(first("jpn").alias("j"), first("eng").alias("e")).where("j is not null and e is not null")
    text = lambda side: F.coalesce(tx.trim_space(F.col(f"{side}._VALUE")), F.lit(""))
    return both.select(text("j").alias("japanese"), text("e").alias("english"))


def by_stem(files: DataFrame, others: DataFrame) -> DataFrame:
    """path and arguments of each file: one ``--folder=path`` for every other file of the same stem, by path.

    The stem is the base name up to its last dot, the folder the name of the other file's own directory.
    """
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    folder = F.element_at(F.split("path", "/"), -2)
    named = others.where(F.col("path").contains("/")).select(stem.alias("_stem"), F.struct("path", F.concat(F.lit("--"), folder, F.lit("="), "path").alias("argument")).alias("_a"))
    listed = named.groupBy("_stem").agg(F.array_sort(F.collect_list("_a"))["argument"].alias("arguments"))
    joined = files.select("path", stem.alias("_s")).join(listed, F.col("_s") == F.col("_stem"), "left")
    return joined.select("path", F.coalesce("arguments", F.array().cast("array<string>")).alias("arguments"))
