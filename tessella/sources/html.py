"""Pages as tables of elements, and records read from them by joins.

:func:`elements` turns each page into rows in document order, once: an element has a
number, the number of its last descendant, its parent, depth, path, id and classes; a
text is a row of its own. What lies inside an element is then an interval of numbers,
so sections, lists and texts are joins on the page.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ELEMENT = "n int, last int, parent int, depth int, tag string, id string, classes string, path string, text string"


class _Rows(HTMLParser):
    """Numbers elements and texts; an end tag closes the elements that were left open inside its own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []

    def _add(self, tag: str, attributes: dict, text: str | None) -> int:
        n, parent = len(self.rows), self.open[-1] if self.open else None
        path = f"{self.rows[parent][7]}/{tag}" if parent is not None else tag
        self.rows.append([n, n, parent, len(self.open), tag, attributes.get("id"), attributes.get("class"), path, text])
        return n

    def handle_starttag(self, tag: str, attrs: list) -> None:
        n = self._add(tag, dict(attrs), None)
        if tag not in VOID:
            self.open.append(n)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self._add(tag, dict(attrs), None)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[at]][4] == tag:
                self._leave(at)
                return

    def handle_data(self, data: str) -> None:
        self._add("#text", {}, data)

    def _leave(self, at: int) -> None:
        for n in self.open[at:]:
            self.rows[n][1] = len(self.rows) - 1
        del self.open[at:]

    def finish(self) -> list[list]:
        self.close()
        self._leave(0)
        return self.rows


def elements(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, n, last, parent, depth, tag, id, classes, path and text of every element and text (tag ``#text``); a null page has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page, source in zip(batch["_key"], batch["_html"], strict=True):
                if source is not None:
                    parser = _Rows()
                    parser.feed(source)
                    rows = pd.DataFrame(parser.finish(), columns=[f.split()[0] for f in ELEMENT.split(", ")])
                    rows["parent"] = rows["parent"].astype("Int64")
                    rows.insert(0, "_key", page)
                    yield rows

    flat = pages.select(F.col(key).cast("string").alias("_key"), F.col(html).cast("string").alias("_html")).where("_key is not null")
    out = flat.mapInPandas(run, f"_key string, {ELEMENT}")
    return out.withColumn(key, F.col("_key").cast(pages.schema[key].dataType)).select(key, *[f.split()[0] for f in ELEMENT.split(", ")])


def has_class(name: str) -> Column:
    return F.array_contains(F.split(F.coalesce("classes", F.lit("")), r"\s+"), name)


def inside(rows: DataFrame, outer: DataFrame, key: str, *keep: str) -> DataFrame:
    """Rows that lie inside elements of ``outer``, with its number as ``in_n`` and its columns ``keep``."""
    o = outer.select(F.col(key).alias("_k"), F.col("n").alias("in_n"), F.col("last").alias("_last"), *[F.col(c).alias(f"in_{c}") for c in keep])
    return rows.join(o, (F.col(key) == F.col("_k")) & (F.col("n") > F.col("in_n")) & (F.col("n") <= F.col("_last"))).drop("_k", "_last")


def outside(rows: DataFrame, outer: DataFrame, key: str) -> DataFrame:
    """Rows that lie in none of the elements of ``outer`` and are none of them."""
    o = outer.select(F.col(key).alias("_k"), F.col("n").alias("_n"), F.col("last").alias("_last"))
    return rows.join(o, (F.col(key) == F.col("_k")) & (F.col("n") >= F.col("_n")) & (F.col("n") <= F.col("_last")), "left_anti")


def texts(rows: DataFrame, table: DataFrame, key: str, strip_each: bool = True) -> DataFrame:
    """Rows with ``content``: their texts in order, each stripped or all together."""
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    each = inside(table.where("tag = '#text'").select(key, "n", "text"), rows, key)
    each = each.withColumn("text", strip("text")) if strip_each else each
    joined = each.groupBy(F.col(key).alias("_k"), F.col("in_n").alias("_n")).agg(F.array_join(F.array_sort(F.collect_list(F.struct("n", "text")))["text"], "").alias("content"))
    out = rows.join(joined, (F.col(key) == F.col("_k")) & (F.col("n") == F.col("_n")), "left").drop("_k", "_n")
    return out.withColumn("content", F.coalesce(strip("content"), F.lit("")))


def following(anchors: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The first of ``rows`` after each anchor, as the row's columns and ``after`` (the anchor's number)."""
    a = anchors.select(F.col(key).alias("_k"), F.col("n").alias("after"))
    met = rows.join(a, (F.col(key) == F.col("_k")) & (F.col("n") > F.col("after")))
    first = met.groupBy("_k", "after").agg(F.min_by(F.struct(*rows.columns), "n").alias("r"))
    return first.select("r.*", "after")


# Classes and ids of the sections of a lesson page.
EXAMPLE, EXAMPLE_JAPANESE, EXAMPLE_ENGLISH, WRITEUP = "writeup-example", "writeup-example--japanese", "writeup-example--english", "writeup-body"
DETAILS, ANTONYMS, SYNONYMS = "details", "antonyms", "synonyms"


def lesson_records(pages: DataFrame, key: str, html: str, least: int = 2) -> DataFrame:
    """Lesson pages as records: name and level of the title, meaning, details, writeup, examples, false friends.

    A page without what a lesson must have is an error row: its record is null and
    ``error`` names the first thing that is missing.
    """
    table = elements(pages, key, html).checkpoint()
    tagged = table.where("tag <> '#text'")
    titles = texts(tagged.where("tag = 'title'"), table, key).groupBy(key).agg(F.min_by("content", "n").alias("title"))
    parts = lambda i: F.trim(F.regexp_extract("title", r"(.+?) \(JLPT (N\d+)\)", i))
    titles = titles.select(key, F.nullif(parts(1), F.lit("")).alias("name"), F.nullif(parts(2), F.lit("")).alias("level"))
    # Examples: an element for either language inside each item, and the pair in the item's order.
    items = tagged.where((F.col("tag") == "li") & has_class(EXAMPLE))
    side = lambda c: texts(inside(tagged.where((F.col("tag") == "div") & has_class(c)), items, key), table, key, strip_each=False).groupBy(key, "in_n").agg(F.min_by("content", "n").alias("content"))
    japanese, english = side(EXAMPLE_JAPANESE).withColumnRenamed("content", "japanese"), side(EXAMPLE_ENGLISH).withColumnRenamed("content", "english")
    tidy = F.replace(F.replace(F.replace("english", F.lit("( "), F.lit("(")), F.lit(" )"), F.lit(")")), F.lit(" ."), F.lit("."))
    pairs = japanese.join(english, [key, "in_n"]).withColumn("english", tidy)
    examples = pairs.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("in_n", "japanese", "english"))), lambda e: F.struct(e["japanese"].alias("japanese"), e["english"].alias("english"))).alias("examples"))
    # The writeup is the first body, without the examples in it.
    bodies = tagged.where((F.col("tag") == "div") & has_class(WRITEUP)).groupBy(key).agg(F.min_by(F.struct(*table.columns), "n").alias("r")).select("r.*")
    writeups = texts(bodies, outside(table, items, key), key).select(key, F.col("content").alias("writeup"))
    # The meaning is the first h2 after the heading that has the name.
    heads = texts(tagged.where("tag = 'h1'"), table, key).join(titles, key).where(F.col("content") == F.col("name"))
    heads = heads.groupBy(key).agg(F.min("n").alias("n"))
    meanings = texts(following(heads, tagged.where("tag = 'h2'"), key).drop("after"), table, key).select(key, F.nullif("content", F.lit("")).alias("meaning"))

    def listed(section: str) -> DataFrame:
        lists = following(tagged.where((F.col("tag") == "div") & (F.col("id") == section)), tagged.where("tag = 'ul'"), key).drop("after")
        return inside(tagged.where("tag = 'li'"), lists, key).drop("in_n")

    def field(rows: DataFrame, tag: str, name: str, place: int = 1) -> DataFrame:
        own = texts(inside(tagged.where(F.col("tag") == tag), rows, key), table, key).groupBy(key, "in_n").agg(F.array_sort(F.collect_list(F.struct("n", "content"))).alias("c"))
        return own.select(key, "in_n", F.get("c", F.lit(place - 1))["content"].alias(name))

    rows = listed(DETAILS)
    details = field(rows, "h4", "heading").join(field(rows, "p", "value"), [key, "in_n"])
    details = details.groupBy(key).agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("in_n", "heading", "value"))), lambda e: F.struct(e["heading"], e["value"]))).alias("details"))
    friends = None
    for section, kind in ((ANTONYMS, "antonym"), (SYNONYMS, "synonym")):
        rows = listed(section)
        own = field(rows, "p", "term").join(field(rows, "p", "meaning", 2), [key, "in_n"]).withColumn("kind", F.lit(kind))
        friends = own if friends is None else friends.unionByName(own)
    friends = friends.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("kind", "in_n", "term", "meaning"))), lambda e: F.struct(e["term"].alias("term"), e["meaning"].alias("meaning"), e["kind"].alias("kind"))).alias("false_friends"))
    out = pages.select(key).where(F.col(key).isNotNull()).distinct()
    for part in (titles, meanings, details, writeups, examples, friends):
        out = out.join(part, key, "left")
    missing = F.coalesce(
        F.when(F.col("name").isNull(), "title"), F.when(F.col("meaning").isNull(), "meaning"), F.when(F.col("details").isNull(), "details"),
        F.when(F.col("writeup").isNull(), "writeup"), F.when(F.coalesce(F.size("examples"), F.lit(0)) < least, "examples"),
    )
    return out.select(key, F.when(missing.isNull(), F.struct("name", "level", "meaning", "details", "writeup", "examples", "false_friends")).alias("record"), missing.alias("error"))
