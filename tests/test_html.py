"""Element tables and lesson records."""

from pyspark.sql import functions as F

from tessella.sources import html

ITEM = '<li class="x writeup-example"><div class="writeup-example--japanese">{0}</div><div class="writeup-example--english">( {1} ) .</div></li>'
FRIEND = "<li><p> {0} </p><p>{1}</p></li>"
PAGE = (
    "<html><head><title>～てこそ (JLPT N2) | x</title><script>if (a < b) '</p>';</script></head><body><h1>Other</h1><h2>no</h2><h1> ～てこそ </h1><h2>only <b>if</b></h2>"
    '<div class="writeup-body">First <p>line &amp; more<br>' + ITEM.format("だめ", "inside") + "</div>"
    '<div id="examples">' + ITEM.format("<ruby>日</ruby>本", "Japan") + '</div><div id="details"></div><ul><li><h4>Register</h4><p>Formal</p></li><li><h4>Use</h4><p>Written<p></li></ul>'
    '<div id="antonyms"><ul>' + FRIEND.format("ない", "not") + '</ul></div><div id="synonyms"><ul>' + FRIEND.format("から", "from") + FRIEND.format("ので", "as") + "</ul></div></body></html>"
)


def test_elements_nest(spark):
    df = spark.createDataFrame([(1, "<div id='a'><p class='b c'>x<br>y<p>z</div>t</div><i/>"), (2, None), (3, "")], "k int, h string")
    rows = [tuple(r) for r in html.elements(df, "k", "h").orderBy("k", "n").collect()]
    assert [(r[1], r[2], r[3], r[4], r[5], r[8], r[9]) for r in rows] == [
        (0, 6, None, 0, "div", "div", None), (1, 6, 0, 1, "p", "div/p", None), (2, 2, 1, 2, "#text", "div/p/#text", "x"), (3, 3, 1, 2, "br", "div/p/br", None),
        (4, 4, 1, 2, "#text", "div/p/#text", "y"), (5, 6, 1, 2, "p", "div/p/p", None), (6, 6, 5, 3, "#text", "div/p/p/#text", "z"), (7, 7, None, 0, "#text", "#text", "t"), (8, 8, None, 0, "i", "i", None),
    ]
    assert rows[0][6] == "a" and rows[1][7] == "b c"


def test_lesson_records(spark):
    few = PAGE.replace("writeup-example", "other", 1)
    pages = [(1, PAGE), (2, few.replace('id="examples"', "").replace(ITEM.format("<ruby>日</ruby>本", "Japan"), "")), (3, "<p>none</p>"), (4, None), (5, PAGE.replace('id="details"', ""))]
    out = {r["k"]: r for r in html.lesson_records(spark.createDataFrame(pages, "k int, h string"), "k", "h").collect()}
    assert {k: r["error"] for k, r in out.items()} == {1: None, 2: "examples", 3: "title", 4: "title", 5: "details"}
    assert out[2]["record"] is None
    r = out[1]["record"].asDict(recursive=True)
    assert r == {
        "name": "～てこそ", "level": "N2", "meaning": "onlyif", "details": {"Register": "Formal", "Use": "Written"}, "writeup": "Firstline & more",
        "examples": [{"japanese": "だめ", "english": "(inside)."}, {"japanese": "日本", "english": "(Japan)."}],
        "false_friends": [{"term": "ない", "meaning": "not", "kind": "antonym"}, {"term": "から", "meaning": "from", "kind": "synonym"}, {"term": "ので", "meaning": "as", "kind": "synonym"}],
    }


def test_outside_and_following(spark):
    table = html.elements(spark.createDataFrame([(1, "<a>1<b>2</b>3</a><b>4</b>")], "k int, h string"), "k", "h")
    out = html.outside(table.where("tag = '#text'"), table.where("tag = 'b'"), "k")
    assert sorted(r["text"] for r in out.collect()) == ["1", "3"]
    found = html.following(table.where("tag = 'a'"), table.where("tag = 'b'"), "k").collect()
    assert [(r["n"], r["after"]) for r in found] == [(2, 0)]
    assert html.texts(table.where("tag = 'a'"), table, "k").select("content").first()[0] == "123"
    assert table.where(html.has_class("z")).count() == 0 and table.where(F.col("tag") == "b").count() == 2
