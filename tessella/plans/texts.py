"""Text, token and matcher queries over the test tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lint, matcher, text, tokens
from ..operators import relational as rel
from ..operators import sequence_rules
from ..sources import html as pages_html
from ..sources import readers
from .tables import table


def get_meaning(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    name = F.when(F.col("p_size") % 5 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" (x) ("), F.lower("p_type"), F.lit(")")))
    return p.select("p_partkey", text.meaning(name).alias("meaning"), text.meaning_start_ok(text.meaning(name)).alias("start_ok"))


def strip_quotes(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    quoted = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('"\'"“‘"\''), "p_name", F.lit('\'"’”"\'"'))).when(F.col("p_size") % 3 == 1, F.concat(F.lit('"'), "p_name")).otherwise(F.col("p_name"))
    return p.select("p_partkey", text.strip_quotes(quoted).alias("name"))


def normalize_text(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit("：「"), "p_name", F.lit("」  a + b&emsp;"), "p_type")
    return p.select("p_partkey", text.normal_spacing(text.normal_japanese(raw)).alias("name"))


def english_tokens(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(", "), "p_type").alias("t"))
    return p.select("p_partkey", F.array_join(text.english_tokens(F.col("t")), "|").alias("tokens"))


def sense_parts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    sense = F.concat(F.when(F.col("p_size") % 2 == 0, "to ").otherwise(""), F.lower("p_type"), F.lit(" (rare), "), F.upper("p_name"))
    return p.select("p_partkey", F.array_join(text.sense_parts(sense), ";").alias("parts"))


ENDINGS = (
    " (X", "/", " (ok) [a]", " 7", " (a 7)", " (an I)", " (a Cat)", " ①", " Verb[て]", " Verb[]", " Verb[く]", " Adjective[く]", " Noun[て]", " (a) b", "+", " ~ b", "〜", " {", ")", "([)]",
)


def name_validator(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    name = F.concat("p_name", F.get(F.array(*map(F.lit, ENDINGS)), (F.col("p_partkey") % len(ENDINGS)).cast("int")))
    return p.select("p_partkey", F.array_join(text.valid_name(name), ",").alias("problems"))


def marked_payload(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("x BEGIN\n"), "p_name", F.lit("\nEND y"))).otherwise(F.col("p_name"))
    return p.select("p_partkey", text.marked_payload(raw).alias("payload"))


def safe_filenames(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", text.safe_filename(F.concat("p_name", F.lit("/("), F.col("p_size").cast("string"), F.lit(")"))).alias("name"))


def quote_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.count_of(F.col("text"), '"').alias("n_quotes"), (text.count_of(F.col("text"), '"') > 1).alias("error"))


def memo_keys(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.json_key(F.col("p_name"), F.col("p_size")).alias("key"))


def html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.strip_tags(F.col("html"))).alias("digest"))


def title_extract(spark, sf_dir):
    return readers.html_record(table(spark, sf_dir, "pages"), "html").select("page_id", "title")


def html_links(spark, sf_dir):
    return readers.html_record(table(spark, sf_dir, "pages"), "html").select("page_id", F.array_join("links", " ").alias("links"), F.size("items").alias("n_items"))


def html_elements(spark, sf_dir):
    """How many elements of each tag the pages have, without what scripts and comments hold."""
    e = pages_html.elements(table(spark, sf_dir, "pages"), "page_id", "html")
    return e.where("tag <> '#text'").groupBy("page_id", "tag").agg(F.count("*").alias("n"), F.min("n").alias("first"))


def html_section_texts(spark, sf_dir):
    """The texts of the list items inside navigation, by interval joins."""
    e = pages_html.elements(table(spark, sf_dir, "pages"), "page_id", "html").checkpoint()
    items = pages_html.inside(e.where("tag = 'li'"), e.where("tag = 'nav'"), "page_id").drop("in_n")
    found = pages_html.texts(items, e, "page_id")
    return found.groupBy("page_id").agg(F.array_join(F.array_sort(F.collect_list("content")), "|").alias("items"))


def _words(spark, sf_dir, spread=False):
    """doc_id, line and words of every line of the documents that has one; ``spread``: dealt to all tasks, as a file may be one task."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = (docs.repartition("doc_id") if spread else docs).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t")).select("doc_id", "line", F.lower("t").alias("t"))
    # Asking for a letter, not for the number of words: a filter on the words would make them twice.
    return lines.where(F.col("t").rlike("[a-z]")).select("doc_id", "line", F.regexp_extract_all("t", F.lit("[a-z]+"), F.lit(0)).alias("words"))


def _token(word):
    return tokens.compact_token(F.struct(
        word.alias("surface"), F.when(F.length(word) > 4, "n").otherwise("prt").alias("pos"), F.when(F.length(word) > 6, "common_noun").alias("pos1"),
        F.lit("general").alias("pos2"), F.lit(None).cast("string").alias("ctype"), F.lit(None).cast("string").alias("cform"),
        F.left(word, F.lit(3)).alias("lemma"), F.left(word, F.lit(4)).alias("base"), F.upper(word).alias("pron"),
    ))


def _tokens(spark, sf_dir):
    """Tokens from the words of the documents: (doc_id, line, pos, word, token)."""
    rows = _words(spark, sf_dir).select("doc_id", "line", F.posexplode_outer("words").alias("pos", "word"))  # none is empty; "outer" spares a filter that makes the words again
    return rows.withColumn("token", _token(F.col("word")))


TOKENS = """d as (select doc_id, unnest(string_split(text, chr(10))) as t, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line from documents),
  w as (select doc_id, line::int as line, unnest(regexp_extract_all(lower(t), '[a-z]+')) as word, generate_subscripts(regexp_extract_all(lower(t), '[a-z]+'), 1) - 1 as pos from d),
  t as (select doc_id, line, pos, word, '⌈ˢ' || word || 'ᵖ' || case when length(word) > 4 then 'n' else 'prt' end || case when length(word) > 6 then ':common_noun' else '' end
    || 'ᵇ' || left(word, 4) || case when left(word, 3) <> word then 'ᵈ' || left(word, 3) else '' end || 'ʳ' || upper(word) || '⌉' as token from w),
  s as (select doc_id, line, string_agg(token, '' order by pos) as compact from t group by doc_id, line)"""


def _sentences(spark, sf_dir, spread=False):
    return _words(spark, sf_dir, spread).select("doc_id", "line", F.array_join(F.transform("words", _token), "").alias("compact"))


def compact_encode(spark, sf_dir):
    return _sentences(spark, sf_dir).select("doc_id", "line", F.md5("compact").alias("digest"))


def compact_decode(spark, sf_dir):
    s = _sentences(spark, sf_dir)
    return s.select("doc_id", "line", tokens.plain_text(F.col("compact"), True).alias("spaced"), F.length(tokens.plain_text(F.col("compact"))).alias("n"))


def token_split(spark, sf_dir):
    return _sentences(spark, sf_dir).select("doc_id", "line", F.explode(tokens.split_tokens(F.col("compact"))).alias("token"))


def token_injectivity(spark, sf_dir):
    rows = _tokens(spark, sf_dir).select(F.left("word", F.lit(2)).alias("compact"), F.col("word").alias("raw"))
    return tokens.injectivity_conflicts(rows, "compact", "raw")


def rich_token_parse(spark, sf_dir):
    t = _tokens(spark, sf_dir).select("doc_id", "line", "pos", tokens.parse_token(F.col("token")).alias("t"))
    return t.select("doc_id", "line", F.col("pos").alias("place"), "t.surface", "t.pos", F.array_join("t.details", ":").alias("details"), "t.base", "t.lemma", "t.pron")


def training_text(spark, sf_dir):
    return _sentences(spark, sf_dir).select("doc_id", "line", tokens.training_text(F.col("compact")).alias("text"))


RULES = {"the|ᵇth": "the-then", "and|○○|of": "and-gap", ".*ing": "loose", "to": "to"}


def sequence_classifier(spark, sf_dir):
    found = sequence_rules.labels(F.col("compact"), sequence_rules.rules_from(spark, RULES))
    return _sentences(spark, sf_dir).select("doc_id", "line", F.array_join(found, ",").alias("labels"))


def _benchmark_rules(spark, sf_dir):
    """Rules from the words of the benchmark: neighbours, words with a gap, base forms, parts of words, a word and what follows."""
    w = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    items = table(spark, sf_dir, "benchmark").select("item_id", w.alias("w")).where("size(w) >= 7")
    at = lambda i: F.get("w", F.lit(i))
    kinds = [
        F.concat_ws("|", at(0), at(1)), F.concat_ws("|", at(1), F.lit("○○"), at(2)), F.concat_ws("|", F.concat(F.lit("ᵇ"), F.left(at(3), F.lit(4))), at(4)),
        F.concat(F.lit(".*"), F.left(at(5), F.lit(5))), F.concat(at(6), F.lit(".*|○○|"), at(0)),
    ]
    each = items.select("item_id", F.posexplode(F.array(*kinds)).alias("kind", "rule"))
    return sequence_rules.numbered(each.withColumn("name", F.concat_ws("-", "item_id", "kind")), "item_id", "kind")


def rule_table_labels(spark, sf_dir):
    found = sequence_rules.labels(F.col("compact"), _benchmark_rules(spark, sf_dir))
    return _sentences(spark, sf_dir, spread=True).select("doc_id", "line", F.array_join(found, ",").alias("labels")).where("labels <> ''")


def rule_table_annotation(spark, sf_dir):
    """The sentences that the benchmark's rules change, and how many names they take."""
    n = sequence_rules.names_taken(F.col("compact"), _benchmark_rules(spark, sf_dir))
    return _sentences(spark, sf_dir, spread=True).select("doc_id", "line", n.alias("n")).where("n > 0")


def matcher_basic(spark, sf_dir):
    pattern = matcher.compile_matcher("⌈ˢ~ᵖprt~⌉ {noun}")
    return _sentences(spark, sf_dir).select("doc_id", "line", matcher.match(F.col("compact"), pattern).alias("found"))


def matcher_lookaround(spark, sf_dir):
    pattern = matcher.compile_matcher("{verb-dictionary}|{verb-imperative}|(?<!ʳTHE⌉)⌈ˢ~ingᵖ~⌉")
    return _sentences(spark, sf_dir).select("doc_id", "line", matcher.match(F.col("compact"), pattern).alias("found"))


def rules_in_turn(spark, sf_dir):
    return _sentences(spark, sf_dir).select("doc_id", "line", sequence_rules.annotate(F.col("compact"), sequence_rules.rules_from(spark, {"the": "art", "and": "con"})).alias("annotated"))


def compliance_report(spark, sf_dir):
    """Lines that lack the label they should have: only that label's rules are run."""
    own = {rule: name for rule, name in RULES.items() if name == "to"}
    found = sequence_rules.labels(F.col("compact"), sequence_rules.rules_from(spark, own))
    return _sentences(spark, sf_dir).where(~F.array_contains(found, "to")).select("doc_id", "line", F.lit("to").alias("label"))


def previous_token_histogram(spark, sf_dir):
    words = F.split(F.lower("text"), "[^a-z]+")
    rows = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn", F.md5("text")).alias("g"), F.posexplode(words).alias("pos", "word")).where("word <> ''")
    return rel.previous_histogram(rows, "g", "pos", "word", F.col("word") == "the")


KANA = "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤ"


def kana_keys(spark, sf_dir):
    """Dictionary keys of brands written in katakana, of a word in hiragana, and of brands as they are."""
    p = table(spark, sf_dir, "part")
    word = F.when(F.col("p_size") % 3 == 0, F.translate(F.lower("p_brand"), "abcdefghijklmnopqrstuvwxyz#0123456789", KANA)).when(F.col("p_size") % 3 == 1, "ひらがな").otherwise(F.col("p_brand"))
    return p.select("p_partkey", text.dictionary_key(word, F.lit("よみ")).alias("key"), text.hiragana(word).alias("hiragana"), text.all_hiragana(word).alias("h"), text.all_katakana(word).alias("k"))


def suggestion_prefix(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    name = F.concat(F.when(F.col("p_size") % 3 == 0, "<suggest>:").when(F.col("p_size") % 3 == 1, "<strongly-suggest>:").otherwise(""), "p_brand")
    return p.select("p_partkey", text.suggested(name, F.col("p_brand") < "Brand#3").alias("name"))


def fenced_lines(spark, sf_dir):
    """Whole texts in code fences, each line in white space."""
    lines = F.transform(F.split("text", "\n"), lambda t: F.concat(F.lit("　 "), t, F.lit(" ")))
    fenced = F.concat(F.lit("```json\n"), F.array_join(lines, "\n"), F.lit("\n```"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.rtrim(text.trim_lines(text.without_fences(fenced)), F.lit("\n"))).alias("digest"))


def geminates(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", tokens.geminate_fix(F.concat("p_name", F.lit(" っ "), "p_type")).alias("name"))


def markdown_bullets(spark, sf_dir):
    """The pages' list items as tables of two columns, and those as bullets."""
    cells = F.transform(F.regexp_extract_all("html", F.lit("(?is)<li[^>]*>(.*?)</li>"), F.lit(1)), lambda x: F.concat(F.lit("<tr><td>k</td><td>"), x, F.lit("</td></tr>")))
    pages = table(spark, sf_dir, "pages").withColumn("t", F.concat(F.lit("<table>"), F.array_join(cells, ""), F.lit("</table>")))
    return pages.select("page_id", F.md5(readers.html_bullets(F.col("t"))).alias("digest"))


def training_extraction(spark, sf_dir):
    """Lines as own and competing sentences of a point per language, held against its matcher."""
    s = _sentences(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    line = F.col("line") % 2 == 0
    none = F.array().cast("array<string>")
    example = F.struct(
        F.when(line, F.array(F.concat(F.lit("{"), "compact", F.lit("}")))).otherwise(none).alias("japanese"),
        F.when(line, F.array().cast("array<struct<competing_japanese:array<string>>>")).otherwise(F.array(F.struct(F.array("compact").alias("competing_japanese")))).alias("competing_grammar"),
    )
    docs = s.select(F.col("lang").alias("grammar_point"), F.when(F.col("lang") == "en", matcher.compile_matcher("⌈ˢthe~⌉")).alias("matcher_regex"), F.array(example).alias("examples"))
    rows = lint.training_sentences(docs)
    return rows.groupBy("grammar_point", "positive", "as_expected").agg(F.count("*").alias("n"))


def label_augmentation(spark, sf_dir):
    """Lines of English texts are positive; what a matcher finds in any line becomes a label of it."""
    s = _sentences(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    rows = s.select(F.col("compact").alias("sentence"), F.col("lang").alias("grammar_point"), (F.col("lang") == "en").alias("positive"))
    out = lint.augmented(rows, {"of": matcher.compile_matcher("⌈ˢof~⌉"), "ing": matcher.compile_matcher("⌈ˢ~ingᵖ~⌉")})
    return out.groupBy(F.array_join("labels", ",").alias("labels")).agg(F.count("*").alias("n"))


def matcher_lint(spark, sf_dir):
    """Each line as competing and as own sentence of a point with a matcher for a word."""
    example = F.struct(F.array("compact").alias("japanese"), F.array(F.struct(F.array("compact").alias("competing_japanese"))).alias("competing_grammar"))
    docs = _sentences(spark, sf_dir).select("doc_id", "line", F.array(example).alias("examples"), F.lit(matcher.compile_matcher("⌈ˢand~⌉")).alias("matcher_regex"), (F.col("line") % 2 == 0).alias("matcher_enforce_examples"))
    return docs.select("doc_id", "line", F.size(lint.competing_matches()).alias("competing"), F.size(lint.example_mismatches()).alias("own"))


ITEMS = "i as (select item_id, regexp_extract_all(lower(text), '[a-z]+') as w from benchmark where len(regexp_extract_all(lower(text), '[a-z]+')) >= 7)"
OPEN_TAGS = """c as (select page_id, regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)(<(script|style)[^>]*>).*?(</(script|style)>)', '\\1§\\3', 'g') as clean from pages),
  p as (select page_id, unnest(regexp_extract_all(clean, '(?s)<[^>]+>|[^<]+')) as piece, generate_subscripts(regexp_extract_all(clean, '(?s)<[^>]+>|[^<]+'), 1) as k from c),
  q as (select page_id, piece, k, row_number() over (partition by page_id order by k) - 1 as place from p where not starts_with(piece, '</') and not starts_with(piece, '<!')),
  t as (select page_id, place, lower(regexp_extract(piece, '^<([A-Za-z0-9]+)', 1)) as tag from q where starts_with(piece, '<'))"""
MEANING = "case when p_size % 5 = 0 then null else lower(p_type) end"
QUERIES = {
    "get_meaning": (get_meaning, f"select p_partkey, {MEANING} as meaning, regexp_matches({MEANING}, '^[a-z~]') as start_ok from part"),
    "strip_quotes": (strip_quotes, "select p_partkey, case when p_size % 3 = 1 then '\"' || p_name else p_name end as name from part"),
    "normalize_text": (normalize_text, "select p_partkey, ':『' || p_name || '』 a+b ' || p_type as name from part"),
    "english_tokens": (english_tokens, "select p_partkey, array_to_string(regexp_extract_all(p_name || ', ' || p_type, '(\\s+|[^\\w\\s]|\\w+)'), '|') as tokens from part"),
    "sense_parts": (sense_parts, """with p as (select p_partkey, lower(p_type) as a, lower(p_name) as b, p_size % 2 = 0 as verb from part),
      q as (select distinct p_partkey, unnest([a, case when verb then substr(b, 4) else b end]) as s from p)
      select p_partkey, string_agg(s, ';' order by s) as parts from q group by p_partkey"""),
    "name_validator": (name_validator, f"""select p_partkey, ['brackets', 'slash', '', '', 'digit', '', 'meaning-case', 'circled-digit', '', 'empty-brackets', 'verb-form', '', 'noun-form', '', 'separator', '', 'separator', '', 'brackets',
      'brackets'][p_partkey % {len(ENDINGS)} + 1] as problems from part"""),
    "marked_payload": (marked_payload, "select p_partkey, p_name as payload from part"),
    "safe_filenames": (safe_filenames, "select p_partkey, p_name || '.' || case when p_size between 1 and 20 then chr(9311 + p_size) else '（' || p_size || '）' end as name from part"),
    "quote_counts": (quote_counts, "select doc_id, (length(text) - length(replace(text, '\"', '')))::int as n_quotes, length(text) - length(replace(text, '\"', '')) > 1 as error from documents"),
    "memo_keys": (memo_keys, "select p_partkey, md5(cast(json_object('a0', p_name, 'a1', p_size::varchar) as varchar)) as key from part"),
    "html_strip": (html_strip, "select page_id, md5(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^\\s+|\\s+$', '', 'g')) as digest from pages"),
    "title_extract": (title_extract, "select page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ' \n\t\r'), '') as title from pages"),
    "html_links": (html_links, "select page_id, array_to_string(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), ' ') as links, len(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>'))::int as n_items from pages"),
    "html_elements": (html_elements, f"""with {OPEN_TAGS} select page_id, tag, count(*) as n, min(place)::int as first from t group by all"""),
    "html_section_texts": (html_section_texts, f"""with {OPEN_TAGS}, v as (select page_id, unnest(regexp_extract_all(clean, '(?is)<nav[^>]*>.*?</nav>')) as nav from c),
      i as (select page_id, regexp_replace(unnest(regexp_extract_all(nav, '(?is)<li[^>]*>(.*?)</li>', 1)), '<[^>]+>', '', 'g') as item from v)
      select page_id, array_to_string(list_sort(list(trim(replace(replace(replace(replace(item, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')))), '|') as items from i group by 1"""),
    "compact_encode": (compact_encode, f"with {TOKENS} select doc_id, line, md5(compact) as digest from s"),
    "compact_decode": (compact_decode, f"with {TOKENS} select doc_id, line, string_agg(word, ' ' order by pos) as spaced, sum(length(word))::int as n from t group by doc_id, line"),
    "token_split": (token_split, f"with {TOKENS} select doc_id, line, token from t"),
    "token_injectivity": (token_injectivity, f"with {TOKENS} select left(word, 2) as compact, count(distinct word) as n_raw, min(word) as raw1, max(word) as raw2 from t group by 1 having count(distinct word) > 1"),
    "rich_token_parse": (rich_token_parse, f"""with {TOKENS} select doc_id, line, pos::int as place, word as surface, case when length(word) > 4 then 'n' else 'prt' end as pos, case when length(word) > 6 then 'common_noun' else '' end as details,
      left(word, 4) as base, case when left(word, 3) <> word then left(word, 3) end as lemma, upper(word) as pron from t"""),
    "training_text": (training_text, f"""with {TOKENS} select doc_id, line, string_agg(word || case when length(word) > 4 then 'n' else 'prt' end || upper(right(word, 1)), ' ' order by pos) as text from t group by doc_id, line"""),
    "sequence_classifier": (sequence_classifier, f"""with {TOKENS} select doc_id, line, array_to_string(list_filter(['and-gap', 'loose', 'the-then', 'to'], lambda x: case x
        when 'and-gap' then regexp_matches(compact, '⌈ˢand[^⌉]*⌉⌈ˢ.*[^⌉]*⌉⌈ˢof[^⌉]*⌉') when 'loose' then regexp_matches(compact, '⌈ˢ.*ing[^⌉]*⌉')
        when 'the-then' then regexp_matches(compact, '⌈ˢthe[^⌉]*⌉⌈[^⌉]*ᵇth[^⌉]*⌉') else regexp_matches(compact, '⌈ˢto[^⌉]*⌉') end), ',') as labels from s"""),
    "rule_table_labels": (rule_table_labels, f"""with {TOKENS}, {ITEMS}, n as (select doc_id, line, pos, word, token, lead(word) over (partition by doc_id, line order by pos) as then from t),
      e as (select doc_id, line, max(pos) as last from t group by all),
      v as (select word, left(word, 4) as base from t group by word), x as (select word, min(token) as token from t group by word),
      f as (select item_id, v.word, x as k from i, v, unnest([1, 2, 3, 5, 7]) u(x) where starts_with(v.word, w[x]) or (x = 5 and starts_with(v.word, w[5]))),
      b as (select item_id, word from i, v where starts_with(base, left(w[4], 4))),
      m as (
        select doc_id, line, n.pos, item_id, 0 as kind from n join f on f.word = n.word and f.k = 1 join i using (item_id) where starts_with(n.then, i.w[2])
        union all select a.doc_id, a.line, a.pos, f.item_id, 1 from t a join f on f.word = a.word and f.k = 2 join (select doc_id, line, item_id, max(pos) as p from t join f on f.word = t.word and f.k = 3 group by all) z
          on z.doc_id = a.doc_id and z.line = a.line and z.item_id = f.item_id and z.p >= a.pos + 2
        union all select doc_id, line, n.pos, item_id, 2 from n join b on b.word = n.word join i using (item_id) where starts_with(n.then, i.w[5])
        union all select t.doc_id, t.line, t.pos, item_id, 3 from t join (select item_id, x.word from i, x where contains(x.token, left(w[6], 5))) h on h.word = t.word
        union all select a.doc_id, a.line, a.pos, f.item_id, 4 from t a join f on f.word = a.word and f.k = 7 join (select doc_id, line, item_id, max(pos) as p from t join f on f.word = t.word and f.k = 1 group by all) z
          on z.doc_id = a.doc_id and z.line = a.line and z.item_id = f.item_id and z.p >= a.pos + 2)
      select doc_id, line, string_agg(distinct item_id || '-' || kind, ',' order by item_id || '-' || kind) as labels from m group by doc_id, line"""),
    "rule_table_annotation": (rule_table_annotation, None),
    "matcher_basic": (matcher_basic, f"""with {TOKENS}, m as (select doc_id, line, regexp_extract(compact, '⌈ˢ[^⌉]*?ᵖprt[^⌉]*?⌉(?:⌈ˢ[^⌉]*?ᵖpron[^⌉]*?⌉|⌈[^⌉]*?ᵖn[^⌉]*?⌉⌈[^⌉]*?ᵖsuff:[^⌉]*?ʳ[^⌉]*?⌉|⌈[^⌉]*?ᵖn[^⌉]*?⌉)') as g from s)
      select doc_id, line, case when g <> '' then array_to_string(regexp_extract_all(g, 'ˢ(.*?)ᵖ', 1), ' ') end as found from m"""),
    "matcher_lookaround": (matcher_lookaround, f"""with {TOKENS}, l as (select *, lag(word) over (partition by doc_id, line order by pos) as before from t)
      select doc_id, line, arg_min(word, pos) filter (word like '%ing' and before is distinct from 'the') as found from l group by doc_id, line"""),
    "rules_in_turn": (rules_in_turn, f"""with {TOKENS}, a as (select doc_id, line, regexp_replace(compact, '(⌈ˢthe[^⌉]*)⌉', '\\1ᵍart⌉') as c from s)
      select doc_id, line, regexp_replace(c, '(⌈ˢand[^⌉]*)⌉', '\\1ᵍcon⌉') as annotated from a"""),
    "compliance_report": (compliance_report, f"with {TOKENS} select doc_id, line, 'to' as label from s where not regexp_matches(compact, '⌈ˢto[^⌉]*⌉')"),
    "previous_token_histogram": (previous_token_histogram, """with w as (select conv_id, turn, md5(text) as d, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> '') as ws from conversations),
      p as (select unnest(list_zip(ws[:-2], ws[2:])) as z from w) select z[1] as previous, count(*) as n from p where z[2] = 'the' group by 1 order by n desc, previous limit 5"""),
    "kana_keys": (kana_keys, f"""with p as (select p_partkey, case p_size % 3 when 0 then translate(lower(p_brand), 'abcdefghijklmnopqrstuvwxyz#0123456789', '{KANA}') when 1 then 'ひらがな' else p_brand end as w, p_size % 3 as m from part),
      q as (select *, case m when 0 then translate(w, '{KANA}', '{"".join(chr(ord(c) - 0x60) for c in KANA)}') else w end as hi from p)
      select p_partkey, case m when 2 then w || '|よみ' else hi end as key, hi as hiragana, m = 1 as h, m = 0 as k from q"""),
    "suggestion_prefix": (suggestion_prefix, "select p_partkey, case when p_size % 3 = 1 then null when p_brand < 'Brand#3' then p_brand else '<suggest>:' || p_brand end as name from part"),
    "fenced_lines": (fenced_lines, "select doc_id, md5(rtrim(array_to_string(list_transform(string_split(text, chr(10)), lambda t: regexp_replace(t, '^\\s+|\\s+$', '', 'g')), chr(10)), chr(10))) as digest from documents"),
    "geminates": (geminates, "select p_partkey, p_name || 'っ' || p_type as name from part"),
    "markdown_bullets": (markdown_bullets, """select page_id, md5(array_to_string(list_transform(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1),
      lambda x: '- k | ' || regexp_replace(regexp_replace(x, '<[^>]+>', '', 'g'), '^\\s+|\\s+$', '', 'g')), chr(10))) as digest from pages"""),
    "training_extraction": (training_extraction, f"""with {TOKENS} select lang as grammar_point, line % 2 = 0 as positive, case when lang = 'en' then regexp_matches(compact, '⌈ˢthe[^⌉]*⌉') = (line % 2 = 0) end as as_expected, count(*) as n
      from s join documents using (doc_id) group by all"""),
    "label_augmentation": (label_augmentation, f"""with {TOKENS}, x as (select compact, bool_or(lang = 'en') as en from s join documents using (doc_id) group by 1),
      l as (select array_to_string(list_filter([case when en then 'en' end, case when regexp_matches(compact, '⌈ˢ[^⌉]*?ingᵖ[^⌉]*?⌉') then 'ing' end, case when regexp_matches(compact, '⌈ˢof[^⌉]*⌉') then 'of' end], lambda v: v is not null), ',') as labels from x)
      select labels, count(*) as n from l group by 1"""),
    "matcher_lint": (matcher_lint, f"""with {TOKENS} select doc_id, line, regexp_matches(compact, '⌈ˢand[^⌉]*⌉')::int as competing, (line % 2 = 0 and not regexp_matches(compact, '⌈ˢand[^⌉]*⌉'))::int as own from s"""),
}
