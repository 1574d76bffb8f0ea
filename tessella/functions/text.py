"""String functions as Column builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tokens import once

# Pairs of quotes, the replacement tables, and the kana range.
QUOTES = ('""', "''", "「」", "『』", "“”", "‘’")
CHARACTERS = {"：": ":", "「": "『", "」": "』"}
SPACING = {"  ": " ", "&emsp;": " ", "　": " ", "〜": "～", " + ": "+", "+ ": "+", " +": "+"}
CLEANING = {"  ": " ", "\n\n\n": "\n\n", "　": " ", "–": "-", "’": "'", "：": ":", "？": "?"}
#: Characters with the property White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
KATAKANA = "".join(chr(c) for c in range(0x30A1, 0x30F4))
HIRAGANA = "".join(chr(c - 0x60) for c in range(0x30A1, 0x30F4))


def replace_all(text: Column, table: dict[str, str]) -> Column:
    """Literal replacements, one pass each, in the table's order."""
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), table.items(), text)


def trim_space(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(text, F.lit(WHITE))


def strip_quotes(text: Column) -> Column:
    """Without matching outer quotes, however many enclose it."""
    opening, closing = ("".join(q[i] for q in QUOTES) for i in (0, 1))

    def common(head: Column, tail: Column) -> Column:
        """The quotes at both ends, from the outside in, as far as they match."""
        ends = F.zip_with(F.split(head, ""), F.split(tail, ""), lambda a, b: a == b)
        return once(F.array_position(ends, False).cast("int"), lambda n: F.when(n > 0, n - 1).otherwise(F.length(head)))

    def matched(t: Column) -> Column:
        """How many quotes enclose a text that begins with one and ends with one."""
        head, tail = F.regexp_extract(t, f"^[{opening}]*", 0), F.reverse(F.regexp_extract(t, f"[{closing}]*+\\z", 0))
        own = F.struct(F.translate(head, opening, closing).alias("head"), tail.alias("tail"), F.floor(F.length(t) / 2).cast("int").alias("half"))

        def cut(e: Column) -> Column:
            most = F.least(F.length(e["head"]), F.length(e["tail"]), e["half"])
            return once(F.struct(F.left(e["head"], most).alias("head"), F.left(e["tail"], most).alias("tail")), lambda c: common(c["head"], c["tail"]))

        return once(own, cut)

    def stripped(t: Column) -> Column:
        # Most texts have no quote at one of their ends.
        enclosed = F.left(t, F.lit(1)).isin(*opening) & F.right(t, F.lit(1)).isin(*closing) & (F.length(t) > 1)
        return F.when(enclosed, once(matched(t), lambda n: F.substr(t, n + 1, F.length(t) - 2 * n))).otherwise(t)

    return once(text, stripped)


def normal_japanese(text: Column) -> Column:
    return F.translate(text, "".join(CHARACTERS), "".join(CHARACTERS.values()))


def normal_spacing(text: Column) -> Column:
    return replace_all(text, SPACING)


def clean_value(text: Column) -> Column:
    """Lines trimmed, then the replacements of a catalogue's texts; a URL keeps its characters, an empty text becomes null."""
    lines = F.array_join(F.transform(F.split(text, "\n"), trim_space), "\n")
    return F.nullif(F.when(lines.startswith("http"), lines).otherwise(replace_all(lines, CLEANING)), F.lit(""))


def meaning(name: Column) -> Column:
    """The last parenthesised group after a space; null without one."""
    return F.get(F.reverse(F.regexp_extract_all(name, F.lit(r" \(([^)]*)\)"), F.lit(1))), F.lit(0))


def meaning_start_ok(text: Column) -> Column:
    return text.rlike(r"^(I |[~～]|\p{Ll})")


def without_suggestion(name: Column) -> Column:
    return F.regexp_replace(name, "^<(strongly-)?suggest>:", "")


def suggested(name: Column, is_known: Column) -> Column:
    """Prefix unknown names; known ones lose the prefix; strongly suggested ones give null."""
    bare = F.regexp_replace(name, "^<suggest>:", "")
    return F.when(name.startswith("<strongly-suggest>:"), F.lit(None).cast("string")).when(is_known, bare).otherwise(F.concat(F.lit("<suggest>:"), bare))


def hiragana(text: Column) -> Column:
    return F.translate(text, KATAKANA, HIRAGANA)


def all_hiragana(text: Column) -> Column:
    return text.rlike(r"^[぀-ゟ]*$")


def all_katakana(text: Column) -> Column:
    return text.rlike(r"^[゠-ヿ]*$")


def dictionary_key(word: Column, reading: Column) -> Column:
    """Kana words by themselves in hiragana, others with their reading."""
    return F.when(all_hiragana(word), word).when(all_katakana(word), hiragana(word)).otherwise(F.concat_ws("|", word, reading))


def english_tokens(text: Column) -> Column:
    """Runs of space, single punctuation, and words."""
    return F.regexp_extract_all(text, F.lit(r"(?U)(\s+|[^\w\s]|\w+)"), F.lit(1))


def sense_parts(sense: Column) -> Column:
    """Sorted distinct parts of a sense: by comma, trimmed, lower case, without parentheses; a leading ``to `` costs each part three characters."""
    parts = F.transform(F.split(sense, ","), lambda p: F.regexp_replace(F.lower(trim_space(p)), r"(?U)\s*\([^)]*\)", ""))
    return F.array_sort(F.array_distinct(F.transform(parts, lambda p: F.when(sense.startswith("to "), F.substr(p, F.lit(4))).otherwise(p))))


def strip_single_quotes(text: Column) -> Column:
    """Trimmed, and without a pair of outer single quotes, at most twice."""
    once = lambda c: F.when(c.startswith("'") & c.endswith("'"), F.substr(c, F.lit(2), F.greatest(F.length(c) - 2, F.lit(0)))).otherwise(c)
    return once(once(trim_space(text)))


def split_key(key: Column) -> Column:
    """name and source of a key, parted at its first bar; the source is null without one."""
    return F.struct(F.substring_index(key, "|", 1).alias("name"), F.when(key.contains("|"), F.regexp_replace(key, r"(?s)^[^|]*\|", "")).alias("source"))


def resolved_meaning(a: Column, b: Column, names: tuple[str, str]) -> Column:
    """A map: one ``meaning`` if both sources agree or one has none, else one entry per source; empty without any."""
    one = lambda c: F.create_map(F.lit("meaning"), c)
    both = F.create_map(F.lit(names[0]), a, F.lit(names[1]), b)
    return F.when(a == b, one(a)).when(a.isNotNull() & b.isNotNull(), both).when(a.isNotNull() | b.isNotNull(), one(F.coalesce(a, b))).otherwise(F.create_map().cast("map<string,string>"))


def trim_lines(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, "\n"), trim_space), "\n")


def without_fences(text: Column) -> Column:
    return F.regexp_replace(text, r"(?m)^```[a-z]*\n?|```$", "")


def marked_payload(text: Column, begin: str = "BEGIN", end: str = "END") -> Column:
    """What stands between the marks, or the whole text without them."""
    pattern = rf"(?s){begin}(.*?){end}"
    return F.when(text.rlike(pattern), trim_space(F.regexp_extract(text, pattern, 1))).otherwise(text)


def count_of(text: Column, needle: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)).cast("int")


def strip_tags(html: Column) -> Column:
    return trim_space(F.regexp_replace(html, "<[^>]+>", ""))


def strip_html(html: Column) -> Column:
    """Text-only markup: drops annotations, scripts and styles, unwraps ruby and span, collapses space."""
    gone = F.regexp_replace(html, r"(?is)<(rt|rp|script|button|svg|style|noscript)\b[^>]*>.*?</\1>", "")
    bare = F.regexp_replace(gone, r"(?i)</?(ruby|span)\b[^>]*>", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"[ \t\r\n]+", " "), r"(<(div|p|ul|li)\b[^>]*>) ?</\2>", ""))


def safe_filename(name: Column) -> Column:
    """Slashes to dots, parentheses to full width, (n) to circled digits."""
    circled = {f"({i})": chr(0x2460 + i - 1) for i in range(1, 21)}
    return F.translate(replace_all(name, circled), "/()", ".（）")


def json_key(*parts: Column) -> Column:
    """A memo key that distinguishes all argument lists."""
    return F.md5(F.to_json(F.struct(*[p.cast("string").alias(f"a{i}") for i, p in enumerate(parts)])))


# What may stand in brackets after a part of speech.
CONJUGATIONS = {
    "Verb": (
        "masu-stem", "て", "た", "ている", "volitional-よう", "ない", "せる・させる", "れる・られる", "dictionary", "negative", "negative-past", "past",
        "た・ている", "ていた・ている", "ば-conditional", "ましょう", "imperfective", "ないで",
    ),
    "Adjective": ("く", "て", "い", "past", "predicate", "negative"),
    "Noun": ("で", "に", "へ", "と", "から", "まで", "より", "negative-modifier"),
}
SEPARATORS = ("+", "~", "〜")


def valid_name(name: Column) -> Column:
    """The problems of a catalogue name, as an array of codes in the order in which they are looked for."""
    opened = F.aggregate(
        F.regexp_extract_all(name, F.lit(r"([\[\]()])"), F.lit(1)), F.lit(""),
        lambda stack, c: F.when(c.isin("(", "["), F.concat(stack, c))
        .when(stack.endswith(F.translate(c, ")]", "([")) & (stack != ""), F.left(stack, F.length(stack) - 1))
        .otherwise(F.concat(stack, F.lit("!"))),
    )
    forms = lambda kind: F.regexp_extract_all(name, F.lit(rf"{kind}\[(.*?)\]"), F.lit(1))
    unknown = lambda kind: F.exists(forms(kind), lambda f: ~f.isin("", *CONJUGATIONS[kind]))
    # Only parentheses that end the name hold its English.
    english = F.regexp_extract(name, r"\(([^)]+)\)\z", 1)
    capital = F.exists(F.split(english, r"(?U)\s+"), lambda w: (w != "I") & w.rlike(r"\p{Lu}"))
    lone = [name.contains(s) & F.exists(F.split(name, f"[{s}]", -1), lambda p: trim_space(p) == "") for s in SEPARATORS]
    checks = [
        ("empty", name == ""), ("circled-digit", name.rlike("[①-⑩]")), ("slash", name.contains("/")), ("brackets", opened != ""),
        ("empty-brackets", reduce(lambda a, b: a | b, [F.array_contains(forms(k), "") for k in CONJUGATIONS])),
        *((f"{k.lower()}-form", unknown(k)) for k in CONJUGATIONS),
        ("meaning-case", capital), ("digit", english.rlike(r"\p{Nd}")), ("separator", reduce(lambda a, b: a | b, lone)),
    ]
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for code, c in checks]), lambda x: x.isNotNull())
