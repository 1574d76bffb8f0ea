"""Tables of sequence rules over compact sentences: labels and annotation.

A rule is a list of parts with ``|`` between them: ``a`` is a token whose surface
begins with a, ``ᵇa`` one with a base form that begins so, ``○○`` one token or more,
``.*a`` any tokens up to one that holds a, ``a.*`` a token that begins with a and
any tokens after it. A match covers whole tokens, begins as far left as it can,
and each gap is as long as it can be.

A table of rules becomes blocks of literals with gaps between them. A batch of
sentences becomes an inverted index of those literals: per literal the sorted places
where it stands. Each rule looks at the sentences of its rarest block only, and all
its matches are read off the places at once, from the last block backwards, so work
follows the number of hits and grows linearly with a sentence's tokens.

Rules of any other form, and sentences with text outside tokens, are matched by
the regular expression that defines the rule (:func:`tessella.functions.matcher.sequence_pattern`).
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.matcher import sequence_pattern

#: Rules of one pass over the sentences; larger tables take several.
RULES_EACH = 5000
#: Sentences, and their characters, that are matched at once.
SENTENCES_EACH, CHARACTERS_EACH = 16_000, 1 << 22
#: Tokens whose literals a task remembers.
KNOWN_TOKENS = 1 << 18
RULE_SCHEMA = "place long, rule string, name string"
SPECIAL = re.compile(r"[][(){}?+*.^$\\⌈⌉]")

Literal = tuple[str, str]  # kind (surface, base, holds) and text


@dataclass(frozen=True)
class Rule:
    """Blocks of literals; ``gaps`` has the least tokens before, between and after them (None: no gap at an end)."""

    name: str
    pattern: str
    blocks: tuple[tuple[Literal, ...], ...] | None
    gaps: tuple[int | None, ...]
    literals: tuple[Literal, ...] = ()


def parse(rule: str, name: str) -> Rule:
    """The blocks and gaps of a rule; ``blocks`` is None for forms that only the regular expression says."""
    steps: list = []
    for part in map(str.strip, rule.split("|")):
        part = part.replace("○○", ".*")
        if part == ".*":
            steps.append(1)
            continue
        ahead, behind = part.startswith(".*"), part.endswith(".*")
        text = part[2:] if ahead else part[:-2] if behind else part
        base = text.startswith("ᵇ")
        if SPECIAL.search(text) or not text or (base and (part != text or len(text) == 1)) or (ahead and "ᵇ" in text):
            return Rule(name, sequence_pattern(rule), None, ())
        if ahead:
            steps += [0, ("holds", text)]
        else:
            steps += [("base", text[1:]) if base else ("surface", text), *([0] if behind else [])]
    blocks, gaps = [[]], [None]
    for step in steps:
        if isinstance(step, tuple):
            blocks[-1].append(step)
        elif not blocks[-1]:
            gaps[-1] = (gaps[-1] or 0) + step
        else:
            blocks.append([])
            gaps.append(step)
    if blocks[-1]:
        gaps.append(None)
    else:
        blocks.pop()
        if not blocks:
            return Rule(name, sequence_pattern(rule), None, ())
    return Rule(name, sequence_pattern(rule), tuple(map(tuple, blocks)), tuple(gaps), tuple({lit: None for block in blocks for lit in block}))


def _starts(block: tuple[Literal, ...], places: dict[Literal, list[int]]) -> list[int]:
    """Places where all literals of a block stand in a row."""
    rarest = min(range(len(block)), key=lambda d: len(places[block[d]]))
    at = [p - rarest for p in places[block[rarest]] if p >= rarest]
    for d, lit in enumerate(block):
        if d != rarest and at:
            held = set(places[lit])
            at = [p for p in at if p + d in held]
    return at


def span(rule: Rule, places: dict[Literal, list[int]], n: int) -> tuple[int, int] | None:
    """First token and the one after the last of a rule's match among ``n`` tokens; all its literals have places."""
    limit = n - (rule.gaps[-1] or 0)
    end = n if rule.gaps[-1] is not None else None
    for k in range(len(rule.blocks) - 1, -1, -1):
        block, before = rule.blocks[k], rule.gaps[k]
        at = _starts(block, places)
        if k == 0 and before is None:
            if not at or at[0] + len(block) > limit:
                return None
            return at[0], at[0] + len(block) if end is None else end
        last = bisect_right(at, limit - len(block)) - 1
        if last < 0 or (k == 0 and at[last] < before):
            return None
        if end is None:
            end = at[last] + len(block)
        limit = at[last] - (before or 0)
    return 0, end


class Table:
    """Compiled rules, in order, and the literals they look for."""

    def __init__(self, rules: Iterable[tuple[str, str]]) -> None:
        self.rules = [parse(rule, name) for rule, name in rules]
        self.by_kind: dict[str, dict[str, Literal]] = {"surface": {}, "base": {}, "holds": {}}
        for rule in self.rules:
            for kind, text in rule.literals:
                self.by_kind[kind][text] = (kind, text)
        self.sizes = {kind: sorted({len(t) for t in texts}) for kind, texts in self.by_kind.items()}
        self.short = [text for text in self.by_kind["holds"] if len(text) == 1]
        self.by_start: dict[str, list[str]] = {}
        for text in self.by_kind["holds"]:
            if len(text) > 1:
                self.by_start.setdefault(text[:2], []).append(text)
        self.every = [(kind, text) for kind, texts in self.by_kind.items() for text in texts]
        self.codes = {lit: k for k, lit in enumerate(self.every)}
        self.numbers, self.found = Numbers(self), []

    def __getstate__(self) -> dict:
        return self.__dict__ | {"numbers": None, "found": []}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.numbers = Numbers(self)

    def forget(self) -> None:
        """Between two batches: drop what is known of tokens if that is much."""
        if len(self.found) >= KNOWN_TOKENS:
            self.numbers.clear()
            self.found.clear()

    def literals(self, token: str) -> tuple[Literal, ...]:
        """The literals of one token ``⌈ˢ...⌉``."""
        inner, out = token[2:-1], []
        surface, base, holds = (self.by_kind[k] for k in ("surface", "base", "holds"))
        out += [surface[inner[:k]] for k in self.sizes["surface"] if inner[:k] in surface]
        at = inner.find("ᵇ")
        while at >= 0:
            out += [base[inner[at + 1 : at + 1 + k]] for k in self.sizes["base"] if inner[at + 1 : at + 1 + k] in base]
            at = inner.find("ᵇ", at + 1)
        # A literal inside is looked for where its first two characters stand together.
        near = self.by_start.keys() & set(map(str.__add__, inner, inner[1:]))
        out += [holds[text] for start in near for text in self.by_start[start] if text in inner]
        out += [holds[c] for c in self.short if c in inner]
        return tuple(dict.fromkeys(out))


class Numbers(dict):
    """Numbers of tokens (without their ends) whose literals a table knows; -1 for what is no token."""

    def __init__(self, table: Table) -> None:
        super().__init__()
        self.table = table

    def __missing__(self, token: str) -> int:
        own = self.table.found
        self[token] = number = len(own) if token.startswith("⌈ˢ") else -1
        if number >= 0:
            own.append([self.table.codes[lit] for lit in self.table.literals(f"{token}⌉")])
        return number


class Batch:
    """An inverted index of the literals of some sentences: sorted places among all their tokens.

    The sentences' tokens stand one behind the other with a gap between two sentences,
    so a rule is matched in all sentences at once and no match crosses a sentence.
    """

    def __init__(self, table: Table, sentences: list[str | None]) -> None:
        self.table = table
        self.texts: dict[int, str] = {}  # rows for the regular expressions
        self.tokens: list[str] = []  # without their ends
        self.marks: list[tuple[np.ndarray, np.ndarray, str]] = []  # not yet in the tokens
        table.forget()
        rows, starts, ends, numbers = [], [], [], []
        for row, text in enumerate(sentences):
            if text is None:
                continue
            tokens = text.split("⌉")
            rest = tokens.pop()
            own = list(map(table.numbers.__getitem__, tokens))
            if rest or min(own, default=0) < 0:
                self.texts[row] = text
                continue
            rows.append(row)
            starts.append(len(self.tokens))
            self.tokens += tokens
            ends.append(len(self.tokens))
            self.tokens.append("")
            numbers += own
            numbers.append(-1)
        self.rows, self.starts, self.ends = (np.array(x, np.int64) for x in (rows, starts, ends))
        self.places = self._index(np.array(numbers, np.int64))

    def _index(self, numbers: np.ndarray) -> dict[Literal, np.ndarray]:
        at = np.flatnonzero(numbers >= 0)
        used, which = np.unique(numbers[at], return_inverse=True)
        own = [self.table.found[k] for k in used.tolist()]
        sizes = np.array([len(x) for x in own], np.int64)
        codes = np.array([c for x in own for c in x], np.int64)
        begins, n = (np.cumsum(sizes) - sizes)[which], sizes[which]
        each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins, n)
        literal, place = codes[each], np.repeat(at, n)
        order = np.argsort(literal, kind="stable")
        literal, place = literal[order], place[order]
        kinds, first = np.unique(literal, return_index=True)
        return {self.table.every[c]: part for c, part in zip(kinds.tolist(), np.split(place, first[1:]), strict=True)} if len(kinds) else {}

    def _block(self, block: tuple[Literal, ...]) -> np.ndarray:
        """Places where all literals of a block stand in a row."""
        held = [self.places[lit] for lit in block]
        rarest = min(range(len(block)), key=lambda d: len(held[d]))
        at = held[rarest] - rarest
        for d, places in enumerate(held):
            if d != rarest and len(at):
                at = at[places[np.minimum(np.searchsorted(places, at + d), len(places) - 1)] == at + d]
        return at

    def matches(self, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each sentence with a match of the rule: which it is, and its match's first and last token (exclusive) among all."""
        if rule.blocks is None:
            return self._by_pattern(rule)
        none = np.zeros((3, 0), np.int64)
        if not all(lit in self.places for lit in rule.literals):
            return tuple(none)
        found = [self._block(block) for block in rule.blocks]
        if not all(map(len, found)):
            return tuple(none)
        # As in :func:`span`, for all sentences that have the rarest block.
        rows = np.unique(np.searchsorted(self.starts, min(found, key=len), "right") - 1)
        limit = self.ends[rows] - (rule.gaps[-1] or 0)
        end = self.ends[rows] if rule.gaps[-1] is not None else None
        for k in range(len(found) - 1, -1, -1):
            at, size, before = found[k], len(rule.blocks[k]), rule.gaps[k]
            if k == 0 and before is None:
                first = at[np.minimum(np.searchsorted(at, self.starts[rows]), len(at) - 1)]
                fits = (first >= self.starts[rows]) & (first + size <= limit)
                return rows[fits], first[fits], (first + size if end is None else end)[fits]
            last = np.searchsorted(at, limit - size, "right") - 1
            fits = (last >= 0) & (at[np.maximum(last, 0)] >= self.starts[rows] + (before if k == 0 else 0))
            rows, last = rows[fits], at[last[fits]]
            end = last + size if end is None else end[fits]
            limit = last - (before or 0)
        return rows, self.starts[rows], end

    def _by_pattern(self, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = []
        for k in range(len(self.rows)):
            text = self.text(k)
            if m := re.search(rule.pattern, text):
                first = self.starts[k] + text.count("⌉", 0, m.start())
                out.append((k, first, first + text.count("⌉", m.start(), m.end())))
        return tuple(np.array(out, np.int64).reshape(-1, 3).T)

    def mark(self, first: np.ndarray, last: np.ndarray, name: str) -> None:
        """Write a name into tokens; literals that the name holds stand there from now on."""
        if not len(first):
            return
        self.marks.append((first, last, name))
        new = self.table.literals(f"⌈ˢ\0ᵍ{name}⌉")
        if new:
            n = last - first
            places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
            for lit in new:
                self.places[lit] = np.union1d(self.places[lit], places) if lit in self.places else places

    def _write(self) -> None:
        """Put the names into the tokens; tokens between the same ends of marks get the same names."""
        if not self.marks:
            return
        first, last = (np.concatenate([m[i] for m in self.marks]) for i in (0, 1))
        mark = np.repeat(np.arange(len(self.marks)), [len(m[0]) for m in self.marks])
        bounds = np.unique(np.concatenate([first, last]))
        low, n = np.searchsorted(bounds, first), np.searchsorted(bounds, last) - np.searchsorted(bounds, first)
        part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        order = np.argsort(part, kind="stable")
        part, mark = part[order], np.repeat(mark, n)[order]
        parts, begins = np.unique(part, return_index=True)
        names = [f"ᵍ{name}" for _, _, name in self.marks]
        told = [names[i] for i in mark.tolist()]
        begins = begins.tolist()
        for low_, high, begin, end in zip(bounds[parts].tolist(), bounds[parts + 1].tolist(), begins, [*begins[1:], len(told)], strict=True):
            own = "".join(told[begin:end])
            self.tokens[low_:high] = [t + own for t in self.tokens[low_:high]]
        self.marks = []

    def text(self, k: int) -> str:
        """A sentence as it is now."""
        self._write()
        return "⌉".join([*self.tokens[self.starts[k] : self.ends[k]], ""])


def labels_of(table: Table, sentences: list[str | None]) -> list[list[str] | None]:
    """The sorted names of the rules that each sentence meets."""
    batch = Batch(table, sentences)
    found: list = [None if s is None else set() for s in sentences]
    for rule in table.rules:
        for row in batch.rows[batch.matches(rule)[0]].tolist():
            found[row].add(rule.name)
        for row, text in batch.texts.items():
            if re.search(rule.pattern, text):
                found[row].add(rule.name)
    return [None if s is None else sorted(s) for s in found]


def _marked(text: str, rule: Rule) -> str:
    m = re.search(rule.pattern, text)
    return text if not m else text[: m.start()] + m.group().replace("⌉", f"ᵍ{rule.name}⌉") + text[m.end() :]


def annotations_of(table: Table, sentences: list[str | None]) -> list[str | None]:
    """The sentences with each rule's name in the tokens of its first match; rules take turns and see earlier names."""
    batch = Batch(table, sentences)
    for rule in table.rules:
        _, first, last = batch.matches(rule)
        batch.mark(first, last, rule.name)
        for row, text in batch.texts.items():
            batch.texts[row] = _marked(text, rule)
    whole = {row: batch.text(k) for k, row in enumerate(batch.rows.tolist())} | batch.texts
    return [whole.get(row) for row in range(len(sentences))]


# --- DataFrames ---


def rules_from(spark: SparkSession, rules: dict[str, str | list[str]]) -> DataFrame:
    """A table of rules from a map; a list stands for one rule a name."""
    pairs = [(rule, name) for rule, names in rules.items() for name in ([names] if isinstance(names, str) else names)]
    return spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], RULE_SCHEMA)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A table of rules from a JSON file: an object of rules, each with a name or a list of names, in the file's order."""
    entries = F.map_entries(F.from_json("value", "map<string,string>"))
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(entries).alias("at", "e"))
    listed = F.from_json("e.value", "array<string>")
    names = F.when(F.col("e.value").startswith("["), F.coalesce(listed, F.array("e.value"))).otherwise(F.array("e.value"))
    each = rows.select("file", "at", F.col("e.key").alias("rule"), F.posexplode(names).alias("k", "name"))
    return numbered(each, "file", "at", "k")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """place, rule, name: the rules of a table in an order (a rule table is small; its numbering is one window)."""
    place = F.row_number().over(_window(order))
    return rows.withColumn("place", place.cast("long") - 1).select("place", "rule", "name")


def _window(order: tuple[str, ...]):
    from pyspark.sql import Window

    return Window.orderBy(*order)


def _passes(rules: DataFrame, each: int) -> list:
    """Compiled tables of at most ``each`` rules, sent to the executors one by one."""
    context, out, held = rules.sparkSession.sparkContext, [], []
    for row in rules.orderBy("place").select("rule", "name").toLocalIterator():
        held.append((row["rule"], row["name"]))
        if len(held) == each:
            out.append(context.broadcast(Table(held)))
            held = []
    return out + ([context.broadcast(Table(held))] if held else [])


def counts_of(table: Table, sentences: list[str | None]) -> list[int | None]:
    """How many names the sentences have after :func:`annotations_of`."""
    return [None if s is None else s.count("ᵍ") for s in annotations_of(table, sentences)]


def _udf(run, kind: str, table) -> object:
    """A column function over Arrow batches: ``run`` with one compiled table.

    Spark would move a condition on a deterministic function below its projection and run
    the function for either; this one runs once a sentence.
    """

    @F.pandas_udf(kind)
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held, size = [], 0
        for batch in batches:
            for sentence in batch.tolist():
                held.append(sentence)
                size += len(sentence or "")
                if size >= CHARACTERS_EACH or len(held) >= SENTENCES_EACH:
                    yield pd.Series(run(table.value, held), dtype=object)
                    held, size = [], 0
        if held:
            yield pd.Series(run(table.value, held), dtype=object)

    return column.asNondeterministic()


def labels(compact: Column, rules: DataFrame, each: int = RULES_EACH) -> Column:
    """The sorted names of the rules that a sentence meets, each on its own; null for a null sentence."""
    parts = [_udf(labels_of, "array<string>", table)(compact) for table in _passes(rules, each)]
    if not parts:
        return F.when(compact.isNotNull(), F.array().cast("array<string>"))
    return parts[0] if len(parts) == 1 else F.array_sort(F.array_distinct(F.concat(*parts)))


def annotate(compact: Column, rules: DataFrame, each: int = RULES_EACH) -> Column:
    """The sentence after all rules in turn; null for a null sentence."""
    for table in _passes(rules, each):
        compact = _udf(annotations_of, "string", table)(compact)
    return compact


def names_taken(compact: Column, rules: DataFrame, each: int = RULES_EACH) -> Column:
    """How many names a sentence has after all rules in turn; null for a null sentence. Annotated sentences stay in their task."""
    *first, last = _passes(rules, each) or [rules.sparkSession.sparkContext.broadcast(Table([]))]
    for table in first:
        compact = _udf(annotations_of, "string", table)(compact)
    return _udf(counts_of, "int", last)(compact)
