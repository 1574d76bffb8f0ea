"""JSON schemas as dictionaries: references, alias chains, schema files with comments, repair of broken JSON.

A schema has ``definitions``, ``properties``, ``items``, ``type``, ``enum`` and ``$ref``;
:mod:`tessella.functions.compiled` turns it into column expressions.
"""

from __future__ import annotations

import json
import re
from typing import Any

PREFIX = "#/definitions/"


def target(node: Any) -> str | None:
    """The definition that a schema node refers to."""
    ref = node.get("$ref") if isinstance(node, dict) else None
    return ref.rsplit("/", 1)[-1] if isinstance(ref, str) and ref.startswith(PREFIX) else None


def alias_chains(schema: dict) -> dict[str, list[str]]:
    """For each definition the names it leads to, itself first; a cycle ends at its first repetition."""
    known = {n: d for n, d in schema.get("definitions", {}).items() if isinstance(d, dict)}
    chains = {}
    for name in known:
        chain = [name]
        while (after := target(known[chain[-1]])) in known and after not in chain:
            chain.append(after)
        chains[name] = chain
    return chains


def dereferenced(schema: dict) -> dict:
    """The schema with references replaced by what they name, without ``definitions``; a reference into itself becomes {}."""
    known = schema.get("definitions", {})

    def at(node: Any, seen: tuple) -> Any:
        name = target(node)
        if name is not None:
            return {} if name in seen or name not in known else at(known[name], (*seen, name))
        if isinstance(node, dict):
            return {k: at(v, seen) for k, v in node.items() if k != "definitions"}
        return [at(v, seen) for v in node] if isinstance(node, list) else node

    return at(schema, ())


_json5 = re.compile(r"""("(?:[^"\\]|\\.)*")|('(?:[^'\\]|\\.)*')|//[^\n]*|/\*.*?\*/|,(?=(?:\s|//[^\n]*|/\*.*?\*/)*[}\]])|([A-Za-z_$][\w$]*)(?=\s*:)""", re.S)


def parse_json5(text: str) -> Any:
    """JSON with comments, trailing commas, bare keys and single-quoted strings."""

    def plain(m: re.Match) -> str:
        if m.group(1):
            return m.group(1)
        if m.group(2):
            return json.dumps(m.group(2)[1:-1].replace("\\'", "'"), ensure_ascii=False)
        return f'"{m.group(3)}"' if m.group(3) else ""

    return json.loads(_json5.sub(plain, text))


def repaired(text: str) -> Any:
    """The value of JSON that broke off or has stray commas or fences; None if nothing can be made of it."""
    body = re.sub(r"^\s*```\w*\s*|\s*```\s*$", "", text)
    start = re.search(r"[\[{]", body)
    if not start:
        return None
    body, closing, quoted, at = body[start.start() :], [], False, 0
    while at < len(body):
        c = body[at]
        if quoted:
            at += c == "\\"
            quoted = c != '"'
        elif c == '"':
            quoted = True
        elif c in "[{":
            closing.append("]" if c == "[" else "}")
        elif c in "]}" and closing:
            closing.pop()
            if not closing:
                body = body[: at + 1]
                break
        at += 1
    body = body + '"' * quoted
    for tail in ("", ":null", "null"):
        try:
            return parse_json5(re.sub(r"[,\s]+$", "", body) + tail + "".join(reversed(closing)))
        except ValueError:
            continue
    return None


_read: dict[str, dict] = {}


def read_schema(spark, path: str) -> dict:
    """A schema file (JSON with comments), read through Spark once per path."""
    if path not in _read:
        _read[path] = parse_json5(spark.read.text(path, wholetext=True).first()[0])
    return _read[path]
