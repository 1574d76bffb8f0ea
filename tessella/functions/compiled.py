"""Schemas compiled to nested column expressions: visits, checks, pruning and key order in one projection.

A document is a struct whose fields stand in the order of the schema's properties
(:func:`struct_type`, :func:`parsed`), so key order is the type's. Steps and rules are
chosen by type name: a definition's name (of a chain of aliases the most general
first), the place of a node without one (``lines/t/string``), and None for the root.
Absent and null values are not visited.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import alias_chains, target

Step = Callable[[Column], Column]
Rule = Callable[[Column, Column], Column]  # value and path give an array of messages
SCALARS = {"string": T.StringType(), "boolean": T.BooleanType(), "integer": T.LongType(), "number": T.DoubleType()}
EXTRA = "_others"


class Walk:
    """Resolves nodes of one schema."""

    def __init__(self, schema: dict) -> None:
        self.known = {n: d for n, d in schema.get("definitions", {}).items() if isinstance(d, dict)}
        self.chains = alias_chains(schema)

    def names(self, node: dict, place: str | None) -> tuple[list[str | None], dict, str | None, str | None]:
        """Type names to visit, the node they lead to, the place inside it, and the definition it is."""
        name = target(node)
        if name is not None:
            if name not in self.chains:
                return [], {}, None, None
            chain = self.chains[name]
            return list(reversed(chain)), self.known[chain[-1]], None, chain[-1]
        kind = node.get("type") if isinstance(node, dict) else None
        typed = place and isinstance(kind, str)
        return [f"{place}/{kind}" if typed else place], node, place, None


def is_object(node: dict) -> bool:
    return isinstance(node.get("properties"), dict)


def is_array(node: dict) -> bool:
    return "items" in node


def struct_type(schema: dict) -> T.DataType:
    """The Spark type of a schema; what refers to itself, and what has no type, is JSON text."""
    walk = Walk(schema)

    def at(node: dict, seen: tuple) -> T.DataType:
        _, node, _, name = walk.names(node, None)
        if name in seen and name is not None:
            return T.StringType()
        seen = (*seen, name) if name else seen
        if is_object(node):
            return T.StructType([T.StructField(k, at(child, seen)) for k, child in node["properties"].items()])
        if is_array(node):
            return T.ArrayType(at(node["items"], seen))
        kind = node.get("type")
        return SCALARS.get(kind, T.StringType()) if isinstance(kind, str) else T.StringType()

    return at(schema, ())


def _raw_type(kind: T.DataType, inner: bool = True) -> T.DataType:
    """Arrays of strings as JSON text, so that a single string in their place is not lost."""
    if isinstance(kind, T.ArrayType):
        return T.StringType() if isinstance(kind.elementType, T.StringType) else T.ArrayType(_raw_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _raw_type(f.dataType)) for f in kind.fields])
    return kind


def _typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType):
            listed = F.when(value.startswith("["), F.from_json(value, kind))
            return F.when(value.isNotNull(), F.coalesce(listed, F.array(value)))
        return F.transform(value, lambda x: _typed(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[_typed(value[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return value


def parsed(json: Column, schema: dict) -> Column:
    """The document of a JSON text, null if it is none; a string in place of an array of strings becomes an array of one."""
    kind = struct_type(schema)
    return _typed(F.from_json(F.when(F.ltrim(json).startswith("{"), json), _raw_type(kind)), kind)


def others(json: Column, schema: dict) -> Column:
    """The members of a JSON object that the schema does not name, as a map of JSON texts in their order."""
    names = list(schema.get("properties", {}))
    return F.map_filter(F.from_json(json, "map<string,string>"), lambda k, _: ~k.isin(*names))


def visited(value: Column, schema: dict, steps: dict[str | None, Step]) -> Column:
    """The document after its steps; parents come before children, which see the new parent."""
    walk = Walk(schema)

    def at(value: Column, node: dict, place: str | None, seen: tuple) -> Column:
        names, node, place, name = walk.names(node, place)
        for own in names:
            if own in steps:
                value = steps[own](value)
        if name in seen and name is not None:
            return value
        seen = (*seen, name) if name else seen
        if is_object(node):
            parts = [at(value[k], child, f"{place}/{k}" if place else k, seen).alias(k) for k, child in node["properties"].items()]
            return F.when(value.isNotNull(), F.struct(*parts))
        if is_array(node):
            return F.transform(value, lambda x: at(x, node["items"], place, seen))
        return value

    return at(value, schema, None, ())


def _none() -> Column:
    return F.array().cast("array<string>")


def messages(value: Column, schema: dict, rule_of: Callable[[str | None, dict], list[Rule]]) -> Column:
    """Messages of all nodes that have a value, parents first, in the schema's order.

    ``rule_of`` gives the rules for a type name and its node.
    """
    walk = Walk(schema)

    def at(value: Column, node: dict, path: Column, place: str | None, seen: tuple) -> list[Column]:
        names, inner, place, name = walk.names(node, place)
        out = [F.when(value.isNotNull(), rule(value, path)) for own in names for rule in rule_of(own, inner)]
        if name in seen and name is not None:
            return out
        seen = (*seen, name) if name else seen
        if is_object(inner):
            for k, child in inner["properties"].items():
                out += at(value[k], child, F.when(path == "", F.lit(k)).otherwise(F.concat(path, F.lit(f".{k}"))), f"{place}/{k}" if place else k, seen)
        elif is_array(inner):
            def of_item(x: Column, i: Column) -> Column:
                return joined(at(x, inner["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), place, seen))

            out.append(F.flatten(F.transform(value, of_item)))
        return out

    def joined(parts: list[Column]) -> Column:
        return F.concat(*[F.coalesce(p, _none()) for p in parts]) if parts else _none()

    return joined(at(value, schema, F.lit(""), None, ()))


def enum_errors(value: Column, schema: dict) -> Column:
    """A message for each value outside its enum, with a path such as ``items[2].status``."""

    def rule_of(own: str | None, node: dict) -> list[Rule]:
        if "enum" not in node:
            return []
        text = lambda v, p: F.concat(F.when(p == "", F.lit("<root>")).otherwise(p), F.lit(" had an invalid enum value: '"), v.cast("string"), F.lit("'"))
        return [lambda v, p: F.when(~v.isin(*node["enum"]), F.array(text(v, p))).otherwise(_none())]

    # A chain of aliases has one enum, at its end.
    walk = Walk(schema)
    last = {chain[-1] for chain in walk.chains.values()}
    return messages(value, schema, lambda own, node: rule_of(own, node) if own is None or own not in walk.chains or own in last else [])


def paths(value: Column, schema: dict) -> Column:
    """Type and path of every visit, as ``type|path``."""
    return messages(value, schema, lambda own, node: [lambda v, p: F.array(F.concat(F.lit(f"{own or ''}|"), p))])


def pruned_before(value: Column, kind: T.DataType) -> Column:
    """Without the parts that are empty from the outset; parts that become empty by it remain."""
    if isinstance(kind, T.StringType):
        return F.when(~value.isin("", "null"), value)
    if isinstance(kind, T.ArrayType):
        kept = F.filter(value, lambda x: ~_empty(x, kind.elementType))
        return F.when(F.size(value) > 0, F.transform(kept, lambda x: pruned_before(x, kind.elementType)))
    if isinstance(kind, T.StructType):
        some = reduce(lambda a, b: a | b, [value[f.name].isNotNull() for f in kind.fields])
        return F.when(value.isNotNull() & some, F.struct(*[pruned_before(value[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return value


def _empty(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return value.isNull() | value.isin("", "null")
    if isinstance(kind, T.ArrayType):
        return value.isNull() | (F.size(value) == 0)
    if isinstance(kind, T.StructType):
        return value.isNull() | reduce(lambda a, b: a & b, [value[f.name].isNull() for f in kind.fields])
    return value.isNull()


def to_json(value: Column, more: Column | None = None) -> Column:
    """JSON text with keys in the schema's order and without nulls; members of the map ``more`` follow."""
    text = F.to_json(value)
    if more is None:
        return text
    pairs = F.transform(F.map_entries(more), lambda e: F.concat(F.to_json(F.array(e["key"])), F.lit(":"), _member(e["value"])))
    rest = F.array_join(F.transform(pairs, lambda p: F.regexp_replace(p, r"^\[(\"(?:[^\"\\\\]|\\\\.)*\")\]:", "$1:")), ",")
    return F.when(F.size(F.coalesce(more, F.create_map().cast("map<string,string>"))) == 0, text).otherwise(
        F.concat(F.left(text, F.length(text) - 1), F.when(text == "{}", F.lit("")).otherwise(F.lit(",")), rest, F.lit("}"))
    )


def _member(text: Column) -> Column:
    """The JSON of a member read as text: objects, arrays, numbers and booleans as they are, other texts quoted."""
    quoted = F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")
    return F.when(text.isNull(), F.lit("null")).when(text.rlike(r"^(\[.*\]|\{.*\}|-?[0-9]+(\.[0-9]+)?|true|false)$"), text).otherwise(quoted)
