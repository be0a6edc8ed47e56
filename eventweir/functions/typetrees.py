"""Type trees of JSON values: their join, hints laid over them, and their declared form.

A tree is a Spark type.  ``void`` stands for values that were always null, an object without fields
for one that was always empty, text also for every mixture.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import types as T

VOID, TEXT, DOUBLE = T.NullType(), T.StringType(), T.DoubleType()
_NUMBERS = (T.LongType, T.DoubleType)


def join(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both.

    Null lies below all, whole numbers below fractions; objects meet by name and arrays by element;
    everything else only has text above it.  The order and grouping of joins change nothing, and
    joining what is known already changes nothing either.
    """
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType) or a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return struct_of({f.name: f.dataType for f in a}, {f.name: f.dataType for f in b})
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join(a.elementType, b.elementType))
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        return DOUBLE
    return TEXT


def struct_of(*parts: Mapping[str, T.DataType]) -> T.StructType:
    """An object with the fields of all parts, sorted by name, equal names joined."""
    names = sorted({name for part in parts for name in part})
    return T.StructType(
        [T.StructField(n, join_all(part[n] for part in parts if n in part)) for n in names]
    )


def join_all(trees: Iterable[T.DataType]) -> T.DataType:
    return reduce(join, trees, VOID)


def declared(tree: T.DataType) -> T.DataType:
    """The tree as it is declared: text for what was always null or always empty."""
    if isinstance(tree, T.NullType) or isinstance(tree, T.StructType) and not tree.fields:
        return TEXT
    if isinstance(tree, T.StructType):
        return T.StructType([T.StructField(f.name, declared(f.dataType)) for f in tree])
    if isinstance(tree, T.ArrayType):
        return T.ArrayType(declared(tree.elementType))
    return tree


def overlay(inferred: T.DataType, hint: T.DataType) -> T.DataType:
    """The inferred tree with the hinted parts replaced, at any depth.

    A hinted object or array changes only the fields or elements it names, where an object or array
    was inferred too; every other hint replaces what was inferred.  Hinted fields that were never
    seen are added behind the others.
    """
    if isinstance(inferred, T.StructType) and isinstance(hint, T.StructType):
        hints = {f.name: f.dataType for f in hint}
        own = [
            T.StructField(
                f.name, overlay(f.dataType, hints.pop(f.name)) if f.name in hints else f.dataType
            )
            for f in inferred
        ]
        return T.StructType(own + [T.StructField(name, kind) for name, kind in hints.items()])
    if isinstance(inferred, T.ArrayType) and isinstance(hint, T.ArrayType):
        return T.ArrayType(overlay(inferred.elementType, hint.elementType))
    return hint


def path_hints(hints: Mapping[str, str]) -> T.StructType:
    """Hints given by path, ``{"o.p": "string", "l[].x": "double"}``, as one partial tree.

    Names with a dot or bracket are quoted, as in the field profile.  A path below another that is
    hinted as something plain is refused.
    """
    fields: dict = {}
    for path, ddl in hints.items():
        node = fields
        *outer, last = _steps(path)
        for step in outer:
            node = node.setdefault(step, {})
            if not isinstance(node, dict):
                raise ValueError(f"{path} lies in a field that is hinted as plain")
        if last in node:
            raise ValueError(f"{path} is hinted twice")
        node[last] = T.DataType.fromDDL(ddl)
    return _tree(fields)


def _steps(path: str) -> list[str]:
    """``a.b[].c`` as a, b, [], c; a quoted name is one step."""
    steps, at = [], 0
    while at < len(path):
        if path.startswith("[]", at):
            steps.append("[]")
            at += 2
        elif path[at] == "`":
            end = path.index("`", at + 1)
            steps.append(path[at : end + 1])
            at = end + 1
        elif path[at] == ".":
            at += 1
        else:
            end = min(i for i in (path.find(".", at), path.find("[]", at), len(path)) if i >= 0)
            steps.append(path[at:end])
            at = end
    if not steps or steps[0] == "[]":
        raise ValueError(f"{path!r} names no field")
    return steps


def _tree(node) -> T.DataType:
    if not isinstance(node, dict):
        return node
    if "[]" in node:
        if len(node) > 1:
            raise ValueError("a field is hinted as an array and as an object")
        return T.ArrayType(_tree(node["[]"]))
    return T.StructType([T.StructField(n.strip("`"), _tree(kind)) for n, kind in node.items()])
