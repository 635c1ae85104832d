"""Projection of dotted, indexed and wildcard paths out of nested columns.

A path such as ``prices[*][0]`` or ``meta.items[2].id`` becomes one Column
expression; nothing is evaluated per row in Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = re.compile(r"\[(\*|\d+)\]|([^.\[\]]+)")
PARAMETER_PREFIX = "_param."


def steps(path: str) -> list[str | int]:
    """``a.b[*][0]`` as ``['a', 'b', '*', 0]``."""
    out: list[str | int] = []
    for bracket, name in _STEP.findall(path):
        out.append(name if name else bracket if bracket == "*" else int(bracket))
    return out


def is_wildcard(path: str) -> bool:
    return "[*]" in path


def _child(data_type: T.DataType | None, step: str | int) -> T.DataType | None:
    """Type below ``step``, or None when the schema has nothing there."""
    if isinstance(step, int) or step == "*":
        return data_type.elementType if isinstance(data_type, T.ArrayType) else None
    if isinstance(data_type, T.StructType) and step in data_type.names:
        return data_type[step].dataType
    return None


def _walk(value: Column, data_type: T.DataType, rest: list[str | int]) -> Column:
    for i, step in enumerate(rest):
        child = _child(data_type, step)
        if step == "*":
            if child is None:
                return F.array()
            tail = rest[i + 1:]
            items = F.transform(value, lambda v: _walk(v, child, tail)) if tail else value
            # A missing array is an empty one at the top, null inside another wildcard.
            return items
        if child is None:
            return F.lit(None)
        value = F.get(value, F.lit(step)) if isinstance(step, int) else value.getField(step)
        data_type = child
    return value


def project(payload: Column, schema: T.StructType, path: str) -> Column:
    """The value at ``path`` in a struct column of type ``schema``.

    Missing keys, wrong containers and out-of-range indexes give null; a
    wildcard over something that is no array gives an empty array.
    """
    parts = steps(path)
    value = _walk(payload, schema, parts)
    return F.coalesce(value, F.array()) if "*" in parts else value


def parameter(path: str, parameters: dict[str, Column | str]) -> Column:
    """``_param.k``: a value of the request, not of the response."""
    value = parameters.get(path[len(PARAMETER_PREFIX):])
    return value if isinstance(value, Column) else F.lit(value)


def payload_schema(paths: dict[str, str]) -> T.StructType:
    """Smallest schema holding every path; ``paths`` maps a path to its leaf type.

    Reading JSON with it prunes everything the contract does not mention.
    """
    tree: dict = {}
    for path, leaf in paths.items():
        if path.startswith(PARAMETER_PREFIX):
            continue
        node = tree
        parts = steps(path)
        for part in parts[:-1]:
            node = node.setdefault("[]" if part == "*" or isinstance(part, int) else part, {})
        last = "[]" if parts[-1] == "*" or isinstance(parts[-1], int) else parts[-1]
        # One element type an array: different leaf types of it meet in the double.
        node[last] = leaf if node.get(last, leaf) == leaf else "double"

    def build(node) -> T.DataType:
        if isinstance(node, str):
            return T.StructType.fromDDL(f"v {node}")["v"].dataType
        if "[]" in node:
            return T.ArrayType(build(node["[]"]))
        return T.StructType([T.StructField(k, build(v)) for k, v in node.items()])

    built = build(tree)
    return built if isinstance(built, T.StructType) else T.StructType([])
