"""Filter trees to Catalyst columns over a VARIANT document.

Navigation is lax: a field step opens an array, an array step takes any other item as an array
of one, and comparisons look at the elements of arrays. Negation is two-valued: every leaf is
false where it can't be decided, before anything negates it. The first field steps of a path
are one literal path outside all lambdas, so the scan reads only those parts of the document.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.errors import QueryError
from docquery.functions import geo, text
from docquery.functions.values import MODIFIERS, MOMENTS, WHOLE, canonical_json, compare, get, like_pattern, plain, unwrapped
from docquery.plans.paths import Bound, Descend, Field, Step, Subscripts, Wildcard, json_path
from docquery.plans.qbe import REGEXES, And, Not, Or, Scope, Special, Test


@dataclass(frozen=True)
class Root:
    """A document and, where its collection has them, its members as items of their own."""

    doc: Column
    members: dict[str, Column]


def at_names(item: Column | Root, kind: str, names: list[str]) -> Column:
    """What a path of field names, not empty, reads from an item or a document."""
    if isinstance(item, Root):
        if names[0] in item.members:
            member = item.members[names[0]]
            return member if len(names) == 1 and kind == "variant" else get(member, kind, json_path(names[1:]))
        item = item.doc
    return get(item, kind, json_path(names))


def present(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())


def opened(items: Column) -> Column:
    return F.flatten(F.transform(items, unwrapped))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _below(items: pd.Series) -> pd.Series:
    """All values under some items, the items included, as JSON texts: depth has no bound, so no column expression can say it."""

    def walk(v):
        yield v
        for x in v.values() if isinstance(v, dict) else v if isinstance(v, list) else ():
            yield from walk(x)

    return items.map(lambda texts: [json.dumps(v, ensure_ascii=False) for t in (texts if texts is not None else ()) for v in walk(json.loads(t))])


def _position(b: Bound, last: Column) -> Column:
    return last - b.offset if b.from_last else F.lit(b.offset)


def _chosen(item: Column, step: Subscripts) -> Column:
    elements = unwrapped(item)
    if step.ranges is None:
        return elements
    last = F.size(elements) - 1

    def wanted(_, i: Column) -> Column:
        tests = [(i >= _position(low, last)) & (i <= _position(high, last)) for low, high in step.ranges]
        return _any(tests)

    return F.filter(elements, wanted)


def step_into(items: Column, step: Step) -> Column:
    """The items that a step reaches from an array of items."""
    if isinstance(step, Field):
        return present(F.transform(opened(items), lambda x: get(x, "variant", json_path([step.name]))))
    if isinstance(step, Wildcard):
        return F.flatten(F.transform(opened(items), lambda x: F.coalesce(F.map_values(get(x, "map<string,variant>")), F.array().cast("array<variant>"))))
    if isinstance(step, Descend):
        return F.transform(_below(F.transform(items, lambda x: F.to_json(x))), lambda t: F.parse_json(t))
    return F.flatten(F.transform(items, lambda x: _chosen(x, step)))


def items_at(item: Column | Root, path: tuple[Step, ...]) -> Column:
    """Array of the items that a path reaches from one item, arrays at its end not opened."""
    if path and isinstance(path[0], Field):
        items, path = present(F.array(at_names(item, "variant", [path[0].name]))), path[1:]
    else:
        items = F.array(item.doc if isinstance(item, Root) else item)
    for step in path:
        items = step_into(items, step)
    return items


def _any(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = t if out is None else out | t
    return out


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def item_test(test: Test) -> Callable[[Column], Column]:
    """item -> whether it meets the operator; null counts as no."""
    op, operand, modifier = test.op, test.operand, test.modifier
    read = MODIFIERS[modifier] if modifier else plain
    moment = modifier in MOMENTS

    def of(item: Column) -> Column:
        value = read(item)
        if op in ("$eq", "gt", "lt", "gte", "lte"):
            return compare(value, op.removeprefix("$"), operand, moment)
        if op == "$in":
            return _any([F.coalesce(_value_test(item, v["$value"]) if isinstance(v, dict) else compare(value, "eq", v, moment), F.lit(False)) for v in operand])
        if op == "$between":
            low, high = operand
            return _all([compare(value, o, v, moment) for o, v in (("gte", low), ("lte", high)) if v is not None])
        if op == "$mod":
            divisor, rest = operand
            return F.floor(value.number) % divisor == rest
        if op == "$value":
            return _value_test(item, operand)
        if op in REGEXES:
            flags, whole = REGEXES[op]
            pattern = f"^(?:{operand})$" if whole else operand
            prefix = "".join(f for f, on in (("s", "nl" in flags), ("i", "ci" in flags)) if on)
            return value.text.rlike(f"(?{prefix}){pattern}" if prefix else pattern)
        return {
            "$startsWith": lambda t: t.startswith(operand), "$hasSubstring": lambda t: t.contains(operand),
            "$instr": lambda t: t.contains(operand), "$like": lambda t: t.rlike("^" + like_pattern(operand) + "$"),
        }[op](value.text)

    return of


def _value_test(item: Column, literal) -> Column:
    """Deep equality, on VARIANT's JSON text: keys ordered, trailing zeros dropped."""
    return F.to_json(item) == canonical_json(literal)


def sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def lower(node, item: Column | Root) -> Column:
    """The column, true or false and never null, that says whether an item meets a node. $sqlJson and spatial leaves may be null."""
    if isinstance(node, And):
        return _all([lower(c, item) for c in node.children])
    if isinstance(node, Or):
        return _any([lower(c, item) for c in node.children])
    if isinstance(node, Not):
        return ~lower(node.child, item)
    if isinstance(node, Scope):
        items = items_at(item, node.path)
        return sure(F.exists(items if node.whole else opened(items), lambda x: lower(node.child, x)))
    if isinstance(node, Special):
        return special(node, item)
    if node.op == "$exists":
        return sure(F.size(items_at(item, node.path)) > 0)
    of = item_test(node)
    if not node.path:
        return sure(of(item))
    items = items_at(item, node.path)
    whole = node.modifier in WHOLE or node.op == "$value"
    return sure(F.exists(items if whole else opened(items), lambda x: sure(of(x))))


def singleton(item: Column | Root, path: tuple[Step, ...]) -> Column:
    """The one item of a path, array steps ignored; null if missing."""
    return at_names(item, "variant", [s.name for s in path if isinstance(s, Field)])


def special(node: Special, item: Column | Root) -> Column:
    if node.op == "$sqlJson":
        names = [s.name for s in node.path if isinstance(s, Field)]
        tests = []
        for op, v in node.operand:
            kind = "double" if isinstance(v, int | float) and not isinstance(v, bool) else "boolean" if isinstance(v, bool) else "string"
            left = at_names(item, kind, names)
            right = F.lit(float(v) if kind == "double" else v)
            name = {"$ge": "$gte", "$le": "$lte"}.get(op, op)
            tests.append(
                left.isNull() if v is None
                else {"$eq": left == right, "$gt": left > right, "$gte": left >= right, "$lt": left < right, "$lte": left <= right}[name]
            )
        return _all(tests)
    if node.op == "$contains":
        return text.contains(items_at(item, node.path), node.operand)
    geometry = singleton(item, node.path)
    operand = node.operand
    if node.op == "$near" and math.isnan(float(operand.get("$distance", 0))):
        raise QueryError(5047, "$distance is a number")
    return geo.relation(node.op, geometry, operand)
