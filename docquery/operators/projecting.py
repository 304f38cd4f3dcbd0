"""Projections and patches of VARIANT documents, for literal specifications."""

from __future__ import annotations

import copy
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.errors import QueryError
from docquery.plans.paths import Field, parse_path

IN, OUT = {1, True, "include"}, {0, False, "exclude"}


def parse_projection(spec: dict) -> tuple[bool, dict]:
    """(include?, tree of field names). Errors: 2045 mixed, 2056 array steps, 2057 overlapping paths."""
    modes, tree = set(), {}
    for text, mode in spec.items():
        if mode not in IN | OUT or isinstance(mode, float):
            raise QueryError(2044, f"{mode!r} is neither include nor exclude")
        modes.add(mode in IN)
        path = parse_path(text)
        if not all(isinstance(s, Field) for s in path):
            raise QueryError(2056, f"a projection takes fields only, not {text!r}")
        at = tree
        for k, step in enumerate(path):
            last = k == len(path) - 1
            if at.get(step.name, {}) is None or (last and step.name in at):
                raise QueryError(2057, f"{text!r} overlaps another path")
            at = at.setdefault(step.name, None if last else {})
    if len(modes) > 1:
        raise QueryError(2045, "a projection includes or excludes, not both")
    return modes != {False}, tree


def _object(item: Column) -> Column:
    return F.try_variant_get(item, "$", "map<string,variant>")


def _rebuilt(entries: Column) -> Column:
    return F.parse_json(F.to_json(F.map_from_entries(entries)))


def project(doc: Column, spec: dict) -> Column:
    """The document with only, or without, the fields of a specification; arrays on the way are mapped over."""
    include, tree = parse_projection(spec)
    return _walk(doc, include, tree)


def _walk(item: Column, include: bool, tree: dict) -> Column:
    def on_object(x: Column) -> Column:
        def change(e: Column) -> Column:
            value = e["value"]
            for name, below in tree.items():
                if below:
                    value = F.when(e["key"] == name, _walk(e["value"], include, below)).otherwise(value)
            return F.struct(e["key"].alias("key"), value.alias("value"))

        named = list(tree)
        gone = [n for n, below in tree.items() if below is None]
        entries = F.map_entries(_object(x))
        kept = F.filter(entries, lambda e: e["key"].isin(named) if include else ~e["key"].isin(gone) if gone else F.lit(True))
        return _rebuilt(F.transform(kept, change))

    elements = F.try_variant_get(item, "$", "array<variant>")
    mapped = F.parse_json(F.to_json(F.transform(elements, lambda x: F.when(_object(x).isNotNull(), on_object(x)).otherwise(x))))
    return F.when(elements.isNotNull(), mapped).when(_object(item).isNotNull(), on_object(item)).otherwise(item)


def merge_patch(doc: Column, patch: dict) -> Column:
    """RFC 7396: members of the patch replace those of the document, null removes, objects merge."""
    if not isinstance(patch, dict):
        return F.parse_json(F.lit(json.dumps(patch)))
    old = F.coalesce(_object(doc), F.map_from_entries(F.array().cast("array<struct<key:string,value:variant>>")))
    entries = F.filter(F.map_entries(old), lambda e: ~e["key"].isin(list(patch))) if patch else F.map_entries(old)
    new = [
        F.struct(F.lit(k).alias("key"), (merge_patch(old[k], v) if isinstance(v, dict) else F.parse_json(F.lit(json.dumps(v)))).alias("value"))
        for k, v in patch.items()
        if v is not None
    ]
    return _rebuilt(F.concat(entries, F.array(*new)) if new else entries)


def _pointer(text: str) -> list[str]:
    if text and not text.startswith("/"):
        raise QueryError(2101, f"{text!r} is no JSON pointer")
    return [p.replace("~1", "/").replace("~0", "~") for p in text.split("/")[1:]]


def _index(at: list, step: str, size: int) -> int:
    if step == "-":
        return len(at)
    if not step.isdecimal() or (len(step) > 1 and step[0] == "0") or int(step) > size:
        raise KeyError(step)
    return int(step)


def _find(doc, steps: list[str]):
    for s in steps:
        doc = doc[_index(doc, s, len(doc) - 1)] if isinstance(doc, list) else doc[s]
    return doc


def _set(doc, steps: list[str], value, replace: bool):
    if not steps:
        return value
    at, last = _find(doc, steps[:-1]), steps[-1]
    if isinstance(at, list):
        if replace:
            at[_index(at, last, len(at) - 1)] = value
        else:
            at.insert(_index(at, last, len(at)), value)
    elif isinstance(at, dict):
        if replace and last not in at:
            raise KeyError(last)
        at[last] = value
    else:
        raise KeyError(last)
    return doc


def same(a, b) -> bool:
    """Whether two parsed JSON values are equal; true and 1 aren't."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(v, b[k]) for k, v in a.items())
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    return a == b


def apply_patch(doc, patch: list[dict]):
    """RFC 6902 on one parsed document; KeyError or ValueError where an operation doesn't apply."""
    doc = copy.deepcopy(doc)
    for step in patch:
        op, path = step["op"], _pointer(step["path"])
        if op in ("add", "replace"):
            doc = _set(doc, path, copy.deepcopy(step["value"]), op == "replace")
        elif op == "remove":
            at = _find(doc, path[:-1])
            del at[_index(at, path[-1], len(at) - 1) if isinstance(at, list) else path[-1]]
        elif op in ("move", "copy"):
            source = _pointer(step["from"])
            value = copy.deepcopy(_find(doc, source))
            if op == "move":
                doc = apply_patch(doc, [{"op": "remove", "path": step["from"]}])
            doc = _set(doc, path, value, False)
        elif op == "test":
            if not same(_find(doc, path), step["value"]):
                raise ValueError("test failed")
        else:
            raise QueryError(2101, f"{op!r} is no patch operation")
    return doc


def json_patch(doc: Column, patch: list[dict]) -> Column:
    """RFC 6902; null where an operation doesn't apply to a document. Arrow batches of JSON texts."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(apply_patch(json.loads(text), patch), ensure_ascii=False)
        except (KeyError, ValueError, IndexError, TypeError):
            return None

    return F.parse_json(F.pandas_udf(lambda texts: texts.map(one).astype(object).where(lambda s: s.notna(), None), "string")(F.to_json(doc)))


