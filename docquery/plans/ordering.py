"""$orderby specifications to sort columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.errors import QueryError
from docquery.functions.values import get, is_kind, kind, moment_of, sort_key
from docquery.plans.lower import Root, items_at, opened, singleton
from docquery.plans.paths import Step, Subscripts, parse_path

KINDS = {"json": "json", "any": "json", "number": "number", "date": "date", "datetime": "timestamp_ntz", "string": "string", "varchar": "string", "varchar2": "string"}


@dataclass(frozen=True)
class Key:
    path: tuple[Step, ...]
    kind: str = "json"
    descending: bool = False
    max_length: int | None = None
    min_max: bool = False


def _path(text) -> tuple[Step, ...]:
    path = parse_path(text)
    if any(isinstance(s, Subscripts) for s in path):
        raise QueryError(5022, "an order path takes no array steps")
    return path


def _rank(name: str, n) -> int:
    if isinstance(n, bool) or not isinstance(n, int | str | float):
        raise QueryError(5035, f"the order of {name} is no integer")
    try:
        value = int(n) if not isinstance(n, float) else int(n) if n.is_integer() else _fail(name)
    except ValueError:
        _fail(name)
    if value == 0:
        raise QueryError(5036, f"the order of {name} is zero")
    return value


def _fail(name: str):
    raise QueryError(5035, f"the order of {name} is no integer")


def parse_order(spec) -> tuple[list[Key], str | None]:
    """Keys in order, and the error clause: None, "lax" or "scalar_required"."""
    clause = None
    if isinstance(spec, dict) and "$fields" in spec:
        if spec.get("$lax") and spec.get("$scalarRequired"):
            raise QueryError(5058, "$lax and $scalarRequired exclude each other")
        clause = "lax" if spec.get("$lax") else "scalar_required" if spec.get("$scalarRequired") else "strict"
        spec = spec["$fields"]
    if isinstance(spec, dict):
        ranked = [(abs(r := _rank(name, n)), r < 0, name) for name, n in spec.items()]
        return [Key(_path(name), descending=down) for _, down, name in sorted(ranked, key=lambda x: x[0])], clause
    if not isinstance(spec, list):
        raise QueryError(5056, "$orderby takes an object or an array")
    keys = []
    for part in spec:
        extra = set(part) - {"path", "datatype", "order", "maxLength", "sortByMinMax"}
        if extra:
            raise QueryError(5055, f"unknown property {sorted(extra)}")
        if "path" not in part:
            raise QueryError(5054, "a part of $orderby has no path")
        if part.get("datatype", "any") not in KINDS:
            raise QueryError(5057, f"unknown datatype {part['datatype']}")
        if part.get("order", "asc") not in ("asc", "desc"):
            raise QueryError(5056, "order is asc or desc")
        if "maxLength" in part and (isinstance(part["maxLength"], bool) or not isinstance(part["maxLength"], int) or part["maxLength"] < 1):
            raise QueryError(5056, "maxLength is a positive integer")
        keys.append(Key(_path(part["path"]), KINDS[part.get("datatype", "any")], part.get("order") == "desc", part.get("maxLength"), bool(part.get("sortByMinMax"))))
    return keys, clause


def _typed(item: Column, key: Key) -> Column:
    if key.kind == "json":
        return sort_key(item)
    if key.kind == "number":
        return F.when(is_kind(item, "number"), get(item, "double")).when(is_kind(item, "string"), get(item, "string").try_cast("double"))
    text = F.when(kind(item).isin("string", "number", "boolean"), get(item, "string"))
    if key.kind == "string":
        return F.substring(text, 1, key.max_length) if key.max_length else text
    return moment_of(text, key.kind)


def sort_columns(keys: list[Key], clause: str | None, doc: Column | Root) -> list[Column]:
    """Missing values come last when ascending and first when descending; sortByMinMax is the other way round.

    Strict clauses fail the query on a container or a value of another type, and scalar_required
    on a missing one too; without a clause, and with lax, such values are null.
    """
    out = []
    for key in keys:
        item = singleton(doc, key.path)
        if key.min_max:
            elements = F.transform(opened(items_at(doc, key.path)), lambda x: _typed(x, key))
            out.append(F.array_max(elements).desc_nulls_last() if key.descending else F.array_min(elements).asc_nulls_first())
            continue
        value = _typed(item, key)
        if clause in ("strict", "scalar_required"):
            bad = item.isNotNull() & (kind(item).isin("array", "object") | (value.isNull() & (kind(item) != "null")))
            if clause == "scalar_required":
                bad = bad | item.isNull()
            value = F.when(bad, F.raise_error(F.lit("[5059] a document has no value to order by of the type asked for"))).otherwise(value)
        out.append(value.desc_nulls_first() if key.descending else value.asc_nulls_last())
    return out
