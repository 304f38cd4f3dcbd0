"""Items of documents as typed values.

An item is a VARIANT column, inside a lambda or not. A `Value` gives its readings as number,
text, truth and moment; a reading is null where the item is not natively of that type, so a
comparison with a literal of another type is null and counts as false.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(38,18)"
#: Texts that $number and $double read; not NaN or Infinity.
NUMERAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NUMBERS = r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL.*|DOUBLE|FLOAT)$"


def get(item: Column, kind: str, path: str = "$") -> Column:
    return F.try_variant_get(item, path, kind)


#: The first word of an item's schema -> its kind; all other types are "other".
KINDS = {"VOID": "null", "BOOLEAN": "boolean", "STRING": "string", "ARRAY": "array", "OBJECT": "object"} | dict.fromkeys(
    ("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT"), "number"
)


def kind(item: Column) -> Column:
    """null, boolean, number, string, array, object, or other, with one look at the item's schema, which walks through containers."""
    first = F.regexp_extract(F.schema_of_variant(item), "^[A-Z]+", 0)
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(v) for pair in KINDS.items() for v in pair)), first), F.lit("other"))


def is_kind(item: Column, wanted: str) -> Column:
    """kind(item) == wanted for the kinds of scalars, with one look at the item's type."""
    t = F.schema_of_variant(item)
    return {"number": t.rlike(NUMBERS), "string": t == "STRING", "boolean": t == "BOOLEAN", "null": t == "VOID"}[wanted]


def unwrapped(item: Column) -> Column:
    """The elements of an array; anything else as the one element of an array."""
    return F.coalesce(get(item, "array<variant>"), F.array(item))


@dataclass(frozen=True)
class Value:
    """exact: the number as decimal(38, 18), null beyond its range; only comparisons with large whole numbers look at it."""

    number: Column
    text: Column
    truth: Column
    moment: Column
    null: Column
    exact: Column | None = None


def _value(number=None, text=None, truth=None, moment=None, null=None, exact=None) -> Value:
    void = lambda c, t: F.lit(None).cast(t) if c is None else c
    return Value(void(number, "double"), void(text, "string"), void(truth, "boolean"), void(moment, "timestamp_ntz"), void(null, "boolean"), exact)


def plain(item: Column) -> Value:
    number = is_kind(item, "number")
    return _value(
        F.when(number, get(item, "double")), F.when(is_kind(item, "string"), get(item, "string")),
        F.when(is_kind(item, "boolean"), get(item, "boolean")), None, is_kind(item, "null"), F.when(number, get(item, DECIMAL)),
    )


def canonical_text(item: Column) -> Column:
    """Numbers without trailing zeros or exponent (but for those a decimal can't hold), booleans and strings as text; null for all else."""
    k = kind(item)
    exact = get(item, DECIMAL)
    plainly = F.regexp_replace(F.regexp_replace(exact.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    held = exact.isNotNull() & ((exact != 0) | (get(item, "double") == 0))
    return F.when(k == "number", F.when(held, F.when(exact == 0, "0").otherwise(plainly)).otherwise(get(item, "string"))).when(k.isin("string", "boolean"), get(item, "string"))


def _read_number(item: Column, cast: str) -> Column:
    text = get(item, "string")
    return F.when(is_kind(item, "number"), get(item, cast)).when(is_kind(item, "string") & text.rlike(NUMERAL), F.trim(text).try_cast(cast))


def _number(item: Column) -> Value:
    return _value(number=_read_number(item, "double"), exact=_read_number(item, DECIMAL))


def _case(item: Column, change: Callable[[Column], Column]) -> Value:
    text = canonical_text(item)
    return _value(text=F.when(text != "", change(text)))


def _native_number(item: Column, change: Callable[[Column], Column]) -> Value:
    return _value(number=change(F.when(is_kind(item, "number"), get(item, "double"))).cast("double"))


def _boolean(item: Column) -> Value:
    k, text = kind(item), get(item, "string")
    return _value(truth=F.when(k == "boolean", get(item, "boolean")).when((k == "string") & text.isin("true", "false"), text == "true"))


def moment_of(text: Column, cast: str = "timestamp_ntz") -> Column:
    """An ISO date or time as a timestamp without zone, in UTC: Z means UTC, and an offset after the time is taken off."""
    zone = r"^(.*T.*)([+-])(\d{2}):?(\d{2})$"
    bare = F.regexp_replace(F.regexp_replace(text, r"(?i)z$", ""), zone, "$1").try_cast("timestamp_ntz")
    part = lambda k: F.regexp_extract(text, zone, k).cast("int")
    minutes = F.when(text.rlike(zone), F.when(F.regexp_extract(text, zone, 2) == "-", -1).otherwise(1) * (60 * part(3) + part(4))).otherwise(0)
    at = bare - F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    return at.cast("date").cast("timestamp_ntz") if cast == "date" else at


def _moment(item: Column, cast: str) -> Value:
    return _value(moment=moment_of(F.when(is_kind(item, "string"), get(item, "string")), cast))


def _only(item: Column, wanted: str) -> Value:
    p, k = plain(item), is_kind(item, wanted)
    return _value(F.when(k, p.number), F.when(k, p.text), F.when(k, p.truth), exact=F.when(k, p.exact))


#: Modifier -> its reading of an item.
MODIFIERS: dict[str, Callable[[Column], Value]] = {
    "$number": _number,
    "$double": lambda x: _value(number=_read_number(x, "double")),
    "$string": lambda x: _value(text=canonical_text(x)),
    "$boolean": _boolean,
    "$date": lambda x: _moment(x, "date"),
    "$timestamp": lambda x: _moment(x, "timestamp_ntz"),
    "$binary": lambda x: _value(text=F.hex(F.try_to_binary(F.when(kind(x) == "string", get(x, "string")), F.lit("base64")))),
    "$ceiling": lambda x: _native_number(x, F.ceil),
    "$floor": lambda x: _native_number(x, F.floor),
    "$abs": lambda x: _native_number(x, F.abs),
    "$upper": lambda x: _case(x, F.upper),
    "$lower": lambda x: _case(x, F.lower),
    "$length": lambda x: _value(number=F.when(is_kind(x, "string"), F.length(get(x, "string"))).cast("double")),
    "$size": lambda x: _value(number=F.coalesce(F.size(get(x, "array<variant>")), F.lit(1)).cast("double")),
    "$type": lambda x: _value(text=kind(x)),
    "$numberOnly": lambda x: _only(x, "number"),
    "$stringOnly": lambda x: _only(x, "string"),
    "$booleanOnly": lambda x: _only(x, "boolean"),
    "$dateTimeOnly": lambda x: _value(moment=F.when(F.schema_of_variant(x).rlike("^(DATE|TIMESTAMP.*)$"), get(x, "timestamp_ntz"))),
    "$binaryOnly": lambda x: _value(text=F.when(F.schema_of_variant(x) == "BINARY", F.hex(get(x, "binary")))),
    "$idOnly": lambda x: _value(text=F.when((kind(x) == "string") & get(x, "string").rlike("^[0-9a-fA-F]{24}$"), get(x, "string"))),
}
#: These look at an array itself, not at its elements.
WHOLE = frozenset({"$size", "$type"})
MOMENTS = frozenset({"$date", "$timestamp", "$dateTimeOnly"})


def like_pattern(text: str) -> str:
    return "(?s)" + "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in text)


def compare(value: Value, op: str, operand, moment: bool = False) -> Column:
    """value op operand, null or false where their types differ. op: eq gt lt gte lte."""
    if operand is None:
        return value.null if op == "eq" else F.lit(False)
    if isinstance(operand, bool):
        return value.truth == F.lit(operand) if op == "eq" else F.lit(False)
    tests = {"eq": lambda x, y: x == y, "gt": lambda x, y: x > y, "lt": lambda x, y: x < y, "gte": lambda x, y: x >= y, "lte": lambda x, y: x <= y}
    if moment:
        return tests[op](value.moment, moment_of(F.lit(str(operand))))
    if isinstance(operand, str):
        return tests[op](value.text, F.lit(operand))
    found = tests[op](value.number, F.lit(float(operand)))
    if isinstance(operand, int) and value.exact is not None and 2**53 <= abs(operand) < 10**20:  # doubles tell smaller whole numbers apart
        return F.coalesce(tests[op](value.exact, F.lit(Decimal(operand))), found)
    return found


def sort_key(item: Column) -> Column:
    """A struct that orders items of all types: null, false, true, numbers, strings, then containers by their text."""
    k = kind(item)
    rank = F.when(k == "null", 0).when(k == "boolean", F.when(get(item, "boolean"), 2).otherwise(1)).when(k == "number", 3).when(k == "other", 4).when(k == "string", 5).otherwise(6)
    text = F.when(k == "string", get(item, "string")).when(k.isin("array", "object", "other"), F.to_json(item))
    return F.when(item.isNotNull(), F.struct(rank.alias("rank"), F.when(k == "number", get(item, "double")).alias("number"), text.alias("text")))


def canonical_json(value) -> Column:
    """A literal as VARIANT's own JSON text writes it: keys in order, whole numbers without a point."""

    def neat(v):
        if isinstance(v, float) and v.is_integer() and abs(v) < 2**53:
            return int(v)
        if isinstance(v, dict):
            return {k: neat(x) for k, x in v.items()}
        return [neat(x) for x in v] if isinstance(v, list) else v

    return F.to_json(F.parse_json(F.lit(json.dumps(neat(value), ensure_ascii=False))))
