"""The operation builder: a lazy, immutable description of a read over documents."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.errors import QueryError
from docquery.operators import aggregate, projecting
from docquery.plans.lower import Root, lower
from docquery.plans.ordering import parse_order, sort_columns
from docquery.plans.paths import Field
from docquery.plans.qbe import And, Not, Or, Query, Scope, Special, Test, parse_query

#: Keys up to which IN is a list of literals; more are joined.
MAX_LITERAL_KEYS = 1_000
#: Bytes of a string in a filter of distinct and summarize.
MAX_OPERAND_BYTES = 4_000
#: What duality views don't take, and the error.
DUALITY = {"$near": 5071, "$within": 5071, "$intersects": 5071, "$contains": 5072, "$sqlJson": 5073}
#: Hints that are Spark's own; others are accepted and left aside.
HINTS = {"broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl", "coalesce", "repartition", "repartition_by_range", "rebalance"}
HEADERS = ("key", "version", "last_modified", "created_on", "media_type")


def _specials(node) -> list[str]:
    if isinstance(node, And | Or):
        return [s for c in node.children for s in _specials(c)]
    if isinstance(node, Not | Scope):
        return _specials(node.child)
    return [node.op] if isinstance(node, Special) else []


def _strings(node) -> list[str]:
    """All strings that a filter compares with."""
    if isinstance(node, And | Or):
        return [s for c in node.children for s in _strings(c)]
    if isinstance(node, Not | Scope):
        return _strings(node.child)
    values = node.operand if isinstance(node.operand, list | tuple) else [node.operand]
    return [v for v in values if isinstance(v, str)]


def necessary(node, kinds: dict[str, str]) -> Column | None:
    """A condition on the columns of `plain` that holds wherever the filter does, so that it can reach the scan; None if there is none.

    kinds: member -> "text" or "number". Members are scalars there, and a null one is missing in the document.
    """
    if isinstance(node, And):
        parts = [p for c in node.children if (p := necessary(c, kinds)) is not None]
        out = parts[0] if parts else None
        for part in parts[1:]:
            out = out & part
        return out
    if isinstance(node, Scope) and isinstance(node.child, And) and len(node.path) == 1:
        return necessary(And(tuple(dataclasses.replace(c, path=node.path) for c in node.child.children if isinstance(c, Test) and not c.path)), kinds)
    if not isinstance(node, Test) or node.modifier or len(node.path) != 1 or not isinstance(node.path[0], Field) or node.path[0].name not in kinds:
        return None
    name, operand = node.path[0].name, node.operand
    text = isinstance(operand, str)
    if not (text or isinstance(operand, int | float) and not isinstance(operand, bool) and abs(operand) < 2**53) or (kinds[name] == "text") != text:
        return None
    column, value = F.col("plain")[name], F.lit(operand)
    return {"$eq": column == value, "gt": column > value, "lt": column < value, "gte": column >= value, "lte": column <= value}.get(node.op)


@dataclass(frozen=True)
class Find:
    """docs: a DataFrame with key and doc, and any of content and the other header columns."""

    docs: DataFrame
    query: Query | None = None
    key_list: tuple[str, ...] | None = None
    like: tuple[str, str | None] | None = None
    start: tuple[str, bool, bool] | None = None
    wanted_version: str | None = None
    wanted_modified: str | None = None
    since_until: tuple[str | None, str | None, bool] | None = None
    n_skip: int | None = None
    n_limit: int | None = None
    by_key: bool = True
    headers: bool = False
    projection: dict | None = None
    hints: tuple[str, ...] = ()
    key_direction: bool | None = None
    locked: bool = False
    duality: bool = False

    # keys: the last of key, keys, keyLike and startKey to be called holds

    def key(self, k: str) -> Find:
        if k is None:
            raise QueryError(2010, "a key can't be null")
        return replace(self, key_list=(str(k),), like=None, start=None)

    def keys(self, ks) -> Find:
        if not ks:
            raise QueryError(2011, "keys takes at least one key")
        if any(k is None for k in ks):
            raise QueryError(2010, "a key can't be null")
        return replace(self, key_list=tuple(map(str, ks)), like=None, start=None)

    def key_like(self, pattern: str, escape: str | None = None) -> Find:
        return replace(self, like=(pattern, escape), key_list=None, start=None)

    def start_key(self, k: str, ascending: bool = True, inclusive: bool = True) -> Find:
        return replace(self, start=(k, ascending is not False, inclusive is not False), key_list=None, like=None)

    def key_order(self, ascending: bool = True) -> Find:
        return replace(self, key_direction=ascending)

    def lock(self) -> Find:
        """Spark has no row locks: writers are told apart at the commit. The rules of use are kept."""
        if self.n_skip is not None or self.n_limit is not None:
            raise QueryError(2058, "lock can't be used with skip or limit")
        return replace(self, locked=True)

    def version(self, v: str) -> Find:
        return replace(self, wanted_version=v)

    def last_modified(self, at: str) -> Find:
        return replace(self, wanted_modified=at.rstrip("Zz"))

    def time_range(self, since: str | None, until: str | None, inclusive: bool = True) -> Find:
        """inclusive is about since only; until always counts."""
        if since is None and until is None:
            raise QueryError(2006, "a time range needs a start or an end")
        return replace(self, since_until=(since, until, inclusive))

    def filter(self, spec) -> Find:
        query = parse_query(spec)
        if self.duality and (found := [op for op in _specials(query.where) if op in DUALITY]):
            raise QueryError(DUALITY[found[0]], f"{found[0]} can't be used on a duality view")
        return replace(self, query=query)

    def skip(self, n: int) -> Find:
        self._unlocked()
        if n < 0:
            raise QueryError(2023, "skip can't be negative")
        return replace(self, n_skip=n)

    def _unlocked(self) -> None:
        if self.locked:
            raise QueryError(2058, "lock can't be used with skip, limit or count")

    def limit(self, n: int) -> Find:
        self._unlocked()
        if n < 1:
            raise QueryError(2008, "limit is at least 1")
        return replace(self, n_limit=n)

    def order_by_key(self, on: bool) -> Find:
        return replace(self, by_key=on)

    def header_only(self) -> Find:
        return replace(self, headers=True, projection=None)

    def project(self, spec: dict) -> Find:
        projecting.parse_projection(spec)
        return replace(self, projection=spec, headers=False)

    def hint(self, text: str) -> Find:
        if "/*" in text or "*/" in text:
            raise QueryError(2066, "a hint can't hold comment marks")
        return replace(self, hints=(*self.hints, text))

    # what the builder says, as columns

    @cached_property
    def condition(self) -> Column:
        """The rows wanted. Keys of $id widen those of key(), keys() and keyLike(); all else narrows."""
        keys: list[Column] = []
        if self.key_list is not None:
            keys.append(F.col("key").isin(*self.key_list))
        if self.like:
            pattern, escape = self.like
            keys.append(F.like("key", F.lit(pattern), F.lit(escape)) if escape else F.col("key").like(pattern))
        if self.query and self.query.ids is not None:
            keys.append(F.col("key").isin(*self.query.ids))
        out = F.lit(True)
        if keys:
            either = keys[0]
            for k in keys[1:]:
                either = either | k
            out = out & either
        if self.start:
            k, up, inclusive = self.start
            key = F.col("key")
            out = out & ((key >= k if inclusive else key > k) if up else (key <= k if inclusive else key < k))
        if self.wanted_version is not None:
            out = out & (F.col("version") == self.wanted_version)
        if self.wanted_modified is not None:
            out = out & (F.col("last_modified") == F.lit(self.wanted_modified).cast("timestamp"))
        if self.since_until:
            since, until, inclusive = self.since_until
            at = F.col("last_modified")
            moment = lambda t: F.lit(t).cast("timestamp")
            if since is not None:
                out = out & (at >= moment(since) if inclusive else at > moment(since))
            if until is not None:
                out = out & (at <= moment(until))
        if self.query:
            out = out & lower(self.query.where, self._root())
            if "plain" in self.docs.columns and (early := necessary(self.query.where, dict(self._plain_kinds()))) is not None:
                out = early & out
        return out

    def _root(self) -> Root:
        """The document, with its members apart if the collection has them."""
        names = [f.name for f in self.docs.schema["members"].dataType.fields] if "members" in self.docs.columns else []
        return Root(F.col("doc"), {n: F.col("members")[n] for n in names})

    def _plain_kinds(self) -> list[tuple[str, str]]:
        return [(f.name, "text" if isinstance(f.dataType, T.StringType) else "number") for f in self.docs.schema["plain"].dataType.fields]

    def order(self) -> list[Column]:
        if self.query and self.query.order is not None:
            keys, clause = parse_order(self.query.order)
            for k, key in enumerate(keys):
                if [getattr(s, "name", None) for s in key.path] == ["_id"]:  # the key column; what follows can't matter
                    return [*sort_columns(keys[:k], clause, self._root()), F.col("key").desc() if key.descending else F.col("key").asc()]
            out = sort_columns(keys, clause, self._root())
        elif self.key_direction is not None:
            return [F.col("key").asc() if self.key_direction else F.col("key").desc()]
        elif self.start:
            return [F.col("key").asc() if self.start[1] else F.col("key").desc()]
        elif self.since_until:
            return [F.col("last_modified").asc(), F.col("key").asc()]
        else:
            out = []
        paged = self.n_skip is not None or self.n_limit is not None
        return [*out, F.col("key").asc()] if paged and self.by_key else out

    def many_keys(self, spark: SparkSession) -> tuple[DataFrame, Find] | None:
        """Where there are too many keys for literals: the distinct keys, $id's included, to be joined, and a find of all else."""
        if self.key_list is None or len(self.key_list) <= MAX_LITERAL_KEYS:
            return None
        named = {*self.key_list, *(self.query.ids or () if self.query else ())}
        rest = replace(self, key_list=None, query=replace(self.query, ids=None) if self.query else None)
        return spark.createDataFrame([(k,) for k in sorted(named)], "key string"), rest

    def matching(self) -> DataFrame:
        docs = self.docs
        for h in self.hints:
            name, _, arguments = h.partition("(")
            if name.strip().lower() in HINTS:
                docs = docs.hint(name.strip(), *(int(a) if a.strip().isdecimal() else a.strip() for a in arguments.rstrip(") ").split(",") if a.strip()))
        if many := self.many_keys(docs.sparkSession):
            wanted, rest = many
            return docs.join(wanted, "key", "left_semi").filter(rest.condition)
        return docs.filter(self.condition)

    def frame(self) -> DataFrame:
        """The documents, ordered and cut; documents that a projection fails on are dropped."""
        out = self.matching()
        if order := self.order():
            out = out.orderBy(*order)
        if self.n_skip:
            out = out.offset(self.n_skip)
        if self.n_limit is not None:
            out = out.limit(self.n_limit)
        out = out.drop("plain", "members")
        if self.headers:
            out = out.select(*(c for c in out.columns if c in HEADERS))
        if self.projection is not None:
            out = out.withColumn("doc", projecting.project(F.col("doc"), self.projection)).filter("doc is not null").drop("content")
        return out

    def fragment(self, offset: int, length: int) -> DataFrame:
        """(key, fragment) of the documents: `length` bytes of the content from a place on (from 0)."""
        if offset < 0 or length < 0:
            raise QueryError(2023, "offset and length can't be negative")
        return self.matching().select("key", F.substring(F.col("content").cast("binary"), offset + 1, length).cast("string").alias("fragment"))

    def count_frame(self) -> DataFrame:
        self._unlocked()
        if self.n_skip is not None or self.n_limit is not None:
            raise QueryError(2054, "count can't be used with skip or limit")
        return self.matching().agg(F.count("*").alias("n"))

    def count(self) -> int:
        return self.count_frame().first()[0]

    def get_one(self) -> Row | None:
        rows = self.frame().take(1)
        return rows[0] if rows else None

    def _plain(self) -> DataFrame:
        if self.query and _specials(self.query.where):
            raise QueryError(2089, "text, spatial and $sqlJson conditions can't be used here")
        if self.query and self.query.ids is not None:
            raise QueryError(2090, "$id can't be used here")
        if self.query and any(len(v.encode()) > MAX_OPERAND_BYTES for v in _strings(self.query.where)):
            raise QueryError(5068, f"a string has more than {MAX_OPERAND_BYTES} bytes")
        return self.matching()

    def distinct(self, path: str) -> DataFrame:
        return aggregate.distinct(self._plain(), path, self._root())

    def distinct_strict(self, path: str) -> DataFrame:
        return aggregate.distinct_strict(self._plain(), path, self._root())

    def summarize(self) -> DataFrame:
        return aggregate.summarize(self._plain())

    def explain_text(self) -> str:
        return self.frame()._jdf.queryExecution().toString()
