"""Queries by name over stored collections and literal documents, and the same in SQL.

A stored collection is made anew for each run, in the folder that all executors share, from the
table `part`: its documents hold the size of a part.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.errors import QueryError
from docquery.operators import projecting
from docquery.operators.find import Find
from docquery.sources import relational
from docquery.sources.store import Collection, Database, Descriptor, scratch

KEY = "CAST(p_partkey AS VARCHAR)"
CONTENT = "'{\"size\":' || p_size || '}'"


def database(spark: SparkSession) -> Database:
    return Database(spark, f"{scratch(spark)}/collections-{uuid.uuid4().hex}")


def sizes(spark: SparkSession, d: str, descriptor: Descriptor | None = None) -> Collection:
    """A collection with a document {"size": n} for every part, under its key."""
    rows = spark.read.parquet(f"{d}/part.parquet")
    c = database(spark).create("parts", descriptor or Descriptor("client"))
    c.insert_frame(rows.select(F.col("p_partkey").cast("string").alias("key"), F.to_json(F.struct(F.col("p_size").alias("size"))).alias("content")))
    return c


def contents(c: Collection) -> DataFrame:
    return c.find().frame().select("key", "content")


def literal(spark: SparkSession, docs: list) -> DataFrame:
    """Documents with the keys 1, 2, 3 …"""
    rows = [(str(k), json.dumps(doc)) for k, doc in enumerate(docs, 1)]
    return spark.createDataFrame(rows, "key string, content string").withColumn("doc", F.parse_json("content"))


def one_row(spark: SparkSession, **values) -> DataFrame:
    return spark.createDataFrame([tuple(values.values())], list(values))


def stored(act: Callable[[Collection], object], show: Callable[[Collection], DataFrame] = contents) -> Callable[[SparkSession, str], DataFrame]:
    """A query that makes the collection, writes to it, and shows it."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        c = sizes(spark, d)
        act(c)
        return show(c)

    return run


def failing(act: Callable[[SparkSession], object]) -> Callable[[SparkSession, str], DataFrame]:
    """A query that gives the code of the error that act raises."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        try:
            act(spark)
        except QueryError as e:
            return one_row(spark, code=e.code)
        return one_row(spark, code=0)

    return run


def _names(spark: SparkSession, d: str) -> DataFrame:
    db = database(spark)
    for name in ("b", "a", "c"):
        db.create(name)
    return spark.createDataFrame([(n,) for n in db.names(limit=2, skip=1)], "name string")


def _opened(spark: SparkSession, d: str) -> DataFrame:
    db = database(spark)
    db.create("a", Descriptor("client", "md5"))
    return one_row(spark, missing=db.open("x") is None, method=db.open("a").descriptor.version_method)


def _dropped(spark: SparkSession, d: str) -> DataFrame:
    db = database(spark)
    for name in ("a", "b"):
        db.create(name)
    first = db.drop("a")
    return one_row(spark, dropped=first, again=db.drop("a"), failed=len(db.drop_all()), remaining=len(db.names()))


def _meta(spark: SparkSession, d: str) -> DataFrame:
    c = database(spark).create("a", Descriptor("client", read_only=True, heterogeneous=True))
    return one_row(spark, name=c.name, read_only=c.descriptor.read_only, heterogeneous=c.descriptor.heterogeneous, key_method=c.descriptor.key_method)


def _inserted(spark: SparkSession, d: str) -> DataFrame:
    c = database(spark).create("a", Descriptor("client"))
    return c.insert_and_get([("k", {"a": 1})]).select("key", "version")


def _by_version(spark: SparkSession, d: str) -> DataFrame:
    c = sizes(spark, d)
    version = c.find_one("7").version
    return c.find().version(version).frame().select("key")


def _as_of(spark: SparkSession, d: str) -> DataFrame:
    c = sizes(spark, d)
    c.find().remove()
    return c.frame(0).select("key").union(c.frame(as_of=0).select("key"))


def _modified(build: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """Keys found by a time between two writes."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        c = sizes(spark, d)
        time.sleep(0.01)
        between = time.time()
        c.find().filter({"size": {"$lt": 5}}).merge({"small": True})
        moment = lambda t: str(spark.range(1).select(F.lit(t).cast("timestamp").cast("string")).first()[0])
        return build(c, moment(between), moment)

    return run


def _saved(c: Collection) -> None:
    c.save([("1", '{"size":-1}'), ("new", '{"size":-2}'), ("new", '{"size":-3}')])


POINTS = [
    {"at": {"type": "Point", "coordinates": [13.4, 52.5]}}, {"at": {"type": "Point", "coordinates": [2.35, 48.85]}},
    {"at": {"type": "LineString", "coordinates": [[13.0, 52.4], [13.5, 52.6]]}}, {"at": {"type": "Polygon", "coordinates": [[[13, 52], [14, 52], [14, 53], [13, 53], [13, 52]]]}}, {},
]
AREA = {"type": "Polygon", "coordinates": [[[12, 51], [15, 51], [15, 54], [12, 54], [12, 51]]]}
HOLED = {"type": "Polygon", "coordinates": [[[0, 0], [20, 0], [20, 60], [0, 60], [0, 0]], [[13.2, 52.2], [13.3, 52.2], [13.3, 52.3], [13.2, 52.3], [13.2, 52.2]]]}
BERLIN = {"$geometry": {"type": "Point", "coordinates": [13.4, 52.52]}, "$distance": 20}
ORDERS = [{"n": 3, "s": "b"}, {"n": "x", "s": "a"}, {"n": True}, {"n": None}, {"n": [1]}, {"s": "c"}, {"n": 1}]
NUMBERS = [{"v": "12"}, {"v": 12.0}, {"v": 1e4}, {"v": "NaN"}, {"v": ""}, {"v": None}, {"v": True}, {"v": [3, 12]}, {"v": {"x": 12}}, {"v": 9007199254740993}]
WORDS = [{"v": "Abc"}, {"v": "ABC"}, {"v": ["x", "abc"]}, {"v": 7}, {"v": ""}, {"v": None}, {"v": False}, {}]
SIZED = [{"v": [1, 2, 3]}, {"v": []}, {"v": "x"}, {"v": None}, {"v": {}}, {}, {"v": [[1, 2], [3]]}]
BOOLEANS = [{"v": "true"}, {"v": True}, {"v": "false"}, {"v": "abc"}, {"v": None}, {"v": 1}, {"v": False}]
MOMENTS = [{"v": "2020-01-01T02:00:00+02:00"}, {"v": "2020-01-01T00:00:00.000001Z"}, {"v": "2019-12-31"}, {"v": "no"}, {"v": 5}]
NESTED = [{"order": [{"items": [{"q": 1}, {"q": 5}]}]}, {"order": {"items": {"q": 5}}}, {"order": {"items": [{"q": 2}]}}, {"a.b": {"": 1}}, {"m": [[1, 2], [3, 4]]}]

#: name -> (documents, filter, keys found)
LITERALS: dict[str, tuple[list, dict, list[int]]] = {
    "qbe_envelope": (NUMBERS, {"$query": {"v": {"$gt": 11}}, "$orderby": {"v": 1}, "$project": {}}, [2, 3, 8, 10]),
    "qbe_value_number": (NUMBERS, {"v": {"$value": 12}}, [2]),
    "qbe_eq_large": (NUMBERS, {"v": 9007199254740993}, [10]),
    "qbe_eq_large_next": (NUMBERS, {"v": 9007199254740992}, []),
    "qbe_mod_negated": ([{"v": 12}, {"v": 13}, {"v": "we"}, {}], {"v": {"$not": {"$mod": [5, 2]}}}, [2, 3, 4]),
    "qbe_literals": (BOOLEANS, {"v": {"$in": [None, False, "true"]}}, [1, 5, 7]),
    "mod_number_text": (NUMBERS, {"v": {"$number": 12}}, [1, 2, 8]),
    "mod_double_text": (NUMBERS, {"v": {"$double": {"$gte": 12}}}, [1, 2, 3, 8, 10]),
    "mod_string_canonical": (NUMBERS, {"v": {"$string": {"$in": ["12", "10000", "true"]}}}, [1, 2, 3, 7, 8]),
    "mod_boolean": (BOOLEANS, {"v": {"$boolean": True}}, [1, 2]),
    "mod_boolean_not": (BOOLEANS, {"v": {"$boolean": {"$ne": True}}}, [3, 4, 5, 6, 7]),
    "mod_booleanonly": (BOOLEANS, {"v": {"$booleanOnly": True}}, [2]),
    "mod_stringonly": (BOOLEANS, {"v": {"$stringOnly": "true"}}, [1]),
    "mod_idonly": ([{"v": "0123456789abcdef01234567"}, {"v": "x"}], {"v": {"$idOnly": "0123456789abcdef01234567"}}, [1]),
    "mod_binary": ([{"v": "AQI="}, {"v": "AQM="}, {"v": 1}], {"v": {"$binary": "0102"}}, [1]),
    "mod_timestamp_zone": (MOMENTS, {"v": {"$timestamp": {"$gte": "2020-01-01T00:00:00Z"}}}, [1, 2]),
    "mod_date_zone": (MOMENTS, {"v": {"$date": {"$lt": "2020-01-01"}}}, [3]),
    "mod_upper_array": (WORDS, {"v": {"$upper": "ABC"}}, [1, 2, 3]),
    "mod_lower_number": (WORDS, {"v": {"$lower": {"$in": ["7", "false"]}}}, [4, 7]),
    "mod_length_array": (WORDS, {"v": {"$length": 3}}, [1, 2, 3]),
    "mod_size_all": (SIZED, {"v": {"$size": 1}}, [3, 4, 5]),
    "mod_type_null": (SIZED, {"v": {"$type": "null"}}, [4]),
    "path_wrapped": (NESTED, {"order[0].items[0].q": 5}, [2]),
    "path_lax": (NESTED, {"order.items.q": {"$gte": 5}}, [1, 2]),
    "path_quoted": (NESTED, {"`a.b`.``": 1}, [4]),
    "path_matrix": (NESTED, {"m[1][0]": 3}, [5]),
    "geo_near": (POINTS, {"at": {"$near": BERLIN}}, [1, 3, 4]),
    "geo_not_near": (POINTS, {"at": {"$not": {"$near": BERLIN}}}, [2]),
    "geo_within": (POINTS, {"at": {"$within": {"$geometry": AREA}}}, [1, 3, 4]),
    "geo_within_hole": (POINTS, {"at": {"$within": {"$geometry": HOLED}}}, [1, 2, 3]),
    "geo_intersects": (POINTS, {"at": {"$intersects": {"$geometry": AREA}}}, [1, 3, 4]),
    "txt_contains_control": ([{"t": "abc\u0001def"}, {"t": {"def": "abc"}}, {"t": ["x", "def"]}], {"t": {"$contains": "def"}}, [1, 3]),
}


def _ordered(docs: list, order, n: int = 100) -> Callable[[SparkSession, str], DataFrame]:
    """(place, key) of the documents in an order; the rank is taken on the page, which is small by its limit."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = Find(literal(spark, docs)).filter({"$orderby": order}).limit(n).frame().select("key").collect()
        return spark.createDataFrame([(k, r.key) for k, r in enumerate(rows, 1)], "place int, key string")

    return run


def _ids(spark: SparkSession, d: str) -> DataFrame:
    return Find(relational.parts(spark, d)).filter({"$orderby": [{"path": "_id", "order": "desc"}, {"path": "size"}]}).limit(9).frame().select("key")


#: name -> (documents, order, keys in order)
ORDERED: dict[str, tuple[list, object, list[int]]] = {
    "ord_json": (ORDERS, {"n": 1}, [4, 3, 7, 1, 2, 5, 6]),
    "ord_minmax_arrays": ([{"x": [5, 9]}, {"x": [1, 3]}, {"x": []}], [{"path": "x", "sortByMinMax": True}], [3, 2, 1]),
    "ord_minmax_desc": ([{"x": [5, 9]}, {"x": [1, 30]}, {"x": []}], [{"path": "x", "order": "desc", "sortByMinMax": True}], [2, 1, 3]),
}

PARTS = f"SELECT {KEY} AS key, {{}} AS content FROM part"
#: name -> (query, the same in SQL)
STORED: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "coll_create": (stored(lambda c: c.database.create("parts", c.descriptor)), PARTS.format(CONTENT)),
    "coll_open": (_opened, "SELECT true AS missing, 'md5' AS method"),
    "coll_names": (_names, "SELECT unnest(['b', 'c']) AS name"),
    "coll_drop": (_dropped, "SELECT true AS dropped, false AS again, 0 AS failed, 0 AS remaining"),
    "coll_truncate": (stored(lambda c: c.truncate()), PARTS.format(CONTENT) + " WHERE false"),
    "coll_meta": (_meta, "SELECT 'a' AS name, true AS read_only, true AS heterogeneous, 'client' AS key_method"),
    "ins_one": (_inserted, "SELECT 'k' AS key, upper(sha256('{\"a\": 1}')) AS version"),
    "ins_bulk": (stored(lambda c: c.insert([(f"n{k}", '{"size":0}') for k in range(3)])), PARTS.format(CONTENT) + " UNION ALL SELECT unnest(['n0', 'n1', 'n2']), '{\"size\":0}'"),
    "save_upsert": (stored(_saved), f"SELECT {KEY} AS key, CASE WHEN p_partkey = 1 THEN '{{\"size\":-1}}' ELSE {CONTENT} END AS content FROM part UNION ALL SELECT 'new', '{{\"size\":-3}}'"),
    "find_one": (lambda spark, d: sizes(spark, d).find().key("5").frame().select("key", "content"), PARTS.format(CONTENT) + " WHERE p_partkey = 5"),
    "find_fragment": (lambda spark, d: sizes(spark, d).find().fragment(8, 3).select("key", "fragment"), f"SELECT {KEY} AS key, substr({CONTENT}, 9, 3) AS fragment FROM part"),
    "header_only": (
        lambda spark, d: sizes(spark, d).find().filter({"size": {"$lt": 9}}).header_only().frame().select("key", "version"),
        f"SELECT {KEY} AS key, upper(sha256({CONTENT})) AS version FROM part WHERE p_size < 9",
    ),
    "version_eq": (_by_version, f"SELECT {KEY} AS key FROM part WHERE p_size = (SELECT p_size FROM part WHERE p_partkey = 7)"),
    "lastmod_eq": (
        _modified(lambda c, between, moment: c.find().last_modified(moment(c.find().filter({"small": True}).frame().select(F.unix_micros("last_modified") / 1e6).first()[0])).frame().select("key")),
        f"SELECT {KEY} AS key FROM part WHERE p_size < 5",
    ),
    "time_range": (_modified(lambda c, between, _: c.find().time_range(between, None).frame().select("key")), f"SELECT {KEY} AS key FROM part WHERE p_size < 5"),
    "as_of": (_as_of, f"SELECT {KEY} AS key FROM part"),
    "key_order": (lambda spark, d: sizes(spark, d).find().key_order(False).limit(4).frame().select("key"), f"SELECT {KEY} AS key FROM part ORDER BY 1 DESC LIMIT 4"),
    "ord_id": (_ids, f"SELECT {KEY} AS key FROM part ORDER BY 1 DESC LIMIT 9"),
    "rm_filter": (stored(lambda c: c.find().filter({"size": {"$gt": 25}}).remove()), PARTS.format(CONTENT) + " WHERE p_size <= 25"),
    "rm_keys_many": (stored(lambda c: c.find().keys([str(k) for k in range(0, 5000, 2)]).remove()), PARTS.format(CONTENT) + " WHERE p_partkey >= 5000 OR p_partkey % 2 = 1"),
    "repl_one": (stored(lambda c: c.find().key("3").replace_one({"size": 0})), PARTS.format(f"CASE WHEN p_partkey = 3 THEN '{{\"size\": 0}}' ELSE {CONTENT} END")),
    "repl_all": (stored(lambda c: c.find().filter({"size": {"$lte": 10}}).replace({"size": 0})), PARTS.format(f"CASE WHEN p_size <= 10 THEN '{{\"size\": 0}}' ELSE {CONTENT} END")),
    "merge_bulk": (
        stored(lambda c: c.find().filter({"size": {"$gt": 40}}).merge({"size": None, "big": True})),
        PARTS.format(f"CASE WHEN p_size > 40 THEN '{{\"big\":true}}' ELSE {CONTENT} END"),
    ),
    "merge_counts": (
        lambda spark, d: one_row(spark, **(lambda w: {"processed": w.processed, "applied": w.applied})(sizes(spark, d).find().filter({"size": {"$gt": 40}}).merge_counted({"x": 1}))),
        "SELECT count(*) AS processed, count(*) AS applied FROM part WHERE p_size > 40",
    ),
    "patch_bulk": (
        stored(lambda c: c.find().patch([{"op": "test", "path": "/size", "value": 7}, {"op": "add", "path": "/tags", "value": ["x"]}, {"op": "remove", "path": "/size"}])),
        PARTS.format(f"CASE WHEN p_size = 7 THEN '{{\"tags\":[\"x\"]}}' ELSE {CONTENT} END"),
    ),
}

#: name -> (what fails, code)
ERRORS: dict[str, tuple[Callable[[SparkSession], object], int]] = {
    "err_not": (lambda s: Find(literal(s, [{}])).filter({"a": {"$not": {"$not": {"$eq": 1}}}}), 5037),
    "err_not_modifier": (lambda s: Find(literal(s, [{}])).filter({"a": {"$not": {"$upper": "A"}}}), 5053),
    "err_mixed": (lambda s: Find(literal(s, [{}])).filter({"a": {"$gt": 1, "b": 2}}), 5038),
    "err_empty": (lambda s: Find(literal(s, [{}])).filter({"a": {}}), 5021),
    "err_path": (lambda s: Find(literal(s, [{}])).filter({"a.[": 1}), 5025),
    "err_between": (lambda s: Find(literal(s, [{}])).filter({"a": {"$between": [None, None]}}), 5045),
    "err_mod": (lambda s: Find(literal(s, [{}])).filter({"a": {"$mod": [0, 1]}}), 5076),
    "err_sqljson": (lambda s: Find(literal(s, [{}])).filter({"a": {"$sqlJson": {"$in": [1]}}}), 5067),
    "err_id_place": (lambda s: Find(literal(s, [{}])).filter({"$and": [{"$id": 1}]}), 5039),
    "err_proj": (lambda s: projecting.parse_projection({"a": 1, "b": 0}), 2045),
    "err_proj_overlap": (lambda s: projecting.parse_projection({"a": 1, "a.b": 1}), 2057),
    "err_ord_array": (lambda s: Find(literal(s, [{}])).filter({"$orderby": {"a[0]": 1}}).frame(), 5022),
    "err_lock": (lambda s: Find(literal(s, [{}])).lock().limit(1), 2058),
    "err_limit": (lambda s: Find(literal(s, [{}])).limit(0), 2008),
    "err_skip": (lambda s: Find(literal(s, [{}])).skip(-1), 2023),
    "err_count": (lambda s: Find(literal(s, [{}])).limit(1).count(), 2054),
    "err_hint": (lambda s: Find(literal(s, [{}])).hint("/* x */"), 2066),
    "err_distinct": (lambda s: Find(literal(s, [{}])).distinct("a[0]"), 2091),
    "err_distinct_long": (lambda s: Find(literal(s, [{}])).filter({"a": "x" * 4_001}).distinct("a"), 5068),
    "err_dualv": (lambda s: Find(literal(s, [{}]), duality=True).filter({"a": {"$sqlJson": 1}}), 5073),
    "err_truncate": (lambda s: database(s).create("v", Descriptor(kind="view")).truncate(), 3000),
    "err_id": (lambda s: database(s).create("e", Descriptor("embedded_oid")).find().key("k").replace_one({"a": 1}), 2105),
    "err_key_like": (lambda s: database(s).create("u").find().key_like("a%"), 2052),
}


def _keys_sql(keys: list[int]) -> str:
    return f"SELECT unnest({[str(k) for k in keys]}) AS key" if keys else "SELECT '' AS key WHERE false"


def _found(docs: list, spec: dict) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: Find(literal(spark, docs)).filter(spec).frame().select("key")


def _placed_sql(keys: list[int]) -> str:
    return " UNION ALL ".join(f"SELECT {place} AS place, '{k}' AS key" for place, k in enumerate(keys, 1))


def all_queries() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]]:
    """name -> (query, the same in SQL)."""
    out = {name: (_found(docs, spec), _keys_sql(keys)) for name, (docs, spec, keys) in LITERALS.items()}
    out |= {name: (_ordered(docs, order), _placed_sql(keys)) for name, (docs, order, keys) in ORDERED.items()}
    out |= {name: (failing(act), f"SELECT CAST({code} AS BIGINT) AS code") for name, (act, code) in ERRORS.items()}
    return out | STORED
