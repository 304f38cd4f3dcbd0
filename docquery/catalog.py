"""Queries by name over the driver's tables, and the same in SQL.

Each filter query returns the keys of the documents that it finds; orders and pages return what
they are about. Collections are built from the tables by `docquery.sources.relational`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery import catalog_store
from docquery.functions.values import get
from docquery.operators import projecting
from docquery.operators.aggregate import data_guide
from docquery.operators.find import Find
from docquery.sources import relational

ITEM = "EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND {})"
ORDERS = "SELECT CAST(o.o_orderkey AS VARCHAR) AS key FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE {}"
PARTS = "SELECT CAST(p_partkey AS VARCHAR) AS key FROM part WHERE {}"
EVENTS = "SELECT CAST(event_id AS VARCHAR) AS key FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) WHERE {}"
TEXTS = "SELECT CAST(d.doc_id AS VARCHAR) AS key FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE {}"
CONVERSATIONS = "SELECT CAST(conv_id AS VARCHAR) AS key FROM (SELECT DISTINCT conv_id FROM conversations) c WHERE {}"
TURN = "EXISTS (SELECT 1 FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) t WHERE t.conv_id = c.conv_id AND {})"

#: name -> (collection, its SQL, filter, the same in SQL)
FILTERS: dict[str, tuple[Callable, str, dict, str]] = {
    "scan_all": (relational.parts, PARTS, {}, "true"),
    "qbe_and": (relational.orders, ORDERS, {"$and": [{"status": "O"}, {"totalprice": {"$gt": 200000}}]}, "o_orderstatus = 'O' AND o_totalprice > 200000"),
    "qbe_or": (relational.parts, PARTS, {"$or": [{"size": 1}, {"size": {"$gte": 49}}]}, "p_size = 1 OR p_size >= 49"),
    "qbe_nor": (relational.parts, PARTS, {"$nor": [{"size": {"$lt": 20}}, {"brand": "Brand#11"}]}, "NOT (p_size < 20 OR p_brand = 'Brand#11')"),
    "qbe_not": (relational.parts, PARTS, {"size": {"$not": {"$gt": 10, "$lt": 3}}}, "NOT p_size > 10 OR NOT p_size < 3"),
    "qbe_mod_not": (relational.parts, PARTS, {"name": {"$length": {"$not": {"$gt": 12}}}}, "NOT length(p_name) > 12"),
    "qbe_not_missing": (relational.texts, TEXTS, {"labels.toxic": {"$not": {"$eq": 1}}}, "coalesce(l.toxic, 0) <> 1"),
    "qbe_eq_implicit": (relational.orders, ORDERS, {"customer.segment": "BUILDING"}, "c_mktsegment = 'BUILDING'"),
    "qbe_all_implicit": (relational.orders, ORDERS, {"items.returnflag": ["A", "R"]}, f"{ITEM.format("l_returnflag = 'A'")} AND {ITEM.format("l_returnflag = 'R'")}"),
    "qbe_downscope": (relational.orders, ORDERS, {"items": {"quantity": {"$gt": 45}, "discount": {"$gte": 0.08}}}, ITEM.format("l_quantity > 45 AND l_discount >= 0.08")),
    "qbe_range_same_item": (relational.orders, ORDERS, {"items.quantity": {"$gt": 20, "$lt": 22}}, ITEM.format("l_quantity > 20 AND l_quantity < 22")),
    "qbe_empty": (relational.orders, ORDERS, {}, "true"),
    "qbe_eq": (relational.parts, PARTS, {"brand": {"$eq": "Brand#23"}}, "p_brand = 'Brand#23'"),
    "qbe_ne": (relational.orders, ORDERS, {"items.returnflag": {"$ne": "N"}}, f"NOT {ITEM.format("l_returnflag = 'N'")}"),
    "qbe_gt": (relational.orders, ORDERS, {"totalprice": {"$gt": 300000}}, "o_totalprice > 300000"),
    "qbe_lt": (relational.orders, ORDERS, {"totalprice": {"$lt": 10000}}, "o_totalprice < 10000"),
    "qbe_gte": (relational.parts, PARTS, {"size": {"$gte": 40}}, "p_size >= 40"),
    "qbe_ge": (relational.parts, PARTS, {"size": {"$ge": 40}}, "p_size >= 40"),
    "qbe_lte": (relational.parts, PARTS, {"size": {"$lte": 4}}, "p_size <= 4"),
    "qbe_le": (relational.parts, PARTS, {"size": {"$le": 4}}, "p_size <= 4"),
    "qbe_in": (relational.parts, PARTS, {"size": {"$in": [3, 5, 7, "x", None]}}, "p_size IN (3, 5, 7)"),
    "qbe_in_empty": (relational.parts, PARTS, {"size": {"$in": []}}, "false"),
    "qbe_nin": (relational.parts, PARTS, {"size": {"$nin": [3, 5, 7]}}, "p_size NOT IN (3, 5, 7)"),
    "qbe_all": (relational.conversations, CONVERSATIONS, {"turns.turn": {"$all": [1, 3]}}, f"{TURN.format("turn = 1")} AND {TURN.format("turn = 3")}"),
    "qbe_between": (relational.orders, ORDERS, {"items.quantity": {"$between": [10, 11]}}, ITEM.format("l_quantity BETWEEN 10 AND 11")),
    "qbe_between_open": (relational.parts, PARTS, {"size": {"$between": [None, 9]}}, "p_size <= 9"),
    "qbe_exists": (relational.texts, TEXTS, {"labels": {"$exists": True}}, "l.doc_id IS NOT NULL"),
    "qbe_not_exists": (relational.texts, TEXTS, {"labels.quality": {"$exists": 0}}, "l.quality IS NULL"),
    "qbe_startswith": (relational.parts, PARTS, {"type": {"$startsWith": "PROMO"}}, "starts_with(p_type, 'PROMO')"),
    "qbe_regex": (relational.parts, PARTS, {"brand": {"$regex": "Brand#[12]."}}, "regexp_full_match(p_brand, 'Brand#[12].')"),
    "qbe_likeregex": (relational.parts, PARTS, {"brand": {"$likeRegex": "#[12]"}}, "regexp_matches(p_brand, '#[12]')"),
    "qbe_ciregex": (relational.parts, PARTS, {"brand": {"$ciRegex": "brand#[12]."}}, "regexp_full_match(p_brand, 'Brand#[12].')"),
    "qbe_cilikeregex": (relational.parts, PARTS, {"brand": {"$ciLikeRegex": "BRAND#1"}}, "regexp_matches(p_brand, 'Brand#1')"),
    "qbe_nlregex": (relational.texts, TEXTS, {"text": {"$nlRegex": "The.*the.*"}}, "starts_with(d.text, 'The') AND contains(substr(d.text, 4), 'the')"),
    "qbe_nllikeregex": (relational.texts, TEXTS, {"text": {"$nlLikeRegex": "the.+ends"}}, "regexp_matches(d.text, 'the.+ends', 's')"),
    "qbe_nlciregex": (relational.texts, TEXTS, {"text": {"$nlciRegex": "the .*"}}, "regexp_full_match(d.text, 'the .*', 'si')"),
    "qbe_nlcilikeregex": (relational.texts, TEXTS, {"text": {"$nlciLikeRegex": "license.+"}}, "regexp_matches(d.text, 'license.+', 'si')"),
    "qbe_substr": (relational.texts, TEXTS, {"text": {"$hasSubstring": "License"}}, "contains(d.text, 'License')"),
    "qbe_instr": (relational.parts, PARTS, {"type": {"$instr": "O"}}, "contains(p_type, 'O')"),
    "qbe_like": (relational.parts, PARTS, {"brand": {"$like": "Brand#_3"}}, "p_brand LIKE 'Brand#_3'"),
    "qbe_mod": (relational.parts, PARTS, {"size": {"$mod": [7, 3]}}, "p_size % 7 = 3"),
    "qbe_value": (relational.texts, TEXTS, {"labels": {"$value": {"toxic": 1, "quality": 1}}}, "l.quality = 1 AND l.toxic = 1"),
    "mod_number": (relational.orders, ORDERS, {"totalprice": {"$number": {"$gt": 250000}}}, "o_totalprice > 250000"),
    "mod_double": (relational.events, EVENTS, {"props.k": {"$double": {"$lt": 5}}}, "k < 5"),
    "mod_string": (relational.parts, PARTS, {"size": {"$string": {"$startsWith": "1"}}}, "starts_with(CAST(p_size AS VARCHAR), '1')"),
    "mod_date": (relational.orders, ORDERS, {"orderdate": {"$date": {"$gte": "1997-01-01", "$lt": "1997-04-01"}}}, "o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1997-04-01'"),
    "mod_timestamp": (relational.events, EVENTS, {"ts": {"$timestamp": {"$gt": "2024-01-15T00:00:00Z"}}}, "ts > TIMESTAMP '2024-01-15 00:00:00'"),
    "mod_ceiling": (relational.parts, PARTS, {"retailprice": {"$ceiling": {"$mod": [10, 0]}}}, "ceil(p_retailprice) % 10 = 0"),
    "mod_floor": (relational.parts, PARTS, {"retailprice": {"$floor": {"$mod": [10, 0]}}}, "floor(p_retailprice) % 10 = 0"),
    "mod_abs": (relational.events, EVENTS, {"value": {"$abs": {"$lt": 3}}}, "abs(value) < 3"),
    "mod_upper": (relational.orders, ORDERS, {"customer.segment": {"$upper": "MACHINERY"}}, "c_mktsegment = 'MACHINERY'"),
    "mod_lower": (relational.orders, ORDERS, {"customer.segment": {"$lower": {"$in": ["machinery", "building"]}}}, "c_mktsegment IN ('MACHINERY', 'BUILDING')"),
    "mod_type": (relational.texts, TEXTS, {"labels": {"$type": "object"}}, "l.doc_id IS NOT NULL"),
    "mod_length": (relational.texts, TEXTS, {"text": {"$length": {"$lt": 200}}}, "length(d.text) < 200"),
    "mod_size": (relational.orders, ORDERS, {"items": {"$size": {"$gte": 6}}}, "(SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) >= 6"),
    "mod_numberonly": (relational.parts, PARTS, {"size": {"$numberOnly": 7}}, "p_size = 7"),
    "path_index": (relational.conversations, CONVERSATIONS, {"turns[0].role": "system"}, TURN.format("place = 0 AND role = 'system'")),
    "path_last": (relational.conversations, CONVERSATIONS, {"turns[last].role": "assistant"}, TURN.format("place = n - 1 AND role = 'assistant'")),
    "path_range": (relational.conversations, CONVERSATIONS, {"turns[1 to 2, last-1].turn": {"$gte": 3}}, TURN.format("(place BETWEEN 1 AND 2 OR place = n - 2) AND turn >= 3")),
    "path_star": (relational.conversations, CONVERSATIONS, {"turns[*].turn": 4}, TURN.format("turn = 4")),
    "path_wildcard": (relational.orders, ORDERS, {"*.segment": "FURNITURE"}, "c_mktsegment = 'FURNITURE'"),
    "path_descendant": (relational.orders, ORDERS, {"status": "F", "customer..segment": "BUILDING"}, "o_orderstatus = 'F' AND c_mktsegment = 'BUILDING'"),
    "qbe_id": (relational.parts, PARTS, {"$id": [1, 2.0, "3"], "size": {"$gt": 0}}, "p_partkey IN (1, 2, 3)"),
    "sqljson_gt": (relational.orders, ORDERS, {"totalprice": {"$sqlJson": {"$gt": 280000, "$lte": 320000}}}, "o_totalprice > 280000 AND o_totalprice <= 320000"),
    "txt_contains": (relational.texts, TEXTS, {"text": {"$contains": "license mit"}}, "len(list_intersect(regexp_split_to_array(lower(d.text), '[^\\p{L}\\p{N}_]+'), ['license', 'mit'])) = 2"),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {
        "$query": {"status": "O", "items": {"quantity": {"$gt": 45}, "discount": {"$gte": 0.08}}},
        "$orderby": [{"path": "totalprice", "datatype": "number", "order": "desc"}],
    }
    found = Find(relational.orders(spark, sf_dir)).filter(spec).limit(20).frame()
    return found.select("key", get(F.col("doc"), "double", "$.totalprice").alias("totalprice"))


FLAGSHIP_SQL = (
    "SELECT CAST(o.o_orderkey AS VARCHAR) AS key, o_totalprice AS totalprice FROM orders o WHERE o_orderstatus = 'O' AND "
    + ITEM.format("l_quantity > 45 AND l_discount >= 0.08")
    + " ORDER BY o_totalprice DESC, CAST(o.o_orderkey AS VARCHAR) LIMIT 20"
)
PART_KEY = "CAST(p_partkey AS VARCHAR)"


def _parts(build: Callable[[Find], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: build(Find(relational.parts(spark, d)))


def _keys(build: Callable[[Find], Find]) -> Callable[[SparkSession, str], DataFrame]:
    return _parts(lambda f: build(f).frame().select("key"))


def _member(name: str, kind: str):
    return get(F.col("doc"), kind, f"$.{name}").alias(name)


def _placed(build: Callable[[Find], Find]) -> Callable[[SparkSession, str], DataFrame]:
    """The page that a find cuts, with the size of each part on it."""
    return _parts(lambda f: build(f).frame().select("key", _member("size", "int")))


def _guide(spark: SparkSession, d: str) -> DataFrame:
    return data_guide(relational.conversations(spark, d)).select("path", "kind", "n", "max_length")


#: name -> (query, the same in SQL)
OTHERS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "flagship": (flagship, FLAGSHIP_SQL),
    "coll_mapped_view": (
        lambda spark, d: Find(relational.mapped(spark.read.parquet(f"{d}/supplier.parquet"), "s_suppkey")).filter({"s_acctbal": {"$lt": 0}}).frame().select("key"),
        "SELECT CAST(s_suppkey AS VARCHAR) AS key FROM supplier WHERE s_acctbal < 0",
    ),
    "key_eq": (_keys(lambda f: f.key("17")), f"SELECT {PART_KEY} AS key FROM part WHERE p_partkey = 17"),
    "key_in": (_keys(lambda f: f.keys(["1", "5", "nope"])), f"SELECT {PART_KEY} AS key FROM part WHERE p_partkey IN (1, 5)"),
    "key_in_many": (_keys(lambda f: f.keys([str(k) for k in range(0, 5000, 2)])), f"SELECT {PART_KEY} AS key FROM part WHERE p_partkey < 5000 AND p_partkey % 2 = 0"),
    "key_like": (_keys(lambda f: f.key_like("1%")), f"SELECT {PART_KEY} AS key FROM part WHERE {PART_KEY} LIKE '1%'"),
    "key_start": (_keys(lambda f: f.start_key("19", inclusive=False).limit(7)), f"SELECT {PART_KEY} AS key FROM part WHERE {PART_KEY} > '19' ORDER BY 1 LIMIT 7"),
    "key_or_id": (_keys(lambda f: f.key("3").filter({"$id": "4", "size": {"$gte": 0}})), f"SELECT {PART_KEY} AS key FROM part WHERE p_partkey IN (3, 4)"),
    "paging": (_keys(lambda f: f.start_key("5", False, True).limit(9)), f"SELECT {PART_KEY} AS key FROM part WHERE {PART_KEY} <= '5' ORDER BY 1 DESC LIMIT 9"),
    "skip_limit": (_keys(lambda f: f.skip(5).limit(11)), f"SELECT {PART_KEY} AS key FROM part ORDER BY 1 LIMIT 11 OFFSET 5"),
    "limit_keyorder": (_keys(lambda f: f.filter({"size": {"$gt": 30}}).limit(8)), f"SELECT {PART_KEY} AS key FROM part WHERE p_size > 30 ORDER BY 1 LIMIT 8"),
    "ord_map": (
        _placed(lambda f: f.filter({"$query": {}, "$orderby": {"size": -2, "brand": 1}}).limit(15)),
        f"SELECT {PART_KEY} AS key, p_size AS size FROM part ORDER BY p_brand, p_size DESC, 1 LIMIT 15",
    ),
    "ord_array": (
        _placed(lambda f: f.filter({"$orderby": [{"path": "retailprice", "datatype": "number", "order": "desc"}]}).limit(15)),
        f"SELECT {PART_KEY} AS key, p_size AS size FROM part ORDER BY p_retailprice DESC, 1 LIMIT 15",
    ),
    "ord_lax": (
        _placed(lambda f: f.filter({"$orderby": {"$fields": [{"path": "name", "datatype": "number"}], "$lax": True}}).limit(5)),
        f"SELECT {PART_KEY} AS key, p_size AS size FROM part ORDER BY TRY_CAST(p_name AS DOUBLE) NULLS LAST, 1 LIMIT 5",
    ),
    "ord_scalar_required": (
        _placed(lambda f: f.filter({"$orderby": {"$fields": [{"path": "size", "datatype": "number"}], "$scalarRequired": True}}).limit(5)),
        f"SELECT {PART_KEY} AS key, p_size AS size FROM part ORDER BY p_size, 1 LIMIT 5",
    ),
    "ord_nulls": (
        lambda spark, d: Find(relational.texts(spark, d)).filter({"$orderby": [{"path": "labels.quality", "order": "desc"}]}).limit(12).frame().select("key"),
        "SELECT CAST(d.doc_id AS VARCHAR) AS key FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id ORDER BY l.quality DESC NULLS FIRST, 1 LIMIT 12",
    ),
    "ord_minmax": (
        lambda spark, d: Find(relational.orders(spark, d)).filter({"$orderby": [{"path": "items.quantity", "datatype": "number", "sortByMinMax": True}, {"path": "orderkey"}]}).limit(3).frame().select("key"),
        "SELECT CAST(o_orderkey AS VARCHAR) AS key FROM orders LEFT JOIN (SELECT l_orderkey, min(l_quantity) AS least FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey ORDER BY least NULLS FIRST, o_orderkey LIMIT 3",
    ),
    "proj_include": (
        _parts(lambda f: f.project({"brand": 1, "size": 1}).frame().select("key", F.to_json("doc").alias("doc"))),
        f"SELECT {PART_KEY} AS key, '{{\"brand\":\"' || p_brand || '\",\"size\":' || p_size || '}}' AS doc FROM part",
    ),
    "proj_exclude": (
        _parts(lambda f: f.project({"name": 0, "type": 0, "retailprice": 0, "partkey": 0}).frame().select("key", F.to_json("doc").alias("doc"))),
        f"SELECT {PART_KEY} AS key, '{{\"brand\":\"' || p_brand || '\",\"size\":' || p_size || '}}' AS doc FROM part",
    ),
    "merge_one": (
        _parts(lambda f: f.frame().select("key", F.to_json(projecting.merge_patch(F.col("doc"), {"name": None, "type": None, "retailprice": None, "partkey": None, "size": 0})).alias("doc"))),
        f"SELECT {PART_KEY} AS key, '{{\"brand\":\"' || p_brand || '\",\"size\":0}}' AS doc FROM part",
    ),
    "agg_count": (_parts(lambda f: f.filter({"size": {"$gt": 25}}).count_frame()), "SELECT count(*) AS n FROM part WHERE p_size > 25"),
    "agg_distinct": (_parts(lambda f: f.distinct("brand").select("value", "n")), "SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1"),
    "agg_distinct_array": (
        lambda spark, d: Find(relational.orders(spark, d)).distinct("items.returnflag").select("value", "n"),
        "SELECT l_returnflag AS value, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1",
    ),
    "agg_distinct_strict": (_parts(lambda f: f.distinct_strict("size").select(F.col("item").cast("int").alias("size"))), "SELECT DISTINCT p_size AS size FROM part"),
    "agg_summarize": (
        lambda spark, d: Find(relational.mapped(spark.read.parquet(f"{d}/region.parquet"), "r_regionkey")).summarize(),
        "SELECT count(*) AS n, CAST(sum(strlen('{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}')) AS BIGINT) AS total_bytes FROM region",
    ),
    "agg_dataguide": (
        _guide,
        """SELECT '$.conv_id' AS path, 'number' AS kind, count(DISTINCT conv_id) AS n, NULL AS max_length FROM conversations
        UNION ALL SELECT '$.turns', 'array', count(DISTINCT conv_id), NULL FROM conversations
        UNION ALL SELECT '$.turns.turn', 'number', count(*), NULL FROM conversations
        UNION ALL SELECT '$.turns.role', 'string', count(*), max(length(role)) FROM conversations
        UNION ALL SELECT '$.turns.text', 'string', count(*), max(length(text)) FROM conversations""",
    ),
    "get_one": (
        _parts(lambda f: f.key("12").frame().limit(1).select("key", _member("brand", "string"))),
        f"SELECT {PART_KEY} AS key, p_brand AS brand FROM part WHERE p_partkey = 12",
    ),
}


def _filtered(collection: Callable, spec: dict) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: Find(collection(spark, d)).filter(spec).frame().select("key")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: _filtered(collection, spec) for name, (collection, _, spec, _) in FILTERS.items()}
    return found | {name: query for name, (query, _) in (OTHERS | catalog_store.all_queries()).items()}


def expected_sql() -> dict[str, str]:
    found = {name: sql.format(where) for name, (_, sql, _, where) in FILTERS.items()}
    return found | {name: sql for name, (_, sql) in (OTHERS | catalog_store.all_queries()).items()}
