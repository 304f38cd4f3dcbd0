"""Filters on small documents with known answers, errors, and the law of two-valued negation."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docquery.errors import QueryError
from docquery.operators.find import Find
from docquery.operators.projecting import apply_patch, merge_patch
from docquery.plans.ordering import parse_order
from docquery.plans.paths import parse_path
from docquery.plans.qbe import parse_query

DOCS = [
    {"k": 1, "a": {"b": [1, 10, 20]}, "n": "12", "t": "x", "e": {"": 1, "a.b": 2}},
    {"k": 2, "order": [{"items": [{"q": 1, "p": 2.5}, {"q": 5, "p": 1.0}]}], "lit": "true"},
    {"k": 3, "order": {"items": [{"q": 7, "p": 1.0}]}, "a": None, "lit": True},
    {"k": 4, "s": "Hello World", "arr": ["x", "Y"], "bool": True, "m": [[1, 2], [3]], "loc": {"type": "Point", "coordinates": [2, 3]}},
    {"k": 5, "s": "line one\nHello", "neg": -7.5, "nest": {"deep": [{"z": 4}]}, "loc": {"type": "LineString", "coordinates": [[0, 0], [9, 9]]}},
]
SQUARE = {"type": "Polygon", "coordinates": [[[0, 0], [5, 0], [5, 5], [0, 5], [0, 0]]]}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(str(d["k"]), json.dumps(d)) for d in DOCS]
    return spark.createDataFrame(rows, "key string, content string").withColumn("doc", F.parse_json("content")).cache()


@pytest.mark.parametrize(
    ("spec", "want"),
    [
        ({}, "12345"),
        ({"a.b": {"$gt": 1, "$lt": 5}}, ""),
        ({"$and": [{"a.b": {"$gt": 1}}, {"a.b": {"$lt": 5}}]}, "1"),
        ({"order[0].items[0].q": 7}, "3"),
        ({"order.items": {"q": {"$gt": 4}, "p": 1.0}}, "23"),
        ({"order.items.q": {"$all": [1, 5]}}, "2"),
        ({"a": None}, "3"),
        ({"lit": "true"}, "2"),
        ({"lit": True}, "3"),
        ({"lit": {"$boolean": True}}, "23"),
        ({"n": 12}, ""),
        ({"n": {"$number": 12}}, "1"),
        ({"e.``": 1}, "1"),
        ({"e.`a.b`": 2}, "1"),
        ({"s": {"$upper": "HELLO WORLD"}}, "4"),
        ({"s": {"$regex": "Hello"}}, ""),
        ({"s": {"$likeRegex": "Hello"}}, "45"),
        ({"s": {"$regex": "line.*"}}, ""),
        ({"s": {"$nlRegex": "line.*"}}, "5"),
        ({"s": {"$ciLikeRegex": "WORLD"}}, "4"),
        ({"s": {"$not": {"$startsWith": "H"}}}, "1235"),
        ({"s": {"$like": "%World"}}, "4"),
        ({"arr": {"$size": 2}}, "4"),
        ({"s": {"$size": 1}}, "45"),
        ({"arr": {"$type": "array"}}, "4"),
        ({"arr": ["x", "Y"]}, "4"),
        ({"arr": {"$upper": {"$in": ["Y"]}}}, "4"),
        ({"m[0][1]": 2}, "4"),
        ({"m[*][0]": 3}, "4"),
        ({"m[last][last]": 3}, "4"),
        ({"nest..z": 4}, "5"),
        ({"*.b[last-1]": 10}, "1"),
        ({"bool": {"$ne": True}}, "1235"),
        ({"neg": {"$abs": 7.5}}, "5"),
        ({"neg": {"$ceiling": -7}}, "5"),
        ({"neg": {"$floor": {"$lt": -7}}}, "5"),
        ({"a.b": {"$value": [1, 10, 20]}}, "1"),
        ({"a": {"$eq": {"$value": {"b": [1, 10, 20]}}}}, "1"),
        ({"k": {"$between": [2, 3]}}, "23"),
        ({"k": {"$not": {"$between": [2, 3]}}}, "145"),
        ({"k": {"$nin": [1, 2]}}, "345"),
        ({"order": {"$exists": False}}, "145"),
        ({"s": {"$contains": "hello"}}, "45"),
        ({"loc": {"$near": {"$geometry": {"type": "Point", "coordinates": [2, 3.01]}, "$distance": 1}}}, "4"),
        ({"loc": {"$within": {"$geometry": SQUARE}}}, "4"),
        ({"loc": {"$intersects": {"$geometry": SQUARE}}}, "45"),
        ({"loc": {"$not": {"$intersects": {"$geometry": SQUARE}}}}, ""),
        ({"k": {"$sqlJson": {"$gt": 3}}}, "45"),
        ({"$id": ["1", 5]}, "15"),
        ({"k": {"$not": {"$gt": 4, "$lt": 2}}}, "12345"),
    ],
)
def test_finds(docs, spec, want):
    assert "".join(sorted(r.key for r in Find(docs).filter(spec).frame().collect())) == want


@pytest.mark.parametrize(
    ("spec", "code"),
    [
        ({"a": {}}, 5021), ({"a": {"$not": {"$not": {"$eq": 1}}}}, 5037), ({"a": {"$not": {"$upper": "x"}}}, 5053), ({"a": {"$upper": {"$lower": "x"}}}, 5053),
        ({"a": {"$gt": 1, "b": 2}}, 5038), ({"a": {"$startsWith": 1}}, 5014), ({"a": {"$gt": None}}, 5015), ({"a": {"$eq": [1]}}, 5016), ({"a": {"$size": [1]}}, 5017),
        ({"a": {"$nope": 1}}, 5018), ({"a": {"$between": [1]}}, 5045), ({"a": {"b": {"$contains": "x"}}}, 5052), ({"$and": [{"$id": 1}]}, 5039), ({"a": {"$mod": [0, 1]}}, 5076),
        ({"$and": []}, 5006), ({"$query": {}, "a": 1}, 5034), ({"a": {"$sqlJson": {"$in": [1]}}}, 5067),
    ],
)
def test_errors(spec, code):
    with pytest.raises(QueryError) as e:
        parse_query(spec)
    assert e.value.code == code


@pytest.mark.parametrize("path", ["", ".a", "a.", "a...b", "a[", "a[]", "a[x]", "a`b`", "`a", "a]b", "a[1,]", "a[1 to]", "a[0]b"])
def test_bad_paths(path):
    with pytest.raises(QueryError):
        parse_path(path)


def test_bad_orders():
    for spec, code in (({"a": 0}, 5036), ({"a": "x"}, 5035), ([{"datatype": "number"}], 5054), ([{"path": "a", "x": 1}], 5055), ([{"path": "a", "datatype": "blob"}], 5057), ([{"path": "a[0]"}], 5022)):
        with pytest.raises(QueryError) as e:
            parse_order(spec)
        assert e.value.code == code


def test_strict_order_fails_and_lax_does_not(docs):
    spec = {"$orderby": {"$fields": [{"path": "order", "datatype": "number"}]}}
    with pytest.raises(Exception, match="5059"):
        Find(docs).filter(spec).frame().collect()
    spec["$orderby"]["$lax"] = True
    assert len(Find(docs).filter(spec).frame().collect()) == 5


leaves = st.one_of(
    st.builds(lambda f, o, v: {f: {o: v}}, st.sampled_from(["k", "a.b", "order.items.q", "n", "zz"]), st.sampled_from(["$gt", "$lte", "$eq", "$ne"]), st.integers(-2, 12)),
    st.builds(lambda f: {f: {"$exists": True}}, st.sampled_from(["a", "s", "loc.type", "zz"])),
)
trees = st.recursive(leaves, lambda t: st.builds(lambda o, xs: {o: xs}, st.sampled_from(["$and", "$or", "$nor"]), st.lists(t, min_size=1, max_size=3)), max_leaves=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(trees)
def test_a_filter_and_its_negation_share_out_all_documents(docs, tree):
    yes = {r.key for r in Find(docs).filter(tree).frame().collect()}
    no = {r.key for r in Find(docs).filter({"$nor": [tree]}).frame().collect()}
    assert yes.isdisjoint(no) and len(yes) + len(no) == len(DOCS)


def test_scan_reads_only_the_fields_of_a_filter(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "d"))
    found = Find(spark.read.parquet(str(tmp_path / "d"))).filter({"k": {"$sqlJson": {"$gt": 3}}}).frame().select("key")
    plan = found._jdf.queryExecution().toString()
    assert "GreaterThan(doc.`0`,3.0)" in plan


def test_patches(spark):
    target, patch = {"a": "b", "c": {"d": "e", "f": "g"}}, {"a": "z", "c": {"f": None}}
    df = spark.createDataFrame([(json.dumps(target),)], "c string").select(F.to_json(merge_patch(F.parse_json("c"), patch)).alias("c"))
    assert json.loads(df.first().c) == {"a": "z", "c": {"d": "e"}}
    assert apply_patch({"a": [1, 2]}, [{"op": "add", "path": "/a/1", "value": 9}, {"op": "remove", "path": "/a/0"}, {"op": "copy", "from": "/a", "path": "/b"}]) == {"a": [9, 2], "b": [9, 2]}
    with pytest.raises(ValueError):
        apply_patch({"a": 1}, [{"op": "test", "path": "/a", "value": 2}])


def test_stream(spark, tmp_path):
    from docquery.streaming.filters import filter_stream

    spark.createDataFrame([(json.dumps(d),) for d in DOCS] + [("{bad",)], "content string").write.parquet(str(tmp_path / "in"))
    stream = filter_stream(spark.readStream.schema("content string").parquet(str(tmp_path / "in")), {"k": {"$gt": 3}})
    q = stream.writeStream.format("memory").queryName("found_docs").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("found_docs").count() == 2
