import json

from pyspark.sql import functions as F

from docquery.operators.aggregate import data_guide


def guide(spark, docs, **options):
    rows = spark.createDataFrame([(json.dumps(d),) for d in docs], "content string")
    found = data_guide(rows.select(F.parse_json("content").alias("doc")), **options).collect()
    assert len({(r.path, r.kind) for r in found}) == len(found)
    return {(r.path, r.kind): (r.n, r.max_length) for r in found}


def brute(docs):
    out = {}
    kinds = {dict: "object", list: "array", str: "string", int: "number", bool: "boolean", type(None): "null"}

    def walk(path, v):
        for x in v if isinstance(v, list) else ():
            walk(path, x)
        for name, x in v.items() if isinstance(v, dict) else ():
            at = f"{path}.{name}", kinds[type(x)]
            n, longest = out.get(at, (0, None))
            out[at] = n + 1, max(longest or 0, len(x)) if isinstance(x, str) else longest
            walk(at[0], x)

    for d in docs:
        walk("$", d)
    return out


def test_guide_reaches_every_level(spark):
    deep = {"end": "word"}
    for k in range(20):
        deep = {f"f{k}": deep if k % 3 else [[deep, [deep]], 1]}
    docs = [deep, {"a": [[{"b": 1}], [[{"b": "xy", "c": None}]], {"b": True}]}, {"a": {"b": "long"}}, {}, [], 5]
    assert guide(spark, docs) == brute(docs)
    assert guide(spark, docs[1:3], depth=1) == {("$.a", "array"): (1, None), ("$.a", "object"): (1, None)}
