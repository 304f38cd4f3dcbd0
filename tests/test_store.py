import pytest

from docquery.errors import BatchError, QueryError
from docquery.sources.store import Database, Descriptor


@pytest.fixture
def db(spark, tmp_path):
    return Database(spark, str(tmp_path / "db"))


def keys(frame):
    return sorted(r.key for r in frame.collect())


def test_life_of_a_collection(db):
    assert db.open("c") is None
    c = db.create("c", Descriptor("client"))
    with pytest.raises(QueryError):
        db.create("c", Descriptor("client", "md5"))
    c.insert([(f"id-{i}", {"d": i, "t": {"x": 1, "y": 2}}) for i in range(1, 6)])
    assert c.find().filter({"d": {"$gte": 4}}).count() == 2
    with pytest.raises(BatchError):
        c.insert([("id-1", {"d": 0})])
    with pytest.raises(BatchError) as e:
        c.insert([("id-9", {"d": 0}), ("id-10", "{bad")])
    assert e.value.processed == 1 and c.find().count() == 5
    version = c.find_one("id-1").version
    assert c.find().key("id-1").version("no").replace_one({"d": 7}) is False
    assert c.find().key("id-1").version(version).replace_one({"d": 7}) is True
    assert c.find_one("id-1").version != version
    assert c.find().key("id-2").merge_one({"t": {"x": None, "z": 3}, "d": None})
    assert c.find_one("id-2").content == '{"t":{"y":2,"z":3}}'
    assert c.find().filter({"d": {"$gt": 3}}).patch([{"op": "replace", "path": "/t/x", "value": 9}]) == 2  # id-1 has no t
    assert c.find().filter({"t.x": 9}).remove() == 2
    assert keys(c.find().frame()) == ["id-1", "id-2", "id-3"]
    c.save([("id-3", {"d": 33}), ("id-8", {"d": 8})])
    assert keys(c.find().frame()) == ["id-1", "id-2", "id-3", "id-8"]
    assert keys(c.frame(0)) == [f"id-{i}" for i in range(1, 6)]
    with pytest.raises(QueryError):
        c.find().merge_one({"a": 1})
    c.truncate()
    assert c.find().count() == 0
    assert db.names() == ["c"] and db.drop("c") and db.names() == []


def test_first_writer_wins(db):
    c = db.create("c", Descriptor("client"))
    c.insert([("a", {})])
    base = c.manifest()
    c.insert([("b", {})])
    with pytest.raises(QueryError):
        c.commit(base, [])


def test_embedded_and_sequence_keys(db):
    e = db.create("e", Descriptor("embedded_oid"))
    e.insert([{"_id": "k1", "a": 1}, {"a": 2}])
    assert e.find_one("k1").content == '{"_id": "k1", "a": 1}'
    with pytest.raises(QueryError):
        e.find().merge({"_id": "x"})
    s = db.create("s", Descriptor("sequence", "sequential"))
    s.insert([{"a": 1}])
    s.find().replace({"a": 5})
    assert s.find().get_one().version == "2"


def test_writes_with_more_keys_than_literals(db):
    c = db.create("c", Descriptor("client"))
    c.insert([(f"k{i}", {"d": i}) for i in range(1_105)])
    many = [f"k{i}" for i in range(1_001)]
    assert c.find().keys(many).filter({"d": {"$lt": 3}}).replace({"d": -1}) == 3
    assert c.find().keys(many).merge({"m": 1}) == 1_001
    assert c.find().keys(many).patch([{"op": "add", "path": "/p", "value": 1}]) == 1_001
    assert c.find().filter({"m": 1, "p": 1}).count() == 1_001 and c.find_one("k1001").content == '{"d": 1001}'
    assert c.find().keys([*many, "k0", "none"]).filter({"$id": ["k1004"]}).remove() == 1_002
    assert keys(c.find().frame()) == sorted(f"k{i}" for i in range(1_001, 1_105) if i != 1_004)


def test_results_of_writes(db):
    c = db.create("c", Descriptor("client"))
    c.insert([(f"id-{i}", {"d": i}) for i in range(1, 4)])
    got = c.find().key("id-1").replace_one_and_get({"d": 10})
    assert got.content == '{"d": 10}' and got.version == c.find_one("id-1").version
    assert c.find().key("none").merge_one_and_get({"e": 1}) is None
    assert keys(c.find().filter({"d": {"$lt": 5}}).merge_and_get({"e": 1})) == ["id-2", "id-3"]
    done = c.find().patch_counted([{"op": "remove", "path": "/e"}])
    assert (done.processed, done.applied) == (3, 2)
    with pytest.raises(QueryError) as e:
        c.find().key("id-1").version("no").error_on_version_mismatch().replace_one({"d": 1})
    assert e.value.code == 2107
    assert keys(c.save_and_get([("id-1", {"d": 1}), ("id-9", {"d": 8}), ("id-9", {"d": 9})])) == ["id-1", "id-9"]
    assert c.find_one("id-9").content == '{"d": 9}' and c.find().key("id-9").count() == 1


def test_gapless_sequence_keys(db):
    s = db.create("s", Descriptor("sequence"))
    s.insert([{"a": k} for k in range(5)])
    s.save([{"a": 5}, {"a": 6}])
    assert sorted(int(k) for k in keys(s.find().frame())) == list(range(1, 8))
    with pytest.raises(QueryError) as e:
        s.find().key_like("1%")
    assert e.value.code == 2052


def test_rules_of_use(db):
    e = db.create("e", Descriptor("embedded_oid"))
    e.insert([{"_id": "k1", "a": 1}])
    view = db.create("v", Descriptor(kind="duality"))
    cases = [
        (2105, lambda: e.find().key("k1").replace_one({"a": 2})), (2106, lambda: e.find().patch([{"op": "move", "from": "/_id", "path": "/x"}])),
        (2058, lambda: e.find().lock().limit(1)), (2058, lambda: e.find().skip(1).lock()), (2058, lambda: e.find().lock().count()), (3000, view.truncate),
        (5072, lambda: view.find().filter({"a": {"$contains": "x"}})), (5073, lambda: view.find().filter({"a": {"$sqlJson": 1}})),
        (5068, lambda: e.find().filter({"a": "x" * 4_001}).distinct("a")), (5042, lambda: e.add_index({"fields": []})),
        (5059, lambda: e.add_index({"name": "i", "fields": [{"path": "b"}], "scalarRequired": True})),
    ]
    for code, act in cases:
        with pytest.raises(QueryError) as error:
            act()
        assert error.value.code == code


def test_indexes_and_time_to_live(db):
    c = db.create("c", Descriptor("client"))
    c.insert([("a", {"at": "2020-01-01T00:00:00", "k": 1}), ("b", {"at": "2999-01-01T00:00:00", "k": 1}), ("c", {"k": 2})])
    with pytest.raises(QueryError):
        c.add_index({"name": "u", "unique": True, "fields": [{"path": "k"}]})
    c = c.add_index({"name": "t", "ttl": 60, "fields": [{"path": "at"}]})
    assert keys(db.open("c").find().frame()) == ["b", "c"] and [i["name"] for i in c.indexes()] == ["t"]
    c, gone = c.drop_index("t")
    assert gone and keys(c.find().frame()) == ["a", "b", "c"] and c.drop_index("t")[1] is False
