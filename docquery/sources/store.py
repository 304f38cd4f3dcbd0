"""Collections kept as Parquet snapshots: a manifest lists the folders of the current one.

Every write makes new folders and then one new manifest, created under a number that must not
exist yet: of two writers that started from the same snapshot, one fails and can try again.
Inserts add a folder; updates and deletes write a new folder with all rows they keep. Readers
see one snapshot, current or past. All access is through Hadoop's file systems. That the first of two
writers wins needs a store on which creating a file that must not exist is one step (HDFS, a local
disk); on object stores without it, let one writer at a time commit.
"""

from __future__ import annotations

import json
import re
import tempfile
import time
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.errors import BatchError, QueryError
from docquery.functions.values import get, moment_of
from docquery.operators import projecting
from docquery.operators.find import Find
from docquery.plans.paths import json_path

NAME = re.compile(r"[A-Za-z0-9_.$ -]{1,255}")
SCHEMA = "key string, content string, version string, last_modified timestamp, created_on timestamp, media_type string"
VERSIONS = {"none", "timestamp", "sequential", "uuid", "sha256", "md5"}
KEYS = {"uuid", "client", "embedded_oid", "sequence"}


@dataclass(frozen=True)
class Descriptor:
    """How a collection assigns keys and versions. Re-creating a collection takes an equal one."""

    key_method: str = "uuid"
    version_method: str = "sha256"
    read_only: bool = False
    heterogeneous: bool = False
    indexes: tuple = ()
    kind: str = "table"
    media_type: str = "application/json"

    def __post_init__(self):
        if self.key_method not in KEYS or self.version_method not in VERSIONS:
            raise QueryError(2500, f"unknown key or version method: {self.key_method}, {self.version_method}")
        if self.kind not in ("table", "view", "duality"):
            raise QueryError(2500, f"unknown kind {self.kind}")


def scratch(spark: SparkSession) -> str:
    """A folder for collections that are made for one run: spark.checkpoint.dir, which all executors share; a local session may do without."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return at or tempfile.mkdtemp(prefix="spark-", dir="/tmp")


class Files:
    """The few file operations that a catalog needs, on the store of a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(conf)

    def path(self, at: str):
        return self.jvm.org.apache.hadoop.fs.Path(at)

    def names(self, at: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(at))) if self.exists(at) else []

    def exists(self, at: str) -> bool:
        return self.fs.exists(self.path(at))

    def create(self, at: str, text: str) -> bool:
        """Write a file that must not exist; False if it does."""
        try:
            out = self.fs.create(self.path(at), False)
        except Exception:  # py4j wraps the store's own "file exists"
            if self.exists(at):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, at: str) -> str:
        stream = self.fs.open(self.path(at))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, at: str) -> bool:
        return self.fs.delete(self.path(at), True)


class Database:
    """Named collections under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root)

    def create(self, name: str, descriptor: Descriptor | None = None) -> Collection:
        """A new collection, or the one of that name if its descriptor is the same."""
        if not isinstance(name, str) or not NAME.fullmatch(name):
            raise QueryError(2001, "a collection has no valid name")
        wanted = descriptor or Descriptor()
        text = json.dumps(asdict(wanted))
        if not self.files.create(f"{self.root}/{name}/descriptor.json", text) and descriptor and json.loads(self.files.read(f"{self.root}/{name}/descriptor.json")) != json.loads(text):
            raise QueryError(2503, f"{name} exists with another descriptor")
        return self.open(name)

    def open(self, name: str) -> Collection | None:
        at = f"{self.root}/{name}"
        if not self.files.exists(f"{at}/descriptor.json"):
            return None
        found = json.loads(self.files.read(f"{at}/descriptor.json"))
        return Collection(self, name, Descriptor(**found | {"indexes": tuple(map(tuple, found["indexes"]))}))

    def names(self, limit: int | None = None, skip: int = 0, start: str | None = None) -> list[str]:
        found = [n for n in self.files.names(self.root) if (start is None or n >= start)][skip:]
        return found if limit is None else found[:limit]

    def drop(self, name: str) -> bool:
        return self.files.exists(f"{self.root}/{name}") and self.files.delete(f"{self.root}/{name}")

    def drop_all(self) -> list[tuple[str, str]]:
        """Drop every collection; the names and errors of those that couldn't be."""
        failed = []
        for n in self.names():
            try:
                self.drop(n)
            except Exception as e:
                failed.append((n, str(e)))
        return failed


def _text(doc) -> str:
    if isinstance(doc, bytes):
        return doc.decode(json.detect_encoding(doc))
    return doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False)


def canonical_key(key, method: str) -> str:
    """Keys as they are stored: sequence keys are digits without leading zeros, UUIDs 32 upper-case hex digits."""
    text = str(key)
    if method == "sequence":
        if not re.fullmatch(r"\d+", text):
            raise QueryError(2007, f"{text!r} is no integer key")
        return text.lstrip("0") or "0"
    if method == "uuid":
        return text.replace("-", "").upper().rjust(32, "0")
    return text


def content_as(row: Row, kind: str = "text"):
    """A document's content as "text", "bytes" or "value" (parsed)."""
    if kind not in ("text", "bytes", "value"):
        raise QueryError(2500, f"unknown kind of content {kind}")
    return row.content if kind == "text" else row.content.encode() if kind == "bytes" else json.loads(row.content)


@dataclass(frozen=True)
class Written:
    """What a bulk write did: documents that were wanted, those that were changed, and the time they now carry."""

    processed: int
    applied: int
    at: float | None = None


@dataclass(frozen=True)
class Collection:
    database: Database
    name: str
    descriptor: Descriptor

    @property
    def home(self) -> str:
        return f"{self.database.root}/{self.name}"

    @property
    def spark(self) -> SparkSession:
        return self.database.spark

    # snapshots

    def snapshots(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self.database.files.names(f"{self.home}/log") if n.endswith(".json"))

    def manifest(self, snapshot: int | None = None) -> dict:
        known = self.snapshots()
        at = (known[-1] if known else None) if snapshot is None else snapshot
        return json.loads(self.database.files.read(f"{self.home}/log/v{at:010d}.json")) if at is not None else {"snapshot": -1, "folders": [], "at": 0}

    def commit(self, base: dict, folders: list[str]) -> None:
        new = {"snapshot": base["snapshot"] + 1, "folders": folders, "at": time.time()}
        if not self.database.files.create(f"{self.home}/log/v{new['snapshot']:010d}.json", json.dumps(new)):
            raise QueryError(2107, "another writer was first; read again and retry")

    def frame(self, snapshot: int | None = None, as_of: float | None = None) -> DataFrame:
        """Rows of a snapshot, the current one unless a number or a time (seconds since 1970) is given."""
        if as_of is not None:
            past = [m for s in self.snapshots() if (m := self.manifest(s))["at"] <= as_of]
            folders = past[-1]["folders"] if past else []
        else:
            folders = self.manifest(snapshot)["folders"]
        rows = self.spark.read.schema(SCHEMA + ", doc variant").parquet(*(f"{self.home}/{f}" for f in folders)) if folders else self.spark.createDataFrame([], SCHEMA).withColumn("doc", F.parse_json("content"))
        return rows

    def find(self) -> Stored:
        """A find on the current snapshot; documents past the time to live of an index are left out."""
        rows = self.frame()
        for spec in (json.loads(text) for _, text in self.descriptor.indexes):
            if "ttl" in spec:
                since = moment_of(get(F.col("doc"), "string", json_path(spec["fields"][0]["path"].split("."))))
                rows = rows.filter(since.isNull() | (since + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(spec["ttl"])) > F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())))
        return Stored(rows, collection=self, duality=self.descriptor.kind == "duality")

    def find_one(self, key: str) -> Row | None:
        return self.find().key(canonical_key(key, self.descriptor.key_method)).get_one()

    # writes

    def _writable(self) -> None:
        if self.descriptor.read_only:
            raise QueryError(2009, f"{self.name} is read-only")

    def version_of(self, content: Column, old: Column | None = None) -> Column:
        method = self.descriptor.version_method
        if method == "sequential":
            return F.coalesce(((old if old is not None else F.lit(None)).cast("long") + 1).cast("string"), F.lit("1"))
        return {
            "none": F.lit(None).cast("string"), "sha256": F.upper(F.sha2(content, 256)), "md5": F.upper(F.md5(content.cast("binary"))),
            "uuid": F.upper(F.replace(F.uuid(), F.lit("-"), F.lit(""))), "timestamp": F.unix_micros(F.current_timestamp()).cast("string"),
        }[method]

    def write(self, rows: DataFrame) -> str:
        folder = f"data-{uuid.uuid4().hex}"
        rows.select(*(c.split()[0] for c in SCHEMA.split(", "))).withColumn("doc", F.parse_json("content")).write.parquet(f"{self.home}/{folder}")
        return folder

    def _new_rows(self, docs: Iterable) -> list[tuple[str, str]]:
        out = []
        for n, d in enumerate(docs):
            try:
                key, content = d if isinstance(d, tuple) else (None, d)
                text = _text(content)
                json.loads(text)
                if self.descriptor.key_method == "embedded_oid":
                    parsed = json.loads(text)
                    key = parsed.setdefault("_id", uuid.uuid4().hex[:24])
                    text = json.dumps(parsed, ensure_ascii=False)
                if key is None and self.descriptor.key_method == "client":
                    raise QueryError(2012, "the document has no key")
                out.append((canonical_key(key, self.descriptor.key_method) if key is not None else None, text))
            except (QueryError, ValueError, AttributeError) as e:
                raise BatchError(f"document {n} can't be written: {e}", n) from e
        return out

    def insert(self, docs: Iterable) -> DataFrame:
        """Documents, or (key, document) pairs, as one snapshot; their headers. All of them, or none."""
        self._writable()
        return self.insert_frame(self.spark.createDataFrame(self._new_rows(docs), "key string, content string"))

    def insert_frame(self, rows: DataFrame) -> DataFrame:
        """Insert a distributed set of rows (key, content); null keys are assigned. Keys must be new."""
        self._writable()
        base = self.manifest()
        now = F.lit(time.time()).cast("timestamp")
        rows = self._with_keys(rows, base)
        full = rows.select("key", "content", self.version_of(F.col("content")).alias("version"), now.alias("last_modified"), now.alias("created_on"), F.lit(None).cast("string").alias("media_type"))
        folder = self.write(full)
        added = self.spark.read.parquet(f"{self.home}/{folder}")
        twice = added.groupBy("key").count().filter("count > 1").limit(1).count()
        if twice or (base["folders"] and self.frame(base["snapshot"]).join(added, "key", "left_semi").limit(1).count()):
            self.database.files.delete(f"{self.home}/{folder}")
            raise BatchError("a key is there already", 0)
        self.commit(base, [*base["folders"], folder])
        return added.select("key", "version", "last_modified", "created_on")

    def _with_keys(self, rows: DataFrame, base: dict) -> DataFrame:
        """rows (key, content) with keys in place of null ones. Sequence keys go on from the largest, without gaps: rows are counted by partition, once they are written."""
        if self.descriptor.key_method != "sequence":
            return rows.withColumn("key", F.coalesce("key", F.upper(F.replace(F.uuid(), F.lit("-"), F.lit("")))))
        at = f"{self.home}/keys-{uuid.uuid4().hex}"
        rows.withColumn("_at", F.when(F.col("key").isNull(), F.monotonically_increasing_id())).withColumn("_part", F.spark_partition_id()).write.parquet(at)
        rows = self.spark.read.parquet(at)
        old = self.frame(base["snapshot"] if base["folders"] else None)
        top = max(df.agg(F.max(F.col("key").cast("long"))).first()[0] or 0 for df in (old, rows))
        counts = rows.filter("_at is not null").groupBy("_part").agg(F.count("*").alias("_n"))
        before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        inside = F.row_number().over(Window.partitionBy("_part", F.col("_at").isNull()).orderBy("_at"))
        numbered = rows.withColumn("_in", inside).join(F.broadcast(counts.select("_part", before.alias("_before"))), "_part", "left")  # one row a partition
        return numbered.select(F.coalesce("key", (F.col("_before") + F.col("_in") + top).cast("string")).alias("key"), "content")

    def insert_and_get(self, docs: Iterable) -> DataFrame:
        """The headers of the documents inserted."""
        return self.insert(docs)

    def save_and_get(self, docs: Iterable) -> DataFrame:
        """The headers of the documents saved."""
        at = self.save(docs)
        return self.frame().filter(F.col("last_modified") == F.lit(at).cast("timestamp")).select("key", "version", "last_modified", "created_on", "media_type")

    def save(self, docs: Iterable) -> float:
        """Insert, or replace the documents whose keys are there; of documents with one key the last one holds. The time that they carry."""
        self._writable()
        base = self.manifest()
        at = time.time()
        now = F.lit(at).cast("timestamp")
        named: dict = {}
        for n, (key, content) in enumerate(self._new_rows(docs)):
            named.pop(key, None)
            named[key if key is not None else n] = (key, content)
        rows = self._with_keys(self.spark.createDataFrame(list(named.values()), "key string, content string"), base)
        old = self.frame(base["snapshot"] if base["folders"] else None)
        new = rows.join(old.select("key", F.col("version").alias("_v"), F.col("created_on").alias("_c")), "key", "left").select(
            "key", "content", self.version_of(F.col("content"), F.col("_v")).alias("version"), now.alias("last_modified"), F.coalesce("_c", now).alias("created_on"), F.lit(None).cast("string").alias("media_type")
        )
        kept = old.join(rows.select("key"), "key", "left_anti").select(*new.columns)
        self.commit(base, [self.write(kept.unionByName(new))])
        return at

    def truncate(self) -> None:
        if self.descriptor.kind != "table":
            raise QueryError(3000, "only tables can be truncated")
        self._writable()
        self.commit(self.manifest(), [])

    def rewrite(self, wanted: Find, content: Column | None) -> Written:
        """Replace the contents of wanted rows, or drop them if content is None. Folders without such rows stay as they are."""
        self._writable()
        base, at = self.manifest(), time.time()
        many = wanted.many_keys(self.spark)
        named, wanted = many or (None, wanted)
        folders, processed, applied = [], 0, 0
        for folder in base["folders"]:
            rows = self.spark.read.schema(SCHEMA + ", doc variant").parquet(f"{self.home}/{folder}")
            if many:
                rows = rows.join(named.withColumn("_named", F.lit(True)), "key", "left")
                hit = F.col("_named").isNotNull() & wanted.condition
            else:
                hit = wanted.condition
            rows = rows.withColumn("_hit", F.coalesce(hit, F.lit(False)))
            if content is not None:
                rows = rows.withColumn("_new", F.when(F.col("_hit"), content))
            changed = F.col("_hit") if content is None else F.col("_new").isNotNull()
            got = rows.filter("_hit").agg(F.count("*").alias("n"), F.coalesce(F.sum(changed.cast("long")), F.lit(0)).alias("changed")).first()
            processed, applied = processed + got.n, applied + got.changed
            if not got.changed:
                folders.append(folder)
            elif content is None:
                folders.append(self.write(rows.filter("not _hit")))
            else:
                now = F.lit(at).cast("timestamp")
                folders.append(self.write(rows.withColumns({
                    "version": F.when(changed, self.version_of(F.col("_new"), F.col("version"))).otherwise(F.col("version")),
                    "last_modified": F.when(changed, now).otherwise(F.col("last_modified")),
                    "media_type": F.when(changed, F.lit(self.descriptor.media_type)).otherwise(F.col("media_type")),
                    "content": F.coalesce("_new", "content"),
                })))
        if applied:
            self.commit(base, folders)
        return Written(processed, applied, at)

    # metadata

    def _described(self, indexes: tuple) -> Collection:
        new = replace(self.descriptor, indexes=indexes)
        self.database.files.delete(f"{self.home}/descriptor.json")
        self.database.files.create(f"{self.home}/descriptor.json", json.dumps(asdict(new)))
        return replace(self, descriptor=new)

    def add_index(self, spec: dict) -> Collection:
        """Keep an index's specification. unique and scalarRequired are checked over all documents; ttl (seconds) hides documents on reads; the rest is a hint, as Spark has no secondary indexes."""
        if not spec.get("name") or not (spec.get("fields") or spec.get("spatial") or "search_on" in spec or "dataguide" in spec):
            raise QueryError(5042, "an index needs a name, and fields, spatial or search options")
        if spec.get("fields") and (spec.get("spatial") or "search_on" in spec):
            raise QueryError(5066, "fields can't stand beside spatial or search options")
        if spec.get("lax") and spec.get("scalarRequired"):
            raise QueryError(5059, "lax and scalarRequired exclude each other")
        if spec.get("multivalue") and len(spec.get("fields", ())) != 1:
            raise QueryError(2100, "a multivalue index has one path")
        values = [get(F.col("doc"), "string", json_path(f["path"].split("."))) for f in spec.get("fields", ())]
        rows = self.frame().select(*(v.alias(f"f{k}") for k, v in enumerate(values)))
        if spec.get("scalarRequired") and not rows.filter(" or ".join(f"{c} is null" for c in rows.columns)).isEmpty():
            raise QueryError(5059, "a document lacks a field of the index")
        if spec.get("unique") and not rows.dropna(how="all").groupBy(*rows.columns).count().filter("count > 1").isEmpty():
            raise QueryError(5059, "documents share the values of a unique index")
        return self._described((*(i for i in self.descriptor.indexes if i[0] != spec["name"]), (spec["name"], json.dumps(spec))))

    def indexes(self) -> list[dict]:
        return [json.loads(text) for _, text in self.descriptor.indexes]

    def drop_index(self, name: str) -> tuple[Collection, bool]:
        """The collection without the index, and whether there was one."""
        left = tuple(i for i in self.descriptor.indexes if i[0] != name)
        return self._described(left), len(left) < len(self.descriptor.indexes)


@dataclass(frozen=True)
class Stored(Find):
    """A find that can also write. As in the reference's interface, start keys don't narrow writes."""

    collection: Collection | None = None
    version_errors: bool = False

    def key(self, k: str) -> Stored:
        return super().key(canonical_key(k, self.collection.descriptor.key_method) if k is not None else k)

    def key_like(self, pattern: str, escape: str | None = None) -> Stored:
        if self.collection.descriptor.key_method != "client":
            raise QueryError(2052, "key_like needs keys that clients assign")
        return super().key_like(pattern, escape)

    def error_on_version_mismatch(self, on: bool = True) -> Stored:
        return replace(self, version_errors=on)

    def _wanted(self) -> Find:
        return replace(self, start=None)

    def _one(self) -> None:
        if not self.key_list or len(self.key_list) != 1:
            raise QueryError(2022, "this needs key()")

    def _written(self, content: Column | None) -> Written:
        done = self.collection.rewrite(self._wanted(), content)
        if self.version_errors and self.wanted_version is not None and not done.applied and self.collection.find_one(self.key_list[0] if self.key_list else ""):
            raise QueryError(2107, "the document has another version")
        return done

    def _got(self, done: Written) -> DataFrame:
        """The documents that a write changed, with their new versions."""
        return self.collection.frame().filter(F.col("last_modified") == F.lit(done.at).cast("timestamp")) if done.applied else self.collection.frame().limit(0)

    def _got_one(self, done: Written) -> Row | None:
        return self.collection.find_one(self.key_list[0]) if done.applied else None

    def remove(self) -> int:
        return self._written(None).applied

    def _replaced(self, doc) -> Written:
        text = _text(doc)
        parsed = json.loads(text)
        if self.collection.descriptor.key_method == "embedded_oid" and (not isinstance(parsed, dict) or "_id" not in parsed):
            raise QueryError(2105, "a replacement needs the document's _id")
        return self._written(F.lit(text))

    def replace(self, doc) -> int:
        return self._replaced(doc).applied

    def replace_one(self, doc) -> bool:
        self._one()
        return self.replace(doc) > 0

    def replace_one_and_get(self, doc) -> Row | None:
        self._one()
        return self._got_one(self._replaced(doc))

    def _guard(self, names: Iterable[str], code: int) -> None:
        if self.collection.descriptor.key_method == "embedded_oid" and "_id" in names:
            raise QueryError(code, "_id can't be changed")

    def merge_counted(self, patch: dict) -> Written:
        """How many documents were wanted, and how many the patch changed."""
        self._guard(patch, 2104)
        return self._written(F.to_json(projecting.merge_patch(F.col("doc"), patch)))

    def merge(self, patch: dict) -> int:
        return self.merge_counted(patch).applied

    def merge_and_get(self, patch: dict) -> DataFrame:
        return self._got(self.merge_counted(patch))

    def merge_one(self, patch: dict) -> bool:
        self._one()
        return self.merge(patch) > 0

    def merge_one_and_get(self, patch: dict) -> Row | None:
        self._one()
        return self._got_one(self.merge_counted(patch))

    def patch_counted(self, steps: list[dict]) -> Written:
        """JSON Patch; documents it doesn't apply to stay as they are and count as wanted only."""
        touched = [s[k] for s in steps for k in ("path", "from") if k in s and s["op"] != "test" and not (k == "from" and s["op"] == "copy")]
        self._guard(["_id" if t == "" else t.split("/")[1] for t in touched if t == "" or t.count("/")], 2106)
        return self._written(F.to_json(projecting.json_patch(F.col("doc"), steps)))

    def patch(self, steps: list[dict]) -> int:
        return self.patch_counted(steps).applied

    def patch_and_get(self, steps: list[dict]) -> DataFrame:
        return self._got(self.patch_counted(steps))

    def patch_one(self, steps: list[dict]) -> bool:
        self._one()
        return self.patch(steps) > 0

    def patch_one_and_get(self, steps: list[dict]) -> Row | None:
        self._one()
        return self._got_one(self.patch_counted(steps))
