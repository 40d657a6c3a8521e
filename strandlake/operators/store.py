"""Parquet tables in versions under one root, committed together, appended by key and compacted."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.functions.blanks import key_value
from strandlake.operators.merge import duplicate_ledger, keyed_append, table_key, upsert
from strandlake.operators.ranking import keep_one

#: A part's filter has so many bits for each row, of which each key sets so many.
BITS_PER_ROW, HASHES = 32, 6
#: So many parts of about one size are rewritten as one.
FAN = 8
#: Times that a commit is tried again when other writers take its version.
TRIES = 10


class Conflict(RuntimeError):
    """Another writer has changed what a commit was built on."""


@dataclass
class Change:
    """What a commit does to one table: parts to add, parts to take away (None: all), and whether the table must be as it was read."""

    add: list[dict] = field(default_factory=list)
    remove: set[str] | None = field(default_factory=set)
    unchanged: bool = False
    schema: T.StructType | None = None


class TableStore:
    """Tables of parts, each written once, and numbered commits, each a manifest of all tables with their parts.

    A commit may change several tables at once. It is created only if its number is not taken; a writer that comes second looks
    at what the first one did, and goes on with the next number unless a table that it read has changed. Files of
    earlier commits stay untouched until vacuum(). A part comes with its number of rows, the range of its keys and a filter of
    them, so that an append opens only parts that may hold one of its keys. Columns that are new in a part are null in earlier ones.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # Manifests

    def _path(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self, name: str) -> list[int]:
        """Numbers of the commits; those of a table are those of the store."""
        path, fs = self._path("commits")
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(path)) if fs.exists(path) else []

    def _state(self, version: int) -> dict | None:
        """The manifest, or None if its writer ended before it was whole."""
        path, fs = self._path("commits", f"v{version}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            return None
        finally:
            stream.close()

    def _latest(self, name: str) -> tuple[int, dict]:
        for version in reversed(self._versions(name)):
            if state := self._state(version):
                return version, state
        return 0, {"tables": {}, "tags": {}}

    def _commit(self, name: str, base: tuple[int, dict], changes: dict[str, Change], tags: dict[str, int] | None = None) -> int:
        """Publish the changes as the next version."""
        parts_of = lambda state, table: [p["part"] for p in state["tables"].get(table, {}).get("parts", [])]
        for _ in range(TRIES):
            _, state = self._latest(name)
            tables = dict(state["tables"])
            for table, change in changes.items():
                now = parts_of(state, table)
                if change.unchanged and now != parts_of(base[1], table) or change.remove and not change.remove <= set(now):
                    raise Conflict(f"{table} has changed since version {base[0]}")
                old = tables.get(table, {"schema": T.StructType().jsonValue(), "parts": []})
                kept = [p for p in old["parts"] if change.remove is not None and p["part"] not in change.remove]
                schema = old["schema"] if change.schema is None else (change.schema if change.remove is None else _united(T.StructType.fromJson(old["schema"]), change.schema)).jsonValue()
                tables[table] = {"schema": schema, "parts": kept + change.add}
            version = max(self._versions(name), default=0) + 1
            path, fs = self._path("commits", f"v{version}")
            try:
                out = fs.create(path, False)
            except Py4JJavaError as error:
                if "FileAlreadyExists" not in str(error.java_exception):
                    raise
                continue  # another writer was first
            try:
                out.write(json.dumps({"tables": tables, "tags": state["tags"] | (tags or {})}).encode())
            finally:
                out.close()
            return version
        raise Conflict(f"version {version} of the store already exists")

    # Parts

    def _keys(self, name: str, columns: list[str]) -> list[str]:
        try:
            return table_key(name, columns)
        except ValueError:
            return []

    def _write(self, name: str, df: DataFrame, clustered: bool = False) -> dict:
        """Write df as a part: its name, number of rows, key columns, range of the first key and bits of its filter."""
        keys, part = self._keys(name, df.columns), f"part-{uuid.uuid4().hex}"
        if clustered and keys:
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        path = f"{self.root}/{name}/parts/{part}"
        df.write.parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path)
        if not keys:
            return {"part": part, "rows": rows.count(), "keys": []}
        texts = rows.select(*_texts(rows, keys))
        low, high, n = texts.agg(F.min("_t0"), F.max("_t0"), F.count(F.lit(1))).first()
        bits = 1 << max(15, math.ceil(math.log2(BITS_PER_ROW * max(1, n))))
        slots = texts.select(F.explode(F.array(*_places(len(keys), bits))).alias("slot"))
        bitmap = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))
        bitmap.write.parquet(f"{self.root}/{name}/filters/{part}")
        return {"part": part, "rows": n, "keys": keys, "low": low, "high": high, "bits": bits}

    def _open(self, name: str, parts: list[str], schema: T.StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{name}/parts/{part}" for part in parts))

    def _may_hold(self, name: str, parts: list[dict], incoming: DataFrame, keys: list[str]) -> list[str]:
        """Parts that may hold a key of incoming: by the ranges of their keys, then by their filters.

        Keys meet the filters' rows in a join, so that filters may be of any size; only names of parts come to the driver.
        """
        unknown = [p["part"] for p in parts if p["keys"] != keys]
        known = [p for p in parts if p["keys"] == keys and p["rows"]]
        texts = incoming.select(*_texts(incoming, keys)).distinct()
        least, most = texts.agg(F.min("_t0"), F.max("_t0")).first() if known else (None, None)
        known = [p for p in known if least is not None and p["low"] <= most and p["high"] >= least]
        if not known:
            return unknown
        schema = "part string, low string, high string, bits long"
        ranges = F.broadcast(self.spark.createDataFrame([(p["part"], p["low"], p["high"], p["bits"]) for p in known], schema))  # a row for each part
        filters = self.spark.read.schema("bucket long, bitmap binary").parquet(*(f"{self.root}/{name}/filters/{p['part']}" for p in known))
        filters = filters.withColumn("part", F.regexp_extract(F.col("_metadata.file_path"), r"/filters/([^/]+)/", 1)).join(ranges, "part")
        sizes = sorted({p["bits"] for p in known})
        key = F.struct(*(f"_t{i}" for i in range(len(keys)))).alias("key")
        places = F.explode(F.flatten(F.array(*(F.array(*(F.struct(F.lit(bits).alias("bits"), p.alias("slot")) for p in _places(len(keys), bits))) for bits in sizes)))).alias("p")
        asked = texts.select("_t0", key, places).select("_t0", "key", F.col("p.bits").alias("bits"), F.bitmap_bucket_number("p.slot").alias("bucket"), F.bitmap_bit_position("p.slot").alias("bit")).distinct()
        met = asked.join(filters, ["bits", "bucket"]).filter(F.col("_t0").between(F.col("low"), F.col("high")))
        byte = F.conv(F.hex(F.expr("substring(bitmap, CAST(bit DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
        missing = F.count_if(byte.bitwiseAND(F.expr("shiftleft(1, CAST(bit % 8 AS INT))")) == 0)
        wanted = asked.groupBy("key", "bits").agg(F.count(F.lit(1)).alias("n"))
        seen = met.groupBy("key", "part", "bits").agg(missing.alias("missing"), F.count(F.lit(1)).alias("found")).filter("missing = 0")
        return unknown + [r["part"] for r in seen.join(wanted, ["key", "bits"]).filter("found = n").select("part").distinct().collect()]

    # Tables

    def exists(self, name: str) -> bool:
        return name in self._latest(name)[1]["tables"]

    def read(self, name: str, version: int | None = None) -> DataFrame:
        state = self._latest(name)[1] if version is None else self._state(version)
        table = state["tables"][name]
        return self._open(name, [p["part"] for p in table["parts"]], T.StructType.fromJson(table["schema"]))

    def replace(self, name: str, df: DataFrame) -> int:
        """Write df as the table. Readers see it when its manifest is there; earlier versions stay as backups."""
        base = self._latest(name)
        return self._commit(name, base, {name: Change([self._write(name, df)], None, True, df.schema)})

    def append(self, name: str, df: DataFrame) -> int:
        """Add the rows of df; their values take the types that the table's columns have."""
        return self.append_all({name: df})

    def append_all(self, tables: dict[str, DataFrame]) -> int:
        """Add rows to several tables in one commit: readers see all of them or none."""
        name = next(iter(tables))
        base = self._latest(name)
        changes = {t: self._added(t, base[1], df) for t, df in tables.items()}
        version = self._commit(name, base, changes)
        for t in tables:
            version = self.compact(t) or version
        return version

    def _added(self, name: str, state: dict, df: DataFrame) -> Change:
        df = self._typed(name, state, df)
        return Change([self._write(name, df)], schema=df.schema)

    def _typed(self, name: str, state: dict, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in T.StructType.fromJson(state["tables"][name]["schema"])} if name in state["tables"] else {}
        return df.select(*(F.col(c).cast(types[c]).alias(c) if c in types and df.schema[c].dataType != types[c] else F.col(c) for c in df.columns))

    def append_new(self, name: str, df: DataFrame, now: datetime, order: str | None = None, ledger: str | None = "update_exclusions", replace_updated: bool = False, tag: tuple[str, int] | None = None) -> int:
        """Append the rows whose key is new; keys that are there already go to the ledger, in the same commit. Running it again appends nothing.

        A newer version of a known key is left out like any other duplicate, unless replace_updated puts it in its place. A tag
        (source, number) marks a batch: one whose number the source has reached already changes nothing, the ledger included.
        """
        keys = table_key(name, df.columns)

        def attempt() -> int:
            base = version, state = self._latest(name)
            if tag and state["tags"].get(tag[0], -1) >= tag[1]:
                return version
            rows, tags = self._typed(name, state, df), {tag[0]: tag[1]} if tag else None
            table = state["tables"].get(name)
            if not table:
                first = keep_one(rows, keys, order or F.struct(*rows.columns))
                return self._commit(name, base, {name: Change([self._write(name, first)], None, True, first.schema)}, tags)
            schema = T.StructType.fromJson(table["schema"])
            if replace_updated:
                out = upsert(self.read(name, version), keep_one(rows, keys, order or F.struct(*rows.columns), last=True), keys)
                return self._commit(name, base, {name: Change([self._write(name, out)], None, True, out.schema)}, tags)
            held = self._open(name, self._may_hold(name, table["parts"], rows, keys), schema)
            new, duplicates = keyed_append(held, rows, keys, order)
            changes = {name: Change([self._write(name, new)], unchanged=True, schema=new.schema)}
            if ledger:
                changes[ledger] = self._added(ledger, state, duplicate_ledger(duplicates, name, keys, "duplicate key", now))
            return self._commit(name, base, changes, tags)

        version = _again(attempt)
        for t in (name, ledger) if ledger else (name,):
            version = self.compact(t) or version
        return version

    def compact(self, name: str, fan: int = FAN) -> int | None:
        """Rewrite parts as one, sorted by key, where fan or more are of about one size; the version, or None if there was nothing to do.

        So a row is written anew once for each time that its part grows by fan, and a table has few parts. Parts that
        others append meanwhile stay beside the new one.
        """
        version = None
        while True:
            base = self._latest(name)
            table = base[1]["tables"].get(name, {"parts": []})
            tiers: dict[int, list[dict]] = {}
            for part in table["parts"]:
                tiers.setdefault(int(math.log(max(1, part["rows"]), fan)), []).append(part)
            full = [parts for _, parts in sorted(tiers.items()) if len(parts) >= fan]
            if not full:
                return version
            names, schema = [p["part"] for p in full[0]], T.StructType.fromJson(table["schema"])
            try:
                version = self._commit(name, base, {name: Change([self._write(name, self._open(name, names, schema), True)], set(names), schema=schema)})
            except Conflict:
                return version  # another writer has rewritten these parts

    def vacuum(self, keep: int = 1) -> int:
        """Delete parts that none of the last keep versions names, and earlier manifests; the number of parts deleted. For use while nobody writes."""
        versions = self._versions("")
        kept, gone = versions[-keep:], versions[:-keep]
        states = [s for v in kept if (s := self._state(v))]
        used = {(t, p["part"]) for s in states for t, table in s["tables"].items() for p in table["parts"]}
        n = 0
        for table in {t for s in states for t in s["tables"]}:
            for kind in ("parts", "filters"):
                path, fs = self._path(table, kind)
                for status in fs.listStatus(path) if fs.exists(path) else []:
                    if (table, status.getPath().getName()) not in used:
                        fs.delete(status.getPath(), True)
                        n += kind == "parts"
        for version in gone:
            path, fs = self._path("commits", f"v{version}")
            fs.delete(path, False)
        return n


def _again(attempt: Callable[[], int]) -> int:
    for _ in range(TRIES - 1):
        try:
            return attempt()
        except Conflict:
            continue
    return attempt()


def _united(old: T.StructType, new: T.StructType) -> T.StructType:
    have = set(old.names)
    return T.StructType([T.StructField(f.name, f.dataType) for f in [*old.fields, *(f for f in new.fields if f.name not in have)]])


def _texts(df: DataFrame, keys: list[str]) -> list[Column]:
    """_t0, _t1, ...: the keys as they are compared, as texts."""
    return [F.coalesce(key_value(F.col(k), isinstance(df.schema[k].dataType, T.StringType)).cast("string"), F.lit("\0")).alias(f"_t{i}") for i, k in enumerate(keys)]


def _places(n_keys: int, bits: int) -> list[Column]:
    """Places, from 1, that a key has in a filter."""
    return [F.pmod(F.xxhash64(F.lit(i), *(f"_t{j}" for j in range(n_keys))), F.lit(bits)) + 1 for i in range(HASHES)]
