"""The table store: commits over several tables, appends by key statistics, compaction."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strandlake.operators import store as stores

NOW = datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture
def store(spark, tmp_path):
    return stores.TableStore(spark, f"file://{tmp_path}/store")


def sequences(spark, *keys, text="A"):
    return spark.createDataFrame([(k, text) for k in keys], "header string, sequence string")


def headers(df):
    return sorted(r["header"] for r in df.select("header").collect())


def watched(store, monkeypatch):
    """The parts that the store opens from now on."""
    seen, opens = [], store._open
    monkeypatch.setattr(store, "_open", lambda name, parts, schema: (seen.extend(parts), opens(name, parts, schema))[1])
    return seen


def test_appends_of_new_keys_open_no_old_part(spark, store, monkeypatch):
    for i in range(3):  # ranges that lie apart
        store.append_new("sequences", sequences(spark, *(f"{chr(97 + i)}{k:03}" for k in range(200))), NOW)
    old = {p["part"] for p in store._latest("")[1]["tables"]["sequences"]["parts"]}
    seen = watched(store, monkeypatch)
    store.append_new("sequences", sequences(spark, *(f"z{k}" for k in range(50))), NOW)
    assert not old & set(seen)
    store.append_new("sequences", sequences(spark, *(f"b{k:03}x" for k in range(50))), NOW)  # within a part's range: its filter tells
    assert not old & set(seen)
    store.append_new("sequences", sequences(spark, "b007", " c008 ", "new", text="other"), NOW)
    assert len(old & set(seen)) == 2
    monkeypatch.undo()
    assert len(headers(store.read("sequences"))) == len(set(headers(store.read("sequences")))) == 701
    assert store.read("sequences").filter("sequence = 'other'").count() == 1
    assert sorted(r["key"] for r in store.read("update_exclusions").collect()) == ["b007", "c008"]


def test_keys_of_several_columns_and_nulls(spark, store):
    table = lambda *rows: spark.createDataFrame(rows, "host_taxa_id long, rank string, name string")
    store.append_new("host_lineage", table((1, "genus", "a"), (None, "genus", "b"), (2, None, "c")), NOW)
    store.append_new("host_lineage", table((1, "genus ", "x"), (None, "genus", "x"), (2, "", "x"), (1, "species", "d")), NOW)
    assert sorted(r["name"] for r in store.read("host_lineage").collect()) == ["a", "b", "c", "d"]
    store.append_new("host_lineage", spark.createDataFrame([("1", "genus", "x"), ("3", "genus", "e")], "host_taxa_id string, rank string, name string"), NOW)
    assert sorted(r["name"] for r in store.read("host_lineage").collect()) == ["a", "b", "c", "d", "e"]


def test_fifty_appends(spark, store):
    for i in range(50):
        store.append_new("sequences", sequences(spark, f"h{i:02}", f"h{i - 1:02}"), NOW)
    parts = store._latest("")[1]["tables"]["sequences"]["parts"]
    assert len(parts) < 2 * stores.FAN
    assert sum(p["rows"] for p in parts) == 51 and headers(store.read("sequences")) == sorted(["h-1", *(f"h{i:02}" for i in range(50))])
    assert store.read("sequences", 1).count() == 2  # earlier versions stay
    assert store.read("update_exclusions").count() == 49
    deleted = store.vacuum()
    assert deleted > 0 and store.read("sequences").count() == 51 and store.vacuum() == 0
    store.append_new("sequences", sequences(spark, "h07", "h99"), NOW)
    assert store.read("sequences").count() == 52


def test_compacted_parts_are_sorted(spark, store):
    for i in range(stores.FAN):
        store.append("sequences", sequences(spark, *(f"{(i * 37 + k * 11) % 97:02}-{i}" for k in range(8))))
    (part,) = store._latest("")[1]["tables"]["sequences"]["parts"]
    rows = [r["header"] for r in store.read("sequences").coalesce(1).collect()]
    assert rows == sorted(rows) and part["rows"] == len(rows) == 8 * stores.FAN and (part["low"], part["high"]) == (rows[0], rows[-1])


def test_second_writer_tries_again(spark, store, monkeypatch):
    """Another writer commits between this one's reading and its commit: nothing is lost or written twice, in the ledger neither."""
    store.append_new("sequences", sequences(spark, "a"), NOW)
    other, commit, interrupted = stores.TableStore(spark, store.root), store._commit, []

    def late(name, base, changes, tags=None):
        if not interrupted:
            interrupted.append(other.append_new("sequences", sequences(spark, "b", "a", text="first"), NOW))
        return commit(name, base, changes, tags)

    monkeypatch.setattr(store, "_commit", late)
    store.append_new("sequences", sequences(spark, "b", "c", text="second"), NOW)
    assert interrupted and sorted(map(tuple, store.read("sequences").collect())) == [("a", "A"), ("b", "first"), ("c", "second")]
    assert sorted(r["key"] for r in store.read("update_exclusions").collect()) == ["a", "b"]


def test_failed_commit_leaves_all_tables(spark, store, monkeypatch):
    store.append_new("sequences", sequences(spark, "a"), NOW)

    def fails(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(store, "_commit", fails)
        with pytest.raises(OSError):
            store.append_new("sequences", sequences(spark, "a", "b"), NOW)
    assert headers(store.read("sequences")) == ["a"] and not store.exists("update_exclusions")
    store.append_new("sequences", sequences(spark, "a", "b"), NOW)
    assert headers(store.read("sequences")) == ["a", "b"] and store.read("update_exclusions").count() == 1


def test_unfinished_manifest_is_passed_over(spark, store, tmp_path):
    store.append("sequences", sequences(spark, "a"))
    (tmp_path / "store/commits/v2").write_text('{"tables": {"seq')
    assert headers(store.read("sequences")) == ["a"]
    assert store.append("sequences", sequences(spark, "b")) == 3
    assert headers(store.read("sequences")) == ["a", "b"]


def test_writers_of_different_tables_do_not_disturb(spark, store):
    store.append("sequences", sequences(spark, "a"))
    base = store._latest("")
    store.append("other", sequences(spark, "x"))
    store._commit("sequences", base, {"sequences": stores.Change([store._write("sequences", sequences(spark, "b"))], unchanged=True)})
    assert headers(store.read("sequences")) == ["a", "b"] and headers(store.read("other")) == ["x"]
    with pytest.raises(stores.Conflict, match="changed"):
        store._commit("sequences", base, {"sequences": stores.Change([], None, True)})
    assert store.append_all({"sequences": sequences(spark, "c"), "other": sequences(spark, "y")}) == 4
    assert store.read("other", 4).count() == 2 and store.read("sequences", 4).count() == 3


def test_tagged_batches_count_once(spark, store):
    for number, keys in ((0, "ab"), (0, "ab"), (1, "bc"), (1, "bc")):
        store.append_new("sequences", sequences(spark, *keys), NOW, tag=("stream", number))
    assert headers(store.read("sequences")) == ["a", "b", "c"] and store.read("update_exclusions").count() == 1
    assert store.read("sequences").filter(F.col("header") == "zz").count() == 0
