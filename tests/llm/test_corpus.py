"""Decontamination, packing, fixity and the pipeline."""

import hashlib
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from strandlake.llm import decontaminate, fixity, pack
from tests.llm.conftest import ODD

TOKENS = public_tokenizers.path("byte_bpe_50k.json")
ITEM = "A farmer named Tom has 12 kg of apples and 30 pears. If Tom sells 5 kg of apples each day, how many days will it take until Tom has none of them left in the old barn?"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, window string")


def test_leaks(spark, documents):
    filler = " ".join(f"filler{chr(97 + i % 26)}" for i in range(60))
    other = ITEM.replace("Tom", "Anna").replace("12", "77").replace("30", "4,5").replace("5 kg", "9 kg").replace("kg", "lb")
    wild = re.sub("Tom", lambda m, n=iter(["Ann", "Bob", "Cy"]): next(n), ITEM)
    rows = [(101, f"{filler} {ITEM} {filler}"), (102, f"{filler}\n{other}\n{filler}"), (103, filler), (104, ITEM[: len(ITEM) // 2]), (105, " ".join(ITEM.upper().lower().split())), *ODD]
    bench = items(spark, [(7, ITEM, "w"), (8, None, "w"), (9, "...", "w"), (10, filler[:40], "w")])
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(documents(rows), bench).collect()}
    assert {(101, 7), (102, 7)} <= set(got)
    assert not {d for d, i in got if i == 7} & {103, 104, 1, 2, 3, 4, 7, 8, 9, 10, None}
    assert got[102, 7]["slots"] > 0 and got[102, 7]["slot_consistency"] >= 0.9
    assert decontaminate.leaks(documents([(1, wild)]), bench, consistency=0.9).filter("item_id = 7").count() == 0
    assert decontaminate.leaks(documents([(1, ITEM)]), bench.limit(0)).count() == 0
    assert decontaminate.leaks(documents([]), bench).count() == 0
    clean = decontaminate.decontaminate(documents(rows), bench)
    assert clean.columns == documents(rows).columns and clean.count() == len(rows) - len({d for d, _ in got})


def test_leaks_without_broadcast(spark, documents, monkeypatch):
    bench = items(spark, [(7, ITEM, "w")])
    rows = [(1, "x " + ITEM), (1, "x " + ITEM), (2, "nothing here"), (None, ITEM)]
    want = sorted(map(str, decontaminate.leaks(documents(rows), bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(map(str, decontaminate.leaks(documents(rows), bench).collect())) == want
    assert len(want) == 2


def with_values(text, name, *numbers):
    return re.sub(r"[0-9]+", lambda m, n=iter(numbers): str(next(n)), text).replace("Tom", name)


def test_leaks_by_occurrence(spark, documents):
    """A template held several times with different values, and a wild mixture of values that is no occurrence."""
    bench = items(spark, [(7, ITEM, "w")])
    copies = [ITEM, *(with_values(ITEM, f"{n}a", *range(100 * k, 100 * k + 3)) for k, n in ((1, "Anna"), (2, "Bobby"), (3, "Carla")))]
    inserted = [c.replace("will it take", "will it then take") for c in copies]
    wild = " ".join(re.sub(r"[0-9]+|Tom|kg", lambda m, n=iter(range(10 * k, 10 * k + 10)): ("N" if m[0] == "Tom" else "") + (f"{next(n)}" if m[0] != "Tom" else chr(97 + next(n)) * 3), ITEM) for k in range(1, 5))
    rows = [(1, " ".join(copies)), (2, "\n".join(copies[1:])), (3, " and then ".join(inserted)), (4, wild), (5, ITEM)]
    got = {r["doc_id"]: r for r in decontaminate.leaks(documents(rows), bench, consistency=0.6).collect()}
    assert {1, 2, 3, 5} == set(got)
    assert all(r["slot_consistency"] >= 0.9 for r in got.values())
    assert [r["doc_id"] for r in decontaminate.decontaminate(documents(rows[:3]), bench).collect()] == []


def test_leaks_of_renamed_starts(spark, documents):
    """Names at the start of texts, sentences, lines and quotations, and in capitals."""
    first = "Tom has 5 apples and 3 pears. Tom gives 2 apples to his sister. Tom then buys 7 more pears. How many fruits does Tom have?"
    quoted = first.replace(". Tom gives", '.\n"Tom gives').replace(". Tom then", ". (Tom then")
    bench = items(spark, [(1, first, "w"), (2, quoted, "w")])
    rows = [(1, first.replace("Tom", "Anna")), (2, "so " + quoted.replace("Tom", "Anna")), (3, first.replace("Tom", "ANNA").replace("5", "9")), (4, "Anna has no fruits. How many fruits does Bob have?")]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(rows), bench).collect()}
    assert got == {(d, i) for d in (1, 2, 3) for i in (1, 2)}


def test_leaks_sql_agrees(spark, documents):
    """The SQL that the driver compares with, on a fixture whose items have slots."""
    import duckdb

    from strandlake.llm.queries import oracle_sql

    rows = [(1, "so " + ITEM.replace("Tom", "Anna").replace("12", "9,5").replace("30", "31")), (2, ITEM + " " + ITEM.replace("Tom", "Bob")), (3, "no leak"), (4, None)]
    bench = [(7, ITEM), (8, None), (9, "Is Anna 5 years old? Then Anna was 4 years old one year ago, as Bob knows.")]
    store = duckdb.connect()
    for name, columns, data in (("documents", "doc_id BIGINT, text VARCHAR", rows), ("benchmark", "item_id BIGINT, text VARCHAR", bench)):
        store.execute(f"CREATE TABLE {name} ({columns})")
        store.executemany(f"INSERT INTO {name} VALUES (?, ?)", data)
    want = store.execute(oracle_sql()["op6_benchmark_decontamination"]).fetchall()
    got = [tuple(r) for r in decontaminate.leaks(documents(rows), items(spark, [(*b, "w") for b in bench])).collect()]
    rounded = lambda x: sorted((*r[:4], round(r[4], 9), r[5], round(float(r[6]), 9)) for r in x)
    assert rounded(got) == rounded(want)
    assert any(r[5] > 0 for r in got)


def template(text):
    """The template words, by hand."""
    text = re.sub(r"[0-9]+(?:[.,][0-9]+)*", lambda m: f"0n{m[0]} ", text)
    text = re.sub(rf"(0n[0-9.,]+[ ]+)((?:{decontaminate.UNITS})\b)", r"\g<1>0u\2", text)
    text = re.sub(r"([^\W\d_A-Z]|[0-9,;])( )([A-Z])", lambda m: f"{m[1]}{m[2]}0a{m[3]}" if m[1].islower() or not m[1].isalpha() else m[0], text)
    return [w for w in re.split(r"[^\w]+|_", re.sub(r"0([anu])[^\W_.,]*[\w.,]*", r"0\1 ", text).lower()) if w]


def test_leaks_of_sample(spark, sample):
    df, texts = sample
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    windows = lambda ws: {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()
    held = {i: windows(template(t)) for i, t in texts.items()}
    want = set()
    for r in bench.collect():
        own = windows(template(r["text"]))
        want |= {(i, r["item_id"]) for i, w in held.items() if len(own & w) / len(own) >= 0.8}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, bench).collect()}
    assert got == want
    plain = lambda t: " ".join(t.lower().split())
    assert {(i, r["item_id"]) for r in bench.collect() for i, t in texts.items() if plain(r["text"]) in plain(t)} <= got


def check_packed(rows, got, capacity):
    made, want = library(), Counter()
    for i, t in rows:
        ids = np.array(made.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = [0, *range(len(ids) % capacity or min(capacity, len(ids)), len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, n, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    used = {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(used), sum(r["length"] for r in got)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing(documents, sample, capacity):
    rows = [*ODD, *list(sample[1].items())[:60], (500, "a <|endoftext|> b"), (501, "x  y   z\n\n  w ")]
    got = pack.pack_documents(documents(rows), TOKENS, capacity).collect()
    sequences, total = check_packed(rows, got, capacity)
    assert sequences <= -(-total // capacity) * 1.05 + 1
    assert pack.pack_documents(documents([]), TOKENS).count() == 0
    ids = pack.pack_documents(documents(rows[:5]), TOKENS, capacity, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\r\xa0\x1c\x1f\x85\u2003\u3000\u200b\ufeff'sab1é½.,!<|"), max_size=30) | st.sampled_from(["<|endoftext|>", "it's", "don't  ", "\xa0\n \xa0 \xa0"]), max_size=6))
def test_ids_are_the_librarys(parts):
    text = "".join(parts)
    assert list(pack.token_bytes([text], TOKENS)) == [np.array(library().encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


@cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENS)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 30)))
def test_plan_uses_every_piece_once(counts):
    runs = pack.plan(counts, 40)
    used = Counter()
    for lengths, n in runs:
        assert n > 0 and sum(lengths) <= 40
        for x in lengths:
            used[x] += n
    assert used == Counter({k: v for k, v in counts.items() if v})
    table = pack.places(runs)
    assert len(table["length"]) == sum(len(lengths) for lengths, _ in runs)


def test_plan_fills_exactly():
    assert sorted(pack.plan({10: 3, 6: 2, 4: 2, 5: 1, 3: 1, 2: 1}, 10)) == sorted([((10,), 3), ((6, 4), 2), ((5, 3, 2), 1)])


def test_fixity(spark):
    rows = [(i, f"u{i}", "<p>" + "x" * (i * 37 % 900) + "é</p>") for i in range(400)] + [(7, "u7", "<p>" + "x" * 259 + "é</p>"), (None, None, None), (None, None, None), (900, "big", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"offset": F.lit(1), "state": F.lit("?")})
    damage = F.when(F.col("page_id") % 50 == 3, F.lit(None)).when(F.col("page_id") % 60 == 7, F.concat(F.lit("w"), F.expr("substring(record, 2)"))).otherwise(F.col("record"))
    got = fixity.report(pages, damage).collect()
    record = lambda i, u, h: f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{'' if i is None else i}>\r\nWARC-Target-URI: {u or ''}\r\nContent-Length: {len((h or '').encode())}\r\n\r\n{h or ''}\r\n\r\n".encode()
    state = lambda i: "ok" if i is None else "missing" if i % 50 == 3 else "changed" if i % 60 == 7 else "ok"
    want = Counter((hashlib.sha256(record(*r)).hexdigest(), len(record(*r)), r[0], state(r[0])) for r in rows)
    assert {(r["record_sha256"], r["length"], r["page_id"], r["state"]): r["copies"] for r in got} == want
    ends = {}
    for r in sorted(got, key=lambda r: (r["volume"], r["offset"])):
        assert r["offset"] == ends.get(r["volume"], 0)
        ends[r["volume"]] = r["offset"] + r["length"]
    assert fixity.report(pages.limit(0)).count() == 0


def test_audit_reads_only_what_differs(spark):
    sha = lambda x: hashlib.sha256(str(x).encode()).hexdigest()
    left = spark.createDataFrame([(i * 5000, sha(i)) for i in range(3000)], "address long, sha string")
    right = left.filter("address != 10000").withColumn("sha", F.when(F.col("address") == 9_000_000, "0").otherwise(F.col("sha"))).union(spark.createDataFrame([(77, "z")], left.schema))
    assert sorted(tuple(r) for r in fixity.audit(left, right).collect()) == [(77, "extra"), (10000, "missing"), (9_000_000, "changed")]
    assert fixity.audit(left, left).count() == 0
    levels = fixity.tree(left)
    assert levels[-1].count() == 1 and [d.count() for d in levels[:2]] == [229, 4]


def test_pipeline(spark, sample):
    df, texts = sample
    docs, kept = df, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        if name != "best-fit packing":
            assert out.columns == df.columns
            kept.append({r["doc_id"] for r in out.collect()})
        docs = spark.createDataFrame(out.toPandas(), out.schema)
    identified, exact, near, clean = kept
    assert identified == set(texts)  # every document of this table has a language
    first = {}
    for i in sorted(texts):
        first.setdefault(" ".join(re.split("[\x20\x09-\x0d]+", texts[i])), i)
    assert exact == set(first.values())
    assert clean < near <= exact
    check_packed([(i, texts[i]) for i in clean], docs.collect(), 2048)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
