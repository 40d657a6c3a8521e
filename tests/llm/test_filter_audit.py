"""The audit of filters against brute force over all orders."""

import re
from collections import defaultdict
from itertools import permutations

import duckdb
import pytest

from strandlake.llm import filter_audit, queries

SPACE = re.compile("[\x20\x09-\x0d]+")


def masks(rows):
    """The letters that each (doc_id, text, source) fails."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        words = [w for w in SPACE.split(t) if w]
        failed = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and t in first and i > first[t],
        }
        out.append({x for x in failed if failed[x]})
    return out


def brute(rows, labels):
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for (i, _, s), m in zip(rows, masks(rows), strict=True):
        parts[s or ""].append((i, m))
    out = set()
    for part, docs in parts.items():
        steps, shapley = [], defaultdict(int)
        for order in permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order, 1):
                gone, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                fails, alone = sum(f in m for _, m in docs), sum(m == {f} for _, m in docs)
                steps.append((f, part, "".join(order), k, len(left), len(gone), fails - len(gone), alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out |= {(*s[1:], shapley[s[0]]) for s in steps}
    return out


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, None, "a"), (2, "", "a"), (3, LONG, "a"), (4, LONG, "b"), (4, LONG, "b"), (None, LONG, "b"), (5, LONG + " #", None), (6, "x " * 80, ""), (7, LONG.upper(), "a"), (8, "É" * 30 + "A", "a"),
    (9, LONG.replace(" ", "\x0b"), "a"), (10, LONG.replace(" ", " "), "a"), (11, "AB|" + "a" * 200, "a"), (12, "Zz" * 9000, "c"), (13, "word $ " * 9000, "c"), (14, "word $ " * 9000, "c"),
]
LABELS = [(1, 1, 0), (3, 1, 1), (4, 1, 0), (4, 0, 1), (6, None, 1), (7, 1, None), (14, 1, 1), (None, 1, 1), (99, 1, 1)]


@pytest.fixture(scope="session")
def audited(spark):
    docs = spark.createDataFrame([(*r, "m", 1, "d") for r in ROWS], "doc_id long, text string, source string, mask string, part int, digest string")
    labels = spark.createDataFrame([(*r, "g") for r in LABELS], "doc_id long, quality int, toxic int, good string")
    return docs, labels


def test_audit(audited):
    got = [tuple(r) for r in filter_audit.audit(*audited).select(*COLUMNS).collect()]
    expected = brute(ROWS, LABELS)
    assert len(got) == len(set(got)) == 600 * 4 and set(got) == expected
    assert filter_audit.audit(audited[0].limit(0), audited[1]).count() == 0
    assert filter_audit.audit(audited[0], audited[1].limit(0)).agg({"good_lost": "sum", "toxic_lost": "sum"}).first()[0] == 0


def test_audit_of_the_table(spark):
    d = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{d}/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = {tuple(r) for r in queries.op11_filter_audit(spark, d).select(*COLUMNS).collect()}
    assert got == brute(rows, labels)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    assert {tuple(r) for r in con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({queries.OP11_SQL})").fetchall()} == got


def test_orders_differ_by_one_swap():
    for n in range(1, 6):
        order, seen = list(range(n)), {tuple(range(n))}
        for i in filter_audit.transpositions(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            seen.add(tuple(order))
        assert seen == set(permutations(range(n)))
    with pytest.raises(ValueError):
        filter_audit.orders(None, "ABCDEFGHI")
