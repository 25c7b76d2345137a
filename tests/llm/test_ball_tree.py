import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from souk.llm import ball_tree as B
from souk.llm.queries import op11_ball_tree

SF = "/root/testdata/sf0.001"
TERM = re.compile(B.TERM)


def found(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k=10):
    docs = [(i, found(t)) for i, t in rows]
    docs = [(i, w) for i, w in docs if w]
    n, total = len(docs), sum(len(w) for _, w in docs)
    df = {}
    for _, w in docs:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        q = found(text)
        scored = []
        for i, w in docs:
            m = 25 + 75 * len(w) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in q if t in w)
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus(r, n=300):
    words = [f"w{int(r.paretovariate(0.5))}" for _ in range(4000)] + ["É", "日本", "A-b", "naïve", "X1"]
    rows = [(k, " ".join(r.choice(words) for _ in range(r.randrange(1, 60)))) for k in range(n)]
    rows += [(n + k, rows[7][1]) for k in range(90)] + [(None, rows[3][1]), (None, rows[3][1]), (5, rows[7][1]), (1000, None), (1001, ""), (1002, "!? --"), (1003, "w1 " * 5000)]
    items = [(k, rows[r.randrange(n)][1].upper() if k % 2 else " ".join(r.choice(words) for _ in range(12))) for k in range(40)]
    return rows, items + [(None, "w1 w2"), (900, None), (901, "nothing-there"), (902, ""), (3, "w1 w1 w1 w3")]


@pytest.mark.parametrize("piece, block", [(B.PIECE, B.BLOCK), (4000, 300)])
def test_against_brute_force(spark, monkeypatch, piece, block):
    rows, items = corpus(random.Random(11))
    monkeypatch.setattr(B, "PIECE", piece)
    monkeypatch.setattr(B, "BLOCK", block)
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, item_id string, rank int").repartition(3)
    its = spark.createDataFrame([(*x, 1.0) for x in items], "item_id long, text string, score double")
    assert got(B.search(docs, its)) == brute(rows, items)


def test_bounds_hold_and_prune():
    r = random.Random(2)
    topics = [[f"t{t}x{j}" for j in range(60)] for t in range(30)]
    texts = [" ".join(r.choice(topics[k % 30]) for _ in range(40)) for k in range(3000)]
    ids = pa.array(range(3000), pa.int64())
    vocab, ptr, cols, tf, n = B.vectors(pa.array(texts))
    total = int(n.sum())
    vals = B.impacts(ptr, tf, n, 3000, total)
    order, nodes = B.grow(ptr, cols, vals, len(vocab))
    assert sorted(order.tolist()) == list(range(3000))
    for lo, hi, left, right, radius, at, value in nodes:
        centre = np.zeros(len(vocab))
        centre[at] = value
        for row in order[lo:hi][:5]:
            x = np.zeros(len(vocab))
            x[cols[ptr[row]:ptr[row + 1]]] = vals[ptr[row]:ptr[row + 1]]
            assert np.linalg.norm(x - centre) <= radius
        if left >= 0:
            assert (nodes[left][0], nodes[right][1]) == (lo, hi) and nodes[left][1] == nodes[right][0]
    one = B.shard(ids, pa.array(texts), 3000, total)
    block = B.Block([texts[5], texts[17]])
    block.weights = np.full(len(block.terms), 1000)
    opened = []
    best = list(B.best(block, *[one.column(k)[0].values for k in (0, 1)], *[one.column(k)[0].as_py() for k in (2, 3)], 10, opened))
    assert len(best) == 2 and len(opened) < len([x for x in nodes if x[2] < 0])  # of 2 x all leaves


def test_empty_tables_and_string_ids(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    items = spark.createDataFrame([("i", "one two")], "item_id string, text string")
    docs = spark.createDataFrame([("b", "one"), ("a", "one"), ("c", "two two"), (None, "one")], "doc_id string, text string")
    assert got(B.search(none, items)) == [] and got(B.search(docs, items.limit(0))) == []
    assert [(x[1], x[2]) for x in sorted(B.search(docs, items, k=4).collect(), key=lambda x: x[1])] == [(1, "c"), (2, "a"), (3, "b"), (4, None)]


def test_query(spark):
    for t in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE TEMP VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    out = op11_ball_tree(spark, SF)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(out) == sorted(duckdb.sql(B.SQL).fetchall(), key=str)
