import random

import numpy as np
import xxhash

from souk.llm import simhash_pivots as S
from souk.llm.queries import op9_simhash_pivots

SF = "/root/testdata/sf0.001"


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            r = find(k)
            least[r] = min(least.get(r, i), i)
    return sorted(((i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_against_brute_force(spark):
    r = random.Random(3)
    words = [f"w{k}" for k in range(50)]
    base = [r.choice(words) for _ in range(400)]
    rows = [(1, None), (2, ""), (3, "one"), (4, "ONE"), (5, "one two"), (None, "one two"), (None, None), (7, " \t "), (8, "lost"), (8, "lost")]
    for k in range(60):
        w = list(base)
        for _ in range(r.randrange(0, 6)):
            w[r.randrange(400)] = r.choice(words)
        rows.append((100 + k, " ".join(w)))
    rows += [(300 + k, " ".join(r.choice(words) for _ in range(r.randrange(1, 9)))) for k in range(40)]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, component_id string").repartition(3)
    assert got(S.report(S.groups(df))) == brute(rows)
    kept = sorted((x[0], x[1]) for x in S.keep_one(df).collect() if x[0] is not None)
    want = {x[2] for x in brute(rows) if x[2] is not None}
    assert [x[0] for x in kept] == sorted(want)


def test_links_in_one_large_bucket():
    r = np.random.default_rng(1)
    fp = (np.uint64(0xF0F0) << np.uint64(40)) ^ r.integers(0, 1 << 14, 3000, np.int64).astype(np.uint64)
    fp = np.unique(fp)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(fp), np.int32)), pa.array(np.full(len(fp), 5)), pa.array(fp.view(np.int64))], names=["t", "key", "fp"])
    parts = [batch.slice(0, 7), batch.slice(7, 900), batch.slice(907)]
    links = [(a, b) for x in S._links(3, iter(parts)) for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist())]
    assert len(links) < len(fp)
    parent = {int(x): int(x) for x in fp.view(np.int64)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
    for i, j in zip(*np.nonzero(near)):
        assert find(int(fp.view(np.int64)[i])) == find(int(fp.view(np.int64)[j]))


def test_every_pair_meets():
    r = random.Random(9)
    m = [x & (1 << 64) - 1 for x in S.masks(3, 6)]
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for k in r.sample(range(64), 3):
            b ^= 1 << k
        assert any(a & x == b & x for x in m)


def test_chain_of_links(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "a long, b long").repartition(5)
    roots = {r["node"]: r["root"] for r in S.components(links).collect()}
    assert roots == {**{k: 0 for k in range(1, 201)}, 501: 500}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert got(S.report(S.groups(df))) == [] and S.keep_one(df).count() == 0


def test_query(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op9_simhash_pivots(spark, SF)) == brute(rows)


def test_one_row_of_each_group_stays(spark):
    r = random.Random(11)
    say = lambda: " ".join(f"v{r.randrange(10 ** 6)}" for _ in range(300))
    one, other, third, base = say(), say(), say(), say()
    near = base + " more"
    assert 0 < (brute_fp(base) ^ brute_fp(near)).bit_count() <= 3
    # an id with three unrelated texts; a group that has no ids
    rows = [(5, one), (5, other), (5, third), (6, one), (7, other), (None, third), (None, base), (None, near), (None, base)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(x) for x in S.keep_one(df).collect()]
    assert sorted(x for x in kept if x[0] is not None) == sorted([(5, one), (5, other), (5, third)])
    assert len(kept) == 4 and [x[1] in (base, near) for x in kept if x[0] is None] == [True]
