import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from souk.llm import lm_scoring as L
from souk.llm.queries import op3_lm_scoring

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Exact counts, every pair's quantised to 2 ** floor(log2 c): pairs seen once too."""
    docs = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, (t or "").encode().lower().split() + [None]) for i, t in rows]
    c, pairs, s = Counter(), Counter(), Counter()
    for _, held, w in docs:
        if not held:
            c.update(w)
            pairs.update(zip([None] + w[:-1], w))
    n, v = sum(c.values()), len(c)
    q = {k: 2 ** int(math.log2(x)) for k, x in pairs.items()}
    for (h, _), x in q.items():
        s[h] += x
    p1 = lambda x: (c[x] + 1) / (n + v + 1)
    p = lambda h, x: (q.get((h, x), 0) + (c[h] - s[h] + 1) * p1(x)) / (c[h] + 1)
    return [(i, held, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(p1(x)) for x in w),
             sum(math.log10(p(h, x)) for h, x in zip([None] + w[:-1], w))) for i, held, w in docs]


def same(got, want, loose):
    key = lambda x: (str(x[0]), x[2], round(x[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in got], [x[5] for x in want])
    a, b = np.array([x[6] for x in got]), np.array([x[6] for x in want])
    # false positives (about 1 in 1000 probes) only move a pair up: a row of a few hundred tokens has one in 5 to 15 cases of 100
    assert (a - b > -1e-6).all() and (np.abs(a - b) < 1e-6).mean() > 0.8 and abs(a.sum() - b.sum()) < loose * abs(b.sum())


def fixture():
    r = random.Random(6)
    words = [f"W{int(r.expovariate(0.1))}" for _ in range(400)]
    rows = [(k, " ".join(r.choice(words) for _ in range(r.randrange(0, 80)))) for k in range(60)]
    return rows + [(70, None), (71, ""), (None, "w1 w2"), (5, "w1"), (5, "w1"), (72, "Never Seen É"), (73, "w3 " * 5000)]


@pytest.mark.parametrize("limit", [L.BROADCAST_BYTES, 0])
def test_against_exact_counts(spark, limit):
    df = spark.createDataFrame([(*x, "clash") for x in fixture()], "doc_id long, text string, slot string").repartition(3)
    same(L.score(df, L.training_rows(df), broadcast_bytes=limit).collect(), brute(fixture()), 0.005)


def test_filter_gives_levels_back():
    r = np.random.default_rng(0)
    keys, levels = r.integers(0, 1 << 62, 4000).astype(np.uint64), r.integers(1, 9, 4000)
    words = L.build_filter(keys, levels)
    got = L.probe(words, keys, np.uint64(len(words)), 0)
    assert (got >= levels).all() and (got == levels).mean() > 0.995
    other = L.probe(words, r.integers(0, 1 << 62, 4000).astype(np.uint64), np.uint64(len(words)), 0)
    assert (other > 0).mean() < 0.004


def test_no_training_rows_and_empty_table(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    got = L.score(df, F.lit(False)).first()
    assert got["train_tokens"] == 0 and got["n_known"] == 0 and got["base_score"] == 0.0 and got["n_tokens"] == 3
    assert L.score(df.where("false"), F.lit(True)).collect() == []


def test_query(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op3_lm_scoring(spark, SF).collect()
    same(got, brute(rows), 0.005)
    held = [x for x in got if x["held_out"]]
    assert sum(x["score"] for x in held) > sum(x["base_score"] for x in held)


@pytest.mark.parametrize("limit", [L.BROADCAST_BYTES, 0])
def test_pairs_seen_once_count(spark, limit):
    df = spark.createDataFrame(fixture(), "doc_id long, text string").repartition(3)
    same(L.score(df, L.training_rows(df), broadcast_bytes=limit).collect(), brute(fixture()), 0.005)
    rows = [(1, "a b"), (3, "c d"), (4, "a b"), (5, "a d")]  # a b once in training, a d never
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in L.score(df, df.doc_id < 4, broadcast_bytes=limit).collect()}
    assert got[4] > got[5] + 0.1


def test_pieces_and_blocks_change_nothing(monkeypatch):
    import pyarrow as pa
    from souk.llm import kernel as K
    text, offs = K.column_bytes(pa.array([t for _, t in fixture()]))
    ids, first = L.tokens(text, offs)
    keys, levels = L.Vocabulary(ids, 5).pairs()
    words = L.build_filter(keys, levels)
    found = L.probe(words, keys, np.uint64(len(words)), 0)
    monkeypatch.setattr(L, "PIECE", 50)
    monkeypatch.setattr(L, "BLOCK", 7)
    again, at = L.tokens(text, offs)
    assert (again == ids).all() and (at == first).all() and len(first) == len(fixture()) + 1
    k, n = L.Vocabulary(again, 5).pairs()
    assert (k == keys).all() and (n == levels).all() and n.sum() == len(ids) and (np.diff(k.astype(object)) > 0).all()
    assert (L.build_filter(keys, levels) == words).all() and (L.probe(words, keys, np.uint64(len(words)), 0) == found).all()
    empty, zero = L.tokens(text[:0], offs[:1])
    assert len(empty) == 0 and list(zero) == [0]


def test_counting_holds_little_besides_its_results():
    import tracemalloc
    import pyarrow as pa
    r = random.Random(2)
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{r.randrange(50_000)}" for _ in range(2000)) for _ in range(500)])], names=["text"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in L._count(3, iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 3 and peak < 75 * 1_000_000, peak  # bytes a token


def test_filter_stays_packed_and_is_opened_by_shard():
    import tracemalloc
    from collections import defaultdict
    import pyarrow as pa
    from souk.llm import kernel as K
    r, parts = random.Random(4), 16
    texts = pa.array([" ".join(f"w{r.randrange(3000)}" for _ in range(1000)) for _ in range(400)])
    rows = defaultdict(list)
    for b in L._count(parts, iter([pa.RecordBatch.from_arrays([texts], names=["text"])])):
        for x in b.to_pylist():
            rows[x["part"]].append(x)
    models = {p: L._model(pa.Table.from_pylist(x)).to_pylist()[0] for p, x in rows.items()}
    size = sum(m["n_words"] * 8 for m in models.values())
    shards = [models[p]["filter"] for p in range(parts)]
    assert sum(map(len, shards)) < 0.75 * size
    text, offs = K.column_bytes(texts)
    voc = L.Vocabulary(L.tokens(text[:offs[20]], offs[:21])[0], parts)
    sums = np.concatenate([L._unzip(models[p]["sums"])[np.isin(np.frombuffer(models[p]["ids"], "<u8"), voc.ids[a:b])]
                           for p, (a, b) in enumerate(zip(voc.bounds, voc.bounds[1:]))])
    tracemalloc.start()
    found = L._levels(shards, voc, sums)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < size / 2, (peak, size)
    every = L.Vocabulary(L.tokens(text, offs)[0], parts)
    exact = dict(zip(*(x.tolist() for x in every.pairs())))
    place = {w: k for k, w in enumerate(every.ids.tolist())}
    head = np.array([place[w] for w in voc.ids.tolist()], np.uint64)[voc.before] << np.uint64(L.PAIR_BITS)
    key = head | K.pair(voc.ids[voc.before], voc.ids[voc.index]) & L.PAIR_MASK
    want = np.array([exact[k].bit_length() for k in key.tolist()])
    assert (found >= want).all() and (found == want).mean() > 0.99
    none = L._levels([None] * parts, voc, np.zeros_like(sums))
    assert len(none) == len(found) and not none.any()


def test_freed_memory_is_given_back():
    import ctypes
    import re
    from souk.llm.common import give_back
    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("glibc only")
    used = lambda: int(re.search(r"RssAnon:\s+(\d+)", open("/proc/self/status").read())[1]) // 1024
    held = [bytes(bytearray(b"x" * 90_000)) for _ in range(3000)]
    last = held[-1]  # on top of the heap: without a trim nothing below goes
    del held
    before = used()
    give_back()
    assert used() < before - 150 and len(last) == 90_000
