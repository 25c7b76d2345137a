import hashlib
import random
import re

import numpy as np

from souk.llm import fm_decontam as M
from souk.llm.queries import op10_fm_decontam

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())


def brute(rows, items, width=10):
    wins = {}
    for k, t in items:
        w = words(t)
        for a in range(max(1, len(w) - width + 1)) if w else ():
            wins.setdefault(tuple(w[a:a + width]), set()).add(None if k is None else str(k))
    sizes = {len(w) for w in wins}
    out = []
    for i, t in rows:
        w = words(t)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                own = wins.get(tuple(w[a:a + n]))
                if own:
                    found |= own
                    hit[a:a + n] = [True] * n
        out.append((i, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found - {None})).encode()).hexdigest(), any(hit)))
    return sorted(out, key=str)


def fixture():
    r = random.Random(4)
    vocab = ["ab", "Cd", "été", "x1", "of", "the", "zz", "q"]
    say = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    items = [(k, say(r.randrange(11, 30))) for k in range(12)] + [(50, "ab Cd"), (51, None), (52, "..."), (53, "zz, zz zz"), (1, say(15)), (54, "unseen words only here"), (None, "zz zz zz")]
    rows = [(k, say(r.randrange(0, 200)) + ". " + r.choice(items)[1].upper() if r.random() < 0.5 else say(300)) for k in range(30) if True or items]
    return [(i, t) for i, t in rows] + [(90, None), (91, ""), (92, "q"), (None, items[0][1]), (7, items[2][1]), (7, items[2][1]), (93, (items[3][1] + " ") * 200)], items


def run(spark, rows, items, **options):
    d = spark.createDataFrame([(*x, "clash", "clash") for x in rows], "doc_id long, text string, spans string, items string").repartition(3)
    b = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    return d, b, sorted(map(tuple, M.report(M.contamination(d, b, **options)).collect()), key=str)


def test_against_brute_force(spark):
    rows, items = [(i, t) for i, t in fixture()[0]], fixture()[1]
    want = brute(rows, items)
    assert run(spark, rows, items)[2] == want
    assert sum(x[2] for x in want) > 100
    # several blocks of items, small shards
    assert run(spark, rows, items, block_words=40, shard_bytes=200)[2] == want


def test_empty_tables(spark):
    rows, items = fixture()
    assert run(spark, [], items)[2] == []
    for none in ([], [(1, None), (2, "-")]):
        assert run(spark, rows, none)[2] == brute(rows, none)


def test_remove(spark):
    rows = [(1, "Keep this. The QUICK brown fox, jumps! and more"), (2, "nothing here"), (3, None), (4, "")]
    d, b, _ = run(spark, rows, [(9, "the quick brown fox jumps")])
    got = {r["doc_id"]: r["text"] for r in M.remove(d, b).collect()}
    assert got == {1: "Keep this. ! and more", 2: "nothing here", 3: None, 4: ""}
    assert M.remove(d, b).columns == d.columns


def test_index_finds_every_occurrence():
    r = np.random.default_rng(0)
    text = r.integers(1, 4, 300)
    starts = np.array([0, 50, 51, 200])
    index = M.FMIndex.of(text, starts, 4)
    run_of = np.searchsorted(starts, np.arange(300), "right")
    windows = np.array([[0, 1, 2], [1, 1, 1], [3, 2, 1], [0, 0, 3]])
    lengths = np.array([2, 3, 3, 1])
    lo, hi = index.search(windows, lengths)
    for k, n in enumerate(lengths):
        w = windows[k, 3 - n:]
        want = [p for p in range(300 - n + 1) if (text[p:p + n] == w).all() and run_of[p] == run_of[p + n - 1]]
        assert sorted(index.locate(np.arange(lo[k], hi[k])).tolist()) == want


def test_index_survives_writing():
    """An index read back finds what the one in memory does; documents may be empty, equal, or one long repetition."""
    texts = [b"", b"a b c " * 500, b"a b c " * 500, b"...", b"c a b", b""]
    raw, offs = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    shard = M.Shard.of(raw, offs)
    again = M.Shard.from_bytes(shard.to_bytes())
    block = M.make_block([("x", "b c a"), ("y", "b q"), ("z", "c")], 3)
    for got in (M.occurrences(shard, block), M.occurrences(again, block)):
        rows, counts = np.unique(got[0], return_counts=True)
        assert dict(zip(rows.tolist(), counts.tolist())) == {1: 499 + 500, 2: 499 + 500, 4: 1}
    empty = M.Shard.from_bytes(M.Shard.of(raw[:0], np.zeros(3, np.int64)).to_bytes())
    assert len(M.occurrences(empty, block)[0]) == 0


def test_suffix_order():
    r = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        text = np.append(r.integers(1, 3, n), 0)
        assert M.suffix_order(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())


def test_block_has_a_bound():
    """A block at its bound of words takes less than 200 MB on the driver."""
    import tracemalloc
    r = np.random.default_rng(2)
    per = 200
    items = [(str(k), " ".join(map(str, r.integers(0, 30000, per)))) for k in range(M.BLOCK_WORDS // per)]
    tracemalloc.start()
    block = M.make_block(items, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(block.windows) > 400_000 and peak < 200e6


def test_query(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(x) for x in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, op10_fm_decontam(spark, SF).collect()), key=str) == brute(rows, items)


def test_equal_rows_in_several_blocks(spark):
    """Copies of one row send their hits once a block, whatever their number."""
    from souk.llm import fm_decontam as D
    words = [f"w{k}" for k in range(40)]
    text = " ".join(words)
    docs = spark.createDataFrame([(1, text)] * 10000 + [(2, "nothing here")], "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(10, " ".join(words[:12])), (11, " ".join(words[20:33]))], "item_id long, text string")
    got = D.report(D.contamination(docs, items, block_words=12)).groupBy("doc_id", "n_words", "n_hit", "n_items").count().collect()
    assert sorted(map(tuple, got)) == [(1, 40, 25, 2, 10000), (2, 2, 0, 0, 1)]
