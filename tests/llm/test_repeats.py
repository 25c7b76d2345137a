import hashlib
import random

import pytest

from souk.llm import runs, suffix_dedup, window_dedup
from souk.llm.queries import op2_suffix_dedup, op5_window_dedup

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, spans string, kept string"


def sha(b):
    return hashlib.sha256(b).hexdigest()


def brute_bytes(rows, n):
    rows = [(i if i is not None else 1 << 70, (t or "").encode(), i) for i, t in rows]
    first = {}
    for i, b, _ in rows:
        for p in range(len(b) - n + 1):
            s = b[p:p + n]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b, real in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first[b[p:p + n]] < i:
                gone[p:p + n] = b"\1" * n
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((real, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out, key=str)


def brute_words(rows, n):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    count = {}
    for _, w in docs:
        for p in range(len(w) - n + 1):
            k = tuple(w[p:p + n])
            count[k] = count.get(k, 0) + 1
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for p in range(len(w) - n + 1):
            if count[tuple(w[p:p + n])] > 1:
                gone[p:p + n] = [True] * n
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def fixture():
    r = random.Random(5)
    vocab = ["alpha", "beta", "gamma", "dé", "x", "of", "the", "long-winded", "zwölf"]
    say = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    shared, other = say(90), say(60)
    rows = [(k, say(r.randrange(0, 60)) + " " + r.choice([shared, other, shared[20:300], ""]) + "\t" + say(r.randrange(0, 40))) for k in range(40)]
    rows += [(50, None), (51, ""), (52, "short"), (53, rows[3][1]), (54, rows[3][1]), (55, "a" * 400), (56, "b " * 300), (57, "a" * 60 + "c"),
             (7, rows[7][1]), (7, shared), (None, shared), (None, shared), (58, shared + " " + shared), (59, " \t\n "), (60, say(3000) + shared + say(3000))]
    return rows


def both(spark, rows):
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], DOC).repartition(3)
    a = sorted(map(tuple, suffix_dedup.report(suffix_dedup.remove_repeats(df)).collect()), key=str)
    b = sorted(map(tuple, window_dedup.report(window_dedup.remove_repeats(df)).collect()), key=str)
    return a, b


def test_against_brute_force(spark):
    rows = fixture()
    a, b = both(spark, rows)
    assert a == brute_bytes(rows, 50)
    assert b == brute_words(rows, 35)
    assert sum(x[2] for x in a) > 1000 and sum(x[2] for x in b) > 300


def test_frequent_grams_are_dealt_out_by_window(spark, monkeypatch):
    r = random.Random(8)
    common = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(k, " ".join(r.choice("abcdefghij") * r.randrange(1, 9) for _ in range(30)) + " " + common + " " + " ".join(r.choice("klm") * 3 for _ in range(30))) for k in range(120)]
    rows += [(200 + k, rows[k][1][40:]) for k in range(0, 120, 7)]
    a, b = both(spark, rows)
    assert a == brute_bytes(rows, 50)
    assert b == brute_words(rows, 35)
    assert runs.HEAVY_CONTENTS < 40


def test_empty_table(spark):
    a, b = both(spark, [])
    assert a == [] and b == []


def test_queries_against_brute_force(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op2_suffix_dedup(spark, SF).collect()), key=str) == brute_bytes(rows, 50)
    assert sorted(map(tuple, op5_window_dedup(spark, SF).collect()), key=str) == brute_words(rows, 35)
    with pytest.raises(ValueError):
        suffix_dedup.task(8)


def test_long_texts_cross_segments(spark, monkeypatch):
    monkeypatch.setattr(runs, "SEGMENT", 64)
    monkeypatch.setattr(runs.K, "POS_BITS", 8)
    monkeypatch.setattr(runs.K, "POS_MASK", runs.K.U64(255))
    import numpy as np
    r = random.Random(2)
    text = "".join(r.choice("ab ") for _ in range(2000)).encode()
    raw = np.frombuffer(text, np.uint8)
    starts = []
    for row, lo, cnt, *_ in runs.runs_of(suffix_dedup.task(50), raw, np.array([0, len(raw)])):
        assert (row == 0).all()
        starts += [x for a, c in zip(lo.tolist(), cnt.tolist()) for x in range(a, a + c)]
    assert starts == list(range(len(raw) - 49))


@pytest.mark.parametrize("length", [20, 32, 50, 77])
def test_refined_buckets_are_equal_strings(length):
    import numpy as np
    r = random.Random(length)
    text = b"".join(r.choice([b"a" * 70, b"ab", b"abcabcabc" * 9, bytes([r.randrange(256)])]) for _ in range(300))
    units, starts = np.frombuffer(text, np.uint8), np.arange(len(text) - length + 1)
    got = suffix_dedup.refined(length, units, starts)
    strings = [text[p:p + length] for p in starts]
    places = {}
    for s, k in zip(strings, got.tolist()):
        assert places.setdefault(s, k) == k
    assert len(set(places.values())) == len(places)
    # pointers are places in sorted order
    assert [s for _, s in sorted((k, s) for s, k in places.items())] == sorted(places)


def colliding(spark):
    """Two texts of different sizes with one 32-bit hash, and no repeated window."""
    from pyspark.sql import functions as F
    words = F.regexp_replace(F.sha2(F.col("id").cast("string"), 512), "(..)", "$1 ")
    pool = spark.range(400000).select(words.substr(F.lit(1), (F.lit(130) + F.col("id") % 50).cast("int")).alias("text"))
    pool = pool.select("text", F.hash("text").alias("h"))
    pairs = pool.groupBy("h").agg(F.collect_list("text").alias("texts")).where("size(texts) > 1 and length(texts[0]) != length(texts[1])")
    return sorted(pairs.orderBy("h").first()["texts"], key=len)


def test_rows_of_one_id_whose_texts_hash_alike(spark):
    short, long = colliding(spark)
    rows = [(None, short), (None, long), (1, long), (2, long)]
    a, b = both(spark, rows)
    assert a == brute_bytes(rows, 50)
    assert b == brute_words(rows, 35)


@pytest.mark.parametrize("task", [suffix_dedup.task(50), window_dedup.task(35)])
def test_equal_rows_do_not_multiply_what_is_found(spark, task):
    from pyspark.sql import functions as F
    r = random.Random(4)
    text = " ".join(f"w{r.randrange(10 ** 6)}" for _ in range(200))
    most = []
    for copies in (3, 60):
        docs = spark.createDataFrame([(None, text)] * copies + [(1, text)], "doc_id long, text string").repartition(3)
        most.append(runs.covered_windows(docs, task).agg(F.max(F.size("found"))).first()[0])
    assert most[1] <= 2 * most[0]
