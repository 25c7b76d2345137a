import random

import numpy as np
import pyarrow as pa

from souk.llm import byte_cnn as B
from souk.llm import kernel as K
from souk.llm import toxicity as T
from souk.llm.queries import op6_toxicity, op8_byte_cnn

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, score string, label string"
LAB = "doc_id long, quality int, toxic int"


def labelled(spark, name):
    want = {r["doc_id"]: r[name] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return want


def test_quality_query_on_held_out_rows(spark):
    want = labelled(spark, "quality")
    got = [r for r in op8_byte_cnn(spark, SF).collect()]
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [(r["predicted"], want[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in want]
    assert len(held) > 90 and np.mean([a == b for a, b in held]) > 0.85


def test_toxicity_query_on_held_out_rows(spark):
    want = labelled(spark, "toxic")
    got = op6_toxicity(spark, SF).collect()
    assert len(got) == 1000
    held = [(r["predicted"], want[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in want]
    assert np.mean([a == b for a, b in held]) > 0.88 and sum(a > b for a, b in held) <= 3


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in B.start_model(rng).items()}
    m["out"] = rng.normal(size=m["out"].shape)
    raw = rng.integers(1, 256, 1500).astype(np.uint8)
    data, first = B.layout(raw, np.array([0, 0, 700, 703, 1500]))
    y = np.array([1.0, 0, 1, 0])
    loss = lambda: -np.sum(y * np.log(B.forward(m, data, first)["p"]) + (1 - y) * np.log(1 - B.forward(m, data, first)["p"])) / 4
    g = B.gradient(m, data, first, y)
    for k in m:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in m[k].shape)
            keep = m[k][at]
            m[k][at] = keep + 1e-5
            up = loss()
            m[k][at] = keep - 1e-5
            down = loss()
            m[k][at] = keep
            assert abs((up - down) / 2e-5 - g[k][at]) < 1e-3 + 0.02 * abs(g[k][at])


def test_long_text_piece_by_piece(monkeypatch):
    rng = np.random.default_rng(1)
    m = B.start_model(rng)
    m["out"] = rng.normal(size=m["out"].shape).astype(np.float32)
    raw = rng.integers(0, 256, 20_000).astype(np.uint8)
    offs = np.array([0, 5, 16_005, 16_005, 20_000])
    whole = B.probabilities(m, raw, offs)
    monkeypatch.setattr(B, "SEGMENT", 1024)
    assert np.allclose(B.probabilities(m, raw, offs), whole, atol=1e-5)
    alone = [B.probabilities(m, raw[a:b], np.array([0, b - a]))[0] for a, b in zip(offs, offs[1:])]
    assert np.allclose(alone, whole, atol=1e-5)


def rows():
    r = random.Random(0)
    say = lambda: " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(r.randrange(5, 60)))
    out, labels = [], []
    for k in range(200):
        bad, rude = k % 4 == 0, k % 5 == 0
        out.append((k, say() + ("###$$$ " * 9 if bad else "") + (" Vile, " if rude else "")))
        labels.append((k, int(not bad), int(rude)))
    return out + [(500, None), (501, ""), (None, "vile"), (3, "again"), (502, "vile " * 30_000)], labels + [(3, 1, 0), (None, 1, 1), (4, None, None), (999, 0, 1), (502, 0, 1)]


def test_odd_rows(spark):
    docs, labels = rows()
    d = spark.createDataFrame([(*x, "clash", "clash") for x in docs], DOC).repartition(3)
    lab = spark.createDataFrame(labels, LAB)
    a = {r["doc_id"]: r["score"] for r in B.score(d, B.train(d, lab)).collect()}
    chain = T.train(d, lab)
    b = {r["doc_id"]: r for r in T.score(d, chain).collect()}
    assert abs(a[500] - a[501]) < 1e-5 and len(a) == len({x[0] for x in docs})
    truth = {k: (q, t) for k, q, t in labels if k is not None and q is not None and k < 200}
    assert np.mean([(a[k] >= 0.5) == q for k, (q, _) in truth.items()]) > 0.95
    assert all((b[k]["p_toxic"] >= 0.5) == t for k, (_, t) in truth.items()) and b[None]["p_toxic"] > 0.5
    kept = B.accept(d, B.train(d, lab))
    assert kept.columns == d.columns and 0 < kept.count() < d.count()


def test_no_labels_and_one_kind(spark):
    d = spark.createDataFrame([(1, "x", "", ""), (2, "y", "", "")], DOC)
    none = spark.createDataFrame([], LAB)
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LAB)
    assert [r["score"] for r in B.score(d, B.train(d, none)).collect()] == [0.5, 0.5]
    assert all(r["score"] > 0.99 for r in B.score(d, B.train(d, one)).collect())
    assert all(r["p_toxic"] < 0.01 for r in T.score(d, T.train(d, none)).collect())
    assert B.score(d.where("false"), B.train(d, one)).collect() == [] and T.score(d.where("false"), T.train(d, one)).collect() == []


def test_out_of_fold_chain():
    # the second category follows from the first, whose words the second link also sees
    r = random.Random(1)
    texts, low = [], []
    for k in range(400):
        y = r.random() < 0.4
        texts.append(" ".join(r.choice("abcdefgh") for _ in range(8)).encode() + (b" junk" if y else b""))
        low.append(float(y))
    chain = T.fit_chain(texts, {"one": np.array(low), "two": np.array(low)})
    assert chain[0].earlier.shape == (0,) and chain[1].earlier.shape == (1,) and chain[1].earlier[0] > 0
    raw, offs = K.column_bytes(pa.array([t.decode() for t in texts]))
    p = T.predict_chain(chain, raw, offs)
    assert ((p[:, 1] > 0.5) == np.array(low, bool)).mean() > 0.97
