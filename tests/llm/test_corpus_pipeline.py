import re

import pytest

import corpus_pipeline as P
from souk.llm import byte_cnn, mixing

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def stages(spark, sf):
    """What each stage returns, each written and read again as the driver does."""
    docs, out = P.documents(spark, sf), []
    for name, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), stage(spark, docs, sf).schema)
        out.append((name, docs))
    return out


def test_stages_against_brute_force(spark):
    from tests_llm_helpers import brute_clean, brute_kept
    got = dict(stages(spark, SF))
    docs = P.documents(spark, SF)
    rows = {r["doc_id"]: r for r in docs.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    score = {r["doc_id"]: r["score"] for r in byte_cnn.score(docs, byte_cnn.train(docs, labels)).collect()}
    good = sorted(i for i in rows if score[i] >= 0.5)
    assert sorted(r["doc_id"] for r in got["quality"].collect()) == good
    assert got["quality"].columns == docs.columns
    kept = brute_kept([(i, rows[i]["text"]) for i in good])
    assert sorted(r["doc_id"] for r in got["near_copies"].collect()) == kept
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i: brute_clean(rows[i]["text"], items) for i in kept}
    assert {r["doc_id"]: r["text"] for r in got["benchmark_passages"].collect()} == clean
    after = {r["doc_id"]: r["text"] for r in got["secrets"].collect()}
    assert set(after) == set(kept)
    secret = re.compile(r"[0-9a-f]{16,}|AKIA[A-Z0-9]{14,}")
    assert sum(bool(secret.search(t)) for t in clean.values()) > 0
    assert not any(secret.search(t) for t in after.values())
    assert all(after[i] == clean[i] for i in kept if "[secret]" not in after[i])
    assert all(r["n_chars"] == len(r["text"]) for r in got["secrets"].collect())
    size = {i: len(after[i].encode().split()) for i in after}
    mix = got["mixture"].collect()
    goal = {r["doc_id"]: r for r in mixing.assign(got["secrets"]).collect()}
    taken = {}
    for r in mix:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + size[r["doc_id"]]
        assert r["text"] == after[r["doc_id"]] and 0 <= r["position"] <= 1
    assert taken == {i: g["taken"] for i, g in goal.items() if g["taken"]}
    whole = P.run(spark, SF).collect()
    assert [(r["doc_id"], r["epoch"]) for r in whole] == [(r["doc_id"], r["epoch"]) for r in sorted(mix, key=lambda r: (r["position"], r["doc_id"]))]


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, "", "x", None, 3), (None, None, None, "s", None), (2, "a b", None, "s", None), (2, "a b", None, "s", None)]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 1.5) for r in rows], SCHEMA + ", spans string, position double")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        out.collect()
    got = P.mixture(spark, docs, SF)
    assert set(docs.columns) <= set(got.columns)
    # targets: 2 words of source s, weight by its place; no copy beyond three
    assert all(r["text"] == "a b" for r in got.collect())


def test_run_reads_what_a_stage_has_written(spark):
    out = []
    stage = lambda name, f: lambda spark, d, sf: out.append((name, d.inputFiles())) or f(spark, d, sf)
    old, P.STAGES[:] = P.STAGES[:], [(n, stage(n, f)) for n, f in P.STAGES]
    try:
        P.run(spark, SF)
    finally:
        P.STAGES[:] = old
    names = [n for n, _ in old]
    for (_, files), before in zip(out[1:], names):
        assert files and {f.split("/")[-2] for f in files} == {before}
