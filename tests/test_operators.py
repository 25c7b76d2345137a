"""Unit checks for X6 criteria mapping, X22 keep-first, A8 profile, grain check."""
from pyspark.sql import functions as F

from souk.operators.dedup import keep_first, latest_per_key
from souk.operators.quality import completeness_profile, grain_check
from souk.operators.extract import criteria_field, criteria_value


def test_criteria_mapping_last_pair_wins(spark):
    df = spark.createDataFrame([([("Seniority level", "Entry level"), ("Type d'emploi", " Stage  "),
                                  ("Niveau hiérarchique", "Confirmé"), ("Industries", "Banque"), ("Autre", "x")],)],
                               "c array<struct<h:string,v:string>>")
    m = df.select(criteria_field(F.col("c")).alias("m"))
    r = m.select(*[criteria_value(F.col("m"), f).alias(f) for f in
                   ("experience_level", "contract_type", "function", "sector")]).first()
    assert (r.experience_level, r.contract_type, r.function, r.sector) == ("Confirmé", "Stage", None, "Banque")


def test_keep_first_and_latest(spark):
    cards = spark.createDataFrame([("u1", 1, 0, 5, "b"), ("u1", 0, 2, 9, "a"), ("u2", 2, 0, 0, "c"),
                                   ("u1", 0, 2, 3, "z")], "url string, kw int, page int, pos int, tag string")
    got = {r.url: r.tag for r in keep_first(cards, ["url"], [F.col("kw"), F.col("page"), F.col("pos")]).collect()}
    assert got == {"u1": "z", "u2": "c"}
    import datetime as dt
    rows = spark.createDataFrame([("u", dt.datetime(2026, 1, 1), "old"), ("u", None, "null-ts"),
                                  ("v", dt.datetime(2026, 1, 2), "v2"), ("v", dt.datetime(2026, 1, 3), "v3")],
                                 "url string, ts timestamp_ntz, tag string")
    got = {r.url: r.tag for r in latest_per_key(rows, "url", "ts", ["tag"]).collect()}
    assert got == {"u": "null-ts", "v": "v3"}  # DESC puts NULL first, as PostgreSQL does


def test_profile_and_grain(spark):
    df = spark.createDataFrame([("a", None, "x" * 60, "p"), ("b", "Rabat", "x" * 120, "p"), (None, None, None, "q")],
                               "company string, location string, description string, source string")
    got = {r.source: r for r in completeness_profile(df, "source").collect()}
    p = got["p"]
    assert (p.n_rows, p.n_company, p.n_location, p.n_description_gt_50, p.n_description_gt_100) == (2, 2, 1, 2, 1)
    assert got["q"].n_company == 0
    dup = spark.createDataFrame([("j1",), ("j1",), ("j2",)], "job_id string")
    assert [tuple(r) for r in grain_check(dup, ["job_id"]).collect()] == [("j1", 2)]


def test_dedup_with_a_hot_key_matches_brute_force(spark):
    import random
    rnd = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"u{rnd.randint(0, 400)}", rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "url string, rank int, pos int").repartition(6)
    got = {r.url: (r.rank, r.pos) for r in keep_first(df, ["url"], [F.col("rank"), F.col("pos")]).collect()}
    want = {}
    for url, rank, pos in rows:
        if url not in want or (rank, pos) < want[url]:
            want[url] = (rank, pos)
    assert got == want and got["hot"] == min((r, p) for u, r, p in rows if u == "hot")
