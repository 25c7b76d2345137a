"""Randomised parity: translated patterns in Spark vs Python ``re`` (the
collectors' engine) on strings mixing dictionary fragments, accents, digits,
underscores, punctuation and Unicode whitespace."""
import random
import re


from souk.functions.regex import to_java
from souk.operators import extract as X
from souk.rulesets import extraction as D

FRAGMENTS = ["CDI", "cdd", "Stage", "stages", "intérim", "INTERIM", "full-time", "Full time", "fixed term", "intern",
             "Bac", "+", "5", "3", "Master", "master's", "MSc", "bsc", "Licence", "ingénieur", "doctorat", "PhD",
             "ans", "an", "years", "year", "of", "experience", "expérience", "d'", "de", "minimum", "at least",
             "à", "-", "–", "to", "junior", "Senior", "confirmé", "lead", "Fès", "FES", "Salé", "El Jadida",
             "Data Engineer", "ML Engineer", "DevOps", "banque", "télécom", "SaaS", "cloud", "IT services",
             "e-commerce", "oil and gas", "école", "ſ", "İ", "K", "_", "é", "2", "10", "7+"]
SPACES = [" ", "  ", "\t", "\n", " ", " ", "　", "", ",", ".", "/", "(", ")", "'"]


def corpus(n=600, seed=7):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(1, 9)):
            parts.append(rnd.choice(FRAGMENTS))
            parts.append(rnd.choice(SPACES))
        out.append("".join(parts))
    return out


def test_random_strings_match_python(spark):
    rows = corpus()
    df = X.with_folded(spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string"), "t")
    t = X.text("t")
    named = {}
    for label, p in D.CONTRACTS_FR_EN + D.EDUCATION_INDEED + D.EDUCATION_DREAMJOB + D.SECTORS:
        named[f"{label}|{p}"] = p
    for v in D.CITIES + D.FUNCTIONS_DREAMJOB:
        named[v] = rf"\b{re.escape(v)}\b"
    cols = []
    for k, p in named.items():
        cond = X.py_isearch(p)
        cols.append(cond.spark(t.c, t.folded).alias(f"g{len(cols)}"))          # gated, folded path
        cols.append(t.c.rlike(to_java(p, ignore_case=True)).alias(f"p{len(cols)}"))  # plain (?iu) path
        cols.append(cond.spark(t.c, t.folded, t.words).alias(f"w{len(cols)}"))       # from the text's words
    got = df.select("i", *cols).orderBy("i").collect()
    keys = list(named.items())
    for r in got:
        text = rows[r.i]
        for j, (k, p) in enumerate(keys):
            want = re.search(p, text, flags=re.IGNORECASE) is not None
            assert r[1 + 3 * j] == want, (k, text, "gated")
            assert r[2 + 3 * j] == want, (k, text, "plain")
            assert r[3 + 3 * j] == want, (k, text, "words")
    exp = {p: X.experience(t, p) for p in ("dreamjob", "indeed", "linkedin")}
    got = df.select("i", *[c.alias(k) for k, c in exp.items()]).orderBy("i").collect()

    def years(patterns, words, s):
        for pat in patterns:
            m = re.search(pat, s, flags=re.IGNORECASE)
            if m:
                g = [x for x in m.groups() if x]
                return f"{g[0]}-{g[1]} ans" if len(g) == 2 else f"{g[0]} ans"
        for label, pat in words:
            if re.search(pat, s, flags=re.IGNORECASE):
                return label
        return None
    for r in got:
        s = rows[r.i]
        assert r.dreamjob == (years(D.EXPERIENCE_DREAMJOB, D.EXPERIENCE_WORDS_DREAMJOB, s) if s else None), s
        assert r.indeed == (years(D.EXPERIENCE_INDEED, D.EXPERIENCE_WORDS_INDEED, s) if s else None), s
        assert r.linkedin == (years(D.EXPERIENCE_LINKEDIN, [], s) if s else None), s


def _pg_to_python(p: str) -> str:
    """PostgreSQL ARE word anchors for Python's ``re`` (brute-force reference)."""
    return (p.replace(r"\m", r"(?<!\w)(?=\w)").replace(r"\M", r"(?<=\w)(?!\w)").replace(r"\b", "\x08"))


def test_random_strings_skills_match(spark):
    from souk.operators.skills import match_skills, skill_rows
    rows = corpus(400, seed=11)
    extra = ["Apache  Spark", "PowerBI", "power bi", "R&D", "K8s", "sklearn", "Scikit-learn", "GitLab", "a_SQL_b",
             "Amazon Web   Services", "Google Cloud", "ML", "Natural Language", "PostgreSQL", "Hadoop2"]
    rnd = random.Random(3)
    rows = [r + " " + " ".join(rnd.sample(extra, 3)) for r in rows]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    got = {}
    for r in match_skills(df, "t").select("i", "skill_id").collect():
        got.setdefault(r.i, set()).add(r.skill_id)
    for i, text in enumerate(rows):
        want = {sid for sid, _, p, _, _ in skill_rows() if re.search(_pg_to_python(p), text, flags=re.IGNORECASE)}
        assert got.get(i, set()) == want, text
