"""Secret scans with an incremental blob ledger.

Method: every version of every path is addressed by the SHA-256 of its
content.  The ledger has one entry for each blob, rule and rule version that
was ever scanned.  A run scans each unseen pair once, however many paths hold
the blob, and joins the findings back to all paths.  DataFrame functions only.

A rule's matches are leftmost and don't overlap.  Positions are code points:
the lengths of the text between matches and of the matches, added up.

Defined results: a null text is the empty blob; equal rows and copies share a
ledger entry and each gets the findings; an entry of another rule version is
not used; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import cut

SPANS = "array<struct<start:int,end:int>>"
ENTRIES = f"array<struct<rule:string,version:int,spans:{SPANS}>>"


@dataclass(frozen=True)
class Rule:
    name: str
    version: int
    pattern: str
    #: the group whose length counts (0: the whole match), and its least length
    group: int = 0
    least: int = 1
    #: for blocks: the pattern finds opening and closing marks, and this what an opening mark without a closing one takes with it
    tail: str | None = None


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE = (
    Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),  # runs of 16 or more: what is left of [0-9a-f]+
)
#: A block goes from an opening mark through the next mark, if that is a closing one.
_OPENS, _CLOSES = "-----BEGIN", "-----END"
_MARK = f"(?:{_OPENS}|{_CLOSES}) [A-Z ]*PRIVATE KEY-----"
#: Else the key is what follows up to the next mark: its fields, base64 with blanks between up to the last word of
#: 40 or more letters, and then the lines that are base64 as a whole.  Only character classes repeat: no count bounds
#: them and a matcher doesn't recurse.
_B, _NL = "A-Za-z0-9+/", r"(?:\n|\\n)"
_FIELDS = r"(?:[ \t\r\n\\]*n?(?:Proc-Type|DEK-Info):[^\n\\]*){0,2}"
_LINES = rf"[{_B}=\t\r\n]*[{_B}=][ \t\r]*(?:\n|\z)"
_TAIL = rf"^{_FIELDS}(?:[{_B}=\\ \t\r\n]*[{_B}]{{40,}}=*(?:[ \t\r]*{_NL})?(?:{_LINES})?|[ \t\r]*{_NL}{_LINES})?"
#: Added to the base rules by this operator: blocks of key material.
MORE = (Rule("pem", 3, _MARK, tail=_TAIL),)
RULES = BASE + MORE


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(text: Column, rule: Rule) -> Column:
    """Spans of the blocks between a rule's marks."""
    def block(marks, m, i):
        after = F.get(marks, i + 1)
        closed = F.substring(text, after["start"] + 1, len(_CLOSES)) == _CLOSES
        rest = F.substring(text, m["end"] + 1, F.coalesce(after["start"], F.length(text)) - m["end"])
        end = F.when(F.coalesce(closed, F.lit(False)), after["end"]).otherwise(m["end"] + F.length(F.regexp_extract(rest, rule.tail, 0)))
        opens = F.substring(text, m["start"] + 1, len(_OPENS)) == _OPENS
        return F.struct(m["start"].alias("start"), F.when(opens, end).alias("end"))

    whole = _let(find(text, Rule(rule.name, rule.version, rule.pattern)), lambda marks: F.transform(marks, lambda m, i: block(marks, m, i)))
    return F.filter(whole, lambda b: b["end"].isNotNull()).cast(SPANS)


def find(text: Column, rule: Rule) -> Column:
    """Spans of the rule's matches in text, in order."""
    if rule.tail:
        return _blocks(text, rule)
    none = F.array().cast(SPANS)

    def locate(m):
        parts = F.struct(m.alias("m"), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("v"), F.split(text, rule.pattern, -1).alias("s"))
        return _let(parts, lambda p: F.aggregate(
            F.sequence(F.lit(0), F.size(p["m"]) - 1), F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda a, i: _step(a, F.get(p["s"], i), F.get(p["m"], i), F.get(p["v"], i)), lambda a: a["out"]))

    def _step(a, between, match, value):
        start = a["at"] + F.length(between)
        end = start + F.length(match)
        one = F.array(F.struct(start.alias("start"), end.alias("end"))).cast(SPANS)
        return F.struct(end.alias("at"), F.when(F.length(value) >= rule.least, F.concat(a["out"], one)).otherwise(a["out"]).alias("out")).cast(f"struct<at:int,out:{SPANS}>")

    return _let(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda m: F.when(F.size(m) == 0, none).otherwise(locate(m)))


#: A blob with over a HOT_PARTS-th of all paths is hot: there are fewer than HOT_PARTS of them.
HOT_PARTS = 1000


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _entry(rule: Rule, spans: Column) -> Column:
    return F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"), spans.cast(SPANS).alias("spans"))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules=RULES, text_col: str = "text") -> DataFrame:
    """blob, paths (how many rows have it), entries: an entry for each rule, taken from the ledger (blob, rule, version, spans) or scanned now.

    With a ledger, addresses are looked up first, without their texts; only
    blobs that lack an entry of a rule's present version fetch theirs, by a
    semi-join on the addresses wanted (where those are few, Spark's run-time
    filter keeps the other texts out of its shuffle), and are searched for the
    rules they lack.
    """
    rows = docs.select(address(docs[text_col]).alias("blob"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    if ledger is None:
        blobs = rows.groupBy("blob").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("paths"))
        return blobs.select("blob", "paths", F.array(*[_entry(r, find(F.col("text"), r)) for r in rules]).cast(ENTRIES).alias("entries"))
    present = F.lit(False)
    for r in rules:
        present = present | ((F.col("rule") == r.name) & (F.col("version") == r.version))
    known = ledger.where(present).groupBy(F.col("blob").alias("__blob")).agg(F.collect_list(F.struct("rule", "version", "spans")).alias("known"))
    paths = rows.groupBy("blob").agg(F.count(F.lit(1)).alias("paths"))
    asked = paths.join(known, paths.blob == known["__blob"], "left").select("blob", "paths", F.coalesce("known", F.array().cast(ENTRIES)).alias("known"))
    lack = F.lit(False)
    for r in rules:
        lack = lack | (F.size(_known(r)) == 0)
    asked = cut(asked.withColumn("lack", lack))
    unseen = asked.where("lack").select(F.col("blob").alias("__blob"))
    texts = rows.join(unseen, rows.blob == F.col("__blob"), "left_semi").groupBy(F.col("blob").alias("__blob")).agg(F.first("text").alias("text"))
    fresh = asked.join(texts, asked.blob == texts["__blob"]).select("blob", "paths", F.array(
        *[_entry(r, F.when(F.size(_known(r)) > 0, F.get(_known(r), F.lit(0))["spans"]).otherwise(find(F.col("text"), r))) for r in rules]).cast(ENTRIES).alias("entries"))
    old = asked.where(~F.col("lack")).select("blob", "paths", F.array(*[_entry(r, F.get(_known(r), F.lit(0))["spans"]) for r in rules]).cast(ENTRIES).alias("entries"))
    return fresh.unionByName(old)


def join_back(rows: DataFrame, blob: str, found: DataFrame, name: str) -> DataFrame:
    """rows with column ``name`` of found (blob, paths, name) added by content address; found is a written table.

    The few hot blobs' findings are broadcast (fewer than HOT_PARTS rows), the
    rows that got theirs are spread out by all their columns, and the others
    meet the rest of the findings by blob, where no blob has many paths.
    """
    total = found.agg(F.coalesce(F.sum("paths"), F.lit(0)).alias("n")).first()["n"]
    hot = found.where(F.col("paths") * HOT_PARTS > total).where(F.col("paths") > 1)
    cold = found.where((F.col("paths") * HOT_PARTS <= total) | (F.col("paths") <= 1))
    hot = hot.select(F.col("blob").alias("__hot"), F.col(name).alias("__of_hot"))
    cold = cold.select(F.col("blob").alias("__cold"), F.col(name).alias("__of_cold"))
    d = rows.join(F.broadcast(hot), rows[blob] == hot["__hot"], "left")
    d = d.withColumn("__key", F.when(F.col("__hot").isNull(), F.col(blob)).otherwise(F.concat(F.lit("-"), F.xxhash64(*rows.columns).cast("string"))))
    d = d.join(cold, d["__key"] == cold["__cold"], "left")
    return d.select(*rows.columns, F.coalesce("__of_hot", "__of_cold").alias(name))


def as_ledger(scanned: DataFrame) -> DataFrame:
    """Rows to append to the ledger: blob, rule, version, spans."""
    return scanned.select("blob", F.inline("entries"))


def findings(docs: DataFrame, ledger: DataFrame | None = None, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, blob, entries of every row."""
    paths = docs.select(docs[id_col].alias("doc_id"), address(docs[text_col]).alias("blob"))
    return join_back(paths, "blob", cut(scan(docs, ledger, rules, text_col)), "entries")


def _of(rule: Rule) -> Column:
    """The rule's spans, from entries."""
    return F.get(F.filter("entries", lambda e: e["rule"] == rule.name), F.lit(0))["spans"]


def _known(rule: Rule) -> Column:
    return F.filter("known", lambda e: (e["rule"] == rule.name) & (e["version"] == rule.version))


def _placed(k: int, rule: Rule) -> Column:
    return F.transform(_of(rule), lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), F.lit(rule.name).alias("kind")))


def _spans(rules) -> Column:
    """All spans of the rules by start, then by the rules' order: kind:start:end, comma-joined."""
    lists = [_placed(k, r) for k, r in enumerate(rules)]
    return F.array_join(F.transform(F.sort_array(F.concat(*lists)), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts and digest of findings()."""
    n = [F.size(_of(r)).cast("long").alias(f"n_{r.name}") for r in BASE]
    return found.select("doc_id", *n, F.sha2(_spans(BASE), 256).alias("base_sha256"), _spans(RULES).alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]", rules=RULES, text_col: str = "text") -> DataFrame:
    """docs with every found span replaced by ``mark``; overlapping spans become one.  A null text stays null."""
    found = scan(docs, rules=rules, text_col=text_col).select("blob", "paths", F.flatten(F.transform("entries", lambda e: e["spans"])).alias("__spans"))
    found = cut(found.where(F.size("__spans") > 0))
    d = join_back(docs.withColumn("__blob", address(docs[text_col])), "__blob", found, "__spans")
    text = d[text_col]
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, s):
        before = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        fresh = F.struct(s["end"].alias("at"), F.concat(a["out"], before, F.lit(mark)).alias("out"))
        longer = F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))
        return F.when((s["start"] >= a["at"]) | (a["at"] == 0), fresh).otherwise(longer)

    new = F.aggregate(F.sort_array("__spans"), start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return d.withColumn(text_col, F.when(F.col("__spans").isNull() | text.isNull(), text).otherwise(new)).drop("__blob", "__spans")


_P = {"assign": BASE[0].pattern.replace("'", "''"), "access": BASE[1].pattern, "hex": BASE[2].pattern}


def _sql_kind(k: int, name: str, group: int, least: int) -> str:
    p = _P[name]
    return f"""select rid, {k} k, '{name}' kind, unnest(list_zip(regexp_extract_all(text, '{p}'), regexp_extract_all(text, '{p}', {group}),
        string_split_regex(text, '{p}')[1:len(regexp_extract_all(text, '{p}'))])) z, unnest(range(1, len(regexp_extract_all(text, '{p}')) + 1)) i, {least} least from t"""


SQL = f"""
with t as (select row_number() over () rid, doc_id, coalesce(text, '') as text from documents),
m as ({" union all ".join(_sql_kind(k, n, g, x) for k, (n, g, x) in enumerate((("assign", 2, 12), ("access", 0, 18), ("hex", 0, 16))))}),
mark as (select rid, text, unnest(list_zip(regexp_extract_all(text, '{_MARK}'), string_split_regex(text, '{_MARK}')[1:len(regexp_extract_all(text, '{_MARK}'))])) z,
    unnest(range(1, len(regexp_extract_all(text, '{_MARK}')) + 1)) i from t),
placed as (select rid, text, z[1] mark, cast(sum(length(z[1]) + length(z[2])) over (partition by rid order by i rows unbounded preceding) as bigint) en from mark),
follow as (select *, lead(mark) over w nm, lead(en) over w ne from placed window w as (partition by rid order by en)),
pem as (select rid, 3 k, 'pem' kind, en - length(mark) st, case when nm like '{_CLOSES}%' then ne
    else en + length(regexp_extract(substr(text, en + 1, coalesce(ne - length(nm), length(text)) - en), '{_TAIL}')) end en from follow where mark like '{_OPENS}%'),
p as (select *, sum(length(z[1]) + length(z[3])) over (partition by rid, k order by i rows unbounded preceding) as e from m),
s as (select rid, k, kind, cast(e - length(z[1]) as bigint) st, cast(e as bigint) en from p where length(z[2]) >= least
    union all select rid, k, kind, st, en from pem),
a as (select rid, count(*) filter (k = 0) n0, count(*) filter (k = 1) n1, count(*) filter (k = 2) n2,
    string_agg(kind || ':' || st || ':' || en, ',' order by st, k) filter (k < 3) b, string_agg(kind || ':' || st || ':' || en, ',' order by st, k) al from s group by rid)
select doc_id, coalesce(n0, 0) n_assign, coalesce(n1, 0) n_access, coalesce(n2, 0) n_hex, sha256(coalesce(b, '')) base_sha256, coalesce(al, '') spans
from t left join a using (rid)
"""
