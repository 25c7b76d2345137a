"""Quality rules with host-level verdicts.

Method: every document is measured against simple rules; failures are summed
by host (the ``source`` of a document); a host's failure rates are shrunk by
a beta prior that is fitted to all hosts by its moments; hosts whose shrunk
rate of some rule is over ``limit`` are rejected, and the verdicts are joined
back to the documents.  DataFrame functions only.  Sums are combined before
the shuffle and a verdict is one narrow row a host, so a host may hold any
part of the documents.

Defined results: a null text has no words; null is a host like any other; a
host with one document gets close to the prior's mean; equal rows are
separate documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import WORD, cut

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PCT = 20, 30
#: Further rules that count for hosts only: symbols and repeated lines, in per cent of words.
MAX_SYMBOL_PCT, MAX_DUP_LINE_PCT = 30, 10
LIMIT = 0.5


def _let(value: Column, body) -> Column:
    """body(value) with value computed once, also where lambdas in body use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Number of words inside windows of ``width`` words that the text has twice or more."""
    def windows(h):
        last = F.size(h) - width
        at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))

    def covered(w):
        pairs = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def same(s, e, i):
            return ((i > 0) & (F.get(s, i - 1)["x"] == e["x"])) | ((i < F.size(s) - 1) & (F.get(s, i + 1)["x"] == e["x"]))

        starts = _let(pairs, lambda s: F.sort_array(F.transform(F.filter(s, lambda e, i: F.coalesce(same(s, e, i), F.lit(False))), lambda e: e["i"])))
        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(starts, start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(width), p - a["last"])).alias("n")), lambda a: a["n"])

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(_let(hashes, windows), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host and counts of each row."""
    text = F.coalesce(docs[text_col], F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(F.translate(x, "\t\x0b\x0c\r", "    "))) > 0)

    def counts(w):
        return F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeated_words(w).alias("n_repeat_words"))

    def dup(ls):
        return F.size(ls) - F.size(F.array_distinct(ls))

    d = docs.select(docs[id_col].alias("doc_id"), docs[host_col].alias("host"), _let(words, counts).alias("c"),
                    F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"), _let(lines, dup).alias("n_dup_lines"))
    # cut here: the host sums and the join back both read these few bytes a document instead of the texts
    d = cut(d.select("doc_id", "host", "c.*", "n_symbols", "n_dup_lines"))
    longs = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return d.select("doc_id", "host", *longs)


def failures(m: DataFrame) -> dict[str, Column]:
    """The rules, as columns of measures()."""
    return {
        "short": m.n_words < MIN_WORDS,
        "repeats": 100 * m.n_repeat_words > MAX_REPEAT_PCT * m.n_words,
        "symbols": 100 * m.n_symbols > MAX_SYMBOL_PCT * m.n_words,
        "lines": 100 * m.n_dup_lines > MAX_DUP_LINE_PCT * m.n_words,
    }


def host_verdicts(m: DataFrame, limit: float = LIMIT) -> DataFrame:
    """host, n, rejected and the shrunk rate of each rule."""
    rules = failures(m)
    hosts = m.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("long")).alias(k) for k, c in rules.items()])
    # a few totals over the hosts' rows, as numbers: no host's row meets another's
    total = hosts.agg(F.sum("n").alias("n"), *[(F.sum(k) / F.sum("n")).alias(k) for k in rules]).first()
    mean = {k: total[k] or 0.0 for k in rules}
    spread = hosts.agg(*[(F.sum(F.col("n") * F.pow(F.col(k) / F.col("n") - F.lit(mean[k]), 2)) / F.sum("n")).alias(k) for k in rules]).first()
    out = hosts
    for k in rules:
        everyone, var = float(total["n"] or 0), spread[k] or 0.0
        # moments of a beta distribution; hosts that don't differ give the strongest prior, all documents
        weight = max(min(mean[k] * (1 - mean[k]) / var - 1, everyone), 1.0) if var > 0 else everyone
        out = out.withColumn(f"{k}_rate", (F.col(k) + F.lit(mean[k] * weight)) / (F.col("n") + F.lit(weight)))
    bad = None
    for k in rules:
        bad = F.col(f"{k}_rate") > limit if bad is None else bad | (F.col(f"{k}_rate") > limit)
    return out.select("host", "n", *[f"{k}_rate" for k in rules], bad.alias("rejected"))


def judge(docs: DataFrame, limit: float = LIMIT, **columns) -> DataFrame:
    """Counts, base_failed, host_rejected and kept of each document."""
    m = measures(docs, **columns)
    rules = failures(m)
    v = host_verdicts(m, limit).select(F.col("host").alias("h"), F.col("rejected").alias("host_rejected"))
    d = m.withColumn("base_failed", rules["short"] | rules["repeats"])
    d = d.join(v, d.host.eqNullSafe(v.h), "left")
    return d.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rejected", "kept")


SQL = r"""
with t as (select row_number() over () rid, doc_id, source, coalesce(text, '') text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] ls from documents),
p as (select rid, unnest(w) x, unnest(range(len(w))) i from t),
l8 as (select rid, i, concat_ws(' ', x, lead(x, 1) over o, lead(x, 2) over o, lead(x, 3) over o, lead(x, 4) over o, lead(x, 5) over o, lead(x, 6) over o, lead(x, 7) over o) g,
    lead(x, 7) over o last from p window o as (partition by rid order by i)),
g as (select rid, i, count(*) over (partition by rid, g) c from l8 where last is not null),
cov as (select rid, count(distinct i + k) n from g, (select unnest(range(0, 8)) k) where c > 1 group by rid),
m as (select t.rid, doc_id, source, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) n_symbols, cast(len(ls) - len(list_distinct(ls)) as bigint) n_dup_lines,
    cast(coalesce(cov.n, 0) as bigint) n_repeat_words from t left join cov using (rid)),
f as (select *, cast(n_words < 20 as integer) f1, cast(100 * n_repeat_words > 30 * n_words as integer) f2,
    cast(100 * n_symbols > 30 * n_words as integer) f3, cast(100 * n_dup_lines > 10 * n_words as integer) f4 from m),
l as (select source, r.k, r.f from f, unnest([{k: 1, f: f1}, {k: 2, f: f2}, {k: 3, f: f3}, {k: 4, f: f4}]) u(r)),
h as (select source, k, count(*) n, sum(f) s from l group by 1, 2),
a as (select k, sum(n) n_all, sum(s) / sum(n) mean from h group by k),
v as (select k, any_value(n_all) n_all, any_value(mean) mean, sum(n * pow(s / n - mean, 2)) / sum(n) var from h join a using (k) group by k),
c as (select k, mean, case when var > 0 then greatest(least(mean * (1 - mean) / var - 1, n_all), 1.0) else n_all end weight from v),
bad as (select source, bool_or((s + mean * weight) / (n + weight) > 0.5) rejected from h join c using (k) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 + f2 > 0 base_failed, rejected host_rejected,
    not (f1 + f2 > 0) and not rejected kept from f join bad on f.source is not distinct from bad.source
"""
