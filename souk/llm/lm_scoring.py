"""Language-model scoring with a log-frequency Bloom filter of n-gram counts.

Method: the training text's word pairs are counted over the whole corpus; a
pair with count c enters a Bloom filter once for each level
1..1 + floor(log2 c), so a count is found again, quantised to 2**(level - 1),
by probing one level after another until a probe fails (a pair seen once has
level 1).  The filter is broadcast to the workers and the probability of a word w after h is

    (q(h,w) + (c(h) - s(h) + 1) * p1(w)) / (c(h) + 1)

with q the quantised count, s(h) the sum of q over all w and p1 the add-one
unigram probability: what quantising takes from the counts goes to the
unigrams, so probabilities sum to one but for false positives of the filter.

Exact word counts c and s are no broadcast data, as vocabularies grow with the
corpus.  Documents are dealt into slots; a slot asks each hash range of words
for the counts of its distinct words, and the answers come back to the slot.
The filter has a shard for each range, sized by the range's pairs; shards stay
compressed, also in the broadcast, and a task opens one at a time.  If all
shards together are over ``broadcast_bytes``, probes travel the same way: the
slot sends its distinct pairs and the range that holds the shard probes it.

Defined results: a null text is empty and has the end token only; a null id
counts as the empty text in the split; equal rows are scored alike and each is
counted; without training rows all probabilities are those of an empty model;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import crc_mod, cut, give_back, partitions, pick, ranges

U = np.uint64
END = U(0x5851F42D4C957F2D)
PAIR_BITS = 40
PAIR_MASK = U((1 << PAIR_BITS) - 1)
#: Bits of the filter for each entry, and bits that an entry sets in its word.
BITS_PER_ENTRY, PROBES = 24, 5
BROADCAST_BYTES = 256 << 20
FLUSH = 16 << 20
#: Bytes of text, and pairs, that are worked on at a time: what a task holds besides its results is some MB.
PIECE, BLOCK = 2 << 20, 1 << 17
#: Bytes of text that are scored in one task, about.
SLOT = 128 << 20


def _zip(a: np.ndarray) -> bytes:
    """An integer array, like bytes together, compressed."""
    a = a.astype("<i8")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unzip(raw: bytes) -> np.ndarray:
    a = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(a.reshape(8, -1).T).view("<i8").ravel()


def _pack(words: np.ndarray) -> bytes:
    """A shard of the filter, compressed: about a fifth of its bits are set, so a third of its bytes go."""
    return zstandard.ZstdCompressor(level=1).compress(words.astype("<u8").tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "<u8")


def _five(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unfive(raw: bytes) -> np.ndarray:
    a = np.zeros((len(raw) // 5, 8), np.uint8)
    a[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return a.view("<u8").ravel().astype(U)


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token identifiers (words, then one end for each row) and the index of each row's first (and the total)."""
    ids, firsts, n = [np.zeros(0, U)], [], 0
    for i, j in K.segments(offs, PIECE):
        part = K.LOWER[raw[offs[i]:offs[j]]]
        starts, stops, first = K.word_bounds(part, offs[i:j + 1] - offs[i], K.BLANK)
        out = np.full(len(starts) + j - i, END, U)
        out[np.arange(len(starts)) + K.rows_of(first)] = K.word_ids(part, starts, stops)
        ids.append(out)
        firsts.append(first[:-1] + np.arange(j - i) + n)
        n += len(out)
    return np.concatenate(ids), np.concatenate([*firsts, [n]]).astype(np.int64)


def blocks(n: int) -> Iterator[slice]:
    return (slice(a, a + BLOCK) for a in range(0, n, BLOCK))


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and their counts; sorts x itself."""
    x.sort()
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    at = np.flatnonzero(new)
    return x[at], np.diff(at, append=len(x))


class Vocabulary:
    """Distinct tokens of some rows, by hash range, and their distinct pairs."""

    def __init__(self, ids: np.ndarray, parts: int):
        by = np.argsort(ids)
        new, ids = np.ones(len(ids), bool), ids[by]
        np.not_equal(ids[1:], ids[:-1], out=new[1:])
        u = ids[new]
        del ids
        part = (u % U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(u), np.int32)  # fewer than 2 ** 31 tokens fit an Arrow array
        place[order] = np.arange(len(u))
        self.ids, self.index = u[order], np.empty(len(by), np.int32)
        self.index[by] = np.repeat(place, np.diff(np.flatnonzero(new), append=len(new)))
        self.bounds = np.searchsorted(part[order], np.arange(parts + 1))
        end = place[np.searchsorted(u, END)] if len(u) else 0
        self.before = self.index.copy()  # every row ends with END
        self.before[:1], self.before[1:] = end, self.index[:-1]

    def keys(self) -> np.ndarray:
        """context << 40 | pair of each token."""
        out = np.empty(len(self.index), U)
        for b in blocks(len(out)):
            out[b] = self.before[b].astype(U) << U(PAIR_BITS) | K.pair(self.ids[self.before[b]], self.ids[self.index[b]]) & PAIR_MASK
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys and their counts; sorted, so by range too."""
        return _distinct(self.keys())


COUNTS = "part int, ids binary, counts binary, n_pairs binary, pairs binary, pair_counts binary"


def _count(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training texts -> counts of each flush's distinct tokens and pairs, a row for each hash range."""
    for batch in batches:
        give_back()
        text, every = K.column_bytes(batch.column(0))
        for i, j in K.segments(every, FLUSH):
            v = Vocabulary(tokens(text[every[i]:every[j]], every[i:j + 1] - every[i])[0], parts)
            n = np.bincount(v.index, minlength=len(v.ids))
            key, kn = v.pairs()
            head = (key >> U(PAIR_BITS)).astype(np.int64)
            per = np.bincount(head, minlength=len(v.ids))
            cut_at = np.searchsorted(head, v.bounds)
            rows = [(p, v.ids[a:b].tobytes(), _zip(n[a:b]), _zip(per[a:b]), _five(key[x:y] & PAIR_MASK), _zip(kn[x:y]))
                    for p, (a, b, x, y) in enumerate(zip(v.bounds, v.bounds[1:], cut_at, cut_at[1:])) if b > a]
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                             names=[x.split()[0] for x in COUNTS.split(", ")])


def _places(keys: np.ndarray, level: int, n_words) -> tuple[np.ndarray, np.ndarray]:
    """Word of the filter, and the bits in it, of each pair's entry at a level."""
    x = K.pair(keys, np.full(len(keys), level, U))
    y, mask = K.mix(x + U(1)), np.zeros(len(keys), U)
    for p in range(PROBES):
        mask |= U(1) << (y >> U(6 * p) & U(63))
    return (x % n_words).astype(np.int64), mask


def build_filter(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The filter's 64-bit words, for pairs with their levels (>= 1): an entry sets PROBES bits of one word."""
    words = np.zeros(max(1, int(levels.sum()) * BITS_PER_ENTRY // 64), U)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for b in blocks(len(keys)):
            at, mask = _places(keys[b][levels[b] >= level], level, U(len(words)))
            np.bitwise_or.at(words, at, mask)
    return words


def probe(words: np.ndarray, keys: np.ndarray, n_words, start) -> np.ndarray:
    """Level of each pair: levels are probed upwards until one is missing."""
    out = np.zeros(len(keys), np.int64)
    n_words, start = np.broadcast_to(n_words, keys.shape), np.broadcast_to(start, keys.shape)
    for b in blocks(len(keys)):
        level, live = 1, np.arange(b.start, min(b.stop, len(keys)))
        while len(live):
            at, mask = _places(keys[live], level, n_words[live])
            live = live[words[start[live] + at] & mask == mask]
            out[live] = level
            level += 1
    return out


MODEL = "part int, n long, v long, ids binary, counts binary, sums binary, filter binary, n_words long"


def _model(table: pa.Table) -> pa.Table:
    """All counts of one hash range -> its words' counts and sums, and its filter shard."""
    give_back()
    rows = table.to_pylist()
    ids = np.concatenate([np.frombuffer(r["ids"], "<u8") for r in rows]).astype(U)
    u, inv = np.unique(ids, return_inverse=True)
    counts = np.bincount(inv, np.concatenate([_unzip(r["counts"]) for r in rows])).astype(np.int64)
    head = np.repeat(inv, np.concatenate([_unzip(r["n_pairs"]) for r in rows]))
    key = head.astype(U) << U(PAIR_BITS) | np.concatenate([_unfive(r["pairs"]) for r in rows])
    n = np.concatenate([_unzip(r["pair_counts"]) for r in rows])
    order = np.argsort(key)
    key, n = key[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    n = np.add.reduceat(n, np.flatnonzero(new)) if len(key) else n
    key = key[new]
    level = np.frexp(n.astype(float))[1].astype(np.int64)  # 1 + floor(log2)
    head = (key >> U(PAIR_BITS)).astype(np.int64)
    sums = np.bincount(head, np.left_shift(1, level - 1), minlength=len(u)).astype(np.int64)
    words = build_filter(K.pair(u[head], key & PAIR_MASK), level)
    return pa.table({"part": pa.array([rows[0]["part"]], pa.int32()), "n": [int(counts.sum())], "v": [len(u)], "ids": pa.array([u.tobytes()], pa.binary()),
                     "counts": pa.array([_zip(counts)], pa.binary()), "sums": pa.array([_zip(sums)], pa.binary()),
                     "filter": pa.array([_pack(words)], pa.binary()), "n_words": [len(words)]})


def train(docs: DataFrame, is_training: Column | None = None, text_col: str = "text") -> DataFrame:
    """The model, a row for each hash range of words; written once."""
    d = docs if is_training is None else docs.where(is_training)
    d = d.select(F.coalesce(d[text_col], F.lit("")).alias("text"))
    return cut(d.mapInArrow(partial(_count, partitions(docs.sparkSession)), COUNTS).groupBy("part").applyInArrow(_model, MODEL))


ASK = "part int, slot int, ids binary, n_pairs binary, pairs binary"
ANSWER = "slot int, part int, counts binary, sums binary, levels binary"


def _ask(parts: int, with_pairs: bool, table: pa.Table) -> pa.Table:
    give_back()
    text, offs = K.column_bytes(table.column("text"))
    v = Vocabulary(tokens(text, offs)[0], parts)
    key = v.pairs()[0] if with_pairs else np.zeros(0, U)
    head = (key >> U(PAIR_BITS)).astype(np.int64)
    per = np.bincount(head, minlength=len(v.ids))
    at = np.searchsorted(head, v.bounds)
    slot = table.column("slot")[0].as_py()
    rows = [(p, slot, v.ids[a:b].tobytes(), _zip(per[a:b]), _five(key[x:y] & PAIR_MASK))
            for p, (a, b, x, y) in enumerate(zip(v.bounds, v.bounds[1:], at, at[1:])) if b > a]
    cols = list(zip(*rows))
    return pa.table({"part": pa.array(cols[0], pa.int32()), "slot": pa.array(cols[1], pa.int32()),
                     **{k: pa.array(c, pa.binary()) for k, c in zip(("ids", "n_pairs", "pairs"), cols[2:])}})


def _answer(asked: pa.Table, model: pa.Table) -> pa.Table:
    give_back()
    known = model.to_pylist()
    ids, counts, sums, words = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), None
    if known:
        m = known[0]
        ids, counts, sums = np.frombuffer(m["ids"], "<u8").astype(U), _unzip(m["counts"]), _unzip(m["sums"])
        words = _unpack(m["filter"]) if m["filter"] else None
    out = []
    for r in asked.to_pylist():
        u = np.frombuffer(r["ids"], "<u8").astype(U)
        at = np.minimum(np.searchsorted(ids, u), max(len(ids) - 1, 0))
        hit = ids[at] == u if len(ids) else np.zeros(len(u), bool)
        c, s = np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
        c[hit], s[hit] = counts[at[hit]], sums[at[hit]]
        pairs = _unfive(r["pairs"])
        level = np.zeros(len(pairs), np.int64)
        if len(pairs) and words is not None:
            level = probe(words, K.pair(np.repeat(u, _unzip(r["n_pairs"])), pairs), U(len(words)), 0)
        out.append((r["slot"], r["part"], _zip(c), _zip(s), _zip(level)))
    cols = list(zip(*out)) if out else [()] * 5
    return pa.table({"slot": pa.array(cols[0], pa.int32()), "part": pa.array(cols[1], pa.int32()),
                     **{k: pa.array(c, pa.binary()) for k, c in zip(("counts", "sums", "levels"), cols[2:])}})


SCORES = "n_tokens long, n_known long, base_score double, score double"


def _levels(shards: list, voc: Vocabulary, sums: np.ndarray) -> np.ndarray:
    """Level of each token's pair, shard by shard: only one is open at a time."""
    out = np.zeros(len(voc.index), np.int8)
    of = np.repeat(np.arange(len(shards), dtype=np.min_scalar_type(len(shards))), np.diff(voc.bounds))
    there = np.flatnonzero(sums[voc.before] > 0)  # other contexts have no pair in the filter
    part = of[voc.before[there]]
    at = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=len(shards)))])
    there = there[np.argsort(part, kind="stable")]
    for shard, a, b in zip(shards, at, at[1:]):
        if a == b:
            continue
        words = _unpack(shard)
        for piece in blocks(b - a):
            t = there[a:b][piece]
            h = voc.ids[voc.before[t]]
            out[t] = probe(words, K.pair(h, K.pair(h, voc.ids[voc.index[t]]) & PAIR_MASK), U(len(words)), 0)
    return out


def _score(parts: int, n: int, v: int, shared, table: pa.Table, answers: pa.Table) -> pa.Table:
    give_back()
    text, offs = K.column_bytes(table.column("text"))
    ids, first = tokens(text, offs)
    voc = Vocabulary(ids, parts)
    del ids, text
    got = sorted(answers.to_pylist(), key=lambda r: r["part"])
    counts, sums = (np.concatenate([_unzip(r[k]) for r in got]) for k in ("counts", "sums"))
    if shared is None:
        levels = np.concatenate([_unzip(r["levels"]) for r in got])[np.unique(voc.keys(), return_inverse=True)[1]]
    else:
        levels = _levels(shared.value, voc, sums)
    known, base, total = np.empty(len(offs) - 1, np.int64), np.empty(len(offs) - 1), np.empty(len(offs) - 1)
    for i, j in K.segments(first, BLOCK):
        word, head = voc.index[first[i]:first[j]], voc.before[first[i]:first[j]]
        c, ch, sh = counts[word].astype(float), counts[head].astype(float), sums[head].astype(float)
        p1 = (c + 1) / (n + 1.0 * (v + 1))
        level = levels[first[i]:first[j]].astype(np.int64)
        q = np.minimum(np.where(level > 0, np.exp2(level - 1), 0.0), sh)
        p = (q + np.maximum(ch - sh + 1, 1) * p1) / (ch + 1)
        at = first[i:j] - first[i]
        known[i:j] = np.add.reduceat((c > 0).astype(np.int64), at)
        base[i:j], total[i:j] = np.add.reduceat(np.log10(p1), at), np.add.reduceat(np.log10(p), at)
    return pa.table({"doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "n_tokens": np.diff(first),
                     "n_known": known, "base_score": base, "score": total})


def score(docs: DataFrame, is_training: Column, broadcast_bytes: int = BROADCAST_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row; the model learns from is_training rows."""
    spark, parts = docs.sparkSession, partitions(docs.sparkSession)
    model = train(docs, is_training, text_col)
    size = model.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v"),
                     F.coalesce(F.sum(F.col("n_words") * 8), F.lit(0)).alias("b")).first()
    shared = None
    if size["b"] <= broadcast_bytes:
        shards = [None] * parts
        for r in model.select("part", "filter").toLocalIterator():
            shards[r["part"]] = bytes(r["filter"])
        shared = spark.sparkContext.broadcast(shards)
    slots = max(3 * parts, ranges(docs, text_col, SLOT))
    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.withColumn("__held", ~is_training)
    d = pick(d, doc_id=id_col, text=text_col, held_out="__held")
    d = d.select("doc_id", "held_out", F.coalesce("text", F.lit("")).alias("text"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int").alias("slot"))
    ask = partial(_ask, parts, shared is None)
    asked = d.groupBy("slot").applyInArrow(lambda t: ask(t), ASK)
    facts = model.select("part", "ids", "counts", "sums", *(["filter"] if shared is None else [F.lit(b"").alias("filter")]))
    answers = asked.groupBy("part").cogroup(facts.groupBy("part")).applyInArrow(_answer, ANSWER)
    run = partial(_score, parts, size["n"], size["v"], shared)
    out = d.groupBy("slot").cogroup(answers.groupBy("slot")).applyInArrow(lambda a, b: run(a, b), f"doc_id {kind}, held_out boolean, {SCORES}")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(size["n"]).cast("long").alias("train_tokens"), "base_score", "score")


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """The split of the query: a seventh of the documents is not trained on."""
    return crc_mod(docs[id_col], 7) != 2
