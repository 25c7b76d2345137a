"""Benchmark decontamination with an FM-index of each training shard.

Method: a shard (rows of one Arrow batch, about ``shard_bytes`` of text) is a
sequence of word symbols over its own vocabulary.  Its suffix array comes from
prefix doubling, its Burrows-Wheeler transform goes into a wavelet matrix of
packed bits, and suffix positions are kept for the first word of a document
and every ``SAMPLE``-th one.  The index knows nothing of the test items:
``index_shards`` makes one row a shard, and any block of items searches it.
Every window is sought by backward search, all windows of a block at once (one
rank a word on each end of the interval); occurrences are located by walking
back to sampled positions, and the words they cover merge into spans.

Test items are broadcast in blocks of at most ``block_words`` words (or one
longer item).  Several blocks search one written copy of the indexes, so texts
are read and sorted once whatever the number of items; the blocks' findings
are merged by document.

Defined results: null texts have no words; an item of fewer words than a
window is one window, of none nothing; equal item ids are one item; a null
item id counts as an item without a name (a null in ``items``, counted, not
in the digest); equal documents get equal rows; an empty table of either kind
gives no hits; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import cut, pick

WINDOW = 10
BLOCK_WORDS = 500_000
SAMPLE = 8
#: Bytes of text in a shard (or one longer document); making its index takes some 20 times that.
SHARD = 4 << 20
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Bits:
    """Bit sequence in 64-bit words: rank(i) is the number of ones before i."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def of(cls, bits: np.ndarray) -> Bits:
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[:len(some)] = some
        return cls(packed.view("<u8"))

    def rank(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class Wavelet:
    """Wavelet matrix of n symbols: one bit sequence a level, from the highest bit down."""

    def __init__(self, levels: list[Bits], n: int):
        self.levels = [(bit, b, n - int(b.before[-1])) for bit, b in zip(range(len(levels) - 1, -1, -1), levels)]

    @classmethod
    def of(cls, symbols: np.ndarray, sigma: int) -> Wavelet:
        levels, cur = [], symbols
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (cur >> bit & 1).astype(bool)
            levels.append(Bits.of(ones))
            cur = np.concatenate([cur[~ones], cur[ones]])
        return cls(levels, len(symbols))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c occurs before i."""
        lo = np.zeros_like(i)
        for bit, ones, zeros in self.levels:
            one = (c >> bit & 1).astype(bool)
            a, b = ones.rank(lo), ones.rank(i)
            lo, i = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, i - b)
        return i - lo

    def symbol(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at i, how often it occurs before i)."""
        lo, c = np.zeros_like(i), np.zeros_like(i)
        for bit, ones, zeros in self.levels:
            one = ones.get(i)
            c |= one.astype(c.dtype) << bit
            a, b = ones.rank(lo), ones.rank(i)
            lo, i = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, i - b)
        return c, i - lo


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that still share a bucket are sorted again.

    The last symbol occurs once, so that no two suffixes are equal.
    """
    n, step = len(symbols), 1
    order = np.argsort(symbols, kind="stable")
    head = np.ones(n, bool)
    head[1:] = symbols[order][1:] != symbols[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    slots = np.arange(n)
    while True:
        alone = head[slots] & np.append(head, True)[slots + 1]
        slots = slots[~alone]
        if not len(slots):
            return order
        suffixes = order[slots]
        key = rank[suffixes] * n + rank[suffixes + step]
        by = np.argsort(key)
        suffixes, key = suffixes[by], key[by]
        order[slots] = suffixes
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        head[slots] = new
        rank[suffixes] = np.maximum.accumulate(np.where(new, slots, 0))
        step *= 2


class FMIndex:
    """FM-index of documents of symbols 1..sigma-1."""

    def __init__(self, wavelet: Wavelet, first: np.ndarray, marked: Bits, spots: np.ndarray):
        #: the transform; rows before each symbol's; rows with a sampled position; those positions, by row
        self.wavelet, self.first, self.marked, self.spots = wavelet, first, marked, spots

    @classmethod
    def of(cls, symbols: np.ndarray, starts: np.ndarray, sigma: int) -> FMIndex:
        """Index of the documents that start at ``starts`` (none is empty)."""
        # each ends with a terminator of its own, all less than any word, so that order never depends on the next document
        n, r = len(symbols), len(starts)
        document = np.repeat(np.arange(r), np.diff(np.append(starts, n)))
        text = np.zeros(n + r, np.int64)
        place = np.arange(n) + document
        text[place] = symbols + r
        text[np.append(starts[1:], n) + np.arange(r)] = np.arange(r)
        order = suffix_order(text) if n else np.zeros(0, np.int64)
        plain = np.maximum(text - r, 0)
        # sampled: the first word of each document and every SAMPLE-th, so that no walk crosses a terminator
        spot = np.full(n + r, -1, np.int64)
        spot[place[::SAMPLE]] = np.arange(0, n, SAMPLE)
        spot[place[starts]] = starts
        spot = spot[order]
        return cls(Wavelet.of(plain[order - 1], sigma), np.concatenate([[0], np.cumsum(np.bincount(plain, minlength=sigma))]),
                   Bits.of(spot >= 0), spot[spot >= 0])

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of suffixes that start with each window (a row, right-aligned, of ``lengths`` symbols)."""
        lo, hi = np.zeros(len(windows), np.int64), np.full(len(windows), self.first[-1], np.int64)
        for k in range(windows.shape[1]):
            live = np.flatnonzero((lengths > k) & (lo < hi))
            if not len(live):
                break
            c = windows[live, windows.shape[1] - 1 - k]
            lo[live] = self.first[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.first[c] + self.wavelet.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each suffix among the words."""
        rows, back, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            done = self.marked.get(rows[todo])
            d = todo[done]
            out[d] = self.spots[self.marked.rank(rows[d])] + back[d]
            todo = todo[~done]
            c, before = self.wavelet.symbol(rows[todo])
            rows[todo] = self.first[c] + before
            back[todo] += 1
        return out


@dataclass(frozen=True)
class Shard:
    """The index of a shard's documents, its vocabulary, and where each document's words start (and the total)."""

    vocabulary: np.ndarray  # sorted word identifiers; symbol k + 1 stands for the k-th
    first: np.ndarray
    index: FMIndex

    @classmethod
    def of(cls, raw: np.ndarray, offs: np.ndarray) -> Shard:
        starts, stops, first = K.word_bounds(raw, offs, K.NOT_ALNUM)
        vocabulary, symbols = np.unique(K.word_ids(raw, starts, stops), return_inverse=True)
        return cls(vocabulary, first, FMIndex.of(symbols + 1, np.unique(first[first < len(starts)]), len(vocabulary) + 1))

    def to_bytes(self) -> bytes:
        out, i = io.BytesIO(), self.index
        np.savez(out, vocabulary=self.vocabulary, first=self.first.astype(np.int32), levels=np.array([b.words for _, b, _ in i.wavelet.levels]),
                 counts=np.diff(i.first).astype(np.int32), marked=i.marked.words, spots=i.spots.astype(np.int32))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Shard:
        x = np.load(io.BytesIO(raw))
        first = np.concatenate([[0], np.cumsum(x["counts"], dtype=np.int64)])
        wavelet = Wavelet([Bits(w) for w in x["levels"]], int(first[-1]))
        return cls(x["vocabulary"], x["first"].astype(np.int64), FMIndex(wavelet, first, Bits(x["marked"]), x["spots"].astype(np.int64)))


@dataclass(frozen=True)
class Block:
    """Windows of a bounded number of test items."""

    vocabulary: np.ndarray  # sorted word identifiers; symbol k + 1 stands for the k-th
    windows: np.ndarray  # distinct windows of symbols, right-aligned, zeros before
    lengths: np.ndarray
    names: list[str | None]  # items, sorted, null last
    owners: np.ndarray  # item of each owner entry
    owner_from: np.ndarray  # first owner entry of each window, and the total


def make_block(items: list[tuple[str | None, str | None]], width: int) -> Block | None:
    """Block of (item id, text) pairs; None if no item has a word."""
    raw, offs = K.column_bytes(pa.array([t or "" for _, t in items], pa.string()))
    raw = K.LOWER[raw]
    starts, stops, first = K.word_bounds(raw, offs, K.NOT_ALNUM)
    if not len(starts):
        return None
    vocabulary, symbols = np.unique(K.word_ids(raw, starts, stops), return_inverse=True)
    symbols = (symbols + 1).astype(np.int32)
    names = sorted({i for i, _ in items}, key=lambda i: (i is None, i))
    number = {i: k for k, i in enumerate(names)}
    n = np.diff(first)
    each = np.where(n > 0, np.maximum(n - width + 1, 1), 0)  # windows of each item
    item = np.repeat(np.arange(len(items)), each)
    begin = first[item] + np.arange(len(item)) - (np.cumsum(each) - each)[item]
    lengths = np.minimum(n, width)[item]
    windows = np.zeros((len(item), width), np.int32)
    for k in range(width):
        some = lengths >= width - k
        windows[some, k] = symbols[begin[some] + lengths[some] - width + k]
    owner = np.array([number[i] for i, _ in items], np.int32)[item]
    order = np.lexsort((owner, *windows.T))
    windows, owner, lengths = windows[order], owner[order], lengths[order]
    new = np.ones(len(order), bool)
    new[1:] = (windows[1:] != windows[:-1]).any(axis=1)
    again = np.zeros(len(order), bool)
    again[1:] = ~new[1:] & (owner[1:] == owner[:-1])
    return Block(vocabulary, windows[new], lengths[new], names, owner[~again], np.append(np.flatnonzero(new[~again]), (~again).sum()))


def occurrences(shard: Shard, block: Block):
    """(row, first word, last word + 1, window) of every occurrence in the shard's documents."""
    none = np.zeros(0, np.int64)
    if not len(shard.vocabulary):
        return none, none, none, none
    at = np.minimum(np.searchsorted(shard.vocabulary, block.vocabulary), len(shard.vocabulary) - 1)
    symbol = np.concatenate([[0], np.where(shard.vocabulary[at] == block.vocabulary, at + 1, -1)])
    windows = symbol[block.windows]
    there = np.flatnonzero((windows >= 0).all(axis=1))  # a window with a word that the shard lacks doesn't occur
    lo, hi = shard.index.search(windows[there], block.lengths[there])
    n = np.maximum(hi - lo, 0)
    window = np.repeat(there, n)
    word = shard.index.locate(np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum())))
    row = np.searchsorted(shard.first, word, "right") - 1
    start = word - shard.first[row]
    return row, start, start + block.lengths[window], window


_INDEX = "doc_id array<{id}>, th array<long>, shard binary"
_FOUND = "doc_id {id}, th long, n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def _index(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, every = K.column_bytes(batch.column(2))
        for i, j in K.segments(every, size):
            shard = Shard.of(K.LOWER[text[every[i]:every[j]]], every[i:j + 1] - every[i])
            whole = pa.array([0, j - i], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(whole, pa.concat_arrays([batch.column(k).slice(i, j - i)])) for k in (0, 1)]
                                             + [pa.array([shard.to_bytes()], pa.binary())], names=["doc_id", "th", "shard"])


def _seek(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block: Block = shared.value
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        for k in range(batch.num_rows):
            shard = Shard.from_bytes(batch.column(2)[k].as_py())
            row, s, e, window = occurrences(shard, block)
            order = np.argsort(row, kind="stable")
            bounds = np.searchsorted(row[order], np.arange(len(shard.first)))
            spans, items = [], []
            for i, j in zip(bounds[:-1], bounds[1:]):
                if i == j:
                    spans.append([])
                    items.append([])
                    continue
                o = order[i:j]
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(*K.merged(s[o], e[o]))])
                own = np.unique(np.concatenate([block.owners[block.owner_from[w]:block.owner_from[w + 1]] for w in np.unique(window[o])]))
                items.append([block.names[q] for q in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[k].values, batch.column(1)[k].values, pa.array(np.diff(shard.first), pa.int64()), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "th", "n_words", "spans", "items"])


def index_shards(docs: DataFrame, shard_bytes: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a shard: its documents' ids and text hashes, and the FM-index of their words (``Shard``)."""
    d = pick(docs, doc_id=id_col, text=text_col)
    d = d.select("doc_id", F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    return d.mapInArrow(partial(_index, shard_bytes), _INDEX.format(id=docs.schema[id_col].dataType.simpleString()))


def blocks_of(items: DataFrame, width: int, block_words: int, id_col: str, text_col: str):
    """The items' blocks, one at a time on the driver; each has at most block_words words, or one longer item."""
    text = F.coalesce(items[text_col], F.lit(""))
    d = items.select(items[id_col].cast("string").alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n"))
    # a word takes two bytes at least, with what ends it
    total = d.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    count = max(1, -(-total // max(1, 2 * block_words)))
    if count > 1:
        d = cut(d)
    for k in range(count):
        part = d.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k) if count > 1 else d
        block = make_block([(r["id"], r["text"]) for r in part.select("id", "text").collect()], width)
        if block is not None:
            yield block


def _merged(spans: Column) -> Column:
    """Maximal intervals of an array of spans."""
    kind = "array<struct<start:int,end:int>>"

    def step(out, s):
        last = F.element_at(out, -1)
        joined = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(out) > 0) & (s["start"] <= F.try_element_at(out, F.lit(-1))["end"]), joined).otherwise(F.concat(out, F.array(s))).cast(kind)

    return F.when(F.size(spans) == 0, F.array().cast(kind)).otherwise(F.aggregate(F.sort_array(spans), F.array().cast(kind), step))


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, block_words: int = BLOCK_WORDS, shard_bytes: int = SHARD,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, th, n_words, spans (maximal runs of hit words), items (ids with occurring windows, sorted) of each row."""
    spark = docs.sparkSession
    schema = _FOUND.format(id=docs.schema[id_col].dataType.simpleString())
    index = index_shards(docs, shard_bytes, id_col, text_col)
    blocks = [spark.sparkContext.broadcast(b) for b in blocks_of(items, width, block_words, item_col, item_text_col)]
    if not blocks:
        text = F.coalesce(docs[text_col], F.lit(""))
        n = F.regexp_count(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(WORDS)).cast("long")
        return docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[text_col]).alias("th"), n.alias("n_words"),
                           F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    if len(blocks) > 1:
        index = cut(index)
    found = [index.mapInArrow(partial(_seek, b), schema) for b in blocks]
    if len(found) == 1:
        return found[0]
    # several blocks: each searches the written indexes, and only hits meet; equal rows have equal hits, kept once a block
    all_hits = found[0]
    for f in found[1:]:
        all_hits = all_hits.union(f)
    hits = all_hits.where(F.size("spans") > 0).groupBy("doc_id", "th").agg(F.flatten(F.collect_set("spans")).alias("s"), F.flatten(F.collect_set("items")).alias("i"))
    hits = hits.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "s", "i")
    base = found[0].select("doc_id", "th", "n_words")
    joined = base.join(hits, base.doc_id.eqNullSafe(hits.d) & (base.th == hits.t), "left")
    empty_s, empty_i = F.array().cast("array<struct<start:int,end:int>>"), F.array().cast("array<string>")
    return joined.select("doc_id", "th", "n_words", _merged(F.coalesce("s", empty_s)).alias("spans"), F.array_sort(F.array_distinct(F.coalesce("i", empty_i))).alias("items"))


def report(found: DataFrame) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def remove(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with the hit spans cut out of their texts; texts without hits (and null texts) stay as they are."""
    found = contamination(docs, items, id_col=id_col, text_col=text_col, **options)
    hits = found.where(F.size("spans") > 0).select(F.col("doc_id").alias("__d"), F.col("th").alias("__t"), F.col("spans").alias("__spans")).dropDuplicates(["__d", "__t"])
    d = docs.withColumn("__th", F.xxhash64(docs[text_col]))
    d = d.join(hits, d[id_col].eqNullSafe(hits["__d"]) & (d["__th"] == hits["__t"]), "left")
    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(F.pandas_udf(_without, "string")(F.col(text_col), F.col("__spans")))
    return d.withColumn(text_col, text).select(*docs.columns)


def _without(texts, spans):
    """Texts without the words of their spans, from the first word's first character to the last word's last."""
    import pandas as pd
    out = []
    for text, cuts in zip(texts, spans):
        if text is None or cuts is None:
            out.append(text)
            continue
        raw = text.encode()
        data = K.LOWER[np.frombuffer(raw, np.uint8)]
        starts, stops, _ = K.word_bounds(data, np.array([0, len(data)]), K.NOT_ALNUM)
        rest, at = [], 0
        for c in cuts:
            rest.append(raw[at:starts[c["start"]]])
            at = stops[c["end"] - 1]
        out.append((b"".join(rest) + raw[at:]).decode())
    return pd.Series(out, dtype=object)


SQL = r"""
with w as (select row_number() over () rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
bw as (select distinct item_id, least(len(w), 10) n, array_to_string(w[i:i+9], ' ') g from (select item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) i from b where len(w) > 0)),
ns as (select distinct n from bw),
dw as (select rid, i, n, array_to_string(w[i:i+n-1], ' ') g from (select rid, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) i from w, ns where len(w) >= n)),
o as (select rid, i, dw.n, item_id from dw join bw on dw.g = bw.g and dw.n = bw.n),
h as (select rid, count(distinct i + k) n_hit from (select distinct rid, i, n from o), (select unnest(range(0, 10)) k) where k < n group by rid),
it as (select rid, count(*) n_items, string_agg(id, ',' order by id) ids from (select distinct rid, cast(item_id as varchar) id from o) group by rid)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256, n_hit is not null contaminated
from w left join h using (rid) left join it using (rid)
"""
