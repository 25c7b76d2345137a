"""Ranked lexical search with exact sparse ball trees.

Every task cuts its rows into shards of about ``PIECE`` bytes of text and
builds one ball tree a shard, over all of the shard's terms and without
knowledge of any query: a document is the sparse vector of its terms'
saturated frequencies (integers), a node is a contiguous range of documents
with a centre (the centroid's ``CENTRE`` largest entries; the ball holds for
whatever centre it has) and the radius around it.  The trees are written once
and every block of items searches them.

Search: q·x <= q·c + |q'|·r for every document x of a ball, where q' is q
without the terms that no document of the node has.  Bounds are rounded
outward, so no document is lost to rounding; nodes are opened best first until
the best bound is below the k-th score; leaves are scored exactly in 64-bit
integers.  Each shard gives its k best of each item, and Spark ranks them.

Items come in blocks of at most ``BLOCK`` bytes of text; a block's terms and
weights are all that is broadcast or collected.  Texts are never shuffled.

Defined results: a null or empty text has no terms and is never found; an item
without terms has no rows; rows of one doc_id rank apart; a null doc_id comes
after others of its score; items of one id (null too) are ranked apart, each
with ranks from 1; equal scores by ascending doc_id, of repeated rows all count;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import cut, pick

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
#: Bytes of text in a shard (or one longer document), and of items in a block (or one longer item).
PIECE, BLOCK = 8 << 20, 1 << 20
LEAF, CENTRE = 32, 256
#: Outward rounding of a bound's sums of doubles; their true error is far less.
ROUND = 1 + 1e-9


# ------------------------------------------------------------------ terms
def terms(col: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(term number of each occurrence, the distinct terms, first occurrence of each row and the total)."""
    raw, offs = K.column_bytes(col)
    low = K.LOWER[raw]
    starts, stops, first = K.word_bounds(low, offs, K.NOT_ALNUM)
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts, out=ends[1:])
    kept = low[~K.NOT_ALNUM[low]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(kept)]).dictionary_encode()
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary.cast(pa.binary()), first


def vectors(col: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary, row pointers, columns (term numbers), frequencies, number of terms of each row."""
    codes, vocab, first = terms(col)
    wide = max(1, len(vocab))
    key, tf = np.unique(K.rows_of(first) * wide + codes, return_counts=True)
    ptr = np.searchsorted(key // wide, np.arange(len(first)))
    return vocab, ptr, key % wide, tf.astype(np.int64), np.diff(first)


def impacts(ptr: np.ndarray, tf: np.ndarray, n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """Saturated frequency of each entry, with the document's length against the mean."""
    m = np.array([25 + 75 * int(x) * total_docs // max(1, total_terms) for x in n], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(ptr)))


# ------------------------------------------------------------------ tree
def _rows(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows' entries, and their pointers."""
    size = ptr[rows + 1] - ptr[rows]
    own = np.concatenate([[0], np.cumsum(size)])
    return np.arange(own[-1]) + np.repeat(ptr[rows] - own[:-1], size), own


def _sums(x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(x)])
    return run[ptr[1:]] - run[ptr[:-1]]


def _radius(squares: np.ndarray) -> float:
    """Outward-rounded root of the largest squared distance; unbounded where integers could have wrapped."""
    most = int(squares.max(initial=0))
    return math.isqrt(most) + 1.0 if most else 0.0


def grow(ptr: np.ndarray, cols: np.ndarray, vals: np.ndarray, width: int):
    """Ball tree over sparse rows: (order of rows, nodes); a node is (lo, hi, left, right, radius, centre columns, centre values).

    A range splits at the widest gap, in its middle half, of the difference of
    distances to two rows far apart; equal rows stay in one leaf.
    """
    norms = _sums(vals * vals, ptr)
    safe = bool(_sums(vals.astype(float) ** 2, ptr).max(initial=0) < 2.0 ** 60)
    order, nodes = np.arange(len(ptr) - 1), []
    stack = [(0, len(order), None, 0)]
    while stack:
        lo, hi, parent, side = stack.pop()
        at, own = _rows(ptr, order[lo:hi])
        c, v = cols[at], vals[at]
        near = norms[order[lo:hi]]
        # a node's own columns, numbered anew where they are fewer
        names, c = np.unique(c, return_inverse=True) if len(c) < width else (np.arange(width), c)
        own_width = len(names)

        def squared(pivot: np.ndarray, size: int) -> np.ndarray:
            return near + size - 2 * _sums(v * pivot[c], own)

        mean = np.bincount(c, v, own_width) / (hi - lo)
        top = np.argpartition(mean, -CENTRE)[-CENTRE:] if own_width > CENTRE else np.arange(own_width)
        top = np.sort(top[mean[top] >= 1])
        centre = np.zeros(own_width, np.int64)
        centre[top] = mean[top]
        away = squared(centre, int((centre * centre).sum()))
        me = len(nodes)
        nodes.append([lo, hi, -1, -1, _radius(away) if safe else math.inf, names[top], centre[top]])
        if parent is not None:
            nodes[parent][2 + side] = me
        if hi - lo <= LEAF:
            continue

        def distances(row: int) -> np.ndarray:
            dense = np.zeros(own_width, np.int64)
            dense[c[own[row]:own[row + 1]]] = v[own[row]:own[row + 1]]
            return squared(dense, int(near[row]))

        one = distances(int(away.argmax()))
        if not one.any():
            continue
        gap = one - distances(int(one.argmax()))
        by = np.argsort(gap, kind="stable")
        quarter = (hi - lo) // 4
        mid = quarter + int(np.diff(gap[by])[quarter:hi - lo - quarter].argmax()) + 1
        order[lo:hi] = order[lo:hi][by]
        stack += [(lo, lo + mid, me, 0), (lo + mid, hi, me, 1)]
    return order, nodes


def _blob(*arrays: np.ndarray) -> bytes:
    """Integer arrays as compressed bytes, their lengths before them."""
    data = b"".join(a.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays)
    head = np.array([len(arrays), len(data), *map(len, arrays)], "<i8").tobytes()
    return head + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def _arrays(blob: bytes) -> list[np.ndarray]:
    many, size = np.frombuffer(blob, "<i8", 2)
    lengths = np.frombuffer(blob, "<i8", many, 16)
    raw = np.frombuffer(pa.decompress(blob[16 + 8 * int(many):], int(size), codec="zstd", asbytes=True) if size else b"", np.uint8)
    out, at = [], 0
    for n in lengths.tolist():
        out.append(np.ascontiguousarray(raw[at:at + 8 * n].reshape(8, n).T).reshape(-1).view("<i8"))
        at += 8 * n
    return out


def shard(ids: pa.Array, texts: pa.Array, total_docs: int, total_terms: int) -> pa.RecordBatch:
    """One row: ids in tree order, vocabulary, rows, tree."""
    vocab, ptr, cols, tf, n = vectors(texts)
    vals = impacts(ptr, tf, n, total_docs, total_terms)
    order, nodes = grow(ptr, cols, vals, len(vocab))
    at, own = _rows(ptr, order)
    centres = [x[5] for x in nodes]
    flat = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    table = np.array([[x[0], x[1], x[2], x[3], -1 if math.isinf(x[4]) else int(x[4]), len(x[5])] for x in nodes], np.int64).reshape(-1, 6)
    return pa.RecordBatch.from_arrays([
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))),
        pa.ListArray.from_arrays(pa.array([0, len(vocab)], pa.int32()), vocab),
        pa.array([_blob(own, cols[at], vals[at])], pa.binary()),
        pa.array([_blob(table.ravel(), flat(centres), flat([x[6] for x in nodes]))], pa.binary()),
    ], names=["ids", "vocab", "entries", "tree"])


def _index(total_docs: int, total_terms: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush():
        both = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return shard(both.column(0), both.column(1), total_docs, total_terms)

    for batch in batches:
        _, offs = K.column_bytes(batch.column(1))
        for a, b in K.segments(offs, PIECE):
            more = int(offs[b] - offs[a])
            if held and size + more > PIECE:
                yield flush()
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            size += more
    if held:
        yield flush()


# ------------------------------------------------------------------ search
class Block:
    """Items' terms: distinct terms, and term numbers and repeats of each item."""

    def __init__(self, texts: list[str | None]):
        codes, self.terms, first = terms(pa.array(texts, pa.large_string()))
        self.items = [np.unique(codes[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:])]
        self.weights = np.zeros(len(self.terms), np.int64)


def _frequencies(block, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term number, documents of the shard that hold it) of the block's terms."""
    for batch in batches:
        for vocab, entries in zip(batch.column(0), batch.column(1)):
            found = pc.index_in(block.value.terms, value_set=vocab.values)
            have = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            _, cols, _ = _arrays(entries.as_py())
            df = np.bincount(cols, minlength=len(vocab.values))
            yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(df[found.take(pa.array(have)).to_numpy()].astype(np.int64))], names=["term", "df"])


def best(block: Block, ids: pa.Array, vocab: pa.Array, entries: bytes, tree: bytes, k: int, opened: list | None = None) -> Iterator[tuple[int, list[int], list[int]]]:
    """(item number, positions, scores) of a shard's k best documents of each item; opened gets the leaves scored."""
    own, cols, vals = _arrays(entries)
    table, ccols, cvals = _arrays(tree)
    table = table.reshape(-1, 6)
    number = np.full(len(vocab), -1)
    found = pc.index_in(block.terms, value_set=vocab)
    have = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
    if not len(have):
        return
    number[found.take(pa.array(have)).to_numpy()] = np.arange(len(have))
    local = np.full(len(block.terms), -1)
    local[have] = np.arange(len(have))
    # only entries of the block's terms can score
    mine = number[cols] >= 0
    ptr = np.concatenate([[0], np.cumsum(mine)])[own]
    cols, vals = number[cols[mine]], vals[mine]
    # terms of each node: of leaves from their documents, of others from their leaves (all ranges are nested)
    lo, hi, left, right = (table[:, j] for j in range(4))
    leaves = np.flatnonzero(left < 0)
    leaves = leaves[np.argsort(lo[leaves])]
    leaf_of = np.repeat(np.arange(len(leaves)), hi[leaves] - lo[leaves])
    there = np.zeros((len(leaves) + 1, len(have)), np.int32)
    there[leaf_of[K.rows_of(ptr)] + 1, cols] = 1
    there = there.cumsum(axis=0)
    edge = np.append(lo[leaves], hi[leaves[-1]])
    present = there[np.searchsorted(edge, hi)] > there[np.searchsorted(edge, lo)]
    centre = np.zeros((len(table), len(have)))
    node = np.repeat(np.arange(len(table)), table[:, 5])
    on = number[ccols] >= 0
    centre[node[on], number[ccols[on]]] = cvals[on]
    radius = np.where(table[:, 4] < 0, np.inf, table[:, 4])
    rank = np.empty(len(ids), np.int64)
    rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    lo_, hi_, left_, right_ = lo.tolist(), hi.tolist(), left.tolist(), right.tolist()
    dense = np.zeros(len(have), np.int64)
    for i, (t, repeats) in enumerate(block.items):
        w = block.weights[t] * repeats
        t, w = local[t], w
        t, w = t[(t >= 0) & (w > 0)], w[(t >= 0) & (w > 0)]
        if not len(t):
            continue
        q = w.astype(float)
        norm = np.sqrt(present[:, t] @ (q * q))
        with np.errstate(invalid="ignore"):
            bound = np.where(norm > 0, (centre[:, t] @ q + norm * radius) * ROUND + 1, 0.0).tolist()
        dense[t] = w
        top: list[tuple[int, int, int]] = []  # (score, -rank, position), the worst first
        heap = [(-bound[0], 0)]
        while heap:
            reach, at = heapq.heappop(heap)
            if -reach < (top[0][0] if len(top) == k else 1):
                break
            if left_[at] >= 0:
                for child in (left_[at], right_[at]):
                    if bound[child] >= 1:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            if opened is not None:
                opened.append(at)
            a, b = lo_[at], hi_[at]
            got = _sums(dense[cols[ptr[a]:ptr[b]]] * vals[ptr[a]:ptr[b]], ptr[a:b + 1] - ptr[a])
            keep = np.flatnonzero(got >= (top[0][0] if len(top) == k else 1))
            if len(keep) > k:
                keep = keep[np.lexsort((rank[a + keep], -got[keep]))[:k]]
            for x in keep.tolist():
                entry = (int(got[x]), -int(rank[a + x]), a + x)
                if len(top) < k:
                    heapq.heappush(top, entry)
                else:
                    heapq.heappushpop(top, entry)
        dense[t] = 0
        if top:
            yield i, [x[2] for x in top], [x[0] for x in top]


def _search(block, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, vocab, entries, tree in zip(*batch.columns):
            n, at, score = [], [], []
            for i, p, s in best(block.value, ids.values, vocab.values, entries.as_py(), tree.as_py(), k):
                n += [i] * len(p)
                at += p
                score += s
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), ids.values.take(pa.array(at, pa.int64())), pa.array(score, pa.int64())], names=["item_no", "doc_id", "score"])


# ------------------------------------------------------------------ Spark
def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offs = K.column_bytes(batch.column(0))
        n = np.concatenate([np.diff(K.word_bounds(K.LOWER[raw[offs[a]:offs[b]]], offs[a:b + 1] - offs[a], K.NOT_ALNUM)[2]) for a, b in K.segments(offs, PIECE)] or [np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], names=["docs", "terms"])


def totals(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and terms with repeats, of all rows."""
    counted = pick(docs, text=text_col).where("text IS NOT NULL").mapInArrow(_totals, "docs long, terms long")
    got = counted.agg(F.sum("docs"), F.sum("terms")).first()
    return int(got[0] or 0), int(got[1] or 0)


def index(docs: DataFrame, size: tuple[int, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each shard: ids, vocabulary, entries and tree; written once."""
    d = pick(docs, doc_id=id_col, text=text_col).where("text IS NOT NULL")
    return cut(d.mapInArrow(partial(_index, *size), f"ids array<{docs.schema[id_col].dataType.simpleString()}>, vocab array<binary>, entries binary, tree binary"))


def _blocks(items: DataFrame) -> Iterator[list]:
    block, size = [], 0
    for row in items.toLocalIterator():
        more = len((row[1] or "").encode())
        if block and size + more > BLOCK:
            yield block
            block, size = [], 0
        block.append(row)
        size += more
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of each item's k best documents."""
    spark = docs.sparkSession
    doc_type, item_type = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    none = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {doc_type}, score long")
    size = totals(docs, text_col)
    if not size[0]:
        return none
    shards, found = index(docs, size, id_col, text_col), []
    for rows in _blocks(pick(items, item_id=item_col, text=item_text)):
        block = Block([x[1] for x in rows])
        if not len(block.terms):
            continue
        sent = spark.sparkContext.broadcast(block)
        df = shards.select("vocab", "entries").mapInArrow(partial(_frequencies, sent), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
        sent.destroy()
        counts = dict(map(tuple, df))
        block.weights = np.array([math.floor(1000 * math.log((2 * size[0] + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(block.terms))], np.int64)
        best_of = shards.mapInArrow(partial(_search, spark.sparkContext.broadcast(block), k), f"item_no long, doc_id {doc_type}, score long")
        names = spark.createDataFrame([(n, x[0]) for n, x in enumerate(rows)], f"no long, item_id {item_type}")
        order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best_of.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found.append(ranked.join(F.broadcast(names), ranked.item_no == names.no).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return reduce(DataFrame.union, found) if found else none


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH term AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}')) AS term FROM documents WHERE text IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM term GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM term GROUP BY ALL),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
item AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}')) AS term FROM benchmark WHERE text IS NOT NULL),
query AS (SELECT item_id, term, count(*) AS repeats, any_value(floor(1000 * ln((2 * docs + 2) / (2 * df + 1)::DOUBLE))::BIGINT) AS w
          FROM item JOIN df USING (term), total GROUP BY ALL),
scored AS (SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
           FROM query JOIN tf USING (term) JOIN len USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
