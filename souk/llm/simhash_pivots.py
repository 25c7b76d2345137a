"""SimHash near-dedup with pivot distance tables.

Every document gets a 64-bit SimHash of its word shingles (XXH64).  Equal
fingerprints are one node; links are sought between nodes.

Method: a table holds each fingerprint's Hamming distances to many reference
fingerprints (pivots).  By the triangle inequality two fingerprints within d
bits have distances to any pivot that differ by d at most, so a pair whose
largest coordinate difference is greater is discarded; survivors are verified
bit by bit.  So that no task sees all pairs, fingerprints meet in buckets
first: of six blocks of bits at least three are equal in a pair with three
differing bits, so each fingerprint goes to a bucket for each three of the
blocks (in general: blocks - bits of them).  In a bucket, rows are sorted by
the first pivot's distance and a row meets those at most d further.

Links of a bucket become a spanning forest before they leave the task, and
components are joined by minima over the whole corpus (large and small stars),
as DataFrames; no step holds all of a component's rows in one place.

Defined results: a null text has no words; no words give fingerprint 0, which
links like any other; equal rows are in one component; a null doc_id counts
for no component's name unless all are null; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import cut, partitions, pick

SHINGLE, BITS, BLOCKS, SEED = 3, 3, 6, 42
#: Reference fingerprints: any fixed values do; these spread over all bits.
PIVOTS = K.mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Verified links of one task that are held before they become a forest.
HELD = 1 << 18


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """SimHash of lower-cased words: a bit is 1 if it is set in over half the shingles' hashes."""
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    first, last = starts[:-shingle].tolist(), (starts[shingle:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(first, last)], np.uint64, len(first))
    votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes)).view("<u8")[0])


def _fingerprints(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offs = K.column_bytes(batch.column(2))
        fps = np.empty(batch.num_rows, np.uint64)
        for r in range(batch.num_rows):
            fps[r] = fingerprint(raw[offs[r]:offs[r + 1]].tobytes().lower().split(), shingle)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64), pa.int64())], names=["doc_id", "th", "fp"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its tree) of the nodes that aren't least themselves, for the links a-b."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[:len(a)], inv[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]]


def _meet(fp: np.ndarray, group: np.ndarray, bits: int):
    """Verified links among rows of equal group; rows come sorted by group and first pivot distance."""
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int16)
    live, k = np.arange(len(fp)), 1
    while len(live):
        live = live[live + k < len(fp)]
        live = live[(group[live] == group[live + k]) & (table[live + k, 0] - table[live, 0] <= bits)]
        for at in range(0, len(live), 1 << 18):
            i = live[at:at + (1 << 18)]
            i = i[np.abs(table[i] - table[i + k]).max(axis=1) <= bits]
            i = i[np.bitwise_count(fp[i] ^ fp[i + k]) <= bits]
            if len(i):
                yield fp[i], fp[i + k]
        k += 1


def _links(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets (sorted by table and key) -> forest links."""
    def solve(parts):
        t, key, fp = (np.concatenate(x) for x in zip(*parts))
        first = np.bitwise_count(fp ^ PIVOTS[0])
        order = np.lexsort((first, key, t))
        t, key, fp = t[order], key[order], fp[order]
        new = np.ones(len(fp), bool)
        new[1:] = (t[1:] != t[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(new)
        many = np.bincount(group)[group] > 1
        a, b, n = [], [], 0
        for x, y in _meet(fp[many], group[many], bits):
            a.append(x)
            b.append(y)
            n += len(x)
            if n > HELD:
                x, y = _forest(np.concatenate(a), np.concatenate(b))
                a, b, n = [x], [y], 0 if len(x) < HELD // 2 else -len(x)
        if a:
            x, y = _forest(np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

    rest: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        fp = batch.column(2).to_numpy().view(np.uint64)
        # the last bucket of a batch may go on in the next
        end = int(np.flatnonzero((t != t[-1]) | (key != key[-1]))[-1]) + 1 if ((t != t[-1]) | (key != key[-1])).any() else 0
        if end:
            yield from solve([*rest, (t[:end], key[:end], fp[:end])])
            rest = []
        rest.append((t[end:], key[end:], fp[end:]))
    if rest:
        yield from solve(rest)


def masks(bits: int, blocks: int) -> list[int]:
    """Bit masks of each choice of ``blocks - bits`` blocks, as signed longs."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    one = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    out = [sum(c) for c in combinations(one, blocks - bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def components(links: DataFrame) -> DataFrame:
    """node, root (least node of its component) of every node with a link; links has columns a and b."""
    e = cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # large star: greater neighbours go to the least neighbour
        e = both.join(low, both.a == low.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: the others and the node itself do
        low = e.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        j = e.join(low, e.a == low.n)
        e = cut(j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(j.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th (hash of the text, tells rows of one id apart), fp of each row; written once."""
    d = pick(docs, doc_id=id_col, text=text_col)
    d = d.select("doc_id", F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    return cut(d.mapInArrow(partial(_fingerprints, shingle), f"doc_id {docs.schema[id_col].dataType.simpleString()}, th long, fp long"))


def link(fps: DataFrame, bits: int = BITS, blocks: int = BLOCKS) -> DataFrame:
    """fp, root of each fingerprint in a component of several."""
    nodes = fps.select("fp").distinct()
    n = partitions(fps.sparkSession)
    tables = F.array(*[F.lit(m) for m in masks(bits, blocks)])
    rows = nodes.select("fp", F.posexplode(tables).alias("t", "m")).select(F.col("t").cast("int").alias("t"), F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp")
    found = rows.repartition(n, "t", "key").sortWithinPartitions("t", "key").mapInArrow(partial(_links, bits), "a long, b long")
    return components(found).select(F.col("node").alias("fp"), "root")


def groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, blocks: int = BLOCKS, **columns) -> DataFrame:
    """doc_id, th, fp, component_id, root (least fingerprint of the component) of each row."""
    fps = fingerprints(docs, shingle, **columns)
    roots = link(fps, bits, blocks).select(F.col("fp").alias("node"), "root")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(names.withColumnRenamed("root", "r"), F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id", "root")
    return fps.join(named, fps.fp == named.f).select("doc_id", "th", "fp", "component_id", "root")


def report(grouped: DataFrame) -> DataFrame:
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without near copies: of each group the row with the least id stays (then the least text hash, one of equal rows).

    A row with a null id stays only where a group has no other.
    """
    g = groups(docs, id_col=id_col, text_col=text_col, **options)
    least = g.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("least"))
    kept = least.select(F.col("least.doc_id").alias("keep_id"), F.col("least.th").alias("keep_th"))
    d = docs.withColumn("__th", F.xxhash64(docs[text_col]))
    d = d.join(kept, d[id_col].eqNullSafe(kept.keep_id) & (d["__th"] == kept.keep_th)).drop("keep_id", "keep_th")
    return d.dropDuplicates([id_col, "__th"]).drop("__th").select(*docs.columns)
