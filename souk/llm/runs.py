"""Find windows of n units that also occur elsewhere, over a whole corpus.

Shared by the byte and the word form of substring removal, which differ in
how they identify a window and in which occurrences they cover.

Sending each window of each document through a shuffle would cost many times
the corpus.  Instead the windows of a document are split into *runs* that
have the same least gram (``kernel.shared_runs``).  Equal windows have equal
least grams, so:

1. one record for each run goes to its gram's bucket.  Runs of equal content
   settle all their windows at once; a bucket that holds one content only
   has no repeated window beside those;
2. the runs of the remaining buckets (the edges of repeated passages) go back
   to their texts, and each of their windows is compared on its own: by its
   identifier, or, where the task has ``refine``, by the units themselves,
   which travel with the run.

Both steps are exact for distinct identifiers.  Each map task combines equal
contents before the shuffle, so a passage found in a third of all documents
sends one record a batch.  A gram with many different contents in one batch
is marked: its runs skip the first comparison and their windows are dealt out
by window, so that no bucket grows with a frequent gram.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import ranges

NULL_ID = np.iinfo(np.int64).max
MULTI, COVERED, REQUEST, HEAVY = 1, 2, 4, 8
#: Different contents of one gram in one batch beyond which the gram is heavy.
HEAVY_CONTENTS = 32
SEGMENT = 1 << 18

BLOB = "part int, docs binary, places binary, bucket binary, content binary"
#: found: first window << 16 | number of windows << 8 | kind (0: covered)
FOUND = "doc_id long, th long, size int, found long"
#: Bytes that tell grams of one range apart; two grams that share them only have their windows compared closer.
GRAM_BYTES = 4
#: Bytes of text whose records are combined and sent together, and whose records meet in one task (about).
FLUSH, RANGE = 4 << 20, 12 << 20
#: Units that are refined together (about): whole buckets.
REFINED = 2 << 20


@dataclass(frozen=True)
class Task:
    """How windows are identified and which of them are covered."""

    #: (bytes, offsets) -> (units, index of each row's first unit and the total)
    units: Callable
    #: units -> (identifier of the gram at each unit, identifier of the window at each unit)
    identify: Callable
    window: int
    gram: int
    #: True: covered if a smaller doc_id has it; False: if it occurs anywhere else
    first_stays: bool
    #: (one-byte units, window starts) -> number of each window, equal for equal windows; None: identifiers tell windows apart
    refine: Callable | None = None

    def __post_init__(self):
        if not 0 <= self.window - self.gram < 255:
            raise ValueError("a window has at least one gram and at most 255")


def judge(first_stays: bool, bucket, content, ident, multi):
    """(covered, needs closer comparison, stands for its content), for records of one range of buckets."""
    n = len(bucket)
    if n == 0:
        z = np.zeros(0, bool)
        return z, z, z
    order = np.lexsort((ident, content, bucket))
    b, c, d = bucket[order], content[order], ident[order]
    newb = np.ones(n, bool)
    newb[1:] = b[1:] != b[:-1]
    newc = newb.copy()
    newc[1:] |= c[1:] != c[:-1]
    ci, bi = np.cumsum(newc) - 1, np.cumsum(newb) - 1
    groups = np.bincount(bi[newc])  # contents in each bucket
    if first_stays:
        least = d[newc][ci]
        cov = d > least
        need = ~cov & (least > np.minimum.reduceat(d, np.flatnonzero(newb))[bi])
    else:
        total = np.add.reduceat(1 + multi[order].astype(np.int64), np.flatnonzero(newc))[ci]
        cov = total > 1
        need = ~cov & (groups[bi] > 1)
    useful = np.zeros(len(groups), bool)
    np.logical_or.at(useful, bi[need], True)
    stands = newc & useful[bi]
    out = []
    for x in (cov, need, stands):
        y = np.empty(n, bool)
        y[order] = x
        out.append(y)
    return tuple(out)


def runs_of(task: Task, raw: np.ndarray, offs: np.ndarray):
    """(row, first window, count, bucket, content, window identifiers, first index in them, units) of each piece of the rows."""
    n = task.window
    for i, j in K.segments(offs, SEGMENT):
        units, first = task.units(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        step = (1 << K.POS_BITS) - n
        for at in range(0, max(len(units) - n + 1, 0), step):
            part = units[at:at + step + n - 1]
            grams, windows = task.identify(part)
            p = np.arange(len(windows))
            row = np.searchsorted(first, p + at, "right") - 1
            valid = p + at + n <= first[row + 1]
            bucket, whole, lo, cnt = K.shared_runs(grams, windows, valid, n - task.gram + 1)
            yield row[lo] + i, lo + at - first[row[lo]], cnt, bucket, whole, windows, lo, part


def _low_bytes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _from_bytes(raw: bytes, width: int) -> np.ndarray:
    a = np.zeros((len(raw) // width, 8), np.uint8)
    a[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return a.view("<u8").ravel()


def _pack(*columns: np.ndarray) -> bytes:
    """Integer columns, byte by byte (like bytes together), compressed."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, c.dtype.itemsize).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(raw: bytes, *kinds: str) -> list[np.ndarray]:
    kinds = [np.dtype(k) for k in kinds]
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    n, at, out = len(data) // sum(k.itemsize for k in kinds), 0, []
    for k in kinds:
        out.append(np.ascontiguousarray(data[at:at + n * k.itemsize].reshape(k.itemsize, n).T).view(k).ravel())
        at += n * k.itemsize
    return out


def _blobs(parts: int, part, ids, ths, sizes, row, lo, cnt, flag, bucket, content, per=None) -> pa.RecordBatch:
    """One row for each part with all its records; ``per`` contents (identifiers or one-byte units) belong to a record if given."""
    order = np.argsort(part * (np.int64(1) << 44) + row * (np.int64(1) << 22) + np.minimum(lo, (1 << 22) - 1), kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    ends = np.cumsum(per) if per is not None else None
    rows = []
    met = (flag & (COVERED | REQUEST)) == 0  # only these are compared: the others need neither gram nor content
    for k in np.flatnonzero(np.diff(bounds)):
        o = order[bounds[k]:bounds[k + 1]]
        used, local = np.unique(row[o], return_inverse=True)
        m = o[met[o]]
        body = content[m] if per is None else content[np.repeat(ends[m] - per[m], per[m]) + _within(per[m])]
        rows.append((int(k), _pack(np.diff(ids[used], prepend=np.int64(0)), ths[used], sizes[used]),
                     _pack(np.diff(local, prepend=0).astype("<u4"), lo[o].astype("<u4"), cnt[o].astype(np.uint8), flag[o].astype(np.uint8)),
                     _low_bytes(bucket[m] // np.uint64(parts), GRAM_BYTES), _pack(body.ravel()) if body.dtype == np.uint8 else _low_bytes(body, 6)))
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                      names=[x.split()[0] for x in BLOB.split(", ")])


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. for each group of the given sizes."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def _read(table: pa.Table, windows: bool, refined: bool = False):
    """All records of one part; a content for each record, or for each of its windows (0 where none was sent), or the units that were sent."""
    out = {k: [] for k in ("id", "th", "size", "lo", "cnt", "flag", "bucket", "content")}
    for r in table.select(["docs", "places", "bucket", "content"]).to_batches():
        for docs, places, bucket, content in zip(*[c.to_pylist() for c in r.columns]):
            ids, ths, sizes = _unpack(docs, "<i8", "<i8", "<i4")
            at, lo, cnt, flag = _unpack(places, "<u4", "<u4", "u1", "u1")
            at = np.cumsum(at)
            met = (flag & (COVERED | REQUEST)) == 0
            grams = np.zeros(len(flag), np.uint64)
            grams[met] = _from_bytes(bucket, GRAM_BYTES)
            if refined:
                whole = _unpack(content, "u1")[0]
            else:
                if windows:
                    met = np.repeat(met, cnt)
                whole = np.zeros(len(met), np.uint64)
                whole[met] = _from_bytes(content, 6)
            for k, v in (("id", np.cumsum(ids)[at]), ("th", ths[at]), ("size", sizes[at]), ("lo", lo), ("cnt", cnt), ("flag", flag),
                         ("bucket", grams), ("content", whole)):
                out[k].append(v)
    return {k: np.concatenate(v) for k, v in out.items()}


def _found(kind, rec, mask) -> pa.RecordBatch:
    code = (rec["lo"].astype(np.int64) << 16 | rec["cnt"].astype(np.int64) << 8 | kind)[mask]
    return pa.RecordBatch.from_arrays([pa.array(rec["id"][mask], pa.int64()), pa.array(rec["th"][mask], pa.int64()),
                                       pa.array(rec["size"][mask], pa.int32()), pa.array(code, pa.int64())], names=["doc_id", "th", "size", "found"])


def covered(found: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of each row's first interval and the total, first windows, numbers of windows) that are covered."""
    offsets, codes = found.offsets.to_numpy(), found.flatten().to_numpy(zero_copy_only=False)
    keep = (codes & 255) == 0
    upto = np.concatenate([[0], np.cumsum(keep)])
    codes = codes[keep]
    return upto[offsets - offsets[0]], codes >> 16, (codes >> 8) & 255


def _combine(first_stays, bucket, content, ident):
    """Before the shuffle: (covered here already, the records that must travel, that they stand for several)."""
    n = len(bucket)
    order = np.lexsort((ident, content, bucket))
    b, c, d = bucket[order], content[order], ident[order]
    new = np.ones(n, bool)
    new[1:] = (b[1:] != b[:-1]) | (c[1:] != c[:-1])
    g = np.cumsum(new) - 1
    if first_stays:
        cov = d > d[new][g]
        send, several = ~cov, np.zeros(n, bool)
    else:
        cov = (np.bincount(g)[g] > 1) if n else np.zeros(0, bool)
        send, several = new, cov
    out = []
    for x in (cov, send, several):
        y = np.empty(n, bool)
        y[order] = x
        out.append(y)
    return tuple(out)


def _inputs(batch):
    raw, offs = K.column_bytes(batch.column(2))
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
    return raw, offs, ids, batch.column(1).to_numpy(zero_copy_only=False).astype("<i8"), np.diff(offs).astype("<i4")


def _map_runs(task: Task, parts: int):
    def send(ids, ths, sizes, row, lo, cnt, bucket, content):
        content = content & np.uint64((1 << 48) - 1)
        cov, send, several = _combine(task.first_stays, bucket, content, ids[row])
        flag = np.where(several, MULTI, 0).astype(np.uint8)
        # grams with many contents: their runs go straight to the second step
        _, inv, contents = np.unique(bucket[send], return_inverse=True, return_counts=True)
        heavy = np.zeros(len(row), bool)
        heavy[np.flatnonzero(send)] = contents[inv] > HEAVY_CONTENTS
        part = (bucket % np.uint64(parts)).astype(np.int64)
        # what needs no comparison may go anywhere: copies of one content spread over all parts
        spread = (K.mix(content + row.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        pick, code, where = [np.flatnonzero(send & ~heavy)], [flag[send & ~heavy]], [part[send & ~heavy]]
        for mask, extra in ((cov, COVERED), (heavy, REQUEST | HEAVY)):
            pick.append(np.flatnonzero(mask))
            code.append(flag[mask] | np.uint8(extra))
            where.append(spread[mask])
        marks = np.flatnonzero(heavy)
        marks = marks[np.unique(bucket[marks], return_index=True)[1]]
        pick.append(marks)
        code.append(np.full(len(marks), HEAVY, np.uint8))
        where.append(part[marks])
        o, code, where = map(np.concatenate, (pick, code, where))
        return _blobs(parts, where, ids, ths, sizes, row[o], lo[o], cnt[o], code, bucket[o], content[o])

    def run(batches):
        for batch in batches:
            raw, offs, ids, ths, sizes = _inputs(batch)
            for i, j in K.segments(offs, FLUSH):
                got = [x[:5] for x in runs_of(task, raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])]
                if sum(len(x[0]) for x in got):
                    yield send(ids[i:j], ths[i:j], sizes[i:j], *map(np.concatenate, zip(*got)))
    return run


def _reduce_runs(task: Task):
    def run(table: pa.Table) -> pa.Table:
        rec = _read(table, False)
        flag = rec["flag"]
        passed = (flag & (COVERED | REQUEST)) != 0
        mark = ~passed & ((flag & HEAVY) != 0)
        own = np.flatnonzero(~passed & ~mark)
        cov, need, stands = judge(task.first_stays, rec["bucket"][own], rec["content"][own], rec["id"][own], flag[own] & MULTI)
        hot = np.isin(rec["bucket"][own], rec["bucket"][mark]) if mark.any() else np.zeros(len(own), bool)
        covered, ask = (flag & COVERED) != 0, np.zeros(len(flag), bool)
        kind = np.zeros(len(flag), np.int32)
        covered[own[cov]] = True
        if task.first_stays:
            ask[own[(need | stands | hot) & ~cov]] = True
        else:
            ask[own[need | stands | (hot & (stands | ~cov))]] = True
            if hot.any():  # one of each repeated content of a heavy gram still stands for it
                o = own[hot & cov]
                ask[o[np.unique(np.stack([rec["bucket"][o], rec["content"][o]]), axis=1, return_index=True)[1]]] = True
        ask |= (flag & REQUEST) != 0
        # 1: compare windows by bucket; 2: of a heavy gram; +2: stands for several occurrences
        several = covered | ((flag & MULTI) != 0)
        heavy = (flag & HEAVY) != 0
        heavy[own[hot]] = True
        kind[:] = 1 + heavy + 2 * several
        return pa.Table.from_batches([_found(0, rec, covered), _found(kind, rec, ask)])
    return run


def _map_windows(task: Task, parts: int):
    """Texts with their open runs -> the identifiers of those runs' windows, or the runs' units."""
    more = task.window - 1 if task.refine else 0  # contents of a run beside one a window

    def opened(raw, offs, key, kind):
        for row, first, cnt, b, _, windows, at, units in runs_of(task, raw, offs):
            mine = row * (1 << 40) + first
            j = np.minimum(np.searchsorted(key, mine), len(key) - 1)
            hit = np.flatnonzero(key[j] == mine)
            if len(hit):
                c = cnt[hit]
                ws = windows[np.repeat(at[hit], c) + _within(c)] & np.uint64((1 << 48) - 1)
                body = units[np.repeat(at[hit], c + more) + _within(c + more)] if task.refine else ws
                yield row[hit], first[hit], c, b[hit], kind[j[hit]], ws, body

    def send(ids, ths, sizes, row, first, cnt, b, k, ws, body):
        flag = np.where(k > 2, MULTI, 0).astype(np.uint8)
        heavy = (k == 2) | (k == 4)
        ends, upto = np.cumsum(cnt), np.cumsum(cnt + more)
        light, hv = np.flatnonzero(~heavy), np.flatnonzero(heavy)
        if len(light):
            n, per = cnt[light], cnt[light] + more
            yield _blobs(parts, (b[light] % np.uint64(parts)).astype(np.int64), ids, ths, sizes, row[light], first[light], n,
                         flag[light], b[light], body[np.repeat(~heavy, cnt + more)], per)
        if len(hv):
            n = cnt[hv]
            w = ws[np.repeat(ends[hv] - n, n) + _within(n)]
            r, f, bb, fl = np.repeat(row[hv], n), np.repeat(first[hv], n) + _within(n), np.repeat(b[hv], n), np.repeat(flag[hv], n)
            cov, go, several = _combine(task.first_stays, bb, w, ids[r])
            fl = fl | np.where(several, MULTI, 0).astype(np.uint8)
            o = np.concatenate([np.flatnonzero(go), np.flatnonzero(cov)])
            code = np.concatenate([fl[go], fl[cov] | np.uint8(COVERED)])
            salt = K.pair(bb, w)
            where = np.concatenate([salt[go], K.mix(salt[cov] + r[cov].astype(np.uint64))]) % np.uint64(parts)
            one = np.ones(len(o), np.int64)
            if task.refine:  # only what is compared carries its units
                begin = (np.repeat(upto[hv] - n - more, n) + _within(n))[go]
                w = np.lib.stride_tricks.sliding_window_view(body, task.window)[begin]
            else:
                w = w[o]
            yield _blobs(parts, where.astype(np.int64), ids, ths, sizes, r[o], f[o], one, code, bb[o], w)

    def run(batches):
        for batch in batches:
            keep = np.flatnonzero(np.asarray(batch.column(3).is_valid()))
            if not len(keep):
                continue
            batch = batch.take(pa.array(keep))
            raw, offs, ids, ths, sizes = _inputs(batch)
            fo, codes = batch.column(3).offsets.to_numpy(), batch.column(3).flatten().to_numpy(zero_copy_only=False)
            fo = fo - fo[0]
            for i, j in K.segments(offs, FLUSH):
                mine = codes[fo[i]:fo[j]]
                row = np.repeat(np.arange(j - i), np.diff(fo[i:j + 1]))
                ask = (mine & 255) > 0
                key = row[ask] * (1 << 40) + (mine[ask] >> 16)
                if len(key):
                    order = np.argsort(key, kind="stable")
                    got = list(opened(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i], key[order], (mine[ask] & 255)[order]))
                    if got:
                        yield from send(ids[i:j], ths[i:j], sizes[i:j], *map(np.concatenate, zip(*got)))
    return run


def _numbered(task: Task, rec: dict, n: np.ndarray) -> np.ndarray:
    """A number for each window of the records, equal for equal windows of one bucket; buckets are refined some at a time."""
    met = np.flatnonzero((rec["flag"] & (COVERED | REQUEST)) == 0)
    size, upto = n[met] + task.window - 1, np.cumsum(n) - n
    begin = np.cumsum(size) - size
    order = np.argsort(rec["bucket"][met], kind="stable")
    b = rec["bucket"][met][order]
    edges = np.append(np.flatnonzero(np.append(True, b[1:] != b[:-1])), len(b)) if len(b) else np.zeros(1, np.int64)
    out, sizes = np.zeros(int(n.sum()), np.uint64), np.concatenate([[0], np.cumsum(size[order])])
    for i, j in K.segments(sizes[edges], REFINED):
        o = order[edges[i]:edges[j]]
        units = rec["content"][np.repeat(begin[o], size[o]) + _within(size[o])]
        c = n[met[o]]
        starts = np.repeat(np.cumsum(size[o]) - size[o], c) + _within(c)
        out[np.repeat(upto[met[o]], c) + _within(c)] = task.refine(units, starts)
    return out


def _reduce_windows(task: Task):
    def run(table: pa.Table) -> pa.Table:
        rec = _read(table, True, task.refine is not None)
        n = rec["cnt"].astype(np.int64)
        if task.refine:
            rec["content"] = _numbered(task, rec, n)
        each = {k: np.repeat(rec[k], n) for k in ("id", "th", "size", "flag", "bucket")}
        each["lo"] = np.repeat(rec["lo"].astype(np.int64), n) + _within(n)
        each["cnt"] = np.ones(len(each["lo"]), np.int64)
        covered = (each["flag"] & COVERED) != 0
        own = np.flatnonzero(~covered)
        cov, _, _ = judge(task.first_stays, each["bucket"][own], rec["content"][own], each["id"][own], each["flag"][own] & MULTI)
        covered[own[cov]] = True
        # neighbours of one run become one interval
        at = np.flatnonzero(covered)
        if len(at):
            run_no = np.repeat(np.arange(len(n)), n)[at]
            new = np.ones(len(at), bool)
            new[1:] = (run_no[1:] != run_no[:-1]) | (at[1:] != at[:-1] + 1)
            start = np.flatnonzero(new)
            each["cnt"][at[start]] = np.diff(np.append(start, len(at)))
            covered[:] = False
            covered[at[start]] = True
        return pa.Table.from_batches([_found(0, each, covered)])
    return run


def covered_windows(docs: DataFrame, task: Task) -> DataFrame:
    """doc_id, text, found (codes, see ``covered``) of each row of docs(doc_id, text).

    Rows that share a doc_id are told apart by their text (48 bits of its hash
    and its size in bytes); equal rows share what is found, each code once.  Null ids stay.
    """
    parts = ranges(docs, "text", RANGE)
    doc_id = F.col("doc_id").cast("long")
    # joins are on keys that are never null: such equality keeps the grouping's own partitioning
    base = docs.select(F.coalesce(doc_id, F.lit(int(NULL_ID))).alias("key"), F.xxhash64("text").bitwiseAND(F.lit((1 << 48) - 1)).alias("th"),
                       F.octet_length(F.coalesce("text", F.lit(""))).alias("size"), F.coalesce("text", F.lit("")).alias("text"), doc_id.alias("doc_id"))

    def by_document(found):
        return found.groupBy(F.col("doc_id").alias("i"), F.col("th").alias("h"), F.col("size").alias("s")).agg(F.collect_set("found").alias("found"))

    def attach(left, right, name):
        r = right.select("i", "h", "s", F.col("found").alias(name))
        return left.join(r, (left.key == r.i) & (left.th == r.h) & (left["size"] == r.s), "left").drop("i", "h", "s")

    # the texts are shuffled once: both joins read the same exchange
    sent = base.select("key", "th", "text").mapInArrow(_map_runs(task, parts), BLOB)
    runs = by_document(sent.groupBy("part").applyInArrow(_reduce_runs(task), FOUND))
    opened = attach(base, runs, "found")
    windows = opened.select("key", "th", "text", "found", "doc_id").mapInArrow(_map_windows(task, parts), BLOB)
    rest = by_document(windows.groupBy("part").applyInArrow(_reduce_windows(task), FOUND))
    both = attach(attach(base, runs, "found"), rest, "more")
    none = F.array().cast("array<bigint>")
    return both.select("doc_id", "text", F.concat(F.coalesce("found", none), F.coalesce("more", none)).alias("found"))
