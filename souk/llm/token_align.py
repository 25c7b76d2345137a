"""Cross-tokenizer alignment by galloping intersection.

Two public tokenizers cut the same bytes (a space and the text).  The places
where tokens of both end cut a document into groups; tokens whose byte ranges
overlap are linked.  A link's count is the number of documents corpus-wide
that hold its pair of ids linked.

Method: of two end lists the shorter drives.  Each of its ends is sought in the
longer from where the last one was found, in steps that double, then by binary
search between the last two steps.  Ends found equal slice the groups; the
difference of two neighbouring ranks is the range of the longer list's tokens
that a token of the shorter overlaps.

Neither tokenizer's tokens cross a space after a character that is not white
space (checked against the vocabulary), so both lists have an end there, and a
stretch up to the next such space is encoded and aligned once a slot however
often it occurs.  A slot is about ``PIECE`` bytes of texts of one task; it is
written once, as its documents' distinct id pairs.  Counts are a shuffle by
pair of what the slots hold (a row for each slot and pair, so a pair in every
document has a row for each slot at most), and go back to their slots.

Defined results: a null or empty text, and one whose tokens' bytes differ from
space and text, has zeros and '' as digest; rows of one id and equal rows count
as documents each; null ids stay null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import cut, pick

#: Bytes of text in a slot (or one longer document).
PIECE = 3 << 20
#: Stretches in one call of a tokenizer.
CALL = 4096
#: The byte-level tokenizer's own pattern for words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fewer lists than this are walked one by one instead of together.
TOGETHER = 16


# ------------------------------------------------------------------ tokenizers
def _byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters are themselves, other bytes follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(size.sum())), size


class ByteLevel:
    """Ids and token bytes of a byte-level BPE file.

    Stretches of plain ASCII go through tiktoken, with the file's own entries
    as ranks, where every entry is one merge and numbered in the merges' order
    (the two then merge alike, and tiktoken takes a tenth of the time);
    others, whose letters depend on a library's Unicode tables, through tokenizers.
    """

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = _byte_alphabet()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        added = {x["content"] for x in file["added_tokens"]}
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, k in self.tokenizer.get_vocab().items():
            self.bytes[k] = token.encode() if token in added else bytes(alphabet[c] for c in token)
        self.length = np.array([len(x) for x in self.bytes], np.int64)
        vocab = file["model"]["vocab"]
        merged = ["".join(x if isinstance(x, list) else x.split(" ")) for x in file["model"]["merges"]]
        ordered = [vocab[x] for x in merged] == list(range(256, 256 + len(merged)))
        ranks = {self.bytes[k]: k for token, k in vocab.items() if token not in added}
        self.quick = Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ordered else None
        self.splits = True  # words take one space before them and no white space after them

    def encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each stretch)."""
        plain = np.array([self.quick is not None and x.isascii() and not x[-1:].isspace() for x in stretches], bool)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        words, rest = [stretches[k] for k in order[:plain.sum()].tolist()], [stretches[k] for k in order[plain.sum():].tolist()]
        ids, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(words), CALL):  # a space after text always begins a token: joined, they are cut alike
            ids.append(np.array(self.quick.encode_ordinary("".join(words[i:i + CALL])), np.int64))
            stops = np.cumsum([len(x) for x in words[i:i + CALL]])
            sizes.append(np.diff(np.searchsorted(np.cumsum(self.length[ids[-1]]), stops) + 1, prepend=0))
        for i in range(0, len(rest), CALL):
            more, size = _flat([x.ids for x in self.tokenizer.encode_batch_fast(rest[i:i + CALL], add_special_tokens=False)])
            ids.append(more)
            sizes.append(size)
        flat, run = np.concatenate(ids), np.concatenate(sizes)
        size, begin = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        size[order], begin[order] = run, np.cumsum(run) - run
        return flat[np.arange(len(flat)) + np.repeat(begin - (np.cumsum(size) - size), size)], size


class Pieces:
    """Ids and token bytes of a sentencepiece file that adds the first space itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.space = self.model.piece_to_id("▁")
        self.splits = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode([x[1:] for x in stretches], num_threads=1)
        return _flat([ids if x != " " else [self.space] for x, ids in zip(stretches, found)])


@lru_cache(maxsize=4)
def _both(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


# ------------------------------------------------------------------ stretches
def _spaces_after_text(raw: np.ndarray) -> np.ndarray:
    """Positions of spaces that follow a character other than white space (of Unicode, and of control characters)."""
    at = np.flatnonzero(raw == 0x20)
    at = at[at > 0]
    one, two, three = (raw[np.maximum(at - k, 0)] for k in (1, 2, 3))
    blank = (one == 0x20) | ((one >= 0x09) & (one <= 0x0D)) | ((one >= 0x1C) & (one <= 0x1F))
    blank |= (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    blank |= (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    blank |= (three == 0xE2) & (two == 0x80) & (((one >= 0x80) & (one <= 0x8A)) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    blank |= (three == 0xE2) & (two == 0x81) & (one == 0x9F)
    blank |= (three == 0xE3) & (two == 0x80) & (one == 0x80)
    return at[~blank]


def _spaced(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space before each row that isn't empty."""
    size = np.diff(offs)
    size = size + (size > 0)
    own = np.concatenate([[0], np.cumsum(size)])
    out = np.full(own[-1], 0x20, np.uint8)
    text = np.ones(len(out), bool)
    text[own[:-1][size > 0]] = False
    out[text] = raw
    return out, own


# ------------------------------------------------------------------ galloping
def gallop(ends: np.ndarray, short: np.ndarray, short_end: np.ndarray, long: np.ndarray, long_end: np.ndarray) -> np.ndarray:
    """Position in ``ends`` of the first end of the longer list that is not below, for each element of the shorter.

    Row k of the lists is ends[short[k]:short_end[k]] and
    ends[long[k]:long_end[k]]; both ascend and close with the same end.  All
    rows take their next step together.  Returns positions in the order of the
    rows' shorter lists.
    """
    size = short_end - short
    base = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.int64)
    at, cursor, live = short.copy(), long.copy(), np.flatnonzero(size > 0)
    while len(live) >= TOGETHER:
        target, lo = ends[at[live]], cursor[live].copy()
        last, hi, step = long_end[live] - 1, cursor[live].copy(), np.ones(len(live), np.int64)
        behind = np.flatnonzero(ends[hi] < target)
        while len(behind):  # steps that double
            lo[behind] = hi[behind] + 1
            hi[behind] = np.minimum(hi[behind] + step[behind], last[behind])
            step[behind] *= 2
            behind = behind[ends[hi[behind]] < target[behind]]
        open_ = np.flatnonzero(lo < hi)
        while len(open_):  # halves
            mid = (lo[open_] + hi[open_]) // 2
            below = ends[mid] < target[open_]
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        out[base[live] + at[live] - short[live]] = hi
        cursor[live] = hi
        at[live] += 1
        live = live[at[live] < short_end[live]]
    for k in live.tolist():
        row = ends[long[k]:long_end[k]].tolist()
        where = int(cursor[k] - long[k])
        for i in range(int(at[k]), int(short_end[k])):
            target, step, lo = int(ends[i]), 1, where
            while row[where] < target:
                lo = where + 1
                where = min(where + step, len(row) - 1)
                step *= 2
            where = bisect_left(row, target, lo, where)
            out[base[k] + i - short[k]] = long[k] + where
    return out


def _same(stretches: list[bytes], ids: np.ndarray, size: np.ndarray, table: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, size, and whether each stretch is its tokens' bytes."""
    parts, last = [table[k] for k in ids.tolist()], np.cumsum(size).tolist()
    return ids, size, np.fromiter((b"".join(parts[j - k:j]) == s for s, j, k in zip(stretches, last, size.tolist())), bool, len(stretches))


def _without(ids: np.ndarray, size: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids[~np.repeat(bad, size)], np.where(bad, 0, size)


class Aligned:
    """Stretches' tokens, groups and links: all arrays go by stretch through the pointers beside them."""

    def __init__(self, stretches: list[bytes], a: ByteLevel, b: Pieces):
        text, n = [x.decode() for x in stretches], len(stretches)
        coded = [_same(stretches, *side.encode(text), side.bytes) for side in (a, b)]
        self.good = coded[0][2] & coded[1][2]
        coded = [_without(ids, size, ~self.good) for ids, size, _ in coded]
        self.n_a, self.n_b = coded[0][1], coded[1][1]
        flat, middle = np.concatenate([coded[0][0], coded[1][0]]), len(coded[0][0])
        lengths = [np.fromiter(map(len, side.bytes), np.int64, len(side.bytes))[ids] for side, (ids, _) in zip((a, b), coded)]
        first = np.concatenate([[0], np.cumsum(np.concatenate([self.n_a, self.n_b]))])
        run = np.cumsum(np.concatenate(lengths))
        ends = run - np.repeat(np.concatenate([[0], run])[first[:-1]], np.diff(first))
        lists = np.stack([first[:-1].reshape(2, n), first[1:].reshape(2, n)])  # [begin or end, a or b, stretch]
        drives = (self.n_a > self.n_b).astype(int)  # 0: a is the shorter, or equal
        rows = np.arange(n)
        short, short_end, long, long_end = lists[0, drives, rows], lists[1, drives, rows], lists[0, 1 - drives, rows], lists[1, 1 - drives, rows]
        rank = gallop(ends, short, short_end, long, long_end)
        size = short_end - short
        ptr = np.concatenate([[0], np.cumsum(size)])
        own = np.repeat(rows, size)
        at = np.arange(len(rank)) - ptr[own] + short[own]
        match = ends[rank] == ends[at]
        # a token of the shorter list overlaps from the rank before it (one on, after a shared end) to its own
        begin = np.empty(len(rank), np.int64)
        begin[1:] = rank[:-1] + match[:-1]
        begin[ptr[:-1][size > 0]] = long[size > 0]
        many = rank - begin + 1
        self.link_ptr = np.concatenate([[0], np.cumsum(many)])[ptr]
        left = np.repeat(at, many)
        right = np.arange(len(left)) + np.repeat(begin - (np.cumsum(many) - many), many)
        swap = np.repeat(drives[own], many).astype(bool)
        self.pair = (flat[np.where(swap, right, left)] << 32) | flat[np.where(swap, left, right)]
        hits = np.flatnonzero(match)
        self.n_groups = np.bincount(own[hits], minlength=n)
        common = np.zeros(len(flat), bool)
        common[at[hits]] = common[rank[hits]] = True
        self.groups = self.texts(flat, common, middle)

    def texts(self, flat: np.ndarray, common: np.ndarray, middle: int) -> list[bytes]:
        """Groups of each stretch: common ends slice both sides' ids, in turn."""
        group = np.concatenate([np.cumsum(common[:middle]), np.cumsum(common[middle:])]) - common
        side = np.arange(len(flat)) >= middle
        order = np.argsort(2 * group + side, kind="stable")
        most = int(flat.max(initial=0)) + 1
        table = [f"{k}{sign}" for sign in ",|;" for k in range(most)]
        sign = np.where(common, np.where(side, 2, 1), 0)
        parts = [table[k] for k in (flat + most * sign)[order].tolist()]
        last = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(parts[i:j])[:-1].encode() for i, j in zip([0, *last], last)]


# ------------------------------------------------------------------ slots
_KEEP = ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "sha", "keys", "docs", "held")


def _squeeze(*arrays: np.ndarray) -> bytes:
    data = b"".join(x.astype("<i4").tobytes() for x in arrays)
    return np.array([len(x) for x in arrays], "<i8").tobytes() + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def _unsqueeze(blob: bytes, many: int) -> list[np.ndarray]:
    lengths = np.frombuffer(blob, "<i8", many)
    size = int(lengths.sum()) * 4
    data = np.frombuffer(pa.decompress(blob[8 * many:], size, codec="zstd", asbytes=True) if size else b"", "<i4")
    return np.split(data.astype(np.int64), np.cumsum(lengths)[:-1])


def slot(ids: pa.Array, texts: pa.Array, paths: tuple[str, str]) -> tuple[dict, list[bytes]]:
    """A slot's columns, and the groups' text of each document."""
    a, b = _both(*paths)
    raw, own = _spaced(*K.column_bytes(texts))
    cuts = np.union1d(_spaces_after_text(raw) if a.splits and b.splits else [], own).astype(np.int64)
    parts = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(raw)]).dictionary_encode()
    code = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found = Aligned(parts.dictionary.to_pylist(), a, b)
    ptr = np.searchsorted(cuts, own)  # first stretch of each document
    doc = K.rows_of(ptr)
    bad = np.zeros(len(own) - 1, bool)
    bad[doc[~found.good[code]]] = True
    doc, code = doc[~bad[doc]], code[~bad[doc]]
    rows = len(own) - 1
    links = np.diff(found.link_ptr)
    total = {n: np.bincount(doc, x[code], rows).astype(np.int64) for n, x in (("n_a", found.n_a), ("n_b", found.n_b), ("n_groups", found.n_groups), ("n_links", links))}
    first = np.searchsorted(doc, np.arange(rows + 1))
    names = code.tolist()
    groups = [b";".join([found.groups[k] for k in names[i:j]]) for i, j in zip(first[:-1].tolist(), first[1:].tolist())]
    # distinct pairs of each document, with their links
    keys, number = np.unique(found.pair, return_inverse=True)
    size = links[code]
    at = np.arange(size.sum()) + np.repeat(found.link_ptr[code] - (np.cumsum(size) - size), size)
    held, times = np.unique(np.repeat(doc, size) * max(1, len(keys)) + number[at], return_counts=True)
    pair = held % max(1, len(keys))
    of = np.searchsorted(held // max(1, len(keys)), np.arange(rows + 1))
    there = np.bincount(pair, minlength=len(keys))
    back = np.cumsum(there > 0) - 1  # pairs of documents without tokens go
    step = np.diff(back[pair], prepend=0)
    return {"doc_ids": ids, **total, "sha": [hashlib.sha256(g).hexdigest() if g else "" for g in groups],
            "keys": keys[there > 0], "docs": there[there > 0], "held": _squeeze(of, step, times)}, groups


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of about PIECE bytes."""
    held, size = [], 0

    def both():
        one = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return one.column(0), one.column(1)

    for batch in batches:
        _, offs = K.column_bytes(batch.column(1))
        for i, j in K.segments(offs, PIECE):
            more = int(offs[j] - offs[i])
            if held and size + more > PIECE:
                yield both()
                held, size = [], 0
            held.append(batch.slice(i, j - i))
            size += more
    if held:
        yield both()


def _slots(paths: tuple[str, str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for k, (ids, texts) in enumerate(_texts(batches)):
        x, _ = slot(ids, texts, paths)
        one = [pa.ListArray.from_arrays(pa.array([0, len(x[n])], pa.int32()), x[n] if n == "doc_ids" else pa.array(x[n])) for n in _KEEP[:-1]]
        yield pa.RecordBatch.from_arrays([pa.array([(task << 32) + k]), *one, pa.array([x["held"]], pa.binary())], names=["slot", *_KEEP])


def _groups(paths: tuple[str, str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in _texts(batches):
        _, found = slot(ids, texts, paths)
        yield pa.RecordBatch.from_arrays([ids, pa.array([g.decode() for g in found], pa.string())], names=["doc_id", "groups"])


def _answered(slots: pa.Table, answers: pa.Table) -> pa.Table:
    """Documents of one slot, with the counts of its pairs."""
    row = {n: slots.column(n)[0] for n in _KEEP if n != "docs"}
    count, best = np.zeros(len(row["keys"]), np.int64), np.zeros(len(row["keys"]), np.int64)
    at = answers.column("k").to_numpy()
    count[at], best[at] = answers.column("n").to_numpy(), answers.column("best").to_numpy()
    of, step, times = _unsqueeze(row["held"].as_py(), 3)
    pair = np.cumsum(step)
    run = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[of])
    columns = [row["doc_ids"].values, *(row[n].values for n in ("n_a", "n_b", "n_groups", "n_links")),
               pa.array(run(best[pair] * times)), pa.array(run(count[pair] * times)), row["sha"].values]
    return pa.table(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


# ------------------------------------------------------------------ Spark
def slots(docs: DataFrame, paths: tuple[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each slot, written once: its documents' totals, its id pairs and who holds them."""
    d = pick(docs, doc_id=id_col, text=text_col)
    schema = (f"slot long, doc_ids array<{docs.schema[id_col].dataType.simpleString()}>, n_a array<long>, n_b array<long>, n_groups array<long>, "
              "n_links array<long>, sha array<string>, keys array<long>, docs array<long>, held binary")
    return cut(d.mapInArrow(partial(_slots, paths), schema))


def pair_counts(written: DataFrame) -> DataFrame:
    """key (id of a, times 2**32, and id of b), n (documents), best (1: none of a's pairs has more)."""
    n = written.select(F.inline(F.arrays_zip("keys", "docs"))).groupBy("keys").agg(F.sum("docs").alias("n")).withColumnRenamed("keys", "key")
    a = F.shiftright("key", 32)
    most = n.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return n.join(most, a == most.a).select("key", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def align(docs: DataFrame, paths: tuple[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document."""
    written = slots(docs, paths, id_col, text_col)
    asked = written.select(F.col("slot").alias("to"), F.posexplode("keys").alias("k", "key"))
    counts = pair_counts(written)
    answers = asked.join(counts, "key").select("to", "k", "n", "best")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return written.drop("docs").groupBy("slot").cogroup(answers.groupBy("to")).applyInArrow(_answered, schema)


def groups(docs: DataFrame, paths: tuple[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the groups of each document as text: ids of a|ids of b;..."""
    d = pick(docs, doc_id=id_col, text=text_col)
    return d.mapInArrow(partial(_groups, paths), f"doc_id {docs.schema[id_col].dataType.simpleString()}, groups string")
