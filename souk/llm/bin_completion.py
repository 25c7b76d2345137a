"""Best-fit packing by bin completion.

Documents become token ids and an end id, and only those longer than a
sequence are cut.  Pieces are dealt to shards of about ``SHARD`` pieces by
hash, and each shard is packed by itself (its last sequences may be part full:
at most one sequence a shard over what one packing of all could need, where
the shard reaches its bound).

Method (a shard): best-fit decreasing gives the incumbent.  Branch and bound
then closes one sequence a node: the largest piece left opens it, and its
fillings from the lengths left are tried with the least waste first.  A
filling is left out if another dominates it: some of its pieces could give
way to one larger piece that is still there.  A filling is pruned if the waste
so far and its own exceed what a packing no worse than the incumbent may waste.
The search ends at the lower bound (total tokens, large pieces), when nothing
is left to try, or after ``STEPS`` fillings looked at; what it has then is
valid and at least as good as best-fit.

Pieces of one length are interchangeable, so a shard is solved on its at most
``CAPACITY`` distinct lengths, whatever the number of copies.

Defined results: a null or empty text is its end id alone; rows of one id and
equal rows are packed each; null ids stay null; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import cut, pick

CAPACITY, END = 2048, 0
#: Pieces in a shard (by hash: about), and fillings that its search looks at.
SHARD, STEPS = 16384, 500_000
#: Bytes of text that are tokenised together (or one longer document).
PIECE = 8 << 20


# ------------------------------------------------------------------ tokens
#: Classes of bytes: letters together (beyond ASCII: those of U+00C0 to U+017F), each digit by itself, other signs together.
KIND = np.full(256, 3, np.uint8)
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
KIND[[*range(0x30, 0x3A)]] = 2
#: Words with one of these bytes, or with other characters beyond ASCII, are left to the tokenizer whole.
WHOLE = np.zeros(256, bool)
WHOLE[[ord("'"), ord("<"), *range(0x00, 0x09), *range(0x0E, 0x20), 0x7F]] = True
#: The byte-level alphabet's characters for the bytes that aren't themselves in it, from U+0100 on in the order of the bytes.
SHIFTED = {chr(b): chr(0x100 + k) for k, b in enumerate([*range(0x00, 0x21), *range(0x7F, 0xA1), 0xAD]) if b >= 0x80}
#: Words in one call of the tokenizer, and words whose ids a Python worker keeps (then it starts anew).
CALL, KEPT = 4096, 1 << 19


def _byte_level(text: str) -> str:
    text = text.encode().decode("latin-1")
    for a, b in SHIFTED.items():
        text = text.replace(a, b)
    return text


class WordPieces:
    """A word-level BPE file (lower case, word ends, white space dropped)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        # words of letters, in lower case, need neither normalizing nor splitting: the same model on words between blanks
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[k for token, k in vocab.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each word's ids begin in them, how many they are) of words of letters."""
        if len(self.known) > KEPT:
            self.forget()
        new = [w for w in words if w not in self.known]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        calls = [" ".join(new[i:i + CALL]).lower() for i in range(0, len(new), CALL)]
        ids = [np.array(self.bare.encode(c if c.isascii() else _byte_level(c), add_special_tokens=False).ids, np.uint32) for c in calls]
        flat = np.concatenate([np.zeros(0, np.uint32), *ids])
        self.flat = np.concatenate([self.flat, flat])
        self.size = np.concatenate([self.size, np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)])
        at = np.fromiter((self.known[w] for w in words), np.int64, len(words))
        return self.flat, (np.cumsum(self.size) - self.size)[at], self.size[at]

    def others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(words), CALL):
            coded = [x.ids for x in self.whole.encode_batch_fast(words[i:i + CALL], add_special_tokens=False)]
            size.append(np.fromiter(map(len, coded), np.int64, len(coded)))
            ids.append(np.fromiter((k for x in coded for k in x), np.uint32, int(size[-1].sum())))
        return np.concatenate(ids), np.concatenate(size)


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> WordPieces:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
    return WordPieces(path)


def _strange(raw: np.ndarray) -> np.ndarray:
    """Bytes that leave their word whole: those of WHOLE, and of characters beyond ASCII but for the letters of U+00C0 to U+017F.

    Those are letters, are their own normal form and have one lower-case
    character each, all but U+00D7, U+00F7 and U+0130.
    """
    out = WHOLE[raw]
    at = np.flatnonzero(raw >= 0x80)
    if len(at):
        lead = at[(raw[at] >= 0xC3) & (raw[at] <= 0xC5)]
        two = raw[np.minimum(lead + 1, len(raw) - 1)]
        odd = ((raw[lead] == 0xC3) & ((two == 0x97) | (two == 0xB7))) | ((raw[lead] == 0xC4) & (two == 0xB0))
        fine = np.zeros(len(raw) + 1, bool)
        fine[lead[~odd]] = True
        fine[lead[~odd] + 1] = True
        out[at] = ~fine[at]
    return out


def _units(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that are encoded by themselves, first stretch of each row, and which are letters only.

    The tokenizer drops white space, so no token crosses it.  A word without
    strange bytes is cut further, as the tokenizer's own pattern cuts it:
    letters, single digits, other signs.
    """
    starts, stops, _ = K.word_bounds(raw, offs, K.BLANK)
    if not len(starts):
        return starts, stops, np.zeros(len(offs), np.int64), np.zeros(0, bool)
    whole = np.logical_or.reduceat(_strange(raw), starts)
    kind = KIND[raw]
    edge = np.ones(len(raw), bool)
    edge[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    edge &= ~K.BLANK[raw]
    edge[:starts[0]] = False
    edge[starts[0]:] &= ~np.repeat(whole, np.diff(starts, append=len(raw)))
    edge[starts] = True
    begin = np.flatnonzero(edge)
    word = np.searchsorted(starts, begin, "right") - 1
    end = np.minimum(np.append(begin[1:], len(raw)), stops[word])
    return begin, end, np.searchsorted(begin, offs), (kind[begin] == 1) & ~whole[word]


def token_ids(raw: np.ndarray, offs: np.ndarray, path: str, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows with an end id after each, first id of each row and the total); each distinct stretch is encoded once."""
    begin, stop, first, letters = _units(raw, offs)
    at = np.concatenate([[0], np.cumsum(stop - begin)])
    units = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(raw[~K.BLANK[raw]])]).dictionary_encode()
    code = units.indices.to_numpy(zero_copy_only=False)
    plain = np.zeros(len(units.dictionary), bool)
    plain[code] = letters
    coder = _tokenizer(path)
    order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
    words = units.dictionary.take(pa.array(order)).to_pylist()
    n = int(plain.sum())
    (one, at_one, size_one), (two, size_two) = coder.letters(words[:n]), coder.others(words[n:])
    flat = np.concatenate([one, two])
    at, size = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    at[order] = np.concatenate([at_one, len(one) + np.cumsum(size_two) - size_two])
    size[order] = np.concatenate([size_one, size_two])
    size, at = size[code], at[code]
    before = np.concatenate([[0], np.cumsum(size)])
    ids = flat[np.arange(before[-1]) + np.repeat(at - before[:-1], size)]
    ptr = before[first] + np.arange(len(first))
    out = np.full(ptr[-1], end, np.uint32)
    inside = np.ones(len(out), bool)
    inside[ptr[1:] - 1] = False
    out[inside] = ids
    return out, ptr


def _pieces(path: str, capacity: int, with_ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        raw, offs = K.column_bytes(batch.column(1))
        for a, b in K.segments(offs, PIECE):
            ids, ptr = token_ids(raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a], path)
            many = -(-np.diff(ptr) // capacity)
            row = np.repeat(np.arange(b - a), many)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            start = piece * capacity
            length = np.minimum(capacity, np.diff(ptr)[row] - start)
            data, at = ids.astype("<u4"), ptr[row] + start
            crc = [zlib.crc32(data[i:i + n].data) for i, n in zip(at.tolist(), length.tolist())]
            columns = [batch.column(0).slice(a, b - a).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                       pa.array(crc, pa.int64()), pa.array((task << 40) + seen + np.arange(len(row)))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "rid"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
            seen += len(row)


# ------------------------------------------------------------------ packing of one shard
def _low(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Best-fit decreasing: the fullest sequence in which a piece fits takes it."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = defaultdict(list)
    open_ = 0  # bit r is set if a sequence has room r
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = open_ >> length
            if fits:
                r = length + _low(fits)
                at = room[r].pop()
                if not room[r]:
                    open_ ^= 1 << r
            else:
                r, at = capacity, len(bins)
                bins.append([])
            bins[at].append(length)
            if r > length:
                room[r - length].append(at)
                open_ |= 1 << (r - length)
    return [tuple(b) for b in bins]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: all tokens, and for each k the pieces that fit with none of length k or more."""
    lengths = np.array(sorted(counts), np.int64)
    number = np.array([counts[x] for x in lengths.tolist()], np.int64)
    n, total = np.concatenate([[0], np.cumsum(number)]), np.concatenate([[0], np.cumsum(number * lengths)])

    def upto(x) -> np.ndarray:
        return np.searchsorted(lengths, x, "right")

    half = upto(capacity // 2)
    k = np.concatenate([[0], lengths[:half]])
    big = upto(capacity - k)
    first = np.searchsorted(lengths, k)
    middle, room = n[big] - n[half], (n[big] - n[half]) * capacity - (total[big] - total[half])
    rest = np.maximum(0, -(-(total[half] - total[first] - room) // capacity))
    return int((n[-1] - n[big] + middle + rest).max(initial=0))


class _Spent(Exception):
    """The search has looked at as many fillings as it may."""


class Completion:
    """Branch and bound over one shard's lengths."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS):
        self.capacity, self.steps = capacity, steps
        self.left = dict(counts)
        self.bits = sum(1 << x for x in counts)  # bit x: length x is left
        self.mirror = sum(1 << (capacity - x) for x in counts)  # bit capacity - x
        self.total = sum(x * n for x, n in counts.items())
        self.bound = lower_bound(counts, capacity)
        self.best = best_fit(counts, capacity)
        self.limit = len(self.best)  # sequences that a packing may have to be taken

    def take(self, length: int) -> None:
        self.left[length] -= 1
        if not self.left[length]:
            self.bits ^= 1 << length
            self.mirror ^= 1 << (self.capacity - length)

    def give(self, length: int) -> None:
        if not self.left[length]:
            self.bits |= 1 << length
            self.mirror |= 1 << (self.capacity - length)
        self.left[length] += 1

    def exact(self, total: int, top: int, alone: bool = True) -> Iterator[tuple[int, ...]]:
        """Multisets of lengths left with sum total and no length above top, fewest large ones first."""
        self.steps -= 1
        if self.steps < 0:
            raise _Spent
        if total == 0:
            if alone:
                yield ()
            return
        if alone and total <= top and self.left.get(total, 0):
            yield (total,)
        # pairs (x, total - x): lengths left and their mirror image agree at bit x
        below = (1 << (min(top, total - 1) + 1)) - 1
        pairs = self.bits & (self.mirror >> (self.capacity - total)) & below & ~((1 << ((total + 1) // 2)) - 1)
        while pairs:
            x = pairs.bit_length() - 1
            pairs ^= 1 << x
            if 2 * x != total or self.left[x] > 1:
                yield x, total - x
        most = total - 2 * _low(self.bits) if self.bits else 0
        larger = self.bits & ((1 << (min(top, most) + 1)) - 1) if most > 0 else 0
        while larger:
            x = larger.bit_length() - 1
            larger ^= 1 << x
            if 3 * x < total and not self.left_within(total, x):
                return
            self.take(x)
            for rest in self.exact(total - x, x, alone=False):
                self.give(x)  # whoever gets the filling finds all lengths as they were
                yield (x, *rest)
                self.take(x)
            self.give(x)

    def left_within(self, total: int, top: int) -> bool:
        """Whether lengths up to top could still sum to total."""
        have, bits = 0, self.bits & ((1 << (top + 1)) - 1)
        while bits and have < total:
            x = bits.bit_length() - 1
            bits ^= 1 << x
            have += x * self.left[x]
        return have >= total

    def dominated(self, filling: tuple[int, ...], waste: int) -> bool:
        """A larger piece that is left could take the place of some of the filling's pieces.

        Looked at are each piece and pair, and every choice of at most six
        pieces; others are kept, which costs time but loses nothing.
        """
        for x in filling:
            self.take(x)
        try:
            sizes = range(1, len(filling) + 1) if len(filling) <= 6 else (1, 2)
            for many in sizes:
                for some in set(combinations(filling, many)):
                    least = sum(some) + (many == 1)
                    if self.bits >> least & ((1 << (sum(some) + waste - least + 1)) - 1):
                        return True
            return False
        finally:
            for x in filling:
                self.give(x)

    def fillings(self, room: int, bins: int, waste: int) -> Iterator[tuple[int, ...]]:
        """Undominated fillings of the room, least waste first, while the waste bound holds."""
        own = 0
        while own <= room and waste + own <= self.limit * self.capacity - self.total and bins + 1 <= self.limit:
            for filling in self.exact(room - own, room - own):
                if not self.dominated(filling, own):
                    yield filling
            own += 1

    def solve(self) -> list[tuple[int, ...]]:
        """Sequences as tuples of lengths."""
        stack: list[tuple[Iterator, int, int]] = []  # fillings to try, opening length, waste before
        path: list[tuple[int, ...]] = []
        if not self.bits:
            return []

        def open_(waste: int) -> None:
            largest = self.bits.bit_length() - 1
            self.take(largest)
            stack.append((self.fillings(self.capacity - largest, len(path), waste), largest, waste))

        try:
            open_(0)
            while stack:
                tries, largest, waste = stack[-1]
                filling = next(tries, None)
                if filling is None:
                    stack.pop()
                    self.give(largest)
                    if path:
                        for x in path.pop()[1:]:
                            self.give(x)
                    continue
                for x in filling:
                    self.take(x)
                path.append((largest, *filling))
                if self.bits:
                    open_(waste + self.capacity - largest - sum(filling))
                    continue
                self.best = list(path)
                self.limit = len(path) - 1
                if len(path) <= self.bound:
                    break
                for x in path.pop()[1:]:
                    self.give(x)
        except _Spent:
            pass
        return self.best


def _pack(capacity: int, steps: int, batch: pa.Table) -> pa.Table:
    """Sequence and offset of each piece of a shard."""
    length, rid = batch.column("length").to_numpy(), batch.column("rid").to_numpy()
    shard = batch.column("shard")[0].as_py()
    sizes, number = np.unique(length, return_counts=True)
    packed = Completion(dict(zip(sizes.tolist(), number.tolist())), capacity, steps).solve()
    flat = np.array([x for b in packed for x in b], np.int64)
    in_bin = np.repeat(np.arange(len(packed)), [len(b) for b in packed])
    run = np.cumsum(flat) - flat
    offset = run - run[np.searchsorted(in_bin, in_bin)]
    # places and pieces of one length pair up in order
    place, piece = np.lexsort((in_bin, flat)), np.lexsort((rid, length))
    sequence, at = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    sequence[piece], at[piece] = in_bin[place], offset[place]
    out = batch.drop_columns(["shard", "rid"])
    return out.append_column("sequence_id", pa.array((shard << 32) + sequence)).append_column("offset", pa.array(at))


# ------------------------------------------------------------------ Spark
def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, rid (and ids) of each piece; written once, so that rid stays."""
    d = pick(docs, doc_id=id_col, text=text_col)
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, rid long"
    return cut(d.mapInArrow(partial(_pieces, path, capacity, with_ids), schema + (", ids array<int>" if with_ids else "")))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, shard: int = SHARD, steps: int = STEPS, with_ids: bool = False, **columns) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of each piece."""
    cut_up = pieces(docs, path, capacity, with_ids, **columns)
    shards = max(1, -(-cut_up.count() // shard))
    dealt = cut_up.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)))
    kept = [f for f in cut_up.schema.fields if f.name != "rid"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    return dealt.groupBy("shard").applyInArrow(lambda table: _pack(capacity, steps, table), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each training sequence; packed comes with ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
