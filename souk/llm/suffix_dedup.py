"""Suffix dedup: remove every byte of a long string that an earlier document has too.

Method: bucket-pointer refinement.  Suffixes are dealt to machines by the
least 20-byte string of a window (``runs``), named by a hash that all
machines agree on, so that no machine needs a global ranking; long repeats
meet there run by run and are settled.  The suffixes of what is left (the
edges of repeats) travel as bytes and are sorted where they meet
(``refined``): buckets of equal first eight bytes, ordered, each suffix with
a pointer to its bucket; a bucket is refined by sorting its suffixes on the
pointers of later offsets (8, then 16, then 18 further), the finer pointers
serve the next level, and a suffix alone in its bucket isn't sorted again.
After 50 bytes, suffixes in one bucket start with the same string.

Defined results: a null text is empty; a text shorter than ``length`` loses
nothing; rows with equal doc_id don't cover each other; a null doc_id counts
as later than all others; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import pick
from souk.llm.runs import Task, covered, covered_windows

GRAM = 20


def _units(raw: np.ndarray, offsets: np.ndarray):
    return raw, offsets


def deepen(names: np.ndarray, have: int, depth: int) -> np.ndarray:
    """Names at ``depth`` bytes from names at ``have`` bytes (have < depth <= 2 * have)."""
    step = depth - have
    return K.pair(names[:-step], names[step:])


def _identify(length: int, units: np.ndarray):
    n = len(units)
    if n < length:
        z = np.zeros(0, np.uint64)
        return z, z
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = units
    names = np.ndarray((n - 7,), "<u8", padded, 0, (1,)).astype(np.uint64)  # the first eight bytes themselves
    have, grams = 8, None
    while have < length:
        if grams is None and 2 * have >= GRAM:
            two = names if have == GRAM else deepen(names, have, GRAM)
            grams = two
        depth = min(2 * have, length)
        names, have = deepen(names, have, depth), depth
    return grams, names


def refined(length: int, units: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The bucket, ``length`` bytes deep, of the suffixes at ``starts``: equal for equal strings.

    A bucket's pointer is the place of its first suffix in sorted order.
    """
    n, depths = len(units), [8]
    while depths[-1] < length:
        depths.append(min(2 * depths[-1], length))
    steps = [b - a for a, b in zip(depths, depths[1:])]
    # what each level sorts: the suffixes of the next one, and those whose pointers refine them
    levels = [np.zeros(n, bool)]
    levels[0][starts] = True
    for step in reversed(steps):
        later = levels[0].copy()
        later[step:] |= levels[0][:n - step]
        levels.insert(0, later)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = units
    order = np.flatnonzero(levels[0])
    key = np.ndarray((n,), ">u8", padded, 0, (1,))[order].astype(np.uint64)
    by = np.argsort(key)
    order, key = order[by], key[by]
    pointer = np.empty(n, np.int64)
    pointer[order] = _places(np.append(True, key[1:] != key[:-1]))
    for step, level in zip(steps, levels[1:]):
        order = order[level[order]]
        bucket = pointer[order]
        head = np.append(True, bucket[1:] != bucket[:-1])
        slots = np.flatnonzero(~(head & np.append(head[1:], True)))
        suffixes = order[slots]
        key = bucket[slots] * n + pointer[suffixes + step]
        by = np.argsort(key)
        order[slots], key = suffixes[by], key[by]
        head[slots] = np.append(True, key[1:] != key[:-1])[:len(key)]
        pointer[order] = _places(head)
    return pointer[starts].astype(np.uint64)


def _places(head: np.ndarray) -> np.ndarray:
    """For each suffix in sorted order the place where its bucket starts."""
    return np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))


def task(length: int) -> Task:
    if length < GRAM:
        raise ValueError(f"length is at least {GRAM} bytes")
    return Task(units=_units, identify=partial(_identify, length), window=length, gram=GRAM, first_stays=True, refine=partial(refined, length))


_OUT = "doc_id long, text string, spans array<struct<start:int,end:int>>, kept binary"


def _cut(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        raw, offs = K.column_bytes(batch.column(1))
        ro, lo, cnt = covered(batch.column(2))
        starts, ends, sizes, kept = [], [], [], []
        for r in range(batch.num_rows):
            text = raw[offs[r]:offs[r + 1]]
            a, b = lo[ro[r]:ro[r + 1]], cnt[ro[r]:ro[r + 1]]
            s, e = K.merged(a, a + b + (length - 1))
            starts.append(s)
            ends.append(e)
            sizes.append(len(s))
            if len(s):
                gone = np.zeros(len(text) + 1, np.int8)
                gone[s] += 1
                gone[e] -= 1
                kept.append(text[np.cumsum(gone[:-1]) == 0].tobytes())
            else:
                kept.append(text.tobytes())
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate([*starts, np.zeros(0)]).astype(np.int32)), pa.array(np.concatenate([*ends, np.zeros(0)]).astype(np.int32))],
                                          fields=list(kind.value_type))
        spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans.cast(kind), pa.array(kept, pa.binary())], names=["doc_id", "text", "spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, spans (maximal removed byte runs), kept (remaining bytes) of each row."""
    found = covered_windows(pick(docs, doc_id=id_col, text=text_col), task(length))
    return found.mapInArrow(partial(_cut, length), _OUT)


def report(removed: DataFrame) -> DataFrame:
    """Counts and digest of what remove_repeats returned."""
    return removed.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        (F.octet_length("text") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
