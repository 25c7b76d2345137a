"""Substring dedup: remove the words of every fixed-length window that occurs twice.

Method: Rabin-Karp hashes of every window of ``width`` words, from prefix sums
of word identifiers times powers of a fixed odd base modulo 2**64, then mixed.
Spark counts them (``runs``): windows that neighbour each other and share
their least 8-word gram are counted together where all they cover is equal
and one by one where a repeated passage begins or ends.  Repeated windows
merge into maximal removal intervals.

Defined results: a null text has no words; fewer than ``width`` words lose
nothing; repeated rows are occurrences like any other, so all of them go; an
empty table gives no rows; other columns are ignored.
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

GRAM = 8
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of each window of ``width`` identifiers."""
    n = len(ids)
    if n < width:
        return np.zeros(0, np.uint64)
    powers, inverse = K._powers(_BASE, n), K._powers(_INVERSE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(ids * powers, out=sums[1:])
    m = n - width + 1
    return K.mix((sums[width:] - sums[:m]) * inverse[:m])


def _units(raw: np.ndarray, offsets: np.ndarray):
    starts, stops, first = K.word_bounds(raw, offsets, K.BLANK)
    return K.word_ids(raw, starts, stops), first


def _identify(width: int, ids: np.ndarray):
    return rolling(ids, min(GRAM, width)), rolling(ids, width)


def task(width: int) -> Task:
    return Task(units=_units, identify=partial(_identify, width), window=width, gram=min(GRAM, width), first_stays=False)


_OUT = "doc_id long, n_words long, spans array<struct<start:int,end:int>>, kept string"


def _cut(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        raw, offs = K.column_bytes(batch.column(1))
        ro, lo, cnt = covered(batch.column(2))
        n_words, spans, kept = [], [], []
        for r in range(batch.num_rows):
            words = raw[offs[r]:offs[r + 1]].tobytes().split()
            a, b = lo[ro[r]:ro[r + 1]], cnt[ro[r]:ro[r + 1]]
            s, e = K.merged(a, a + b + (width - 1))
            n_words.append(len(words))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e)])
            rest, at = [], 0
            for x, y in zip(s.tolist(), e.tolist()):
                rest += words[at:x]
                at = y
            kept.append(b" ".join(rest + words[at:]) if len(s) else b" ".join(words))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary()).cast(pa.string())],
                                         names=["doc_id", "n_words", "spans", "kept"])


def remove_repeats(docs: DataFrame, width: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, spans (maximal removed word runs), kept (kept words joined by one space) of each row."""
    found = covered_windows(pick(docs, doc_id=id_col, text=text_col), task(width))
    return found.mapInArrow(partial(_cut, width), _OUT)


def report(removed: DataFrame) -> DataFrame:
    """Counts and digest of what remove_repeats returned."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return removed.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
