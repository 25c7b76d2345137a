"""Quality classifier: a byte-level convolutional network in numpy.

Method: every byte has a learned vector; learned filters run over windows of
``WIDTH`` bytes, every ``HOP`` bytes, through the whole text.  Texts are read
in chunks of two halves that overlap by one half; a filter's value in a chunk
is its maximum there.  The largest and the mean value over all chunks go into
one logistic unit, which gives one probability.

The network is fitted on the driver on at most ``TRAIN_ROWS`` labelled rows
of at most ``TRAIN_BYTES`` each, chosen by a hash of the id: a bound that no
input size changes.  Scoring reads every byte of every text, in tasks that
hold a few megabytes at a time; the model is a few kilobytes.

Defined results: null and empty texts are scored like a text of padding only;
labels that are null, or of ids that no document has, aren't used; an id with
several labels counts once with the larger; without labels of both kinds every
score is the share of label 1 (0.5 without any); equal texts have
scores equal to about 1e-6 (single precision); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import crc_mod, pick

TRAIN_ROWS, TRAIN_BYTES = 5000, 1 << 17
EMBED, WIDTH, HOP, FILTERS, HALF = 4, 8, 4, 24, 128
EPOCHS, BATCH, RATE, SEED = 10, 64, 0.01, 7
SEGMENT = 1 << 20


def layout(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts padded with zero bytes to whole halves, two at least, and the first half of each (and the total)."""
    size = np.diff(offs)
    halves = np.maximum(-(-size // HALF), 2)
    first = np.concatenate([[0], np.cumsum(halves)])
    out = np.zeros(int(first[-1]) * HALF + WIDTH, np.uint8)
    row = K.rows_of(offs)
    out[np.arange(len(raw)) + (first[:-1] * HALF - offs[:-1])[row]] = raw
    return out, first


def start_model(rng) -> dict:
    return {"embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), "filters": rng.normal(0, 0.25, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32), "out": np.zeros(2 * FILTERS, np.float32), "c": np.zeros(1, np.float32)}


def forward(m: dict, data: np.ndarray, first: np.ndarray, places: bool = False, ends: bool = True) -> dict:
    """Everything that a prediction and its gradient need.  ends: the rows end here, so no window may reach past them."""
    vectors = m["embed"][data]
    n = (len(data) - WIDTH) // HOP
    step = vectors.strides[0]
    windows = np.lib.stride_tricks.as_strided(vectors, (n, WIDTH * EMBED), (HOP * step, vectors.strides[1]))
    values = (windows @ m["filters"] + m["bias"]).reshape(-1, HALF // HOP, FILTERS)
    if ends:
        values[first[1:] - 1, -1] = values[first[1:] - 1, -2]
    half = values.max(axis=1)
    best = values.argmax(axis=1) if places else None
    # chunk k of a row: its halves k and k + 1
    rows = len(first) - 1
    left = np.delete(np.arange(first[-1]), first[1:] - 1)
    chunk_from = first[:-1] - np.arange(rows)
    right_wins = half[left + 1] > half[left]
    chunk = np.where(right_wins, half[left + 1], half[left])
    counts = np.diff(first) - 1
    top = np.maximum.reduceat(chunk, chunk_from, axis=0)
    mean = np.add.reduceat(np.maximum(chunk, 0), chunk_from, axis=0) / counts[:, None].astype(np.float32)
    feats = np.concatenate([np.tanh(top), np.tanh(mean)], axis=1)
    z = feats @ m["out"] + m["c"]
    return {"p": 1 / (1 + np.exp(-z.astype(np.float64))), "feats": feats, "windows": windows, "best": best, "left": left, "right_wins": right_wins,
            "chunk": chunk, "top": top, "chunk_from": chunk_from, "counts": counts}


def gradient(m: dict, data: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict:
    f = forward(m, data, first, places=True)
    dz = ((f["p"] - y) / len(y)).astype(np.float32)
    g = {"out": f["feats"].T @ dz, "c": dz.sum(keepdims=True)}
    df = dz[:, None] * m["out"][None, :] * (1 - f["feats"] ** 2)
    d_top, d_mean = df[:, :FILTERS], df[:, FILTERS:] / f["counts"][:, None]
    row = np.repeat(np.arange(len(y)), f["counts"])
    dc = np.where(f["chunk"] > 0, d_mean[row], 0)
    is_top = f["chunk"] == f["top"][row]
    share = np.add.reduceat(is_top, f["chunk_from"], axis=0, dtype=np.float32)
    dc += np.where(is_top, (d_top / share)[row], 0)
    half = f["left"][:, None] + f["right_wins"]
    ch = np.broadcast_to(np.arange(FILTERS), dc.shape)
    # the gradient reaches one window of a chunk for each filter
    window = half * (HALF // HOP) + f["best"][half, ch]
    hit = np.zeros((len(f["windows"]), FILTERS), np.float32)
    np.add.at(hit, (window.ravel(), ch.ravel()), dc.ravel())
    live = np.flatnonzero(hit.any(axis=1))
    hit, seen = hit[live], f["windows"][live]
    g["filters"], g["bias"] = seen.T @ hit, hit.sum(axis=0)
    back = (hit @ m["filters"].T).reshape(len(live), WIDTH, EMBED)
    byte = data[live[:, None] * HOP + np.arange(WIDTH)]
    g["embed"] = np.stack([np.bincount(byte.ravel(), back[:, :, k].ravel(), 256) for k in range(EMBED)], axis=1).astype(np.float32)
    return g


def fit(texts: list[bytes], labels: np.ndarray) -> dict:
    """Fitted network for texts with labels 0/1 (Adam, fixed seed)."""
    rng = np.random.default_rng(SEED)
    m = start_model(rng)
    y = np.asarray(labels, float)
    share = y.mean() if len(y) else 0.5
    if len(y) == 0 or share in (0.0, 1.0):
        m["filters"][:] = 0
        m["c"][:] = 0.0 if len(y) == 0 else (30.0 if share else -30.0)
        return m
    m["c"][:] = np.log(share / (1 - share))
    mean, var, t = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2)), None, 0
    mean, var = mean
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            b = order[at:at + BATCH]
            part = [texts[i] for i in b]
            offs = np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int64)
            data, first = layout(np.frombuffer(b"".join(part), np.uint8), offs)
            g = gradient(m, data, first, y[b])
            t += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k in m:
                mean[k] = 0.9 * mean[k] + 0.1 * g[k]
                var[k] = 0.999 * var[k] + 0.001 * g[k] ** 2
                m[k] = (m[k] - rate * (mean[k] / (1 - 0.9 ** t)) / (np.sqrt(var[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return m


def probabilities(m: dict, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each text; a text longer than a segment is read piece by piece."""
    out = np.empty(len(offs) - 1)
    for i, j in K.segments(offs, SEGMENT):
        if offs[j] - offs[i] <= 2 * SEGMENT:
            data, first = layout(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            out[i:j] = forward(m, data, first)["p"]
        else:
            out[i] = _long(m, raw[offs[i]:offs[j]])
    return np.round(out, 6)


def _long(m: dict, text: np.ndarray) -> float:
    """The same for one long text: pieces share a half, so that every chunk is seen once."""
    top, total, chunks = np.full(FILTERS, -np.inf, np.float32), np.zeros(FILTERS), 0
    halves = -(-len(text) // HALF)
    step = SEGMENT // HALF
    for h in range(0, halves - 1, step):
        last = min(h + step + 1, halves)
        data = np.zeros((last - h) * HALF + WIDTH, np.uint8)
        part = text[h * HALF:last * HALF + WIDTH]
        data[:len(part)] = part
        chunk = forward(m, data, np.array([0, last - h]), ends=last == halves)["chunk"]
        top, total, chunks = np.maximum(top, chunk.max(axis=0)), total + np.maximum(chunk, 0).sum(axis=0), chunks + len(chunk)
    feats = np.concatenate([np.tanh(top), np.tanh(total / chunks)]).astype(np.float32)
    return float(1 / (1 + np.exp(-float(feats @ m["out"] + m["c"][0]))))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, keep: Column | None, id_col: str, text_col: str, rows: int, max_bytes: int) -> list:
    """At most ``rows`` (text, label) of labelled rows, the same ones at each run."""
    lab = labels if keep is None else labels.where(keep)
    lab = lab.where(lab[label_col].isNotNull() & lab[id_col].isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).cast("int").alias("label"))
    lab = lab.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    d = pick(docs, doc_id=id_col, text=text_col).where(F.octet_length(F.coalesce("text", F.lit(""))) <= max_bytes)
    # a broadcast of at most ``rows`` ids
    d = d.join(F.broadcast(lab), d.doc_id == lab.label_id).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")
    return [(r["text"].encode(), r["label"]) for r in d.orderBy("doc_id", "text").limit(2 * rows).collect()]


def train(docs: DataFrame, labels: DataFrame, keep: Column | None = None, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES) -> dict:
    got = sample(docs, labels, label_col, keep, id_col, text_col, rows, max_bytes)
    return fit([t for t, _ in got], np.array([y for _, y in got]))


def _scores(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = probabilities(shared.value, *K.column_bytes(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    return pick(docs, doc_id=id_col, text=text_col).mapInArrow(partial(_scores, shared), f"doc_id {kind}, score double")


def accept(docs: DataFrame, model: dict, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """docs whose score is at least ``least``, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(texts):
        import pandas as pd
        return pd.Series(probabilities(shared.value, *K.column_bytes(pa.array(texts, pa.string()))))

    return docs.where(F.pandas_udf(rate, "double")(docs[text_col]) >= least)


def training_rows(labels: DataFrame, id_col: str = "doc_id") -> Column:
    """The split of the query: labels of a third of the ids are held out."""
    return crc_mod(labels[id_col], 3) != 1


def report(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
