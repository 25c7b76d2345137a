"""Toxicity by a chain of linear classifiers.

Method: the categories are predicted one after another.  The model of each is
linear in the words of a text and in the probabilities of the categories
before it; those it was trained on are out-of-fold predictions (a row's
probability comes from a model that never saw the row), so that later links
learn what the earlier ones are worth on new texts.

Words are letters and digits in lower case, present or absent in a text.  A
link uses the words that tell its category apart best (by the z score of
their counts in its training rows, ``LEAST_Z`` or more).  All links together are fitted on the
driver on at most ``TRAIN_ROWS`` labelled rows of at most ``TRAIN_BYTES``,
chosen by a hash of the id; scoring reads every word of every text.

The categories of the query are the labels the corpus has: low quality first,
then toxic.

Defined results: a null or empty text has no words; labels that are null, or
of ids that no document has, aren't used; an id with several labels counts
once, with the larger of each; a category with one kind of label only gets
its share as probability (0 without labels); equal texts have equal scores;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm import kernel as K
from souk.llm.common import crc_mod, pick

TRAIN_ROWS, TRAIN_BYTES = 8000, 1 << 17
WORDS, LEAST_Z, FOLDS, STEPS, RIDGE = 1000, 3.0, 4, 800, 1e-5
#: Categories in the chain's order, from columns of labels.
CATEGORIES = {"low_quality": lambda labels: 1 - labels["quality"], "toxic": lambda labels: labels["toxic"]}
SEGMENT = 1 << 22


def word_sets(raw: np.ndarray, offs: np.ndarray):
    """(row, word) of each row's distinct words, in order."""
    raw = K.LOWER[raw]
    starts, stops, first = K.word_bounds(raw, offs, K.NOT_ALNUM)
    ids, row = K.word_ids(raw, starts, stops), K.rows_of(first)
    order = np.lexsort((ids, row))
    ids, row = ids[order], row[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (row[1:] != row[:-1])
    return row[new], ids[new]


@dataclass
class Link:
    """One category's model: sorted word identifiers with weights, weights of earlier categories, constant."""

    name: str
    words: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    constant: float

    def predict(self, row: np.ndarray, ids: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
        z = np.full(n, self.constant) + earlier @ self.earlier
        if len(self.words) and len(ids):
            at = np.minimum(np.searchsorted(self.words, ids), len(self.words) - 1)
            hit = self.words[at] == ids
            z += np.bincount(row[hit], self.weights[at[hit]], n)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_link(name: str, row: np.ndarray, ids: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> Link:
    """Words by z score, then logistic regression with a ridge (accelerated gradient steps)."""
    n, share = len(y), float(y.mean()) if len(y) else 0.0
    none = np.zeros(0)
    if share in (0.0, 1.0):
        return Link(name, none.astype(np.uint64), none, np.zeros(earlier.shape[1]), 30.0 if share else -30.0)
    u, inv = np.unique(ids, return_inverse=True)
    seen, pos = np.bincount(inv, minlength=len(u)), np.bincount(inv, y[row], len(u))
    z = (pos - seen * share) / np.sqrt(seen * share * (1 - share) + 1)
    best = np.argsort(-np.abs(z), kind="stable")[:WORDS]
    best = np.sort(best[np.abs(z[best]) >= LEAST_Z])
    place = np.full(len(u), -1)
    place[best] = np.arange(len(best))
    col = place[inv]
    r, c = row[col >= 0], col[col >= 0]
    w, v, extra, ve = np.zeros(len(best)), np.zeros(len(best)), np.zeros(earlier.shape[1]), np.zeros(earlier.shape[1])
    b = vb = np.log(share / (1 - share))
    size = 0.25 * (np.bincount(r, minlength=n).max(initial=0) + 1 + (earlier ** 2).sum(axis=1).max(initial=0))
    # the step that the largest curvature allows, by power iteration
    x = np.ones(len(best))
    for _ in range(20):
        q = np.bincount(c, np.bincount(r, x[c], n)[r], len(best))
        size, x = min(size, max(np.linalg.norm(q) / max(np.linalg.norm(x), 1e-30) / n * 0.25 + 0.5, 1e-3)), q / max(np.linalg.norm(q), 1e-30)
    rate = 1 / (size + RIDGE)
    for t in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(r, v[c], n) + earlier @ ve + vb, -500, 500)))
        d = (p - y) / n
        nw, ne, nb = v - rate * (np.bincount(c, d[r], len(best)) + RIDGE * v), ve - rate * (earlier.T @ d + RIDGE * ve), vb - rate * d.sum()
        k = t / (t + 3)
        v, ve, vb = nw + k * (nw - w), ne + k * (ne - extra), nb + k * (nb - b)
        w, extra, b = nw, ne, nb
    return Link(name, u[best], w, extra, float(b))


def fit_chain(texts: list[bytes], labels: dict[str, np.ndarray]) -> list[Link]:
    """One link for each category, in the order given."""
    n = len(texts)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    row, ids = word_sets(np.frombuffer(b"".join(texts), np.uint8), offs)
    fold = np.arange(n) % FOLDS
    earlier, chain = np.zeros((n, 0)), []
    for name, y in labels.items():
        y = np.asarray(y, float)
        chain.append(fit_link(name, row, ids, earlier, y))
        out = np.zeros(n)
        for k in range(FOLDS):
            train = np.flatnonzero(fold != k)
            place = np.full(n, -1)
            place[train] = np.arange(len(train))
            m = place[row] >= 0
            link = fit_link(name, place[row[m]], ids[m], earlier[train], y[train])
            out[fold == k] = link.predict(row, ids, n, earlier)[fold == k]
        earlier = np.column_stack([earlier, out])
    return chain


def predict_chain(chain: list[Link], raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Probabilities (rows, categories)."""
    out = np.zeros((len(offs) - 1, len(chain)))
    for i, j in K.segments(offs, SEGMENT):
        row, ids = word_sets(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        for k, link in enumerate(chain):
            out[i:j, k] = link.predict(row, ids, j - i, out[i:j, :k])
    return out


def train(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES) -> list[Link]:
    """The chain, fitted on the labelled rows that keep allows."""
    lab = labels if keep is None else labels.where(keep)
    cols = {k: f(lab) for k, f in categories.items()}
    known = lab[id_col].isNotNull()
    for c in cols.values():
        known &= c.isNotNull()
    lab = lab.where(known).groupBy(F.col(id_col).alias("label_id")).agg(*[F.max(c).cast("int").alias(f"y_{k}") for k, c in cols.items()])
    lab = lab.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    d = pick(docs, doc_id=id_col, text=text_col).where(F.octet_length(F.coalesce("text", F.lit(""))) <= max_bytes)
    # a broadcast of at most ``rows`` ids
    got = d.join(F.broadcast(lab), d.doc_id == lab.label_id).orderBy("doc_id", "text").limit(2 * rows).collect()
    return fit_chain([(r["text"] or "").encode() for r in got], {k: np.array([r[f"y_{k}"] for r in got], float) for k in categories})


def _rates(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chain = shared.value
    for batch in batches:
        p = predict_chain(chain, *K.column_bytes(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p[:, k]) for k in range(len(chain))]], names=["doc_id", *[f"p_{c.name}" for c in chain]])


def score(docs: DataFrame, chain: list[Link], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and p_<category>, the probability of each category, of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"p_{c.name} double" for c in chain]])
    return pick(docs, doc_id=id_col, text=text_col).mapInArrow(partial(_rates, shared), schema)


def training_rows(labels: DataFrame, id_col: str = "doc_id") -> Column:
    """The split of the query: labels of a third of the ids are held out."""
    return crc_mod(labels[id_col], 3) != 1


def report(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "p_low_quality", F.col("p_toxic").alias("score"),
                         (F.col("p_toxic") >= 0.5).cast("int").alias("predicted"), (F.col("p_toxic") >= 0.5).alias("toxic"))
