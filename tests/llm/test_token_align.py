import hashlib
import json
import random

import public_tokenizers as P
import pytest

from souk.llm import token_align as T
from souk.llm.queries import op13_token_align

PATHS = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"


def tokens(text):
    """Bytes and ids of both sides' tokens, whole text at once."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PATHS[1])
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_b = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
    return ids_a, [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a], ids_b, bytes_b


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(rows):
    docs, holds = [], {}
    for i, text in rows:
        whole = (" " + text).encode() if text else b""
        a, pa_, b, pb = tokens(text) if text else ([], [], [], [])
        if b"".join(pa_) != whole or b"".join(pb) != whole:
            a, pa_, b, pb = [], [], [], []
        sa, sb = spans(pa_), spans(pb)
        links = [(a[x], b[y]) for x in range(len(a)) for y in range(len(b)) if sa[x][0] < sb[y][1] and sb[y][0] < sa[x][1]]
        for pair in set(links):
            holds[pair] = holds.get(pair, 0) + 1
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        for e in common:
            groups.append(",".join(str(k) for k, s in zip(a, sa) if low <= s[0] < e) + "|" + ",".join(str(k) for k, s in zip(b, sb) if low <= s[0] < e))
            low = e
        docs.append((i, len(a), len(b), groups, links))
    most = {}
    for (x, _), n in holds.items():
        most[x] = max(most.get(x, 0), n)
    return sorted([(i, na, nb, len(g), len(ln), sum(holds[p] == most[p[0]] for p in ln), sum(holds[p] for p in ln),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, na, nb, g, ln in docs], key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "tail  ", "\n\nx \n y", "don't it's\t\tgo", "x" * 700, "日本語のテキスト 漢字", "a  b 　 c",
       "▁ raw ▁mark", "<s> </s> <unk> <|endoftext|> <0x41>", "emoji 🙂🙂 é é", "1234567 12.5%", "  line\x85 end \x1c \x1f x", "tab\t space", "A" * 50 + " " + "b" * 3]


def test_against_brute_force(spark):
    r = random.Random(5)
    words = ["alpha", "beta", "naïve", "don't", "x1y2", "über", "  ", "\n", "—", "the", "re-use", "日本", "\t", "🙂"]
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "null id"), (3, "same id"), (3, "same id")]
    rows += [(100 + k, " ".join(r.choice(words) for _ in range(r.randrange(1, 40)))) for k in range(60)]
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, groups_sha256 string, slot int").repartition(3)
    assert got(T.align(df, PATHS)) == brute(rows)


def test_small_slots_equal_large_ones(spark, monkeypatch):
    import pyarrow as pa
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    ids = pa.array(range(len(docs)), pa.int64())
    whole, text = T.slot(ids, pa.array(docs), PATHS)
    for k, d in enumerate(docs):
        one, alone = T.slot(ids[k:k + 1], pa.array([d]), PATHS)
        assert alone[0] == text[k] and one["sha"][0] == whole["sha"][k] and one["n_links"][0] == whole["n_links"][k]


@pytest.mark.parametrize("together", [1, 16, 10 ** 9])
def test_gallop_is_a_lower_bound(monkeypatch, together):
    import numpy as np
    monkeypatch.setattr(T, "TOGETHER", together)
    r = np.random.default_rng(1)
    ends, edges = [], []
    for _ in range(200):
        last = int(r.integers(5, 400))
        for n in (int(r.integers(0, 8)), int(r.integers(8, 200))):
            x = np.unique(np.append(r.integers(1, last, n), last))
            edges.append((len(ends), len(ends) + len(x)))
            ends += x.tolist()
    ends, edges = np.array(ends), np.array(edges)
    s, l = edges[::2], edges[1::2]
    out = T.gallop(ends, s[:, 0], s[:, 1], l[:, 0], l[:, 1])
    want = [l[k, 0] + np.searchsorted(ends[l[k, 0]:l[k, 1]], ends[i]) for k in range(len(s)) for i in range(s[k, 0], s[k, 1])]
    assert out.tolist() == want


def test_quick_path_equals_the_file_s_own():
    a = T.ByteLevel(PATHS[0])
    assert a.quick
    r = random.Random(8)
    signs = "abcdeghilmnorstuvABEST0123456789 .,'-_()/\\\n\t\x1c\x1f\x7f\x00"
    words = [" " + "".join(r.choice(signs) for _ in range(r.randrange(0, 40))) for _ in range(20000)]
    ids, size = a.encode(words)
    assert a.quick and ids.tolist() == [k for x in a.tokenizer.encode_batch(words, add_special_tokens=False) for k in x.ids]


def test_empty_table_and_string_ids(spark):
    assert T.align(spark.createDataFrame([], "doc_id long, text string"), PATHS).count() == 0
    df = spark.createDataFrame([("k1", "one two"), ("k2", None)], "doc_id string, text string")
    assert [x[0] for x in got(T.align(df, PATHS))] == ["k1", "k2"]
    assert dict(T.groups(df, PATHS).collect())["k2"] == ""


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    small = sorted(rows, key=lambda x: len(x[1] or ""))[:120]
    df = spark.createDataFrame(small, "doc_id long, text string").repartition(2)
    assert got(T.align(df, PATHS)) == brute(small)
    out = op13_token_align(spark, SF)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert out.count() == len(rows)
    assert json.dumps(sorted(x[0] for x in out.select("doc_id").collect())) == json.dumps(sorted(x[0] for x in rows))
