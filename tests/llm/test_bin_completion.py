import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from souk.llm import bin_completion as B
from souk.llm import kernel as K
from souk.llm.queries import op12_bin_completion

PATH, SF = P.path("word_bpe_49k.json"), "/root/testdata/sf0.001"
ODD = ["", "a b　c  d", "<|endoftext|> x<|startoftext|>y", "é ́x ΑΣ ΟΔΟΣ. İ", "don't\tit's\x0b\x0c'll \x1cA\x85B", "x" * 5000, "日本語 テキスト 12345", "ÅÅ Å ﬁ", " \n ", "tail ", "Abc12,34-De f(x)=<|startoftext|> A1's don'T x_y__z...", "H̱ ẖ \x00a\x7fb", "<a> b<c 9 10 a.b'll"]


def encode(texts):
    from tokenizers import Tokenizer
    return [x.ids + [0] for x in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def fewest(items, capacity):
    """Fewest sequences: every piece into every open one, or a new one."""
    best, items = [len(items)], sorted(items, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins) if b + items[i] <= capacity}.values():
            bins[j] += items[i]
            go(i + 1, bins)
            bins[j] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_fewest_sequences_against_brute_force():
    r, better = random.Random(1), 0
    for _ in range(1500):
        capacity = r.choice([10, 20, 30, 50])
        low, high = r.choice([(1, capacity), (capacity // 6 + 1, capacity // 2 + 1)])
        items = [r.randrange(low, high + 1) for _ in range(r.randrange(1, 13))]
        search = B.Completion(Counter(items), capacity)
        start, packed, want = len(search.best), search.solve(), fewest(items, capacity)
        assert Counter(x for b in packed for x in b) == Counter(items) and all(sum(b) <= capacity for b in packed)
        assert search.bound <= want == len(packed)
        better += start > want
    assert better  # best-fit alone isn't enough


def test_triples_that_best_fit_misses():
    """Triples that fill 1000 exactly: the search finds the perfect packing, best-fit doesn't."""
    r, items = random.Random(4), []
    for _ in range(12):
        a = r.randrange(380, 490)
        b = r.randrange(260, 1000 - a - 250)
        items += [a, b, 1000 - a - b]
    search = B.Completion(Counter(items), 1000, 2_000_000)
    assert len(search.best) > 12 and len(search.solve()) == 12


def test_spent_search_keeps_the_incumbent():
    items = Counter(np.random.default_rng(1).integers(500, 1100, 3000).tolist())
    search = B.Completion(items, 2048, 1000)
    packed = search.solve()
    assert len(packed) <= len(B.best_fit(items, 2048)) and Counter(x for b in packed for x in b) == items


def test_dominated_fillings_go():
    search = B.Completion(Counter([9, 5, 4, 3, 1]), 14)
    search.take(9)
    assert list(search.fillings(5, 0, 0))[0] == (5,)  # 4+1 and 3+1 give way to 5
    assert (4, 1) not in list(search.fillings(5, 0, 0))


def test_token_ids_are_those_of_whole_texts():
    raw, offs = K.column_bytes(pa.array(ODD))
    ids, ptr = B.token_ids(raw, offs, PATH)
    assert [ids[a:b].tolist() for a, b in zip(ptr, ptr[1:])] == encode(ODD)


def test_token_ids_of_random_texts():
    r = random.Random(6)
    signs = "aAzZ09éÉñÿŸſİ×÷ıŉ \t\n.,'<|>_-$é日\u0301\u00a0\x1c😀s"
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(0, 60))) for _ in range(3000)]
    ids, ptr = B.token_ids(*K.column_bytes(pa.array(texts)), PATH)
    assert [ids[a:b].tolist() for a, b in zip(ptr, ptr[1:])] == encode(texts)


def check(rows, out, capacity=B.CAPACITY):
    """Every row is there in its pieces, whole, and every sequence is gapless and not too long; returns its sequences."""
    want = Counter()
    for (i, _), ids in zip(rows, encode([t for _, t in rows])):
        for p, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            want[i, p, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in out) == want
    at = defaultdict(list)
    for x in out:
        at[x.sequence_id].append((x.offset, x.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return at


@pytest.mark.parametrize("shard", [B.SHARD, 20])
def test_round_trip(spark, shard):
    r = random.Random(3)
    rows = [(k, t) for k, t in enumerate([None, *ODD])] + [(None, "no id"), (None, "no id"), (2, "same id"), (2, "other")]
    rows += [(100 + k, "word " * r.randrange(1, 9000)) for k in range(40)] + [(200, "same row")] * 60
    df = spark.createDataFrame([(*x, "clash", 7) for x in rows], "doc_id long, text string, shard string, length int").repartition(3)
    packed = B.pack(df, PATH, shard=shard, with_ids=True)
    out = packed.collect()
    at = check(rows, out)
    total = sum(x.length for x in out)
    assert len(at) <= -(-total // B.CAPACITY) + (1 if shard == B.SHARD else len(out) // 10)
    whole = {x.sequence_id: x.ids for x in B.sequences(packed).collect()}
    for x in out:
        assert whole[x.sequence_id][x.offset:x.offset + x.length] == x.ids


def test_empty_table(spark):
    assert B.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query(spark):
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    df = op12_bin_completion(spark, SF)
    assert df.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    out = df.collect()
    at = check(rows, out)
    assert len(at) == -(-sum(x.length for x in out) // B.CAPACITY)  # no packing has fewer
