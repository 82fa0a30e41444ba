import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from riskloom.llm import packing
from riskloom.llm.queries import QUERIES, TOKENIZER
from riskloom.llm.tables import read
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return t


def expected(tokenizer, rows, capacity=1024):
    out = Counter()
    for doc_id, text in rows:
        ids, start = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for k, n in enumerate(packing.piece_lengths(len(ids), capacity)):
            out[doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
            start += n
    return out


def check(rows, wanted, capacity=1024):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_sample_is_packed_tightly(spark, sample, tokenizer):
    docs = [(r.doc_id, r.text) for r in read(spark, sample, "documents").collect()]
    rows = QUERIES["op8_best_fit_packing"](spark, sample).collect()
    bins = check(rows, expected(tokenizer, docs))
    assert bins <= 1.01 * -(-sum(r.length for r in rows) // 1024) + 1


def test_awkward_texts(spark, make_docs, awkward, tokenizer):
    rows = [*enumerate(awkward), (None, None), (3, "again"), (3, "again"), (77, "a  b\n\n c \t d <|endoftext|>  e")]
    check(packing.pack_documents(make_docs(rows), TOKENIZER).collect(), expected(tokenizer, rows))


def test_empty_table(spark, make_docs):
    assert packing.pack_documents(make_docs([]), TOKENIZER).count() == 0


def test_cached_chunks_give_the_same_ids(spark, sample, tokenizer):
    texts = [r.text for r in read(spark, sample, "documents").limit(200).collect()]
    for keep in (1_000_000, 10):
        encoder = packing.ChunkEncoder(TOKENIZER, keep)
        for a in range(0, 200, 50):
            ids, at = encoder.encode(pa.array(texts[a : a + 50]))
            for k, text in enumerate(texts[a : a + 50]):
                assert ids[at[k] : at[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_local_search_empties_bins():
    # 6+4 and 7+3 fit exactly; a bad start needs three bins and a move or an exchange.
    start = Counter({(6, 3): 1, (7,): 1, (4,): 1})
    found = packing.local_search(start, 10)
    assert found == Counter({(6, 4): 1, (7, 3): 1})
    two = packing.local_search(Counter({(5, 4): 1, (3, 2): 1, (6,): 1}), 10)
    assert sum(two.values()) == 2


def test_local_search_ends_where_no_step_is_left():
    random = np.random.default_rng(3)
    for _ in range(300):
        capacity = int(random.integers(10, 60))
        start = Counter()
        for _ in range(int(random.integers(2, 12))):
            pieces, room = [], capacity
            while room and random.random() < 0.7:
                pieces.append(int(random.integers(1, room + 1)))
                room -= pieces[-1]
            if pieces:
                start[tuple(sorted(pieces, reverse=True))] += int(random.integers(1, 5))
        found = packing.local_search(start, capacity)
        held = lambda plan: sum((Counter({x: n * p.count(x) for x in set(p)}) for p, n in plan.items()), Counter())
        assert held(found) == held(start)
        least = -(-sum(sum(p) * n for p, n in start.items()) // capacity)
        assert least <= sum(found.values()) <= sum(start.values())
        assert packing.improve(Counter(found), capacity, least) == 0


def test_pieces_of_many_lengths_take_part_in_exchanges():
    many = tuple([3] * 80 + [1] * 5)  # more than 64 pieces, few lengths
    assert {n for n, _ in packing._options(many)} == {0, 1, 2, 3, 4, 6}


def test_plan_keeps_every_piece():
    random = np.random.default_rng(1)
    counts = Counter(random.integers(1, 1025, 5_000).tolist())
    start = packing.best_fit(counts, 1024)
    found = packing.local_search(start, 1024)
    held = Counter()
    for pattern, times in found.items():
        assert sum(pattern) <= 1024
        for x in pattern:
            held[x] += times
    assert held == counts
    assert sum(found.values()) <= sum(start.values())
