import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.tokens import TextEncoder, encoder, tokenizer_path
from tests.llm.fixtures import SF_DIR, no_docs, odd_docs

ODD_TEXTS = [
    "", "  a  b\n\n c ", "x<|endoftext|> y  <|endoftext|>", "don't we'll 's 'S", "a b　 c \n d",
    "\x1c a\x1f b", "tab\t\t x\r\n y", "a\0 b", " " * 3000, "ab" * 9000, "é" * 700 + " ̀x",
]


def test_ids_are_those_of_the_defining_library():
    defining = Tokenizer.from_file(tokenizer_path())
    for text in ODD_TEXTS:
        want = defining.encode(text, add_special_tokens=False).ids
        assert encoder(tokenizer_path()).ids(text).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text_gets_the_defining_ids(text):
    tokens: TextEncoder = encoder(tokenizer_path())
    assert tokens.ids(text).tolist() == tokens._defining.encode(text, add_special_tokens=False).ids


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= length]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - length)
        else:
            rooms.append(capacity - length)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_equals_best_fit_over_single_pieces(lengths):
    slots = packing.plan_slots(Counter(lengths), 40)
    used = defaultdict(list)
    placed = Counter()
    for length, first, last, sequence, offset in slots:
        placed[length] += last - first + 1
        for i in range(last - first + 1):
            used[sequence + i].append((offset, length))
    assert placed == Counter(lengths)
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 40
    assert len(used) == best_fit_decreasing(lengths, 40)


def test_plan_does_not_grow_with_the_counts():
    few = packing.plan_slots({n: 100 for n in range(1, 2049)}, 2048)
    many = packing.plan_slots({n: 10**9 for n in range(1, 2049)}, 2048)
    assert len(many) < 2 * len(few) < 50_000


def check_packed(packed, docs, capacity):
    defining = Tokenizer.from_file(tokenizer_path())
    pieces = defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append(r)
    for doc_id, text in docs.items():
        ids = np.array(defining.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r.start == at and 0 < r.length <= capacity
            assert r.piece == 0 or r.length == capacity
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) == best_fit_decreasing([r.length for r in packed], capacity)


@pytest.mark.parametrize("capacity", [2048, 100])
def test_packs_whole_documents(spark, capacity):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id < 150")
    packed = packing.pack(spark, docs, capacity).collect()
    check_packed(packed, {r.doc_id: r.text for r in docs.collect()}, capacity)


def test_odd_documents(spark):
    packed = packing.pack(spark, odd_docs(spark)).collect()
    firsts = Counter(r.doc_id for r in packed if r.piece == 0)
    assert firsts == {1: 1, 2: 1, 3: 1, 4: 1, 5: 2, 6: 1, None: 2, 7: 1, 8: 1, 9: 1}
    assert {r.length for r in packed if r.doc_id in (1, 2)} == {1}
    assert sum(r.length for r in packed if r.doc_id == 7) > 2048
    assert packing.pack(spark, no_docs(spark)).collect() == []
