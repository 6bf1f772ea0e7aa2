"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import pytest
from conftest import SF

from trolley.llm import byte_pairs as B
from trolley.llm._common import table


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    import tiktoken

    ranks = B.read_ranks(B.default_ranks())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_slices_of_random_texts_are_those_of_the_library(reference):
    random.seed(5)
    letters = [*"aesTtrvlmd'' \n\t  12.,!-\x00\x1c\x85 é日𝒳٣²", "'s", "'re", "'ve", "'ll", "ʼn"]
    texts = ["".join(random.choices(letters, k=random.randint(0, 60))) for _ in range(4000)]
    texts += ["", "'", "'s", "a's'", "  ", " \n", "'\x00s", "x" * 3000, "ab" * 5000, " " * 300, "<|endoftext|>"]
    texts.append("".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000))
    got = B.encode_texts(texts, B.SliceCache(B.default_ranks()))
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        ends = B.token_ends(ids, B.default_ranks())
        assert B.decode_ids(ids.astype(np.int64), ends, B.default_ranks()) == text.encode()


def test_scan_of_blocks_equals_a_plain_scan():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 4097, 5000):
        kinds = rng.integers(0, 9, n)
        state, expected = 0, []
        for kind in kinds:
            expected.append(state)
            state = int(B.STEP[kind, state])
        assert B.FUNCTIONS[B._before(B.OF_CLASS[kinds]), B.FRESH].tolist() == expected


def test_a_full_cache_and_small_groups_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(B, "KEPT", 3)
    monkeypatch.setattr(B, "GROUP", 7)
    texts = ["one two three's four", "", "zzqqxx kkjjww zzqqxx", "y" * 100 + " one"]
    cache = B.SliceCache(B.default_ranks())
    for _ in range(3):
        assert [x.tolist() for x in B.encode_texts(texts, cache)] == [reference.encode_ordinary(t) for t in texts]


def test_offsets_of_another_vocabulary_are_refused():
    with pytest.raises(ValueError):
        B.decode_ids(np.array([5, 6]), np.array([1, 5]), B.default_ranks())


def test_round_trip_of_whole_documents(spark, reference):
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r for r in B.round_trip_digests(docs).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    assert rows.keys() == texts.keys()
    for k, text in texts.items():
        ids = np.array(reference.encode_ordinary(text), dtype="<u4")
        assert rows[k]["n_tokens"] == len(ids)
        assert rows[k]["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert rows[k]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows_and_empty_tables(spark):
    shape = "doc_id long, text string, ids string, ends int, n_tokens string"
    rows = [(1, None, "x", 1, "y"), (None, "a b", None, None, None), (2, "", "x", 1, "y"), (2, "", "x", 1, "y"), (3, "q " * 200_000, "", 0, "")]
    got = B.round_trip_digests(spark.createDataFrame(rows, shape)).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["decoded_sha256"] == nothing) for r in got)[:4] == [
        (0, 2, False), (1, 0, True), (2, 0, True), (2, 0, True),
    ]
    assert B.round_trip_digests(spark.createDataFrame([], shape)).collect() == []
