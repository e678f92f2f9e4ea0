"""Token counts, the piece codec and packing against the libraries themselves."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featuremill.llm import packing, queries, token_counts
from featuremill.llm.common import public_path, read
from featuremill.llm.packing import ChunkEncoder, plan_windows
from featuremill.llm.piece_codec import PieceCodec, decode_documents, encode_documents
from featuremill.llm.token_counts import PrefixCounter, count_at, longest_within, prefix_counts

from odd_rows import none_at_all, odd  # noqa: F401  (fixtures)


def content(name):
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=public_path("piece_bpe_32k.model"))


COUNTER = PrefixCounter(content("byte_bpe_50k.json"))
CODEC = PieceCodec(content("piece_bpe_32k.model"))
ENCODER = ChunkEncoder(content("byte_bpe_50k.json"))
PARTS = ["a", "the ", "'re", "'ll", "'s", "'l", " ", "  ", "   ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", "　", "é",
         "ß", "日本", "🙂", "▁", "<|endoftext|>", "<|end", "</s>", "<0x0A>", "...", "!!!", "123", "١٢", "​", "\x00", "ab",
         "hello", " world", "ing", "aaaa", "-" * 20, "﻿", "ﬁ", "ș"]
TEXT = st.one_of(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), st.text(max_size=30))


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_count_of_every_prefix(library, text):
    table = COUNTER.table(text)
    want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    assert prefix_counts(table).tolist() == want
    assert [count_at(table, i) for i in range(len(text) + 1)] == want
    for budget in range(max(want) + 2):
        assert longest_within(table, budget) == max(i for i, n in enumerate(want) if n <= budget)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=10))
def test_codec_is_the_library(pieces, text, ids):
    got = CODEC.encode(text).tolist()
    assert got == pieces.encode(text)
    assert CODEC.decode(got) == pieces.decode(got)
    assert CODEC.decode(ids) == pieces.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_ids_by_chunk_are_the_library(library, texts):
    for text, raw in zip(texts, ENCODER.encode_all(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def documents(spark, sf_dir=SF001):
    return {r.doc_id: r.text or "" for r in read(spark, sf_dir, "documents").collect()}


def test_token_count_query(spark, library):
    docs = documents(spark)
    got = queries.op7_token_counts(spark, SF001).collect()
    assert len(got) == len(docs)
    for r in got:
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def test_codec_query(spark, pieces):
    docs = documents(spark)
    got = queries.op10_piece_codec(spark, SF001).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = pieces.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(pieces.decode(ids).encode()).hexdigest()


def test_odd_rows(odd, none_at_all, library, pieces):
    texts = sorted((r.doc_id or -1, r.text or "") for r in odd.collect())
    counted = token_counts.token_prefix_counts(odd, budget=5).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in counted) == sorted(
        (i, len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts)
    back = decode_documents(encode_documents(odd)).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == texts
    assert token_counts.token_prefix_counts(none_at_all).count() == 0
    assert encode_documents(none_at_all).count() == 0
    assert packing.pack(none_at_all).count() == 0
    check_pieces(packing.pack(odd, 64).collect(), 64, None)


def check_pieces(rows, window, docs_ids):
    per_doc, per_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        per_doc[r.doc_id, r.doc_tokens].append(r)
        per_sequence[r.sequence_id].append((r.offset, r.length))
    for own in per_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(per_sequence) == list(range(len(per_sequence)))
    if docs_ids is None:
        return len(per_sequence)
    assert len(per_doc) == len(docs_ids)
    for (doc_id, total), own in per_doc.items():
        ids = docs_ids[doc_id]
        assert total == len(ids)
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:at], "<u4").tobytes())
        assert at == total
    return len(per_sequence)


def test_packing_query(spark, library):
    ids = {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in documents(spark).items()}
    n = check_pieces(queries.op6_pack_windows(spark, SF001).collect(), 2048, ids)
    assert sum(map(len, ids.values())) > 0.97 * 2048 * n


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
def test_plan_uses_up_the_histogram(histogram):
    used = defaultdict(int)
    for lengths, repeats in plan_windows(histogram, 64):
        assert sum(lengths) <= 64 and repeats > 0
        for size in lengths:
            used[size] += repeats
    assert used == histogram


def test_ranks_cover_equal_lengths(spark):
    """A third of the documents have one length: their places differ all the same."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("a b c")).otherwise(
        F.concat(F.lit("w "), F.repeat(F.lit("x "), (F.col("id") % 50).cast("int")))).alias("text"))
    check_pieces(packing.pack(docs.repartition(7), 32).collect(), 32, None)
