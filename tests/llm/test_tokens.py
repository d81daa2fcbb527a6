"""Word encoder, token files and packing against the library itself."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from firmweave.llm import packing, token_files
from firmweave.llm.tokens import WordEncoder
from tests.llm.conftest import ODD, invented

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text, end):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_words_give_the_ids_of_the_text(library):
    rng = np.random.default_rng(1)
    texts = [t for _, t in ODD] + [invented(rng, 300, "abcdeéßñü!?&$"), "12.5 __a_ don't a\xa0b  Σς é é"]
    found = WordEncoder(PATH).encode_all(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == ids_of(library, text, 0)[:-1].tolist()


def test_a_full_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr("firmweave.llm.tokens.CACHE_WORDS", 20)
    encoder, rng = WordEncoder(PATH), np.random.default_rng(2)
    for _ in range(5):
        text = invented(rng, 40)
        assert np.frombuffer(encoder.encode_all([text])[0], "<u2").tolist() == ids_of(library, text, 0)[:-1].tolist()


@pytest.mark.parametrize("top", [1, 200, 255, 256, 70_000, 2**24, 2**32 - 1])
def test_codes_round_trip(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 3, 4, 1001):
        ranks = rng.integers(0, top, n, endpoint=True).astype(np.uint32)
        assert (token_files.decode_block(*token_files.encode_block(ranks), n) == ranks).all()


def test_files_give_back_every_document_in_order(spark, docs, library, uri, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 500)
    rng = np.random.default_rng(3)
    rows = ODD + [(i, invented(rng, int(rng.integers(0, 90)))) for i in rng.permutation(40).tolist()]
    token_files.write_tokens(docs(rows), uri("t"), PATH)
    full = token_files.read_tokens(spark, uri("t")).orderBy("start").collect()
    short = {r.start: r for r in token_files.read_tokens(spark, uri("t"), digests=True).collect()}
    expected = Counter((d, ids_of(library, t, 2).tobytes()) for d, t in rows)
    assert Counter((r.doc_id, bytes(r.ids)) for r in full) == expected
    at, last = 0, -1
    for r in full:
        assert r.start == at and r.n_tokens * 4 == len(r.ids) and short[at].ids_crc32 == zlib.crc32(r.ids)
        assert (-1 if r.doc_id is None else r.doc_id) >= last
        at, last = at + r.n_tokens, -1 if r.doc_id is None else r.doc_id


def test_files_of_no_documents(spark, docs, uri):
    token_files.write_tokens(docs([]), uri("t"), PATH)
    assert token_files.read_tokens(spark, uri("t")).count() == 0


def test_patterns_hold_every_length_once():
    rng = random.Random(1)
    for _ in range(300):
        size = rng.choice([16, 64, 2048])
        lengths = {rng.randint(1, size): rng.choice([1, 2, 5, 1000, 10**9]) for _ in range(rng.randint(0, 60))}
        held = Counter()
        for count, pattern in packing.pack_histogram(lengths, size):
            assert count > 0 and sum(n * times for n, times in pattern) <= size
            for n, times in pattern:
                held[n] += count * times
        assert held == Counter(lengths)


def test_packing_loses_no_id_and_leaves_no_gap(docs, library):
    rng = np.random.default_rng(4)
    rows = ODD + [(i, invented(rng, int(rng.integers(0, 60)))) for i in range(60)] + [(i, "the same words") for i in range(100, 160)]
    packed = packing.pack(docs(rows), PATH, size=64)
    found = packed.collect()
    pieces = {}
    for r in found:
        ids = np.frombuffer(r.ids, "<u2")
        assert r.length == len(ids) <= 64 and r.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in pieces.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(pieces) == list(range(len(pieces)))
    expected = Counter()
    for d, t in rows:
        ids = ids_of(library, t, 1)
        for start in range(0, len(ids), 64):
            expected[d, start, ids[start : start + 64].astype("<u2").tobytes(), len(ids)] += 1
    assert Counter((r.doc_id, r.start, bytes(r.ids), r.doc_tokens) for r in found) == expected
    for r in packing.sequences(packed, size=64).collect():
        assert len(r.ids) == 2 * (r.used if r.used & (r.used - 1) == 0 else 64)


def test_packing_of_no_documents(docs):
    assert packing.pack(docs([]), PATH).count() == 0


def test_a_vocabulary_without_word_ends_goes_to_the_library():
    other = public_tokenizers.path("byte_bpe_50k.json")
    texts = [t for _, t in ODD] + ["Upper CASE and  two blanks\nline"]
    encoder, whole = WordEncoder(other), Tokenizer.from_file(other)
    assert not encoder.by_word and WordEncoder(PATH).by_word
    assert encoder.encode_all(texts) == [np.array(whole.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


def test_utf8_bytes_have_the_ids_of_their_text():
    encoder = WordEncoder(PATH)
    texts = ["Plain WORDS and, marks! 12 a1b", "déjà vu ÀB,\x85x\xa0y 日本語 \U0001f600", "", None, "again Plain vu plain", "ſ ß İ don't"]
    found = encoder.encode_all([t.encode() if t is not None else None for t in texts])
    whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == whole
    assert encoder.encode_all(texts) == found
