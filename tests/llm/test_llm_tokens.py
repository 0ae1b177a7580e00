"""Token counts and BPE against the tokenizer library."""

import hashlib
import random

import llm_brute as brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daygauge.llm import bpe, queries, splitting, token_counts

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "\n\n a", None, "It's <|endoftext|> x<|startoftext|>y  ", "İstanbul ŉ ſ ß \xa0x\x85y", "日本語 テスト 123 ½²",
    "é café ΣΑΣ J̌", "\x1c\x1d a\x1eb", "🙂🙂 !!'s 'll", "'S 'LL don'T", "x" * 5000, "ab" * 3000 + "!?" * 1500,
    "<|endoftext", "\t\tfoo\r\n  bar   ", "\x00\x01 \x7f", "Ⱥ Ⱦ ǅ", "\x00123", "a" + "́" * 900,
]


def odd_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(" \t\n'sabcé1!?\xa0ß<|İ日") for _ in range(rng.randint(0, 200))) for _ in range(n)]


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_pieces_are_the_librarys():
    for text in [*ODD, *odd_texts(1, 300)]:
        found, total = token_counts.document_pieces(text, BYTES)
        own = Tokenizer.from_file(BYTES) if text in ODD else splitting.tokenizer(BYTES)
        total += sum(n * len(own.encode(piece, add_special_tokens=False).ids) for piece, n in found.items())
        assert total == len(own.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("frequent, held", [(0, 10), (5, 3), (200_000, 200_000)])
def test_token_counts_equal_the_library(spark, frequent, held):
    docs, rows = brute.awkward(spark, [*ODD, *odd_texts(2, 40)])
    found = token_counts.token_counts(docs.repartition(3), BYTES, frequent=frequent, held=held).collect()
    want = sorted((str(i), len((t or "").encode()), len(ids_of(BYTES, t))) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == want
    assert token_counts.token_counts(docs.limit(0), BYTES).collect() == []


def test_long_frequent_pieces_reach_all_tasks_as_digests(spark):
    texts = [f"{'x' * 50_000} {'é' * 33} {'é' * 32} word{n}" for n in range(6)]
    docs = brute.frame(spark, [(n, t, None, None, None) for n, t in enumerate(texts)])
    sent = token_counts._frequent(token_counts.piece_table(docs, BYTES, "text"), 200_000).collect()
    assert " word" in {r.piece for r in sent}
    assert all(len((r.piece or "").encode()) <= 64 for r in sent)
    assert sum(r.digest is not None for r in sent) == 3
    found = token_counts.token_counts(docs, BYTES).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in found) == [(n, len(ids_of(BYTES, t))) for n, t in enumerate(texts)]


@pytest.mark.parametrize("leaf", [2, 3, 16, 1024])
def test_joined_halves_equal_the_librarys_encoding(leaf):
    rng = random.Random(leaf)
    texts = [*ODD, *odd_texts(leaf, 60)]
    for _ in range(60):
        letters = "thernd onae"[: rng.randint(3, 9)]
        texts.append("".join(rng.choice(letters) for _ in range(rng.randint(10, 400))))
    own = splitting.tokenizer(WORDS)
    for text in texts:
        if leaf < 10 and text and len(text) > 2000:
            text = text[:300]
        assert bpe.unpack(bpe.encode_text(text, WORDS, leaf)) == own.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("long, part, leaf", [(20, 30, 8), (32_768, 8_192, 1_024)])
def test_encoding_and_decoding_equal_the_library(spark, long, part, leaf):
    docs, rows = brute.awkward(spark, [*(t[:700] if t else t for t in ODD), *odd_texts(3, 30)])
    coded = bpe.encoded(docs, WORDS, text_out="back", long=long, part=part, leaf=leaf)
    assert coded.columns == [*docs.columns, "ids", "back"]
    own = Tokenizer.from_file(WORDS)
    want = sorted((str(i), str(t), ids_of(WORDS, t)) for i, t, *_ in rows)
    found = coded.collect()
    assert sorted((str(r.doc_id), str(r.text), bpe.unpack(r.ids)) for r in found) == want
    again = bpe.decoded(coded, WORDS).collect()
    for r in [*found, *again]:
        assert r.back == own.decode(bpe.unpack(r.ids), skip_special_tokens=False)
    assert all(r.decoded == r.back for r in again)
    assert bpe.encoded(docs.limit(0), WORDS).collect() == []


def test_digests(spark):
    docs, rows = brute.awkward(spark, ["One text, 12!", None, "", "x" * 40_000])
    own = Tokenizer.from_file(WORDS)
    want = []
    for i, t, *_ in rows:
        ids = ids_of(WORDS, t)
        digests = np.array(ids, "<u4").tobytes(), own.decode(ids, skip_special_tokens=False).encode()
        want.append((str(i), len(ids), *(hashlib.sha256(d).hexdigest() for d in digests)))
    found = queries.bpe_digests(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(want)
