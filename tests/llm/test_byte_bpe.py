import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cabmill.llm import byte_bpe

PIECES = ["the", "a", " ", "  ", "\n", "\t", "\r\n", "é", "é", "ﬁ", "梦", "\x00", "<|endoftext|>", "🙂", ".",
          " ,", "1", "١", "ing", "İ", " ", " ", "don't", "I'LL", "x'y", "�", "\U0010ffff", "ñezll", "!!", "\x1c"]


def texts(n, seed=3):
    rng = random.Random(seed)
    out = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    letters = "".join(rng.choice("abcdefghijé") for _ in range(30_000))
    return out + ["", " ", "a", " " * 5000, "ab " * 3000, "q" * 9000, letters, "\x00" * 400]


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def path(request):
    return public_tokenizers.path(request.param)


def library(path):
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library(path, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 300)  # generations change
    own, want, sample = byte_bpe.ByteBpe(path, public_tokenizers.PATTERN), library(path), texts(1200)
    for text, packed in zip(sample, own.encode_all(sample), strict=True):
        ids = np.frombuffer(packed, "<u4").tolist()
        assert ids == want.encode_ordinary(text)
        assert own.decode(ids) == text.encode()
    assert own.decode([1, 50256]) is None and own.decode([1, None]) is None


def test_long_texts_are_taken_in_runs(monkeypatch):
    monkeypatch.setattr(byte_bpe, "TOGETHER", 200)
    monkeypatch.setattr(byte_bpe, "TAKEN", 7)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own, want, sample = byte_bpe.ByteBpe(path, public_tokenizers.PATTERN), library(path), texts(300, 5)
    got = [np.frombuffer(x, "<u4").tolist() for x in own.encode_all(sample)]
    assert got == [want.encode_ordinary(t) for t in sample]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000, 7777])
def test_perfect_hash(n):
    rng = random.Random(n)
    keys = list({bytes(rng.randrange(256) for _ in range(rng.randint(1, 9))) for _ in range(n)})
    table = byte_bpe.PerfectHash(keys)
    assert sorted(table.find(keys)) == list(range(len(keys)))
    others = [k + b"!" for k in keys if k + b"!" not in set(keys)] + [b"x" * 100]
    assert set(table.find(others)) == {-1}
    with pytest.raises(ValueError):
        byte_bpe.PerfectHash([b"a", b"b", b"a"])


def test_digests(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    sample, want = texts(60), library(path)
    rows = [(i, t, "x") for i, t in enumerate(sample)] + [(None, None, "x"), (0, sample[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = byte_bpe.encoding_digests(docs, path, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "" if r.doc_id is None else sample[r.doc_id]
        ids = want.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.encoding_digests(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_columns_there_and_back(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.createDataFrame([(1, "a é", "k"), (None, None, "l"), (1, "a é", "k")], "`doc.id` long, text string, x string")
    encoded = byte_bpe.encode_texts(docs, path, pattern)
    assert encoded.columns == ["doc.id", "x", "ids"]
    back = byte_bpe.decode_ids(encoded, path, pattern).collect()
    assert sorted((r["doc.id"] or 0, r.x, bytes(r.decoded)) for r in back) == [(0, "l", b""), *[(1, "k", "a é".encode())] * 2]
    odd = spark.createDataFrame([([1, None],), (None,), ([-1],), ([70_000],), ([],)], "ids array<int>")
    assert [r.decoded for r in byte_bpe.decode_ids(odd, path, pattern).collect()] == [None] * 4 + [b""]
    with pytest.raises(ValueError):
        byte_bpe.encode_texts(docs.withColumnRenamed("x", "ids"), path, pattern)


def test_bytes_that_are_no_text(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    got = byte_bpe.encoding_digests(docs, path, pattern).first()
    assert got.decoded_sha256 == hashlib.sha256("a�b".encode()).hexdigest()
