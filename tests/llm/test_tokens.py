import hashlib
import random
import string
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from cabmill.llm import packing, piece_encode, word_bpe
from cabmill.llm.word_bpe import WordIds

WORDS = ["the", "a", " ", "  ", "\n", "\t", "▁", "é", "é", "ﬁ", "梦", "\x00", "<s>", "</s>", "<|endoftext|>",
         "🙂", ".", " ,", "1", "ing", "İ", " ", "don't", "x▁y", "Σ", "<0x0A>", "x" * 60]


def texts(n, seed=1):
    rng = random.Random(seed)
    out = ["".join(rng.choice(WORDS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return out + ["", " ", "a", "▁" * 300, "ab " * 3000, "q" * 5000]


@pytest.fixture(scope="module")
def word_path():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def piece_path():
    return public_tokenizers.path("piece_bpe_32k.model")


def test_word_ids_equal_the_library(word_path, monkeypatch):
    own = WordIds(word_path)
    assert own._direct
    odd = ["ΟΔΟΣ", "Σ", "σας", "e\u0301te\u0301", "ǅ", "x²", "ª", "ﬀ", "ẞtraße", "İstanbul", "ЖДАЛ!", "ñandú.,;", "a\u200db", "한국어", "ÀÉ--", "don't", "ſ"]
    sample = texts(600) + odd + [a + b for a in odd for b in odd]
    for t, packed in zip(sample, own.all_ids([t.encode() for t in sample]), strict=True):
        want = own._tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == want, t
    # The same while generations change.
    monkeypatch.setattr(word_bpe, "KEPT_WORDS", 50)
    monkeypatch.setattr(word_bpe, "KEPT_RUNS", 30)
    for t in sample[:200]:
        packed, = own.all_ids([t.encode()])
        assert np.frombuffer(packed, "<u4").tolist() == own._tokenizer.encode(t, add_special_tokens=False).ids
    # And for every letter of its own, however it is lower-cased or composed.
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha() and not 0x3400 < c < 0x9FFF and not 0xAC00 < c < 0xD7A0 and c < 0x20000]
    found = own._tokenizer.encode_batch_fast([f"a{c}b" for c in letters], add_special_tokens=False)
    for c, e, packed in zip(letters, found, own.all_ids([f"a{c}b".encode() for c in letters]), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == e.ids, hex(ord(c))


def test_words_of_a_large_vocabulary_are_encoded_once(word_path, monkeypatch):
    own, encoded = WordIds(word_path), []
    encode = own._encode
    monkeypatch.setattr(own, "_encode", lambda runs: (encoded.append(len(runs)), encode(runs)))
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(letters[i // 26**k % 26] for k in range(4)) for i in range(250_000)]
    batches = [{w.encode() for w in words[at : at + 10_000]} for at in range(0, len(words), 10_000)]
    for batch in batches * 2:
        own.learn(batch)
    assert sum(encoded) == len(words) + 1  # and the empty rest of a word


def test_letters_before_any_marks_are_merged_alone(word_path, monkeypatch):
    own, whole = WordIds(word_path), []
    encode = own._whole
    monkeypatch.setattr(own, "_whole", lambda runs: (whole.extend(runs), encode(runs))[1])
    marks = [a + b for a in string.punctuation for b in ["", *string.punctuation]] + ["***", "'.", "...'", "__", "|>"]
    texts = [f"dog{m} DOG{m}\u2003x ñandú{m}" for m in marks] + ["dogs's dog<|endoftext|> <|endoftext|>. '' 's'"]
    for t, packed in zip(texts, own.all_ids([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == own._tokenizer.encode(t, add_special_tokens=False).ids, t
    assert not [w for w in whole if w.startswith("dog") and w[3:] in marks]


def test_ids_do_not_depend_on_what_is_held_together(word_path, monkeypatch):
    own, sample = WordIds(word_path), [*texts(300), "", " \x0b a\x1cb \x0c"]
    want = [own._tokenizer.encode(t, add_special_tokens=False).ids for t in sample]
    column = pa.array([None, *(t.encode() for t in sample)], pa.binary())
    for rows, taken, words in (7, 1, 3), (50, 100, 1000), (1000, 10, 10**6):
        monkeypatch.setattr(word_bpe, "_ROWS", rows)
        monkeypatch.setattr(word_bpe, "_TAKEN", taken)
        monkeypatch.setattr(word_bpe, "KEPT_WORDS", words)
        got = [np.frombuffer(x, "<u4").tolist() for x in own.all_ids(column)]
        assert got == [[], *want]


def test_packing_covers_every_id_once(spark, word_path):
    rows = [(i, t, "x") for i, t in enumerate(texts(120))] + [(None, "no id", "x"), (1000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    got = packing.pack_documents(docs, word_path, tiers=(16, 64, 128)).collect()
    tokenizer = WordIds(word_path)._tokenizer
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, text, _ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 128 and at & (at - 1) == 0 and {r.tier for r in s} == {at}
    cost = defaultdict(int)
    for r in got:
        cost[r.tier, r.step_group] += r.length
    assert packing.pack_documents(docs.limit(0), word_path).count() == 0


def test_repeated_rows_are_packed_each(spark, word_path):
    docs = spark.createDataFrame([(5, "the same text")] * 3, "doc_id long, text string").coalesce(1)
    got = packing.pack_documents(docs, word_path).collect()
    assert sum(r.length for r in got) == 3 * got[0].doc_tokens


def test_pieces_equal_the_library(piece_path):
    own = piece_encode.PieceEncoder(piece_path)
    sample = [t.encode() for t in texts(1500)]
    for text, (ids, starts, ends) in zip(sample, own.encode_all(sample), strict=True):
        assert ids.tolist() == own.library.encode(text.decode())
        if len(ids):
            assert starts[0] == 0 and ends[-1] == len(text)
            assert ((starts[1:] == ends[:-1]) | (starts[1:] == starts[:-1])).all()
            spelled = [own.library.id_to_piece(int(i)) for i in ids]
            for piece, a, b in zip(spelled, starts.tolist(), ends.tolist(), strict=True):
                if not piece.startswith("<0x"):
                    # The first piece also holds the prefix mark, which has no source.
                    source = text[a:b].decode().replace(" ", "▁")
                    assert piece == source or (a == 0 and piece == "▁" + source)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_character_map_equals_the_library(rule):
    from sentencepiece import SentencePieceNormalizer, sentencepiece_model_pb2

    library, model = SentencePieceNormalizer(rule_name=rule), sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    own, rng = piece_encode.Normalizer(model.normalizer_spec), random.Random(2)
    letters = [*WORDS[:-1], "Ⅳ", "①", "ｱ", "ﾞ", "　", "㍿"]
    for _ in range(600):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        out, source = own(text.encode())
        assert out.decode() == library.normalize(text)
        assert len(source) == len(out) and (np.diff(source) >= 0).all()


def test_digests(spark, piece_path):
    sample = texts(60)
    rows = [(i, t, "x") for i, t in enumerate(sample)] + [(None, None, "x"), (0, sample[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = piece_encode.encoding_digests(docs, piece_path).collect()
    library = piece_encode.encoder(piece_path).library
    assert len(got) == len(rows) and all(r.tiled for r in got)
    for r in got:
        ids = [1, *library.encode("" if r.doc_id is None else sample[r.doc_id]), 2]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    encoded = piece_encode.encode_texts(docs.select("doc_id", "text"), piece_path)
    assert encoded.columns == ["doc_id", "ids", "starts", "ends"] and encoded.count() == len(rows)
    assert piece_encode.encoding_digests(docs.limit(0), piece_path).count() == 0
