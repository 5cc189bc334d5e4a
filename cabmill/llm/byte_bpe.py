"""Byte-level pair encoding of whole texts, and back, in two tiers.

A text is cut into pre-tokens by the tokenizer's pattern. Pre-tokens that are tokens themselves
are found by a minimal perfect hash of the vocabulary, many at a time; the others are merged, each
once, with a heap over their linked bytes. Both give the ids of the public library.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.common import chosen, read, ship

#: Distinct pre-tokens of a generation that a worker remembers; two generations are kept.
KEPT = 250_000
#: Characters of texts that are encoded together, and pre-tokens of a text taken at a time.
TOGETHER, TAKEN = 1 << 20, 1 << 18
_U = np.uint64
# Fixed values of the public splitmix64 mixing function.
_MIX = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x + _MIX[0]
    x = (x ^ (x >> _U(30))) * _MIX[1]
    x = (x ^ (x >> _U(27))) * _MIX[2]
    return x ^ (x >> _U(31))


class PerfectHash:
    """A place of its own, of as many places as there are keys, for each of some distinct keys.

    Keys are dealt to buckets. Buckets, the fullest first, get the first displacement that sends
    all of their keys to free places; a single key is sent to a free place directly.
    """

    #: Keys of a bucket on average, and displacements tried at a time.
    LOAD, TRIED = 3, 64

    def __init__(self, keys: list[bytes]):
        self.keys: list[bytes | None] = [None] * len(keys)
        self._longest = max(map(len, keys), default=0)
        self._buckets = len(keys) // self.LOAD + 1
        for seed in range(64):
            # An odd base: powers of it never vanish modulo 2^64.
            base = _mixed(np.array([seed], _U)) | _U(1)
            self._powers = np.cumprod(np.concatenate([[_U(1)], np.repeat(base, self._longest)]))
            hashed = self._hashed(keys)
            if len(np.unique(hashed)) == len(keys):
                break
        else:
            raise ValueError("the keys are not distinct")
        self._place_all(keys, hashed)

    def _hashed(self, words: list[bytes]) -> np.ndarray:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        if not len(words):
            return np.empty(0, _U)
        first = np.cumsum(lengths) - lengths
        at = np.arange(lengths.sum()) - np.repeat(first, lengths)
        letters = np.frombuffer(b"".join(words), np.uint8).astype(_U) + _U(1)
        return _mixed(np.add.reduceat(letters * self._powers[at], first))

    def _places(self, hashed: np.ndarray, moved: np.ndarray) -> np.ndarray:
        return (_mixed(hashed ^ _mixed(moved.astype(_U))) % _U(len(self.keys))).astype(np.int64)

    def _place_all(self, keys: list[bytes], hashed: np.ndarray) -> None:
        bucket = (hashed % _U(self._buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self._buckets + 1))
        sizes = np.diff(cuts)
        self._moves = np.zeros(self._buckets, np.int64)
        free = np.ones(len(keys), bool)
        for b in np.argsort(-sizes, kind="stable").tolist():
            own = order[cuts[b] : cuts[b + 1]]
            if len(own) < 2:
                break
            tried = 0
            while True:
                moves = np.arange(tried, tried + self.TRIED)
                places = self._places(hashed[own][None, :], moves[:, None])
                fits = free[places].all(1)
                ranked = np.sort(places, 1)
                fits &= (ranked[:, 1:] != ranked[:, :-1]).all(1)
                if fits.any():
                    break
                tried += self.TRIED
            at = int(fits.argmax())
            self._moves[b] = moves[at]
            free[places[at]] = False
            for key, place in zip(own.tolist(), places[at].tolist(), strict=True):
                self.keys[place] = keys[key]
        # Places of single keys are stored as negative numbers.
        single = np.flatnonzero(sizes == 1)
        left = np.flatnonzero(free)
        self._moves[single] = -1 - left
        for key, place in zip(order[cuts[single]].tolist(), left.tolist(), strict=True):
            self.keys[place] = keys[key]

    def find(self, words: list[bytes]) -> list[int]:
        """The place of each word, or -1 for one that is no key; no word is empty."""
        out = [-1] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= self._longest]
        if not short or not self.keys:
            return out
        some = [words[i] for i in short]
        hashed = self._hashed(some)
        moves = self._moves[(hashed % _U(self._buckets)).astype(np.int64)]
        places = np.where(moves < 0, -1 - moves, self._places(hashed, np.maximum(moves, 0)))
        keys = self.keys
        for i, word, place in zip(short, some, places.tolist(), strict=True):
            if keys[place] == word:
                out[i] = place
        return out


class ByteBpe:
    """Ids of texts as little-endian unsigned 32-bit bytes, and bytes of ids."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self._ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if any(bytes([b]) not in self._ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds every single byte")
        self._pattern = regex.compile(pattern)
        self._hash = PerfectHash(list(self._ranks))
        packed = lambda rank: rank.to_bytes(4, "little")
        self._at_place = [packed(self._ranks[k]) for k in self._hash.keys]
        self._bytes = {rank: token for token, rank in self._ranks.items()}
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def merged(self, word: bytes) -> bytes:
        """Ids of a pre-token: while neighbours make a token, those that make the one of lowest
        rank join, the leftmost of equals. A pair in the heap that has changed since is passed
        over."""
        ranks, n = self._ranks, len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [ranks.get(word[i : i + 2], -1) for i in range(n - 1)] + [-1]
        heap = [rank * n + i for i, rank in enumerate(pair) if rank >= 0]
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), n)
            if pair[i] != rank:
                continue
            j = after[i]
            pair[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair[i] = rank = ranks.get(word[i : after[k]], -1)
                if rank >= 0:
                    heappush(heap, rank * n + i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                pair[h] = rank = ranks.get(word[h:k], -1)
                if rank >= 0:
                    heappush(heap, rank * n + h)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[word[i : after[i]]])
            i = after[i]
        return np.array(ids, "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Let the newer generation hold all of some pre-tokens."""
        if len(self._new) + len(words) > KEPT:
            self._old, self._new = self._new, {}
        new, old = self._new, self._old
        unknown = []
        for w in words.difference(new):
            known = old.get(w)
            if known is None:
                unknown.append(w)
            else:
                new[w] = known
        raw = [w.encode() for w in unknown]
        at_place, merged = self._at_place, self.merged
        for w, r, place in zip(unknown, raw, self._hash.find(raw), strict=True):
            new[w] = at_place[place] if place >= 0 else merged(r)

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; their unknown pre-tokens are looked up together. A long text is
        taken in runs of pre-tokens, so its pre-tokens never lie in memory at once."""
        some: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text) < TOGETHER:
                some.append(self._pattern.findall(text))
                size += len(text)
                if size < TOGETHER:
                    continue
            yield from self._looked_up(some)
            some, size = [], 0
            if len(text) >= TOGETHER:
                found = (m.group() for m in self._pattern.finditer(text))
                out = bytearray()
                while run := list(islice(found, TAKEN)):
                    out += next(self._looked_up([run]))
                yield bytes(out)
        yield from self._looked_up(some)

    def _looked_up(self, parts: list[list[str]]) -> Iterator[bytes]:
        self._learn(set().union(*parts))
        ids = self._new.__getitem__
        for own in parts:
            yield b"".join(map(ids, own))

    def decode(self, ids: list[int]) -> bytes | None:
        """The bytes of some ids; None if one of them is not in the vocabulary."""
        found = list(map(self._bytes.get, ids))
        return None if None in found else b"".join(found)


_KNOWN: dict[tuple[str, str], ByteBpe] = {}


def encoder(path: str, pattern: str) -> ByteBpe:
    """The worker's encoder for a rank file; kept between tasks."""
    if (path, pattern) not in _KNOWN:
        _KNOWN[path, pattern] = ByteBpe(path, pattern)
    return _KNOWN[path, pattern]


def _texts(column: pa.Array) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in column.to_pylist()]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _mapped(frame: DataFrame, column: str, kind: str, name: str, made: str, run) -> DataFrame:
    """The frame's other columns, and ``run(values)`` of one column's values in another."""
    ship(frame.sparkSession)
    kept = [f for f in frame.schema if f.name != column]
    if name in {f.name for f in kept}:
        raise ValueError(f"the frame has a column {name} already")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(parts):
            *rest, own = part.columns
            yield pa.RecordBatch.from_arrays([*rest, run(own)], [*(f.name for f in kept), name])

    # Numbered names on the way in: a name with a dot would be taken for a field of a column.
    inner = [F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)]
    source = F.col(f"`{column}`").cast(kind).alias("source")
    return frame.select(*inner, source).mapInArrow(batches, f"{fields}`{name}` {made}")


def encode_texts(frame: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """The frame's other columns and ``ids``, the token ids of a text; null is empty."""

    def run(column: pa.Array) -> pa.Array:
        found = encoder(ranks, pattern).encode_all(_texts(column))
        return pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in found], pa.list_(pa.int64()))

    return _mapped(frame, text, "binary", "ids", "array<long>", run)


def decode_ids(frame: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The frame's other columns and ``decoded``, the bytes of a list of ids. They are null where
    the list is null or holds anything that is no id of the vocabulary."""

    def run(column: pa.Array) -> pa.Array:
        decode = encoder(ranks, pattern).decode
        return pa.array([None if x is None else decode(x) for x in column.to_pylist()], pa.binary())

    return _mapped(frame, ids, "array<long>", "decoded", "binary", run)


def _digests(ranks: str, pattern: str):
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    sha = lambda raw: hashlib.sha256(raw).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(ranks, pattern)
        for part in _slices(batches):
            rows = []
            for packed in model.encode_all(_texts(part.column(1))):
                ids = np.frombuffer(packed, "<u4").tolist()
                rows.append((len(ids), sha(packed), sha(model.decode(ids))))
            counts, own, back = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(own), pa.array(back)], names
            )

    return run


def encoding_digests(documents: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document the number and digest of its ids, and the digest of what these decode to.

    A null text is empty: no ids. Bytes that are not UTF-8 count as U+FFFD. Repeated rows get a
    row each, a null doc_id stays null, an empty table gives no rows, further columns are ignored.
    One pass, no shuffle.
    """
    ship(documents.sparkSession)
    docs = chosen(documents, doc_id="long", text="binary")
    return docs.mapInArrow(
        _digests(ranks, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoding_digests(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
