"""Piece encoding of whole texts with the byte span of every piece in the original.

A text is normalised by the longest prefixes found in the model's compiled character map; the
source byte of every normalised byte is recorded on the way. The normalised text is cut where no
piece of the vocabulary reaches across, each distinct part is merged once, and the pieces' places
are projected back to the original through the record.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.common import chosen, read

#: Distinct parts a worker remembers; results do not depend on it.
KEPT_PARTS = 500_000
_SPACE = "▁"
_MARK = _SPACE.encode()
# Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
#: Bits of a packed piece below its width, and characters of a part that is merged on its own.
_WIDTH, _LONG = 20, 48


def _part_pattern(joined: list[str]) -> re.Pattern:
    """Splits a normalised text where no piece reaches across: before a run of space marks,
    around a line end, and between letters and a comma or full stop."""
    if any(_SPACE in p.lstrip(_SPACE) for p in joined) or any("\n" in p for p in joined):
        return re.compile(r"(?s).+")
    near = {a + b for p in joined for a, b in zip(p, p[1:], strict=False)}
    marks = "".join(c for c in ",." if not any(b[1] == c and b[0].isalpha() for b in near))
    letters = rf"{_SPACE}*[^\W\d_]+(?=[{marks}])|" if marks else ""
    return re.compile(rf"\n|{letters}{_SPACE}*[^{_SPACE}\n]+|{_SPACE}+")


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and a pool of texts."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self._units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self._pool = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of text[at:] and what replaces it."""
        units, found = self._units, None
        offset = lambda u: (u >> 10) << ((u & 0x200) >> 6)
        node = offset(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, start = found
        return length, self._pool[start : self._pool.index(b"\0", start)]


class Normalizer:
    """normalise(text) gives the normalised bytes and, for each, its source byte in the text."""

    def __init__(self, spec):
        self._map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self._dummy, self._squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self._space = _MARK if spec.escape_whitespaces else b" "

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if self._map is None and not self._squeeze:
            return self._plain(text)
        return self._mapped(text)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The same for an empty map: only spaces change."""
        if not text:
            return b"", np.empty(0, np.int64)
        width = np.where(np.frombuffer(text, np.uint8) == 0x20, len(self._space), 1)
        source = np.repeat(np.arange(len(text)), width)
        out = text.replace(b" ", self._space)
        if self._dummy:
            return self._space + out, np.concatenate([np.zeros(len(self._space), np.int64), source])
        return out, source

    def _step(self, text: bytes, at: int) -> tuple[int, bytes]:
        found = self._map.longest(text, at) if self._map else None
        if found:
            return found
        lead = text[at]
        length = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return length, text[at : at + length]

    def _mapped(self, text: bytes) -> tuple[bytes, np.ndarray]:
        at, out, source = 0, bytearray(), []
        steps = []
        while at < len(text):
            length, new = self._step(text, at)
            steps.append((at, new))
            at += length
        if self._squeeze:
            first = next((i for i, (_, new) in enumerate(steps) if new != b" "), len(steps))
            steps = steps[first:]
        if not steps:
            return b"", np.empty(0, np.int64)
        if self._dummy:
            out += self._space
            source += [steps[0][0]] * len(self._space)
        spaced = self._squeeze
        for at, new in steps:
            if spaced:
                new = new.lstrip(b" ")
            if new:
                written = new.replace(b" ", self._space)
                out += written
                source += [at] * len(written)
                spaced = self._squeeze and new.endswith(b" ")
        if self._squeeze:
            while out.endswith(self._space):
                del out[-len(self._space) :], source[-len(self._space) :]
        return bytes(out), np.array(source, np.int64)


class PieceEncoder:
    """encode(text): ids and byte spans, as the public library's merges give them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = [p.type for p in model.pieces]
        if model.trainer_spec.model_type != 2 or _UNUSED in kinds or _USER in kinds:
            raise ValueError("only merge models without unused or user-defined pieces are supported")
        self.library = SentencePieceProcessor(model_file=path)
        self.normalise = Normalizer(model.normalizer_spec)
        self._scores = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self._ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self._bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self._unknown = kinds.index(_UNKNOWN)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self._spell = np.array([self._bytes.get(b, self._unknown) for b in range(256)], "<u4")
        joined = [p for p in self._scores if len(p) > 1]
        self._part = _part_pattern(joined)
        # Symbols: normal pieces and the characters they are made of; later also any other.
        self._symbols = {p: i for i, p in enumerate(dict.fromkeys([*self._scores, *"".join(joined)]))}
        self._names = list(self._symbols)
        self._factor = len(self._symbols) + 1  # other characters share the last number: no pair
        keys, made = [], []
        for p in joined:
            for k in range(1, len(p)):
                if p[:k] in self._symbols and p[k:] in self._symbols:
                    keys.append(self._symbols[p[:k]] * self._factor + self._symbols[p[k:]])
                    made.append(self._symbols[p])
        order = np.argsort(keys)
        self._pair, self._made = np.array(keys, np.int64)[order], np.array(made, np.int64)[order]
        # Pieces in the order in which merges prefer them.
        score = np.array([self._scores.get(p, -np.inf) for p in self._names])
        self._rank = np.unique(-score, return_inverse=True)[1]
        self._char = np.full(0x110000, self._factor - 1, np.int32)
        self._code = np.zeros(self._factor, "<u4")
        for name, i in self._symbols.items():
            if name in self._ids:
                self._code[i] = self._ids[name] | len(name.encode()) << _WIDTH
                if len(name) == 1:
                    self._char[ord(name)] = i
        self._parts: dict[str, bytes] = {}

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol that each pair of neighbours makes, or -1."""
        key = left.astype(np.int64) * self._factor + right
        at = np.minimum(np.searchsorted(self._pair, key), len(self._pair) - 1)
        return np.where(self._pair[at] == key, self._made[at], -1)

    def _learn(self, parts: list[str]) -> None:
        """Merge all parts together, in rounds: each part joins its best-scored pair of
        neighbours, the leftmost of equals, until none has a known pair."""
        text = "".join(parts)
        symbol = self._char[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        owner = np.repeat(np.arange(len(parts)), lengths)
        # Long parts, and those with characters outside the vocabulary, are merged one by one.
        alone = lengths > _LONG
        alone[owner[symbol == self._factor - 1]] = True
        for i in np.flatnonzero(alone).tolist():
            self._parts[parts[i]] = self._packed(self._merged_long(list(parts[i])))
        if alone.all():
            return
        together = ~alone[owner]
        symbol = symbol[together]
        owner = owner[together]
        start = np.arange(len(symbol))
        # Symbols that are final for their part leave the working arrays.
        final: list[tuple[np.ndarray, np.ndarray]] = []
        far = np.int64(1 << 40)
        while len(symbol):
            made = np.full(len(symbol), -1, np.int64)
            made[:-1] = self._joins(symbol[:-1], symbol[1:])
            made[:-1][owner[:-1] != owner[1:]] = -1
            key = np.where(made >= 0, self._rank[made] * far + np.arange(len(symbol)), np.iinfo(np.int64).max)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(key, first)
            live = best < np.iinfo(np.int64).max
            at = best[live] % far
            symbol[at] = made[at]
            sizes = np.diff(np.append(first, len(symbol)))
            stays = np.repeat(live, sizes)
            if not live.all():
                final.append((start[~stays], symbol[~stays]))
            gone = stays.copy()
            gone[at + 1] = False
            symbol, owner, start = symbol[gone], owner[gone], start[gone]
        begin = np.concatenate([f[0] for f in final])
        name = np.concatenate([f[1] for f in final])
        order = np.argsort(begin)
        codes = self._code[name[order]].tobytes()
        edges = 4 * np.searchsorted(begin[order], np.concatenate([[0], np.cumsum(lengths[~alone])]))
        rest = (parts[i] for i in np.flatnonzero(~alone).tolist())
        for p, x, y in zip(rest, edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            self._parts[p] = codes[x:y]

    def _merged_long(self, symbols: list[str]) -> list[str]:
        scores, n = self._scores, len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (s := scores.get(both := symbols[i] + symbols[j])) is not None:
                heapq.heappush(heap, (-s, i, j, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not symbols[i] or right[i] != j or symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j] = both, ""
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [s for s in symbols if s]

    def _packed(self, symbols: list[str]) -> bytes:
        """Per piece its id and, above it, its normalised bytes: none for a later byte of a
        character that is spelled in bytes, as each byte of one has its whole span."""
        out = []
        for symbol in symbols:
            known, raw = self._ids.get(symbol), symbol.encode()
            if known is not None:
                out.append(known | len(raw) << _WIDTH)
            elif self._bytes:
                spelled = self._spell[list(raw)].tolist()
                out += [spelled[0] | len(raw) << _WIDTH, *spelled[1:]]
            else:
                out.append(self._unknown | len(raw) << _WIDTH)
        return np.array(out, "<u4").tobytes()

    def _remember(self, distinct: set[str]) -> None:
        if len(self._parts) + len(distinct) > KEPT_PARTS:
            self._parts.clear()
        self._learn([p for p in distinct if p not in self._parts])

    def encode_all(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """encode() of each text; their new parts are merged together."""
        normal = [self.normalise(t) for t in texts]
        parts = [self._part.findall(n.decode()) for n, _ in normal]
        self._remember(set().union(*parts))
        for text, (_, source), own in zip(texts, normal, parts, strict=True):
            yield self._placed(text, source, own)

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, start and end of each piece as bytes of the text; a piece that stands for nothing
        in the text (the prefix mark) has an empty span."""
        return next(self.encode_all([text]))

    def _placed(self, text: bytes, source: np.ndarray, parts: list[str]):
        if not parts:
            none = np.empty(0, np.int64)
            return none.astype("<u4"), none, none
        found = b"".join(map(self._parts.__getitem__, parts))
        packed = np.frombuffer(found, "<u4")
        ids, widths = packed & np.uint32((1 << _WIDTH) - 1), (packed >> np.uint32(_WIDTH)).astype(np.int64)
        if not self._bytes:
            ids, widths = _joined_unknowns(ids, widths, self._unknown)
        # A byte of a character spelled in bytes starts where the character starts.
        after = np.cumsum(widths)
        first = after - widths
        owner = np.maximum.accumulate(np.where(widths > 0, np.arange(len(widths)), 0))
        first, after = first[owner], after[owner]
        edge = np.append(source, len(text))
        return ids, edge[first], edge[after]


def _joined_unknowns(ids: np.ndarray, widths: np.ndarray, unknown: int):
    """A run of unknown pieces is one."""
    first = np.concatenate([[True], ~((ids[1:] == unknown) & (ids[:-1] == unknown))])
    return ids[first], np.add.reduceat(widths, np.flatnonzero(first))


_KNOWN: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a model file; kept between tasks."""
    if path not in _KNOWN:
        _KNOWN[path] = PieceEncoder(path)
    return _KNOWN[path]


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [t or b"" for t in part.column(part.num_columns - 1).to_pylist()]
                found = list(model.encode_all(texts))
                columns = [
                    pa.array([x[i].astype(np.int64) for x in found], pa.list_(pa.int64())) for i in range(3)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *columns], [*part.schema.names[:-1], "ids", "starts", "ends"]
                )

    return run


def encode_texts(frame: DataFrame, model: str, text: str = "text") -> DataFrame:
    """The frame's other columns with ids, starts and ends (bytes of the text) of its pieces."""
    kept = [c for c in frame.columns if c != text]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema if f.name in kept)
    return frame.select(*kept, F.col(text).cast("binary")).mapInArrow(
        _encoded(model), f"{fields}ids array<long>, starts array<long>, ends array<long>"
    )


def _digest(model: PieceEncoder, doc_id: int | None, text: bytes, encoded: tuple) -> tuple:
    ids, starts, ends = encoded
    framed = np.concatenate([[model.begin], ids, [model.end]]).astype("<u4")
    decoded = model.library.decode(framed.tolist())
    # Spans in order, each beginning where the one before ends or with it.
    tiled = not len(ids) or bool(
        starts[0] == 0 and ends[-1] == len(text)
        and ((starts[1:] == ends[:-1]) | (starts[1:] == starts[:-1])).all()
    )
    return (
        doc_id, len(framed), hashlib.sha256(framed.tobytes()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(), tiled,
    )


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        for batch in batches:
            rows, names, texts = [], batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 64):
                part = [t or b"" for t in texts[at : at + 64]]
                encoded = zip(names[at : at + 64], part, model.encode_all(part), strict=True)
                rows += [_digest(model, *x) for x in encoded]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*rows, strict=True),
                        (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()), strict=True,
                    )],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "tiled"],
                )

    return run


def encoding_digests(documents: DataFrame, model: str) -> DataFrame:
    """Per document the number and digest of its ids, begin and end included, the digest of what
    the library decodes them to, and whether the spans cover the text without a gap.

    A null text is empty: two ids. Repeated rows get a row each, a null doc_id stays null, an
    empty table gives no rows, further columns are ignored. One pass, no shuffle.
    """
    docs = chosen(documents, doc_id="long", text="string")
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        _digests(model),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, tiled boolean",
    )


def op6_piece_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoding_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
