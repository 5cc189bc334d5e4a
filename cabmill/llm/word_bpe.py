"""Token ids of whole texts from a public word BPE, with each distinct letter run encoded once.

The tokenizer drops white space and never joins what white space parts, so a text's ids are those
of its words in a row. Arrow splits texts and numbers their distinct words; only these are looked
at one by one, and numpy puts their ids in the texts' order. A worker keeps the ids of the letter
runs it has met.
"""

from __future__ import annotations

import os
import string
from array import array
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cabmill.llm.common import kept

#: Words of texts that are held and numbered together (those of one text at least), and distinct
#: letter runs that a worker remembers; beyond, those of the last texts stay. Results do not depend
#: on either.
KEPT_WORDS, KEPT_RUNS = 2_000_000, 300_000
_ROWS, _TAKEN = 4096, 200_000  # texts split at a time, words whose ids are put in order at a time
# What may follow the letters of a plain word: the tokenizer itself encodes the two apart, as no
# contraction and no special token is of such signs alone.
_MARKS = string.punctuation


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte, by the public rule: printable
    Latin-1 characters stand for themselves, the other bytes for characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """ids(text) as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._letters = regex.compile(r"\p{L}+")
        self._written = str.maketrans(_byte_letters())
        self._runs: dict[str, bytes] = {}
        # The merges alone give a run of letters the same ids as the whole tokenizer; if a
        # vocabulary were of another kind, every run would pass through all of it.
        probes = ["the", "antidisestablishment", "été", "ñandú", "ждал", "qzxv"]
        self._direct = all(self._merged(x) == self._whole([x])[0] for x in probes)

    def _whole(self, runs: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(runs, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _merged(self, run: str) -> bytes:
        """The ids of a normalised run of letters."""
        if not run.isascii():
            run = run.encode().decode("latin-1").translate(self._written)
        return array("I", [t.id for t in self._model.tokenize(run)]).tobytes()

    def _encode(self, runs: list[str]) -> None:
        """Remember the ids of some runs."""
        known, rest = self._runs, []
        if not self._direct:
            rest = runs
        else:
            for r in runs:
                # The tokenizer lower-cases letter by letter; of all letters only a final sigma
                # differs from that in str.lower. What is not composed goes the whole way.
                n = r.lower()
                if n.isalpha() and (
                    r.isascii() or ("Σ" not in r and is_normalized("NFC", r) and self._letters.fullmatch(n))
                ):
                    known[r] = self._merged(n)
                else:
                    rest.append(r)
        known.update(zip(rest, self._whole(rest), strict=True))

    def _learn_runs(self, runs: set[str]) -> None:
        """Let the newest generation hold all of some runs; of the one before only these stay."""
        old = {}
        if len(self._runs) + len(runs) > KEPT_RUNS:
            old, self._runs = self._runs, {}
        unknown = []
        for r in runs.difference(self._runs):
            if r in old:
                self._runs[r] = old[r]
            else:
                unknown.append(r)
        self._encode(unknown)

    def learn(self, words: pa.StringArray | Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, one after the other, and the number of each one's ids."""
        if not isinstance(words, pa.Array):
            words = pa.array(list(words), pa.binary()).cast(pa.string())
        # Only A-Z are lower-cased here; the tokenizer does the rest.
        low = pc.ascii_lower(words)
        letters = pc.ascii_rtrim(low, _MARKS)
        cut = pc.binary_length(low).to_numpy() - pc.binary_length(letters).to_numpy()
        letters = letters.dictionary_encode()
        names = letters.dictionary.to_pylist()
        plain = np.fromiter(map(str.isalpha, names), bool, len(names))
        names = [x if p else "" for x, p in zip(names, plain.tolist(), strict=True)]
        head = letters.indices.to_numpy().astype(np.int64)
        odd = np.flatnonzero(~plain[head])  # these go through the whole tokenizer as they are
        marked = np.flatnonzero((cut > 0) & plain[head])
        ends = [w[-k:] for w, k in zip(low.take(pa.array(marked)).to_pylist(), cut[marked].tolist(), strict=True)]
        marks = {x: i for i, x in enumerate(dict.fromkeys(["", *ends]), len(names) + len(odd))}
        head[odd] = np.arange(len(names), len(names) + len(odd))
        tail = np.full(len(head), marks[""])
        tail[marked] = [marks[x] for x in ends]
        names += [*words.take(pa.array(odd)).to_pylist(), *marks]
        self._learn_runs(set(names))
        runs = list(map(self._runs.__getitem__, names))
        flat, size = np.frombuffer(b"".join(runs), "<u4"), np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        return _gathered(flat, size, np.stack([head, tail], axis=1).ravel()), size[head] + size[tail]

    def all_ids(self, texts: pa.Array | list[bytes]) -> Iterator[bytes]:
        """The ids of each text (null: none); the distinct words of many texts are encoded together."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.binary())
        for row in range(0, len(texts), _ROWS):
            split = pc.ascii_split_whitespace(texts.slice(row, _ROWS).cast(pa.string()).fill_null(""))
            ends, at = split.offsets.to_numpy(), 0
            while at < len(split):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + KEPT_WORDS, "right")) - 1)
                first = ends[at]
                words = split.values.slice(first, ends[to] - first).dictionary_encode()
                flat, size = self.learn(words.dictionary)
                each = words.indices.to_numpy()
                while at < to:
                    end = min(to, max(at + 1, int(np.searchsorted(ends, ends[at] + _TAKEN, "right")) - 1))
                    own = each[ends[at] - first : ends[end] - first]
                    ids = _gathered(flat, size, own)
                    cuts = np.concatenate([[0], np.cumsum(size[own])])[ends[at : end + 1] - ends[at]].tolist()
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        yield ids[a:b].tobytes()
                    at = end


def _gathered(flat: np.ndarray, size: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Parts of ``flat``, whose sizes are given in a row, in the order of their numbers."""
    first, n = (np.cumsum(size) - size)[each], size[each]
    ends = np.cumsum(n)
    return flat[np.repeat(first - ends + n, n) + np.arange(n.sum())]


def word_ids(path: str) -> WordIds:
    """The worker's encoder for a vocabulary file; kept between tasks."""
    return kept(("word_bpe", path), lambda: WordIds(path))
