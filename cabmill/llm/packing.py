"""Hierarchical packing of documents into windows of several lengths.

Documents are routed to the shortest tier that holds them (whole windows of the longest tier are
cut off first). Each tier is packed from its longest documents on; the gap that is left in a
window is filled from the shorter tiers, whole documents first, and at last with a piece cut to
fit. Every window is therefore full, but for the end of a partition, whose last tokens are cut
into windows of powers of two. Windows of a tier are dealt to step groups in a serpentine by
their attention cost, so that steps have the same shape and nearly the same cost.

Every partition of the input is packed on its own: no shuffle, no group larger than a task's own
rows, and a lost task is repeated alone. A table of millions of partitions packs as well as a
small one, as only the last few windows of a partition are short.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.common import chosen, read
from cabmill.llm.word_bpe import word_ids

TIERS = (256, 512, 1024, 2048)
END_ID = 1
#: Documents that wait for a place at a time, and windows of a tier that are dealt together.
POOL, DEAL = 2048, 512
#: Tokens of a step group.
STEP_TOKENS = 131_072

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier long, step_group long"
)


class _Packer:
    """Packs documents given one by one; ``flush`` yields the windows made so far."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, first: int):
        self.tiers, self.step_tokens, self.next_id = tiers, step_tokens, first
        self.pools: list[list[tuple[int, int]]] = [[] for _ in tiers]  # (left, document), ascending
        self.docs: dict[int, list] = {}  # document: doc_id, ids as bytes, tokens, next start
        self.sums = [0] * len(tiers)  # tokens in each pool
        self.waiting, self.number = 0, 0
        self.windows: dict[int, list[list[tuple]]] = {t: [] for t in tiers}
        self.steps = dict.fromkeys(tiers, 0)

    def add(self, doc_id, ids: bytes) -> None:
        key, self.number = self.number, self.number + 1
        doc = self.docs[key] = [doc_id, ids, len(ids) // 4, 0]
        longest = self.tiers[-1]
        while doc[2] - doc[3] >= longest:
            self.windows[longest].append([self._piece(key, longest)])
        self._route(key)

    def _route(self, key: int) -> None:
        left = self.docs[key][2] - self.docs[key][3]
        if not left:
            del self.docs[key]
            return
        tier = next(i for i, t in enumerate(self.tiers) if left <= t)
        insort(self.pools[tier], (left, key))
        self.sums[tier] += left
        self.waiting += 1

    def _piece(self, key: int, length: int) -> tuple:
        doc = self.docs[key]
        start, doc[3] = doc[3], doc[3] + length
        crc = zlib.crc32(memoryview(doc[1])[4 * start : 4 * (start + length)])
        return doc[0], start, length, crc, doc[2]

    def _take(self, tier: int, most: int) -> int | None:
        """The longest document of a tier with at most so many tokens."""
        at = bisect_right(self.pools[tier], (most, 1 << 62)) - 1
        return None if at < 0 else self._pop(tier, at)

    def _pop(self, tier: int, at: int) -> int:
        left, key = self.pools[tier].pop(at)
        self.sums[tier] -= left
        self.waiting -= 1
        return key

    def _fill(self, tier: int) -> list[tuple] | None:
        """A full window of a tier; None if what waits can't fill one (it stays as it was)."""
        size = self.tiers[tier]
        if sum(self.sums[: tier + 1]) < size:
            return None
        pieces, gap = [], size
        while gap:
            for i in range(tier, -1, -1):
                key = self._take(i, gap)
                if key is not None:
                    break
            else:  # nothing fits whole: cut the shortest that waits
                key = self._pop(next(i for i in range(tier + 1) if self.pools[i]), 0)
            doc = self.docs[key]
            length = min(gap, doc[2] - doc[3])
            pieces.append(self._piece(key, length))
            gap -= length
            self._route(key)
        return pieces

    def pack(self, last: bool) -> None:
        """Fill windows, longest tier first, from what waits; at the end, use all of it."""
        for tier in range(len(self.tiers) - 1, -1, -1):
            while self.pools[tier] or last:
                window = self._fill(tier)
                if window is None:
                    break
                self.windows[self.tiers[tier]].append(window)
        if last:
            self._rest()

    def _rest(self) -> None:
        """Fewer tokens than the shortest tier's window: windows of powers of two, exactly full."""
        keys = [k for p in self.pools for _, k in p]
        left = sum(self.docs[k][2] - self.docs[k][3] for k in keys)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            window = []
            while size:
                doc = self.docs[keys[0]]
                length = min(size, doc[2] - doc[3])
                window.append(self._piece(keys[0], length))
                size -= length
                if doc[2] == doc[3]:
                    del self.docs[keys.pop(0)]
            total = sum(p[2] for p in window)
            self.windows.setdefault(total, []).append(window)
            self.steps.setdefault(total, 0)
        self.pools, self.sums, self.waiting = [[] for _ in self.tiers], [0] * len(self.tiers), 0

    def flush(self, last: bool) -> Iterator[tuple]:
        for tier, windows in self.windows.items():
            if not windows or not (last or len(windows) >= DEAL):
                continue
            cost = np.array([sum(p[2] ** 2 for p in w) for w in windows])
            groups = max(1, round(len(windows) * tier / self.step_tokens))
            turn = np.arange(len(windows)) % (2 * groups)
            group = np.empty(len(windows), int)
            group[np.argsort(-cost, kind="stable")] = np.where(turn < groups, turn, 2 * groups - 1 - turn)
            for window, g in zip(windows, group.tolist(), strict=True):
                offset = 0
                for doc_id, start, length, crc, total in window:
                    yield (
                        doc_id, start, length, crc, total, self.next_id, offset, tier,
                        (self.next_id >> 40 << 40) + self.steps[tier] + g,
                    )
                    offset += length
                self.next_id += 1
            self.steps[tier] += groups
            windows.clear()


def _packed(path: str, tiers: tuple[int, ...], step_tokens: int, end_id: int):
    end = np.asarray([end_id], "<u4").tobytes()

    def rows(found: list[tuple]) -> pa.RecordBatch:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        packer = _Packer(tiers, step_tokens, TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            encoded = encoder.all_ids(batch.column(1))
            for at in range(0, len(ids), 256):
                for doc_id, own in zip(ids[at : at + 256], islice(encoded, 256), strict=True):
                    packer.add(doc_id, own + end)
                if packer.waiting >= POOL:
                    packer.pack(last=False)
                if found := list(packer.flush(last=False)):
                    yield rows(found)
        packer.pack(last=True)
        if found := list(packer.flush(last=True)):
            yield rows(found)
        pa.default_memory_pool().release_unused()

    return run


def pack_documents(
    documents: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS, end_id: int = END_ID,
) -> DataFrame:
    """One row per piece of a document: where it starts there, and where it lies in a sequence.

    A null text is empty: one piece with the end id alone. Repeated rows are packed each; a null
    doc_id stays null; an empty table gives no rows; further columns are ignored. A text longer
    than the longest tier is cut into full windows and a rest.
    """
    docs = chosen(documents, doc_id="long", text="string")
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        _packed(tokenizer, tiers, step_tokens, end_id), SCHEMA
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
