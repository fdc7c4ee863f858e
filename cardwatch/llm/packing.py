"""Hierarchical packing of token sequences for several context sizes.

Each task packs the documents of its partition in blocks of bounded size. Documents are
routed by length to tiers of context sizes; longer ones first give up full windows of the
largest size. Windows are packed from the longest tier down: the longest piece opens a
window of its tier, the gap is filled with the longest pieces that fit, from shorter tiers,
and at the last by cutting a short one. Windows of a tier are counted off into step groups
of equal numbers of tokens.

What a task has left when its partition ends (an unfilled window, and less than a group of
each tier) goes through one shuffle with that of up to ``FAN_IN - 1`` others, is packed and
grouped again, and its last rest is packed into windows of the largest size. So of each
``FAN_IN`` tasks less than one group stays short, and less than one window of the largest
size is cut into windows of powers of two, so that no window is padded.

Defined cases: null and empty texts are documents of only the end id. Repeated rows and
ids are packed as often as they stand. Empty tables give empty results. Other columns are
not read.
"""

from __future__ import annotations

import bisect
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, materialize, record_batch, trimmed
from .wordtokens import END_ID, encoder, tokenizer_path

#: Context sizes, powers of two.
TIERS = (512, 1024, 2048, 4096)
#: Tokens packed together, and tokens of a step group.
BLOCK_TOKENS, GROUP_TOKENS = 1 << 21, 1 << 15
#: Tasks whose rests are packed together: each sends less than a group of each tier.
FAN_IN = 128
#: Chunks and words that a task's encoder remembers, about.
TABLE_ENTRIES = 500_000
#: Sequence ids of rests start here.
RESTS = 1 << 61

OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                 ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                 ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int64()),
                 ("step_group", pa.int64()), ("ids", pa.binary())])
DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
       "sequence_id long, offset long, tier long, step_group long, ids binary")


class Packer:
    """Pieces are (length, order, doc_id, start, tokens of the document, id bytes)."""

    def __init__(self, base: int, tiers=TIERS, group_tokens: int = GROUP_TOKENS):
        self.tiers, self.group_tokens = tuple(sorted(tiers)), group_tokens
        self.items: list[tuple] = []
        self.held = self.made = self.order = 0
        self.base = base
        self.open: dict[int, list] = {}  # windows of the group that a tier is filling
        self.groups: dict[int, int] = {}
        self.rows: list[tuple] = []

    def _piece(self, doc_id, start, total, ids):
        self.order += 1
        return (len(ids) // 4, self.order, doc_id, start, total, ids)

    def _window(self, pieces: list[tuple], size: int) -> None:
        group = self.open.setdefault(size, [])
        group.append(pieces)
        if len(group) >= max(1, self.group_tokens // size):
            self._close(size)

    def _close(self, size: int) -> None:
        """Hand out the windows of a tier's group."""
        k = self.groups.get(size, 0)
        self.groups[size] = k + 1
        number = self.base + (size.bit_length() << 26) + k
        for pieces in self.open.pop(size):
            seq, at = self.base + self.made, 0
            self.made += 1
            for n, _, doc_id, start, total, ids in pieces:
                self.rows.append((doc_id, start, n, zlib.crc32(ids), total, seq, at, size,
                                  number, None))
                at += n

    def _unfinished(self) -> list[tuple]:
        """The pieces of open groups and of the window that is not filled."""
        self.pack()
        out = [p for windows in self.open.values() for w in windows for p in w] + self.items
        self.open, self.items, self.held = {}, [], 0
        return out

    def add(self, doc_id, ids: bytes) -> None:
        total, top = len(ids) // 4, self.tiers[-1]
        start = 0
        while total - start >= top:
            self._window([self._piece(doc_id, start, total, ids[4 * start:4 * (start + top)])], top)
            start += top
        if start < total:
            self.add_piece(doc_id, start, total, ids[4 * start:])

    def add_piece(self, doc_id, start, total, ids: bytes) -> None:
        """A part of a document, of at most the largest size."""
        p = self._piece(doc_id, start, total, ids)
        self.items.append(p)
        self.held += p[0]

    def _split(self, p, n):
        """The first n ids of a piece, and the rest."""
        _, _, doc_id, start, total, ids = p
        return (self._piece(doc_id, start, total, ids[:4 * n]),
                self._piece(doc_id, start + n, total, ids[4 * n:]))

    def pack(self) -> None:
        """Fill windows from the longest piece down; an unfilled window's pieces are held
        back for the next block."""
        items = self.items
        items.sort()
        while items:
            window = [items.pop()]
            size = next(t for t in self.tiers if t >= window[0][0])
            gap = size - window[0][0]
            while gap and items:
                k = bisect.bisect_left(items, (gap + 1,)) - 1
                if k >= 0:
                    p = items.pop(k)
                else:  # all are longer than the gap: cut the shortest
                    p, rest = self._split(items.pop(0), gap)
                    bisect.insort(items, rest)
                window.append(p)
                gap -= p[0]
            if gap:
                self.items, self.held = window, size - gap
                return
            self._window(window, size)
        self.items, self.held = [], 0

    def leave(self) -> None:
        """Hand out what is not in a full group as rows that carry their ids."""
        for n, _, doc_id, start, total, ids in self._unfinished():
            self.rows.append((doc_id, start, n, None, total, self.base, None, None, None, ids))

    def finish(self) -> None:
        """Pack the rest into windows of the largest size, and the last of it into powers of
        two; the groups are what they are."""
        self.items = self._unfinished()
        self.tiers = self.tiers[-1:]
        self.pack()
        left = self.items
        n = sum(p[0] for p in left)
        while n:
            size, window, need = 1 << (n.bit_length() - 1), [], 0
            need = size
            while need:
                p = left.pop(0)
                if p[0] > need:
                    p, rest = self._split(p, need)
                    left.insert(0, rest)
                window.append(p)
                need -= p[0]
            self._window(window, size)
            n -= size
        self.items, self.held = [], 0
        for size in sorted(self.open):
            self._close(size)

    def take(self):
        rows, self.rows = self.rows, []
        return record_batch(OUT, *(zip(*rows) if rows else [[]] * len(OUT)))


def _packed(path, end, tiers, block_tokens, group_tokens):
    def run(batches):
        enc = encoder(path)
        packer = Packer(TaskContext.get().partitionId() << 32, tiers, group_tokens)
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packer.add(i, enc.id_bytes(t, end))
                if packer.held >= block_tokens:
                    packer.pack()
            if len(packer.rows) >= 4096:
                yield packer.take()
            if enc.entries() > TABLE_ENTRIES:
                enc.forget()
        packer.leave()
        enc.forget()
        yield packer.take()
    return run


def _rests_packed(tiers, block_tokens, group_tokens):
    def run(batches):
        packer = last = None
        for batch in batches:
            for key, *piece in zip(*(batch.column(n).to_pylist() for n in (
                    "key", "doc_id", "start", "doc_tokens", "ids"))):
                if key != last:
                    if packer:
                        packer.finish()
                        yield packer.take()
                    packer, last = Packer(RESTS + (key << 32), tiers, group_tokens), key
                packer.add_piece(*piece)
                if packer.held >= block_tokens:
                    packer.pack()
                if len(packer.rows) >= 4096:
                    yield packer.take()
        if packer:
            packer.finish()
            yield packer.take()
    return run


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer: str | None = None, end: int = END_ID, tiers=TIERS,
         block_tokens: int = BLOCK_TOKENS, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row for each piece. Each task packs what it reads; the pieces are written once, and
    only rests, whose number of tokens is bounded by the number of tasks, are shuffled."""
    batches_of(df.sparkSession)
    packed = materialize(df.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        trimmed(_packed(tokenizer or tokenizer_path(), end, tiers, block_tokens, group_tokens)),
        DDL),
        "packed")
    task = F.shiftright("sequence_id", 32)
    rests = (packed.filter("ids IS NOT NULL")
             .select(F.floor(task / FAN_IN).alias("key"), "doc_id", "start", "doc_tokens", "ids")
             .repartition("key").sortWithinPartitions("key", "doc_id", "start", "ids")
             .mapInArrow(trimmed(_rests_packed(tiers, block_tokens, group_tokens)), DDL))
    return packed.filter("ids IS NULL").unionByName(rests).drop("ids")
