"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

A text is cut at safe boundaries, before a space or line feed that follows a character which
is not white space: the byte-level tokenizer's pattern starts anew there, and no special token
holds white space, so the counts of the parts add up to the text's. The parts of many texts,
about ``GROUP_BYTES`` of them, are looked at together: those seen before have their count in a
table, the rest are encoded in batches of about ``BATCH_BYTES`` each, so neither a few long
texts nor many short ones make a batch large. A long text is worked off in several groups.
The table starts anew when full. A tokenizer whose pattern or special tokens may join what a
cut would part is not cut (:func:`cuts_before_spaces`); its texts are encoded whole.

Special tokens in a text are taken as the library's default does (one id each).

Defined cases: null and empty texts have 0 bytes and 0 tokens. A part without any boundary
(a long text without white space) is encoded as a whole. Null ids and repeated rows stay as
they are. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, record_batch
from .wordtokens import tokenizer_path

#: Python's white space holds all that the tokenizer's pattern calls so, and a few more, so
#: what stands before a cut is not white space for either.
CUT = re.compile(r"(?<=\S)(?=[ \n])")
GROUP_BYTES, BATCH_BYTES = 1 << 20, 1 << 18
#: Parts of up to so many characters are remembered, so many of them.
LONGEST, TABLE_ROWS = 64, 600_000

OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def cuts_before_spaces(spec: dict) -> bool:
    """Whether a tokenizer of this description can be cut: byte-level pattern, no prefix
    space, nothing that changes the text first, plain added tokens without white space."""
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])
                and not re.search(r"\s", t["content"]) for t in spec.get("added_tokens", ()))
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and bool(pre.get("use_regex", True)) and not pre.get("add_prefix_space", True)
            and plain)


class Counter:
    def __init__(self, path: str, rows: int = TABLE_ROWS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            self.cut = cuts_before_spaces(json.load(f))
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.rows, self.table = rows, {}

    def parts(self, text: str) -> list[str]:
        return CUT.split(text) if self.cut else [text]

    def encoded(self, parts: list[str]):
        """The number of ids of each part, from batches balanced by bytes."""
        batch, held = [], 0
        for p in parts:
            batch.append(p)
            held += len(p)
            if held >= BATCH_BYTES:
                yield from map(len, self.tok.encode_batch_fast(batch, add_special_tokens=False))
                batch, held = [], 0
        if batch:
            yield from map(len, self.tok.encode_batch_fast(batch, add_special_tokens=False))

    def counts(self, parts: list[str]) -> list[int]:
        new = list(set(parts).difference(self.table))
        if len(self.table) + len(new) > self.rows:
            self.table.clear()
            new = list(set(parts))
        long = {}
        for p, n in zip(new, self.encoded(new)):
            (self.table if len(p) <= LONGEST else long)[p] = n
        if not long:
            return list(map(self.table.__getitem__, parts))
        return [self.table[p] if len(p) <= LONGEST else long[p] for p in parts]


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of this Python worker, whose table serves task after task."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def group_counts(c: Counter, texts: list[str]):
    """Token counts of each text, worked off in groups of about GROUP_BYTES characters."""
    totals, parts, owner, held = [0] * len(texts), [], [], 0

    def settle():
        at = 0
        for row, k in owner:
            totals[row] += sum(got[at:at + k])
            at += k

    for row, text in enumerate(texts):
        mine = c.parts(text) if text else []
        at = 0
        while at < len(mine):
            take, size = at, 0
            while take < len(mine) and held + size < GROUP_BYTES:
                size += len(mine[take])
                take += 1
            parts += mine[at:take]
            owner.append((row, take - at))
            held, at = held + size, take
            if held >= GROUP_BYTES:
                got = c.counts(parts)
                settle()
                parts, owner, held = [], [], 0
    got = c.counts(parts)
    settle()
    return totals


def _count(path):
    def run(batches):
        c = counter(path)
        for batch in batches:
            yield record_batch(OUT, batch.column(0), batch.column(1),
                               group_counts(c, batch.column(2).to_pylist()))
    return run


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row's whole text."""
    batches_of(df.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                    F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = src.mapInArrow(_count(path or tokenizer_path("byte_bpe_50k.json")),
                             "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
