"""SentencePiece encoding and decoding through a table of distinct marked words.

No piece of the model goes on after a word marker that follows other characters, and the
model joins pieces by rank without looking further, so a text's pieces are those of its
marked words (a run of markers and what follows up to the next) one after another. Each
distinct marked word is segmented once and its ids are put back at every place where it
stands. The table starts anew when full. A model with longer or user-defined pieces, or
one that changes its text first, is not cut (:func:`cuts_at_markers`).

Defined cases: null and empty texts have no ids and decode to the empty text. Equal texts
get equal results. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, record_batch
from .wordtokens import tokenizer_path

MARKER = "▁"
TABLE_ROWS = 600_000
MARKED = re.compile(" +[^ ]*")
#: Strings that show whether a model changes its text.
PROBES = ("a  b", " a ", "a b", "ﬁ é", "Ａ", "a\tb\nc", "   ")

OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                 ("decoded_sha256", pa.string())])


def cuts_at_markers(model) -> bool:
    names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    if any(MARKER in p.lstrip(MARKER) for p in names):
        return False
    own = [k for k, p in enumerate(names) if not (model.is_control(k) or model.is_unknown(k)
                                                  or model.is_byte(k) or model.is_unused(k))]
    # A user-defined piece has score 0 wherever it stands in the vocabulary.
    if any(model.get_score(k) == 0 for k in own[1:]):
        return False
    return all(model.decode(model.encode(p)) == p for p in PROBES)


class Pieces:
    def __init__(self, path: str, rows: int = TABLE_ROWS):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cut, self.rows = cuts_at_markers(self.model), rows
        self.table: dict[str, tuple] = {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if not self.cut:
            return self.model.encode(text, num_threads=1)
        # The model puts a marker before the text and takes a marker in it for a space.
        words = MARKED.findall(" " + text.replace(MARKER, " "))
        table = self.table
        new = set(words).difference(table)
        if new:
            if len(table) + len(new) > self.rows:
                self.table = table = {}
                new = set(words)
            new = list(new)
            # Encoding adds the first marker itself; a lone marker is not an empty text.
            plain = [w for w in new if w != " "]
            for w, ids in zip(plain, self.model.encode([w[1:] for w in plain], num_threads=1)):
                table[w] = tuple(ids)
            if len(plain) < len(new):
                table[" "] = (self.model.piece_to_id(MARKER),)
        return list(itertools.chain.from_iterable(map(table.__getitem__, words)))

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


_models: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The model of this Python worker, whose table serves task after task."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def _digests(path):
    def run(batches):
        model = pieces_of(path)
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = model.encode(t)
                rows.append((i, len(ids),
                             hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256(model.decode(ids).encode()).hexdigest()))
            yield record_batch(OUT, *(zip(*rows) if rows else [[]] * 4))
    return run


def _ids(path):
    def run(batches):
        model = pieces_of(path)
        for batch in batches:
            got = [model.encode(t) for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(got, pa.list_(pa.int32()))], names=["row", "ids"])
    return run


def encode(df: DataFrame, text_col: str = "text", model: str | None = None) -> DataFrame:
    """A struct ``row`` of the input columns, and ``ids``."""
    batches_of(df.sparkSession)
    src = df.select(F.struct("*").alias("row"), F.col(text_col).alias("t"))
    return src.mapInArrow(_ids(model or tokenizer_path("piece_bpe_32k.model")),
                          src.select("row").schema.add("ids", "array<int>"))


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               model: str | None = None) -> DataFrame:
    """Ids and decoded text of each document, as digests."""
    batches_of(df.sparkSession)
    return df.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        _digests(model or tokenizer_path("piece_bpe_32k.model")),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
