"""Whole texts to token ids with the tokenizers library, each distinct chunk once.

The word tokenizer drops white space before it splits, and no rule of it looks across a
space or a line feed, so a text's ids are those of its chunks between these, in order.
A table of the chunks seen so far spares encoding the frequent ones again; it starts anew
when it is full, so its memory is bounded.
"""

from __future__ import annotations

import os
import re
import struct

import public_tokenizers

#: The id appended to each document.
END_ID = 2
TABLE_ROWS, WORD_ROWS = 500_000, 1_200_000
#: Latin-1 letters, then punctuation that neither joins them nor starts a special token: the
#: tokenizer lower-cases the letters one for one and splits between the two.
WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:$%&*#|)]*)")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


def _packed(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Words(dict):
    """Ids of lower-case words and punctuation. ASCII ones reach the tokenizer's model as
    they are and in one piece, so the model alone is asked."""

    def __init__(self, tok, rows: int):
        self.tok, self.rows = tok, rows

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.rows:
            self.clear()
        if word.isascii():
            ids = _packed([p.id for p in self.tok.model.tokenize(word)]) if word else b""
        else:
            ids = _packed(self.tok.encode(word, add_special_tokens=False).ids)
        self[word] = ids
        return ids


class _Chunks(dict):
    """Ids of chunks, each looked up once; an unknown one is put together from its word
    and punctuation where it is only that."""

    def __init__(self, tok, rows: int):
        self.tok, self.rows, self.words = tok, rows, _Words(tok, WORD_ROWS)

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.rows:
            self.clear()
        if m := WORD.fullmatch(chunk):
            word, rest = m.groups()
            ids = self.words[word.lower()] + self.words[rest]
        else:
            ids = _packed(self.tok.encode(chunk, add_special_tokens=False).ids)
        self[chunk] = ids
        return ids


class Encoder:
    def __init__(self, path: str, rows: int = TABLE_ROWS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tok = self.tok = Tokenizer.from_file(path)
        self.table = _Chunks(tok, rows)
        self.vocabulary = tok.get_vocab_size()

    def entries(self) -> int:
        return len(self.table) + len(self.table.words)

    def forget(self) -> None:
        """Start the tables anew; results stay the same."""
        self.table.clear()
        self.table.words.clear()

    def id_bytes(self, text: str | None, end: int | None = END_ID) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers, then the end id."""
        chunks = (text or "").replace("\n", " ").split(" ")
        tail = b"" if end is None else end.to_bytes(4, "little")
        return b"".join([*map(self.table.__getitem__, chunks), tail])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, whose table serves task after task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
