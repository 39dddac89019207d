"""Token ids of texts by the ``tokenizers`` library, as bytes of little-endian unsigned 32-bit numbers.

A byte-level tokenizer splits a text before it merges bytes, and always splits
between two non-space characters that one space or one line break separates,
and between a letter and punctuation after it.  So pieces and words between
such places go to the library's model once per worker and are kept in bounded
tables.  Texts with other white space, and tokenizers of another kind, go to the
library whole.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: End of a document.
END_ID = 0
END = np.array([END_ID], dtype="<u4").tobytes()
#: Pieces, and words, kept per worker at most, some 100 MB together; a full table is emptied.
KEPT_PIECES = 250_000
#: The same where a worker does little else.
MANY_PIECES = 900_000
_LINE_BREAK = "\n"
_PLAIN_SPACE = " \n"
#: What a text has if its white space is not all single spaces and line breaks; and the mark that cuts pieces.
_UNUSUAL = ("\0", "  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in _PLAIN_SPACE))


def default_tokenizer() -> str:
    """Path of the byte-level vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Pieces(dict):
    """Ids of a piece; what is not there yet is asked of the library and kept."""

    def __init__(self, tokenizer, kept: int) -> None:
        super().__init__()
        self.kept = kept
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.words: dict[str, bytes] = {}
        self.ids = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        self.symbols = _byte_symbols(tokenizer.pre_tokenizer)

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.kept:
            self.clear()
        core = piece.rstrip(string.punctuation)
        if core.removeprefix(" ").isalpha():
            found = self._word(core)
            if len(core) < len(piece):
                found += self._word(piece[len(core) :])
        else:
            found = b"".join([self.ids[i] for i in self.tokenizer.encode(piece, add_special_tokens=False).ids])
        self[piece] = found
        return found

    def _word(self, word: str) -> bytes:
        """Ids of what the tokenizer does not split."""
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= self.kept:
                self.words.clear()
            symbols = word.encode().decode("latin-1").translate(self.symbols)
            found = self.words[word] = b"".join([self.ids[token.id] for token in self.model.tokenize(symbols)])
        return found


def _byte_symbols(pre_tokenizer) -> dict[int, str]:
    """The character by which the model knows each byte, asked of the library."""
    symbols: dict[int, str] = {}
    for code in (*range(0x800), *range(0x800, 0xD800, 0x400), *range(0xE000, 0x10000, 0x400), *range(0x10000, 0x110000, 0x1000)):
        shown = "".join(part for part, _ in pre_tokenizer.pre_tokenize_str(chr(code)))
        symbols.update(zip(chr(code).encode(), shown, strict=True))
    return symbols


class Encoder:
    """Encodes lists of texts; special tokens in a text are ordinary text."""

    def __init__(self, path: str, kept: int = KEPT_PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        before = self.tokenizer.pre_tokenizer
        splits = isinstance(before, ByteLevel) and [p for p, _ in before.pre_tokenize_str("a b")] == ["a", before.pre_tokenize_str(" b")[0][0]]
        alone = splits and self.tokenizer.normalizer is None and isinstance(self.tokenizer.model, BPE)
        self.pieces = _Pieces(self.tokenizer, kept) if alone else None

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, without the end id."""
        split = [None if self.pieces is None else _pieces(text) for text in texts]
        whole = [text for text, pieces in zip(texts, split, strict=True) if pieces is None]
        others = iter(self._whole(whole) if whole else [])
        return [next(others) if pieces is None else b"".join(map(self.pieces.__getitem__, pieces)) for pieces in split]


def _pieces(text: str) -> list[str] | None:
    """Pieces that are encoded alike anywhere, or None where white space is not all single spaces and line breaks."""
    if not text or text[0] in _PLAIN_SPACE or text[-1] in _PLAIN_SPACE or any(part in text for part in _UNUSUAL):
        return None
    return text.replace(" ", "\0 ").replace(_LINE_BREAK, "\0\n\0").split("\0")


@cache
def encoder(path: str, kept: int = KEPT_PIECES) -> Encoder:
    return Encoder(path, kept)


def encoded(
    path: str, batches: Iterator[pa.RecordBatch], text: str = "text", rows: int = 512, kept: int = KEPT_PIECES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the input beside the ids of their texts, each with the end id; null counts as empty."""
    encode = encoder(path, kept).encode
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part, [ids + END for ids in encode([x or "" for x in part.column(text).to_pylist()])]
