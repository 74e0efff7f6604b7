"""Exact, fast encoding with the ``tokenizers`` library through caches of chunks and pre-tokens.

Neither supported vocabulary merges across a blank that follows another kind of character, so a
text's ids are the concatenation of its chunks' ids, a chunk being a blank and what follows it up to
the next one, or a line break by itself.  A chunk is looked up; one not seen yet is cut by the
vocabulary's own pre-tokenizer pattern into pre-tokens, which the library's model encodes once each.
Wherever that argument could fail (unusual white space, characters outside the Latin blocks) the
library encodes the whole text or chunk itself.  Caches are emptied when full, which costs time and
never changes ids; where white space is removed, a full cache of chunks is kept aside until the next
one is full, so that chunks that come again and again are not lost.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import regex

#: Entries at which a worker's caches are emptied; these bound memory only.
CHUNK_ENTRIES, PIECE_ENTRIES = 300_000, 600_000

_UNUSUAL_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
_UNUSUAL_BYTES = bytes([*range(0x09, 0x0A), *range(0x0B, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0])
_BEYOND_LATIN = re.compile("[İɐ-\U0010ffff]")
#: Fixed values of the public vocabulary files: the patterns that split text before merges.
_KEEPING = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_DROPPING = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _plain(text: str) -> bool:
    """Whether no character of the text needs the library's own way."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return not (_BEYOND_LATIN.search(text) or _UNUSUAL_SPACE.search(text))
    return len(raw.translate(None, _UNUSUAL_BYTES)) == len(raw)


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


_LETTERS = _byte_letters()


class ChunkEncoder:
    """ids of whole texts as little-endian ``uint16`` or ``uint32`` bytes (``dtype``).

    ``drops_space``: the vocabulary lower-cases and removes white space before merging.
    ``specials``: the string of a special token inside a text is that token, as the library has it by
    default (it encodes such a text whole); else it is ordinary text.
    """

    def __init__(self, path: str, drops_space: bool, specials: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not specials
        names = [t.content for t in self.tok.get_added_tokens_decoder().values()] if specials else []
        self.starts = tuple({x[0] for x in names})
        self.special = re.compile("|".join(map(re.escape, names)), re.IGNORECASE) if names else None
        self.model = self.tok.model
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 0xFFFF else np.dtype("<u4")  # the same letters name array()'s types
        self.drops_space = drops_space
        # Where blanks are kept most chunks are pieces, and a piece by itself has the same ids: one cache holds both.
        # Lower-cased chunks without white space repeat more, so fewer entries do: two caches of chunks, the last full
        # one and the one being filled, and one of the pieces that are in neither.
        both = CHUNK_ENTRIES + PIECE_ENTRIES
        self.most_chunks, self.most_pieces = (CHUNK_ENTRIES // 2, PIECE_ENTRIES // 8) if drops_space else (both, both)
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {} if drops_space else self.chunks

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _model(self, piece: str) -> bytes:
        """The library's ids of a piece."""
        word = piece[1:] if piece[:1] == " " else piece
        if word.isascii() and word.isalpha():
            letters = piece.replace(" ", _LETTERS[0x20])
        else:
            letters = piece.encode().decode("latin-1").translate(_LETTERS)
        return array(self.dtype.char, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Of a piece that is not among pieces: it may be held as a chunk."""
        found = self.chunks.get(piece) or self.older.get(piece)
        if found is None:
            if len(self.pieces) >= self.most_pieces:
                self.pieces.clear()
            self.pieces[piece] = found = self._model(piece)
        return found

    def _chunk(self, chunk: str, checked: bool) -> bytes:
        """Of a chunk that no cache of chunks holds; checked: its text has no character that needs the library's own way."""
        if not checked and not _plain(chunk):
            return self.whole(chunk)
        get = self.pieces.get
        word = chunk[1:] if chunk[:1] == " " else chunk
        if word.isalpha():  # most chunks, without the pattern
            piece = word.lower() if self.drops_space else chunk
            if piece == chunk:  # the caller holds it as a chunk, so it is no entry among pieces
                return get(piece) or self._model(piece)
            return get(piece) or self._piece(piece)
        if word[-1:] in (".", ",") and word[:-1].isalpha():
            piece = word[:-1].lower() if self.drops_space else chunk[:-1]
            return (get(piece) or self._piece(piece)) + (get(word[-1]) or self._piece(word[-1]))
        found = _DROPPING.findall(chunk.lower()) if self.drops_space else _KEEPING.findall(chunk)
        return b"".join([get(p) or self._piece(p) for p in found])

    def _set_aside(self) -> None:
        """Empties the full cache of chunks; where white space is removed, it takes the older one's place."""
        self.older.clear()
        if self.drops_space:
            self.older.update(self.chunks)
        self.chunks.clear()

    def forget(self) -> None:
        for cache in (self.chunks, self.older, self.pieces):
            cache.clear()

    def _split(self, text: str, plain: bool) -> list[str] | None:
        """Chunks whose ids concatenate to the text's ids, or None where the text must be encoded whole."""
        if self.drops_space:
            return (text.lower() if plain else text).replace("\n", " ").split(" ")
        if "  " in text or "\n " in text or text[-1] == " " or not plain and _UNUSUAL_SPACE.search(text):
            return None
        if "\0" in text:
            first, *rest = text.split(" ")
            return [first, *[" " + x for x in rest]]
        # The last line break of a run is a pre-token, those before it are another, all of them at a text's end are one.
        if "\n\n\n" not in text and " \n" not in text and text[-2:] != "\n\n":
            text = text.replace("\n", "\0\n\0")
        return text.replace(" ", "\0 ").split("\0")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One id string for each text; null and empty texts give no ids."""
        out: list[bytes] = []
        for text in texts:
            if not text:
                out.append(b"")
                continue
            if self.special and any(x in text for x in self.starts) and self.special.search(text):
                out.append(self.whole(text))
                continue
            plain = _plain(text)
            parts = self._split(text, plain)
            if parts is None:
                out.append(self.whole(text))
                continue
            cache, older = self.chunks, self.older
            found = [*map(cache.get, parts)]  # kept here, so that a cache may be emptied at any miss
            if None in found:
                for i in [i for i, x in enumerate(found) if x is None]:
                    p = parts[i]
                    if (ids := cache.get(p)) is None:
                        if len(cache) >= self.most_chunks:
                            self._set_aside()
                        if (ids := older.get(p)) is None:
                            ids = self._chunk(p, plain)
                        cache[p] = ids
                    found[i] = ids
            out.append(b"".join(found))
        return out


_encoders: dict[tuple[str, bool, bool], ChunkEncoder] = {}


def encoder(path: str, drops_space: bool, specials: bool = True) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file; made once in each Python worker, one at a time."""
    key = path, drops_space, specials
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = ChunkEncoder(path, drops_space, specials)
    return _encoders[key]


def forget() -> None:
    """Empties the caches of the worker's encoder; workers outlive the tasks that need them.  The vocabulary stays for the next task."""
    for enc in _encoders.values():
        enc.forget()
