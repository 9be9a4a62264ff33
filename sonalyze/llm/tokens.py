"""Token ids by the tokenizers library, with a cache of words that the library has already cut."""

from __future__ import annotations

from array import array

import numpy as np

#: Words kept with their ids in each Python worker; beyond it the cache starts anew.
CACHED_WORDS = 1_000_000
#: The library's own cutting rule for byte-level vocabularies (fixed value), letters first for speed: no
#: token crosses one of these pieces.
PIECES = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Marks that end words; a run of them is one piece.
ENDS = ".,;:!?"

_loaded: dict[str, "Encoder"] = {}


def byte_characters() -> dict[int, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class Known(dict):
    """Ids of the text between two spaces, with the space before it; a line break stands without one."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        e = self.encoder
        if chunk.isalpha():  # one piece
            found = array(e.code, [t.id for t in e.tokenize(e.space + (chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(e.characters)))]).tobytes()
        elif (word := chunk.rstrip(ENDS)) and word.isalpha():  # the word, and the marks as another piece
            found = self[word] + e.marks(chunk[len(word) :])
        else:
            found = e.cut_blob(chunk if chunk[:1] == "\n" else " " + chunk)
        self[chunk] = found
        return found


class Encoder:
    """encode(text) gives the ids that Tokenizer.encode gives; every id comes from the library.

    Where no two blanks meet, a token never crosses the place before a space or a line break, so the text
    between two of these always has the same ids.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.library = Tokenizer.from_file(path)
        pre = config.get("pre_tokenizer") or {}
        self.by_word = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not config.get("normalizer")
        self.special = [t["content"] for t in config.get("added_tokens", [])]
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.cut = regex.compile(PIECES).findall
        self.known = Known(self)
        self.ends: dict[str, bytes] = {}
        self.tokenize = self.library.model.tokenize
        self.characters = byte_characters()
        self.space = chr(self.characters[0x20])

    def cut_blob(self, text: str) -> bytes:
        out = array(self.code)
        for p in self.cut(text):
            out.extend([t.id for t in self.tokenize(p.encode().decode("latin-1").translate(self.characters))])
        return out.tobytes()

    def marks(self, text: str) -> bytes:
        if text not in self.ends:
            self.ends[text] = self.cut_blob(text)
        return self.ends[text]

    def blob(self, text: str) -> bytes:
        """The ids as unsigned integers of kind."""
        if not text:
            return b""
        if not self.by_word or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        flat = text.replace("\n", " ")
        # printable: its only blanks are spaces
        if "  " in flat or flat[0] == " " or flat[-1] == " " or not flat.isprintable():
            return self.cut_blob(text)
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
            self.ends.clear()
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.cut_blob(first) + b"".join(map(self.known.__getitem__, rest))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.blob(text), self.kind)


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _loaded:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _loaded[path] = Encoder(path)
    return _loaded[path]


def release() -> None:
    """Drop the encoders of this worker."""
    _loaded.clear()
