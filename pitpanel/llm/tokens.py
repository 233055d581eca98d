"""Encoding whole texts fast with the ``tokenizers`` library.

Byte-level BPE encodes a text piece by piece: wherever a single space or line break stands between two
characters that are not white space, the text can be cut before it, since no
pre-token spans such a place (nor one between two line breaks, if there are no more). Pieces repeat (words), so a worker keeps the ids of those it has met. A
piece it has not met is cut into its pre-tokens ("word", ".", a line break), which repeat far more than
the pieces do, and only pre-tokens that are new to the worker go to the library's BPE model. What
a worker keeps is bounded (``KEEP_TOKENS`` entries, the first it meets, the frequent ones among them);
whatever is not kept is encoded again.

Pieces are cut into pre-tokens here only where that rule leaves no doubt: a byte-level
pre-tokenizer with its usual pattern, ASCII and Latin-1 letters. Any other piece is encoded by the library as a whole, and a text
with an added token or other spacing (double spaces, a space beside a line break or at the end) too. The result equals encoding whole texts (tested).
"""

from __future__ import annotations

import json
import re
import threading
from array import array

import numpy as np

KEEP_PIECES = 600_000          # entries up to which pieces of several pre-tokens are kept by a worker
KEEP_TOKENS = 1_100_000        # entries up to which pre-tokens are kept, about 150 bytes each
MAX_PIECE = 100                # characters; longer pieces are not kept
_LOCK = threading.Lock()
_MADE: dict = {}

# Where the byte-level pattern's classes are the same in every version of Unicode, and the pattern there.
PLAIN = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PRE_TOKENS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")


def byte_characters() -> list:
    """The character that stands for each byte in a byte-level vocabulary: printable ones stand for
    themselves, the others for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in plain)}
    return [chr(others.get(b, b)) for b in range(256)]


# A space or line break beside other white space, three line breaks, or white space at the end: the text cannot be cut
# at every one. Most texts have only spaces and line breaks, and are looked through for pairs of them; others by the pattern.
ODD = re.compile(r"[ \n][^\S\n]|[^\S\n][ \n]|\n\n\n|\s\Z")
RARE_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")


def is_odd(text: str) -> bool:
    if " " not in text and "\n" not in text:
        return False
    if "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text or text[-1].isspace():
        return True
    return any(c in text for c in RARE_SPACES) and ODD.search(text) is not None


class Pieces(dict):
    """Piece, without the space before it, or with the line break that it begins with -> ids; a piece not held is encoded, and held while there is room."""

    def __init__(self, encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        return self.encoder.encode_piece(piece)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = Pieces(self)
        self.inner: dict = {}                # pre-token with no space before it -> ids
        self.byte_lengths = None
        self.added = [a.content for a in self.tokenizer.get_added_tokens_decoder().values()]
        described = json.loads(self.tokenizer.to_str())
        pre = described.get("pre_tokenizer") or {}
        self.cuts = (described.get("normalizer") is None and pre.get("type") == "ByteLevel"
                     and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        self.model = self.tokenizer.model
        self.mapped = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})

    def _encode(self, texts: list) -> list:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, text: str) -> bool:
        return is_odd(text) or any(a in text for a in self.added)

    def _keep(self, store: dict, key: str, ids: bytes, most: int) -> bytes:
        if len(key) <= MAX_PIECE and len(self.pieces) + len(self.inner) < most:
            store[key] = ids
        return ids

    def _token(self, token: str) -> bytes:
        """Ids of one pre-token, from the model."""
        chars = token.encode().decode("latin-1").translate(self.mapped)
        return array("I", [t.id for t in self.model.tokenize(chars)]).tobytes()

    def encode_piece(self, piece: str) -> bytes:
        """Ids of a piece and the space before it; a piece that begins with a line break has none."""
        text = piece if piece[0] == "\n" else " " + piece
        if self.cuts and piece.isascii() and piece.isalpha():                      # one pre-token
            return self._keep(self.pieces, piece, self._token(text), KEEP_TOKENS)
        if not self.cuts or not PLAIN.fullmatch(piece):
            return self._keep(self.pieces, piece, self._encode([text])[0], KEEP_PIECES)
        tokens = PRE_TOKENS.findall(text)
        first, inner = tokens[0], self.inner
        if len(tokens) == 1:
            return self._keep(self.pieces, piece, self._token(text), KEEP_TOKENS)
        parts, rest = [], tokens
        if first[0] == " ":
            rest = tokens[1:]
            parts = [self.pieces.get(first[1:]) or self._keep(self.pieces, first[1:], self._token(first), KEEP_TOKENS)]
        for t in rest:
            parts.append(inner.get(t) or self._keep(inner, t, self._token(t), KEEP_TOKENS))
        return self._keep(self.pieces, piece, b"".join(parts), KEEP_PIECES)

    def encode(self, texts: list) -> list:
        """Ids of each text as little-endian unsigned 32-bit integers (bytes)."""
        if self.cuts:
            cut = [[t] if self._whole(t) else t.replace("\n", " \n").split(" ") for t in texts]
        else:
            cut = [[t] if self._whole(t) or "\n" in t else t.split(" ") for t in texts]
        get = self.pieces.__getitem__
        return [first + b"".join(map(get, c[1:])) for first, c in zip(self._encode([c[0] for c in cut]), cut)]

    def lengths(self) -> np.ndarray:
        """Bytes of text per id, for byte-level vocabularies (one character per byte)."""
        if self.byte_lengths is None:
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            added = set(self.added)
            n = np.zeros(max(vocab.values(), default=0) + 1, dtype=np.int64)
            for token, i in vocab.items():
                n[i] = len(token.encode()) if token in added else len(token)
            self.byte_lengths = n
        return self.byte_lengths


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; the file is read on the worker."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    with _LOCK:
        if path not in _MADE:
            _MADE[path] = Encoder(path)
        return _MADE[path]


def slices(batch_texts: list, limit: int = 1 << 20):
    """Index ranges of about ``limit`` characters, so that a task holds few ids at a time."""
    i = 0
    while i < len(batch_texts):
        j, size = i, 0
        while j < len(batch_texts) and (j == i or size + len(batch_texts[j]) <= limit):
            size += len(batch_texts[j])
            j += 1
        yield i, j
        i = j
