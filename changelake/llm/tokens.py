"""Token ids of whole texts by a tokenizer file, word by word with a bounded cache.

The tokenizer must never let a token span ASCII white space (true of files whose pre-tokenizer drops white space, as
word_bpe_49k.json does): then the ids of a text are the ids of its words in turn, and a word met before costs one
look-up. Words over WORD_BYTES, and new ones once CACHE_WORDS are kept, are encoded each time. Words of lower-case letters
go to the tokenizer's model at once if the file leaves such words as they are, which samples of them tell.
"""

from __future__ import annotations

import os
from array import array
from unicodedata import is_normalized

CACHE_WORDS = 800_000
WORD_BYTES = 40
SPECIAL = b"<|"
#: Letters before this one are Latin, Greek or Cyrillic, and have long been in Unicode.
BEYOND = "\u0530"
SAMPLES = ("a", "word", "don", "größe", "ñandú", "слово", "λόγος", "œuvre")
#: Byte-level files write a byte that isn't a visible character of Latin-1 as one of those from 256 on, in order.
BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173))}
_encoders: dict[str, "Encoder"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(text: bytes) -> list[bytes]:
    """Words that encode independently. Lower-casing ASCII changes no id, but meets the cache more often; a text that may
    hold a special token's string stays as it is."""
    return text.split() if SPECIAL in text else text.lower().split()


def letters(text: str) -> bool:
    """Whether text is one run of letters that no normalizer changes."""
    return text.isalpha() and (text.isascii() or max(text) < BEYOND and is_normalized("NFC", text)) and text == text.lower()


class Encoder(dict):
    """The cache itself: the ids (little-endian u32) of each piece that was met; a piece that wasn't is encoded when asked for."""

    def __init__(self, path: str, most: int):
        super().__init__()
        self.most = most
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.ids_of, self.tokens_of = tokenizer.encode, tokenizer.model.tokenize
        self.direct = all(self.by_model(w.encode()) == self.whole(w) for w in SAMPLES)

    def whole(self, text: str) -> list[int]:
        """The ids by the whole tokenizer."""
        return self.ids_of(text, None, False, False).ids

    def by_model(self, piece: bytes) -> list[int]:
        """The ids by the model alone, past normalizers and pre-tokenizers."""
        return [t.id for t in self.tokens_of(piece.decode("latin-1").translate(BYTE_CHARS))]

    def __missing__(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        if piece[-1] in b".," and len(text) > 1 and text[-2] < BEYOND and text[-2].lower().isalpha():
            # A full stop or comma between a letter and white space is a token of its own.
            ids = self[piece[:-1]] + self[piece[-1:]]
        else:
            ids = array("I", self.by_model(piece) if self.direct and letters(text) else self.whole(text)).tobytes()
        if len(piece) <= WORD_BYTES and len(self) < self.most:
            self[piece] = ids
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        return [b"".join(map(self.__getitem__, pieces(t))) for t in texts]


def forget() -> None:
    """Drops what this worker has cached."""
    _encoders.clear()


def encoder(path: str, most: int = CACHE_WORDS) -> Encoder:
    """One encoder a worker process, with a cache of at most `most` words (about 250 bytes each); tasks that follow reuse it."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, most)
    return _encoders[path]
