"""Token ids of whole texts with a public tokenizer file, by word, with a memo.

The word tokenizer never joins pieces across white space, so a text's ids are
the ids of its space- and newline-separated chunks. A worker keeps a memo
chunk -> ids; a missing chunk of plain Latin letters and signs is split by the
file's own rule and goes straight to the library's model, any other chunk goes
through the library's whole chain (normaliser, splitter, added tokens).
"""

from __future__ import annotations

import os
import sys
from array import array

import numpy as np
import regex

from fanline.llm.common import claim, hold, text_of

WORD_BPE = "word_bpe_49k.json"
#: appended to every document
END_ID = 1
#: entries of a worker's memo; it is emptied when full
MEMO_CHUNKS = 700_000

# fixed values: the tokenizer file's split rule, and its byte alphabet (printable
# Latin-1 bytes stand for themselves, the others for code points from 256 on)
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_REST = [b for b in range(256) if b not in _OWN]
_ALPHABET = {**{b: b for b in _OWN}, **{b: 256 + k for k, b in enumerate(_REST)}}

#: characters that normalisation leaves alone but for simple lower case
_PLAIN = regex.compile("[!-~¡-¬®-įı-ɏ]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_BPE)


class WordEncoder(dict):
    """Memo chunk -> little-endian unsigned 16- or 32-bit ids of one tokenizer file."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.split = regex.compile(SPLIT_RULE).findall
        # bytes hold no references, so the garbage collector never walks the memos
        self.pieces: dict[str, bytes] = {}
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype, self.code = ("<u2", "H") if small else ("<u4", "I")
        self.plain = self._follows_rule(path)

    @staticmethod
    def _follows_rule(path: str) -> bool:
        """Whether the file splits and normalises as the short way assumes."""
        import json

        with open(path, encoding="utf-8") as f:
            head = json.load(f)
        kinds = [x["type"] for x in (head.get("normalizer") or {}).get("normalizers", [])]
        splits = (head.get("pre_tokenizer") or {}).get("pretokenizers", [])
        rule = splits[0].get("pattern", {}).get("Regex") if splits else None
        added = all(x["content"].startswith("<|") for x in head.get("added_tokens", []))
        return kinds == ["NFC", "Replace", "Lowercase"] and rule == SPLIT_RULE and added

    def _packed(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _piece(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_ALPHABET)
        out = self.pieces[piece] = self._packed([x.id for x in self.model.tokenize(mapped)])
        return out

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= MEMO_CHUNKS:
            self.clear()
            self.pieces.clear()
        known = self.pieces.get
        out = b"".join([known(x) or self._piece(x) for x in self._pieces(chunk)])
        if not out and chunk:
            out = self._packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        self[chunk] = out
        return out

    def _pieces(self, chunk: str) -> list[str]:
        """Lower-case pieces of a plain chunk by the split rule; none of another."""
        if not self.plain:
            return []
        if chunk.isascii():  # the commonest forms: a word, a word and a sign
            if chunk.isalpha():
                return [chunk.lower()]
            if chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":
                return [chunk[:-1].lower(), chunk[-1]]
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return self.split(chunk.lower())
        return []

    def encode(self, text) -> np.ndarray:
        """Ids of a whole text (NULL: none) with the end id."""
        chunks = text_of(text).replace("\n", " ").split(" ")
        raw = b"".join(map(self.__getitem__, chunks))
        return np.frombuffer(raw + np.array([END_ID], self.dtype).tobytes(), self.dtype)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file (kept between tasks)."""
    claim("tokens")
    if path not in _encoders:
        enc = _encoders[path] = WordEncoder(path)
        hold("tokens", enc)
        hold("tokens", enc.pieces)
    return _encoders[path]
