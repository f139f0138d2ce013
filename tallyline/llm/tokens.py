"""Two public tokenizers, read from their vocabulary files, with the bytes of every token; one copy of each per Python worker.

The byte-level BPE's ranks and token bytes come from its JSON file; the merges run in tiktoken, which gives the same ids (tested against
the file's own library). Long texts are encoded in chunks cut before a single space between two other characters (not U+2581), where neither
tokenizer lets a token reach across, so that memory is bounded for texts of any length that have such a place now and then.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import sentencepiece
import tiktoken

FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK = 1 << 18
# fixed value: how byte-level BPE splits text before it merges
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """The text in pieces of about `size` characters; all but the first start with their space."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Tokenizer:
    """Token ids, the bytes of each token, and their lengths."""

    def __init__(self, parts: Sequence[bytes]) -> None:
        self.parts = list(parts)
        self.lengths = np.array([len(p) for p in self.parts], np.int64)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset at which each token ends."""
        return np.cumsum(self.lengths[ids])

    def joined(self, ids: np.ndarray) -> bytes:
        parts = self.parts
        return b"".join([parts[k] for k in ids.tolist()])


class ByteLevel(Tokenizer):
    """Byte-level BPE; `control` strings get the ids after the vocabulary and are found before anything else."""

    def __init__(self, path: str, control: Sequence[str] = ()) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in token): k for token, k in told["model"]["vocab"].items() if token not in special}
        size = 1 + max([*ranks.values(), *special.values()])
        parts = [b""] * size
        for token, k in ranks.items():
            parts[k] = token
        self.control = {c: size + k for k, c in enumerate(control)}
        super().__init__(parts + [c.encode() for c in control])
        self._encoding = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=self.control)

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text; control strings in it are control tokens."""
        some = [self._encoding.encode_to_numpy(c, allowed_special="all") for c in chunks(text)]
        return (some[0] if len(some) == 1 else np.concatenate(some)).astype(np.int64)


class Pieces(Tokenizer):
    """BPE over pieces with byte fallback; a space is put before the text."""

    def __init__(self, path: str) -> None:
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        told = [self._model.id_to_piece(k) for k in range(len(self._model))]
        super().__init__([bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in told])

    def encode(self, text: str) -> np.ndarray:
        some = [np.array(self._model.encode(c if k == 0 else c[1:]), np.int64) for k, c in enumerate(chunks(text))]
        return some[0] if len(some) == 1 else np.concatenate(some)


@functools.cache
def byte_level(folder: str = FOLDER, control: tuple[str, ...] = ()) -> ByteLevel:
    return ByteLevel(f"{folder}/{BYTE_BPE}", control)


@functools.cache
def pieces(folder: str = FOLDER) -> Pieces:
    return Pieces(f"{folder}/{PIECE_BPE}")
