"""Ids of public tokenizers, by way of each distinct space-separated chunk.

Both vocabularies split text before the merges, and a single space between two other characters is always
such a split. So a chunk's ids do not depend on its neighbours, and one encoding per distinct chunk is enough.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
#: Entries that a worker's caches of chunks and of their parts hold; what comes after is worked out each time.
CACHE, PARTS = 200_000, 300_000


@functools.lru_cache
def library(name: str):
    """The tokenizer at a path, or by its name among the public ones."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if os.path.sep in name else public_tokenizers.path(name))


@functools.lru_cache
def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: a byte that prints stands for itself, each other one for the next letter from 256."""
    shows = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shows]
    return {b: chr(256 + hidden.index(b)) for b in hidden}


def in_bytes(text: str) -> str:
    return text.encode().decode("latin-1").translate(byte_letters())


#: Printing ASCII and the Latin-1 letters: for these, Python's classes and the library's agree.
PLAIN = re.compile("[!-~À-ÿ]+")
WORD_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


class WordIds(dict):
    """Chunk -> its ids as little-endian unsigned 32-bit bytes, for a vocabulary that drops white space."""

    def __init__(self, name: str = WORD_BPE):
        super().__init__()
        self.tokenizer = library(name)
        self.parts: dict[str, bytes] = {}
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]

    def part(self, pre_token: str) -> bytes:
        ids = np.array([x.id for x in self.tokenizer.model.tokenize(in_bytes(pre_token))], "<u4").tobytes()
        if len(self.parts) < PARTS and len(pre_token) <= 32:
            self.parts[pre_token] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        if PLAIN.fullmatch(chunk) and not ("<|" in chunk and any(x in chunk for x in self.special)):
            parts = self.parts
            ids = b"".join([parts.get(x) or self.part(x) for x in WORD_PARTS.findall(chunk.lower())])
        else:
            ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < CACHE and len(chunk) <= 32:
            self[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """All ids of a text, four bytes each."""
        return b"".join([self[x] for x in text.replace("\n", " ").split(" ") if x])


@functools.lru_cache
def word_ids(name: str = WORD_BPE) -> WordIds:
    return WordIds(name)


#: Two white spaces together, or one at either end: such texts are split by the library as a whole.
LOOSE = re.compile(r"\s\s|\A\s|\s\Z")


PLAIN_LOOSE = re.compile("[\n -~À-ÿ]*")
BYTE_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class PreTokens(dict):
    """Chunk -> its pre-tokens as the byte-level library cuts them; each special string in it is None."""

    def __init__(self, name: str = BYTE_BPE):
        super().__init__()
        self.tokenizer = library(name)
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or r"(?!)")

    def between(self, text: str) -> list[str]:
        if PLAIN_LOOSE.fullmatch(text):
            return BYTE_PARTS.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def cut(self, text: str) -> list[str | None]:
        """Every pre-token of a text in order; None for each special string in it."""
        out: list[str | None] = []
        at = 0
        for m in self.special.finditer(text):
            out += self.between(text[at : m.start()])
            out.append(None)
            at = m.end()
        return out + self.between(text[at:])

    def __missing__(self, chunk: str) -> list[str | None]:
        got = self.cut(chunk)
        if len(self) < CACHE and len(chunk) <= 32:
            self[chunk] = got
        return got

    def chunks(self, text: str) -> list[str]:
        """Stretches of a text that can be cut apart from each other: its words, each with its leading space."""
        if LOOSE.search(text) or not text:
            return [text]
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def pieces(self, pre_token: str) -> int:
        return len(self.tokenizer.model.tokenize(in_bytes(pre_token)))


@functools.lru_cache
def pre_tokens(name: str = BYTE_BPE) -> PreTokens:
    return PreTokens(name)
