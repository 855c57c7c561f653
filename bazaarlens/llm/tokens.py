"""Public tokenizers inside tasks: one loaded model per worker process."""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from importlib.metadata import version
from pathlib import Path

# Longer texts are encoded in parts, where the tokenizer allows it.
PART_CHARS = 1 << 20
_BLANK = "▁"  # how sentencepiece writes a space

# Fixed value: how byte-level vocabularies of this kind cut texts before they merge bytes.
_BYTE_LEVEL_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def library(tokenizer_file: str) -> str:
    """The library a tokenizer file is for."""
    return {".json": "tokenizers", ".model": "sentencepiece"}[Path(tokenizer_file).suffix]


def version_digest(tokenizer_file: str) -> str:
    """SHA-256 of what ids depend on: the library, its version and the file."""
    name = library(tokenizer_file)
    known = hashlib.sha256(f"{name} {version(name)}\n".encode())
    known.update(Path(tokenizer_file).read_bytes())
    return known.hexdigest()


class PieceTokenizer:
    """A sentencepiece model; special strings inside texts are plain text to it."""

    def __init__(self, tokenizer_file: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=tokenizer_file)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        # No piece goes on behind a word with a space, and the text is taken as it is: then a text may be cut at a single
        # space, which the encoder puts before each part.
        self._cuttable = (
            not any(_BLANK in piece.lstrip(_BLANK) for piece in pieces)
            and self._model.normalize("a  ÅÅﬁ ") == f"{_BLANK}a{_BLANK * 2}ÅÅﬁ{_BLANK}"
        )

    def encoded(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, without any added."""
        if not self._cuttable or max(map(len, texts), default=0) <= PART_CHARS:
            return self._model.encode(texts, num_threads=1)
        single = re.compile(f"(?<![ {_BLANK}]) (?![ {_BLANK}])")
        return [[i for part in _parts(text, single) for i in self._model.encode(part)] for text in texts]

    def token_bytes(self) -> list[bytes]:
        """The bytes each id stands for."""
        model = self._model
        return [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(_BLANK, " ").encode()
            for i in range(model.get_piece_size())
        ]


class JsonTokenizer:
    """Any model of the tokenizers library, with its own defaults for special strings inside texts."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(tokenizer_file)
        self._model.no_truncation()
        self._model.no_padding()

    def encoded(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, without any added."""
        return [one.ids for one in self._model.encode_batch_fast(texts, add_special_tokens=False)]


class ByteTokenizer:
    """A byte-level BPE file of the tokenizers library; special strings inside texts are plain text to it.

    The file's vocabulary is handed to tiktoken, which merges in the same order several times as fast; that the
    file is of the kind for which both agree is checked.
    """

    def __init__(self, tokenizer_file: str):
        import tiktoken

        parts = json.loads(Path(tokenizer_file).read_text(encoding="utf-8"))
        vocabulary, merges = parts["model"]["vocab"], parts["model"]["merges"]
        value = {char: byte for byte, char in enumerate(_byte_chars())}
        special = {token["content"] for token in parts["added_tokens"]}
        self._bytes = {i: bytes(value[c] for c in token) for token, i in vocabulary.items() if token not in special}
        self._special = {token["id"]: token["content"].encode() for token in parts["added_tokens"]}
        joined = [token.replace(" ", "") if isinstance(token, str) else "".join(token) for token in merges]
        in_order = [vocabulary[token] for token in joined]
        cutter = parts["pre_tokenizer"]
        if (
            in_order != list(range(256, 256 + len(merges)))
            or parts["normalizer"]
            or (cutter["type"], cutter["add_prefix_space"], cutter["use_regex"]) != ("ByteLevel", False, True)
        ):
            raise ValueError(f"{tokenizer_file} is no plain byte-level vocabulary in the order of its merges")
        ranks = {token: i for i, token in self._bytes.items()}
        self._model = tiktoken.Encoding("bytes", pat_str=_BYTE_LEVEL_CUTS, mergeable_ranks=ranks, special_tokens={})

    def encoded(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, without any added."""
        # Words take at most one space, in front.
        before_space = re.compile(r"(?<=\S)(?= \S)")
        return [[i for part in _parts(text, before_space) for i in self._model.encode_ordinary(part)] for text in texts]

    def token_bytes(self) -> list[bytes]:
        """The bytes each id stands for."""
        known = self._bytes | self._special
        return [known.get(i, b"") for i in range(max(known) + 1)]


def _parts(text: str, cut: re.Pattern) -> list[str]:
    """The text, or if it is long, parts of about PART_CHARS that end where ``cut`` matches."""
    parts, at = [], 0
    while len(text) - at > PART_CHARS:
        found = cut.search(text, at + PART_CHARS, len(text) - 1)
        if found is None:
            break
        parts.append(text[at : found.start()])
        at = found.end()
    return [*parts, text[at:]]


def _byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones are themselves, the others are
    counted up from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=2)
def tokenizer(tokenizer_file: str) -> PieceTokenizer | JsonTokenizer:
    """The file's own library; kept for all tasks that a worker process runs."""
    return PieceTokenizer(tokenizer_file) if library(tokenizer_file) == "sentencepiece" else JsonTokenizer(tokenizer_file)


@lru_cache(maxsize=2)
def byte_tokenizer(tokenizer_file: str) -> ByteTokenizer:
    """Kept for all tasks that a worker process runs."""
    return ByteTokenizer(tokenizer_file)
