"""Byte-pair encoding of any text: the tokenizer's own code, with long runs of
white space, which its pattern can't take, cut into pieces beforehand."""

from __future__ import annotations

import re

import regex
import tiktoken

# Fixed value: how these vocabularies cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = re.compile(r"\s{2000}")


def encoding(name: str, ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """An encoding without special tokens."""
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(bpe: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a text.  Pieces are merged one by one whichever way they are cut."""
    if not LONG_RUN.search(text):
        return bpe.encode_ordinary(text)
    return [i for piece in regex.findall(PATTERN, text) for i in bpe._encode_single_piece(piece.encode("utf-8"))]
