"""Byte-level BPE ids: a slice of texts is encoded by its distinct words, each of them once."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

#: Fixed values of the vocabulary: how text is split, its one special string, the end of a document.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
END_ID = 2
#: Characters of text encoded together; bounds the memory of the arrays (a longer text goes alone).
SLICE = 1_000_000

#: A space that may not begin a part of the pattern.
_ODD_SPACE = re.compile(r" (?!\S)")
_vocabularies: dict[str, tuple[Callable[[str], list[int]], np.ndarray]] = {}


def _raw(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


_END = _raw([END_ID])


def _vocabulary(path: str) -> tuple[Callable[[str], list[int]], np.ndarray]:
    """Function from a text without the special string to its ids, and the bytes that each id stands for."""
    if path not in _vocabularies:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            n_bytes[rank] = len(token)
        _vocabularies[path] = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, n_bytes
    return _vocabularies[path]


def encoder(vocabulary: str) -> Callable[[str], bytes]:
    """Function from a text to its ids as little-endian 32-bit numbers, with the end id.

    ``vocabulary`` is a file of ranks.
    """
    plain, _ = _vocabulary(vocabulary)

    def encode(text: str) -> bytes:
        return _raw([SPECIAL_ID]).join(_raw(plain(x)) for x in text.split(SPECIAL)) + _END

    return encode


def slice_encoder(vocabulary: str) -> Callable[[list[str]], list[bytes]]:
    """Function from texts, about ``SLICE`` characters of them, to what :func:`encoder` gives for each.

    A space before a character other than white space always begins a new part of the pattern, so words
    that follow such a space have the same ids wherever they stand. The distinct ones are encoded in one
    call; where each begins in the result is known by the bytes that the ids stand for.
    """
    plain, n_bytes = _vocabulary(vocabulary)
    encode = encoder(vocabulary)

    def encode_slice(texts: list[str]) -> list[bytes]:
        heads, tails, by_words = [], [], []
        for text in texts:
            head, space, tail = text.partition(" ")
            words = bool(space) and len(text) <= SLICE and SPECIAL not in text and not _ODD_SPACE.search(text)
            by_words.append(words)
            heads.append(_raw(plain(head)) if words else encode(text))
            tails.append(tail if words else None)
        if not any(by_words):
            return heads
        lists = pc.split_pattern(pa.array(tails, pa.string()), " ")
        coded = lists.flatten().dictionary_encode()
        distinct, word = coded.dictionary, coded.indices.to_numpy()
        together = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), " ")
        ids = np.array(plain(" " + together[0].as_py()), "<u4")
        ends = np.cumsum(pc.binary_length(distinct).to_numpy().astype(np.int64) + 1)
        ends = np.searchsorted(np.cumsum(n_bytes[ids]), ends) + 1
        n_ids = np.diff(ends, prepend=0)
        counts = n_ids[word]
        total = np.cumsum(counts)
        place = np.arange(total[-1]) + np.repeat(ends[word] - total, counts)
        ids = ids[place]
        # Where the ids of each text end: the words of the texts before and of its own.
        until = np.append(0, total)[lists.offsets.to_numpy()].tolist()
        return [head + ids[a:b].tobytes() + _END if words else head
                for head, words, a, b in zip(heads, by_words, until, until[1:], strict=False)]

    return encode_slice
