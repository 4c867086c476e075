"""Token counts and ids by the strings between spaces, each distinct string encoded once.

Both vocabularies merge symbols inside such a string only, so a text can be cut at its spaces, the
distinct strings of a block of texts encoded once, and the results joined back to the texts'
strings by dictionary codes. What has been encoded is kept per Python worker, up to a fixed number
of strings and of bytes; then it starts anew. Texts in which the cut could matter (runs of white space, literal
marks, special strings) are encoded whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct strings that a worker remembers, bytes that they may have together, and bytes of text in a block.
REMEMBERED, REMEMBERED_BYTES, BLOCK_BYTES = 200_000, 8 << 20, 2 << 20
SPECIAL = "<|endoftext|>"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def sentence_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def byte_bpe(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def ranks(path: str):
    """The byte-level vocabulary as ranks, which encodes faster, and the bytes in each token."""
    import public_tokenizers
    import tiktoken

    pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    sizes = np.zeros(max(pairs.values()) + 1, np.int64)
    for token, rank in pairs.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs, special_tokens={}), sizes


def blocks(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of at most ``BLOCK_BYTES`` of text, or one text, with the place of their first."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        low = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, "right")))
        yield at, pc.fill_null(texts.slice(at, to - at), "")
        at = to


class Remembered:
    """Codes for strings; subclasses say what a string's value is by ``learn``."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.string())

    def learn(self, new: pa.Array) -> None:
        raise NotImplementedError

    def codes_of(self, strings: pa.Array) -> np.ndarray:
        """A code for each string; valid until the next call."""
        coded = strings.dictionary_encode()
        if len(self.known) > REMEMBERED or self.known.nbytes > REMEMBERED_BYTES:
            self.clear()
        found = pc.index_in(coded.dictionary, value_set=self.known)
        missing = pc.is_null(found).to_numpy(zero_copy_only=False)
        table = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        if missing.any():
            new = coded.dictionary.filter(pa.array(missing))
            self.learn(new)
            table[missing] = np.arange(len(new)) + len(self.known)
            self.known = pa.concat_arrays([self.known, new])
        return table[coded.indices.to_numpy()]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The strings between the spaces of all texts, and where each text's begin (one more at the end)."""
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


def frequencies(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often each text holds each of its distinct strings: texts, codes and numbers, sorted by text."""
    most = int(codes.max(initial=0)) + 1
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pairs, times = np.unique(texts * most + codes, return_counts=True)
    return pairs // most, pairs % most, times


class PieceCounter(Remembered):
    """Numbers of SentencePiece tokens, for a vocabulary whose pieces have a space mark at their start only."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.model = sentence_model(path)

    def clear(self) -> None:
        super().clear()
        self.sizes = np.zeros(0, np.int64)

    def learn(self, new: pa.Array) -> None:
        # The model puts a space mark before each text, as the space before the word would.
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, self.model.encode(new.to_pylist(), num_threads=1)), np.int64, len(new))])

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text, as the model gives them for the whole text; null has none."""
        out = np.zeros(len(texts), np.int64)
        for at, part in blocks(texts):
            odd = pc.match_substring_regex(part, "^ |  | $|▁").to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(odd).tolist():
                out[at + i] = len(self.model.encode(part[i].as_py()))
            plain = np.flatnonzero(~odd)
            if len(plain):
                words, offsets = words_of(part.take(pa.array(plain)))
                text, code, times = frequencies(self.codes_of(words), offsets)
                out[at + plain] = np.bincount(text, times * self.sizes[code], len(plain)).astype(np.int64)
        pa.default_memory_pool().release_unused()
        return out


class ByteEncoder(Remembered):
    """Token ids of a byte-level vocabulary; remembers the ids of each string with a space before it."""

    def __init__(self, path: str, ranks_path: str) -> None:
        self.path = path
        self.fast, self.bytes = ranks(ranks_path)
        super().__init__()

    def clear(self) -> None:
        super().clear()
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        """Ids of one text."""
        if SPECIAL in text:
            return np.array(byte_bpe(self.path).encode(text, add_special_tokens=False).ids, np.uint32)  # loaded only for these
        return np.asarray(self.fast.encode_to_numpy(text), np.uint32) if text else np.zeros(0, np.uint32)

    def learn(self, new: pa.Array) -> None:
        odd = pc.match_substring_regex(new, r"^$|^[\s\p{Z}\x{85}\x0b\x1c-\x1f]|[\s\p{Z}\x{85}\x0b\x1c-\x1f]$").to_numpy(zero_copy_only=False)
        joined = new.filter(pa.array(~odd))
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(joined)], joined), " ")[0].as_py()
        found = self.whole(" " + text) if len(joined) else np.zeros(0, np.uint32)
        ends = np.cumsum(pc.binary_length(joined).to_numpy().astype(np.int64) + 1)
        cut = np.searchsorted(np.cumsum(self.bytes[found]), ends) + 1 if len(joined) else ends
        sizes, begin = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        sizes[~odd], begin[~odd] = np.diff(cut, prepend=0), np.concatenate([[0], cut[:-1]])[: len(joined)]
        parts, at = [found], len(found)
        for i in np.flatnonzero(odd).tolist():
            parts.append(self.whole(" " + new[i].as_py()))
            sizes[i], begin[i] = len(parts[-1]), at
            at += len(parts[-1])
        self.starts = np.concatenate([self.starts, begin + len(self.ids)])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, *parts])

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Blocks of texts: place of the first, ids of all (uint32), and where each text's begin (one more at the end)."""
        for at, part in blocks(texts):
            # Cutting before a space is safe unless white space stands on both of its sides.
            odd = pc.or_(pc.match_substring_regex(part, r"[\s\p{Z}\x{85}\x0b\x1c-\x1f] (?:[\s\p{Z}\x{85}\x0b\x1c-\x1f]|$)"), pc.match_substring(part, SPECIAL))
            odd = odd.to_numpy(zero_copy_only=False)
            words, offsets = words_of(pc.if_else(pa.array(odd), "", part))
            codes = self.codes_of(words)
            sizes, starts = self.sizes[codes], self.starts[codes]
            # The first string of a text has no space before it.
            firsts = [self.whole(w) for w in words.take(pa.array(offsets[:-1])).to_pylist()]
            for i in np.flatnonzero(odd).tolist():
                firsts[i] = self.whole(part[i].as_py())
            extra = np.concatenate([np.zeros(0, np.uint32), *firsts])
            n_first = np.fromiter(map(len, firsts), np.int64, len(firsts))
            sizes[offsets[:-1]] = n_first
            starts[offsets[:-1]] = np.cumsum(n_first) - n_first + len(self.ids)
            pool = np.concatenate([self.ids, extra])
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            where = np.repeat(starts - (ends - sizes), sizes)
            where += np.arange(total)
            bounds = np.concatenate([[0], ends[offsets[1:] - 1]])
            yield at, pool[where], bounds
            del pool, where
        pa.default_memory_pool().release_unused()  # workers live on, next to those of other stages
