"""Ids of a word-wise BPE tokenizer (``word_bpe_49k.json``), for whole batches of texts at once.

This tokenizer drops white space, so a text's ids are those of its words one after the other.  Each distinct word of a batch is
encoded once.  Words of ASCII and Latin-1 letters with punctuation at their end are merged here, all words of a length
together, by the merge list of the tokenizer's file; any other word is given to the tokenizer itself.
"""

from __future__ import annotations

import json

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm.words import LOWER, Words

NONE = np.int64(1 << 40)
CACHED = 2_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_signs() -> list[str]:
    """The sign that stands for each byte in the vocabulary: itself if printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    signs = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [signs[b] for b in range(256)]


class PairTable:
    """Rank of a pair of ids among the merges: two hash tables without collisions."""

    def __init__(self, keys: np.ndarray):
        ranks = np.arange(len(keys), dtype=np.int64)
        self.levels = []
        for level in range(2):
            for seed in range(1, 10_000):
                factor = np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) & ((1 << 64) - 1))
                slot = ((keys.astype(np.uint64) * factor) >> np.uint64(45)).astype(np.int64)
                _, first = np.unique(slot, return_index=True)
                if level == 0 or len(first) == len(keys):
                    break
            place = np.full(1 << 19, -1, dtype=np.int64)
            rank = np.full(1 << 19, NONE, dtype=np.int64)
            place[slot[first]], rank[slot[first]] = keys[first], ranks[first]
            self.levels.append((factor, place, rank))
            rest = np.setdiff1d(np.arange(len(keys)), first)
            keys, ranks = keys[rest], ranks[rest]

    def rank(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(keys.shape, NONE)
        for factor, place, rank in self.levels:
            slot = ((keys.astype(np.uint64) * factor) >> np.uint64(45)).astype(np.int64)
            out = np.where(place[slot] == keys, rank[slot], out)
        return out


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary, signs = model["vocab"], byte_signs()
        self.size = len(vocabulary)
        self.inner = np.array([vocabulary[s] for s in signs], dtype=np.int64)
        self.final = np.array([vocabulary[s + "</w>"] for s in signs], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = PairTable(np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in merges], dtype=np.int64))
        self.merged = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint16)

    def merge(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the byte runs at ``starts``: flat ids, and per run where its ids start and how many there are."""
        at, length, flat, filled = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), [], 0
        for size in np.unique(sizes):
            if size == 0:
                continue
            runs = np.flatnonzero(sizes == size)
            block = data[starts[runs][:, None] + np.arange(size)]
            symbols = self.inner[block]
            symbols[:, -1] = self.final[block[:, -1]]
            while len(runs):
                if symbols.shape[1] > 1:
                    rank = self.pairs.rank(symbols[:, :-1] * self.size + symbols[:, 1:])
                    place = rank.argmin(axis=1)
                    best = rank[np.arange(len(runs)), place]
                    more = best < NONE
                else:
                    more = np.zeros(len(runs), bool)
                done = symbols[~more]
                at[runs[~more]] = filled + np.arange(len(done)) * symbols.shape[1]
                length[runs[~more]] = symbols.shape[1]
                flat.append(done.astype(np.uint16).ravel())
                filled += done.size
                runs, symbols = runs[more], symbols[more]
                if len(runs):
                    place = place[more]
                    columns = np.arange(symbols.shape[1] - 1)
                    new = np.take_along_axis(symbols, columns[None, :] + (columns[None, :] > place[:, None]), axis=1)
                    new[np.arange(len(runs)), place] = self.merged[best[more]]
                    symbols = new
        return np.concatenate([np.zeros(0, np.uint16), *flat]), at, length

    def learn(self, words: Words, numbers: np.ndarray, index: np.ndarray) -> None:
        """Encode the words ``index`` of the batch and remember them under ``numbers``."""
        starts, ends = words.starts[index], words.ends[index]
        data = LOWER[words.data]
        # Latin-1 capitals: C3 80-9E without C3 97.
        second = np.concatenate([[False], data[:-1] == 0xC3])
        data = np.where(second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97), data + 32, data).astype(np.uint8)
        letter = (data >= 97) & (data <= 122)
        letter |= second & (data >= 0xA0) & (data <= 0xBF) & (data != 0xB7) | second & (data == 0x9F)
        letter |= np.concatenate([letter[1:], [False]]) & (data == 0xC3)
        sign = (data > 32) & (data < 127) & ~letter & ~((data >= 48) & (data <= 57)) & (data != 39)
        letters, signs = np.concatenate([[0], np.cumsum(letter)]), np.concatenate([[0], np.cumsum(sign)])
        n_letters, n_signs = letters[ends] - letters[starts], signs[ends] - signs[starts]
        # Simple: all letters, then all signs; a word in angle brackets may be a special token.
        simple = (n_letters + n_signs == ends - starts) & (letters[starts + n_letters] - letters[starts] == n_letters)
        simple &= (ends - starts <= 64) & ~((n_signs >= 2) & (data[starts] == 60))
        s = np.flatnonzero(simple)
        flat, at, length = self.merge(data, np.concatenate([starts[s], starts[s] + n_letters[s]]),
                                      np.concatenate([n_letters[s], n_signs[s]]))
        pieces, sizes = np.stack([at[:len(s)], at[len(s):]], 1), np.stack([length[:len(s)], length[len(s):]], 1)
        ids = flat[spans(pieces.ravel(), sizes.ravel())]
        lengths = np.zeros(len(index), np.int64)
        lengths[s] = sizes.sum(axis=1)
        other = np.flatnonzero(~simple)
        encoded = self.tokenizer.encode_batch(
            [bytes(words.data[starts[i]:ends[i]]).decode("utf-8", "replace") for i in other], add_special_tokens=False)
        lengths[other] = [len(e.ids) for e in encoded]
        order = np.concatenate([s, other])
        all_ids = np.concatenate([ids, np.array([i for e in encoded for i in e.ids], dtype=np.uint16)])
        begin = np.zeros(len(index), np.int64)
        begin[order] = len(self.ids) + np.cumsum(lengths[order]) - lengths[order]
        known = np.concatenate([self.known, numbers])
        by = np.argsort(known, kind="stable")
        self.known, self.at = known[by], np.concatenate([self.at, begin])[by]
        self.length, self.ids = np.concatenate([self.length, lengths])[by], np.concatenate([self.ids, all_ids])

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of the batch, and how many ids come before each word (and in all)."""
        if len(self.known) > CACHED:
            self.forget()
        distinct, index, which = np.unique(words.numbers, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            self.learn(words, distinct[new], index[new])
            place = np.searchsorted(self.known, distinct)
        at, length = self.at[place][which], self.length[place][which]
        return self.ids[spans(at, length)], np.concatenate([[0], np.cumsum(length)])


def spans(at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indexes at[0], at[0] + 1, ... of all spans, one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(at - (ends - length), length)
