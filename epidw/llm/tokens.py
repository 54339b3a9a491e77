"""Token ids by a public tokenizer file, for whole columns of texts, with a bounded memory of the parts already encoded.

Byte-level and word-end BPE never merge across the pieces that a tokenizer first splits a text into. So a text may be cut
at any place where such a piece must begin. The parts of all texts of a slice are found and hashed at once, each distinct
part is encoded by the tokenizers library once, and the ids of all parts are gathered by number. Two different parts of n
share a 64-bit hash with a probability of n * n / 2**65.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from epidw.llm.bytehash import SPACE, merged, run_bounds, span_hashes
from epidw.llm.common import slices, utf8

#: parts kept by a worker before it starts anew
KEPT_PARTS = 1_500_000
#: parts encoded in one text
TOGETHER = 64
#: such texts given to the library at once, whose answers take some hundred bytes for each id
ASKED = 64
#: bytes of text worked on at once
ENCODED_BYTES = 1 << 20
#: longer parts, in bytes, are not kept, so that the memory stays bounded in bytes too
KEPT_LENGTH = 64

GRAPHIC = np.zeros(256, bool)
GRAPHIC[0x21:0x7F] = True
#: first bytes of characters some of which are white space beyond ASCII
SPACELIKE = np.zeros(256, bool)
SPACELIKE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
WORDLIKE = np.zeros(256, bool)
WORDLIKE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: punctuation that is in no contraction and in no special token
PLAIN_MARKS = GRAPHIC & ~WORDLIKE
PLAIN_MARKS[[ord(c) for c in "'<|>"]] = False


def word_edges(data: np.ndarray) -> np.ndarray:
    """Places between an ASCII letter or digit and a plain punctuation mark, in either order."""
    word, mark = WORDLIKE[data], PLAIN_MARKS[data]
    return np.flatnonzero((word[:-1] & mark[1:]) | (mark[:-1] & word[1:])) + 1


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places of blanks and line ends that stand between two characters that are surely no white space.

    A character beyond ASCII counts as one only if no white space beyond ASCII has its first byte; cutting less often is
    always right.
    """
    at = np.flatnonzero((data == 0x20) | (data == 0x0A))
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    wide = (before >= 0x80) & ~SPACELIKE[data[at - 2]] & ~SPACELIKE[data[np.maximum(at - 3, 0)]]
    return at[(GRAPHIC[before] | wide) & (GRAPHIC[after] | ((after >= 0x80) & ~SPACELIKE[after]))]


class Encoder:
    """Ids of texts as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them, as unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._drops_space = not self._tokenizer.encode(" ", add_special_tokens=False).ids
        self._separator, self._mark = (" \x01 ", "\x01") if self._drops_space else ("\n", "\n")
        self._separator_id = self._tokenizer.encode(self._mark, add_special_tokens=False).ids[0]
        self._forget()

    def _asked(self, items: list, text: Callable) -> Iterator[tuple[object, np.ndarray]]:
        """Each item and the ids of its text, as the library gives them, for a bounded number of texts at a time."""
        for at in range(0, len(items), ASKED):
            some = items[at : at + ASKED]
            for item, encoded in zip(some, self._tokenizer.encode_batch_fast([text(i) for i in some], add_special_tokens=False)):
                yield item, np.array(encoded.ids, np.uint32)

    def _plain(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, each encoded for itself, and the number of ids of each.

        Many parts are encoded in one text where a separator, a piece of its own, keeps them apart; the few that hold the
        separator or end in white space go alone.
        """
        joined = [i for i, p in enumerate(parts) if self._mark not in p and not p[-1].isspace()]
        found: list[np.ndarray | None] = [None] * len(parts)
        groups = [joined[at : at + TOGETHER] for at in range(0, len(joined), TOGETHER)]
        for some, ids in self._asked(groups, lambda group: self._separator.join(parts[i] for i in group)):
            ends = np.flatnonzero(ids == self._separator_id)
            if len(ends) == len(some) - 1:
                for i, a, b in zip(some, [0, *(ends + 1).tolist()], [*ends.tolist(), len(ids)]):
                    found[i] = ids[a:b]
        for i, ids in self._asked([i for i, ids in enumerate(found) if ids is None], lambda i: parts[i]):
            found[i] = ids
        return np.concatenate(found), np.array([len(ids) for ids in found], np.int64)

    def _forget(self) -> None:
        self._known = np.zeros(0, np.uint64)  # hashes in order, and place and number of the ids of each
        self._first = np.zeros(0, np.int64)
        self._sizes = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _spans(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each part of the texts that start at ``starts``."""
        edges = merged(word_edges(data), starts[starts < len(data)])
        if self._drops_space:
            return run_bounds(~SPACE[data], edges)
        begin = merged(cut_places(data), edges)
        return begin, np.append(begin[1:], len(data))

    def _parts(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start of each part, the number of its ids, and all ids in order."""
        begin, end = self._spans(data, starts)
        distinct, sample, of = np.unique(span_hashes(data, begin, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self._known, distinct)
        known = self._known[np.minimum(at, len(self._known) - 1)] == distinct if len(self._known) else np.zeros(len(distinct), bool)
        first, sizes, pool = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64), self._ids
        first[known], sizes[known] = self._first[at[known]], self._sizes[at[known]]
        if not known.all():
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            ids, sizes[new] = self._plain([raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(begin[sample[new]].tolist(), end[sample[new]].tolist())])
            first[new] = len(pool) + np.cumsum(sizes[new]) - sizes[new]
            pool = np.concatenate([pool, ids])
            self._remember(distinct[new], first[new], sizes[new], (end - begin)[sample[new]], pool)
        counts = sizes[of]
        places = np.repeat(first[of] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return begin, counts, pool[places]

    def _remember(self, hashes: np.ndarray, first: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, pool: np.ndarray) -> None:
        short = lengths <= KEPT_LENGTH
        if len(self._known) + short.sum() > KEPT_PARTS:
            self._forget()
            return
        at = np.searchsorted(self._known, hashes[short])
        self._known = np.insert(self._known, at, hashes[short])
        # only the ids of kept parts stay
        kept = np.repeat(first[short] - (np.cumsum(sizes[short]) - sizes[short]), sizes[short]) + np.arange(sizes[short].sum())
        moved = len(self._ids) + np.cumsum(sizes[short]) - sizes[short]
        self._first, self._sizes = np.insert(self._first, at, moved), np.insert(self._sizes, at, sizes[short])
        self._ids = np.concatenate([self._ids, pool[kept]])

    def encode_slices(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Range of rows, their ids in order, and the number of ids up to each row; null is an empty text."""
        data, starts = utf8(column)
        for a, b in slices(starts, ENCODED_BYTES):
            low, high = int(starts[a]), int(starts[b])
            if high - low > ENCODED_BYTES:  # one long text
                ids = np.concatenate(list(self._blocks(data[low:high])))
                yield a, b, ids, np.array([0, len(ids)])
                continue
            cuts = starts[a : b + 1] - low
            begin, counts, ids = self._parts(data[low:high], cuts[:-1])
            yield a, b, ids, np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(begin, cuts)]

    def _blocks(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of a long text, block by block; blocks end where a part does."""
        low, size = 0, ENCODED_BYTES
        while low < len(data):
            block = data[low : low + size]
            if low + size < len(data):
                ends = np.flatnonzero(SPACE[block]) if self._drops_space else cut_places(block)
                if not len(ends) or not ends[-1]:
                    size *= 2
                    continue
                block = block[: ends[-1]]
            yield self._parts(block, np.zeros(1, np.int64))[2]
            low, size = low + len(block), ENCODED_BYTES

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text."""
        return next(iter(self.encode_slices(pa.array([text], pa.string()))))[2]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process."""
    return Encoder(path)
