"""The best segmentations of many short words at once, over a trie of pieces (NumPy)."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np

#: Words that are segmented together.
WORDS_AT_ONCE = 1 << 13
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CHARACTERS = 0x110000


class PieceTrie:
    """A trie whose edges ``node, character -> node`` lie in a hash table with exact keys."""

    def __init__(self, ids: Mapping[str, int], scores: Mapping[str, float], unknown: float):
        prefixes = sorted({p[:n] for p in ids for n in range(1, len(p) + 1)})
        nodes = {p: n for n, p in enumerate(prefixes, 1)}
        nodes[""] = 0
        self.unknown = unknown
        self.longest = max(map(len, ids), default=1)
        self.id = np.array([-1] + [ids.get(p, -1) for p in prefixes], np.int32)
        self.score = np.array([-np.inf] + [scores.get(p, -np.inf) for p in prefixes])
        self.first = np.zeros(_CHARACTERS, np.int32)
        bits = max(4, (4 * len(prefixes)).bit_length())
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys = np.full(size + len(prefixes) + 1, -1, np.int64)
        self.child = np.zeros(len(self.keys), np.int32)
        edges = [(nodes[p[:-1]], ord(p[-1]), nodes[p]) for p in prefixes]
        keys = np.array([n * _CHARACTERS + c for n, c, _ in edges], np.int64)
        for (node, character, child), key, slot in zip(
                edges, keys.tolist(), self._slots(keys).tolist(), strict=True):
            if node == 0:
                self.first[character] = child
                continue
            while self.keys[slot] >= 0:
                slot += 1
            self.keys[slot], self.child[slot] = key, child

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def _step(self, node: np.ndarray, character: np.ndarray) -> np.ndarray:
        """The children, 0 where there is none."""
        keys = node * np.int64(_CHARACTERS) + character
        slots, out = self._slots(keys), np.zeros(len(keys), np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[slots]
            hit = there == keys
            out[open_[hit]] = self.child[slots[hit]]
            on = (there >= 0) & ~hit
            open_, keys, slots = open_[on], keys[on], slots[on] + 1
        return out

    def segment(self, words: list[str]) -> list[bytes | None]:
        """The ids of each word as 32-bit numbers; None if a character has to be spelled.

        Of equal scores the shortest last pieces win. Takes steps in the longest word's length,
        so longer words are better segmented one by one.
        """
        return [ids for at in range(0, len(words), WORDS_AT_ONCE)
                for ids in self._segment(words[at : at + WORDS_AT_ONCE])]

    def _segment(self, words: list[str]) -> list[bytes | None]:
        words_in = np.argsort([-len(w) for w in words], kind="stable")
        lengths = np.array([len(words[i]) for i in words_in], np.int64)
        codes = np.frombuffer("".join(words[i] for i in words_in).encode("utf-32-le"), np.uint32)
        codes, total = codes.astype(np.int64), len(codes)
        begins = np.cumsum(lengths) - lengths
        left = np.repeat(begins + lengths, lengths) - np.arange(total)
        # Longest words first, and their first characters together, then their second ones: then
        # whatever ends at the n-th characters is one range, in the order of the words.
        reach = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        ranks = np.cumsum(reach) - reach
        place = (np.repeat(np.arange(len(words)), lengths)
                 + ranks[np.arange(total) - begins.repeat(lengths)])
        # score[c - 1, e]: of the piece of c characters whose last one has place e
        score = np.full((self.longest, total), -np.inf)
        score[0] = self.unknown
        piece = np.full((self.longest, total), -1, np.int32)
        at, node = np.arange(total), self.first[codes].astype(np.int64)
        for chars in range(1, self.longest + 1):
            alive = node > 0
            at, node = at[alive], node[alive]
            ids = self.id[node]
            found = ids >= 0
            last = place[at[found] + (chars - 1)]
            score[chars - 1, last], piece[chars - 1, last] = self.score[node[found]], ids[found]
            if chars < self.longest:
                on = left[at] > chars
                at, node = at[on], node[on]
                node = self._step(node, codes[at + chars])
        best, taken = [np.zeros(len(words))], np.zeros(total, np.int8)
        for end, (rank, count) in enumerate(zip(ranks.tolist(), reach.tolist(), strict=True), 1):
            here = slice(rank, rank + count)
            top, back = np.full(count, -np.inf), np.ones(count, np.int8)
            for chars in range(min(end, self.longest), 0, -1):
                arriving = best[end - chars][:count] + score[chars - 1, here]
                np.copyto(back, chars, where=arriving >= top)
                np.maximum(top, arriving, out=top)
            best.append(top)
            taken[here] = back
        ends, which, order, out = lengths.copy(), np.arange(len(words)), [], []
        while len(which):
            last = ranks[ends[which] - 1] + which
            chars = taken[last].astype(np.int64)
            order.append(which)
            out.append(piece[chars - 1, last])
            ends[which] -= chars
            which = which[ends[which] > 0]
        order, out = np.concatenate(order[::-1]), np.concatenate(out[::-1])
        sorted_ = np.argsort(order, kind="stable")
        order, out = order[sorted_], out[sorted_]
        sizes = np.bincount(order, minlength=len(words))
        spelled = np.bincount(order[out < 0], minlength=len(words)) > 0
        stops = (4 * np.cumsum(sizes)).tolist()
        raw, parts = out.astype(np.int32).tobytes(), [None] * len(words)
        for i, begin, stop, by_bytes in zip(
                words_in.tolist(), [0, *stops], stops, spelled.tolist(), strict=False):
            parts[i] = None if by_bytes else raw[begin:stop]
        return parts
