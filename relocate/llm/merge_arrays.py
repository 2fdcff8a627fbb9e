"""Rank-synchronous merging: many symbol sequences at once, as ragged arrays.

All sequences lie end to end in one array. In every round each sequence merges its own pair of
lowest rank (the leftmost of equals), all of them in one array step; then only pairs beside a
merge are looked up again. Sequences without a pair left move out of the arrays.

A candidate may be skipped: the decision is a hash of the sequence's key, the character where
the candidate starts and the symbol it would make. It depends on nothing else, so the order in
which sequences are worked off, and a task that runs again, change nothing.
"""

from __future__ import annotations

import heapq

import numpy as np

from relocate.llm.piece_model import SPACE_MARK, PieceModel

#: Above every rank and place; ranks are counted in steps of 2**32.
NONE = 1 << 62
#: Longer sequences go through a heap, whose work does not grow with the square of the length.
LONG = 512
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Merger:
    """Merges character sequences under one model, optionally with seeded merge-dropout."""

    def __init__(self, model: PieceModel, dropout: float = 0.0):
        self.model = model
        self.size = model.symbols
        self.limit = np.uint64(min(int(dropout * 2.0**64), 2**64 - 1))
        self.dropout = dropout > 0
        #: Ranks of pairs in steps of 2**32; the last entry, at -1, is that of no pair.
        self.rank_step = np.append(model.pair_rank << 32, NONE)
        top = 0x110000
        self.char_symbol = np.full(top, self.size - 1, np.int32)
        for text, symbol in model.symbol_of.items():
            if len(text) == 1:
                self.char_symbol[ord(text)] = symbol
        self.char_symbol[ord(" ")] = self.char_symbol[ord(SPACE_MARK)]
        # A literal space mark in a text is not a space: it goes out as bytes.
        self.char_symbol[ord(SPACE_MARK)] = self.size - 1 if self.dropout else self.char_symbol[ord(" ")]
        slots = 1 << (4 * len(model.pair_keys) - 1).bit_length()
        self.mask = np.uint64(slots - 1)
        self.slot_key = np.full(slots, -1, np.int64)
        self.slot_pair = np.zeros(slots, np.int64)
        self._fill(model.pair_keys)

    def _fill(self, keys: np.ndarray) -> None:
        left = np.arange(len(keys))
        self.probes = 0
        while len(left):
            at = self._slot(keys[left], self.probes)
            free = self.slot_key[at] < 0
            self.slot_key[at[free]] = keys[left[free]]
            won = self.slot_key[at] == keys[left]
            self.slot_pair[at[won]] = left[won]
            left = left[~won]
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((mixed(keys.view(np.uint64) * _A) + np.uint64(probe)) & self.mask).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge of each pair of symbols, or -1."""
        keys = left.astype(np.int64) * self.size + right
        out = np.full(len(keys), -1, np.int32)
        todo = np.arange(len(keys))
        base = mixed(keys.view(np.uint64) * _A)
        for probe in range(self.probes):
            at = ((base[todo] + np.uint64(probe)) & self.mask).astype(np.int64)
            held = self.slot_key[at]
            hit = held == keys[todo]
            out[todo[hit]] = self.slot_pair[at[hit]]
            todo = todo[~hit & (held >= 0)]
            if not len(todo):
                break
        return out

    def skipped(self, key: np.ndarray, start: np.ndarray, made: np.ndarray) -> np.ndarray:
        """Whether a candidate is skipped, by the sequence's key, its first character and what it makes."""
        h = mixed(key + start.astype(np.uint64) * _A) ^ (made.astype(np.uint64) * _C)
        return mixed(h) < self.limit

    def merge(
        self, texts: list[str], keys: np.ndarray | None = None, looked: list | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts end to end, where each symbol starts, and the symbols per text.

        With ``looked`` nothing is skipped, and every candidate looked at is added to it: text, first
        character and symbol made. Texts must not be longer than ``LONG`` then.
        """
        count = len(texts)
        lengths = np.fromiter(map(len, texts), np.int64, count)
        chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        keys = np.zeros(count, np.uint64) if keys is None else keys.astype(np.uint64)
        first = np.cumsum(lengths) - lengths
        parts = []
        for i in np.flatnonzero(lengths > LONG):
            found = self._by_heap(self.char_symbol[chars[first[i] : first[i] + lengths[i]]], keys[i])
            parts.append((np.full(len(found[0]), i), *found))
        seq = np.repeat(np.arange(count, dtype=np.int32), lengths)
        start = (np.arange(len(chars)) - first[seq]).astype(np.int32)
        short = lengths[seq] <= LONG
        self._rounds(seq[short], self.char_symbol[chars[short]], start[short], keys, parts, looked)
        seq = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(seq, kind="stable")
        symbols = np.concatenate([p[1] for p in parts])[order] if parts else np.zeros(0, np.int32)
        starts = np.concatenate([p[2] for p in parts])[order] if parts else np.zeros(0, np.int64)
        return symbols, starts, np.bincount(seq, minlength=count)

    def _candidates(self, seq, symbol, start, keys, at, looked=None) -> np.ndarray:
        """The merge that begins at each place, or -1 at the end of a sequence."""
        pair = np.full(len(at), -1, np.int32)
        inside = np.flatnonzero(at + 1 < len(seq))
        inside = inside[seq[at[inside]] == seq[at[inside] + 1]]
        here = at[inside]
        pair[inside] = self._find(symbol[here], symbol[here + 1])
        if looked is not None:
            known = inside[pair[inside] >= 0]
            looked.append((seq[at[known]], start[at[known]], self.model.pair_symbol[pair[known]]))
        elif self.dropout and len(inside):
            known = inside[pair[inside] >= 0]
            made = self.model.pair_symbol[pair[known]]
            skip = self.skipped(keys[seq[at[known]]], start[at[known]], made)
            pair[known[skip]] = -1
        return pair

    def _rounds(self, seq, symbol, start, keys, parts, looked) -> None:
        made_of = self.model.pair_symbol
        pair = self._candidates(seq, symbol, start, keys, np.arange(len(seq)), looked)
        while len(seq):
            head = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            cost = self.rank_step[pair] + np.arange(len(seq))
            least = np.minimum.reduceat(cost, head)
            going = least < NONE
            if not going.all():
                sizes = np.diff(np.append(head, len(seq)))
                out = np.repeat(~going, sizes)
                parts.append((seq[out], symbol[out], start[out]))
                seq, symbol, start, pair = (x[~out] for x in (seq, symbol, start, pair))
                if not len(seq):
                    return
                moved = np.cumsum(~out) - 1
                at = moved[least[going] & 0xFFFFFFFF]
            else:
                at = least & 0xFFFFFFFF
            symbol[at] = made_of[pair[at]]
            stay = np.ones(len(seq), bool)
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            seq, symbol, start, pair = (x[stay] for x in (seq, symbol, start, pair))
            at = place[at]
            # One merge a sequence: no place is both beside a merge and a merge.
            before = at[at > 0] - 1
            changed = np.concatenate([before[seq[before] == seq[before + 1]], at])
            pair[changed] = self._candidates(seq, symbol, start, keys, changed, looked)

    def _by_heap(self, symbol: np.ndarray, key: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """One long sequence through an agenda of candidates, best first."""
        n = len(symbol)
        rank_of, made_of = self.model.pair_rank, self.model.pair_symbol
        seq, start, keys = np.zeros(n, np.int64), np.arange(n), np.array([key], np.uint64)
        pair = self._candidates(seq, symbol, start, keys, start)
        symbols, after, before = symbol.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(int(rank_of[pair[i]]), int(i), symbols[i], symbols[i + 1]) for i in np.flatnonzero(pair >= 0)]
        heapq.heapify(agenda)
        merge_of = self._merge_table
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = int(made_of[merge_of[a * self.size + b]]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if left < 0 or right >= n:
                    continue
                found = merge_of.get(symbols[left] * self.size + symbols[right], -1)
                if found < 0:
                    continue
                if self.dropout and self.skipped(keys, np.array([left]), made_of[found : found + 1])[0]:
                    continue
                heapq.heappush(agenda, (int(rank_of[found]), left, symbols[left], symbols[right]))
        kept = np.array([i for i in range(n) if symbols[i] >= 0], np.int64)
        return np.array([symbols[i] for i in kept], np.int32), kept

    @property
    def _merge_table(self) -> dict[int, int]:
        if not hasattr(self, "_table"):
            self._table = {int(k): i for i, k in enumerate(self.model.pair_keys)}
        return self._table
