"""Byte-pair merges for a whole batch of pre-tokens, driven by a queue over merge ranks."""

from __future__ import annotations

import base64

import numpy as np

NONE = np.int64(1) << 40


class RankBitmap:
    """Which ranks have a bucket: 64-bit words, and above them words that tell which of those are not zero."""

    def __init__(self, n: int) -> None:
        self.levels = [[0] * (n // 64 + 1)]
        while len(self.levels[-1]) > 1:
            self.levels.append([0] * ((len(self.levels[-1]) - 1) // 64 + 1))

    def set(self, i: int) -> None:
        for level in self.levels:
            i, bit = divmod(i, 64)
            level[i] |= 1 << bit

    def clear(self, i: int) -> None:
        for level in self.levels:
            i, bit = divmod(i, 64)
            level[i] &= ~(1 << bit)
            if level[i]:
                return

    def first(self) -> int:
        """The smallest rank set, or -1: find-first-set from the top word down."""
        if not self.levels[-1][0]:
            return -1
        i = 0
        for level in reversed(self.levels):
            word = level[i]
            i = i * 64 + (word & -word).bit_length() - 1
        return i


class ByteBpe:
    """Encodes pre-tokens by the ranks of a byte-level vocabulary, and decodes ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.size = max(ranks.values()) + 1
        self.pieces = [b""] * self.size
        self._marks = np.zeros(0, dtype=bool)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {
            ranks[piece[:k]] * self.size + ranks[piece[k:]]: rank
            for piece, rank in ranks.items()
            for k in range(1, len(piece))
            if piece[:k] in ranks and piece[k:] in ranks
        }
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()] + [NONE], dtype=np.int64)

    @classmethod
    def from_file(cls, path: str) -> ByteBpe:
        """From lines of a base64 token and its rank."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of what each pair of ids would merge to, NONE if nothing."""
        if not len(self.pair_keys):
            return np.full(len(left), NONE)
        key = left * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers.

        All words lie in one linked list, in which no pair spans two words. A bucket for each merge rank
        holds positions whose pair has that rank; the bitmap gives the lowest rank with a bucket. Positions
        whose pair has changed meanwhile are stale and skipped. All positions of a bucket merge at once;
        where a merge makes a pair of lower rank in a word with more positions, only the first one of that
        word merges and the others go back to the queue, so the order is the one-at-a-time order.
        """
        n_of = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        n = int(n_of.sum())
        if not n:
            return [b""] * len(words)
        token = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), n_of)
        # Position n stands for "none" on either side.
        following = np.arange(1, n + 2)
        before = np.arange(-1, n)
        ends = np.cumsum(n_of)[n_of > 0]
        following[ends - 1] = n
        before[(ends - n_of[n_of > 0])] = n
        rank = np.full(n + 1, NONE)
        inner = np.flatnonzero(following[:n] < n)
        rank[inner] = self.rank_of(token[inner], token[inner + 1])
        token = np.append(token, 0)
        alive = np.ones(n, dtype=bool)
        buckets: dict[int, list[np.ndarray]] = {}
        bitmap = RankBitmap(self.size)

        def push(at: np.ndarray) -> None:
            at = at[rank[at] < NONE]
            if not len(at):
                return
            ranks = rank[at]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for r, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(at)], strict=True):
                if r in buckets:
                    buckets[r].append(at[a:b])
                else:
                    buckets[r] = [at[a:b]]
                    bitmap.set(r)

        push(inner)
        while (r := bitmap.first()) >= 0:
            bitmap.clear(r)
            held = buckets.pop(r)
            at = held[0] if len(held) == 1 else np.concatenate(held)
            at = np.sort(at[rank[at] == r])
            if not len(at):
                continue
            at = at[np.append(True, at[1:] != at[:-1])]
            if len(at) > 1:
                every = at
                at = self._without_overlaps(at, following)
                at, waiting = self._in_order(at, r, token, following, before, word)
                if len(waiting):
                    # With the positions that an overlap has ruled out for now: it may be gone by then.
                    later = every[np.isin(word[every], waiting)]
                    buckets[r] = [later[~np.isin(later, at)]]
                    bitmap.set(r)
            gone = following[at]
            right = following[gone]
            token[at] = r
            alive[gone] = False
            rank[gone] = NONE
            following[at] = right
            before[right] = at
            before[n] = n
            left = before[at]
            rank[at] = np.where(right < n, self.rank_of(token[at], token[right]), NONE)
            rank[left] = np.where(left < n, self.rank_of(token[left], token[at]), NONE)
            rank[n] = NONE
            push(np.concatenate([at, left[left < n]]))
        n_ids = np.bincount(word[alive], minlength=len(words))
        ids = token[:n][alive].astype("<u4").tobytes()
        stops = (np.cumsum(n_ids) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    @staticmethod
    def _without_overlaps(at: np.ndarray, following: np.ndarray) -> np.ndarray:
        """Of chains in which each pair begins where the last one ends ("aaaa"), every other one from the first."""
        joined = np.append(False, at[1:] == following[at[:-1]])
        if not joined.any():
            return at
        index = np.arange(len(at))
        first = np.maximum.accumulate(np.where(joined, 0, index))
        return at[(index - first) % 2 == 0]

    def marks(self, n: int) -> np.ndarray:
        """A scratch array of n + 1 or more False; whoever sets some puts them back."""
        if len(self._marks) <= n:
            self._marks = np.zeros(n + 1, dtype=bool)
        return self._marks

    def _in_order(self, at, r, token, following, before, word):
        """(positions that can merge at once, words whose other positions must wait)."""
        same = word[at][1:] == word[at][:-1]
        if not same.any():
            return at, at[:0]
        many = np.append(same, False) | np.append(False, same)
        p = at[many]
        n = len(before) - 1
        gone = following[p]
        right, left = following[gone], before[p]
        merged = np.full(len(p), r)
        used = self.marks(n)
        used[gone] = True
        left_token = np.where(used[left], r, token[left])
        used[gone] = False
        used[p] = True
        right_token = np.where(used[right], r, token[right])
        used[p] = False
        lower = (right < n) & ((self.rank_of(merged, token[right]) < r) | (self.rank_of(merged, right_token) < r))
        lower |= (left < n) & ((self.rank_of(left_token, merged) < r) | (self.rank_of(token[left], merged) < r))
        if not lower.any():
            return at, at[:0]
        first, waiting = np.append(True, ~same), word[p[lower]]
        return at[first | ~np.isin(word[at], waiting)], waiting

    def decode(self, ids: bytes) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
