"""Which of many fingerprints reach a score with one: counters that hold one bit of 64 rows in a word.

A block of fingerprints is kept as a bitmap of rows for each bit. The bitmaps of a target's on-bits are added up by full
adders on whole words, so the work follows the on-bits of the target and not the width of the fingerprint. Its most
frequent bits may be left out: they add at most their number, and what then may have enough is compared bit by bit.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle

# Executors run the functions below without having this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows turned into bitmaps, or compared, at a time: a multiple of 64.
CHUNK = 4_096
# Rows of a segment, a multiple of 64, and targets that are counted in it together: 32 kB for one bit of all counters.
SEGMENT, TOGETHER = 16_384, 16
# Bits are left out as long as the least number of the others is so many deviations above what a row has by chance: at
# first, and at most either way. In between the number follows the share of rows that then have enough for nothing.
DEVIATIONS, MOST_DEVIATIONS = 2.0, 16.0
FOR_NOTHING = 1e-3
# So many bitmaps are added in the time that it takes to compare their rows.
ADDED = 800
# Bitmaps that are added before their sum is carried into the higher bits of the counters, as a power of two, and those fetched at a time.
GROUP, FETCHED = 4, 8
# Pairs verified at a time.
VERIFIED = 2_048


def row_bitmaps(words: np.ndarray) -> np.ndarray:
    """One bitmap of rows for each bit, in the order of the bytes of the words, padded to whole words."""
    n, width = len(words), words.shape[1] * 8
    lists = np.zeros((width * 8, -(-n // 64) * 8), np.uint8)
    for first in range(0, n, CHUNK):
        part = words[first : first + CHUNK].view(np.uint8)
        part = np.concatenate([part, np.zeros((-len(part) % 8, width), np.uint8)])
        # Squares of 8 rows and 8 bits, turned about their diagonal by three exchanges.
        x = np.ascontiguousarray(part.reshape(-1, 8, width).transpose(2, 0, 1)).view("<u8")[..., 0]
        for shift, mask in ((7, 0x00AA00AA00AA00AA), (14, 0x0000CCCC0000CCCC), (28, 0x00000000F0F0F0F0)):
            t = (x ^ (x >> np.uint64(shift))) & np.uint64(mask)
            x = x ^ t ^ (t << np.uint64(shift))
        turned = np.ascontiguousarray(x).view(np.uint8).reshape(width, -1, 8).transpose(0, 2, 1).reshape(width * 8, -1)
        lists[:, first // 8 : first // 8 + turned.shape[1]] = turned
    return lists.view(np.uint64)


class Counters:
    """Fingerprints ordered by number of on-bits, to be searched for those that reach a score with a target."""

    def __init__(self, words: np.ndarray, pops: np.ndarray, common=None):
        """``common`` gives the numbers of common on-bits of a fingerprint with a range of rows, if there is a faster way."""
        self.words, self.pops = words, pops
        self.common = common or self._common_with
        self.pair_words = np.empty((2, VERIFIED, words.shape[1]), np.uint64)
        n_bits = words.shape[1] * 64
        seen = np.zeros(n_bits, np.int64)
        self.segments = []
        for first in range(0, len(words), SEGMENT):
            bitmaps = row_bitmaps(words[first : first + SEGMENT])
            for at in range(0, n_bits, 64):
                seen[at : at + 64] += np.bitwise_count(bitmaps[at : at + 64]).sum(axis=1, dtype=np.int64)
            # An empty list at the end fills up targets with fewer on-bits than others.
            self.segments.append(np.concatenate([bitmaps, np.zeros((1, bitmaps.shape[1]), np.uint64)]))
        self.deviations = np.full(len(self.segments), DEVIATIONS)
        self.rarest_first = np.argsort(seen, kind="stable")
        self.share = np.append(seen[self.rarest_first] / max(1, len(words)), 0.0)
        self.list_of = np.append(self.rarest_first, n_bits)
        size = TOGETHER * SEGMENT // 64
        self.planes = np.empty((n_bits.bit_length() + 1, size), np.uint64)
        self.spare = np.empty((2 * GROUP + 3, size), np.uint64)
        self.fetched = np.empty(FETCHED * size, np.uint64)

    def windows(self, pops: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each target the range of rows whose number of on-bits allows its floor."""
        with np.errstate(over="ignore"):
            low = np.searchsorted(self.pops, np.ceil(floors * pops - 1e-6))
            high = np.searchsorted(self.pops, np.floor(pops / floors + 1e-6), "right")
        return low, np.maximum(low, high)

    def search(self, words: np.ndarray, pops: np.ndarray, floors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs ``(target, row, common on-bits)`` with a score of at least the target's floor.

        Targets have on-bits, and floors above 0, however small. Floors may be raised between two results: what follows
        keeps to the new ones. Rows with about as many on-bits as the target come first.
        """
        if not len(self.pops):
            return
        lows, highs = self.windows(pops, floors)
        first, last = lows // SEGMENT, -(-highs // SEGMENT)
        rows = np.minimum(last * SEGMENT, len(self.pops)) - first * SEGMENT
        few = (pops * rows > ADDED * (highs - lows)) & (lows < highs)
        for t in np.flatnonzero(few):
            for start in range(lows[t], highs[t], CHUNK):
                at = np.arange(start, min(start + CHUNK, highs[t]))
                common = self.common(words[t], start, start + len(at))
                yield self._kept(np.full(len(at), t), at, common.astype(np.int64), pops, floors)
        many = np.flatnonzero(~few & (lows < highs))
        # Those together have about the same window and number of bitmaps to add.
        lists = pops * (1.1 - 2 * floors / (1 + floors))
        many = many[np.lexsort((lists[many], last[many], first[many]))]
        for start in range(0, len(many), TOGETHER):
            own = many[start : start + TOGETHER]
            lists = self._rarest_lists(words[own])
            near = int(np.searchsorted(self.pops, pops[own].mean())) / SEGMENT - 0.5
            for segment in sorted(range(int(first[own].min()), int(last[own].max())), key=lambda s: abs(s - near)):
                of, found = self._reaching(segment, lists, pops[own], floors[own])
                right = 0
                for begin in range(0, len(found), VERIFIED):
                    t, at = own[of[begin : begin + VERIFIED]], found[begin : begin + VERIFIED]
                    one, other = self.pair_words[:, : len(at)]
                    self.words.take(at, axis=0, out=one, mode="clip")
                    words.take(t, axis=0, out=other, mode="clip")
                    kept = self._kept(t, at, self._common(one, other), pops, floors)
                    right += len(kept[0])
                    yield kept
                step = 0.4 if len(found) - right > FOR_NOTHING * len(own) * SEGMENT else -0.2
                self.deviations[segment] = np.clip(self.deviations[segment] + step, -MOST_DEVIATIONS, MOST_DEVIATIONS)

    def _common(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Numbers of common on-bits, row by row, of up to ``VERIFIED`` rows."""
        both = self.pair_words[0, : len(one)]
        np.bitwise_and(one, other, out=both)
        return np.bitwise_count(both).sum(axis=1, dtype=np.int64)

    def _common_with(self, query: np.ndarray, low: int, high: int) -> np.ndarray:
        """Numbers of common on-bits of a fingerprint with the rows low..high."""
        parts = range(low, high, VERIFIED)
        return np.concatenate([self._common(self.words[at : min(at + VERIFIED, high)], query) for at in parts])

    def _kept(self, t: np.ndarray, at: np.ndarray, common: np.ndarray, pops: np.ndarray, floors: np.ndarray) -> tuple:
        keep = common / (self.pops[at] + pops[t] - common) >= floors[t]
        return t[keep], at[keep], common[keep]

    def _rarest_lists(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each target, in a column, its bits from the rarest on, and the number of them that a row has by chance."""
        bits = np.unpackbits(words.view(np.uint8).reshape(len(words), -1), axis=1, bitorder="little")[:, self.rarest_first]
        of, rank = np.nonzero(bits)
        sizes = np.bincount(of, minlength=len(words))
        place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ranks = np.full((int(sizes.max()), len(words)), len(self.rarest_first))
        ranks[place, of] = rank
        return self.list_of[ranks], np.cumsum(self.share[ranks], axis=0)

    def _add(self, bitmaps: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """The bits of the number of these bitmaps in which a row stands, lowest first, for each target."""
        n, together = lists.shape
        width = bitmaps.shape[1]
        size = together * width
        planes = self.planes[: n.bit_length(), :size]
        planes.fill(0)
        shape, planes = (len(planes), together, width), list(planes)
        *spare, other, one, two = (row[:size] for row in self.spare)
        both, either, any_of = np.bitwise_and, np.bitwise_xor, np.bitwise_or

        def rows() -> Iterator[np.ndarray]:
            for first in range(0, n, FETCHED):
                part = lists[first : first + FETCHED].ravel()
                held = self.fetched[: len(part) * width].reshape(len(part), width)
                bitmaps.take(part, axis=0, out=held, mode="clip")
                yield from held.reshape(-1, size)

        row = rows()

        def carry(level: int, out: np.ndarray) -> np.ndarray:
            """Adds 2 ** level bitmaps to the planes below that level and returns what is carried into it."""
            a = carry(level - 1, spare[2 * level - 2]) if level > 1 else next(row)
            if level > 1:
                b = carry(level - 1, spare[2 * level - 1])
            else:
                np.copyto(spare[0], a)
                a, b = spare[0], next(row)
            plane = planes[level - 1]
            either(plane, a, other)
            both(plane, a, out)
            either(other, b, plane)
            both(other, b, other)
            any_of(out, other, out)
            return out

        added = 0
        for level in [GROUP] * (n >> GROUP) + [k for k in reversed(range(GROUP)) if n >> k & 1]:
            added += 1 << level
            carried = carry(level, one) if level else next(row)
            for upper in range(level, added.bit_length()):
                out = two if carried is one else one
                both(planes[upper], carried, out)
                either(planes[upper], carried, planes[upper])
                carried = out
        return self.planes[: shape[0], :size].reshape(shape)

    def _reaching(self, segment: int, lists: tuple, pops: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of targets and rows of a segment, within their windows, that may have the score."""
        lows, highs = (np.clip(at, segment * SEGMENT, (segment + 1) * SEGMENT) for at in self.windows(pops, floors))
        here = np.flatnonzero(lows < highs)
        if not len(here):
            return here, here
        lists, by_chance = (each[:, here] for each in lists)
        lows, highs, pops, floors = (each[here] for each in (lows, highs, pops, floors))
        share = floors / (1 + floors)
        least = np.maximum(np.ceil(share * (pops + self.pops[lows]) - 1e-6), 1).astype(np.int64)
        # The rarest bits only: as many as tell rows that have enough from most that have some by chance.
        left_out = pops - 1 - np.arange(len(lists))[:, None]
        sure = share * 2 * pops - left_out >= by_chance + self.deviations[segment] * np.sqrt(by_chance) + 1
        n = int(((sure & (left_out < least)) | (left_out <= 0)).argmax(axis=0).max()) + 1
        left_out = np.maximum(pops - n, 0)[:, None]
        planes = self._add(self.segments[segment], lists[:n])
        first_pops = self.pops[segment * SEGMENT : (segment + 1) * SEGMENT : 64]
        # The first row of a window may stand in a word behind rows with fewer on-bits.
        need = np.maximum(np.ceil(share[:, None] * (pops[:, None] + first_pops) - 1e-6), least[:, None]).astype(np.int64)
        above = np.clip(need - left_out - 1, 0, (1 << len(planes)) - 1).astype(np.uint64)
        more, equal = np.zeros(above.shape, np.uint64), np.full(above.shape, ~np.uint64(0))
        for level in reversed(range(len(planes))):
            differs = planes[level] ^ np.negative(above >> np.uint64(level) & np.uint64(1))
            more |= differs & planes[level] & equal
            equal &= ~differs
        of, word = np.nonzero(more)
        hit, bit = np.nonzero(np.unpackbits(more[of, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        of, at = of[hit], segment * SEGMENT + word[hit] * 64 + bit
        inside = (at >= lows[of]) & (at < highs[of])
        return here[of[inside]], at[inside]
