"""A compressed index over many short word sequences, with vectorised searches.

The sequences are joined by separators and sorted by suffix; their
Burrows-Wheeler transform is held in a wavelet matrix of packed bits. Searches
run for many sequences at once: every numpy step moves all of them.
"""

from __future__ import annotations

import numpy as np

_MASKS = np.array([(1 << k) - 1 for k in range(64)], np.uint64)


class WaveletMatrix:
    """Symbols as levels of packed bits with a running count for each 64 of them."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = max(1, int(largest).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(self.levels):
            bit = (symbols >> (self.levels - 1 - level)) & 1
            packed = np.packbits(np.pad(bit.astype(np.uint8), (0, 64 - len(bit) % 64)), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.r_[0, np.cumsum(np.bitwise_count(packed).astype(np.int64))[:-1]].astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where each place before which ``symbol`` is counted ends up on the lowest level."""
        for level in range(self.levels):
            block = at >> 6
            ones = self.counts[level][block] + np.bitwise_count(self.bits[level][block] & _MASKS[at & 63]).astype(np.int64)
            at = np.where((symbol >> (self.levels - 1 - level)) & 1, self.zeros[level] + ones, at - ones)
        return at


def _minima(values: np.ndarray) -> np.ndarray:
    """Row k holds the minimum of the 2**k values that start at each place."""
    rows = [values]
    while 2 << (len(rows) - 1) <= len(values):
        half = 1 << (len(rows) - 1)
        last = rows[-1]
        rows.append(np.r_[np.minimum(last[:-half], last[half:]), last[-half:]])
    return np.stack(rows)


class FMIndex:
    """Index of word sequences (arrays of word hashes), each owned by a document."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray):
        lengths = np.array(list(map(len, sequences)), np.int64)
        self.start = np.r_[0, np.cumsum(lengths + 1)][:-1]
        _, dense = np.unique(np.concatenate(sequences), return_inverse=True)
        n = int(lengths.sum() + len(lengths))
        self.text = np.zeros(n, np.int64)  # 0 separates
        real = np.ones(n, bool)
        real[self.start + lengths] = False
        self.text[real] = dense + 1
        self.left = np.repeat(self.start + lengths, lengths + 1) - np.arange(n)  # symbols before the next separator
        self._sort(int(lengths.max()))
        owner = np.repeat(np.asarray(owners, np.int64), lengths + 1)[self.order]
        self.owners, ranked = np.unique(owner, return_inverse=True)
        self.low_owner = _minima(ranked.astype(np.int32))
        largest = int(self.text.max())
        before = np.r_[0, np.cumsum(np.bincount(self.text, minlength=largest + 1))][:-1]
        self.tree = WaveletMatrix(self.text[self.order - 1], largest)
        symbols = np.arange(largest + 1)
        self.base = before - self.tree.descend(symbols, np.zeros_like(symbols))
        self.log = np.zeros(n + 2, np.int8)
        for k in range(1, 40):
            self.log[1 << k :] = k

    def _sort(self, longest: int) -> None:
        """Suffix order by doubling; suffixes equal up to their separator stay in text order. Keeps common prefix lengths."""
        n, rank, ranks, width = len(self.text), self.text, [], 1
        while True:
            ranks.append(rank.astype(np.int32))
            second = np.zeros(n, np.int64)
            inside = self.left >= width
            second[inside] = rank[np.flatnonzero(inside) + width]
            key = rank * (int(rank.max()) + 1) + second
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
            width *= 2
            if width > longest:
                break
        self.order = order
        self.place = np.empty(n, np.int64)
        self.place[order] = np.arange(n)
        one, two = order[:-1].copy(), order[1:]
        common = np.zeros(n - 1, np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            fits = self.left[one] - common >= 1 << level
            fits[fits] = ranks[level][(one + common)[fits]] == ranks[level][np.minimum(two + common, n - 1)[fits]]
            common += fits.astype(np.int64) << level
        # a second pass over the levels is not needed: a common length below 2**(levels) is found bit by bit
        self.common = _minima(np.r_[0, common].astype(np.uint8))

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the interval of symbol + pattern."""
        both = self.tree.descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi])) + np.concatenate([self.base[symbol]] * 2)
        return both[: len(lo)], both[len(lo) :]

    def widen(self, lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the pattern's first ``length`` symbols."""
        lo, hi, n = lo.copy(), hi.copy(), len(self.text)
        for k in range(len(self.common) - 1, -1, -1):
            step = 1 << k
            row = self.common[k]
            more = hi + step <= n
            more[more] = row[hi[more]] >= length[more]
            hi[more] += step
            more = lo - step >= 0
            more[more] = row[lo[more] - step + 1] >= length[more]
            lo[more] -= step
        return lo, hi

    def earlier(self, lo: np.ndarray, hi: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Whether the interval holds a sequence of an owner ranked below ``owner``."""
        found = hi > lo
        a, b, k = lo[found], hi[found], self.log[hi[found] - lo[found]].astype(np.int64)
        low = np.minimum(self.low_owner[k, a], self.low_owner[k, b - (1 << k)])
        found[found] = low < owner[found]
        return found

    def matching_starts(self, asked: np.ndarray, owners: np.ndarray, seed: np.ndarray, seed_size: int, last: np.ndarray, window: int) -> list[np.ndarray]:
        """For each asked sequence, the starts s <= last of windows that an earlier owner's sequence holds too.

        Every window sought holds the seed (``seed_size`` symbols from offset
        ``seed``). The longest match from the seed to the right is found in the
        suffix order; from there backward search runs to the left, and where a
        symbol does not fit the right end gives way, as in matching statistics.
        """
        owner = np.searchsorted(self.owners, owners)
        begin = self.start[asked]
        at = begin + seed
        seed_end = at + seed_size
        lo, hi = self.widen(self.place[at], self.place[at] + 1, np.full(len(at), seed_size))
        alive = self.earlier(lo, hi, owner)
        length, lo, hi = self._longest(lo, hi, self.place[at], self.place[at] + 1, np.full(len(at), seed_size), self.left[at], owner, alive)
        end = at + length
        hits: list[tuple[np.ndarray, np.ndarray]] = []

        def note(lanes: np.ndarray) -> None:
            offset = at[lanes] - begin[lanes]
            full = (end[lanes] - at[lanes] >= window) & (offset <= last[lanes])
            hits.append((lanes[full], offset[full]))

        lanes = np.flatnonzero(alive)
        note(lanes)
        while True:
            lanes = lanes[at[lanes] > begin[lanes]]
            if not len(lanes):
                break
            symbol = self.text[at[lanes] - 1]
            new_lo, new_hi = self.extend(symbol, lo[lanes], hi[lanes])
            fits = self.earlier(new_lo, new_hi, owner[lanes])
            stuck = lanes[~fits]
            lo[lanes[fits]], hi[lanes[fits]] = new_lo[fits], new_hi[fits]
            if len(stuck):
                kept = self._give_way(stuck, symbol[~fits], at, lo, hi, end, seed_end, owner)
                fits[~fits] = kept
            lanes = lanes[fits]
            at[lanes] -= 1
            note(lanes)
        who = np.concatenate([h[0] for h in hits])
        where = np.concatenate([h[1] for h in hits])
        order = np.lexsort((where, who))
        return np.split(where[order], np.searchsorted(who[order], np.arange(1, len(asked))))

    def _longest(self, lo, hi, near_lo, near_hi, least, most, owner, alive):
        """Largest length up to ``most`` at which the interval still holds an earlier owner; ``least`` is known to."""
        least, most = least.copy(), np.where(alive, most, least)
        while True:
            open_ = np.flatnonzero(least < most)
            if not len(open_):
                return least, lo, hi
            middle = (least[open_] + most[open_] + 1) // 2
            a, b = self.widen(near_lo[open_], near_hi[open_], middle)
            good = self.earlier(a, b, owner[open_])
            chosen = open_[good]
            least[chosen], lo[chosen], hi[chosen] = middle[good], a[good], b[good]
            most[open_[~good]] = middle[~good] - 1

    def _give_way(self, lanes, symbol, at, lo, hi, end, seed_end, owner) -> np.ndarray:
        """Shorten the matches of stuck lanes from the right until their next symbol fits; False where the seed would go."""
        least, most = seed_end[lanes] - at[lanes], end[lanes] - at[lanes] - 1
        kept = least <= most
        best_lo, best_hi, best = lo[lanes].copy(), hi[lanes].copy(), least.copy()
        tried = least.copy()
        first = True
        while True:
            open_ = np.flatnonzero(kept & (least <= most)) if first else np.flatnonzero(kept & (best < most))
            if not len(open_):
                break
            tried[open_] = least[open_] if first else (best[open_] + most[open_] + 1) // 2
            a, b = self.widen(lo[lanes[open_]], hi[lanes[open_]], tried[open_])
            a, b = self.extend(symbol[open_], a, b)
            good = self.earlier(a, b, owner[lanes[open_]])
            chosen = open_[good]
            best[chosen], best_lo[chosen], best_hi[chosen] = tried[chosen], a[good], b[good]
            bad = open_[~good]
            if first:
                kept[bad] = False
            else:
                most[bad] = tried[bad] - 1
            first = False
        ok = lanes[kept]
        lo[ok], hi[ok], end[ok] = best_lo[kept], best_hi[kept], at[ok] + best[kept]
        return kept
