"""A table from units (short byte strings) to runs of ids, looked up for a whole batch at once.

A unit is known by its first and last eight bytes and its length, and beyond sixteen bytes by a hash and
then by all its bytes; so two units are never taken for one.  New units are handed to ``solve`` once.  The
table holds at most MOST bytes: beyond, the units that were asked for once since the last time go, and if
they are too few, all do.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from kinsift.llm.textkit import U, mix, span_hashes

MOST = 96 << 20
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], U)  # masks of the first k bytes
_ROW = 64  # bytes that a unit takes besides its own and its values


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(total)


class Units:
    """Spans of a byte array: head, tail, length and hash of each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.sizes = data, starts, ends - starts
        padded = np.zeros(len(data) + 16, np.uint8)
        padded[8:-8] = data
        eights = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))
        self.head = eights[starts + 8] & _KEEP[np.minimum(self.sizes, 8)]
        self.tail = np.where(self.sizes > 8, eights[ends], U(0))
        self.hash = mix(self.head * U(0x9E3779B97F4A7C15) + mix(self.tail + self.sizes.astype(U)))
        long = np.flatnonzero(self.sizes > 16)
        if len(long):
            places = ragged(starts[long], self.sizes[long])
            to = np.cumsum(self.sizes[long])
            self.hash[long] ^= span_hashes(data[places], to - self.sizes[long], to)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.sizes[i]].tobytes()


class Rows:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.array, self.n = np.empty(1024, kind), 0

    def __len__(self) -> int:
        return self.n

    @property
    def all(self) -> np.ndarray:
        return self.array[: self.n]

    def extend(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.array):
            self.array = np.concatenate([self.all, np.empty(max(n, 2 * self.n) - self.n, self.array.dtype)])
        self.array[self.n : n] = values
        self.n = n


class UnitTable:
    """solve: a list of units as bytes -> a run of ids for each."""

    def __init__(self, solve: Callable[[list[bytes]], list], kind: str, most: int = MOST):
        self.solve, self.kind, self.most = solve, np.dtype(kind), most
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots = np.zeros(0, U), np.zeros(0, np.int32)  # sorted by key
        self.head, self.tail, self.size, self.uses = Rows(U), Rows(U), Rows(np.int32), Rows(np.int32)
        self.value_at, self.value_n, self.values = Rows(np.int64), Rows(np.int32), Rows(self.kind)
        self.long: dict[int, bytes] = {}
        self.long_bytes = 0

    def held(self) -> int:
        return len(self.head) * _ROW + len(self.values) * self.kind.itemsize + self.long_bytes

    def _same(self, units: Units, at: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Whether the units at these places are those of the slots."""
        out = (units.head[at] == self.head.all[slots]) & (units.tail[at] == self.tail.all[slots]) & (units.sizes[at] == self.size.all[slots])
        for i in np.flatnonzero(out & (units.sizes[at] > 16)).tolist():
            out[i] = units.bytes_of(int(at[i])) == self.long[int(slots[i])]
        return out

    def _add(self, units: Units, at: np.ndarray) -> np.ndarray:
        """New slots for the units at these places."""
        texts = [units.bytes_of(i) for i in at.tolist()]
        runs = self.solve(texts)
        counts = np.fromiter(map(len, runs), np.int64, len(runs))
        values = np.fromiter((v for r in runs for v in r), self.kind, int(counts.sum()))
        slots = np.arange(len(self.head), len(self.head) + len(at))
        self.value_at.extend(len(self.values) + np.cumsum(counts) - counts)
        for rows, new in ((self.head, units.head[at]), (self.tail, units.tail[at]), (self.size, units.sizes[at]), (self.uses, np.zeros(len(at), np.int32)), (self.value_n, counts), (self.values, values)):
            rows.extend(new)
        for slot, text in zip(slots.tolist(), texts, strict=True):
            if len(text) > 16:
                self.long[slot] = text
                self.long_bytes += len(text)
        return slots

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of each span; valid until the next call."""
        if self.held() > self.most:
            self._shrink()
        units = Units(data, starts, ends)
        keys, first, back = np.unique(units.hash, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            inside = np.minimum(place, len(self.keys) - 1)
            known = self.keys[inside] == keys
            slots = np.where(known, self.slots[inside], 0).astype(np.int64)
        else:
            slots = np.zeros(len(keys), np.int64)
        new = np.flatnonzero(~known)
        if len(new):
            slots[new] = self._add(units, first[new])
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.slots = np.insert(self.slots, place[new], slots[new].astype(np.int32))
        out = slots[back]
        # all spans at once; only those of over 16 bytes are compared byte by byte, once a distinct one
        fine = (units.head == self.head.all[out]) & (units.tail == self.tail.all[out]) & (units.sizes == self.size.all[out])
        long = np.flatnonzero(fine & (units.sizes > 16))
        if len(long):
            fine[long] = self._same(units, long, out[long])
        self.uses.all[slots] += 1
        odd = np.flatnonzero(~fine)
        if len(odd):  # another unit of the same hash: slots without a key
            out[odd] = self._add(units, odd)
        return out

    def _shrink(self) -> None:
        """Forgets the units used in one batch only; all, if that's not half of them."""
        kept = np.flatnonzero(self.uses.all[self.slots] > 1)
        if 2 * len(kept) > len(self.slots):
            return self.clear()
        old, keys, slots = self.__dict__.copy(), self.keys[kept], self.slots[kept].astype(np.int64)
        self.clear()
        self.keys, self.slots = keys, np.arange(len(slots), dtype=np.int32)
        counts = old["value_n"].all[slots]
        places = ragged(old["value_at"].all[slots], counts.astype(np.int64))
        self.value_at.extend(np.cumsum(counts) - counts)
        for name in ("head", "tail", "size", "value_n"):
            getattr(self, name).extend(old[name].all[slots])
        self.values.extend(old["values"].all[places])
        self.uses.extend(np.zeros(len(slots), np.int32))
        for new, slot in enumerate(slots.tolist()):
            if slot in old["long"]:
                self.long[new] = old["long"][slot]
                self.long_bytes += len(self.long[new])
        return None

    def runs(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slots, one run after another, and how many each has."""
        counts = self.value_n.all[slots].astype(np.int64)
        return self.values.all[ragged(self.value_at.all[slots], counts)], counts
