"""Pairs of rows that share a key, made and compared by numpy (see ``blocking.meet_lists``).

What Spark joins are lists of rows, one for each side of a key; a task makes the pairs of some lists at a time as
numbers of rows, leaves out those that an earlier key gives, and compares what is left.  What belongs to a row is made
once a row; distances are those of bit-parallel columns (Myers), many pairs at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CELLS = 32_768  # pairs that are compared at once, or those of one left row
BLOCK = 8192  # pairs whose distances are made at once
MASKED = 52  # words of a name that a mask can tell apart


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


class Side:
    """The rows of lists: their columns, the list of each, and where a list's rows begin."""

    def __init__(self, lists: pa.ListArray):
        rows = lists.flatten()
        self.columns = dict(zip([f.name for f in rows.type], rows.flatten(), strict=True))
        ends = lists.offsets.to_numpy().astype(np.int64)
        self.start, self.count = ends[:-1] - ends[0], np.diff(ends)
        self.rows, self.group = len(rows), np.repeat(np.arange(len(lists)), self.count)

    def __getitem__(self, name: str) -> pa.Array:
        return self.columns[name]

    def by_id(self, name: str) -> None:
        """Puts each list's rows in order of a column."""
        rank = np.empty(self.rows, np.int64)
        rank[pc.sort_indices(self[name]).to_numpy()] = np.arange(self.rows)
        order = pa.array(np.lexsort((rank, self.group)))
        self.columns = {k: c.take(order) for k, c in self.columns.items()}


@dataclass
class Step:
    """Left rows from `first` to `last` with all right rows of their lists: pair i, j is cell base[i - first] + j."""

    first: int
    last: int
    base: np.ndarray
    i: np.ndarray
    j: np.ndarray


def steps(one: Side, two: Side) -> Iterator[Step]:
    times = two.count[one.group]
    ends, first = np.cumsum(times), 0
    while first < one.rows:
        before = ends[first] - times[first]
        last = max(first + 1, int(np.searchsorted(ends, before + CELLS, "right")))
        own = times[first:last]
        start = two.start[one.group[first:last]]
        base = np.cumsum(own) - own - start
        i = np.repeat(np.arange(first, last), own)
        yield Step(first, last, base, i, np.arange(len(i)) - np.repeat(base, own))
        first = last


class Shared:
    """Values of a column of lists that both rows of a pair have."""

    def __init__(self, one: Side, two: Side, name: str):
        left, right = one[name], two[name]
        code = plain(pa.chunked_array([left.flatten(), right.flatten()]).combine_chunks()).dictionary_encode()
        self.values, code = code.dictionary, code.indices.to_numpy().astype(np.int64)
        sizes = [pc.list_value_length(c).fill_null(0).to_numpy().astype(np.int64) for c in (left, right)]
        self.first = np.append(0, np.cumsum(sizes[0]))
        self.row = np.repeat(np.arange(one.rows), sizes[0])
        row = np.repeat(np.arange(two.rows), sizes[1])
        self.code = code[: len(self.row)]
        key, n = two.group[row] * len(self.values) + code[len(self.row) :], one.group[self.row] * len(self.values) + self.code
        order = np.argsort(key, kind="stable")
        key, self.right = key[order], row[order]
        starts = np.append(0, np.cumsum(sizes[1]))
        self.place = order - starts[self.right]  # of the value in the right row
        self.low = np.searchsorted(key, n)
        self.times = np.searchsorted(key, n, "right") - self.low

    def met(self, step: Step) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, entry of the left rows, entry of the right rows) for each value that a pair shares."""
        a, b = self.first[step.first], self.first[step.last]
        times = self.times[a:b]
        where = np.repeat(self.low[a:b] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        return np.repeat(step.base[self.row[a:b] - step.first], times) + self.right[where], np.repeat(np.arange(a, b), times), where

    def any(self, step: Step) -> np.ndarray:
        found = np.zeros(len(step.i), bool)
        found[self.met(step)[0]] = True
        return found

    def count(self, step: Step) -> np.ndarray:
        return np.bincount(self.met(step)[0], minlength=len(step.i))


class Texts:
    """Texts as runs of numbers of one alphabet."""

    def __init__(self, codes: np.ndarray, length: np.ndarray, letters: int):
        self.codes, self.length, self.letters = codes, length, letters
        self.start = np.cumsum(length) - length


def coded(*sides: list[str]) -> list[Texts]:
    flat = np.frombuffer("".join(t for texts in sides for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    number = np.zeros(int(flat.max()) + 1 if len(flat) else 1, np.int64)
    number[flat] = 1
    letters = int(number.sum())
    number = np.cumsum(number) - 1
    out, begin = [], 0
    for texts in sides:
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        out.append(Texts(number[flat[begin : (begin := begin + int(length.sum()))]], length, letters))
    return out


def distances(one: Texts, two: Texts, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Levenshtein distances of the texts i of one and j of two."""
    out = np.empty(len(i), np.int64)
    if not len(i):
        return out
    low, high = int(i.min()), int(i.max()) + 1
    length, size = one.length[low:high], max(1, one.letters)
    row = np.repeat(np.arange(high - low), length)
    at = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
    words = np.maximum(1, -(-length // 64))
    own = one.codes[one.start[low] : one.start[low] + len(row)]
    most = int(words.max())
    bits = np.zeros((most, (high - low) * size), np.uint64)  # where a text has a letter
    np.add.at(bits.reshape(-1), ((at >> 6) * (high - low) + row) * size + own, np.uint64(1) << (at & 63).astype(np.uint64))
    row, n = i - low, two.length[j]
    for w in range(1, most + 1):
        pick = np.arange(len(i)) if most == 1 else np.flatnonzero(words[row] == w)
        pick = pick[np.argsort(-n[pick].astype(np.int16 if n.max() < 2**15 else np.int64), kind="stable")]  # the longest first
        for begin in range(0, len(pick), BLOCK):
            some = pick[begin : begin + BLOCK]
            out[some] = _columns(bits[:w], row[some] * size, length[row[some]], two.codes, two.start[j[some]], n[some])
    return out


def _columns(bits: np.ndarray, base: np.ndarray, length: np.ndarray, codes: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Distances of texts whose letters stand in `bits` from base on, and texts of codes, of which the longest come first."""
    one, top = np.uint64(1), np.uint64(63)
    more = [np.full(len(base), ~np.uint64(0)) for _ in bits]
    less = [np.zeros(len(base), np.uint64) for _ in bits]
    there = np.searchsorted(-n, -np.arange(int(n[0])))
    for t, k in enumerate(there.tolist()):
        at = codes[start[:k] + t]
        at += base[:k]
        up, down = one, None
        for w, letters in enumerate(bits):
            eq, pv, mv = letters[at], more[w][:k], less[w][:k]
            xv = eq | mv
            if w:
                eq |= down
            xh = eq & pv
            xh += pv
            xh ^= pv
            xh |= eq
            ph = xh | pv
            np.invert(ph, out=ph)
            ph |= mv
            xh &= pv  # now the decreases
            carry = (ph >> top, xh >> top) if w + 1 < len(bits) else None
            ph <<= one
            ph |= up
            xh <<= one
            if w:
                xh |= down
            np.bitwise_and(ph, xv, out=mv)
            xv |= ph
            np.invert(xv, out=xv)
            np.bitwise_or(xv, xh, out=pv)
            if carry:
                up, down = carry
    found = n.copy()
    for w in range(len(bits)):
        own = np.clip(length - 64 * w, 0, 64)
        mask = np.where(own == 64, ~np.uint64(0), (one << np.minimum(own, 63).astype(np.uint64)) - one)
        found += np.bitwise_count(more[w] & mask).astype(np.int64) - np.bitwise_count(less[w] & mask)
    return found


def similarity(distance: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """That of ``matching.similarity``, of the distance and the lengths."""
    most = np.maximum(a, b)
    return np.where(most == 0, 1.0, 1 - distance / np.maximum(most, 1))


def ratio(shared: np.ndarray, either: np.ndarray) -> np.ndarray:
    return np.where(either == 0, 0.0, shared / np.maximum(either, 1))


def rounded(x: np.ndarray, digits: int = 6) -> np.ndarray:
    """To so many digits, halves up; x: 0 or more."""
    y = x * 10**digits
    whole = np.floor(y)
    return (whole + (y - whole >= 0.5)) / 10**digits


#: both sides -> a step and the cells that are pairs -> more columns
Make = Callable[[Side, Side], Callable[[Step, np.ndarray], dict[str, np.ndarray]]]


def run(make: Make, names: list[str], before: str = "_before") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """s1_id and cand_id of each pair, and what `make` makes of it."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, two, step, kept, made in each(batches, make, before):
            columns = {"s1_id": one["s1_id"].take(pa.array(step.i[kept])), "cand_id": two["cand_id"].take(pa.array(step.j[kept])), **made}
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in (columns[x] for x in names)], names)

    return pairs


def each(batches: Iterator[pa.RecordBatch], make: Make, before: str = "_before"):
    for batch in batches:
        if not len(batch):
            continue
        one, two = Side(batch["_rows1"]), Side(batch["_rows2"])
        two.by_id("cand_id")
        earlier, of = Shared(one, two, before), make(one, two)
        for step in steps(one, two):
            kept = np.flatnonzero(~earlier.any(step))
            if len(kept):
                yield one, two, step, kept, of(step, kept)


def labels(one: Side, two: Side):
    texts = Shared(one, two, "texts")
    return lambda step, kept: {"label": texts.any(step)[kept].astype(np.int32)}


def best_of(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(s1_id, cand_id) of the pairs that may be among the first `most` of their s1_id in order of cand_id."""

    def pairs(batches):
        for one, two, step, kept, _ in each(batches, lambda one, two: lambda step, kept: {}):
            i = step.i[kept]
            start = np.flatnonzero(np.diff(i, prepend=-1))
            rank = np.arange(len(i)) - np.repeat(start, np.diff(np.append(start, len(i))))
            kept = kept[rank < most]
            yield pa.RecordBatch.from_arrays([one["s1_id"].take(pa.array(step.i[kept])), two["cand_id"].take(pa.array(step.j[kept]))], ["s1_id", "cand_id"])

    return pairs


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(s1_id, n_found, n_candidates): numbers of pairs, of those with label 1 and of all, not yet summed over all tasks' keys."""
    for one, _, step, kept, made in each(batches, labels):
        at, n = step.i[kept] - step.first, step.last - step.first
        found, every = np.bincount(at, made["label"], n).astype(np.int64), np.bincount(at, minlength=n)
        rows = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([one["s1_id"].take(pa.array(rows + step.first)), pa.array(found[rows]), pa.array(every[rows])], ["s1_id", "n_found", "n_candidates"])


def alias(one: Side, two: Side):
    """best: that of ``matching.best_of_alias`` for legal and alias of the left names, rounded."""
    legal, alias_, names = coded(*(c.fill_null("").to_pylist() for c in (one["legal"], one["alias"], two["name"])))
    has = one["alias"].is_valid().to_numpy(zero_copy_only=False)

    def of(step, kept):
        i, j = step.i[kept], step.j[kept]
        best = similarity(distances(legal, names, i, j), legal.length[i], names.length[j])
        also = np.flatnonzero(has[i])
        i, j = i[also], j[also]
        best[also] = np.maximum(best[also], similarity(distances(alias_, names, i, j), alias_.length[i], names.length[j]))
        return {"best": rounded(best)}

    return of


def rests(shared: Shared, side: Side, which: int, step: Step, kept: np.ndarray, met: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[list[str], np.ndarray]:
    """The texts of a row's words that the other row of a pair has not, and each kept cell's number among them."""
    cell, rows = met[0], (step.i if which == 0 else step.j)[kept]
    place = met[1] - shared.first[shared.row[met[1]]] if which == 0 else shared.place[met[2]]
    words = side["words"]
    if int(pc.max(pc.list_value_length(words)).as_py() or 0) > MASKED:
        own, out = [set() for _ in step.i], []
        for c, p in zip(cell.tolist(), place.tolist(), strict=True):
            own[c].add(p)
        for c, row in zip(kept.tolist(), rows.tolist(), strict=True):
            out.append(" ".join(w for p, w in enumerate(words[row].as_py()) if p not in own[c]))
        return out, np.arange(len(out))
    # words of a row are distinct, so each bit is added once
    mask = np.bincount(cell, np.exp2(place), len(step.i)).astype(np.int64)[kept]
    low = int(rows.min())
    masks, code = np.unique(mask, return_inverse=True)
    keys, at = np.unique((rows - low) * len(masks) + code, return_inverse=True)
    row, code = np.divmod(keys, len(masks))
    lists = dict(zip(u := np.unique(row), words.take(pa.array(u + low)).to_pylist(), strict=True))
    return [" ".join(w for p, w in enumerate(lists[r]) if not m >> p & 1) for r, m in zip(row.tolist(), masks[code].tolist(), strict=True)], at


def features(one: Side, two: Side):
    """label and the columns of ``matching.FEATURES``, which see; columns: those of ``matching.fields``."""
    texts, words, parts, numbers = (Shared(one, two, c) for c in ("texts", "words", "addr_words", "numbers"))
    of_words = pc.utf8_length(words.values).to_numpy(zero_copy_only=False).astype(np.float64)
    pairs_of = lambda name: coded(one[name].to_pylist(), two[name].to_pylist())
    (n1, n2), (a1, a2), (o1, o2) = map(pairs_of, ("name", "addr", "sorted"))
    size = lambda name: [pc.list_value_length(s[name]).to_numpy().astype(np.int64) for s in (one, two)]
    (w1, w2), (b1, b2), (k1, k2) = map(size, ("words", "addr_words", "numbers"))
    # length of a row's distinct words, joined
    set1, set2 = (np.array([len(" ".join(w)) for w in s["words"].to_pylist()], np.int64) for s in (one, two))

    def equal(name: str):
        code = plain(pa.chunked_array([one[name], two[name]]).combine_chunks()).dictionary_encode().indices.fill_null(-1).to_numpy()
        left, right = code[: one.rows], code[one.rows :]
        return lambda i, j: ((left[i] == right[j]) & (left[i] >= 0)).astype(np.float64)

    pin, city, state = map(equal, ("pin", "city", "state"))
    s3 = pc.starts_with(two["cand_id"], "S3-").to_numpy(zero_copy_only=False).astype(np.float64)

    def of(step: Step, kept: np.ndarray) -> dict[str, np.ndarray]:
        i, j, cells = step.i[kept], step.j[kept], len(step.i)
        met = words.met(step)
        shared = np.bincount(met[0], minlength=cells)[kept]
        base = np.bincount(met[0], of_words[words.code[met[1]]], cells)[kept].astype(np.int64) + np.maximum(shared - 1, 0)
        (x, at1), (y, at2) = (rests(words, s, k, step, kept, met) for k, s in enumerate((one, two)))
        x, y = coded(x, y)
        # the shared words begin both texts, and a space follows where there are others
        rest = distances(x, y, at1, at2) + ((shared > 0) & ((w1[i] == shared) != (w2[j] == shared)))
        whole = similarity(rest, set1[i], set2[j])
        to_base = [similarity(np.abs(s - base), s, base) for s in (set1[i], set2[j])]  # the base begins either
        name = similarity(distances(n1, n2, i, j), n1.length[i], n2.length[j])
        addr = similarity(distances(a1, a2, i, j), a1.length[i], a2.length[j])
        some = [a1.length[i] > 0, a2.length[j] > 0]
        lengths = np.maximum(n1.length[i], n2.length[j])
        both = {c: s.count(step)[kept] for c, s in (("addr", parts), ("numbers", numbers))}
        return {
            "label": texts.any(step)[kept].astype(np.int32),
            "name_levenshtein": name,
            "name_jaccard": ratio(shared, w1[i] + w2[j] - shared),
            "addr_levenshtein": addr,
            "addr_jaccard": ratio(both["addr"], b1[i] + b2[j] - both["addr"]),
            "same_name": ((name == 1) & (n1.length[i] == n2.length[j])).astype(np.float64),
            "length_ratio": np.where(lengths == 0, 1.0, np.minimum(n1.length[i], n2.length[j]) / np.maximum(lengths, 1)),
            "shared_tokens": shared.astype(np.float64),
            "pin_match": pin(i, j),
            "number_overlap": ratio(both["numbers"], k1[i] + k2[j] - both["numbers"]),
            "has_both_addr": (some[0] & some[1]).astype(np.float64),
            "name_x_addr": name * addr,
            "token_sort": similarity(distances(o1, o2, i, j), o1.length[i], o2.length[j]),
            "token_set": np.maximum(np.where(shared > 0, np.maximum(*to_base), 0.0), whole),
            "city_match": city(i, j),
            "state_match": state(i, j),
            "from_s3": s3[j],
            "missing_addr": (~(some[0] & some[1])).astype(np.float64),
        }

    return of


def rounded_features(columns: tuple[str, ...]) -> Make:
    """features, of which these columns are rounded."""

    def make(one: Side, two: Side):
        of = features(one, two)
        return lambda step, kept: {k: rounded(v) if k in columns else v for k, v in of(step, kept).items()}

    return make


def with_copies(one: Side, two: Side):
    """features, and n_copies of the left row."""
    of, n = features(one, two), one["n_copies"].to_numpy(zero_copy_only=False)
    return lambda step, kept: {"n_copies": n[step.i[kept]], **of(step, kept)}


def predicted(trees: list[tuple[float, list[tuple]]], columns: tuple[str, ...]) -> Make:
    """label and p, the probability by ``matching.trees``, rounded; columns: the features by number."""

    def make(one: Side, two: Side):
        of = features(one, two)

        def rows(step: Step, kept: np.ndarray) -> dict[str, np.ndarray]:
            found = of(step, kept)
            x = np.stack([found[c] for c in columns])
            every, margin = np.arange(len(kept)), np.zeros(len(kept))
            for weight, nodes in trees:
                feature, threshold, left, right, prediction = (np.array(c) for c in zip(*nodes, strict=True))
                at = np.zeros(len(kept), np.int64)
                while (feature[at] >= 0).any():
                    at = np.where(x[feature[at], every] <= threshold[at], left[at], right[at])  # leaves stay
                margin += weight * prediction[at]
            return {"label": found["label"], "p": rounded(1 / (1 + np.exp(-2 * margin)))}

        return rows

    return make
