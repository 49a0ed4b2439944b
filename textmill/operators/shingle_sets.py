"""Word 3-grams of texts as numbers, a slice of a batch at a time (numpy).

A set's name is a hash of its 3-grams.  Its keys are such that similar sets have
one in common: of sets of similar size, the 3-grams are dealt by their hash to
more parts than two similar sets can have differing 3-grams, so one part at least
is equal.  A part holds about eight 3-grams (at a threshold of 0.9), so sets of
little in common, a shared passage say, meet in no key, however many they are.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text and rows that are taken at a time (row numbers are 16 bits wide)
SLICE_BYTES = 1 << 21
SLICE_ROWS = 1 << 14
#: thresholds from which a part holds several 3-grams; below, parts would be empty
PARTS_FROM = 0.85

_LANES = ("shingles: lane 1", "shingles: lane 2")
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PREFIX = np.uint64(1 << 63)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def slices(sizes: np.ndarray):
    """(start, end) of runs of rows that hold SLICE_BYTES and SLICE_ROWS at most, or one row."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (total + size > SLICE_BYTES or i - start >= SLICE_ROWS):
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def byte_sizes(texts) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def _windows(texts):
    """(words, codes, start of each 3-gram among the codes, its row): the distinct
    words and every window of three words that single spaces separate."""
    lists = pc.split_pattern(texts, " ")
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    row = np.repeat(np.arange(len(counts), dtype=np.uint16), counts)
    whole = pc.binary_length(words).to_numpy(zero_copy_only=False)[codes] > 0
    start = np.flatnonzero((row[:-2] == row[2:]) & whole[:-2] & whole[1:-1] & whole[2:]) if len(row) > 2 else np.zeros(0, dtype=np.int64)
    return words, codes, start, row[start]


def _in_rows(order: np.ndarray, row: np.ndarray) -> np.ndarray:
    """``order`` with rows first (a radix sort, since rows are 16 bits wide)."""
    return order[np.argsort(row[order], kind="stable")]


def _ends(row: np.ndarray, rows: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])


def named_sets(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lane 1, lane 2, row) of each row's distinct 3-grams in the order of the
    lanes: 128 bits that depend on the 3-gram alone."""
    words, codes, start, row = _windows(texts)
    values = np.array(words.cast(pa.binary()).to_pylist(), dtype=object)
    lanes = []
    for key in _LANES:
        name = pd.util.hash_array(values, hash_key=key, categorize=False) if len(values) else np.zeros(0, dtype=np.uint64)
        parts = [(name * by)[codes] for by in (_A, _B, _C)]
        lanes.append(mixed(parts[0][start] + parts[1][start + 1] + parts[2][start + 2]))
    one, two = lanes
    order = _in_rows(np.argsort(one), row)
    a, b, r = one[order], two[order], row[order]
    same = (a[1:] == a[:-1]) & (r[1:] == r[:-1])
    if (same & (b[1:] != b[:-1])).any():  # 3-grams of equal first lanes
        order = np.lexsort((two, one, row))
        a, b, r = one[order], two[order], row[order]
        same = (a[1:] == a[:-1]) & (r[1:] == r[:-1]) & (b[1:] == b[:-1])
    first = np.concatenate([[True], ~same]) if len(r) else np.zeros(0, dtype=bool)
    return a[first], b[first], r[first]


@functools.cache
def levels(threshold: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest size, parts) of each level up to sets of ``most``.

    Level i serves pairs whose smaller set is of class i, the sizes from its
    smallest to that by the threshold; the larger one is of class i or i + 1.  Sets of
    sizes a <= b <= a / threshold and at least that similarity differ in (1 - t) / (1 + t) * (a + b)
    members at most.  No parts: such sets are equal."""
    starts, parts, low = [], [], 1
    while low <= most:
        high = int(np.floor(low / threshold + 1e-9))
        differing = int(np.floor(high * (1 - threshold) / threshold + 1e-9))
        starts.append(low)
        parts.append(differing + 1 if differing else 0)
        low = high + 1
    return np.array(starts, dtype=np.int64), np.array(parts, dtype=np.int64)


def shared_keys(one: np.ndarray, two: np.ndarray, row: np.ndarray, rows: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(key, row), by row: two rows of at least that similarity whose sets are not
    equal have a key in common.

    Each part that is not empty gives a key.  Of two sets whose equal parts are all
    empty both have an empty part: those rows also give their prefix in the order of
    the lanes, of which similar sets share a member."""
    n = np.bincount(row, minlength=rows)
    ends = np.concatenate([[0], np.cumsum(n)])
    starts, parts = levels(threshold, 1 << int(max(1, n.max(initial=0))).bit_length())
    kind = np.searchsorted(starts, n, side="right") - 1
    value = mixed(one * _A + two)
    keys, of = [], []
    for level in (kind, kind - 1):
        k = np.where((level >= 0) & (n > 0), parts[np.maximum(level, 0)], 0)
        used = np.flatnonzero(k[row] > 0)
        if not len(used):
            continue
        r = row[used]
        part = ((one[used] >> np.uint64(32)) * k[r].astype(np.uint64)) >> np.uint64(32)  # ascending in a row
        begin = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (part[1:] != part[:-1])]))
        total, r, part = np.add.reduceat(value[used], begin), r[begin], part[begin]
        salt = level.astype(np.uint64) << np.uint64(32)
        keys.append(mixed(total + mixed(salt[r] + part + _B)))
        of.append(r)
        filled = np.bincount(r, minlength=rows)
        for i in np.flatnonzero((filled < k) & (k > 0)).tolist():
            size = int(n[i])
            prefix = value[ends[i]:ends[i] + size - int(np.ceil(size * threshold - 1e-9)) + 1]
            keys.append(mixed(prefix + mixed(salt[i:i + 1] + _PREFIX)))
            of.append(np.full(len(prefix), i, dtype=np.uint16))
    if not keys:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint16)
    keys, of = np.concatenate(keys), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return keys[order].view(np.int64), of[order]


def names_and_keys(texts, threshold: float | None):
    """(names of the sets, keys) of an Arrow array of texts; no keys without a threshold."""
    names, lists = [], []
    for a, b in slices(byte_sizes(texts)):
        one, two, row = named_sets(texts.slice(a, b - a))
        ends = _ends(row, b - a)
        names += [hashlib.sha256(one[x:y].tobytes() + two[x:y].tobytes()).digest() for x, y in zip(ends[:-1], ends[1:])]
        if threshold is not None:
            keys, of = shared_keys(one, two, row, b - a, threshold)
            lists.append(pa.ListArray.from_arrays(pa.array(_ends(of, b - a), pa.int32()), pa.array(keys, pa.int64())))
    kind = pa.list_(pa.int64())
    return pa.array(names, pa.binary()), pa.concat_arrays(lists) if lists else pa.nulls(len(texts), kind)


def member_names(texts):
    """The first lanes of each text's set (Arrow lists)."""
    lists = []
    for a, b in slices(byte_sizes(texts)):
        one, _, row = named_sets(texts.slice(a, b - a))
        lists.append(pa.ListArray.from_arrays(pa.array(_ends(row, b - a), pa.int32()), pa.array(one.view(np.int64), pa.int64())))
    return pa.concat_arrays(lists) if lists else pa.nulls(0, pa.list_(pa.int64()))


#: cells of the incidence matrix that is multiplied at a time
_CELLS = 1 << 22


def similar_rows(names, block: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b), a != b in any order, of distinct blocks if there are two, whose
    sets of distinct names are similar above the threshold; empty sets: 1."""
    n = pc.list_value_length(names).to_numpy(zero_copy_only=False)
    values, rows = names.flatten().to_numpy(zero_copy_only=False), len(n)
    row = np.repeat(np.arange(rows), n)
    left, right = (np.flatnonzero(block == x) for x in (block.min(), block.max()))
    at = np.zeros(rows, dtype=np.int64)
    at[left], at[right] = np.arange(len(left)), np.arange(len(right))
    cross = block.min() != block.max()
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, dtype=np.int64)
    many = np.diff(np.append(begin, len(values)))
    both = np.full((len(left), len(right)), np.float32((many == rows).sum()))
    some = (many > 1) & (many < rows)
    used = np.repeat(some, many)
    row, column, width = row[used], np.repeat(np.cumsum(some) - 1, many)[used], max(1, _CELLS // rows)
    for first in range(0, int(some.sum()), width):
        x, y = np.searchsorted(column, [first, first + width])
        cells = np.zeros((rows, min(width, int(some.sum()) - first)), dtype=np.float32)
        cells[row[x:y], column[x:y] - first] = 1
        both += cells[left] @ cells[right].T if cross else cells @ cells.T
    found = []
    for i, row in enumerate(both):
        row = row.astype(np.float64)
        union = n[left[i]] + n[right] - row
        found.append(np.flatnonzero(np.where(union == 0, 1.0, row / np.maximum(union, 1)) > threshold))
    a, b = np.repeat(left, [len(x) for x in found]), right[np.concatenate(found)]
    return (np.concatenate([a, b]), np.concatenate([b, a])) if cross else (a[a != b], b[a != b])
