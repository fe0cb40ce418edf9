"""Edit distance within a bound, for many pairs at once."""

from __future__ import annotations

import numpy as np

_CELLS = 4_000_000


def within(left: list[str], right: list[str], most: int) -> np.ndarray:
    """Whether each pair of texts is at most ``most`` edits (insert, delete, replace) apart.

    Banded bit-parallel: the cells of one column that lie within ``most`` of the diagonal are the bits
    of a word, and a column is a few word operations, done for all pairs together. What pairs
    have in common at both ends is left out first.
    """
    result = np.zeros(len(left), dtype=bool)
    cores = []
    for i, (a, b) in enumerate(zip(left, right)):
        if abs(len(a) - len(b)) > most:
            continue
        a, b = _core(a, b)
        if len(a) > len(b):
            a, b = b, a
        if len(a) <= most:  # shorter than half the band
            result[i] = _plain(a, b) <= most
        else:
            cores.append((len(b), i, a, b))
    cores.sort(key=lambda c: c[:2])
    at = 0
    while at < len(cores):
        end = at + 1
        while end < len(cores) and cores[end][0] * (end - at + 1) <= _CELLS:
            end += 1
        some = cores[at:end]
        result[[c[1] for c in some]] = _banded([c[3] for c in some], [c[2] for c in some], most) <= most
        at = end
    return result


def _core(a: str, b: str) -> tuple[str, str]:
    """Both texts without what they share at the start and at the end."""
    x, y = np.frombuffer(a.encode("utf-32-le"), np.uint32), np.frombuffer(b.encode("utf-32-le"), np.uint32)
    n = min(len(x), len(y))
    differ = x[:n] != y[:n]
    start = int(differ.argmax()) if differ.any() else n
    x, y = x[start:][::-1], y[start:][::-1]
    n -= start
    differ = x[:n] != y[:n]
    end = int(differ.argmax()) if differ.any() else n
    return a[start : len(a) - end], b[start : len(b) - end]


def _plain(a: str, b: str) -> int:
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def _columns(texts: list[str], before: int, height: int, fill: int) -> np.ndarray:
    """Code points, one text per column, from row ``before`` on."""
    out = np.full((height, len(texts)), fill, dtype=np.int32)
    for i, text in enumerate(texts):
        out[before : before + len(text), i] = np.frombuffer(text.encode("utf-32-le"), np.int32)
    return out


def _banded(rows: list[str], columns: list[str], most: int) -> np.ndarray:
    """Distances up to ``most``; more is any larger number. Rows are at least as long as columns, and longer than ``most``."""
    width = 2 * most + 1
    full = np.uint32((1 << width) - 1)
    m = np.array([len(r) for r in rows])
    n = np.array([len(c) for c in columns])
    last = int(n.max())
    x = _columns(rows, most, max(int(m.max()) + most, last + width) + 1, -1)
    y = _columns(columns, 0, last, -2)
    vp = np.full(len(rows), ((1 << (most + 1)) - 1) << most, dtype=np.uint32)  # rows from 0 on
    vn = np.zeros(len(rows), dtype=np.uint32)
    distance = np.full(len(rows), most)
    row_bit = np.full(len(rows), 1 << (width - 2), dtype=np.uint32)
    for j in range(last):
        same = np.zeros(len(rows), dtype=np.uint32)
        for k in range(width):
            same |= (x[j + k] == y[j]).astype(np.uint32) << np.uint32(k)
        d0 = ((((same & vp) + vp) ^ vp) | same | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        diagonal = j < m - most
        level = ~diagonal & (j < n)
        distance += diagonal & ((d0 >> np.uint32(width - 1)) == 0)
        distance += level & ((hp & row_bit) != 0)
        distance -= level & ((hn & row_bit) != 0)
        row_bit = np.where(level, row_bit >> np.uint32(1), row_bit)
        vp, vn = (hn | ~((d0 >> np.uint32(1)) | hp)) & full, (d0 >> np.uint32(1)) & hp
    return distance
