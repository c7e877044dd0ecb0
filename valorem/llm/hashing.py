"""Rolling hashes of byte strings in numpy, and runs of equal keys in sorted batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below n."""
    if len(_POWERS["up"]) < n:
        size = 1 << n.bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


class Rolling:
    """Hashes of any spans of a byte array: equal bytes have equal hashes wherever they lie."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values + np.uint64(1)) * up[:len(values)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def whole_runs(batches: Iterator[pa.RecordBatch], columns: int, most: int | None) -> Iterator[tuple[bool, np.ndarray]]:
    """Rows of longs sorted by the first column -> (False, rows of whole runs) and (True, rows of runs over ``most``).

    A run that goes over the end of a batch is held until it ends. One that
    grows over ``most`` is passed on as it comes and never held.
    """
    held = np.empty((columns, 0), np.int64)
    common = None

    def sorted_out(rows: np.ndarray):
        start = np.flatnonzero(np.concatenate(([True], rows[0, 1:] != rows[0, :-1])))
        size = np.diff(np.append(start, rows.shape[1]))
        over = np.repeat(size > most, size) if most is not None else np.zeros(rows.shape[1], bool)
        if over.any():
            yield True, rows[:, over]
            rows = rows[:, ~over]
        if rows.shape[1]:
            yield False, rows

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.concatenate([held, np.stack([batch.column(i).to_numpy() for i in range(columns)])], axis=1)
        if common is not None:
            more = rows[0] == common
            if more.any():
                yield True, rows[:, more]
                rows = rows[:, ~more]
            if not rows.shape[1]:
                held = rows
                continue
            common = None
        last = rows[0] == rows[0, -1]
        done, held = rows[:, ~last], rows[:, last]
        if done.shape[1]:
            yield from sorted_out(done)
        if most is not None and held.shape[1] > most:
            common = held[0, 0]
            yield True, held
            held = held[:, :0]
    if held.shape[1]:
        yield from sorted_out(held)
