"""Streaming over rows that arrive sorted by a block key."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per run of equal keys; only the current run is held in memory."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        cols = [t.column(k).to_numpy() for k in keys]
        change = np.zeros(t.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(change).tolist()
        first = tuple(c[0] for c in cols)
        if held and first != last:
            yield pa.concat_tables(held)
            held = []
        at = 0
        for cut in cuts:
            held.append(t.slice(at, cut - at))
            yield pa.concat_tables(held)
            held, at = [], cut
        held.append(t.slice(at))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.concat_tables(held)


class Forest:
    """Union-find over 0..n-1; a root is its tree's smallest index."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], dtype=np.int64)
