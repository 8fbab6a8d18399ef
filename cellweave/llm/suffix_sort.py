"""Suffix order by induced sorting, with bucket queues that spill to the shared folder.

Suffixes are S-type (smaller than the next) or L-type. The order of the leftmost S-type suffixes
induces that of all L-types in one pass of a priority queue from the smallest, and these induce the
S-types in one pass from the largest. The queue holds one run of positions for each leading byte,
in order of arrival; a pass takes all that a byte has at once. Runs over the memory limit are
written to files and read when their byte's turn comes.

The first two passes sort the leftmost S-type substrings; the string of their ranks is sorted by
doubling, only as deep as the wanted prefix needs; then two passes give all suffixes, equal within
the wanted prefix in any order.
"""

from __future__ import annotations

import uuid
from collections import defaultdict, deque

import numpy as np
from pyarrow import fs

#: Bytes of queued runs held in memory.
HELD = 256 << 20


class Runs:
    """Queues of position runs by leading byte; over the limit, runs go to files in the folder."""

    def __init__(self, folder: str | None = None, held: int = HELD):
        self.queues, self.size, self.held, self.folder, self.files = defaultdict(deque), 0, held, folder, 0
        self.store = self.top = None

    def push(self, key: int, run: np.ndarray) -> None:
        if not len(run):
            return
        if self.folder and self.size + run.nbytes > self.held:
            if self.store is None:
                self.store, top = fs.FileSystem.from_uri(self.folder)
                self.top = f"{top}/{uuid.uuid4().hex}"
                self.store.create_dir(self.top, recursive=True)
            name, self.files = f"{self.top}/{self.files}", self.files + 1
            with self.store.open_output_stream(name) as f:
                f.write(run.astype(np.int64).tobytes())
            self.queues[key].append(name)
        else:
            self.size += run.nbytes
            self.queues[key].append(run)

    def pop(self, key: int) -> np.ndarray | None:
        if not self.queues[key]:
            return None
        run = self.queues[key].popleft()
        if isinstance(run, str):
            with self.store.open_input_stream(run) as f:
                back = np.frombuffer(f.read(), np.int64)
            self.store.delete_file(run)
            return back
        self.size -= run.nbytes
        return run

    def close(self) -> None:
        if self.store is not None:
            self.store.delete_dir(self.top)


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the end counts as smaller than any."""
    n = len(text)
    change = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    after = change[np.searchsorted(change, np.arange(n))]
    out = np.zeros(n, bool)
    inner = after < n - 1
    out[inner] = text[after[inner]] < text[after[inner] + 1]
    return out


def _deal(queue: Runs, text: np.ndarray, items: np.ndarray) -> None:
    """Pushes items to the queues of their bytes, in their order."""
    lead = text[items]
    order = np.argsort(lead, kind="stable")
    items, lead = items[order], lead[order]
    cut = np.flatnonzero(np.diff(lead)) + 1
    for part in np.split(np.arange(len(items)), cut) if len(items) else []:
        queue.push(int(lead[part[0]]), items[part])


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, folder: str | None, held: int) -> np.ndarray:
    """All suffixes in order, from the leftmost S-types in order by leading byte."""
    starts = np.searchsorted(text[seeds], np.arange(257))
    queue, large = Runs(folder, held), [[] for _ in range(256)]
    try:
        last = np.array([len(text) - 1], np.int64)
        queue.push(int(text[-1]), last)
        for c in range(256):
            while (run := queue.pop(c)) is not None:
                large[c].append(run)
                before = run[run > 0] - 1
                _deal(queue, text, before[~small[before]])
            own = seeds[starts[c] : starts[c + 1]]
            before = own[own > 0] - 1
            _deal(queue, text, before[~small[before]])
    finally:
        queue.close()
    queue, out = Runs(folder, held), []
    try:
        for c in range(255, -1, -1):
            parts = []
            while (run := queue.pop(c)) is not None:
                parts.append(run)
                before = run[run > 0] - 1
                _deal(queue, text, before[small[before]])
            own = np.concatenate(large[c])[::-1] if large[c] else np.zeros(0, np.int64)
            large[c] = []
            before = own[own > 0] - 1
            _deal(queue, text, before[small[before]])
            out += [*parts, own]
    finally:
        queue.close()
    return np.concatenate(out)[::-1]


def _doubled(names: np.ndarray, rounds: int) -> np.ndarray:
    """Order of the suffixes of names by their first 2 ** rounds names."""
    rank, n = names.astype(np.int64) + 1, len(names)
    order = np.argsort(rank, kind="stable")
    for k in range(rounds):
        after = np.zeros(n, np.int64)
        after[: max(0, n - (1 << k))] = rank[1 << k :]
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order] = np.cumsum(np.diff(key[order], prepend=-1) != 0)
        rank = new
        if rank.max(initial=0) == n:
            break
    return order


def suffix_order(text: np.ndarray, depth: int = 100, folder: str | None = None, held: int = HELD) -> np.ndarray:
    """Starts of all suffixes of bytes, in order of their first depth bytes at least."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    small = suffix_types(text)
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    seeds = left[np.argsort(text[left], kind="stable")]
    if len(left) > 1:
        found = induce(text, small, seeds, folder, held)
        is_left = np.zeros(n, bool)
        is_left[left] = True
        ranked = found[is_left[found]]
        # names: equal neighbours have the same bytes and types from one leftmost S-type to the next
        stop = np.full(n, n, np.int64)
        stop[left[:-1]] = left[1:]
        a, b = ranked[:-1], ranked[1:]
        span = stop[a] - a
        same = (span == stop[b] - b) & (stop[a] < n) & (stop[b] < n)
        at, k = np.flatnonzero(same), 0
        while len(at):
            equal = text[a[at] + k] == text[b[at] + k]
            same[at[~equal]] = False
            at, k = at[equal], k + 1
            at = at[span[at] >= k]
        name = np.zeros(n, np.int64)
        name[ranked] = np.concatenate([[0], np.cumsum(~same)])
        if not same.any():
            seeds = ranked
        else:  # a name spans two bytes at least
            seeds = left[_doubled(name[left], max(1, int(depth // 2).bit_length() + 1))]
    return induce(text, small, seeds, folder, held)


def equal_prefixes(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For ordered starts, whether each agrees with the one before in the first length bytes (all inside the text)."""
    words = text.astype(np.uint64)
    for step in (1, 2, 4):
        words[:-step] |= words[step:] << np.uint64(8 * step)
    a, b = starts[:-1], starts[1:]
    at = np.arange(len(b))
    for k in [*range(0, length - 7, 8), length - 8]:
        at = at[words[a[at] + k] == words[b[at] + k]]
    out = np.zeros(len(starts), bool)
    out[at + 1] = True
    return out
