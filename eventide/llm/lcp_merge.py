"""Merging sorted string runs with loser trees that know common prefixes (numpy, many trees in lock step).

Strings are fixed-width rows.  A run is a sorted array of them with, for each
row, the length of the prefix it shares with the row before it.  The strings
are cut into many narrow ranges; one loser tree merges each range, and all
trees take their next step together.  A tree node keeps the loser and the
length of the prefix it shares with the winner that beat it, so a match is
decided by these lengths alone unless they are equal, and then only the bytes
beyond the shared prefix are read.
"""

from __future__ import annotations

import numpy as np

PAD = 8             # zero bytes after each row, so that eight bytes can be read anywhere
MAX_RUNS = 256      # runs merged at once; more are merged in rounds
TREES = 2048        # ranges merged in lock step, at most one for each 64 rows
_STEPS = np.array([1 << s for s in range(56, 0, -8)], np.uint64)


def shared_prefixes(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix each row shares with the row before it (first: 0)."""
    out = np.zeros(len(rows), np.int64)
    for lo in range(1, len(rows), 1 << 16):
        hi = min(lo + (1 << 16), len(rows))
        differs = rows[lo:hi] != rows[lo - 1: hi - 1]
        any_ = differs.any(axis=1)
        out[lo:hi] = np.where(any_, differs.argmax(axis=1), rows.shape[1])
    return out


def front_code(rows: np.ndarray, lcp: np.ndarray) -> tuple[bytes, bytes]:
    """A sorted run as shared-prefix lengths (one byte each) and the remaining bytes of its rows."""
    keep = np.arange(rows.shape[1]) >= lcp[:, None]
    return lcp.astype(np.uint8).tobytes(), rows[keep].tobytes()


def from_front_code(lengths: bytes, tails: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    lcp = np.frombuffer(lengths, np.uint8).astype(np.int64)
    rows = np.zeros((len(lcp), width), np.uint8)
    keep = np.arange(width) >= lcp[:, None]
    rows[keep] = np.frombuffer(tails, np.uint8)
    for j in range(width):      # a byte inside the shared prefix is that of the last row that spelt it out
        last = np.maximum.accumulate(np.where(keep[:, j], np.arange(len(lcp)), 0))
        rows[:, j] = rows[last, j]
    return rows, lcp


class _Trees:
    def __init__(self, rows: np.ndarray, lcp: np.ndarray, bounds: np.ndarray):
        """bounds: (trees, runs + 1 pairs) begin and end of every run's part in every tree's range."""
        self.width = rows.shape[1]
        self.step = self.width + PAD
        padded = np.zeros((len(rows), self.step), np.uint8)
        padded[:, : self.width] = rows
        self.words = np.ndarray((max(0, padded.size - 7),), ">u8", padded.reshape(-1), strides=(1,))
        self.lcp = np.append(lcp, 0)
        self.cur, self.end = bounds
        self.trees, self.runs = self.cur.shape
        self.known = np.where(self.cur < self.end, 0, -1)
        self.loser = np.zeros((self.trees, max(self.runs, 1)), np.int64)

    def compare(self, a, b, known):
        """Whether row a <= row b, and the length of their shared prefix, reading from ``known`` on."""
        at, first = known.copy(), np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x = self.words[a[live] * self.step + at[live]].astype(np.uint64)
            y = self.words[b[live] * self.step + at[live]].astype(np.uint64)
            diff = x ^ y
            lead = (diff[:, None] < _STEPS).sum(axis=1)
            apart = diff != 0
            first[live] = x <= y
            at[live] += np.where(apart, lead, 8)
            live = live[~apart & (at[live] < self.width)]
        return first, np.minimum(at, self.width)

    def play(self, tree, a, b):
        """Winner and loser of runs a and b in each tree; the loser learns the prefix it shares with the winner."""
        ha, hb = self.known[tree, a], self.known[tree, b]
        wins = ha > hb
        tie = np.flatnonzero((ha == hb) & (ha >= 0))
        if len(tie):
            t, x, y = tree[tie], a[tie], b[tie]
            first, shared = self.compare(self.cur[t, x], self.cur[t, y], ha[tie])
            wins[tie] = first
            self.known[t, np.where(first, y, x)] = shared
        return np.where(wins, a, b), np.where(wins, b, a)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        total = (self.end - self.cur).sum(axis=1)
        rank = np.argsort(-total, kind="stable")         # the longest first, so that live trees lead
        self.cur, self.end, self.known, total = self.cur[rank], self.end[rank], self.known[rank], total[rank]
        win = np.broadcast_to(np.arange(self.runs), (self.trees, self.runs))
        while win.shape[1] > 1:
            half = win.shape[1] // 2
            tree = np.repeat(np.arange(self.trees), half)
            w, l = self.play(tree, win[:, 0::2].ravel(), win[:, 1::2].ravel())
            self.loser[:, half: 2 * half] = l.reshape(self.trees, half)
            win = w.reshape(self.trees, half)
        win = win[:, 0].copy()
        rows, shared, of = [], [], []
        for t in range(int(total[0]) if len(total) else 0):
            k = int(np.searchsorted(-total, -t, side="left"))
            tree, c = np.arange(k), win[:k]
            at = self.cur[tree, c]
            rows.append(at)
            shared.append(self.known[tree, c])
            of.append(tree)
            self.cur[tree, c] = at + 1
            self.known[tree, c] = np.where(at + 1 < self.end[tree, c], self.lcp[at + 1], -1)
            node = (self.runs + c) >> 1
            for _ in range(self.runs.bit_length() - 1):
                w, l = self.play(tree, c, self.loser[tree, node])
                self.loser[tree, node] = l
                c, node = w, node >> 1
            win[:k] = c
        order = np.argsort(rank[np.concatenate(of)], kind="stable")
        return np.concatenate(rows)[order], np.concatenate(shared)[order]


def merge(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of all runs (numbered run after run), and prefixes shared with the row before."""
    if len(runs) > MAX_RUNS:
        out, first = [], 0
        for lo in range(0, len(runs), MAX_RUNS):
            order, lcp = merge(runs[lo: lo + MAX_RUNS])
            rows = np.concatenate([r for r, _ in runs[lo: lo + MAX_RUNS]])
            out.append((rows[order], lcp, first + order))
            first += len(rows)
        order, lcp = merge([(r, h) for r, h, _ in out])
        return np.concatenate([o for _, _, o in out])[order], lcp
    runs_n = 1 << max(0, len(runs) - 1).bit_length()
    rows = np.concatenate([r for r, _ in runs])
    lcp = np.concatenate([h for _, h in runs])
    if len(rows) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.zeros((len(rows), 8), np.uint8)
    head[:, : min(8, rows.shape[1])] = rows[:, :8]
    head = head.view(">u8").ravel().astype(np.uint64)
    sample = np.sort(head[:: max(1, len(head) >> 15)])
    cuts = np.unique(sample[:: max(1, len(sample) // max(1, min(TREES, len(head) >> 6)))][1:])
    trees = len(cuts) + 1
    begin, end = np.zeros((trees, runs_n), np.int64), np.zeros((trees, runs_n), np.int64)
    at = 0
    for i, (r, _) in enumerate(runs):
        inner = np.searchsorted(head[at: at + len(r)], cuts, side="left")
        edges = np.concatenate(([0], inner, [len(r)])) + at
        begin[:, i], end[:, i] = edges[:-1], edges[1:]
        at += len(r)
    order, shared = _Trees(rows, lcp, (begin, end)).merged()
    # the first row of a tree's range knows nothing of the range before it
    first = np.cumsum((end - begin).sum(axis=1))[:-1]
    first = np.unique(first[(first > 0) & (first < len(order))])
    a, b = rows[order[first]], rows[order[first - 1]]
    differs = a != b
    shared[first] = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return order, shared
