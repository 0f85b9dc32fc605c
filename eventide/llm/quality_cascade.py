"""Quality rules as a short-circuit cascade.

Every rule reads one measure of a document and rejects it beyond a bound.  The
cost of a rule's measure (seconds per byte) and its selectivity (share of
documents it rejects) are estimated on a bounded random sample; rules then run
in the order of rejection per cost, and a measure is taken only for documents
that every earlier rule let pass.  The verdict is the conjunction of all rules
and so never depends on the order; ``rejected_by`` names the rule that fired
first in the order used.

Defined results: null and empty texts have no words and fail ``few_words``;
rows are judged one by one, so ties, repeated rows and null ids change
nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm import text as T

SAMPLE_ROWS = 4096      # bound of the sample that orders the rules

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
REPEAT_WINDOW = 8


class Measures:
    """Measures of the documents of one slice."""

    def __init__(self, buf, offs):
        self.buf, self.offs = buf, offs
        self.words = T.Words(buf, offs, lower=False)
        self.n_words = self.words.counts.astype(np.int64)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offs[1:]] - total[self.offs[:-1]]

    def word_chars(self) -> np.ndarray:
        return self.per_row(self.words.inside & T.code_points(self.buf))

    def n_symbols(self) -> np.ndarray:
        return self.per_row(_SYMBOL[self.buf])

    def n_exclamations(self) -> np.ndarray:
        return self.per_row(self.buf == ord("!"))

    def n_letterless(self) -> np.ndarray:
        """Words without an ASCII letter or a non-ASCII character."""
        w = self.words
        letters = np.concatenate(([0], np.cumsum(_LETTER[self.buf], dtype=np.int64)))
        none = (letters[w.end] == letters[w.start]).astype(np.int64)
        total = np.concatenate(([0], np.cumsum(none)))
        return total[w.row_start[1:]] - total[w.row_start[:-1]]

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those of them equal to an earlier line of the document."""
        n, rows = len(self.buf), len(self.offs) - 1
        cut = np.zeros(n + 1, bool)
        cut[self.offs] = True
        feed = np.flatnonzero(self.buf == 10)
        start = np.unique(np.concatenate((self.offs[:-1], feed + 1)))
        start = start[start < n]
        stop = np.zeros(n + 1, bool)
        stop[feed] = True
        stop |= cut
        ends = np.flatnonzero(stop)
        end = ends[np.searchsorted(ends, start, side="left")] if len(start) else start
        # a line that starts at a document's first byte ends at the next feed or document end
        again = (end == start) & (start < n) & ~(self.buf[np.minimum(start, n - 1)] == 10) if n else np.zeros(0, bool)
        if again.any():
            end = end.copy()
            end[again] = ends[np.searchsorted(ends, start[again], side="right")]
        inside = np.concatenate(([0], np.cumsum(self.words.inside, dtype=np.int64)))
        full = inside[end] > inside[start]
        start, end = start[full], end[full]
        row = np.searchsorted(self.offs, start, side="right") - 1
        total = np.bincount(row, minlength=rows).astype(np.int64)
        h = T.span_hashes(self.buf, start, end)
        order = np.lexsort((h, row))
        same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
        dup = np.bincount(row[order][1:][same], minlength=rows).astype(np.int64)
        return total, dup

    def n_repeat_words(self) -> np.ndarray:
        """Words covered by an 8-word window found twice or more in the document."""
        w, rows = self.words, len(self.offs) - 1
        h, at = T.windows(w.hashes(), w.row_start, REPEAT_WINDOW)
        if len(h) == 0:
            return np.zeros(rows, np.int64)
        row = np.searchsorted(w.row_start, at, side="right") - 1
        order = np.lexsort((h, row))
        same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
        twice = np.zeros(len(h), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(len(w.start) + 1, np.int64)
        edge[at[twice]] += 1
        np.subtract.at(edge, at[twice] + REPEAT_WINDOW, 1)
        covered = np.cumsum(edge[:-1]) > 0
        total = np.concatenate(([0], np.cumsum(covered)))
        return total[w.row_start[1:]] - total[w.row_start[:-1]]


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], np.ndarray]


def _lines_repeat(m: Measures) -> np.ndarray:
    total, dup = m.lines()
    return 100 * dup > 50 * total


RULES = (
    Rule("few_words", lambda m: m.n_words < 20),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words() > 30 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols() > m.n_words),
    Rule("repeated_lines", _lines_repeat),
    Rule("letterless_words", lambda m: 100 * m.n_letterless() > 30 * m.n_words),
    Rule("word_length", lambda m: (lambda c: (2 * c < 5 * m.n_words) | (c > 12 * m.n_words))(m.word_chars())),
    Rule("exclamations", lambda m: 10 * m.n_exclamations() > 3 * m.n_words),
)
BASE_RULES = ("few_words", "repeated_windows")


def estimate(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds per byte, share rejected) of each rule over a random sample of at most sample_rows rows."""
    n = docs.count()
    part = docs.select("text").sample(fraction=min(1.0, sample_rows / max(n, 1)), seed=7).limit(sample_rows)

    def run(batches):
        for s in T.slices(batches, limit=T.LEAN_BYTES):
            buf, offs = T.as_bytes(s.column(0))
            names, secs, gone = [], [], []
            for r in rules:
                m = Measures(buf, offs)
                t = time.thread_time()
                bad = r.rejects(m)
                secs.append(time.thread_time() - t)
                gone.append(int(bad.sum()))
                names.append(r.name)
            k = len(rules)
            yield pa.RecordBatch.from_pydict({"rule": names, "secs": secs, "gone": pa.array(gone, pa.int64()),
                                              "n": pa.array([len(offs) - 1] * k, pa.int64()),
                                              "size": pa.array([len(buf)] * k, pa.int64())})

    rows = (part.mapInArrow(run, "rule string, secs double, gone long, n long, size long")
            .groupBy("rule").agg(F.sum("secs"), F.sum("size"), F.sum("gone"), F.sum("n")).collect())
    by = {r[0]: (r[1] / max(r[2], 1), r[3] / max(r[4], 1)) for r in rows}      # one row per rule
    return [(r.name, *by.get(r.name, (0.0, 0.0))) for r in rules]


def ordered(estimates: list[tuple[str, float, float]], rules=RULES) -> list[Rule]:
    """Rules by rejection per cost, best first; the given order breaks ties."""
    rank = {name: share / max(cost, 1e-12) for name, cost, share in estimates}
    return sorted(rules, key=lambda r: -rank.get(r.name, 0.0))


def cascade(buf: np.ndarray, offs: np.ndarray, rules) -> np.ndarray:
    """Index in ``rules`` of the rule that rejects each document first, -1 for kept ones."""
    rows = len(offs) - 1
    verdict = np.full(rows, -1, np.int64)
    live = np.arange(rows)
    for k, rule in enumerate(rules):
        if len(live) == 0:
            break
        if k == 0 or shrunk:
            if len(live) == rows:
                m = Measures(buf, offs)
            else:
                size = offs[live + 1] - offs[live]
                new = np.concatenate(([0], np.cumsum(size)))
                at = np.arange(new[-1]) - np.repeat(new[:-1], size) + np.repeat(offs[live], size)
                m = Measures(buf[at], new)
        bad = rule.rejects(m)
        verdict[live[bad]] = k
        live, shrunk = live[~bad], bool(bad.any())
    return verdict


def judge(docs: DataFrame, rules=RULES, counts: bool = False, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, kept, rejected_by) of every document, one row for each.

    ``counts`` adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    and base_failed, which are then taken for all documents.
    """
    order = ordered(estimate(docs, rules, sample_rows), rules)
    schema = "doc_id long, kept boolean, rejected_by string"
    if counts:
        schema += (", n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
                   " base_failed boolean")

    def run(batches):
        for s in T.slices(batches, limit=T.LEAN_BYTES):
            buf, offs = T.as_bytes(s.column(1))
            v = cascade(buf, offs, order)
            out = [s.column(0), pa.array(v < 0),
                   pa.array([None if k < 0 else order[k].name for k in v], pa.string())]
            if counts:
                m = Measures(buf, offs)
                rep = m.n_repeat_words()
                out += [pa.array(x) for x in (m.n_words, m.word_chars(), m.n_symbols(), m.lines()[1], rep,
                                              (m.n_words < 20) | (100 * rep > 30 * m.n_words))]
            yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def kept_rows(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that pass every rule, unchanged."""
    order = ordered(estimate(docs, rules, sample_rows), rules)
    at = docs.columns.index("text")

    def run(batches):
        for s in T.slices(batches, limit=T.LEAN_BYTES):
            yield s.filter(pa.array(cascade(*T.as_bytes(s.column(at)), order) < 0))

    return docs.mapInArrow(run, docs.schema)
