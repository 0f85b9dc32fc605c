"""Fill-in-the-middle transformation; a wavelet matrix over character classes finds the cuts.

The bytes of a slice of texts (``text.slices``: bounded, no text is cut) become
classes, numbered so that every unit is a range of them:

    0 continuation byte, 1 inside a word, 2 white space, 3 word start,
    4 word start that begins a line, 5 white space that begins a line

``char`` units begin at classes 1-5 (code points), ``word`` units at 3-4,
``line`` units at 4-5.  A wavelet matrix of the classes answers, for all texts
of the slice at once, how many classes below c lie before a byte; two such
ranks make the number of unit boundaries, and bisection on ranks finds the
byte at which the k-th unit ends.  The pieces are then cut and put together by
Spark functions, and ``restore`` rebuilds the text from output and form alone.

Cuts.  n is the number of units; h1 to h4 are the first four 8-digit groups of
the hex SHA-256 of ``seed:doc_id``.  The prefix ends after min(h1 % (n + 1),
h2 % (n + 1)) units, the middle after max(...); what stands before the first
unit of a piece (spaces) belongs to the piece before it, or to the first.

Defined results: a null text counts as empty; empty texts and texts that hold a
marker stay plain; a null doc_id counts as an empty string in the hash; repeated
rows and ties are each returned; very long texts are slices of their own; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm import text as T

UNITS = {"char": (1, 6), "word": (3, 5), "line": (4, 6)}
BITS = 3
MARKS = ("<P>", "<S>", "<M>")       # prefix, suffix, middle


class WaveletMatrix:
    """Ranks over a sequence of small numbers; every level holds one bit of each, zeros sorted before ones."""

    def __init__(self, symbols: np.ndarray, bits: int = BITS):
        self.n, self.bits, self.levels = len(symbols), bits, []
        for shift in range(bits - 1, -1, -1):
            one = (symbols >> shift & 1).astype(bool)
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            packed[: -(-self.n // 8)] = np.packbits(one, bitorder="little")
            words = packed.view("<u8")
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
            self.levels.append((words, before, self.n - int(before[-1])))
            symbols = np.concatenate((symbols[~one], symbols[one]))

    @staticmethod
    def _ones(words, before, at):
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(words[at >> 6] & mask)

    def below(self, c: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are less than c."""
        if c >= 1 << self.bits:
            return at
        total, ends = np.zeros(len(at), np.int64), np.concatenate(([0], at))
        for shift, (words, before, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            ones = self._ones(words, before, ends)
            if c >> shift & 1:
                left = ends - ones
                total += left[1:] - left[0]
                ends = zeros + ones
            else:
                ends = ends - ones
        return total

    def rank(self, classes: tuple[int, int], at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols lie in the range of classes."""
        return self.below(classes[1], at) - self.below(classes[0], at)

    def after(self, classes: tuple[int, int], start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The place where k units that begin in [start, end) have ended: where unit k + 1 begins, or ``end``."""
        target = self.rank(classes, start) + k + 1
        lo, hi = start.copy(), end.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            reached = self.rank(classes, mid + 1) >= target[open_]
            hi[open_[reached]] = mid[reached]
            lo[open_[~reached]] = mid[~reached] + 1
        return np.where(k == 0, start, lo)


def classes(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The class of every byte of a slice."""
    n = len(buf)
    first = np.zeros(n + 1, bool)
    first[offs] = True
    first = first[:n]
    space = T.Words.separators[buf]
    after_space = np.concatenate(([True], space[:-1])) | first
    after_line = np.concatenate(([True], buf[:-1] == 0x0A)) | first
    out = np.where(space, 2, np.where(after_space, 3, 1)).astype(np.uint8)
    out[after_line] = np.where(space[after_line], 5, 4)
    out[~T.code_points(buf)] = 0
    return out


def cuts(docs: DataFrame, unit: str = "char", seed: int = 1) -> DataFrame:
    """(doc_id, text, h3, h4, n, prefix_end, middle_end, prefix_chars, middle_chars): both cuts of every text, in bytes."""
    wanted, chars = UNITS[unit], UNITS["char"]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       *(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)))

    def run(batches):
        for s in T.slices(batches):
            buf, offs = T.as_bytes(s.column(1))
            start, end = offs[:-1], offs[1:]
            matrix = WaveletMatrix(classes(buf, offs))
            n = matrix.rank(wanted, end) - matrix.rank(wanted, start)
            a, b = (s.column(i).to_numpy() % (n + 1) for i in (2, 3))
            one = matrix.after(wanted, start, end, np.minimum(a, b))
            two = matrix.after(wanted, start, end, np.maximum(a, b))
            before = matrix.rank(chars, one)
            yield pa.RecordBatch.from_arrays(
                [s.column(0), s.column(1), s.column(4), s.column(5),
                 *map(pa.array, (n, one - start, two - start, before - matrix.rank(chars, start), matrix.rank(chars, two) - before))],
                names=names)

    schema = "doc_id long, text string, h3 long, h4 long, n long, prefix_end long, middle_end long, prefix_chars long, middle_chars long"
    names = [f.split()[0] for f in schema.split(", ")]
    return rows.mapInArrow(run, schema)


def transform(docs: DataFrame, unit: str = "char", seed: int = 1, moved_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, text, output) of every document; the form is plain, psm or spm."""
    found = cuts(docs, unit, seed)
    marked = F.lit(False)
    for m in MARKS:
        marked = marked | F.contains("text", F.lit(m))
    form = (F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= moved_percent), "plain")
            .when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm"))
    found = found.withColumn("form", form)
    prefix = F.expr("substring(cast(text as binary), 1, int(prefix_end))").cast("string")
    middle = F.expr("substring(cast(text as binary), int(prefix_end) + 1, int(middle_end - prefix_end))").cast("string")
    suffix = F.expr("substring(cast(text as binary), int(middle_end) + 1)").cast("string")
    p, s, m = map(F.lit, MARKS)
    output = (F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
              .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("text")))
    moved = F.col("form") != "plain"
    return found.select("doc_id", "n", "form", F.when(moved, F.col("prefix_chars")).alias("prefix_chars"),
                        F.when(moved, F.col("middle_chars")).alias("middle_chars"), "text", output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text, rebuilt from an output and its form (a moved text holds no marker, so each marker occurs once)."""
    second, third = (F.locate(m, output) for m in MARKS[1:])
    p = F.locate(MARKS[0], output)

    def between(start, stop):
        return F.substring(output, start, F.greatest(stop - start, F.lit(0)))

    rest = F.substring(output, third + 3, F.length(output))
    return (F.when(form == "psm", F.concat(between(F.lit(4), second), rest, between(second + 3, third)))
            .when(form == "spm", F.concat(between(p + 3, third), rest, between(F.lit(4), p))).otherwise(output))
