"""Interpolated modified Kneser-Ney model of any order, counted in Spark and memory-mapped by the workers.

Counting.  Tasks pre-aggregate sorted (key, count) runs; each run is cut by
shard, delta-coded, and merged by the shard's task.  Three kinds of shard files
lie in the model folder, all sorted arrays that are looked up by binary search:

    vocab-S.hash, vocab-S.count, vocab-S.cont
        64-bit word hashes in ascending order over all shards (a word's id is
        its place), training counts, and numbers of different words before it
    gramN-S.key, gramN-S.count (one byte; larger ones in .count.at, .count.big)
        for each N from 2 to the order: context id << 32 | word id, and counts;
        the context is a word (N = 2) or a gram of N - 1 words, whose id is its
        place over all shards
    contextN-S.id, contextN-S.stats
        contexts of more than ``SHORT`` keys with their total and how many words
        followed once, twice, more; shorter ones are summed from their keys

The highest level counts occurrences.  A level below counts different words
before a gram (different grams of the next level that end with it), or the
occurrences of a gram that begins a text, which has none before it.

Grams lie in the shard of their context; contexts with more than a fixed
share of all tokens (a bounded number of them), and the beginning of a text,
are spread over all shards by the whole key, and their totals are summed apart.

Scoring.  P(w|u) = max(c(uw) - D(c), 0) / c(u) + g(u) P(w|u'), u' without u's
first word, down to the words' continuation counts, which back off to
1 / (V + 1); D are the modified Kneser-Ney discounts of each level.  A slice of texts looks its
distinct keys up in ascending order in the mapped arrays, so a worker keeps
only the pages it touches.  The folder must be a shared one that workers see
as files (a ``file:`` path), because object stores cannot be memory-mapped.

Defined results: null and empty texts are one end token; a null doc_id counts
as training; repeated rows are each counted and scored; with no training text
every token has probability 1 / (V + 1) = 1; other columns are not read.
"""

from __future__ import annotations

import functools
import os
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventide.llm import text as T
from eventide.llm.components import discard, shuffles_dropped, written_lean
from eventide.session import scratch_path

END = np.uint64(0x5D6F2A9C31E7B845)       # the end token's hash
START = np.uint64(0xFFFFFFFF)             # context id of a text's first token
RUN_KEYS = 2_000_000                      # distinct keys a task holds before it emits a run
SHORT = 4                                 # contexts of at most so many keys have no stored totals
HEAVY_SHARE = 4                           # contexts above 1 / (HEAVY_SHARE * shards) of the tokens are spread


# ---- sorted runs -----------------------------------------------------------

def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending 64-bit keys and their counts, delta-coded by byte planes."""
    step = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = np.concatenate((step.view(np.uint8).reshape(-1, 8).T.ravel(),
                             counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()))
    return len(keys).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(block[:8], "little")
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block[8:], max_output_size=12 * n), np.uint8)
    step = np.ascontiguousarray(planes[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(step, dtype=np.uint64), np.ascontiguousarray(planes[8 * n:].reshape(4, n).T).view("<u4").ravel()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys with their counts added up."""
    if len(keys) == 0:
        return keys, counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first)


class _Tally:
    """Counts of keys in a task, emitted as one run per shard whenever enough are held."""

    def __init__(self, shard_of):
        self.shard_of, self.keys, self.counts, self.held = shard_of, [], [], 0

    def add(self, keys: np.ndarray):
        k, n = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(n)
        self.held += len(k)
        if self.held >= 2 * RUN_KEYS:
            k, n = summed(np.concatenate(self.keys), np.concatenate(self.counts))
            self.keys, self.counts, self.held = [k], [n], len(k)
            if self.held >= RUN_KEYS:
                yield self.close()

    def close(self):
        k, n = summed(np.concatenate([np.zeros(0, np.uint64), *self.keys]), np.concatenate([np.zeros(0, np.int64), *self.counts]))
        self.keys, self.counts, self.held = [], [], 0
        return runs(self.shard_of(k), k, n)


def runs(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """One packed run per shard of ascending keys."""
    parts = [(s, pack(keys[rows], counts[rows])) for s, rows in _rows_of_shards(shard)]
    return pa.RecordBatch.from_arrays(
        [pa.array([s for s, _ in parts], pa.int32()), pa.array([r for _, r in parts], pa.binary())], names=["shard", "run"])


def _rows_of_shards(shard: np.ndarray):
    """(shard, its rows in order) of each shard that has rows."""
    n = np.bincount(shard)
    order = np.argsort(shard.astype(np.uint16) if len(n) <= 1 << 16 else shard, kind="stable")      # 16 bits: by radix
    used = np.flatnonzero(n)
    ends = np.cumsum(n[used])
    for s, a, b in zip(used.tolist(), (ends - n[used]).tolist(), ends.tolist()):
        yield s, order[a:b]


def _by_shard(batches):
    """(shard, [runs]) of each shard of a partition sorted by shard."""
    held, at = [], None
    for b in batches:
        for shard, run in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if shard != at:
                if held:
                    yield at, held
                held, at = [], shard
            held.append(run)
    if held:
        yield at, held


def _merged(held) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(r) for r in held]
    return summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))


def _dealt(df: DataFrame, shards: int) -> DataFrame:
    return df.repartition(shards, "shard").sortWithinPartitions("shard")


# ---- files -----------------------------------------------------------------

def local_path(path: str) -> str:
    """The folder as workers open it."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"the model folder must be a shared folder that workers see as files, not {path}")
    return path


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Write a shard file; a second attempt of a task writes the same bytes and replaces it."""
    os.makedirs(folder, exist_ok=True)
    tmp = f"{folder}/.{name}.{TaskContext.get().taskAttemptId()}"
    array.tofile(tmp)
    os.replace(tmp, f"{folder}/{name}")


@functools.lru_cache(maxsize=4096)
def _mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    path = f"{folder}/{name}"
    if not os.path.exists(path) or os.path.getsize(path) == 0:
        return np.zeros(0, dtype)
    return np.asarray(np.memmap(path, dtype, "r"))


def _save_counts(folder: str, name: str, counts: np.ndarray) -> None:
    """Counts as one byte each; those of 255 and more stand, in 64 bits, in a second pair of arrays."""
    big = np.flatnonzero(counts >= 255)
    _save(folder, name, np.minimum(counts, 255).astype("u1"))
    _save(folder, f"{name}.at", big.astype("<u8"))
    _save(folder, f"{name}.big", counts[big].astype("<u8"))


def _counts(folder: str, name: str, at: np.ndarray | None = None) -> np.ndarray:
    """Counts at the given places, or all."""
    small = _mapped(folder, name, "u1")
    out = (small if at is None else small[at]).astype(np.int64)
    over = np.flatnonzero(out == 255)
    if len(over):
        places = over if at is None else at[over]
        out[over] = _mapped(folder, f"{name}.big", "<u8")[np.searchsorted(_mapped(folder, f"{name}.at", "<u8"), places.astype(np.uint64))]
    return out


# ---- the model -------------------------------------------------------------

def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of keys counted once to four times."""
    n1, n2, n3, n4 = n
    if min(n1, n2, n3) == 0:
        return 0.75, 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    out = tuple(min(float(i), i - (i + 1) * y * b / a) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))
    return out if min(out) > 0 else (0.75, 0.75, 0.75)      # else a context would leave nothing to unseen words


@dataclass
class Level:
    heavy: np.ndarray           # spread contexts, ascending
    heavy_stats: np.ndarray     # their total, n1, n2, n3+
    base: np.ndarray            # first gram id of each shard
    top: tuple = (0, 0, 0)      # discounts


@dataclass
class Model:
    folder: str
    bits: int                   # shards: 2 ** bits
    base: np.ndarray            # first word id of each shard
    tokens: int                 # N
    vocabulary: int             # V
    low: tuple = (0, 0, 0)      # discounts of the words' continuation counts
    types: int = 0              # different bigrams
    low_back: float = 1.0       # weight of the uniform distribution
    levels: dict = field(default_factory=dict)      # Level of each N >= 2

    def _find(self, kind: str, dtype: str, shard: np.ndarray, keys: np.ndarray, *reads, near=None) -> tuple[np.ndarray, ...]:
        """Whether each key is in its shard's array, where, and what ``reads`` get there; keys ascend within each shard.

        A read is (function of shard and places, width); keys that are not found get zeros.  A key whose ``near`` is
        not negative can only be at that place or one of the next ``SHORT`` - 1.
        """
        found, at = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        out = [np.zeros((len(keys), width) if width > 1 else len(keys), np.int64) for _, width in reads]
        for s, rows in _rows_of_shards(shard):
            array = _mapped(self.folder, f"{kind[0]}-{s}.{kind[1]}", dtype)
            if len(array):
                own = keys[rows]
                if near is None:
                    place = np.searchsorted(array, own)
                else:
                    place = near[rows]
                    few, far = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
                    around = array.take(place[few][:, None] + np.arange(SHORT), mode="clip")
                    place[few] += (around == own[few][:, None]).argmax(axis=1)
                    place[far] = np.searchsorted(array, own[far])
                place = np.minimum(place, len(array) - 1)
                hit = array[place] == own
                found[rows], at[rows] = hit, place
                if reads:
                    rows, place = rows[hit], place[hit]
                    for o, (read, _) in zip(out, reads):
                        o[rows] = read(s, place)
        return found, at, *out

    def _column(self, kind: str, name: str, dtype: str, width: int = 1):
        """A read of ``_find``: the given array of a shard."""
        def read(s, place):
            array = _mapped(self.folder, f"{kind}-{s}.{name}", dtype)
            return array[place] if width == 1 else array.reshape(-1, width)[place]
        return read, width

    def words(self, hashes: np.ndarray, ids_only: bool = False):
        """Ids (-1: unknown), counts and continuation counts of words."""
        u, back = np.unique(hashes, return_inverse=True)
        shard = (u >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(u), np.int64)
        reads = () if ids_only else (self._column("vocab", "count", "<u8"), self._column("vocab", "cont", "<u4"))
        found, at, *more = self._find(("vocab", "hash"), "<u8", shard, u, *reads)
        ids = np.where(found, at + self.base[shard], -1)
        return ids[back] if ids_only else (ids[back], *(x[back] for x in more))

    def contexts(self, n: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Total, n1, n2, n3+ of each context of level n, zeros for unseen ones; and where a short one's keys begin, or -1."""
        heavy, heavy_stats = self.levels[n].heavy, self.levels[n].heavy_stats
        u, back = np.unique(ids, return_inverse=True)
        shard = gram_shard(u << np.uint64(32), np.zeros(0, np.uint64), self.bits)
        out = np.zeros((len(u), 4), np.int64)
        long = np.zeros(len(u), bool)
        near = np.full(len(u), -1, np.int64)
        for s, rows in _rows_of_shards(shard):
            keys = _mapped(self.folder, f"gram{n}-{s}.key", "<u8")
            if len(keys) == 0:
                continue
            lo = np.searchsorted(keys, u[rows] << np.uint64(32))
            # the context's first keys; it is short if the one after SHORT of them is another's
            at = lo[:, None] + np.arange(SHORT + 1)
            own = (keys.take(at, mode="clip") >> np.uint64(32) == u[rows][:, None]) & (at < len(keys))
            long[rows] = own[:, SHORT]
            near[rows] = np.where(own[:, 0] & ~own[:, SHORT], lo, -1)
            i, j = np.nonzero(own[:, :SHORT] & ~own[:, SHORT:])
            c = _counts(self.folder, f"gram{n}-{s}.count", at[i, j])
            stats = np.bincount(4 * i + np.minimum(c, 3), minlength=4 * len(rows)).reshape(-1, 4)
            stats[:, 0] = np.bincount(i, c, len(rows))
            out[rows] = stats
        at_long = np.flatnonzero(long)
        out[at_long] = self._find((f"context{n}", "id"), "<u4", shard[at_long], u[at_long].astype(np.uint32),
                                  self._column(f"context{n}", "stats", "<u8", 4))[2]
        if len(heavy):
            place = np.minimum(np.searchsorted(heavy, u), len(heavy) - 1)
            big = heavy[place] == u
            out[big] = heavy_stats[place[big]]
            near[big] = -1      # their keys lie in all shards
        return out[back], near[back]

    def grams(self, n: int, keys: np.ndarray, counts: bool = False, near: np.ndarray | None = None):
        """Ids of the grams of level n (-1: unseen) and, on demand, their counts; ``near``: of their contexts."""
        u, back = np.unique(keys, return_inverse=True)
        shard = gram_shard(u, self.levels[n].heavy, self.bits)
        reads = [(lambda s, place: _counts(self.folder, f"gram{n}-{s}.count", place), 1)] if counts else []
        if near is not None:
            by_key = np.empty(len(u), np.int64)
            by_key[back] = near
            near = by_key
        found, at, *seen = self._find((f"gram{n}", "key"), "<u8", shard, u, *reads, near=near)
        ids = np.where(found, at + self.levels[n].base[shard], -1)
        return (ids[back], seen[0][back]) if counts else ids[back]

    def suffixes(self, n: int, ids: np.ndarray) -> np.ndarray:
        """For ascending ids of level n: the id, one level below, of the gram without its first word."""
        shard = np.searchsorted(self.levels[n].base, ids, "right") - 1
        out = np.zeros(len(ids), np.uint64)
        for s in np.unique(shard).tolist():
            rows = np.flatnonzero(shard == s)
            at = ids[rows] - self.levels[n].base[s]
            out[rows] = (_mapped(self.folder, f"gram{n}-{s}.key", "<u8")[at] & np.uint64(0xFFFFFFFF) if n == 2
                         else _mapped(self.folder, f"gram{n}-{s}.suffix", "<u4")[at])
        return out

    def context_ids(self, n: int, ids: np.ndarray, starts: np.ndarray, grams=None) -> np.ndarray:
        """Each token's context id at level n (-1: none), from word ids and, where known, the gram ids of level n - 1."""
        if n > 2 and grams is None:
            below = self.context_ids(n - 1, ids, starts)
            grams = np.full(len(ids), -1, np.int64)
            ok = np.flatnonzero((below >= 0) & (ids >= 0))
            grams[ok] = self.grams(n - 1, gram_keys(below[ok], ids[ok]))
        out = np.empty(len(ids), np.int64)
        out[1:] = (ids if n == 2 else grams)[:-1]
        out[starts] = int(START) if n == 2 else -1
        return out

    def score(self, hashes: np.ndarray, starts: np.ndarray):
        """Per token: count in training and log10 probability; starts: first token of each text."""
        ids, count, cont = self.words(hashes)
        low = self.low_back / (self.vocabulary + 1)
        p = np.full(len(ids), low)
        if self.types:
            p += (cont - _discount(cont, self.low)) / self.types
        grams = None
        for n, level in sorted(self.levels.items()):
            before = self.context_ids(n, ids, starts, grams)
            ctx = np.flatnonzero(before >= 0)
            stats, near = self.contexts(n, before[ctx].astype(np.uint64))
            seen = stats[:, 0] > 0
            ctx, stats, near = ctx[seen], stats[seen], near[seen]
            c = np.zeros(len(ctx), np.int64)
            known = ids[ctx] >= 0
            at = ctx[known]
            grams = np.full(len(ids), -1, np.int64)
            grams[at], c[known] = self.grams(n, gram_keys(before[at], ids[at]), counts=True, near=near[known])
            back = (stats[:, 1:] * np.array(level.top)).sum(axis=1)
            p[ctx] = ((c - _discount(c, level.top)) + back * p[ctx]) / stats[:, 0]
        return count, np.log10(p)


def gram_keys(ctx: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return ctx.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64)


def _discount(c: np.ndarray, d: tuple) -> np.ndarray:
    return np.array((0.0, *d))[np.minimum(c, 3)]


def gram_shard(keys: np.ndarray, heavy: np.ndarray, bits: int) -> np.ndarray:
    """The shard of each gram: its context's, or its own for spread contexts."""
    ctx = keys >> np.uint64(32)
    by = T.mix(ctx + np.uint64(1))
    if len(heavy):
        spread = heavy[np.minimum(np.searchsorted(heavy, ctx), len(heavy) - 1)] == ctx
        by[spread] = T.mix(keys[spread])
    return (by >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def tokens(col) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts end to end (an end token closes each), and the bounds of the texts."""
    buf, offs = T.as_bytes(col)
    w = T.Words(buf, offs, lower=True)
    n = w.counts + 1
    ends = np.cumsum(n)
    out = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint64)
    body = np.ones(len(out), bool)
    body[ends - 1] = False
    out[body] = w.hashes()
    return out, np.concatenate(([0], ends))


def _four(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in range(1, 5)]


def train(docs: DataFrame, path: str, order: int = 2) -> Model:
    """Count the texts of docs and write the model's arrays under the shared folder ``path``."""
    if order < 2:
        raise ValueError("the order is at least 2")
    spark, folder = docs.sparkSession, local_path(path)
    bits = max(0, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    shards = 1 << bits
    texts = docs.select("text")

    def count_words(batches):
        tally = _Tally(lambda k: (k >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(k), np.int64))
        for s in T.slices(batches):
            yield from tally.add(tokens(s.column(0))[0])
        yield tally.close()

    def save_words(batches):
        for shard, held in _by_shard(batches):
            keys, n = _merged(held)
            _save(folder, f"vocab-{shard}.hash", keys.astype("<u8"))
            _save(folder, f"vocab-{shard}.count", n.astype("<u8"))
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "words": pa.array([len(keys)]),
                                              "tokens": pa.array([int(n.sum())])})

    rows = _dealt(texts.mapInArrow(count_words, "shard int, run binary"), shards).mapInArrow(
        save_words, "shard int, words long, tokens long")
    sizes = np.zeros(shards, np.int64)
    total = 0
    for shard, words, n in rows.collect():          # one row per shard
        sizes[shard] = words
        total += n
    base = np.cumsum(sizes) - sizes
    vocabulary = int(sizes.sum())
    if vocabulary >= int(START):
        raise ValueError("more than 2**32 - 1 different words")
    least = total // (HEAVY_SHARE * shards) + 1

    def frequent(kind, base):
        """Ids of the words or grams above the share: at most HEAVY_SHARE * shards."""
        def run(batches):
            for b in batches:
                for shard in b.column(0).to_pylist():
                    name = f"{kind[0]}-{shard}.{kind[1]}"
                    at = np.flatnonzero((_counts(folder, name) if kind[1] == "raw" else _mapped(folder, name, "<u8")) > least)
                    yield pa.RecordBatch.from_pydict({"id": pa.array(at + base[shard], pa.int64())})
        return [r[0] for r in spark.range(shards).mapInArrow(run, "id long").collect()]

    model = Model(folder, bits, base, total, vocabulary)

    def save_contexts(n, shard, keys, counts, heavy):
        """Save the contexts' totals; rows of what is summed over all shards."""
        ctx = keys >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([len(ctx) > 0], ctx[1:] != ctx[:-1])))
        if len(first) == 0:
            return [[*_four(counts), 0]]
        stats = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (counts, counts == 1, counts == 2, counts >= 3)], 1)
        ids = ctx[first]
        spread = np.isin(ids, heavy)
        kept = ~spread & (np.diff(first, append=len(ctx)) > SHORT)
        _save(folder, f"context{n}-{shard}.id", ids[kept].astype("<u4"))
        _save(folder, f"context{n}-{shard}.stats", stats[kept].astype("<u8"))
        return [[*_four(counts), len(keys)]] + [[int(i), *map(int, s)] for i, s in zip(ids[spread], stats[spread])]

    def rows_of(shard, out, extra):
        """Record batch of packed runs and of the rows of save_contexts."""
        k = out.num_rows
        return pa.RecordBatch.from_arrays(
            [pa.array(["cont"] * k + ["four"] * (len(extra) > 0) + ["heavy"] * (len(extra) - 1), pa.string()),
             pa.array(out.column(0).to_pylist() + [shard] * len(extra), pa.int32()),
             pa.array(out.column(1).to_pylist() + [None] * len(extra), pa.binary()),
             pa.array([None] * k + extra, pa.list_(pa.int64()))], names=["kind", "shard", "run", "n"])

    schema = "kind string, shard int, run binary, n array<long>"
    sums = [F.sum(F.get("n", F.lit(i))) for i in range(5)]
    none = runs(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def finish(n, out):
        """Discounts and spread contexts of a level; the number of its grams."""
        four = out.filter("kind = 'four'").agg(*sums).first()
        level = model.levels[n]
        place = {int(h): i for i, h in enumerate(level.heavy)}
        for r in out.filter("kind = 'heavy'").groupBy(F.get("n", F.lit(0)).alias("id")).agg(*sums[1:]).collect():
            level.heavy_stats[place[r[0]]] = r[1:]          # at most len(heavy) rows
        level.top = discounts([int(x or 0) for x in four[:4]])
        return int(four[4] or 0)

    def count_grams(n, heavy):
        def run(batches):
            tally = _Tally(lambda k: gram_shard(k, heavy, bits))
            for s in T.slices(batches):
                h, bounds = tokens(s.column(0))
                ids = model.words(h, ids_only=True)
                before = model.context_ids(n, ids, bounds[:-1])
                at = np.flatnonzero(before >= 0)
                yield from tally.add(gram_keys(before[at], ids[at]))
            yield tally.close()
        return run

    def save_grams(n, heavy):
        def run(batches):
            for shard, held in _by_shard(batches):
                keys, c = _merged(held)
                _save(folder, f"gram{n}-{shard}.key", keys.astype("<u8"))
                _save_counts(folder, f"gram{n}-{shard}.{'count' if n == order else 'raw'}", c)
                word = keys & np.uint64(0xFFFFFFFF)
                if n == 2:
                    word, types = np.unique(word, return_counts=True)
                    out = runs(np.searchsorted(base, word.astype(np.int64), "right") - 1, word, types)
                else:
                    ctx, back = np.unique(keys >> np.uint64(32), return_inverse=True)
                    ends = gram_keys(model.suffixes(n - 1, ctx.astype(np.int64))[back], word)
                    if n < order:
                        _save(folder, f"gram{n}-{shard}.suffix", model.grams(n - 1, ends).astype("<u4"))
                    ends, types = np.unique(ends, return_counts=True)
                    out = runs(gram_shard(ends, model.levels[n - 1].heavy, bits), ends, types)
                extra = save_contexts(n, shard, keys, c, heavy) if n == order else [[0, 0, 0, 0, len(keys)]]
                yield rows_of(shard, out, extra)
        return run

    def adjust(n, heavy):
        def run(batches):
            for shard, held in _by_shard(batches):
                keys = np.array(_mapped(folder, f"gram{n}-{shard}.key", "<u8"))
                c = _counts(folder, f"gram{n}-{shard}.raw")
                ends, types = _merged(held)
                c[np.searchsorted(keys, ends)] = types
                _save_counts(folder, f"gram{n}-{shard}.count", c)
                yield rows_of(shard, none, save_contexts(n, shard, keys, c, heavy))
        return run

    heavy = np.sort(np.array(frequent(("vocab", "count"), base) + [int(START)], np.uint64))
    for n in range(2, order + 1):
        if n > 2:
            heavy = np.sort(np.array(frequent((f"gram{n - 1}", "raw"), model.levels[n - 1].base), np.uint64))
        rows = _dealt(texts.mapInArrow(count_grams(n, heavy), "shard int, run binary"), shards)
        level = written_lean(spark, rows.mapInArrow(save_grams(n, heavy), schema), "lm")
        gram_sizes = np.zeros(shards, np.int64)
        for shard, size in level.filter("kind = 'four'").select("shard", F.get("n", F.lit(4))).collect():    # one row per shard
            gram_sizes[shard] = size
        if n < order and gram_sizes.sum() >= int(START):
            raise ValueError(f"more than 2**32 - 1 different grams of {n} words")
        model.levels[n] = Level(heavy, np.zeros((len(heavy), 4), np.int64), np.cumsum(gram_sizes) - gram_sizes)
        if n == 2:
            out, model.types = level, int(gram_sizes.sum())
        else:
            blank = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(
                pack(np.zeros(0, np.uint64), np.zeros(0, np.int64))).alias("run"))
            ends = _dealt(level.filter("kind = 'cont'").select("shard", "run").unionByName(blank), shards)
            adjusted = written_lean(spark, ends.mapInArrow(adjust(n - 1, model.levels[n - 1].heavy), schema), "lm")
            finish(n - 1, adjusted)
            discard(adjusted)
            for shard in range(shards):         # read for the last time
                for end in ("", ".at", ".big"):
                    os.remove(f"{folder}/gram{n - 1}-{shard}.raw{end}")
        if n == order:
            finish(n, level)
        if n > 2:
            discard(level)

    def save_continuations(batches):
        for shard, held in _by_shard(batches):
            keys, n = _merged(held)
            cont = np.zeros(sizes[shard], "<u4")
            cont[keys.astype(np.int64) - base[shard]] = n
            _save(folder, f"vocab-{shard}.cont", cont)
            yield pa.RecordBatch.from_pydict({"n": pa.array([_four(cont)], pa.list_(pa.int64()))})

    conts = _dealt(out.filter("kind = 'cont'").select("shard", "run"), shards).mapInArrow(save_continuations, "n array<long>")
    ones = written_lean(spark, conts, "lm").agg(*sums[:4]).first()
    discard(out)
    model.low = discounts([int(x or 0) for x in ones])
    if model.types:
        n1, n2 = int(ones[0] or 0), int(ones[1] or 0)
        model.low_back = float(np.dot(model.low, (n1, n2, vocabulary - n1 - n2))) / model.types
    return model


def score(docs: DataFrame, model: Model, extra: list[Column] = ()) -> DataFrame:
    """(doc_id, *extra, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *extra, "text")
    kept = rows.columns[:-1]

    def run(batches):
        m = shared.value
        for s in T.slices(batches):
            h, bounds = tokens(s.column(len(kept)))
            count, logp = m.score(h, bounds[:-1])
            base = np.log10((count + 1) / (m.tokens + m.vocabulary + 1))
            yield pa.RecordBatch.from_arrays(
                [*(s.column(i) for i in range(len(kept))), pa.array(np.diff(bounds)),
                 pa.array(np.add.reduceat((count > 0).astype(np.int64), bounds[:-1])),
                 pa.array(np.full(s.num_rows, m.tokens)), pa.array(np.add.reduceat(base, bounds[:-1])),
                 pa.array(np.add.reduceat(logp, bounds[:-1]))],
                names=[*kept, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    fields = ", ".join(f"{n} {t}" for n, t in rows.drop("text").dtypes)
    return rows.mapInArrow(run, f"{fields}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(docs: DataFrame, held_out: Column, order: int = 2) -> DataFrame:
    """Scores of all texts by a model that learns from those not held out."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lm-model")
    with shuffles_dropped(spark):
        model = train(docs.filter(~held_out), path, order)
    return score(docs, model, [held_out.alias("held_out")])
