"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian verification, exact confirmation.

1. Each text becomes its set of distinct k-word shingles (64-bit hashes); equal
   sets collapse to one node (the smallest doc_id), so copies cost nothing more.
2. Nodes sharing a band of their signature are candidates.  The number of bands
   follows from the threshold and the chosen miss probability.
3. A candidate pair's signatures are compared batch by batch; after each batch
   the pair is dropped when the posterior probability (uniform prior) that its
   similarity reaches the threshold is below the miss probability.
4. Survivors are confirmed on the full shingle sets, and links are closed into
   components.

A bucket never expands into all pairs.  First every member is compared with
the bucket's least node only.  A second pass compares members that ended in
another component than that node with the bucket's members of other components,
in blocks of bounded size; pairs left out by it lie in one component already,
so the components are those of all candidate pairs.

Defined results: null, empty or wordless texts have an empty set and are linked
with nothing; fewer than k words are one shingle; rows with a null doc_id are
returned unlinked (component null, kept); rows that share a doc_id are one
node, linked with all that any of their texts is linked with (an empty text adds
no link); repeated rows are each returned; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm import text as T
from eventide.llm.components import components, written

BAND_ROWS = 4
MISS = 1e-5             # chance that a pair at the threshold shares no band; bound of the Bayesian pruning
BATCH = 16              # signature values compared between two posterior checks
BLOCK = 512             # members of a bucket compared in one step
SMALL_IDS = 2_000_000   # ids whose table may be broadcast (16 MB); beyond it the join shuffles


def bands_for(threshold: float, miss: float = MISS, rows: int = BAND_ROWS) -> int:
    return max(1, math.ceil(math.log(miss) / math.log1p(-threshold ** rows)))


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest matches among n values that keep P(similarity >= threshold | matches) at or above miss."""
    tail = 0.0
    for m in range(n + 1):      # P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m)
        tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


def stages(n_hashes: int, threshold: float, miss: float) -> list[tuple[int, int, int]]:
    """(from, to, fewest matches so far) of each batch of signature values."""
    cuts = [*range(0, n_hashes, BATCH), n_hashes]
    return [(a, b, least_matches(b, threshold, miss)) for a, b in zip(cuts, cuts[1:])]


def shingle_sets(buf, offs, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, end to end, and the n + 1 bounds of the rows."""
    w = T.Words(buf, offs, lower=True)
    h, counts = w.hashes(), w.counts
    wide, at = T.windows(h, w.row_start, k)
    rows = np.searchsorted(w.row_start, at, side="right") - 1
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        one = np.zeros(len(short), np.uint64)
        for j, m in enumerate(T.multipliers(k)[: k - 1]):
            has = counts[short] > j
            one[has] += h[w.row_start[short[has]] + j] * m
        one = T.mix(one + counts[short].astype(np.uint64) * T.multipliers(k + 1)[k])
        where = np.searchsorted(rows, short)
        wide, rows = np.insert(wide, where, one), np.insert(rows, where, short)
    bound = np.searchsorted(rows, np.arange(len(offs)))
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist()):
        if b - a > 1:
            wide[a:b].sort()
    new = np.ones(len(wide), bool)
    new[1:] = (wide[1:] != wide[:-1]) | (rows[1:] != rows[:-1])
    return wide[new], np.searchsorted(rows[new], np.arange(len(offs)))


def signatures(h: np.ndarray, bound: np.ndarray, n_hashes: int) -> np.ndarray:
    """MinHash signatures (rows x n_hashes, 32 bits) of non-empty sets; empty sets get zeros."""
    rows = len(bound) - 1
    out = np.zeros((rows, n_hashes), np.uint32)
    full = np.flatnonzero(bound[1:] > bound[:-1])
    if len(full):
        first = bound[:-1][full]
        seeds = T.mix(T.multipliers(n_hashes + 64)[64:]) | np.uint64(1)
        for j in range(n_hashes):
            out[full, j] = np.minimum.reduceat((h * seeds[j]) >> np.uint64(32), first).astype(np.uint32)
    return out


def _signed(docs: DataFrame, k: int, n_hashes: int) -> DataFrame:
    def run(batches):
        for s in T.slices(batches, limit=T.LEAN_BYTES):
            buf, offs = T.as_bytes(s.column(1))
            h, bound = shingle_sets(buf, offs, k)
            n = np.diff(bound)
            total = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(T.mix(h ^ x)))) for x in T.multipliers(2)]
            c1, c2 = ((t[bound[1:]] - t[bound[:-1]]).view(np.int64) for t in total)
            sig = signatures(h, bound, n_hashes)
            yield pa.RecordBatch.from_arrays(
                [s.column(0), pa.array(n.astype(np.int64)), pa.array(c1), pa.array(c2),
                 pa.array([x.tobytes() for x in sig], pa.binary())],
                names=["doc_id", "n_shingles", "c1", "c2", "sig"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, c1 long, c2 long, sig binary")


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    bands = sig.shape[1] // BAND_ROWS
    rows = sig.reshape(len(sig), bands, BAND_ROWS).astype(np.uint64)
    seed = T.multipliers(bands + BAND_ROWS)
    key = np.zeros((len(sig), bands), np.uint64)
    for j in range(BAND_ROWS):
        key = T.mix(key + rows[:, :, j] * seed[bands + j] + seed[:bands])
    return key.view(np.int64)


def _banded(nodes: DataFrame, bands: int) -> DataFrame:
    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            node = b.column(0).to_numpy(zero_copy_only=False)
            buf, _ = T.as_bytes(b.column(1))
            key = band_keys(buf.view(np.uint32).reshape(len(node), -1))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(node, bands))],
                                             names=["key", "node"])
    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def _likely(pairs: DataFrame, nodes: DataFrame, checks) -> DataFrame:
    """Pairs (a, b) that the sequential comparison of their signatures does not prune."""
    both = (pairs.join(nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb"))
    width = checks[-1][1]

    def run(batches):
        for r in batches:
            if r.num_rows == 0:
                continue
            x, y = (T.as_bytes(r.column(i))[0].view(np.uint32).reshape(-1, width) for i in (2, 3))
            live, found = np.arange(r.num_rows), np.zeros(r.num_rows, np.int64)
            for lo, hi, least in checks:
                found[live] += (x[live, lo:hi] == y[live, lo:hi]).sum(axis=1)
                live = live[found[live] >= least]
            yield r.select([0, 1]).take(pa.array(live))
    return both.mapInArrow(run, "a long, b long").distinct()


def _sets(docs: DataFrame, ids: DataFrame, k: int, width: type = np.uint64) -> DataFrame:
    """(doc_id, shingles) of the documents in ids: sorted distinct hashes, the top bits of each as ``width``."""
    spark = docs.sparkSession
    ids = written(spark, ids.distinct(), "near-ids")
    ids = F.broadcast(ids) if ids.count() <= SMALL_IDS else ids     # checked size; shuffled beyond it
    drop = np.uint64(64 - 8 * np.dtype(width).itemsize)

    def sets(batches):
        size = np.dtype(width).itemsize
        for s in T.slices(batches, limit=T.LEAN_BYTES):
            buf, offs = T.as_bytes(s.column(1))
            h, bound = shingle_sets(buf, offs, k)
            data = (h >> drop).astype(width).tobytes()
            yield pa.RecordBatch.from_arrays(
                [s.column(0), pa.array([data[size * a: size * b] for a, b in zip(bound[:-1], bound[1:])], pa.binary())],
                names=["doc_id", "shingles"])

    full = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
            .mapInArrow(sets, "doc_id long, shingles binary"))
    return written(spark, full, "near-sets")


def _confirmed(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity.  pairs: written."""
    full = _sets(docs, pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))), k)
    both = (pairs.join(full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches):
        for r in batches:
            (x, xo), (y, yo) = (T.as_bytes(r.column(i)) for i in (2, 3))
            x, y, xo, yo = x.view(np.uint64), y.view(np.uint64), (xo // 8).tolist(), (yo // 8).tolist()
            keep = []
            for i in range(r.num_rows):
                p, q = x[xo[i]: xo[i + 1]], y[yo[i]: yo[i + 1]]
                if len(p) > len(q):
                    p, q = q, p
                if len(p) == 0 or 100 * len(p) < percent * len(q):
                    continue
                common = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                if 100 * common >= percent * (len(p) + len(q) - common):
                    keep.append(i)
            yield r.select([0, 1]).take(pa.array(keep, pa.int64()))
    return both.mapInArrow(run, "a long, b long").distinct()


def _second_pairs(docs: DataFrame, buckets: DataFrame, comps: DataFrame, nodes: DataFrame, checks, k: int,
                  percent: int) -> DataFrame:
    """Pairs of different components inside a bucket that the first pass did not compare and no test prunes.

    A block's members meet the bucket's pivots in one task: a pair is tested in the first
    band it shares only, by its signatures and then by 32-bit shingle sets (with one
    percent of slack for chance matches), so that few pairs ever leave the task.
    """
    at = buckets.join(comps, "node", "left").select("key", "node", "hub", F.coalesce("component", "node").alias("comp"))
    hub = comps.select(F.col("node").alias("hub"), F.col("component").alias("hub_comp"))
    at = at.join(hub, "hub", "left").withColumn("hub_comp", F.coalesce("hub_comp", "hub"))
    rest = F.col("comp") != F.col("hub_comp")
    active = (at.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(rest, 1)).alias("m")).filter("m > 0")
              .select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"), F.ceil(F.col("m") / BLOCK).alias("parts")))
    rows = written(docs.sparkSession, at.join(active, "key").select(
        "key", "node", "comp", "blocks", "parts", rest.alias("pivot")), "near-active")
    sets = _sets(docs, rows.select(F.col("node").alias("doc_id")), k, np.uint32)
    rows = rows.join(nodes.select("node", "sig"), "node").join(sets.withColumnRenamed("doc_id", "node"), "node")
    spot = F.xxhash64("node")
    members = rows.withColumn("blk", F.pmod(spot, F.col("blocks"))).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("pivot", F.lit(False))
    pivots = rows.filter("pivot").withColumn("part", F.pmod(spot, F.col("parts"))).withColumn(
        "blk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cols = ["key", "blk", "part", "pivot", "node", "comp", "sig", "shingles"]
    both = members.select(cols).unionByName(pivots.select(cols))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(n, "key", "blk", "part").sortWithinPartitions("key", "blk", "part", "pivot")
    width = checks[-1][1]

    def pairs(key, group):
        node, comp, pivot, sig, sizes, data = (np.concatenate(c) for c in zip(*group))
        ends = np.cumsum(sizes)
        m = np.flatnonzero(~pivot)
        bands = sig.reshape(len(sig), -1, BAND_ROWS)
        keys = band_keys(sig)
        a, b = [], []
        for p in np.flatnonzero(pivot):
            live = m[comp[m] != comp[p]]
            found = np.zeros(len(node), np.int64)
            for lo, hi, least in checks:
                found[live] += (sig[live, lo:hi] == sig[p, lo:hi]).sum(axis=1)
                live = live[found[live] >= least]
            live = live[100 * np.minimum(sizes[live], sizes[p]) >= percent * np.maximum(sizes[live], sizes[p])]
            if len(live) == 0:
                continue
            shared = (bands[live] == bands[p]).all(axis=2).argmax(axis=1)
            live = live[keys[p, shared] == key]
            if len(live) == 0:
                continue
            own = data[ends[p] - sizes[p]: ends[p]]
            size = sizes[live]
            first = np.cumsum(size) - size
            other = data[np.arange(int(size.sum())) + np.repeat(ends[live] - size - first, size)]
            same = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            common = np.add.reduceat(same.astype(np.int64), first)
            live = live[100 * common >= (percent - 1) * (size + sizes[p] - common)]
            a.append(np.minimum(node[live], node[p]))
            b.append(np.maximum(node[live], node[p]))
        return a, b

    def run(batches):
        held, held_key = [], None

        def flush():
            a, b = pairs(held_key[0], held) if held else ([], [])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for r in batches:
            if r.num_rows == 0:
                continue
            key = np.stack([r.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            pivot = r.column(3).to_numpy(zero_copy_only=False).astype(bool)
            node, comp = (r.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            sig = T.as_bytes(r.column(6))[0].view(np.uint32).reshape(-1, width)
            data, offs = T.as_bytes(r.column(7))
            data, offs = data.view(np.uint32), offs // 4
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(key)]):
                here = tuple(key[lo].tolist())
                if here != held_key:
                    yield from flush()
                    held, held_key = [], here
                held.append((node[lo:hi], comp[lo:hi], pivot[lo:hi], sig[lo:hi], np.diff(offs[lo: hi + 1]),
                             data[offs[lo]: offs[hi]].copy()))
        yield from flush()
    return both.mapInArrow(run, "a long, b long").distinct()


def _same_id(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) of an id whose rows differ with the nodes of all its sets."""
    by_id = signed.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.struct("c1", "c2")).alias("low"), F.max(F.struct("c1", "c2")).alias("high")).filter("low != high")
    own = signed.filter("n_shingles > 0").join(by_id.select("doc_id"), "doc_id").select("doc_id", "c1", "c2").distinct()
    return own.join(classes.select("c1", "c2", "node"), ["c1", "c2"]).select(
        F.col("doc_id").alias("a"), F.col("node").alias("b")).filter("a != b")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document; similarity bound in percent, inclusive."""
    spark = docs.sparkSession
    t = percent / 100
    bands = bands_for(t, miss)
    n_hashes = bands * BAND_ROWS
    checks = stages(n_hashes, t, miss)
    signed = written(spark, _signed(docs, k, n_hashes), "near-signed")
    classes = written(spark, signed.filter("n_shingles > 0 and doc_id is not null").groupBy("c1", "c2").agg(
        F.min("doc_id").alias("node"), F.first("sig").alias("sig")), "near-nodes")
    nodes = classes.select("node", "sig")
    banded = written(spark, _banded(nodes, bands), "near-bands")
    full = banded.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub != last")
    buckets = written(spark, banded.join(full.select("key", "hub"), "key").select("key", "node", "hub"), "near-buckets")
    stars = buckets.filter("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    first = written(spark, _likely(stars, nodes, checks), "near-first")
    links = written(spark, _confirmed(docs, first, k, percent).unionByName(_same_id(signed, classes)), "near-links")
    comps = components(spark, links)
    more = written(spark, _second_pairs(docs, buckets, comps, nodes, checks, k, percent), "near-second")
    if not more.isEmpty():
        found = written(spark, _confirmed(docs, more, k, percent), "near-links")
        if not found.isEmpty():
            comps = components(spark, links.unionByName(found))
    member = classes.select("c1", "c2", "node").join(comps, "node", "left").select(
        "c1", "c2", F.coalesce("component", "node").alias("component_id"))
    # an empty text follows its id's other texts
    blank = (signed.filter("n_shingles = 0 and doc_id is not null").select("doc_id").distinct()
             .join(comps.select(F.col("node").alias("doc_id"), F.col("component").alias("own")), "doc_id")
             .select(F.col("doc_id").alias("blank"), "own"))
    return (signed.select("doc_id", "n_shingles", "c1", "c2").join(member, ["c1", "c2"], "left")
            .join(blank, F.expr("doc_id = blank and n_shingles = 0"), "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "own", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def kept_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs without the near copies of another document, unchanged."""
    gone = near_duplicates(docs, **options).filter("not kept").select("doc_id").distinct()
    gone = written(docs.sparkSession, gone, "near-gone")
    gone = F.broadcast(gone) if gone.count() <= SMALL_IDS else gone     # checked size; shuffled beyond it
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
