"""Repeated byte strings across documents by a distributed, prefix-aware merge sort of suffixes.

Goal: remove each byte covered by a string of ``width`` bytes that also starts
in a document with a smaller doc_id.

Sparse suffixes.  Every string of ``width`` bytes holds 31 grams of 20 bytes;
the gram with the least hash is its anchor, and equal strings have equal
anchors at equal places.  So only suffixes that start at anchors (about one
byte in sixteen) are sorted, each with the bytes to its left.

1. Distinguishing prefixes: sorted, delta-coded runs of gram hashes are merged
   by shard; an anchor whose gram occurs in one place only cannot repeat and
   leaves the job here.
2. Each task sorts the remaining suffixes of its documents (equal contexts
   collapse to the smallest doc_id; the other documents of the task are
   answered on the spot) and sends the sorted run, front-coded and cut at
   common splitters.
3. A shard merges its runs with loser trees (``lcp_merge``).  The prefixes that
   neighbours share give, for every length, the class of suffixes equal to it;
   with the classes of the left contexts this tells, for every place of the
   anchor in a string, the smallest document holding that string.
4. Covered intervals return to their documents, are merged and cut out.

A context occurs once per run however many documents hold it, and nothing is
ever paired.  Gram hashes only select candidates; equality is decided on bytes.

Step 1 keeps its sorted arrays in a shared folder that workers memory-map (a
``file:`` path).

Defined results: null and empty texts have no bytes; texts shorter than
``width`` lose nothing; rows with a null doc_id neither lose bytes nor cause
losses; rows that share a doc_id do not cause losses among themselves; repeated
rows are each returned; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from eventide.llm import lcp_merge as L, text as T
from eventide.llm.components import written
from eventide.llm.ngram_lm import _by_shard, _dealt, _mapped, _merged, _save, local_path, runs as packed_runs, summed
from eventide.session import scratch_path

WIDTH = 50
GRAM = 20
PLACES = WIDTH - GRAM + 1       # places of the anchor in a string
LEFT = PLACES - 1               # bytes kept to the left of an anchor
HASH_BITS = 40                  # of a gram's hash, enough to select candidates
RUN_ROWS = 400_000              # suffixes of a sorted run
SPLITTER_ROWS = 50_000          # bound of the sample of suffixes that sets the splitters
SMALL_IDS = 2_000_000


def _words(buf: np.ndarray, at=None) -> np.ndarray:
    """The eight bytes from every place on, as one number (zeros beyond the end)."""
    data = np.concatenate((buf, np.zeros(8, np.uint8)))
    view = np.ndarray((len(buf),), ">u8", data, strides=(1,))
    return (view if at is None else view[at]).astype(np.uint64)


def anchors(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of all anchors of a slice."""
    n = len(buf)
    if n < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    w = _words(buf)
    m = T.multipliers(3)
    g = n - GRAM + 1
    h = T.mix(w[:g] * m[0] + T.mix(w[8: g + 8] * m[1] + w[12: g + 12] * m[2]))
    del w
    least = h
    for step in (1, 2, 4, 8, 15):       # minimum over 2, 4, 8, 16, 31 grams
        least = np.minimum(least[:-step], least[step:])
    # least[s]: minimum of the string starting at s, for s <= n - WIDTH
    room = np.repeat(offs[1:], np.diff(offs))[: n - WIDTH + 1]
    least[np.arange(n - WIDTH + 1) + WIDTH > room] = 0
    best = np.concatenate((np.zeros(LEFT, np.uint64), least, np.zeros(LEFT, np.uint64)))
    for step in (1, 2, 4, 8, 15):       # the largest of the 31 minima that a gram takes part in
        best = np.maximum(best[:-step], best[step:])
    at = np.flatnonzero((best[:g] == h) & (h > 0))
    return at, h[at]


def _repeated(docs: DataFrame, folder: str, bits: int) -> None:
    """Write, by shard, the sorted hashes of grams that anchor in more than one document."""
    shards = 1 << bits

    def shard_of(k):
        return (k >> np.uint64(HASH_BITS - bits)).astype(np.int64) if bits else np.zeros(len(k), np.int64)

    def count(batches):
        keys, counts, held = [], [], 0
        for s in T.slices(batches):
            buf, offs = T.as_bytes(s.column(1))
            at, h = anchors(buf, offs)
            h >>= np.uint64(64 - HASH_BITS)
            row = np.searchsorted(offs, at, "right")
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            k, n = np.unique(h[new], return_counts=True)
            keys.append(k)
            counts.append(np.minimum(n, 2))
            held += len(k)
            if held > 4_000_000:
                k, n = summed(np.concatenate(keys), np.concatenate(counts))
                yield packed_runs(shard_of(k), k, np.minimum(n, 2))
                keys, counts, held = [], [], 0
        if keys:
            k, n = summed(np.concatenate(keys), np.concatenate(counts))
            yield packed_runs(shard_of(k), k, np.minimum(n, 2))

    def save(batches):
        for shard, held in _by_shard(batches):
            k, n = _merged(held)
            _save(folder, f"gram-{shard}.hash", k[n > 1].astype("<u8"))
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "grams": pa.array([int((n > 1).sum())])})

    _dealt(docs.mapInArrow(count, "shard int, run binary"), shards).mapInArrow(
        save, "shard int, grams long").agg(F.sum("grams")).collect()


def _select(h: np.ndarray, folder: str, bits: int) -> np.ndarray:
    """Which gram hashes are repeated."""
    k = h >> np.uint64(64 - HASH_BITS)
    order = np.argsort(k)
    sorted_k = k[order]
    keep = np.zeros(len(h), bool)
    shard = (sorted_k >> np.uint64(HASH_BITS - bits)).astype(np.int64) if bits else np.zeros(len(k), np.int64)
    used, first = np.unique(shard, return_index=True)
    for s, a, b in zip(used.tolist(), first, [*first[1:], len(k)]):
        have = _mapped(folder, f"gram-{s}.hash", "<u8")
        if len(have):
            place = np.minimum(np.searchsorted(have, sorted_k[a:b]), len(have) - 1)
            keep[order[a:b]] = have[place] == sorted_k[a:b]
    return keep


class _Run:
    """The suffixes of a task's documents: contexts, documents and places."""

    def __init__(self):
        self.rows, self.docs, self.places, self.keys, self.held = [], [], [], [], 0

    def add(self, buf, offs, at, doc_id, key):
        row = np.searchsorted(offs, at, "right") - 1
        begin, end = offs[row], offs[row + 1]
        padded = np.concatenate((np.zeros(LEFT, np.uint8), buf, np.zeros(WIDTH, np.uint8)))
        around = np.lib.stride_tricks.sliding_window_view(padded, LEFT + WIDTH)[at]
        ahead, behind = np.minimum(end - at, WIDTH), np.minimum(at - begin, LEFT)
        rows = np.zeros((len(at), WIDTH + LEFT + 2), np.uint8)
        rows[:, :WIDTH] = np.where(np.arange(WIDTH) < ahead[:, None], around[:, LEFT:], 0)
        rows[:, WIDTH: WIDTH + LEFT] = np.where(np.arange(LEFT) < behind[:, None], around[:, LEFT - 1:: -1][:, :LEFT], 0)
        rows[:, WIDTH + LEFT], rows[:, WIDTH + LEFT + 1] = ahead, behind
        self.rows.append(rows)
        self.docs.append(doc_id[row])
        self.keys.append(key[row])
        self.places.append(at - begin)
        self.held += len(at)

    def close(self, splitters):
        """(shard, run) rows of the sorted run, and the intervals that are settled inside it."""
        rows, docs, keys, places = (np.concatenate(x) for x in (self.rows, self.docs, self.keys, self.places))
        self.__init__()
        order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
        rows, docs, keys, places = rows[order], docs[order], keys[order], places[order]
        new = np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))
        of = np.cumsum(new) - 1
        least = np.minimum.reduceat(docs, np.flatnonzero(new))
        later = docs > least[of]
        full = _intervals(places[later], np.minimum(rows[later, WIDTH + LEFT + 1], LEFT).astype(np.int64),
                          WIDTH - rows[later, WIDTH + LEFT].astype(np.int64))
        settled = (docs[later], keys[later], *full)
        rows = rows[new]
        first = ~later
        occ, o_doc, o_key, o_place = of[first], least[of[first]], keys[first], places[first]
        head = _words(np.ascontiguousarray(rows).ravel(), np.arange(len(rows)) * rows.shape[1])
        shard = np.searchsorted(splitters, head, "right")
        used, begins = np.unique(shard, return_index=True)
        out = []
        for s, a, b in zip(used.tolist(), begins.tolist(), [*begins[1:].tolist(), len(rows)]):
            x, y = np.searchsorted(occ, (a, b))
            out.append((s, _encode_run(rows[a:b], occ[x:y] - a, o_doc[x:y], o_key[x:y], o_place[x:y])))
        return out, settled


def _intervals(place, most, least):
    """Covered intervals of anchors whose strings match for places ``least`` to ``most`` of the anchor; empty: 0, 0."""
    ok = least <= most
    return np.where(ok, place - most, 0), np.where(ok, place - least + WIDTH, 0)


def _encode_run(rows, occ, doc, key, place) -> bytes:
    suffix = np.ascontiguousarray(rows[:, :WIDTH])
    lengths, tails = L.front_code(suffix, L.shared_prefixes(suffix))
    parts = [lengths, tails, rows[:, WIDTH:].tobytes(), np.bincount(occ, minlength=len(rows)).astype("<u4").tobytes(),
             doc.astype("<i8").tobytes(), key.astype("<i8").tobytes(), place.astype("<i8").tobytes()]
    sizes = np.array([len(p) for p in parts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(parts))


def _decode_run(block: bytes):
    raw = zstandard.ZstdDecompressor().decompress(block)
    sizes = np.frombuffer(raw[:56], "<i8")
    cuts = 56 + np.concatenate(([0], np.cumsum(sizes)))
    lengths, tails, rest, times, doc, key, place = (raw[a:b] for a, b in zip(cuts, cuts[1:]))
    suffix, lcp = L.from_front_code(lengths, tails, WIDTH)
    return (suffix, lcp, np.frombuffer(rest, np.uint8).reshape(len(suffix), -1), np.frombuffer(times, "<u4").astype(np.int64),
            np.frombuffer(doc, "<i8"), np.frombuffer(key, "<i8"), np.frombuffer(place, "<i8"))


def _settle(blocks):
    """Intervals (doc, key, begin, end) found by merging the runs of a shard."""
    parts = [_decode_run(b) for b in blocks]
    order, shared = L.merge([(p[0], p[1]) for p in parts])
    rest, times = (np.concatenate([p[i] for p in parts]) for i in (2, 3))
    ends = np.cumsum(times)
    doc, key, place = (np.concatenate([p[i] for p in parts]) for i in (4, 5, 6))
    shared = np.append(shared, 0)
    shared[0] = 0
    alike = np.maximum(shared[:-1], shared[1:]) >= GRAM         # others start with another gram
    keep = np.flatnonzero(alike)
    if len(keep) == 0:
        return None
    h = np.where(np.concatenate(([False], keep[1:] == keep[:-1] + 1)), shared[keep], 0)
    rows = order[keep]
    rest, times, first = rest[rows], times[rows], ends[rows] - times[rows]
    ahead, behind = rest[:, LEFT].astype(np.int64), rest[:, LEFT + 1].astype(np.int64)
    least_doc = doc[first]
    left = np.ascontiguousarray(rest[:, :LEFT])
    by_left = np.argsort(left.view(f"S{LEFT}").ravel(), kind="stable")
    left_shared = L.shared_prefixes(left[by_left])
    n = len(rows)
    most, least = np.full(n, -1), np.full(n, PLACES)
    left_class = np.empty(n, np.int64)
    for o in range(PLACES):
        left_class[by_left] = np.cumsum(left_shared < o) if o else 0
        can = np.flatnonzero((ahead >= WIDTH - o) & (behind >= o))
        if len(can) == 0:
            continue
        pair = np.cumsum(h < WIDTH - o)[can] * (n + 1) + left_class[can]
        by = np.argsort(pair, kind="stable")
        p, d = pair[by], least_doc[can][by]
        starts = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        smallest = np.repeat(np.minimum.reduceat(d, starts), np.diff(np.append(starts, len(p))))
        hit = can[by[smallest < d]]
        most[hit] = np.maximum(most[hit], o)
        least[hit] = np.minimum(least[hit], o)
    hit = np.flatnonzero(most >= 0)
    if len(hit) == 0:
        return None
    t = times[hit]
    at = np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t) + np.repeat(first[hit], t)
    begin, end = _intervals(place[at], np.repeat(most[hit], t), np.repeat(least[hit], t))
    return doc[at], key[at], begin, end


_SPANS = "doc_id long, key long, begins binary, ends binary"


def _span_rows(doc, key, begin, end):
    """One row per document: its intervals, merged, as int64 arrays."""
    use = end > begin
    doc, key, begin, end = doc[use], key[use], begin[use], end[use]
    if len(doc) == 0:
        return None
    order = np.lexsort((begin, key, doc))
    doc, key, begin, end = doc[order], key[order], begin[order], end[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
    group = np.cumsum(new) - 1
    lift = group * (int(end.max()) + 1)                  # keeps documents apart in one running maximum
    reach = np.maximum.accumulate(end + lift)
    cut = np.concatenate(([True], (begin + lift)[1:] > reach[:-1])) | new
    at = np.flatnonzero(cut)
    last = np.append(at[1:], len(begin)) - 1
    b, e = begin[at], (reach - lift)[last]
    rows = np.flatnonzero(new)
    edge = np.append(np.searchsorted(at, rows), len(at))
    bb, eb = b.astype("<i8").tobytes(), e.astype("<i8").tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[rows]), pa.array(key[rows]),
         pa.array([bb[8 * x: 8 * y] for x, y in zip(edge, edge[1:])], pa.binary()),
         pa.array([eb[8 * x: 8 * y] for x, y in zip(edge, edge[1:])], pa.binary())], names=["doc_id", "key", "begins", "ends"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, begins, ends): covered byte intervals, several rows per document; key is xxhash64 of the text."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(0, (parts - 1).bit_length())
    folder = local_path(scratch_path(spark, "suffix-grams"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key")).filter(
        "doc_id is not null and text is not null")
    _repeated(rows, folder, bits)
    shards = 4 * parts

    def heads(batches):
        for s in T.slices(batches):
            buf, offs = T.as_bytes(s.column(0))
            at, _ = anchors(buf, offs)
            yield pa.RecordBatch.from_arrays([pa.array(_words(buf, at[::16]).view(np.int64))], names=["head"])

    share = min(1.0, 20_000 / max(1, docs.count()))
    sample = rows.select("text").sample(share, seed=3).mapInArrow(heads, "head long").limit(SPLITTER_ROWS).collect()
    sample = np.sort(np.array([r[0] for r in sample], np.int64).view(np.uint64))
    splitters = np.unique(sample[:: max(1, len(sample) // shards)][1:])

    def sort(batches):
        run = _Run()

        def emit():
            sent, settled = run.close(splitters)
            spans = _span_rows(*settled)
            n = len(sent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in sent], pa.int32()), pa.array([b for _, b in sent], pa.binary()),
                 *(pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=names)
            if spans is not None:
                n = spans.num_rows
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *spans.columns], names=names)

        names = ["shard", "run", "doc_id", "key", "begins", "ends"]
        for s in T.slices(batches):
            buf, offs = T.as_bytes(s.column(1))
            at, h = anchors(buf, offs)
            at = at[_select(h, folder, bits)]
            if len(at):
                run.add(buf, offs, at, s.column(0).to_numpy(zero_copy_only=False), s.column(2).to_numpy(zero_copy_only=False))
            if run.held >= RUN_ROWS:
                yield from emit()
        if run.held:
            yield from emit()

    sent = written(spark, rows.mapInArrow(sort, f"shard int, run binary, {_SPANS}"), "suffix-runs")

    def settle(batches):
        for _, blocks in _by_shard(batches):
            found = _settle(blocks)
            spans = _span_rows(*found) if found is not None else None
            if spans is not None:
                yield spans

    merged = _dealt(sent.filter("shard is not null").select("shard", "run"), shards).mapInArrow(settle, _SPANS)
    here = sent.filter("shard is null").select("doc_id", "key", "begins", "ends")
    return merged.unionByName(here)


def deduplicate(docs: DataFrame, texts: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document, and the kept bytes on demand."""
    spark = docs.sparkSession
    spans = written(spark, repeated_spans(docs), "suffix-spans")
    found = spans.groupBy("doc_id", "key").agg(F.collect_list("begins").alias("begins"), F.collect_list("ends").alias("ends"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))
    ids = written(spark, spans.select("doc_id").distinct(), "suffix-ids")
    small = ids.count() <= SMALL_IDS        # checked size: only documents with spans meet them; beyond it, all do
    touched = rows.join(F.broadcast(ids), "doc_id", "left_semi") if small else rows
    joined = touched.join(found, ["doc_id", "key"], "left").select("doc_id", "text", "begins", "ends")
    if small:
        joined = joined.unionByName(rows.join(F.broadcast(ids), "doc_id", "left_anti").select(
            "doc_id", "text", F.lit(None).cast("array<binary>").alias("begins"), F.lit(None).cast("array<binary>").alias("ends")))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")

    def cut(batches):
        for s in T.slices(batches):
            buf, offs = T.as_bytes(s.column(1))
            data = buf.tobytes()
            removed, n_spans, sha, kept = [], [], [], []
            for i, (b, e) in enumerate(zip(s.column(2).to_pylist(), s.column(3).to_pylist())):
                lo, hi = int(offs[i]), int(offs[i + 1])
                if not b:
                    removed.append(0)
                    n_spans.append(0)
                    rest = data[lo:hi]
                else:
                    mark = np.zeros(hi - lo + 1, np.int64)
                    np.add.at(mark, np.frombuffer(b"".join(b), "<i8"), 1)
                    np.add.at(mark, np.frombuffer(b"".join(e), "<i8"), -1)
                    gone = np.cumsum(mark[:-1]) > 0
                    removed.append(int(gone.sum()))
                    n_spans.append(int((gone & ~np.concatenate(([False], gone[:-1]))).sum()))
                    rest = buf[lo:hi][~gone].tobytes()
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            cols = [s.column(0), pa.array(np.diff(offs)), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha)]
            if texts:
                cols.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in schema.split(", ")])

    return joined.mapInArrow(cut, schema)
