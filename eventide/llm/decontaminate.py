"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over consecutive tokens that ignores some positions.
Every masked window of every benchmark item is hashed; every masked window of
every document is hashed and looked up.  The two masks together hit every
13-token window that differs in at most two tokens from an item (checked over
all pairs of positions in the tests).  Around each hit the item is laid over
the document and an overlap is confirmed when some 13 consecutive positions
hold at most two differences; shorter items must overlap whole, with one
difference allowed from eight tokens on.  Items of fewer than four tokens are
too short to tell contamination and match nothing.

Tokens are runs of ASCII letters and digits and non-ASCII characters, A-Z
lowered.  Seeds of both sides are joined by their hash.  Before that join a
Bloom filter over the benchmark's seeds, of a fixed greatest size, drops the
documents' seeds that meet none; a benchmark that fills it costs a larger join,
never a result.  Documents are read once, whatever the benchmark's size (twice
by ``clean``).  Equal texts are searched once.  A seed that very many texts hold
is cut into pieces, joined in different tasks.  Hits become distinct shifts of
an item against a text inside Spark's aggregation, which spills, so a very
repetitive text costs as many shifts as its and the item's tokens; a task lays
one item over the stretch of one text that its shifts span.

Defined results: null and empty texts have no tokens and are clean; every row
is reported, so repeated rows and null ids are; an empty benchmark leaves all
documents clean; an item's repeated rows are each reported; other columns, of
any name, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm import text as T
from eventide.llm.components import written

MASKS = ((0, 2, 3, 5, 7, 8), (0, 1, 2, 5, 6, 7))
WINDOW = 13
SUBSTITUTIONS = 2
LEAST_TOKENS = 4
FILTER_BITS = 1 << 27       # greatest size of the seed filter (16 MB)
BITS_PER_SEED, PROBES = 512, 4
PIECE_ROWS = 1 << 17        # rows of one seed that are joined in one piece

_LOW = np.uint64((1 << 32) - 1)
_SPLIT = np.ones(256, bool)
_SPLIT[48:58] = _SPLIT[65:91] = _SPLIT[97:123] = False
_SPLIT[128:] = False


class _Tokens(T.Words):
    """Tokens of a slice: alphanumeric and non-ASCII runs."""
    separators = _SPLIT


def _tokens(col):
    buf, offs = T.as_bytes(col)
    w = _Tokens(buf, offs, lower=True)
    return w.hashes(), w.row_start


def _need(n: int) -> tuple[int, int]:
    """Window length and differences allowed for an item of n tokens."""
    if n >= WINDOW:
        return WINDOW, SUBSTITUTIONS
    return n, 1 if n >= 8 else 0


def _masks_for(n: int):
    """The masks that find overlaps of an item of n tokens."""
    if n >= WINDOW:
        return MASKS
    size = (n - 1) // 2 if n >= 8 else n        # one difference leaves a run of at least (n - 1) / 2
    return (tuple(range(size)),)


def _masked(h: np.ndarray, row_start: np.ndarray, mask) -> tuple[np.ndarray, np.ndarray]:
    span = mask[-1] + 1
    n = len(h)
    if n < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    mult = T.multipliers(64)
    value = np.zeros(n - span + 1, np.uint64)
    for j in mask:
        value += h[j: n - span + 1 + j] * mult[j]
    last = np.repeat(row_start[1:], np.diff(row_start))
    at = np.flatnonzero(np.arange(n - span + 1) + span <= last[: n - span + 1])
    return T.mix(value[at] + np.uint64(sum(1 << j for j in mask))), at


def _seeds(h, row_start, masks):
    """Hashes of the masked windows of all rows, and the token each begins at."""
    found = [_masked(h, row_start, m) for m in masks]
    return np.concatenate([v for v, _ in found]), np.concatenate([a for _, a in found])


def _lists(values: np.ndarray, of: np.ndarray, n: int, kind) -> pa.Array:
    """List column of n rows; value i belongs to row of[i], ascending."""
    offs = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values.astype(kind)))


def _marked(lead: list[pa.Array], names: list[str], h, start, value, at) -> pa.RecordBatch:
    """Rows that have a seed: leading columns, their token hashes as bytes, hash and place of their seeds."""
    row = np.searchsorted(start, at, "right") - 1
    order = np.argsort(row, kind="stable")
    rows, of = np.unique(row[order], return_inverse=True)
    place = (at - start[row])[order]
    tokens = [h[a:b].tobytes() for a, b in zip(start[rows].tolist(), start[rows + 1].tolist())]
    cols = [c.take(pa.array(rows)) for c in lead]
    return pa.RecordBatch.from_arrays(
        [*cols, pa.array(tokens, pa.binary()), _lists(value[order].view(np.int64), of, len(rows), np.int64),
         _lists(place, of, len(rows), np.int32)], names=[*names, "tokens", "hash", "at"])


def _text_key(col) -> pa.Array:
    return pa.array([hashlib.sha256(t.encode()).hexdigest() if t is not None else None for t in col.to_pylist()], pa.string())


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, key, kind, tokens, hash, at) of every different text of the benchmark, written once."""
    spark = benchmark.sparkSession
    texts = benchmark.select("text").filter("text is not null").distinct().select(
        F.monotonically_increasing_id().alias("item"), F.sha2("text", 256).alias("key"), "text")

    def run(batches):
        for s in T.slices(batches, limit=T.LEAN_BYTES):
            h, start = _tokens(s.column(2))
            size = np.diff(start)
            kind = np.minimum(size, WINDOW)
            for n in np.unique(kind[size >= LEAST_TOKENS]).tolist():
                value, at = _seeds(h, start, _masks_for(n))
                use = kind[np.searchsorted(start, at, "right") - 1] == n
                yield _marked([s.column(0), s.column(1), pa.array(kind.astype(np.int32))], ["item", "key", "kind"],
                              h, start, value[use], at[use])

    return written(spark, texts.mapInArrow(
        run, "item long, key string, kind int, tokens binary, hash array<long>, at array<int>"), "op4-items")


def _unnested(marked: DataFrame, *names: str) -> DataFrame:
    seeds = marked.select(*names, F.explode(F.arrays_zip("hash", "at")).alias("s"))
    return seeds.select(*names, F.col("s.hash").alias("hash"), F.col("s.at").alias("at"))


def _filter(seeds: DataFrame, most_bits: int) -> np.ndarray:
    """Bloom filter over the benchmark's seeds; at most ``most_bits`` bits, whatever their number."""
    n = seeds.agg(F.count("*")).first()[0]
    bits = max(1 << 15, min(most_bits, 1 << (BITS_PER_SEED * n).bit_length()))
    low, high = F.col("hash").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("hash", 32).bitwiseOR(F.lit(1))
    probe = F.explode(F.array(*((low + high * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)))).alias("p")
    rows = (seeds.select(probe).groupBy(F.shiftright("p", 15).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(32767))).alias("set")))
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for r in rows.collect():            # bits / 8 bytes in all
        out[r.bucket] = np.frombuffer(r.set, np.uint8)
    return out.reshape(-1)


def _in_filter(bitmap: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places of the values that may be in the filter."""
    mask = np.uint64(8 * len(bitmap) - 1)
    hit = np.arange(len(value))
    for i in range(PROBES):
        v = value[hit]
        p = ((v & _LOW) + (v >> np.uint64(32) | np.uint64(1)) * np.uint64(i)) & mask
        hit = hit[(bitmap[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0]
    return hit


def _verified(batches):
    """Best overlap of each pair of a text and an item around its hits."""
    for b in batches:
        out = []
        for i, (shifts, item, base, doc) in enumerate(zip(*(b.column(c).to_pylist() for c in range(2, 6)))):
            item, doc = np.frombuffer(item, np.uint64), np.frombuffer(doc, np.uint64)
            size, allowed = _need(len(item))
            best = None
            for shift in shifts:
                shift -= base
                lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
                if hi - lo < size:
                    continue
                differs = np.concatenate(([0], np.cumsum(item[lo:hi] != doc[lo + shift: hi + shift])))
                good = np.flatnonzero(differs[size:] - differs[:-size] <= allowed)
                if len(good) == 0:
                    continue
                first, end = int(good[0]), int(good[-1]) + size
                here = (first - end, int(differs[end] - differs[first]), lo + first + shift + base, lo + end + shift + base)
                best = here if best is None or here < best else best
            if best:
                out.append((i, best[2], best[3], best[1]))
        if out:
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), *(pa.array([o[k] for o in out], pa.int64()) for k in (1, 2, 3))],
                names=["key", "item", "first_token", "end_token", "substitutions"])


def _with_seeds(docs: DataFrame, masks, bitmap) -> DataFrame:
    """Rows of docs that have a seed of the filter, with these seeds and the token hashes."""
    def run(batches):
        for s in T.slices(batches, limit=T.LEAN_BYTES):
            h, start = _tokens(s.column(1))
            value, at = _seeds(h, start, masks)
            maybe = _in_filter(bitmap.value, value)
            if len(maybe):
                b = _marked([s.column(0), s.column(1)], ["doc_id", "text"], h, start, value[maybe], at[maybe])
                yield pa.RecordBatch.from_arrays([b.column(0), _text_key(b.column(1)), *b.columns[2:]],
                                                 names=["doc_id", "key", "tokens", "hash", "at"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, key string, tokens binary, hash array<long>, at array<int>")


def _found(docs: DataFrame, benchmark: DataFrame, filter_bits: int, piece_rows: int):
    """(rows of docs with a seed, items, overlaps by text key and item); None where the benchmark has no seeds."""
    spark = docs.sparkSession
    items = _items(benchmark)
    kinds = [r[0] for r in items.select("kind").distinct().collect()]       # at most ten
    if not kinds:
        return None
    masks = sorted({m for n in kinds for m in _masks_for(n)})
    item_seeds = _unnested(items, "item")
    bitmap = spark.sparkContext.broadcast(_filter(item_seeds, filter_bits))
    marked = written(spark, _with_seeds(docs, masks, bitmap), "op4-marked")
    # equal texts are searched once
    seeds = written(spark, _unnested(marked, "key").distinct(), "op4-seeds")
    # a seed that many texts hold is cut into pieces, and the items' rows of that seed are repeated for each
    hot = written(spark, seeds.groupBy("hash").agg(F.ceil(F.count("*") / piece_rows).cast("int").alias("pieces"))
                  .filter("pieces > 1"), "op4-hot")
    left = seeds.join(hot, "hash", "left").withColumn(
        "piece", F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64("key", "at"), "pieces")).cast("int"))
    right = (item_seeds.withColumnRenamed("at", "in_item").join(hot, "hash", "left")
             .withColumn("piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))))
    pairs = (left.drop("pieces").join(right.drop("pieces"), ["hash", "piece"])
             .select("key", "item", (F.col("at") - F.col("in_item")).alias("shift")).distinct()
             .groupBy("key", "item").agg(F.collect_list("shift").alias("shifts")))
    pairs = written(spark, pairs, "op4-pairs")
    texts = (marked.select("key", "tokens").join(pairs.select("key").distinct(), "key", "left_semi")
             .groupBy("key").agg(F.first("tokens").alias("tokens")))
    base = F.greatest(F.array_min("shifts"), F.lit(0))
    size = F.array_max("shifts") + (F.length("item_tokens") / 8).cast("int") - base
    laid = (pairs.join(items.select("item", F.col("tokens").alias("item_tokens")), "item").join(texts, "key")
            .select("key", "item", "shifts", "item_tokens", base.alias("base"),
                    F.substr("tokens", base * 8 + 1, size * 8).alias("tokens")))
    return marked, items, written(spark, laid.mapInArrow(
        _verified, "key string, item long, first_token long, end_token long, substitutions long"), "op4-overlaps")


def overlaps(docs: DataFrame, benchmark: DataFrame, filter_bits: int = FILTER_BITS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(doc_id, item_id, first_token, end_token, substitutions) of every overlap of a document with an item."""
    found = _found(docs, benchmark, filter_bits, piece_rows)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, first_token long, end_token long, substitutions long")
    marked, items, over = found
    ids = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.sha2("text", 256).alias("item_key"))
    of = over.join(items.select("item", F.col("key").alias("item_key")), "item").join(ids, "item_key")
    return marked.select("doc_id", "key").join(of, "key").select(
        "doc_id", "item_id", "first_token", "end_token", "substitutions")


def clean(docs: DataFrame, benchmark: DataFrame, filter_bits: int = FILTER_BITS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The rows of docs without an overlap, unchanged."""
    found = _found(docs, benchmark, filter_bits, piece_rows)
    if found is None:
        return docs
    bad = written(docs.sparkSession, found[2].select(F.col("key").alias("overlapping_text")).distinct(), "op4-bad")
    return docs.join(bad, F.sha2(docs["text"], 256) == bad["overlapping_text"], "left_anti")
