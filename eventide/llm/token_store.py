"""Token-id store: documents as checksummed blocks of range-coded ids.

Layout.  A store is a Parquet folder of block rows, written by Spark (so a lost
task is simply run again and only whole files become visible).  Documents lie in
ascending doc_id order (or a given one) over the parts; the ids of a part, each document closed
by the end id, form one stream that is cut into blocks of 8,192 ids:

    part      partition in that order
    block     number of the block in its part
    n_ids     ids in the block
    checksum  CRC-32 of the ids as little-endian unsigned 32-bit integers
    payload   range-coder words (``mixing_coder``), decodable on their own
    docs      zlib of int64 triples (ordinal, doc_id, ids in this block), one
              per document touching the block; a doc_id's null is flagged by a
              negative ordinal (-1 - ordinal)

Reading decodes blocks side by side, verifies every checksum, and returns the
pieces of documents; pieces of documents that span blocks are joined by their
order, and per-document checksums by CRC combination, never by moving ids.

Defined results: an added token of the tokenizer file that stands in a text
becomes its own id; null and empty texts hold the end id alone; documents with a
null doc_id come first; documents that share a doc_id follow each other ordered
by text hash; an empty table gives an empty store; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventide.llm import mixing_coder as C, text as T

END_ID = 2
KNOWN_PIECES = 400_000          # at which a worker forgets half of its encoded pieces
GROUP_IDS = C.BLOCK_IDS * C.LANES
TEXT_BYTES = 2 << 20            # of texts split into pieces at once
INDEX = "doc_id long, part int, ordinal long, block long, n long, crc long"


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library.

    The library first takes out the file's added tokens (leftmost, then longest);
    its pre-tokenizer cuts the stretches between them by ``PATTERN`` and its model
    merges inside pieces only, so the model encodes each distinct piece once and
    the ids are remembered.  The cuts of all texts of a slice are found at once, on
    the classes of their characters, which are the pattern's own (regex module).
    """

    PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    SPACE, OTHER, UNKNOWN = 0, 3, 255       # classes; letters 1, numbers 2

    def __init__(self, path: str, pattern: str):
        if pattern != self.PATTERN:
            raise ValueError(f"pieces are cut by {self.PATTERN} only, not by {pattern}")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added):
            raise ValueError("only added tokens that are matched as they stand are supported")
        self.added = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.find_added = re.compile(b"|".join(map(re.escape, self.added))).finditer
        self.class_of = regex.compile(r"(\s)|(\p{L})|(\p{N})|(.)", regex.S).match
        self.ascii = bytes(self.class_of(chr(c)).lastindex - 1 for c in range(128)) + bytes(128)
        self.wide = np.full(0x110000, self.UNKNOWN, np.uint8)
        self.added_ids = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # the letter of every byte that UTF-8 has, as the pre-tokenizer writes it for the model
        every = "".join(map(chr, (*range(0x800), *range(0x800, 0xD800, 0x40), *range(0xE000, 0x110000, 0x1000))))
        letters = "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(every))
        if self.tokenizer.normalizer is not None or len(letters) != len(every.encode()):
            raise ValueError("only byte-level files without a normalizer or an added blank are supported")
        self.letters = dict(zip(every.encode(), letters))
        self.model = self.tokenizer.model
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)         # the pieces are remembered here
        self._empty()

    def _characters(self, data: np.ndarray):
        """Class of every character, and the byte it starts at (None: every byte is one)."""
        classes = np.frombuffer(data.tobytes().translate(self.ascii), np.uint8)
        if not len(data) or data.max() < 128:
            return classes, None
        at = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[at]
        classes = classes[at]
        long = np.flatnonzero(lead >= 0x80)
        first, byte = at[long], lead[long].astype(np.int32)
        code = np.where(byte < 0xE0, byte & 0x1F, np.where(byte < 0xF0, byte & 0x0F, byte & 0x07))
        for k, least in ((1, 0), (2, 0xE0), (3, 0xF0)):
            more = byte >= least
            code[more] = code[more] << 6 | (data[first[more] + k] & 0x3F)
        found = self.wide[code]
        if (found == self.UNKNOWN).any():
            for c in np.unique(code[found == self.UNKNOWN]).tolist():
                self.wide[c] = self.class_of(chr(c)).lastindex - 1
            found = self.wide[code]
        classes[long] = found
        return classes, at

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The byte at which each piece or added token of the texts starts, ascending."""
        if not len(data):
            return np.zeros(0, np.int64)
        edges, inside = offsets, []
        text = data.tobytes()
        if any(a in text for a in self.added):
            spans = [(lo + m.start(), lo + m.end()) for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                     for m in self.find_added(text[lo: hi])]
            edges = np.union1d(offsets, np.array(spans, np.int64).ravel())
            inside = spans
        classes, at = self._characters(data)
        chars = data if at is None else data[at]
        if at is not None:
            edges, inside = np.searchsorted(at, edges), [np.searchsorted(at, s) for s in inside]
        edges = edges[edges < len(classes)]
        starts = np.empty(len(classes), bool)
        starts[0] = True
        np.not_equal(classes[1:], classes[:-1], out=starts[1:])
        # the last white-space character before another one is cut off; a blank goes with what follows it
        last = starts[1:] & (classes[:-1] == self.SPACE)
        last[edges[edges > 0] - 1] = False
        starts[:-1] |= last
        last &= chars[:-1] == 0x20
        starts[1:] &= ~last
        edge = np.zeros(len(classes) + 3, bool)
        edge[edges] = True
        edge[len(classes):] = True
        starts[edges] = True
        # contractions
        mark = np.flatnonzero(chars == 0x27)
        mark = mark[starts[mark] & ~edge[mark + 1]]
        if len(mark):
            one = chars[mark + 1]
            two = np.where(edge[mark + 2], 0, chars[np.minimum(mark + 2, len(chars) - 1)])
            n = np.where(np.isin(one, (0x73, 0x74, 0x6D, 0x64)), 1,                     # 's 't 'm 'd
                         np.where((((one == 0x72) | (one == 0x76)) & (two == 0x65))     # 're 've
                                  | ((one == 0x6C) & (two == 0x6C)), 2, 0))             # 'll
            mark, n = mark[n > 0], n[n > 0]
            starts[mark + 1] = False
            after = mark + 1 + n
            starts[after[~edge[after] & (classes[np.minimum(after, len(classes) - 1)] != self.SPACE)]] = True
        for lo, hi in inside:
            starts[lo + 1: hi] = False
        return np.flatnonzero(starts) if at is None else at[starts]

    def _forget(self):
        """Keeps the half of the known pieces that were met in most slices."""
        names, keep = list(self.known), np.sort(np.argsort(-self.met[: len(self.known)], kind="stable")[: KNOWN_PIECES // 2])
        sizes = self.sizes[keep]
        ends = np.cumsum(sizes, dtype=np.int64)
        flat = self.pool[np.arange(ends[-1]) + np.repeat(self.starts[keep] - ends + sizes, sizes)]
        met = self.met[keep]
        self._empty()
        self._enter([names[i] for i in keep.tolist()], flat, sizes)
        self.met[: len(met)] = met

    def _empty(self):
        self.known: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, np.uint32)
        self.starts, self.sizes, self.met = (np.zeros(1 << 16, np.int32) for _ in range(3))
        self.used = 0

    def _enter(self, pieces: list[str], flat: np.ndarray, sizes: np.ndarray):
        n = len(self.known)
        while n + len(pieces) > len(self.sizes):
            self.starts, self.sizes, self.met = (np.concatenate((a, np.zeros_like(a))) for a in (self.starts, self.sizes, self.met))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.starts[n: n + len(pieces)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n: n + len(pieces)] = sizes
        self.pool[self.used: self.used + len(flat)] = flat
        self.used += len(flat)
        self.known.update(zip(pieces, range(n, n + len(pieces))))

    def _learn(self, pieces: list[str]) -> range:
        """Has the file's model encode new pieces; their numbers."""
        n, merge, letters, added = len(self.known), self.model.tokenize, self.letters, self.added_ids
        flat: list[int] = []
        ends = [0]
        for p in pieces:
            flat += [t.id for t in merge(p.encode().decode("latin-1").translate(letters))] if p not in added else [added[p]]
            ends.append(len(flat))
        self._enter(pieces, np.array(flat, np.uint32), np.diff(ends))
        return range(n, len(self.known))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each."""
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        data, offsets = T.as_bytes(texts)
        cuts = self.cuts(data, offsets)
        bounds = np.append(cuts, len(data))
        pieces = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
        pieces = pieces.dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.known.get, names, itertools.repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = self._learn([names[i] for i in new.tolist()])
        self.met[at] += 1
        at = at[pieces.indices.to_numpy()]
        sizes = self.sizes[at]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.pool[np.arange(total) + np.repeat(self.starts[at] - ends + sizes, sizes)]
        rows = np.concatenate(([0], ends))[np.searchsorted(cuts, offsets)]
        return flat, np.diff(rows)


@functools.lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """The encoder of a public tokenizer file, once per worker."""
    import public_tokenizers
    return Encoder(public_tokenizers.path(name), public_tokenizers.PATTERN)


class _Writer:
    """Cuts a part's stream of ids into blocks and codes them many at a time."""

    def __init__(self, part: int):
        self.part, self.block, self.ordinal = part, 0, 0
        self.ids: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_ids, flat: np.ndarray, sizes: np.ndarray):
        n = len(sizes)
        ends = np.cumsum(sizes + 1)
        ids = np.full(int(ends[-1]) if n else 0, END_ID, np.uint32)
        body = np.ones(len(ids), bool)
        body[ends - 1] = False
        ids[body] = flat
        known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
        row = np.arange(self.ordinal, self.ordinal + n)
        self.docs.append(np.stack([np.where(known, row, -1 - row), doc_ids.fill_null(0).to_numpy(zero_copy_only=False),
                                   sizes + 1], 1))
        self.ordinal += n
        self.ids.append(ids)
        self.held += len(ids)
        while self.held >= GROUP_IDS:
            yield self._flush(GROUP_IDS)

    def close(self):
        if self.held:
            yield self._flush(self.held)

    def _flush(self, n: int):
        ids, docs = np.concatenate(self.ids), np.concatenate(self.docs)
        take, self.ids, self.held = ids[:n], [ids[n:].copy()], len(ids) - n
        ends = np.cumsum(docs[:, 2])
        cuts = np.arange(0, n, C.BLOCK_IDS)
        heads = []
        for lo in cuts:
            hi = min(lo + C.BLOCK_IDS, n)
            a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left") + 1
            part = docs[a:b].copy()
            part[:, 2] = np.minimum(ends[a:b], hi) - np.maximum(ends[a:b] - docs[a:b, 2], lo)
            heads.append(zlib.compress(part.astype("<i8").tobytes(), 3))
        left = docs[np.searchsorted(ends, n, "right"):].copy()
        if len(left):
            left[0, 2] = min(left[0, 2], ends[-len(left)] - n)
        self.docs = [left]
        blocks = [take[lo: lo + C.BLOCK_IDS] for lo in cuts]
        coded = C.encode(blocks)
        first, self.block = self.block, self.block + len(blocks)
        return pa.RecordBatch.from_pydict({
            "part": pa.array([self.part] * len(blocks), pa.int32()),
            "block": pa.array(range(first, self.block), pa.int64()),
            "n_ids": pa.array([len(b) for b in blocks], pa.int64()),
            "checksum": pa.array([c for _, c in coded], pa.int64()),
            "payload": pa.array([p for p, _ in coded], pa.binary()),
            "docs": pa.array(heads, pa.binary())})


def write(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", order: list[Column] = ()) -> None:
    """Write the ids of all documents to a new store, in ascending ``order`` (default: doc_id, then text hash)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = list(order) or [F.col("doc_id").cast("long"), F.xxhash64("text")]      # the hash splits rows of one id
    by = [f"__by{i}" for i in range(len(order))]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(c.alias(b) for c, b in zip(order, by)))
    rows = rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
    rows = rows.select("doc_id", "text")

    def run(batches):
        out = _Writer(TaskContext.get().partitionId())
        for s in T.slices(batches, limit=TEXT_BYTES):
            flat, sizes = encoder(tokenizer).ids(s.column(1))
            yield from out.add(s.column(0), flat, sizes)
        yield from out.close()

    rows.mapInArrow(run, "part int, block long, n_ids long, checksum long, payload binary, docs binary").write.parquet(path)


def pieces(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """Decoded pieces of documents: one row for each document and run of neighbouring blocks in one task.

    Columns doc_id, part, ordinal (of the document in its part), block (the
    piece's first), n, crc (CRC-32 of the piece's ids) and, on demand, ids.
    """
    schema = INDEX + (", ids array<int>" if ids else "")

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, C.LANES):
                yield from _piece_rows(b.slice(lo, C.LANES), ids, schema)

    return spark.read.parquet(path).mapInArrow(run, schema)


def _piece_rows(b, with_ids: bool, schema: str):
    col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
    part, block, n_ids, checksum = (col[c].to_numpy(zero_copy_only=False) for c in ("part", "block", "n_ids", "checksum"))
    decoded = C.decode(col["payload"].to_pylist(), n_ids.tolist(), checksum.tolist())
    heads = [np.frombuffer(zlib.decompress(h), "<i8").reshape(-1, 3) for h in col["docs"].to_pylist()]
    rows = np.concatenate(heads)
    of = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
    flat = np.concatenate(decoded).astype("<u4")
    end = np.cumsum(rows[:, 2])
    start = end - rows[:, 2]
    known = rows[:, 0] >= 0
    ordinal = np.where(known, rows[:, 0], -1 - rows[:, 0])
    p = part[of]
    # a piece that goes on in the next block of this batch is joined to it
    same = (ordinal[1:] == ordinal[:-1]) & (p[1:] == p[:-1]) & (block[of][1:] == block[of][:-1] + 1)
    first = np.flatnonzero(np.concatenate(([True], ~same)))
    last = np.concatenate((first[1:], [len(rows)])) - 1
    a, z = start[first], end[last]
    data = flat.tobytes()
    out = [pa.array(rows[first, 1], mask=~known[first]), pa.array(p[first], pa.int32()), pa.array(ordinal[first]),
           pa.array(block[of][first]), pa.array(z - a),
           pa.array([zlib.crc32(data[4 * x: 4 * y]) for x, y in zip(a.tolist(), z.tolist())], pa.int64())]
    if with_ids:
        out.append(pa.ListArray.from_arrays(pa.array(np.concatenate((a, z[-1:])).astype(np.int32)), pa.array(flat.view(np.int32))))
    yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in schema.split(", ")])


def _shift_crc(crc: int, n_bytes: int) -> int:
    """CRC-32 state after n_bytes zero bytes, without the pre- and post-conditioning (GF(2) matrix powers)."""
    if n_bytes == 0:
        return crc

    def times(mat, vec):
        out, i = 0, 0
        while vec:
            if vec & 1:
                out ^= mat[i]
            vec >>= 1
            i += 1
        return out

    square = [0xEDB88320] + [1 << i for i in range(31)]         # one zero bit; the CRC-32 polynomial (fixed value)
    for _ in range(3):
        square = [times(square, c) for c in square]             # one zero byte
    while n_bytes:
        if n_bytes & 1:
            crc = times(square, crc)
        n_bytes >>= 1
        if n_bytes:
            square = [times(square, c) for c in square]
    return crc


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of the concatenation of (crc, bytes) parts."""
    out = 0
    for crc, size in parts:
        out = _shift_crc(out, size) ^ crc
    return out


def read_index(spark: SparkSession, path: str, place: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a store, all from decoded blocks.

    On demand also place, the number of documents before it.
    """
    from eventide.llm.components import written
    rows = (pieces(spark, path).groupBy("part", "ordinal")
            .agg(F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"),
                 F.sort_array(F.collect_list(F.struct("block", "n", "crc"))).alias("p")))

    def run(batches):
        for b in batches:
            crc = [x[0]["crc"] if len(x) == 1 else joined_crc([(y["crc"], 4 * y["n"]) for y in x])
                   for x in b.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(crc, pa.int64())],
                                             names=["part", "ordinal", "doc_id", "n_tokens", "ids_crc32"])

    rows = written(spark, rows.select("part", "ordinal", "doc_id", "n_tokens", "p").mapInArrow(
        run, "part int, ordinal long, doc_id long, n_tokens long, ids_crc32 long"), "token-index")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("ids"), F.count("*").alias("docs"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per part
    offsets = totals.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("part0"),
                            F.coalesce(F.sum("docs").over(earlier), F.lit(0)).alias("docs0"))
    before = Window.partitionBy("part").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
            .join(F.broadcast(offsets), "part")
            .select("doc_id", (F.col("part0") + F.col("start")).alias("start"), "n_tokens", "ids_crc32",
                    *([(F.col("docs0") + F.col("ordinal")).alias("place")] if place else [])))
