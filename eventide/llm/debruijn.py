"""Repeated word strings across documents by compaction of a de Bruijn graph of token k-mers.

Goal: remove each word covered by a window of ``width`` words whose sequence
also starts in a document with a smaller doc_id.

1. Whole copies.  Texts of equal hash are told apart from the one of the least
   doc_id: each is one span of all its words and takes no part in steps 2 to 5.
2. Candidates.  The anchor of a window is the least hash of its five-word grams;
   equal windows have equal anchors.  Anchors of one document only are dropped
   by an aggregation and a join, and each document gets the anchors that occur
   elsewhere.
3. Edges.  A candidate window is an edge between the hashes of its first and its
   last width - 1 words.  One aggregation by edge (partial on every mapper)
   keeps the edges of two or more documents, each with its source coordinate:
   the smallest doc_id and the edge's first place there.
4. Compaction.  Node degrees, joined to the edges, tell the nodes that exactly
   one repeated edge enters and one leaves.  Edges that follow each other at
   such nodes, at neighbouring source coordinates, become one path.
5. Occurrences join their edge and learn path and source coordinate; those in
   documents after the source, next to each other on a path, merge into spans.
6. Verification.  Spans are spelled from the text at their source coordinate;
   the digest of those words is compared with the document's own words before
   anything is removed.  Should any span differ (two word strings with the same
   128-bit edge), all is done again with other hashes, so results are exact.

Anchors and edges only select; equality is decided on words.

Defined results: null and empty texts have no words; texts shorter than
``width`` words lose nothing; rows with a null doc_id neither lose words nor
cause losses; rows that share a doc_id cause no losses among themselves, also
where their texts differ; repeated rows are each returned; very long texts are
one row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from eventide.llm import text as T
from eventide.llm.components import discard, written_lean

WIDTH = 13
GRAM = 5
TRIES = 4           # seeds tried before an impossible series of collisions is reported
_POS = 32           # bits of a word's place in a coordinate; above them a 31-bit hash of the text


def _grams(s, column: int, width: int, seed: int):
    """Word hashes, row bounds, window places and the anchor of each window of a slice."""
    words = T.Words(*T.as_bytes(s.column(column)), lower=False)
    h = T.mix(words.hashes() + np.uint64(seed) * T.multipliers(1)[0])
    bounds = words.row_start
    least, at = T.windows(h, bounds, GRAM)
    full = np.full(len(h), np.iinfo(np.uint64).max, np.uint64)
    full[at] = least
    reach, least = width - GRAM + 1, full
    done = 1
    while done < reach:                 # least gram of each window, by doubling
        step = min(done, reach - done)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        done += step
    last = np.repeat(bounds[1:], np.diff(bounds))
    starts = np.flatnonzero(np.arange(len(h)) + width <= last)
    return h, bounds, starts, least[starts]


def _rows(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.expr(f"shiftrightunsigned(xxhash64(text, {seed}), 33)").alias("twin"), "text")


def _copies(rows: DataFrame, seed: int) -> DataFrame:
    """(doc_id, twin, src): texts that a document with a smaller doc_id is claimed to hold word for word."""
    spark = rows.sparkSession
    sums = written_lean(spark, rows.filter("doc_id is not null and text is not null").select(
        "doc_id", "twin", F.expr(f"xxhash64(text, {seed + TRIES})").alias("whole")), "dbg-texts")
    least = sums.groupBy("whole", "twin").agg(F.min("doc_id").alias("src"))
    return written_lean(spark, sums.join(least, ["whole", "twin"]).filter("doc_id > src").select("doc_id", "twin", "src").distinct(),
                        "dbg-copies")


def _anchors(rows: DataFrame, width: int, seed: int) -> DataFrame:
    """(doc_id, anchors): for each document, its anchors that also occur in a document with another id."""
    spark = rows.sparkSession

    def run(batches):
        for s in T.slices(batches):
            _, bounds, starts, anchor = _grams(s, 2, width, seed)
            row = np.searchsorted(bounds, starts, "right") - 1
            new = np.ones(len(starts), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), s.column(0).take(pa.array(row[new]))],
                                             names=["anchor", "doc_id"])

    pairs = written_lean(spark, rows.filter("doc_id is not null").mapInArrow(run, "anchor long, doc_id long"), "dbg-anchors")
    shared = pairs.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("anchor")
    found = pairs.join(shared, "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))   # at most its words
    found = written_lean(spark, found, "dbg-shared")
    discard(pairs)
    return found


def _occurrences(rows: DataFrame, anchors: DataFrame, width: int, seed: int) -> DataFrame:
    """(left, right, doc_id, at, first): candidate windows as edges; at: text hash and place; first: the first place in its text."""
    def run(batches):
        for s in T.slices(batches):
            h, bounds, starts, anchor = _grams(s, 2, width, seed)
            row = np.searchsorted(bounds, starts, "right") - 1
            lists = s.column(3)
            own = np.repeat(np.arange(s.num_rows), np.diff(lists.offsets.to_numpy()))
            salt = T.multipliers(2)[1]
            wanted = lists.flatten().to_numpy().view(np.uint64) ^ (own.astype(np.uint64) * salt)
            hit = np.isin(anchor ^ (row.astype(np.uint64) * salt), wanted)
            starts, row = starts[hit], row[hit]
            node, at = T.windows(h, bounds, width - 1)
            nodes = np.zeros(len(h) + 1, np.uint64)
            nodes[at] = node
            left, right = nodes[starts], nodes[starts + 1]
            order = np.lexsort((starts, right, left, row))
            first = np.ones(len(starts), bool)
            a, b = order[1:], order[:-1]
            first[a] = (left[a] != left[b]) | (right[a] != right[b]) | (row[a] != row[b])
            twin = s.column(1).to_numpy()[row]
            place = (twin << _POS) | (starts - bounds[row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(left.view(np.int64)), pa.array(right.view(np.int64)), s.column(0).take(pa.array(row)),
                 pa.array(place), pa.array(first)], names=["left", "right", "doc_id", "at", "first"])

    return rows.join(anchors, "doc_id").select("doc_id", "twin", "text", "anchors").mapInArrow(
        run, "left long, right long, doc_id long, at long, first boolean")


def repeated_edges(occurrences: DataFrame) -> DataFrame:
    """(left, right, src, src_at): edges of two or more documents with their source coordinate."""
    return (occurrences.groupBy("left", "right")
            .agg(F.min("doc_id").alias("src"), F.max("doc_id").alias("last"),
                 F.min_by("at", F.expr("if(first, doc_id, null)")).alias("src_at"))
            .filter("src < last").drop("last"))


def paths(edges: DataFrame) -> DataFrame:
    """(left, right, src, src_at, path): the place at which the path of each edge begins."""
    ends = (edges.select(F.col("left").alias("node"), F.lit(1).alias("leaving"), F.lit(0).alias("entering"))
            .unionByName(edges.select(F.col("right").alias("node"), F.lit(0).alias("leaving"), F.lit(1).alias("entering"))))
    through = (ends.groupBy("node").agg(F.sum("leaving").alias("o"), F.sum("entering").alias("i"))
               .filter("o = 1 and i = 1").select(F.col("node").alias("left"), F.lit(True).alias("through")))
    inside = Window.partitionBy("src").orderBy("src_at")        # at most the words of one document's texts
    follows = F.coalesce("through", F.lit(False)) & (F.lag("src_at").over(inside) == F.col("src_at") - 1)
    linked = edges.join(through, "left", "left").withColumn("head", F.when(~F.coalesce(follows, F.lit(False)), F.col("src_at")))
    return linked.select("left", "right", "src", "src_at", F.max("head").over(inside).alias("path"))


def repeated_spans(rows: DataFrame, width: int, seed: int) -> DataFrame:
    """(doc_id, at, n, src, src_at): n windows from ``at`` on (-1: the whole text), claimed to be those at ``src_at`` in the source."""
    spark = rows.sparkSession
    copies = _copies(rows, seed)
    once = rows.join(copies, ["doc_id", "twin"], "left_anti").select(rows.columns)
    occurrences = written_lean(spark, _occurrences(once, _anchors(once, width, seed), width, seed), "dbg-edges-seen")
    bare = written_lean(spark, repeated_edges(occurrences), "dbg-edges")
    edges = written_lean(spark, paths(bare), "dbg-paths")
    discard(bare)
    later = occurrences.select("left", "right", "doc_id", "at").join(edges, ["left", "right"]).filter("doc_id > src").select(
        "doc_id", "at", "src", "src_at", "path")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def merge(batches):
        for b in batches:
            doc, at, src, src_at, path = (c.to_numpy() for c in b.columns)
            new = np.ones(len(doc), bool)
            new[1:] = ((doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1) | (src[1:] != src[:-1])
                       | (src_at[1:] != src_at[:-1] + 1) | (path[1:] != path[:-1]))
            head = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[head]) for x in (doc, at)), pa.array(np.diff(head, append=len(doc))),
                                              *(pa.array(x[head]) for x in (src, src_at))], names=["doc_id", "at", "n", "src", "src_at"])

    spans = later.repartition(n, "doc_id").sortWithinPartitions("doc_id", "at").mapInArrow(
        merge, "doc_id long, at long, n long, src long, src_at long")
    start = F.shiftleft("twin", _POS)
    whole = copies.select("doc_id", start.alias("at"), F.lit(-1).cast("long").alias("n"), "src", start.alias("src_at"))
    spans = written_lean(spark, spans.unionByName(whole), "dbg-spans")
    discard(occurrences)
    discard(edges)
    return spans


def _spelled(rows: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """(src, src_at, n, spelled): digest of the words of every distinct span at its source."""
    asked = (spans.select("src", "src_at", "n").distinct()
             .withColumn("twin", F.shiftright("src_at", _POS))
             .groupBy(F.col("src").alias("doc_id"), "twin").agg(F.collect_list(F.struct("src_at", "n")).alias("asked")))

    def run(batches):
        for s in T.slices(batches, limit=T.SLICE_BYTES):
            lists = s.column(1)
            flat = lists.flatten()
            at, n = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            edge, out = lists.offsets.to_numpy() - lists.offsets[0].as_py(), []
            for i, t in enumerate(s.column(2).cast(pa.binary()).to_pylist()):
                words = t.split()
                for j in range(edge[i], edge[i + 1]):
                    p = int(at[j]) & 0xFFFFFFFF
                    out.append(_digest(words[p: p + int(n[j]) + width - 1] if n[j] >= 0 else words))
            own = np.repeat(np.arange(s.num_rows), np.diff(edge))
            yield pa.RecordBatch.from_arrays([s.column(0).take(pa.array(own)), pa.array(at), pa.array(n), pa.array(out, pa.binary())],
                                             names=["src", "src_at", "n", "spelled"])

    return (rows.join(asked, ["doc_id", "twin"]).select("doc_id", "asked", "text")
            .mapInArrow(run, "src long, src_at long, n long, spelled binary").dropDuplicates(["src", "src_at", "n"]))


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _cut(rows: DataFrame, spans: DataFrame, width: int, texts: bool) -> DataFrame:
    """Every row of rows with its result; n_failed counts the spans that differ from their source."""
    held = spans.withColumn("twin", F.shiftright("at", _POS)).groupBy("doc_id", "twin").agg(
        F.collect_list(F.struct("at", "n", "spelled")).alias("spans"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_failed long" + (", kept string" if texts else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for s in T.slices(batches):
            out = []
            for i, t, found in zip(s.column(0).to_pylist(), s.column(2).cast(pa.binary()).to_pylist(), s.column(1).to_pylist()):
                words = (t or b"").split()
                kept, failed = words, 0
                if found:
                    mark = np.zeros(len(words) + 1, np.int32)
                    for x in found:
                        p = x["at"] & 0xFFFFFFFF
                        q = p + x["n"] + width - 1 if x["n"] >= 0 else len(words)
                        if q <= len(words) and _digest(words[p:q]) == x["spelled"]:
                            if q - p >= width:
                                mark[p] += 1
                                mark[q] -= 1
                        else:
                            failed += 1
                    kept = list(compress(words, (np.cumsum(mark[:-1]) == 0).tolist()))
                rest = b" ".join(kept)
                out.append((i, len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), failed, rest.decode())[: len(names)])
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), kinds)], names=names)

    kinds = [pa.field(n, t) for n, t in zip(names, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()))]
    none = F.lit(None).cast(held.schema["spans"].dataType)
    known = rows.filter("doc_id is not null").join(held, ["doc_id", "twin"], "left").select("doc_id", "spans", "text")
    return known.unionByName(rows.filter("doc_id is null").select("doc_id", none.alias("spans"), "text")).mapInArrow(run, schema)


def deduplicate(docs: DataFrame, width: int = WIDTH, texts: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document, and the kept words on demand."""
    spark = docs.sparkSession
    for seed in range(1, TRIES + 1):
        rows = _rows(docs, seed)
        spans = repeated_spans(rows, width, seed)
        spelled = written_lean(spark, _spelled(rows, spans, width), "dbg-spelled")      # a table, so that the join can split a hot source
        checked = spans.join(spelled, ["src", "src_at", "n"], "left").select("doc_id", "at", "n", "spelled")
        out = written_lean(spark, _cut(rows, written_lean(spark, checked, "dbg-checked"), width, texts), "dbg-out")
        if not out.filter("n_failed > 0").limit(1).count():
            return out.drop("n_failed")
    raise RuntimeError("spans differ from their sources under every seed")
