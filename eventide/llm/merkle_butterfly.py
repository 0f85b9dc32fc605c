"""Merkle manifest of a dataset: trees by group under one root, with the proof of every row, by butterfly exchange.

Leaves.  A row's leaf is the SHA-256 of its fields, each as byte count, ``:``
and value (null: ``-``).  Rows are placed by group (``lang``) and doc_id: a
range partitioning, per-partition totals and their prefix sums give every leaf
its number in its group, and numbers are cut into aligned blocks of
fanout^levels leaves.  A block hashes its own subtree (a bounded row).

Butterfly.  In round r blocks stand in aligned runs of fanout subtrees of
fanout^r blocks.  Every block sends its subtree's root to the blocks at the
same place of the other subtrees of its run; with the roots it receives each
block hashes their common ancestor itself and appends the received roots to its
proof.  After log_fanout(blocks) rounds every block holds the root of its group
and the upper part of the proofs of its leaves; nothing is passed down.  A short
last subtree of m blocks serves the places t with t mod m = its own place, so
each block receives exactly one copy of every root.  The groups' roots are the
leaves of a second tree, built by the same steps, whose root stands for the
dataset.  Each round's small table (one row a block) is written to the shared
folder, which cuts lineage.

Every fanout consecutive nodes (the last run: fewer, even one) become the hash
of their hex digests, until one node is left; a lone leaf is its tree's root.

Defined results: null groups come first, then groups by UTF-8 bytes; null
doc_ids come first in their group; rows that share a doc_id are ordered by leaf,
and rows equal in both are interchangeable; null and empty texts differ; an empty
table gives an empty result; columns other than the fields are not read.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.components import written_lean

FANOUT = 8
LEVELS = 4
PROOF = "array<struct<left:string,right:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def _leaf(fields: list[Column]) -> Column:
    def coded(c):
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return digest(F.concat(*map(coded, fields)))


def leaves(docs: DataFrame, group: str = "lang", changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """(grp, doc_id, leaf, other): leaves of all rows; other is the leaf with ``changed`` fields, where the condition holds."""
    own = [F.col(f) for f in FIELDS]
    other = F.lit(None).cast("string")
    if changed:
        other = F.when(where, _leaf([changed.get(f, F.col(f)) for f in FIELDS]))
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    return docs.select(name.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), _leaf(own).alias("leaf"), other.alias("other"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their number in the group (``at``, from 0, by ``order``) and the group's size (``total``)."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written_lean(spark, rows.withColumn("tie", F.rand(17)), "merkle-leaves")
    order = [*order, "tie"]
    # written once: the partitions and their totals must come from one partitioning
    ranged = written_lean(spark, rows.repartitionByRange(n, "grp", *order).withColumn("part", F.spark_partition_id()), "merkle-ranged")
    sizes = ranged.groupBy("grp", "part").agg(F.count("*").alias("size"))      # at most partitions + groups rows
    parts = Window.partitionBy("grp").orderBy("part")
    offsets = sizes.select("grp", "part", (F.sum("size").over(parts) - F.col("size")).alias("before"),
                           F.sum("size").over(Window.partitionBy("grp")).alias("total"))
    inside = Window.partitionBy("grp", "part").orderBy(*order)
    numbered = ranged.withColumn("nth", F.row_number().over(inside) - 1).join(offsets, ["grp", "part"])
    return numbered.withColumn("at", F.col("before") + F.col("nth")).drop("nth", "before", "part", "tie")


def subtree(nodes: list[str], fanout: int, levels: int, alone: bool) -> list[list[str]]:
    """Levels of a block's subtree, leaves first; a block that is a whole tree stops where one node is left."""
    out = [nodes]
    for _ in range(levels):
        if alone and len(nodes) == 1:
            break
        nodes = [hashlib.sha256("".join(nodes[i: i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
        out.append(nodes)
    return out


def _by_block(batches):
    """(grp, p, rows) of every block of a stream that is sorted by both; rows are tuples of the remaining columns."""
    def stream():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))
    for (grp, p), rows in itertools.groupby(stream(), key=lambda r: r[:2]):
        yield grp, p, [r[2:] for r in rows]         # at most one block


def _blocks(leaves_at: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(grp, p, at, n, ...): leaves with their block and the number of blocks of the group."""
    width = fanout ** levels
    return leaves_at.select("grp", F.expr(f"at div {width}").alias("p"), "at", F.expr(f"(total + {width - 1}) div {width}").alias("n"),
                            "doc_id", "leaf", "other")


def _sorted(rows: DataFrame) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "grp", "p").sortWithinPartitions("grp", "p", "at")


def _roots(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(grp, p, n, root, proof): the subtree root of every block, with an empty proof."""
    def run(batches):
        for grp, p, rows in _by_block(batches):
            top = subtree([r[2] for r in rows], fanout, levels, rows[0][1] == 1)[-1]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (grp, p, rows[0][1], top[0])], names=["grp", "p", "n", "root"])
    roots = _sorted(blocks.select("grp", "p", "at", "n", "leaf")).mapInArrow(run, "grp string, p long, n long, root string")
    return roots.withColumn("proof", F.from_json(F.lit("[]"), PROOF))


def exchange(state: DataFrame, stride: int, fanout: int) -> DataFrame:
    """One round: state (grp, p, n, root, proof) with subtrees of ``stride`` blocks to subtrees of stride * fanout."""
    run = stride * fanout
    targets = (f"flatten(transform(filter(sequence(0L, {fanout - 1}L), d -> g + d * {stride} < n), d -> "
               f"if(j < least({stride}L, n - g - d * {stride}), "
               f"transform(sequence(j, least({stride}L, n - g - d * {stride}) - 1, m), t -> g + d * {stride} + t), array())))")
    senders = (state.filter(F.col("n") > stride)
               .withColumn("g", F.expr(f"p div {run} * {run}")).withColumn("j", F.expr(f"p % {stride}"))
               .withColumn("m", F.expr(f"least({stride}L, n - (p - j))")))
    sent = senders.select("grp", "n", F.expr(f"(p - g) div {stride}").alias("digit"), "root", "p", "proof",
                          F.explode(F.expr(targets)).alias("to"))
    mine = F.col("to") == F.col("p")
    met = (sent.groupBy("grp", "to").agg(
        F.max("n").alias("n"), F.max(F.when(mine, F.col("digit"))).alias("own"),
        F.sort_array(F.collect_list(F.struct("digit", "root"))).alias("met"),       # at most fanout
        F.first(F.when(mine, F.col("proof")), ignorenulls=True).alias("proof")))

    def joined(test):
        return F.array_join(F.transform(F.filter("met", test), lambda x: x["root"]), "")

    step = F.struct(joined(lambda x: x["digit"] < F.col("own")).alias("left"), joined(lambda x: x["digit"] > F.col("own")).alias("right"))
    done = met.select("grp", F.col("to").alias("p"), "n", digest(joined(lambda x: F.lit(True))).alias("root"),
                      F.concat("proof", F.array(step)).alias("proof"))
    return state.filter(F.col("n") <= stride).unionByName(done)


def _tree(rows: DataFrame, order: list[str], fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """Leaves by block and, for each block, the root of its tree with the upper part of the proofs."""
    spark = rows.sparkSession
    blocks = _blocks(written_lean(spark, placed(rows, order), "merkle-placed"), fanout, levels)
    state = written_lean(spark, _roots(blocks, fanout, levels), "merkle-state")
    most, stride = state.agg(F.max("n")).first()[0] or 0, 1
    while stride < most:
        state = written_lean(spark, exchange(state, stride, fanout), "merkle-state")
        stride *= fanout
    return blocks, state


def _proofs(blocks: DataFrame, upper: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(grp, doc_id, leaf, other, subroot, root, proof) of every leaf; upper: (grp, p, subroot, root, proof) by block."""
    def run(batches):
        for grp, p, rows in _by_block(batches):
            (_, _, _, _, _, subroot, root, above), rows = rows[0], rows[1:]     # at -1: the block's upper part
            nodes = subtree([r[3] for r in rows], fanout, levels, rows[0][1] == 1)[:-1]
            left, right = [], []
            for k in range(len(rows)):
                for level in nodes:
                    base = k // fanout * fanout
                    left.append("".join(level[base: k]))
                    right.append("".join(level[k + 1: base + fanout]))
                    k //= fanout
                left += [s["left"] for s in above]
                right += [s["right"] for s in above]
            n, steps = len(rows), len(nodes) + len(above)
            proof = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * steps, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([grp] * n), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string()),
                 pa.array([r[4] for r in rows], pa.string()), pa.array([subroot] * n), pa.array([root] * n), proof],
                names=["grp", "doc_id", "leaf", "other", "subroot", "root", "proof"])

    first = upper.select("grp", "p", F.lit(-1).cast("long").alias("at"), "subroot", "root", "proof")
    return _sorted(blocks.unionByName(first, allowMissingColumns=True)).mapInArrow(
        run, f"grp string, doc_id long, leaf string, other string, subroot string, root string, proof {PROOF}")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def manifest(docs: DataFrame, group: str = "lang", changed: dict[str, Column] | None = None, where: Column | None = None,
             fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """(grp, doc_id, leaf, other, subroot, root, proof): the manifest's rows; grp is ``=`` and the group, or empty for null.

    ``proof`` lists, from the leaf's level to the dataset's root, the digests to
    the left and right of the path; ``other`` is the leaf of the changed row, or null.
    """
    spark = docs.sparkSession
    blocks, state = _tree(leaves(docs, group, changed, where), ["doc_id", "leaf"], fanout, levels)
    state = state.withColumnRenamed("root", "subroot")
    tops = state.filter("p = 0").select(F.lit("").alias("grp"), F.lit(None).cast("long").alias("doc_id"),
                                        F.col("subroot").alias("leaf"), F.col("grp").alias("other"))
    top_blocks, top_state = _tree(tops, ["other"], fanout, levels)
    over = _proofs(top_blocks, top_state.withColumn("subroot", F.col("root")), fanout, levels).select(
        F.col("other").alias("grp"), "root", F.col("proof").alias("above"))
    over = written_lean(spark, over, "merkle-groups")
    upper = state.join(over, "grp").select("grp", "p", "subroot", "root", F.concat("proof", "above").alias("proof"))
    return _proofs(blocks, upper, fanout, levels)
