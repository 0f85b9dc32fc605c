"""Wavelet cuts, Merkle manifest and de Bruijn dedup against brute force, and their registered queries against SQL."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import debruijn, merkle_butterfly, queries, wavelet_fim
from tests import oracle_harness
from tests.llm import fixtures as fx


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# -- op11 ---------------------------------------------------------------------------------------------------------

def test_wavelet_ranks_and_bisection():
    rng = np.random.default_rng(5)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 8, n).astype(np.uint8)
        m = wavelet_fim.WaveletMatrix(symbols)
        at = np.arange(n + 1)
        for lo, hi in ((0, 1), (1, 6), (3, 5), (4, 8), (0, 8)):
            hits = np.concatenate(([0], np.cumsum((symbols >= lo) & (symbols < hi))))
            assert (m.rank((lo, hi), at) == hits).all()
            for k in range(0, int(hits[-1]) + 1, 7):
                place = m.after((lo, hi), np.array([0]), np.array([n]), np.array([k]))[0]
                begins = np.flatnonzero((symbols >= lo) & (symbols < hi))
                assert place == (0 if k == 0 else begins[k] if k < len(begins) else n)


def units(t, unit):
    """Where each unit begins, in code points."""
    if unit == "char":
        return list(range(len(t)))
    if unit == "word":
        return [m.start() for m in fx.WORD.finditer(t)]
    return [i for i in range(len(t)) if i == 0 or t[i - 1] == "\n"]


FIM_ROWS = fx.texts() + [(200, "Größe<P>x", "s"), (201, "a<S>", "s"), (202, "<M>", "s"), (203, "日本語 テキスト\n\nx\n", None),
                         (204, "<<P <S < M>", "s"), (205, "\n\n\n", "s"), (206, "🙂" * 50, "s")]


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_fill_in_middle(spark, unit):
    out = wavelet_fim.transform(fx.frame(spark, FIM_ROWS), unit=unit, seed=9)
    got = out.withColumn("back", wavelet_fim.restore(F.col("output"), F.col("form"))).collect()
    want, forms = [], set()
    for i, t, _ in FIM_ROWS:
        t = t or ""
        h = sha(f"9:{'' if i is None else i}")
        h1, h2, h3, h4 = (int(h[8 * j: 8 * j + 8], 16) for j in range(4))
        begins = units(t, unit)
        n = len(begins)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (0 if k == 0 else begins[k] if k < n else len(t) for k in (a, b))
        plain = t == "" or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90
        form = "plain" if plain else "spm" if h4 % 100 < 20 else "psm"
        parts = {"plain": t, "psm": f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}", "spm": f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"}
        want.append((i, n, form, None if plain else a, None if plain else b - a, parts[form]))
        forms.add(form)
    key = lambda r: (str(r[0]), r[5])
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == sorted(want, key=key)
    assert all(r.back == r.text for r in got) and forms == {"plain", "psm", "spm"}


# -- op12 ---------------------------------------------------------------------------------------------------------

def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout):
    """Root of the nodes and, by node, the (left, right) siblings of each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            base = k // fanout * fanout
            paths[i].append(("".join(nodes[base:k]), "".join(nodes[k + 1: base + fanout])))
            at[i] = k // fanout
        nodes = [sha("".join(nodes[i: i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def manifest_rows():
    rng = np.random.default_rng(2)
    langs = ["en"] * 70 + ["de"] * 33 + ["fr"] + [None] * 9 + ["Ü"] * 3 + ["a"] * 8
    rows = [(int(i) if i % 17 else None, f"Text {i}" if i % 5 else None, lang, f"s{i % 3}" if i % 4 else None, int(i))
            for i, lang in zip(rng.permutation(len(langs)), langs)]
    return rows + [rows[3], (rows[5][0], "other text", rows[5][2], "s", 1)]


@pytest.mark.parametrize("fanout,levels", [(2, 1), (3, 1), (2, 2), (8, 4)])
def test_manifest(spark, fanout, levels):
    rows = manifest_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        "*", F.lit("x").alias("grp"), F.lit(1).alias("at"), F.lit(2).alias("part"), F.lit("r").alias("root"))
    got = merkle_butterfly.manifest(docs, changed={"text": F.lower("text")}, where=F.col("n_chars") % 2 == 0, fanout=fanout, levels=levels)
    got = got.withColumn("folded", merkle_butterfly.fold(F.coalesce("other", "leaf"), F.col("proof"))).collect()
    groups = {}
    for i, text, lang, source, n in rows:
        own = leaf((i, source, lang, n, text))
        other = leaf((i, source, lang, n, text.lower() if text else text)) if n % 2 == 0 else None
        groups.setdefault("" if lang is None else "=" + lang, []).append((i is not None, i or 0, own, i, other))
    names = sorted(groups, key=str.encode)
    trees = {g: tree([r[2] for r in sorted(groups[g], key=lambda r: r[:3])], fanout) for g in names}
    root, tops = tree([trees[g][0] for g in names], fanout)
    want = sorted((g, str(r[3]), r[2], r[4], trees[g][0], root, path + tops[k])
                  for k, g in enumerate(names) for r, path in zip(sorted(groups[g], key=lambda r: r[:3]), trees[g][1]))
    seen = sorted((r.grp, str(r.doc_id), r.leaf, r.other, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in got)
    assert [s[:6] for s in seen] == [w[:6] for w in want]
    assert sorted(map(str, seen)) == sorted(map(str, want))
    assert all((r.folded == r.root) == (r.other in (None, r.leaf)) for r in got)


def test_manifest_of_empty_and_single(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    assert merkle_butterfly.manifest(spark.createDataFrame([], schema)).count() == 0
    one = merkle_butterfly.manifest(spark.createDataFrame([(None, "", None, None, None)], schema)).collect()[0]
    assert one.leaf == one.subroot == one.root == leaf((None, None, None, None, "")) and one.proof == []


# -- op13 ---------------------------------------------------------------------------------------------------------

def cut_words(rows, width):
    least, out = {}, []
    texts = [(r[0], fx.words(r[1], lower=False)) for r in rows]
    for i, w in texts:
        for p in range(len(w) - width + 1 if i is not None else 0):
            k = tuple(w[p: p + width])
            least[k] = min(least.get(k, i), i)
    for i, w in texts:
        gone = set()
        for p in range(len(w) - width + 1 if i is not None else 0):
            if least[tuple(w[p: p + width])] < i:
                gone.update(range(p, p + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), sha(kept), kept))
    return sorted(out, key=str)


def word_rows():
    """Short vocabularies, so that paths branch, cross and repeat inside a text; copies and ties."""
    rng = np.random.default_rng(11)
    rows = [(int(i), " ".join(rng.choice(["a", "b", "c"], int(rng.integers(0, 60))))) for i in range(40)]
    rows += [(90 + i, " ".join(["same"] * i)) for i in range(20)] + [(3, rows[3][1]), (3, rows[7][1] + " tail"), (None, rows[8][1])]
    return [(i, t, "s") for i, t in rows] + [(300 + i, rows[30][1] + " x", "s") for i in range(25)]


@pytest.mark.parametrize("rows,width", [(fx.texts(), 13), (word_rows(), 13), (word_rows(), 6)])
def test_debruijn_dedup(spark, rows, width):
    got = debruijn.deduplicate(fx.frame(spark, rows), width=width, texts=True).collect()
    assert sorted(map(tuple, got), key=str) == cut_words(rows, width)


def test_debruijn_paths_compact(spark):
    """Text 2 shares one long run with text 1; nothing branches, so it is one span."""
    shared = fx.prose(50, 80)
    rows = debruijn._rows(fx.frame(spark, [(1, fx.prose(51, 30) + " " + shared, "s"), (2, shared + " " + fx.prose(52, 30), "s")]), 1)
    spans = debruijn.repeated_spans(rows, 13, 1).collect()
    assert [(r.doc_id, r.at & 0xFFFFFFFF, r.n, r.src, r.src_at & 0xFFFFFFFF) for r in spans] == [(2, 0, 68, 1, 30)]


def test_false_claims_are_refused(spark):
    """A span whose words differ from its source's is counted and removes nothing."""
    rows = debruijn._rows(fx.frame(spark, [(1, fx.prose(60, 40), "s"), (2, fx.prose(61, 40), "s")]), 1)
    at = F.shiftleft("twin", 32)
    claim = rows.filter("doc_id = 2").select("doc_id", at.alias("at"), F.lit(3).cast("long").alias("n"), F.lit(b"0" * 16).alias("spelled"))
    out = {r.doc_id: r for r in debruijn._cut(rows, claim, 13, False).collect()}
    assert out[2].n_failed == 1 and out[2].n_removed == 0 and out[1].n_failed == 0


def test_empty_tables(spark):
    none = fx.frame(spark, [])
    assert debruijn.deduplicate(none).count() == 0 and wavelet_fim.transform(none).count() == 0


# -- registered queries -------------------------------------------------------------------------------------------

def test_queries_equal_their_sql(spark, sf_dir):
    keys = ["op11_wavelet_fim", "op12_butterfly_manifest"]
    assert oracle_harness.compare(spark, sf_dir, keys, verbose=False) == dict.fromkeys(keys, "OK")


def test_debruijn_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_debruijn_dedup(spark, sf_dir).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == [r[:4] for r in cut_words([tuple(d) for d in docs], 13)]
    assert re.fullmatch("[0-9a-f]{64}", got[0].kept_sha256)
