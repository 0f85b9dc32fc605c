"""Personal data and the terms that give it away: information-theoretic sanitisation.

1. Personal data of fixed form (email, ip, card, phone) is found in every text.
   Its normalised values are the protected entities.
   So are the classes they belong to: an email's domain, an ip's first three
   numbers, a card's first six digits, a phone's digits but the last four.
2. A term (a word, A-Z lowered, outer ASCII punctuation cut off) co-occurs with
   every entity of its document, wherever both stand.  Over all documents the
   counts df(term), df(entity) and co(term, entity) give the share of the
   entity's information that the term discloses, PMI(term; entity) / IC(entity)
   = log(co N / (df(term) df(entity))) / log(N / df(entity)).
3. A small sample may reach any share by chance.  For each pair the chance that
   independent term and entity meet in at least as many different texts, given
   that they meet (hypergeometric tail; copies of a text with the entity are one
   witness), is bounded, and the pairs are kept that hold the rate of false
   ones at ``CHANCE`` (Benjamini-Hochberg over all pairs tested).  One text in
   common proves nothing (its chance is 1), so an entity or a term of one text
   is not paired; neither is a term too frequent to reach ``GENERALISE``.
4. A kept term that reaches ``GENERALISE`` for some entity is generalised to its
   shape wherever it stands; from ``REMOVE`` on it is removed.

Terms above the threshold are sent to the tasks in blocks of bounded size.

Defined results: null and empty texts have no spans; rows are judged one by
one, so repeated rows and null ids are each returned (each row counts as a
document); an empty table gives an empty result; other columns are not read.
Texts are searched in one pass from each possible beginning, so the time follows
the length of a text whatever it holds.
"""

from __future__ import annotations

import bisect
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm import text as T
from eventide.llm.components import written

CHANCE = 0.05
GENERALISE = 0.9
REMOVE = 0.97
BLOCK_TERMS = 1_000_000
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_AZ = {c: c + 32 for c in range(65, 91)}
_ANY = re.compile(r"[0-9@]")


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    for m in _DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i: i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def _cards(text: str):
    for m in _DIGITS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            yield m.start(), m.end()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.start(), m.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of personal data, by kind as listed, then start; code points, end exclusive."""
    if not _ANY.search(text):
        return []
    return [(kind, a, b) for kind, find in zip(KINDS, (_emails, _ips, _cards, _phones)) for a, b in find(text)]


def _value(kind: str, found: str) -> str:
    """An entity's normal form."""
    return f"{kind}:{found.translate(_AZ) if kind in ('email', 'ip') else re.sub('[^0-9]', '', found)}"


def _term(word: str) -> str:
    return word.translate(_AZ).strip(_EDGE)


def _merged(spans) -> tuple[list[int], list[int]]:
    """Disjoint intervals covering the (start, end) spans, ascending."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _meets(merged, a: int, b: int) -> bool:
    """True if [a, b) overlaps one of the intervals."""
    k = bisect.bisect_left(merged[0], b) - 1
    return k >= 0 and merged[1][k] > a


def _entities(text: str, spans) -> set[str]:
    """The protected values of a text and their classes."""
    out = set()
    for kind, a, b in spans:
        value = _value(kind, text[a:b])
        out.add(value)
        v = value[len(kind) + 1:]
        out.add({"email": f"email:@{v[v.index('@') + 1:]}" if kind == "email" else "", "ip": f"ip:{v.rpartition('.')[0]}.*",
                 "card": f"card:{v[:6]}*", "phone": f"phone:{v[:-4]}*"}[kind])
    return out


def _terms(text: str, spans) -> set[str]:
    """The terms of a text that stand outside all spans."""
    taken = _merged((a, b) for _, a, b in spans)
    return {t for m in _WORD.finditer(text) if not _meets(taken, *m.span()) and (t := _term(m.group()))}


def _evidence(docs: DataFrame) -> DataFrame:
    """(hash, entities, terms, n) of each different text with personal data; n: its documents."""
    def run(batches):
        for s in T.slices(batches):
            entities, terms, row = [], [], []
            for i, t in enumerate(s.column(0).to_pylist()):
                if t and (spans := base_spans(t)):
                    entities.append(sorted(_entities(t, spans)))
                    terms.append(sorted(_terms(t, spans)))
                    row.append(i)
            if row:
                yield pa.RecordBatch.from_arrays(
                    [s.column(1).take(pa.array(row)), pa.array(entities, pa.list_(pa.string())),
                     pa.array(terms, pa.list_(pa.string()))], names=["hash", "entities", "terms"])
    return (docs.select("text", F.xxhash64("text").alias("hash"))
            .mapInArrow(run, "hash long, entities array<string>, terms array<string>")
            .groupBy("hash").agg(F.first("entities").alias("entities"), F.first("terms").alias("terms"),
                                 F.count("*").alias("n")))


def term_hashes(words: list[str]) -> np.ndarray:
    buf, offs = T.as_bytes(pa.array(words, pa.string()))
    return T.span_hashes(buf, offs[:-1], offs[1:])


def _trimmed(buf, offs):
    """Words of a slice, lowered and without outer ASCII punctuation: row bounds, byte bounds, non-empty mask."""
    w = T.Words(buf, offs, lower=True)
    edge = np.zeros(256, bool)
    edge[[ord(c) for c in _EDGE]] = True
    inner = np.flatnonzero(~edge[w.buf] & w.inside)
    if len(inner) == 0:
        return w, w.start, w.start, np.zeros(len(w.start), bool)
    first = np.searchsorted(inner, w.start)
    last = np.searchsorted(inner, w.end) - 1
    some = last >= first
    start = np.where(some, inner[np.minimum(first, len(inner) - 1)], w.start)
    end = np.where(some, inner[np.maximum(last, 0)] + 1, w.start)
    return w, start, end, some


def _document_counts(docs: DataFrame) -> DataFrame:
    """(term_hash, df): documents that hold each term, pre-aggregated by slice."""
    def run(batches):
        for s in T.slices(batches):
            w, start, end, some = _trimmed(*T.as_bytes(s.column(0)))
            h = T.span_hashes(w.buf, start[some], end[some])
            rows = w.rows[some]
            order = np.lexsort((rows, h))
            h, rows = h[order], rows[order]
            if len(h) == 0:
                continue
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
            value, n = np.unique(h[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], names=["term_hash", "n"])
    return (docs.select("text").mapInArrow(run, "term_hash long, n long")
            .groupBy("term_hash").agg(F.sum("n").alias("df")))


def _log_choose(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """log of the binomial coefficients; -inf where k is not in 0..n."""
    ok = (k >= 0) & (k <= n)
    n, k = np.where(ok, n, 0).astype(float), np.where(ok, k, 0).astype(float)
    lg = np.frompyfunc(math.lgamma, 1, 1)
    return np.where(ok, (lg(n + 1) - lg(k + 1) - lg(n - k + 1)).astype(float), -np.inf)


def log_chance(met: np.ndarray, entity: np.ndarray, term: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """log10 of a bound on P(X >= met | X >= 1), X the common texts of independent sets of these sizes."""
    met, entity, term, texts = (np.asarray(x, np.int64) for x in (met, entity, term, texts))
    every = _log_choose(texts, term)
    at = _log_choose(entity, met) + _log_choose(texts - entity, term - met) - every
    step = (entity - met) * (term - met) / ((met + 1) * np.maximum(texts - entity - term + met + 1, 1))   # next over this
    with np.errstate(divide="ignore", invalid="ignore"):
        tail = at - np.log1p(-np.minimum(step, 1.0))        # the ratios fall, so a geometric sum bounds the tail
        any_ = np.log(-np.expm1(np.minimum(_log_choose(texts - entity, term) - every, 0.0)))
        out = np.where((met < 2) | (step >= 1), 0.0, tail - any_)
    return np.minimum(np.nan_to_num(out, nan=0.0, posinf=0.0, neginf=-690.0), 0.0) / math.log(10)


def _last_bin(bins: list[tuple[int, int]], tested: int, rate: float) -> int | None:
    """The highest of the ascending (bin, pairs) that Benjamini-Hochberg accepts; bin b ends at 10 ** ((b + 1) / 100)."""
    kept, out = 0, None
    for b, n in bins:
        kept += n
        if 10 ** ((b + 1) / 100) * tested <= rate * kept:
            out = b
    return out


def tested_pairs(docs: DataFrame, n: int, generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, co, met, df, df_entity, bin) of all pairs tested; met: different texts in common, bin: 100 log10 of the chance."""
    spark = docs.sparkSession
    seen = written(spark, _evidence(docs), "pii-evidence")
    at = seen.select("hash", "n", F.explode("entities").alias("entity"))
    entities = (at.groupBy("entity").agg(F.sum("n").alias("df_entity"), F.count("*").alias("texts"))
                .filter((F.col("texts") > 1) & (F.col("df_entity") < n)))
    at = written(spark, at.join(entities, "entity"), "pii-entities")
    none = "entity string, term string, co long, met long, df long, df_entity long, bin int"
    if at.isEmpty():
        return spark.createDataFrame([], none)

    def hashed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(term_hashes(b.column(1).to_pylist()).view(np.int64))],
                                             names=["hash", "term", "term_hash"])

    words = (seen.join(at.select("hash").distinct(), "hash", "left_semi").select("hash", F.explode("terms").alias("term"))
             .mapInArrow(hashed, "hash long, term string, term_hash long"))
    words = words.join(_document_counts(docs).filter("df > 1"), "term_hash").select("hash", "term", "df")
    reach = F.col("df_entity") * F.pow(F.lit(float(n)) / F.col("df_entity"), F.lit(1 - generalise))
    pairs = (at.join(words, "hash").filter(F.col("df") <= reach + 1e-6).groupBy("entity", "term")
             .agg(F.sum("n").alias("co"), F.count("*").alias("met"), F.first("df").alias("df"),
                  F.first("df_entity").alias("df_entity"), F.first("texts").alias("texts")))

    def judged(batches):
        for b in batches:
            co, met, df, df_entity, texts = (b.column(i).to_numpy() for i in range(2, 7))
            chance = log_chance(met, texts, df - (co - met), n - (df_entity - texts))
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(np.floor(100 * chance).astype(np.int32))],
                                             names=["entity", "term", "co", "met", "df", "df_entity", "bin"])

    return written(spark, pairs.mapInArrow(judged, none), "pii-pairs")


def disclosing_terms(docs: DataFrame, generalise: float = GENERALISE, chance: float = CHANCE) -> DataFrame:
    """(term, disclosure): the largest share of an entity's information that the term discloses, where above the bound."""
    n = docs.count()
    pairs = tested_pairs(docs, n, generalise)
    bins = sorted(tuple(r) for r in pairs.groupBy("bin").count().collect())      # at most 30,001 rows
    last = _last_bin(bins, sum(c for _, c in bins), chance)
    if last is None:
        return docs.sparkSession.createDataFrame([], "term string, disclosure double")
    share = (F.log(F.col("co") * F.lit(float(n)) / (F.col("df") * F.col("df_entity")))
             / F.log(F.lit(float(n)) / F.col("df_entity")))
    return (pairs.filter(F.col("bin") <= last).groupBy("term").agg(F.max(share).alias("disclosure"))
            .filter(F.col("disclosure") >= generalise))


def _shape(word: str) -> str:
    """A generalised word: letters as a, capitals as A, digits as 0."""
    return "".join("0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in word)


def _masked(text: str, spans, removes) -> str:
    out, done = [], 0
    for a, b, kind in sorted((a, -b, k) for k, a, b in spans):
        b = -b
        if a < done:
            if b > done:
                done = b
            continue
        out.append(text[done:a])
        out.append(f"[{kind.upper()}]" if kind != "term" else "[TERM]" if _term(text[a:b]) in removes else _shape(text[a:b]))
        done = b
    return "".join(out) + text[done:]


def sanitise(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, chance: float = CHANCE,
             texts: bool = True, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(doc_id, spans, sanitised) of every document.

    ``spans`` lists (kind, start, end) in code points: personal data by kind,
    then disclosing terms (kind ``term``), each by start.
    """
    spark = docs.sparkSession
    terms = written(spark, disclosing_terms(docs, generalise, chance), "pii-terms")
    blocks = -(-terms.count() // block_terms)
    span = "array<struct<kind:string,start:long,end:long>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(None).cast(span).alias("spans"),
                       F.lit(None).cast("array<string>").alias("removed"))
    schema = f"doc_id long, text string, spans {span}, removed array<string>"

    def finder(block, first):
        known = dict(block.value) if block is not None else {}
        hashes = np.sort(term_hashes(list(known)))

        def run(batches):
            for s in T.slices(batches):
                hit = set()
                if len(hashes):
                    w, start, end, some = _trimmed(*T.as_bytes(s.column(1)))
                    h = T.span_hashes(w.buf, start[some], end[some])
                    found = hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h
                    hit = set(w.rows[some][found].tolist())
                spans, removed = [], []
                old, gone = (None, None) if first else (s.column(2).to_pylist(), s.column(3).to_pylist())
                for i, t in enumerate(s.column(1).to_pylist()):
                    here = [{"kind": k, "start": a, "end": b} for k, a, b in base_spans(t or "")] if first else old[i]
                    cut = [] if first else gone[i]
                    if i in hit:
                        base = _merged((x["start"], x["end"]) for x in here if x["kind"] != "term")
                        for m in _WORD.finditer(t):
                            core = _term(m.group())
                            if core in known:
                                a = m.start() + len(m.group()) - len(m.group().lstrip(_EDGE))
                                b = a + len(core)
                                if not _meets(base, a, b):
                                    here.append({"kind": "term", "start": a, "end": b})
                                    if known[core] >= remove:
                                        cut.append(core)
                    spans.append(here)
                    removed.append(cut)
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array(spans, kind),
                                                  pa.array(removed, pa.list_(pa.string()))],
                                                 names=["doc_id", "text", "spans", "removed"])
        return run

    for k in range(max(1, blocks)):
        block = None
        if blocks:      # bounded: block_terms terms at a time
            part = terms.filter(F.pmod(F.xxhash64("term"), F.lit(blocks)) == k)
            block = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        rows = rows.mapInArrow(finder(block, k == 0) if block is None else _lazy(finder, block, k == 0), schema)

    def finish(batches):
        for b in batches:
            spans, out = [], []
            for t, here, gone in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                here = sorted(here, key=lambda x: (KINDS.index(x["kind"]) if x["kind"] in KINDS else len(KINDS), x["start"]))
                spans.append(here)
                if texts:
                    out.append(None if t is None else _masked(t, [(x["kind"], x["start"], x["end"]) for x in here], set(gone)))
            cols = [b.column(0), pa.array(spans, kind)] + ([pa.array(out, pa.string())] if texts else [])
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "spans", "sanitised"][: len(cols)])

    return rows.mapInArrow(finish, f"doc_id long, spans {span}" + (", sanitised string" if texts else ""))


def _lazy(finder, block, first):
    """The finder, with its block read inside the task."""
    def run(batches):
        yield from finder(block, first)(batches)
    return run
