"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm import (curriculum, debruijn, decontaminate, disclosure, merkle_butterfly, minhash_bayes, ngram_lm, perspectives,
                          quality_cascade, sharding, suffix_dedup, token_store, wavelet_fim)
from eventide.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 7 == 2
    return ngram_lm.perplexity(_table(spark, sf_dir, "documents"), held_out, order=3)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write(_table(spark, sf_dir, "documents"), path)
    return token_store.read_index(spark, path)


def op3_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sharding.assign_shards(_table(spark, sf_dir, "documents"), 8)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "start_byte"))


def op4_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(_table(spark, sf_dir, "documents"))
    out = mixed.select("doc_id", "size", "source_size", "target", "taken",
                       F.get("copies", F.lit(0))["position"].alias("position"))
    return curriculum.range_sorted(out, "position", "doc_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(_table(spark, sf_dir, "documents"))


def op7_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(_table(spark, sf_dir, "conversations"))


def op8_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.judge(_table(spark, sf_dir, "documents"), counts=True).drop("rejected_by")


def _joined(kinds: tuple[str, ...]):
    part = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(part, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.sanitise(_table(spark, sf_dir, "documents"), texts=False)

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, (*disclosure.KINDS, "term")),
                        F.sha2(_joined(disclosure.KINDS), 256).alias("base_sha256"),
                        _joined((*disclosure.KINDS, "term")).alias("spans"))


def op10_bayes_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_bayes.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def op11_wavelet_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = wavelet_fim.transform(_table(spark, sf_dir, "documents"))
    return moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(wavelet_fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_butterfly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 0
    rows = merkle_butterfly.manifest(_table(spark, sf_dir, "documents"), changed={"text": lower}, where=tampered)
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    folded = merkle_butterfly.fold(F.coalesce("other", "leaf"), F.col("proof"))
    return (rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op13_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.deduplicate(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_kneser_ney, op2_token_store, op3_byte_shards, op4_spaced_seed_decontamination,
                                   op5_curriculum_mix, op6_suffix_dedup, op7_perspective_rotation, op8_rule_cascade, op9_disclosure_pii,
                                   op10_bayes_near_dedup, op11_wavelet_fim, op12_butterfly_manifest,
                                   op13_debruijn_dedup)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_CODED = " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("i", "source", "lang", "n_chars"))

ORACLE = {
    "op5_curriculum_mix": rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(source, '') || ':' || coalesce(text, '')) AS k
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s0),
s2 AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM s1),
s3 AS (SELECT *,
  CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS room,
  CAST(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS share
  FROM s2),
s4 AS (SELECT *, cap * share <= weight * room AS is_full FROM s3),
s5 AS (SELECT *, max(CASE WHEN NOT is_full THEN CAST(room AS DOUBLE) / share END) OVER () AS level FROM s4),
s6 AS (SELECT source, source_size, rank, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE weight * level END AS target FROM s5),
p AS (SELECT d.doc_id, d.size, s6.source_size, s6.target, s6.rank, CAST(floor(s6.target + 0.5) AS BIGINT) AS want,
        CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY k ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS before
      FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source),
t AS (SELECT *,
  greatest(0, least(size, want - before)) + greatest(0, least(size, want - before - source_size))
    + greatest(0, least(size, want - before - 2 * source_size)) AS taken,
  CASE WHEN least(size, want - before) > 0 THEN CAST(before AS DOUBLE) / want END AS c
  FROM p)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE rank % 3
    WHEN 0 THEN 2 * c / (1.5 + sqrt(2.25 - 2 * c))
    WHEN 1 THEN c
    ELSE CASE WHEN c < 0.375 / 1.125
      THEN 2 * c / (0.5 / 1.125 + sqrt(0.25 / 1.265625 + 2 * c / 1.125))
      ELSE 0.5 + 2 * (c - 0.375 / 1.125) / (1 / 1.125 + sqrt(1 / 1.265625 + 4 * (c - 0.375 / 1.125) / 1.125)) END
  END AS position
FROM t""",
    "op8_rule_cascade": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) AS t(k) GROUP BY doc_id),
ln AS (SELECT doc_id, len(l) AS lines, len(l) - len(list_distinct(l)) AS dups FROM (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d)),
c AS (SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, dups AS n_dup_lines, lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS letterless,
        len(text) - len(replace(text, '!', '')) AS bangs
      FROM d JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 50 * lines OR 100 * letterless > 30 * n_words
       OR 2 * word_chars < 5 * n_words OR word_chars > 12 * n_words OR 10 * bangs > 3 * n_words) AS kept
FROM b""",
    "op11_wavelet_fim": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
        CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
        CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, '<P>' || substr(t, 1, a) AS pre, '<S>' || substr(t, b + 1) AS suf, '<M>' || substr(t, a + 1, b - a) AS mid FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN pre || suf || mid ELSE suf || pre || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p""",
    "op12_butterfly_manifest": f"""
WITH RECURSIVE f AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, CAST(doc_id AS VARCHAR) AS i, source, lang, CAST(n_chars AS VARCHAR) AS n_chars, text,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM documents),
h AS (SELECT doc_id, g, coalesce(i, '') AS i,
    sha256({_CODED} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256({_CODED} || coalesce(strlen(lower_text) || ':' || lower_text, '-')) AS other FROM f),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS cnt,
    xor(list_reduce(list_transform(range(1, length(i) + 1), lambda k: CAST(ascii(substr(i, k, 1)) AS BIGINT)),
        lambda c, b: list_reduce(range(0, 8), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
        4294967295), 4294967295) % 3 = 0 AS tampered FROM h),
n(lvl, g, idx, h, cnt) AS (
  SELECT 0, g, pos, leaf, cnt FROM l
  UNION ALL
  SELECT lvl + 1, g, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), any_value((cnt + 7) // 8) FROM n WHERE cnt > 1 GROUP BY lvl, g, idx // 8),
s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS cnt FROM n WHERE cnt = 1),
t(lvl, idx, h, cnt) AS (
  SELECT 0, pos, subroot, cnt FROM s
  UNION ALL
  SELECT lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), any_value((cnt + 7) // 8) FROM t WHERE cnt > 1 GROUP BY lvl, idx // 8),
near AS (
  SELECT l.g, l.pos, n.lvl AS step, coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx < l.pos // (8 ** n.lvl)::BIGINT), '') AS a,
    coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx > l.pos // (8 ** n.lvl)::BIGINT), '') AS b
  FROM l JOIN n ON n.g = l.g AND n.cnt > 1 AND n.idx // 8 = l.pos // (8 ** n.lvl)::BIGINT // 8 GROUP BY l.g, l.pos, n.lvl),
far AS (
  SELECT s.g, 1000 + t.lvl AS step, coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx < s.pos // (8 ** t.lvl)::BIGINT), '') AS a,
    coalesce(string_agg(t.h, '' ORDER BY t.idx) FILTER (t.idx > s.pos // (8 ** t.lvl)::BIGINT), '') AS b
  FROM s JOIN t ON t.cnt > 1 AND t.idx // 8 = s.pos // (8 ** t.lvl)::BIGINT // 8 GROUP BY s.g, t.lvl),
steps AS (SELECT * FROM near UNION ALL SELECT l.g, l.pos, step, a, b FROM l JOIN far ON far.g = l.g),
path AS (SELECT g, pos, list(a || '|' || b ORDER BY step) AS p, string_agg(a || b, '' ORDER BY step) AS sib FROM steps GROUP BY g, pos),
r AS (
  SELECT l.doc_id, l.leaf, s.subroot, (SELECT h FROM t WHERE cnt = 1) AS root, sha256(coalesce(sib, '')) AS proof_sha256,
    list_reduce(coalesce(p, []), lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2)),
      CASE WHEN l.tampered THEN l.other ELSE l.leaf END) AS folded_root
  FROM l JOIN s ON s.g = l.g LEFT JOIN path ON path.g = l.g AND path.pos = l.pos)
SELECT *, folded_root = root AS verified FROM r""",
}
