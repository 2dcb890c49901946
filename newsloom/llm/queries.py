"""Queries of the training-text problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import boilerplate, canon, leakage, mixing, neardup, residue, spans, topn, truncation
from newsloom.runtime import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return canon.equal_looking_pairs(table(spark, d, "raw_items"), "ingest_seq", ["title", "summary"])


def p1_canonical(spark: SparkSession, d: str) -> DataFrame:
    return canon.canonicalise(table(spark, d, "raw_items").select("ingest_seq", "title", "summary"), ["title", "summary"])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "raw_items")
    parted = residue.parted_suspects(items)
    bodies = residue.residue(items, parted=parted).filter("field_name = 'body_text'").select("ingest_seq")
    lines = parted[0].select(F.col("id").alias("ingest_seq"), F.explode("gone").alias("line_no"))
    return lines.join(bodies, "ingest_seq", "left_anti")


def p2_main_text(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.main_text(table(spark, d, "raw_items"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return topn.best_ranked(table(spark, d, "raw_items")).select("source_id", "rank_section", "ingest_seq")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_values(table(spark, d, "raw_items"), "ingest_seq", ["title", "summary"]).select("ingest_seq", "field_name")


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "raw_items")
    cuts = truncation.cut_values(items, "ingest_seq", ["title", "summary"])
    return truncation.cut_rates(items, cuts, "ingest_seq", "source_id", ["title", "summary"])


def p4_reasons(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_values(table(spark, d, "raw_items"), "ingest_seq", ["title", "summary"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "raw_items"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.pairs_within(neardup.story_groups(table(spark, d, "raw_items")), "ingest_seq")


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.story_groups(table(spark, d, "raw_items"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_windows(table(spark, d, "documents"), table(spark, d, "benchmark"), "doc_id", "item_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).filter("exact > 0").select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p8_reparameterised(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).filter("exact = 0").select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "changed")


def p8_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(_leaks(spark, d))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(*mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets")))


def p9_promises(spark: SparkSession, d: str) -> DataFrame:
    """Whether the mixture keeps to its caps and goals; the SQL says that every target with documents must."""
    docs = table(spark, d, "documents")
    return mixing.kept_promises(docs, *mixing.mixture(docs, table(spark, d, "mix_targets")))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.sharing_documents(table(spark, d, "documents"), "doc_id", "text")


def p10_shared(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_amount(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p1_found, p1_canonical, p2_found, p2_main_text, p3_found, p4_found, p4_rates, p4_reasons, p5_found, p6_found, p6_groups, p8_found, p8_reparameterised, p8_leaked_items, p9_mixture, p9_shares, p9_promises, p10_found, p10_shared)}
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
# the SQL's own letters, by the order of the Latin ones they are drawn like
_FROM = "ёѐїӧӓ" + _WIDE + "АВСЕНІЈКМОРЅТХУасԁеһіјорԛѕԝху" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνορ"
_TO = "ëèïöä" + "".join(chr(ord(c) - 0xFEE0) for c in _WIDE) + "ABCEHIJKMOPSTXYacdehijopqswxy" + "ABEZHIKMNOPTYXvop"
_TO = _TO.replace("'", "''")  # inside a literal

_STORY_GROUPS = f"""
        WITH RECURSIVE c AS (SELECT ingest_seq, coalesce(title, '') || ' ' || coalesce(summary, '') AS v FROM raw_items),
             t AS (SELECT ingest_seq, translate(regexp_replace(v, '[\\x{{AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}\\x{{FEFF}}]', '', 'g'), '{_FROM}', '{_TO}') AS x FROM c),
             k AS (SELECT ingest_seq, trim(regexp_replace(lower(nfc_normalize(replace(replace(replace(x, 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'))), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS f FROM t),
             r AS (SELECT f, min(ingest_seq) AS d FROM k WHERE length(f) >= 80 GROUP BY 1),
             g AS (SELECT DISTINCT d, substr(f, i, 3) AS x FROM (SELECT d, f, unnest(generate_series(1, length(f) - 2)) AS i FROM r) u),
             n AS (SELECT d, count(*) AS n FROM g GROUP BY 1),
             o AS (SELECT a.d AS a, b.d AS b, count(*) AS m FROM g a JOIN g b ON a.x = b.x AND a.d < b.d GROUP BY 1, 2),
             e AS (SELECT o.a, o.b FROM o JOIN n p ON p.d = o.a JOIN n q ON q.d = o.b WHERE o.m >= 0.65 * (p.n + q.n - o.m) - 1e-9),
             y AS (SELECT a AS s, b AS t FROM e UNION ALL SELECT b, a FROM e),
             z(d, c) AS (SELECT d, d FROM r UNION SELECT y.t, z.c FROM z JOIN y ON y.s = z.d),
             w AS (SELECT d, min(c) AS c FROM z GROUP BY 1),
             i AS (SELECT k.ingest_seq, w.c FROM k JOIN r ON k.f = r.f JOIN w ON w.d = r.d)"""

ORACLE: dict[str, str] = {
    "p9_promises": "SELECT DISTINCT source, true AS within_cap, true AS within_goal, true AS known, true AS once FROM mix_targets WHERE source IN (SELECT source FROM documents) AND target_share > 0 AND max_repeats > 0",
    "p3_found": """
        SELECT source_id, rank_section, ingest_seq FROM (
          SELECT source_id, rank_section, ingest_seq, row_number() OVER (
            PARTITION BY source_id, rank_section ORDER BY rank_position ASC, fetched_at DESC NULLS LAST, ingest_seq ASC) AS rn
          FROM raw_items WHERE rank_position >= 1 AND rank_section IS NOT NULL AND rank_section <> '') t
        WHERE rn <= 5""",
    "p8_found": """
        WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}]+'), lambda x: lower(x)) AS w FROM documents),
             b AS (SELECT item_id, list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}]+'), lambda x: lower(x)) AS w FROM benchmark),
             dw AS (SELECT doc_id, array_to_string(w[i:i + 11], ' ') AS k FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 12) t),
             bw AS (SELECT item_id, array_to_string(w[i:i + 11], ' ') AS k FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 11)) AS i FROM b WHERE len(w) >= 12) t)
        SELECT DISTINCT doc_id, item_id FROM dw JOIN bw USING (k)""",
    "p10_found": """
        WITH w AS (SELECT doc_id, md5(substr(text, i, 300)) AS h FROM (SELECT doc_id, text, unnest(generate_series(1, length(text) - 299)) AS i FROM documents WHERE length(text) >= 300) t),
             d AS (SELECT DISTINCT doc_id, h FROM w), m AS (SELECT h FROM d GROUP BY h HAVING count(*) > 1), k AS (SELECT d.* FROM d SEMI JOIN m USING (h))
        SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM k a JOIN k b ON a.h = b.h AND a.doc_id < b.doc_id""",
    "p10_shared": """
        WITH w AS (SELECT doc_id, i, md5(substr(text, i, 300)) AS h FROM (SELECT doc_id, text, unnest(generate_series(1, length(text) - 299)) AS i FROM documents WHERE length(text) >= 300) t),
             m AS (SELECT h FROM w GROUP BY h HAVING count(DISTINCT doc_id) > 1),
             k AS (SELECT doc_id, lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i AS gap FROM w SEMI JOIN m USING (h)),
             s AS (SELECT doc_id, sum(least(coalesce(gap, 300), 300))::INT AS shared_chars, count(*) FILTER (WHERE coalesce(gap, 301) > 300)::INT AS n_spans FROM k GROUP BY 1)
        SELECT doc_id, coalesce(length(text), 0)::INT AS n_chars, coalesce(shared_chars, 0) AS shared_chars, coalesce(n_spans, 0) AS n_spans,
               CASE WHEN length(text) > 0 THEN coalesce(shared_chars, 0) / length(text) ELSE 0.0 END AS share
        FROM documents LEFT JOIN s USING (doc_id)""",
    # the same equivalence by other means: width and look-alike letters by translation, all to Latin
    "p1_found": f"""
        WITH c AS (SELECT ingest_seq, 'title' AS field_name, title AS v FROM raw_items WHERE title <> '' UNION ALL SELECT ingest_seq, 'summary', summary FROM raw_items WHERE summary <> ''),
             t AS (SELECT ingest_seq, field_name, v, translate(regexp_replace(v, '[\\x{{AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}\\x{{FEFF}}]', '', 'g'), '{_FROM}', '{_TO}') AS x FROM c),
             k AS (SELECT ingest_seq, field_name, v, trim(regexp_replace(nfc_normalize(replace(replace(replace(x, 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl')), '[\\s\\p{{Z}}]+', ' ', 'g')) AS f FROM t)
        SELECT a.field_name, a.ingest_seq AS ingest_seq_a, b.ingest_seq AS ingest_seq_b FROM k a JOIN k b ON a.field_name = b.field_name AND a.f = b.f AND a.ingest_seq < b.ingest_seq AND a.v <> b.v""",
    "p6_found": f"""{_STORY_GROUPS}
        SELECT a.ingest_seq AS ingest_seq_a, b.ingest_seq AS ingest_seq_b FROM i a JOIN i b ON a.c = b.c AND a.ingest_seq < b.ingest_seq""",
    "p6_groups": f"""{_STORY_GROUPS}
        SELECT i.ingest_seq, i.c AS group_id, coalesce(l.n, 0)::INT AS n_links FROM i JOIN k ON k.ingest_seq = i.ingest_seq JOIN r ON r.f = k.f LEFT JOIN (SELECT s, count(*) AS n FROM y GROUP BY 1) l ON l.s = r.d""",
}
