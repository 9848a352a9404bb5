"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ann, hard_negatives, license_scan, line_dedup, merkle, packing, periodic, quality, sentencepiece, simhash, suffix_dedup, url_filter, warc
from .common import NULL_ID, table

PACKING_TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def q_op1(spark, sf) -> DataFrame:
    return sentencepiece.digest(table(spark, sf, "documents"), tokenizer_path(PIECES))


def q_op2(spark, sf) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"))


def q_op3(spark, sf) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def q_op4(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return line_dedup.drop_lines(docs).select("doc_id", "source", "n_lines", "n_dropped", "text")


def q_op5(spark, sf) -> DataFrame:
    return packing.packed_digest(table(spark, sf, "documents"), tokenizer_path(PACKING_TOKENIZER))


def q_op6(spark, sf) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages"))


def q_op7(spark, sf) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents")).drop("spans")


def q_op8(spark, sf) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf, "documents"))
    hex16 = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return out.select(F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), hex16("fp").alias("fingerprint"), F.col("component").alias("component_id"), hex16("root").alias("group_fingerprint"))


def q_op9(spark, sf) -> DataFrame:
    return ann.search(table(spark, sf, "embeddings"))


def q_op10(spark, sf) -> DataFrame:
    out = warc.round_trip(table(spark, sf, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_op11(spark, sf) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    finite = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    seven = F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False))
    rows = rows.where(finite).select(
        F.col("vec_id").alias("id"), F.when(seven, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double"))).alias("vector"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def q_op12(spark, sf) -> DataFrame:
    out = merkle.edited_fingerprints(table(spark, sf, "documents"))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), merkle.fingerprint(F.col("tree")).alias("fingerprint"),
        merkle.fingerprint(F.col("edited_tree")).alias("edited_fingerprint"), "near_edited", "near_next", F.col("edit.first").cast("long").alias("edit_first"))


def repeated(key: int | None, words: list) -> list:
    """The words of a document as op13 is asked to judge them: those of every
    tenth id (by hash) repeat from some word on. A null id changes nothing."""
    h = 1 if key is None else zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def q_op13(spark, sf) -> DataFrame:
    return periodic.digest(periodic.find(table(spark, sf, "documents"), min_exponent=3, min_length=24, rewrite=repeated))


QUERIES = {
    "op1_sentencepiece": q_op1,
    "op2_quality_rules": q_op2,
    "op3_suffix_dedup": q_op3,
    "op4_line_dedup": q_op4,
    "op5_packing": q_op5,
    "op6_url_filter": q_op6,
    "op7_license_scan": q_op7,
    "op8_simhash": q_op8,
    "op9_ann_tree": q_op9,
    "op10_warc": q_op10,
    "op11_hard_negatives": q_op11,
    "op12_merkle": q_op12,
    "op13_periodic": q_op13,
}

ORACLE_SQL = {
    "op4_line_dedup": """
        WITH d AS (SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        totals AS (SELECT source, count(*) AS total FROM d GROUP BY source),
        seen AS (SELECT source, unnest(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS line FROM d),
        counts AS (SELECT source, line, count(*) AS pages FROM seen GROUP BY source, line),
        drops AS (SELECT c.source, list(line) AS gone FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
                  WHERE pages >= 2 AND pages >= total * CAST(0.1 AS DOUBLE) GROUP BY c.source),
        kept AS (SELECT d.*, list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), x)) AS stay
                 FROM d LEFT JOIN drops ON d.source IS NOT DISTINCT FROM drops.source)
        SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(lines) END AS n_lines,
               CASE WHEN text IS NULL THEN 0 ELSE len(lines) - len(stay) END AS n_dropped,
               CASE WHEN text IS NULL THEN NULL ELSE array_to_string(stay, chr(10)) END AS text
        FROM kept""",
    "op10_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest, html FROM p),
        b AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS best FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= {warc.MIN_DEDUP} AND page_id < best THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= {warc.MIN_DEDUP} AND page_id < best THEN best END AS refers_to
        FROM b""",
    "op12_merkle": f"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        o AS (SELECT *, length(text) AS n, row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(text)) AS r, count(*) OVER () AS total FROM t),
        e AS (SELECT o.*, substr(o.text, 1, o.n - o.n // 4) || substr(x.text, 1, o.n // 4) AS edited, x.r AS next FROM o JOIN o x ON x.r = o.r % o.total + 1),
        texts AS (SELECT r, 'a' AS kind, text FROM e UNION ALL SELECT r, 'b', edited FROM e),
        lines AS (SELECT r, kind, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS li FROM texts),
        words AS (SELECT r, kind, li, unnest(string_split(line, ' ')) AS w, generate_subscripts(string_split(line, ' '), 1) AS wi FROM lines),
        cuts AS (SELECT *, (CASE WHEN w = '' THEN 0 ELSE unicode(w) + length(w) END) % {merkle.PIECE} = 0 AS last FROM words),
        parts AS (SELECT *, coalesce(sum(last::INT) OVER (PARTITION BY r, kind, li ORDER BY wi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM cuts),
        pieces AS (SELECT r, kind, li, g, md5(string_agg(w, ' ' ORDER BY wi)) AS h FROM parts GROUP BY ALL),
        paragraphs AS (SELECT r, kind, li, md5(string_agg(h, '' ORDER BY g)) AS h, string_agg(left(h, 8), '' ORDER BY g) AS short FROM pieces GROUP BY r, kind, li),
        ends AS (SELECT *, coalesce(sum((left(h, 1) < '4')::INT) OVER (PARTITION BY r, kind ORDER BY li ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM paragraphs),
        sections AS (SELECT r, kind, s, md5(string_agg(h, '' ORDER BY li)) AS h, string_agg(left(h, 8) || '.' || short, ',' ORDER BY li) AS inner_ FROM ends GROUP BY r, kind, s),
        prints AS (SELECT r, kind, sha256(string_agg(h, '' ORDER BY s)) || '/' || string_agg(left(h, 8) || '=' || inner_, ';' ORDER BY s) AS fp FROM sections GROUP BY r, kind),
        counts AS (SELECT r, kind, left(h, 8) AS h, count(*) AS c FROM pieces GROUP BY r, kind, left(h, 8)),
        sizes AS (SELECT r, kind, sum(c) AS c FROM counts GROUP BY r, kind),
        pairs AS (SELECT r, 'b' AS kind, r AS other FROM e UNION ALL SELECT r, 'a', next FROM e),
        common AS (SELECT p.r, p.kind, sum(least(x.c, y.c)) AS c FROM pairs p JOIN counts x ON x.r = p.r AND x.kind = 'a'
                   JOIN counts y ON y.r = p.other AND y.kind = p.kind AND y.h = x.h GROUP BY p.r, p.kind),
        near AS (SELECT p.r, p.kind, 2.0::DOUBLE * coalesce(m.c, 0) / (x.c + y.c) AS v FROM pairs p JOIN sizes x ON x.r = p.r AND x.kind = 'a'
                 JOIN sizes y ON y.r = p.other AND y.kind = p.kind LEFT JOIN common m ON m.r = p.r AND m.kind = p.kind),
        differ AS (SELECT coalesce(x.r, y.r) AS r, min(coalesce(x.li, y.li)) - 1 AS first_ FROM (SELECT * FROM paragraphs WHERE kind = 'a') x
                   FULL JOIN (SELECT * FROM paragraphs WHERE kind = 'b') y ON x.r = y.r AND x.li = y.li WHERE left(x.h, 8) IS DISTINCT FROM left(y.h, 8) GROUP BY ALL)
        SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
               ne.v AS near_edited, nn.v AS near_next, d.first_ AS edit_first
        FROM e JOIN prints a ON a.r = e.r AND a.kind = 'a' JOIN prints b ON b.r = e.r AND b.kind = 'b'
        JOIN near ne ON ne.r = e.r AND ne.kind = 'b' JOIN near nn ON nn.r = e.r AND nn.kind = 'a' LEFT JOIN differ d ON d.r = e.r""",
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256.0 * CAST(x AS DOUBLE))) AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
                     CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
              FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
