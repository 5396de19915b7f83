"""The queries of this package by name, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.ann import nearest
from tillwork.llm.decontaminate import contaminated
from tillwork.llm.lm import lattice_scores
from tillwork.llm.main_text import main_texts
from tillwork.llm.mixture import mixture
from tillwork.llm.near_dups import near_duplicates
from tillwork.llm.negatives import hard_negatives
from tillwork.llm.repair import damaged, repair
from tillwork.llm.secret_scan import (
    ACCESS,
    ALLOWED,
    ASSIGN,
    CANDIDATE,
    HEX,
    HEX_BITS,
    KINDS,
    LEAST,
    MIXED_BITS,
    WINDOW,
    as_text,
    find_secrets,
)
from tillwork.llm.substrings import remove_repeats
from tillwork.llm.suffixes import remove_repeated_bytes
from tillwork.llm.toxicity import toxicity
from tillwork.llm.url_rules import judge, labelled_urls, mine

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def op1_secrets(spark: SparkSession, d: str) -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return find_secrets(_documents(spark, d)).select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def op2_main_text(spark: SparkSession, d: str) -> DataFrame:
    pages = spark.read.parquet(f"{d}/pages.parquet")
    return main_texts(pages).withColumn("n_chars", F.length("text").cast("long"))


def op3_lattice_scores(spark: SparkSession, d: str) -> DataFrame:
    return lattice_scores(_documents(spark, d))


def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return contaminated(_documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"))


def op5_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture(_documents(spark, d))


def op6_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(_documents(spark, d), shingle=3, percent=85)


def op7_url_rules(spark: SparkSession, d: str) -> DataFrame:
    pages = spark.read.parquet(f"{d}/pages.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return judge(pages, mine(labelled_urls(pages, labels)))


def op8_nearest_neighbours(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/embeddings.parquet")
    return nearest(rows, F.col("vec_id") % 100 == 0)


def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity(_documents(spark, d), spark.read.parquet(f"{d}/labels.parquet"))


def op10_repeated_passages(spark: SparkSession, d: str) -> DataFrame:
    return remove_repeats(_documents(spark, d), window=50).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op11_repeated_bytes(spark: SparkSession, d: str) -> DataFrame:
    return remove_repeated_bytes(_documents(spark, d), length=50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/embeddings.parquet")
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{d}/conversations.parquet")))


QUERIES: dict[str, Query] = {
    "op1_secrets": op1_secrets,
    "op2_main_text": op2_main_text,
    "op3_lattice_scores": op3_lattice_scores,
    "op4_decontamination": op4_decontamination,
    "op5_mixture": op5_mixture,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_url_rules": op7_url_rules,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_toxicity": op9_toxicity,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_repeated_bytes": op11_repeated_bytes,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_repair": op13_conversation_repair,
}


def _spans_sql(kind: str, pattern: str, least: int, value: int) -> str:
    together = rf"(?s)(.*?)({pattern}|\z)".replace("'", "''")
    return f"""
        SELECT rid, doc_id, {KINDS.index(kind)} AS rank, '{kind}' AS kind, hit, value,
               CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY rid ORDER BY i)
                    AS BIGINT) AS until
        FROM (SELECT rid, doc_id, unnest(gaps) AS gap, unnest(hits) AS hit,
                     unnest(vals) AS value, unnest(range(len(gaps))) AS i
              FROM (SELECT rid, doc_id, regexp_extract_all(text, '{together}', 1) AS gaps,
                           regexp_extract_all(text, '{together}', 2) AS hits,
                           regexp_extract_all(text, '{together}', {value}) AS vals FROM docs))
        QUALIFY length(value) >= {least}"""


def _secrets_sql() -> str:
    allowed = " OR ".join(
        "regexp_matches(hit, '{}')".format(p.replace("'", "''")) for p in ALLOWED
    )
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text
                      FROM documents),
        base AS ({_spans_sql("assign", ASSIGN, LEAST["assign"], 4)}
            UNION ALL {_spans_sql("access", ACCESS, LEAST["access"], 2)}
            UNION ALL {_spans_sql("hex", HEX, LEAST["hex"], 2)}),
        candidates AS ({_spans_sql("entropy", CANDIDATE, 1, 2)}),
        added AS (
            SELECT * FROM candidates c
            WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = c.rid
                    AND b.until - length(b.hit) < c.until AND c.until - length(c.hit) < b.until)
              AND NOT ({allowed})
              AND list_max(list_transform(range(1, length(hit) - {WINDOW} + 2), lambda i:
                    list_aggregate(string_split(substr(hit, i, {WINDOW}), ''), 'entropy')))
                  > CASE WHEN regexp_matches(hit, '^([0-9a-f]+|[0-9A-F]+)$')
                         THEN {HEX_BITS} ELSE {MIXED_BITS} END),
        spans AS (
            SELECT rid, rank, kind, until - length(hit) AS begins,
                   kind || ':' || (until - length(hit)) || ':' || until AS span
            FROM (SELECT * FROM base UNION ALL SELECT * FROM added)),
        listed AS (
            SELECT rid, count(*) FILTER (WHERE rank = 0) AS n_assign,
                   count(*) FILTER (WHERE rank = 1) AS n_access,
                   count(*) FILTER (WHERE rank = 2) AS n_hex,
                   count(*) FILTER (WHERE rank = 3) AS n_entropy,
                   string_agg(span, ',' ORDER BY begins, rank) FILTER (WHERE rank < 3) AS base,
                   string_agg(span, ',' ORDER BY begins, rank) AS spans
            FROM spans GROUP BY rid)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, coalesce(n_entropy, 0) AS n_entropy,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN listed USING (rid)"""


ORACLE: dict[str, str] = {
    "op5_mixture": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' ||
                        coalesce(text, '')), 1, 15) AS BIGINT) AS draw
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                        WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
            FROM sized GROUP BY source),
        filled AS (
            SELECT *, 2 * source_size AS most, 2 * source_size / weight AS fills_at,
                   1.5::DOUBLE * sum(source_size) OVER () AS budget FROM sources),
        held AS (
            SELECT *, sum(most) OVER w + fills_at * (sum(weight) OVER () - sum(weight) OVER w)
                      <= budget AS held
            FROM filled WINDOW w AS (ORDER BY fills_at)),
        targets AS (
            SELECT source, source_size, CASE WHEN held THEN CAST(most AS DOUBLE) ELSE
                   (budget - coalesce(sum(most) FILTER (WHERE held) OVER (), 0)) * weight
                   / (sum(weight) FILTER (WHERE NOT held) OVER ()) END AS target
            FROM held),
        needs AS (
            SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT)
                      ELSE 0 END AS whole FROM targets),
        running AS (
            SELECT d.doc_id, d.size, n.source_size, n.target, n.whole,
                   n.target - n.whole * n.source_size AS need,
                   sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw) AS until,
                   sum(d.size) OVER (PARTITION BY d.source, d.draw) AS alike
            FROM sized d JOIN needs n ON d.source IS NOT DISTINCT FROM n.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(size * (whole + CASE WHEN until <= need THEN 1
                    WHEN until - alike <= need AND until - need < need - (until - alike) THEN 1
                    ELSE 0 END) AS BIGINT) AS taken
        FROM running""",
    "op1_secrets": _secrets_sql(),
    # Compares all pairs that share a shingle, and follows all links.
    "op6_near_duplicates": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i
                  FROM split WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS u, b.doc_id AS v
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
        reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.other),
        least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id,
               doc_id = component_id AS kept
        FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)""",
    "op10_repeated_passages": r"""
        WITH split AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        windows AS (
            SELECT rid, doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS s
            FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM split)),
        first AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
        repeated AS (SELECT rid, i FROM windows JOIN first USING (s) WHERE least < doc_id),
        covered AS (
            SELECT rid, word, t.i, coalesce(max(CASE WHEN r.i IS NOT NULL THEN 1 ELSE 0 END)
                   OVER (PARTITION BY rid ORDER BY t.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
                   0) AS gone
            FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split) t
            LEFT JOIN repeated r USING (rid, i)),
        kept AS (
            SELECT rid, count(*) FILTER (WHERE gone = 1) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS text
            FROM covered GROUP BY rid)
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (rid)""",
    "op11_repeated_bytes": """
        WITH split AS (
            SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h
            FROM documents),
        strings AS (
            -- Parts of 200 starts, as substr() counts from the beginning of what it is given.
            SELECT rid, doc_id, 200 * k + j AS i, md5(substr(part, 2 * j + 1, 100)) AS s
            FROM (SELECT rid, doc_id, k, part, unnest(range(length(part) // 2 - 49)) AS j
                  FROM (SELECT rid, doc_id, k, substr(h, 400 * k + 1, 498) AS part
                        FROM (SELECT *, unnest(range(length(h) // 400 + 1)) AS k FROM split)))),
        first AS (SELECT s, min(doc_id) AS least FROM strings GROUP BY s),
        repeated AS (SELECT rid, i FROM strings JOIN first USING (s) WHERE least < doc_id),
        bytes AS (
            SELECT rid, unnest(regexp_extract_all(h, '..')) AS b, unnest(range(length(h) // 2)) AS i
            FROM split),
        covered AS (
            SELECT rid, b, i, coalesce(max(CASE WHEN r.i IS NOT NULL THEN 1 ELSE 0 END)
                   OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
                   0) AS gone
            FROM bytes LEFT JOIN repeated r USING (rid, i)),
        runs AS (
            SELECT *, gone = 1 AND lag(gone, 1, 0) OVER (PARTITION BY rid ORDER BY i) = 0 AS begins
            FROM covered),
        kept AS (
            SELECT rid, count(*) FILTER (WHERE gone = 1) AS n_removed,
                   count(*) FILTER (WHERE begins) AS n_spans,
                   string_agg(b, '' ORDER BY i) FILTER (WHERE gone = 0) AS h
            FROM runs GROUP BY rid)
        SELECT doc_id, length(split.h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
               coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
        FROM split LEFT JOIN kept USING (rid)""",
    "op12_hard_negatives": """
        WITH usable AS (
            SELECT DISTINCT vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
                   CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id,
               positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY rank <= 5""",
    "op13_conversation_repair": r"""
        WITH filled AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' ||
                       coalesce(CAST(turn AS VARCHAR), ' '), ''),
                       lambda c: CAST(ascii(c) AS BIGINT)) AS key
            FROM conversations),
        drawn AS (
            SELECT *, xor(list_reduce(key, lambda c, b: list_reduce(range(8),
                       lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
                       4294967295), 4294967295) % 20 AS draw FROM filled),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
                   CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END
                       AS text,
                   unnest(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM drawn),
        placed AS (
            SELECT *, row_number() OVER w AS place,
                   lag(left(role, 1)) OVER w || left(role, 1) AS pair,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
                   row_number() OVER (PARTITION BY conv_id, role, text
                                      ORDER BY turn NULLS FIRST, copy) > 1 AS again
            FROM damaged
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
        faulty AS (
            SELECT *, body = '' AS blank, body <> '' AND again AS duplicate,
                   body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated
            FROM placed),
        counted AS (
            SELECT conv_id,
                   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (WHERE blank) AS blank,
                   count(*) FILTER (WHERE duplicate) AS duplicate,
                   count(*) FILTER (WHERE truncated) AS truncated,
                   count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
                   list({'i': left(role, 1), 'go': blank OR duplicate,
                         'more': CASE WHEN truncated THEN 3 ELSE 0 END} ORDER BY place) AS turns
            FROM faulty GROUP BY conv_id),
        -- The cheapest edits into each state of the grammar (nothing, s, u, a), row by row.
        solved AS (
            SELECT *, list_reduce(turns, lambda b, t: list_transform([list_transform([list_min([b[3],
                    {'c': b[1].c + 3, 'a': b[1].a || 'I'}, {'c': b[2].c + 3, 'a': b[2].a || 'I'},
                    {'c': b[4].c + 3, 'a': b[4].a || 'I'}])], lambda u: [b[1], b[2], u,
                    list_min([b[4], {'c': u.c + 3, 'a': u.a || 'I'}])])[1]], lambda e: [
                {'c': e[1].c + 4, 'a': e[1].a || 'D'},
                list_min([{'c': e[2].c + 4, 'a': e[2].a || 'D'},
                    {'c': CASE WHEN t.i = 's' AND NOT t.go THEN e[1].c + t.more ELSE 1000000000 END,
                     'a': e[1].a || 'K'}]),
                list_min([{'c': e[3].c + 4, 'a': e[3].a || 'D'}] || list_transform([1, 2, 4],
                    lambda k: {'c': CASE WHEN t.go THEN 1000000000 ELSE e[k].c + t.more +
                                    CASE WHEN t.i = 'u' THEN 0 ELSE 3 END END,
                               'a': e[k].a || CASE WHEN t.i = 'u' THEN 'K' ELSE 'R' END})),
                list_min([{'c': e[4].c + 4, 'a': e[4].a || 'D'},
                    {'c': CASE WHEN t.go THEN 1000000000 ELSE e[3].c + t.more +
                          CASE WHEN t.i = 'a' THEN 0 ELSE 3 END END,
                     'a': e[3].a || CASE WHEN t.i = 'a' THEN 'K' ELSE 'R' END}])])[1],
                [{'c': 0, 'a': ''}, {'c': 1000000000, 'a': ''}, {'c': 1000000000, 'a': ''},
                 {'c': 1000000000, 'a': ''}]) AS b
            FROM counted),
        best AS (
            SELECT *, list_min([b[1], b[4], {'c': b[3].c + 3, 'a': b[3].a || 'I'},
                                {'c': b[2].c + 6, 'a': b[2].a || 'II'}]) AS way FROM solved),
        letters AS (
            SELECT *, row_number() OVER w AS k, sum(CASE edit WHEN 'I' THEN 0 ELSE 1 END)
                   OVER (w ROWS UNBOUNDED PRECEDING) AS place
            FROM (SELECT conv_id, unnest(string_split(way.a, '')) AS edit,
                         unnest(range(length(way.a))) AS spot FROM best WHERE way.a <> '')
            WINDOW w AS (PARTITION BY conv_id ORDER BY spot)),
        left_over AS (
            SELECT l.conv_id, l.k, l.edit, f.role, f.text,
                   row_number() OVER (PARTITION BY l.conv_id ORDER BY l.k) AS n,
                   max(CASE WHEN l.edit = 'K' AND left(f.role, 1) = 's' THEN 1 ELSE 0 END)
                       OVER (PARTITION BY l.conv_id) AS has_s
            FROM letters l LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM l.conv_id
                 AND f.place = l.place AND l.edit <> 'I'
            WHERE l.edit <> 'D'),
        lines AS (
            SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role
                       WHEN (n - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                       coalesce(text, ''), chr(10) ORDER BY n) AS repaired
            FROM left_over GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
               coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, CAST(coalesce(way.c, 0) AS BIGINT) AS cost,
               coalesce(way.a, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id""",
}
