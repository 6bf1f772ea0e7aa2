"""The operators' queries over their whole tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trolley.llm._common import table
from trolley.llm.attribution import attribute_tokens
from trolley.llm.byte_pairs import round_trip_digests
from trolley.llm.collocations import collocations
from trolley.llm.decontamination import contamination_report
from trolley.llm.langid import identify_languages
from trolley.llm.licenses import scan_licenses
from trolley.llm.near_dup import duplicate_classes
from trolley.llm.packing import pack_documents
from trolley.llm.pii import find_personal_data
from trolley.llm.topk import exact_top_k
from trolley.llm.toxicity import score_toxicity
from trolley.llm.vector_codes import compress_vectors, with_label_errors
from trolley.llm.warc import archive_round_trip


def op1_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribute_tokens(table(spark, sf_dir, "documents"))


def op2_prob_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_classes(table(spark, sf_dir, "documents"))


def op3_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_code_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op6_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op8_segment_field_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_norm_sorted_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.filter("vec_id % 100 = 0"))


def op11_graph_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"))


def op13_cover_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = with_label_errors(compress_vectors(table(spark, sf_dir, "embeddings")))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_attribution,
        op2_prob_min_hash,
        op3_recurrent_toxicity,
        op4_code_languages,
        op5_warc_bundles,
        op6_certified_packing,
        op7_license_windows,
        op8_segment_field_pii,
        op9_decontamination,
        op10_norm_sorted_top_k,
        op11_graph_collocations,
        op12_byte_pairs,
        op13_cover_tree_codes,
    )
}

def _codes_sql(rounds: int = 6) -> str:
    """Lloyd's rounds by brute force: every part against every entry, one common table expression a round."""
    nearest = """
        SELECT v.row, v.p, min(list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 16 + b.e) AS best
        FROM v JOIN b{0} b USING (p) GROUP BY ALL"""
    steps = [
        f"""a{k} AS ({nearest.format(k)}),
        b{k + 1} AS (
            SELECT b.p, b.e, coalesce(n.x, b.x) AS x FROM b{k} b LEFT JOIN (
                SELECT p, e, list(CAST(((s - ((s % n) + n) % n) // n) AS BIGINT) ORDER BY i) AS x FROM (
                    SELECT p, best % 16 AS e, i, sum(x[i]) AS s, count(*) AS n
                    FROM a{k} JOIN v USING (row, p), (SELECT unnest(range(1, 9)) AS i) GROUP BY ALL)
                GROUP BY ALL) n ON n.p = b.p AND n.e = b.e)"""
        for k in range(rounds)
    ]
    return f"""
        WITH k AS (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
                list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS MATERIALIZED (SELECT row, p, x[8 * p + 1 : 8 * p + 8] AS x FROM k, (SELECT unnest(range(8)) AS p)),
        b0 AS (SELECT p, row - 1 AS e, x FROM v WHERE row <= 16), {', '.join(steps)},
        final AS MATERIALIZED ({nearest.format(rounds)}),
        c AS (
            SELECT row, string_agg(printf('%02x', best % 16), '' ORDER BY p) AS code,
                CAST(sum((best - best % 16) // 16) AS BIGINT) AS error
            FROM final GROUP BY row)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
        FROM k JOIN c USING (row)
    """


ORACLES: dict[str, str] = {
    "op11_graph_collocations": r"""
        WITH d AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]') AS pieces
            FROM documents),
        p AS (
            SELECT lang, list_filter(string_split_regex(unnest(pieces), '[\x20\x09]+'), lambda w: w <> '') AS w FROM d),
        g AS (
            SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase
            FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM p, range(1, 5) t(size)
                WHERE len(w) >= size)),
        f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE size > 1 AND f >= 30),
        hidden AS (
            SELECT DISTINCT c.lang, c.phrase FROM c JOIN (
                SELECT lang, a, array_to_string(list_slice(w, i, i + m - 1), ' ') AS part
                FROM (SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS i FROM c, range(2, 4) t(m) WHERE m < size)
            ) b ON b.lang = c.lang AND b.part = c.phrase AND 100 * b.a::HUGEINT >= 80 * c.a::HUGEINT),
        cuts AS (
            SELECT c.lang, c.phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS x,
                array_to_string(list_slice(w, k + 1, size), ' ') AS y
            FROM c, range(1, 4) t(k) WHERE k < size AND (c.lang, c.phrase) NOT IN (SELECT (lang, phrase) FROM hidden)),
        s AS (
            SELECT cuts.lang, cuts.phrase, a, fx.f AS l, fy.f AS r, k, (2000000 * a::HUGEINT) // (fx.f + fy.f) AS score
            FROM cuts JOIN f fx ON fx.lang = cuts.lang AND fx.phrase = x JOIN f fy ON fy.lang = cuts.lang AND fy.phrase = y),
        b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM s) WHERE i = 1)
        SELECT * FROM (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
                CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
            FROM b JOIN n USING (lang))
        WHERE rank <= 2000
    """,
    "op13_cover_tree_codes": _codes_sql(),
    "op5_warc_bundles": """
        WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS h FROM pages),
        d AS (SELECT *, sha256(h) AS payload_digest, octet_length(encode(h)) AS payload_bytes FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND first_id IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END
                AS record_type,
            CASE WHEN payload_bytes >= 100 AND first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to, url
        FROM f
    """,
    "op9_decontamination": r"""
        WITH t AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS s
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM bw),
        dw AS (
            SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM t, sizes WHERE len(w) >= n)),
        m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
        h AS (
            SELECT doc_id, count(DISTINCT x) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM m) GROUP BY doc_id),
        k AS (
            SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
            FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
        SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
            coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM t LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)
    """,
    "op10_norm_sorted_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 10
    """,
}
