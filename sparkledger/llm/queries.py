"""The registered query of each operator: it applies the operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkledger.llm import common


def _tokenizer(name: str) -> str:
    """Where a public tokenizer's file is; the files are not part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import quality_lm

    return quality_lm.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_pack_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import packing

    return packing.digest(packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json")))


def op3_license_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import licenses

    return licenses.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import vector_dedup

    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import minhash

    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85).drop("text_hash")


def op6_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import warc

    path = common.shared_dir(spark, "warc")
    archives = common.materialize(warc.write(_table(spark, sf_dir, "pages"), path), "warc-list")
    return warc.read(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import token_store

    path = common.shared_dir(spark, "token-files")
    files = token_store.write(_table(spark, sf_dir, "documents"), path, _tokenizer("word_bpe_49k.json"))
    return token_store.digest(token_store.read(spark, common.materialize(files, "token-files-list")))


def op8_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import ann

    vectors = _table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import substring

    return substring.digest(substring.mark_repeats(_table(spark, sf_dir, "documents")))


def op10_piece_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import pieces

    return pieces.digest(pieces.encode(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model")))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import phrases

    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import suffixes

    return suffixes.digest(suffixes.mark_repeats(_table(spark, sf_dir, "documents")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkledger.llm import conversations

    return conversations.repair(conversations.damage(_table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_quality_model, op2_pack_pieces, op3_license_spans, op4_near_vectors, op5_near_duplicates, op6_warc_archives, op7_token_files, op8_one_bit_search, op9_repeated_passages, op10_piece_codes, op11_phrases, op12_repeated_strings, op13_conversation_repair)}
ORACLES: dict[str, str] = {
    "op4_near_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS x, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS size FROM embeddings
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
            WHERE a.vec_id <> b.vec_id AND a.size > 0 AND b.size > 0 AND list_inner_product(a.x, b.x) / (a.size * b.size) >= 0.9
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
        ), degree AS (
            SELECT a, count(*) AS n FROM links GROUP BY a
        ), least AS (
            SELECT a, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN least ON least.a = vec_id LEFT JOIN degree ON degree.a = vec_id
    """,
    "op8_one_bit_search": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
        ), s AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x) AS score
            FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
    """,
    "op9_repeated_passages": """
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 19), ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)
        ), later AS (
            SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, i + unnest(range(20)) AS j, true AS out FROM later
        ), words AS (
            SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w
        ), kept AS (
            SELECT doc_id, count(*) AS n_words, count(out) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (out IS NULL) AS t
            FROM words LEFT JOIN gone USING (doc_id, j) GROUP BY doc_id
        )
        SELECT w.doc_id AS doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)
    """,
    "op5_near_duplicates": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 2), ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM w
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
        ), least AS (
            SELECT a, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT w.doc_id AS doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
        FROM w JOIN least ON least.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
    """,
    "op11_phrases": """
        WITH p AS (
            SELECT doc_id, coalesce(lang, 'und') AS lang, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\\x0A-\\x0D]+') AS ps FROM documents
        ), w AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (SELECT lang, unnest(ps) AS piece FROM p)
        ), f AS (
            SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase, count(*) AS f
            FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 4) r(k) WHERE len(ws) >= k) GROUP BY 1, 2, 3 HAVING count(*) >= 10
        ), n AS (
            SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY 1
        ), c AS (
            SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2
        ), longer AS (
            SELECT lang, phrase, max(a) AS m FROM (SELECT lang, ws[1] || ' ' || ws[2] AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, ws[2] || ' ' || ws[3], a FROM c WHERE k = 3) GROUP BY 1, 2
        ), cuts AS (
            SELECT *, array_to_string(ws[1:cut], ' ') AS x, array_to_string(ws[cut + 1:k], ' ') AS y FROM c, range(1, 3) r(cut) WHERE cut < k
        ), scored AS (
            SELECT cuts.lang, cuts.phrase, a, fx.f AS l, fy.f AS r, cut, (1000000::HUGEINT * a * a) // (fx.f::HUGEINT * fy.f) AS score
            FROM cuts JOIN f fx ON fx.lang = cuts.lang AND fx.phrase = x JOIN f fy ON fy.lang = cuts.lang AND fy.phrase = y LEFT JOIN longer ON longer.lang = cuts.lang AND longer.phrase = cuts.phrase
            WHERE m IS NULL OR 100 * m < 50 * a QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, cut) = 1
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM scored JOIN n USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
    """,
    "op6_warc_archives": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html FROM pages
        ), d AS (
            SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
        FROM f
    """,
}
