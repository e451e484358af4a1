"""The operators bound to the given tables, with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framewright.llm import bpe, common, embed, minhash, negatives, packing, pii, quality, records, secretscan, spelling, suffix, urlfilter, warc

#: Rules of host/path and their verdicts.
URL_RULES = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
#: Listed hosts, with all their subdomains.
BLOCKED_HOSTS = tuple(f"{name}.example.{top}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    return quality.judge_documents(docs, quality.train(docs, labels))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.table(spark, sf_dir, "documents"), vocabulary())


def op3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.shared_dir(spark)
    records.write_records(common.table(spark, sf_dir, "documents"), folder, vocabulary())
    return records.with_starts(records.read_records(spark, folder))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(common.table(spark, sf_dir, "documents"), percent=85)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.shared_dir(spark)
    warc.write_archives(warc.mark_revisits(common.table(spark, sf_dir, "pages")), folder)
    return warc.read_archives(spark, folder)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(common.table(spark, sf_dir, "pages"), URL_RULES, BLOCKED_HOSTS)


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_vectors(common.table(spark, sf_dir, "embeddings"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(common.table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(common.table(spark, sf_dir, "documents"), vocabulary())


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(common.table(spark, sf_dir, "documents"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan_secrets(common.table(spark, sf_dir, "documents"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(common.table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_packing, op3_records, op4_minhash, op5_warc, op6_url_filter, op7_embeddings, op8_pii, op9_suffix, op10_bpe,
        op11_spelling, op12_secrets, op13_negatives,
    )
}

_HOSTS = ", ".join(f"'{h}'" for h in BLOCKED_HOSTS)
_RULES = ", ".join(f"('{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}', '{v}')" for r, v in URL_RULES.items())

#: CRC-32 of the bytes of a string, most of it a table that follows from its polynomial.
_CRC_TABLE = """(SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) FROM range(256) t(b))"""

ORACLE_SQL: dict[str, str] = {
    "op11_spelling": f"""
        WITH RECURSIVE crc_table AS (SELECT {_CRC_TABLE} AS t),
        runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
            GROUP BY ALL HAVING length(any_value(run)) >= 6),
        hashed AS (
            SELECT run, n, xor(list_reduce(
                list_transform(range(0, length(b) // 2), lambda i: (instr('0123456789ABCDEF', substr(b, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(b, 2 * i + 2, 1)) - 1),
                lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h
            FROM (SELECT *, hex(encode(doc_id || ':' || run)) AS b FROM runs), crc_table),
        words AS (
            SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
        v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
        cut AS (SELECT DISTINCT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = cut.rest
            UNION SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = cut.rest),
        best AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS x FROM near GROUP BY 1),
        state AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -x[1] >= 5 * v.n THEN x[2] END AS form, CASE WHEN -x[1] >= 5 * v.n THEN -x[1] END AS form_n
            FROM v LEFT JOIN best ON best.word = v.word),
        chain(word, root, step) AS (
            SELECT word, word, 0 FROM state UNION ALL SELECT c.word, s.form, step + 1 FROM chain c JOIN state s ON s.word = c.root WHERE s.form IS NOT NULL)
        SELECT s.word, form, r.root, s.n, s.n_near, s.form_n FROM state s JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY 1) r ON r.word = s.word""",
    "op13_negatives": """
        WITH v AS (
            SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
        p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY rank <= 5""",
    "op7_embeddings": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
        arcs AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(vec_id, other) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, arcs.b FROM reach r JOIN arcs ON r.other = arcs.a),
        n AS (SELECT a AS vec_id, count(*) AS n_links FROM arcs GROUP BY 1),
        m AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1)
        SELECT m.vec_id, coalesce(n_links, 0) AS n_links, component_id, m.vec_id = component_id AS kept
        FROM m LEFT JOIN n ON n.vec_id = m.vec_id""",
    "op4_minhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
        f AS (SELECT doc_id, unnest(sh) AS g FROM s),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM f a JOIN f b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM common JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 85 * (len(x.sh) + len(y.sh) - n)),
        arcs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, e.b FROM reach r JOIN arcs e ON r.other = e.a)
        SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
        FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) m ON m.doc_id = s.doc_id""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, h, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
        g AS (SELECT payload_digest, max(page_id) AS original FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, payload_bytes, d.payload_digest,
               CASE WHEN original IS NOT NULL AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> original THEN original END AS refers_to
        FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest""",
    "op6_url_filter": f"""
        WITH u AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages),
        r(rule_host, rule_path, rule, verdict) AS (VALUES {_RULES}),
        best AS (
            SELECT u.page_id, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
            FROM u JOIN r ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path)
            GROUP BY 1),
        l AS (SELECT unnest([{_HOSTS}]) AS listed),
        bad AS (SELECT DISTINCT host FROM u JOIN l ON u.host = listed OR ends_with(u.host, '.' || listed))
        SELECT u.page_id, u.host, u.path, best.rule,
               coalesce(best.verdict, CASE WHEN u.host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
        FROM u LEFT JOIN best USING (page_id)""",
}
