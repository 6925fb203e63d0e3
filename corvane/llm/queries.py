"""The registered queries of this subpackage, one thin query an operator, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, decontamination, exact_dedup, hard_negatives, jaccard_join, lm_scoring, packing, preference_format, secret_scan, suffix_dedup, toxicity, url_filter

#: Rules of op4: (verdict, host, path prefix).
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_test_text(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 are pair k; the even one is the chosen one."""
    turns = table(spark, sf_dir, "conversations")
    return preference_format.preference_pairs(turns, F.expr("conv_id div 2"), F.col("conv_id") % 2 == 0)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_path()))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    of_kind = lambda kind: F.regexp_count("base_spans", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", of_kind("assign"), of_kind("access"), of_kind("hex"), F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(table(spark, sf_dir, "embeddings"), label_col=label)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def lm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of op2: token counts and the base score."""
    found = op2_lm_scoring(spark, sf_dir)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def secret_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of op7: the fixed patterns."""
    return op7_secret_scan(spark, sf_dir).drop("spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_exact_dedup, op2_lm_scoring, op3_decontamination, op4_url_filter, op5_preference_format, op6_bpe, op7_secret_scan, op8_toxicity, op9_suffix_dedup, op10_ngram_jaccard_join, op11_hard_negatives, op12_collocations, op13_best_fit_packing, lm_base, secret_base)}

_RULES_SQL = ", ".join(f"({i}, '{v}', '{h}', '{p}')" for i, (v, h, p) in enumerate(URL_RULES))

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op3_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
                FROM (SELECT *, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        pos AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
                FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
        hit AS (SELECT DISTINCT doc_id, i, n, item_id FROM pos JOIN win USING (n, k)),
        words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY doc_id)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
               sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_url_filter": f"""
        WITH rules(i, verdict, host, path) AS (VALUES {_RULES_SQL}),
        parts AS (
          SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
          FROM pages),
        fits AS (
          SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
                 row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, r.i) AS n
          FROM parts p LEFT JOIN rules r ON ends_with('.' || p.host, '.' || r.host) AND starts_with(p.path, r.path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1""",
    "op9_suffix_dedup": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        again AS (
          SELECT doc_id, i FROM (SELECT doc_id, i, sha256(array_slice(b, i, i + 199)) AS k FROM (SELECT doc_id, b, unnest(range(1, n - 198)) AS i FROM d WHERE n >= 200))
          QUALIFY count(*) OVER (PARTITION BY k) > 1),
        steps AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM again),
        runs AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM steps) GROUP BY doc_id, g),
        gone AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS last FROM runs GROUP BY doc_id),
        pieces AS (
          SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 1) AS p, a AS q FROM runs
          UNION ALL SELECT doc_id, coalesce(last, 1), n + 1 FROM d LEFT JOIN gone USING (doc_id)),
        kept AS (SELECT doc_id, string_agg(substring(hex(b), 2 * p - 1, 2 * (q - p)), '' ORDER BY p) AS h FROM pieces JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(h)) AS kept_sha256
        FROM d LEFT JOIN gone USING (doc_id) JOIN kept USING (doc_id)""",
    "op10_ngram_jaccard_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
          SELECT a, b, shared = x.n AND shared = y.n AS same
          FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL) JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
          WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
        reach AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT b, c FROM reach JOIN links ON a = doc_id)
        SELECT doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(c) AS component_id, least(doc_id, (SELECT min(b) FROM links WHERE a = doc_id AND same)) AS class_id,
               (SELECT count(*) FROM links WHERE a = doc_id) AS n_links
        FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op5_preference_format": """
        WITH t AS (
          SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS side, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
          FROM conversations WHERE conv_id IS NOT NULL),
        sizes AS (SELECT pair_id, count(*) FILTER (side) AS n_chosen, count(*) FILTER (NOT side) AS n_rejected FROM t GROUP BY pair_id),
        breaks AS (
          SELECT pair_id, min(i) AS first_break FROM (
            SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.i, b.i) AS i, coalesce(a.role = b.role AND a.text = b.text, false) AS same
            FROM (FROM t WHERE side) a FULL JOIN (FROM t WHERE NOT side) b ON a.pair_id = b.pair_id AND a.i = b.i) WHERE NOT same GROUP BY pair_id),
        sized AS (SELECT s.*, coalesce(b.first_break - 1, s.n_chosen) AS n_prefix FROM sizes s LEFT JOIN breaks b USING (pair_id)),
        laid AS (
          SELECT t.*, s.n_prefix, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown,
                 coalesce(sum(length(role) + length(text) + 13) OVER (PARTITION BY pair_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(role) + 5 AS pos
          FROM t JOIN sized s USING (pair_id)),
        made AS (
          SELECT pair_id,
            coalesce(string_agg(shown, '' ORDER BY i) FILTER (side AND i <= n_prefix), '') AS prompt,
            coalesce(string_agg(shown, '' ORDER BY i) FILTER (side AND i > n_prefix), '') AS chosen,
            coalesce(string_agg(shown, '' ORDER BY i) FILTER (NOT side AND i > n_prefix), '') AS rejected,
            coalesce(string_agg(pos || ':' || (pos + length(text)), ',' ORDER BY i) FILTER (side AND i > n_prefix AND role = 'assistant'), '') AS chosen_spans,
            coalesce(string_agg(pos || ':' || (pos + length(text)), ',' ORDER BY i) FILTER (NOT side AND i > n_prefix AND role = 'assistant'), '') AS rejected_spans
          FROM laid GROUP BY pair_id)
        SELECT pair_id, CASE WHEN n_rejected = 0 THEN 'chosen_only' WHEN n_chosen = 0 THEN 'rejected_only'
                 WHEN n_prefix = n_chosen AND n_prefix = n_rejected THEN 'identical' ELSE 'pair' END AS status,
               n_prefix::INTEGER AS n_prefix, n_chosen::INTEGER AS n_chosen, n_rejected::INTEGER AS n_rejected, prompt, chosen, rejected, chosen_spans, rejected_spans
        FROM sized JOIN made USING (pair_id)""",
    "op11_hard_negatives": """
        WITH v AS (
          SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
          SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
          FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5),
        n AS (
          SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.id, s.b)::INTEGER AS rank
          FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
        SELECT * FROM n WHERE rank <= 3""",
    "op12_collocations": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
        g AS (
          SELECT lang, w[i:i + m - 1] AS ws, count(*) AS f
          FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS t(m)) GROUP BY ALL HAVING count(*) >= 30),
        n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
        cuts AS (
          SELECT c.lang, c.ws, c.f AS a, k, l.f AS l, r.f AS r, 2000000::HUGEINT * c.f // (l.f + r.f) AS score
          FROM (SELECT *, unnest(range(1, len(ws))) AS k FROM g) c JOIN g l ON l.lang = c.lang AND l.ws = c.ws[1:k] JOIN g r ON r.lang = c.lang AND r.ws = c.ws[k + 1:]),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
        inside AS (SELECT lang, ws[i:i + m - 1] AS ws, max(f) AS f FROM (SELECT *, unnest(range(1, len(ws) - m + 2)) AS i FROM g, (VALUES (2), (3)) AS t(m) WHERE len(ws) > m) GROUP BY ALL)
        SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, array_to_string(o.ws, ' '))::BIGINT AS rank, array_to_string(o.ws, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
        FROM lowest o JOIN n USING (lang) LEFT JOIN inside i ON i.lang = o.lang AND i.ws = o.ws
        WHERE coalesce(100 * i.f < 80 * a, true) QUALIFY rank <= 2000""",
    "lm_base": r"""
        WITH d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS i, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        folds AS (
          SELECT doc_id, w, xor(list_reduce([ascii(c)::BIGINT FOR c IN string_split(i, '')],
            lambda c, b: list_reduce(range(8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(c, b)), 4294967295::BIGINT), 4294967295::BIGINT) % 10 = 0 AS held_out FROM d),
        t AS (SELECT doc_id, held_out, unnest(w) AS token FROM folds UNION ALL SELECT doc_id, held_out, '' FROM folds),
        c AS (SELECT token, count(*) AS c FROM t WHERE NOT held_out GROUP BY token),
        n AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM c)
        SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, round(sum(log10((coalesce(c, 0) + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1)))), 4) AS base_score
        FROM t LEFT JOIN c USING (token), n GROUP BY doc_id, held_out""",
    "secret_base": r"""
        WITH kinds(kind, k, pattern, least) AS (VALUES
          ('assign', 0, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 8), ('access', 1, '(AKIA[A-Z0-9]+)', 16), ('hex', 2, '([0-9a-f]+)', 32)),
        m AS (SELECT doc_id, kind, k, least, regexp_split_to_array(coalesce(text, ''), pattern) AS p, regexp_extract_all(coalesce(text, ''), pattern, 0) AS m, regexp_extract_all(coalesce(text, ''), pattern, 1) AS g FROM documents, kinds),
        e AS (SELECT doc_id, kind, k, least, length(g) AS n, length(p) AS a, length(m) AS b, i FROM (SELECT doc_id, kind, k, least, unnest(g) AS g, unnest(p[:len(m)]) AS p, unnest(m) AS m, generate_subscripts(m, 1) AS i FROM m)),
        s AS (SELECT doc_id, kind, k, b, (sum(a + b) OVER (PARTITION BY doc_id, kind ORDER BY i))::BIGINT AS stop, least FROM e QUALIFY n >= least),
        t AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex, string_agg(kind || ':' || (stop - b) || ':' || stop, ',' ORDER BY stop - b, k) AS spans FROM s GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256 FROM documents LEFT JOIN t USING (doc_id)""",
}
