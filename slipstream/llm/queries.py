"""The registered query of each operator, with the parameters used in production, and SQL where SQL can check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.llm import alignment, bpe_fst, html_extract, multiset_hash, packing, ppm, quality_classifier, quality_rules, simhash_dedup, spelling, substring_dedup, subword, url_filters, wavelet
from slipstream.llm.staging import new_folder


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return quality_classifier.resampled(docs, quality_classifier.fit(docs, _labels(spark, sf_dir)))


def op2_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multiset_hash.edited_fingerprints(_documents(spark, sf_dir))
    own, edited, following = F.col("vector"), F.col("edited_vector"), F.col("next_vector")
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        multiset_hash.as_hex(own).alias("fingerprint"), multiset_hash.as_hex(edited).alias("edited_fingerprint"),
        multiset_hash.likeness(own, edited).alias("near_edited"), multiset_hash.likeness(own, following).alias("near_next"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return substring_dedup.deduplicated(docs).select("doc_id", "dedup.n_words", "dedup.n_removed", "dedup.kept_sha256")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), subword.public_path(subword.VOCABULARY), capacity=1024, end=2)


def op5_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scored(_documents(spark, sf_dir), held=1)


def op6_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "shards")
    wavelet.write(_documents(spark, sf_dir), path, subword.public_path(subword.VOCABULARY), end=0)
    return wavelet.documents(wavelet.read(spark, path))


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = bpe_fst.round_trip(_documents(spark, sf_dir), subword.public_path(bpe_fst.RANKS), public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = quality_rules.fit(docs, _labels(spark, sf_dir))
    return quality_rules.judged(docs.select("doc_id", "text"), model).select("doc_id", "rules.*")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(_documents(spark, sf_dir), shingle=3, distance=3)
    return found.select("doc_id", simhash_dedup.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(_documents(spark, sf_dir))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(_documents(spark, sf_dir), subword.public_path(subword.VOCABULARY), subword.public_path(alignment.PIECES))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), url_filters.RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_multiset_hash": op2_multiset_hash,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_ppm_scoring": op5_ppm_scoring,
    "op6_wavelet_matrix": op6_wavelet_matrix,
    "op7_bpe_transducer": op7_bpe_transducer,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_html_extraction": op10_html_extraction,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_url_filters": op13_url_filters,
}

#: The other operators fit models, link by 64-bit hashes, run tokenizers or choose numbers freely: tests/llm checks them
#: by brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": r"""
        WITH texts AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
            FROM documents
        ), windows AS (
            SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM texts WHERE len(w) >= 50)
        ), first AS (
            SELECT h, min(doc_id) AS least FROM windows GROUP BY h
        ), covered AS (
            SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p
            FROM windows JOIN first USING (h) WHERE least < doc_id
        ), words AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
            FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (doc_id)
    """,
    "op11_spelling_variants": r"""
        WITH RECURSIVE crc AS (
            SELECT [list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR b IN range(256)] AS t
        ), runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL
        ), spelled AS (
            SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs WHERE len(run) >= 6
        ), hashed AS (
            SELECT run, n, xor(list_reduce([4294967295] || [('0x' || x[2 * k + 1:2 * k + 2])::BIGINT FOR k IN range(len(x) // 2)],
                                           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
            FROM spelled, crc
        ), words AS (
            SELECT CASE WHEN h % 199 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, sum(n)::BIGINT AS n
            FROM hashed GROUP BY 1 HAVING len(word) >= 6 AND sum(n) >= 5
        ), less AS (
            SELECT word, n, k, word[:k] || word[k + 2:] AS part FROM (SELECT word, n, unnest(range(len(word))) AS k FROM words)
        ), pairs AS (
            SELECT a.word, b.word AS near, b.n FROM less a JOIN less b ON a.part = b.part AND a.k = b.k AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.part = b.word
            UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.part = b.word
        ), counted AS (
            SELECT word, count(*) AS n_near, max(n) AS most, arg_min(near, (-n, hex(encode(near)))) AS best FROM pairs GROUP BY word
        ), forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 5 * w.n THEN best END AS form, CASE WHEN most >= 5 * w.n THEN most END AS form_n
            FROM words w LEFT JOIN counted c ON w.word = c.word
        ), chain(word, root) AS (
            SELECT word, word FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NOT NULL
        ), ends AS (
            SELECT chain.word, chain.root FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
    """,
    "op13_url_filters": r"""
        WITH RECURSIVE rules(rule, host, path, verdict) AS (
            VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                   ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
        ), tags AS (
            SELECT url, unnest(regexp_extract_all(regexp_replace(html, '<!--.*?-->|<script\b.*?</script>', '', 'gis'), '(?is)<(?:link|meta)\b[^>]*>')) AS tag
            FROM pages
        ), named AS (
            SELECT url, CASE
                WHEN regexp_matches(tag, '(?i)^<link\b.*\brel\s*=\s*["'']?([^"''>]*\s)?canonical\b') THEN regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
                WHEN regexp_matches(tag, '(?i)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)
                END AS target
            FROM tags
        ), links AS (
            SELECT url AS a, target AS b FROM named WHERE target LIKE '%://%' AND url <> target
        ), linked AS (
            SELECT a, b FROM links UNION SELECT b, a FROM links
        ), reach(a, b) AS (
            SELECT a, a FROM linked UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
        ), urls AS (
            SELECT page_id, url FROM pages UNION ALL SELECT NULL, b FROM reach
        ), split AS (
            SELECT page_id, url, strpos(url, '://') > 0 AS whole, substr(url, strpos(url, '://') + 3) AS rest FROM urls
        ), parts AS (
            SELECT page_id, url, CASE WHEN whole THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
                   CASE WHEN whole THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
            FROM split
        ), judged AS (
            SELECT p.*, (SELECT arg_max({'rule': r.rule, 'verdict': r.verdict}, len(r.rule)) FROM rules r
                         WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS found
            FROM parts p
        ), blocked AS (
            SELECT DISTINCT reach.a AS url FROM reach JOIN judged ON judged.url = reach.b WHERE judged.found.verdict = 'block'
        )
        SELECT page_id, host, path, found.rule AS rule, coalesce(found.verdict, CASE WHEN b.url IS NULL THEN 'allow' ELSE 'block' END) AS verdict
        FROM judged LEFT JOIN blocked b ON judged.url = b.url
        WHERE page_id IS NOT NULL
    """,
}
