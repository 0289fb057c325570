"""One registered query per operator over its whole table, and the same as DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe, decontam, html, language, licenses, near_dup, quality_model, quality_rules, ranked_search, substring_dedup, url_filter, warc, whitening
from tickloom.llm.common import table

BPE_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), BPE_PATH, public_tokenizers.PATTERN)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels.select("doc_id", quality_model.grade_of(F.col("quality"), F.col("toxic")).alias("grade")))
    return quality_model.predict(docs.select("doc_id", "text"), model, drop=("text",))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("clean_text")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "template")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector")))
    each = found.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "explained", "identity_error", F.posexplode("whitened").alias("place", "whitened"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", "place").alias("explained"), "identity_error")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.coalesce(F.sha2("kept_text", 256), "words_sha256").alias("kept_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _canonical_sql(text: str) -> str:
    """The canonical form of licences.canonical in DuckDB's SQL."""
    out = f"regexp_replace(lower(coalesce({text}, '')), '{licenses.COPYRIGHT_LINE}', chr(10), 'g')"
    out = f"' ' || regexp_replace({out}, '[^a-z0-9]+', ' ', 'g') || ' '"
    for odd, usual in licenses.SPELLINGS:
        out = f"replace({out}, ' {odd} ', ' {usual} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


_KNOWN_SQL = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.KNOWN)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc, op2_near_duplicates, op3_byte_bpe, op4_license_scan, op5_language_id, op6_decontamination, op7_quality_model, op8_quality_rules, op9_html_extraction, op10_url_filter, op11_whitening, op12_substring_dedup, op13_ranked_search)
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
               CAST(NULL AS VARCHAR) AS error
        FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                     CASE WHEN strlen(html) >= 1000 AND page_id IS DISTINCT FROM max(page_id) OVER (PARTITION BY html)
                          THEN max(page_id) OVER (PARTITION BY html) END AS refers_to
              FROM pages)
    """,
    "op4_license_scan": f"""
        WITH known AS (SELECT digest, string_agg(DISTINCT license, ' OR ' ORDER BY license) AS license
                       FROM (SELECT sha256({_canonical_sql("text")}) AS digest, license FROM (VALUES {_KNOWN_SQL}) AS k(license, text)) GROUP BY digest),
        docs AS (SELECT row_number() OVER () AS nr, doc_id, text FROM documents),
        found AS (SELECT nr, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS n_license_lines
                  FROM (SELECT nr, sha256({_canonical_sql("line")}) AS digest FROM (SELECT nr, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE line <> '')
                  JOIN known USING (digest) GROUP BY nr)
        SELECT doc_id, sha256({_canonical_sql("text")}) AS digest, license, coalesce(line_licenses, '') AS line_licenses,
               coalesce(n_license_lines, 0) AS n_license_lines
        FROM docs LEFT JOIN known ON known.digest = sha256({_canonical_sql("text")}) LEFT JOIN found USING (nr)
    """,
    "op6_decontamination": """
        WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
        docs AS (SELECT row_number() OVER () AS nr, doc_id,
                        regexp_extract_all(translate(coalesce(text, ''), upper, lower), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
                 FROM documents, letters),
        items AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
                         regexp_extract_all(translate(coalesce(text, ''), upper, lower), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
                  FROM benchmark, letters WHERE item_id IS NOT NULL),
        windows AS (SELECT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS s
                    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM windows),
        grams AS (SELECT nr, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
                  FROM (SELECT nr, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes)),
        hits AS (SELECT DISTINCT nr, n, i, item_id FROM grams JOIN windows USING (n, s)),
        covered AS (SELECT nr, count(DISTINCT p) AS n_hit FROM (SELECT nr, unnest(range(i, i + n)) AS p FROM hits) GROUP BY nr),
        listed AS (SELECT nr, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
                   FROM (SELECT DISTINCT nr, item_id FROM hits) GROUP BY nr)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN covered USING (nr) LEFT JOIN listed USING (nr)
    """,
    "op8_quality_rules": """
        WITH docs AS (
            SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
            FROM documents),
        grams AS (SELECT nr, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT nr, w, unnest(range(1, len(w) - 1)) AS i FROM docs)),
        twice AS (SELECT nr, i FROM (SELECT nr, i, count(*) OVER (PARTITION BY nr, s) AS n FROM grams) WHERE n > 1),
        repeated AS (SELECT nr, count(DISTINCT p) AS n FROM (SELECT nr, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY nr),
        line AS (SELECT nr, line, regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g') AS bare,
                        length(regexp_replace(line, '[^|»›•·>]+', '', 'g')) AS separators
                 FROM (SELECT nr, unnest(lines) AS line FROM docs)),
        judged AS (SELECT nr, bare, NOT contains('.!?…:;"''”’»)]。！？', right(bare, 1))
                       OR (length(line) <= 200 AND regexp_matches(lower(line), 'lorem ipsum|javascript|cookie|terms of use|terms of service|privacy policy|all rights reserved|click here|read more|sign in|sign up|log in|subscribe|share this|skip to content'))
                       OR length(regexp_replace(bare, '[^!?|*#$%&<>~^=_+/@\\\\]+', '', 'g')) > 0.15 * length(bare)
                       OR (separators >= 3 AND 5 * separators >= len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))) AS fails
                   FROM line),
        kept AS (SELECT nr, count(*) FILTER (fails) AS n_failed_lines, coalesce(sum(length(bare)) FILTER (NOT fails), 0) AS remaining FROM judged GROUP BY nr),
        told AS (
            SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
                   coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(remaining, 0) AS remaining
            FROM docs LEFT JOIN repeated USING (nr) LEFT JOIN kept USING (nr))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND remaining >= 0.5 * word_chars AS kept
        FROM told
    """,
    "op12_substring_dedup": """
        WITH docs AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS nr, doc_id,
                             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        windows AS (SELECT nr, i, array_to_string(w[i : i + 19], ' ') AS s FROM (SELECT nr, w, unnest(range(1, len(w) - 18)) AS i FROM docs)),
        repeats AS (SELECT nr, i FROM (SELECT nr, i, row_number() OVER (PARTITION BY md5(s) ORDER BY nr, i) AS place FROM windows) WHERE place > 1),
        covered AS (SELECT nr, list(DISTINCT p) AS gone FROM (SELECT nr, unnest(range(i, i + 20)) AS p FROM repeats) GROUP BY nr),
        words AS (SELECT nr, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
        removed AS (SELECT nr, unnest(gone) AS p, true AS gone FROM covered),
        kept AS (SELECT nr, string_agg(word, ' ' ORDER BY p) AS kept_text FROM words LEFT JOIN removed USING (nr, p) WHERE gone IS NULL GROUP BY nr)
        SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
        FROM docs LEFT JOIN covered USING (nr) LEFT JOIN kept USING (nr)
    """,
    "op13_ranked_search": """
        WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
        docs AS (SELECT row_number() OVER () AS nr, doc_id,
                        regexp_extract_all(translate(coalesce(text, ''), upper, lower), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
                 FROM documents, letters),
        items AS (SELECT row_number() OVER () AS item, item_id,
                         regexp_extract_all(translate(coalesce(text, ''), upper, lower), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
                  FROM (SELECT DISTINCT item_id, text FROM benchmark), letters),
        told AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0),
        tfs AS (SELECT nr, term, count(*) AS tf FROM (SELECT nr, unnest(w) AS term FROM docs) GROUP BY nr, term),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
                    FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), told),
        asked AS (SELECT item, term, count(*) AS often FROM (SELECT item, unnest(w) AS term FROM items) GROUP BY item, term),
        scored AS (SELECT item, nr, CAST(sum(often * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(w) * n_docs) // n_terms)))) AS BIGINT) AS score
                   FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN docs USING (nr), told GROUP BY item, nr),
        ranked AS (SELECT item, nr, doc_id, score, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, nr) AS INTEGER) AS rank
                   FROM scored JOIN docs USING (nr) WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= 10
    """,
}
