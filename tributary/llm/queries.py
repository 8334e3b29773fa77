"""One query for each operator of this package over the driver's tables, and the same as SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import exact_dedup, filter_audit, language_id, license_scan, mixing, periodic_runs, quality_classifier, quality_rules, secret_scan, sentencepiece_codec, sharding, simhash, token_counts
from tributary.llm.shared import documents


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest(sentencepiece_codec.encode_documents(documents(spark, sf_dir)))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_with_planted(documents(spark, sf_dir))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_token_counts, op3_quality_rules, op4_simhash, op5_sentencepiece, op6_secret_scan, op7_sharding, op8_quality_classifier, op9_exact_dedup, op10_language_id,
    op11_filter_audit, op12_periodic_runs, op13_license_scan,
)}

_STOPS = ", ".join(f"'{w}'" for w in [*quality_rules.STOP_WORDS, *(w.capitalize() for w in quality_rules.STOP_WORDS)])

_SETS = license_scan.template_sets(license_scan.TEMPLATES)


def _listed(words: list[bytes]) -> str:
    return f"[{', '.join(repr(w.decode()) for w in words)}]"


#: Template number, label, distinct words, how many of them a block must hold, and which ones.
_TEMPLATES = ", ".join(f"({k}, '{t.label}', {_listed(t.words)}, {license_scan.needed(len(t.words), license_scan.THRESHOLD)}, {_listed(t.marks)})" for k, t in enumerate(_SETS))
#: A template, and one that holds all its words and more.
_WIDER = ", ".join(f"({k}, {other})" for k, others in enumerate(license_scan.wider(_SETS)) for other in others)
_PHRASES = ", ".join(f"('{phrase}', {len(phrase.split())}, '{label}')" for phrase, label in license_scan.PHRASES.items())

ORACLE_SQL = {
    "op11_filter_audit": r"""
        WITH known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
        t AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                   min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
            FROM documents),
        masks AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
                   + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS mask
            FROM t LEFT JOIN known USING (doc_id)),
        n AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY 1, 2),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x) JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
        steps AS (
            SELECT filter_order, s::INT AS step, 1 << (ord(filter_order[s]) - 65) AS own, list_sum(list_transform(range(1, s + 1), lambda j: 1 << (ord(filter_order[j]) - 65)))::INT AS upto
            FROM orders, unnest(range(1, 6)) AS r(s)),
        counted AS (
            SELECT part, filter_order, step, own,
                   coalesce(sum(n) FILTER (mask & upto = 0), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (mask & upto = own), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (mask & own <> 0 AND mask & (upto - own) <> 0), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (mask & upto = own), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (mask & upto = own), 0)::BIGINT AS toxic_lost
            FROM n, steps GROUP BY 1, 2, 3, 4)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM counted""",
    "op13_license_scan": rf"""
        WITH templates(template, label, ws, need, marks) AS (VALUES {_TEMPLATES}),
        wider(template, other) AS (VALUES {_WIDER}),
        phrases(phrase, k, label) AS (VALUES {_PHRASES}),
        t AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
            FROM documents),
        holding AS (SELECT r, w, phrase, k, label FROM t JOIN phrases ON contains(' ' || array_to_string(w, ' ') || ' ', ' ' || phrase || ' ')),
        starts AS (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM holding),
        places AS (SELECT r, i - 1 AS start, label FROM starts WHERE array_to_string(w[i:i + k - 1], ' ') = phrase),
        base AS (SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS base FROM places GROUP BY r),
        blocks AS (
            SELECT r, b, unnest(list_distinct(w[b * {license_scan.STEP} + 1:b * {license_scan.STEP} + {license_scan.BLOCK}])) AS word
            FROM (SELECT r, w, unnest(range(0, 1 + greatest(0, ceil((len(w) - {license_scan.BLOCK}) / {license_scan.STEP})::BIGINT))) AS b FROM t)),
        asked AS (SELECT template, label, len(ws) AS size, need, marks, unnest(ws) AS word FROM templates),
        pairs AS (
            SELECT r, b, template, label, count(*) / size AS containment FROM blocks JOIN asked USING (word) GROUP BY r, b, template, label, size, need, marks
            HAVING count(*) >= need AND len(marks) = count(*) FILTER (list_contains(marks, word))),
        told AS (SELECT p.* FROM pairs p ANTI JOIN (SELECT q.r, q.b, wider.template FROM pairs q JOIN wider ON wider.other = q.template) w ON p.r = w.r AND p.b = w.b AND p.template = w.template),
        own AS (SELECT r, max(containment) AS containment, list(DISTINCT label) AS own FROM told GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
               array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ',') AS labels,
               greatest(coalesce(containment, 0), (coalesce(n_base, 0) > 0)::INT)::DOUBLE AS score
        FROM t LEFT JOIN base USING (r) LEFT JOIN own USING (r)""",
    "op3_quality_rules": rf"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t),
        grams AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM starts),
        twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c >= 2),
        covered AS (SELECT doc_id, count(DISTINCT j) AS r FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY doc_id),
        c AS (
            SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words,
                   len(l)::BIGINT AS n_lines, len(list_filter(w, lambda x: rtrim(x, '.,;:?') IN ({_STOPS})))::BIGINT AS n_stop_words
            FROM t LEFT JOIN covered USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
                 AND word_chars / n_words BETWEEN 2.0 AND 16.0 AND n_symbols / n_words <= 0.4
                 AND n_stop_words / n_words >= 0.02 AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5) AS kept,
               n_lines, n_stop_words
        FROM c""",
    "op9_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
        k AS (SELECT doc_id, body, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY body) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k""",
}
