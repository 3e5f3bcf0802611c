"""The operators of this package over the whole tables, and the SQL they equal where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import content_sort, conversation_repair, license_scan, line_dedup, lm_scoring, mixing, packing, quality_classifier, quality_rules, secret_scan, simhash_dedup, token_alignment, token_cache
from .common import write_scratch


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir)).withColumnsRenamed({"id": "doc_id", "keep_id": "keep_doc_id"})


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, strict = quality_rules.POLICIES
    return quality_rules.ledger(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.passes(base)).alias("base_failed"),
        quality_rules.passes(strict).alias("kept"),
        "failed",
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_cache.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit")
    )


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_sort(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_corpus(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def mixture_levels() -> list[mixing.Level]:
    """A made-up domain, by the number that ends a source's name, then language, then source."""
    domain = F.expr("'d' || (try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int) % 4)")
    return [
        mixing.Level("mix_domain", domain, DOMAIN_WEIGHTS),
        mixing.Level("mix_lang", F.col("lang"), LANG_WEIGHTS),
        mixing.Level("mix_source", F.col("source"), SOURCE_WEIGHTS),
    ]


DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 4, "de": 3, "fr": 2, "es": 1}
SOURCE_WEIGHTS = {"src0": 3}
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 60, 2, 7


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(
        documents(spark, sf_dir), mixture_levels(), budget_percent=MIX_PERCENT, max_epochs=MIX_EPOCHS, seed=MIX_SEED
    )
    return mixed.select(
        F.col("id").alias("doc_id"), "mix_domain", "mix_lang", "mix_source", "n_tokens", "epoch", "target"
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_repair.audit_conversations(damaged, gone=F.col("gone"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_corpus(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.classify(documents(spark, sf_dir), labels).withColumnRenamed("id", "doc_id")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy costs, from the ledger that op2 measures, written once."""
    return quality_rules.ablations(write_scratch(quality_rules.ledger(documents(spark, sf_dir)), "ledger"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_quality_rules,
        op3_token_counts,
        op4_simhash_dedup,
        op5_exact_dedup,
        op6_license_scan,
        op7_secret_scan,
        op8_packing,
        op9_lm_scoring,
        op10_mixing,
        op11_conversation_repair,
        op12_token_alignment,
        op13_quality_classifier,
        quality_ablations,
    )
}

def _weight_sql(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {w}" for v, w in weights.items()) + " ELSE 1 END"


def mixture_sql(percent: int, epochs: int, seed: int) -> str:
    """The mixture as SQL: shares of the three levels one after the other, then the prefix of each leaf."""
    names = ["mix_domain", "mix_lang", "mix_source"]
    weights = [DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS]
    parts = [
        f"""WITH d AS (
            SELECT doc_id, coalesce('d' || (try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS INT) % 4), '') AS mix_domain,
                   coalesce(lang, '') AS mix_lang, coalesce(source, '') AS mix_source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
            FROM documents
        ), leaf AS (
            SELECT mix_domain, mix_lang, mix_source, sum(n_tokens) AS tokens, {epochs} * sum(n_tokens) AS capacity FROM d GROUP BY ALL
        )"""
    ]
    for k, (name, weight) in enumerate(zip(names, weights), start=1):
        own, parents = ", ".join(names[:k]), ", ".join(names[: k - 1])
        family = f"PARTITION BY {parents}" if parents else ""
        order = f"{family} ORDER BY capacity / weight, {name}"
        budget = (
            f"least((SELECT sum(tokens) FROM leaf) * {percent} // 100, (SELECT sum(capacity) FROM leaf))"
            if k == 1
            else "any_value(above.target)"
        )
        above = "" if k == 1 else f" JOIN t{k - 1} AS above USING ({parents})"
        parts.append(
            f"""n{k} AS (
            SELECT {own}, sum(capacity) AS capacity, {budget} AS budget, {_weight_sql(name, weight)} AS weight FROM leaf{above} GROUP BY {own}
        ), o{k} AS (
            SELECT *, sum(capacity) OVER ({order} ROWS UNBOUNDED PRECEDING) - capacity AS before_it,
                   sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward FROM n{k}
        ), f{k} AS (
            SELECT *, capacity * onward <= greatest(budget - before_it, 0) * weight AS filled FROM o{k}
        ), r{k} AS (
            SELECT *, budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({family}) AS open_budget,
                   sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({family}) AS open_weights,
                   sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({order} ROWS UNBOUNDED PRECEDING) AS open_upto FROM f{k}
        ), t{k} AS (
            SELECT {own}, CASE WHEN filled THEN capacity ELSE
                   open_budget * open_upto // open_weights - open_budget * (open_upto - weight) // open_weights END AS target FROM r{k}
        )"""
        )
    parts.append(
        f"""p AS (
            SELECT *, target // tokens AS whole, target % tokens AS rest FROM t3 JOIN leaf USING ({", ".join(names)}) WHERE target > 0
        ), k AS (
            SELECT *, sha256('{seed}:' || whole::BIGINT || ':' || doc_id) AS key FROM d JOIN p USING ({", ".join(names)})
        ), c AS (
            SELECT *, sum(n_tokens) OVER (PARTITION BY {", ".join(names)} ORDER BY key ROWS UNBOUNDED PRECEDING) - n_tokens AS before_it FROM k
        ), e AS (
            SELECT *, (whole + CASE WHEN rest > 0 AND before_it < rest THEN 1 ELSE 0 END)::BIGINT AS times FROM c
        )
        SELECT doc_id, {", ".join(names)}, n_tokens, unnest(range(times)) AS epoch, target::BIGINT AS target FROM e WHERE times > 0"""
    )
    return ", ".join(parts)


# The damage, the faults, and the cheapest edits by one row of the recursion per conversation, place and state: 0 before
# the first message, 1 after s, 2 after u, 3 after a.
CONVERSATION_SQL = r"""
    WITH RECURSIVE hashed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(list_reduce(flatten(list_transform(
                   string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                   lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
                   lambda a, b: CASE WHEN xor(a, b) % 2 = 1 THEN xor(xor(a, b) // 2, 3988292384) ELSE xor(a, b) // 2 END,
                   4294967295::BIGINT), 4294967295) % 20 AS kind
        FROM conversations
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM hashed WHERE kind <> 0
    ), known AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM damaged
    ), told AS (
        SELECT *, left(role, 1) AS initial, trim(text, E' \t\n\x0b\x0c\r') AS bare,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS place FROM known
    ), rows AS (
        SELECT conv_id, turn, role, text, initial, place,
               CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before
        FROM told
    ), counted AS (
        SELECT conv_id, count(*) AS n,
               coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows GROUP BY conv_id
    ), inserts(state, after, letters, cost, lines) AS (
        VALUES (0, 0, '', 0, ''), (0, 2, 'I', 3, E'\nuser:'), (0, 3, 'II', 6, E'\nuser:\nassistant:'),
               (1, 1, '', 0, ''), (1, 2, 'I', 3, E'\nuser:'), (1, 3, 'II', 6, E'\nuser:\nassistant:'),
               (2, 2, '', 0, ''), (2, 3, 'I', 3, E'\nassistant:'), (2, 2, 'II', 6, E'\nassistant:\nuser:'),
               (3, 3, '', 0, ''), (3, 2, 'I', 3, E'\nuser:'), (3, 3, 'II', 6, E'\nuser:\nassistant:')
    ), edits(state, after, letter, cost, initial, role) AS (
        VALUES (0, 0, 'D', 4, NULL, NULL), (1, 1, 'D', 4, NULL, NULL), (2, 2, 'D', 4, NULL, NULL), (3, 3, 'D', 4, NULL, NULL),
               (0, 2, 'R', 3, NULL, 'user'), (1, 2, 'R', 3, NULL, 'user'), (2, 3, 'R', 3, NULL, 'assistant'), (3, 2, 'R', 3, NULL, 'user'),
               (0, 1, 'K', 0, 's', NULL), (0, 2, 'K', 0, 'u', NULL), (1, 2, 'K', 0, 'u', NULL), (2, 3, 'K', 0, 'a', NULL), (3, 2, 'K', 0, 'u', NULL)
    ), best AS (
        SELECT conv_id, 0::BIGINT AS place, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} AS way FROM counted
        UNION ALL
        SELECT r.conv_id, r.place, e.after, min({
                   'cost': b.way.cost + i.cost + e.cost + CASE WHEN r.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END,
                   'audit': b.way.audit || i.letters || e.letter,
                   'lines': b.way.lines || i.lines || CASE WHEN e.letter = 'D' THEN '' ELSE chr(10) || coalesce(e.role, r.role) || ':' || r.text END})
        FROM best b JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.place = b.place + 1
             JOIN inserts i ON i.state = b.state
             JOIN edits e ON e.state = i.after AND (e.initial IS NULL OR e.initial = r.initial) AND (e.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
        GROUP BY ALL
    ), ended AS (
        SELECT b.conv_id, min({'cost': b.way.cost + i.cost, 'audit': b.way.audit || i.letters, 'lines': b.way.lines || i.lines}) AS way
        FROM best b JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.place
             JOIN inserts i ON i.state = b.state AND i.after IN (0, 3)
        GROUP BY b.conv_id
    )
    SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.way.cost, 0)::BIGINT AS cost,
           coalesce(e.way.audit, '') AS audit, sha256(coalesce(substr(e.way.lines, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
         LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
"""

ORACLE: dict[str, str] = {
    "op2_quality_rules": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ), w AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)
        ), r AS (
            SELECT doc_id, count(DISTINCT place) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM w WHERE times > 1) GROUP BY doc_id
        ), m AS (
            SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   len(list_distinct(words)) AS n_distinct_words,
                   len(list_filter(words, lambda x: right(x, 1) IN ('.', ',', ';', ':', '!', '?'))) AS n_stops,
                   len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_lettered
            FROM d LEFT JOIN r USING (doc_id)
        ), f AS (
            SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
                   + 4 * (100 * n_symbols > 10 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 40 * n_lines)::BIGINT
                   + 16 * (n_words > 0 AND (100 * word_chars < 300 * n_words OR 100 * word_chars > 1000 * n_words))::BIGINT
                   + 32 * (n_words > 0 AND 100 * n_stops < 2 * n_words)::BIGINT
                   + 64 * (n_words > 0 AND 100 * n_distinct_words < 5 * n_words)::BIGINT
                   + 128 * (n_words > 0 AND 100 * n_lettered < 70 * n_words)::BIGINT AS failed FROM m
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
               failed = 0 AS kept, failed FROM f
    """,
    "op5_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY norm)
    """,
    "op10_mixing": mixture_sql(MIX_PERCENT, MIX_EPOCHS, MIX_SEED),
    "op11_conversation_repair": CONVERSATION_SQL,
}

# the bits the SQL above gives the rules, which strict-1 has all of, in their order
_bits = {rule: 1 << k for k, rule in enumerate(quality_rules.POLICIES[-1].rules)}
_asked = ", ".join(
    f"('{p.version}', '{rule}', {sum(_bits[name] for name in p.rules)}, {_bits[rule]})" for p in quality_rules.POLICIES for rule in p.rules
)
ORACLE["quality_ablations"] = f"""
    SELECT version, rule, count(*) FILTER (failed & mask = 0) AS kept, count(*) FILTER (failed & bit <> 0) AS broken,
           count(*) FILTER (failed & (mask - bit) = 0) AS kept_without
    FROM ({ORACLE["op2_quality_rules"]}) l, (VALUES {_asked}) p(version, rule, mask, bit) GROUP BY version, rule
"""
