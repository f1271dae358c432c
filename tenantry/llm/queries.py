"""The registered queries of the operators for training text, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tenantry.llm import chat, decontamination, fm_dedup, html_text, language, merkle, near_dedup, packing, quality, spelling, suffix_dedup, toxicity, url_filter
from tenantry.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def op1_classifier_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's probabilities of low quality and of toxicity, and whether it is toxic."""
    scored = toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", "p_low_quality", "p_toxic", "toxic")


def op2_digest_array(spark: SparkSession, folder: str) -> DataFrame:
    """Each page's url against the rules, and against the hosts of pages with a spam label."""
    pages = table(spark, folder, "pages")
    judged = url_filter.filter_urls(pages, url_filter.spam_hosts(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_block_max_wand(spark: SparkSession, folder: str) -> DataFrame:
    """Each document and benchmark item that it leaks, with the best passage's figures."""
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_risk_controlled(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's counts and whether base rules and proven cutoffs keep it."""
    judged = quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_tree_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of each page."""
    return html_text.extract(table(spark, folder, "pages"))


def op6_probminhash(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's near-duplicate class."""
    return near_dedup.classes(table(spark, folder, "documents"))


def op7_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    """The turns of each conversation after the cheapest repair, rendered."""
    return chat.repair(table(spark, folder, "conversations"))


def op8_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Each piece of each document with its place in a sequence."""
    packed = packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_two_stage_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """Each document without the bytes of 50-byte strings that a smaller doc_id has too."""
    left = suffix_dedup.remove_repeated_strings(table(spark, folder, "documents"), outputs=False)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_fm_index(spark: SparkSession, folder: str) -> DataFrame:
    """Each document without the words of 35-word windows that occur twice."""
    left = fm_dedup.remove_repeated_windows(table(spark, folder, "documents"), outputs=False)
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_octopus_multiproof(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's leaf, proof and verdict in the manifest of all documents, some of them tampered with."""
    proven = merkle.verify(table(spark, folder, "documents"), merkle.tampered())
    return proven.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_word_first_backoff(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's language by a model of the documents that are not held out."""
    return language.identify(table(spark, folder, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op13_search_schemes(spark: SparkSession, folder: str) -> DataFrame:
    """Each word with the number of its near words, and the frequent one that it is a variant of."""
    return spelling.variants(table(spark, folder, "documents")).select("word", "n", "n_near", "form", "form_n", "root")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_classifier_chain, op2_digest_array, op3_block_max_wand, op4_risk_controlled, op5_tree_scoring, op6_probminhash,
        op7_role_repair, op8_best_two_fit, op9_two_stage_suffixes, op10_fm_index, op11_octopus_multiproof,
        op12_word_first_backoff, op13_search_schemes,
    )
}


def _op2_sql() -> str:
    cases = [
        f"SELECT '{rule}' AS rule, '{rule.partition('/')[0]}' AS rhost, '{rule[rule.index('/'):]}' AS rpath, '{verdict}' AS rverdict" for rule, verdict in url_filter.RULES
    ]
    labels = "|".join(url_filter.SPAM_LABELS)
    return f"""
    WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    rules AS ({" UNION ALL ".join(cases)}),
    best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rverdict, length(rule)) AS rverdict
        FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
    SELECT page_id, host, path, rule,
        coalesce(rverdict, CASE WHEN regexp_matches(host, '(^|\\.)({labels})(\\.|$)') THEN 'block' ELSE 'allow' END) AS verdict
    FROM parts LEFT JOIN best USING (page_id)"""


def _op4_sql() -> str:
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    figures = {
        "symbols_per_word": "n_symbols / n_words",
        "repeat_share": "n_repeat_words / n_words",
        "dup_lines_per_word": "n_dup_lines / n_words",
        "chars_per_word": "word_chars / n_words",
        "shouts_per_word": "n_shouts / n_words",
    }
    rate, risk = quality.TOLERATED, quality.RISK
    columns = list(zip(*quality.CUTOFFS.values(), strict=True))
    levels = " UNION ALL ".join(f"SELECT {j} AS level, {', '.join(f'{c!r}::DOUBLE AS max_{name}' for name, c in zip(quality.CUTOFFS, own, strict=True))}" for j, own in enumerate(columns))
    over = " OR ".join(f"{value} > max_{name}" for name, value in figures.items())
    return f"""
    WITH t AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS word, generate_subscripts(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), 1) AS i FROM t),
    g AS (SELECT doc_id, i, a, b, c, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM (
        SELECT doc_id, i, word AS a, lead(word, 1) OVER p AS b, lead(word, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)) WHERE c IS NOT NULL),
    r AS (SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words FROM g, (SELECT unnest([0, 1, 2]) AS d) WHERE n > 1 GROUP BY doc_id),
    s AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
    l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
        WHERE trim(line, {white}) <> '' GROUP BY doc_id),
    m AS MATERIALIZED (SELECT t.doc_id, stratum, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(text, '!!')) AS n_shouts, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_words, 0) < {quality.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {quality.MAX_REPEAT_PERCENT} * coalesce(n_words, 0) AS base_failed
        FROM t LEFT JOIN s USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
    held AS (SELECT * FROM m WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1)),
    levels AS ({levels}),
    tests AS (SELECT stratum, level, count(*) AS n, count(*) FILTER (WHERE {over}) AS k FROM held, levels GROUP BY ALL),
    able AS (SELECT *, count(DISTINCT coalesce(stratum, '-')) OVER () AS strata FROM tests WHERE pow(1 - {rate}, n) <= {risk}),
    tails AS (SELECT *, CASE WHEN k > n * {rate} THEN 1.0 ELSE
        list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({rate}) + (n - j) * ln(1 - {rate})))) END AS p FROM able),
    passing AS (SELECT *, bool_and(p <= {risk} / strata) OVER (PARTITION BY stratum ORDER BY level) AS proven FROM tails),
    used AS (SELECT stratum, max(level) AS level FROM passing WHERE proven GROUP BY ALL)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce({over}, false) AS kept
    FROM m LEFT JOIN used ON used.stratum IS NOT DISTINCT FROM m.stratum LEFT JOIN levels USING (level)"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII text."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)] || [-1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END"
    return f"xor(list_reduce([4294967295::BIGINT] || list_transform({steps}, lambda v: v::BIGINT), lambda s, x: {step}), 4294967295)"


def _op11_sql() -> str:
    def encoded(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"

    def leaf(n_chars: str) -> str:
        return f"sha256({' || '.join(encoded(n_chars if c == 'n_chars' else c) for c in merkle.FIELDS)})"

    def levels(name: str, leaves: str) -> str:
        return f"""{name} AS (SELECT tree, 0::BIGINT AS level, pos AS idx, digest, n AS width FROM {leaves}
        UNION ALL SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), any_value((width + 1) // 2)
        FROM {name} WHERE width > 1 GROUP BY tree, level, idx // 2)"""

    def folds(name: str, rows: str, nodes: str) -> str:
        return f"""{name} AS (SELECT row, tree, pos, n AS width, claimed AS digest, '' AS proof, 0::BIGINT AS level FROM {rows}
        UNION ALL SELECT f.row, f.tree, f.pos // 2, (f.width + 1) // 2,
            sha256(CASE WHEN s.digest IS NULL THEN f.digest WHEN f.pos % 2 = 1 THEN s.digest || f.digest ELSE f.digest || s.digest END),
            f.proof || coalesce(s.digest, ''), f.level + 1
        FROM {name} f LEFT JOIN {nodes} s ON s.tree = f.tree AND s.level = f.level AND s.idx = xor(f.pos, 1) WHERE f.width > 1)"""

    return f"""
    WITH RECURSIVE d AS MATERIALIZED (SELECT *, {leaf("n_chars")} AS digest, {leaf("hit_chars")} AS claimed, {encoded("lang")} AS tree, row_number() OVER () AS row
        FROM (SELECT *, CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS hit_chars FROM documents)),
    l AS MATERIALIZED (SELECT row, doc_id, tree, digest, claimed, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
    {levels("nodes", "l")},
    subroots AS MATERIALIZED (SELECT 'top' AS tree, nodes.tree AS row, digest, digest AS claimed, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM nodes JOIN (SELECT DISTINCT tree, lang FROM d) USING (tree) WHERE width = 1),
    {levels("crown", "subroots")},
    {folds("low", "l", "nodes")},
    {folds("high", "(SELECT low.row, 'top' AS tree, s.pos, s.n, low.digest AS claimed FROM low JOIN subroots s ON s.row = low.tree WHERE low.width = 1)", "crown")}
    SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(low.proof || high.proof) AS proof_sha256,
        high.digest AS folded_root, high.digest = r.digest AS verified
    FROM l JOIN low ON low.row = l.row AND low.width = 1 JOIN high ON high.row = l.row AND high.width = 1
        JOIN subroots s ON s.row = l.tree, (SELECT digest FROM crown WHERE width = 1) r"""


SQL: dict[str, str] = {"op2_digest_array": _op2_sql(), "op4_risk_controlled": _op4_sql(), "op11_octopus_multiproof": _op11_sql()}
