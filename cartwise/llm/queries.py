"""The thin ``opN_<name>`` queries, their DuckDB SQL where SQL can express them,
and ``pipeline``. Each takes (spark, sf_dir) and runs its operator over the whole
intended table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwise.llm.common import table


def op2_ann_tree(spark, sf_dir):
    from cartwise.llm.ann_tree import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.expr("pmod(id, 20) = 0"))


def op3_simhash_near_dedup(spark, sf_dir):
    from cartwise.llm.simhash_dedup import simhash_components
    rows = simhash_components(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")


def op1_substring_dedup(spark, sf_dir):
    from cartwise.llm.substring_dedup import substring_dedup
    rows = substring_dedup(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def byte_bpe_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark, sf_dir):
    from cartwise.llm.bpe import round_trip
    rows = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), byte_bpe_path())
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_decontaminate(spark, sf_dir):
    """Every (document, benchmark item) match: edits and the span in the normalised text."""
    from cartwise.llm.decontaminate import matches
    rows = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(F.col("id").alias("doc_id"), "item_id", "edits", "start", "stop")


#: The rules (host and path, verdict) of the URL query.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]


def op6_url_filter(spark, sf_dir):
    from cartwise.llm.url_filter import url_filter
    rules = spark.createDataFrame(URL_RULES, "entry string, verdict string")
    return url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


#: Fixed value: a conversation whose texts are the control strings of a template.
CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_format(spark, sf_dir):
    from cartwise.llm.chat_format import format_turns, read_back
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(CONTROL_TURNS, "conv_id bigint, turn bigint, role string, text string")
    return read_back(format_turns(rows.unionByName(more), byte_bpe_path()), byte_bpe_path())


def op9_warc(spark, sf_dir):
    """The payload of responses is read and measured; revisits are read by their headers."""
    from cartwise.llm.common import work_path
    from cartwise.llm.warc import archive, key_of, measured, read_archive
    path = archive(table(spark, sf_dir, "pages"), work_path(spark, "warc"))
    responses = measured(read_archive(spark, path, "record_type string, key bigint, payload binary")
                         .where("record_type = 'response'").select("key", "payload"))
    revisits = read_archive(spark, path, "record_type string, key bigint, payload_digest string, payload_length bigint, "
                                         "refers_to string").where("record_type = 'revisit'")
    return (responses.select(F.col("key").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest",
                             F.lit("response").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to"))
            .unionByName(revisits.select(F.col("key").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
                                         "payload_digest", "record_type", key_of("refers_to").alias("refers_to"))))


#: Rows whose labels may be learned: crc32 of the id as text is no multiple of 5.
TRAIN_ROWS = "pmod(crc32(CAST(CAST(id AS STRING) AS BINARY)), 5) <> 0"


def op8_quality(spark, sf_dir):
    from cartwise.llm.quality import THRESHOLD, score_quality
    rows = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train_when=F.expr(TRAIN_ROWS))
    return rows.select(F.col("id").alias("doc_id"), (~F.expr(TRAIN_ROWS)).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op10_pii(spark, sf_dir):
    from cartwise.llm.pii import KINDS, find_pii, span_text
    rows = find_pii(table(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = [F.expr(f"CAST(size(filter(base, s -> s.k = {i})) AS BIGINT)").alias(f"n_{k}")
              for i, k in enumerate(KINDS[:4])]
    return rows.select("doc_id", *counts, F.sha2(span_text("base"), 256).alias("base_sha256"),
                       span_text("spans").alias("spans"))


def op11_ranked_search(spark, sf_dir):
    from cartwise.llm.ranked_search import ranked_search
    found = ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def op12_quality_rules(spark, sf_dir):
    """The base counts and verdict of the contract, and whether the text passes every rule of the table."""
    from cartwise.llm.quality_rules import judge
    rows = judge(table(spark, sf_dir, "documents").select("doc_id", "text"), out="r")
    counts = [F.col(f"r.counts.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select("doc_id", *counts, "r.base_failed", (F.size("r.failed") == 0).alias("kept"))


def with_planted_periods(docs):
    """The texts of the contract: where crc32(doc_id) is a multiple of ten, the words from
    place ``a`` on repeat the ``p`` words that begin there."""
    spaces = r"\t\n\u000B\u000C\r "
    words = rf"split(btrim(text, '{spaces}'), '[\\x20\\x09-\\x0D]+')"
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", h.alias("h"))
    d = d.withColumn("w", F.expr(f"CASE WHEN h % 10 = 0 AND btrim(text, '{spaces}') <> '' THEN {words} END"))
    d = d.withColumns({"g": F.expr("h div 10"), "n": F.size("w")}).withColumn("a", F.expr("g % n"))
    d = d.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    return d.select("doc_id", F.expr("""CASE WHEN w IS NULL THEN text ELSE array_join(transform(
        sequence(0, n - 1), i -> w[CAST(IF(i < a, i, a + (i - a) % p) AS INT)]), ' ') END""").alias("text"))


#: The run of greatest length / period, compared exactly; the runs come by start, then period.
_BEST_RUN = """aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>),
    (a, r) -> CASE WHEN a IS NULL OR r.length * a.period > a.length * r.period THEN r ELSE a END)"""
_RUN_LINES = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"


def op13_periodic_runs(spark, sf_dir):
    from cartwise.llm.periodic_runs import periodic_runs
    rows = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    rows = rows.withColumn("best", F.expr(_BEST_RUN))
    return rows.select(F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"),
                       "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(F.expr(_RUN_LINES), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_substring_dedup": op1_substring_dedup,
    "op2_ann_tree": op2_ann_tree,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_bpe": op4_bpe,
    "op5_decontaminate": op5_decontaminate,
    "op6_url_filter": op6_url_filter,
    "op7_chat_format": op7_chat_format,
    "op8_quality": op8_quality,
    "op9_warc": op9_warc,
    "op10_pii": op10_pii,
    "op11_ranked_search": op11_ranked_search,
    "op12_quality_rules": op12_quality_rules,
    "op13_periodic_runs": op13_periodic_runs,
}

#: Word windows of 13 joined by a space, against the smallest id that holds the same words.
_OP1_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
             FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
     least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s HAVING count(DISTINCT doc_id) > 1),
     gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p
              FROM win JOIN least USING (s) WHERE m < doc_id),
     gw AS (SELECT r, list(p) AS ps FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w ELSE
           list_transform(list_filter(list_transform(w, lambda x, j: {'x': x, 'j': j}),
                                      lambda y: NOT list_contains(ps, y.j)), lambda y: y.x) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gw USING (r)"""

_OP6_SQL = r"""
WITH rules(entry, h, p, verdict) AS (VALUES
       ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
       ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
       ('net/fr/', 'net', '/fr/', 'block')),
     u AS (SELECT page_id, row_number() OVER () AS r,
                  CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
                       ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
     s AS (SELECT page_id, r, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
     hit AS (SELECT r, arg_max(entry, length(entry)) AS rule, arg_max(verdict, length(entry)) AS verdict
             FROM s JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM s LEFT JOIN hit USING (r)"""

#: A backslash goes into each control string, so a text grows by the control strings it holds.
_OP7_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
     e AS (SELECT *, length(role) + length(text) + length('<|im_start|><|im_sep|><|im_end|>') + len(regexp_extract_all(
                  role || chr(10) || text,
                  '<\\*\|(?:im_start|im_sep|im_end|endoftext)\|>|<\\*/?s>|\[\\*/?INST\]')) AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM (SELECT *, row_number() OVER (ORDER BY turn NULLS FIRST, role, text) AS k FROM e) GROUP BY conv_id"""

#: Base 32 of a hex digest: five hex digits are four letters.
_OP9_SQL = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
     q AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS m,
                  list_transform(range(0, 8), lambda i: CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS v
           FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((v[j // 4 + 1] >> (15 - 5 * (j % 4))) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> m THEN m END AS refers_to
FROM q"""

#: Every (item, document) pair that shares a term, scored.
_OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
     n AS (SELECT r, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
     g AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM n),
     b AS (SELECT row_number() OVER () AS k, item_id, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
     q AS (SELECT k, item_id, term, count(*) AS c FROM (SELECT k, item_id, unnest(t) AS term FROM b) GROUP BY ALL),
     f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
           WHERE term IN (SELECT term FROM q) GROUP BY ALL),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM f, g GROUP BY term, nn),
     s AS (SELECT k, item_id, r, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))))
                  AS BIGINT) AS score
           FROM q JOIN w USING (term) JOIN f USING (term) JOIN n USING (r), g GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10"""

#: Counts as the rules of ``quality_rules.RULES`` take them; ratios compared in integers.
_OP12_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
           FROM documents),
     win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s
             FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
     rep AS (SELECT r, s FROM win GROUP BY r, s HAVING count(*) > 1),
     cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM win JOIN rep USING (r, s))
             GROUP BY r),
     c AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                  length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
                  length(t) - length(translate(t, '0123456789', '')) AS n_digits,
                  len(list_filter(w, lambda x: list_contains(STOPS, x))) AS n_stop_words,
                  len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                  len(list_filter(ls, lambda l: l[1:2] IN ('- ', '* ') OR l[1] = chr(8226))) AS n_bullet_lines,
                  len(list_filter(ls, lambda l: suffix(l, '...') OR suffix(l, chr(8230)))) AS n_ellipsis_lines,
                  coalesce(n, 0) AS n_repeat_words
           FROM d LEFT JOIN cov USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
            OR word_chars * 1000 < 1500 * n_words OR word_chars * 1000 > 15000 * n_words
            OR n_symbols * 1000 > 100 * n_words OR n_digits * 1000 > 300 * word_chars
            OR n_stop_words * 1000 < 20 * n_words OR n_dup_lines * 1000 > 400 * n_lines
            OR n_bullet_lines * 1000 > 900 * n_lines OR n_ellipsis_lines * 1000 > 300 * n_lines) AS kept
FROM c"""


def _op12_sql() -> str:
    from cartwise.llm.quality_rules import STOP_WORDS
    stops = ", ".join(f"'{x}'" for w in STOP_WORDS for x in (w, w.capitalize()))
    return _OP12_SQL.replace("STOPS", f"[{stops}]")


ORACLE_SQL: dict[str, str] = {
    "op11_ranked_search": _OP11_SQL,
    "op12_quality_rules": _op12_sql(),
    "op6_url_filter": _OP6_SQL,
    "op1_substring_dedup": _OP1_SQL,
    "op7_chat_format": _OP7_SQL,
    "op9_warc": _OP9_SQL,
}
