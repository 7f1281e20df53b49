"""The registered queries of the text operators (digest columns of their results)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.chat_format import format_conversations, read_loss, read_turns
from demandspark.llm.common import read_table
from demandspark.llm.decontaminate import find_contamination
from demandspark.llm.fingerprints import COUNT, MASK, ONES, SIGNS, SIZE, SLOT, edit_fingerprints
from demandspark.llm.language_id import fit, held_out, identify
from demandspark.llm.license_scan import scan
from demandspark.llm.line_dedup import dedup_lines
from demandspark.llm.merkle import document_proofs
from demandspark.llm.ngram_join import near_duplicates
from demandspark.llm.packing import pack_documents
from demandspark.llm.quality_rules import ADDRESS, BOILERPLATE, NAVIGATION, clean_documents
from demandspark.llm.search import search
from demandspark.llm.suffix_dedup import remove_repeats
from demandspark.llm.token_files import read_checksums, write_token_files
from demandspark.llm.tokens import tokenizer_text
from demandspark.session import shared_dir


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_contamination(docs, read_table(spark, sf_dir, "benchmark"), min_match=5, coverage=0.5)
    return out.select("doc_id", (F.size("matches") > 0).alias("contaminated"),
                      F.coalesce(F.array_max("matches.coverage"), F.lit(0.0)).alias("coverage"),
                      F.array_sort("matches.item_id").alias("item_ids"), "matches")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, min_lines=3, min_words=50)


OP2_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(range(len(x))) AS i, unnest(x) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
counted AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w FROM lines),
runs AS (
  SELECT doc_id, i, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c, w, w + lead(w) OVER w AS w2
  FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
later AS (
  SELECT doc_id, i, 3 AS size FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS n
    FROM runs WHERE c IS NOT NULL) WHERE n > 1
  UNION ALL SELECT doc_id, i, 2 FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, i) AS n
    FROM runs WHERE w2 >= 50) WHERE n > 1
  UNION ALL SELECT doc_id, i, 1 FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY a ORDER BY doc_id, i) AS n
    FROM runs WHERE w >= 50) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest(range(3)) AS k) WHERE k < size),
marked AS (
  SELECT l.doc_id, l.i, l.line, g.i IS NOT NULL AS g,
         lag(g.i IS NOT NULL) OVER (PARTITION BY l.doc_id ORDER BY l.i) AS before
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i)
SELECT d.doc_id,
       CASE WHEN d.text IS NOT NULL
            THEN coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT g), '') END AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE g) AS n_removed,
       count(*) FILTER (WHERE g AND NOT coalesce(before, false)) AS n_runs
FROM marked m JOIN documents d ON d.doc_id = m.doc_id
GROUP BY d.doc_id, d.text"""


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clean_documents(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "n_lines_removed", F.char_length("text").cast("long").alias("clean_chars"))


OP4_SQL = """
WITH t AS (SELECT doc_id, text, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, string_split(t, chr(10)) AS lines
  FROM t),
full_lines AS (
  SELECT doc_id, list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS f FROM w),
pos AS (SELECT doc_id, words, unnest(range(len(words) - 2)) AS i FROM w WHERE len(words) > 2),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i + 1], words[i + 2], words[i + 3]) AS c FROM pos),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM win, (SELECT unnest(range(3)) AS k) WHERE c > 1 GROUP BY doc_id),
passed AS (
  SELECT doc_id, list_filter(lines, lambda x: NOT (
    100 * len(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) > 10 * len(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g'))
    OR 100 * len(regexp_replace(x, '[^!]', '', 'g')) > 10 * len(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g'))
    OR regexp_matches(x, '@NAVIGATION@') OR regexp_matches(x, '@BOILERPLATE@') OR regexp_matches(x, '@ADDRESS@')
    OR regexp_matches(x, '([.][.][.]|…)[\\x20\\x09-\\x0D]*$')
    OR (len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) BETWEEN 1 AND 3
        AND NOT regexp_matches(x, '[].!?:;,…"''”’»)][\\x20\\x09-\\x0D]*$')))) AS p
  FROM w),
m AS (
  SELECT w.doc_id, text, len(words) AS n_words,
         len(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(f) - len(list_distinct(f)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(lines) - len(p) AS n_lines_removed, array_to_string(p, chr(10)) AS clean,
         len(words) < 50 OR 100 * coalesce(n, 0) > 50 * len(words) AS base_failed
  FROM w JOIN full_lines USING (doc_id) JOIN passed USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * (word_chars - len(regexp_replace(clean, '[\\x20\\x09-\\x0D]', '', 'g')))
         <= 50 * word_chars AS kept,
       n_lines_removed, CASE WHEN text IS NOT NULL THEN len(clean) END AS clean_chars
FROM m""".replace("@NAVIGATION@", NAVIGATION).replace("@ADDRESS@", ADDRESS).replace(
    "@BOILERPLATE@", BOILERPLATE.replace("'", "''"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = format_conversations(rows.unionByName(probe))
    read = out.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                      read_loss(F.col("segments")).alias("loss"), "attachments", "expanded_tokens")
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(joined, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"),
                       F.size("attachments").cast("long").alias("n_parts"), "expanded_tokens",
                       F.array_join(F.transform("attachments", lambda p: F.concat(p["kind"], F.lit(" "), p["ref"])),
                                    "\n").alias("refs"))


OP7_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]'
  FROM (SELECT unnest([0, 1]) AS k)),
e AS (
  SELECT *, replace(replace(text, '&', '&amp;'), '<', '&lt;') AS body,
         replace(replace(role, '&', '&amp;'), '<', '&lt;') AS head,
         regexp_extract_all(text, '!\\[(image|audio|document)\\]\\([^()\\s]*\\)') AS parts
  FROM rows),
f AS (
  -- a placeholder is 7 characters longer than the part it stands for
  SELECT *, len('<|turn|><|text|><|end|>') + len(head) + len(body) + 7 * len(parts) AS size FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, body) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars, CAST(sum(len(parts)) AS BIGINT) AS n_parts,
       CAST(sum(576 * len(list_filter(parts, lambda p: starts_with(p, '![image]')))
                + 750 * len(list_filter(parts, lambda p: starts_with(p, '![audio]')))
                + 1024 * len(list_filter(parts, lambda p: starts_with(p, '![document]')))) AS BIGINT) AS expanded_tokens,
       array_to_string(list_transform(flatten(list(parts ORDER BY turn, role, body)),
         lambda p: regexp_replace(p, '^!.([a-z]+)..(.*).$', '\\1 \\2')), chr(10)) AS refs
FROM f GROUP BY conv_id"""


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_text(), capacity=2048, end_id=0)
    return out.withColumn("length", F.col("length").cast("long"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()).select("text", "lang"))
    out = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", "spans")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"), words=5, percent=75)
    return out.select("doc_id", "n_shingles", "component_id")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path, tokenizer_text(), end_id=1)
    return read_checksums(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"), (F.col("n_removed") > 0).alias("repeated"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(read_table(spark, sf_dir, "documents"))


OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
o AS (
  SELECT doc_id, t, len(t) AS n, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt
  FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST)),
e AS (SELECT *, left(t, n - n // 2) || left(nt, n // 2) AS x FROM o),
lines AS (
  SELECT doc_id, kind, unnest(string_split(CASE kind WHEN 0 THEN t WHEN 1 THEN x ELSE nt END, chr(10))) AS line
  FROM e, (SELECT unnest([0, 1, 2]) AS kind)),
hashed AS (
  SELECT doc_id, kind, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS filled, sha256(line) AS h FROM lines),
words AS (
  SELECT doc_id, kind, filled,
         [CAST('0x' || substr(h, 1, 15) AS BIGINT), CAST('0x' || substr(h, 16, 15) AS BIGINT),
          CAST('0x' || substr(h, 31, 15) AS BIGINT), CAST('0x' || substr(h, 46, 15) AS BIGINT)] AS w
  FROM hashed),
packed AS (
  SELECT doc_id, kind, p, CASE
      WHEN p >= {SIGNS} AND p < {COUNT} THEN w[p - {SIGNS} + 1] & {MASK}
      WHEN NOT filled THEN 0 WHEN p = {COUNT} THEN 1
      ELSE (w[p // {SLOT} + 1] >> (p % {SLOT})) & {ONES} END AS v
  FROM words, (SELECT unnest(range({SIZE})) AS p)),
lanes AS (
  SELECT doc_id, kind, p, CAST(sum(v & 65535) AS BIGINT) & 65535 AS a,
         CAST(sum((v >> {SLOT}) & 65535) AS BIGINT) & 65535 AS b,
         CAST(sum((v >> {2 * SLOT}) & 65535) AS BIGINT) & 65535 AS c
  FROM packed GROUP BY doc_id, kind, p),
prints AS (
  SELECT doc_id, kind,
         string_agg(lpad(lower(to_hex(a | (b << {SLOT}) | (c << {2 * SLOT}))), 15, '0'), '' ORDER BY p) AS f,
         max(a) FILTER (WHERE p = {COUNT}) AS n
  FROM lanes GROUP BY doc_id, kind),
signed AS (
  SELECT doc_id, kind, p, l,
         ((2 * CASE l WHEN 0 THEN a WHEN 1 THEN b ELSE c END - prints.n + 98304) & 65535) - 32768 AS s
  FROM lanes JOIN prints USING (doc_id, kind), (SELECT unnest([0, 1, 2]) AS l) WHERE p < {SIGNS}),
near AS (
  SELECT x.doc_id, y.kind, sum(x.s * y.s) AS dot, sum(x.s * x.s + y.s * y.s) AS size
  FROM signed x JOIN signed y ON x.doc_id = y.doc_id AND x.p = y.p AND x.l = y.l AND x.kind = 0 AND y.kind > 0
  GROUP BY x.doc_id, y.kind),
alike AS (
  SELECT doc_id, near.kind, CASE WHEN own.f = other.f THEN 1.0 WHEN size = 0 THEN 0.0
         ELSE greatest(0.0, least(1.0, 2 * dot::DOUBLE / size)) END AS v
  FROM near JOIN prints own USING (doc_id) JOIN prints other USING (doc_id)
  WHERE own.kind = 0 AND other.kind = near.kind)
SELECT e.doc_id, e.n AS n_chars, sha256(x) AS edited_sha256, f.f AS fingerprint, g.f AS edited_fingerprint,
       CAST(a.v AS DOUBLE) AS near_edited, CAST(b.v AS DOUBLE) AS near_next
FROM e JOIN (SELECT * FROM prints WHERE kind = 0) f USING (doc_id) JOIN (SELECT * FROM prints WHERE kind = 1) g USING (doc_id)
JOIN (SELECT * FROM alike WHERE kind = 1) a USING (doc_id) JOIN (SELECT * FROM alike WHERE kind = 2) b USING (doc_id)"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return document_proofs(read_table(spark, sf_dir, "documents"), picked)


OP12_SQL = r"""
WITH RECURSIVE d AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         -- crc32 of the decimal digits: each byte is followed by eight steps (-1)
         4294967295 - list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
             string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
           AS crc
  FROM documents),
l AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS claimed
  FROM d),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY source) AS size FROM l),
nodes(g, lev, i, digest, size) AS (
  SELECT g, 0, i, leaf, size FROM leaves
  UNION ALL
  SELECT g, lev + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (max(size) + 15) // 16
  FROM nodes WHERE size > 1 GROUP BY g, lev, i // 16),
tops(lev, i, digest, size) AS (
  SELECT 0, g, digest, count(*) OVER () FROM nodes WHERE size = 1
  UNION ALL
  SELECT lev + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (max(size) + 15) // 16
  FROM tops WHERE size > 1 GROUP BY lev, i // 16),
-- both kinds of trees: g is -1 at the top; a run of more than one level's nodes by its parent
runs AS (
  SELECT g, lev, i // 16 AS p, list(digest ORDER BY i) AS run FROM nodes WHERE size > 1 GROUP BY g, lev, i // 16
  UNION ALL SELECT -1, lev, i // 16, list(digest ORDER BY i) FROM tops WHERE size > 1 GROUP BY lev, i // 16),
fold(doc_id, own, leaf, g, lev, i, digest, siblings, last) AS (
  SELECT doc_id, g, leaf, g, 0, i, coalesce(claimed, leaf), '', false FROM leaves
  UNION ALL
  SELECT doc_id, own, leaf, CASE WHEN run IS NULL THEN -1 ELSE f.g END, CASE WHEN run IS NULL THEN 0 ELSE f.lev + 1 END,
         CASE WHEN run IS NULL THEN own ELSE i // 16 END,
         CASE WHEN run IS NULL THEN digest
              ELSE sha256(array_to_string(list_concat(list_concat(run[1:i % 16], [digest]), run[i % 16 + 2:]), '')) END,
         siblings || CASE WHEN run IS NULL THEN '' ELSE
           array_to_string(list_concat(run[1:i % 16], run[i % 16 + 2:]), '') END,
         run IS NULL AND f.g = -1
  FROM fold f LEFT JOIN runs r ON f.g = r.g AND f.lev = r.lev AND f.i // 16 = r.p WHERE NOT last)
SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(siblings) AS proof_sha256,
       f.digest AS folded_root, f.digest = r.digest AS verified
FROM fold f JOIN nodes s ON s.g = f.own AND s.size = 1, tops r WHERE f.last AND r.size = 1"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=20)


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM documents),
size AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM size),
tf AS (SELECT doc_id, w, count(*) AS tf FROM words GROUP BY doc_id, w),
weight AS (
  SELECT w, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM tf, corpus GROUP BY w, nn),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
terms AS (SELECT item_id, w, count(*) AS c FROM asked GROUP BY item_id, w),
scored AS (
  SELECT item_id, doc_id, CAST(sum(c * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nn) // l)))) AS BIGINT) AS score
  FROM terms JOIN tf USING (w) JOIN weight USING (w) JOIN size USING (doc_id), corpus
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20"""


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_quality_rules": op4_quality_rules,
    "op7_chat_format": op7_chat_format,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_language_id": op6_language_id,
    "op8_ngram_join": op8_ngram_join,
    "op9_token_files": op9_token_files,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_fingerprints": op11_fingerprints,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_lexical_search": op13_lexical_search,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op4_quality_rules": OP4_SQL,
    "op7_chat_format": OP7_SQL,
    "op11_fingerprints": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
