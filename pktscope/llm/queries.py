"""Registered queries of this package: each takes (spark, sf_dir), reads its
whole table and returns the full result.  ``ORACLES`` holds DuckDB SQL where
SQL can express the query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    return pack(_table(spark, sf_dir, "documents"))


@query
def op2_relational_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_chat, read_turns, trained_text
    said = r"\### Assistant: </turn> ok"
    turns = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    out = format_chat(turns.unionByName(extra)).select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"),
        trained_text(F.col("segments")).alias("trained"), F.length("formatted").alias("formatted_chars"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(spoken, 256).alias("turns_sha256"),
                      F.length("trained").cast("long").alias("loss_chars"),
                      F.sha2("trained", 256).alias("loss_sha256"),
                      F.col("formatted_chars").cast("long").alias("formatted_chars"))


ORACLES["op2_relational_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (
  SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS follows
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
c AS (
  SELECT *, regexp_replace(text, '(\\*<(?:turn:|/turn|part))', '\\\1', 'g') AS escaped FROM m)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(escaped)
      + CASE WHEN follows THEN length(chr(10) || '<part>' || chr(10))
             ELSE length('<turn:' || role || '>' || chr(10)) + length(chr(10) || '</turn>' || chr(10)) END)
    AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


@query
def op3_simhash_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import classes
    found = classes(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats
    found = remove_repeats(_table(spark, sf_dir, "documents"), with_kept=True)
    # the cuts are between bytes: a character cut apart reads as U+FFFD
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


@query
def op5_bit_plane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokenbin import read_tokens, write_tokens
    return read_tokens(write_tokens(_table(spark, sf_dir, "documents")))


@query
def op6_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_warc, write_warc
    return read_warc(write_warc(_table(spark, sf_dir, "pages")))


ORACLES["op6_sharded_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5))::INT >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""


@query
def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymise
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, count_col="n_replaced")


@query
def op8_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find
    hits = find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "distance")


@query
def op9_quality_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import verdicts
    v = verdicts(_table(spark, sf_dir, "documents"))
    return v.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols",
                    "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    "n_removed_words", "depleted")


ORACLES["op9_quality_line_frequency"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
grams AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g
          FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT rid, CAST(sum(least(8, nxt - i)) AS BIGINT) AS n
            FROM (SELECT rid, i, lead(i, 1, i + 8) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
lines AS (SELECT rid, line, norm, len(string_split(norm, ' ')) AS n, CAST('0x' || substr(md5(norm), 1, 15) AS BIGINT) AS h
          FROM (SELECT rid, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
                FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d))
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid),
texts AS (SELECT min(rid) AS rid, host, count(*) OVER (PARTITION BY host) AS host_docs FROM d GROUP BY host, text),
limits AS (SELECT *, greatest(5, least(0.05 * host_docs, 200)) AS most FROM texts),
held AS (SELECT t.rid, t.host, t.most, l.h, sum(l.n) AS n FROM limits t JOIN lines l USING (rid) GROUP BY ALL),
frequent AS (SELECT *, sum(n) OVER (PARTITION BY rid) AS words, min(h) OVER (PARTITION BY rid) AS low
             FROM (SELECT *, count(*) OVER (PARTITION BY host, h) AS docs FROM held) WHERE docs > most),
bad AS (SELECT f.host, f.h FROM frequent f JOIN w USING (rid) GROUP BY f.host, f.h, f.most
        HAVING count(DISTINCT CASE WHEN f.words > 0.8 * len(w.ws) THEN 'line ' || f.low ELSE 'text ' || f.rid END) > f.most),
gone AS (SELECT l.rid, CAST(sum(l.n) AS BIGINT) AS n
         FROM lines l JOIN d USING (rid) JOIN bad b ON d.host IS NOT DISTINCT FROM b.host AND l.h = b.h GROUP BY l.rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
        coalesce(gone.n, 0) AS n_removed_words
      FROM d JOIN w USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN gone USING (rid)),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        n_removed_words > 0 AND (n_words - n_removed_words < 20 OR n_removed_words > 0.5 * n_words) AS depleted FROM m)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM v
"""


@query
def op10_line_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import deduplicate
    out = deduplicate(_table(spark, sf_dir, "documents"))
    return out.withColumn("spans", F.array_join(F.transform(
        "spans", lambda s: F.concat_ws("+", s["start"], s["length"])), ","))


ORACLES["op10_line_hash_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?][ \t]+|\n\s*)', '\1' || chr(1), 'g'), chr(1)) AS ps FROM d),
pieces AS (SELECT doc_id, unnest(range(1, len(ps) + 1)) AS pos, unnest(ps) AS piece FROM cut),
placed AS (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos) - length(piece) AS start,
             trim(regexp_replace(lower(piece), '\s+', ' ', 'g')) AS norm FROM pieces),
units AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k,
            row_number() OVER (PARTITION BY norm ORDER BY doc_id, pos) > 1 AS again,
            len(string_split(norm, ' ')) AS words FROM placed WHERE norm <> ''),
runs AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, again ORDER BY k) AS run FROM units),
gone AS (SELECT doc_id, CAST(min(start) AS BIGINT) AS a, CAST(max(start + length(piece)) AS BIGINT) AS b, count(*) AS n
         FROM runs WHERE again GROUP BY doc_id, run HAVING sum(words) >= 15),
spans AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_removed, CAST(sum(b - a) AS BIGINT) AS removed_chars,
            string_agg(a || '+' || (b - a), ',' ORDER BY a) AS spans FROM gone GROUP BY doc_id),
kept AS (SELECT p.doc_id, string_agg(piece, '' ORDER BY pos) AS text FROM placed p
         LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.start >= g.a AND p.start < g.b AND p.norm || piece <> ''
         WHERE g.doc_id IS NULL GROUP BY p.doc_id),
counted AS (SELECT doc_id, count(*) AS n_units FROM units GROUP BY doc_id)
SELECT d.doc_id, coalesce(kept.text, '') AS text, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units,
  coalesce(n_removed, 0) AS n_removed, coalesce(removed_chars, 0) AS removed_chars, coalesce(spans, '') AS spans
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id) LEFT JOIN spans USING (doc_id)
"""


@query
def op11_frequency_vector_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .variants import spellings, vocabulary
    return spellings(vocabulary(_table(spark, sf_dir, "documents")))


@query
def op12_lempel_ziv_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lempel_ziv import half_replaced
    found = half_replaced(_table(spark, sf_dir, "documents"))
    text = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(text).withColumnRenamed("id", "doc_id")


@query
def op13_merkle_pointer_jumping(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import FIELDS, digest, fold_proof, manifest
    tampered = digest(*[F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = manifest(_table(spark, sf_dir, "documents"), also={"changed": F.when(hit, tampered)})
    return found.withColumn("folded_root", fold_proof(F.coalesce("changed", "leaf"))).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


#: crc32 of a string of ASCII characters as DuckDB SQL: the table of the
#: reversed polynomial (joined as ``t``), and the fold over the bytes.
CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
    FROM range(256) r(b)))"""


def _crc_sql(bytes_list: str) -> str:
    return (f"xor(list_reduce({bytes_list}, lambda c, b: xor(c >> 8, t"
            "[CAST(xor(c, b) & 255 AS INT) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)")


def _leaf_sql(*fields: str) -> str:
    parts = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


ORACLES["op13_merkle_pointer_jumping"] = f"""
WITH RECURSIVE {CRC_TABLE},
d AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf_sql("doc_id", "source", "lang", "n_chars", "text")} AS leaf, {_leaf_sql("doc_id", "source", "lang", "(n_chars + 1)", "text")} AS changed,
    {_crc_sql("list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT))")} AS crc
  FROM documents, crc_table),
leaves AS MATERIALIZED (
  SELECT *, coalesce('=' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM d),
low(tree, lvl, n, i, h) AS (
  SELECT tree, 0, n, i, leaf FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, (n + 1) // 2, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1
  GROUP BY tree, lvl, n, i // 2),
subroots AS MATERIALIZED (
  SELECT tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, n, i, h) AS (
  SELECT 0, n, i, h FROM subroots
  UNION ALL
  SELECT lvl + 1, (n + 1) // 2, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY lvl, n, i // 2),
walk(doc_id, leaf, tree, lvl, n, i, proof, f) AS (
  SELECT doc_id, leaf, tree, 0, n, i, '', CASE WHEN crc % 7 = 0 THEN coalesce(changed, leaf) ELSE leaf END FROM leaves
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.lvl + 1, (w.n + 1) // 2, w.i // 2, w.proof || coalesce(s.h, ''),
    sha256(CASE WHEN w.i % 2 = 1 THEN coalesce(s.h, '') || w.f ELSE w.f || coalesce(s.h, '') END)
  FROM walk w LEFT JOIN low s ON s.tree = w.tree AND s.lvl = w.lvl AND s.i = xor(w.i, 1) WHERE w.n > 1),
climb(doc_id, leaf, subroot, lvl, n, i, proof, f) AS (
  SELECT w.doc_id, w.leaf, s.h, 0, s.n, s.i, w.proof, w.f FROM walk w JOIN subroots s ON s.tree = w.tree WHERE w.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.lvl + 1, (c.n + 1) // 2, c.i // 2, c.proof || coalesce(s.h, ''),
    sha256(CASE WHEN c.i % 2 = 1 THEN coalesce(s.h, '') || c.f ELSE c.f || coalesce(s.h, '') END)
  FROM climb c LEFT JOIN high s ON s.lvl = c.lvl AND s.i = xor(c.i, 1) WHERE c.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM climb, (SELECT h AS root FROM high WHERE n = 1) WHERE n = 1
"""


_HEX_BYTE = "CAST('0x' || substr(hex(encode({0})), CAST(2 * i - 1 AS INT), 2) AS BIGINT)"
ORACLES["op11_frequency_vector_trie"] = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS MATERIALIZED (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS tagged, w, count(*) AS c FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
  WHERE length(w) >= 5 GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT w, c, {_crc_sql("list_transform(range(1, strlen(tagged) + 1), lambda i: " + _HEX_BYTE.format("tagged") + ")")} AS h
  FROM runs, crc_table),
words AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) + 2 AS INT)) ELSE w END AS word, c
    FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS MATERIALIZED (
  SELECT DISTINCT word, n, i, substr(word, 1, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b, b.n AS bn FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
near AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY bn DESC, encode(b)) AS best, max(bn) AS best_n FROM pairs GROUP BY a),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
    CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n FROM words w LEFT JOIN near USING (word)),
path(word, spot) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT p.word, f.form FROM path p JOIN forms f ON f.word = p.spot WHERE f.form IS NOT NULL),
ends AS (SELECT p.word, p.spot AS root FROM path p JOIN forms f ON f.word = p.spot WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
