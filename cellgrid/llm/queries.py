"""One query per operator with its production parameters, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm import collocation, fingerprint, line_dedup, mixing, piece_codec, prefix_trie, quality, secrets, simhash, substring, token_store, topk_search, url_filter
from cellgrid.llm._shared import shared_dir

#: Labels of hosts on the block list.
BLOCKED_NAMES = ["ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets"]

#: Rules on top of the list: host, path, verdict.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]

#: Weights of the sources, in turn.
MIX_WEIGHTS = [5.0, 2.0, 1.0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, BLOCKED_NAMES))).alias("name"))
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages"), names, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file; the driver reads it and sends its contents to the tasks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, their number, and whether decoding gives the text back."""
    model = tokenizer_file("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = piece_codec.decode_ids(piece_codec.encode_texts(docs, model), model, out="decoded")
    return out.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_pieces"), (F.col("decoded") == F.col("text")).alias("round_trip"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprint.to_hex(F.col("sketch")).alias("fingerprint"), fingerprint.to_hex(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(20)) == 0, k=20)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as f:
        encode = token_store.text_encoder(spark, f.read(), end_id=2)
    token_store.write_ids(table(spark, sf_dir, "documents"), path := shared_dir(spark), "text", encode)
    return token_store.read_ids(spark, path, with_ids=False)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), width=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.top_phrases(table(spark, sf_dir, "documents"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_line_dedup": op2_line_dedup,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_fingerprints": op4_fingerprints,
        "op5_topk": op5_topk,
        "op6_simhash": op6_simhash,
        "op7_token_store": op7_token_store,
        "op8_mixing": op8_mixing,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_quality": op10_quality,
        "op11_collocations": op11_collocations,
        "op12_secrets": op12_secrets,
        "op13_prefix_trie": op13_prefix_trie,
    }


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH parts AS (
  SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
fits AS (
  SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM (SELECT DISTINCT page_id, host, path FROM parts) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule,
       coalesce(v, CASE WHEN list_has_any(string_split(host, '.'), [{", ".join(f"'{n}'" for n in BLOCKED_NAMES)}]) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits USING (page_id, host, path)
"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT doc_id, pos, line, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM lines),
seen AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT doc_id, pos, line, coalesce(doc_id > first, false) AS gone FROM keyed LEFT JOIN seen USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP5_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64.0::DOUBLE * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""

OP8_SQL = f"""
WITH sized AS (
  SELECT doc_id, source AS src, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, length(coalesce(text, '')) AS chars
  FROM documents),
per AS (SELECT src, sum(size)::BIGINT AS source_size FROM sized GROUP BY src),
weighted AS (
  SELECT src, source_size, 3.0::DOUBLE * source_size AS cap,
         ([5, 2, 1])[((row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM per),
levels AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, src NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, src NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here
  FROM weighted),
level AS (SELECT arg_min(here, cap / weight) AS l FROM levels WHERE here <= cap / weight),
targets AS (SELECT src, source_size, coalesce(least(cap, weight * l), cap) AS target FROM levels, level),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 1 END AS epochs FROM targets),
keyed AS (
  SELECT doc_id, s.src, size, source_size, target, epochs, target - epochs * source_size AS budget,
         -ln((('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5) / 281474976710656.0)
           / (1.0 / (1.0 + abs(ln(((chars + 1.0::DOUBLE) / (size + 1.0::DOUBLE)) / 7.0::DOUBLE)))) AS key
  FROM sized s JOIN epochs e ON s.src IS NOT DISTINCT FROM e.src),
summed AS (SELECT *, sum(size) OVER (PARTITION BY src ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM keyed)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN upto - size / 2.0 <= budget AND size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""


OP9_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []::VARCHAR[]) AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM words WHERE len(w) >= 35),
keyed AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM starts),
repeated AS (SELECT k FROM keyed GROUP BY k HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS i FROM keyed JOIN repeated USING (k)),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


OP11_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM starts, (VALUES (1), (2), (3)) t(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
split AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS p FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM split),
scored AS (
  SELECT c.lang, c.k, c.g, c.a, c.c, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.k = c.c AND x.g = array_to_string(p[1:c.c], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - c.c AND y.g = array_to_string(p[c.c + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
longer AS (
  SELECT lang, g, max(a) AS a FROM (
    SELECT lang, array_to_string(p[1:2], ' ') AS g, a FROM split WHERE k = 3 UNION ALL SELECT lang, array_to_string(p[2:3], ' '), a FROM split WHERE k = 3) GROUP BY ALL),
stay AS (SELECT t.* FROM lowest t LEFT JOIN longer o ON o.lang = t.lang AND o.g = t.g AND t.k = 2 WHERE o.a IS NULL OR 100 * o.a < 50 * t.a)
SELECT lang, row_number() OVER w AS rank, g AS phrase, a, l, r, n, score::BIGINT AS score FROM stay JOIN sizes USING (lang)
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, g) QUALIFY row_number() OVER w <= 2000
"""

# crc32, bit by bit
_CRC = "list_reduce([4294967295::BIGINT] || list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT), lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))"

OP13_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, conv_id::VARCHAR AS s FROM turns),
hashed AS (SELECT conv_id, base, xor({_CRC}, 4294967295) % 6 AS h FROM convs),
mixed AS (
  SELECT h.conv_id, pos, role, text, 0 AS own FROM hashed h JOIN turns t ON t.conv_id = base AND pos <= h
  UNION ALL SELECT conv_id, pos, role, text, 1 FROM turns JOIN hashed USING (conv_id) WHERE pos > h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, role, text FROM mixed),
keyed AS (SELECT conv_id, depth, length(text) AS chars, md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM hashed),
linked AS (SELECT *, lag(key) OVER w AS parent, lead(key) OVER w IS NULL AS last FROM keyed WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS (
  SELECT depth, key, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM linked GROUP BY depth, key),
kids AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
whole AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.depth = n.depth AND k.key = n.key),
sums AS (
  SELECT k.depth, k.key, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM whole w JOIN keyed k ON k.conv_id = w.conv_id AND k.depth <= w.depth GROUP BY ALL)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM whole w JOIN sums s ON s.depth = w.depth AND s.key = w.key LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.key = w.parent
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_collocations": OP11_SQL, "op13_prefix_trie": OP13_SQL, "op1_url_filter": OP1_SQL, "op2_line_dedup": OP2_SQL, "op5_topk": OP5_SQL, "op8_mixing": OP8_SQL, "op9_substring_dedup": OP9_SQL}
