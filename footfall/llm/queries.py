"""Registered queries of the training-data operators, each beside its SQL twin if it has one.

Every query reads its whole table and applies its operator with production
parameters; the digest columns are derived from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    bitplanes,
    boilerplate,
    bpe,
    jaccard,
    multi_index,
    neighbours,
    packing,
    periodic,
    ppm,
    prefix_trie,
    quality,
    store,
    toxicity,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            TWINS[function.__name__] = sql
        return function

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1: quality rules ----------------------------------------------------------

_GRAMS = ", ".join(f"({n})" for n in sorted({*quality.GRAM_LIMITS, quality.REPEAT_WORDS}))
_TOO_MUCH = " OR ".join(
    f"100 * coalesce(gram{n}_chars, 0) > {limit} * word_chars" for n, limit in quality.GRAM_LIMITS.items()
)
QUALITY_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
grams AS (
  SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM d, (VALUES {_GRAMS}) AS lengths(n)) AS windows),
again AS (
  SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, gram) > 1 AS dup FROM grams),
cover AS (
  SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS i FROM again WHERE dup),
covered AS (
  SELECT doc_id,
         {", ".join(f"sum(length(word)) FILTER (WHERE n = {n}) AS gram{n}_chars" for n in quality.GRAM_LIMITS)},
         count(*) FILTER (WHERE n = {quality.REPEAT_WORDS}) AS n_repeat_words
  FROM cover JOIN w USING (doc_id, i) GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
line_counts AS (
  SELECT doc_id, count(*) AS times,
         length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars
  FROM lines GROUP BY doc_id, line),
line_sums AS (
  SELECT doc_id, sum(times - 1) AS n_dup_lines, sum(times * chars) FILTER (WHERE times > 1) AS line_chars
  FROM line_counts WHERE chars > 0 GROUP BY doc_id),
figures AS (
  SELECT d.doc_id, len(words) AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         {", ".join(f"coalesce(gram{n}_chars, 0) AS gram{n}_chars" for n in quality.GRAM_LIMITS)},
         coalesce(line_chars, 0) AS line_chars
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN line_sums USING (doc_id)),
judged AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_LIMIT} * n_words AS base_failed
  FROM figures)
SELECT doc_id, {", ".join(f"CAST({name} AS BIGINT) AS {name}" for name in quality.FIELDS.names
                          if name not in ("base_failed", "kept"))},
       base_failed,
       NOT (base_failed OR {_TOO_MUCH} OR 100 * line_chars > {quality.LINE_LIMIT} * word_chars) AS kept
FROM judged
"""


@query(QUALITY_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_quality(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


# --- 2: token ids in shuffled planes -------------------------------------------


@query()
def op2_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode, write the chunk files, and digest what is read back from them."""
    docs = read(spark, sf_dir, "documents")
    chunks = bitplanes.encode_chunks(docs, public_tokenizers.path("byte_bpe_50k.json"))
    stored = bitplanes.decode_chunks(bitplanes.write_chunks(chunks))
    return stored.select(
        "doc_id", "start",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
    )


# --- 3: nearest neighbours -----------------------------------------------------


@query()
def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# --- 4: language identification ------------------------------------------------


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = ppm.fit(docs)
    found = ppm.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", ppm.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


# --- 5: best-fit packing -------------------------------------------------------


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    pieces = packing.write_pieces(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


# --- 6: toxicity ---------------------------------------------------------------


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.with_toxicity(docs.select("doc_id", "text"), model).drop("text")


# --- 7: byte-level BPE ---------------------------------------------------------


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# --- 8: n-gram Jaccard join ----------------------------------------------------


@query()
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(read(spark, sf_dir, "documents"), words=4, percent=85)


# --- 9: HTML extraction --------------------------------------------------------


@query()
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_texts(read(spark, sf_dir, "pages"))


# --- 10: url filters -----------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _path_sql(what: str) -> str:
    cases = []
    for rule in sorted(urls.PATH_RULES, key=lambda r: (-len(r.host + r.path), r.host + r.path)):
        shown = rule.host + rule.path if what == "rule" else rule.verdict
        cases.append(
            f"WHEN (host = {_text(rule.host)} OR ends_with(host, {_text('.' + rule.host)})) "
            f"AND starts_with(path, {_text(rule.path)}) THEN {_text(shown)}"
        )
    return "CASE " + " ".join(cases) + " ELSE NULL END"


_LOWERED = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
URLS_SQL = f"""
WITH rests AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, url,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests)
SELECT page_id, host, path, {_path_sql("rule")} AS rule,
       coalesce({_path_sql("verdict")},
                CASE WHEN {" OR ".join(f"regexp_matches({_LOWERED}, {_text(r.pattern)})" for r in urls.PATTERN_RULES)}
                     THEN 'block' ELSE 'allow' END) AS verdict
FROM parts
"""


@query(URLS_SQL)
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


# --- 11: near duplicates of embeddings -----------------------------------------

LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS x,
         vec_id IS NOT NULL AND len(embedding) = (SELECT mode(len(embedding)) FROM embeddings)
         AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
         AND len(list_filter(embedding, lambda y: y <> 0)) > 0 AS able
  FROM embeddings),
links AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r <> b.r AND a.able AND b.able
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
reach AS (
  SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
lowest AS (SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = v.r) AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN lowest USING (r)
"""


@query(LINKS_SQL)
def op11_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.link_vectors(read(spark, sf_dir, "embeddings"), threshold=0.9)


# --- 12: periodic runs ---------------------------------------------------------


def planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts, by a checksum of the id, with a tail that repeats itself.

    With h the checksum and g its tenth, the words from place a = g % n on repeat the
    first p = 1 + (n - a) div (3 + g % 8) of them. Native expressions without lambdas,
    so that a text is cut into words once.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    cut = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"),
                      F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"))
    cut = cut.withColumn("n", F.size("words"))
    planted = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    cut = cut.withColumn("a", F.when(planted, F.expr("CAST(g % n AS INT)")).otherwise(0))
    cut = cut.withColumn("p", F.when(planted, F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)")).otherwise(1))
    tail = "flatten(array_repeat(slice(words, a + 1, p), CAST((n - a) DIV p AS INT)))"
    rebuilt = f"concat_ws(' ', slice(words, 1, a), {tail}, slice(words, a + 1, CAST((n - a) % p AS INT)))"
    return cut.select("doc_id", F.when(planted, F.expr(rebuilt)).otherwise(F.col("text")).alias("text"))


# The checksum of a decimal number (CRC-32, its polynomial reversed), as DuckDB has none.
_CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY b) AS t
  FROM (SELECT b, list_reduce([b] || range(8), lambda c, k:
               CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS bytes(b)) AS cells)"""


def _crc_sql(number: str) -> str:
    """The checksum of an integer expression; ``crc_table`` must be in scope."""
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return (f"xor(list_reduce([4294967295] || {codes}, lambda c, x: "
            "xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])), 4294967295)")  # fmt: skip


RUNS_SQL = f"""
WITH {_CRC_TABLE},
cut AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         {_crc_sql("doc_id")} AS h
  FROM documents, crc_table),
placed AS (SELECT *, len(words) AS n, h // 10 AS g FROM cut),
tails AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM placed),
w AS (
  SELECT doc_id, i, words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM tails) AS each),
grams AS (
  SELECT doc_id, i, hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram,
         lead(word, 4) OVER o IS NOT NULL AS whole, word
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i AND x.whole AND y.whole),
islands AS (
  SELECT doc_id, q, min(i) AS start, max(i) + 5 + q - min(i) AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal) AS marked
  GROUP BY doc_id, q, island
  HAVING max(i) + 5 + q - min(i) >= greatest({periodic.LEAST_WORDS}, {periodic.LEAST_TIMES} * q)),
runs AS (
  SELECT * FROM islands x WHERE NOT EXISTS (
    SELECT 1 FROM islands y WHERE y.doc_id = x.doc_id AND y.q < x.q
    AND y.start <= x.start AND y.start + y.length >= x.start + x.length)),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS shown
  FROM runs GROUP BY doc_id),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) AS place FROM runs),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS shown FROM w ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start,
       CAST(length AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
       CAST(1000 * length // q AS BIGINT) AS exponent_milli,
       sha256(coalesce(told.shown, '')) AS runs_sha256, sha256(coalesce(kept.shown, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told USING (doc_id) LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (doc_id)
     LEFT JOIN kept USING (doc_id)
"""


@query(RUNS_SQL)
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.with_runs(planted_repeats(read(spark, sf_dir, "documents")))
    # Runs come by start, then period, so of equal exponents the first stays.
    best = F.expr(
        "aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), "
        "(best, r) -> CASE WHEN best IS NULL OR r.length * best.period > best.length * r.period THEN r ELSE best END)"
    )
    shown = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    shown = F.when(F.size("runs") > 0, F.concat(shown, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(shown, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# --- 13: conversation prefixes -------------------------------------------------

HEAD_TURNS = 5

TRIE_SQL = f"""
WITH {_CRC_TABLE},
t AS (
  SELECT conv_id, role, text, md5(whole) AS digest,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(whole)) AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
               strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS whole
        FROM conversations WHERE conv_id IS NOT NULL) AS turns),
ids AS (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS donor, {_crc_sql("conv_id")} % {HEAD_TURNS + 1} AS h
  FROM (SELECT DISTINCT conv_id FROM t) AS every, crc_table),
heads AS (SELECT c, i, digest, text FROM ids JOIN t ON t.conv_id = donor AND i <= h),
lent AS (SELECT c, count(*) AS m FROM heads GROUP BY c),
turns AS (
  SELECT * FROM heads UNION ALL
  SELECT c, i - h + coalesce(m, 0) AS i, digest, text
  FROM ids JOIN t ON t.conv_id = c AND i > h LEFT JOIN lent USING (c)),
named AS (
  SELECT c, i AS depth, length(text) AS chars, i = max(i) OVER (PARTITION BY c) AS ends,
         md5(string_agg(digest, '') OVER (PARTITION BY c ORDER BY i)) AS node
  FROM turns
  UNION ALL SELECT c, 0, 0, c NOT IN (SELECT c FROM turns), '' FROM ids),
members AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY depth) AS parent FROM named),
nodes AS (
  SELECT node, min(c) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, any_value(chars) AS chars,
         count(*) AS n_convs, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends) AS told
  FROM members GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
  SELECT a.node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved
  FROM nodes x JOIN members a ON a.c = x.conv_id AND a.depth <= x.depth LEFT JOIN kids ON kids.node = x.node
  GROUP BY a.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(n.told, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes up ON up.node = n.parent LEFT JOIN kids ON kids.node = n.node JOIN sums ON sums.node = n.node
"""


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns, and ids, of conversations that begin as the one whose id ends in two zeros begins.

    Of conversation c the first crc32(c) % 6 turns give way to those of c - c % 100.
    """
    turns = store.written(turns, "numbered-turns")
    ids = turns.select("conv_id").distinct()
    beginnings = turns.where((F.col("depth") <= HEAD_TURNS) & (F.col("conv_id") % 100 == 0))
    beginnings = beginnings.groupBy(F.col("conv_id").alias("donor")).agg(  # a few rows each
        F.sort_array(F.collect_list(F.struct("depth", "digest", "n_chars"))).alias("head")
    )
    plans = ids.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("donor"),
        (F.crc32(F.col("conv_id").cast("string")) % (HEAD_TURNS + 1)).cast("int").alias("h"),
    ).join(beginnings, "donor", "left")
    plans = plans.withColumn("m", F.least("h", F.coalesce(F.size("head"), F.lit(0))))
    heads = plans.where("m > 0").select("conv_id", F.inline(F.slice("head", F.lit(1), F.col("m"))))
    own = turns.join(plans.select("conv_id", "h", "m"), "conv_id").where("depth > h")
    own = own.select("conv_id", (F.col("depth") - F.col("h") + F.col("m")).alias("depth"), "digest", "n_chars")
    return heads.unionByName(own), ids


@query(TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, ids = rebuilt_conversations(prefix_trie.turn_digests(read(spark, sf_dir, "conversations")))
    nodes, ends = prefix_trie.prefix_trie(turns, ids)
    shared = prefix_trie.member_digests(ends.where("n_convs > 1"))
    alone = F.when(F.col("n_ends") > 0, F.col("conv_id").cast("string")).otherwise("")
    return nodes.join(shared, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(alone, 256)).alias("ends_sha256"),
    )
