"""Queries of this subpackage's operators, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credence.llm import (
    byte_bpe,
    chat_parse,
    chat_repair,
    decontaminate,
    id_files,
    minhash,
    periodic_runs,
    sharding,
    site_text,
    token_counts,
    toxicity,
    vector_forest,
    vector_search,
)
from credence.llm.common import table

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_maglev_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sharding.assign(table(spark, sf_dir, "documents"), "doc_id")
            .select(F.col("key").alias("doc_id"), "slot", "shard"))


def op2_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, per_100=85)


def op3_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS),
                               public_tokenizers.PATTERN)


def op5_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


def op6_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.covered(F.col("spans")).cast("long")
    return hits.select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op8_vector_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = (table(spark, sf_dir, "embeddings").select("vec_id", vector_search.whole("embedding").alias("x")))
    return vector_search.top_k(x, F.col("vec_id") % 50 == 0, k=5).select("query_id", "rank", "vec_id", "score")


def op9_site_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_text.extract(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after the damage that the query's contract
    states, dropped ones marked by ``present`` = false."""
    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    return conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
                                text.alias("text"), (kind != 0).alias("present"), times.alias("copy"))


def op11_chat_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat_parse.hashed(chat_parse.repair(damaged(table(spark, sf_dir, "conversations")), F.col("present")))
    return found.select("conv_id", "gaps", *(F.col(f"n_{c}").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")),
                        "cost", "audit", F.col("sha256").alias("repaired_sha256"))


def op12_tree_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``documents``; the words of one row in ten, by the hash of
    its id, repeat periodically from some word on, as the query's contract states.
    A row without id stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", periodic_runs.WORD_SPACE), lambda w: w != "")
    d = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    d = d.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n")))
    d = d.withColumn("left", (F.col("n") - F.col("a")).cast("int"))
    d = d.withColumn("p", (F.lit(1) + F.floor(F.col("left") / (3 + F.pmod("g", F.lit(8))))).cast("int"))
    block = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil(F.col("left") / F.col("p")).cast("int"))), F.lit(1), F.col("left"))
    planted = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a").cast("int")), tail)
    return d.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        "", F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    r = found.withColumn("best", periodic_runs.longest(F.col("runs")))
    return r.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
                    F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_maglev_shards, op2_minhash_join, op3_viterbi_counts, op4_byte_bpe, op5_chat_repair, op6_plane_files,
    op7_decontaminate, op8_vector_files, op9_site_text, op10_toxicity, op11_chat_parse, op12_tree_forest,
    op13_periodic_runs)}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_N, _M = len(sharding.SHARDS), sharding.SIZE
_NUMBER = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"
OP1_SQL = f"""
WITH RECURSIVE names AS (SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') AS name FROM range({_N}) t(i)),
steps AS (SELECT i, name, {_NUMBER.format("name || '#offset'")} % {_M} AS o,
                 {_NUMBER.format("name || '#skip'")} % {_M - 1} + 1 AS k FROM names),
orders AS (SELECT list(p ORDER BY i) AS orders, list(name ORDER BY i) AS names FROM (
  SELECT i, name, list_transform(range({_M}), lambda j: (o + j * k) % {_M}) AS p FROM steps)),
fill AS (
  SELECT 0 AS turn, list_transform(range({_M}), lambda j: -1) AS slots
  UNION ALL
  SELECT turn + 1, list_transform(slots, lambda h, s: CASE WHEN s - 1 = c THEN turn % {_N} ELSE h END) FROM (
    SELECT turn, slots, list_filter(orders[turn % {_N} + 1], lambda s: slots[s + 1] = -1)[1] AS c
    FROM fill, orders WHERE turn < {_M})),
tab AS (SELECT unnest(slots) AS owner, unnest(range({_M})) AS slot FROM fill WHERE turn = {_M})
SELECT d.doc_id, CAST(tab.slot AS INTEGER) AS slot, orders.names[tab.owner + 1] AS shard
FROM (SELECT doc_id, {_NUMBER.format("coalesce(CAST(doc_id AS VARCHAR), '')")} % {_M} AS slot FROM documents) d
JOIN tab ON tab.slot = d.slot, orders"""

OP2_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
   ELSE list_distinct(list_transform(range(len(w) - 2), lambda i: array_to_string(w[i + 1 : i + 3], ' '))) END AS s FROM d),
n AS (SELECT doc_id, len(s) AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * common >= 85 * (na.n + nb.n - common)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)"""

_WORDS7 = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS7} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS7} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i + 1 : i + k], ' ') AS g FROM (
  SELECT item, w, least(len(w), 10) AS k, unnest(range(len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i + 1 : i + k], ' ') AS g FROM (
  SELECT doc_id, w, k, unnest(range(greatest(0, len(w) - k + 1))) AS i FROM d, (SELECT DISTINCT k FROM bw))),
h AS (SELECT doc_id, i, dw.k, item FROM dw JOIN bw USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""

OP8_SQL = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.row AS q_row, c.row AS c_row, c.vec_id AS vec_id,
  CAST(list_sum(list_transform(range(len(q.x)), lambda i: q.x[i + 1] * c.x[i + 1])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.row <> q.row),
r AS (SELECT *, row_number() OVER (PARTITION BY q_row ORDER BY score DESC, vec_id, c_row) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""

_CRC32 = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({{}}, ''), lambda b: CAST(ascii(b) AS BIGINT))), " \
    "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
  {_CRC32.format("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
a AS (SELECT r, doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
  list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) END AS w FROM p),
x AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM t),
e AS (SELECT a.r, a.i, b.i - a.i AS q FROM x a JOIN x b ON a.r = b.r AND a.word = b.word AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
k AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS stretch FROM e),
s AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM k GROUP BY r, q, stretch HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM s GROUP BY r, start, length),
o AS (SELECT r, count(*) AS n_runs, first(struct_pack(start, length, period) ORDER BY length DESC, start, period) AS best,
  string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
c AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM x ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM t LEFT JOIN o USING (r) LEFT JOIN c USING (r)"""

ORACLES = {"op1_maglev_shards": OP1_SQL, "op2_minhash_join": OP2_SQL, "op7_decontaminate": OP7_SQL,
           "op8_vector_files": OP8_SQL, "op13_periodic_runs": OP13_SQL}
