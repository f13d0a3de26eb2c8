"""The operators over the test tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.llm import chat, grades, near_dups, neighbours, packing, quality, repair, repeats, resampling, secrets, token_counts, toxicity, transducer

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MAX_TOKENS = 512


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


CHAT_SQL = """
WITH own AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) t),
ends AS (
  SELECT conv_id, coalesce(max(pos) FILTER (WHERE role = 'assistant'), 0) AS n, max(pos) AS size FROM own GROUP BY conv_id),
answers AS (
  SELECT o.conv_id, o.role, o.text FROM own o JOIN ends e ON o.conv_id = e.conv_id AND o.pos = e.n),
sides AS (
  SELECT 'c' AS side, o.conv_id, o.pos, o.role, o.text FROM own o JOIN ends e USING (conv_id) WHERE e.n = 0 OR o.pos <= e.n
  UNION ALL
  SELECT 'r', o.conv_id, o.pos, o.role, o.text FROM own o JOIN ends e USING (conv_id) WHERE e.n = 0 OR o.pos < e.n
  UNION ALL
  SELECT 'r', e.conv_id, CASE WHEN e.n = 0 THEN e.size + 1 ELSE e.n END, a.role, a.text
  FROM ends e JOIN answers a ON a.conv_id = xor(e.conv_id, 1)),
sizes AS (
  SELECT conv_id, count(*) FILTER (WHERE side = 'c') AS nc, count(*) FILTER (WHERE side = 'r') AS nr FROM sides GROUP BY conv_id),
differ AS (
  SELECT c.conv_id, min(c.pos) AS pos FROM sides c JOIN sides r ON r.side = 'r' AND c.conv_id = r.conv_id AND c.pos = r.pos
  WHERE c.side = 'c' AND (c.role <> r.role OR c.text <> r.text) GROUP BY c.conv_id),
prompts AS (
  SELECT s.conv_id, coalesce(d.pos - 1, least(s.nc, s.nr)) AS np FROM sizes s LEFT JOIN differ d USING (conv_id)),
shown AS (
  SELECT s.side, s.conv_id, s.pos, s.role, p.np, '<|im_start|>' || s.role || chr(10) AS head,
         '<|im_start|>' || s.role || chr(10) || s.text || '<|im_end|>' || chr(10) AS shown
  FROM sides s JOIN prompts p USING (conv_id)),
placed AS (
  SELECT *, sum(length(shown)) OVER (PARTITION BY conv_id, side, pos > np ORDER BY pos) AS stop FROM shown),
pieces AS (
  SELECT conv_id, np, side,
    coalesce(string_agg(shown, '' ORDER BY pos) FILTER (WHERE pos <= np), '') AS before,
    coalesce(string_agg(shown, '' ORDER BY pos) FILTER (WHERE pos > np), '') AS after,
    coalesce(string_agg(concat(stop - length(shown) + length(head), ':', stop - 1), ',' ORDER BY pos)
      FILTER (WHERE pos > np AND role = 'assistant'), '') AS learned
  FROM placed GROUP BY conv_id, np, side)
SELECT p.conv_id, CAST(p.np AS INTEGER) AS n_prompt_turns, coalesce(c.before, '') AS prompt,
  coalesce(c.after, '') AS chosen, coalesce(c.learned, '') AS chosen_learned,
  coalesce(r.after, '') AS rejected, coalesce(r.learned, '') AS rejected_learned
FROM prompts p LEFT JOIN pieces c ON c.conv_id = p.conv_id AND c.side = 'c'
LEFT JOIN pieces r ON r.conv_id = p.conv_id AND r.side = 'r'
"""


@query("op1_preference_rows", CHAT_SQL)
def preference_rows(spark: SparkSession, sf: str) -> DataFrame:
    talks = chat.conversations(table(spark, sf, "conversations"))
    return chat.preference_rows(chat.answer_pairs(talks, F.col("conv_id").bitwiseXOR(F.lit(1))))


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), BYTE_BPE)


@query("op3_token_counts")
def token_count(spark: SparkSession, sf: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf, "documents"), BYTE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


@query("op4_line_quality")
def line_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality.quality_rules(docs, quality.fit_to_labels(docs, table(spark, sf, "labels")))


@query("op5_permutation_index")
def permutation_index(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, count=20)


@query("op6_golay_simhash")
def golay_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_dups.simhash_components(table(spark, sf, "documents"), words=3)


#: A document's grade: bad and toxic, bad, good but toxic, good.
GRADES = 4


@query("op7_ordinal_grades")
def ordinal_grades(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    grader = grades.fit_to_ratings(docs, labels, 2 * F.col("quality") + 1 - F.col("toxic"), GRADES)
    return grades.graded(docs, grader, reach=GRADES - 1)


@query("op8_bpe_transducer")
def bpe_transducer(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return transducer.encode_texts(docs, MULTI_BPE, public_tokenizers.PATTERN, with_text=True).select(
        "doc_id",
        F.expr("length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query("op9_secret_scan")
def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(table(spark, sf, "documents"), BYTE_RANKS)
    base = F.filter("spans", lambda s: s.kind != "random")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), count("random"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"),
    )


@query("op10_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf, "documents"), window=400, keep_first=False)
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        F.length("kept").cast("long").alias("n_kept"), left.alias("kept_text"),
    )


# Remainders of CRC-32 after half a byte.
HALF_BYTES = [0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
              0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C]


def crc_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes: of each byte first the lower half, then the upper one."""
    half = f"(instr('0123456789ABCDEF', substr(hex({text}), i + 2 - 2 * (i % 2), 1)) - 1)::BIGINT"
    return f"""xor(list_reduce([4294967295::BIGINT] || list_transform(range(2 * octet_length(encode({text}))), lambda i: {half}),
      lambda a, n: xor(list_extract({HALF_BYTES}, (xor(a, n) & 15) + 1), a >> 4)), 4294967295)"""


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PARTED = rf"list_filter(regexp_split_to_array({LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
BUCKETS = resampling.BUCKETS


def run_sql(table: str, key: str) -> str:
    """(id, feature, n) of all runs of one or two words."""
    return f"""SELECT id, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature
      FROM (SELECT {key} AS id, {PARTED} AS words FROM {table})"""


RESAMPLING_SQL = f"""
WITH corpus AS (SELECT id, feature, count(*) AS n FROM ({run_sql("documents", "doc_id")}) GROUP BY ALL),
wanted AS (SELECT feature, count(*) AS n FROM ({run_sql("benchmark", "item_id")}) GROUP BY ALL),
buckets AS (SELECT feature, {crc_sql("feature")} % {BUCKETS} AS bucket FROM (SELECT feature FROM corpus UNION SELECT feature FROM wanted)),
s AS (SELECT bucket, sum(n) AS n FROM corpus JOIN buckets USING (feature) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM wanted JOIN buckets USING (feature) GROUP BY bucket),
sums AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS s, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (sums.s + {BUCKETS}) / ((coalesce(s.n, 0)::DOUBLE + 1) * (sums.t + {BUCKETS}))))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM buckets) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket) CROSS JOIN sums),
own AS (
  SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM corpus JOIN buckets USING (feature) JOIN gains USING (bucket) GROUP BY id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, coalesce(n_features, 0) + 1 >= 2 * {resampling.LEAST_WORDS} AS able,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{resampling.SEED}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
  FROM documents d LEFT JOIN own ON d.doc_id = own.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY able) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= {resampling.PERCENT} * n // 100 THEN place END AS rank FROM ranked
"""


@query("op11_target_resampling", RESAMPLING_SQL)
def target_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op12_compression_toxicity")
def compression_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    found = toxicity.scored(docs, toxicity.fit_to_labels(docs, labels.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"), "n_windows", "n_marked")


REPAIR_SQL = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS harm
  FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT * FROM given WHERE harm <> 0 UNION ALL SELECT * FROM given WHERE harm = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM hurt),
marked AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS following FROM placed),
faults AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM marked),
sizes AS (
  SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM faults GROUP BY conv_id),
-- States: nothing so far, or the initial of the last turn. At most two turns are put in at one place.
edits(pick, cost) AS (VALUES ('D', 3), ('K', 0), ('R', 2)),
ahead(state, put, goal, cost) AS (VALUES
  ('', '', '', 0), ('s', '', 's', 0), ('u', '', 'u', 0), ('a', '', 'a', 0), ('', 'I', 'u', 2), ('s', 'I', 'u', 2), ('u', 'I', 'a', 2), ('a', 'I', 'u', 2),
  ('', 'II', 'a', 4), ('s', 'II', 'a', 4), ('u', 'II', 'u', 4), ('a', 'II', 'a', 4)),
moves AS (
  SELECT f.conv_id, f.pos, a.state, a.put || e.pick AS edit, a.cost + e.cost + CASE WHEN e.pick <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
    CASE e.pick WHEN 'D' THEN a.goal WHEN 'K' THEN f.initial ELSE CASE a.goal WHEN 'u' THEN 'a' ELSE 'u' END END AS after
  FROM faults f CROSS JOIN ahead a CROSS JOIN edits e
  WHERE e.pick = 'D' OR (coalesce(f.fault, '') NOT IN ('blank', 'duplicate') AND (e.pick = 'R' OR
    (f.initial = 's' AND a.goal = '') OR (f.initial = 'u' AND a.goal <> 'u') OR (f.initial = 'a' AND a.goal = 'u')))),
ways AS (
  SELECT conv_id, 0::BIGINT AS pos, '' AS state, {{'cost': 0, 'audit': ''}} AS best FROM sizes
  UNION ALL
  SELECT w.conv_id, w.pos + 1, m.after, min({{'cost': w.best.cost + m.cost, 'audit': w.best.audit || m.edit}})
  FROM ways w JOIN moves m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.pos = w.pos + 1 AND m.state = w.state
  GROUP BY w.conv_id, w.pos, m.after),
cheapest AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + a.cost, 'audit': w.best.audit || a.put}}) AS best
  FROM ways w JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND w.pos = s.n JOIN ahead a ON a.state = w.state
  WHERE a.goal IN ('', 'a') GROUP BY w.conv_id),
steps AS (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS spot FROM cheapest),
taken AS (
  SELECT conv_id, spot, substr(audit, spot, 1) AS edit, length(replace(substr(audit, 1, spot), 'I', '')) AS pos FROM steps),
stay AS (
  SELECT t.conv_id, t.spot, t.edit, f.role, f.text,
    count(*) FILTER (WHERE NOT (t.edit = 'K' AND f.initial = 's')) OVER (PARTITION BY t.conv_id ORDER BY t.spot) AS written
  FROM taken t LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.pos = t.pos WHERE t.edit <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE CASE written % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS lines FROM stay GROUP BY conv_id)
SELECT c.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate, coalesce(s.truncated, 0) AS truncated,
  coalesce(s.illegal, 0) AS illegal, coalesce(b.best.cost, 0)::BIGINT AS cost, coalesce(b.best.audit, '') AS audit, sha256(coalesce(r.lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN cheapest b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op13_conversation_repair", REPAIR_SQL)
def conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    talks = table(spark, sf, "conversations")
    found = repair.repair(repair.damaged(talks))
    counts, none = ["gaps", *repair.COUNTS], F.lit(0).cast("long")
    # One shuffle for all parts: rows of a conversation are put together by an aggregate.
    parts = [found.report.select("conv_id", *counts, "audit"), repair.digests(found.turns)]
    rows = talks.select("conv_id")
    for part in parts:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), none).alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
