"""The queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.audit import audit_filters
from millrace.llm.common import byte_count
from millrace.llm.infill import fill_in_middle, restored
from millrace.llm.minhash import near_duplicates
from millrace.llm.mixing import mix
from millrace.llm.neighbours import near_duplicate_vectors
from millrace.llm.packing import pack_documents
from millrace.llm.pii import replace_personal_data
from millrace.llm.search import search
from millrace.llm.sharding import shard
from millrace.llm.suffixes import remove_repeats
from millrace.llm.tokens import count_tokens
from millrace.llm.toxicity import score_toxicity
from millrace.llm.windows import pack_windows

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_mix_sources")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


ORACLES["op3_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws('|', '17', doc_id::VARCHAR)) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::DOUBLE AS w
  FROM d GROUP BY source
), r AS (  -- the level at which the sources of smaller ratio stop
  SELECT *, 2.0 * source_size / w AS ratio FROM s
), l AS (
  SELECT a.ratio,
         (1.5 * (SELECT sum(source_size) FROM r)
          - (SELECT coalesce(sum(2.0 * source_size), 0) FROM r b WHERE b.ratio < a.ratio))
         / (SELECT sum(w) FROM r b WHERE b.ratio >= a.ratio) AS level
  FROM r a
), t AS (
  SELECT source, source_size,
         least(w * (SELECT arg_min(level, ratio) FROM l WHERE level <= ratio), 2.0 * source_size) AS target
  FROM r
), p AS (
  SELECT d.*, source_size, target, floor(target)::BIGINT AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size
             + greatest(0, least(size, budget % source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM p
"""


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(_table(spark, sf_dir, "documents"), TOKENIZER)
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


@query("op6_shard")
def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard(_table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id",
        (byte_count(F.col("text")) + 8).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_pack")
def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op10_surrogates")
def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = replace_personal_data(_table(spark, sf_dir, "documents"), key="op10")
    return masked.select("doc_id", "text", "n_entities")


@query("op5_near_duplicates")
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


ORACLES["op5_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) >= 4 THEN array_to_string(ws[i:i + 3], ' ')
                               ELSE 'short ' || array_to_string(ws, ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
), u AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r AS (
  SELECT doc_id AS node, doc_id AS top FROM w
  UNION
  SELECT u.b, r.top FROM r JOIN u ON u.a = r.node WHERE r.top < u.b
), c AS (
  SELECT node, min(top) AS component_id FROM r GROUP BY node
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN c ON c.node = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence")


@query("op1_near_vectors")
def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


ORACLES["op1_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND list_aggregate(list_transform(embedding, lambda e: abs(e)), 'max') > 0
), u AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.95
), r AS (
  SELECT vec_id AS node, vec_id AS top FROM embeddings
  UNION
  SELECT u.b, r.top FROM r JOIN u ON u.a = r.node WHERE r.top < u.b
), c AS (
  SELECT node, min(top) AS component_id FROM r GROUP BY node
)
SELECT vec_id, (SELECT count(*) FROM u WHERE u.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.node = vec_id
"""


@query("op8_search")
def op8_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return search(docs, docs.where(F.col("doc_id") % 50 == 0), k=10)


ORACLES["op8_search"] = r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term
  FROM documents
), p AS (
  SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2
), l AS (
  SELECT doc_id, count(w.term) AS dl FROM documents LEFT JOIN w USING (doc_id) GROUP BY 1
), s AS (
  SELECT count(*) AS n, avg(dl) AS mean FROM l
), f AS (
  SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM p, s GROUP BY term, n
), m AS (
  SELECT q.doc_id AS query_id, d.doc_id,
         round(sum(q.tf * idf * d.tf * 2.2 / (d.tf + 1.2 * (1 - 0.75 + 0.75 * dl / mean))), 6) AS score
  FROM p q JOIN f USING (term) JOIN p d USING (term) JOIN l ON l.doc_id = d.doc_id, s
  WHERE q.doc_id % 50 = 0 GROUP BY 1, 2
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM m
)
SELECT * FROM r WHERE rank <= 10
"""


@query("op9_remove_repeats")
def op9_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLES["op9_remove_repeats"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i AS p, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS i FROM d)
), m AS (
  SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS least FROM w) WHERE least < doc_id
), r AS (  -- runs of removed strings, then of overlapping or touching ones
  SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM m GROUP BY doc_id, run
), g AS (
  SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 THEN 0 ELSE 1 END AS new FROM r
), n AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY a) AS k FROM g
), x AS (
  SELECT doc_id, k, min(a) AS a, max(b) AS b FROM n GROUP BY doc_id, k
), y AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_,
         lead(a) OVER (PARTITION BY doc_id ORDER BY a) IS NULL AS last_ FROM x
), z AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)) || CASE WHEN last_ THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS rest
  FROM y JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN z USING (doc_id)
"""


@query("op11_filter_audit")
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, good, toxic,
         CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY x) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f GROUP BY 1, 2
), o AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || letter FROM o, unnest(['A', 'B', 'C', 'D', 'E']) AS t(letter) WHERE NOT contains(o, letter)
), s AS (
  SELECT o AS filter_order, step, substr(o, step, 1) AS letter, substr(o, 1, step - 1) AS before
  FROM o, range(1, 6) AS r(step) WHERE length(o) = 5
), m AS (  -- translate leaves what a text fails besides the filters before
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN translate(fails, before || letter, '') = fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN contains(fails, letter) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM m
"""


@query("op12_windows")
def op12_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_windows(_table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


@query("op13_fill_in_middle")
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(_table(spark, sf_dir, "documents"))
    digests = [
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    ]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op13_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT doc_id, x, length(x)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u
), o AS (
  SELECT *, CASE form WHEN 'plain' THEN x
                 WHEN 'psm' THEN '<P>' || x[1:a] || '<S>' || x[b + 1:] || '<M>' || x[a + 1:b]
                 ELSE '<S>' || x[b + 1:] || '<P>' || x[1:a] || '<M>' || x[a + 1:b] END AS y FROM f
), p AS (
  SELECT *, instr(y, '<P>') AS p, instr(y, '<S>') AS s, instr(y, '<M>') AS m FROM o
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars, sha256(y) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN y
                   WHEN 'psm' THEN y[p + 3:s - 1] || y[m + 3:] || y[s + 3:m - 1]
                   ELSE y[p + 3:m - 1] || y[m + 3:] || y[s + 3:p - 1] END) AS restored_sha256
FROM p
"""
