"""Registered queries of the operators in this folder, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import (
    ann, decontaminate, exact_dedup, hard_negatives, language_id, license_scan, mixing, near_dup, resampling, secret_scan,
    sharding, toxicity, warc,
)
from driftline.session import fresh_path

# Production targets of the mix.  Topics are given in full; of the sources only the ones that are to be held down or
# lifted are named.  Every margin has a share for ``other``, the values it does not name and nulls: without it they would
# be dropped for certain.  Shares are relative: those of values that the corpus does not hold are spread over the rest.
TOPIC_RULES = (
    ("legal", r"(?i)licen[cs]e|rights reserved"),
    ("secrets", r"(?i)token =|password|api_key"),
    ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]|\+?[0-9]{3}[-. ][0-9]{3}"),
    ("tabular", r"\|"),
)
TARGETS = {
    "source": {"src0": 0.15, "src1": 0.06, "src2": 0.06, "src3": 0.06, "src4": 0.06, "other": 0.61},
    "lang": {"en": 0.5, "de": 0.18, "fr": 0.18, "es": 0.14, "other": 0.05},
    "topic": {"legal": 0.04, "secrets": 0.01, "contact": 0.05, "tabular": 0.1, "other": 0.8},
}
MIX_KEEP = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def mixed(docs: DataFrame, keep: float = MIX_KEEP) -> DataFrame:
    """Documents with topic, tokens, weight, prob and sampled under the production targets."""
    return mixing.mix(docs.withColumn("topic", mixing.topic_by_rules(F.col("text"), TOPIC_RULES)), TARGETS, keep)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixed(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "source", "lang", "topic", "tokens", F.round("weight", 6).alias("weight"), F.round("prob", 6).alias("prob"), "sampled"
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_of_id() % 4 == 2, F.lit(False))
    known = language_id.learn(docs.filter(crc_of_id() % 4 != 2), "text", "lang", "doc_id")
    found = language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), known)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_warc_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontaminate.decontaminate(docs, items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels outside the held-out fold."""
    return table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(crc_of_id() % 5 != 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, toxic_labels(spark, sf_dir))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(crc_of_id() % 5 == 0, F.lit(False)).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans")
    )


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, rows.filter(F.col("vec_id") % 50 == 0))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("id") % 100 == 0)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), keep="largest", fold_case=True)


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text")
    return resampling.resample(docs, items)


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_mix_sources, op3_secret_scan, op4_shard, op5_language_id, op6_warc_reader, op7_near_duplicates,
        op8_decontaminate, op9_toxicity, op10_vector_search, op11_hard_negatives, op12_exact_dedup, op13_resample,
    )
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate(coalesce({text}, ''), '{upper}', '{upper.lower()}')"


def _sql_mix() -> str:
    """Raking and calibration unrolled over the cells, as in :mod:`driftline.llm.mixing`."""
    names = list(TARGETS)
    topic = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPIC_RULES)
    named = {n: [v for v in TARGETS[n] if v != "other"] for n in names}
    quoted = {n: ", ".join(f"'{v}'" for v in named[n]) for n in names}
    steps = [
        f"""d AS (SELECT doc_id, source, lang, text, CASE {topic} ELSE 'other' END AS topic,
            len(regexp_extract_all(coalesce(text, ''), '{mixing.TOKEN}')) AS tokens FROM documents)""",
        "e AS (SELECT *, " + ", ".join(
            f"CASE WHEN {n} IN ({quoted[n]}) THEN {n} ELSE 'other' END AS c_{n}" for n in names
        ) + " FROM d)",
        "w0 AS (SELECT c_source, c_lang, c_topic, CAST(sum(tokens) AS DOUBLE) AS m, CAST(sum(tokens) AS DOUBLE) AS w FROM e GROUP BY ALL)",
    ]
    steps += [
        f"g_{n}(v, goal) AS (VALUES " + ", ".join(f"('{v}', CAST({TARGETS[n].get(v, 0.0)} AS DOUBLE))" for v in [*named[n], "other"]) + ")"
        for n in names
    ]
    at = 0
    for _ in range(mixing.RAKING_ROUNDS):
        for n in names:
            steps.append(
                f"""w{at + 1} AS MATERIALIZED (SELECT w{at}.c_source, w{at}.c_lang, w{at}.c_topic, m, CASE WHEN have > 0 AND total > 0
                THEN w * (goal / total / have) ELSE CASE WHEN total > 0 THEN 0 ELSE w END END AS w FROM w{at}
                JOIN (SELECT c_{n}, have, goal, sum(CASE WHEN have > 0 THEN goal ELSE 0 END) OVER () AS total FROM
                (SELECT c_{n}, sum(w) AS have FROM w{at} GROUP BY 1) JOIN g_{n} ON v = c_{n}) h ON h.c_{n} = w{at}.c_{n})"""
            )
            at += 1
    steps.append(f"f AS MATERIALIZED (SELECT *, CASE WHEN m > 0 THEN w * (SELECT greatest(sum(m), 1) FROM w{at}) / m ELSE 0 END AS f FROM w{at})")
    budget = f"(SELECT {MIX_KEEP} * greatest(sum(m), 1) FROM f)"
    steps.append(f"s0 AS MATERIALIZED (SELECT {budget} / greatest((SELECT sum(m * f) FROM f), 1e-300) AS s)")
    for i in range(mixing.BUDGET_ROUNDS):
        steps.append(
            f"""s{i + 1} AS MATERIALIZED (SELECT coalesce((SELECT CASE WHEN sum(CASE WHEN s * f < 1 THEN m * f ELSE 0 END) > 0 THEN
            greatest(any_value(s), ({budget} - sum(CASE WHEN s * f >= 1 AND f > 0 THEN m ELSE 0 END))
            / sum(CASE WHEN s * f < 1 THEN m * f ELSE 0 END)) ELSE any_value(s) END FROM f, s{i}), 0) AS s)"""
        )
    last = mixing.BUDGET_ROUNDS
    draw = f"CAST(('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8)) AS BIGINT) / 4294967296.0"
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, source, lang, topic, tokens, round(f, 6) AS weight, round(least(1.0, s * f), 6) AS prob,
               {draw} < least(1.0, s * f) AS sampled
        FROM e JOIN f USING (c_source, c_lang, c_topic), s{last}"""


SQL_DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_lower("text")}, '{WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_lower("text")}, '{WORD}') AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM bw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d JOIN sizes ON len(w) >= n),
hit AS (SELECT r, item_id, i, win.n FROM dw JOIN win ON win.n = dw.n AND win.k = array_to_string(dw.w[i:i + dw.n - 1], ' ')),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, {1 + 5 * g}, 5) AS BIGINT) >> {s}) & 31 AS INTEGER) + 1, 1)"
    for g in range(8)
    for s in (15, 10, 5, 0)
)
SQL_WARC = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM q
"""

SQL_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
             list_sum(list_transform(list_zip(a.x, r.x), lambda p: p[1] * p[2])) AS score
      FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id,
       CAST(positive_score AS BIGINT) AS positive_score, CAST(score AS BIGINT) AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""

SQL_EXACT = f"""
WITH d AS (SELECT doc_id, sha256({_lower("text")}) AS text_sha256 FROM documents),
e AS (SELECT *, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size FROM d WINDOW g AS (PARTITION BY text_sha256))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM e
"""

# CRC-32 of the distinct words: a table of 256 remainders, then one step a byte.
SQL_RESAMPLE = f"""
WITH RECURSIVE bits(b, i, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE i < 8),
lookup AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_lower("text")}, '{WORD}') AS w FROM documents),
dw AS (SELECT r, unnest(w) AS word FROM d),
bw AS (SELECT unnest(regexp_extract_all({_lower("text")}, '{WORD}')) AS word FROM benchmark),
vocabulary AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
hashed AS (SELECT word, xor(list_reduce(list_prepend(4294967295,
    list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM vocabulary, lookup),
src AS (SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (word) GROUP BY 1),
tgt AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (word) GROUP BY 1),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM src) AS s_all, (SELECT coalesce(sum(t), 0) FROM tgt) AS t_all),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000.0::DOUBLE)
    / ((s + 1.0::DOUBLE) * (t_all + 10000.0::DOUBLE)))) AS BIGINT) AS g FROM src LEFT JOIN tgt USING (bucket), sums),
weights AS (SELECT r, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM dw JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, r, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM d LEFT JOIN weights USING (r)),
places AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN places USING (r)
"""

ORACLES = {
    "op11_hard_negatives": SQL_NEGATIVES, "op12_exact_dedup": SQL_EXACT, "op13_resample": SQL_RESAMPLE, "op2_mix_sources": _sql_mix(),
    "op6_warc_reader": SQL_WARC, "op8_decontaminate": SQL_DECONTAMINATE,
}
