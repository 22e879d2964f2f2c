"""The registered queries of this package, (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import (
    contamination,
    conversations,
    lines,
    mixing,
    periods,
    pii,
    quality,
    secrets,
    sharding,
    simhash,
    substrings,
    suffixes,
    tokenfiles,
)
from termloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_suffix_groups(spark, sf_dir):
    return suffixes.deduplicated(table(spark, sf_dir, "documents")).drop("kept")


@query
def op2_random_field(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op3_linked_secrets(spark, sf_dir):
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query
def op4_line_windows(spark, sf_dir):
    found = lines.deduplicated(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_removed", digest)


@query
def op5_decontamination(spark, sf_dir):
    documents, benchmark = (table(spark, sf_dir, x) for x in ("documents", "benchmark"))
    return contamination.leaks(documents, benchmark)


@query
def op6_fair_queueing(spark, sf_dir):
    rows = mixing.sized(table(spark, sf_dir, "documents"))
    return mixing.plan(rows).select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op7_covering_simhash(spark, sf_dir):
    found = simhash.classes(table(spark, sf_dir, "documents"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", shown, "component_id")


@query
def op8_hash_tree(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"), []).drop("row")


@query
def op9_fixed_blocks(spark, sf_dir):
    found = substrings.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op10_robust_outliers(spark, sf_dir):
    found = quality.judged(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("row.doc_id", *quality.COUNTS, "base_failed", "kept")


@query
def op11_block_convolution(spark, sf_dir):
    found = periods.periodic_runs(periods.planted(table(spark, sf_dir, "documents")))
    found = found.withColumn("best", periods.best(F.col("runs")))
    lines_of = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines_of, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


#: Vocabulary file of op12; any file of the tokenizers library will do.
TOKENIZER = "byte_bpe_50k.json"


@query
def op12_elias_fano(spark, sf_dir):
    import public_tokenizers

    files = tokenfiles.written(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return tokenfiles.located(files, F.crc32("ids").cast("long").alias("ids_crc32"))


@query
def op13_integer_paths(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    found = conversations.repaired(given, conversations.damaged(given))
    return found.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("repaired")


# Words of a text in DuckDB's dialect.
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SQL: dict[str, str] = {
    "op4_line_windows": """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, unnest(range(len(ls) - 2)) AS spot, ls FROM l WHERE len(ls) >= 3),
h AS (SELECT doc_id, spot, ls[spot + 1] || chr(10) || ls[spot + 2] || chr(10) || ls[spot + 3] AS run FROM w),
o AS (SELECT doc_id, spot, row_number() OVER (PARTITION BY run ORDER BY doc_id, spot) AS place FROM h),
r AS (SELECT DISTINCT doc_id, spot + k AS line FROM o, range(3) t(k) WHERE place > 1),
e AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS k FROM l),
kept AS (SELECT e.doc_id, count(*) AS n, string_agg(e.line, chr(10) ORDER BY e.k) AS text
         FROM e ANTI JOIN r ON e.doc_id = r.doc_id AND e.k = r.line GROUP BY ALL)
SELECT l.doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(ls), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM l LEFT JOIN kept USING (doc_id)
""",
    "op6_fair_queueing": f"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
             CAST(3 * source_size AS DOUBLE) AS cap FROM s),
v AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
        - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size,
             CASE WHEN cap / weight <= level THEN cap
                  ELSE weight * (SELECT arg_min(level, cap / weight) FROM v WHERE cap / weight > level)
             END AS target FROM v),
q AS (SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id
                                  ROWS UNBOUNDED PRECEDING) AS cum FROM d WHERE size > 0),
f AS (SELECT q.doc_id, q.source, q.size, epoch, md5(CAST(q.doc_id AS VARCHAR)) AS h,
             CAST(epoch * source_size + cum AS DOUBLE) / target AS finish
      FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source, range(3) r(epoch)),
m AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, epoch, h
                                ROWS UNBOUNDED PRECEDING) AS upto FROM f),
k AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM m
      WHERE upto <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(k.taken, 0) AS taken, d.source
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN k USING (doc_id)
""",
    "op9_fixed_blocks": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM d WHERE len(ws) >= 13),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS run FROM w),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS least FROM h),
r AS (SELECT DISTINCT doc_id, i + k AS spot FROM f, range(13) t(k) WHERE least < doc_id),
e AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS spot FROM d),
kept AS (SELECT e.doc_id, count(*) AS n, string_agg(e.word, ' ' ORDER BY e.spot) AS text
         FROM e ANTI JOIN r ON e.doc_id = r.doc_id AND e.spot = r.spot GROUP BY ALL)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
}
