"""The registered queries of this folder and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import alignment_report
from .contamination import contamination_report
from .exact import exact_groups
from .near import near_groups
from .personal import personal_data
from .pieces import round_trip
from .quality import quality
from .repeats import remove_repeats
from .scoring import score_texts
from .secrets import secrets
from .sharding import shard_table
from .spelling import spelling_groups
from .toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return wrap


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


EXACT_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t ORDER BY points DESC, doc_id)
"""


@query("op1_exact_dedup", EXACT_SQL)
def op1(spark, sf_dir):
    return exact_groups(read(spark, sf_dir, "documents"))


WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

CONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
       FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS k
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw))),
hit AS (SELECT doc_id, item, m, i FROM dw JOIN bw USING (m, k)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op2_decontamination", CONTAMINATION_SQL)
def op2(spark, sf_dir):
    return contamination_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("spans")


@query("op4_secret_scan")
def op4(spark, sf_dir):
    return secrets(read(spark, sf_dir, "documents")).drop("found")


@query("op8_personal_data")
def op8(spark, sf_dir):
    return personal_data(read(spark, sf_dir, "documents")).drop("found")


@query("op6_quality")
def op6(spark, sf_dir):
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


@query("op7_sentencepiece")
def op7(spark, sf_dir):
    return round_trip(read(spark, sf_dir, "documents"))


@query("op3_near_dedup")
def op3(spark, sf_dir):
    return near_groups(read(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark, sf_dir):
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op9_repeated_passages")
def op9(spark, sf_dir):
    return remove_repeats(read(spark, sf_dir, "documents"), keep_text=False)


@query("op10_lm_scoring")
def op10(spark, sf_dir):
    return score_texts(read(spark, sf_dir, "documents"))


#: DuckDB has no crc32: a table of one entry a byte value, from its rule, and a checksum over a text's bytes.
CRC_TABLE = """t AS (SELECT list(x ORDER BY k) AS t FROM (
  SELECT k, list_reduce(list_prepend(k, range(8)), lambda c, i: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS x
  FROM range(256) r(k)))"""


def crc_sql(text: str) -> str:
    steps = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[a-z\u00C0-\u00FF]+')) AS r FROM documents),
h AS (SELECT r, {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r")} AS h FROM r, t WHERE length(r) >= 5),
w AS (SELECT CASE WHEN h % 97 = 0 THEN r[:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word FROM h),
n AS (SELECT word, count(*) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
k AS (SELECT word, n, i, word[:i - 1] || '_' || word[i + 1:] AS hole, word[:i - 1] || word[i + 1:] AS less
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM n)),
p AS (SELECT x.word, y.word AS near, y.n AS m FROM k x JOIN k y ON x.hole = y.hole AND x.i = y.i WHERE x.word <> y.word
      UNION SELECT x.word, y.word, y.n FROM k x JOIN n y ON x.less = y.word
      UNION SELECT y.word, x.word, x.n FROM k x JOIN n y ON x.less = y.word),
b AS (SELECT word, count(*) AS n_near, first(near ORDER BY m DESC, near) AS near, max(m) AS m FROM p GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN near END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
      FROM n LEFT JOIN b USING (word)),
s AS (SELECT word, word AS root, form AS next FROM f
      UNION ALL SELECT s.word, f.word, f.form FROM s JOIN f ON s.next = f.word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, root FROM s WHERE next IS NULL) USING (word)
"""


@query("op11_spelling", SPELLING_SQL)
def op11(spark, sf_dir):
    return spelling_groups(read(spark, sf_dir, "documents"), slips=97)


@query("op12_alignment")
def op12(spark, sf_dir):
    return alignment_report(read(spark, sf_dir, "documents"))


SHARDS_SQL = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size,
             {crc_sql("coalesce(text, '')")} AS crc,
             md5('13:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, coalesce('=' || source, '') AS name
      FROM documents, t),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY h, doc_id, size, crc) - 1 AS r, count(*) OVER (PARTITION BY name) AS c,
             ('0x' || substr(md5('13:' || name), 1, 5))::BIGINT AS u FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY CAST(r * 1048576 + u AS DOUBLE) / CAST(c * 1048576 AS DOUBLE), name, h, doc_id, size, crc) - 1 AS p,
             count(*) OVER () AS n FROM r),
s AS (SELECT *, p * 40 // n AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(p - (shard * n + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, source
FROM s
"""


@query("op13_sharding", SHARDS_SQL)
def op13(spark, sf_dir):
    return shard_table(read(spark, sf_dir, "documents"))
