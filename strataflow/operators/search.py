"""Keyword search with BM25 over a stored postings table, filters, and rank fusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import stage
from ..sources.sinks import batch_ids, read_batches, write_batch

K1, B = 1.2, 0.75
RRF_K = 60


def postings(docs: DataFrame, key: str, text: str, terms: Sequence[str] | None = None) -> DataFrame:
    """(term, document, occurrences, document length), for all terms or only the given ones."""
    words = docs.select(F.col(key).alias("doc"), tokens(text).alias("_w"))
    kept = F.col("_w") if terms is None else F.filter("_w", lambda w: w.isin(*terms))
    rows = words.select("doc", F.size("_w").alias("doc_len"), F.explode(kept).alias("term"))
    return rows.groupBy("term", "doc", "doc_len").agg(F.count(F.lit(1)).alias("tf"))


def lengths(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc"), F.size(tokens(text)).alias("doc_len"))


def refresh_index(docs: DataFrame, key: str, text: str, path: str, batch_id: int) -> None:
    """Add the postings of new documents; document counts are taken from the postings at query time.

    Sorted by term inside the files, so a query's term filter skips row groups.
    """
    # By ranges of (term, document), so a frequent term is cut as often as its size asks for.
    by_term = postings(docs, key, text).repartitionByRange("term", "doc")
    write_batch(by_term.sortWithinPartitions("term", "doc"), f"{path}/postings", batch_id)
    write_batch(lengths(docs, key, text), f"{path}/lengths", batch_id)


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    if not batch_ids(spark, f"{path}/postings"):
        raise FileNotFoundError(path)
    return read_batches(spark, f"{path}/postings"), read_batches(spark, f"{path}/lengths")


def bm25(
    index: DataFrame,
    doc_lengths: DataFrame,
    terms: Sequence[str],
    attributes: DataFrame | None = None,
    key: str = "doc",
    where: Column | None = None,
    k: int | None = 10,
) -> DataFrame:
    """Documents ranked for the query terms; attribute filters apply before the top k."""
    hits = index.where(F.col("term").isin(*terms))
    # Document count and mean length, as one scalar struct.
    corpus = doc_lengths.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("doc_len").alias("avg"))).scalar()
    # One row per query term.
    counts = hits.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    rows = hits.join(F.broadcast(counts), "term").withColumn("_c", corpus)
    rows = rows.withColumns({"_n": F.col("_c.n"), "_avg": F.col("_c.avg")})
    idf = F.log(1 + (F.col("_n") - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    tf = F.col("tf")
    part = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("doc_len") / F.col("_avg")))
    scored = rows.groupBy("doc").agg(F.round(F.sum(part), 6).alias("score"), F.count(F.lit(1)).alias("terms_hit"))
    if attributes is not None:
        kept = attributes.where(where) if where is not None else attributes
        scored = scored.join(kept.withColumnRenamed(key, "doc"), "doc")
    ranked = scored.orderBy(F.desc("score"), F.asc("doc"))
    return ranked.limit(k) if k is not None else ranked


def search_texts(
    docs: DataFrame, key: str, text: str, terms: Sequence[str], keep: Sequence[str] = (), where: Column | None = None, k: int | None = 10
) -> DataFrame:
    """BM25 ranking straight from the documents, in one pass over their texts.

    The pass leaves one narrow row per document (length, occurrences of each term, kept columns), staged for the two
    readers: the corpus figures, one scalar, and the scores of documents with a hit.
    """
    cut = docs.select(F.col(key).alias("doc"), *keep, tokens(text).alias("_w"))

    def occurrences(term: str) -> Column:
        return F.size(F.filter("_w", lambda w: w == F.lit(term)))

    rows = stage(cut.select("doc", *keep, F.size("_w").alias("doc_len"), F.array(*[occurrences(x) for x in terms]).alias("_tf")))
    seen = F.array(*[F.count_if(F.col("_tf")[i] > 0) for i in range(len(terms))])
    corpus = rows.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("doc_len").alias("avg"), seen.alias("df"))).scalar()
    hits = rows.where(F.exists("_tf", lambda n: n > 0)).withColumn("_c", corpus)
    if where is not None:
        hits = hits.where(where)
    n, norm = F.col("_c.n"), K1 * (1 - B + B * F.col("doc_len") / F.col("_c.avg"))
    parts = F.lit(0.0)
    for i in range(len(terms)):
        tf, df = F.col("_tf")[i], F.col("_c.df")[i]
        parts = parts + F.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + norm)
    out = hits.select(
        "doc", *keep, F.round(parts, 6).alias("score"), F.size(F.filter("_tf", lambda x: x > 0)).cast("long").alias("terms_hit")
    )
    ranked = out.orderBy(F.desc("score"), F.asc("doc"))
    return ranked.limit(k) if k is not None else ranked


def substring_search(docs: DataFrame, index: DataFrame, key: str, text: str, phrase: str) -> DataFrame:
    """Documents that contain the phrase; the inner words of the phrase narrow the candidates.

    The first and last word may be parts of longer words, so only the words between them
    must be index terms; with none, every document is checked.
    """
    # The phrase is cut the same way the index cuts documents.
    words = [w for w in _cut(phrase)]
    inner = sorted({w for w in words[1:-1] if w})
    rows = docs
    if inner:
        have = index.where(F.col("term").isin(*inner)).groupBy("doc").agg(F.countDistinct("term").alias("_c"))
        wanted = have.where(F.col("_c") == len(inner)).select(F.col("doc").alias(key))
        rows = docs.join(wanted, key, "left_semi")
    return rows.where(F.contains(F.col(text), F.lit(phrase)))


def _cut(phrase: str) -> list[str]:
    out, word = [], ""
    for ch in phrase.lower():
        if ch.isalpha():
            word += ch
        else:
            out.append(word)
            word = ""
    return [*out, word]


def fuse_rankings(rankings: Sequence[DataFrame], key: str, k: int) -> DataFrame:
    """Reciprocal rank fusion of top lists (columns key, rank): sum of 1 / (60 + rank)."""
    from .reshape import union_all

    parts = [r.select(key, (F.lit(1.0) / (RRF_K + F.col("rank"))).alias("_s")) for r in rankings]
    fused = union_all(parts).groupBy(key).agg(F.round(F.sum("_s"), 9).alias("score"))
    return fused.orderBy(F.desc("score"), F.asc(key)).limit(k)
