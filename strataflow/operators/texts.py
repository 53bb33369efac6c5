"""Corpus-level text operators: term weights, sentence ranking, themes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NEGATIVE, POSITIVE, count_words, sentences, tokens
from ..session import stage
from .joins import broadcast_groups, hot_limit, lookup_by_hot_key
from .windows import top_n_per_group

WEIGHT_UNIT = 1_000_000  # term weights are integers in millionths, so sums do not depend on order


def term_weights(terms: DataFrame, key: Sequence[str], total: Column) -> DataFrame:
    """Documents per term and its inverse document frequency; `terms` has one row per (document, term)."""
    df = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))
    return df.withColumn("weight", F.round(F.log(total / F.col("n_docs")) * WEIGHT_UNIT).cast("long"))


def document_terms(docs: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """Each distinct term of the sentences of each document once."""
    words = F.flatten(F.transform(sentences(text), tokens))
    return docs.select(*key, F.explode(F.array_distinct(words)).alias("term"))


def sentence_scores(docs: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """Place and mean term weight of every sentence with words: (key, pos, score), without the texts.

    Documents are read and split once for the weights and again for each kind of words, as the words of all sentences would
    be several times the texts on disk. The weights of frequent terms are broadcast and added up where the documents are
    read, so one narrow row of a sentence is shuffled; of the words only rare ones are sent to their weights.
    """
    total = docs.agg(F.count(F.lit(1))).scalar()
    weights = stage(term_weights(document_terms(docs, key, text), key, total))
    place = docs.select(*key, F.posexplode(F.transform(sentences(text), tokens)).alias("pos", "_words"))
    words = place.select(*key, "pos", F.size("_words").alias("n_words"), F.explode("_words").alias("term"))
    weighted = lookup_by_hot_key(words, weights, "term", "weight", "n_docs", hot_limit(weights, "n_docs"))
    return weighted.groupBy(*key, "pos").agg((F.sum("weight") / F.max("n_words")).alias("score"))


def with_sentences(best: DataFrame, docs: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """Rows of (key, pos, ...) with the sentence there, one for each document of that key that has it. Few keys are broadcast to
    the documents; many meet them by shuffle, the only one that has texts."""
    rest = F.struct(*[c for c in best.columns if c not in key])
    wanted = broadcast_groups(best.groupBy(*key).agg(F.collect_list(rest).alias("_w")))
    found = docs.select(*key, F.col(text).alias("_t")).join(wanted, list(key))
    rows = found.select(*key, sentences("_t").alias("_s"), F.explode("_w").alias("_w"))
    return rows.select(*key, "_w.*", F.get("_s", F.col("_w.pos")).alias("sentence")).where(F.col("sentence").isNotNull())


def summarize(docs: DataFrame, key: Sequence[str], text: str, n: int = 3) -> DataFrame:
    """The n heaviest sentences of each document, in their original order."""
    order = [F.desc("score"), F.asc("pos")]
    best = top_n_per_group(sentence_scores(docs, key, text), key, order, n)
    # Documents that share a key have a sentence each in the same place.
    best = top_n_per_group(with_sentences(best, docs, key, text), key, order, n)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "sentence")))
    joined = F.array_join(F.transform(ordered, lambda s: s["sentence"]), ". ")
    return best.groupBy(*key).agg(joined.alias("summary"), F.count(F.lit(1)).alias("n_sentences"))


def summarize_groups(docs: DataFrame, key: Sequence[str], text: str, group: str, n: int = 3) -> DataFrame:
    """Per group the document count and its n heaviest sentences over all documents."""
    order = [F.desc("score"), *[F.asc(k) for k in key], F.asc("pos")]
    best = top_n_per_group(sentence_scores(docs, key, text).join(docs.select(*key, group), list(key)), [group], order, n)
    best = top_n_per_group(with_sentences(best, docs, key, text), [group], order, n, rank_col="_rank")
    ordered = F.array_sort(F.collect_list(F.struct("_rank", "sentence")))
    lines = best.groupBy(group).agg(F.array_join(F.transform(ordered, lambda s: s["sentence"]), " | ").alias("summary"))
    return docs.groupBy(group).agg(F.count(F.lit(1)).alias("n_docs")).join(lines, group, "left")


def answer_question(docs: DataFrame, key: Sequence[str], text: str, terms: Sequence[str]) -> DataFrame:
    """Best sentence per document for the terms of a question.

    A sentence scores the weights of the distinct question terms it holds. Only the document
    counts of those few terms are needed: one aggregate row, read as a scalar subquery.
    """
    words = tokens(text)
    flags = [F.count_if(F.array_contains(words, w)).alias(f"_d{i}") for i, w in enumerate(terms)]
    stats = docs.agg(F.count(F.lit(1)).alias("_n"), *flags)
    cells = [
        F.when(F.col(f"_d{i}") > 0, F.round(F.log(F.col("_n") / F.col(f"_d{i}")) * WEIGHT_UNIT)).otherwise(0).cast("long")
        for i in range(len(terms))
    ]
    weights = stats.select(F.array(*cells)).scalar()
    rows = docs.select(*key, F.posexplode(sentences(text)).alias("pos", "sentence"), weights.alias("_w"))
    own = tokens("sentence")
    score = None
    for i, w in enumerate(terms):
        part = F.when(F.array_contains(own, w), F.col("_w")[i]).otherwise(F.lit(0))
        score = part if score is None else score + part
    scored = rows.withColumn("score", score).where(F.col("score") > 0).drop("_w")
    return top_n_per_group(scored, key, [F.desc("score"), F.asc("pos")])


def themes(docs: DataFrame, key: Sequence[str], text: str, group: str, n: int = 5, min_length: int = 4) -> DataFrame:
    """Per group the n terms with the highest (documents in group) x (inverse document frequency).

    Counts are combined before every shuffle; each group sends n rows per task to the ranking.
    """
    total = docs.agg(F.count(F.lit(1))).scalar()
    long_enough = F.filter(F.array_distinct(tokens(text)), lambda w: F.length(w) >= min_length)
    pairs = docs.select(group, F.explode(long_enough).alias("term"))
    counts = pairs.groupBy(group, "term").agg(F.count(F.lit(1)).alias("n_docs"))
    everywhere = counts.groupBy("term").agg(F.sum("n_docs").alias("_all"))
    weight = F.round(F.log(total / F.col("_all")) * WEIGHT_UNIT).cast("long")
    scored = counts.join(everywhere, "term").withColumn("score", F.col("n_docs") * weight).drop("_all")
    return top_n_per_group(scored, [group], [F.desc("score"), F.asc("term")], n, rank_col="theme_rank")


def hashed_vectors(docs: DataFrame, key: Sequence[str], text: str, dims: int = 64) -> DataFrame:
    """Normalised hashed term counts per document as array<double>."""
    bucket = F.conv(F.substring(F.md5(F.col("term")), 1, 6), 16, 10).cast("long") % dims
    counts = (
        docs.select(*key, F.explode(tokens(text)).alias("term"))
        .groupBy(*key, bucket.cast("int").alias("_b"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # At most `dims` cells per document reach this aggregate.
    cells = F.map_from_entries(F.collect_list(F.struct("_b", F.col("_n").cast("double"))))
    packed = counts.groupBy(*key).agg(cells.alias("_m"), F.sqrt(F.sum(F.col("_n") * F.col("_n"))).alias("_norm"))
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.element_at("_m", i), F.lit(0.0)) / F.col("_norm")
    )
    return packed.select(*key, dense.alias("embedding"))


def entity_sentiment(
    docs: DataFrame,
    text: str,
    entities: Sequence[str],
    positive: Sequence[str] = POSITIVE,
    negative: Sequence[str] = NEGATIVE,
) -> DataFrame:
    """Per entity term: sentences that name it and the sentiment of those sentences."""
    rows = docs.select(F.explode(sentences(text)).alias("sentence")).withColumn("_words", tokens("sentence"))
    named = F.array_intersect("_words", F.array(*[F.lit(e) for e in entities]))
    hits = rows.select(
        F.explode(named).alias("entity"),
        count_words(F.col("_words"), positive).alias("_p"),
        count_words(F.col("_words"), negative).alias("_n"),
    )
    g = hits.groupBy("entity").agg(
        F.count(F.lit(1)).alias("mentions"), F.sum("_p").alias("positive"), F.sum("_n").alias("negative")
    )
    both = F.col("positive") + F.col("negative")
    return g.withColumn(
        "sentiment", F.when(both > 0, (F.col("positive") - F.col("negative")) / both).otherwise(F.lit(0.0))
    )


def topic_relations(left: DataFrame, right: DataFrame, left_key: Sequence[str], right_key: Sequence[str], n: int = 3) -> DataFrame:
    """Which rows of two tables are related through a shared topic, without writing out the pairs.

    Both inputs have a `topics` array. Per topic: matching rows on each side, the number of
    related pairs, and the first n keys of each side.
    """

    def side(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
        rows = df.select(*key, F.explode("topics").alias("topic"))
        counts = rows.groupBy("topic").agg(F.count(F.lit(1)).alias(f"n_{name}"))
        first = top_n_per_group(rows, ["topic"], [F.asc(k) for k in key], n)
        text = F.concat_ws(":", *[F.col(k).cast("string") for k in key])
        listed = F.array_sort(F.collect_list(F.struct(*key, text.alias("_t"))))
        sample = first.groupBy("topic").agg(
            F.array_join(F.transform(listed, lambda s: s["_t"]), ",").alias(f"first_{name}")
        )
        return counts.join(sample, "topic")

    both = side(left, left_key, "left").join(side(right, right_key, "right"), "topic")
    return both.withColumn("n_pairs", F.col("n_left") * F.col("n_right"))
