"""Spelling variants: words one edit apart, found by pivotal grams, and the commonest form each belongs to.

Letter pairs of a word are ordered by how rare they are over all words. The rarest three make up its gram prefix, and two
of them that do not overlap are its pivots: one edit destroys one pivot at most. Of two near words, the one whose prefix
ends at the rarer pair has a pivot among the other's prefix grams, and everything on one side of that pivot is unchanged,
which fixes its place.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_table

#: Letters of words; A to Z are lower-cased first.
LETTERS = "a-zÀ-ÿ"
#: Letters in a gram, and edits that make words near.
GRAM, EDITS = 2, 1
LEAST, TIMES = 5, 3


def count_words(df: DataFrame, id_col="doc_id", text_col="text", least=LEAST, times=TIMES, slips=0) -> DataFrame:
    """(word, n): maximal runs of letters of at least `least` code points, A to Z lower-cased, that occur `times` times.

    With `slips`, a run whose checksum h of `<id>:<run>` that number divides loses its code point h % length first. A null
    text has no words, a null id counts as empty; repeated rows count each. Only words and counts are shuffled, summed in
    each task first. Other columns are not read.
    """
    low = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # A slip only shortens, so shorter runs are out.
    found = df.select(name.alias("id"), F.explode(F.regexp_extract_all(low, F.lit(f"([{LETTERS}]{{{least},}})"), 1)).alias("word"))
    if slips:
        found = found.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word")))
        cut = "CAST(h % length(word) AS INT)"
        short = F.expr(f"concat(substring(word, 1, {cut}), substring(word, {cut} + 2))")
        found = found.select(F.when(F.col("h") % slips == 0, short).otherwise(F.col("word")).alias("word")).filter(F.length("word") >= least)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= times)


def grams(word: str) -> list[str]:
    return [word[k : k + GRAM] for k in range(len(word) - GRAM + 1)]


def _gram_counts(batches):
    for batch in batches:
        c = Counter()
        for w in batch["word"].to_pylist():
            c.update(grams(w))
        yield pa.RecordBatch.from_pydict({"gram": pa.array(c.keys(), pa.string()), "n": pa.array(c.values(), pa.int64())})


def pivots(places: list[int], costs: list[int], need: int = EDITS + 1) -> list[int]:
    """`need` of the ascending places, none nearer than a gram's length to the next, of the least total cost: row k of the
    table holds the best choice of k among the places so far."""
    far = sum(costs) + 1
    best = [[(0, ())] * (len(places) + 1)]
    for k in range(1, need + 1):
        row, free = [(far, ())], 0
        for i, place in enumerate(places):
            while places[free] + GRAM <= place:
                free += 1
            cost, chosen = best[k - 1][free]  # of the places that end before this one
            taken = (cost + costs[i], (*chosen, place)) if len(chosen) == k - 1 else (far, ())
            row.append(min(row[-1], taken, key=lambda x: x[0]))
        best.append(row)
    return list(best[need][-1][1])


def _signatures(shared):
    def run(batches):
        rank, count = shared.value
        for batch in batches:
            last, first, second, prefix = [], [], [], []
            for w in batch["word"].to_pylist():
                own = grams(w)
                if len(own) <= GRAM * EDITS:
                    raise ValueError(f"{w!r}: words need {GRAM * EDITS + GRAM} code points")
                order = sorted(rank[g] for g in own)
                # All occurrences up to the rank at which the prefix ends, so repeats of that gram belong to it.
                end = order[GRAM * EDITS]
                places = [k for k, g in enumerate(own) if rank[g] <= end]
                p, q = pivots(places, [count[own[k]] for k in places])
                last.append(end)
                first.append(p)
                second.append(q)
                prefix.append(places)
            cols = {"last": pa.array(last, pa.int32()), "first": pa.array(first, pa.int32()), "second": pa.array(second, pa.int32()), "prefix": pa.array(prefix, pa.list_(pa.int32()))}
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], *cols.values()], names=["word", "n", *cols])

    return run


def _sides(place: str, mine: str, size: str) -> list[Column]:
    """Keys of a gram at `place` (of word `mine`) for a partner of `size` letters, of which the edit leaves three parts
    alone: the gram, one side of it, and the nearer or farther half of the other side. Halves are those of the shorter or
    longer partner with `size` letters, so both words cut alike.
    """
    right = f"({size} - {place} - {GRAM})"  # letters right of the gram, in the partner
    left = f"({place} + {size} - length({mine}))"  # letters left of it, in the partner
    tail = f"({right} - {right} div 2)"
    head = f"({left} - {left} div 2)"
    begin = f"substring({mine}, 1, {place} + {GRAM})"
    parts = [
        # The left side unchanged: then the nearer half, or the farther half.
        f"'a', substring({mine}, 1, {place} + {GRAM} + {right} div 2)",
        f"'b', concat({begin}, '|', right({mine}, {tail}))",
        # The right side unchanged: then the half at the word's beginning, or the half next to the gram.
        f"'c', concat(substring({mine}, 1, {left} div 2), '|', substring({mine}, {place} + 1))",
        f"'d', substring({mine}, greatest({place} - {head}, 0) + 1)",
    ]
    return [F.expr(f"xxhash64({p}, {size})") for p in parts]


def near_words(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): every pair of different words one inserted, deleted or replaced code point apart, once, a < b.

    `words` has distinct words of four code points or more (shorter ones raise an error) and their counts n. Every candidate shares a key with the other
    word and is compared in full; no bucket is capped. Grams are counted over all words; their number is bounded by the
    alphabet's square (8,100 here), so their ranks are broadcast.
    """
    spark = words.sparkSession
    counted = words.mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).orderBy("n", "gram").collect()
    shared = spark.sparkContext.broadcast(({r.gram: k for k, r in enumerate(counted)}, {r.gram: r.n for r in counted}))
    signed = words.mapInArrow(_signatures(shared), "word string, n long, last int, first int, second int, prefix array<int>")
    signed = shared_table(signed, "signatures")
    size = F.explode(F.array(*[F.length("word") + F.lit(d) for d in range(-EDITS, EDITS + 1)])).alias("size")
    probes = signed.select("word", "n", "last", "first", "second", size)
    # The edit is right of the first pivot or left of the second.
    keys = F.array(*_sides("first", "word", "size")[:2], *_sides("second", "word", "size")[2:])
    probes = probes.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("last").alias("last_a"), F.explode(F.array_distinct(keys)).alias("key"))
    index = signed.select("word", "n", "last", F.explode("prefix").alias("place")).withColumn("size", F.length("word"))
    index = index.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("last").alias("last_b"), F.explode(F.array(*_sides("place", "word", "size"))).alias("key"))
    met = (probes["key"] == index["key"]) & (F.col("last_a") <= F.col("last_b")) & (F.col("a") != F.col("b"))
    found = probes.join(index, met & (F.levenshtein("a", "b", EDITS) == EDITS))
    swap = F.col("a") > F.col("b")
    pair = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(z) for x, y, z in (("a", "b", "a"), ("b", "a", "b"), ("n_a", "n_b", "n_a"), ("n_b", "n_a", "n_b"))]
    return found.select(*pair).distinct()


def spelling_forms(words: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    A word's form is its near word of the largest n (of equal ones the first in code-point order) if that is at least twice
    its own n. Following forms leads to the root; a word without form is its own root. n doubles with each step, so 62
    steps lead to every root and paths are halved at most six times. An empty table gives no rows.
    """
    words = shared_table(words, "words")
    pairs = near_words(words)
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m")),
        )
    ).alias("x")
    best = pairs.select(both).groupBy("x.word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("x.m")).alias("m"), F.col("x.near").alias("near"))).alias("best"))
    enough = -F.col("best.m") >= 2 * F.col("n")
    forms = words.join(best, "word", "left").select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, -F.col("best.m")).alias("form_n"),
    )
    forms = shared_table(forms, "forms")
    at = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = shared_table(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return forms.join(at, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(df: DataFrame, id_col="doc_id", text_col="text", slips=0) -> DataFrame:
    """`spelling_forms` of the words of all texts."""
    return spelling_forms(count_words(df, id_col, text_col, slips=slips))
