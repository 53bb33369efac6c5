"""Equal tiles of a table by selection: the rows at which tiles end are found from counts, no row is moved.

The value at a rank is bracketed by a quantile sketch, counts by value inside the bracket give it exactly, and only where
rows tie at a cut the tie-break is searched the same way. Tiles are then comparisons with a few literals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Exact type that all order values are compared in; nulls take its last value.
NUMBER = "decimal(38,6)"
LAST = "9" * 32 + ".999999"
ACCURACY = 10_000


def rank_values(rows: DataFrame, wanted: dict[int, dict[int, int]], sizes: dict[int, int]) -> dict[tuple[int, int], tuple]:
    """(group, rank from 0) -> (value, rows of the group before it, rows with it), for rows of (g, x).

    Two aggregations: a sketch per group, then one count for each stretch between brackets and for each value inside one.
    A bracket holds about 4 / ACCURACY of its group's rows besides ties of one value, which are one count.
    """
    probes = {g: [_around(r, sizes[g]) for r in ranks] for g, ranks in wanted.items()}
    every = sorted({p for pairs in probes.values() for pair in pairs for p in pair})
    sketch = rows.groupBy("g").agg(F.percentile_approx(F.col("x").cast("double"), every, ACCURACY).alias("q")).collect()
    found = {r.g: dict(zip(every, r.q, strict=True)) for r in sketch}
    stretch = inside = None
    for g in wanted:
        # A step down and up, as the sketch speaks in doubles.
        edges = [(found[g][a], found[g][b]) for a, b in probes[g]]
        spans = _merged([(lo - abs(lo) * 1e-12 - 1e-6, hi + abs(hi) * 1e-12 + 1e-6) for lo, hi in edges])
        value = F.col("x").cast("double")
        before = reduce(lambda a, b: a + b, [(value >= lo).cast("int") + (value > hi).cast("int") for lo, hi in spans])
        held = reduce(lambda a, b: a | b, [value.between(lo, hi) for lo, hi in spans])
        mine = F.col("g") == g
        stretch = F.when(mine, before) if stretch is None else stretch.when(mine, before)
        inside = F.when(mine, held) if inside is None else inside.when(mine, held)
    counted = (
        rows.select("g", stretch.alias("s"), F.when(inside, F.col("x")).alias("x"))
        .groupBy("g", "s", "x")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    walk = Window.partitionBy("g").orderBy("s", "x").rowsBetween(Window.unboundedPreceding, 0)
    ends = counted.withColumn("end", F.sum("c").over(walk))
    hits = [(F.col("g") == g) & (F.col("end") - F.col("c") <= r) & (F.col("end") > r) for g, ranks in wanted.items() for r in ranks]
    out = {}
    for row in ends.where(reduce(lambda a, b: a | b, hits)).collect():
        for r in wanted[row.g]:
            if row.end - row.c <= r < row.end:
                if row.x is None:
                    raise RuntimeError(f"rank {r} of group {row.g} lies outside its bracket")
                out[row.g, r] = (row.x, row.end - row.c, row.c)
    return out


def _around(rank: int, size: int) -> tuple[float, float]:
    """Two quantiles of the sketch that are sure to hold the rank between them."""
    slack = 2 / ACCURACY + 2 / size
    at = (rank + 0.5) / size
    return max(0.0, at - slack), min(1.0, at + slack)


def _merged(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def tiles_by_cuts(df: DataFrame, tiles: int, orders: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Adds ntile(tiles) columns over all rows, one for each order: (value, unique tie-break), both numbers, ascending;
    negate a number for descending, nulls come last. The first (rows % tiles) tiles have one row more.

    `df` is read five times by small aggregations (of the order columns only) and once for the result, so write it before
    if it is costly. Each selection returns at most tiles - 1 rows per order.
    """
    number = lambda c: F.coalesce(c.cast(NUMBER), F.lit(LAST).cast(NUMBER))
    names = list(orders)
    n = df.count()
    if not n:
        return df.withColumns({name: F.lit(None).cast("int") for name in names})
    ends = [k * (n // tiles) + min(k, n % tiles) for k in range(1, tiles)]
    ranks = {e - 1: k for k, e in enumerate(ends) if e}
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("g"), number(a).alias("x"), number(b).alias("tie")) for i, (a, b) in enumerate(orders.values())]))
    rows = df.select(pairs.alias("p")).select("p.*")
    cuts = rank_values(rows.select("g", "x"), {i: ranks for i in range(len(names))}, {i: n for i in range(len(names))}) if ranks else {}
    # Cuts inside a run of equal values: the tie-break's value at the rank within the run.
    split = {key: (x, key[1] - before, c) for key, (x, before, c) in cuts.items() if key[1] - before < c - 1}
    ties = {}
    if split:
        ids = {key: i for i, key in enumerate(split)}
        runs = [F.when((F.col("g") == g) & (F.col("x") == F.lit(x)), F.lit(ids[g, r])) for (g, r), (x, _, _) in split.items()]
        tied = rows.select(F.explode(F.array_compact(F.array(*runs))).alias("g"), F.col("tie").alias("x"))
        got = rank_values(tied, {ids[key]: {r: 0} for key, (_, r, _) in split.items()}, {ids[key]: c for key, (_, _, c) in split.items()})
        ties = {key: got[ids[key], r][0] for key, (_, r, _) in split.items()}
    out = {}
    for i, (name, (a, b)) in enumerate(orders.items()):
        tile = F.lit(1 + sum(e == 0 for e in ends))
        for rank in ranks:
            x = F.lit(cuts[i, rank][0])
            after = number(a) > x
            if (i, rank) in ties:
                after = after | ((number(a) == x) & (number(b) > F.lit(ties[i, rank])))
            tile = tile + after.cast("int")
        out[name] = tile.cast("int")
    return df.withColumns(out)
