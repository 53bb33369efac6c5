"""Exact distinct counts without multiplying rows: sets over a known domain as bits, one unbounded column by a roll-up.

Spark plans several distinct counts by writing each row once per column (`Expand`). Here a column with a bounded domain
becomes a few words of bits that merge by `bit_or`, and one column of any size is counted by grouping twice: by the keys
and the column, then by the keys, with all other measures merged on the way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

WORD = 64
#: A domain may have so many values; they are held by the driver and in the plan.
LARGEST = 4096


@dataclass(frozen=True)
class Domain:
    """A bounded set of texts, numbered. A text's number is looked up in a table whose size keeps all hashes apart."""

    values: tuple[str, ...]
    slots: tuple[str | None, ...]
    places: tuple[int, ...]

    @classmethod
    def of(cls, column: DataFrame) -> Domain:
        """The distinct values of a one-column DataFrame, usually of a small table that the facts are joined with."""
        name = column.columns[0]
        rows = column.distinct().where(F.col(name).isNotNull()).limit(LARGEST + 1).select(name, F.xxhash64(name).alias("h")).collect()
        if len(rows) > LARGEST:
            raise ValueError(f"{name} has more than {LARGEST} values: count it by the roll-up")
        size = max(1, len(rows))
        while len({r.h % size for r in rows}) < len(rows):
            size += 1
        at = {r.h % size: k for k, r in enumerate(rows)}
        values = tuple(r[0] for r in rows)
        return cls(values, tuple(values[at[k]] if k in at else None for k in range(size)), tuple(at.get(k, 0) for k in range(size)))

    @property
    def words(self) -> int:
        return max(1, -(-len(self.values) // WORD))

    def masks(self, c: str) -> list[Column]:
        """Words of bits with the value's bit set, none for null; a value outside the domain is an error."""
        slot = F.pmod(F.xxhash64(c), F.lit(len(self.slots))).cast("int")
        known = F.get(F.array(*[F.lit(v) for v in self.slots]), slot).eqNullSafe(F.col(c))
        place = F.get(F.array(*[F.lit(p) for p in self.places]), slot)
        place = F.when(F.col(c).isNull(), None).when(known, place).otherwise(F.raise_error(F.concat(F.lit(f"{c} outside its domain: "), F.col(c))).cast("int"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place % WORD)
        return [F.when(F.floor(place / WORD) == k, bit).otherwise(F.lit(0).cast("long")) for k in range(self.words)]


def count_distinct(
    df: DataFrame,
    keys: Sequence[str],
    rolled: str,
    sets: dict[str, Domain],
    measures: dict[str, tuple[Column, str]],
) -> DataFrame:
    """Per key: `n_<rolled>`, `n_<set>` for each set column, and the measures; null values are not counted.

    `measures` maps a name to an aggregate of the rows and how parts of it merge (sum, min, max). Two shuffles, the
    first combined by (keys, rolled), so a key with any number of values is never one group.
    """
    merge = {"sum": F.sum, "min": F.min, "max": F.max}
    bits = {f"_{c}_{k}": mask for c, domain in sets.items() for k, mask in enumerate(domain.masks(c))}
    narrow = df.withColumns(bits) if bits else df
    first = narrow.groupBy(*keys, rolled).agg(
        *[F.bit_or(b).alias(b) for b in bits], *[agg.alias(name) for name, (agg, _) in measures.items()]
    )
    return first.groupBy(*keys).agg(
        F.count(rolled).alias(f"n_{rolled}"),
        *[_ones([F.bit_or(f"_{c}_{k}") for k in range(d.words)]).alias(f"n_{c}") for c, d in sets.items()],
        *[merge[how](name).alias(name) for name, (_, how) in measures.items()],
    )


def _ones(words: list[Column]) -> Column:
    """Set bits of all words."""
    return reduce(lambda a, b: a + b, [F.bit_count(w).cast("long") for w in words])


def count_distinct_each(df: DataFrame, keys: Sequence[str], rolled: Sequence[str], sets: dict[str, Domain]) -> DataFrame:
    """Distinct counts of several columns of any size: the different combinations are written once, then each column is
    rolled up from that narrow table. Per key: `n_<column>`."""
    bits = {f"_{c}_{k}": mask for c, domain in sets.items() for k, mask in enumerate(domain.masks(c))}
    combos = stage(df.withColumns(bits).groupBy(*keys, *rolled).agg(*[F.bit_or(b).alias(b) for b in bits]))
    out = None
    for i, c in enumerate(rolled):
        own = bits if i == 0 else {}
        first = combos.groupBy(*keys, c).agg(*[F.bit_or(b).alias(b) for b in own], F.lit(1).alias("_one"))
        counts = first.groupBy(*keys).agg(
            F.count(c).alias(f"n_{c}"), *([_ones([F.bit_or(f"_{s}_{k}") for k in range(d.words)]).alias(f"n_{s}") for s, d in sets.items()] if i == 0 else [])
        )
        if out is None:
            out = counts
        else:
            same = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
            out = out.alias("a").join(counts.alias("b"), same).select("a.*", f"b.n_{c}")
    return out
