"""Change capture between snapshots of a table (K2, K5)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that changed, with `_action` (INSERT or DELETE) and `_is_update`.

    An update is a DELETE of the old row and an INSERT of the new one. All columns are
    compared, nulls as equal. One full outer join on the key; unchanged rows end there.
    """
    cols = old.columns
    # Whole rows as structs: a side that is absent is a null struct, whatever its key.
    a = old.select(F.struct(*cols).alias("_old"))
    b = new.select(F.struct(*cols).alias("_new"))
    same = reduce(lambda x, y: x & y, [F.col(f"_old.{k}").eqNullSafe(F.col(f"_new.{k}")) for k in keys])
    both = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), same, "full")
    update = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    changed = both.where(~update.eqNullSafe(True) | ~F.col("_old").eqNullSafe(F.col("_new")))

    def event(action: str, row: str):
        return F.when(
            F.col("_a" if row == "_old" else "_b").isNotNull(),
            F.struct(F.lit(action).alias("_action"), update.alias("_is_update"), F.col(row).alias("_row")),
        )

    events = F.array_compact(F.array(event("DELETE", "_old"), event("INSERT", "_new")))
    out = changed.withColumn("_e", F.explode(events))
    return out.select(*[F.col(f"_e._row.{c}").alias(c) for c in cols], "_e._action", "_e._is_update")


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot after the changes: drop every changed key, add the inserted rows."""
    same = reduce(lambda x, y: x & y, [F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
    kept = old.alias("o").join(changes.select(*keys).distinct().alias("c"), same, "left_anti")
    return kept.unionByName(changes.where(F.col("_action") == "INSERT").select(*old.columns))
