"""Window operators that hold up when one key owns a large share of the rows.

All keys take one path that cuts their ordered rows into blocks, so no task ever has to
hold a whole hot key. Blocks end at quantiles of the order value over all rows, so a block
holds about the same number of rows wherever a key's rows crowd together:

* running sums and sequence numbers: local window per (key, block) plus the totals of the
  earlier blocks of that key;
* row frames and lags: blocks of consecutive sequence numbers, each with a copy of the last
  rows of the block before;
* time-range frames: time blocks, each with a copy of the last rows of the block before;
* sums over time ranges: units much shorter than the range, whole ones by their totals.

Positions in a global order use range partitioning and per-partition counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.compat import epoch_seconds
from ..session import stage

BLOCKS_PER_PARTITION = 2
_POSITION_BITS = 33  # low bits of monotonically_increasing_id() count rows inside a partition


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    ties: str = "row_number",
    rank_col: str | None = None,
) -> DataFrame:
    """First n rows per key; `order` must end in a unique column for ties='row_number'.

    The rank filter lets Spark keep only n rows per key before the shuffle, so a hot key
    sends n rows per map task.
    """
    fn = {"row_number": F.row_number, "rank": F.rank}[ties]
    name = rank_col or "_rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, fn().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def _with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A struct key: joins and grouping treat null parts as equal, as window partitions do."""
    return df.withColumn("_key", F.struct(*[F.col(k) for k in keys]))


def with_blocks(df: DataFrame, by: Column, blocks: int | None = None) -> DataFrame:
    """Adds `_block`: the number of the quantile range of `by` over all rows; rows without a value are in the last one.

    The quantiles are one row of bounded length, from one pass over one column.
    """
    count = blocks or BLOCKS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = by.cast("double")
    edges = None
    if count > 1:
        edges = df.agg(F.percentile_approx(value, [i / count for i in range(1, count)], 1_000).alias("e")).first()["e"]
    if not edges:
        return df.withColumn("_block", F.when(value.isNull(), F.lit(1.0)).otherwise(F.lit(0.0)))
    splits = [-float("inf"), *sorted(set(edges)), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_by", outputCol="_block", handleInvalid="keep")
    numbered = cut.transform(df.withColumn("_by", value)).drop("_by")
    return numbered.withColumn("_block", F.coalesce("_block", F.lit(float(len(splits)))))


def _running_blocks(
    df: DataFrame, order: Sequence[Column], by: Column, sums: dict[str, Column], sequence: str | None, blocks: int | None
) -> DataFrame:
    measures = {name: measure for name, measure in sums.items()}
    if sequence:
        measures[sequence] = F.lit(1).cast("long")
    blocked = with_blocks(df, by, blocks)
    for name, measure in measures.items():
        blocked = blocked.withColumn(f"_m_{name}", measure)
    # Rows are shuffled once: the totals are summed where the rows of a block meet. They take every column (as a hash), so
    # both branches ask for the same exchange and Spark runs it, and all that is below it, a single time.
    met = blocked.repartition("_key", "_block")
    totals = met.groupBy("_key", "_block").agg(
        *[F.sum(f"_m_{name}").alias(f"_t_{name}") for name in measures], F.max(F.xxhash64(*met.columns)).alias("_every")
    )
    totals = totals.where(F.col("_every").isNotNull())
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_key", "_block", *[F.sum(f"_t_{name}").over(earlier).alias(f"_o_{name}") for name in measures]
    )
    local = Window.partitionBy("_key", "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for name in measures:
        met = met.withColumn(f"_l_{name}", F.sum(f"_m_{name}").over(local))
    out = met.join(offsets, ["_key", "_block"])
    for name in measures:
        total = F.coalesce(F.col(f"_o_{name}") + F.col(f"_l_{name}"), F.col(f"_l_{name}"), F.col(f"_o_{name}"))
        out = out.withColumn(name, total)
    temp = [f"_{p}_{name}" for name in measures for p in ("m", "o", "l")]
    return out.drop("_block", *temp)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    by: Column,
    sums: dict[str, Column] | None = None,
    sequence: str | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Running sums (rows up to the current one) and a 1-based sequence number per key.

    `by` is a number that grows with `order` (for example the microseconds of the ordering
    timestamp). A null comes last, so order columns that may be null with `asc_nulls_last`.
    """
    return _running_blocks(_with_key(df, keys), order, by, sums or {}, sequence, blocks).drop("_key")


def row_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    by: Column,
    frames: dict[str, tuple[int, Callable[[Window], Column]]],
    rows_per_block: int = 100_000,
    blocks: int | None = None,
) -> DataFrame:
    """Columns over the current row and the n rows before it, per key.

    `frames` maps a column name to (rows before, function of the ordered window); the
    function must not look further back than that many rows.
    """
    reach = max(n for n, _ in frames.values())
    if reach >= rows_per_block:
        raise ValueError("rows_per_block must exceed the longest frame")
    numbered = _running_blocks(_with_key(df, keys), order, by, {}, "_seq", blocks)
    slot = F.floor((F.col("_seq") - 1) / rows_per_block)
    near_end = (F.col("_seq") - 1) % rows_per_block >= rows_per_block - reach
    copies = F.when(near_end, F.array(slot, slot + 1)).otherwise(F.array(slot))
    framed = numbered.withColumn("_slot", F.explode(copies))
    w = Window.partitionBy("_key", "_slot").orderBy("_seq")
    for name, (_, fn) in frames.items():
        framed = framed.withColumn(name, fn(w))
    own = F.col("_slot") == F.floor((F.col("_seq") - 1) / rows_per_block)
    return framed.where(own).drop("_slot", "_seq", "_key")


def moving_average(value: str, rows: int) -> tuple[int, Callable[[Window], Column]]:
    """Mean of the current and the rows-1 previous values."""
    return rows - 1, lambda w: F.avg(value).over(w.rowsBetween(-(rows - 1), 0))


def lagged(value: str, k: int) -> tuple[int, Callable[[Window], Column]]:
    return k, lambda w: F.lag(value, k).over(w)


def time_range_frames(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seconds: int,
    aggregates: dict[str, Callable[[], Column]],
    block_seconds: int | None = None,
) -> DataFrame:
    """Aggregates over rows of the same key at most `seconds` before the current row.

    Both ends count, as do other rows at the same instant. Time blocks of `block_seconds`
    (default 4 ranges) bound what one task sees of a key; rows in the last `seconds` of a
    block are copied into the next one and dropped after the window.
    """
    width = block_seconds or 4 * seconds
    if width < seconds:
        raise ValueError("a block must be at least one range long")
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    unit = 1_000_000
    own = F.floor(micros / (width * unit))
    reaches_next = F.pmod(micros, F.lit(width * unit)) >= F.lit((width - seconds) * unit)
    copies = F.when(reaches_next, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("_us", micros).withColumn("_own", own).withColumn("_slot", F.explode(copies))
    w = Window.partitionBy(*keys, "_slot").orderBy("_us").rangeBetween(-seconds * unit, 0)
    for name, make in aggregates.items():
        spread = spread.withColumn(name, make().over(w))
    return spread.where(F.col("_slot").eqNullSafe(F.col("_own"))).drop("_us", "_own", "_slot")


def range_totals(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, sums: dict[str, Column], parts: int = 240
) -> DataFrame:
    """Sums over rows of the same key at most `seconds` before the current row, both ends and equal instants included.

    Time is cut into units, `parts` to the range, so a row's range is the end of one unit, `parts` - 1 whole units and the
    beginning of its own, at the same offset. Each row meets only the rows of its own unit and of the unit one range
    earlier (a narrow copy of each row is sent there), and the totals of the units between. A key with any share of the
    rows is spread over its units. Rows without a time are one frame of their key.
    """
    width = seconds * 1_000_000 // parts
    if width * parts != seconds * 1_000_000:
        raise ValueError("parts must divide the range")
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    measured = _with_key(df, keys).withColumns({"_us": micros, **{f"_m_{n}": c for n, c in sums.items()}})
    measured = measured.withColumns({"_unit": F.floor(F.col("_us") / width), "_at": F.pmod("_us", F.lit(width))})
    names = [f"_m_{n}" for n in sums]
    totals = measured.where("_us IS NOT NULL").groupBy("_key", "_unit").agg(*[F.sum(n).alias(n) for n in names])
    # Whole units of the range: a window over unit totals, in blocks of four ranges with a copied edge.
    own = F.floor(F.col("_unit") / (4 * parts))
    near_end = F.pmod("_unit", F.lit(4 * parts)) >= 3 * parts
    spread = totals.withColumn("_block", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))))
    between = Window.partitionBy("_key", "_block").orderBy("_unit").rangeBetween(-(parts - 1), -1)
    whole = spread.withColumns({f"_w_{n}": F.sum(n).over(between) for n in names}).where(F.col("_block") == own)
    whole = whole.select("_key", "_unit", *[f"_w_{n}" for n in names])
    kept = [c for c in measured.columns if c not in ("_key", "_unit", "_at", "_us", *names)]
    now = F.struct(F.lit(True).alias("own"), "_unit", F.struct(*kept).alias("row"))
    row_type = measured.select(F.struct(*kept).alias("row")).schema["row"].dataType
    later = F.struct(F.lit(False).alias("own"), (F.col("_unit") + parts).alias("_unit"), F.lit(None).cast(row_type).alias("row"))
    copies = F.when(F.col("_us").isNotNull(), F.array(now, later)).otherwise(F.array(now))
    met = measured.select("_key", "_at", *names, F.explode(copies).alias("_c"))
    met = met.select("_key", "_at", *names, F.col("_c._unit").alias("_unit"), F.col("_c.own").alias("_own"), F.col("_c.row").alias("_row"))
    order = Window.partitionBy("_key", "_unit").orderBy("_at")
    until, since = order.rangeBetween(Window.unboundedPreceding, 0), order.rangeBetween(0, Window.unboundedFollowing)
    met = met.withColumns(
        {
            **{f"_u_{n}": F.sum(F.when(F.col("_own"), F.col(n))).over(until) for n in names},
            **{f"_s_{n}": F.sum(F.when(~F.col("_own"), F.col(n))).over(since) for n in names},
        }
    ).where("_own")
    out = met.alias("r").join(whole.alias("w"), (F.col("r._key") == F.col("w._key")) & (F.col("r._unit") == F.col("w._unit")), "left")
    results = []
    for n in sums:
        bits = [F.col(f"r._u__m_{n}"), F.col(f"r._s__m_{n}"), F.col(f"w._w__m_{n}")]
        zero = F.lit(0)
        added = F.coalesce(bits[0], zero) + F.coalesce(bits[1], zero) + F.coalesce(bits[2], zero)
        kind = totals.schema[f"_m_{n}"].dataType
        results.append(F.when(F.coalesce(*bits).isNotNull(), added).cast(kind).alias(n))
    return out.select(*[F.col(f"r._row.{c}").alias(c) for c in kept], *results)


def global_position(df: DataFrame, order: Sequence[Column], position: str, total: str | None = None) -> DataFrame:
    """1-based position in a total order over all rows, with no single-task window.

    Range partitioning puts the order across tasks, the row number inside a partition comes
    from the sort, and the counts of earlier partitions (one row per partition) are added.
    """
    marked = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mark", F.monotonically_increasing_id())
    )
    part = F.shiftright("_mark", _POSITION_BITS)
    inside = F.col("_mark").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    counts = marked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: this window is bounded by the number of partitions.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(everything).alias("_total"),
    )
    out = marked.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    out = out.withColumn(position, F.col("_offset") + inside + 1)
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_part", "_offset", "_total", "_mark")


def distributed_ntile(df: DataFrame, tiles: int, order: Sequence[Column], out: str) -> DataFrame:
    """ntile(tiles) over all rows: the first (rows % tiles) tiles get one row more."""
    ranked = global_position(df, order, "_pos", "_rows")
    size = F.floor(F.col("_rows") / tiles)
    extra = F.col("_rows") % tiles
    cut = extra * (size + 1)
    p = F.col("_pos") - 1
    early = F.floor(p / (size + 1)) + 1
    late = extra + F.floor((p - cut) / F.greatest(size, F.lit(1))) + 1
    return ranked.withColumn(out, F.when(p < cut, early).otherwise(late).cast("int")).drop("_pos", "_rows")


def dense_ids(df: DataFrame, order: Sequence[Column], out: str, start: int = 1) -> DataFrame:
    """Gap-free surrogate keys in a stated order."""
    return global_position(df, order, out).withColumn(out, F.col(out) + (start - 1))
