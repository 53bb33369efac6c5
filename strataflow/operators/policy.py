"""Masking, row and output policies as DataFrame rewrites for a user's roles (G)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

# Mask outputs, tag values, retention periods and minimum group size.
MASK_TEXT = "***MASKED***"
MASK_NUMBER = -1
MASK_CREDIT = 0
TAG_VALUES = {
    "data_classification": ("PII", "RESTRICTED", "SENSITIVE", "INTERNAL", "PUBLIC"),
    "data_owner": (
        "PLATFORM_TEAM", "ANALYTICS_TEAM", "COMPLIANCE_TEAM", "SUPPORT_TEAM", "RISK_TEAM", "MARKET_DATA_TEAM",
    ),
    "regulatory_framework": ("GDPR", "CCPA", "PCI_DSS", "SOX", "BSA_AML", "NONE"),
    "retention_policy": ("30_DAYS", "90_DAYS", "1_YEAR", "3_YEARS", "7_YEARS", "INDEFINITE"),
}
RETENTION = {
    "30_DAYS": "30 DAYS", "90_DAYS": "90 DAYS", "1_YEAR": "1 YEAR", "3_YEARS": "3 YEARS", "7_YEARS": "7 YEARS",
}
MIN_GROUP = 5

FULL_ACCESS = frozenset({"ADMIN", "COMPLIANCE_OFFICER", "ACCOUNT_ADMIN"})
MONEY_ACCESS = FULL_ACCESS | {"ANALYST"}


@dataclass(frozen=True)
class SessionContext:
    """Who asks, with which roles; decided when the plan is built, so masks become constants."""

    user: str
    roles: frozenset[str] = frozenset()

    def any_of(self, roles: Iterable[str]) -> bool:
        return bool(self.roles & frozenset(roles))


def mask_text(c: Column) -> Column:
    return F.lit(MASK_TEXT)


def mask_date(c: Column) -> Column:
    """First of January of the year."""
    return F.make_date(F.year(c), F.lit(1), F.lit(1))


def mask_constant(value: float) -> Callable[[Column], Column]:
    return lambda c: F.lit(value)


@dataclass(frozen=True)
class MaskPolicy:
    mask: Callable[[Column], Column]
    visible_to: frozenset[str] = FULL_ACCESS


@dataclass(frozen=True)
class RowPolicy:
    """Rows are limited for users holding one of `mapped_roles`: to keys mapped to the user.

    `full_access` roles see everything; other roles see all rows or none, by `default_allow`.
    """

    column: str
    mapping: DataFrame | None = None
    mapping_user: str = "user"
    mapping_key: str = "key"
    mapped_roles: frozenset[str] = frozenset()
    full_access: frozenset[str] = FULL_ACCESS
    default_allow: bool = False

    def apply(self, df: DataFrame, ctx: SessionContext) -> DataFrame:
        if ctx.any_of(self.full_access):
            return df
        if ctx.any_of(self.mapped_roles) and self.mapping is not None:
            allowed = (
                self.mapping.where(F.col(self.mapping_user) == ctx.user)
                .select(F.col(self.mapping_key).alias(self.column))
                .distinct()
            )
            return df.join(allowed, self.column, "left_semi")
        return df if self.default_allow else df.where(F.lit(False))


def tag_mask(tag: str, dtype: T.DataType) -> Callable[[Column], Column] | None:
    """Mask of a classification tag for a column type; None where the tag leaves it clear."""
    hidden = tag in ("PII", "RESTRICTED")
    partly = tag == "SENSITIVE"
    if not (hidden or partly):
        return None
    if isinstance(dtype, T.StringType):
        return mask_text if hidden else lambda c: F.concat(F.left(c, F.lit(1)), F.lit("***"))
    if isinstance(dtype, T.NumericType):
        return mask_constant(MASK_NUMBER)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return mask_date if hidden else None
    if isinstance(dtype, T.VariantType):
        return lambda c: F.parse_json(F.lit('{"masked": true}'))
    return lambda c: F.lit(None).cast(dtype)  # what has no mask of its own is not shown


@dataclass
class PolicyRegistry:
    """Policies and tags by table and column."""

    masks: dict[tuple[str, str], MaskPolicy] = field(default_factory=dict)
    rows: dict[str, RowPolicy] = field(default_factory=dict)
    tags: dict[tuple[str, str | None, str], str] = field(default_factory=dict)

    def tag(self, name: str, value: str, table: str, column: str | None = None) -> None:
        if name not in TAG_VALUES:
            raise ValueError(f"unknown tag {name!r}")
        if value not in TAG_VALUES[name]:
            raise ValueError(f"{value!r} is not allowed for {name}: {TAG_VALUES[name]}")
        self.tags[(table, column, name)] = value

    def classification(self, table: str, column: str) -> str | None:
        return self.tags.get((table, column, "data_classification"))

    def apply(self, df: DataFrame, table: str, ctx: SessionContext) -> DataFrame:
        """Row policy first (it may need the clear value), then masks; a column policy beats its tag."""
        if table in self.rows:
            df = self.rows[table].apply(df, ctx)
        out = []
        for f in df.schema.fields:
            policy = self.masks.get((table, f.name))
            mask = None
            if policy is not None:
                mask = None if ctx.any_of(policy.visible_to) else policy.mask
            elif not ctx.any_of(FULL_ACCESS):
                tag = self.classification(table, f.name)
                mask = tag_mask(tag, f.dataType) if tag else None
            c = F.col(f.name)
            out.append(mask(c).cast(f.dataType).alias(f.name) if mask else c)
        return df.select(*out)

    def as_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(t, c, "MASK", None, None) for t, c in self.masks]
        rows += [(t, r.column, "ROW_ACCESS", None, None) for t, r in self.rows.items()]
        rows += [(t, c, "TAG", n, v) for (t, c, n), v in self.tags.items()]
        return spark.createDataFrame(
            rows, "table_name string, column_name string, kind string, tag_name string, tag_value string"
        )


def columns_frame(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Column listing of the tables."""
    return spark.createDataFrame(
        [(n, f.name, f.dataType.simpleString()) for n, d in tables.items() for f in d.schema.fields],
        "table_name string, column_name string, data_type string",
    )


def coverage(registry: DataFrame, columns: DataFrame) -> DataFrame:
    """Per table: columns, classified and masked columns, row policies, share classified."""
    r = registry.groupBy("table_name", "column_name").agg(
        F.max(
            F.when((F.col("kind") == "TAG") & (F.col("tag_name") == "data_classification"), 1).otherwise(0)
        ).alias("classified"),
        F.max(F.when(F.col("kind") == "MASK", 1).otherwise(0)).alias("masked"),
        F.max(F.when(F.col("kind") == "ROW_ACCESS", 1).otherwise(0)).alias("row_access"),
    )
    c = columns.join(r, ["table_name", "column_name"], "left")
    total = F.count(F.lit(1))
    classified = F.sum(F.coalesce("classified", F.lit(0)))
    return c.groupBy("table_name").agg(
        total.alias("total_columns"),
        classified.alias("classified_columns"),
        F.sum(F.coalesce("masked", F.lit(0))).alias("masked_columns"),
        F.max(F.coalesce("row_access", F.lit(0))).alias("has_row_policy"),
        F.round(classified * 100.0 / total, 1).alias("classified_pct"),
    )


class ProjectionDenied(PermissionError):
    pass


class GuardedFrame:
    """A DataFrame whose guarded columns may filter rows but not appear in the output."""

    def __init__(self, df: DataFrame, guarded: Sequence[str], ctx: SessionContext):
        self._df = df
        self._ctx = ctx
        self._guarded = frozenset() if ctx.any_of(FULL_ACCESS) else frozenset(guarded)

    def where(self, condition: Column | str) -> "GuardedFrame":
        return GuardedFrame(self._df.where(condition), list(self._guarded), self._ctx)

    def select(self, *cols: str) -> DataFrame:
        """Plain column names only, so a guarded column cannot leave inside an expression."""
        if any(not isinstance(c, str) or c not in self._df.columns for c in cols):
            raise ProjectionDenied("select takes names of existing columns")
        denied = [c for c in cols if c in self._guarded]
        if denied:
            raise ProjectionDenied(f"columns not available in output: {denied}")
        return self._df.select(*cols)

    def count_rows(self) -> DataFrame:
        return self._df.agg(F.count(F.lit(1)).alias("n"))


#: Aggregates whose result does not show a single row's values; with `extremes` the least and the greatest too.
SAFE_AGGREGATES = {"count", "count_if", "sum", "avg", "mean", "approx_count_distinct"}
EXTREMES = {"min", "max"}


def aggregate_names(df: DataFrame) -> set[str]:
    """Names of the aggregate functions in the topmost aggregation of an analysed plan."""
    plan = df._jdf.queryExecution().analyzed()
    found: set[str] = set()

    def walk(e):
        if e.nodeName() == "AggregateExpression":
            found.add(e.aggregateFunction().prettyName())
        children = e.children()
        for i in range(children.size()):
            walk(children.apply(i))

    expressions = plan.aggregateExpressions()
    for i in range(expressions.size()):
        walk(expressions.apply(i))
    return found


def guarded_aggregate(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], ctx: SessionContext, min_group: int = MIN_GROUP, extremes: bool = False
) -> DataFrame:
    """Only grouped results of aggregates that hide single rows, and only groups of at least `min_group` rows, unless
    fully trusted. `extremes` admits least and greatest values."""
    if not aggs:
        raise PermissionError("raw rows are not available, give at least one aggregate")
    out = df.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("_group_size"))
    allowed = SAFE_AGGREGATES | (EXTREMES if extremes else set())
    refused = aggregate_names(out) - allowed
    if refused:
        raise PermissionError(f"aggregates not available here: {sorted(refused)}")
    if not ctx.any_of(FULL_ACCESS):
        out = out.where(F.col("_group_size") >= min_group)
    return out.drop("_group_size")


def resolve_roles(edges: DataFrame) -> DataFrame:
    """All (role, inherited) pairs of a grant graph given as (role, inherits).

    One join per level of the hierarchy; only pairs not seen before go on, so grant cycles
    end as well. Each level is written before the next one reads it.
    """
    steps = edges.select(F.col("role").alias("_via"), "inherits").distinct()
    known = stage(edges.select("role", F.col("inherits").alias("inherited")).distinct())
    fresh = known
    while not fresh.isEmpty():
        onward = fresh.join(steps, fresh.inherited == steps._via).select("role", F.col("inherits").alias("inherited"))
        fresh = stage(onward.distinct().join(known, ["role", "inherited"], "left_anti"))
        known = known.unionByName(fresh)
    return known


# Value patterns and name hints of the automatic classification.
PII_PATTERNS = {
    "email": r"^[^@ ]+@[^@ ]+\.[a-z]{2,}$",
    "phone": r"^\+?[0-9]{1,3}-[0-9]{2,4}-[0-9]{3,4}(-[0-9]{3,4})?$",
    "name": r"^[A-Z][a-z]+#[0-9]+$",
    "code": r"^[A-Z]{2}-[0-9]{3}$",
}
NAME_HINTS = {"email": "PII", "phone": "PII", "customer_name": "PII", "date_of_birth": "PII", "annual_income": "RESTRICTED"}


def classify_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per text column the share of values matching each pattern, and the proposed tag.

    One aggregate over the whole table; the result has one row per (column, pattern).
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    aggs = [F.count(c).alias(f"n__{c}") for c in text]
    aggs += [F.count_if(F.col(c).rlike(p)).alias(f"m__{c}__{k}") for c in text for k, p in PII_PATTERNS.items()]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(k).alias("pattern"),
                F.round(F.col(f"m__{c}__{k}") / F.nullif(F.col(f"n__{c}"), F.lit(0)), 4).alias("share"),
                F.lit(NAME_HINTS.get(c)).cast("string").alias("name_hint"),
            )
            for c in text
            for k in PII_PATTERNS
        ]
    )
    found = df.agg(*aggs).select(F.inline(rows))
    by_value = F.when(
        F.col("share") >= threshold, F.when(F.col("pattern") == "code", F.lit("INTERNAL")).otherwise(F.lit("PII"))
    )
    return found.withColumn("proposed", by_value)


def retention_filter(df: DataFrame, column: str, policy: str, as_of: Column, expired: bool = False) -> DataFrame:
    """Rows still inside (or, with expired=True, past) the retention period of a tag value."""
    if policy not in TAG_VALUES["retention_policy"]:
        raise ValueError(f"unknown retention policy {policy!r}")
    if policy == "INDEFINITE":
        return df.where(F.lit(False)) if expired else df
    cutoff = as_of - F.expr(f"INTERVAL {RETENTION[policy]}")
    # A row without a date cannot be shown to be old, so it is kept.
    old = F.coalesce(F.col(column) < cutoff, F.lit(False))
    return df.where(old if expired else ~old)
