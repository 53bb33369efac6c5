"""Base tables of the layered model, projected from the star-schema parquet tables.

Every function returns a lazy DataFrame, so column pruning and filter pushdown reach the
parquet scan through these projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.compat import MONEY, json_get, money

# Status and type names of the model, by source code.
ACCOUNT_STATUS = {"O": "ACTIVE", "P": "INACTIVE", "F": "CLOSED"}
TXN_TYPE = {"N": "DEBIT", "A": "CREDIT", "R": "TRANSFER"}
CHANNELS = ("ONLINE", "BRANCH", "ATM", "MOBILE", "POS")
PRIORITIES = ("LOW", "MEDIUM", "MEDIUM", "HIGH", "CRITICAL")
TEAMS = ("Support Team", "Fraud Team", "Card Services", "Tech Support", "Compliance")
RESOLUTION = {
    "view": "OPEN",
    "click": "IN_PROGRESS",
    "purchase": "RESOLVED",
    "signup": "CLOSED",
    "error": "ESCALATED",
}
REGULATORS = ("OCC", "FDIC", "SEC", "CFPB", "FinCEN", "FRB")
DOC_STATUS = ("ACTIVE", "DRAFT", "UNDER_REVIEW", "ARCHIVED")
REVIEW_CYCLES = ("QUARTERLY", "SEMI_ANNUAL", "ANNUAL")
CLASSIFICATIONS = ("CONFIDENTIAL", "INTERNAL", "PUBLIC")

# Schemas of the parquet tables. Reading with a stated schema needs no job that
# opens files to infer one.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Order that makes transactions of one account a total order (full rows are unique).
TXN_TIE = ("txn_date", "amount", "txn_type", "line_number", "part_id", "supplier_id", "quantity")


def _choose(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _translate(c: str, names: dict[str, str]) -> Column:
    chain = None
    for key, value in names.items():
        chain = F.when(F.col(c) == key, value) if chain is None else chain.when(F.col(c) == key, value)
    return chain


class Tables:
    """Lazy access to the parquet tables below one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")

    def customers(self) -> DataFrame:
        c, n, r = self.raw("customer"), self.raw("nation"), self.raw("region")
        key = F.col("c_custkey")
        email = F.concat(
            F.lower(F.replace("c_name", F.lit("#"), F.lit("."))),
            F.lit("@"),
            F.lower("c_mktsegment"),
            F.lit(".com"),
        )
        return (
            c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(
                key.alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.when(key % 50 == 0, F.lower("c_name")).otherwise(email).alias("email"),
                F.col("r_name").alias("city"),
                F.col("n_name").alias("country"),
                money("c_acctbal").alias("annual_income"),
                F.col("c_mktsegment").alias("employment_status"),
                (F.lit(300) + (key * 37) % 551).cast("int").alias("credit_score"),
                F.date_add(F.lit("1994-01-01").cast("date"), (key % 730).cast("int")).alias("signup_date"),
                F.date_add(F.lit("1950-01-01").cast("date"), (key * 97 % 18250).cast("int")).alias(
                    "date_of_birth"
                ),
            )
        )

    def accounts(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("account_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("account_type"),
            money("o_totalprice").alias("balance"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(500000))
            .otherwise(F.lit(0))
            .cast(MONEY)
            .alias("credit_limit"),
            _translate("o_orderstatus", ACCOUNT_STATUS).alias("status"),
            F.col("o_orderdate").cast("date").alias("opened_date"),
            F.concat(
                F.lit("BR-"), F.lpad((F.col("o_custkey") % 50 + 1).cast("string"), 3, "0")
            ).alias("branch_code"),
        )

    def plain_transactions(self) -> DataFrame:
        """Transactions without merchant and category: no join below."""
        return self.raw("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
            F.col("l_orderkey").alias("account_id"),
            F.col("l_shipdate").alias("txn_date"),
            _translate("l_returnflag", TXN_TYPE).alias("txn_type"),
            money("l_extendedprice").alias("amount"),
            _choose(CHANNELS, F.col("l_linenumber") % 5).alias("channel"),
            ((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.08)).alias("is_flagged"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("part_id"),
            F.col("l_suppkey").alias("supplier_id"),
            money("l_quantity").alias("quantity"),
        )

    def categorised_transactions(self) -> DataFrame:
        """Transactions with the category, one join."""
        p = self.raw("part").select(F.col("p_partkey").alias("part_id"), F.col("p_type").alias("category"))
        return self.plain_transactions().join(p, "part_id")

    def transactions(self) -> DataFrame:
        """Transactions with category and merchant."""
        s = self.raw("supplier").select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("merchant_name")
        )
        return self.categorised_transactions().join(s, "supplier_id")

    def _events(self) -> DataFrame:
        e = self.raw("events")
        return e.withColumn("k", json_get(F.parse_json("props"), "$.k", "int"))

    def risk_assessments(self) -> DataFrame:
        """Assessments whose details are JSON text, as they land."""
        k = F.col("k")

        def factor(name: str, score: Column) -> Column:
            return F.struct(F.lit(name).alias("factor"), score.cast("int").alias("score"))

        factors = (
            F.when(
                F.col("event_type") == "view",
                F.array(factor("payment_history", k), factor("credit_mix", k * 7 % 100)),
            )
            .when(
                F.col("event_type").isin("click", "purchase"),
                F.array(
                    factor("account_age", k),
                    factor("new_accounts", k * 3 % 100),
                    factor("public_records", k * 11 % 100),
                ),
            )
            .when(F.col("event_type") == "signup", F.array().cast("array<struct<factor:string,score:int>>"))
        )
        history = (
            F.when(k < 25, "EXCELLENT").when(k < 50, "GOOD").when(k < 75, "FAIR").otherwise("POOR")
        )
        data = F.struct(
            k.alias("risk_score"),
            history.alias("credit_history"),
            (F.col("value") / 500).alias("debt_to_income"),
            factors.alias("risk_factors"),
            F.when(k % 4 == 0, "ENHANCED").otherwise("STANDARD").alias("assessment_type"),
            F.concat(F.lit("v2.3."), (k % 10).cast("string")).alias("model_version"),
        )
        return self._events().select(
            F.col("event_id").alias("assessment_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("assessed_at"),
            F.to_json(data).alias("risk_data_raw"),
        )

    def market_data(self) -> DataFrame:
        """Price rows whose details are JSON text."""
        k, v = F.col("k"), F.col("value")
        data = F.struct(
            v.alias("open"),
            (v + k).alias("high"),
            (v - k / 2.0).alias("low"),
            (v + (k - 50) / 10.0).alias("close"),
            (k * 1000).cast("long").alias("volume"),
            F.struct(
                k.cast("double").alias("rsi"),
                ((k - 50) / 10.0).alias("macd"),
                v.alias("moving_avg_50"),
            ).alias("indicators"),
        )
        return self._events().select(
            F.col("event_id").alias("market_data_id"),
            F.col("event_type").alias("ticker"),
            F.col("ts").alias("trade_date"),
            F.to_json(data).alias("market_data_raw"),
        )

    def tickets(self) -> DataFrame:
        return self._events().select(
            F.col("event_id").alias("ticket_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("created_at"),
            F.concat(F.col("event_type"), F.lit(" issue")).alias("subject"),
            _choose(PRIORITIES, F.col("k") % 5).alias("priority"),
            _translate("event_type", RESOLUTION).alias("resolution_status"),
            _choose(TEAMS, F.col("user_id") % 5).alias("assigned_to"),
        )

    def ticket_texts(self) -> DataFrame:
        """Free text of support conversations, one row per turn."""
        return self.raw("conversations").select(
            "conv_id", "turn", F.col("role").alias("priority"), F.col("text").alias("body")
        )

    def compliance_documents(self) -> DataFrame:
        i = F.col("doc_id")
        meta = F.struct(
            _choose(REGULATORS, i % 6).alias("regulatory_body"),
            _choose(DOC_STATUS, i % 4).alias("status"),
            F.concat((i % 5 + 1).cast("string"), F.lit(".0")).alias("version"),
            F.date_add(F.lit("2024-01-01").cast("date"), (i % 365).cast("int"))
            .cast("string")
            .alias("effective_date"),
            _choose(REVIEW_CYCLES, i % 3).alias("review_cycle"),
            _choose(CLASSIFICATIONS, F.floor(i / 3) % 3).alias("classification"),
        )
        return self.raw("documents").select(
            "doc_id",
            F.col("source").alias("doc_type"),
            F.col("text").alias("doc_content"),
            "lang",
            F.to_json(meta).alias("metadata_raw"),
            F.date_add(F.lit("2023-01-01").cast("date"), (i % 700).cast("int")).alias("created_at"),
        )
