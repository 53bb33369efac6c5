"""Risk-factor parsing: one definition for DataFrames and for SQL LATERAL joins, both native."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACTOR_ROWS = "risk_score int, credit_history string, factor_name string, factor_score int, debt_to_income double"

#: Variant expressions over `doc`, the parsed text, and `factor`, one of its factors.
IS_DOCUMENT = "schema_of_variant(doc) LIKE 'OBJECT%'"
IS_OBJECT = "schema_of_variant(factor) LIKE 'OBJECT%'"
LISTED = """CASE WHEN size(try_variant_get(doc, '$.risk_factors', 'array<variant>')) > 0
            THEN try_variant_get(doc, '$.risk_factors', 'array<variant>') ELSE array(CAST(NULL AS VARIANT)) END"""
FIELDS = {
    "risk_score": "try_variant_get(doc, '$.risk_score', 'int')",
    "credit_history": "coalesce(try_variant_get(doc, '$.credit_history', 'string'), 'UNKNOWN')",
    "factor_name": f"""CASE WHEN factor IS NULL OR is_variant_null(factor) THEN 'NONE'
                       WHEN {IS_OBJECT} THEN coalesce(try_variant_get(factor, '$.factor', 'string'), 'UNKNOWN')
                       ELSE try_variant_get(factor, '$', 'string') END""",
    "factor_score": f"CASE WHEN {IS_OBJECT} THEN try_variant_get(factor, '$.score', 'int') END",
    "debt_to_income": "try_variant_get(doc, '$.debt_to_income', 'double')",
}


def parse_risk_factors(df: DataFrame, text: str) -> DataFrame:
    """One row per factor of a JSON column, beside the other columns.

    Null or malformed text, and a document that is no object, give no row. No factors, or a null factor, give a 'NONE'
    row; a factor object without name, or with a null name, is 'UNKNOWN'; a factor that is not an object is its own
    text. A missing or null credit history is 'UNKNOWN'.
    """
    rows = df.withColumn("doc", F.try_parse_json(text)).where(IS_DOCUMENT).withColumn("factor", F.explode(F.expr(LISTED)))
    return rows.select(*[F.col(c) for c in df.columns], *[F.expr(e).alias(n) for n, e in FIELDS.items()])


def register_table_function(spark: SparkSession) -> None:
    """`parse_risk_factors(text)` for SQL LATERAL joins, made of the same expressions."""
    fields = ", ".join(f"{e} AS {n}" for n, e in FIELDS.items())
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION parse_risk_factors(text STRING) RETURNS TABLE({FACTOR_ROWS}) RETURN
            SELECT {fields} FROM (SELECT doc, explode({LISTED}) AS factor
                                  FROM (SELECT try_parse_json(text) AS doc) WHERE {IS_DOCUMENT})"""
    )
