"""CSV ingestion: text first, then typed, with rejects and load audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Texts that mean null in a file.
NULL_TEXTS = ("", "NULL")


def _parsed(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _text_schema(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def _csv_options(reader):
    # Quotes inside a value are doubled in the files, so the escape is the quote itself.
    return reader.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", False)


def read_csv_text(spark: SparkSession, path: str, schema: StructType | str, stream: bool = False) -> DataFrame:
    """All columns as text, by position; short rows get nulls, surplus fields are ignored.

    Adds when and from which file a row was loaded.
    """
    schema = _parsed(schema)
    reader = spark.readStream if stream else spark.read
    rows = _csv_options(reader.schema(_text_schema(schema))).csv(path)
    cleaned = [F.when(F.col(f.name).isin(*NULL_TEXTS), None).otherwise(F.col(f.name)).alias(f.name) for f in schema.fields]
    return rows.select(
        *cleaned, F.current_timestamp().alias("_loaded_at"), F.col("_metadata.file_path").alias("_source_file")
    )


def typed_or_rejected(text: DataFrame, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the text of rows where a value did not fit its type."""
    schema = _parsed(schema)
    failed = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields
    ]
    marked = text.withColumn("_bad_columns", F.array_compact(F.array(*failed)))
    ok = F.size("_bad_columns") == 0
    extra = [c for c in text.columns if c not in schema.names]
    good = marked.where(ok).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], *extra
    )
    return good, marked.where(~ok)


def load_csv(
    spark: SparkSession, path: str, schema: StructType | str, target: str, rejects: str | None = None, mode: str = "append"
) -> DataFrame:
    """Bulk load into a parquet table; bad rows are skipped and kept as text in `rejects`.

    Reads whatever lies in the folder now, whether it was loaded before or not, so
    mode='overwrite' is a forced reload.
    """
    schema = _parsed(schema)
    good, bad = typed_or_rejected(read_csv_text(spark, path, schema), schema)
    good.write.mode(mode).parquet(target)
    if rejects:
        bad.write.mode(mode).parquet(rejects)
    return spark.read.parquet(target)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Column defaults: added where the column is missing, filled where the value is null."""
    for name, value in defaults.items():
        default = value if not isinstance(value, (str, int, float, bool)) else F.lit(value)
        df = df.withColumn(name, F.coalesce(F.col(name), default) if name in df.columns else default)
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header row, UTF-8, doubled quotes."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("emptyValue", "")
        .csv(path)
    )


def parsed_view(spark: SparkSession, df: DataFrame, text: str, parsed: str, name: str) -> DataFrame:
    """Named view whose JSON text column is also there as VARIANT (null where malformed)."""
    df.withColumn(parsed, F.try_parse_json(text)).createOrReplaceTempView(name)
    return spark.table(name)
