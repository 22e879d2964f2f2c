"""Readers for documents, labelled sources, predictions, reports and run metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.labels import five_class
from termloom.operators.scale import number_records

# Quoted CSV with line breaks inside fields; quotes are doubled inside quotes.
CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
# Markers that keep null and the empty string apart in files we write ourselves.
EXACT = {
    "nullValue": "\x00N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

PREDICTIONS = T.StructType(
    [
        T.StructField("row_id", T.LongType(), False),
        T.StructField("group", T.StringType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("predicted_sentiment", T.StringType(), False),
    ]
)
# The columns of the run table and the fields of the validation record.
RUNS = "max_docs long, chunk_size long, workers long, elapsed_seconds double, " \
    "processed_docs long, speedup_vs_first_chunk double"
_ENTRY = "struct<term:string,count:bigint,examples:array<struct<message:string,sentiment_tag:string>>>"
VALIDATION = (
    "term_frequency_validation struct<checked_rows:bigint,unique_terms:bigint,"
    "token_total:bigint,overlap_tokens:bigint,match_ratio:double,"
    "top_terms:array<array<string>>>,"
    "sentiment_validation struct<samples_compared:bigint,accuracy:double,"
    f"classification_report:map<string,string>,confusion_matrix:array<array<bigint>>>"
)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, exact: bool = False
) -> DataFrame:
    """Quoted multi-line CSV. Without a schema all columns are strings by header.

    A multi-line file is read by one task: give many files, or parquet, at scale.
    """
    reader = spark.read.options(**CSV)
    if exact:
        reader = reader.options(**EXACT)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Documents in parquet (default), csv or another format Spark reads."""
    return read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)


def labelled(
    raw: DataFrame,
    category: str,
    source: str,
    mapping: Callable[[Column], Column] | None = five_class,
    text_col: str = "text",
    label_col: str = "label",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep, text, label, category, source_dataset``; without a mapping no label."""
    columns = [*keep, F.col(text_col).cast("string").alias("text")]
    if mapping is not None:
        columns.append(mapping(F.col(label_col).cast("int")).alias("label"))
    constants = [F.lit(category).alias("category"), F.lit(source).alias("source_dataset")]
    return raw.select(*columns, *constants)


def read_labelled(
    spark: SparkSession,
    path: str,
    category: str,
    source: str,
    mapping: Callable[[Column], Column] | None = five_class,
    fmt: str = "csv",
    **columns,
) -> DataFrame:
    """One labelled source; ``mapping=None`` reads it as an unlabelled one."""
    return labelled(read_table(spark, path, fmt), category, source, mapping, **columns)


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Labelled CSV with ``row_id`` from the position in the input: by file, then place."""
    return number_records(read_csv(spark, path))


def read_predictions(
    spark: SparkSession, path: str, fmt: str = "csv", exact: bool = False
) -> DataFrame:
    """Predictions written by ``write_predictions`` or by another tool."""
    if fmt == "csv":
        return read_csv(spark, path, PREDICTIONS, exact)
    return spark.read.schema(PREDICTIONS).format(fmt).load(path)


def read_report(
    spark: SparkSession, path: str, by_group: bool = False, lines: bool = False
) -> DataFrame:
    """Term report JSON as rows ``[group,] sentiment, term, count, examples, rank``.

    The global layout is one object with a list per sentiment, the other layout has
    such an object per group. A report only holds the top terms. A file is one object;
    with ``lines`` every line is one, as ``write_group_report`` leaves them.
    """
    lists = f"map<string,array<{_ENTRY}>>"
    whole = spark.read.text(path, wholetext=not lines)
    if by_group:
        parsed = F.from_json("value", f"map<string,{lists}>")
        groups = whole.select(F.explode(parsed).alias("group", "lists"))
        keys = ["group"]
    else:
        groups = whole.select(F.from_json("value", lists).alias("lists"))
        keys = []
    named = groups.select(*keys, F.explode("lists").alias("name", "entries"))
    listed = named.select(*keys, "name", F.posexplode("entries").alias("pos", "entry"))
    return listed.select(
        *keys,
        F.regexp_extract("name", "^top_(.*)_terms$", 1).alias("sentiment"),
        "entry.term",
        "entry.count",
        "entry.examples",
        (F.col("pos") + 1).cast("long").alias("rank"),
    )


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Rows ``text, sentiment, group`` of one split; partition pruning leaves its folder only."""
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def read_validation(spark: SparkSession, path: str) -> DataFrame:
    """Validation JSON as one row of two structs."""
    return spark.read.option("multiLine", True).schema(VALIDATION).json(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run-metrics CSV with its six columns."""
    return spark.read.schema(RUNS).csv(path, header=True)
