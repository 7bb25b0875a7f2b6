"""Text extracts of the raw lines, with the faults that an export has.

The derived raw lines are written as CSV under the workbook's header names, one
folder per extract, as an export of two sheets would be. A hash of the line
decides which field goes wrong: dates and numbers that don't parse, customer
ids of the wrong form, missing keys, a zero quantity, a rare stock code.
``EXTRACT_SQL`` gives the same rows to DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from .fixtures import retail_lines, stage
from .io import load_table, read_raw, stage_path, write_table

#: Column -> (first two hex digits of the line's hash -> the text that stands there instead; None: nothing).
FAULTS: dict[str, dict[str, str | None]] = {
    "invoice_date": {"00": "not a date", "01": "2011-02-30 10:00:00", "02": None},
    "quantity": {"10": "three", "11": "1;5", "12": None, "40": "0"},
    "price": {"20": "n/a", "21": "EUR 3", "22": None},
    "customer_id": {"30": "123", "31": "ABCDE", "32": "123456"},
    "country": {"50": None},
    "stock_code": {"51": None, "53": "TEST002"},
    "invoice_no": {"52": None},
}
#: Lines up to this date go to the first extract, all others to the second.
FIRST_UNTIL = "1995-01-01"
#: Rows of a file at most: a compressed file is read by one task.
FILE_ROWS = 1_000_000
TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in S.SOURCE_COLUMNS])
CORRUPT = "_corrupt_record"
_TEXT = {"invoice_date": ("date_format(invoice_date, 'yyyy-MM-dd HH:mm:ss')", "strftime(invoice_date, '%Y-%m-%d %H:%M:%S')"),
         "customer_id": ("cast(cast(customer_id AS bigint) AS string)", "CAST(CAST(customer_id AS BIGINT) AS VARCHAR)")}


def _faulty(column: str, text: Column) -> Column:
    for digits, wrong in FAULTS.get(column, {}).items():
        text = F.when(F.col("_h") == digits, F.lit(wrong)).otherwise(text)
    return text


def extract_rows(raw: DataFrame) -> DataFrame:
    """(extract, the raw columns as text)."""
    key = F.concat_ws("|", F.coalesce("invoice_no", F.lit("")), F.coalesce("stock_code", F.lit("")), F.col("quantity").cast("string"))
    marked = raw.withColumn("_h", F.substring(F.md5(key), 1, 2))
    texts = {c: F.expr(_TEXT[c][0]) if c in _TEXT else F.col(c).cast("string") for c in S.RAW_COLUMNS}
    second = F.coalesce(F.col("invoice_date") >= F.lit(FIRST_UNTIL).cast("timestamp_ntz"), F.lit(True))
    return marked.select(second.cast("int").alias("extract"), *[_faulty(c, texts[c]).alias(c) for c in S.RAW_COLUMNS])


def write_extracts(raw: DataFrame, path: str) -> list[str]:
    """Write the two extracts as compressed CSV with a header; their folders."""
    rows = extract_rows(raw)
    folders = [f"{path}/sheet{i}" for i in (0, 1)]
    for i, folder in enumerate(folders):
        (rows.where(F.col("extract") == i).select(*[F.col(c).alias(s) for c, s in zip(S.RAW_COLUMNS, S.SOURCE_COLUMNS)])
         .write.option("header", True).option("quoteAll", True).option("nullValue", "")
         .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip",
                  maxRecordsPerFile=FILE_ROWS).csv(folder))
    return folders


def _folders(spark: SparkSession, sf_dir: str) -> list[str]:
    return stage(spark, ("extracts", sf_dir.rstrip("/")),
                 lambda: write_extracts(retail_lines(spark, sf_dir), stage_path(spark, "extracts")))


def _clean_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(S.SOURCE_COLUMNS, S.RAW_COLUMNS)))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extracts as they are written: every field as text."""
    return _clean_names(read_raw(spark, _folders(spark, sf_dir), TEXT_SCHEMA, "csv"))


def ingested_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 / SNK-1: the extracts read with the declared types and written as the raw table.

    A field that doesn't parse is NULL and ``is_corrupt`` marks its line; all
    columns are parsed here, once, so the mark covers all of them."""
    def make():
        typed = T.StructType([*S.SOURCE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
        rows = read_raw(spark, _folders(spark, sf_dir), typed, "csv", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                        timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
        path = stage_path(spark, "ingested")
        write_table(_clean_names(rows).withColumn("is_corrupt", F.col(CORRUPT).isNotNull()).drop(CORRUPT), path)
        return path
    return load_table(spark, stage(spark, ("ingested", sf_dir.rstrip("/")), make))


def _sql_faulty(column: str) -> str:
    text = _TEXT[column][1] if column in _TEXT else f"CAST({column} AS VARCHAR)"
    cases = "".join(f" WHEN h = '{d}' THEN {'NULL' if w is None else repr(w)}" for d, w in FAULTS.get(column, {}).items())
    return f"CASE{cases} ELSE {text} END AS {column}" if cases else f"{text} AS {column}"


EXTRACT_SQL = f"""
  SELECT CASE WHEN invoice_date < TIMESTAMP '{FIRST_UNTIL}' THEN 0 ELSE 1 END AS extract,
         {', '.join(_sql_faulty(c) for c in S.RAW_COLUMNS)}
  FROM (SELECT *, substr(md5(concat_ws('|', COALESCE(invoice_no, ''), COALESCE(stock_code, ''), CAST(quantity AS VARCHAR))), 1, 2) AS h
        FROM raw) r"""
