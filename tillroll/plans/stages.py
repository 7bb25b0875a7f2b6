"""The stage tables every analysis starts from.

raw lines -> cleaned + flagged (one lazy plan) -> clean product sales.
Each stage is written once per session and folder as a Parquet table in the
shared checkpoint folder (``tillroll.sources.io.materialize``): the reference
hands the same tables from script to script through a database; a stage table
cuts the lineage (a lost executor re-reads files, it does not re-run joins),
and later scans prune columns and push the mask filters down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_descriptions
from ..operators.splits import add_masks
from ..sources import fixtures
from ..sources.io import materialize


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.retail_lines(spark, sf_dir)


def build_cleaned(raw: DataFrame) -> DataFrame:
    """The full flagged table: cleaned descriptions plus the eleven masks."""
    return add_masks(clean_descriptions(raw))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cleaned_retail_all``: written once as a Parquet stage table."""
    return fixtures.stage(spark, ("cleaned", sf_dir.rstrip("/")),
                          lambda: materialize(build_cleaned(raw_lines(spark, sf_dir)), "cleaned_retail_all"))


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``clean_product_sales`` split table (all columns kept)."""
    return cleaned(spark, sf_dir).where(F.col("is_clean_product_sale_candidate"))
