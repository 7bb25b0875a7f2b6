"""Row-type labelling on a stream (STM-1).

The analysed workflow has no streaming part: every scan is a bounded read.
What carries over unchanged is the stateless part of the cleaning (trim,
masks) plus the per-code description map, which a stream joins as a static
table (built by the batch ``code_description_map`` over the history). No state
store, watermark or window is needed: each micro-batch is labelled on its own
and written under its batch number (``batch_id=N`` folders), replacing what is
there, so a batch that runs again after a failure leaves the same rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.masks import mask_columns
from ..functions.text import is_noise, normalize_description
from ..operators.joins import sized_broadcast
from ..operators.splits import split_long
from ..session import ensure_checkpoint_dir


def label_lines(raw: DataFrame, code_map: DataFrame) -> DataFrame:
    """Trim, fill and standardize from a fixed code map, then add the masks.

    Works on a batch or a streaming DataFrame (stream-static left join)."""
    d0 = normalize_description("description")
    # the static side is persisted, counted and broadcast only when small
    side = sized_broadcast(code_map.select("stock_code", "fill_description", "canonical_description"))
    joined = raw.withColumn("description", d0).join(side, "stock_code", "left")
    d = F.coalesce(F.col("description"), F.col("fill_description"))
    canon = F.col("canonical_description")
    changed = canon.isNotNull() & (d.isNull() | (d != canon))
    out = joined.select(
        *[c for c in S.RAW_COLUMNS if c != "description"],
        F.when(canon.isNotNull(), canon).otherwise(d).alias("description"),
        (F.col("description").isNull() & F.col("fill_description").isNotNull()).alias("description_filled"),
        is_noise(d).alias("is_noise_description"),
        d.alias("description_original"),
        canon.alias("canonical_description"),
        canon.isNotNull().alias("description_in_standardization_map"),
        F.coalesce(changed, F.lit(False)).alias("description_standardized"),
        F.when(changed & d.isNull(), F.lit(S.REASON_FILLED))
         .when(changed & is_noise(d), F.lit(S.REASON_NOISE))
         .when(changed, F.lit(S.REASON_VARIANT)).alias("description_standardization_reason"))
    return out.select(*S.RAW_COLUMNS, *[c for c in out.columns if c not in S.RAW_COLUMNS]).withColumns(
        mask_columns())


def label_stream(spark: SparkSession, source_path: str, code_map: DataFrame, sink_path: str,
                 checkpoint: str | None = None, available_now: bool = True, max_files: int = 1000):
    """Read raw extracts as they land in ``source_path`` (Parquet, fixed schema),
    label them and write every micro-batch to ``sink_path``/splits
    (partitioned by batch and split) and ``sink_path``/cleaned_retail_all. The
    default checkpoint belongs to this source and sink alone."""
    name = hashlib.sha256(f"{source_path}|{sink_path}".encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/label_stream-{name}"
    stream = (spark.readStream.schema(S.RAW_SCHEMA).option("maxFilesPerTrigger", max_files)
                   .parquet(source_path))
    labelled = label_lines(stream, code_map)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        target = f"{sink_path.rstrip('/')}/{{}}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target.format("cleaned_retail_all"))
        split_long(batch).write.mode("overwrite").partitionBy("split").parquet(target.format("splits"))
        batch.unpersist()

    writer = labelled.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
