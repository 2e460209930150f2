"""A bounded sample of labelled texts for fitting a classifier on the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: int,
    max_bytes: int,
    only: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> tuple[pa.Array, np.ndarray]:
    """Texts and 0/1 labels, at most ``per_class`` rows of either class.

    The rows are those with the smallest hashes of their key, among texts of at
    most ``max_bytes`` bytes. ``only`` is a condition on the key column ``__key``.
    Rows with a null key, text or label teach nothing. The labels' keys are chosen
    first, so the join's labelled side has at most ``4 * per_class`` rows.
    """
    marked = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__y"))
    marked = marked.filter("__key IS NOT NULL AND __y IN (0, 1)").distinct()
    if only is not None:
        marked = marked.filter(only)
    # Twice as many as wanted, since some have no text or too long a one.
    order = [F.xxhash64("__key"), "__key"]
    chosen = None
    for value in (0, 1):
        part = marked.filter(F.col("__y") == value).orderBy(*order).limit(2 * per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    slim = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    fits = slim.filter(F.col("__text").isNotNull() & (F.octet_length("__text") <= max_bytes))
    joined = fits.join(F.broadcast(chosen), "__key").dropDuplicates(["__key", "__y"])
    ranked = joined.withColumn("__place", F.row_number().over(Window.partitionBy("__y").orderBy(*order)))
    rows = ranked.filter(F.col("__place") <= per_class).orderBy("__y", "__place").select("__text", "__y").toArrow()
    texts = pc.cast(rows["__text"].combine_chunks(), pa.large_string())
    return texts, rows["__y"].to_numpy().astype(np.int64)
