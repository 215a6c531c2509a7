"""Exact deduplication behind a two-pass Bloom filter, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflog.llm.bloom import BITS_PER_KEY, MAX_BITS, bits_of, filter_size, pages_of, probe
from shelflog.llm.common import id_and_text
from shelflog.session import materialize

def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise=lambda text: text,
    bits_per_row: int = BITS_PER_KEY,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One decision per row of ``docs``: which row of equal texts stays.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. Texts are hashed once; the hash
    rows are all that moves. The first pass counts the rows on each bit of a Bloom filter
    (two bits a row) and keeps the bits hit at least twice. The second pass probes the
    filter: a row with a bit that only it has set is alone for sure and passes straight
    through, the others are grouped by SHA-256, so a false positive costs a shuffle and
    never changes a result. The filter has a proven bound (``max_bits``); beyond it more
    rows are probed positive, nothing else changes.

    Cases: a null text counts as empty. Of equal texts the row with the largest doc_id stays,
    a null doc_id being the smallest; of rows that agree in doc_id too exactly one stays. An
    empty table gives no rows. Other columns are not read.
    """
    text = normalise(F.coalesce(F.col("text"), F.lit("")))
    hashed = materialize(
        id_and_text(docs, id_col, text_col).select("doc_id", F.sha2(text.cast("binary"), 256).alias("text_sha256")),
        "text-hashes",
    )
    n_bits = filter_size(hashed.count(), bits_per_row, max_bits)
    repeated = bits_of(hashed, "text_sha256", n_bits).groupBy("bit").count().where("count > 1")
    probed = probe(hashed, pages_of(repeated, "bloom-pages"), "text_sha256", n_bits, "maybe")
    maybe = F.col("maybe")
    alone = probed.where(~maybe).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    rows = probed.where(maybe).groupBy("text_sha256", "doc_id").agg(F.count("*").alias("copies"))
    groups = materialize(
        rows.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")),
        "text-groups",
    )
    grouped = (
        rows.join(groups, "text_sha256")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
    return alone.unionByName(grouped)
