"""A Bloom filter in pages of bits, built and probed with DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflog.session import materialize

PAGE_BITS = 32768  # bits that bitmap_construct_agg holds
BITS_PER_KEY = 16
MAX_BITS = 1 << 30  # 128 MB, the largest filter ever sent to tasks
HASHES = 2


def filter_size(keys: int, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS) -> int:
    n = PAGE_BITS
    while n < min(keys * bits_per_key, max_bits):
        n *= 2
    return n


def bit(key: str, seed: int, n_bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(n_bits))


def pages_of(bits: DataFrame, label: str) -> DataFrame:
    """Pages for a column ``bit`` of bit numbers, written once: page, bits."""
    paged = bits.groupBy(F.expr(f"bit div {PAGE_BITS}").alias("page"))
    return materialize(paged.agg(F.expr(f"bitmap_construct_agg(bit % {PAGE_BITS})").alias("bits")), label)


def bits_of(rows: DataFrame, key: str, n_bits: int) -> DataFrame:
    return rows.select(F.explode(F.array(*[bit(key, seed, n_bits) for seed in range(HASHES)])).alias("bit"))


def probe(rows: DataFrame, pages: DataFrame, key: str, n_bits: int, found: str) -> DataFrame:
    """``rows`` with a boolean ``found``: false if ``key`` was surely not put into the filter.

    The pages are at most ``MAX_BITS`` in all, so they are sent to the tasks.
    """
    hit = F.lit(True)
    for seed in range(HASHES):
        page, bits = f"_page{seed}", f"_bits{seed}"
        side = F.broadcast(pages.select(F.col("page").alias(page), F.col("bits").alias(bits)))
        place = F.pmod(bit(key, seed, n_bits), F.lit(PAGE_BITS))
        rows = rows.join(side, F.floor(bit(key, seed, n_bits) / PAGE_BITS) == F.col(page), "left")
        byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = hit & F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
        rows = rows.withColumn(f"_set{seed}", hit).drop(page, bits)
        hit = F.col(f"_set{seed}")
    return rows.withColumn(found, hit).drop(*[f"_set{seed}" for seed in range(HASHES)])


def known_keys(keys: DataFrame, key: str, label: str) -> tuple[DataFrame, int]:
    """Filter over all values of ``key``: pages and their number of bits."""
    n_bits = filter_size(keys.count())
    return pages_of(bits_of(keys, key, n_bits), label), n_bits
