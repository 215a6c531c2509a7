"""From raw documents to token shards, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflog.llm import decontaminate, mixing, near, quality, queries, tokens
from shelflog.llm.common import fresh, read_table
from shelflog.session import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the query's threshold."""
    score = fresh(docs.columns, "score")
    model = queries.quality_model(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, name=score).where(F.col(score) >= queries.QUALITY_LEAST).drop(score)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the least doc_id."""
    return near.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    match = fresh(docs.columns, "match")
    found = decontaminate.find_benchmark(docs, read_table(spark, sf_dir, "benchmark"), name=match)
    return found.where(F.size(f"{match}.spans") == 0).drop(match)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix of sources asks; each is read once at least."""
    mix = fresh(docs.columns, "mix")
    return mixing.mix_sources(docs, name=mix).drop(mix)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards; the rows are read back from the files."""
    manifest = tokens.write_tokens(docs, tokens.token_path(spark), queries.tokenizer_file())
    return tokens.read_tokens(manifest)


STAGES = [
    ("quality", good_quality),
    ("near_dedup", without_near_copies),
    ("benchmark_decontamination", decontaminated),
    ("source_mix", mixed),
    ("token_output", tokenised),
]

# Encoding by a tokenizer file can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
