"""Documents made ready for training, in stages that each use one operator.

Each stage takes (spark, docs, sf_dir) and returns documents with all their
columns, which are written as Parquet and read again for the next one; the last
writes token ids and returns, per document read back from them, its place.

1. ``toxicity``          documents scored toxic by a model of the labels go
2. ``near_dedup``        one document of each group of near duplicates stays
3. ``decontamination``   documents that hold half of a benchmark item go
4. ``mixing``            sources are repeated or thinned to tempered weights
5. ``token_ids``         ids are written in bit-plane blocks and read back

Documents may have null texts (kept as empty), repeated rows and further
columns.  Columns that the mixing adds for itself go before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterframe.llm import bit_planes, mixing, near_dedup, template_match, toxicity
from meterframe.llm.queries import table, tokenizer_file
from meterframe.session import durable, fresh_path

SIMILAR = 80  # percent of shingles shared
POWER = 0.7  # of a source's rows, as its weight
SEED = 11


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from all labelled documents of the table, also from those that an
    earlier step has taken out."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_duplicates(docs, SIMILAR)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return template_match.without_benchmark(docs, table(spark, sf_dir, "benchmark"), least_words=1)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, mixing.tempered(POWER), seed=SEED).select(*[F.col(f"`{c}`") for c in docs.columns])


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = bit_planes.write(docs, fresh_path(spark, "token-planes"), tokenizer_file())
    return bit_planes.read_back(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

# A trained model decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
