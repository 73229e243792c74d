"""The corpus pipeline: five stages over `documents`, each one of the training-data operators at work.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents. Written tables between
the stages cut the lineage.

1. toxicity: documents that the CRF scores 0.5 or more go.
2. simhash_near_dedup: of each group of near copies (five-word shingles, resemblance 0.8 or more) the document of
   the smallest id stays. Candidates come from 512-bit fingerprints, through an index that meets 99 % of the pairs
   of exactly 0.8 and more of closer ones; pairs are linked if their shingle sets do have that resemblance.
3. decontamination: benchmark passages are cut out; documents that are mostly benchmark go.
4. mixing: documents are taken as often as the mix to target weights takes them.
5. sharding: every row gets its shard and its slot there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import materialize, table
from tessera.llm.decontamination import decontaminate
from tessera.llm.mixing import mix_documents
from tessera.llm.sharding import shard_records
from tessera.llm.simhash import keep_one
from tessera.llm.toxicity import keep_clean

SHARDS = 40
NEAR = {"size": 5, "words64": 8, "resemblance": 0.8, "recall": 0.99}


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, **NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), least_words=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_records(docs, "doc_id", [1.0] * SHARDS)


STAGES = [("toxicity", toxicity), ("simhash_near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: The stages are not SQL's: a trained tagger, similarity components, an automaton, a flow and a seeded choice.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
