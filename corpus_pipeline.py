"""From raw documents to token ids: five stages over all rows.

Each stage is a function of (spark, docs, sf_dir). Its result is written as
Parquet to the shared folder and read again as the next stage's docs, so a lost
executor never repeats an earlier stage. All stages but the last return the
columns of documents.

1. quality: documents that the quality rules reject go.
2. near duplicates: one document of each group stays.
3. decontamination: documents that cover a benchmark item go.
4. personal data: every span is replaced by the name of its kind.
5. tokens: ids of the whole texts, with the digest of what they decode to.

Every row is judged by its own text, whatever its doc_id: rows that share a doc_id
or have none are copies only if their texts are alike, and are contaminated only
if their own text is.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwright.llm import bpe, decontaminate, minhash, pii, quality
from cartwright.llm.common import packed, read_table, staged, unpacked


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return unpacked(quality.judge(packed(docs)).filter("kept"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, n_tokens, ids, decoded_sha256); ids in decimal, with commas."""
    return bpe.token_rows(docs.select("doc_id", "source", "lang", "text"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", keep_good),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", hide_personal_data),
    ("byte-level BPE", to_tokens),
]

#: expectation-maximisation, MinHash, tiling and BPE are beyond SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result goes through Parquet."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"stage{i + 1}")
    return docs
