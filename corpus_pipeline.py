"""A training-corpus pipeline: five operators of ``playlake.llm``, each on what the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is stored before the next one reads it.  All stages but the last return the columns
of ``documents``:

1. language_id: documents in none of the learned languages go;
2. exact_dedup: of texts equal but for white space one stays;
3. simhash_dedup: of documents linked by SimHash (3-word shingles, at most 2 bits) one stays;
4. substring_dedup: words of 20-word windows that also start earlier are cut; a document that loses
   words keeps the others joined by one space, one that loses all of its words goes, all
   others keep their text as it is;
5. packing: documents become sequences of at most 2048 tokens.

Null and empty texts hold no letter and go in stage 1.  Rows are told apart by themselves, not by doc_id: repeated
rows are copies of each other, of which stage 2 keeps one; rows of a repeated or null doc_id with texts of their
own all stay.  Ties: of copies the longest text, then the smallest doc_id (nulls last) stays; of SimHash
groups the smallest doc_id, then the smallest hash of the text; of equal windows the first in the order of doc_id and place.
Very long texts go through whole.  An empty table gives no rows in every stage.  ``run`` reads the columns of
``documents`` and no others; its last stage returns the columns of ``packing.pack_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm import hash_index, langid, packing, simhash, substring_dedup
from playlake.llm.common import DOCUMENT_COLUMNS, materialize, table
from playlake.llm.tokens import default_tokenizer


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hash_index.drop_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle_words=3, max_bits=2)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeated_windows(docs, min_words=20, carry=docs.columns)
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("carried.text"))
    new = {"text": text, "n_chars": F.when(cut, F.length(text)).otherwise(F.col("carried.n_chars"))}
    return (done.filter(~cut | (F.col("n_removed") < F.col("n_words")))
            .select(*(new.get(c, F.col("carried").getField(c)).cast(docs.schema[c].dataType).alias(c)
                      for c in docs.columns)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, default_tokenizer(), size=2048, end_id=0)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("best_fit_packing", best_fit_packing),
]

#: language scores, SimHash and token ids have no SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
