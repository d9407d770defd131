import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

WORDS = ("ash birch cedar dogwood elm fir ginkgo hazel ironwood juniper kapok larch maple neem oak pine "
         "quince rowan spruce teak ulmo viburnum willow yew zelkova").split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "y", "ing", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with more columns, two of them named like internal ones."""
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
        T.StructField("g", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("h", T.LongType()),
        T.StructField("_id", T.LongType()), T.StructField("_hash", T.StringType()), T.StructField("an odd.name", T.StringType())])

    def make(pairs, langs=None, parts=3):
        rows = [(i, t, langs[k] if langs else "en", "src0", len(t) if t is not None else None, "k", 7, 0.5, 1, 9, "z", "o")
                for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
