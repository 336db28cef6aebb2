import random

import pytest
from pyspark.sql import functions as F

from flowtally.llm.common import code_on_workers

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
WORDS = ("the and of river stone quick maple under cloud seven paper orange window to in "
         "silent market glass a winter motor yellow is bridge candle").split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def code(spark):
    code_on_workers(spark)


@pytest.fixture()
def docs_of(spark, code):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with
    columns whose names clash with what operators use inside."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else 0) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        for name in ("fp", "score", "bucket", "rank", "size", "sigs", "found", "replaced", "copies",
                     "label", "key", "root", "text_"):
            df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture()
def awkward(docs_of):
    """Nulls, empty, repeated and very long texts, ties, odd characters."""
    return docs_of([
        (1, None), (2, ""), (3, "   \n\t "), (4, prose(1, 40)), (5, prose(1, 40)), (5, prose(1, 40)),
        (6, prose(2, 30_000)), (None, prose(3, 50)), (None, None), (7, "x" * 100_000),
        (8, "naïve — ünï “q” \U0001f600 é ſ K"), (9, "a", None), (10, prose(4, 60), None)])


@pytest.fixture()
def nothing(spark, code):
    return spark.createDataFrame([], SCHEMA)
