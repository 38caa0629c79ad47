import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) or full rows, spread over a few partitions."""

    def make(rows, extra=()):
        full = [r if len(r) == 5 else (r[0], r[1], "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS).repartition(3)
        for name in extra:
            df = df.withColumn(name, df.doc_id)
        return df

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Empty, null, blank, short, very long, wide and repeated texts, with shared passages and near copies."""
    pick = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(60)]
    texts = [None, "", "   \n\t ", "One", "one", "a b c", "éàü ñ\u00a0 x\u3000 y", "x" * 5000, "same " * 300, "A.b, c'd! 12\r\n\r\nz"]
    base = [pick.choice(words) for _ in range(120)]
    for edit in range(6):
        own = list(base)
        for _ in range(edit):
            own[pick.randrange(len(own))] = f"e{edit}"
        texts.append(" ".join(own))
    texts.append(" ".join(base).upper())
    for _ in range(4):
        own = [pick.choice(words) for _ in range(80)]
        texts.append(" ".join(own[:30] + passage + own[30:]))
    texts += [" ".join(passage), " ".join(passage[:34]), " ".join(passage[:35]), " ".join(pick.choice(words) for _ in range(30_000))]
    texts += [texts[-1], texts[10], texts[10]]
    return texts
