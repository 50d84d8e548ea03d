"""Search where ids repeat."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from salvor.llm import search


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    pick = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in pick.integers(-8, 8, 4)]) for i in np.concatenate([np.arange(60) % 23, [5, 5, 5]])]
    rows[-1] = rows[-2]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows, k in ((16, 5), (1000, 5), (16, 100)):
        got = search.search(frame, F.col("vec_id") % 5 == 0, scale=1.0, k=k, shard_rows=shard_rows, block_queries=4, leaf_rows=4, each_row=True)
        want = Counter()
        for i, (query, a) in enumerate(rows):
            if query % 5 == 0:
                others = sorted((-int(np.dot(a, b)), v) for j, (v, b) in enumerate(rows) if j != i)
                want.update((query, n, v, -s) for n, (s, v) in enumerate(others[:k], 1))
        assert Counter(tuple(r) for r in got.collect()) == want


def test_the_query_keeps_each_row(spark, tmp_path):
    frame = spark.createDataFrame([(20, [1.0]), (20, [2.0]), (3, [0.5])], "vec_id long, embedding array<double>")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = Counter(tuple(r) for r in search.query(spark, str(tmp_path)).collect())
    assert got == Counter([(20, 1, 20, 8192), (20, 2, 3, 2048), (20, 1, 20, 8192), (20, 2, 3, 4096)])
