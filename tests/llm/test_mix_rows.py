"""The mix where ids are missing or repeat."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from salvor.llm import mixing


@pytest.mark.parametrize("ids", ["missing", "repeated", "unique"])
def test_mix_takes_each_row_by_itself(spark, ids):
    texts = [(i, f"s{i % 3}", " ".join(f"w{i}" for _ in range(1 + i % 5))) for i in range(60)]
    row_id = {"missing": lambda i: None, "repeated": lambda i: i % 7, "unique": lambda i: i}[ids]
    docs = spark.createDataFrame([(row_id(i), s, t) for i, s, t in texts], "doc_id long, source string, text string")
    plan = mixing.mix(docs).collect()
    budget = {r["source"]: int(r["target"]) for r in plan}
    got = mixing.mixed_documents(docs, cell_rows=7).collect()
    words = Counter()
    for r in got:
        words[r["source"]] += len(r["text"].split())
    assert dict(words) == {s: b for s, b in budget.items() if b}
    # A source cuts at most one row: every other copy is whole.
    whole = {t for _, _, t in texts}
    assert all(n <= 1 for n in Counter(r["source"] for r in got if r["text"] not in whole).values())
