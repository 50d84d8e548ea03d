"""Rows that stages keep, the whole pipeline over rows at the edges, batches, settings, and conflicting labels."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salvor.llm import common, dedup, minhash, quality, tokens, warc
from salvor.llm.common import staged

P = pytest.importorskip("public_tokenizers")
A = " ".join(f"alpha{i}" for i in range(40))
B = " ".join(f"beta{i}" for i in range(40))
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, doc string, key int, keep boolean, part int, row int"


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 2}", None, "x", 1, True, 2, 3) for i, t in rows], SHAPE)


def kept(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def test_a_distinct_text_of_a_repeated_id_stays(spark):
    docs = frame_of(spark, [(1, A), (2, A), (2, B)])
    assert kept(minhash.keep_classes(docs)) == [(1, A), (2, B)]
    assert kept(dedup.keep_first(docs)) == [(1, A), (2, B)]


def test_repeated_rows_and_missing_ids(spark):
    near = A + " more"
    docs = frame_of(spark, [(3, A), (3, A), (None, A), (None, B), (None, B), (7, near), (8, None), (9, "")])
    found = minhash.keep_classes(docs)
    assert found.columns == docs.columns
    assert kept(found) == sorted([(3, A), (8, None), (None, B)], key=str)
    assert kept(dedup.keep_first(docs)) == sorted([(3, A), (None, B), (7, near), (8, None)], key=str)
    assert minhash.keep_classes(docs.filter("false")).count() == dedup.keep_first(docs.filter("false")).count() == 0


def test_one_of_a_hot_key_stays(spark):
    docs = spark.range(3000).selectExpr("if(id < 1000, 5, id) as doc_id", "if(id < 1000, 'same', concat('t ', id)) as text")
    assert dedup.keep_first(docs).count() == 2001
    decided = spark.createDataFrame([(5, True), (1500, False)], "key long, keep boolean")
    assert common.thinned(docs, F.col("doc_id"), decided).count() == 2000


def test_the_whole_pipeline_over_rows_at_the_edges(spark):
    long = " ".join(f"der{i % 500} wort{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, A), (4, A), (5, A), (None, A), (None, B), (6, B), (7, long), (8, "12345 !!!"), (9, "é́ mit 🙂 text")]
    frame = frame_of(spark, rows)
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = staged(stage(spark, frame, ""), f"edge-{name}")
        assert frame.columns == columns
    texts = {r["text"] for r in frame.collect()}
    assert any(t == A for t in texts) and not any(not (t or "").strip() for t in texts)
    pieces = corpus_pipeline.STAGES[-1][1](spark, frame, "")
    assert pieces.filter("length > 2048 or offset < 0").count() == 0 and pieces.agg(F.sum("length")).first()[0] > 20_000


def test_batches_are_cut_by_rows_and_bytes():
    texts = ["a" * 10] * 2000 + ["b" * (common.BATCH_BYTES + 5)] + [None, "c"] * 3
    whole = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    cut = list(common.batches(iter([whole])))
    assert [t for _, part in cut for t in part] == [t or "" for t in texts]
    assert [i for b, _ in cut for i in b.column("id").to_pylist()] == list(range(len(texts)))
    assert all(len(part) <= common.BATCH_ROWS for _, part in cut)
    assert all(len(part) == 1 or sum(map(len, part)) <= common.BATCH_BYTES for _, part in cut)
    assert list(common.batches(iter([whole.slice(0, 0)]))) == []


def test_settings_are_as_before(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "10000")
    pages = spark.createDataFrame([(1, "u", "<p>a"), (2, "u", "<p>a"), (3, None, None)], "page_id long, url string, html string")
    assert warc.round_trip(pages).filter("record_type = 'revisit'").count() == 1
    dedup.keep_first(frame_of(spark, [(1, A), (2, B)])).count()
    assert spark.conf.get(key) == "10000"
    tokens.token_counts(frame_of(spark, [(1, A)]), P.path("piece_bpe_32k.model")).count()
    assert spark.conf.get(key) == str(common.BATCH_ROWS)  # from Spark's default
    spark.conf.set(key, "77")
    tokens.token_counts(frame_of(spark, [(1, A)]), P.path("piece_bpe_32k.model")).count()
    assert spark.conf.get(key) == "77"  # one of its own stays
    spark.conf.unset(key)


def test_of_conflicting_labels_the_lesser_counts(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    rows = [(i, q) for i in range(40) for q in ((0, 1) if i % 2 else (1, 1))]
    one = quality.measured_sample(docs, spark.createDataFrame(rows, "doc_id long, quality int"), 100)
    two = quality.measured_sample(docs, spark.createDataFrame(rows[::-1], "doc_id long, quality int").repartition(3), 100)
    assert one[1].tolist() == two[1].tolist() and set(one[1].tolist()) == {0.0, 1.0}
