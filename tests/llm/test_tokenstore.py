"""Token ids in ORC: ids against the library, starts, pruning by bounds and Bloom filters, stripes, edges."""

import glob
import zlib

import numpy as np
import pyarrow.orc
import pytest
from tokenizers import Tokenizer

from salvor.llm import tokenstore
from salvor.session import scratch

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")
LONG = "palabra muy larga " * 5_000 + "a" * 20_000
EDGES = [(5, "five"), (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (4, "one two"), (4, "other"), (6, LONG), (7, "12345 !!!"), (None, "one two"), (8, "é́​🙂 \x1c <|endoftext|> ▁x"), (-3, "below")]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, 1, 2, 3, "x") for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, part int, at int, first int, ids string")


@pytest.mark.parametrize("piece", [4096, 7])
@pytest.mark.parametrize("parts", [None, 1, 5])
def test_edges(spark, edges, library, piece, parts):
    path = scratch(spark, "t-orc")
    tokenstore.write(edges, path, PATH, piece_ids=piece, parts=parts)
    got = [tuple(r) for r in tokenstore.checksums(spark, path).orderBy("start").collect()]
    order = [i for i, _ in sorted(EDGES, key=lambda r: (r[0] is None, r[0] or 0))]
    assert [g[0] for g in got] == order
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    wanted = sorted((i is None, i or 0, len(library(t)), crc(library(t))) for i, t in EDGES)
    assert sorted((i is None, i or 0, n, c) for i, _, n, c in got) == wanted
    assert tokenstore.rows(spark, path).selectExpr("max(size(ids))").first()[0] <= piece


def test_lookup_gives_whole_documents(spark, edges, library):
    path = scratch(spark, "t-orc")
    tokenstore.write(edges, path, PATH, piece_ids=50)
    found = {r["doc_id"]: r["ids"] for r in tokenstore.lookup(spark, path, [6, 8, 99]).collect()}
    assert found == {6: library(LONG), 8: library(dict(EDGES)[8])}


def test_empty_table(spark, edges):
    path = scratch(spark, "t-orc")
    tokenstore.write(edges.filter("false"), path, PATH)
    assert tokenstore.checksums(spark, path).count() == 0


def scanned(frame):
    """Rows that the scan gave out, after stripes and row groups were passed over."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_bounds_and_bloom_filters_prune_and_stripes_split(spark):
    docs = spark.range(30_000).selectExpr("id * 2 as doc_id", "repeat(concat('word', id, ' '), 20) as text")
    path = scratch(spark, "t-orc")
    tokenstore.write(docs, path, PATH, parts=1, stripe_bytes=20_000)
    (file,) = [f for f in glob.glob(f"{path}/*.orc") if pyarrow.orc.ORCFile(f).nrows]
    assert pyarrow.orc.ORCFile(file).nstripes > 4
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        split = tokenstore.rows(spark, path)
        assert split.rdd.getNumPartitions() > 3 and split.count() == 30_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    read = lambda i: scanned(tokenstore.rows(spark, path).filter(f"doc_id = {i}").select("doc_id"))
    assert 0 < read(40_000) <= 10_000
    assert read(70_001) == 0  # beyond all bounds
    # Odd ids lie inside the bounds of a row group, and only its Bloom filter says that they are absent.
    absent = [read(i) for i in range(20_001, 20_041, 2)]
    assert absent.count(0) >= 15
