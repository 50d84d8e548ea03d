"""Each operator against brute force, the tokenizers or known labels, and on rows at the edges."""

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salvor.llm import dedup, langid, minhash, mixing, packing, pii, quality, search, tokens, warc
from salvor.llm.common import staged, table

P = pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.001"
CLASHES = "body string, salt int, key long, size int, bands string, _id int, _copy int, cell int"
DOC = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
EXTRA = ("x", 1, 2, 3, "y", 4, 5, 6)
LONG = "palabra muy larga " * 20_000 + "a" * 100_000


def rows_of(texts):
    return [(i, t, "en" if i is None or i % 3 else None, None if i is None or i % 4 == 0 else f"s{i % 3}", None, *EXTRA) for i, t in texts]


EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (4, "one two"), (5, "one  two"), (6, LONG), (7, "12345 !!!"), (None, "one two"), (8, "é́​🙂 \x1c <|endoftext|> <0x41> ▁x")]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(rows_of(EDGES), DOC)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups_at_the_edges(edges, none):
    got = {(r["doc_id"], r["kept"]): (r["keep_id"], r["group_size"], r["text_sha256"]) for r in dedup.exact_groups(edges).collect()}
    digest = lambda t: hashlib.sha256(plain(t).encode()).hexdigest()
    assert got[(1, True)] == (1, 2, digest("")) and got[(2, False)] == (1, 2, digest(""))
    assert got[(3, True)] == (3, 1, digest(" "))
    assert got[(4, True)] == got[(4, False)] == got[(5, False)] == got[(None, False)] == (4, 4, digest("one two"))
    assert dedup.exact_groups(none).count() == 0
    kept = dedup.keep_first(edges)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [1, 3, 4, 6, 7, 8]


def test_hot_text_spreads_over_salts(spark):
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "same text").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = dedup.exact_groups(many, salts=8)
    assert got.filter("kept").count() == 2001
    assert got.filter("keep_id = 0").select("group_size").distinct().collect()[0][0] == 2000


def mix_by_hand(rows, weights=(5.0, 2.0, 1.0)):
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3.0 * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / free for s in order}
        over = {s for s in order if s not in full and target[s] > 3.0 * sizes[s]}
        if not over:
            return sizes, target
        full |= over


def test_mix_targets_and_budgets(docs, texts):
    rows = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()]
    sizes, target = mix_by_hand(rows)
    got = mixing.mix(docs, cell_rows=7).collect()
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(taken[s] == int(t + 1e-9) for s, t in target.items())
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(5), cell_rows=1000).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_mixed_documents_hold_the_words_taken(docs):
    plan = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix(docs).collect()}
    words = {}
    for r in mixing.mixed_documents(docs).collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert {d: w for d, w in words.items() if w} == {d: t for d, (t, _) in plan.items() if t}


def test_mix_at_the_edges(edges, none):
    got = mixing.mix(edges).collect()
    assert len(got) == len(EDGES) and {r["taken"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mix(none).count() == 0
    assert mixing.mixed_documents(edges.filter("doc_id <> 4")).columns == edges.columns


def unigram():
    from tokenizers import Tokenizer, models, normalizers

    made = Tokenizer(models.Unigram(tokens.read_vocabulary(P.path("piece_bpe_32k.model")), unk_id=0, byte_fallback=True))
    made.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return made


def test_token_counts_are_the_tokenizers(docs, texts, edges, none):
    path, exact = P.path("piece_bpe_32k.model"), unigram()
    for r in tokens.token_counts(docs, path).collect():
        assert r["n_tokens"] == len(exact.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
    pick, counter = random.Random(3), tokens.UnitCounter(tokens.read_vocabulary(path))
    for _ in range(1500):
        text = "".join(pick.choice("ab the in▁ \n<0x41></s>é東🙂00") for _ in range(pick.randint(0, 24)))
        assert counter.text(text)[0] == len(exact.encode(text, add_special_tokens=False).ids), text
    got = tokens.token_counts(edges, path).collect()
    assert len(got) == len(EDGES) and {r["n_tokens"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert tokens.token_counts(none, path).count() == 0


def test_viterbi_keeps_the_first_of_equal_scores():
    tie = tokens.UnitCounter([("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("c", -1.0), ("ab", -2.0), ("bc", -2.0), ("▁", -1.0)])
    assert tie.viterbi(" abc") == (3, -4.0)  # the piece that starts first stays: ▁ ab c or ▁ a bc


def test_search_is_exact(spark):
    pick = np.random.default_rng(5)
    vectors = [(int(i), [float(x) for x in v]) for i, v in enumerate(np.round(pick.normal(size=(400, 6)) * 2) / 8)]
    vectors += [(9000, None), (9020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (9040, [float("nan")] * 6), (9060, [float("inf")] * 6), (None, [1.0] * 6), (9080, [1.0, 2.0]), (9081, [3.0, 1.0]), (20, vectors[20][1])]
    frame = spark.createDataFrame([(i, v, 7) for i, v in vectors], "vec_id long, embedding array<float>, v int")
    got = {}
    for r in search.search(frame, F.col("vec_id") % 20 == 0, shard_rows=90, block_queries=6, leaf_rows=8).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    whole = {i: np.floor(64 * np.array(v)) for i, v in vectors[:400]}
    for q in range(0, 400, 20):
        best = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q))[:20]
        assert [got[q][r] for r in range(1, 21)] == [(i, -s) for s, i in best]
    assert got[9080] == {1: (9081, int(64 * 64 * 5))} and set(got) == {*range(0, 400, 20), 9080}
    assert search.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def spans_by_hand(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    fine = (lambda m: True, lambda m: all(int(x) <= 255 for x in m[0].split(".")), lambda m: 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m)), lambda m: 9 <= len(digits(m)) <= 15)
    return [(k, m.start(), m.end()) for k, pattern in enumerate(PATTERNS) for m in re.finditer(pattern, text) if fine[k](m)]


def test_base_spans_are_the_patterns():
    pick = random.Random(1)
    for _ in range(20_000):
        text = "".join(pick.choice("ab@@..1234 -+()%é\n") for _ in range(pick.randint(0, 30)))
        assert pii.base_spans(text) == spans_by_hand(text), text


def test_personal_data(spark, edges, none):
    signs = [f"x ann.{i}b@mail{i % 7}.example.com y 10.0.{i}.7 z +1 ({200 + 7 * i}) 555-{1000 + 13 * i} w 4{i:03d}5555444411 {i}77 end" for i in range(120)]
    known = spark.createDataFrame(list(enumerate(signs)), "doc_id long, text string")
    weights = pii.fit(known)
    clean = "In 1998 some 47774316 copies were sold, 3.5 a day. key=ddc9f86a9e94140273"
    more = ["call (846) 555-1234 now", "write to bob [at] site.example.org today", clean, "at 12:30 and 10-20 or 1,234,567.89"]
    found = [pii.added_spans(t, pii.base_spans(t), weights) for t in more]
    assert [k for k, _, _ in found[0]] == [3] and more[0][found[0][0][1] : found[0][0][2]] == "(846) 555-1234"
    assert [k for k, _, _ in found[1]] == [0]
    assert found[2] == [] and found[3] == []
    for r in pii.find(known, weights).collect():
        base = pii.joined(spans_by_hand(signs[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(r["spans"].split(","))
    got = pii.find(edges, weights).collect()
    assert len(got) == len(EDGES) and all(r["spans"] == "" for r in got)
    assert pii.find(none, pii.fit(none)).count() == 0


def classes_by_hand(texts, least=0.8):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in texts:
        for j in texts:
            if j < i and (sets[i] == sets[j] or sets[i] and sets[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) - 1e-9):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def chain_texts():
    """Copies, chains of small edits, and a family of texts that share much and are not similar."""
    pick, texts = random.Random(9), {}
    for family in range(6):
        words = [f"w{pick.randrange(5000)}" for _ in range(120)]
        for step in range(12):
            for _ in range(2):
                words[pick.randrange(120)] = f"n{pick.randrange(10**6)}"
            texts[len(texts)] = " ".join(words)
    shared = [f"s{i}" for i in range(90)]
    for i in range(60):
        texts[len(texts)] = " ".join(shared + [f"o{i}x{j}" for j in range(40)])
    texts[len(texts)] = texts[3].replace(" ", "\n ")
    return texts


def test_near_duplicates_lose_no_link(spark):
    texts = chain_texts()
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(frame, block=16).collect()}
    assert got == classes_by_hand(texts)


def test_near_duplicates_at_the_edges(edges, none):
    got = {(r["doc_id"], r["class_id"]) for r in minhash.near_duplicates(edges).collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 7), (None, None)} <= got
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.keep_classes(edges).columns == edges.columns


def test_darts_agree_as_often_as_weights_overlap():
    pick, k = np.random.default_rng(2), 4000
    elements = pick.integers(1, 1 << 62, 60).astype(np.uint64)
    one, two = pick.integers(1, 9, 60) / 2.0, pick.integers(1, 9, 60) / 2.0
    ranks = minhash.dart_minhash([elements, elements], [one, two], k)
    assert abs((ranks[0] == ranks[1]).mean() - np.minimum(one, two).sum() / np.maximum(one, two).sum()) < 0.04


def test_quality_on_held_out_rows(spark, edges, none):
    folder = "/root/testdata/sf0.01"
    labels = table(spark, folder, "labels")
    got = quality.qualities(table(spark, folder, "documents"), labels).join(labels, "doc_id").filter("held_out").collect()
    right = [r["predicted"] == r["quality"] for r in got]
    assert sum(right) / len(right) > 0.9
    found = quality.qualities(edges, labels).collect()
    assert len(found) == len(EDGES) and all(0 <= r["score"] <= 1 for r in found)
    assert quality.qualities(none, labels.limit(0)).count() == 0


def test_language_on_held_out_rows(spark, edges, none):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    right = [r["lang"] == r["lang_pred"] for r in got]
    assert sum(right) / len(right) > 0.9
    model = langid.fit(docs)
    found = {r["doc_id"]: r for r in langid.identify(edges, model).collect()}
    assert {i for i in found if found[i]["lang_pred"] == "und"} == {1, 2, 3, 7}
    assert langid.recognised(edges, model, least=0.0).columns == edges.columns
    assert {r["lang_pred"] for r in langid.predictions(edges.filter("lang is null")).collect()} == {"und"}
    assert langid.predictions(none).count() == 0


def test_packing_round_trip(spark, docs, texts, edges, none):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.pack(docs.repartition(3), path, length=256, open_windows=8, keep_ids=True).collect()
    ids, windows = {}, {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        part = np.frombuffer(p["ids"], "<u4")
        assert p["start"] == len(ids.setdefault(p["doc_id"], [])) and len(part) == p["length"] and zlib.crc32(p["ids"]) == p["ids_crc32"]
        ids[p["doc_id"]] += part.tolist()
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert ids == {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    padding = 0
    for parts in windows.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 256
        padding += 0 if at & (at - 1) == 0 else 256 - at
    assert padding < 0.06 * sum(map(len, ids.values()))
    odd = packing.pack(edges.filter("doc_id <> 4"), path).groupBy("doc_id").agg(F.max("doc_tokens").alias("n"), F.sum("length").alias("m")).collect()
    by_id = dict(EDGES)
    assert {r["doc_id"]: r["n"] for r in odd} == {i: len(tokenizer.encode(by_id[i] or "", add_special_tokens=False).ids) + 1 for i in (1, 2, 3, 5, 6, 7, 8)}
    assert all(r["n"] == r["m"] for r in odd)
    assert packing.pack(none, path).count() == 0


PAGE = "page_id long, url string, html string, same string, first_id int"
PAGES = [(3, "http://a", "<p>é</p>", "x", 1), (1, None, None, "x", 1), (2, "http://b\r\nX: y", "", "x", 1), (5, "u", "<p>é</p>", "x", 1), (4, "u", "WARC/1.1\r\n\r\n" * 3, "x", 1), (4, "u", "WARC/1.1\r\n\r\n" * 3, "x", 1), (None, "u", "alone", "x", 1)]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, PAGE)
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect())
    assert got == [(0, 5, "response", None), (1, 0, "response", None), (2, 0, "revisit", 1), (3, 9, "response", None), (4, 36, "response", None), (4, 36, "response", None), (5, 9, "revisit", 3)]
    least = {r["page_id"]: r["record_type"] for r in warc.round_trip(pages, least_bytes=10).collect()}
    assert set(least.values()) == {"response"}
    assert warc.round_trip(pages.limit(0)).count() == 0


def record(name, body):
    digest = warc.sha1_base32(body)
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{name}>\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_finds_all_records_after_damage(packed):
    pick = random.Random(4)
    parts = [record(i, bytes(pick.randrange(256) for _ in range(200))) for i in range(30)]
    parts = [gzip.compress(p) if packed else p for p in parts]
    for damage in ("flip", "cut", "junk"):
        bad = {5, 6, 17} if damage != "junk" else set()
        blocks = list(parts)
        for i in (5, 6, 17):
            middle = len(blocks[i]) // 2
            if damage == "flip":
                blocks[i] = blocks[i][:middle] + bytes([blocks[i][middle] ^ 255]) + blocks[i][middle + 1 :]
            elif damage == "cut":
                blocks[i] = blocks[i][:middle]
            else:
                blocks[i] = b"\x1f\x8b\x08junk WARC/1.1\r\n" + blocks[i]
        data = b"".join(blocks)
        found = list(warc.salvage(data))
        names = [warc._page(f[3]["warc-record-id"]) for f in found if f[0] == "record"]
        assert names == [i for i in range(30) if i not in bad]
        at = 0
        for _, start, size, *_ in found:  # records and gaps cover every byte
            assert start == at
            at += size
        assert at == len(data) and sum(f[0] == "gap" for f in found) == (2 if damage != "junk" else 3)


def test_pipeline_stages_by_hand(spark, docs, texts):
    kept = {i: t for i, t in texts.items()}
    stage = dict(corpus_pipeline.STAGES)
    first = staged(stage["language"](spark, docs, FOLDER), "t1")
    assert {r["doc_id"] for r in first.collect()} == {i for i, t in kept.items() if re.search(r"[^\W\d_]", t or "")}
    second = staged(stage["exact"](spark, first, FOLDER), "t2")
    heads = {}
    for i in sorted(kept):
        heads.setdefault(plain(kept[i]), i)
    assert {r["doc_id"] for r in second.collect()} == set(heads.values())
    third = staged(stage["near"](spark, second, FOLDER), "t3")
    left = {i: kept[i] for i in heads.values()}
    assert {r["doc_id"] for r in third.collect()} == {i for i, c in classes_by_hand(left).items() if i == c}
    fourth = staged(stage["mix"](spark, third, FOLDER), "t4")
    assert fourth.columns == docs.columns
    pieces = stage["pack"](spark, fourth, FOLDER)
    words = packing.WordIds(P.path("word_bpe_49k.json"))
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(words.text(r["text"])) // 4 + 1 for r in fourth.collect())


def test_pipeline_on_an_empty_table(spark, none):
    frame = none
    for _, stage in corpus_pipeline.STAGES:
        frame = staged(stage(spark, frame, FOLDER), "empty")
    assert frame.count() == 0


def test_shared_counts_are_intersections():
    pick = np.random.default_rng(5)
    sets = [np.unique(pick.integers(0, 300, size)).astype(np.uint64) for size in (0, 1, 40, 200, 299)]
    by_hand = [[len(np.intersect1d(a, b)) for b in sets[1:]] for a in sets]
    assert minhash.shared_counts(sets, sets[1:], columns=16).tolist() == by_hand
    assert minhash.shared_counts(sets[:1], sets[:2]).tolist() == [[0, 0]]


def test_weighted_classes_count_repeats(spark):
    words = [f"w{i}" for i in range(60)]
    texts = {1: " ".join(words), 2: " ".join(words[:59] + ["z"]), 3: " ".join(words * 3), 4: " ".join(words * 3 + ["z"])}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")

    def found(weighted):
        return {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(frame, weighted=weighted).collect()}

    assert found(False) == {1: 1, 2: 1, 3: 1, 4: 1}
    assert found(True) == {1: 1, 2: 1, 3: 3, 4: 3}
