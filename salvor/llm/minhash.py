"""Near-duplicate classes: DartMinHash signatures, a banded join, exact checks, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salvor.llm.common import arrow, batches, by_batches, staged, table, thinned

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5  # a pair at 0.8 shares no band with a chance of 3e-6
COORDINATES = BANDS * ROWS
BLOCK = 1024
SLOTS = 1 << 20

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)
_BASE = _U(0x5851F42D4C957F2D)
_INVERSE = _U(pow(0x5851F42D4C957F2D, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SIGN = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)


def word_shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, str]:
    """(hashes of the distinct shingles, their counts, digest of the text with single spaces).

    A text of fewer words is one shingle; one without words has none. A shingle's hash is that of its
    bytes: differences of a running polynomial sum, so the cost does not depend on its length.
    """
    parts = text.encode("utf-8", "surrogatepass").split()
    stream = b" ".join(parts)
    digest = blake2b(stream, digest_size=16).hexdigest()
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), digest
    signs = np.frombuffer(stream, np.uint8)
    power = np.full(len(signs), _BASE)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    total = np.zeros(len(signs) + 1, np.uint64)
    np.cumsum(_SIGN[signs] * power, dtype=np.uint64, out=total[1:])
    gaps = np.flatnonzero(signs == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(signs)]])
    n = max(1, len(starts) - words + 1)
    starts, ends = starts[:n], ends[-n:]
    # Dividing by the base to the start makes equal shingles equal wherever they stand.
    back = np.full(len(signs), _INVERSE)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)[starts]
    value = mix64((total[ends] - total[starts]) * back + (ends - starts).astype(np.uint64) * _GOLDEN)
    found, counts = np.unique(value, return_counts=True)
    return found, counts.astype(np.uint64), digest


def dart_minhash(elements: list[np.ndarray], weights: list[np.ndarray], k: int) -> np.ndarray:
    """A row of k ranks for each weighted set; two sets agree in a coordinate with the chance of their
    weighted Jaccard similarity.

    An element of weight w owns the region [0, w) x rank. Darts come at unit rate, by rank, from
    hashes of the element and the unit column of its weight alone, so all sets see the same ones; a dart that
    falls above a fractional weight is out. Each dart belongs to one coordinate, which keeps its
    earliest dart. Throwing stops at the rank where about k ln k + 4k darts have hit the set's region; a
    set with an empty coordinate throws on to twice the rank. The rank, a full double, is the identity.
    """
    kept = np.full((len(elements), k), np.inf)
    goal = k * np.log(k) + 4 * k
    mass = np.array([w.sum() for w in weights], float)
    reach = np.divide(goal, mass, out=np.zeros(len(elements)), where=mass > 0)
    todo = np.flatnonzero(mass > 0)
    while len(todo):
        states, owners, limits = [], [], []
        for i in todo:
            columns = np.ceil(weights[i]).astype(np.int64)
            level = np.arange(columns.sum()) - np.repeat(np.cumsum(columns) - columns, columns)
            states.append(mix64(np.repeat(elements[i], columns) + level.astype(np.uint64) * _GOLDEN))
            owners.append(np.full(len(level), i))
            limits.append(np.repeat(weights[i].astype(float), columns) - level)
        state, owner, limit = np.concatenate(states), np.concatenate(owners), np.concatenate(limits)
        rank = np.zeros(len(state))
        while len(state):
            state = mix64(state + _GOLDEN)
            rank = rank - np.log1p(-((state >> _U(11)).astype(float) * 2.0**-53))
            alive = rank < reach[owner]
            state, owner, limit, rank = state[alive], owner[alive], limit[alive], rank[alive]
            hit = mix64(state ^ _BASE)
            place = owner * k + ((hit & _U(0xFFFFFFFF)) % _U(k)).astype(np.int64)
            inside = (hit >> _U(32)).astype(float) * 2.0**-32 < limit
            np.minimum.at(kept.reshape(-1), place[inside], rank[inside])
        todo = todo[np.isinf(kept[todo]).any(axis=1)]
        reach[todo] *= 2
    return kept


def signatures(docs: DataFrame, *, words: int, bands: int, rows: int, weighted: bool) -> DataFrame:
    """doc_id, copy (digest of the words), bands (bucket of each band), sig (16 bits a coordinate), size (weight of the set)."""
    k = bands * rows
    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.string()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary()), ("size", pa.float64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(source):
            ids = batch.column("doc_id").to_pylist()
            for at in range(0, len(texts), 64):
                found = [word_shingles(t, words) for t in texts[at : at + 64]]
                sizes = [c if weighted else np.ones_like(c) for _, c, _ in found]
                bits = mix64(dart_minhash([e for e, _, _ in found], sizes, k).view(np.uint64))
                bucket = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _GOLDEN, len(found), axis=0)
                for r in range(rows):
                    bucket = mix64(bucket * _BASE + bits[:, r::rows])
                sig = (bits >> _U(48)).astype("<u2")
                some = [len(e) > 0 for e, _, _ in found]
                buckets = [b if s else [] for b, s in zip(bucket.view(np.int64).tolist(), some)]
                yield arrow(schema, [ids[at : at + 64], [d for _, _, d in found], buckets, [s.tobytes() for s in sig], [float(c.sum()) for c in sizes]])

    return by_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), run, "doc_id long, copy string, bands array<long>, sig binary, size double")


def _agreeing(k: int, similarity: float) -> float:
    """Coordinates that a pair at the threshold shares at least, 4 standard deviations below the mean:
    a pair exactly there is lost with a chance of 3e-5, one at 0.85 with less than 1e-9."""
    return k * similarity - 4.0 * np.sqrt(k * similarity * (1 - similarity))


def close_by_signature(pairs: DataFrame, reps: DataFrame, k: int, similarity: float) -> DataFrame:
    """Pairs (a, b) whose signatures agree in enough coordinates for the threshold."""
    least = _agreeing(k, similarity)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, k) for c in ("sig_a", "sig_b"))
            good = np.flatnonzero((one == two).sum(axis=1) >= least)
            yield arrow(schema, [batch.column(c).to_numpy(zero_copy_only=False)[good] for c in ("a", "b")])

    side = lambda n: reps.select(F.col("rep").alias(n), F.col("sig").alias(f"sig_{n}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def exact_sets(docs: DataFrame, nodes: DataFrame, *, words: int, weighted: bool) -> DataFrame:
    """node, elements (its shingles as 8-byte hashes; with ``weighted``, one for each time a shingle occurs) of the
    documents in ``nodes``.

    Only their texts are shingled again, and no text is shuffled: ids fall into SLOTS hash slots,
    and the slots in use (SLOTS rows at most, so the broadcast is bounded) pick the rows. The few
    other rows that share a slot meet no node.
    """
    slot = lambda c: F.pmod(F.xxhash64(F.col(c).cast("bigint")), F.lit(SLOTS))
    slots = nodes.select(slot("node").alias("slot")).distinct()
    picked = docs.select("doc_id", "text").withColumn("slot", slot("doc_id")).join(F.broadcast(slots), "slot", "left_semi")
    schema = pa.schema([("node", pa.int64()), ("elements", pa.binary())])

    def sets(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(source):
            found = []
            for elements, counts, _ in (word_shingles(t, words) for t in texts):
                if weighted:
                    level = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts.astype(np.int64))
                    elements = mix64(np.repeat(elements, counts.astype(np.int64)) + level.astype(np.uint64) * _GOLDEN)
                found.append(elements.tobytes())
            yield arrow(schema, [batch.column("doc_id").to_pylist(), found])

    shingled = by_batches(picked.selectExpr("cast(doc_id as bigint) doc_id", "text"), sets, "node long, elements binary")
    return staged(shingled, "shingles")


def check_pairs(docs: DataFrame, pairs: DataFrame, *, words: int, similarity: float, weighted: bool) -> DataFrame:
    """The pairs whose exact similarity reaches the threshold."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    shingled = exact_sets(docs, nodes, words=words, weighted=weighted)

    def compare(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in source:
            rows = []
            for a, b, ea, eb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "elements_a", "elements_b"))):
                one, two = np.frombuffer(ea, np.uint64), np.frombuffer(eb, np.uint64)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                if shared >= similarity * (len(one) + len(two) - shared) - 1e-9:
                    rows.append((a, b))
            yield arrow(links, list(zip(*rows)) or [[], []])

    side = lambda n: shingled.select(F.col("node").alias(n), F.col("elements").alias(f"elements_{n}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of an edge, by alternating large and
    small stars. Minima are added up map-side, so a hub is one row for each task."""
    current = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = current.union(current.select("v", "u"))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        current = staged(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")


def by_block(work, names: Sequence[str], schema: pa.Schema):
    """A mapInArrow function: ``work`` on the rows of each (bucket, i, j), which stand together."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in source:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if group and group[0][:3] != row[:3]:
                    out += work(group)
                    group = []
                group.append(row)
            yield arrow(schema, list(zip(*out)) or [[] for _ in schema])
        if group:
            yield arrow(schema, list(zip(*work(group))) or [[] for _ in schema])

    return run


def sides(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """The rows of block i and those of block j, by column ``own``."""
    i, j = rows[0][1:3]
    left = [r for r in rows if r[3] == i]
    return left, left if i == j else [r for r in rows if r[3] == j]


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of each set of ``left`` with each of ``right``: a product of 0-1 matrices over the
    elements that both sides have, ``columns`` of them at a time."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        value, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(both, value), len(both) - 1)
        known = both[at] == value
        at, owner = at[known], owner[known]
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    total = np.zeros((len(left), len(right)))
    if not len(both):
        return total
    (at_l, own_l), (at_r, own_r) = placed(left), placed(right)
    for start in range(0, len(both), columns):
        parts = []
        for at, own, n in ((at_l, own_l, len(left)), (at_r, own_r, len(right))):
            lo, hi = np.searchsorted(at, [start, start + columns])
            part = np.zeros((n, min(columns, len(both) - start)), np.float32)
            part[own[lo:hi], at[lo:hi] - start] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T  # whole numbers up to ``columns``: exact
    return total


def crossing_links(docs: DataFrame, members: DataFrame, reps: DataFrame, k: int, *, words: int, similarity: float, weighted: bool, block: int) -> DataFrame:
    """Links between different classes that meet in a bucket: enough of them to join all the classes that any
    exactly similar pair of a bucket joins.

    members: bucket, rep, class, size. A bucket is cut into blocks of about ``block`` rows and ``block`` * 4096 shingles at most
    by hash, and each pair of blocks is one group of a task. First, signatures are compared as matrices, and the rows
    with a close partner of another class go on, each pair in the first bucket that it shares. Then their
    sets are compared exactly, also as matrices, and one link for each two classes that a block joins comes out. No
    pair is a row, so the rows grow with the members and not with their pairs.
    """
    least = _agreeing(k, similarity)
    weight = F.ceil(F.greatest(F.count("*") / block, F.sum("size") / (block * 4096))).cast("int")
    sized = members.join(members.groupBy("bucket").agg(weight.alias("blocks")), "bucket")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    grid = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")))
    placed = sized.withColumn("own", own).withColumn("cell", F.explode(grid)).select("bucket", "cell.i", "cell.j", "own", "rep", "class", "size")

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def close(rows: list[tuple]) -> list[tuple]:
        left, right = sides(rows)
        if not left or not right:
            return []
        sig = lambda part: np.frombuffer(b"".join(r[6] for r in part), "<u2").reshape(-1, k)
        kind, other, theirs = sig(right), np.array([r[5] for r in right]), np.array([r[7] for r in right])
        sizes, wanted = np.array([r[8] for r in right]), set()
        for row, mine in zip(left, sig(left)):
            # Sets whose sizes differ by more than the threshold cannot be similar.
            fits = np.minimum(sizes, row[8]) >= similarity * np.maximum(sizes, row[8]) - 1e-9
            agree = np.flatnonzero(((kind == mine).sum(axis=1) >= least) & (other != row[5]) & fits)
            if len(agree):
                own_bands = np.array(row[7])
                agree = agree[own_bands[(theirs[agree] == own_bands).argmax(axis=1)] == row[0]]
            if len(agree):
                wanted |= {row[:6], *(right[at][:6] for at in agree)}
        return list(wanted)

    def link(rows: list[tuple]) -> list[tuple]:
        left, right = sides(rows)
        if not left or not right:
            return []
        one, two = ([np.frombuffer(r[6], np.uint64) for r in part] for part in (left, right))
        shared = shared_counts(one, two)
        total = np.array([len(x) for x in one])[:, None] + np.array([len(x) for x in two])[None, :]
        linked = shared >= similarity * (total - shared) - 1e-9
        # Classes joined so far carry the same label.
        names, label = np.unique([r[5] for part in (left, right) for r in part], return_inverse=True)
        root, found = np.arange(len(names)), []
        for at, row in enumerate(left):
            partners = np.flatnonzero(linked[at])
            while len(partners := partners[root[label[len(left) + partners]] != root[label[at]]]):
                found.append((row[4], right[partners[0]][4]))
                root[root == root[label[len(left) + partners[0]]]] = root[label[at]]
        return [(min(p), max(p)) for p in found]

    cells, types = ["bucket", "i", "j", "own", "rep", "class"], [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    signed = together(placed.join(reps.select("rep", "sig", "bands"), "rep").select(*cells, "sig", "bands", "size"))
    near = by_block(close, [*cells, "sig", "bands", "size"], pa.schema(list(zip(cells, types))))
    kept = staged(signed.mapInArrow(near, "bucket long, i int, j int, own int, rep long, class long"), "crossing")
    sets = exact_sets(docs, kept.select(F.col("rep").alias("node")), words=words, weighted=weighted)
    whole = together(kept.join(sets, kept["rep"] == sets["node"]).select(*cells, "elements"))
    exact = by_block(link, [*cells, "elements"], pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    return whole.mapInArrow(exact, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, words: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, weighted: bool = False, block: int = BLOCK) -> DataFrame:
    """doc_id, copy_of, class_id: classes of texts linked by a similarity of their shingle sets of at least
    ``similarity`` (with ``weighted``, shingles count as often as they occur).

    1. Texts with equal words are one node, that of the smallest id (copy_of).
    2. In each bucket of each band, every member is paired with one leader. The partner that a member shares
       most bands with is checked, by signature and then exactly, and links become classes.
    3. Other pairs matter only between classes: all pairs of different classes in a bucket are compared in
       blocks, as matrices, by signature and then exactly, so every pair that shares a bucket is in one
       class or not similar.

    Null text is the empty text. Texts without words are copies of each other and similar to no other; of one to four words,
    the text is its only shingle. Rows of one id are one document, and a missing id has no class. An empty
    table gives no rows. class_id is the smallest id of the class.
    """
    k = bands * rows
    options = {"words": words, "similarity": similarity, "weighted": weighted}
    # Executors hold a few hundred signatures or sets at a time.
    signed = staged(signatures(docs, words=words, bands=bands, rows=rows, weighted=weighted), "signatures")
    copies = signed.groupBy("copy").agg(F.min("doc_id").alias("rep"))
    nodes = staged(signed.join(copies.filter("rep is not null"), (signed["copy"] == copies["copy"]) & (signed["doc_id"] == copies["rep"])).select("rep", "bands", "sig", "size").dropDuplicates(["rep"]), "nodes")
    members = nodes.select("rep", "size", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = staged(members.join(sizes, "bucket"), "shared")  # buckets of two or more
    # The member that meets most others over all its buckets leads: in a family of copies of one text, that text.
    meets = shared.groupBy("rep").agg(F.sum("n").alias("met"))
    leaders = shared.join(meets, "rep").groupBy("bucket").agg(F.max(F.struct("met", (-F.col("rep")).alias("low"))).alias("first"))
    led = shared.join(leaders.select("bucket", (-F.col("first.low")).alias("leader")), "bucket").filter("leader <> rep")
    stars = led.groupBy(F.col("leader").alias("a"), F.col("rep").alias("b")).agg(F.count("*").alias("bands"))
    nearest = Window.partitionBy("b").orderBy(F.col("bands").desc(), "a")  # a row for each band at most
    first = stars.withColumn("place", F.row_number().over(nearest)).filter("place = 1").select("a", "b")
    close = staged(close_by_signature(first, nodes, k, similarity), "close")
    links = staged(check_pairs(docs, close, **options), "links")
    classes = components(links)
    root = classes.select(F.col("node").alias("rep"), "root")
    inside = shared.select("bucket", "rep", "size").join(root, "rep", "left").select("bucket", "rep", "size", F.coalesce("root", "rep").alias("class"))
    mixed = inside.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo < hi").select("bucket")
    links = links.union(crossing_links(docs, inside.join(mixed, "bucket"), nodes, k, block=block, **options))
    classes = components(links)
    of_copy = signed.select("doc_id", "copy").join(copies, "copy").select("doc_id", F.col("rep").alias("copy_of"))
    roots = classes.select(F.col("node").alias("copy_of"), "root")
    found = of_copy.join(roots, "copy_of", "left")
    return found.select("doc_id", "copy_of", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "copy_of")).alias("class_id"))


def keep_classes(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, all columns as they are: the row of the smallest id, missing ids last, equal ones by text.

    Classes are found over rows, not ids: a row is named by a 64-bit hash of its id and text, so rows of one id with
    different texts are documents of their own (two rows share a name with a chance of 2^-64). Of rows equal in
    both one stays. Only rows that repeat or lie in a hash slot of a row that goes are shuffled with their texts.
    """
    name = F.xxhash64(docs["doc_id"], docs["text"])
    named = docs.select(name.alias("row"), F.col("doc_id").cast("bigint").alias("id"), "text")
    classes = near_duplicates(named.select(F.col("row").alias("doc_id"), "text"), **options)
    rows = staged(named.groupBy("row").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "near-rows")
    found = rows.join(classes.select(F.col("doc_id").alias("row"), "class_id").distinct(), "row")
    rank = F.struct(F.col("id").isNull(), "id", "row")
    heads = found.groupBy("class_id").agg(F.min(rank).alias("head"))
    decided = found.join(heads, "class_id").select(F.col("row").alias("key"), (F.col("head.row") == F.col("row")).alias("keep"), "copies")
    decided = staged(decided.filter("not keep or copies > 1").drop("copies"), "near-decided")
    return thinned(docs, name, decided)


def query(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
