"""Prefix trie of conversations; subtree totals by parallel tree contraction."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salvor.llm.common import arrow, staged, table
from salvor.operators.ordering import number_rows

# Fixed values of the contract: conversations of five share the first turns of one, at most eight.
FAMILY, MOST_SHARED = 5, 8
# Turns of a conversation and ids of a node are added up in cells of so many.
CELL = 4096
NODE = ["depth", "k1", "k2"]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest and bytes of every turn in order of ``turn``, null first, ties by digest.

    Null role and text are empty; rows without conv_id belong to no conversation and are left out; rows that repeat
    are turns each. Sampled ranges cut long conversations, so none is sorted in one task; texts do not travel.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = lambda c: F.octet_length(c).cast("bigint")
    narrow = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.md5(F.concat(size(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        size(text).alias("bytes"),
        F.monotonically_increasing_id().alias("salt"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    dealt = narrow.repartitionByRange(F.col("conv_id").asc(), *order, F.col("salt").asc()).withColumn("cell", F.spark_partition_id())
    dealt = staged(dealt.select("conv_id", "turn", "digest", "bytes", "cell"), "trie-turns")
    return number_rows(dealt, order, F.col("cell"), "place", by=["conv_id"]).select("conv_id", "place", "digest", "bytes")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns in which conversation c starts with the first h turns of conversation c - c % 5 (all if fewer, none
    if there is no such conversation) and goes on after its own first h, h = crc32(decimal c) % 9; and (conv_id, turns)
    of every conversation, also those left without turns. A conversation's first turns are wanted by at most five."""
    counts = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).alias("h")
    convs = counts.select("conv_id", "n", shared, (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    given = F.least("h", F.coalesce("base_n", F.lit(0))).cast("bigint")
    convs = convs.join(bases, "base", "left").withColumn("given", given)
    convs = convs.withColumn("turns", F.col("given") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    convs = staged(convs.select("conv_id", "base", "h", "given", "turns"), "trie-conversations")
    first = own.filter(F.col("place") <= MOST_SHARED).select(F.col("conv_id").alias("base"), "place", "digest", "bytes")
    borrowed = convs.join(first, "base").filter(F.col("place") <= F.col("given")).select("conv_id", "place", "digest", "bytes")
    kept = own.join(convs, "conv_id").filter(F.col("place") > F.col("h"))
    kept = kept.select("conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("place"), "digest", "bytes")
    return borrowed.unionByName(kept), convs.select("conv_id", "turns")


def prefixes(turns: DataFrame) -> DataFrame:
    """Every turn with the key (k1, k2) of the conversation up to it and that of its parent (p1, p2).

    A key is the sum modulo 2 of hashes of (place, turn), 128 bits in all, so it is a prefix sum: inside cells of a
    conversation and over the few cells of a long one. Different prefixes share a key with a chance of 2^-128 a pair."""
    hashed = turns.select(
        "conv_id", "place", "bytes", F.xxhash64("place", "digest").alias("t1"), F.xxhash64("digest", "place").alias("t2"), F.expr(f"(place - 1) div {CELL}").alias("cell")
    )
    inside = Window.partitionBy("conv_id", "cell").orderBy("place")
    local = hashed.select("*", F.bit_xor("t1").over(inside).alias("k1"), F.bit_xor("t2").over(inside).alias("k2"))
    totals = hashed.groupBy("conv_id", "cell").agg(F.bit_xor("t1").alias("c1"), F.bit_xor("t2").alias("c2"))
    earlier = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("conv_id", "cell", F.bit_xor("c1").over(earlier).alias("b1"), F.bit_xor("c2").over(earlier).alias("b2")).filter("cell > 0")
    joined = local.join(before, ["conv_id", "cell"], "left")
    key = lambda i: F.col(f"k{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0)))
    joined = joined.select("conv_id", F.col("place").alias("depth"), "bytes", "t1", "t2", key(1).alias("k1"), key(2).alias("k2"))
    return joined.withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}")) for i in (1, 2)}).drop("t1", "t2")


def ending_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2) and ``ends_sha256`` of the decimal conv_ids that end there, ascending, comma-joined.

    Ids are joined by cells of CELL consecutive numbers first; the cells of a node then pass one after another
    through one running hash, so no list of a node's members is held anywhere."""
    cell = F.floor(F.col("conv_id") / F.lit(CELL)).alias("cell")
    listed = ends.groupBy(*NODE, cell).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    joined = listed.select(*NODE, "cell", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def digest(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in source:
            done = []
            for key, ids in zip(zip(*[batch.column(c).to_pylist() for c in NODE]), batch.column("ids").to_pylist()):
                if key != node:
                    if running:
                        done.append((*node, running.hexdigest()))
                    node, running = key, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield arrow(schema, [*(zip(*done) if done else ((),) * 4)])
        if running:
            yield arrow(schema, [*zip((*node, running.hexdigest()))])

    dealt = joined.repartition(*NODE).sortWithinPartitions(*NODE, "cell").select(*NODE, "ids")
    return dealt.mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def trie_nodes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of the trie over numbered turns, staged: id (smallest member, depth), up (the parent's id, null for the root),
    n_convs, bytes (of the last text), ends_sha256, n_children. Every conversation in ``lengths`` (conv_id, turns) is a
    member of the root. Without conversations there are no nodes.

    Members are counted map-side first, and the join to a parent of many children is split at run time."""
    paths = staged(prefixes(turns), "trie-prefixes")
    counted = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    zero = F.lit(0).cast("bigint")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("bytes"), F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"))
    nodes = staged(counted.unionByName(root), "trie-nodes")
    ends = paths.join(lengths.filter("turns > 0"), [paths["conv_id"] == lengths["conv_id"], paths["depth"] == lengths["turns"]], "left_semi").select(*NODE, "conv_id")
    without = lengths.filter("turns = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id")
    ids = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    whole = nodes.join(ids, ["depth", "p1", "p2"], "left").join(children, NODE, "left").join(ending_digests(ends.unionByName(without)), NODE, "left")
    return staged(
        whole.select(
            F.struct("conv_id", "depth").alias("id"),
            F.when(F.col("depth") > 0, F.struct(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth"))).alias("up"),
            "n_convs",
            "bytes",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ),
        "trie",
    )


def _rake(tree: DataFrame, weights: Sequence[str]) -> DataFrame:
    """The tree without its leaves (kids = 0), their weights added to their parents; with the remaining
    children of each node counted and, where there is one, named."""
    raked = F.col("kids") == 0
    given = tree.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("id")).agg(
        *[F.sum(F.when(raked, F.col(w)).otherwise(0)).alias(f"{w}_given") for w in weights],
        F.count_if(~raked).alias("left"),
        F.min(F.when(~raked, F.col("id"))).alias("child"),
    )
    rest = tree.filter(~raked).drop("kids").join(given, "id")
    return rest.select("id", "up", *[(F.col(w) + F.col(f"{w}_given")).alias(w) for w in weights], F.col("left").alias("kids"), "child")


def _compress(tree: DataFrame, weights: Sequence[str], turn: int) -> DataFrame:
    """Splice nodes with one child out of their chains: of two such neighbours, that with the higher hash of this
    round may go, so no two that go are neighbours. Their child moves up to their parent, which takes their weight.
    Rows that went stay in the frame with ``spliced``. Every join is by ids that occur once on both sides."""
    unary = tree.filter((F.col("kids") == 1) & F.col("up").isNotNull()).select("id", "up", "child", *weights, F.xxhash64(F.lit(turn), "id").alias("draw"))
    below = unary.select(F.col("id").alias("child"), F.col("draw").alias("other"))
    met = unary.select("id", "child", "draw").join(below, "child")
    lost = met.select(F.when(F.struct("draw", "id") < F.struct(F.col("other"), F.col("child")), F.col("id")).otherwise(F.col("child")).alias("id")).distinct()
    gone = unary.join(lost, "id", "left_anti")
    none, false = F.lit(None).cast(tree.schema["id"].dataType), F.lit(False)
    nothing = [F.lit(0).cast("bigint").alias(f"{w}_given") for w in weights]
    edits = (
        gone.select("id", none.alias("moved"), *nothing, F.lit(True).alias("spliced"))
        .unionByName(gone.select(F.col("child").alias("id"), F.col("up").alias("moved"), *nothing, false.alias("spliced")))
        .unionByName(gone.select(F.col("up").alias("id"), none.alias("moved"), *[F.col(w).alias(f"{w}_given") for w in weights], false.alias("spliced")))
    )
    edits = edits.groupBy("id").agg(F.max("moved").alias("moved"), *[F.sum(f"{w}_given").alias(f"{w}_given") for w in weights], F.max("spliced").alias("spliced"))
    return tree.join(edits, "id", "left").select(
        "id",
        F.coalesce("moved", "up").alias("up"),
        *[(F.col(w) + F.when(F.coalesce("spliced", false), 0).otherwise(F.coalesce(f"{w}_given", F.lit(0)))).alias(w) for w in weights],
        "kids",
        "child",
        F.coalesce("spliced", false).alias("spliced"),
    )


def subtree_sums(tree: DataFrame, weights: Sequence[str]) -> DataFrame:
    """id and, for each of ``weights`` (whole numbers), its sum over the subtree of every node of a forest given
    as (id, up, weights): up is null for roots.

    Parallel contraction: rounds rake all leaves into their parents and compress chains by splicing out nodes that
    are no neighbours (a third of a chain is expected to go), so the number of rounds grows with the logarithm of the nodes,
    also for one chain of all of them. A leaf's sum is known when it is raked. Then the rounds are undone: a spliced
    node's sum is its own weight at that time plus the sum of the child it had. Every round is a staged table.

    Ids are unique and every up is an id. An empty frame gives none.
    """
    kids = tree.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("id")).agg(F.count("*").alias("kids"))
    now = staged(tree.select("id", "up", *weights).join(kids, "id", "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "contract")
    raked, spliced, turn = [now.filter("kids = 0")], [], 0
    while True:
        turn += 1
        rest = staged(_rake(now, weights), "contract-rake")
        left, chained = rest.agg(F.count("*"), F.count_if((F.col("kids") == 1) & F.col("up").isNotNull())).first()
        if not left:
            break
        now = rest
        if chained:
            both = staged(_compress(rest, weights, turn), "contract-compress")
            spliced.append((len(raked), both.filter("spliced")))
            now = both.filter("not spliced")
        now = now.select("id", "up", *weights, "kids")
        raked.append(now.filter("kids = 0"))
    sums = None
    for at in reversed(range(len(raked))):
        here = raked[at].select("id", *weights)
        sums = here if sums is None else sums.unionByName(here)
        for back, gone in spliced:
            if back == at:
                known = sums.select(F.col("id").alias("child"), *[F.col(w).alias(f"{w}_below") for w in weights])
                undone = gone.join(known, "child").select("id", *[(F.col(w) + F.col(f"{w}_below")).alias(w) for w in weights])
                sums = sums.unionByName(staged(undone, "contract-expand"))
    return sums


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each node of the trie: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes of last texts that members beyond the first repeat, over the subtree), ends_sha256.

    ``turns`` are numbered turns (conv_id, place from 1 without gaps, digest, bytes), ``lengths`` all conversations with
    their number of turns; those without turns are members of the root. No conversations, no rows.
    """
    nodes = trie_nodes(turns, lengths)
    leaf = (F.col("n_children") == 0).cast("bigint").alias("n_leaves")
    saved = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")
    sums = subtree_sums(nodes.select("id", "up", leaf, saved), ["n_leaves", "saved_tokens"])
    return nodes.join(sums, "id").select(
        "id.conv_id",
        "id.depth",
        F.col("up.conv_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )


def query(spark, folder: str) -> DataFrame:
    return prefix_trie(*rebuilt(numbered_turns(table(spark, folder, "conversations"))))


SQL = r"""
with own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, digest) as place, digest, bytes
  from (
    select conv_id, turn, strlen(coalesce(text, ''))::bigint as bytes,
           md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as digest
    from conversations where conv_id is not null
  )
), convs as (
  select conv_id, conv_id - conv_id % 5 as base, count(*) as n,
         xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda s: ascii(s)::bigint),
               lambda a, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
                 lambda y, z: xor(y >> 1, case when y & 1 = 1 then 3988292384 else 0 end), xor(a, b)),
               4294967295::bigint), 4294967295) % 9 as h
  from own group by conv_id
), given as (
  select c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) as given,
         least(c.h, coalesce(b.n, 0)) + greatest(0, c.n - c.h) as turns
  from convs c left join convs b on b.conv_id = c.base
), turns as (
  select g.conv_id, o.place, o.digest, o.bytes from given g join own o on o.conv_id = g.base and o.place <= g.given
  union all
  select g.conv_id, o.place - g.h + g.given, o.digest, o.bytes from given g join own o on o.conv_id = g.conv_id and o.place > g.h
), paths as (
  select conv_id, place as depth, bytes,
         md5(string_agg(digest, '' order by place) over (partition by conv_id order by place)) as key
  from turns
  union all select conv_id, 0, 0, '' from given
), nodes as (
  select depth, key, min(conv_id) as conv_id, count(*) as n_convs, max(bytes) as bytes from paths group by depth, key
), up as (
  select n.depth, n.key, p.key as parent_key, q.conv_id as parent_conv_id
  from nodes n left join paths p on p.conv_id = n.conv_id and p.depth = n.depth - 1
  left join nodes q on q.depth = p.depth and q.key = p.key
), kids as (
  select depth - 1 as depth, parent_key as key, count(*) as n_children from up where depth > 0 group by all
), sums as (
  select p.depth, p.key,
         sum(case when k.n_children is null then 1 else 0 end)::bigint as n_leaves,
         sum((n.n_convs - 1) * n.bytes)::bigint as saved_tokens
  from nodes n left join kids k on k.depth = n.depth and k.key = n.key
  join paths p on p.conv_id = n.conv_id and p.depth <= n.depth
  group by p.depth, p.key
), ends as (
  select p.depth, p.key, string_agg(p.conv_id::varchar, ',' order by p.conv_id) as ids
  from paths p join given g on g.conv_id = p.conv_id and g.turns = p.depth group by p.depth, p.key
)
select n.conv_id, n.depth::bigint as depth, u.parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children,
       s.n_leaves, s.saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes n join up u on u.depth = n.depth and u.key = n.key join sums s on s.depth = n.depth and s.key = n.key
left join kids k on k.depth = n.depth and k.key = n.key left join ends e on e.depth = n.depth and e.key = n.key
"""
