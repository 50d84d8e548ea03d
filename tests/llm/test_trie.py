"""The prefix trie against a dictionary of prefixes, contraction against recursion, and rows at the edges."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from salvor.llm import trie


def rebuilt_by_hand(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = own.get(base, [])[:h] + own[c][h:]
    return made


def trie_by_hand(rows):
    made = rebuilt_by_hand(rows)
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, inside in members.items():
        under = [n for n in members if n[: len(node)] == node]
        leaf = [n for n in under if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)]
        ends = ",".join(map(str, sorted(c for c in inside if len(made[c]) == len(node))))
        out.append(
            (
                min(inside),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(inside),
                sum(len(n) == len(node) + 1 for n in under),
                len(leaf),
                sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out)


def found(frame):
    nodes = trie.prefix_trie(*trie.rebuilt(trie.numbered_turns(frame)))
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted(tuple(r) for r in nodes.select(columns).collect())


CLASHES = "id int, up int, place int, cell int, digest string, turns int, base int, h int"
SHAPE = f"conv_id long, turn long, role string, text string, {CLASHES}"


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "x", 5, 6, 7) for r in rows], SHAPE)


def test_edges(spark):
    pick = random.Random(3)
    rows = []
    for c in [*range(25), 102, -7, -5, 10_000_001]:
        for t in range(pick.randrange(1, 9)):
            rows.append((c, t, pick.choice(["user", "assistant", None]), pick.choice(["a", "é🙂", "", None, "b c"])))
    rows += [(50, None, "user", "null first"), (50, 0, "user", "then this"), (50, 0, "user", "then this"), (50, 0, None, None)]
    rows += [(None, 1, "user", "no conversation"), (60, 0, "user", "x" * 300_000)]
    assert found(frame_of(spark, rows)) == trie_by_hand(rows)


def test_empty_table(spark):
    assert found(frame_of(spark, [])) == []


def test_conversations_left_without_turns_are_members_of_the_root(spark):
    # h of 3 is 2 or more, and conversation 0 is absent.
    rows = [(3, 0, "user", "only")]
    assert zlib.crc32(b"3") % 9 > 0
    (root,) = found(frame_of(spark, rows))
    assert root[:7] == (3, 0, None, 1, 0, 1, 0) and root[7] == hashlib.sha256(b"3").hexdigest()


def test_hot_conversation_and_common_turns(spark):
    rows = [(0, t, "user", "long") for t in range(9_000)]
    rows += [(5 * c, t, "user", f"same {t}") for c in range(1, 60) for t in range(3)]
    got = found(frame_of(spark, rows))
    assert len(got) == 1 + 9_000 + 3
    by_node = {r[:2]: r for r in got}
    assert by_node[(0, 0)][3:6] == (60, 2, 2)
    assert by_node[(0, 9_000)][2:6] == (0, 1, 0, 1)
    assert by_node[(5, 1)][3] == 59 and by_node[(5, 1)][6] == 58 * 6 * 3
    assert by_node[(5, 3)][7] == hashlib.sha256(",".join(str(5 * c) for c in range(1, 60)).encode()).hexdigest()


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_contraction_equals_recursion(spark, shape):
    pick = random.Random(shape)
    n = 300
    up = {0: None}
    for i in range(1, n):
        up[i] = {"chain": i - 1, "star": 0, "random": pick.randrange(i), "forest": pick.choice([None, i - 1])}[shape]
    weight = {i: (pick.randrange(100), pick.randrange(5)) for i in up}
    names = list(up)
    pick.shuffle(names)  # numbers say nothing about depth
    name = dict(zip(up, names))
    rows = [(name[i], None if u is None else name[u], *weight[i]) for i, u in up.items()]
    tree = spark.createDataFrame(rows, "id long, up long, a long, b long")
    wanted = {i: list(w) for i, w in weight.items()}
    for i in sorted(up, reverse=True):
        if up[i] is not None:
            for j in (0, 1):
                wanted[up[i]][j] += wanted[i][j]
    got = {r["id"]: [r["a"], r["b"]] for r in trie.subtree_sums(tree, ["a", "b"]).collect()}
    assert got == {name[i]: w for i, w in wanted.items()}


def test_ids_of_a_node_pass_in_cells(spark):
    ids = random.Random(1).sample(range(-20_000, 60_000), 15_000)
    ends = spark.createDataFrame([(c,) for c in ids], "conv_id long").select(
        F.lit(1).cast("long").alias("depth"), (F.col("conv_id") % 2).alias("k1"), F.lit(0).cast("long").alias("k2"), "conv_id"
    )
    got = {r["k1"]: r["ends_sha256"] for r in trie.ending_digests(ends).collect()}
    for k in {int.__mod__(abs(c), 2) * (1 if c >= 0 else -1) for c in ids}:
        mine = sorted(c for c in ids if (c - 2 * int(c / 2)) == k)
        assert got[k] == hashlib.sha256(",".join(map(str, mine)).encode()).hexdigest()
