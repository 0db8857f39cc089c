from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from footfall.llm import prefix_trie
from footfall.llm.queries import op13_prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def by_hand(conversations):
    """{(smallest member, depth): (parent, members, children, leaves, saved, ends)} of {id: [(role, text)]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    out, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        out[members[node][0], len(node)] = (
            members[node[:-1]][0] if node else None, len(members[node]), len(below), leaves[node], saved[node], ends[node],
        )
    return out


def ordered(rows):
    """Rows (conv_id, turn, role, text) as conversations, as the operator orders them."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            found[c].append((turn is not None, turn or 0, role, digest, text))
    return {c: [(r[2], r[4]) for r in sorted(turns)] for c, turns in found.items()}


def found_by(spark, rows, cells=None):
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    turns = prefix_trie.turn_digests(df)
    trie = prefix_trie.prefix_trie(turns, df.where("conv_id IS NOT NULL").select("conv_id").distinct(), cells)
    ends = defaultdict(list)
    for row in trie.ends.collect():
        ends[row.conv_id, row.depth].append(row.member)
    nodes = trie.nodes.collect()
    assert all(row.n_ends == len(ends[row.conv_id, row.depth]) for row in nodes)
    out = {
        (r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, sorted(ends[r.conv_id, r.depth]))
        for r in nodes
    }
    assert len(out) == len(nodes)
    digests = {(r.conv_id, r.depth): r.ends_sha256 for r in prefix_trie.member_digests(trie.ends).collect()}
    told = {node: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() for node, (*_, ids) in out.items() if ids}
    assert digests == told
    return out


def made(n, longest, kinds, seed):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(pick.randint(1, longest)):
            rows.append((c - n // 3, pick.choice([turn, turn, turn, None]), pick.choice(["user", "user", None]), pick.choice(kinds)))
    return rows


@pytest.mark.parametrize("cells", [128, None])
def test_equals_plain_python(spark, cells):
    rows = made(60, 7, ["a", "bé", "a", "", None], 1) + [(None, 0, "user", "a"), (3, 1, "user", "a"), (3, 1, "user", "a")]
    assert found_by(spark, rows, cells) == by_hand(ordered(rows))


def test_long_copies_span_partitions(spark):
    text = [f"turn {i}" for i in range(150)]
    rows = [(c, i, "user", t) for c in (1, 2, 5) for i, t in enumerate(text)] + [(4, i, "user", t) for i, t in enumerate(text[:90])]
    rows += [(9, i, "user", t + "!") for i, t in enumerate(text)]
    assert found_by(spark, rows) == by_hand(ordered(rows))


def test_very_many_copies_and_long_texts(spark):
    rows = [(c, i, "user", "hello" * 50_000 * (i == 1)) for c in range(300) for i in range(2)]
    rows += [(1000, i, "user", str(i)) for i in range(300)]
    assert found_by(spark, rows) == by_hand(ordered(rows))


def test_defined_results(spark):
    none = spark.createDataFrame([], TURNS)
    trie = prefix_trie.prefix_trie(prefix_trie.turn_digests(none), none.select("conv_id"))
    assert trie.nodes.collect() == [] and trie.ends.collect() == []
    alone = spark.createDataFrame([(7,)], "conv_id long")
    trie = prefix_trie.prefix_trie(prefix_trie.turn_digests(none), alone)
    assert [tuple(r) for r in trie.nodes.collect()] == [(7, 0, None, 1, 1, 0, 1, 0)]
    clash = spark.createDataFrame([(1, 0, "user", "a")], TURNS)
    clash = clash.withColumn("depth", F.lit(5)).withColumn("digest", F.lit(2)).withColumn("s.1", F.lit(3))
    assert [tuple(r)[:2] + tuple(r)[3:] for r in prefix_trie.turn_digests(clash).collect()] == [(1, 1, 1)]


def test_query_equals_plain_python(spark, tmp_path):
    pick = random.Random(5)
    rows = [(c, t, pick.choice(["user", "assistant"]), pick.choice("abc")) for c in [*range(0, 40), *range(190, 330)]
            for t in range(pick.randint(1, 9))]
    spark.createDataFrame(rows, TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    own = ordered(rows)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    wanted = {
        (*node, *figures, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        for node, (*figures, ids) in by_hand(rebuilt).items()
    }
    found = op13_prefix_trie(spark, str(tmp_path))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = [tuple(row) for row in found.collect()]
    assert len(found) == len(wanted) and set(found) == wanted
