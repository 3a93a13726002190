"""The trie of conversation prefixes against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadmason.llm import prefix_trie
from loadmason.llm.prefix_trie import Parentheses, end_digests, trie, trie_digests

from .conftest import clashing

TURN = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows, group, shared):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    convs = {c: [t for _, t in sorted(turns)] for c, turns in convs.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % shared
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        path = tuple(convs.get(base, [])[:h] + convs[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    out, totals = [], {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below = [totals[c] for c in children[path]]
        totals[path] = (sum(n for n, _ in below) or 1, own + sum(s for _, s in below))
        digest = hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        out.append((min(members[path]), len(path), parent, len(members[path]), len(children[path]), *totals[path], digest))
    return sorted(out, key=repr)


def conversations(seed=4):
    rng = random.Random(seed)
    rows = []
    for conv in range(-7, 70):
        if conv % 11 == 3:
            continue
        for turn in range(rng.randrange(1, 14)):
            text = rng.choice(["yes", "no", "", None, "é\U0001f600", "x" * 30])
            rows.append((conv, turn if rng.random() > 0.05 else None, rng.choice(["user", "assistant", None]), text))
    rows += [(c, t, "user", "the same") for c in range(100, 140) for t in range(4)]
    rows += [(c, t, "user", "the same") for c in range(140, 150) for t in range(6)]
    rows += [(200, t, "user", f"turn {t % 40}") for t in range(60)] + [(205, t, "user", f"turn {t % 40}") for t in range(70)]
    rows += [(5, 3, "user", "again")] * 3 + [(None, 0, "user", "lost")]
    return rows


@pytest.mark.parametrize("band_turns,shard_bytes", [(1024, 16 << 20), (1024, 700), (16, 900), (1, 2000)])
def test_nodes(spark, monkeypatch, band_turns, shard_bytes):
    monkeypatch.setattr(prefix_trie, "SHARD_BYTES", shard_bytes)
    if band_turns == 1:
        rows = [r for r in conversations() if r[0] is None or r[0] < 30]
    else:
        rows = conversations()
    found = trie_digests(clashing(spark.createDataFrame(rows, TURN).repartition(5)), band_turns=band_turns)
    got = sorted([tuple(r[c] for c in COLUMNS) for r in found.collect()], key=repr)
    assert got == plain_trie(rows, prefix_trie.GROUP, prefix_trie.SHARED)


def test_turnless_and_missing_conversations(spark):
    # the heads of 1 and 2 would come from conversation 0, which is not there
    rows = [(1, 0, "user", "a"), (2, 0, "user", "b"), (2, 1, "user", "c")]
    got = sorted([tuple(r[c] for c in COLUMNS) for r in trie_digests(spark.createDataFrame(rows, TURN)).collect()], key=repr)
    assert got == plain_trie(rows, 5, 9)
    assert trie_digests(spark.createDataFrame([], TURN)).count() == 0
    nodes, ends = trie(spark.createDataFrame(rows, TURN))
    assert sorted(r.conv_id for r in ends.collect()) == [1, 2]
    assert nodes.join(ends.select("n1", "n2"), ["n1", "n2"]).count() == 2


def test_ids_stream_through_a_digest(spark):
    ends = spark.range(1000).select(F.lit(1).cast("long").alias("n1"), (F.col("id") % 2).alias("n2"), F.col("id").alias("conv_id"))
    got = {r.n2: r.ends_sha256 for r in end_digests(ends).collect()}
    assert got == {p: hashlib.sha256(",".join(map(str, range(p, 1000, 2))).encode()).hexdigest() for p in (0, 1)}


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 500, 5000])
def test_find_close(size):
    rng = random.Random(size)
    bits, depth = [], 0
    while len([b for b in bits if b]) < size:
        if depth and rng.random() < 0.45:
            bits.append(False)
            depth -= 1
        else:
            bits.append(True)
            depth += 1
    bits += [False] * depth
    held, close = [], {}
    for i, b in enumerate(bits):
        if b:
            held.append(i)
        else:
            close[held.pop()] = i
    tree = Parentheses(np.array(bits))
    assert tree.find_close(tree.opens).tolist() == [close[i] for i in tree.opens.tolist()]
    assert tree.leaf_rank[-1] == sum(a and not b for a, b in zip(bits[:-1], bits[1:]))
