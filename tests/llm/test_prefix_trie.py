"""Tries against plain dictionaries of prefixes."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from payrisk.llm import prefix_trie
from payrisk.session import setting
from tests.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - int(math.fmod(c, 100))  # the remainder has the sign of c, as in SQL
        whole[c] = tuple(own.get(family, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    for seq in members:
        if seq:
            children[seq[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for seq, convs in members.items():
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += seq not in children
            saved[seq[:d]] += (len(convs) - 1) * len(seq[-1][1]) if seq else 0
    out = []
    for seq, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if whole[c] == seq)))
        parent = min(members[seq[:-1]]) if seq else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(seq), parent, len(convs), children[seq], leaves[seq], saved[seq], digest))
    return sorted(out, key=str)


def found(rows, **how):
    trie = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(rows)), **how)
    return sorted((tuple(r) for r in trie.collect()), key=str)


def test_query_equals_plain(spark, run_query):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = run_query(11)
    assert got.columns == prefix_trie.COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


@pytest.fixture(scope="module")
def crowded():
    """Small alphabets: deep shared prefixes, copies, one conversation in a third of all ids."""
    pick = random.Random(11)
    rows = []
    for c in range(600):
        turns = ["hot", "hotter", "hottest"] if c % 3 == 0 else [pick.choice("ab") for _ in range(pick.randrange(9))]
        rows += [(c, t, pick.choice(["user", None]) if x == "a" else "user", x) for t, x in enumerate(turns)]
    return rows


@pytest.mark.parametrize(
    ("partitions", "block_turns", "block_rows"), [(1, 1 << 18, 1 << 15), (1, 7, 3), (5, 40, 1 << 15), (150, 1 << 18, 2)]
)
def test_cuts_give_the_same(spark, crowded, partitions, block_turns, block_rows):
    """Runs go over blocks and tasks; pieces and corrections make up whole nodes."""
    frame = spark.createDataFrame(crowded, SCHEMA)
    with (
        setting(spark, "spark.sql.shuffle.partitions", str(partitions)),
        setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"),
    ):
        assert found(frame, block_turns=block_turns, block_rows=block_rows) == plain(crowded)


def test_odd_rows(spark):
    """Null and negative ids, null turns, roles and texts, equal turns, a family without its first
    conversation, conversations that end up without turns, a long text, clashing columns."""
    rows = [
        (0, None, "user", "first"), (0, 1, None, None), (0, 1, "", ""), (0, 2, "user", "x" * 200_000),
        (101, 0, "user", "lost"), (102, 5, "user", "é😀"), (102, 5, "user", "é😀"),
        (7, 0, "user", "only"), (-3, 0, "a", "b"), (-3, 0, "a", "b"), (None, 0, "user", "nobody"),
        (1, 0, "user", "first"), (2, 0, "user", "first"), (3, 3, "user", "first"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as seq", "3 as turns", "4 as family")
    assert found(frame) == plain(rows)
    assert found(frame.limit(0)) == []


def test_long_conversation(spark):
    """One conversation with many turns, twice: searches are logarithmic in what they share."""
    rows = [(c, t, "user", str(t)) for c in (200, 206) for t in range(5000)] + [(206, 9999, "user", "end")]
    assert found(spark.createDataFrame(rows, SCHEMA), block_turns=64) == plain_long(rows)


def plain_long(rows):
    """Both share their family's first turns and have the rest in common but for the end."""
    sizes = [0, *(len(str(t)) for t in range(5000))]
    none = hashlib.sha256(b"").hexdigest()
    out = []
    for d in range(5001):
        ends = hashlib.sha256(b"200").hexdigest() if d == 5000 else none
        out.append((200, d, 200 if d else None, 2, 1, 1, sum(sizes[max(d, 1):]), ends))
    out.append((206, 5001, 200, 1, 0, 1, 0, hashlib.sha256(b"206").hexdigest()))
    return sorted(out, key=str)


def test_sparse_table_searches():
    import numpy as np

    pick = np.random.default_rng(5)
    values = pick.integers(0, 9, 77)
    values[0] = -1
    table = prefix_trie.SparseTable(values)
    for at in range(77):
        for least in range(9):
            left = max(i for i in range(at + 1) if values[i] < least)
            right = min([i for i in range(at, 77) if values[i] < least], default=77)
            one, key = np.array([at]), np.array([least])
            assert table.left_end(one, key)[0] == left
            assert table.right_end(one, key)[0] == right
            assert table.minimum(np.array([min(at, 40)]), np.array([40 + at // 3]))[0] == values[min(at, 40) : 41 + at // 3].min()
