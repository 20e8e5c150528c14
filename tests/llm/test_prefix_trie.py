"""The trie against a plain version over lists of turns."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fillscope.llm import prefix_trie
from fillscope.llm.queries import prefix_trie_nodes

SCHEMA = "conv_id long, turn long, role string, text string, path string, n int, depth string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, key), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def sums(p):
        below = [sums(q) for q in children[p]]
        leaves = sum(b[0] for b in below) if below else 1
        return leaves, sum(b[1] for b in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)

    found = []
    for p, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if rebuilt[c] == p)))
        parent = min(members[p[:-1]]) if p else None
        found.append((min(convs), len(p), parent, len(convs), len(children[p]), *sums(p), sha(ends)))
    return sorted(found, key=repr)


def found(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, prefix_trie_nodes(frame).collect()), key=repr)


def made_rows():
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {c % 3 if t else 0} {t}") for c in range(130) for t in range(c % 8)]
    # A long group of copies, a hot first turn, and its continuations.
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(200) for t in range(7)]
    rows += [(5000 + c, t, "user", f"hot {c if t else 0} \U0001f926é") for c in range(150) for t in range(6)]
    rows += [(300, None, "user", None), (300, 0, None, "x"), (300, None, "", ""), (300, 0, None, "x"), (None, 1, "user", "nobody")]
    rows += [(-250, 0, "user", "minus"), (-200, 0, "user", "base"), (-201, 1, "a", "b"), (2**62, 0, "big", "id"), (9_000_000_000, 1, "u", "far")]
    rows += [(700, t, "user", "very " * 2000 + str(t)) for t in range(300)] + [(701, t, "user", "very " * 2000 + str(t)) for t in range(250)]
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_brute_force(spark, parts):
    rows = made_rows()
    assert found(spark, rows, parts) == plain(rows)


def test_any_splitters_give_the_same_nodes(spark, monkeypatch):
    rows = made_rows()
    expected = plain(rows)
    monkeypatch.setattr(prefix_trie, "SHARD_BYTES", 2000)
    assert found(spark, rows) == expected
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", 16)
    assert found(spark, rows) == expected
    monkeypatch.setattr(prefix_trie, "FLUSH_ROWS", 1)
    assert found(spark, rows) == expected


def test_no_rows_and_turnless_conversations(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "nobody")]) == []
    # crc32 of 13 leaves more than one turn to an absent base, so the conversation is rebuilt without turns.
    alone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    assert found(spark, [(alone, 0, "user", "gone")]) == [(alone, 0, None, 1, 0, 1, 0, sha(str(alone)))]


def test_skeleton_holds_every_shared_node():
    key = lambda *turns: b"".join(hashlib.md5(t.encode()).digest() for t in turns)
    paths = sorted(key(a, b, c) for a in "xy" for b in "pqr" for c in "123456")
    splitters = [paths[5], paths[17], paths[29]]
    skeleton = prefix_trie.Skeleton(splitters)
    inside = {0: b""}
    for (node, step), child in skeleton.children.items():
        inside[child] = inside[node] + step
    shards = defaultdict(set)
    for path in paths:
        for d in range(0, len(path) + 1, 16):
            shards[path[:d]].add(sum(s <= path for s in splitters))
    assert all(prefix in inside.values() for prefix, where in shards.items() if len(where) > 1)


def test_equal_conversations_are_packed(spark):
    rows = [(c, 0, "user", "same") for c in range(9000)]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    packed = prefix_trie.distinct_paths(prefix_trie.turn_sequences(frame))
    assert packed.count() == 3 and packed.agg(F.sum("n")).first()[0] == 9000
