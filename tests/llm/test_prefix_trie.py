import hashlib
import zlib
from collections import defaultdict

import pytest

from spendlight.llm import prefix_trie as trie

TURNS = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    """Every node from all prefixes, for rows whose turns differ."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(t)] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = own.get(c - c % 20, [])
        path = tuple(head[:h] + turns[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    words = lambda path: len(path[-1][1].split()) if path else 0
    out = set()
    for path, held in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = {p for p in members if len(p) == len(path) + 1 and p[:-1] == path}
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in members)]
        text = ",".join(map(str, sorted(ends[path])))
        out.add((
            min(held), len(path), min(members[path[:-1]]) if path else None, len(held), len(kids), len(leaves),
            sum((len(members[p]) - 1) * words(p) for p in below), hashlib.sha256(text.encode()).hexdigest(),
        ))
    return out


def small_rows():
    rows = [(c, t, "user" if t % 2 == 0 else "bot", f"say {t} {(c * 7 + t) % 3}") for c in range(70) for t in range(c % 6)]
    rows += [(c, t, "user", "all the same") for c in range(100, 160) for t in range(5)]
    rows += [(300, None, "user", "first"), (300, 0, None, None), (300, 1, "", ""), (301, 5, "user", ""), (309, 0, "u", "x")]
    return rows + [(None, 0, "user", "nobody"), (333, 0, "a", "bc"), (334, 0, "ab", "c")]


@pytest.mark.parametrize("shards", [None, 1, 2, 5, 40, 200])
def test_equals_brute_force(spark, shards):
    rows = small_rows()
    found = trie.prefix_trie(spark.createDataFrame(rows, TURNS), shards).collect()
    assert len(found) == len(set(map(tuple, found)))
    assert set(map(tuple, found)) == brute_force(rows)


def test_copies_are_spread_over_shards(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(1000, 3000) for t in range(4)]
    paths = trie.rebuilt_paths(spark.createDataFrame(rows, TURNS)).cache()
    cuts = trie.splitters(paths, 8)
    shards = [r["count"] for r in trie._cut(paths, cuts).groupBy("shard").count().collect()]
    assert len(shards) == 8 and max(shards) < 600
    assert len(trie.skeleton_of(cuts)) <= 8


def test_the_skeleton_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(trie, "SKELETON_NODES", 6)
    rows = small_rows()
    conversations = spark.createDataFrame(rows, TURNS)
    assert len(trie.skeleton_of(trie.splitters(trie.rebuilt_paths(conversations), 40))) <= 6
    assert set(map(tuple, trie.prefix_trie(conversations, 40).collect())) == brute_force(rows)


def test_pieces_of_a_digest(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = small_rows()
    assert set(map(tuple, trie.prefix_trie(spark.createDataFrame(rows, TURNS), 9).collect())) == brute_force(rows)


def test_long_conversation_and_ties(spark):
    rows = [(41, t, "user", f"w{t}") for t in range(3000)] + [(41, 5, "user", "again"), (-7, 0, "u", "x"), (-7, 0, "u", "x")]
    found = trie.prefix_trie(spark.createDataFrame(rows, TURNS), 3).collect()
    again = trie.prefix_trie(spark.createDataFrame(rows[::-1], TURNS).repartition(5), 7).collect()
    assert set(map(tuple, found)) == set(map(tuple, again))
    h = zlib.crc32(b"41") % 4
    assert max(r.depth for r in found if r.conv_id == 41) == 3001 - h


def test_other_columns_and_empty_tables(spark):
    from pyspark.sql import functions as F

    rows = small_rows()
    conversations = spark.createDataFrame(rows, TURNS)
    clashing = conversations.withColumns({c: F.lit("x") for c in ("path", "words", "shard", "node", "keys", "head", "h")})
    assert set(map(tuple, trie.prefix_trie(clashing).collect())) == brute_force(rows)
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, None, None, None)], TURNS)).collect() == []
