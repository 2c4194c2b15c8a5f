"""The trie of rebuilt conversations against brute force, and the algebra of fingerprints."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import reduce

import pytest

from queuelake.llm import prefix_trie
from queuelake.llm.prefix_trie import combine


def brute(rows, family=5, heads=9):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % family if c >= 0 else -(-c % family))
        rebuilt = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append(c)
        ends[rebuilt].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[p] for p in children[path]) or 1
        saved[path] = sum(saved[p] for p in children[path]) + ((len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0)
    out = []
    for path, convs in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children[path]), leaves[path], saved[path], digest))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
DDL = "conv_id bigint, turn bigint, role string, text string, depth int, idx int, part int, h int, n_bytes int, t1 int"


def trie(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], DDL).repartition(4)
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(frame, **options).select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="session")
def talks():
    """Shared openings, copies of whole conversations, one very long, ties, nulls, ids below zero, bases that are absent."""
    rng = random.Random(3)
    rows = []
    for c in [*range(-12, 40), *range(1001, 1005)]:
        n = rng.choice([1, 1, 2, 4, 9, 12])
        rows += [(c, t, rng.choice(["user", "user", None]), rng.choice(["", "yes", "no", "nö", None])) for t in range(n)]
    rows += [(c, t, "user", f"the same {t}") for c in range(100, 160) for t in range(14)]
    rows += [(200, t, "assistant", f"line {t % 5}") for t in range(1500)] + [(202, t, "assistant", f"line {t % 5}") for t in range(1200)]
    rows += [(300, None, "user", "early"), (300, 5, "user", "b"), (300, 5, "user", "a"), (300, 5, "user", "a"), (300, -1, "user", "z")]
    rows += [(301, 0, "user", "x" * 300_000), (302, 0, "user", "x" * 300_000 + "y"), (None, 0, "user", "nowhere"), (None, None, None, None)]
    return rows


def test_trie(spark, talks):
    assert trie(spark, talks) == brute(talks)


def test_other_families(spark, talks):
    assert trie(spark, talks, family=3, heads=4) == brute(talks, 3, 4)


def test_nothing_and_one(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "x")]) == []
    assert trie(spark, [(7, None, None, None)]) == brute([(7, None, None, None)])


def test_codes_that_collide_are_replaced(spark):
    """Equal codes of different turns are found out by the texts they refer to."""
    asked = []

    def weak(attempt, role, text):
        return bytes([len(text) % 2]) * 16 if attempt == 0 else prefix_trie.digest_code(attempt, role, text)

    rows = [(c, t, "user", f"{c % 3} says {'x' * (t % 3)}") for c in range(12) for t in range(4)]
    asked.append(trie(spark, rows, code=weak))
    assert asked[0] == brute(rows)


def test_members_that_differ_are_found_out(spark):
    """A fingerprint shared by prefixes of different turns or parents is no node."""
    base = "conv_id bigint, depth bigint, f1 bigint, f2 bigint, g1 bigint, g2 bigint, t1 bigint, t2 bigint, n_bytes bigint"
    same = [(1, 2, 9, 9, 4, 4, 7, 7, 3), (2, 2, 9, 9, 4, 4, 7, 7, 3)]
    assert prefix_trie._nodes(spark.createDataFrame(same, base)).first().n_convs == 2
    for other in ((2, 2, 9, 9, 5, 4, 7, 7, 3), (2, 2, 9, 9, 4, 4, 7, 8, 3)):
        assert prefix_trie._nodes(spark.createDataFrame([same[0], other], base)) is None


def test_fingerprints_are_a_monoid():
    rng = random.Random(9)
    parts = [(rng.randrange(9), rng.getrandbits(64), rng.getrandbits(64)) for _ in range(6)]
    assert combine(combine(parts[0], parts[1]), parts[2]) == combine(parts[0], combine(parts[1], parts[2]))
    assert combine((0, 0, 0), parts[3]) == parts[3] == combine(parts[3], (0, 0, 0))


def test_conversations_cross_partitions(spark):
    """Products of turns are the same wherever the boundaries of the range partitions lie."""
    rows = [(1, t, "user", f"{t}") for t in range(900)] + [(2, 0, "user", "0"), (3, 0, "user", "0"), (3, 1, "user", "1")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        found = {(r.conv_id, r.idx): (r.idx, r.p1 % 2**64, r.p2 % 2**64) for r in prefix_trie.coded(frame).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    code = lambda text: (1, *(int.from_bytes(prefix_trie.digest_code(0, "user", text)[k : k + 8], "little") for k in (0, 8)))
    for conv, n in ((1, 900), (2, 1), (3, 2)):
        so_far = (0, 0, 0)
        for t in range(n):
            so_far = combine(so_far, code(f"{t}"))
            assert found[conv, t + 1] == so_far
    assert reduce(combine, [code(f"{t}") for t in range(900)]) == found[1, 900] and len(found) == 903


def test_ids_are_hashed_in_pieces(spark, monkeypatch):
    rows = [(c, 0, "user", "hello") for c in range(0, 4000)]
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 100)
    assert trie(spark, rows) == brute(rows)
