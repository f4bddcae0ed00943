import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from stayledger.llm.prefix_trie import conversations, find_close, trie
from stayledger.llm.queries import op12_prefix_trie, oracle_sql
from verification.compare import connect, differences

TURNS = "conv_id long, turn int, role string, text string"


def expected(chats: dict) -> Counter:
    """Nodes by brute force from {conv_id: [(role, text), ...]}."""
    nodes = defaultdict(list)
    for c, turns in chats.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    out = Counter()
    for node, members in nodes.items():
        tree = [(s, m) for s, m in nodes.items() if s[:len(node)] == node]
        inner = {s[:-1] for s in nodes if s}
        ends = sorted(c for c in members if c is not None and len(chats[c]) == len(node))
        out[(least(members), len(node), least(nodes[node[:-1]]) if node else None, len(members),
             sum(bool(s) and s[:-1] == node for s in nodes), sum(s not in inner for s, _ in tree),
             sum((len(m) - 1) * len(s[-1][1]) for s, m in tree if s),
             hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())] += 1
    return out


def least(members):
    return min((c for c in members if c is not None), default=None)


def rows_of(df) -> Counter:
    return Counter(tuple(r) for r in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def table(spark, chats):
    return spark.createDataFrame([(c, k, r, t) for c, turns in chats.items() for k, (r, t) in enumerate(turns)], TURNS)


def test_close_of_every_parenthesis():
    rng = random.Random(1)
    for size in (1, 2, 7, 700):
        bits = []
        left, depth = size, 0
        while left or depth:  # one tree, deep runs now and then
            if left and (depth == 0 and not bits or depth > 0 and rng.random() < 0.6):
                bits.append(1)
                left, depth = left - 1, depth + 1
            elif depth > 1 or not left:
                bits.append(0)
                depth -= 1
            else:
                bits.append(1)
                left, depth = left - 1, depth + 1
        stack, want = [], {}
        for p, b in enumerate(bits):
            if b:
                stack.append(p)
            else:
                want[stack.pop()] = p
        excess = np.cumsum(np.where(np.array(bits) == 1, 1, -1))
        opens = np.nonzero(bits)[0]
        for block in (1, 2, 8, 128):
            assert find_close(excess, opens, block).tolist() == [want[p] for p in opens.tolist()]


def test_nodes_equal_brute_force_for_any_shards(spark):
    rng = random.Random(5)
    chats = {}
    for c in range(160):
        if c % 4 == 0:
            chats[c] = [("user", "hot"), ("assistant", "é")]  # a third are copies
        else:
            chats[c] = [(rng.choice(["user", "assistant"]), rng.choice(["", "a", "bb", "é\n", "hot"]))
                        for _ in range(1 + rng.randrange(6))]
    chats[999] = [("user", "x" * 50)] * 300
    want = expected(chats)
    for per_shard in (20_000, 90, 7):
        assert rows_of(trie(conversations(table(spark, chats)), per_shard)) == want


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = spark.createDataFrame([
        (1, None, "user", "n"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 3, None, None),
        (None, 0, "user", "n"), (None, 1, "user", "z"), (-7, 0, "user", "n")], TURNS)
    chats = {1: [("user", x) for x in "naab"], 2: [("", "")], None: [("user", "n"), ("user", "z")], -7: [("user", "n")]}
    clash = rows.withColumns({c: F.lit("x") for c in ("steps", "key", "path", "shard", "nth", "size")})
    assert rows_of(trie(conversations(clash))) == expected(chats)
    assert trie(conversations(rows.limit(0))).count() == 0


def test_query_rebuilds_and_equals_its_sql(spark, tmp_path):
    rng = random.Random(9)
    own = {c: [(rng.choice(["user", "assistant"]), f"t{rng.randrange(3)}") for _ in range(1 + rng.randrange(7))]
           for c in [*range(0, 230), *range(310, 330), 1000]}
    table(spark, own).write.parquet(f"{tmp_path}/conversations.parquet")
    chats = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        chats[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    assert any(not turns for turns in chats.values())
    assert rows_of(op12_prefix_trie(spark, str(tmp_path))) == expected(chats)


def test_sql_at_two_scales(spark):
    for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        con = connect(d)
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
        assert not differences(spark, op12_prefix_trie, oracle_sql()["op12_prefix_trie"], d, con)
