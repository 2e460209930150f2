"""The prefix trie against its SQL and against plain Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tidegauge.llm import prefix_trie
from tidegauge.llm.queries import ORACLE_SQL, QUERIES

TURNS = "conv_id bigint, turn bigint, role string, text string, depth string, block string, id string, level string"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plainly(rows):
    """The definition, by sets of members."""
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            told[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [t[1:] for t in sorted(own)] for c, own in told.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        # Towards zero, as SQL takes remainders.
        home = c - (abs(c) % 100) * (1 if c > 0 else -1)
        paths[c] = tuple(turns.get(home, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = Counter()
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in own if len(paths[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out[own[0], len(node), parent, len(own), len(children), len(leaves), saved, sha] += 1
    return out


def by_sql(turns):
    engine = duckdb.connect()
    engine.register("conversations", turns.select("conv_id", "turn", "role", "text").toArrow())
    result = engine.execute(ORACLE_SQL["op12_prefix_trie"])
    assert sorted(c[0] for c in result.description) == sorted(NAMES)
    order = [[c[0] for c in result.description].index(n) for n in NAMES]
    return Counter(tuple(row[i] for i in order) for row in result.fetchall())


def got(df):
    return Counter(map(tuple, df.select(NAMES).collect()))


def test_trie_equals_sql(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert got(QUERIES["op12_prefix_trie"](spark, sf_dir)) == by_sql(turns)


@pytest.fixture(scope="module")
def turns(spark):
    """Long conversations with a long common start, copies, odd rows, lone turns."""
    rows = [(c, t, "ab"[t % 2], f"same {t}" if t < 30 + c else f"own {c} {t}") for c in range(3) for t in range(60)]
    rows += [(100 + c, t, "user", f"hi {t % (1 + c % 3)}") for c in range(12) for t in range(1 + c)]
    rows += [(200 + c, 0, "user", "first") for c in range(20)] + [(1700, t, "x", "y" * t) for t in range(9)]
    rows += [(1700 + c, t, "x", "z") for c in (3, 50) for t in range(c)] + [(-150, 1, "m", "minus"), (-3, 0, "m", "é\U0001f600")]
    rows += [(301, 0, "a", "bc"), (302, 0, "ab", "c"), (303, None, None, None), (303, 5, "", ""), (None, 0, "u", "left out")]
    rows += [(400, 0, "u", "later"), (400, None, "u", "earlier"), (400, 0, "u", "also"), (400, 0, None, "also")]
    rows += [(400, 0, "u", "again")] * 20 + [(401, 0, "u", "long " * 5000), (402, 0, "u", "long " * 5000)]
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], TURNS)


def test_trie_of_odd_conversations(turns):
    expected = plainly([tuple(r)[:4] for r in turns.collect()])
    assert by_sql(turns) == expected
    assert got(prefix_trie.prefix_trie(turns)) == expected


def test_runs_and_pieces_are_joined(turns, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 2)
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", 2)
    assert got(prefix_trie.prefix_trie(turns)) == plainly([tuple(r)[:4] for r in turns.collect()])


def test_a_long_conversation_is_spread(spark, turns):
    """One conversation over several parts of the range sort, each turn in its place."""
    rows = [(0, 700 - t, "u", f"turn {700 - t}") for t in range(700)] + [(1, 3, "u", "other")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = prefix_trie.ordered(table, "conv_id", "turn", "role", "text")
        assert placed.filter("conv = 0").selectExpr("shiftright(place, 33) AS part").distinct().count() > 1
        found = prefix_trie.rebuilt(placed).filter("conv = 0").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(r["pos"] for r in found) == list(range(700))
    lengths = [r["length"] for r in sorted(found, key=lambda r: r["pos"])]
    assert lengths == [len(f"turn {t}") for t in range(1, 701)]


def test_trie_of_no_rows(turns):
    assert prefix_trie.prefix_trie(turns.limit(0)).count() == 0


def test_last_plan_stays_small(spark):
    """Plans are held by the driver, whatever the rows: what the last one joins is written."""
    rows = [(i, t, "user", f"{i % 3} {t}") for i in range(6) for t in range(3)]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 10, plan
