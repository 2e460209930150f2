"""Prefix trie of conversations, by ROLLUP over positional turn-id columns.

A conversation is rebuilt first: conversation c takes the first h turns of
conversation ``c - c % 100`` and then its own turns after its first h, with
``h = crc32(decimal c) % HEADS``. Each distinct sequence of first d rebuilt turns is a
node of depth d, whose members are the conversations that start with it; the root,
of depth 0, has all.

1. Order. Turns are dealt by a range sort over (conversation, turn, role, text), so a
   long conversation is spread over tasks; its turns are numbered within a part from
   the first one's place, plus the counts of the parts ahead. Texts end here: a turn
   goes on as its id, 128 bits of SHA-256 over role and text, and its length.
2. Blocks. ``BLOCK`` consecutive turns make one row with a column per position. A
   block is keyed by the node that the block ahead ends in: two sums of 64-bit hashes
   over the blocks so far, one running sum within ``RUN`` blocks and one over runs.
3. ``GROUP BY block, prior, ROLLUP (t1, ..., t8)``: all prefixes of all blocks at
   once, grouping_id telling the depth. A first pass finds members; a node's smallest
   member owns it, and owns all deeper nodes of its own path, so one number per
   conversation says which nodes are its own. With that, a second ROLLUP adds up what
   a subtree holds from its members alone: a leaf counts through the member that owns
   it, and (members - 1) x length summed over a subtree is, per member, the length of
   its path from the node on as far as others own it.
4. ``ends_sha256``: conversation ids are distinct numbers, so those that share all
   but their last 12 bits are at most 4096; each such piece is joined on its own and
   a node's pieces are hashed in order, as a stream.

Places, blocks, nodes, owners and ends are written, so each of the plans is small:
the driver holds plans and generated code, not rows.

Rows are counted before each shuffle. What meets in one task is a conversation's
runs, the 4096 ids of a piece, or the stream of pieces of one node.

Edge cases: a null role or text is empty; turns without a number come first; equal
turn numbers go by role, then text, nulls as empty, and repeated rows are all kept. Rows
without a conversation id belong to no conversation and are left out. A
conversation whose turns all go with the first h and that gets none is a member of
the root alone. An empty table has no root and gives an empty result. Other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.shared import written

BLOCK, RUN = 8, 4096
HEADS, FAMILY = 6, 100
TURNS = [f"t{i}" for i in range(1, BLOCK + 1)]
PIECE_BITS = 12

KEY = ["depth", "ka", "kb"]


def turn_id(role: Column, text: Column) -> Column:
    """The length of the role keeps ("a", "bc") apart from ("ab", "c")."""
    told = F.concat_ws(":", F.length(role).cast("string"), role, text)
    return F.substring(F.unhex(F.sha2(told.cast("binary"), 256)), 1, 16)


def ordered(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, place, id, length): ``place`` grows along each conversation. Written to
    the shared folder."""
    plain = turns.select(
        F.col(conversation).cast("bigint").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).filter("conv IS NOT NULL")
    order = ["conv", "turn", "role", "text"]
    # The row's number splits rows that are equal in all columns.
    dealt = plain.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, "row")
    # Null turns come first: Spark's ascending order.
    placed = dealt.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    slim = placed.select(
        "conv", "place", turn_id(F.col("role"), F.col("text")).alias("id"), F.length("text").alias("length")
    )
    return written(slim, "trie-turns")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, total, pos, id, length): turns of the rebuilt conversations, from 0; of a
    conversation without turns one row without a position."""
    part = F.shiftright("place", 33)
    parts = turns.groupBy("conv", part.alias("part")).agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("*", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    convs = parts.groupBy("conv").agg(F.sum("n").alias("n"))
    heads = convs.withColumns(
        {
            "h": F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS,
            "source": F.col("conv") - F.col("conv") % FAMILY,
        }
    )
    first = convs.select(F.col("conv").alias("source"), F.col("n").alias("n0"))
    got = F.least("h", F.coalesce("n0", F.lit(0)))
    heads = heads.join(first, "source", "left").select(
        "conv", "source", "h", got.alias("got"), (got + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")
    )
    # Read back three times below, so the plan of what follows stays small.
    places = written(parts.join(heads, "conv").drop("n"), "trie-places")
    heads = places.filter("ahead = 0")
    numbered = (
        turns.withColumn("part", part)
        .join(places, ["conv", "part"])
        .withColumn("pos", F.col("ahead") + F.col("place") - F.col("start"))
    )
    own = numbered.filter("pos >= h").select("conv", "total", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "id", "length")
    lent = numbered.filter(F.col("pos") < HEADS - 1).select(F.col("conv").alias("source"), "pos", "id", "length")
    taken = heads.filter("got > 0").join(lent, "source").filter("pos < h").select("conv", "total", "pos", "id", "length")
    none = heads.filter("total = 0").selectExpr("conv", "total", "CAST(NULL AS BIGINT)", "CAST(NULL AS BINARY)", "0")
    return own.union(taken).union(none)


def mixed(salt: str, depth: Column, turns: list[Column]) -> Column:
    """A hash of a block's first turns; nulls after them do not count."""
    return F.xxhash64(F.lit(salt), depth.cast("bigint"), *turns).cast("decimal(38,0)")


def blocks(turns: DataFrame) -> DataFrame:
    """A row per conversation and block: the node it starts from (``pa``, ``pb``), the
    ids and lengths of its turns, the lengths ahead of it, the conversation's total.
    Written to the shared folder."""
    block = F.coalesce(F.floor(F.col("pos") / BLOCK), F.lit(0)).cast("bigint")
    held = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "id", "length"))))
    rows = turns.groupBy("conv", "total", block.alias("block")).agg(held.alias("held"))
    at = [F.get("held", F.lit(i)) for i in range(BLOCK)]
    wide = rows.select(
        "conv", "total", "block",
        *[one["id"].alias(t) for one, t in zip(at, TURNS, strict=True)],
        *[F.coalesce(one["length"], F.lit(0)).cast("bigint").alias(f"l{i + 1}") for i, one in enumerate(at)],
    )
    end, ids = (F.col("block") + 1) * BLOCK, [F.col(t) for t in TURNS]
    length = sum((F.col(f"l{i + 2}") for i in range(BLOCK - 1)), F.col("l1"))
    # All blocks but the last are full, and only those ahead are summed.
    wide = wide.withColumns(
        {"_a": mixed("a", end, ids), "_b": mixed("b", end, ids), "_l": length, "_run": F.floor(F.col("block") / RUN)}
    )

    def before(column: str, by: list[str], along: str) -> Column:
        window = Window.partitionBy(*by).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    inside = wide.withColumns({f"in{c}": before(c, ["conv", "_run"], "block") for c in ("_a", "_b", "_l")})
    runs = wide.groupBy("conv", "_run").agg(*[F.sum(c).alias(c) for c in ("_a", "_b", "_l")])
    ahead = runs.select("conv", "_run", *[before(c, ["conv"], "_run").alias(f"out{c}") for c in ("_a", "_b", "_l")])
    # Conversations of one run, nearly all, have nothing ahead of it.
    both = inside.join(ahead.filter("_run > 0"), ["conv", "_run"], "left")

    def total(column: str, kind: str) -> Column:
        return (F.col(f"in{column}") + F.coalesce(F.col(f"out{column}"), F.lit(0))).cast(kind)

    keys = {"pa": total("_a", "decimal(38,0)"), "pb": total("_b", "decimal(38,0)"), "ahead": total("_l", "bigint")}
    lengths = [f"l{i + 1}" for i in range(BLOCK)]
    return written(both.select("conv", "total", "block", *TURNS, *lengths, *[k.alias(n) for n, k in keys.items()]), "trie-blocks")


def node_key(level: Column, up: int = 0) -> list[Column]:
    """Depth and hashes of the node of the block's first ``level - up`` turns."""
    depth = F.col("block") * BLOCK + level - up
    ids = [F.when(level - up > i, F.col(t)) for i, t in enumerate(TURNS)]
    # No turns of the block: the node that the block starts from.
    return [depth, *[F.col(p) + F.when(level > up, mixed(s, depth, ids)).otherwise(0) for p, s in (("pa", "a"), ("pb", "b"))]]


def rolled(table: DataFrame, sums: str) -> DataFrame:
    """All prefixes of the blocks, with ``level`` turns of their block each."""
    rows = table.sparkSession.sql(
        f"""SELECT block, pa, pb, {", ".join(TURNS)}, {BLOCK} - bit_count(grouping_id()) AS level, {sums}
            FROM {{blocks}} GROUP BY block, pa, pb, ROLLUP ({", ".join(TURNS)})""",
        blocks=table,
    )
    # A block's own start is a node of the block ahead, the root's aside; a level
    # beyond a block's last turn is none.
    held = F.get(F.array(*TURNS), F.col("level") - 1)
    return rows.filter(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(held.isNotNull()))


def keyed(rows: DataFrame, *columns: str) -> DataFrame:
    level = F.col("level")
    names = [*KEY, *[f"up_{k}" for k in KEY]]
    keys = [*node_key(level), *node_key(level, 1)]
    return rows.select(*[k.alias(n) for n, k in zip(names, keys, strict=True)], *columns)


def owners(nodes: DataFrame, table: DataFrame) -> DataFrame:
    """The blocks with ``shared``, the length of the conversation's path that others
    own, and ``leaf``, whether it owns a childless node; a row per conversation is
    written to the shared folder."""
    parents = nodes.select(*[F.col(f"up_{k}").alias(k) for k in KEY]).distinct()
    childless = nodes.join(parents.withColumn("inner", F.lit(True)), KEY, "left")
    own = childless.groupBy("conv_id").agg(F.min("depth").alias("own"), F.max(F.col("inner").isNull()).alias("leaf"))
    marked = table.join(own.withColumnRenamed("conv_id", "conv"), "conv", "left")
    # Turn i of the block is the last of the node of depth block * BLOCK + i.
    theirs = [
        F.when(F.coalesce(F.col("block") * BLOCK + i + 1 < F.col("own"), F.lit(True)), F.col(f"l{i + 1}")).otherwise(0)
        for i in range(BLOCK)
    ]
    paths = marked.groupBy("conv").agg(F.sum(sum(theirs[1:], theirs[0])).alias("shared"), F.first("leaf").alias("leaf"))
    return table.join(written(paths, "trie-owners"), "conv")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of node and place to one digest per node."""
    node, digest = None, None

    def answer() -> pa.RecordBatch:
        columns = [pa.array([node[0]], pa.int64()), *[pa.array([k], pa.string()) for k in node[1:]], pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, names=[*KEY, "sha"])

    for batch in batches:
        for *key, piece in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")], strict=True):
            if key != node:
                if node:
                    yield answer()
                node, digest = key, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
    if node:
        yield answer()


def ends(table: DataFrame) -> DataFrame:
    """Node key and SHA-256 of the ids of the conversations that end there. Written to
    the shared folder."""
    level = F.col("total") - F.col("block") * BLOCK
    last = table.filter((level >= 0) & (level <= BLOCK) & ((level > 0) | (F.col("total") == 0)))
    named = last.select("conv", *[k.alias(n) for n, k in zip(KEY, node_key(level), strict=True)])
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))
    pieces = named.groupBy(*KEY, F.shiftright("conv", PIECE_BITS).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))
    # Decimals as texts: Arrow has no digits to check.
    texts = pieces.select("depth", F.col("ka").cast("string").alias("ka"), F.col("kb").cast("string").alias("kb"), "piece", "ids")
    dealt = texts.repartition(*KEY).sortWithinPartitions(*KEY, "piece")
    hashed = dealt.mapInArrow(_hashed, "depth bigint, ka string, kb string, sha string")
    keys = [F.col(k).cast("decimal(38,0)").alias(k) for k in KEY[1:]]
    return written(hashed.select("depth", *keys, "sha"), "trie-ends")


def prefix_trie(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256: a row per node."""
    table = blocks(rebuilt(ordered(turns, conversation, turn, role, text)))
    members = rolled(table, "min(conv) AS conv_id")
    nodes = written(keyed(members, "conv_id"), "trie-nodes")
    # What a member's path from turn i of the block on has in others' nodes.
    spent, saved = F.col("shared") - F.col("ahead"), {}
    for i in range(BLOCK):
        saved[f"s{i + 1}"] = F.greatest(spent, F.lit(0))
        spent = spent - F.col(f"l{i + 1}")
    marked = owners(nodes, table).withColumns(saved).withColumn("leaf", F.col("leaf").cast("bigint"))
    sums = ", ".join(f"sum(s{i + 1}) AS s{i + 1}" for i in range(BLOCK))
    subtrees = rolled(marked, f"min(conv) AS conv_id, count(*) AS n_convs, sum(coalesce(leaf, 0)) AS n_leaves, {sums}")
    from_here = F.get(F.array(*saved), F.greatest(F.col("level") - 1, F.lit(0)))
    full = keyed(subtrees.withColumn("saved_tokens", from_here), "conv_id", "n_convs", "n_leaves", "saved_tokens")
    children = nodes.groupBy(*[F.col(f"up_{k}").alias(k) for k in KEY]).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(*[F.col(k).alias(f"up_{k}") for k in KEY], F.col("conv_id").alias("parent_conv_id"))
    nobody = hashlib.sha256(b"").hexdigest()
    return (
        full.join(children, KEY, "left")
        .join(ends(table), KEY, "left")
        .join(parents, [f"up_{k}" for k in KEY], "left")
        .select(
            "conv_id",
            F.col("depth").cast("bigint").alias("depth"),
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            F.col("n_leaves").cast("bigint").alias("n_leaves"),
            F.col("saved_tokens").cast("bigint").alias("saved_tokens"),
            F.coalesce("sha", F.lit(nobody)).alias("ends_sha256"),
        )
    )


SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
heads AS (
  SELECT conv_id, n, conv_id - conv_id % {FAMILY} AS source,
         -- CRC-32 of the decimal digits, bit by bit.
         xor(list_reduce(
               list_concat([CAST(4294967295 AS UBIGINT)],
                           [CAST(ascii(x) AS UBIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
               lambda c, b: list_reduce(
                 list_concat([xor(c, b)], [CAST(k AS UBIGINT) FOR k IN range(8)]),
                 lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS UBIGINT)) ELSE x // 2 END)),
             CAST(4294967295 AS UBIGINT)) % {HEADS} AS h
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id)
),
joined AS (
  SELECT s.conv_id, t.role, t.text, t.pos FROM heads s JOIN turns t ON t.conv_id = s.source AND t.pos <= s.h
  UNION ALL
  SELECT s.conv_id, t.role, t.text, t.pos + {HEADS} FROM heads s JOIN turns t ON t.conv_id = s.conv_id AND t.pos > s.h
),
paths AS (
  SELECT h.conv_id, coalesce(j.path, []) AS path, coalesce(j.lengths, []) AS lengths
  FROM heads h LEFT JOIN (
    SELECT conv_id, list(sha256(length(role) || ':' || role || ':' || text) ORDER BY pos) AS path,
           list(length(text) ORDER BY pos) AS lengths
    FROM joined GROUP BY conv_id) j USING (conv_id)
),
prefixes AS (
  SELECT conv_id, d AS depth, len(path) AS total, sha256(array_to_string(path[1:d], ',')) AS node,
         CASE WHEN d > 0 THEN sha256(array_to_string(path[1:d - 1], ',')) END AS parent,
         CASE WHEN d > 0 THEN lengths[d] ELSE 0 END AS wide
  FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)
),
nodes AS (
  SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(wide) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE total = depth), '')) AS ends
  FROM prefixes GROUP BY depth, node
),
children AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf
  FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node
),
-- Every node and each node above it, through the path of a conversation that holds both.
above AS (
  SELECT p.depth, p.node, f.saved, f.leaf
  FROM full_nodes f JOIN prefixes q ON q.conv_id = f.conv_id AND q.depth = f.depth
  JOIN prefixes p ON p.conv_id = f.conv_id AND p.depth <= f.depth
),
subtrees AS (SELECT depth, node, sum(saved) AS saved, sum(leaf) AS leaves FROM above GROUP BY depth, node)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM full_nodes f JOIN subtrees s ON s.depth = f.depth AND s.node = f.node
LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.node = f.parent
"""
