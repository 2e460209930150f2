"""Resharding that moves the fewest bytes, by a minimum-cost flow.

The old shards are folders of files. Their rows fall into blocks by a hash of key
and content, at most ``BLOCKS`` per shard. From the old shards' sizes and the new
shards' capacities a minimum-cost flow (cost 0 for bytes that stay, 1 for bytes
that move, or costs of the caller's) says how many bytes go from which old shard to
which new one; each old shard's blocks are dealt to its targets to meet the flow.
Files of shards that lose nothing stay as they are, new ones are added beside
them; files of shards that lose a block are rewritten.

The flow has a node per shard and is solved on the driver; the block table has at
most ``old shards * BLOCKS`` rows whatever the corpus, so it may be collected and
broadcast. No text is shuffled: tasks write what they read into shard folders.
A shard is balanced to within about one block per target. A row larger than a
block is its own limit.

Edge cases: a null text has size 1, as an empty one; null keys and sources hash
like any value; equal rows may share a block but keep their own slots. An empty
table gives empty shards. Extra columns travel with the rows; the names
``__shard`` and ``__block`` are reserved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.shared import fresh_path

BLOCKS = 4096


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Units from each source to each sink at the least total cost.

    Successive shortest paths with whole units; the capacities must hold the
    supplies. One pass settles a source or a sink, so there are few passes.
    """
    m, n = len(supply), len(capacity)
    flow = [[0] * n for _ in range(m)]
    left, room = list(supply), list(capacity)
    if sum(left) > sum(room):
        raise ValueError("the new shards cannot hold the old ones")
    while any(left):
        # Bellman-Ford over sources 0..m-1 and sinks m..m+n-1 of the residual net.
        dist = [0 if left[i] else None for i in range(m)] + [None] * n
        back: list[int | None] = [None] * (m + n)
        for _ in range(m + n):
            changed = False
            for i in range(m):
                for j in range(n):
                    if dist[i] is not None and (dist[m + j] is None or dist[i] + cost[i][j] < dist[m + j]):
                        dist[m + j], back[m + j], changed = dist[i] + cost[i][j], i, True
                    if flow[i][j] and dist[m + j] is not None:
                        if dist[i] is None or dist[m + j] - cost[i][j] < dist[i]:
                            dist[i], back[i], changed = dist[m + j] - cost[i][j], m + j, True
            if not changed:
                break
        end = min((j for j in range(n) if room[j] and dist[m + j] is not None), key=lambda j: (dist[m + j], j))
        path, node = [], m + end
        while back[node] is not None:
            path.append((back[node], node))
            node = back[node]
        amount = min([left[node], room[end], *(flow[b][a - m] for a, b in path if a >= m)])
        for a, b in path:
            if a < m:
                flow[a][b - m] += amount
            else:
                flow[b][a - m] -= amount
        left[node] -= amount
        room[end] -= amount
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def deal_blocks(blocks: list[tuple[int, int, int]], flow: list[list[int]]) -> dict[tuple[int, int], int]:
    """New shard of each (old shard, block), given blocks with their sizes.

    Along an old shard's blocks, the targets take stretches as long as their flow,
    the old shard's own number first; a block belongs where its middle lies.
    """
    by_shard: dict[int, list[tuple[int, int]]] = {}
    for shard, block, size in sorted(blocks):
        by_shard.setdefault(shard, []).append((block, size))
    target: dict[tuple[int, int], int] = {}
    for shard, own in by_shard.items():
        order = sorted((j for j in range(len(flow[shard])) if flow[shard][j]), key=lambda j: (j != shard, j))
        place, at, end = 0, 0, flow[shard][order[0]]
        for block, size in own:
            while place < len(order) - 1 and at + size / 2 > end:
                place += 1
                end += flow[shard][order[place]]
            target[shard, block] = order[place]
            at += size
    return target


@dataclass
class Layout:
    """Shard folders of one or two roots: files that stayed, files rewritten."""

    kept: DataFrame
    rewritten: DataFrame | None = None

    @property
    def rows(self) -> DataFrame:
        """All rows, with their shard in ``__shard``."""
        return self.kept if self.rewritten is None else self.kept.unionByName(self.rewritten)


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def write_layout(docs: DataFrame, shard: Column, key: str = "doc_id", text: str = "text") -> Layout:
    """The rows as files in a folder per shard; the shard is a whole number."""
    spark = docs.sparkSession
    block = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(BLOCKS)).cast("int")
    marked = docs.withColumns({"__block": block, "__shard": shard.cast("int")})
    path = fresh_path(spark, "shards")
    marked.write.partitionBy("__shard").parquet(path)
    return Layout(_files(spark, path, marked))


def _files(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(like.columns)


def reshard(
    layout: Layout, old: int, new: int, size: Column, capacities: list[int] | None = None, cost: list[list[int]] | None = None
) -> Layout:
    """The layout over ``new`` shards, from one over ``old`` shards."""
    spark, rows = layout.rows.sparkSession, layout.rows
    sizes = rows.groupBy("__shard", "__block").agg(F.sum(size).alias("bytes")).collect()
    blocks = [(r["__shard"], r["__block"], r["bytes"]) for r in sizes]
    supply = [0] * old
    for shard, _, held in blocks:
        supply[shard] += held
    capacities = capacities or even_capacities(sum(supply), new)
    cost = cost or [[int(i != j) for j in range(new)] for i in range(old)]
    target = deal_blocks(blocks, min_cost_flow(supply, capacities, cost))
    losing = sorted({shard for (shard, _), to in target.items() if to != shard})
    if not losing:
        return layout
    moves = spark.createDataFrame(
        [(shard, block, to) for (shard, block), to in target.items() if shard in losing],
        "__shard int, __block int, __to int",
    )
    affected = rows.filter(F.col("__shard").isin(losing)).join(F.broadcast(moves), ["__shard", "__block"])
    moved = affected.withColumn("__shard", F.col("__to")).select(rows.columns)
    path = fresh_path(spark, "resharded")
    moved.write.partitionBy("__shard").parquet(path)
    return Layout(rows.filter(~F.col("__shard").isin(losing)), _files(spark, path, rows))


def with_slots(layout: Layout, narrow: DataFrame, order: list[str]) -> DataFrame:
    """Add a gapless ``__slot`` from 0 per shard to columns taken from the layout.

    ``narrow`` keeps ``__shard`` and ``__block``. Rows are ranked within their
    block; the rows of the blocks before it come from the block table, which has
    at most ``shards * BLOCKS`` rows. No shard is ever sorted in one task.
    """
    counts = layout.rows.groupBy("__shard", "__block").count()
    before = Window.partitionBy("__shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__shard", "__block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    rank = F.row_number().over(Window.partitionBy("__shard", "__block").orderBy(*order)) - 1
    ranked = narrow.withColumn("__rank", rank).join(F.broadcast(starts), ["__shard", "__block"])
    return ranked.withColumn("__slot", (F.col("__start") + F.col("__rank")).cast("bigint"))
