"""Resharding by minimum-cost flow: the fewest bytes leave their shard, and only affected shards are rewritten."""

from __future__ import annotations

import heapq
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import running_totals, size_level, written
from quern.session import scratch_dir

ROW_BYTES = 16
#: Old shards are single files or, when there are more files, runs of neighbouring ones.
MAX_OLD = 256
#: Rows above this part of a shard are placed one by one; there are at most PART times the shards of them.
PART = 64
#: A shard is written in files of about this many bytes of text.
FILE_BYTES = 64 << 20


def min_cost_flow(supply: list[int], room: list[int], cost: Callable[[int, int], int]) -> dict[tuple[int, int], int]:
    """Bytes to send from each old to each new shard at the least total cost; the room must hold the supply.

    Successive shortest paths with potentials over source, old shards, new shards and sink. It runs on totals per
    shard, so its size is the number of shards, never that of rows.
    """
    n, m = len(supply), len(room)
    if sum(room) < sum(supply):
        raise ValueError("the new shards cannot hold what the old ones have")
    source, sink, nodes = n + m, n + m + 1, n + m + 2
    arcs: list[list[int]] = []  # target, capacity left, cost; arc k ^ 1 is the way back
    leaving: list[list[int]] = [[] for _ in range(nodes)]

    def add(a: int, b: int, capacity: int, price: int) -> None:
        leaving[a].append(len(arcs))
        arcs.append([b, capacity, price])
        leaving[b].append(len(arcs))
        arcs.append([a, 0, -price])

    for i in range(n):
        add(source, i, supply[i], 0)
    for j in range(m):
        add(n + j, sink, room[j], 0)
    for i in range(n):
        for j in range(m):
            add(i, n + j, sum(supply), cost(i, j))
    level = [0] * nodes
    while True:
        far: list[float] = [float("inf")] * nodes
        by = [-1] * nodes
        far[source] = 0
        queue: list[tuple[float, int]] = [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for k in leaving[a]:
                b, left, price = arcs[k]
                step = d + price + level[a] - level[b]
                if left and step < far[b]:
                    far[b], by[b] = step, k
                    heapq.heappush(queue, (step, b))
        if by[sink] < 0:
            break
        top = max(d for d in far if d < float("inf"))
        level = [x + int(min(d, top)) for x, d in zip(level, far, strict=True)]
        path, b = [], sink
        while b != source:
            path.append(by[b])
            b = arcs[by[b] ^ 1][0]
        push = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= push
            arcs[k ^ 1][1] += push
    flow = {}
    for i in range(n):
        for k in leaving[i]:
            b = arcs[k][0]
            if n <= b < n + m and k % 2 == 0 and arcs[k ^ 1][1]:
                flow[i, b - n] = arcs[k ^ 1][1]
    return flow


def moving_cost(old: int, new: int) -> int:
    return int(old != new)


def located(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The table at ``path`` with ``old_shard`` (its files in the order of their names), ``_q_tie`` (a digest of the
    row's place) and ``size``; and the number of old shards."""
    docs = spark.read.parquet(path)
    docs = docs.drop("old_shard", "size", "shard", "slot")
    place = docs.select("*", F.col("_metadata.file_path").alias("_q_file"), F.col("_metadata.row_index").alias("_q_row"))
    names = place.groupBy("_q_file").agg(F.lit(1).alias("one")).select("_q_file")
    ranked = names.withColumn("_q_n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_q_file")) - 1)
    ranked = written(ranked, "files")  # a row per file
    n_files = ranked.count()
    n_old = max(1, min(MAX_OLD, n_files))
    run = lambda n: F.floor(n.cast("long") * n_old / F.lit(max(1, n_files)))
    first = (F.col("_q_n") == 0) | (run(F.col("_q_n")) > run(F.col("_q_n") - 1))
    starts = sorted(r["_q_file"] for r in ranked.filter(first).select("_q_file").collect())  # a name per old shard
    old = F.size(F.filter(F.array(*map(F.lit, starts)), lambda s: s <= F.col("_q_file"))) - 1 if starts else F.lit(0)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    out = place.withColumns({"old_shard": old.cast("int"), "size": size})
    return out.withColumn("_q_tie", F.md5(F.concat_ws(":", "_q_file", "_q_row"))).drop("_q_file", "_q_row"), n_old


def place_large(large: list, n_new: int, cap: list[int]) -> tuple[list[int], list[int]]:
    """Shards of the large rows ``(old, size)``, largest first: their own where it has room, else the emptiest one."""
    used, to = [0] * n_new, []
    for old, size in large:
        j = old if old < n_new and used[old] + size <= cap[old] else min(range(n_new), key=lambda x: (used[x] - cap[x], x))
        used[j] += size
        to.append(j)
    return to, used


def reshard_plan(docs: DataFrame, n_old: int, n_new: int, cost: Callable[[int, int], int] = moving_cost) -> DataFrame:
    """Add ``shard`` to rows with ``old_shard, size, _q_tie``, so that shard sizes are near equal and few bytes move.

    Rows above 1/64 of a new shard, at most 64 per shard, are placed one by one. The other rows follow the flow from
    old sizes to the room left: rows of an old shard stand in one line, larger ones first, and each transfer takes the
    stretch of the line that its bytes reach. Where the stretches begin is all that is looked up, at most one row per
    transfer; the texts themselves are not sorted or joined for it.
    """
    level = (-size_level(F.col("size"))).cast("long")
    line = docs.select("old_shard", "size", F.col("_q_tie").alias("_q_place"), level.alias("_q_lv"))
    total, n = docs.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    cap = [total // n_new + (j < total % n_new) for j in range(n_new)]
    is_large = F.col("size") * (n_new * PART) > total
    large = line.filter(is_large).orderBy(F.col("size").desc(), "_q_place").limit(n_new * PART).collect()
    to, used = place_large([(r["old_shard"], r["size"]) for r in large], n_new, cap)
    small = line.filter(~is_large)
    have = [0] * n_old
    for r in small.groupBy("old_shard").agg(F.sum("size").alias("s")).collect():
        have[r["old_shard"]] = r["s"]
    room = [max(0, c - u) for c, u in zip(cap, used, strict=True)]
    short = sum(have) - sum(room)
    room = [r + max(0, short) // n_new + (j < max(0, short) % n_new) for j, r in enumerate(room)]
    flow = min_cost_flow(have, room, cost)
    spark = docs.sparkSession
    stretches, at = [], [0] * n_old
    for i, j in sorted(flow, key=lambda x: (x[0], x[1] != x[0], x[1])):
        stretches.append((i, j, at[i], at[i] + flow[i, j]))
        at[i] += flow[i, j]
    bounds = spark.createDataFrame(stretches, "old_shard int, shard int, lo long, hi long")
    lined = running_totals(small, ["old_shard"], F.col("_q_lv"), F.col("_q_place"), {"_q_end": F.col("size")}, n).alias("l")
    middle = F.col("_q_end") * 2 - F.col("size")
    inside = (middle >= F.col("lo") * 2) & (middle < F.col("hi") * 2)
    first = lined.join(F.broadcast(bounds).alias("b"), (F.col("l.old_shard") == F.col("b.old_shard")) & inside)
    cuts = first.groupBy(F.col("l.old_shard").alias("old_shard"), "shard").agg(F.min(F.struct("_q_lv", "_q_place")).alias("k"))
    cuts = cuts.groupBy("old_shard").agg(F.sort_array(F.collect_list(F.struct("k", "shard"))).alias("_q_cuts"))
    cuts = written(cuts, "cuts")  # a row per old shard; the cuts are at most one per transfer
    ones = spark.createDataFrame([(r["_q_place"], j) for r, j in zip(large, to, strict=True)], "_q_tie string, _q_one int")
    out = docs.withColumn("_q_lv", level).join(F.broadcast(cuts), "old_shard", "left").join(F.broadcast(ones), "_q_tie", "left")
    mine = F.struct(F.col("_q_lv"), F.col("_q_tie").alias("_q_place"))
    past = F.filter("_q_cuts", lambda c: c["k"] <= mine)
    shard = F.coalesce(F.col("_q_one"), F.try_element_at(past, F.lit(-1))["shard"], F.col("_q_cuts")[0]["shard"])
    return out.withColumn("shard", shard.cast("int")).drop("_q_lv", "_q_cuts", "_q_one")


def with_slots(placed: DataFrame, n_new: int) -> DataFrame:
    """Add ``slot``: rows of a shard are numbered from 0 without gaps.

    A shard is cut into slices by the rows' digests; the counts of slices give each slice its first slot, joined by the
    slices that rows are numbered in, so rows are shuffled once.
    """
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slices = max(4, -(-total // (n_new * FILE_BYTES)))
    cut = F.floor(F.conv(F.substring("_q_tie", 1, 8), 16, 10).cast("long") * slices / F.lit(2**32)).cast("int")
    sliced = placed.withColumn("_q_slice", cut)
    before = Window.partitionBy("shard").orderBy("_q_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy("shard", "_q_slice").agg(F.count("*").alias("_q_n"))
    starts = counts.select("shard", "_q_slice", F.coalesce(F.sum("_q_n").over(before), F.lit(0)).alias("_q_first"))
    starts = written(starts, "slots")
    within = Window.partitionBy("shard", "_q_slice").orderBy("_q_tie")
    out = sliced.withColumn("_q_at", F.row_number().over(within) - 1).join(starts.hint("merge"), ["shard", "_q_slice"])
    return out.withColumn("slot", F.col("_q_first") + F.col("_q_at")).drop("_q_first", "_q_at", "_q_slice")


def reshard_files(spark: SparkSession, path: str, n_new: int, out: str | None = None, cost: Callable[[int, int], int] = moving_cost) -> DataFrame:
    """Move the rows of a Parquet table into ``n_new`` shards and read the new layout back.

    Returns the table's columns and ``old_shard, size, shard, slot``. Shards that lose and gain rows are rewritten below
    ``out`` (a folder per shard); a shard that keeps exactly its old rows stays where it is. A row's size is the UTF-8
    length of its text (null: 0) plus 16. Shard sizes differ from their mean by about a row of 1/64 of it at each end
    of a stretch. Rows are told apart by their place, so nulls, ties and repeated rows are rows like others; columns
    called as those added are replaced; an empty table gives no rows.
    """
    docs, n_old = located(spark, path)
    placed = reshard_plan(docs, n_old, n_new, cost)
    moved = placed.groupBy("old_shard", "shard").count().collect()  # at most old times new shards
    affected = {r["shard"] for r in moved if r["shard"] != r["old_shard"]} | {r["old_shard"] for r in moved if r["shard"] != r["old_shard"]}
    slotted = with_slots(placed, n_new).drop("_q_tie")
    out = out or scratch_dir(spark, "shards")
    rewritten = slotted.filter(F.col("shard").isin(sorted(affected))) if affected else slotted.limit(0)
    rewritten.write.partitionBy("shard").parquet(out)
    back = spark.read.schema(slotted.schema).parquet(out) if affected else slotted.limit(0)
    untouched = slotted.filter(~F.col("shard").isin(sorted(affected))) if affected else slotted
    if affected >= {r["shard"] for r in moved}:
        return back
    return back.unionByName(untouched)
