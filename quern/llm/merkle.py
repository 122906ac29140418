"""Merkle manifest of a dataset by slot pivots.

Rows stand in line within their group. A round spreads the children of ``FAN ** depth`` places into columns, one
conditional aggregate per slot, and hashes columns of a run together, level by level, until one column is left, which is
a child in the next round. The columns of a run without a node's own are its siblings; they come down from the root the
way they went up. Only the pivoted rows of a round are shuffled, a group of any size is spread over all tasks, and the
number of rounds grows with the logarithm of the largest group.

Nulls: a null field is ``-`` in the leaf, null groups come first, null keys come first in their group. Rows with equal
keys stand in the order of their leaves; repeated rows are one node each, counted before they are sorted. An empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import key_of, written

#: Children of a node.
FAN = 2
#: Levels hashed in one round; its pivot has ``FAN ** DEPTH`` columns.
DEPTH = 4

PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts, one behind the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field of a leaf: byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*(field(v) for v in values))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, e: digest(e["before"], h, e["after"]))


def siblings_of(path: Column) -> Column:
    """All digests of a path in order, as one text."""
    return F.array_join(F.transform(path, lambda e: F.concat(e["before"], e["after"])), "")


def places(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Each row with ``_q_pos``, its place in its group in ``order``, and ``_q_m``, the rows of the group.

    Equal rows are counted first. The distinct ones are sorted by ranges over all tasks, so neither a hot group nor a
    hot key meets in one task, and written; a part of the sorted table and a group share one running count.
    """
    n = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_q_n"))
    lined = n.orderBy(group, *order).withColumn("_q_id", F.monotonically_increasing_id())
    lined = written(lined, "lined").withColumn("_q_part", F.shiftright("_q_id", 33))
    totals = lined.groupBy(group, "_q_part").agg(F.sum("_q_n").alias("_q_t"))
    mine = Window.partitionBy(group)
    before = mine.orderBy("_q_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        group, "_q_part", F.coalesce(F.sum("_q_t").over(before), F.lit(0)).alias("_q_off"), F.sum("_q_t").over(mine).alias("_q_m")
    )
    inside = Window.partitionBy(group, "_q_part").orderBy("_q_id").rowsBetween(Window.unboundedPreceding, 0)
    put = lined.withColumn("_q_run", F.sum("_q_n").over(inside) - F.col("_q_n")).join(starts, [group, "_q_part"])
    start = F.col("_q_off") + F.col("_q_run")
    every = put.withColumn("_q_pos", F.explode(F.sequence(start, start + F.col("_q_n") - 1)))
    return every.select(*rows.columns, "_q_pos", "_q_m")


@dataclass
class Tree:
    """The pivoted rounds from the leaves up, and the one node that is left of each group."""

    group: str
    rounds: list[DataFrame]
    tops: DataFrame


def _at(level: int, i: int) -> str:
    return f"h{level}_{i}"


def _nodes(level: int) -> str:
    """Nodes of the group ``level`` levels above those of the round."""
    run = FAN**level
    return f"(_q_m + {run - 1}) DIV {run}"


def _pivot(nodes: DataFrame, group: str, carried: str | None) -> DataFrame:
    """A round: ``group, _q_up``, a column per slot and level, and with ``carried`` the rows of the slots."""
    radix = FAN**DEPTH
    put = [("_q_h", [_at(0, s) for s in range(radix)])] + ([(carried, [f"r{s}" for s in range(radix)])] if carried else [])
    spread = [
        F.expr(f"first(CASE WHEN _q_pos % {radix} = {s} THEN {c} END, true)").alias(name) for c, names in put for s, name in enumerate(names)
    ]
    wide = nodes.groupBy(group, F.expr(f"_q_pos DIV {radix}").alias("_q_up")).agg(F.first("_q_m").alias("_q_m"), *spread)
    for level in range(DEPTH):
        made = []
        for i in range(FAN ** (DEPTH - level - 1)):
            run = [_at(level, i * FAN + j) for j in range(FAN)]
            joined = ", ".join(f"coalesce({c}, '')" for c in run)
            made.append(
                f"CASE WHEN {_nodes(level)} = 1 OR {run[0]} IS NULL THEN {run[0]} ELSE sha2(concat({joined}), 256) END AS {_at(level + 1, i)}"
            )
        wide = wide.selectExpr("*", *made)
    return wide


def build_tree(placed: DataFrame, group: str, leaf: str, carried: Sequence[str] = ()) -> Tree:
    """The tree over each group of a table of :func:`places`, with the columns ``carried`` kept beside the leaves."""
    most = placed.agg(F.max("_q_m")).first()[0] or 0
    nodes = placed.select(group, "_q_pos", "_q_m", F.col(leaf).alias("_q_h"), F.struct(*carried).alias("_q_row"))
    row: str | None = "_q_row"
    rounds = []
    while not rounds or most > 1:
        rounds.append(written(_pivot(nodes, group, row), f"round{len(rounds)}"))
        nodes = rounds[-1].select(
            group, F.col("_q_up").alias("_q_pos"), F.expr(_nodes(DEPTH)).alias("_q_m"), F.col(_at(DEPTH, 0)).alias("_q_h")
        )
        most, row = -(-most // FAN**DEPTH), None
    return Tree(group, rounds, nodes.select(group, F.col("_q_h").alias("_q_top")))


def _path(slot: int) -> str:
    """The path of a slot to the top of its round: the run's other columns at every level that was hashed."""
    steps = []
    for level in range(DEPTH):
        own = slot // FAN**level
        first = own - own % FAN
        before = ", ".join(["''", *(_at(level, i) for i in range(first, own))])
        after = ", ".join(["''", *(_at(level, i) for i in range(own + 1, first + FAN))])
        step = f"array(struct(concat_ws('', {before}) AS before, concat_ws('', {after}) AS after))"
        steps.append(f"CASE WHEN {_nodes(level)} > 1 THEN {step} ELSE CAST(array() AS {PATH}) END")
    return f"concat({', '.join(steps)})"


def _slots(leaves: bool) -> str:
    """The slots of a round as an array: number, whether there is a node, its path and, beside leaves, its row."""
    row = ", r{s} AS row" if leaves else ""
    slots = (f"struct({s} AS s, {_at(0, s)} IS NOT NULL AS is, {_path(s)} AS steps{row.format(s=s)})" for s in range(FAN**DEPTH))
    return f"array({', '.join(slots)})"


def paths_down(tree: Tree, tops: DataFrame, kept: Sequence[str]) -> DataFrame:
    """``group``, the columns carried with the leaves, ``kept`` and ``path`` of every leaf.

    ``tops`` gives each group its columns ``kept`` and ``path``, from its top to whatever stands above it.
    """
    g = tree.group
    above = tops.select(g, F.lit(0).cast("long").alias("_q_up"), *kept, "path")
    for wide in reversed(tree.rounds):
        leaves = "r0" in wide.columns
        slot = F.explode_outer(F.expr(_slots(leaves))).alias("_q_slot")
        met = wide.join(above, [g, "_q_up"]).select(g, "_q_up", *kept, "path", slot)
        met = met.filter("_q_slot.is").withColumn("path", F.concat("_q_slot.steps", "path"))
        if leaves:
            return met.select(g, "_q_slot.row.*", *kept, "path")
        above = met.select(g, (F.col("_q_up") * FAN**DEPTH + F.col("_q_slot.s")).alias("_q_up"), *kept, "path")
    raise AssertionError("a tree has a round")


def manifest(rows: DataFrame, group: str, key: str, leaf: str) -> DataFrame:
    """Every row with ``subroot`` of its group, ``root`` and ``path``.

    ``path`` is an array of the digests before and after the own one at each level from the leaf to the root; see
    :func:`fold`. A group is the tree over its leaves in the order of ``key``, a number; the root is that over the groups
    in the order of their names, null first. Columns called ``subroot``, ``root`` or ``path`` are replaced.
    """
    rows = rows.drop("subroot", "root", "path")
    own = rows.columns
    placed = written(places(rows.withColumn("_q_g", key_of(group)), "_q_g", [key, leaf]), "placed")
    tree = build_tree(placed, "_q_g", leaf, own)
    tops = written(tree.tops.withColumn("_q_all", F.lit(0)), "tops")
    above = build_tree(written(places(tops, "_q_all", ["_q_g"]), "placed"), "_q_all", "_q_top", ["_q_g", "_q_top"])
    roots = above.tops.select("_q_all", F.col("_q_top").alias("root"), F.array().cast(PATH).alias("path"))
    groups = paths_down(above, roots, ["root"]).withColumnRenamed("_q_top", "subroot").drop("_q_all")
    groups = written(groups, "subroots")
    return paths_down(tree, groups, ["subroot", "root"]).select(*own, "subroot", "root", "path")


def _leaf_sql(n_chars: str) -> str:
    fields = (f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({c}::VARCHAR), ':', {c}) END" for c in ("doc_id", "source", "lang", n_chars, "text"))
    return f"sha256(concat({', '.join(fields)}))"


#: CRC-32 of the digits of an id, bit by bit.
CRC_SQL = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b: list_reduce(
  range(9), lambda r, k: CASE WHEN k = 0 THEN r WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(c, b)), 4294967295), 4294967295)"""

#: Every level of every group, and of the groups themselves, joins the level below on the parent's place.
ORACLE = f"""WITH RECURSIVE f AS MATERIALIZED (SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf, CASE WHEN n_chars IS NOT NULL AND {CRC_SQL} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')} END AS tampered FROM documents),
g AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS grp FROM f),
up AS (SELECT 0 AS lvl, grp, pos, leaf AS h, count(*) OVER (PARTITION BY grp) AS m FROM g
  UNION ALL SELECT lvl + 1, grp, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(m) + 1) // 2 FROM up WHERE m > 1 GROUP BY lvl, grp, pos // 2),
nodes AS MATERIALIZED (SELECT * FROM up),
subs AS MATERIALIZED (SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS m FROM nodes WHERE m = 1),
top AS (SELECT 0 AS lvl, pos, h, m FROM subs UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(m) + 1) // 2 FROM top WHERE m > 1 GROUP BY lvl, pos // 2),
tops AS MATERIALIZED (SELECT * FROM top),
walk AS (SELECT doc_id, leaf, grp, FALSE AS above, 0 AS lvl, pos, '' AS proof, tampered AS folded FROM g
  UNION ALL SELECT doc_id, leaf, w.grp, CASE WHEN above THEN TRUE ELSE n.m = 1 END, CASE WHEN NOT above AND n.m = 1 THEN 0 ELSE w.lvl + 1 END,
    CASE WHEN above THEN w.pos // 2 WHEN n.m = 1 THEN s.pos ELSE w.pos // 2 END,
    CASE WHEN NOT above AND n.m = 1 THEN proof ELSE proof || coalesce(CASE WHEN above THEN tb.h ELSE nb.h END, '') END,
    CASE WHEN NOT above AND n.m = 1 THEN folded WHEN w.pos % 2 = 0 THEN sha256(folded || coalesce(CASE WHEN above THEN tb.h ELSE nb.h END, ''))
      ELSE sha256(CASE WHEN above THEN tb.h ELSE nb.h END || folded) END
  FROM walk w LEFT JOIN nodes n ON NOT above AND n.grp = w.grp AND n.lvl = w.lvl AND n.pos = w.pos
    LEFT JOIN nodes nb ON NOT above AND nb.grp = w.grp AND nb.lvl = w.lvl AND nb.pos = xor(w.pos, 1)
    LEFT JOIN subs s ON s.grp = w.grp
    LEFT JOIN tops t ON above AND t.lvl = w.lvl AND t.pos = w.pos LEFT JOIN tops tb ON above AND tb.lvl = w.lvl AND tb.pos = xor(w.pos, 1)
  WHERE NOT (above AND t.m = 1)),
ends AS (SELECT w.*, t.h AS root FROM walk w JOIN tops t ON above AND t.lvl = w.lvl AND t.m = 1)
SELECT doc_id, leaf, subs.h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM ends JOIN subs USING (grp)"""
