"""Merkle manifest of a dataset: one tree per language over its documents, one tree over the languages' roots.

Leaves get their places by ranges: rows are sorted by tree and key over all tasks, and one row per task and tree says how
many came before. Every 1,024 consecutive nodes of a tree are a superblock. On the way up superblocks are reduced to one
node each, level by level, until every tree has one node. On the way down each superblock receives one row with the outer
nodes its members need, and nodes and outer nodes are cogrouped by superblock: there the reduction within the block is
finished, its siblings are put before the outer ones, and at the leaves the proof is folded. No task sees more than a superblock.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.common import discard, ship, table

#: Levels of a superblock, which holds two to that many nodes; one step climbs so many.
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Ids go through tasks as text: whole numbers beside nulls would not stay whole there.
PROOFS = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value):
    """Byte count, colon and value, so that fields cannot run into each other; a lone dash for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, claim) per row: the hash of the row, and the hash of the same row with ``n_chars`` one higher where 7
    divides the CRC of its id (the row as it is otherwise). ``tree`` orders languages, null first, then by their bytes."""
    fields = {c: F.col(f"`{c}`") for c in FIELDS}
    tampered = fields | {"n_chars": F.when(F.crc32(fields["doc_id"].cast("string").cast("binary")) % 7 == 0, fields["n_chars"].cast("decimal(20,0)") + 1)
                         .otherwise(fields["n_chars"].cast("decimal(20,0)"))}
    leaf, claim = (F.sha2(F.concat(*(_field(x[c]) for c in FIELDS)), 256) for x in (fields, tampered))
    tree = F.when(fields["lang"].isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), fields["lang"].cast("string")))
    return docs.select(tree.alias("tree"), fields["doc_id"].alias("doc_id"), leaf.alias("leaf"), claim.alias("claim"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """A written table of ``rows`` with ``pos``, the place from 0 within its ``tree`` by ``order`` (nulls first), and ``n``, the size
    of the tree.

    Rows are dealt by ranges of (tree, order, task they come from), so that neither a large tree nor a repeated key meets in one
    task; rows alike in all of these columns but the last take their places in any order.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in ["tree", *order, "__tie"]]
    # Equal rows are told apart by the task they come from, which stays the same when a task is run again.
    laid = table(rows.withColumn("__tie", F.spark_partition_id()).repartitionByRange(parts, *by).sortWithinPartitions(*by)
                 .drop("__tie").withColumn("__at", F.monotonically_increasing_id()), "laid")
    part = F.shiftright("__at", 33)  # the task that wrote the row; the lower bits count its rows
    runs = laid.groupBy("tree", part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    of_tree = Window.partitionBy("tree")  # one row per task that has rows of the tree
    starts = table(runs.select("tree", "__part", "__first",
                               (F.sum("__rows").over(of_tree.orderBy("__part")) - F.col("__rows")).alias("__start"),
                               F.sum("__rows").over(of_tree).alias("n")), "starts")
    placed = laid.withColumn("__part", part).join(starts, ["tree", "__part"])
    out = table(placed.withColumn("pos", F.col("__start") + F.col("__at") - F.col("__first")).drop("__part", "__at", "__first", "__start"), "placed")
    discard(laid)
    return out


def _heights(nodes: list[str], n: int, levels: int) -> list[list[str]]:
    """All levels over the consecutive nodes of a superblock: up to a single one if it is the whole tree of ``n``, else ``levels`` of them."""
    whole = n <= 1 << levels
    out = [nodes]
    while len(out[-1]) > 1 if whole else len(out) <= levels:
        last = out[-1]
        out.append([digest("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return out


def _siblings(levels: list[list[str]], at: int) -> list[str]:
    """What stands beside the path from node ``at`` to the top of ``levels``: L or R and the sibling, or nothing for a lone node."""
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append(("L" if other < at else "R") + level[other] if other < len(level) else "")
        at >>= 1
    return out


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and the siblings on its path give."""
    for sibling in path:
        side, other = sibling[:1], sibling[1:]
        leaf = digest(other + leaf if side == "L" else leaf + other)
    return leaf


def climb(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Written steps (tree, pos, n, node) from ``nodes`` up, ``levels`` levels each, the last with one node per tree."""
    def top(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        n, place = int(block["n"].iloc[0]), int(block["pos"].iloc[0]) >> levels
        node = _heights(block["node"].tolist(), n, levels)[-1][0]
        return pd.DataFrame({"tree": block["tree"].iloc[:1], "pos": [place], "n": [-(-n >> levels)], "node": [node]})

    steps = [nodes]
    while (steps[-1].agg(F.max("n")).first()[0] or 0) > 1:
        steps.append(table(steps[-1].select("tree", "pos", "n", "node").groupBy("tree", F.shiftright("pos", levels).alias("block"))
                           .applyInPandas(top, "tree string, pos long, n long, node string"), "level"))
    return steps


OUTER = "tree string, pos long, path array<string>, subroot string, root string"


def exchange(nodes: DataFrame, outer: DataFrame, result, schema: str, levels: int = LEVELS) -> DataFrame:
    """Cogroup nodes with the outer nodes of their superblocks (``OUTER``, one row each) and finish within the superblock.

    ``result`` makes rows of ``schema`` from the nodes in order, the siblings on the path of each up to the root, and the outer row.
    """
    def run(block: pd.DataFrame, beyond: pd.DataFrame) -> pd.DataFrame:
        block, beyond = block.sort_values("pos"), beyond.iloc[0]
        heights = _heights(block["node"].tolist(), int(block["n"].iloc[0]), levels)
        return result(block, [_siblings(heights, i) + list(beyond["path"]) for i in range(len(block))], beyond)

    left = nodes.withColumn("block", F.shiftright("pos", levels)).groupBy("tree", "block")
    return left.cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(run, schema)


def descend(steps: list[DataFrame], outer: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Outer nodes of the superblocks of the lowest step, from those of whole trees (``OUTER``, pos 0)."""
    for nodes in reversed(steps[1:]):
        outer = table(exchange(nodes.select("tree", "pos", "n", "node"), outer, _inner, OUTER, levels), "outer")
    return outer


def _inner(block: pd.DataFrame, paths: list[list[str]], beyond: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"tree": block["tree"], "pos": block["pos"], "path": paths, "subroot": beyond["subroot"], "root": beyond["root"]})


def _languages(block: pd.DataFrame, paths: list[list[str]], beyond: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"tree": block["name"], "pos": 0, "path": paths, "subroot": block["node"], "root": beyond["root"]})


def _proofs(block: pd.DataFrame, paths: list[list[str]], beyond: pd.Series) -> pd.DataFrame:
    folded = [fold(claim, path) for claim, path in zip(block["claim"], paths)]
    return pd.DataFrame({"doc_id": block["doc_id"], "leaf": block["node"], "subroot": beyond["subroot"], "root": beyond["root"],
                         "proof_sha256": [digest("".join(s[1:] for s in p)) for p in paths], "folded_root": folded,
                         "verified": [f == beyond["root"] for f in folded]})


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, lang, n_chars, text): leaf, subroot of its language, root, proof_sha256, and what folding
    the row as it is claimed (see ``leaves``) with the siblings gives: folded_root and verified.

    A null field is a dash of its own, so a null and an empty text differ. Rows with a null id come first in their language and
    are claimed as they are; rows with one id are ordered by their hashes; rows alike in everything have leaves of their own,
    side by side, with equal hashes and different proofs. A single row is its own root, with the proof of no siblings. An
    empty table gives no rows. Other columns are ignored, whatever they are called. ``levels`` sets the size of a superblock.
    """
    ship(docs.sparkSession)
    hashed = table(leaves(docs), "leaves")  # sorting reads its rows twice: texts are read and hashed once
    placed = numbered(hashed, ["doc_id", "leaf"]).withColumnRenamed("leaf", "node")
    discard(hashed)
    steps = climb(placed, levels)
    forest = numbered(steps[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node"), ["name"])
    above = climb(forest, levels)
    root = above[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.array().cast("array<string>").alias("path"),
                            F.lit("").alias("subroot"), F.col("node").alias("root"))
    trees = table(exchange(forest, descend(above, root, levels), _languages, OUTER, levels), "languages")
    found = exchange(placed.withColumn("doc_id", F.col("doc_id").cast("string")), descend(steps, trees, levels), _proofs, PROOFS, levels)
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def brute_sql() -> str:
    """DuckDB SQL for the query over documents: all levels by recursion, CRC bit by bit."""
    field = "case when {0} is null then '-' else strlen({0}::varchar) || ':' || {0}::varchar end"
    row = " || ".join(field.format(c) for c in FIELDS)
    changed = " || ".join(field.format(c if c != "n_chars" else "changed") for c in FIELDS)
    bit = "lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end"
    return f"""
with recursive bytes as (
  select doc_id, list_prepend(4294967295::bigint, [ord(c)::bigint for c in string_split(doc_id::varchar, '')]) as b from documents),
crc as (
  select distinct doc_id, xor(list_reduce(b, lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), {bit})), 4294967295) as crc from bytes),
hashed as (
  select d.doc_id, case when lang is null then '-' else '=' || lang end as tree, sha256({row}) as leaf, sha256({changed}) as claim
  from (select d.*, case when crc % 7 = 0 then n_chars + 1 else n_chars end as changed
        from documents d left join crc on crc.doc_id = d.doc_id) d),
placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n from hashed),
nodes as (
  select 0 as lvl, tree, pos, n, leaf as node from placed
  union all
  select lvl + 1, tree, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' order by pos)) from nodes where n > 1 group by lvl, tree, pos // 2, n),
subroots as (
  select tree, node as subroot, row_number() over (order by encode(tree)) - 1 as pos, count(*) over () as n from nodes where n = 1),
forest as (
  select 0 as lvl, pos, n, subroot as node from subroots
  union all
  select lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' order by pos)) from forest where n > 1 group by lvl, pos // 2, n),
walk as (
  select row_number() over () as id, doc_id, leaf, tree, 0 as lvl, pos, n, claim as hash, '' as proof from placed
  union all
  select w.id, w.doc_id, w.leaf, w.tree, w.lvl + 1, w.pos // 2, (w.n + 1) // 2,
    sha256(case when s.node is null then w.hash when s.pos < w.pos then s.node || w.hash else w.hash || s.node end), w.proof || coalesce(s.node, '')
  from walk w left join nodes s on s.lvl = w.lvl and s.tree = w.tree and s.pos = xor(w.pos, 1) where w.n > 1),
upper as (
  select w.id, w.doc_id, w.leaf, r.subroot, 0 as lvl, r.pos, r.n, w.hash, w.proof from walk w join subroots r on r.tree = w.tree where w.n = 1
  union all
  select u.id, u.doc_id, u.leaf, u.subroot, u.lvl + 1, u.pos // 2, (u.n + 1) // 2,
    sha256(case when s.node is null then u.hash when s.pos < u.pos then s.node || u.hash else u.hash || s.node end), u.proof || coalesce(s.node, '')
  from upper u left join forest s on s.lvl = u.lvl and s.pos = xor(u.pos, 1) where u.n > 1)
select u.doc_id, u.leaf, u.subroot, f.node as root, sha256(u.proof) as proof_sha256, u.hash as folded_root, u.hash = f.node as verified
from upper u, (select node from forest where n = 1) f where u.n = 1
"""
