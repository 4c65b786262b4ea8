"""Merkle manifest of a dataset by time-forward processing over blocks of its trees."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import saved

#: Children of a node.
FAN = 8
#: What a node's block and the reversed sweep hand down: the runs above a node, from the nearest on, and the two roots.
ABOVE = "tree string, pos long, path array<struct<slot:int,run:string>>, subroot string, root string"
#: A path while it is swept: (slot, digests of the run, path above), shared by all nodes of a run.
Path = tuple[int, str, "Path | None"]


def digest_of(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its length in front, so that no two rows read alike; null is a dash."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def tree_name(value: Column) -> Column:
    """A name that is never null and sorts as value does bytewise, null first."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), text))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes, with a column tree, and their place `pos` among the n nodes of their tree; written to the shared folder.

    Rows are dealt by ranges of (tree, order), so that a tree with most rows lies in many tasks; each task numbers the
    rows of its range, and a table of one row a range and tree says how many lie before.
    """
    tied = nodes.withColumn("_tie", F.monotonically_increasing_id())
    by = ["tree", *order, "_tie"]
    ranges = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for tree in batch.column("tree").to_pylist():
                place = place + 1 if tree == last else 0
                last = tree
                places.append(place)
            own = [pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, "part", "place"])

    columns = ", ".join(f"`{c}` {kind}" for c, kind in ranges.dtypes)
    placed = saved(ranges.mapInArrow(number, f"{columns}, part int, place long"))
    sizes = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = F.expr("coalesce(sum(rows) OVER (PARTITION BY tree ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    sizes = saved(sizes.select("tree", "part", before.alias("before"), F.expr("sum(rows) OVER (PARTITION BY tree)").alias("n")))
    return placed.join(sizes, ["tree", "part"]).select(*ranges.columns, (F.col("before") + F.col("place")).alias("pos"), "n")


def level_sizes(nodes: int, most: int, climb: int) -> list[int]:
    """Nodes on each level of a block of `climb` levels, from its own nodes up; a tree of `most` nodes may end below."""
    sizes = [nodes]
    while len(sizes) <= climb and most > 1:
        sizes.append(-(-sizes[-1] // FAN))
        most = -(-most // FAN)
    return sizes


def forward(digests: list[str], most: int, climb: int) -> tuple[str, list[str]]:
    """(digest of the block's top, joined runs of its inner nodes by label) of a block of a tree with `most` nodes on this level.

    Nodes are labelled level by level, so every child comes before its parent. A queue ordered by label holds the
    digests that children have sent; a node is made when its messages are the smallest ones, and sends its own on.
    """
    sizes = level_sizes(len(digests), most, climb)
    if len(sizes) == 1:
        return digests[0], []
    queue = [(i // FAN, i % FAN, d) for i, d in enumerate(digests)]  # in order, so it is a heap
    runs: list[str] = []
    first, level = 0, 1  # label of the first inner node of the level
    while True:
        label, run = queue[0][0], []
        while queue and queue[0][0] == label:
            run.append(heapq.heappop(queue)[2])
        runs.append("".join(run))
        own = digest_of(runs[-1])
        while label - first >= sizes[level]:
            first += sizes[level]
            level += 1
        if level == len(sizes) - 1:
            return own, runs
        place = label - first
        heapq.heappush(queue, (first + sizes[level] + place // FAN, place % FAN, own))


def backward(runs: list[str], nodes: int, most: int, climb: int, above: Path | None) -> list[Path | None]:
    """The path of each of a block's nodes: the reversed sweep takes labels from the last on and hands a node's path to its children."""
    sizes = level_sizes(nodes, most, climb)
    if len(sizes) == 1:
        return [above] * nodes
    starts = [sum(sizes[1:k]) for k in range(1, len(sizes))]  # labels of the first inner node of each level above the lowest
    queue: list[tuple[int, Path | None]] = [(-(len(runs) - 1), above)]
    paths: list[Path | None] = [None] * nodes
    level = len(sizes) - 1
    while queue:
        label, path = heapq.heappop(queue)
        label = -label
        while label < starts[level - 1]:
            level -= 1
        place = label - starts[level - 1]
        for slot in range(len(runs[label]) // 64):
            child, own = place * FAN + slot, (slot, runs[label], path)
            if level == 1:
                paths[child] = own
            else:
                heapq.heappush(queue, (-(starts[level - 2] + child), own))
    return paths


def fold(path: Path | None, digest: str) -> tuple[str, str]:
    """(digest of all siblings on the way up, root that a node with this digest leads to)."""
    siblings = []
    while path is not None:
        slot, run, path = path
        left, right = run[: 64 * slot], run[64 * slot + 64 :]
        siblings += [left, right]
        digest = digest_of(left + digest + right)
    return digest_of("".join(siblings)), digest


def in_blocks(nodes: DataFrame, climb: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FAN**climb}"))


def climbed(nodes: DataFrame, climb: int) -> DataFrame:
    """(tree, pos, n, digest) of the tops of all blocks of nodes with these columns."""

    def top(block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        n, pos = block["n"][0].as_py(), block["pos"][0].as_py()
        digest, _ = forward([d.hex() for d in block["digest"].to_pylist()], n, climb)
        own = {"tree": [block["tree"][0].as_py()], "pos": [pos // FAN**climb], "n": [-(-n // FAN**climb)], "digest": [bytes.fromhex(digest)]}
        return pa.table(own, schema=pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]))

    return in_blocks(nodes.select("tree", "pos", "n", "digest"), climb).groupBy("tree", "block").applyInArrow(top, "tree string, pos long, n long, digest binary")


def swept_back(block: pa.Table, above: pa.Table, climb: int) -> tuple[pa.Table, list[Path | None], str | None, str]:
    """(a block in order, the paths of its nodes, subroot, root); the block's own runs are made again from its digests."""
    block = block.sort_by("pos")
    path = None
    for step in reversed(above["path"][0].as_py()):
        path = (step["slot"], step["run"], path)
    most = block["n"][0].as_py()
    _, runs = forward([d.hex() for d in block["digest"].to_pylist()], most, climb)
    return block, backward(runs, len(block), most, climb, path), above["subroot"][0].as_py(), above["root"][0].as_py()


def handed_down(nodes: DataFrame, above: DataFrame, climb: int) -> DataFrame:
    """ABOVE for each node, from ABOVE of its block's top."""

    def down(block: pa.Table, top: pa.Table) -> pa.Table:
        block, paths, subroot, root = swept_back(block, top, climb)
        lists = []
        for path in paths:
            steps = []
            while path is not None:
                steps.append({"slot": path[0], "run": path[1]})
                path = path[2]
            lists.append(steps)
        kind = pa.list_(pa.struct([("slot", pa.int32()), ("run", pa.string())]))
        columns = [block["tree"], block["pos"], pa.array(lists, kind), pa.array([subroot] * len(block), pa.string()), pa.array([root] * len(block), pa.string())]
        return pa.table(columns, names=["tree", "pos", "path", "subroot", "root"])

    blocks = in_blocks(nodes.select("tree", "pos", "n", "digest"), climb)
    return blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "pos")).applyInArrow(down, ABOVE)


def rounds_of(nodes: DataFrame, climb: int) -> list[DataFrame]:
    """nodes, then the tops of their blocks, and so on until each tree has one node; all but the first written to the shared folder."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 1) > 1:
        rounds.append(saved(climbed(rounds[-1], climb)))
    return rounds


def manifest(
    docs: DataFrame, changed: dict[str, Column], id_col: str = "doc_id", tree_col: str = "lang",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), climb: int = 4,
) -> DataFrame:
    """id_col, leaf, subroot, root, proof_sha256, folded_root, verified of each row of docs.

    A leaf digests the given columns of a row. The rows of each value of tree_col, by id_col, form a tree of FAN
    children a node; its top is the subroot, and the subroots form a tree in the same way, whose top is root.
    proof_sha256 digests all siblings from a leaf up to root. folded_root is the root that a leaf and its
    siblings lead to when the row is read with the columns of `changed` in place of its own.

    Trees are swept in blocks of `climb` levels, 4096 leaves for 4: a task sweeps its block forward with a queue ordered by label and
    writes the block's top; the tops are the leaves of the next round. Then the rounds are swept in reverse: a
    block gets the path of its top and hands a path to each of its nodes. What crosses blocks is a table in the
    shared folder, grouped and sorted by Spark, which spills; so no task holds more than a block, and a lost
    executor costs some blocks of one round.

    Null ids come first, equal ids follow each other by leaf, and repeated rows are leaves of their own, next to each
    other. A null in tree_col is a tree of its own. Null columns, empty and very long texts are leaves like others. An empty table
    gives no rows. Other columns of docs are not read.
    """
    leaf = leaf_digest(*[F.col(c) for c in columns])
    other = leaf_digest(*[changed.get(c, F.col(c)) for c in columns])
    leaves = docs.select(F.col(id_col).alias("id"), tree_name(F.col(tree_col)).alias("tree"), F.unhex(leaf).alias("digest"), F.unhex(other).alias("other"))
    leaves = saved(numbered(leaves.select("id", "tree", "digest", F.nullif("other", "digest").alias("other")), ["id", "digest"]))
    rounds = rounds_of(leaves, climb)
    # The subroots are nodes of one more tree.
    tops = numbered(rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    tops = saved(tops)
    upper = rounds_of(tops, climb)
    above = upper[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.expr("CAST(array() AS array<struct<slot:int,run:string>>)").alias("path"), F.lit(None).cast("string").alias("subroot"), F.lower(F.hex("digest")).alias("root"))
    for nodes in reversed(upper[:-1]):
        above = saved(handed_down(nodes, above, climb))
    named = above.join(tops.select("pos", "name", "digest"), "pos")
    above = saved(named.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.lower(F.hex("digest")).alias("subroot"), "root"))
    # rounds[-1] holds the subroots themselves.
    for nodes in reversed(rounds[1:-1]):
        above = saved(handed_down(nodes, above, climb))

    def prove(block: pa.Table, top: pa.Table) -> pa.Table:
        block, paths, subroot, root = swept_back(block, top, climb)
        own = [d.hex() for d in block["digest"].to_pylist()]
        read = [o.hex() if o is not None else d for o, d in zip(block["other"].to_pylist(), own, strict=True)]
        proofs, folded = zip(*[fold(p, d) for p, d in zip(paths, read, strict=True)], strict=True)
        same = [subroot] * len(own), [root] * len(own)
        columns = [block["id"], *[pa.array(x, pa.string()) for x in (own, *same, proofs, folded)], pa.array([f == root for f in folded], pa.bool_())]
        return pa.table(columns, names=[id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    kind = docs.schema[id_col].dataType.simpleString()
    proven = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return in_blocks(leaves, climb).groupBy("tree", "block").cogroup(above.groupBy("tree", "pos")).applyInArrow(prove, f"`{id_col}` {kind}, {proven}")


def lower_cased(text: Column) -> Column:
    """A-Z in lower case, no other letter."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
