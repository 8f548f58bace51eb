"""A Merkle manifest of a dataset that stores only every few levels of its trees.

Rows are leaves. The leaves of a group form a tree, every ``ARITY`` consecutive nodes becoming one, and the
groups' roots form the tree of the dataset in the same way. Of a tree, the leaves and every
``every``-th level above are stored. A proof needs the levels between as well: they are computed again from
the stored nodes of one aligned subtree, give their siblings, and are gone.

Digests are lower-case hex SHA-256, of digests in that form. Spark hashes the rows, places the leaves and brings each
subtree together, a row of ``ARITY ** every`` nodes at most; what lies inside a subtree is hashed in Python.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.sources.shared import publish

ARITY = 3
ALL_GROUPS = "all"
SUBTREES_AT_ONCE = 64  # whose proofs a task holds
EVERY = 4  # levels from one stored level to the next: subtrees of 81 nodes
NO_STEPS = "array<struct<left:string,right:string>>"
_PLACE_BITS = 33  # of monotonically_increasing_id: partition above, place in the partition below


def joined_digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its byte count, a colon and its text, or ``-`` for null."""
    texts = [v.cast("string") for v in values]
    fields = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return joined_digest(*[F.coalesce(f, F.lit("-")) for f in fields])


def group_key(column: str) -> Column:
    """A text that is never null and sorts as the column does: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def placed_in_groups(rows: DataFrame, group: str, order: Sequence[Column | str]) -> DataFrame:
    """Add ``idx``, a row's number in its group in ``order``, and ``n``, the rows of the group.

    One parallel sort by group and order. Only counts per group and partition are joined to its rows, and no
    key of that join has more rows than a partition, so a group of any size is numbered in parts.
    """
    at = F.monotonically_increasing_id()
    stored = publish(
        rows.orderBy(group, *order).select(
            "*",
            F.shiftright(at, _PLACE_BITS).cast("int").alias("_part"),
            at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
        ),
        "merkle-sorted",
    )
    by_part = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        stored.groupBy(group, "_part")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_from"))
        .select(
            F.col(group).alias("_group"),
            F.col("_part").alias("_run"),
            (F.coalesce(F.sum("_rows").over(by_part), F.lit(0)) - F.col("_from")).alias("_shift"),
            F.sum("_rows").over(Window.partitionBy(group)).alias("n"),
        )
    )
    joined = stored.join(runs, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_run")))
    return joined.withColumn("idx", F.col("_place") + F.col("_shift")).drop(
        "_part", "_place", "_group", "_run", "_shift"
    )


def _subtrees(nodes: DataFrame, every: int, carried: Sequence[str] = ()) -> DataFrame:
    """One row per aligned subtree of a stored level: ``grp``, ``block``, ``n`` and its ``members`` in order.

    ``n`` counts the nodes of the whole level.
    """
    return (
        nodes.where("n > 1")
        .groupBy("grp", F.floor(F.col("idx") / ARITY**every).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("idx", "digest", *carried))).alias("members"), F.first("n").alias("n"))
    )


def subtree_root(nodes: list[str], every: int, is_whole: bool) -> str:
    """The node ``every`` levels above, or the root of the tree that ends inside the subtree."""
    for _ in range(every):
        if is_whole and len(nodes) == 1:
            break
        nodes = _parents(nodes)
    return nodes[0]


def _parents(nodes: list[str]) -> list[str]:
    return [sha256("".join(nodes[i : i + ARITY]).encode()).hexdigest() for i in range(0, len(nodes), ARITY)]


def subtree_paths(nodes: list[str], every: int, is_whole: bool) -> list[list[dict[str, str]]]:
    """For each node of a subtree's lowest level its siblings, level by level: those before and those after it in its run.

    The levels between are made here and gone afterwards. ``is_whole``: the tree ends inside the subtree, at
    its root.
    """
    paths: list[list[dict[str, str]]] = [[] for _ in nodes]
    level, width = nodes, 1
    for _ in range(every):
        if is_whole and len(level) == 1:
            break
        steps = []
        for i in range(len(level)):
            start = i - i % ARITY
            steps.append({"left": "".join(level[start:i]), "right": "".join(level[i + 1 : start + ARITY])})
        for place, path in enumerate(paths):
            path.append(steps[place // width])
        level, width = _parents(level), width * ARITY
    return paths


def _with_paths(subtrees: DataFrame, every: int, own: Sequence[str], also: Sequence[str]) -> DataFrame:
    """Members of subtrees (``grp``, ``n``, ``members``, ``also`` and the ``path`` of their root), each with its own path."""
    step = pa.struct([("left", pa.string()), ("right", pa.string())])
    members = subtrees.schema["members"].dataType.elementType
    shape = [subtrees.schema["grp"], members["idx"], members["digest"], *(members[c] for c in own)]
    shape += [*(subtrees.schema[c] for c in also), subtrees.schema["path"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SUBTREES_AT_ONCE):
                batch = whole.slice(start, SUBTREES_AT_ONCE)
                lists = batch.column("members")
                sizes, flat = lists.value_lengths().to_pylist(), lists.flatten()
                digests, at, paths = flat.field("digest").to_pylist(), 0, []
                above, n = batch.column("path").to_pylist(), batch.column("n").to_pylist()
                for row, size in enumerate(sizes):
                    found = subtree_paths(digests[at : at + size], every, n[row] <= ARITY**every)
                    paths += [path + above[row] for path in found]
                    at += size
                parent = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                columns = [batch.column("grp").take(parent)]
                columns += [flat.field(c) for c in ("idx", "digest", *own)]
                columns += [batch.column(c).take(parent) for c in also]
                columns.append(pa.array(paths, pa.list_(step)))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in shape])

    return subtrees.select("grp", "n", "members", *also, "path").mapInArrow(run, T.StructType(shape))


@dataclass(frozen=True)
class Trees:
    """The stored levels of the trees of all groups.

    Each has ``grp``, ``idx``, ``n`` (nodes of the group at that level) and ``digest``; the first one, the leaves,
    also what the leaves carry.
    """

    stored: list[DataFrame]
    every: int

    def roots(self) -> DataFrame:
        """``grp``, ``root``."""
        ends = [level.where("n = 1").select("grp", F.col("digest").alias("root")) for level in self.stored]
        found = ends[0]
        for more in ends[1:]:
            found = found.union(more)
        return found

    def proofs(self, above: DataFrame, carried: Sequence[str]) -> DataFrame:
        """Per leaf ``grp``, ``idx``, ``digest``, ``carried``, the columns of ``above`` and its ``path``: an array of the siblings
        to the left and to the right, from the leaf up.

        ``above`` has one row per group: ``grp``, the ``path`` from the group's root on, and what else holds for the
        group. Paths go down from the roots, one stored level at a time; a path is joined to a subtree, not
        to its leaves, so no key has more rows than a subtree.
        """
        found: DataFrame | None = None
        also = [c for c in above.columns if c not in ("grp", "path")]
        for level in range(len(self.stored) - 1, -1, -1):
            nodes = self.stored[level]
            own = carried if level == 0 else ()
            tops = nodes.where("n = 1").join(above, "grp").select("grp", "idx", "digest", *own, *also, "path")
            if found is not None:
                roots = found.select("grp", F.col("idx").alias("block"), "path", *also)
                below = _with_paths(_subtrees(nodes, self.every, own).join(roots, ["grp", "block"]), self.every, own, also)
                tops = tops.union(below)
            found = tops
        return found


def grow(leaves: DataFrame, every: int = EVERY) -> Trees:
    """Store the trees of ``leaves``: ``grp`` (not null), ``idx`` from 0 in the group, ``n`` leaves of the group, ``digest``.

    The only number that the driver takes is the size of the largest group, which tells how many levels
    there are.
    """
    stored = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    width = ARITY**every

    @F.pandas_udf("string")
    def root_of(members: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([subtree_root(list(m), every, k <= width) for m, k in zip(members, n, strict=True)], dtype=object)

    while most > 1:
        up = _subtrees(stored[-1], every).select(
            "grp",
            F.col("block").alias("idx"),
            F.ceil(F.col("n") / width).alias("n"),
            root_of("members.digest", "n").alias("digest"),
        )
        stored.append(publish(up, "merkle-level"))
        most = -(-most // width)
    return Trees(stored, every)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda node, step: joined_digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf up, left to right."""
    texts = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(texts, ""), 256)


@dataclass(frozen=True)
class Manifest:
    """The trees of the groups and the tree of their roots, whose only group is ``ALL_GROUPS``."""

    groups: Trees
    top: Trees

    def subroots(self) -> DataFrame:
        """``grp``, ``root`` of each group."""
        return self.groups.roots()

    def root(self) -> DataFrame:
        """One row with the ``root`` of the dataset; none where there are no leaves."""
        return self.top.roots().select("root")

    def proofs(self, carried: Sequence[str]) -> DataFrame:
        """Per leaf ``grp``, ``idx``, ``digest``, ``carried``, ``subroot``, ``root`` and the ``path`` to the root."""
        start = self.top.roots().withColumn("path", F.array().cast(NO_STEPS))
        tops = self.top.proofs(start, ["subgroup"])
        above = tops.select(
            F.col("subgroup").alias("grp"), "path", F.col("digest").alias("subroot"), "root"
        )
        return self.groups.proofs(publish(above, "merkle-subroots"), carried)


def manifest(leaves: DataFrame, order: Sequence[Column | str], every: int = EVERY) -> Manifest:
    """The manifest of ``leaves``: ``grp`` as ``group_key`` makes it, ``digest``, and columns to carry.

    ``order`` sorts the leaves of a group; equal ones are told apart by their digests, and leaves equal in both
    are interchangeable. No leaves give no roots.
    """
    placed = publish(placed_in_groups(leaves, "grp", [*order, "digest"]), "merkle-leaves")
    groups = grow(placed, every)
    subroots = groups.roots().select(
        F.lit(ALL_GROUPS).alias("grp"), F.col("grp").alias("subgroup"), F.col("root").alias("digest")
    )
    top = grow(publish(placed_in_groups(subroots, "grp", ["subgroup"]), "merkle-subroots"), every)
    return Manifest(groups, top)


def row_manifest(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """Prove each row of ``docs`` (``doc_id``, ``source``, ``lang``, ``n_chars``, ``text``) and verify an altered copy.

    Returns ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``. A row is altered, by taking the line
    feeds from its text, where the CRC-32 of its id in decimal is even. Groups are the sources, null
    being one. Leaves ascend by ``doc_id``, null first; repeated ids are ordered by their leaves. A null id is a
    leaf like others and is not altered. No rows give no rows. Further columns are ignored.

    Texts are read once and only digests move; what is stored is a few digests a row.
    """
    shown = F.col("doc_id").cast("string")
    even = F.coalesce(F.crc32(shown.cast("binary")) % 2 == 0, F.lit(False))
    altered = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        "doc_id",
        group_key("source").alias("grp"),
        leaf_digest([*others, F.col("text")]).alias("digest"),
        leaf_digest([*others, altered]).alias("altered"),
    )
    proved = manifest(leaves, [F.asc_nulls_first("doc_id")], every).proofs(["doc_id", "altered"])
    found = proved.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("altered"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
