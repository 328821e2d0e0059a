"""Merkle manifest of a dataset, its subtrees stored in van Emde Boas order.

Every row is a leaf; the leaves of a group (of one language, say) ascend by a
key and form a tree of fan-out FANOUT, whose last run at each level may be
short. The roots of the groups, in order of the group, form one more tree.

The tree is cut into aligned blocks of HEIGHT levels. A block is one row whose
``nodes`` holds the digests of its subtree in van Emde Boas order: the subtree
is split at half height, the upper part stored first, then each lower part in
turn, all of them in the same way. ``veb_address`` finds a node by arithmetic
alone, so building and looking up siblings never search. The roots of the
blocks are the leaves of the next round of blocks, until one block is left.

Spark numbers the leaves by range partitions (a group may hold most of the
rows), builds the blocks of a round in parallel (a block has at most
FANOUT ** HEIGHT leaves), and hands the paths to the root down, round by
round. No step holds more than one block in a task's memory.

Digests are SHA-256; the input of a node is the lowercase hex text of its
children, concatenated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.keys import dense_keys
from carelake.session import materialise

FANOUT, HEIGHT = 8, 4
SPAN = FANOUT ** HEIGHT
DIGEST = 32


def leaf_digest(*cols: str | Column) -> Column:
    """Binary SHA-256 of the columns: each ``-`` if null, else the length of its
    text in bytes, ``:`` and the text."""
    parts = []
    for c in cols:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def veb_size(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (FANOUT ** levels - 1) // (FANOUT - 1)


def veb_address(depth: int, index, levels: int):
    """Where node ``index`` (an int or an array) of ``depth`` (0 is the root) lies
    in the van Emde Boas order of a full tree of ``levels`` levels."""
    base = 0
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        tree, index = np.divmod(index, FANOUT ** (depth - upper))
        base = base + veb_size(upper) + tree * veb_size(levels - upper)
        depth, levels = depth - upper, levels - upper
    return base + index


def _join(hexes) -> bytes:
    return hashlib.sha256("".join(hexes).encode()).digest()


def build_block(leaves: list[bytes], height: int) -> tuple[bytes, bytes]:
    """The nodes of an aligned subtree in van Emde Boas order (slots of missing
    nodes are zero), and its root ``height`` levels up."""
    levels = height + 1
    nodes = np.zeros((veb_size(levels), DIGEST), dtype=np.uint8)
    level = leaves
    for depth in range(height, -1, -1):
        at = veb_address(depth, np.arange(len(level)), levels)
        nodes[at] = np.frombuffer(b"".join(level), dtype=np.uint8).reshape(-1, DIGEST)
        if depth:
            hexes = [d.hex() for d in level]
            level = [_join(hexes[i:i + FANOUT]) for i in range(0, len(hexes), FANOUT)]
    return nodes.tobytes(), level[0]


class Block:
    """Sibling lookup in one stored block."""

    def __init__(self, nodes: bytes, size: int, height: int):
        self._nodes = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, DIGEST)
        self.size, self.height = size, height

    def level(self, up: int) -> list[str]:
        """Hex digests of all nodes ``up`` levels above the leaves."""
        at = veb_address(self.height - up, np.arange(-(-self.size // FANOUT ** up)), self.height + 1)
        raw = self._nodes[at].tobytes().hex()
        return [raw[i:i + 2 * DIGEST] for i in range(0, len(raw), 2 * DIGEST)]

    def paths(self) -> list[list[tuple[int, list[str]]]]:
        """For each leaf, from the bottom to the block's root: its place in its
        run, and the run's other members."""
        out: list[list[tuple[int, list[str]]]] = [[] for _ in range(self.size)]
        for up in range(self.height):
            nodes = self.level(up)
            step = FANOUT ** up
            for i, node in enumerate(nodes):
                start = i - i % FANOUT
                run = nodes[start:start + FANOUT]
                place = i - start
                siblings = run[:place] + run[place + 1:]
                for leaf in range(i * step, min((i + 1) * step, self.size)):
                    out[leaf].append((place, siblings))
        return out


def pack_path(path: list[tuple[int, list[str]]]) -> bytes:
    return b"".join(bytes((place, len(s))) + bytes.fromhex("".join(s)) for place, s in path)


def unpack_path(raw: bytes) -> list[tuple[int, list[str]]]:
    path, at = [], 0
    while at < len(raw):
        place, n = raw[at], raw[at + 1]
        end = at + 2 + n * DIGEST
        path.append((place, [raw[i:i + DIGEST].hex() for i in range(at + 2, end, DIGEST)]))
        at = end
    return path


def fold(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its siblings give."""
    for place, siblings in path:
        leaf = _join(siblings[:place] + [leaf] + siblings[place:]).hex()
    return leaf


def _build_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.sort_by("pos")
    height = min(HEIGHT, table.column("height")[0].as_py())
    nodes, top = build_block(table.column("digest").to_pylist(), height)
    return pa.table({
        "grp": [key[0].as_py()], "n": table.column("n")[:1], "height": table.column("height")[:1],
        "block": [key[1].as_py()], "size": pa.array([table.num_rows], pa.int32()), "nodes": [nodes], "top": [top]})


_BLOCK = "grp string, n long, height int, block long, size int, nodes binary, top binary"


def _rounds(leaves: DataFrame) -> list[DataFrame]:
    """Blocks of every round for leaves (grp, n, pos, digest)."""
    # reductions until one node is left
    height = sum((F.when(F.col("n") > FANOUT ** k, 1).otherwise(0) for k in range(21)), F.lit(0))
    level = leaves.withColumn("height", height.cast("int"))
    out = []
    while True:
        blocks = materialise(level.withColumn("block", F.floor(F.col("pos") / SPAN)).groupBy("grp", "block")
                             .applyInArrow(_build_group, _BLOCK), "merkle-blocks")
        out.append(blocks)
        open_ = blocks.where(F.col("height") > HEIGHT)
        if not open_.limit(1).count():
            return out
        level = open_.select("grp", F.ceil(F.col("n") / SPAN).alias("n"), F.col("block").alias("pos"),
                             F.col("top").alias("digest"), (F.col("height") - HEIGHT).alias("height"))


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """(grp, digest): the root of each group."""
    tops = [b.where(F.col("height") <= HEIGHT).select("grp", F.col("top").alias("digest")) for b in rounds]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row["nodes"], row["size"], min(HEIGHT, row["height"]))
            paths = [pack_path(p) + row["path"] for p in block.paths()]
            first = row["block"] * SPAN
            yield pa.RecordBatch.from_pydict({
                "grp": pa.array([row["grp"]] * block.size, pa.string()),
                "pos": pa.array(range(first, first + block.size), pa.int64()),
                "path": pa.array(paths, pa.binary())})


def _paths_down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(grp, block, path): the way of every block of the first round to the root,
    given the ways (grp, path) of the groups' roots."""
    ways = None
    for blocks in reversed(rounds):
        here = blocks.where(F.col("height") <= HEIGHT).select("grp", "block").join(above, "grp")
        if ways is not None:
            here = here.unionByName(ways)
        ways = here
        if blocks is not rounds[0]:
            ways = materialise(blocks.select("grp", "block", "height", "size", "nodes").join(here, ["grp", "block"])
                               .mapInArrow(_descend, "grp string, pos long, path binary"), "merkle-paths")
            ways = ways.withColumnRenamed("pos", "block")
    return ways


@dataclass
class Manifest:
    """``entries`` (grp, pos, digest and the columns given at the build), the
    blocks of the groups' trees and of the tree above them by round, ``groups``
    (grp, place, digest), and the one-row frame ``root`` (digest)."""

    entries: DataFrame
    rounds: list[DataFrame]
    groups: DataFrame
    root_rounds: list[DataFrame]
    root: DataFrame

    def write(self, path: str) -> None:
        """The manifest as Parquet: all blocks of all rounds, and the groups."""
        for tree, rounds in (("rows", self.rounds), ("groups", self.root_rounds)):
            for k, blocks in enumerate(rounds):
                blocks.write.mode("overwrite").parquet(f"{path}/blocks/tree={tree}/round={k}")
        self.groups.write.mode("overwrite").parquet(f"{path}/groups")


def build_manifest(leaves: DataFrame, group_col: str, order_cols: list[str], digest_col: str = "digest") -> Manifest:
    """Manifest over one row per leaf. Groups ascend by the bytes of their text, a
    null group first; leaves ascend by ``order_cols`` (nulls last), equal ones by
    their digest, so repeated rows are leaves of their own and the manifest does
    not depend on the order of the input. Other columns are carried along in
    ``entries``. An empty table has no groups and no root row."""
    # null sorts before every text
    grp = F.when(F.col(group_col).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group_col).cast("string")))
    rows = materialise(leaves.withColumn("grp", grp).withColumnRenamed(digest_col, "digest"), "merkle-leaves")
    numbered = dense_keys(rows, ["grp", *order_cols, "digest"], "seq", start=0)
    starts = numbered.groupBy("grp").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    entries = materialise(numbered.join(starts, "grp").withColumn("pos", F.col("seq") - F.col("first")).drop("seq", "first"),
                          "merkle-entries")
    rounds = _rounds(entries.select("grp", "n", "pos", "digest"))
    groups = materialise(dense_keys(_tops(rounds), ["grp"], "place", start=0), "merkle-groups")
    root_rounds = _rounds(groups.crossJoin(groups.agg(F.count(F.lit(1)).alias("n")))  # one row
                          .select(F.lit("").alias("grp"), "n", F.col("place").alias("pos"), "digest"))
    return Manifest(entries, rounds, groups, root_rounds, _tops(root_rounds).select("digest"))


def _prove(key: tuple[pa.Scalar, ...], entries: pa.Table, blocks: pa.Table) -> pa.Table:
    row = blocks.to_pylist()[0]
    block = Block(row["nodes"], row["size"], min(HEIGHT, row["height"]))
    above = unpack_path(row["path"])
    root = row["root"].hex()
    entries = entries.sort_by("pos")
    paths = block.paths()
    proofs, folded = [], []
    for pos, digest in zip(entries.column("pos").to_pylist(), entries.column("claimed").to_pylist(), strict=True):
        path = paths[pos - row["block"] * SPAN] + above
        proofs.append(_join(s for _, siblings in path for s in siblings).hex())
        folded.append(fold(digest.hex(), path))
    n = entries.num_rows
    kept = entries.drop_columns(["grp", "block", "pos", "claimed"])
    for name, col in (("subroot", [row["subroot"].hex()] * n), ("root", [root] * n), ("proof_sha256", proofs),
                      ("folded_root", folded)):
        kept = kept.append_column(name, pa.array(col, pa.string()))
    return kept.append_column("verified", pa.array([f == root for f in folded], pa.bool_()))


def prove(manifest: Manifest, claimed_col: str, keep: list[str]) -> DataFrame:
    """For each entry: the columns ``keep``, subroot, root, proof_sha256 (digest of
    the sibling digests from the leaf to the root, left to right), folded_root
    (the root that the digest in ``claimed_col`` gives with these siblings) and
    verified (whether that is the root)."""
    top = materialise(_paths_down(manifest.root_rounds, manifest.root.select(F.lit("").alias("grp"), F.lit(b"").alias("path"))),
                      "merkle-top")
    placed = manifest.root_rounds[0].select("grp", "block", "height", "size", "nodes").join(top, ["grp", "block"])
    # the way from each group's root to the root of all
    ways = (placed.mapInArrow(_descend, "grp string, pos long, path binary").select(F.col("pos").alias("place"), "path")
            .join(manifest.groups.select("place", "grp", F.col("digest").alias("subroot")), "place"))
    ways = materialise(ways.crossJoin(manifest.root.select(F.col("digest").alias("root"))), "merkle-ways")  # one row
    low = _paths_down(manifest.rounds, ways.select("grp", "path"))
    blocks = (manifest.rounds[0].select("grp", "block", "height", "size", "nodes").join(low, ["grp", "block"])
              .join(ways.select("grp", "subroot", "root"), "grp"))
    entries = manifest.entries.select("grp", F.floor(F.col("pos") / SPAN).alias("block"), "pos",
                                      F.col(claimed_col).alias("claimed"), *keep)
    fields = ", ".join(f"`{c}` {manifest.entries.schema[c].dataType.simpleString()}" for c in keep)
    return entries.groupBy("grp", "block").cogroup(blocks.groupBy("grp", "block")).applyInArrow(
        _prove, f"{fields}, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def document_proofs(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row
    of ``documents``, grouped by lang and ordered by doc_id. The manifest is that of
    the given rows; rows where ``tampered`` holds are checked with the A-Z of their
    text lower-cased. Null ids come last in their language; repeated ids are ordered
    by their digests; a null text is a leaf of its own kind and cannot be tampered
    with. Further columns are not read."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    upper = "".join(chr(c) for c in range(65, 91))
    low = F.translate(F.col("text").cast("string"), upper, upper.lower())
    rows = docs.select("doc_id", "lang", leaf_digest(*fields, "text").alias("digest"),
                       F.when(tampered, leaf_digest(*fields, low)).alias("other"))
    rows = rows.withColumn("claimed", F.coalesce("other", "digest")).drop("other")
    manifest = build_manifest(rows, "lang", ["doc_id"])
    entries = manifest.entries.withColumn("leaf", F.lower(F.hex("digest")))
    return prove(Manifest(entries, manifest.rounds, manifest.groups, manifest.root_rounds, manifest.root),
                 "claimed", ["doc_id", "leaf"])
