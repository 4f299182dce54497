"""Merkle manifest of a table, with proofs that fold from retained hash states.

Leaves are ordered within a tree (one per language), and every run of eight
consecutive nodes becomes the hash of their digests. A task holds a bounded
piece of a tree, three levels at a time; pieces become the nodes of the next
layer, so no task or driver sees a whole tree. While a parent is hashed, its
state is copied before each child slot. Folding a replaced child resumes the
copy of its slot with the replacement and the right siblings: what stands left
of the slot is never hashed again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import ranked
from riskspark.sources.scratch import stored

_NODES = "tree string, place long, total long, digest string"
_PATHS = "tree string, place long, path array<struct<left:string,right:string>>, subroot string, root string"


@dataclass(frozen=True)
class Manifest:
    """``fan``: children of a node. ``levels``: levels of a tree that one task builds at once, of ``fan ** levels`` nodes."""

    fan: int = 8
    levels: int = 3

    @property
    def span(self) -> int:
        return self.fan**self.levels


def field(column: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, ``:`` and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """Digest of the columns, in hex."""
    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


# -- inside a task ------------------------------------------------------------


def _slots(digests: Sequence[bytes], fan: int) -> tuple[list[tuple], list[bytes]]:
    """For every node (hash state before its slot, left siblings, right siblings), and the parents' digests."""
    slots, parents = [], []
    for at in range(0, len(digests), fan):
        run = digests[at : at + fan]
        joined, state = b"".join(run), hashlib.sha256()
        for i, own in enumerate(run):
            slots.append((state.copy(), joined[: len(own) * i], joined[len(own) * (i + 1) :]))
            state.update(own)
        parents.append(state.hexdigest().encode())
    return slots, parents


def _piece(digests: list[bytes], total: int, rule: Manifest) -> tuple[list[list[tuple]], bytes]:
    """Slots of every level of a piece and the digest on top; a piece that is a whole tree ends at one node."""
    levels = []
    while len(levels) < rule.levels and not (total <= rule.span and len(digests) == 1):
        slots, digests = _slots(digests, rule.fan)
        levels.append(slots)
    return levels, digests[0]


def _resume(slot: tuple, replacement: bytes) -> bytes:
    """The parent's digest with another child in the slot."""
    state = slot[0].copy()
    state.update(replacement)
    state.update(slot[2])
    return state.hexdigest().encode()


def _digests(part: pa.Table, name: str = "digest") -> list[bytes | None]:
    return part.column(name).cast(pa.binary()).to_pylist()


# -- layers of a forest -------------------------------------------------------


def _grouped(nodes: DataFrame, rule: Manifest) -> DataFrame:
    return nodes.withColumn("piece", F.expr(f"place div {rule.span}L"))


def _climb(nodes: DataFrame, rule: Manifest) -> tuple[list[DataFrame], DataFrame]:
    """Layers from the given nodes up, and the node on top of every tree."""

    def above(part: pa.Table) -> pa.Table:
        part = part.sort_by("place")
        tree, piece, total = (part.column(c)[0].as_py() for c in ("tree", "piece", "total"))
        top = _piece(_digests(part), total, rule)[1]
        return pa.table({"tree": [tree], "place": [piece], "total": [-(-total // rule.span)], "digest": [top.decode()]})

    layers, tops = [nodes], nodes.filter("total = 1").select("tree", "digest")
    while not layers[-1].filter("total > 1").isEmpty():
        open_ = _grouped(layers[-1].filter("total > 1"), rule).select("tree", "piece", "place", "total", "digest")
        layers.append(stored(open_.groupBy("tree", "piece").applyInArrow(above, _NODES), "merkle-layer"))
        tops = tops.union(layers[-1].filter("total = 1").select("tree", "digest"))
    return layers, tops


def _walk(nodes: DataFrame, above: DataFrame, rule: Manifest, label: str) -> DataFrame:
    """The path of every node, from that of its piece; the columns of ``_PATHS``, ``tree`` being the node's ``label``."""

    def paths(part: pa.Table, up: pa.Table) -> pa.Table:
        part, up = part.sort_by("place"), up.to_pylist()[0]
        levels, _ = _piece(_digests(part), part.column("total")[0].as_py(), rule)
        found, n = [], part.num_rows
        for i in range(n):
            own = [level[i // rule.fan**k] for k, level in enumerate(levels)]
            found.append([{"left": left.decode(), "right": right.decode()} for _, left, right in own] + up["path"])
        step = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return pa.table({
            "tree": part.column(label), "place": part.column("place"), "path": pa.array(found, step),
            "subroot": part.column("digest") if label == "name" else pa.array([up["subroot"]] * n, pa.string()),
            "root": pa.array([up["root"]] * n, pa.string()),
        })

    pieces = above.groupBy("tree", "piece")
    return stored(_grouped(nodes, rule).groupBy("tree", "piece").cogroup(pieces).applyInArrow(paths, _PATHS), "merkle-paths")


def _descend(layers: list[DataFrame], starts: DataFrame, rule: Manifest) -> DataFrame:
    """The path of every piece of the lowest layer; ``starts`` has the paths of whole trees."""
    paths = None
    for layer in reversed(layers):
        # Renamed, as the pieces meet the layer again.
        whole = layer.filter("total = 1").select(F.col("tree").alias("whole")).join(starts, F.col("whole") == F.col("tree")).select(F.col("whole").alias("tree"), F.lit(0).cast("long").alias("place"), "path", "subroot", "root")
        pieces = (whole if paths is None else paths.union(whole)).withColumnRenamed("place", "piece")
        if layer is not layers[0]:
            paths = _walk(layer, pieces, rule, "tree")
    return pieces


def manifest(
    docs: DataFrame, rule: Manifest = Manifest(), *, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id: str = "doc_id", tree: str = "lang", changed: dict[str, Column] | None = None, where: Column | None = None,
) -> DataFrame:
    """Leaf, subroot, root and the checksum of the proof of every row, and whether the row folds back to the root.

    Columns: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``,
    ``folded_root``, ``verified``. A leaf is the digest of ``columns``. The
    leaves of each value of ``tree`` ascend by ``id``, NULL last, equal ids by
    leaf; subroots ascend by ``tree``, NULL first. Rows for which ``where`` is
    true are folded from the leaf that they have with the columns ``changed``,
    all others from their own.

    A NULL or empty value is part of the leaf like any other (``-`` and ``0:``).
    Rows that repeat are leaves of their own. A NULL ``tree`` is a tree. Other
    columns are ignored. An empty table gives an empty one.
    """
    values = {c: F.col(c) for c in columns}
    own = leaf(*values.values())
    other = leaf(*(values | (changed or {})).values())
    # Texts are read and hashed once; from here on rows are narrow.
    leaves = stored(
        docs.select(
            F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("tree"),
            F.col(id).alias("id"),
            own.alias("digest"),
            F.when(F.coalesce(where if where is not None else F.lit(False), F.lit(False)), other).alias("replacement"),
        ),
        "merkle-leaves",
    )
    placed = stored(ranked(leaves, ["tree"], [F.col("id").asc_nulls_last(), F.col("digest"), F.col("replacement").asc_nulls_last()], "place", total="total"), "merkle-places")
    layers, tops = _climb(placed.select("tree", "place", "total", "digest"), rule)
    # The subroots are the nodes of one more tree.
    tops = stored(ranked(tops, [], [F.col("tree")], "place", total="total"), "merkle-subroots")
    forest, top = _climb(tops.select(F.lit("").alias("tree"), "place", "total", "digest"), rule)
    begin = top.select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    named = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "place", "total", "digest")
    starts = _walk(named, _descend(forest, begin, rule), rule, "name").drop("place")
    above = _descend(layers, starts, rule).groupBy("tree", "piece")

    def fold(part: pa.Table, up: pa.Table) -> pa.Table:
        part, up = part.sort_by("place"), up.to_pylist()[0]
        mine, others = _digests(part), _digests(part, "replacement")
        levels, _ = _piece(mine, part.column("total")[0].as_py(), rule)
        # States before the slots of the path above are made once for the piece.
        path = [(hashlib.sha256(left), left, right) for left, right in ((s["left"].encode(), s["right"].encode()) for s in up["path"])]
        proofs, roots = [], []
        for i, own in enumerate(mine):
            proof, now = hashlib.sha256(), own if others[i] is None else others[i]
            for slot in [level[i // rule.fan**k] for k, level in enumerate(levels)] + path:
                proof.update(slot[1])
                proof.update(slot[2])
                now = _resume(slot, now)
            proofs.append(proof.hexdigest())
            roots.append(now.decode())
        n = len(mine)
        return pa.table({
            "id": part.column("id"), "leaf": part.column("digest"), "subroot": pa.array([up["subroot"]] * n, pa.string()),
            "root": pa.array([up["root"]] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(roots, pa.string()), "verified": pa.array([r == up["root"] for r in roots], pa.bool_()),
        })

    kind = leaves.schema["id"].dataType.simpleString()
    shape = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _grouped(placed, rule).groupBy("tree", "piece").cogroup(above).applyInArrow(fold, shape).withColumnRenamed("id", id)
