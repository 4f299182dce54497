"""Near duplicates by SimHash fingerprints, searched with vantage-point trees.

A fingerprint is a run of 64-bit words; bit j is set if more than half of the
shingle hashes have it. Distinct fingerprints are partitioned by a
vantage-point tree: a node splits by Hamming distance to its vantage point, and
a fingerprint is sent to every shard whose region its search ball overlaps by
the triangle inequality. Inside a shard the search goes on in the same way.
Every shard answers with one edge per fingerprint towards a representative of
the local group, never with all pairs of a group; label propagation over those
edges gives the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import fresh, give_back, hash_share, small_batches, split_by_ids
from riskspark.sources.scratch import stored

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: Odd multipliers that derive further words of a wide fingerprint from the shingle hash (fixed values).
_MIX = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class NearDuplicates:
    """What is hashed and what is linked.

    ``words``: shingle length. ``width``: 64-bit words of a fingerprint; each
    has a tree of its own. ``radius``: a search ball in one word's tree.
    ``link``: most differing bits, over all words, of linked fingerprints. With
    one word and ``radius`` = ``link`` every link is found. With several words,
    a pair is found if it meets in one of the trees.
    ``near``: with several words, a pair is compared in full if its word differs
    by no more. ``leaf``: fingerprints in a shard, as far as vantage points from a sample of
    ``sample`` fingerprints can cut; a larger shard is searched in blocks.
    """

    words: int = 3
    width: int = 1
    radius: int = 2
    link: int = 2
    near: int = 16
    leaf: int = 4096
    sample: int = 16_384
    seed: int = 5


def fingerprint(text: str | None, words: int, width: int) -> bytes:
    """Little-endian words of the fingerprint of a whole text; zero if it has no word."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(bytes.maketrans(_UPPER, _LOWER)).split()
    if not parts:
        return bytes(8 * width)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    last = ends[min(words, len(parts)) - 1 :] - 1
    first = np.concatenate(([0], ends))[: len(last)]
    view, hashed = memoryview(joined), xxhash.xxh64_intdigest
    total = np.zeros((width, 64), dtype=np.int64)
    for at in range(0, len(last), 1 << 16):  # so that memory does not grow with the text
        spans = zip(first[at : at + (1 << 16)].tolist(), last[at : at + (1 << 16)].tolist())
        hashes = np.fromiter((hashed(view[a:b], 42) for a, b in spans), dtype=np.uint64)
        for w in range(width):
            if w:
                hashes = hashes * np.uint64(_MIX + 2 * w)
                hashes ^= hashes >> np.uint64(29)
                hashes *= np.uint64(0xBF58476D1CE4E5B9)
                hashes ^= hashes >> np.uint64(32)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total[w] += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * total > len(last), axis=1, bitorder="little").tobytes()


def fingerprints(docs: DataFrame, rule: NearDuplicates = NearDuplicates(), *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` (binary) of every row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), rule.words, rule.width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary())], ["doc_id", "fingerprint"])
        give_back()

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(each, "doc_id long, fingerprint binary")


def _distance(words: np.ndarray, one: np.uint64) -> np.ndarray:
    return np.bitwise_count(words ^ one).astype(np.int16)


def vantage_tree(sample: np.ndarray, leaves: int) -> tuple | int:
    """Nodes (vantage, cut, near, far) from a sample of one word's values; leaves are numbered in order.

    A broadcast is read without this package, so a tree is made of plain tuples.
    """
    made = 0

    def node(points: np.ndarray, leaves: int) -> tuple | int:
        nonlocal made
        if leaves > 1 and len(points) >= 4:
            vantage = points[len(points) // 2]
            far = _distance(points, vantage)
            cut = int(np.median(far))
            near = far <= cut
            if near.all():
                cut -= 1
                near = far <= cut
            if near.any() and not near.all():
                return vantage, cut, node(points[near], leaves // 2), node(points[~near], leaves - leaves // 2)
        made += 1
        return made - 1

    return node(np.unique(sample), max(1, leaves))


def route(tree: tuple | int, words: np.ndarray, radius: int, rows: np.ndarray, home: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, rows whose ball reaches it, which of them live there)."""
    if not len(rows):
        return
    if isinstance(tree, int):
        yield tree, rows, home
        return
    vantage, cut, near, far = tree
    gap = _distance(words[rows], vantage)
    side = gap <= cut + radius
    yield from route(near, words, radius, rows[side], home[side] & (gap[side] <= cut))
    side = gap > cut - radius
    yield from route(far, words, radius, rows[side], home[side] & (gap[side] > cut))


def _groups(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of the group of each of n points, from pairs."""
    label = np.arange(n)
    while len(left):
        a, b = label[left], label[right]
        open_ = a != b
        if not open_.any():
            break
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]
    return label


def _pairs(home: np.ndarray, guests: np.ndarray, words: np.ndarray, full: np.ndarray, rule: NearDuplicates) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked (home, guest) index pairs, by vantage points down to small blocks."""
    if not len(home) or not len(guests):
        return
    if len(home) > 64:
        vantage = words[home[len(home) // 2]]
        far, gap = _distance(words[home], vantage), _distance(words[guests], vantage)
        cut = int(np.median(far))
        if (far <= cut).all():
            cut -= 1
        near = far <= cut
        if near.any() and not near.all():
            yield from _pairs(home[near], guests[gap <= cut + rule.radius], words, full, rule)
            yield from _pairs(home[~near], guests[gap > cut - rule.radius], words, full, rule)
            return
    for at in range(0, len(guests), max(1, (1 << 20) // len(home))):
        block = guests[at : at + max(1, (1 << 20) // len(home))]
        close = np.bitwise_count(words[home][:, None] ^ words[block][None, :])
        h, g = np.nonzero(close <= (rule.radius if rule.width == 1 else max(rule.radius, rule.near)))
        h, g = home[h], block[g]
        if rule.width > 1 and len(h):
            ok = np.bitwise_count(full[h] ^ full[g]).sum(axis=1) <= rule.link
            h, g = h[ok], g[ok]
        yield h, g


def _search(full: np.ndarray, word: int, home: np.ndarray, rule: NearDuplicates) -> tuple[list[bytes], list[bytes]]:
    """One edge per linked fingerprint of a shard towards the first of its local group."""
    words, label = full[:, word].copy(), np.arange(len(full))
    for h, g in _pairs(np.flatnonzero(home), np.arange(len(full)), words, full, rule):
        label = _groups(label[h], label[g], len(full))[label] if len(h) else label
    own = np.flatnonzero(label != np.arange(len(full)))
    return [full[i].tobytes() for i in own], [full[label[i]].tobytes() for i in own]


def links(prints: DataFrame, rule: NearDuplicates = NearDuplicates()) -> DataFrame:
    """``left``, ``right``: edges whose components are those of all linked fingerprints.

    ``prints`` has distinct values of ``fingerprint``.
    """
    spark, rows = prints.sparkSession, prints.count()
    share = min(1.0, rule.sample / max(1, rows))
    chosen = prints.filter(hash_share(F.col("fingerprint"), F.lit(rule.seed)) < share).limit(2 * rule.sample).collect()
    sample = np.frombuffer(b"".join(sorted(bytes(r[0]) for r in chosen)), dtype="<u8").reshape(-1, rule.width)
    count = -(-rows // rule.leaf)
    trees = spark.sparkContext.broadcast([vantage_tree(sample[:, w], count) for w in range(rule.width)])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_pylist()
            full = np.frombuffer(b"".join(values), dtype="<u8").reshape(-1, rule.width)
            for w, tree in enumerate(trees.value):
                for leaf, at, home in route(tree, full[:, w].copy(), rule.radius, np.arange(len(full)), np.ones(len(full), bool)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), w, np.int32)), pa.array(np.full(len(at), leaf, np.int32)), pa.array(home), pa.array([values[i] for i in at], pa.binary())],
                        ["word", "leaf", "home", "fingerprint"],
                    )
        give_back()

    seen = stored(prints.select("fingerprint").mapInArrow(visits, "word int, leaf int, home boolean, fingerprint binary"), "visits")
    # A leaf that vantage points could not cut small is searched block by block: each
    # block of residents meets each block of visitors once.
    most = 4 * rule.leaf
    blocks = seen.groupBy("word", "leaf").agg(
        F.ceil(F.count_if("home") / most).cast("int").alias("_homes"), F.ceil(F.count_if(~F.col("home")) / (4 * most)).cast("int").alias("_guests")
    )
    seen = seen.join(blocks, ["word", "leaf"]).filter("_homes > 0")
    own = F.pmod(F.xxhash64("fingerprint"), F.greatest("_homes", F.lit(1))).cast("int")
    guest = F.pmod(F.xxhash64("fingerprint"), F.greatest("_guests", F.lit(1))).cast("int")
    # As a resident: in its own block, against every visitor block and every resident block.
    units = seen.select(
        "word",
        "leaf",
        "fingerprint",
        F.explode(
            F.when(
                F.col("home"),
                F.concat(
                    F.transform(F.sequence(F.lit(0), F.greatest("_guests", F.lit(1)) - 1), lambda g: F.struct(own.alias("block"), g.alias("other"), F.lit(False).alias("inner"), F.lit(True).alias("home"))),
                    F.flatten(
                        F.transform(
                            F.filter(F.sequence(F.lit(0), F.col("_homes") - 1), lambda b: F.col("_homes") > 1),
                            lambda b: F.array(
                                F.struct(own.alias("block"), b.alias("other"), F.lit(True).alias("inner"), F.lit(True).alias("home")),
                                F.struct(b.alias("block"), own.alias("other"), F.lit(True).alias("inner"), F.lit(False).alias("home")),
                            ),
                        )
                    ),
                ),
            ).otherwise(
                F.transform(F.sequence(F.lit(0), F.col("_homes") - 1), lambda b: F.struct(b.alias("block"), guest.alias("other"), F.lit(False).alias("inner"), F.lit(False).alias("home")))
            )
        ).alias("_unit"),
    ).select("word", "leaf", "fingerprint", "_unit.*")

    def search(part: pa.Table) -> pa.Table:
        word = part.column("word")[0].as_py()
        part = part.group_by("fingerprint").aggregate([("home", "max")]).sort_by("fingerprint")
        prints = np.frombuffer(b"".join(part.column("fingerprint").to_pylist()), dtype="<u8").reshape(-1, rule.width)
        left, right = _search(prints, word, part.column("home_max").to_numpy(), rule)
        give_back()
        return pa.table({"left": pa.array(left, pa.binary()), "right": pa.array(right, pa.binary())})

    return units.groupBy("word", "leaf", "block", "other", "inner").applyInArrow(search, "left binary, right binary")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node reachable from each node that has an edge.

    Alternating large and small stars; every round is written to the shared
    folder, so its lineage is short and a lost executor costs one round.
    """
    now = stored(edges.select(F.greatest("left", "right").alias("u"), F.least("left", "right").alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        # Large star: neighbours above a node point to the least of its neighbourhood.
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        # Small star: a node and its lower neighbours point to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        after = stored(small.select("e.*").filter("u <> v").distinct(), "small-star")
        changed = after.exceptAll(now).isEmpty() and now.exceptAll(after).isEmpty()
        now = after
        if changed:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _members(docs: DataFrame, rule: NearDuplicates, id: str, text: str) -> DataFrame:
    """``doc_id``, ``fingerprint`` (binary), ``component_id`` and ``root`` (a fingerprint of the component) of every row."""
    rows = stored(fingerprints(docs, rule, id=id, text=text), "fingerprints")
    classes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes.select("fingerprint"), rule))
    grouped = classes.join(roots, classes.fingerprint == roots.node, "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(grouped.join(least, "root").select("fingerprint", "component_id", "root"), "fingerprint")


def near_duplicates(docs: DataFrame, rule: NearDuplicates = NearDuplicates(), *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits a word), ``component_id`` of every row.

    ``component_id`` is the smallest id reachable over links, the own included.
    A NULL or empty text has fingerprint zero, which is linked like any other.
    Rows with one fingerprint are one group, however many. A NULL id keeps its
    row; in a group it counts only if no other id is there. An empty table gives
    an empty one. Other columns are ignored.
    """
    hexed = F.lower(F.hex("fingerprint"))
    big_endian = F.concat(*[F.concat(*[F.substring(hexed, 16 * w + 2 * b + 1, 2) for b in range(7, -1, -1)]) for w in range(rule.width)])
    return _members(docs, rule, id, text).select("doc_id", big_endian.alias("fingerprint"), "component_id")


def _sortable(kind: T.DataType) -> bool:
    parts = kind.fields if isinstance(kind, T.StructType) else [kind.elementType] if isinstance(kind, T.ArrayType) else []
    return not isinstance(kind, (T.MapType, T.VariantType)) and all(_sortable(getattr(p, "dataType", p)) for p in parts)


def keep_one(docs: DataFrame, rule: NearDuplicates = NearDuplicates(), *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` without near duplicates: of each component one row of its smallest id stays.

    Rows are known by id and fingerprint, so unlike texts of one id are decided
    apart. If several rows of a component have its smallest id, the one of the
    least fingerprint stays, and of those the least of all columns (maps not
    compared). A row without an id stays only where no row of its component has
    one, one a component. Repeated rows are duplicates. An empty table gives an
    empty one. Only rows that may go, or have a NULL id, are moved.
    """
    rows = stored(_members(docs, rule, id, text).groupBy("doc_id", "fingerprint", "component_id", "root").agg(F.count(F.lit(1)).alias("rows")), "members")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # Only rows of the smallest id can stay; where those are several, one is chosen.
    several = rows.filter(own).groupBy("root").agg(F.min("fingerprint").alias("first"), F.sum("rows").alias("all")).filter("all > 1")
    chosen = rows.filter(own).join(several, "root").select("doc_id", "fingerprint", (F.col("fingerprint") != F.col("first")).alias("goes"))
    decided = rows.filter(~own).select("doc_id", "fingerprint", F.lit(True).alias("goes")).union(chosen)
    decided = stored(decided.select(F.col("doc_id").alias("_id"), F.col("fingerprint").alias("_print"), F.col("goes").alias("_goes")), "decided")
    mark, key = fresh(docs, "_mark"), fresh(docs, "_key")
    untouched, asked = split_by_ids(docs.filter(F.col(id).isNotNull()), id, decided.filter(F.col("_id").isNotNull()).select("_id").distinct())
    asked = asked.unionAll(docs.filter(F.col(id).isNull()))

    @F.arrow_udf("binary")
    def prints(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([fingerprint(t.as_py(), rule.words, rule.width) for t in part], pa.binary())
        give_back()

    asked = asked.withColumns({mark: prints(F.col(text).cast("string")), key: F.col(id).cast("long")})
    asked = asked.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), F.col(mark).alias("mark"))
    here = F.col("key").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_print"))
    cleared = asked.join(decided, here, "left_anti").select("row.*")
    least = F.struct(*[F.col(f"row.`{f.name}`") for f in docs.schema if _sortable(f.dataType)])
    repeated = asked.join(decided.filter(~F.col("_goes")), here, "left_semi")
    repeated = repeated.groupBy("key", "mark").agg(F.min_by("row", least).alias("row")).select("row.*")
    return untouched.unionAll(cleared).unionAll(repeated)
