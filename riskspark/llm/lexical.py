"""Ranked lexical search of many queries at once, over common subexpressions.

Items of a benchmark share terms. Terms that occur in the same items form one
set, and sets that go together in two or more items are joined in pairs, again
and again: the graph of shared sets. For a block of documents the accumulator
of every node of the graph is computed once, from those of its parts, and an
item's scores are the sum of the few nodes that make it up. Documents are cut
into words once; what remains of a text is the places and counts of its query
terms. Each task keeps the best documents of every item.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import give_back, small_batches
from riskspark.sources.scratch import scratch_path, stored

_SLICE = 1 << 20
# Letters and digits of ASCII stay, capitals as small letters, all from 0x80 on stays, the rest parts words.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


@dataclass(frozen=True)
class Search:
    """``best``: documents per item. Items are met in blocks of ``block_bytes`` of terms (or one larger item);
    sets are mined among items of ``shared_terms`` terms together. ``cells``: numbers held at a time while scoring.
    """

    best: int = 20
    block_bytes: int = 8 << 20
    shared_terms: int = 16_384
    cells: int = 1 << 21


def term_counts(text: bytes | None) -> Counter:
    """How often each term occurs in a whole UTF-8 text, cut in slices."""
    found: Counter = Counter()
    data, at = (text or b"").translate(_TERM_BYTES), 0
    while at < len(data):
        cut = data.find(b" ", at + _SLICE) if len(data) - at > _SLICE else len(data)
        cut = len(data) if cut < 0 else cut
        found.update(data[at:cut].split())
        at = cut
    return found


# -- the query-sharing graph --------------------------------------------------


def share(items: Sequence[dict[int, int]]) -> dict:
    """Graph of the term sets that the items (term number -> repeats) share.

    ``terms``: the term numbers, nodes 0, 1, ... . ``steps``: (node, parts,
    factor): the node is the factor times the sum of its parts, which come
    earlier. ``items``: the nodes whose sum is an item. ``nodes``: their number.
    """
    within: dict[tuple[int, int], int] = defaultdict(int)
    for i, counts in enumerate(items):
        for term, repeats in counts.items():
            within[term, repeats] |= 1 << i
    terms = sorted({t for t, _ in within})
    place = {t: i for i, t in enumerate(terms)}
    steps: list[tuple[int, list[int], int]] = []
    made = len(terms)

    def node(parts: list[int], factor: int = 1) -> int:
        nonlocal made
        steps.append((made, parts, factor))
        made += 1
        return made - 1

    # Terms of the same items, with the same repeats in each, are one set.
    classes: dict[int, list[int]] = defaultdict(list)
    for (term, repeats), bits in sorted(within.items()):
        classes[bits].append(place[term] if repeats == 1 else node([place[term]], repeats))
    users = {(parts[0] if len(parts) == 1 else node(parts)): bits for bits, parts in classes.items()}
    members = [set() for _ in items]
    for n, bits in users.items():
        if bits & (bits - 1):
            for i in _ones(bits):
                members[i].add(n)
    pairs = Counter(pair for held in members for pair in itertools.combinations(sorted(held), 2))
    heap = [(-n, a, b) for (a, b), n in pairs.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        least, a, b = heapq.heappop(heap)
        both = users[a] & users[b]
        n = both.bit_count()
        if n < 2:
            continue
        if n < -least:  # counted before another pair took some of the items
            heapq.heappush(heap, (-n, a, b))
            continue
        new = node([a, b])
        users[a] &= ~both
        users[b] &= ~both
        users[new] = both
        near: Counter = Counter()
        for i in _ones(both):
            members[i] -= {a, b}
            near.update(members[i])
            members[i].add(new)
        for other, n in near.items():
            if n > 1:
                heapq.heappush(heap, (-n, other, new))
    sums: list[list[int]] = [[] for _ in items]
    for n, bits in sorted(users.items()):
        for i in _ones(bits):
            sums[i].append(n)
    return {"terms": np.array(terms, dtype=np.int64), "steps": steps, "items": sums, "nodes": made}


def _ones(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def evaluate(graph: dict, leaves: np.ndarray) -> np.ndarray:
    """Sums of the items, one row each; ``leaves`` has a row per node, those of the terms filled."""
    for n, parts, factor in graph["steps"]:
        if len(parts) == 2:
            np.add(leaves[parts[0]], leaves[parts[1]], out=leaves[n])
        else:
            np.multiply(leaves[parts].sum(axis=0), factor, out=leaves[n])
    return np.array([leaves[parts].sum(axis=0) for parts in graph["items"]])


# -- Spark jobs ---------------------------------------------------------------


def item_terms(items: DataFrame, *, id: str = "item_id", text: str = "text") -> DataFrame:
    """``item``, ``term`` (UTF-8), ``repeats``. Equal rows count once; unlike texts of one id are one item."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, value in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                found = term_counts(value.as_py())
                columns = [pa.array([owner.as_py()] * len(found), batch.schema.field(0).type), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["item", "term", "repeats"])
        give_back()

    rows = items.select(F.col(id).alias("item"), F.col(text).cast("string").alias("text")).distinct()
    kind = rows.schema["item"].dataType.simpleString()
    return rows.mapInArrow(each, f"item {kind}, term binary, repeats long").groupBy("item", "term").agg(F.sum("repeats").alias("repeats"))


def _blocks(terms: DataFrame, rule: Search) -> DataFrame:
    """``item``, ``block``: items in blocks of a bounded size; an item larger than that is alone."""
    sizes = terms.groupBy("item").agg(F.sum(F.octet_length("term") + 16).alias("size"))
    whole = sizes.agg(F.sum("size")).first()[0] or 0
    group = F.pmod(F.xxhash64("item"), F.lit(-(-whole // rule.block_bytes) or 1))
    before = Window.partitionBy("group").orderBy(F.col("item").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0))
    part = F.floor(start / F.lit(rule.block_bytes))
    return sizes.withColumn("group", group).select("item", F.concat_ws(":", F.col("group").cast("string"), part.cast("string")).alias("block"))


def postings(docs: DataFrame, vocabulary: list[bytes], *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n`` (all terms of the document), ``terms`` (places in the vocabulary), ``counts``."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            sizes, terms, counts, ends = [], [], [], [0]
            for value in batch.column(1).cast(pa.binary()):
                found = term_counts(value.as_py())
                sizes.append(found.total())
                for term, n in found.items():
                    at = known.get(term)
                    if at is not None:
                        terms.append(at)
                        counts.append(n)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])
        give_back()

    rows = docs.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(each, "doc_id long, n long, terms array<int>, counts array<long>")


def _top(parts: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The k best of each item from rows (item, score, no id, doc_id), equal scores by id, NULL last."""
    item, score, missing, doc = (np.concatenate([p[i] for p in parts]) for i in range(4))
    order = np.lexsort((doc, missing, -score, item))
    item = item[order]
    first = np.searchsorted(item, item, side="left")
    order = order[np.arange(len(item)) - first < k]
    return tuple(np.concatenate([p[i] for p in parts])[order] for i in range(4))


def scores(found: DataFrame, graphs: list[dict], weights: np.ndarray, documents: int, length: int, rule: Search) -> DataFrame:
    """``item`` (place in the block), ``doc_id``, ``score``: the best documents of each item in each task."""
    held = found.sparkSession.sparkContext.broadcast((graphs, weights))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graphs, weights = held.value
        places = []
        for graph in graphs:
            place = np.full(len(weights), -1, dtype=np.int64)
            place[graph["terms"]] = np.arange(len(graph["terms"]))
            places.append(place)
        many = sum(len(g["items"]) for g in graphs)
        kept = tuple(np.zeros(0, np.int64) for _ in range(4))
        least = np.ones(many, dtype=np.int64)  # a score below this is not among an item's best
        step = max(16, rule.cells // max(1, max(g["nodes"] for g in graphs)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                own = part.column("doc_id")
                missing = own.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = own.fill_null(0).to_numpy()
                terms = part.column("terms").flatten().to_numpy()
                counts = part.column("counts").flatten().to_numpy()
                lengths = part.column("terms").value_lengths().to_numpy()
                of = np.repeat(np.arange(part.num_rows), lengths)
                m = np.array([75 + 25 * n * documents // length for n in part.column("n").to_pylist()], dtype=np.int64)
                value = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 12 * m[of]))
                before, fresh = 0, [kept]
                for graph, place in zip(graphs, places):
                    cells = np.zeros((graph["nodes"], part.num_rows), dtype=np.int64)
                    here = place[terms]
                    mine = here >= 0
                    cells[here[mine], of[mine]] = value[mine]
                    score = evaluate(graph, cells)
                    i, d = np.nonzero(score >= least[before : before + len(score), None])
                    fresh.append((i + before, score[i, d], missing[d], ids[d]))
                    before += len(score)
                kept = _top(fresh, rule.best)
                full = np.bincount(kept[0], minlength=many) == rule.best
                lowest = np.full(many, np.iinfo(np.int64).max)
                np.minimum.at(lowest, kept[0], kept[1])
                least[full] = lowest[full]
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept[0].astype(np.int32)), pa.array(kept[3], mask=kept[2].astype(bool)), pa.array(kept[1])], ["item", "doc_id", "score"]
        )
        give_back()

    return found.mapInArrow(each, "item int, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, rule: Search = Search(), *, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the best documents of each item, all of whose scores are above 0.

    A term is a run of ASCII letters and digits and of all other code points
    from U+0080 on; A-Z are lower-cased. Equal scores are ranked by ``doc_id``,
    NULL last. A document is a row; rows that repeat are documents of their own.
    A text that is NULL, empty or without a term matches nothing and is no part
    of the statistics. Equal rows of ``items`` count once, unlike texts of one
    id are one item, NULL is an id. Other columns are ignored. An empty table on
    either side gives an empty one.
    """
    spark: SparkSession = docs.sparkSession
    terms = stored(item_terms(items, id=item, text=item_text), "item-terms")
    kind = terms.schema["item"].dataType.simpleString()
    blocks = stored(_blocks(terms, rule), "item-blocks")
    out, shape = scratch_path(spark, "ranked"), f"item_id {kind}, rank int, doc_id long, score long"
    spark.createDataFrame([], shape).write.parquet(out)
    for block in sorted(r[0] for r in blocks.select("block").distinct().collect()):
        # The terms of a block, of a bounded size, come to the driver.
        mine: dict = defaultdict(dict)
        here = terms.alias("t").join(blocks.filter(F.col("block") == block).alias("b"), F.col("t.item").eqNullSafe(F.col("b.item")))
        for r in here.select("t.item", "term", "repeats").collect():
            mine[r["item"]][bytes(r["term"])] = r["repeats"]
        _search_block(docs, mine, kind, rule, id, text).write.mode("append").parquet(out)
    return spark.read.schema(shape).parquet(out)


def _search_block(docs: DataFrame, mine: dict, kind: str, rule: Search, id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    names = sorted(mine, key=lambda x: (x is not None, x))
    vocabulary = sorted({t for counts in mine.values() for t in counts})
    number = {t: i for i, t in enumerate(vocabulary)}
    found = stored(postings(docs, vocabulary, id=id, text=text).filter("n > 0"), "postings")
    whole = found.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    held = found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for r in held:
        weights[r["term"]] = math.floor(1000 * math.log((2 * whole.documents + 2) / (2 * r["count"] + 1)))
    graphs, some, size = [], [], 0
    for name in names:
        counts = {number[t]: n for t, n in mine[name].items()}
        if some and size + len(counts) > rule.shared_terms:
            graphs.append(share(some))
            some, size = [], 0
        some.append(counts)
        size += len(counts)
    graphs.append(share(some))
    best = scores(found, graphs, weights, whole.documents, whole.length or 1, rule)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    # Ranked in two steps, so that the rows of all tasks for an item do not meet at once.
    for by in (["item", F.pmod(F.xxhash64("doc_id"), F.lit(64))], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= rule.best)
    named = spark.createDataFrame(list(enumerate(names)), f"place int, item_id {kind}")
    return best.join(F.broadcast(named), F.col("item") == F.col("place")).select("item_id", "rank", "doc_id", "score")
