"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model is over characters, three at a time, and is trained on all trusted
texts: every task counts the triples of its texts, the counts are summed in
shards by triple, and continuation counts, discounts, context totals and
probabilities come from joins of those shards. All code points are told apart.
Scoring is a join as well: the triples of all documents, each once, meet the
sharded counts and get their cost; then the triples that the documents of a
block hold, with their numbers, meet the shard of that table which has them.
No task and no driver holds the model. A document is accepted if its perplexity
is not above a quantile of the trusted documents of its language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import fresh, give_back, small_batches, split_by_ids
from riskspark.sources.scratch import stored

#: Characters counted at a time, whatever the texts' lengths: a block.
_SLICE = 1 << 20
_START = 0x110000  # stands twice before a text; no code point
_BITS = 21  # of a character in a key
#: Keys of the cost table in a shard, keys in a row of it, and blocks that meet one copy of a shard.
_SHARD, _CHUNK, _UNIT = 1 << 17, 1 << 12, 16
_PRIME = 1_000_003
#: Costs are whole numbers of 2**-24 nats, so that sums do not depend on their order.
_NAT = 1 << 24


@dataclass(frozen=True)
class Perplexity:
    """``quantile`` and ``slack``: a document is accepted up to ``slack`` times the
    quantile of the trusted documents of its language. ``shrink``: characters of
    average text added to each document, so that short ones do not stray.
    """

    quantile: float = 0.995
    slack: float = 1.1
    shrink: float = 40.0


@dataclass(frozen=True)
class Model:
    """Probabilities by triple, pair and character, and what contexts leave to the shorter one; all tables.

    ``base`` is the probability of a character that no trusted text has.
    """

    p3: DataFrame
    back3: DataFrame
    p2: DataFrame
    back2: DataFrame
    p1: DataFrame
    base: float


def _blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys of triples, place in ``column`` of the text of each), a bounded number at a time.

    A text that is longer is cut; the cut keeps the two characters before it.
    NULL and empty texts have no triple.
    """
    parts, owners, marks, size = [], [], [], 0

    def packed() -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(p) for p in parts])
        begin = np.cumsum(lengths) - lengths
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
        before = np.array(marks)
        codes[begin[before > 0]] = _START
        codes[begin[before > 1] + 1] = _START
        keys = (codes[:-2] << 2 * _BITS) | (codes[1:-1] << _BITS) | codes[2:]
        real = np.ones(len(codes), bool)
        real[begin], real[begin + 1] = False, False
        return keys[real[2:]], np.repeat(np.array(owners), lengths - 2)

    for place, value in enumerate(column):
        text, at = value.as_py() or "", 0
        while at < len(text):
            stop = min(len(text), at + _SLICE - size)
            marks.append(max(0, 2 - at))
            parts.append(" " * marks[-1] + text[max(0, at - 2) : stop])
            owners.append(place)
            size += stop - at
            at = stop
            if size == _SLICE:
                yield packed()
                parts, owners, marks, size = [], [], [], 0
    if parts:
        yield packed()


def triples(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``key`` (three code points, see ``_parts``), ``n``: how often the triple is in the texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for found, _ in _blocks(batch.column(0)):
                own, times = np.unique(found, return_counts=True)
                keys, place = np.unique(np.concatenate((keys, own)), return_inverse=True)
                counts = np.bincount(place, weights=np.concatenate((counts, times)), minlength=len(keys)).astype(np.int64)
                if len(keys) > _SLICE:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])
                    keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])
        give_back()

    small_batches(docs.sparkSession)
    parts = docs.select(F.col(text).cast("string")).mapInArrow(each, "key long, n long")
    return parts.groupBy("key").agg(F.sum("n").alias("n"))


def _parts() -> list[Column]:
    """``a``, ``b``, ``c``: the code points of ``key``."""
    mask = F.lit((1 << _BITS) - 1)
    return [F.shiftright("key", shift).bitwiseAND(mask).cast("int").alias(name) for name, shift in (("a", 2 * _BITS), ("b", _BITS), ("c", 0))]


def _discounts(counts: DataFrame, column: str) -> tuple[float, float, float]:
    """Modified discounts for counts of 1, 2, and 3 or more, from how many counts are 1, 2, 3, 4."""
    n = counts.agg(*[F.count_if(F.col(column) == i) for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (int(x or 0) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


def _discount(count: Column, d: tuple[float, float, float]) -> Column:
    return F.when(count == 1, d[0]).when(count == 2, d[1]).otherwise(d[2])


def _held(d: tuple[float, float, float]) -> Column:
    """What the discounts take from a group of counts ``n``."""
    return sum(d[i - 1] * F.count_if(F.col("n") == i if i < 3 else F.col("n") >= 3) for i in (1, 2, 3))


def train(trusted: DataFrame, *, text: str = "text") -> Model:
    """Model of all trusted texts.

    What the discounts leave of the single characters is spread evenly over
    those seen and one more, which is any other. Without texts every character
    has the probability 1/2.
    """
    three = stored(triples(trusted, text=text).select(*_parts(), "n"), "counts-3")
    two = stored(three.groupBy("b", "c").agg(F.count(F.lit(1)).alias("n")), "counts-2")
    one = stored(two.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "counts-1")
    d3, d2, d1 = _discounts(three, "n"), _discounts(two, "n"), _discounts(one, "n")

    def contexts(counts: DataFrame, by: list[str], d: tuple[float, float, float], name: str) -> DataFrame:
        return counts.groupBy(*by).agg(F.sum("n").alias(f"total{name}"), (_held(d) / F.sum("n")).alias(f"back{name}"))

    def kept(d: tuple[float, float, float]) -> Column:
        return F.greatest(F.col("n") - _discount(F.col("n"), d), F.lit(0.0))

    whole = one.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), _held(d1).alias("held")).first()
    total = float(whole["total"] or 1)
    base = (float(whole["held"]) / total if whole["total"] else 1.0) / (whole["kinds"] + 2)
    p1 = one.select("c", (kept(d1) / total + base).alias("p1"))
    context2, context3 = contexts(two, ["b"], d2, "2"), contexts(three, ["a", "b"], d3, "3")
    # Tables by one code point have at most 0x110001 rows of two numbers.
    p2 = two.join(F.broadcast(context2), "b").join(F.broadcast(p1), "c")
    p2 = stored(p2.select("b", "c", (kept(d2) / F.col("total2") + F.col("back2") * F.col("p1")).alias("p2")), "pairs")
    p3 = three.join(context3, ["a", "b"]).join(p2, ["b", "c"])
    p3 = p3.select("a", "b", "c", (kept(d3) / F.col("total3") + F.col("back3") * F.col("p2")).alias("p3"))
    return Model(p3, context3.drop("total3"), p2, context2.drop("total2"), p1, base)


def costs(keys: DataFrame, model: Model) -> DataFrame:
    """``key`` and ``cost`` of each of ``keys``: the highest order seen, else the shorter one by the context's share."""
    met = (
        keys.select("key", *_parts())
        .join(model.p3, ["a", "b", "c"], "left")
        .join(model.back3, ["a", "b"], "left")
        .join(model.p2, ["b", "c"], "left")
        .join(F.broadcast(model.back2), "b", "left")
        .join(F.broadcast(model.p1), "c", "left")
    )
    low = F.coalesce("p1", F.lit(model.base))
    middle = F.coalesce("p2", F.coalesce("back2", F.lit(1.0)) * low)
    chance = F.coalesce("p3", F.coalesce("back3", F.lit(1.0)) * middle)
    return met.select("key", F.round(-F.log(chance) * _NAT).cast("long").alias("cost"))


def _counted(docs: DataFrame, shards: int, *, id: str, text: str, lang: str) -> DataFrame:
    """Rows of documents (``id``, ``lang``, ``digest``, ``chars``) and of blocks (``shard``, ``held``), both with ``row``.

    ``row`` numbers the documents, of a block it is its first one's. ``held``
    has a shard's keys of a block and for each key the documents and numbers.
    """
    kinds = {f.name: f.dataType for f in docs.select(F.col(id).alias("id"), F.col(lang).alias("lang")).schema}
    shape = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("id", kinds["id"]), T.StructField("lang", kinds["lang"]), T.StructField("digest", T.StringType()), T.StructField("chars", T.LongType())]
        + [T.StructField("block", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("keys", T.IntegerType()), T.StructField("entries", T.IntegerType()), T.StructField("held", T.BinaryType())]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        block = number
        for batch in batches:
            n = batch.num_rows
            rows = pa.array(np.arange(number, number + n))
            none = lambda kind, size: pa.nulls(size, kind)
            yield pa.RecordBatch.from_arrays(
                [rows, *[batch.column(i) for i in range(4)], none(pa.int64(), n), none(pa.int32(), n), none(pa.int32(), n), none(pa.int32(), n), none(pa.binary(), n)], shape.names
            )
            for keys, owner in _blocks(batch.column(4)):
                own, place = np.unique(keys, return_inverse=True)
                shard = own % _PRIME % shards
                order = np.argsort(shard, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                # Entries along shard, key and document.
                pair, times = np.unique(rank[place] * n + owner, return_counts=True)
                at, owner = pair // n, pair % n
                bounds = np.searchsorted(shard[order], np.arange(shards + 1))
                edges = np.searchsorted(at, bounds)
                out: list[list] = [[], [], [], []]
                for k in np.flatnonzero(np.diff(bounds)):
                    few = slice(edges[k], edges[k + 1])
                    held = own[order[bounds[k] : bounds[k + 1]]]
                    sizes = np.bincount(at[few] - bounds[k], minlength=len(held))
                    raw = held.astype("<i8").tobytes() + b"".join(x.astype("<i4").tobytes() for x in (sizes, owner[few], times[few]))
                    for column, x in zip(out, (int(k), len(held), len(times[few]), pa.compress(raw, codec="zstd", asbytes=True))):
                        column.append(x)
                m = len(out[0])
                ints = [pa.array(x, pa.int32()) for x in out[:3]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * m, pa.int64()), *[none(batch.column(i).type, m) for i in range(4)], pa.array([block] * m, pa.int64()), *ints, pa.array(out[3], pa.binary())], shape.names
                )
                block += 1
            number += n
        give_back()

    small_batches(docs.sparkSession)
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.md5(whole).alias("digest"), F.coalesce(F.length(whole), F.lit(0)).cast("long").alias("chars"), whole.alias("text"))
    return rows.mapInArrow(each, shape)


def score(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``id``, ``lang``, ``digest`` (md5 of the text), ``nats`` and ``chars`` of every row of ``docs``.

    ``nats`` is the negative log probability of the whole text; 0 for one that
    is NULL or empty, as is ``chars``.
    """
    table = stored(costs(triples(docs, text=text).select("key"), model), "costs")
    size = table.count()
    shards = max(1, -(-size // _SHARD))
    counted = stored(_counted(docs, shards, id=id, text=text, lang=lang), "counted")
    blocks = counted.filter("block is not null")
    copies = max(1, -(-blocks.count() // (shards * _UNIT)))
    chunks = max(1, -(-size // (shards * _CHUNK)))
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    fixed = (
        table.groupBy((F.col("key") % _PRIME % shards).cast("int").alias("shard"), F.pmod(F.xxhash64("key"), F.lit(chunks)).alias("chunk"))
        .agg(F.collect_list(F.struct("key", "cost")).alias("rows"))
        .select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("copy"), F.col("rows.key").alias("own"), F.col("rows.cost").alias("cost"))
        .select("shard", "copy", "own", "cost", *[nothing(k, n) for k, n in (("long", "row"), ("int", "keys"), ("int", "entries"), ("binary", "held"))])
    )
    moved = blocks.select("shard", F.pmod(F.xxhash64("block"), F.lit(copies)).alias("copy"), nothing("array<long>", "own"), nothing("array<long>", "cost"), "row", "keys", "entries", "held")
    # A copy of a shard's costs comes first, then the blocks that it serves.
    met = fixed.unionByName(moved).repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("row").asc_nulls_first())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, parts, keys, price = None, [], None, None
        for batch in batches:
            shard, copy = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first, sizes, entries, held = (batch.column(i) for i in (4, 5, 6, 7))
            for i in range(batch.num_rows):
                if unit != (shard[i], copy[i]):
                    unit, parts, keys = (shard[i], copy[i]), [], None
                if not first[i].is_valid:
                    parts.append([np.asarray(batch.column(c)[i].values) for c in (2, 3)])
                    continue
                if keys is None:
                    keys, price = (np.concatenate([p[c] for p in parts]) for c in (0, 1))
                    order = np.argsort(keys)
                    keys, price, parts = keys[order], price[order], []
                n, m = sizes[i].as_py(), entries[i].as_py()
                raw = pa.decompress(held[i].as_py(), 12 * n + 8 * m, codec="zstd", asbytes=True)
                own = np.frombuffer(raw, "<i8", n)
                many, owner, times = np.split(np.frombuffer(raw, "<i4", n + 2 * m, 8 * n), (n, n + m))
                place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                if not np.array_equal(keys[place], own):
                    raise ValueError("the documents changed while they were scored")
                # Whole numbers far below 2**53, as a block has a bounded number of characters.
                found = np.bincount(owner, weights=np.repeat(price[place], many) * times)
                some = np.unique(owner).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(some + first[i].as_py(), pa.int64()), pa.array(found[some].astype(np.int64))], ["row", "cost"])
        give_back()

    sums = met.mapInArrow(each, "row long, cost long").groupBy("row").agg(F.sum("cost").alias("cost"))
    return counted.filter("block is null").join(sums, "row", "left").select("id", "lang", "digest", (F.coalesce("cost", F.lit(0)) / _NAT).alias("nats"), "chars")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the documents with a label of good quality, each once."""
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def judge(docs: DataFrame, good_ids: DataFrame, rule: Perplexity = Perplexity(), *, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``id``, ``lang``, ``digest`` (md5 of the text), ``perplexity``, ``threshold`` and ``accepted`` of every row of ``docs``.

    ``good_ids`` lists the trusted documents in one column. The threshold of a
    language without trusted documents, NULL being a language, is that of all
    trusted ones. A text that is NULL or empty has no perplexity and is not
    accepted. Without trusted documents there is no threshold and everything
    else is accepted. Repeated rows are judged alike; other columns are ignored.
    """
    ids = stored(good_ids.toDF("_good"), "trusted-ids")
    filled = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).filter(F.col("text").isNotNull() & (F.length("text") > 0))
    known = F.col("id") == F.col("_good")
    # Only texts that may be trusted move, once, to meet their ids.
    model = train(split_by_ids(filled, "id", ids)[1].join(ids.hint("merge"), known, "left_semi"))
    scores = stored(score(docs, model, id=id, text=text, lang=lang), "scores")
    figures = scores.filter("chars > 0").join(ids, known, "left_semi")
    mean = figures.agg(F.sum(F.round(F.col("nats") * _NAT).cast("long")) / F.sum("chars")).first()[0] or 0.0
    perplexity = F.when(F.col("chars") > 0, F.exp((F.col("nats") + rule.shrink * mean / _NAT) / (F.col("chars") + rule.shrink)))
    limit = F.percentile_approx(perplexity, F.lit(rule.quantile), F.lit(10_000)) * rule.slack
    by_lang = figures.groupBy("lang").agg(limit.alias("_limit")).withColumnRenamed("lang", "_lang")
    overall = figures.agg(limit).first()[0]
    threshold = F.coalesce("_limit", F.lit(overall).cast("double"))
    accepted = F.coalesce(perplexity <= F.coalesce(threshold, F.lit(float("inf"))), F.lit(False))
    judged = scores.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    return judged.select("id", "lang", "digest", perplexity.alias("perplexity"), threshold.alias("threshold"), accepted.alias("accepted"))


def keep(docs: DataFrame, good_ids: DataFrame, rule: Perplexity = Perplexity(), *, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``judge`` accepts, with all their columns.

    Rows that surely are accepted do not move: those that are not are listed by
    a hash, and only rows with a listed one are compared by id, language and text.
    """
    mark = lambda *columns: F.xxhash64(*columns)
    judged = judge(docs, good_ids, rule, id=id, text=text, lang=lang).filter(~F.col("accepted"))
    out = stored(judged.select(mark("id", "lang", "digest").alias("_out"), F.col("id").alias("_out_id"), F.col("lang").alias("_out_lang"), F.col("digest").alias("_out_digest")).distinct(), "rejected")
    name, digest = fresh(docs, "_mark"), fresh(docs, "_digest")
    marked = docs.withColumn(digest, F.md5(F.col(text).cast("string"))).withColumn(name, mark(id, lang, digest))
    sure, maybe = split_by_ids(marked, name, out.select("_out").distinct())
    others = out.toDF(*[fresh(marked, c) for c in out.columns])
    hashed, *same = others.columns
    meet = F.col(name) == F.col(hashed)
    for own, other in zip((id, lang, digest), same):
        meet = meet & F.col(own).eqNullSafe(F.col(other))
    return sure.unionByName(maybe.join(others, meet, "left_anti")).select(*docs.columns)
