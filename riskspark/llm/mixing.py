"""Systematic sampling of documents so that sources meet target weights.

Within a source every document has the same expected number of copies, the
source's target over its size. Expected copies are summed along an order by
size, one random offset is added, and a document is emitted once per integer
boundary that its part of the sum crosses. The order goes from large to small:
neighbours have nearly the same size, and the rate of the smaller ones makes up
for what the few largest took too much or too little.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import fresh, ranked, word_count
from riskspark.sources.scratch import stored

#: No source is taken more often than this, so no document is either.
MOST_COPIES = 3
#: A document is in level k if its size times the first k of these is at most its source's size.
LEVELS = (10, 40, 160, 640)


@dataclass(frozen=True)
class Mixing:
    """``weights`` are dealt to the sources in code-point order, again and again; ``seed`` moves the offsets."""

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = MOST_COPIES
    seed: int = 17


def source_targets(sizes: DataFrame, plan: Mixing) -> DataFrame:
    """One row per source: ``_source``, ``_source_size``, ``_target``, ``_offset``.

    Targets share the sum of all sizes by weight; one that exceeds ``most`` times
    its source stops there and its excess is shared by the others, until none
    is above. NULL is a source, the last. Sums are whole numbers, so the
    targets do not depend on the order of summation.
    """
    sums = sizes.groupBy("_source").agg(F.sum("_size").cast("long").alias("_source_size"))
    placed = ranked(sums, [], [F.col("_source").asc_nulls_last()], "_place")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in plan.weights]), (F.col("_place") % len(plan.weights) + 1).cast("int"))
    sources = stored(
        placed.select("_source", "_source_size", weight.cast("decimal(38,0)").alias("_weight"), (plan.most * F.col("_source_size")).cast("decimal(38,0)").alias("_cap")),
        "sources",
    )
    total = int(sources.agg(F.sum("_source_size")).first()[0] or 0)
    num, den, capped = total, 1, -1
    while True:
        # One row per round comes to the driver: sums over the capped and the others.
        over = F.col("_weight") * F.lit(num) > F.col("_cap") * F.lit(den)
        if capped < 0:
            over = F.lit(False)
        row = sources.agg(
            F.count_if(over).alias("n"),
            F.sum(F.when(over, F.col("_cap")).otherwise(0)).alias("held"),
            F.sum(F.when(over, 0).otherwise(F.col("_weight"))).alias("rest"),
        ).first()
        if row.n == capped or not row.rest:
            break
        num, den, capped = total - int(row.held or 0), int(row.rest), row.n
    share = (F.col("_weight") * F.lit(num)).cast("double") / F.lit(float(den))
    target = F.when(F.col("_weight") * F.lit(num) > F.col("_cap") * F.lit(den), F.col("_cap").cast("double")).otherwise(share)
    name = F.concat(F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit("null")), F.lit(f":{plan.seed}"))
    offset = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return sources.select("_source", "_source_size", target.alias("_target"), offset.alias("_offset"))


def copies(docs: DataFrame, plan: Mixing = Mixing(), *, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``_id``, ``_size``, ``_source_size``, ``_target`` and ``_copies`` (0 or more) of every row.

    A NULL text has size 0. A source without words has target 0 and no copies.
    Rows that repeat are counted and sampled as rows of their own. An empty
    table gives an empty one. Other columns are ignored.
    """
    sized = docs.select(F.col(source).alias("_source"), word_count(F.col(text)).alias("_size"), F.col(id).alias("_id"))
    # Sorting evaluates the rows twice, so what is computed from texts is written before.
    return _sampled(stored(sized, "sizes"), plan)


def _sampled(sized: DataFrame, plan: Mixing) -> DataFrame:
    """The rows of ``sized`` (``_source``, ``_size``, ``_id`` and more) with what ``copies`` adds."""
    targets = source_targets(sized.select("_source", "_size"), plan)
    placed = ranked(sized, ["_source"], [F.col("_size").desc(), F.col("_id").asc_nulls_last()], "_place")
    known = targets.withColumnRenamed("_source", "_target_source")
    # Largest documents first: level 0 has those over a tenth of their source, and so on.
    level = sum(F.when(F.col("_size") * step <= F.col("_source_size"), 1).otherwise(0) for step in LEVELS)
    rows = placed.join(known, F.col("_source").eqNullSafe(F.col("_target_source"))).drop("_target_source").withColumn("_level", level)
    steps = _rates(rows, plan)
    same = F.col("_source").eqNullSafe(F.col("_rate_source")) & (F.col("_level") == F.col("_rate_level"))
    done = rows.join(steps, same).withColumn("_copies", _crossed())
    return done.drop("_offset", "_place", "_level", "_rate_source", "_rate_level", "_rate", "_base", "_start")


def _crossed() -> Column:
    """Integer boundaries between a document's prefix sum and the one before."""
    reach = lambda place: F.floor(F.col("_base") + F.col("_rate") * place + F.col("_offset"))
    place = F.col("_place") - F.col("_start")
    return (reach(place + 1) - reach(place)).cast("int")


def _rates(rows: DataFrame, plan: Mixing) -> DataFrame:
    """Expected copies of a document by source and level, with where the level's prefix sum begins.

    The large documents of a source are few, and what they take may miss their
    share; the next level's rate makes up for it, within 0 and ``most``.
    """
    sums = rows.groupBy("_source", "_level", "_source_size", "_target", "_offset").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("_size").alias("_words"), F.min("_place").alias("_start")
    )
    sums = stored(sums, "level-sums")
    state = sums.groupBy("_source", "_target", F.col("_source_size").alias("_left")).agg(
        F.lit(0.0).alias("_next"), F.lit(0).cast("long").alias("_taken")
    )
    known = None
    for k in range(len(LEVELS) + 1):
        here = sums.filter(F.col("_level") == k).select(F.col("_source").alias("_s"), "_rows", "_words", "_start")
        wanted = F.greatest(F.lit(0.0), F.least(F.lit(float(plan.most)), (F.col("_target") - F.col("_taken")) / F.col("_left")))
        state = stored(
            state.join(here, F.col("_source").eqNullSafe(F.col("_s")), "left").withColumn(
                "_rate", F.when(F.col("_left") > 0, wanted).otherwise(F.lit(0.0))
            ),
            "level-state",
        )
        step = state.filter(F.col("_s").isNotNull() | F.col("_rows").isNotNull()).select(
            F.col("_source").alias("_rate_source"), F.lit(k).alias("_rate_level"), "_rate", F.col("_next").alias("_base"), "_start"
        )
        same = F.col("_source").eqNullSafe(F.col("_rate_source")) & (F.col("_level") == F.col("_rate_level"))
        taken = (
            rows.filter(F.col("_level") == k)
            .join(step, same)
            .groupBy(F.col("_source").alias("_t"))
            .agg(F.sum(_crossed() * F.col("_size")).alias("_now"))
        )
        known = step if known is None else known.union(step)
        state = state.join(taken, F.col("_source").eqNullSafe(F.col("_t")), "left").select(
            "_source",
            "_target",
            (F.col("_left") - F.coalesce("_words", F.lit(0))).alias("_left"),
            (F.col("_next") + F.col("_rate") * F.coalesce("_rows", F.lit(0))).alias("_next"),
            (F.col("_taken") + F.coalesce("_now", F.lit(0))).alias("_taken"),
        )
    return known


def _numbered(docs: DataFrame, plan: Mixing, id: str, source: str, text: str) -> tuple[DataFrame, str, DataFrame]:
    """The rows written once with a number each, that number's column, and what ``copies`` finds by ``_row``."""
    row, size = fresh(docs, "_row"), fresh(docs, "_words")
    held = stored(docs.withColumns({row: F.monotonically_increasing_id(), size: word_count(F.col(text))}), "mixed-rows")
    narrow = held.select(F.col(source).alias("_source"), F.col(size).alias("_size"), F.col(id).alias("_id"), F.col(row).alias("_row"))
    return held, row, _sampled(narrow, plan)


def mix(docs: DataFrame, plan: Mixing = Mixing(), *, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixed rows, with the columns of ``docs``; a document taken n times appears n times.

    Rows are written once with a number each. Only numbers, ids and sizes are
    ranked; the texts move once, to meet their copies, and are never sorted.
    NULLs, repeats and empty tables as in ``copies``.
    """
    held, row, sampled = _numbered(docs, plan, id, source, text)
    taken, copy = fresh(held, "_taken"), fresh(held, "_copy")
    wanted = sampled.filter("_copies > 0").select(F.col("_row").alias(taken), F.sequence(F.lit(1), F.col("_copies")).alias(copy))
    # Row numbers are unique, so each task's share of the narrow side fits its memory.
    met = held.join(wanted.hint("shuffle_hash"), F.col(row) == F.col(taken))
    return met.select(*docs.columns, F.explode(copy).alias(copy)).select(*docs.columns)


def marked(docs: DataFrame, plan: Mixing = Mixing(), *, id: str = "doc_id", source: str = "source", text: str = "text", name: str = "_mix") -> DataFrame:
    """All rows and columns of ``docs``, moved as ``mix`` moves them, and ``name``: struct of ``source_size``, ``target`` and ``copies``.

    Rows that the mix leaves out have 0 copies. A column called ``name`` is
    replaced. NULLs, repeats and empty tables as in ``copies``.
    """
    held, row, sampled = _numbered(docs, plan, id, source, text)
    of, mark = fresh(held, "_of"), fresh(held, "_mark")
    facts = F.struct(F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"))
    met = held.join(sampled.select(F.col("_row").alias(of), facts.alias(mark)).hint("shuffle_hash"), F.col(row) == F.col(of))
    return met.select(*[c for c in docs.columns if c != name], F.col(mark).alias(name))
