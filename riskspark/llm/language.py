"""Language of each word of code-switched text by a linear-chain conditional random field.

A word's features are hashed character n-grams, its affixes and, if it is in
the lexicon of frequent words, the word itself. The field has a learned weight
for each feature and label and for each transition between labels;
forward-backward gives each word's label probabilities. A document gets the
label with the largest expected number of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import give_back, hash_share
from riskspark.sources.scratch import stored

_SLOTS = 1 << 16
#: Letters hashed at a time: bounds the memory of a task whatever the texts' lengths.
_SLICE = 1 << 20


@dataclass(frozen=True)
class WordLabels:
    """``sample_docs``: documents fitted per language, about. ``sample_bytes``: longest of them.

    Every value of the label column is learned. ``lexicon``: most words with a
    weight of their own.
    """

    sample_docs: int = 250
    sample_bytes: int = 20_000
    lexicon: int = 20_000
    least_count: int = 5
    rounds: int = 25
    penalty: float = 1e-6


def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _hash(kind: int, *codes: np.ndarray) -> np.ndarray:
    mixed = np.full(len(codes[0]), kind + 1, dtype=np.uint64)
    for c in codes:
        mixed = (mixed ^ c) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(40)).astype(np.int64) & (_SLOTS - 1)


def words_of(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per text; per feature its slot; per word its first feature; per word its hash.

    A word is a run of letters, in lower case. There is at least one text.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "replace"), dtype=np.uint32)
    is_letter = letters[codes]
    ends = is_letter.copy()
    ends[:-1] &= ~is_letter[1:]
    keep = is_letter | np.concatenate(([False], ends[:-1]))
    # Letters of all words in a row, each word followed by one 0.
    line = np.where(is_letter, codes, 0)[keep].astype(np.uint64)
    limits = np.cumsum([len(t) + 1 for t in lowered])
    counts = np.diff(np.concatenate(([0], np.cumsum(ends)[limits - 1])))
    line = np.concatenate((np.zeros(1, np.uint64), line, np.zeros(2, np.uint64)))
    at = np.flatnonzero(line)
    first = at[line[at - 1] == 0]
    last = at[line[at + 1] == 0]
    n = last - first + 1
    trigrams = _hash(0, line[at - 1], line[at], line[at + 1])
    bigrams = _hash(1, line[at], line[at + 1])
    prefix = _hash(2, line[first], line[first + 1], np.where(n > 1, line[first + 2], 0))
    suffix = _hash(3, line[last], line[last - 1], np.where(n > 1, line[last - 2], 0))
    # Per word: two features per letter, then its affixes.
    begin = np.concatenate(([0], np.cumsum(2 * n + 2)))[:-1]
    slots = np.empty(int((2 * n + 2).sum()), dtype=np.int64)
    word = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    slots[begin[word] + 2 * inner] = trigrams
    slots[begin[word] + 2 * inner + 1] = bigrams
    slots[begin + 2 * n] = prefix
    slots[begin + 2 * n + 1] = suffix
    weighed = (line[at] * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(7)) * (inner.astype(np.uint64) * np.uint64(2) + np.uint64(0x94D049BB133111EB))
    weighed ^= weighed >> np.uint64(31)
    whole = np.add.reduceat(weighed, np.cumsum(n) - n) if len(n) else np.zeros(0, np.uint64)
    return counts, slots, begin, whole


def emissions(slots: np.ndarray, begin: np.ndarray, whole: np.ndarray, model: dict) -> np.ndarray:
    """Score of each label for each word."""
    if not len(begin):
        return np.zeros((0, len(model["labels"])), np.float32)
    score = np.add.reduceat(model["weights"][slots], begin, axis=0)
    place = np.searchsorted(model["words"], whole)
    place[place == len(model["words"])] = 0
    known = model["words"][place] == whole if len(model["words"]) else np.zeros(len(whole), bool)
    score[known] += model["word_weights"][place[known]]
    return score


def forward_backward(score: np.ndarray, counts: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities of each word, and the forward and backward messages.

    All texts advance together, word by word; each step handles the texts that
    are that long.
    """
    local = np.exp(score - score.max(axis=1, keepdims=True))
    step = np.exp(change - change.max()).astype(local.dtype)
    order = np.argsort(-counts, kind="stable")
    length = counts[order]
    start = (np.cumsum(counts) - counts)[order]
    longest = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(longest), side="left")
    ahead, back = np.empty_like(local), np.ones_like(local)
    message = None
    for t in range(longest):
        n = alive[t]
        at = start[:n] + t
        message = local[at] if message is None else (message[:n] @ step) * local[at]
        message = message / message.sum(axis=1, keepdims=True)
        ahead[at] = message
    message = np.ones((len(length), local.shape[1]), local.dtype)
    for t in range(longest - 2, -1, -1):
        n = alive[t + 1]
        at = start[:n] + t
        message[:n] = (message[:n] * local[at + 1]) @ step.T
        message[:n] /= message[:n].sum(axis=1, keepdims=True)
        back[at] = message[:n]
    both = ahead * back
    return both / np.maximum(both.sum(axis=1, keepdims=True), 1e-30), ahead, back


def fit(texts: list[str], langs: list[str], rule: WordLabels = WordLabels()) -> dict:
    """Learn from documents with one label each.

    First every word has its document's label and no transitions are used.
    Words are then labelled by that model with a mild preference to stay, and
    weights and transitions are learned from the labelled sequences.
    """
    labels = sorted(set(langs))
    k = len(labels)
    if not texts:
        nothing = np.zeros((0, 0), np.float32)
        return {"labels": [], "weights": np.zeros((_SLOTS, 0), np.float32), "words": np.zeros(0, np.uint64), "word_weights": nothing, "change": nothing}
    letters = _letters()
    counts, slots, begin, whole = words_of(texts, letters)
    types, one, type_of = np.unique(whole, return_index=True, return_inverse=True)
    often = np.bincount(type_of, minlength=len(types))
    frequent = np.argsort(-often, kind="stable")[: rule.lexicon]
    frequent = np.sort(frequent[often[frequent] >= rule.least_count])
    width = np.diff(np.concatenate((begin, [len(slots)])))
    lengths = width[one]
    first = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(types)), lengths)
    slot = slots[np.repeat(begin[one] - first, lengths) + np.arange(int(lengths.sum()))]
    model = {"labels": labels, "weights": np.zeros((_SLOTS, k), np.float32), "words": types[frequent], "word_weights": np.zeros((len(frequent), k), np.float32), "change": np.zeros((k, k))}
    gold = np.repeat([labels.index(x) for x in langs], counts)
    inside = np.ones(len(whole), bool)
    inside[np.cumsum(counts)[counts > 0] - 1] = False
    before = np.flatnonzero(inside)
    for sequences in (False, True):
        squares = [np.full_like(model[x], 1e-6, dtype=np.float64) for x in ("weights", "word_weights", "change")]
        goal = np.eye(k, dtype=np.float32)[gold]
        for _ in range(rule.rounds if len(whole) else 0):
            score = emissions(slot, first, types, model)[type_of]
            if sequences:
                chance, ahead, back = forward_backward(score, counts, model["change"])
            else:
                chance = np.exp(score - score.max(axis=1, keepdims=True))
                chance /= chance.sum(axis=1, keepdims=True)
            missing = np.stack([np.bincount(type_of, weights=(goal - chance)[:, j], minlength=len(types)) for j in range(k)], axis=1)
            steps = [
                np.stack([np.bincount(slot, weights=missing[owner, j], minlength=_SLOTS) for j in range(k)], axis=1) / len(whole),
                missing[frequent] / len(whole),
                np.zeros((k, k)),
            ]
            if sequences and len(before):
                move = np.exp(model["change"] - model["change"].max())
                local = np.exp(score - score.max(axis=1, keepdims=True))
                # Expected moves, summed over the words without a square of labels for each.
                after = local[before + 1] * back[before + 1]
                whole_chance = ((ahead[before] @ move) * after).sum(axis=1, keepdims=True)
                seen = np.zeros((k, k))
                np.add.at(seen, (gold[before], gold[before + 1]), 1.0)
                steps[2] = (seen - move * ((ahead[before] / whole_chance).T @ after)) / len(whole)
            for name, step, square in zip(("weights", "word_weights", "change"), steps, squares):
                step = step - rule.penalty * model[name]
                square += step**2
                model[name] = (model[name] + 0.3 * step / np.sqrt(square)).astype(model[name].dtype)
        if not sequences and len(whole):
            stay = np.log(np.full((k, k), 0.05 / max(1, k - 1)) + np.eye(k) * 0.95)
            gold = forward_backward(emissions(slot, first, types, model)[type_of], counts, stay)[0].argmax(axis=1)
            model["change"] = stay
    return model


def sample(docs: DataFrame, rule: WordLabels, *, id: str, text: str, lang: str) -> list:
    """At most about ``sample_docs`` labelled rows per language, chosen by a hash of the id.

    Of a language without a text of ``sample_bytes``, longer texts are chosen
    and the words of a stretch of each, at a place given by a hash, are taken.
    """
    named = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    named = named.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).withColumn("_short", F.octet_length("text") <= rule.sample_bytes)
    known = stored(named.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"), F.count_if("_short").alias("_shorts")), "languages")
    chars = rule.sample_bytes // 4
    start = F.floor(hash_share(F.col("id"), F.lit("stretch")) * F.greatest(F.length("text") - chars, F.lit(1))).cast("int")
    # Where no blank is near, the stretch stands as it is cut.
    stretch = F.substring(F.col("text"), start + 1, F.lit(chars))
    stretch = F.when(F.regexp_like(stretch, F.lit(r"\s\S[\s\S]*\s")), F.regexp_replace(stretch, r"^\S*\s|\s\S*$", " ")).otherwise(stretch)
    wanted = F.col("_short") | (F.col("_shorts") == 0)
    share = rule.sample_docs / F.when(F.col("_shorts") > 0, F.col("_shorts")).otherwise(F.col("_rows"))
    chosen = named.join(known, "lang").filter(wanted & (hash_share(F.col("id"), F.col("text"), F.lit("language")) < share))
    return chosen.select(F.when(F.col("_short"), F.col("text")).otherwise(stretch).alias("text"), "lang").collect()


def predict(docs: DataFrame, model: dict, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``words`` (labelled words) of every whole text.

    ``score`` is the label's share of the expected words. A text that is NULL
    or has no letter is ``und`` with score 0, and so is every text under a model
    without labels. Other columns are ignored; repeated rows are scored alike.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = held.value, _letters()

        def answer(texts: list[str | None]) -> tuple[list, list, list]:
            texts = [t or "" for t in texts]
            scores, counts, at = [], [], 0
            while at < len(texts):  # features of a bounded slice at a time, then one pass over all
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop]) <= _SLICE):
                    size += len(texts[stop])
                    stop += 1
                count, slots, begin, whole = words_of(texts[at:stop], letters)
                counts.append(count)
                scores.append(emissions(slots, begin, whole, model))
                at = stop
            counts, score = np.concatenate(counts), np.concatenate(scores)
            total = np.zeros((len(counts), max(1, len(model["labels"]))))
            if len(score) and len(model["labels"]):
                chance = forward_backward(score, counts, model["change"])[0]
                some = counts > 0
                total[some] = np.add.reduceat(chance.astype(np.float64), (np.cumsum(counts) - counts)[some], axis=0)
            best = total.argmax(axis=1)
            share = total[np.arange(len(total)), best] / np.maximum(counts, 1)
            names = [model["labels"][b] if n and model["labels"] else "und" for b, n in zip(best, counts)]
            return names, np.clip(share, 0.0, 1.0).tolist(), counts.tolist()

        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            names, shares, sizes = [], [], []
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size < 8 * _SLICE):
                    size += len(texts[stop] or "")
                    stop += 1
                for out, part in zip((names, shares, sizes), answer(texts[at:stop])):
                    out += part
                at = stop
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(sizes, pa.int64())], ["doc_id", "lang_pred", "score", "words"])
        give_back()

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(each, "doc_id long, lang_pred string, score double, words long")


def label(docs: DataFrame, train: DataFrame, rule: WordLabels = WordLabels(), *, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Fit on a bounded sample of ``train`` and predict every row of ``docs``."""
    rows = sample(train, rule, id=id, text=text, lang=lang)
    return predict(docs, fit([r["text"] for r in rows], [r["lang"] for r in rows], rule), id=id, text=text)
