"""Toxicity of documents by a weighted finite-state grammar over clauses.

A lexical transducer turns words into classes: insult, threat, target, negation,
reported speech, other. Insults are learned from labelled documents, as words
or as beginnings of words; the other classes are short lists. Small machines
remember a recent negation, a recent target and speech reported in the clause;
their composition is one transition table, and a clause is scored by the path
of its classes through it. Weights of the matched kinds of clauses are fitted
to the labels.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import fresh, give_back, hash_share, small_batches
from riskspark.sources.scratch import stored

# Words of the grammar's closed classes in English, German, French and Spanish.
TARGETS = (
    "you", "your", "you're", "yourself", "he", "she", "they", "him", "her", "them",
    "du", "dich", "dir", "dein", "deine", "ihr", "euch", "sie",
    "tu", "toi", "ton", "ta", "vous", "votre", "il", "elle", "ils",
    "tú", "vosotros", "usted", "ustedes", "él", "ella", "ellos",
)
NEGATIONS = (
    "not", "no", "never", "isn't", "aren't", "don't", "nobody", "without",
    "nicht", "kein", "keine", "nie", "niemals", "ohne",
    "ne", "pas", "jamais", "aucun", "sans",
    "nunca", "jamás", "ningún", "sin",
)
REPORTS = (
    "said", "says", "say", "called", "calls", "wrote", "quoted", "reported", "claimed", "alleged",
    "sagte", "sagt", "nannte", "schrieb", "berichtet", "zitierte",
    "dit", "disait", "appelé", "écrit", "rapporté", "cité",
    "dijo", "dice", "llamó", "escribió", "citó",
)
THREATS = (
    "kill", "murder", "destroy", "hurt", "shoot", "stab", "strangle",
    "umbringen", "töten", "erschießen", "verprügeln",
    "tuer", "tuerai", "frapper", "étrangler",
    "matar", "mataré", "golpear", "destruir",
)

_INSULT, _THREAT, _TARGET, _NEGATION, _REPORT, _OTHER = range(6)
_REACH = 3  # words that a negation or a target reaches
#: Kinds of matches: (insult or threat) x negated x reported x targeted.
KINDS = 16
# What a kind weighs where the labels say nothing: plain and targeted insults count, denied or reported ones hardly.
_PRIOR = np.array([
    (2.0 if kind < 8 else 0.5) + 1.5 * (kind & 1) - 1.5 * bool(kind & 4) - 1.5 * bool(kind & 2) for kind in range(KINDS)
])


@dataclass(frozen=True)
class Grammar:
    """``toxic`` and ``clean``: most labelled documents of each kind learned from, of at most ``sample_bytes``.

    A word, or a beginning of ``stems`` letters, may be an insult if it follows
    or precedes at least ``least`` different words in toxic documents and is
    not more frequent in clean ones; at most ``lexicon`` are considered.
    """

    toxic: int = 2000
    clean: int = 6000
    sample_bytes: int = 50_000
    stems: tuple[int, ...] = (3, 4, 5, 6, 7, 8)
    least: int = 5
    lexicon: int = 4096


def _machine() -> tuple[list[list[int]], list[list[int]]]:
    """Transitions and outputs of the composed machine; output -1 is none, else the kind of match."""
    states = list(itertools.product(range(_REACH + 1), range(2), range(_REACH + 1)))
    number = {s: i for i, s in enumerate(states)}
    moves, outputs = [], []
    for denied, reported, aimed in states:
        move, output = [], []
        for symbol in range(6):
            match = symbol in (_INSULT, _THREAT)
            kind = 8 * (symbol == _THREAT) + 4 * (denied > 0) + 2 * reported + (aimed > 0)
            output.append(kind if match else -1)
            after = (
                _REACH if symbol == _NEGATION else max(0, denied - 1),
                1 if symbol == _REPORT else reported,
                _REACH if symbol == _TARGET else max(0, aimed - 1),
            )
            move.append(number[after])
        moves.append(move)
        outputs.append(output)
    return moves, outputs


class Matcher:
    """The compiled grammar; ``insults`` has the weights of learned words ("=word") and stems."""

    def __init__(self, insults: dict[str, float]):
        words = {w[1:]: x for w, x in insults.items() if w[0] == "="}
        stems = {w: x for w, x in insults.items() if w[0] != "="}
        self.classes = {w: c for c, group in ((_REPORT, REPORTS), (_NEGATION, NEGATIONS), (_TARGET, TARGETS), (_THREAT, THREATS)) for w in group}
        self.words, self.stems, self.lengths = words, stems, sorted({len(s) for s in stems})
        self.moves, self.outputs = _machine()
        self.automaton = ahocorasick.Automaton()
        for w in {*words, *stems, *THREATS}:
            self.automaton.add_word(w, len(w))
        self.automaton.make_automaton()
        self.word = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“„«]")
        self.stop = re.compile(r"[.!?;:\n]+")

    def _class(self, word: str) -> tuple[int, float]:
        """Class of a word and the weight of its arc."""
        if word in ('"', "“", "„", "«"):
            return _REPORT, 0.0
        weight = self.words.get(word)
        if weight is None:
            weight = next((self.stems[word[:n]] for n in self.lengths if word[:n] in self.stems), None)
        return (self.classes.get(word, _OTHER), 1.0) if weight is None else (_INSULT, weight)

    def kinds(self, text: str | None) -> dict[int, float]:
        """Summed arc weights of the matches of each kind over the clauses of a whole text."""
        found: dict[int, float] = {}
        low = (text or "").lower()
        done = 0
        for end, length in self.automaton.iter(low):
            start = end - length + 1
            if start < done or (start and low[start - 1].isalpha()):
                continue
            # The clause around the hit, once.
            stop = self.stop.search(low, end)
            until = stop.start() if stop else len(low)
            since = max(low.rfind(mark, done, start) for mark in ".!?;:\n") + 1 or done
            state = 0
            for word in self.word.findall(low, since, until):
                symbol, weight = self._class(word)
                kind = self.outputs[state][symbol]
                if kind >= 0:
                    found[kind] = found.get(kind, 0.0) + weight
                state = self.moves[state][symbol]
            done = max(until, end + 1)
        return found


def _features(found: dict[int, float], size: int) -> list[float]:
    """Matches of each kind on a log scale, and how dense all are in a text of ``size`` characters."""
    out = [0.0] * (KINDS + 1)
    for kind, weight in found.items():
        out[kind] = math.log1p(weight)
    out[KINDS] = math.log1p(6000.0 * sum(found.values()) / (size + 60.0))
    return out


_WORD = re.compile(r"[^\W\d_]+")


def _entries(words: list[str], rule: Grammar) -> dict[str, str]:
    """Each word and beginning of a document, with the words beside its first place."""
    found: dict[str, str] = {}
    for i, w in enumerate(words):
        if len(w) >= min(rule.stems):
            beside = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
            for entry in ("=" + w, *(w[:n] for n in rule.stems if len(w) > n)):
                found.setdefault(entry, beside)
    return found


def insults(chosen: DataFrame, rule: Grammar) -> dict[str, float]:
    """Words ("=word") and stems that tell toxic documents, with weights; ``chosen`` has ``text`` and ``toxic``.

    Rare words of copied documents stand beside the same words in every copy, so
    an entry is counted by the different words around it. Entries are then
    chosen one by one; a document counts the less the more chosen entries it
    already has, so what merely goes along with insults is not taken.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _entries(_WORD.findall(text.lower()), rule)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.string())], ["entry", "beside"])

    seen = chosen.filter("toxic = 1").select("text").mapInArrow(places, "entry string, beside string")
    often = seen.groupBy("entry").agg(F.count(F.lit(1)).alias("bad"), F.approx_count_distinct("beside").alias("around"))
    often = often.filter((F.col("around") >= rule.least) & (F.col("bad") >= rule.least)).orderBy(F.col("around").desc(), "entry").limit(rule.lexicon)
    candidates = {r["entry"]: i for i, r in enumerate(often.collect())}
    if not candidates:
        return {}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(candidates[e] for e in _entries(_WORD.findall(t.lower()), rule) if e in candidates) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], ["has", "toxic"])

    rows = chosen.select("text", "toxic").mapInArrow(held, "has array<int>, toxic int").collect()
    bad = [np.array(r["has"], dtype=np.int64) for r in rows if r["toxic"] == 1]
    good = [np.array(r["has"], dtype=np.int64) for r in rows if r["toxic"] == 0]
    n = len(candidates)
    count = lambda sets: np.bincount(np.concatenate([np.zeros(0, np.int64), *sets]), minlength=n)
    in_bad, in_good = count(bad), count(good)
    share_bad, share_good = in_bad / max(1, len(bad)), in_good / max(1, len(good))
    odds = np.log((in_bad + 0.5) / (len(bad) + 1)) - np.log((in_good + 0.5) / (len(good) + 1))
    names = sorted(candidates, key=candidates.get)
    owners: list[list[int]] = [[] for _ in range(n)]
    for d, has in enumerate(bad):
        for e in has:
            owners[e].append(d)
    owned = [np.array(o, dtype=np.int64) for o in owners]
    covered = np.zeros(len(bad))
    able = (odds > 1.5) & (share_bad > share_good)
    chosen_entries: dict[str, float] = {}
    while able.any():
        worth = 1.0 / (1.0 + covered)
        gain = np.array([worth[owned[i]].sum() if able[i] else -1.0 for i in range(n)])
        able &= gain >= rule.least
        if not able.any():
            break
        # Among equals a whole word comes before its beginnings, and a long beginning before a short one.
        value = np.where(able, gain * odds, -1.0)
        best = max(np.flatnonzero(value >= value.max() - 1e-9), key=lambda i: (names[i][0] == "=", len(names[i]), names[i]))
        chosen_entries[names[best]] = float(np.clip(odds[best], 0.5, 6.0))
        covered[owned[best]] += 1
        able[best] = False
        for i in np.flatnonzero(able):
            word = names[i].lstrip("=")
            # What a chosen stem begins, or a chosen word or longer stem has as its beginning, adds nothing.
            begins, whole = names[best].lstrip("=").startswith(names[i]), names[best][0] == "="
            if not whole and (word.startswith(names[best]) or begins) or whole and begins and gain[i] < 1.3 * gain[best]:
                able[i] = False
    return chosen_entries


def _logistic(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> np.ndarray:
    """Weights and bias drawn to the prior, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    middle = np.append(_PRIOR, [0.0, -4.0])
    pull = np.append(np.full(KINDS, 0.5), [0.1, 0.05])
    w = middle.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (importance * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, x.T @ (importance * (y - p)) - pull * (w - middle))
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, rule: Grammar = Grammar(), *, id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> dict:
    """Learn the insults and the weights from a bounded sample of the documents with labels.

    The sample is drawn from the labels alone, so only the sampled texts move.
    Rows without text or label are not learned from; a document with several
    labels is learned from once for each. Without rows of both labels, the
    prior weights and no insults are used.
    """
    marks = labels.select(F.col(id).alias("_id"), F.col(toxic).cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1))
    known = dict(marks.groupBy("toxic").count().collect())
    wanted = {1: rule.toxic / max(1, known.get(1, 0)), 0: rule.clean / max(1, known.get(0, 0))}
    share = hash_share(F.col("_id"), F.lit("toxicity"))
    drawn = marks.filter(share < F.when(F.col("toxic") == 1, wanted[1]).otherwise(wanted[0])).limit(2 * (rule.toxic + rule.clean))
    rows = docs.select(F.col(id).alias("_doc"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(F.col("text").isNotNull() & (F.octet_length("text") <= rule.sample_bytes))
    # At most 2 * (toxic + clean) ids and labels are sent.
    chosen = rows.join(F.broadcast(drawn), F.col("_doc") == F.col("_id")).limit(4 * (rule.toxic + rule.clean))
    chosen = stored(chosen.select("text", "toxic"), "toxicity-sample")
    found = insults(chosen, rule) if len(known) == 2 else {}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(found)
        for batch in batches:
            x = [_features(matcher.kinds(t), len(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    weights = np.append(_PRIOR, [0.0, -4.0])
    if len(known) == 2:
        table = chosen.mapInArrow(each, "x array<double>, toxic int").toPandas()
        y = table["toxic"].to_numpy(float)
        # A sampled clean row stands for more rows than a toxic one.
        weights = _logistic(np.array(table["x"].tolist()), y, np.where(y == 1, 1.0, min(wanted[1], 1.0) / min(wanted[0], 1.0)))
    return {"insults": found, "weights": weights.tolist()}


def score(docs: DataFrame, model: dict, name: str, *, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and ``name``, from 0 to 1, of each whole text.

    A NULL or empty text is scored as a text without matches. Repeated rows are
    scored alike; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def measure(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher, weights = Matcher(model["insults"]), np.array(model["weights"])
        nothing = np.array(_features({}, 0))
        for column in parts:
            z = np.empty(len(column))
            for i, value in enumerate(column):
                text = value.as_py()
                found = matcher.kinds(text)
                x = np.array(_features(found, len(text))) if found else nothing
                z[i] = x @ weights[:-1] + weights[-1]
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())
        give_back()

    return docs.withColumn(name, measure(F.col(text).cast("string")))


def label(docs: DataFrame, labels: DataFrame, rule: Grammar = Grammar()) -> DataFrame:
    """All rows and columns of ``docs`` and ``_toxicity``; learns from the documents with a row in ``labels``."""
    return score(docs, fit(docs, labels, rule), fresh(docs, "_toxicity"))
