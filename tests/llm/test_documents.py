"""Document operators against brute force, exact round trips and held-out labels."""

import hashlib
import itertools
import math
import os
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import kneser_ney, language, mixing, pieces, queries, sharding, simhash, toxicity

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# -- language -----------------------------------------------------------------


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    counts, k = np.array([4, 0, 1, 3]), 3
    score, change = rng.normal(size=(8, k)), rng.normal(size=(k, k))
    got = language.forward_backward(score, counts, change)[0]
    at = 0
    for n in counts:
        want = np.zeros((n, k))
        for path in itertools.product(range(k), repeat=int(n)) if n else ():
            weight = math.exp(sum(score[at + i, y] for i, y in enumerate(path)) + sum(change[a, b] for a, b in zip(path, path[1:])))
            for i, y in enumerate(path):
                want[i, y] += weight
        if n:
            assert np.allclose(got[at : at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_word_counts_and_code_switching():
    rule = language.WordLabels(rounds=15, least_count=2)
    english, german = "the house is in the garden and the dog is there", "das haus ist im garten und der hund ist dort"
    model = language.fit([english] * 20 + [german] * 20, ["en"] * 20 + ["de"] * 20, rule)
    letters = language._letters()
    counts, slots, begin, whole = language.words_of(["", "12", f"{english}. {german}!"], letters)
    assert counts.tolist() == [0, 0, 21]
    labels = language.forward_backward(language.emissions(slots, begin, whole, model), counts, model["change"])[0].argmax(axis=1)
    assert [model["labels"][x] for x in labels] == ["en"] * 11 + ["de"] * 10


def test_every_language_is_learned(spark):
    """70 languages, one of which has only texts longer than a sampled one."""
    rng = np.random.default_rng(2)
    own = {f"l{k:02d}": ["".join(chr(0x4E00 + 40 * k + x) for x in rng.integers(0, 40, 4)) for _ in range(12)] for k in range(70)}
    rows = []
    for name, words in own.items():
        size = 800 if name == "l69" else 30
        rows += [(len(rows) + i, " ".join(rng.choice(words, size)), name) for i in range(3 if name == "l69" else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rule = language.WordLabels(sample_bytes=4_000, rounds=6, least_count=2)
    got = {r["doc_id"]: r["lang_pred"] for r in language.label(docs, docs, rule).collect()}
    assert got == {i: name for i, _, name in rows}
    sampled = language.sample(docs, rule, id="doc_id", text="text", lang="lang")
    assert max(len(r["text"].encode()) for r in sampled) <= rule.sample_bytes and {w for r in sampled if r["lang"] == "l69" for w in r["text"].split()} <= set(own["l69"])


@given
def test_language_held_out(spark):
    found = queries.op2_language_id(spark, FOLDER).join(documents(spark).select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.97
    assert found["score"].between(0, 1).all()


# -- near duplicates ----------------------------------------------------------


def plain_fingerprint(text, words=3):
    parts = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    parts = parts.split()
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, links):
    root = {k: k for k in prints}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(prints, 2):
        if links(prints[a], prints[b]):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {k: top(k) for k in prints}


def near_texts():
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(200)]
    texts = {0: "", 1: None, 2: "one", 3: "one two", 4: "ONE two"}
    for i in range(5, 120):
        texts[i] = " ".join(rng.choice(vocabulary, 60))
    for i in range(120, 260):
        words = texts[5 + i % 7].split()
        words[int(rng.integers(60))] = "x"
        texts[i] = " ".join(words)
    return texts


@pytest.mark.parametrize("leaf", [16, 4096])
def test_near_duplicates_equal_brute_force(spark, leaf):
    texts = near_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rule = simhash.NearDuplicates(leaf=leaf)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs, rule).collect()}
    prints = {k: plain_fingerprint(t) for k, t in texts.items()}
    assert {k: int(r["fingerprint"], 16) for k, r in got.items()} == prints
    want = plain_components(prints, lambda a, b: bin(a ^ b).count("1") <= 2)
    assert {k: r["component_id"] for k, r in got.items()} == want


def test_large_leaf_is_searched_in_blocks(spark):
    rows = [(i, ("%016x" % (i * 0x9E3779B97F4A7C15 % 2**64 & ~7 | i % 8))) for i in range(400)]
    values = sorted({int(x, 16) for _, x in rows} | {int(x, 16) ^ 3 for _, x in rows})
    prints = spark.createDataFrame([(v.to_bytes(8, "little"),) for v in values], "fingerprint binary")
    rule = simhash.NearDuplicates(leaf=8, sample=1)  # one vantage point at most: all in few leaves
    found = {bytes(r["node"]): bytes(r["root"]) for r in simhash.components(simhash.links(prints, rule)).collect()}
    want = plain_components({v: v for v in values}, lambda a, b: bin(a ^ b).count("1") <= 2)
    groups = defaultdict(set)
    for v in values:
        key = v.to_bytes(8, "little")
        groups[found.get(key, key)].add(v)
    wanted = defaultdict(set)
    for v, r in want.items():
        wanted[r].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_one_row_of_each_group_stays(spark, empty):
    """Exact copies, links of two bits, repeated and missing ids, against brute force."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [(i, t) for i, t in near_texts().items()]
    rows += [(5001, text("a")), (5002, text("a")), (5002, text("b")), (5003, text("c")), (5003, text("d")), (5004, text("e")), (5004, text("e").upper()), (5004, text("e"))]
    rows += [(None, text("a")), (None, text("f")), (None, text("f")), (None, text("f").upper()), (None, text("g"))]
    prints = [plain_fingerprint(t) for _, t in rows]
    group = plain_components(dict(enumerate(prints)), lambda a, b: bin(a ^ b).count("1") <= 2)
    best = {}
    for i, (doc, t) in enumerate(rows):
        # The order of fingerprints is that of their little-endian bytes.
        key = (doc is None, doc or 0, prints[i].to_bytes(8, "little"), t or "")
        best[group[i]] = min(best.get(group[i], key), key)
    want = sorted((k[0], k[1], k[3]) for k in best.values())
    shape = "doc_id long, text string, lang string, _id string, _key int, _mark int, row string, _print map<string,int>"
    docs = spark.createDataFrame([(i, t, "en", "x", 1, 2, "y", {"m": 1}) for i, t in rows], shape).repartition(5)
    kept = corpus_pipeline.drop_near_copies(spark, docs, empty)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == want


# -- mixing -------------------------------------------------------------------


@given
def test_mix_is_near_its_targets_and_repeats(spark):
    first = queries.op4_source_mixing(spark, FOLDER).toPandas().sort_values("doc_id")
    again = queries.op4_source_mixing(spark, FOLDER).toPandas().sort_values("doc_id")
    assert (first["taken"].to_numpy() == again["taken"].to_numpy()).all()
    assert (first["taken"] <= 3 * first["size"]).all()
    source = documents(spark).select("doc_id", "source").toPandas().merge(first, on="doc_id")
    for _, rows in source.groupby("source"):
        assert abs(rows["taken"].sum() - rows["target"].iloc[0]) <= 0.02 * rows["target"].iloc[0]
    assert math.isclose(sum(g["target"].iloc[0] for _, g in source.groupby("source")), first["size"].sum())


def test_targets_stop_at_three_times_the_source(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(100, "a"), (1, "b"), (10, "c"), (500, "d"), (3, None)])]
    sizes = spark.createDataFrame(rows, "doc_id long, text string, _source string").selectExpr("_source", "size(split(trim(text), ' ')) as _size")
    got = {r["_source"]: r["_target"] for r in mixing.source_targets(sizes, mixing.Mixing()).collect()}
    # Weights 1, 2, 3, 1, 2 of 614 words; b, c and NULL stop at 3, 30 and 9, a and d share the rest evenly.
    assert got == {"a": 286.0, "b": 3.0, "c": 30.0, "d": 286.0, None: 9.0}


def test_mixed_rows_are_the_copies(spark):
    """Columns named like the operator's own, repeated rows, missing values."""
    rows = [(i % 37 if i % 11 else None, "w " * (i % 29), [None, "a", "b"][i % 3 if i < 200 else 1], 7) for i in range(300)]
    names = ("_row", "_words", "_taken", "_copy", "_place", "_part", "_target", "_offset", "_level", "_rows", "_size", "_source", "_id", "_copies", "_rate", "_by_0", "_at", "_whole")
    docs = spark.createDataFrame([(*r, *[1] * len(names)) for r in rows], ["doc_id", "text", "source", "n_chars", *names]).repartition(4)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in mixed.collect())
    assert set(got) <= {r[:3] for r in rows}
    want = Counter()
    for r in mixing.copies(docs.select("doc_id", "text", "source")).collect():
        want[r["_id"], r["_size"], r["_source_size"]] += r["_copies"]
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += len(t.split())
    found = Counter()
    for (i, t, s), n in got.items():
        found[i, len(t.split()), sizes[s]] += n
    assert found == +want


# -- sharding -----------------------------------------------------------------


def test_shards(spark):
    rows = [(i, f"text {i % 700} " * (1 + i % 13)) for i in range(3000)] + [(10_000 + i, "hot copy " * 9) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(docs, 16).toPandas()
    assert len(got) == len(rows)
    sizes = got.groupby("_shard")["_size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 0.02 * sizes.mean() + 2 * got["_size"].max()
    for _, part in got.groupby("_shard"):
        assert sorted(part["_slot"]) == list(range(len(part)))
    # Only a group that holds a boundary is in two shards.
    assert (got.groupby("text")["_shard"].nunique() > 1).sum() <= 15
    for _, group in got[got["text"] != "hot copy " * 9].groupby(["text", "_shard"]):
        assert group["_slot"].max() - group["_slot"].min() == len(group) - 1


# -- pieces -------------------------------------------------------------------

MODEL = pytest.mark.skipif(not os.path.exists(queries.MODEL), reason="no tokenizer files")


@MODEL
@given
def test_pieces_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)
    vocabulary = pieces.load(spark, queries.MODEL)
    texts = [r["text"] for r in documents(spark).select("text").limit(400).collect()]
    texts += ["", " ", "  a  b ", "a\nb\n\n c\t", "日本語 émoji😀x", "▁x ▁▁ y", "<s> a </s> <unk>", "a" * 3000, "\u0000�", "1234567890" * 20, "中文没有空格" * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = pieces.encode(docs, vocabulary)
    for row in encoded.collect():
        assert list(row["ids"]) == library.encode(texts[row["doc_id"]]), texts[row["doc_id"]][:50]
    decoded = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, vocabulary).collect()}
    assert all(decoded[i] == t for i, t in enumerate(texts) if "▁" not in t)


def test_scored_pieces_take_the_cheapest_path():
    names = ("<unk>", "▁", "a", "b", "ab", "▁a", "ba", "<0x63>")
    scores = (0.0, -2.0, -3.0, -3.0, -3.5, -2.5, -1.0, 0.0)
    machine = pieces.Transducer(pieces.Vocabulary(names, scores, (2, 1, 1, 1, 1, 1, 1, 6), False, True, False, True, 0))
    found = [names[i] for i in np.frombuffer(machine.encode("abac"), "<i4")]
    assert found == ["▁a", "ba", "<0x63>"]


# -- quality ------------------------------------------------------------------


def plain_model(texts):
    """Interpolated modified Kneser-Ney over characters, straight from the definition."""
    start = "start"
    letters = set("".join(texts))
    three = Counter()
    for t in texts:
        line = [start, start, *t]
        three.update(zip(line, line[1:], line[2:]))
    two = Counter((b, c) for _, b, c in three)
    one = Counter(c for _, c in two)

    def discounts(counts):
        n = [sum(v == i for v in counts.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        raw = (1 - 2 * y * n[1] / n[0] if n[0] else 0.5, 2 - 3 * y * n[2] / n[1] if n[1] else 1.0, 3 - 4 * y * n[3] / n[2] if n[2] else 1.5)
        return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]

    d1, d2, d3 = discounts(one), discounts(two), discounts(three)
    off = lambda d, v: d[min(v, 3) - 1]
    size = len(letters) + 2

    def p1(c):
        total = sum(one.values())
        return (one[c] - off(d1, one[c]) if c in one else 0) / total + sum(off(d1, v) for v in one.values()) / total / size

    def p2(b, c):
        own = {k[1]: v for k, v in two.items() if k[0] == b}
        if not own:
            return p1(c)
        return ((own[c] - off(d2, own[c]) if c in own else 0) + sum(off(d2, v) for v in own.values()) * p1(c)) / sum(own.values())

    def p3(a, b, c):
        own = {k[2]: v for k, v in three.items() if k[:2] == (a, b)}
        if not own:
            return p2(b, c)
        return ((own[c] - off(d3, own[c]) if c in own else 0) + sum(off(d3, v) for v in own.values()) * p2(b, c)) / sum(own.values())

    def nats(t):
        line = [start, start, *t]
        return -sum(math.log(p3(*x)) for x in zip(line, line[1:], line[2:]))

    return nats


@pytest.mark.parametrize("block", [1 << 20, 1, 2, 7])
def test_perplexity_equals_the_definition(spark, monkeypatch, block):
    """Mixed scripts, every character told apart; several shards, copies and blocks, and texts cut by them."""
    if block < 1 << 20:
        for name, value in (("_SLICE", block), ("_SHARD", 32), ("_CHUNK", 5), ("_UNIT", 2)):
            monkeypatch.setattr(kneser_ney, name, value)
    good = ["abracadabra alakazam", "a cab, a crab, a scab", "", "bazaar zebra", "cc", "東京都と京都", "京都の東", "мама мыла раму", "\x02a \U0001f600", None]
    docs = spark.createDataFrame([(t,) for t in good], "text string")
    nats = plain_model([t or "" for t in good])
    texts = ["abba", "zzz!", "", "a scab alakazam", "qqqqq", None, "京都東 рама", "\U0001f600\U0001f601", "\x02", "  a"] + ["a scab"] * 3
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(2)
    got = {r["id"]: r for r in kneser_ney.score(rows, kneser_ney.train(docs)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert math.isclose(got[i]["nats"], nats(t or ""), rel_tol=1e-6, abs_tol=1e-9) and got[i]["chars"] == len(t or "")


def test_kept_rows_are_the_accepted(spark):
    """Names that the operator uses itself, equal ids, missing values, columns of any type."""
    names = ("_mark", "_digest", "_out", "_out_id", "_out_lang", "_out_digest", "id", "digest", "row", "_good", "_limit", "shard", "copy", "key")
    good = ["the cat is on the mat", "the dog is in the house", "a cat and a dog", "the house is on the hill", "a dog on a mat"]
    odd = ["xq zv kj qq", "@@@ ### $$$", "", None]
    rows = [(i if i % 5 else None, t, ["en", None][i % 2]) for i, t in enumerate((good + odd) * 4)] + [(8, good[0], "en"), (998, "zzkq", "en")]
    docs = spark.createDataFrame([(*r, {"m": 1}, *[7] * len(names)) for r in rows], "doc_id long, text string, lang string, extra map<string,int>, " + ", ".join(f"`{n}` int" for n in names))
    ids = spark.createDataFrame([(i,) for i, t, _ in rows[:-2] if t in good and i is not None], "doc_id long").distinct()
    kept = kneser_ney.keep(docs.repartition(3), ids, kneser_ney.Perplexity(shrink=2.0))
    assert kept.columns == docs.columns
    judged = kneser_ney.judge(docs.repartition(3), ids, kneser_ney.Perplexity(shrink=2.0)).toPandas()
    assert len(judged) == len(rows) and judged["accepted"].any() and not judged["accepted"].all()
    verdict = {(None if i != i else i, x, d): a for i, x, d, a in zip(judged["id"], judged["lang"].where(judged["lang"].notna(), None), judged["digest"], judged["accepted"])}
    digest = lambda t: None if t is None else hashlib.md5(t.encode()).hexdigest()
    want = Counter(r for r in rows if verdict[r[0], r[2], digest(r[1])])
    assert Counter((r["doc_id"], r["text"], r["lang"]) for r in kept.collect()) == want
    assert not any(t in odd or t == "zzkq" for _, t, _ in want)


@given
def test_quality_keeps_good_and_drops_bad(spark):
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = queries.op8_quality_classifier(spark, FOLDER).join(marks, "doc_id").toPandas()
    assert found[found["quality"] == 1]["accepted"].mean() > 0.98
    assert found[found["quality"] == 0]["accepted"].mean() < 0.25


# -- toxicity -----------------------------------------------------------------


def test_clauses():
    matcher = toxicity.Matcher({"=idiot": 2.0, "lostra": 3.0})
    assert matcher.kinds("An idiot. Lostraung!") == {0: 5.0}
    assert matcher.kinds("you are an idiot") == {1: 2.0}
    assert matcher.kinds("this is not an idiot") == {4: 2.0}
    assert matcher.kinds("he said: no. She called him an idiot") == {3: 2.0}
    assert matcher.kinds("I will kill you") == {8: 1.0}
    assert matcher.kinds("idiotic things, nothing else") == {} == matcher.kinds(None)
    assert matcher.kinds("no. idiot") == {0: 2.0}


@given
def test_toxicity_held_out(spark):
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = queries.op10_toxicity(spark, FOLDER).join(marks, "doc_id").toPandas()
    assert found["score"].between(0, 1).all()
    clean, toxic = found[found["toxic"] == 0], found[found["toxic"] == 1]
    assert clean["predicted"].mean() < 0.03 and toxic["predicted"].mean() > 0.7


def test_marked_rows_are_those_that_the_mix_takes(spark):
    rows = [(i, "ab c " * (1 + i % 7) if i % 9 else None, "abc"[i % 3] if i % 5 else None, "kept") for i in range(300)] + [(7, "x", "a", "kept")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _row string").withColumn("_mix", F.lit("replaced"))
    got = mixing.marked(docs)
    assert got.columns == docs.columns and got.count() == len(rows) and got.filter("_row = 'kept'").count() == len(rows)
    times = {}
    for r in mixing.mix(docs.drop("_mix")).collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    taken = {r["doc_id"]: r["n"] for r in got.groupBy("doc_id").agg(F.sum("_mix.copies").alias("n")).filter("n > 0").collect()}
    assert taken == times
    assert mixing.marked(docs.limit(0)).count() == 0
