"""Manifest, ranked search and personal data against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskspark.llm import lexical, merkle, pii, queries

# -- manifest -----------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, lower=False):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    if lower and values[4] is not None:
        values[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in values[4])
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_path(digests, at, fan=8):
    """Top, and (left siblings, right siblings) of each level."""
    path = []
    while len(digests) > 1:
        run = at // fan * fan
        path.append((digests[run:at], digests[at + 1 : run + fan]))
        digests, at = [sha(*digests[i : i + fan]) for i in range(0, len(digests), fan)], at // fan
    return digests[0], path


def plain_manifest(rows, fan=8):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    for group in trees.values():
        group.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], plain_leaf(r)))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    leaves = {t: [plain_leaf(r) for r in trees[t]] for t in order}
    subroots = [plain_path(leaves[t], 0, fan)[0] for t in order]
    out = []
    for i, t in enumerate(order):
        root, above = plain_path(subroots, i, fan)
        for at, r in enumerate(trees[t]):
            path = plain_path(leaves[t], at, fan)[1] + above
            now = plain_leaf(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0)
            for left, right in path:
                now = sha(*left, now, *right)
            out.append((r["doc_id"], leaves[t][at], subroots[i], root, sha(*(d for p in path for side in p for d in side)), now, now == root))
    return sorted(out, key=repr)


def got_manifest(spark, rows, rule, monkeypatch):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, tree string, place int").repartition(5)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    real = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda d, **k: real(d, rule, **k))
    return sorted((tuple(r) for r in queries.op11_merkle_manifest(spark, "").collect()), key=repr)


@pytest.mark.parametrize("fan, levels", [(8, 3), (8, 1), (2, 2)])
def test_manifest_equals_brute_force(spark, monkeypatch, fan, levels):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(700):
        # One tree of a third of all rows, some of one leaf or of a power of the fan, and many small ones.
        lang = ["en", "en", None, "de", f"x{i % 60}"][int(rng.integers(0, 5))] if i < 620 else ["p64", "lone"][i == 699]
        text = [None, "", "Some Text", "lower", "É İ ß A" * 3][int(rng.integers(0, 5))]
        rows.append((int(rng.integers(0, 400)) if i % 50 else None, ["a", None][i % 2], lang, [None, i][i % 3 > 0], text, "clash", 1))
    rows += rows[:5] * 2
    names = ("doc_id", "source", "lang", "n_chars", "text")
    want = plain_manifest([dict(zip(names, r)) for r in rows], fan)
    got = got_manifest(spark, rows, merkle.Manifest(fan=fan, levels=levels), monkeypatch)
    assert got == want
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("count", [1, 2, 8, 9, 64, 65, 513])
def test_manifest_of_one_tree(spark, monkeypatch, count):
    rows = [(i, "s", "en", 3, f"Text {i}", "x", 0) for i in range(count)]
    want = plain_manifest([dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows])
    assert got_manifest(spark, rows, merkle.Manifest(), monkeypatch) == want


def test_a_resumed_state_skips_what_stands_left():
    slots, parents = merkle._slots([b"a" * 64, b"b" * 64, b"c" * 64], 8)
    assert merkle._resume(slots[1], b"b" * 64) == parents[0]
    assert merkle._resume(slots[1], b"x" * 64) == hashlib.sha256(b"a" * 64 + b"x" * 64 + b"c" * 64).hexdigest().encode()
    assert slots[2][1:] == (b"a" * 64 + b"b" * 64, b"")


# -- ranked search ------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return Counter(TERM.findall((text or "").translate(CAPITALS)))


def plain_search(docs, items, best=20):
    found = [(i, plain_terms(t)) for i, t in docs]
    found = [(i, c, c.total()) for i, c in found if c]
    count, length = len(found), sum(n for _, _, n in found)
    out = []
    for item, text in items:
        scored = []
        for doc, terms, n in found:
            m, score = 100 - 25 + 25 * n * count // length, 0
            for t, repeats in plain_terms(text).items():
                if tf := terms[t]:
                    df = sum(t in c for _, c, _ in found)
                    score += repeats * math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:best], 1)]
    return sorted(out)


@pytest.mark.parametrize("rule", [lexical.Search(), lexical.Search(best=3, block_bytes=300, shared_terms=25, cells=512)])
def test_search_equals_brute_force(spark, rule):
    rng = np.random.default_rng(2)
    words = [f"W{i}" for i in range(60)] + ["naïve", "日本", "A_b", "x-y"]
    weight = 1 / np.arange(1, len(words) + 1)
    draw = lambda n: " ".join(rng.choice(words, n, p=weight / weight.sum()))
    docs = [(i, draw(int(rng.integers(0, 50)))) for i in range(300)] + [(1000, None), (1001, "")]
    docs += [(2000 + i, docs[3][1]) for i in range(40)]  # more ties than an item has places
    items = [(i, draw(int(rng.integers(1, 20)))) for i in range(30)] + [(99, "unknown")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    q = spark.createDataFrame(items + items[:3] + [(50, None)], "item_id long, text string")
    got = sorted(tuple(r) for r in lexical.search(d, q, rule).collect())
    assert got == plain_search(docs, items, rule.best)


def test_graph_sums_and_shares():
    rng = np.random.default_rng(3)
    items = [{int(t): int(rng.integers(1, 3)) for t in rng.choice(40, 12, replace=False)} for _ in range(25)]
    graph = lexical.share(items)
    cells = np.zeros((graph["nodes"], 7), dtype=np.int64)
    values = rng.integers(0, 1000, (40, 7))
    cells[: len(graph["terms"])] = values[graph["terms"]]
    want = np.array([sum(values[t] * n for t, n in counts.items()) for counts in items])
    assert (lexical.evaluate(graph, cells) == want).all()
    additions = sum(len(parts) - 1 for _, parts, _ in graph["steps"]) + sum(len(x) - 1 for x in graph["items"])
    assert additions < sum(len(c) - 1 for c in items)


def test_terms_of_a_text_longer_than_a_slice(monkeypatch):
    text = " ".join(f"Word{i % 13} ünï{i % 7}," for i in range(500))
    monkeypatch.setattr(lexical, "_SLICE", 64)
    assert lexical.term_counts(text.encode()) == Counter({t.encode(): n for t, n in plain_terms(text).items()})


# -- personal data ------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    out = {}
    for kind, pattern in BASE.items():
        kept = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                kept.append(m.span())
        out[kind] = kept
    return out


def test_base_spans_equal_brute_force():
    rng = np.random.default_rng(4)
    finder = pii.Finder()
    pieces = ["a@b.c", "@", ".", "1.2.3.4", "300.1.1.1", "+49 (0)30 1234-567", "4111 1111 1111 1111", "4111111111111111", "-", " ", "7", "+", "é", "😀", "x", "..", "a.b@c-d.e@f.g", "0", "255.", "(", "\n", "_%"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces, int(rng.integers(1, 14))))
        got = finder.spans(text)
        assert {k: got[k] for k in pii.BASE} == plain_spans(text), text
    alphabet = list("a@.-+ 0123 (")
    for _ in range(4000):
        text = "".join(rng.choice(alphabet, int(rng.integers(1, 40))))
        got = finder.spans(text)
        assert {k: got[k] for k in pii.BASE} == plain_spans(text), text


def test_spans_of_a_text_longer_than_a_slice(monkeypatch):
    text = "😀 write to some.one@mail.example.org or call +49 30 123456, card 4111-1111-1111-1111 at 10.0.0.1; " * 40
    whole = pii.Finder().spans(text)
    for size in (7, 50, 64):
        monkeypatch.setattr(pii, "_SLICE", size)
        assert pii.Finder().spans(text) == whole
    assert whole["email"] and whole["card"] and {k: whole[k] for k in pii.BASE} == plain_spans(text)


def test_added_kinds():
    text = "See https://example.org/a?b=c, (ftp://x.y). IBAN: DE89 3704 0044 0532 0130 00 and iban DE89370400440532013001; konto 1234567, http://nowhere xhttp://a.b"
    found = pii.Finder().spans(text)
    assert [text[a:b] for a, b in found["url"]] == ["https://example.org/a?b=c", "ftp://x.y"]
    assert [text[a:b] for a, b in found["account"]] == ["DE89 3704 0044 0532 0130 00", "1234567"]


def test_digests_and_counts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a@b.c +49 30 123456"), (2, None), (3, "")], "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    rows = {r["doc_id"]: r for r in queries.op13_pii(spark, "").collect()}
    base = "email:0:5,phone:6:19"
    assert rows[1]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and rows[1]["spans"] == base
    assert (rows[1]["n_email"], rows[1]["n_ip"], rows[1]["n_card"], rows[1]["n_phone"]) == (1, 0, 0, 1)
    for i in (2, 3):
        assert rows[i]["spans"] == "" and rows[i]["base_sha256"] == hashlib.sha256(b"").hexdigest()
