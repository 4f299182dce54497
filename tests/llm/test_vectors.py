"""The two searches and the dialogue views against brute force."""

import numpy as np
import pytest

from riskspark.llm import chat, cross_polytope, topk
from riskspark.llm.common import split_by_ids


def rows(n, width=64, copies=0, seed=2):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, width))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[n - copies :] = v[0]
    return [(i, x.tolist()) for i, x in enumerate(v.astype(np.float32))]


@pytest.mark.parametrize("queries", [4096, 8])
def test_exact_topk(spark, queries):
    data = rows(700, copies=200)
    rule = topk.TopK(every=10, queries=queries, rows=100)
    got = topk.search(spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(5), rule).collect()
    v = np.floor(256 * np.array([np.float32(x) for _, x in data], dtype=np.float64)).astype(np.int64)
    scores = v @ v.T
    want = []
    for q in range(0, 700, 10):
        order = [i for i in np.lexsort((np.arange(700), -scores[q])) if i != q][:5]
        want += [(q, r + 1, i, scores[q, i]) for r, i in enumerate(order)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)


def test_large_components_are_summed_exactly(spark):
    data = [(0, [1.0, 0.5]), (50, [3e14, -7e13])]
    data += [(i + 1, [x, y]) for i, (x, y) in enumerate([(3e5, 1.0), (2.7e5, -1.0), (4e6, 0.25), (5e6, 3.0), (2.5e11, 9e11), (2.5e11, 9e11 + 1), (-6e13, 8e13), (1e-3, 2e-3)])]
    data += [(60, [1e300, 1e300])]
    got = topk.search(spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3), topk.TopK(rows=4)).collect()
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in data}
    want = []
    for q in (0, 50):
        clip = lambda n: max(-(2**63), min(2**63 - 1, n))
        scored = sorted((-clip(sum(a * b for a, b in zip(whole[q], whole[i]))), i) for i in whole if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)


def test_rows_of_one_id_are_candidates_of_their_own(spark):
    data = [(0, [1.0, 0.0]), (7, [0.1, 0.9]), (7, [0.99, 0.1]), (8, [0.5, 0.5]), (7, [0.99, 0.1])]
    got = cross_polytope.search(spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(2)).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 7, 0.99), (0, 2, 7, 0.99), (0, 3, 8, 0.5), (0, 4, 7, 0.1)]


def test_bounds_drop_candidates_but_no_answer():
    rng = np.random.default_rng(0)
    columns = rng.integers(-200, 200, (64, 500))
    columns[16:] //= 50
    ids = np.arange(500)
    rule = topk.TopK()
    norms = topk._suffix_norms(columns, rule.block)
    for q in range(20):
        found, score = topk._search(ids, columns, norms, q, columns[:, q], rule)
        want = columns[:, q] @ columns
        want[q] = -(10**9)
        assert sorted(score)[::-1] == sorted(want)[::-1][:5] and all(want[i] == s for i, s in zip(found, score))


@pytest.mark.parametrize(("n", "copies", "more"), [(30, 0, {}), (2000, 0, {}), (2000, 700, {}), (2000, 0, {"turns": 2, "probes": 2000})])
def test_recall(spark, n, copies, more):
    data = rows(n, copies=copies)
    rule = cross_polytope.CrossPolytope(rows=128, queries=16, **more)
    got = cross_polytope.search(spark.createDataFrame(data, "vec_id long, embedding array<float>"), rule).toPandas()
    v = np.array([np.float32(x) for _, x in data], dtype=np.float64)
    found = 0
    for q in range(0, n, 20):
        mine = got[got["query_id"] == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, min(20, n - 1) + 1))
        assert np.allclose(mine["score"], v[mine["vec_id"]] @ v[q], atol=1e-12)
        assert list(zip(-mine["score"], mine["vec_id"])) == sorted(zip(-mine["score"], mine["vec_id"]))
        scores = v @ v[q]
        scores[q] = -9
        least = np.sort(scores)[-len(mine)]
        found += (mine["score"] >= least - 1e-12).mean()
    assert found / len(range(0, n, 20)) >= 0.9


def test_views_mask_own_turns(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hello"), (1, 2, "bob", "hi <|im_end|>"), (1, 3, "ann", None)]
    got = {r["perspective"]: r for r in chat.rotate(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {"ann", "bob"}
    ann = got["ann"]
    assert ann["text"].startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user name=bob\nhi < |im_end|>")
    assert [ann["text"][s["start"] : s["stop"]] for s in ann["spans"]] == ["hello<|im_end|>", "<|im_end|>"]
    assert [got["bob"]["text"][s["start"] : s["stop"]] for s in got["bob"]["spans"]] == ["hi < |im_end|><|im_end|>"]


def test_long_dialogue_is_cut_into_parts(spark):
    turns = [(1, t, f"p{t % 3}", f"said {t}") for t in range(200)]
    form = chat.ChatFormat(part_turns=16)
    got = chat.rotate(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), form).orderBy("perspective", "part").collect()
    whole = {}
    for r in got:
        assert r["first_turn"] == 16 * r["part"]
        whole.setdefault(r["perspective"], []).append(r["text"])
    assert len(whole) == 3
    for text in whole.values():
        assert [int(x.split("<")[0]) for x in "".join(text).split("said ")[1:]] == list(range(200))


def test_rows_are_told_apart_by_ids(spark):
    rows = spark.createDataFrame([(i, "x") for i in range(500)] + [(None, "y")], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in (3, 77, 499, 10_000)], "id long")
    never, maybe = split_by_ids(rows, "doc_id", ids)
    assert {3, 77, 499} <= {r["doc_id"] for r in maybe.collect()}
    assert never.count() + maybe.count() == 501 and maybe.count() < 20
    assert never.filter("doc_id is null").count() == 1
