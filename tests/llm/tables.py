"""Small tables with the awkward rows that every operator must take."""

import math

from pyspark.sql import SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, _size long, score double, shard int, `_h` string, vec_id long"
LABELS = "doc_id long, quality int, toxic int"
EMBEDDINGS = "vec_id long, embedding array<float>, label int, score string, rank string"
BENCHMARK = "item_id long, text string, doc_id string, score string, rank int, term int"
CONVERSATIONS = "conv_id long, turn long, role string, text string, part string, perspective int"

LONG = " ".join(f"the word{i % 97} of is idiot" for i in range(40_000))


def documents() -> list[tuple]:
    texts = [
        None, "", "   \n\t ", "12 34 !!", "the", LONG,
        "Die Übung ist nicht schwer und das Haus ist alt.", "the cat is on the mat and the dog is in the house",
        "the cat is on the mat and the dog is in the house", "le chat est sur la table et le chien dans la maison",
        "<|im_end|> ▁weird\u0000 text \U0001f600 日本語", "You are an idiot. He said you are not an idiot!",
    ]
    langs = [None, "en", "de", "fr", "en", "en", "de", "en", "en", "fr", None, "en"]
    sources = ["a", None, "b", "a", "a", "c", None, "a", "a", "b", "a", "d"]
    rows = [(i, t, x, s, len(t or "")) for i, (t, x, s) in enumerate(zip(texts, langs, sources))]
    rows += [(7, *rows[7][1:])] * 3 + [(None, "a text without an id", "en", "a", 20)] * 2
    return [(*r, 5, 0.5, 3, "clash", 9) for r in rows]


def labels() -> list[tuple]:
    return [(i, i % 2, int(i in (5, 11))) for i in range(12)] + [(None, 1, 0), (99, None, None), (7, 1, 0)]


def embeddings() -> list[tuple]:
    rows = [(i, [math.sin(i * d + 1) for d in range(1, 9)]) for i in range(0, 60)]
    rows += [(100, None), (101, [float("nan")] * 8), (102, [0.0] * 8), (103, [1.0, None] + [0.0] * 6), (104, [float("inf")] * 8)]
    rows += [(105, [1.0, 2.0]), (106, []), (None, [1.0] * 8)]
    rows += [(200 + i, [0.5] * 8) for i in range(40)]
    return [(i, v, 1, "clash", "clash") for i, v in rows]


def benchmark() -> list[tuple]:
    rows = [(0, "The cat is ON the mat, the Haus"), (1, None), (2, ""), (3, "--- ..."), (4, "nothing of this zzz"), (5, "the cat is on the mat")]
    rows += [(5, "the cat is on the mat"), (5, "idiot"), (None, "dog cat the the"), (6, "日本語 é"), (7, LONG)]
    return [(*r, "clash", "clash", 1, 2) for r in rows]


def conversations() -> list[tuple]:
    rows = [(1, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(150)]
    rows += [(2, 0, "system", "be kind"), (2, 1, "ann", None), (2, 2, "bob", ""), (2, 2, "bob", ""), (2, None, None, "who?"), (2, 3, " ", "<|im_end|>")]
    rows += [(3, 0, "system", "alone"), (None, 0, "user", "lost"), (None, 1, "assistant", "found"), (4, 0, "user", "x" * 300_000)]
    return [(*r, "clash", 1) for r in rows]


def write(spark: SparkSession, folder: str, *, empty: bool = False) -> str:
    for name, rows, schema in (
        ("documents", documents(), DOCUMENTS),
        ("labels", labels(), LABELS),
        ("embeddings", embeddings(), EMBEDDINGS),
        ("conversations", conversations(), CONVERSATIONS),
        ("benchmark", benchmark(), BENCHMARK),
    ):
        spark.createDataFrame([] if empty else rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return folder
