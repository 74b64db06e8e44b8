"""Small documents with every awkward case: NULLs, empty and long texts, copies, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, rep bigint, n bigint"


def prose(rng, words):
    return " ".join("".join(rng.choice("aeiounrst") for _ in range(rng.randint(2, 8))) for _ in range(words))


def documents(spark, seed=1):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(30)]
    base = prose(rng, 200).split(" ")
    for k in range(8):
        near = list(base)
        for _ in range(k):
            near[rng.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    passage = prose(rng, 90)
    texts += [f"{prose(rng, 20)}\n{passage}\n{prose(rng, 20)}" for _ in range(4)]
    texts += [texts[0], texts[0], texts[30], None, "", " ", "\n\n", "one", "one two", "ONE TWO", "one\ntwo\nthree\none\ntwo\nthree"]
    texts += ["again " * 400, "x" * 3000, "é ß 漢字 😀 " * 60, "tab\tdouble  space \n end ", prose(rng, 4000)]
    rows = [(i, t, ("en", "de", None)[i % 3], ("a", "a", "a", "b", None)[i % 5], len(t or ""), 0.5, "k", 7, 1) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id here at all", "en", "a", 17, 0.1, "k", 7, 1), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
