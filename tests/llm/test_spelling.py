"""Spelling variants against brute force."""

import random

import pytest

from corpusprep.llm.spelling import Spelling, near_words, runs, spelling_variants, vocabulary


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute(counts, how):
    rows = {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best and counts[best] >= how.ratio * n else None
        rows[w] = [w, n, len(near), form, counts[form] if form else None]
    for w, row in rows.items():
        root = w
        while rows[root][3]:
            root = rows[root][3]
        row.append(root)
    return sorted(map(tuple, rows.values()))


def got(df):
    return sorted(map(tuple, df.select("word", "n", "n_near", "form", "form_n", "root").collect()))


def some_words(rng, n, letters, lengths):
    return {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(n)}


@pytest.mark.parametrize("how", [Spelling(), Spelling(block=8, pack=4, cells=1), Spelling(min_letters=1, ratio=1 + 1, block=40)])
def test_every_word_one_edit_away_is_found(spark, how):
    rng = random.Random(6)
    words = some_words(rng, 400, "ab\u00e9", range(max(5, how.min_letters), 9)) | some_words(rng, 100, "abcdef", [5, 6])
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "q" * 3000, "q" * 2999, "q" * 1500 + "x" + "q" * 1499}
    if how.min_letters == 1:
        words |= some_words(rng, 60, "ab\u00ff", range(1, 5))
    counts = {w: int(3 * 2 ** rng.choice([0, 0, 1, 2.5, 3, 4, 5, 6])) for w in sorted(words)}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling_variants(vocab, how)) == brute(counts, how)


def test_a_long_way_to_the_root_and_ties(spark):
    counts = {"b" * (5 + i): 3 * 2**i for i in range(30)} | {"xyzzy": 3, "xyzza": 6, "xyzzb": 6}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = got(spelling_variants(vocab))
    assert rows == brute(counts, Spelling())
    assert {r[5] for r in rows if r[0].startswith("b")} == {"b" * 34} and ("xyzzy", 3, 2, "xyzza", 6, "xyzza") in rows


def test_runs_and_vocabulary(docs):
    texts = ["Hello hello, HELLO w\u00f6rld-w\u00f6rld W\u00f6rld 123abc\u0142defgh", None, "", "hello x" * 2, "\u00c9clair \u00e9clair"]
    df = docs(texts).selectExpr("*", "1 AS word")
    words = [r.word for r in runs(df).collect()]
    assert words.count("hello") == 4 and words.count("w\u00f6rld") == 3 and "defgh" in words and "abc" in words
    assert "\u00c9clair" in words and "\u00e9clair" in words  # only A-Z are lower-cased
    assert {r.word: r.n for r in vocabulary(runs(df)).collect()} == {"hello": 4, "w\u00f6rld": 3}


def test_no_words(spark, docs):
    assert spelling_variants(vocabulary(runs(docs([None, ""])))).count() == 0
    one = spark.createDataFrame([("alone", 5)], "word string, n long")
    assert got(spelling_variants(one)) == [("alone", 5, 0, None, None, "alone")]
    assert near_words(one).count() == 0
