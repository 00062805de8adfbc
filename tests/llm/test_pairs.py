"""N-gram join, line dedup and components against brute force."""

import random

import numpy as np
from corpusprep.llm.common import stored
from corpusprep.llm.components import components
from corpusprep.llm.line_dedup import LineDedup, line_dedup
from corpusprep.llm.ngram_join import NgramJoin, ngram_join


def connected(nodes, links):
    label = {x: x for x in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: c for n, c in connected(nodes | {7}, links).items() if n in nodes}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_components_of_a_rising_chain_take_few_rounds(spark, monkeypatch):
    from corpusprep.llm import components as module

    rounds = []

    def counted(df, name):
        rounds.extend([name] if name == "contraction" else [])
        return stored(df, name)

    monkeypatch.setattr(module, "stored", counted)
    chain = spark.range(1000).selectExpr("id as a", "id + 1 as b")
    got = components(chain)
    assert got.count() == 1001 and got.filter("component <> 0").isEmpty()
    assert len(rounds) <= 15


def shingles(text, n):
    words = (text or "").lower().split(" ")
    words = [w for w in words if w]
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)}


def variants(seed=3):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(300)}" for _ in range(rng.randrange(25, 60))] for _ in range(4)]
    texts = []
    for words in base:
        for k in range(14):
            copy = list(words)
            for _ in range(k % 5):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
            texts.append(" ".join(copy))
    common = " ".join(f"c{i}" for i in range(30))
    texts += [common + " " + " ".join(f"y{rng.randrange(9999)}" for _ in range(8)) for _ in range(12)]
    return texts + ["", None, "   ", "one", "one", "two words", "Two WORDS", texts[0], texts[0].upper()]


def test_join_finds_the_groups_of_all_pairs(docs):
    texts = variants()
    for n, percent in ((3, 90), (5, 80), (2, 60)):
        sets = [shingles(t, n) for t in texts]
        links = [
            (a, b)
            for a in range(len(texts))
            for b in range(a)
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
        ]
        want = connected(range(len(texts)), links)
        got = ngram_join(docs(texts), NgramJoin(words=n, percent=percent, sketch_bits=10, filter_bits=15)).collect()
        assert {r.doc_id: r.component_id for r in got} == want
        assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in enumerate(sets)}


def test_join_of_repeated_rows_null_ids_and_nothing(docs):
    got = ngram_join(docs([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "q"), (3, None)])).collect()
    assert sorted(((r.doc_id or -1), (r.component_id or -1)) for r in got) == [(-1, -1), (-1, 5), (3, 3), (5, 5), (5, 5)]
    assert ngram_join(docs([(1, "a")]).filter("false")).count() == 0


def test_lines_keep_their_first_occurrence(docs):
    long = "the quick brown foxes jumped happily over seventeen lazy sleeping dogs yesterday evening while everybody watched"
    near = long.replace("happily", "happilx")
    texts = [
        f"{long}\nshort line\nunique words here are standing alone",
        f"Title\n{long.upper()}!\nshort line",
        f"{near}\nother words stand here quite alone\n\n",
        None,
        "",
        "short line",
    ]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup(docs(texts)).collect()}
    assert got[0] == (texts[0], 3, 0)
    assert got[1] == ("Title\nshort line", 3, 1)
    assert got[3] == (None, 0, 0) and got[4] == ("", 1, 0) and got[5] == ("short line", 1, 0)
    # The variant goes if its hash is close; its own line stays in any case.
    assert "other words stand here quite alone" in got[2][0]


def test_lines_of_repeated_rows_and_null_ids(docs):
    line = "these five words repeat here"
    got = line_dedup(docs([(1, line), (1, line), (2, line), (None, line)]), LineDedup()).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, line), (1, ""), (1, ""), (2, "")]
    assert line_dedup(docs([(1, "a")]).filter("false")).count() == 0


def test_sketches_hold_the_smallest_hash_of_each_bin(monkeypatch):
    from corpusprep.llm import line_dedup as module

    rng = random.Random(1)
    lines = ["".join(rng.choice("abc \u00e9\U0001f600") for _ in range(n)) for n in (0, 1, 10, 11, 12, 40, 700, 3, 90)]
    whole = module.sketches(lines)
    assert [(row != 2**64 - 1).sum() for row in whole[:4]] == [1, 1, 1, 1]
    for line, row in zip(lines, whole, strict=True):
        assert (module.sketches([line])[0] == row).all()
        grams = [module.sketches([line[i : i + 11]])[0] for i in range(max(1, len(line) - 10))]
        assert (np.min(grams, axis=0) == row).all()
    monkeypatch.setattr(module, "_CHUNK", 7)
    assert (module.sketches(lines) == whole).all()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_variants_of_lines_of_all_lengths_are_found(docs):
    rng = random.Random(5)
    letters = "etaoinshrdlu"
    pairs = []
    for k in range(200):
        words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(5 + 75 * k // 199)]
        line = " ".join(words)
        near = list(line)
        for _ in range(1 if k % 2 else rng.randrange(1, len(line) // 10 + 1)):
            at = rng.choice([i for i, c in enumerate(near) if c != " "])
            near[at] = rng.choice(letters)
        near = "".join(near)
        if near != line and distance(line, near) <= 0.1 * max(len(line), len(near)):
            pairs.append((line, near))
    got = {r.doc_id: r.n_removed for r in line_dedup(docs([t for p in pairs for t in p])).collect()}
    assert not any(got[2 * i] for i in range(len(pairs)))
    assert sum(got[2 * i + 1] for i in range(len(pairs))) >= 0.9 * len(pairs) > 170


def test_lines_of_few_long_words_take_part(docs):
    thai = "การเรียนรู้ของเครื่องเป็นสาขาหนึ่งของปัญญาประดิษฐ์"
    near = thai.replace("สาขา", "สาขะ")
    got = line_dedup(docs([f"{thai}\nSubscribe to newsletter\nMenu", thai, near, "Subscribe to newsletter!\nMenu\n---"])).collect()
    assert {r.doc_id: (r.text, r.n_removed) for r in got} == {
        0: (f"{thai}\nSubscribe to newsletter\nMenu", 0), 1: ("", 1), 2: ("", 1), 3: ("Menu\n---", 1)
    }


def test_parities_bound_the_difference_of_sets():
    from corpusprep.llm.ngram_join import differing, parities

    rng = np.random.default_rng(2)
    for size in (0, 1, 40, 3000):
        base = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for other in (0, 1, 30, 900, 20_000):
            more = np.union1d(base[other // 2 :], rng.integers(0, 2**63, other).astype(np.uint64))
            bound = differing(parities(base), parities(more))
            assert bound == differing(parities(more), parities(base)) <= len(np.setxor1d(base, more))
    wide = rng.integers(0, 2**63, 2000).astype(np.uint64)
    assert differing(parities(wide[:1000]), parities(wide[1000:])) > 500 and differing(parities(wide), parities(wide)) == 0


def test_similar_lines_are_those_of_few_edits(spark):
    from corpusprep.llm.line_dedup import LineDedup, similar
    from pyspark.sql import functions as F

    rng = random.Random(11)

    def text(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    def edited(line, edits):
        for _ in range(edits):
            at, kind = rng.randrange(len(line) + 1), rng.randrange(4)
            line = line[:at] + (text(rng.randrange(1, 9)) if kind else "") + line[at + rng.randrange(1, 9) * (kind != 1) :]
        return line

    pairs = [("", ""), ("a", ""), ("same", "same"), ("x" * 3000, "x" * 2700), ("x" * 3000, "x" * 2699), ("ab" * 1500, "ba" * 1500)]
    for n in (1, 9, 10, 11, 40, 200, 700, 2500):
        line = text(n)
        pairs += [(line, text(n)), (line, line[: n // 2] + text(n - n // 2)), (line, text(max(1, n // 8)) + line)]
        pairs += [(line, edited(line, e)) for e in sorted({1, 2, n // 60, n // 30, n // 20})]
    for how in (LineDedup(), LineDedup(similarity=0.7), LineDedup(similarity=1.0)):
        rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
        most = F.floor(F.greatest(F.length("a"), F.length("b")) * (1 - how.similarity) + 1e-9).cast("int")
        plain = (F.levenshtein("a", "b") <= most).alias("plain")
        got = rows.select("i", similar(F.col("a"), F.col("b"), how).alias("got"), plain).collect()
        assert [r.got for r in got] == [r.plain for r in got]
        assert len({r.got for r in got}) == 2


def test_line_dedup_leaves_only_what_its_result_reads(docs, spark, tmp_path, monkeypatch):
    from corpusprep.llm import common

    monkeypatch.setattr(common, "work_path", lambda spark, name: str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}"))
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randrange(900)}" for _ in range(30)) for _ in range(60)]
    near = [line.replace("w1", "v1", 1) for line in base]
    result = line_dedup(docs(["\n".join(base), "\n".join(near), "\n".join(base[:30])]))
    left = {p.name.rpartition("-")[0] for p in tmp_path.iterdir()}
    assert "line-cuts" in left and not left & {"lines", "line-texts", "line-classes", "line-lists", "line-open-lists", "line-marked-lists"}
    assert sorted(r.n_removed for r in result.collect()) == [0, 30, 60]


def test_shuffles_of_stored_results_are_gone(spark):
    import os

    def files():
        tops = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())
        return {f for top in tops for _, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = files()
    got = stored(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "counts")
    assert not files() - before
    assert sorted(r["count"] for r in got.collect()) == [142] + [143] * 6


def test_members_that_fit_no_length_leave_their_list(spark):
    from corpusprep.llm import line_dedup as module

    shared = "this passage of words is the same in every one of the lines here"
    lines = [(1, f"{shared}"), (2, f"{shared} x"), (3, shared + " y" * 400)]
    schema = "class long, size int, joined string, fuzzy boolean, first struct<doc_id:long>"
    classes = spark.createDataFrame([(c, len(t), t, True, (1,)) for c, t in lines], schema)
    got = {(r["class"], r.hub) for r in module._lists(classes, LineDedup()).collect()}
    assert {c for c, _ in got} >= {1, 2}
    alone = module._lists(classes.filter("class <> 2"), LineDedup()).collect()
    assert alone == []


def test_marks_count_common_lists(spark):
    from corpusprep.llm import line_dedup as module
    from pyspark.sql import functions as F

    def key(at, value):
        return int(np.uint64((at << 60) | value).view(np.int64))

    rows = [(key(at, v), c) for c, lists in enumerate([{0: 5, 7: 255, 8: 0, 15: 9}, {0: 5, 7: 254, 8: 0, 15: 9}, {1: 5}, {0: 6, 8: 0}]) for at, v in lists.items()]
    marked = module._marked(spark.createDataFrame(rows, "key long, class long")).drop("key").distinct()
    pairs = marked.crossJoin(marked.select([F.col(c).alias(f"{c}_2") for c in marked.columns]))
    got = {(r[0], r[1]): r[2] for r in pairs.select("class", "class_2", module._lists_in_common()).collect()}
    assert [got[0, 1], got[0, 2], got[0, 3], got[1, 3], got[2, 2], got[0, 0]] == [3, 0, 1, 1, 1, 4]
