"""Operators on single texts against brute force, exact round trips and planted cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm.chat_format import ChatTemplate, format_chats, read_back
from corpusprep.llm.decontam import Decontamination, decontaminate, without_spans
from corpusprep.llm.fm_index import FMIndex, suffix_array
from corpusprep.llm.license_scan import TEMPLATES, LicenseScan, Scanner, differences, license_scan
from corpusprep.llm.lm_score import LanguageModel, Weights, features, lm_score
from corpusprep.llm.mixing import Mixing, mix
from corpusprep.llm.quality_rules import at_most, quality_rules
from corpusprep.llm.token_counts import bpe_counts, commit, deletes, inserts, revisions, totals, word_counts
from corpusprep.llm.url_filter import UrlFilter, url_filter


def test_index_finds_every_occurrence():
    r = np.random.default_rng(1)
    for trial in range(60):
        x = r.integers(1, r.integers(2, 6), r.integers(1, 60))
        x = np.tile(x, 3) if trial % 3 == 0 else x
        text = np.concatenate([x, [0]])
        assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        index, size = FMIndex(x, 4), int(r.integers(1, 5))
        patterns, lengths = r.integers(1, 7, (6, size)), r.integers(1, size + 1, 6)
        for p, m, low, high in zip(patterns, lengths, *index.search(patterns, lengths), strict=True):
            want = [i for i in range(len(x) - m + 1) if (x[i : i + m] == p[:m]).all()]
            assert sorted(index.locate(np.arange(low, high)).tolist()) == want


def test_windows_and_short_items_are_cut_out(spark, docs):
    item = " ".join(f"k{i}" for i in range(20))
    rows = [(1, item), (2, "tiny item"), (None, "no id here"), (4, None), (5, "..."), (1, item)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    texts = [
        f"before {item.upper()} after",
        "a Tiny, ITEM b",
        " ".join(f"k{i}" for i in range(12)),
        None,
        "",
        "x no id here y " + "z " * 100,
    ]
    for block in (1000, 3):
        found = decontaminate(docs(texts), bench, Decontamination(block=block))
        got = {r.doc_id: r for r in found.collect()}
        assert [got[i].n_hit for i in range(6)] == [20, 2, 0, 0, 0, 3]
        assert [got[i].items for i in range(6)] == [["1"], ["2"], [], [], [], [""]]
        assert [got[i].contaminated for i in range(6)] == [True, True, False, False, False, False]
    cut = docs(texts).join(found, "doc_id").select("doc_id", without_spans(F.col("text"), F.col("spans")).alias("t"))
    assert {r.doc_id: r.t for r in cut.collect()}[0] == "before  after"
    assert decontaminate(docs(texts), bench.filter("false")).filter("contaminated").count() == 0
    assert decontaminate(docs(texts).filter("false"), bench).count() == 0


def test_binomial_bound_is_exact(spark):
    df = spark.createDataFrame([(0, 10), (3, 10), (10, 10), (4, 900)], "k long, n long")
    got = [r[0] for r in df.select(at_most(F.col("k"), F.col("n"), 0.01)).collect()]
    want = [sum(math.comb(n, i) * 0.01**i * 0.99 ** (n - i) for i in range(k + 1)) for k, n in ((0, 10), (3, 10), (10, 10), (4, 900))]
    assert got == pytest.approx(want)


def test_quality_of_odd_texts(spark, docs):
    good = " ".join(f"word{i}" for i in range(40))
    texts = [good, None, "", "a b " * 30, "# " * 40, good]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules(docs(texts), labels).collect()}
    assert [got[i].kept for i in range(6)] == [True, False, False, False, False, True]
    assert got[3].n_repeat_words == 60 and got[4].n_symbols == 40 and got[0].word_chars == len(good) - 39
    assert quality_rules(docs(texts).filter("false"), labels).count() == 0


def test_cutoffs_catch_bad_documents_without_losing_good_ones(spark):
    rng = random.Random(2)
    rows = []
    for i in range(2400):
        words = [f"w{rng.randrange(5000)}" for _ in range(40)]
        bad = i % 8 == 0
        rows.append((i, " ".join(f"{w}%%%" if bad else w for w in words), "en", 0 if bad else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    got = quality_rules(df.drop("quality"), df.select("doc_id", "quality"))
    wrong = got.join(df.select("doc_id", "quality"), "doc_id").filter("kept <> (quality = 1)").count()
    assert wrong == 0


def test_model_is_a_distribution_and_beats_frequencies(docs):
    rng = random.Random(5)
    pairs = {f"a{i}": f"b{i}ing" for i in range(30)}
    texts = []
    for _ in range(400):
        texts.append(" ".join(w for _ in range(12) for w in rng.choice(list(pairs.items()))))
    got = lm_score(docs([*texts, None, ""]), F.pmod("doc_id", F.lit(7)) == 2, LanguageModel(rate=1.0, batch=256)).collect()
    held = [r for r in got if r.held_out and r.n_tokens > 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    training = [t.split() for i, t in enumerate([*texts, "", ""]) if i % 7 != 2]
    counts = {}
    for words in training:
        for w in [*words, ""]:
            counts[w] = counts.get(w, 0) + 1
    total, size = sum(counts.values()), len(counts)
    for r in got[:5]:
        words = [*texts[r.doc_id].split(), ""]
        want = sum(math.log10((counts.get(w, 0) + 1) / (total + size + 1)) for w in words)
        assert r.base_score == pytest.approx(want) and r.train_tokens == total and r.n_tokens == len(words)
    weights = Weights(8, np.random.default_rng(0).normal(size=(256, 16)))
    found = np.repeat(features(np.array([0, 1]), np.array([2]), np.array([5, 9], np.uint32), np.array([3, 4]))[:, 1:], 256, 1)
    assert np.exp(weights.log_probability(found, np.arange(256))).sum() == pytest.approx(1, abs=1e-4)
    assert lm_score(docs([(1, "a")]).filter("false"), F.lit(False)).count() == 0


def test_trigram_chooses_the_class_inside_a_group():
    assert LanguageModel().batch == 16_384
    found = np.tile(np.array([[1], [2], [3], [4]], np.uint32), (1, 512))
    found[3, 1::2] = 5
    kinds = np.where(np.arange(512) % 2, 33, 34)
    weights = Weights(10)
    for _ in range(20):
        weights.learn(found, kinds, LanguageModel(rate=1.0, batch=64))
    assert np.exp(weights.log_probability(found, kinds)).min() > 0.6


def test_mixture_fits_its_targets(spark):
    rows = [(i, "w " * (5 + i % 7), f"s{i % 3}", "en" if i % 4 else "fr", "t") for i in range(600)]
    df = spark.createDataFrame([*rows, (None, None, None, None, None)], "doc_id long, text string, source string, lang string, topic string")
    got = mix(df, 0.0, Mixing(share=0.2))
    shares = got.groupBy("lang").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("t")).collect()
    by = {r.lang: r.t for r in shares if r.lang}
    assert by["en"] == pytest.approx(by["fr"], rel=1e-6)
    assert sum(by.values()) == pytest.approx(0.2 * sum(5 + i % 7 for i in range(600)), rel=1e-6)
    assert got.count() == 601 and mix(df.filter("false"), 0.5).count() == 0


def test_rollup_follows_signed_batches_and_repeats(spark, docs, tmp_path):
    df, path = docs(["a b", "c", None, "d e f"]), str(tmp_path / "rollup")
    counts = word_counts(df)
    commit(path, "1", [inserts(counts)])
    for _ in range(2):
        commit(path, "2", [deletes(counts.filter("doc_id = 0"))])
        commit(path, "3", [revisions(counts.filter("doc_id = 3"), counts.filter("doc_id = 3").withColumn("n_tokens", F.lit(9).cast("long")))])
    assert {(r.source, r.n_docs, r.n_tokens) for r in totals(spark, path).collect()} == {("s1", 2, 1), ("s0", 1, 9)}


def test_tokens_are_those_of_the_encoder(docs):
    import base64

    import tiktoken

    from corpusprep.llm.token_counts import PATTERN

    ranks = b"\n".join(base64.b64encode(bytes([i])) + b" %d" % i for i in range(256))
    texts = ["Hello, world!", "", None, "<|endoftext|> éé"]
    got = {r.doc_id: r.n_tokens for r in bpe_counts(docs(texts), ranks, "bytes").collect()}
    encoder = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    assert got == {i: len(encoder.encode_ordinary(t or "")) for i, t in enumerate(texts)}


def test_licenses_by_wording(docs):
    texts = ["some prose\nReleased under the MIT License.\nmore", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-XX 9.9.", None, "", "no such word"]
    got = {r.doc_id: (r.license, r.confirmed) for r in license_scan(docs(texts)).collect()}
    assert got[0] == ("MIT-notice", True) and got[1] == ("CC-BY-NC-4.0", True) and not got[2][1] and set(got) == {0, 1, 2}


def test_licenses_behind_other_words_and_across_lines(docs):
    filler = "permission " + "some other prose " * 120
    texts = [
        filler + "Licensed under CC BY 4.0. " + "more of it " * 150,
        "Released under the MIT License. Licensed under CC0 1.0.",
        "This Source Code Form is subject to the terms\nof the Mozilla Public\nLicense, v. 2.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC0 1.0. Licensed under CC0 1.0.",
    ]
    got = license_scan(docs(texts)).filter("confirmed").collect()
    assert sorted((r.doc_id, r.license) for r in got) == [
        (0, "CC-BY-4.0"), (1, "CC0-1.0"), (1, "MIT-notice"), (2, "MPL-2.0"), (3, "GPL-3.0"), (4, "CC0-1.0"), (4, "CC0-1.0")
    ]
    assert {texts[r.doc_id][r.start : r.end] for r in got if r.doc_id == 0} == {"Licensed under CC BY 4.0"}


def test_licenses_that_differ_in_a_name_a_version_or_a_clause(spark, docs):
    plain = {name: wording.replace("{", "").replace("}", "") for name, wording in TEMPLATES.items()}
    gpl = plain["GPL-3.0"]
    texts = [
        gpl.replace("GNU", "GNU Affero"),
        gpl.replace("is licensed", "is not licensed"),
        "It is not released under the MIT License.",
        plain["BSD-2-Clause"],
        plain["BSD-3-Clause"].replace("contributors may", "helpers may"),
        "We do not care. " + gpl,
        gpl.replace("version 3", "version 4"),
        plain["MIT"].replace("copyright notice", "notice"),
        plain["MIT-grant"],
        f"{gpl} {plain['GPL-2.0']} {gpl.replace('This work', 'This')}",
        plain["BSD-opening"],
        "x " * 3_000_000 + gpl,
        gpl + " \n\n" + plain["Apache-2.0"].upper(),
    ]
    found = license_scan(docs(texts).withColumn("license", F.lit("other"))).filter("confirmed").collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.doc_id, r.start)):
        got.setdefault(r.doc_id, []).append(r.license)
    assert got == {
        0: ["AGPL-3.0"], 3: ["BSD-2-Clause"], 4: ["BSD-3-Clause"], 5: ["GPL-3.0"], 7: ["MIT"], 8: ["MIT-grant"],
        9: ["GPL-3.0", "GPL-2.0", "GPL-3.0"], 10: ["BSD-opening"], 11: ["GPL-3.0"], 12: ["GPL-3.0", "Apache-2.0"],
    }
    assert license_scan(docs([])).count() == 0


def test_every_wording_within_its_differences_is_a_candidate():
    rng, scanner = random.Random(5), Scanner(LicenseScan())
    for number, wording in enumerate(scanner.known * 5):
        number %= len(scanner.known)
        words = list(wording.words)
        for _ in range(wording.allowed):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = [f"zz{rng.randrange(99)}"] if rng.random() < 0.5 else []
        if len(differences(wording.words, words).changes) <= wording.allowed:
            assert any(n == number for _, _, n in scanner.windows(["aa"] * 7 + words + ["bb"] * 7)), words


def test_chats_come_back_unchanged(spark):
    template = ChatTemplate()
    for text in ("</s>[INST] ok [/INST]", "\x1bx\x1be<|end|><|end|", "<|turn|>user<|text|>", "", "[", "<<|end|>>"):
        escaped = template.escaped(text)
        assert template.unescaped(escaped) == text and not any(c in escaped for c in template.controls)
        whole = "".join(t for t, _ in template.segments("user", text) + template.segments("assistant", text))
        assert list(template.turns(whole)) == [("user", text), ("assistant", text)]
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (2, 0, "assistant", "x"), (3, None, None, "<s>"), (None, 0, "user", "a"), (1, 1, "assistant", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in read_back(format_chats(turns)).collect()}
    assert {k: (r.n_turns, r.valid) for k, r in got.items()} == {1: (3, False), 2: (1, False), 3: (1, False), None: (1, False)}
    assert read_back(format_chats(turns.filter("false"))).count() == 0


def test_rules_and_learned_verdicts(spark):
    rules = (("allow", "org", "/"), ("block", "bad.org", "/x"), ("block", "com", "/ads"))
    urls = [None, "", "no-scheme", "http://a.org/q", "HTTP://BAD.org/x1?y", "http://badbad.org/x", "ftp://w.com/adsy#z", "http://u.net"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter(pages, UrlFilter(rules=rules, trees=2)).collect()}
    assert [got[i].rule for i in range(8)] == [None, None, None, "org/", "bad.org/x", "org/", "com/ads", None]
    assert [got[i].verdict for i in (3, 4, 5, 6)] == ["allow", "block", "allow", "block"]
    assert got[4].host == "bad.org" and got[4].path == "/x1" and (got[0].host, got[0].path) == ("", "")
    assert {r.verdict for r in url_filter(pages, UrlFilter()).collect()} == {"allow"}
    assert url_filter(pages.filter("false"), UrlFilter(rules=rules)).count() == 0
