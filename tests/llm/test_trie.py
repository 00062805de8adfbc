"""Prefix trie against brute force."""

import hashlib
import random

from corpusprep.llm.prefix_trie import PrefixTrie, prefix_trie, turn_digests

SCHEMA = "conv_id long, turn long, role string, text string, depth int, owner string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(conversations):
    """``conversations``: id to list of (role, text)."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for key, ids in members.items():
        below = [k for k in members if k[: len(key)] == key]
        childless = [k for k in below if not any(len(x) == len(k) + 1 and x[:-1] == k for x in members)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        ends = ",".join(str(c) for c in sorted(ids) if len(conversations[c]) == len(key))
        rows.append(
            (min(ids), len(key), min(members[key[:-1]]) if key else None, len(ids),
             sum(len(k) == len(key) + 1 for k in below), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=str)


def rows_of(conversations):
    return [(c, i, role, text, 1, "x") for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_trie_is_that_of_all_prefixes(spark):
    rng = random.Random(5)
    made = {}
    for c in range(60):
        if made and rng.random() < 0.8:
            base = made[rng.choice(list(made))]
            cut = rng.randrange(len(base) + 1)
            made[c] = base[:cut] + [(rng.choice("ua"), rng.choice(["é", "b", "ccc", ""])) for _ in range(rng.randrange(6))]
        else:
            made[c] = [(rng.choice("ua"), rng.choice("xyz")) for _ in range(rng.randrange(1, 14))]
    silent = {c: [] for c in (3000, -4)}
    spoken = {c: t for c, t in made.items() if t}
    digests = turn_digests(spark.createDataFrame(rows_of(spoken), SCHEMA))
    ids = spark.createDataFrame([(c,) for c in [*made, *silent, None]], "conv_id long")
    for how in (PrefixTrie(), PrefixTrie(block=3, segment=2), PrefixTrie(block=1, segment=1), PrefixTrie(block=8, segment=1)):
        assert got(prefix_trie(digests, ids, how)) == brute(made | silent), how


def test_copies_a_long_conversation_and_long_texts(spark):
    long = [("u", str(i)) for i in range(700)]
    made = {c: long[:9] for c in range(200)} | {500: long, 501: long[:650] + [("u", "other")], 502: [("a", "é" * 100_000)]}
    digests = turn_digests(spark.createDataFrame(rows_of(made), SCHEMA))
    assert got(prefix_trie(digests, how=PrefixTrie(block=4, segment=16))) == brute(made)


def test_nulls_ties_repeated_rows_and_no_rows(spark):
    rows = [(1, None, None, None, 0, ""), (1, 0, "u", "x", 0, ""), (2, None, "", "", 0, ""), (2, 0, "u", "x", 0, ""),
            (3, 7, "u", "x", 0, ""), (3, 7, "u", "x", 0, ""), (None, 0, "u", "lost", 0, ""),
            (4, 1, "u", "p", 0, ""), (4, 1, "u", "q", 0, ""), (5, 1, "u", "q", 0, ""), (5, 1, "u", "p", 0, "")]
    nodes = {r[:2]: r for r in got(prefix_trie(turn_digests(spark.createDataFrame(rows, SCHEMA))))}
    assert nodes[(1, 0)][3] == 5 and nodes[(1, 2)][3] == 2  # null turns come first, null role and text are empty
    assert nodes[(3, 2)][3] == 1 and nodes[(4, 2)][3] == 2  # repeated turns count; ties do not depend on the input
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(turn_digests(empty), empty).count() == 0
    alone = prefix_trie(turn_digests(empty), spark.createDataFrame([(8,), (8,), (9,)], "conv_id long"))
    assert got(alone) == brute({8: [], 9: []})


def test_roles_and_texts_are_told_apart(spark):
    made = {1: [("u", "ab")], 2: [("ua", "b")], 3: [("", "uab")], 4: [("u", "a"), ("b", "")]}
    assert got(prefix_trie(turn_digests(spark.createDataFrame(rows_of(made), SCHEMA)))) == brute(made)
