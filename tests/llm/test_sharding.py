"""Sharding against a plain recursion over the same points."""

import random

from corpusprep.llm.sharding import Sharding, points, shard, write_shards


def recursion(rows, first, k, dims, most, whole):
    """rows: (ranks, md5, doc_id, size); yields (doc_id, md5, shard)."""
    if k == 1 or not rows:
        yield from ((r[2], r[1], first) for r in rows)
        return
    widths = [(max(r[0][i] for r in rows) - min(r[0][i] for r in rows)) / (most[i] or 1) for i in range(dims)]
    dim = widths.index(max(widths))
    rows = sorted(rows, key=lambda r: (r[0][dim], r[1], r[2] is not None, r[2] or 0))
    total = sum(r[3] for r in rows)
    wanted = total * (k // 2) / k
    upto, places = 0, []
    for r in rows:
        places.append((upto, upto + r[3], (r[0][dim], r[1])))
        upto += r[3]
    low, high, key = next(p for p in places if p[0] < wanted <= p[1])
    around = [p for p in places if p[2] == key]
    a, b = around[0][0], around[-1][1]
    if not (b - a > whole or (a == 0 and b == total)):
        low, high = a, b
    limit = low if wanted - low <= high - wanted else high
    left = [r for r, p in zip(rows, places) if p[1] <= limit]
    yield from recursion(left, first, k // 2, dims, most, whole)
    yield from recursion(rows[len(left) :], first + k // 2, k - k // 2, dims, most, whole)


def check(df, how):
    made = points(df, how).collect()
    dims = len(how.dimensions)
    rows = [(tuple(r[f"r{i}"] for i in range(dims)), bytes(r.text_md5), r.doc_id, r.size) for r in made]
    total = sum(r[3] for r in rows)
    k = how.shards or max(1, -(-total // how.target_bytes))
    most = [max((r[0][i] for r in rows), default=0) for i in range(dims)]
    want = sorted(recursion(rows, 0, k, dims, most, how.whole_percent / 100 * total / k), key=str)
    got = shard(df, how).collect()
    assert sorted(((r.doc_id, bytes(r.text_md5), r.shard) for r in got), key=str) == want
    for n in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == n)
        assert slots == list(range(len(slots)))
    return got


def test_tree_is_that_of_a_plain_recursion(spark, docs):
    rng = random.Random(2)
    texts = ["w" * rng.randrange(0, 400) + str(i) for i in range(300)]
    texts += [texts[3]] * 25 + [None, "", "é" * 20_000]
    for how in (Sharding(shards=16), Sharding(shards=5, dimensions=("n_chars", "lang"), whole_percent=50), Sharding(target_bytes=9000)):
        got = check(docs(texts), how)
        sizes = [sum(r.size for r in got if r.shard == n) for n in {r.shard for r in got}]
        assert sum(sizes) == sum(len((t or "").encode()) + 1 for t in texts)


def test_shards_have_about_equal_bytes_and_copies_stay_together(spark, docs):
    rng = random.Random(4)
    texts = [f"{i} " + "x" * rng.randrange(50, 150) for i in range(3000)]
    texts += [f"twin {i % 100}" for i in range(200)]
    got = check(docs(texts), Sharding(shards=16))
    sizes = [sum(r.size for r in got if r.shard == n) for n in range(16)]
    assert max(sizes) <= 1.05 * min(sizes)
    where = {}
    for r in got:
        where.setdefault(bytes(r.text_md5), set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_a_text_that_holds_most_rows_is_spread(spark, docs):
    got = check(docs(["same text"] * 400 + ["a", "b"]), Sharding(shards=8))
    sizes = [sum(r.size for r in got if r.shard == n) for n in range(8)]
    assert max(sizes) - min(sizes) <= 20


def test_nulls_repeated_rows_clashing_names_and_no_rows(spark, docs, tmp_path):
    df = docs([(None, "a"), (None, "a"), (1, "b"), (1, "b"), (1, None), (2, "")])
    df = df.selectExpr("*", "1 AS shard", "2 AS slot", "'x' AS first", "null AS size", "3 AS k", "'y' AS text_md5")
    got = check(df.withColumn("lang", df["lang"].substr(9, 1)), Sharding(shards=3))
    assert len(got) == 6
    assert {r.size for r in got if r.doc_id == 2} == {1} and {r.text_crc32 for r in got if r.doc_id == 2} == {0}
    assert shard(docs([]), Sharding(shards=4)).count() == 0
    few = docs([(1, "a"), (2, "b"), (None, "c")])
    write_shards(few, shard(few, Sharding(shards=2)), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.text for r in back.collect()) == ["a", "b", "c"] and set(back.columns) == {*few.columns, "shard"}
