"""Jaccard self-join of documents on word n-grams, vertically partitioned.

All n-grams have one global order: rare before frequent, then by hash. How frequent an n-gram is comes from a sketch of
fixed size over all documents; any order gives the same links, a good one only keeps candidate lists short.

1. Documents with the same set form one class.
2. Classes that could be linked share an n-gram among the first ``n - ceil(t n) + 1`` of each (prefix principle).
3. In each list of classes under a prefix n-gram one class is the hub, and every other class is compared with it. Two
   classes that are both linked to the hub are connected already. A class that is not gets compared with the others of
   its list, unless the triangle inequality of the Jaccard distance rules the pair out. So a group of near copies costs
   about as many comparisons as it has members, not their square, and no connection is lost.
4. Every set has a bitmap of parities, about two bits for each n-gram. The bits in which two bitmaps differ are at most
   the n-grams in which the sets differ, so a pair that differs in too many bits can't be linked and ends here.
5. To compare the rest, the global order is cut into fragments of about equal mass; each pair's overlap is counted in
   every fragment separately and summed.
6. Links become connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import salted_lookup
from .common import encoded_words, in_slices, mixed, pieces, stored, summed_slices, word_hashes
from .components import components


@dataclass(frozen=True)
class NgramJoin:
    """``sketch_bits``: log2 of the counters of the frequency sketch (4 bytes each); ``filter_bits``: log2 of the bits
    of the candidate filter. Both are broadcast, and their size depends on nothing but these parameters."""

    words: int = 5
    percent: int = 80
    fragments: int = 8
    sketch_bits: int = 22
    filter_bits: int = 23
    _slices: int = field(default=64, repr=False)

    def __post_init__(self):
        if self.words < 1 or not 0 < self.percent <= 100 or self.fragments < 1:
            raise ValueError("words and fragments from 1, percent from 1 to 100")


def sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct n-gram hashes. Fewer words than an n-gram: the whole sequence is the only one."""
    vocabulary, codes, offsets = encoded_words(texts)
    hashes = word_hashes(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    grams = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        grams[: len(hashes) - k] = mixed(grams[: len(hashes) - k] + hashes[k:] + np.uint64(k + 1))
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        if end - start >= words:
            yield np.unique(grams[start : end - words + 1])
        elif end > start:
            whole = np.array([end - start], np.uint64)
            for k in range(start, end):
                whole = mixed(whole + hashes[k : k + 1])
            yield whole
        else:
            yield np.zeros(0, np.uint64)


def signature(grams: np.ndarray) -> int:
    """64 bits of a set, the same in any order; with the set's size it stands for the class."""
    return int(mixed(grams ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64).astype(np.int64))


def parities(grams: np.ndarray) -> bytes:
    """A bit for each place of a power of two of places, twice the set's size or more: is the number of n-grams odd?"""
    places = 1 << max(6, (2 * len(grams) - 1).bit_length())
    counted = np.bincount((grams & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counted & 1).astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """A lower bound of the n-grams in which two sets differ. The larger bitmap is folded to the smaller one's size."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


class Order:
    """The global order: n-grams by class of frequency (log2 of their counter), then by hash."""

    def __init__(self, counters: np.ndarray, bits: int):
        self.bits = bits
        self.classes = np.ceil(np.log2(np.maximum(counters, 1))).astype(np.uint8)
        mass = np.bincount(self.classes, weights=counters, minlength=65)
        self.below = np.concatenate([[0.0], np.cumsum(mass)])
        self.mass = mass

    def keys(self, grams: np.ndarray) -> np.ndarray:
        frequency = self.classes[(grams & np.uint64((1 << self.bits) - 1)).astype(np.int64)].astype(np.uint64)
        return (frequency << np.uint64(56)) | (grams >> np.uint64(8))

    def fragment(self, keys: np.ndarray, fragments: int) -> np.ndarray:
        """Position of sorted keys in the order, as a share of all n-grams, cut into equal pieces."""
        frequency = (keys >> np.uint64(56)).astype(np.int64)
        within = (keys & np.uint64((1 << 56) - 1)).astype(np.float64) / float(1 << 56)
        share = (self.below[frequency] + within * self.mass[frequency]) / max(self.below[-1], 1.0)
        return np.minimum((share * fragments).astype(np.int64), fragments - 1)


def _describe(how: NgramJoin):
    """Per document its set's size, signature and parities (``slice`` null), and per task the sketch in slices."""

    def run(batches):
        counters = np.zeros(1 << how.sketch_bits, np.int64)
        for piece in pieces(batches, "text"):
            sizes, signatures, bits = [], [], []
            for grams in sets(piece["text"], how.words):
                sizes.append(len(grams))
                signatures.append(signature(grams))
                bits.append(parities(grams))
                np.add.at(counters, (grams & np.uint64((1 << how.sketch_bits) - 1)).astype(np.int64), 1)
            empty = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    piece["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.int64()),
                    empty.cast(pa.int32()),
                    pa.array(bits, pa.binary()),
                ],
                names=["doc_id", "n", "sig", "slice", "block"],
            )
        if counters.any():
            numbers, blocks = in_slices(counters.astype(np.uint32), how._slices)
            none = pa.nulls(len(blocks)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, numbers, blocks], names=["doc_id", "n", "sig", "slice", "block"]
            )

    return run


def _sketch(described: DataFrame, how: NgramJoin) -> np.ndarray:
    slices = described.filter("slice is not null").select("slice", "block")
    return summed_slices(slices, how._slices, 1 << how.sketch_bits, "uint32")


def _prefixes(how: NgramJoin, order):
    """Rows ``token, sig, n, place`` for the prefix of every class, once per task; ``place`` counts from 0."""

    def run(batches):
        seen = set()
        ranks = order.value
        for piece in pieces(batches, "text"):
            tokens, owners, sizes, places = [], [], [], []
            for grams in sets(piece["text"], how.words):
                n, sig = len(grams), signature(grams)
                if n == 0 or (sig, n) in seen:
                    continue
                seen.add((sig, n))
                keys = np.sort(ranks.keys(grams))[: n - -(-how.percent * n // 100) + 1]
                tokens.append(keys.view(np.int64))
                owners.append(np.full(len(keys), sig, np.int64))
                sizes.append(np.full(len(keys), n, np.int64))
                places.append(np.arange(len(keys), dtype=np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (tokens, owners, sizes, places)],
                    names=["token", "sig", "n", "place"],
                )

    return run


def _segments(how: NgramJoin, order, wanted):
    """Rows ``sides, sig, n, fragment, keys`` for the representatives of candidate pairs; ``sides`` has bit 1 for those on
    the left of a pair, bit 2 for those on the right."""

    def run(batches):
        ranks, filters = order.value, wanted.value
        for piece in pieces(batches, "text"):
            ids = np.array([-1 if i is None else i for i in piece["doc_id"].to_pylist()], np.int64)
            place = (mixed(ids.view(np.uint64)) & np.uint64((1 << how.filter_bits) - 1)).astype(np.int64)
            left, right = ((bits[place >> 3] >> (place & 7)) & 1 for bits in filters)
            asked = left + 2 * right
            chosen = piece.filter(pa.array(asked > 0))
            side, owner, size, number, keys = [], [], [], [], []
            for here, grams in zip(asked[asked > 0].tolist(), sets(chosen["text"], how.words), strict=True):
                ordered = np.sort(ranks.keys(grams))
                pieces_of = ranks.fragment(ordered, how.fragments)
                starts = np.flatnonzero(np.diff(pieces_of, prepend=-1)) if len(ordered) else []
                sig = signature(grams)
                for start, part in zip(starts, np.split(ordered, starts[1:]), strict=True):
                    side.append(here)
                    owner.append(sig)
                    size.append(len(grams))
                    number.append(int(pieces_of[start]))
                    keys.append(part.view(np.int64))
            if owner:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(side, pa.int32()),
                        pa.array(owner, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(number, pa.int32()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["sides", "sig", "n", "fragment", "keys"],
                )

    return run


def _filter_of(ids: DataFrame, how: NgramJoin) -> np.ndarray:
    """A bitmap of hashed ids of ``2 ** filter_bits`` bits. It may let others through, never keeps one out."""

    def places(batches):
        for batch in batches:
            values = batch["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64)
            place = mixed(values.view(np.uint64)) & np.uint64((1 << how.filter_bits) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64))], names=["place"])

    placed = ids.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id")).mapInArrow(places, "place long")
    rows = (
        placed.groupBy(F.expr("place div 32768").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.pmod("place", F.lit(32768))).alias("bits"))
        .collect()
    )
    bits = np.zeros(max(1 << how.filter_bits >> 3, 4096), np.uint8)
    for row in rows:  # at most 2 ** filter_bits / 32768
        bits[row["bucket"] * 4096 : (row["bucket"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``sig, n, sig2, n2, least``: the smallest Jaccard distance that the bitmaps of both sides allow."""

    def run(batches):
        for batch in batches:
            n, n2 = (batch[c].to_numpy().astype(np.float64) for c in ("n", "n2"))
            bitmaps = zip(batch["bits"].to_pylist(), batch["bits2"].to_pylist(), strict=True)
            differ = np.array([differing(a, b) for a, b in bitmaps], np.float64)
            shared = np.floor((n + n2 - differ) / 2)
            bound = 1.0 - shared / (n + n2 - shared)
            names = ["sig", "n", "sig2", "n2"]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], pa.array(bound)], names=[*names, "least"])

    left = classes.select("sig", "n", "bits")
    both = pairs.join(left, ["sig", "n"]).join(left.toDF("sig2", "n2", "bits2"), ["sig2", "n2"])
    asked = both.select("sig", "n", "sig2", "n2", "bits", "bits2")
    return asked.mapInArrow(run, "sig long, n long, sig2 long, n2 long, least double")


def _compared(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """Overlap of each pair: counted fragment by fragment, then summed. Columns of ``pairs`` and ``shared``."""
    left = segments.filter("sides % 2 = 1").select("sig", "n", "fragment", "keys")
    right = segments.filter("sides >= 2").select(
        F.col("sig").alias("sig2"), F.col("n").alias("n2"), "fragment", F.col("keys").alias("keys2")
    )
    both = pairs.join(left, ["sig", "n"]).join(right, ["sig2", "n2", "fragment"])
    partial = both.select("sig", "n", "sig2", "n2", "fragment", F.size(F.array_intersect("keys", "keys2")).alias("_o"))
    # A representative whose row is repeated has its segments twice; the maximum counts them once.
    once = partial.groupBy("sig", "n", "sig2", "n2", "fragment").agg(F.max("_o").alias("_o"))
    summed = once.groupBy("sig", "n", "sig2", "n2").agg(F.sum("_o").alias("shared"))
    return pairs.join(summed, ["sig", "n", "sig2", "n2"], "left").withColumn("shared", F.coalesce("shared", F.lit(0)))


def ngram_join(docs: DataFrame, how: NgramJoin = NgramJoin()) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_verified_links`` for every row of ``docs`` (``doc_id`` long, ``text``).

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct word n-grams;
    ``component_id`` is the smallest doc_id reachable by links. ``n_verified_links`` counts links that were verified for the
    document's class, not those that follow from them. Null and wordless texts have an empty set and stay alone. A
    null doc_id can't be linked to: such a row gets the smallest id of its group, null if that has none. Repeated rows
    come back as often as they came; a doc_id with several texts connects what they are linked with. Other columns are
    ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = stored(
        narrow.mapInArrow(_describe(how), "doc_id long, n long, sig long, slice int, block binary"),
        "ngram-sets",
    )
    order = spark.sparkContext.broadcast(Order(_sketch(described, how), how.sketch_bits))
    members = described.filter("slice is null").select("doc_id", "n", "sig", F.col("block").alias("bits"))
    grouped = members.filter("n > 0").groupBy("sig", "n")
    classes = stored(
        grouped.agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bits").alias("bits")),
        "ngram-classes",
    )

    prefixes = narrow.mapInArrow(_prefixes(how, order), "token long, sig long, n long, place long")
    # One shuffle by token serves the removal of repeats, the hubs and the way back to the rows. The hub is the class
    # with the fewest rarer n-grams: the original of a group of copies has none of its own.
    listed = prefixes.repartition("token").dropDuplicates(["token", "sig", "n", "place"])
    hubs = listed.groupBy("token").agg(
        F.count("*").alias("_members"), F.min(F.struct("place", "n", "sig")).alias("hub")
    )
    lists = stored(
        listed.join(hubs.filter("_members > 1"), "token").select(
            "token", "sig", "n", "place", F.col("hub.sig").alias("sig2"), F.col("hub.n").alias("n2"),
            F.col("hub.place").alias("place2"),
        ),
        "ngram-lists",
    )
    same = (F.col("sig") == F.col("sig2")) & (F.col("n") == F.col("n2"))
    # Overlap that a link needs, and the places the first common n-gram of linked sets can have: as many n-grams before
    # it as the set may lose.
    total = F.col("n") + F.col("n2")
    needed = F.expr(f"({how.percent} * (n + n2) + {99 + how.percent}) div {100 + how.percent}")
    fits = (
        (F.lit(100) * F.least("n", "n2") >= F.lit(how.percent) * F.greatest("n", "n2"))
        & (F.col("place") <= F.col("n") - needed)
        & (F.col("place2") <= F.col("n2") - needed)
    )

    reach = F.lit(1.0 - how.percent / 100 + 1e-9)

    def asked(pairs: DataFrame) -> np.ndarray:
        return _filter_of(pairs.distinct().join(classes, ["sig", "n"]).select(F.col("rep").alias("doc_id")), how)

    def compare(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs with the verdict ``linked`` and bounds ``least`` and ``most`` of their distance, which are equal where
        the sets were compared; n-grams are fetched only for pairs that the bitmaps leave open."""
        bounded = stored(_bounded(pairs, classes), f"ngram-{name}-pairs")
        left = bounded.filter(F.col("least") <= reach).select("sig", "n", "sig2", "n2")
        sides = asked(left.select("sig", "n")), asked(left.select("sig2", "n2").toDF("sig", "n"))
        wanted = spark.sparkContext.broadcast(sides)
        segments = stored(
            narrow.mapInArrow(_segments(how, order, wanted), "sides int, sig long, n long, fragment int, keys array<long>"),
            f"ngram-{name}-segments",
        )
        union, distance = total - F.col("shared"), F.lit(1.0) - F.col("shared") / (total - F.col("shared"))
        judged = _compared(left, segments).select(
            "sig", "n", "sig2", "n2", (F.lit(100) * F.col("shared") >= F.lit(how.percent) * union).alias("linked"),
            distance.alias("least"), distance.alias("most"),
        )
        apart = bounded.filter(F.col("least") > reach).select(
            "sig", "n", "sig2", "n2", F.lit(False).alias("linked"), "least", F.lit(1.0).alias("most")
        )
        return stored(judged.union(apart), f"ngram-{name}-links")

    star = compare(lists.filter(~same & fits).select("sig", "n", "sig2", "n2").distinct(), "hub")

    # Classes of a list with their verdict against its hub. Those linked to the hub are connected with each other.
    judged = stored(
        lists.filter(~same)
        .join(star, ["sig", "n", "sig2", "n2"], "left")
        .select(
            "token", "sig", "n", "place", F.coalesce("linked", F.lit(False)).alias("linked"),
            F.coalesce("least", F.lit(0.0)).alias("least"), F.coalesce("most", F.lit(1.0)).alias("most"),
        ),
        "ngram-judged",
    )
    others = judged.select("token", *[F.col(c).alias(f"{c}2") for c in ("sig", "n", "place", "linked", "least", "most")])
    first = (F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("sig") < F.col("sig2")))
    near = (F.col("least") - F.col("most2") <= reach) & (F.col("least2") - F.col("most") <= reach)
    rest = (
        judged.filter("not linked")
        .select("token", "sig", "n", "place", "least", "most")
        .join(others, "token")
        .filter(fits & near & ~same & (F.col("linked2") | first))
        .select("sig", "n", "sig2", "n2")
        .distinct()
    )
    met = compare(rest, "other").filter("linked").select("sig", "n", "sig2", "n2")
    links = star.filter("linked").select("sig", "n", "sig2", "n2").union(met)
    reps = classes.filter("rep is not null")
    named = links.join(reps.withColumnRenamed("rep", "a"), ["sig", "n"]).join(
        reps.select(F.col("sig").alias("sig2"), F.col("n").alias("n2"), F.col("rep").alias("b")), ["sig2", "n2"]
    )
    groups = components(named.select("a", "b"))
    degrees = (
        named.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
        .select(F.explode(F.array("a", "b")).alias("rep"))
        .groupBy("rep")
        .agg(F.count("*").alias("n_verified_links"))
    )
    labelled = classes.join(groups, F.col("rep") == F.col("node"), "left").join(degrees, "rep", "left")
    # A document whose text nobody shares or resembles is its own group: it needs no lookup.
    labelled = labelled.filter("copies > 1 or component is not null").select(
        "sig", "n", F.coalesce("component", "rep").alias("component_id"), "n_verified_links"
    )
    placed = salted_lookup(members.drop("bits"), labelled, ["sig", "n"], ["doc_id"])
    return placed.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_verified_links", F.lit(0)).alias("n_verified_links"),
    )
