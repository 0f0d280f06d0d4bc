"""Near-duplicate groups by min-max hashing of word shingles.

Each hash permutation gives two signature values, the least and the
greatest hashed shingle, so half the hash evaluations of plain min-hashing
fill a signature.  The values are banded; documents that share a band are
candidates.  Candidate pairs are confirmed on full shingle sets and linked
documents are joined into components.

Documents with equal sets are one class first, so copies never meet as
pairs.  In a band's bucket, the member that shares most buckets with others
is the hub and every member is compared with it; components of those links
are found, and then only members that still lie outside their bucket's
largest component meet the members of other components.  Sketches of longer
signatures (four bits a value) tell which of those pairs can reach the
similarity, and they are confirmed like the others.  So every candidate pair
is joined already, ruled out by its sketch, or confirmed, and a group around a
common original costs a number of confirmations in proportion to it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import documents, written
from .kernels import Powers, chunked, mix, words


def shingle_sets(parts: list, powers: Powers, size: int) -> list[np.ndarray]:
    """Distinct ``size``-word shingles (64-bit hashes, sorted) of each text; shorter texts are one shingle."""
    hashes, at = words(parts, powers)
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled[: n - k] = mix(rolled[: n - k] * np.uint64(0x100000001B3) + hashes[k:]) if k else hashes
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            out.append(np.unique(rolled[a: b - size + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mix(whole * np.uint64(0x9E3779B1) + hashes[k: k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _coefficients(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * permutations + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return seeds[:permutations] | np.uint64(1), seeds[permutations:]


def min_max_signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least and greatest value under each permutation, permutations first."""
    low = np.full(len(a), np.iinfo(np.uint64).max)
    high = np.zeros(len(a), np.uint64)
    for at in range(0, len(shingles), 1024):
        hashed = shingles[at: at + 1024, None] * a + b
        hashed ^= hashed >> np.uint64(32)
        low = np.minimum(low, hashed.min(axis=0))
        high = np.maximum(high, hashed.max(axis=0))
    return np.stack([low, high], axis=1)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One key per band; a band takes equally many least and greatest values, of different permutations."""
    values = np.concatenate([signature[:, 0], np.roll(signature[:, 1], len(signature) // 2)])
    # band i takes positions i, i + bands, ...: never both values of one permutation
    rows = values.reshape(-1, bands)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for row in rows:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys


def sketch(signature: np.ndarray) -> np.ndarray:
    """The lowest four bits of every signature value, packed into 64-bit words."""
    bits = (signature.reshape(-1, 1) >> np.arange(4, dtype=np.uint64)) & np.uint64(1)
    packed = np.packbits(bits.astype(np.uint8).ravel())
    return np.append(packed, np.zeros(-len(packed) % 8, np.uint8)).view(np.int64)


def most_differing_bits(values: int, similarity: float, sigmas: float = 4.3) -> int:
    """Bits in which the sketches of two sets of this similarity differ at most, but for one pair in 100 000.

    A value that differs (chance q) differs in two of its four bits on average.
    """
    q = 1 - similarity
    return math.ceil(values * 2 * q + sigmas * math.sqrt(values * (5 * q - 4 * q * q)))


def _signatures(size: int, bands: int, rows: int):
    def run(frames):
        powers = Powers()
        a, b = _coefficients(bands * rows // 2)
        none = np.zeros(0, np.int64)
        for frame in frames:
            for first, last, parts in chunked(list(frame.text)):
                out = []
                for s in shingle_sets(parts, powers, size):
                    if len(s):
                        keys = band_keys(min_max_signature(s, a, b), bands).view(np.int64)
                        place = np.arange(len(s), dtype=np.uint64)
                        print_ = (int(s.sum().view(np.int64)), int(mix(s + place).sum().view(np.int64)))
                    else:
                        keys, print_ = none, (None, None)
                    out.append((len(s), *print_, keys))
                got = pd.DataFrame(out, columns=["n_shingles", "print_a", "print_b", "bands"]).astype(
                    {"print_a": "Int64", "print_b": "Int64"})
                got.insert(0, "doc_id", frame.doc_id.iloc[first:last].to_numpy())
                yield got
    return run


def _sets(size: int):
    def run(frames):
        powers = Powers()
        for frame in frames:
            for first, last, parts in chunked(list(frame.text)):
                sets = shingle_sets(parts, powers, size)
                yield pd.DataFrame({"id": frame.id.iloc[first:last].to_numpy(),
                                    "shingles": [s.view(np.int64) for s in sets]})
    return run


def _sketches(permutations: int):
    def run(frames):
        a, b = _coefficients(permutations)
        for frame in frames:
            frame["bits"] = [sketch(min_max_signature(np.asarray(s, np.int64).view(np.uint64), a, b)) for s in frame.shingles]
            yield frame[["id", "bits"]]
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    sa = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    same = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(sb, "b").join(sa, "a").withColumn("same", same)
            .where(100 * F.col("same") >= percent * (F.size("sa") + F.size("sb") - F.col("same"))).select("a", "b"))


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """id and the least id reachable over ``links`` (a, b), for every id that has a link.

    Alternating large-star and small-star rounds until no link moves; every
    round is written to the shared folder.
    """
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most_rounds):
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = written(large)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                               F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")
                                             ).select("x.a", "x.b").where("a <> b").distinct()
        links = written(small)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _members(rows: DataFrame, found: DataFrame) -> DataFrame:
    return (rows.join(found, "id", "left")
            .withColumn("component", F.coalesce("component", "id")))


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 40, rows: int = 6,
                    sketch_values: int = 2048) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``df`` (doc_id, text).

    Words are lower-cased (A-Z) runs without ASCII white space.  Two texts are
    linked when 100 * shared >= ``percent`` * united shingles; a text of fewer
    than ``shingle`` words is one shingle, one without words has none and is
    linked with nothing.  ``component_id`` is the least id reachable.  A pair
    at 80 % shares none of the 40 bands with a chance of about 5 in a million,
    and its sketches rule it out with one of about 10 in a million.
    Rows that repeat an id and text are kept or dropped together; of several
    texts under one id the least stands for it in confirmations; a null id
    is never a component's id, and its row is kept only if no other row joins it.
    """
    docs = documents(df)
    kind = "doc_id string, n_shingles bigint, print_a bigint, print_b bigint, bands array<bigint>"
    seen = written(docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(_signatures(shingle, bands, rows), kind)
                   .withColumn("doc_id", F.col("doc_id").cast("bigint")))
    classes = written(seen.where("n_shingles > 0 and doc_id is not null").groupBy("print_a", "print_b", "n_shingles")
                      .agg(F.min_by("bands", "doc_id").alias("bands"), F.min("doc_id").alias("id")))
    keyed = classes.select("id", "n_shingles", F.explode("bands").alias("key"))
    shared = written(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    member = written(keyed.join(shared, "key"))
    # the hub: the member that meets most others over all its buckets
    weight = member.groupBy("id").agg(F.sum("n").alias("weight"))
    hubs = written(member.join(weight, "id").groupBy("key").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("hub")))
    sizes = member.groupBy("id").agg(F.first("n_shingles").alias("size"))
    sets = written(docs.withColumnRenamed("doc_id", "id").join(sizes.select("id"), "id", "left_semi")
                   .groupBy("id").agg(F.min("text").alias("text")).mapInPandas(_sets(shingle), "id bigint, shingles array<bigint>"))

    def near(a, b):
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    first = (member.join(hubs, "key").where("id <> hub")
             .select(F.col("hub").alias("a"), F.col("id").alias("b"), F.col("n_shingles").alias("size_b")).distinct()
             .join(sizes.select(F.col("id").alias("a"), F.col("size").alias("size_a")), "a")
             .where(near(F.col("size_a"), F.col("size_b"))).select("a", "b"))
    first = written(_confirmed(written(first), sets, percent))
    grouped = written(_members(member.select("id", "n_shingles", "key"), components(first)))
    # what lies outside its bucket's largest component still has to meet the bucket's other components
    parts = grouped.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = parts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("largest"),
                                       F.count("*").alias("parts")).where("parts > 1").drop("parts")
    split = written(grouped.join(written(largest), "key"))
    late_ids = split.select("id").distinct()
    bits = written(sets.join(late_ids, "id", "left_semi").mapInPandas(_sketches(sketch_values // 2),
                                                                      "id bigint, bits array<bigint>"))
    split = written(split.join(classes.select("id", "bands").dropDuplicates(["id"]), "id").join(bits, "id"))
    outer, other = (split.select("key", F.col("id").alias(x), F.col("n_shingles").alias(f"size_{x}"),
                                 F.col("component").alias(f"in_{x}"), F.col("bands").alias(f"bands_{x}"),
                                 F.col("bits").alias(f"bits_{x}"), (F.col("component") == F.col("largest")).alias(f"main_{x}"))
                    for x in "ab")
    # sketches differ in few bits where sets are alike; the pair is taken in the first bucket that both share
    differ = sum((F.bit_count(F.get("bits_a", i).bitwiseXOR(F.get("bits_b", i))) for i in range(-(-sketch_values // 16))),
                 F.lit(0))
    shared_band = F.array_position(F.zip_with("bands_a", "bands_b", lambda x, y: x == y), True)
    late = (outer.where(~F.col("main_a")).join(other, "key")
            .where((F.col("in_a") != F.col("in_b")) & (F.col("main_b") | (F.col("a") < F.col("b")))
                   & near(F.col("size_a"), F.col("size_b"))
                   & (differ <= most_differing_bits(sketch_values, percent / 100))
                   & (F.element_at("bands_a", shared_band.cast("int")) == F.col("key")))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = first.unionAll(_confirmed(written(late), sets, percent))
    final = written(_members(classes.select("id", "print_a", "print_b", "n_shingles"), components(links)))
    joined = seen.select("doc_id", "n_shingles", "print_a", "print_b").join(
        final.select("print_a", "print_b", "n_shingles", "component"), ["print_a", "print_b", "n_shingles"], "left")
    component = F.coalesce("component", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.col("component").isNull()).alias("kept"))
