"""Near-duplicates by SimHash: fingerprints, pigeonhole blocks, verified links, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import components, staged, words

SEED = 42
SHINGLE = 3
DISTANCE = 3
# Blocks beyond the distance that a pair must share: with 6 blocks and distance 3
# any close pair agrees on 3 blocks of 10 or 11 bits.
SPARE_BLOCKS = 3
# Above this many fingerprints in a block, links come from hubs instead of pairs.
PAIRED_AT_MOST = 4096
# Texts whose hashes are held together.
_TEXTS_AT_ONCE = 1000
# Lanes of 16 bits count up to this many shingles at once.
_LANE_LIMIT = 65535
_LANES = np.uint64(0x0001000100010001)


def _shingle_hashes(text, shingle: int) -> np.ndarray:
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(found).lower(), xxhash.xxh64_intdigest
    if len(found) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    return np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64, len(stops))


def simhash(texts: list, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of texts: a bit is 1 if it is set in over half of the shingles' hashes."""
    hashes = [_shingle_hashes(text, shingle) for text in texts]
    sizes = np.array([len(h) for h in hashes], np.int64)
    prints = np.zeros(len(texts), np.uint64)
    if not sizes.sum():
        return prints
    starts, owners, at = [], [], 0
    for owner, size in enumerate(sizes.tolist()):
        for begin in range(0, size, _LANE_LIMIT):
            starts.append(at + begin)
            owners.append(owner)
        at += size
    pool, owners = np.concatenate(hashes), np.array(owners)
    ones = np.zeros((len(texts), 64), np.int64)
    for shift in range(16):
        lanes = np.add.reduceat((pool >> np.uint64(shift)) & _LANES, starts)
        for lane in range(4):
            counted = (lanes >> np.uint64(16 * lane)) & np.uint64(_LANE_LIMIT)
            np.add.at(ones[:, shift + 16 * lane], owners, counted.astype(np.int64))
    for bit in range(64):
        prints |= (2 * ones[:, bit] > sizes).astype(np.uint64) << np.uint64(bit)
    return prints


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The 64 bits, as a signed long, of a text; null and blank ones have zero."""

    @F.pandas_udf("long")
    def of(texts):
        parts = [simhash(texts[at : at + _TEXTS_AT_ONCE].tolist(), shingle) for at in range(0, len(texts), _TEXTS_AT_ONCE)]
        return type(texts)(np.concatenate(parts).view(np.int64) if parts else [], dtype="int64")

    return of(text.cast("string"))


def _masks(distance: int) -> list[int]:
    """Bit masks of which every pair within the distance agrees on one at least."""
    count = distance + SPARE_BLOCKS
    edges = [64 * i // count for i in range(count + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(kept) for kept in combinations(blocks, count - distance)]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _flips(masks: list[int], radius: int) -> list[tuple[int, int, int]]:
    """Block, change and number of changed bits, up to the radius, outside each mask."""
    found = []
    for block, mask in enumerate(masks):
        free = [b for b in range(64) if not mask >> b & 1]
        for size in range(radius + 1):
            found += [(block, _signed(sum(1 << b for b in bits)), size) for bits in combinations(free, size)]
    return found


def links(prints: DataFrame, distance: int = DISTANCE, paired_at_most: int = PAIRED_AT_MOST) -> DataFrame:
    """Links that connect all distinct fingerprints within the distance.

    ``prints`` has one row per fingerprint. Pairs of a block are verified in the
    join, so only true links leave it. A block with more than ``paired_at_most``
    fingerprints isn't paired: each of its fingerprints goes to the points
    ("hubs") that differ from it in few of the bits outside the block; two within
    the distance meet at one, and at a hub all link to the smallest that is
    within half of the distance. Rows grow with the block, not with its square,
    and connect the same fingerprints.
    """
    spark, masks = prints.sparkSession, _masks(distance)
    keyed = prints.select(
        "print",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("block"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("bits"))
                    for i, m in enumerate(masks)
                )
            )
        ).alias("key"),
    ).select("key.block", "key.bits", "print")
    crowded = staged(keyed.groupBy("block", "bits").count().where(F.col("count") > paired_at_most), "crowded")
    hot = not crowded.isEmpty()
    calm = keyed.join(crowded, ["block", "bits"], "left_anti") if hot else keyed
    one, two = calm.alias("one"), calm.alias("two")
    pairs = one.join(
        two,
        (F.col("one.block") == F.col("two.block"))
        & (F.col("one.bits") == F.col("two.bits"))
        & (F.col("one.print") < F.col("two.print"))
        & (F.bit_count(F.col("one.print").bitwiseXOR(F.col("two.print"))) <= distance),
    ).select(F.col("one.print").alias("a"), F.col("two.print").alias("b"))
    if not hot:
        return pairs.distinct()
    near, far = distance // 2, distance - distance // 2
    flips = spark.createDataFrame(_flips(masks, far), "block int, flip long, size int")  # a fixed, small table
    members = keyed.join(crowded, ["block", "bits"], "left_semi").join(F.broadcast(flips), "block")
    members = members.select("print", "size", "block", F.col("print").bitwiseXOR(F.col("flip")).alias("hub"))
    heads = members.where(F.col("size") <= near).groupBy("block", "hub").agg(F.min("print").alias("head"))
    bridged = members.join(heads, ["block", "hub"]).where("print <> head").select(
        F.least("print", "head").alias("a"), F.greatest("print", "head").alias("b")
    )
    return pairs.union(bridged).distinct()


def _grouped(prints: DataFrame, distance: int, paired_at_most: int) -> DataFrame:
    """Adds ``component_id`` to rows with ``doc_id`` and ``print``."""
    classes = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    linked = staged(links(classes.select("print"), distance, paired_at_most), "links")
    roots = components(linked).select(F.col("node").alias("print"), "root")
    rooted = classes.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(named, "root").select("print", "root", "component_id"), "print")


def near_duplicates(
    docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, paired_at_most: int = PAIRED_AT_MOST
) -> DataFrame:
    """``doc_id``, ``print`` and ``component_id`` of every document.

    Documents with equal fingerprints are one class; classes within the distance
    are linked, and a component has the smallest ``doc_id`` among all it reaches
    (null only if none of them has one). Repeated rows stay repeated. No rows for
    no documents.
    """
    printed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint(F.col("text"), shingle).alias("print"))
    return _grouped(staged(printed, "prints"), distance, paired_at_most).select("doc_id", "print", "component_id")


def one_of_each(
    docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE, paired_at_most: int = PAIRED_AT_MOST
) -> DataFrame:
    """One document of each component, all columns kept: the one with the smallest
    ``doc_id``, null last, and one only of rows with that id. A null text is an
    empty one; texts without words have one fingerprint. No rows for no documents."""
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc_"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        fingerprint(F.col("text"), shingle).alias("print"),
    )
    printed = staged(whole, "printed")  # row numbers stay as they are written
    grouped = _grouped(printed.select("doc_id", "row", "print"), distance, paired_at_most)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = grouped.groupBy("root").agg(first).select(F.col("first.row").alias("row"))
    return printed.join(kept, "row", "left_semi").select("doc_.*")
