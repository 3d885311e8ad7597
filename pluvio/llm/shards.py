"""Sharding of indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import running, stage

#: Groups that one task partitions. A group of over 1 / (shards * LARGE) of all bytes is placed before the others.
TASK_GROUPS, LARGE = 40_000, 256


def difference(partials: list[list[tuple[int, object]]]) -> list[tuple[int, object]]:
    """Combine partial partitions until one is left.

    A partial partition is a list of (sum, tree) with falling sums. The two of
    the largest spread are merged, the largest part of one with the smallest of
    the other; trees are pairs down to the leaves that they came from.
    """
    heap = [(p[-1][0] - p[0][0], i, p) for i, p in enumerate(partials)]
    heapq.heapify(heap)
    seq = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        merged = [(x + y, (s, t) if s is not None and t is not None else t if s is None else s)
                  for (x, s), (y, t) in zip(a, reversed(b))]
        merged.sort(key=lambda p: -p[0])
        heapq.heapreplace(heap, (merged[-1][0] - merged[0][0], seq, merged))
        seq += 1
    return heap[0][2]


def leaves(tree: object) -> list:
    """The leaves of a tree of pairs; leaves are ints or lists."""
    found, stack = [], [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += node
        elif node is not None:
            found.append(node)
    return found


def partition(sizes: list[int], seeds: list[int], turn: int = 0) -> list[int]:
    """A shard for each size, so that sums on top of ``seeds`` are near equal.

    The seeds are a partial partition among the others, whose parts end up in
    different shards and so name them; ``turn`` turns the order of equal seeds.
    """
    n = len(seeds)
    named = sorted(((x, [s]) for s, x in enumerate(seeds)), key=lambda p: (-p[0], (p[1][0] + turn) % n))
    rest = [(0, None)] * (n - 1)
    found = [0] * len(sizes)
    for _, tree in difference([named, *([(x, i), *rest] for i, x in enumerate(sizes))]):
        own = leaves(tree)
        shard = next(x for x in own if isinstance(x, list))[0]
        for i in own:
            if not isinstance(i, list):
                found[i] = shard
    return found


def _split(seeds: list[int], small_bytes: int):
    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "g1", "g2"], ascending=[False, True, True], ignore_index=True)
        own = int(pdf["bytes"].sum())
        grain = own // (1000 * len(seeds)) + 1  # seeds that differ by less count as equal
        share = [x * own // max(1, small_bytes) // grain * grain for x in seeds]
        shard = partition([int(x) for x in pdf["bytes"]], share, int(pdf["bucket"].iloc[0]))
        return pdf.assign(shard=pd.Series(shard, dtype="int32"))[["g1", "g2", "bytes", "shard"]]
    return split


def assign_groups(groups: DataFrame, shards: int = 16) -> DataFrame:
    """Place staged groups (g1, g2, bytes) in ``shards`` shards of near equal bytes: g1, g2, bytes, shard.

    Fewer than shards * LARGE groups can each hold over 1 / (shards * LARGE) of
    all bytes; one task differences these. Tasks of about TASK_GROUPS of the
    others then each difference their own, starting from their part of what the
    large ones left uneven, so a very large group is made up for everywhere. A
    group is one row, however many rows it stands for, and is never divided.
    """
    kind = "g1 long, g2 long, bytes long, shard int"
    row = groups.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    limit = (row["bytes"] or 0) // (shards * LARGE)
    bucketed = groups.withColumn("bucket", F.pmod(F.xxhash64("g1", "g2"), F.lit(max(1, -(-row["n"] // TASK_GROUPS)))).cast("long"))
    large = stage(bucketed.filter(F.col("bytes") > limit).withColumn("bucket", F.lit(0).cast("long"))
                  .groupBy("bucket").applyInPandas(_split([0] * shards, 1), kind))
    sums = {r["shard"]: r["bytes"] for r in large.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
    seeds = [sums.get(s, 0) - min(sums.get(t, 0) for t in range(shards)) for s in range(shards)]
    small_bytes = (row["bytes"] or 0) - sum(sums.values())
    small = bucketed.filter(F.col("bytes") <= limit).groupBy("bucket").applyInPandas(_split(seeds, small_bytes), kind)
    return large.unionByName(small)


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shards of near equal bytes in which equal texts stay together (law ``bytes``).

    One row per document row: doc_id, size (UTF-8 bytes of the text plus 1; a
    null text has none), text_crc32, law, shard, slot (gapless from 0 in each
    shard, by a hash of the id) and grown_shard, null under this law. Null and
    empty texts are one group; repeated rows stay, each with a slot; a null
    doc_id is kept. An empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stage(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g1"), F.xxhash64(F.lit("group"), text).alias("g2")))
    groups = stage(rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes")))
    placed = stage(rows.join(assign_groups(groups, shards).drop("bytes"), ["g1", "g2"])
                   .select("doc_id", "size", "text_crc32", "shard", F.lit(1).cast("long").alias("one")))
    return (running(placed, ["shard"], F.xxhash64("doc_id", "text_crc32"), ["doc_id", "text_crc32", "size"], "one", "slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
