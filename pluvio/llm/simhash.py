"""SimHash near-dedup: a binary trie self-join under a Hamming error budget."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import spread, stage, text_bytes

#: Shingles hashed at a time; fingerprints in a sub-trie before it is cut further; node pairs held at a time.
CHUNK, GROUP, FRONTIER = 65_536, 4096, 500_000


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """64 bits, each set if it is set in over half the hashes of the shingles.

    A-Z are lower-cased; words are cut at ASCII white space. Fewer words than a
    shingle has are one shingle; no words give 0.
    """
    found = text.lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(words, len(found)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, len(ends), CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(line[s:e], seed)
                           for s, e in zip(starts[k:k + CHUNK], ends[k:k + CHUNK])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view("<u8")[0])


def _fingerprints(words: int, seed: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words, seed) for t in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(prints.view(np.int64))], [*names, "fp"])
    return run


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, ``keep``, fp) of every row; ``fp`` is the fingerprint as a signed long."""
    names = ["doc_id", *keep]
    rows = spread(docs.select(*names, text_bytes(docs).alias("text")))
    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(_fingerprints(words, seed, names), f"{fields}, fp long")


def hook(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of all pairs; every entry of ``root`` is a root before and after."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def trie_links(prints: np.ndarray, group: np.ndarray, budget: int) -> np.ndarray:
    """For each print its root among those of its group linked to it; sorted by group, then print.

    The sorted prints of a group are a binary trie: a node is the range of rows
    that share the bits so far. Pairs of nodes go down together, one bit at a
    time; each carries the bits that differ so far and is dropped beyond
    ``budget``, or where both hold one tree already. Pairs are handled in
    bounded pieces, deepest first.
    """
    n = len(prints)
    root = np.arange(n)
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    lo, hi = cuts[:-1], cuts[1:]
    lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
    ones = {}
    stack = [(63, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        bit, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            stack += [(bit, *(x[half:] for x in (alo, ahi, blo, bhi, err))), (bit, *(x[:half] for x in (alo, ahi, blo, bhi, err)))]
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            a, b = alo[single], blo[single]
            near = (a != b) & (np.bitwise_count(prints[a] ^ prints[b]) <= budget)
            hook(root, a[near], b[near])
        own = (alo == blo) & (ahi == bhi)
        # a lone pair of rows in one tree, or a node with itself that has one row, needs no more work
        more = ~single & ~(own & (ahi - alo == 1))
        small = more & ~own & (ahi - alo == 1)
        if small.any():  # one row against a node whose rows all hang with it
            first, last = root[blo], root[bhi - 1]
            more &= ~(small & (bhi - blo == 2) & (first == last) & (first == root[alo]))
        if not more.any() or bit < 0:
            continue
        alo, ahi, blo, bhi, err, own = (x[more] for x in (alo, ahi, blo, bhi, err, own))
        if bit not in ones:
            ones[bit] = np.concatenate(([0], np.cumsum((prints >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)))
        count = ones[bit]
        amid, bmid = ahi - (count[ahi] - count[alo]), bhi - (count[bhi] - count[blo])
        cross = ~own
        parts = [
            (alo, amid, blo, bmid, err),
            (amid, ahi, bmid, bhi, err),
            (alo, amid, bmid, bhi, err + 1),
            *((x[cross] for x in (amid, ahi, blo, bmid, err + 1)),),
        ]
        parts = [tuple(p) for p in parts]
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*parts))
        live = (ahi > alo) & (bhi > blo) & (err <= budget)
        if live.any():
            stack.append((bit - 1, alo[live], ahi[live], blo[live], bhi[live], err[live].astype(np.int8)))
    return root


def _links(budget: int):
    def close(path, masked, fp):
        prints = fp.view(np.uint64)
        group = np.cumsum(np.concatenate(([0], (path[1:] != path[:-1]) | (masked[1:] != masked[:-1]))))
        order = np.lexsort((prints, group))
        root = trie_links(prints[order], group[order], budget)
        at = np.flatnonzero(root != np.arange(len(root)))
        a, b = fp[order][at], fp[order][root[at]]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0
        for batch in batches:
            if len(batch):
                held.append([batch[c].to_numpy(zero_copy_only=False) for c in ("path", "masked", "fp")])
                size += len(batch)
            if size >= 200_000:  # the last group may go on: keep it
                path, masked, fp = (np.concatenate(x) for x in zip(*held))
                last = np.flatnonzero((path != path[-1]) | (masked != masked[-1]))
                end = last[-1] + 1 if len(last) else 0
                if end:
                    yield close(path[:end], masked[:end], fp[:end])
                held, size = [[path[end:], masked[end:], fp[end:]]], len(path) - end
        if size:
            yield close(*(np.concatenate(x) for x in zip(*held)))
    return run


def _blocks(fixed: int, n: int) -> list[int]:
    """The bits not in ``fixed``, dealt in order into ``n`` masks of near equal size."""
    free = [b for b in range(63, -1, -1) if not fixed >> b & 1]
    cuts = [round(i * len(free) / n) for i in range(n + 1)]
    return [sum(1 << b for b in free[s:e]) for s, e in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def link_prints(prints: DataFrame, budget: int = 4, group: int = GROUP, depth: int = 3) -> DataFrame:
    """Edges (u > v) that connect all different prints of at most ``budget`` differing bits.

    Two such prints agree on all bits of one block in budget + 1, so each block
    in turn leads the trie: prints that agree on it are one sub-trie. A sub-trie
    of over ``group`` prints is cut again by blocks of its other bits, up to
    ``depth`` times; the task of a sub-trie then traverses its node pairs. Every
    sub-trie gives a spanning set of edges, never all pairs.
    """
    masks = {0: 0}
    members = prints.select(F.lit(0).alias("path"), F.lit(0).cast("long").alias("masked"), "fp")
    ready = None
    for level in range(depth):
        cut = {}
        for path, fixed in masks.items():
            cut[path] = [((path * (budget + 2)) + j + 1, fixed | m) for j, m in enumerate(_blocks(fixed, budget + 1)) if m]
        masks = {p: m for own in cut.values() for p, m in own}
        choice = F.lit(None).cast("array<struct<path:int,masked:bigint>>")
        for path, own in cut.items():
            to = F.array(*(F.struct(F.lit(p).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("masked"))
                           for p, m in own))
            choice = F.when(F.col("path") == path, to).otherwise(choice)
        members = stage(members.select("fp", F.explode(choice).alias("s")).select("s.path", "s.masked", "fp"))
        hot = members.groupBy("path", "masked").count().filter(F.col("count") > group).drop("count")
        if level == depth - 1:
            rest, hot = members, None
        else:
            hot = stage(hot)
            hot = None if hot.isEmpty() else hot
            rest = members if hot is None else members.join(hot, ["path", "masked"], "left_anti")
        ready = rest if ready is None else ready.unionByName(rest)
        if hot is None:
            break
        members = members.join(hot, ["path", "masked"], "left_semi")
        paths = {r["path"] for r in hot.select("path").distinct().collect()}  # at most (budget + 1) ** level
        masks = {p: m for p, m in masks.items() if p in paths}
    return (ready.repartition("path", "masked").sortWithinPartitions("path", "masked")
            .mapInArrow(_links(budget), "u long, v long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (u > v): the label is the least node of its component.

    Large-star and small-star in turn until the edges are stars. Each turn ends
    in a table in the shared folder; only its row count and a checksum go to the
    driver.
    """
    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = stage(edges)
    now = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.filter("v > u").join(least, "u").filter("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stage(large)
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
                 .unionByName(down.select("u", F.col("m").alias("v"))).distinct())
        edges = stage(small)
        before, now = now, state(edges)
        if before == now:
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))


def near_duplicates(docs: DataFrame, words: int = 4, budget: int = 4, seed: int = 42, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document row: doc_id, ``keep``, fp (signed long), component_id, component.

    component_id is the smallest doc_id reachable over fingerprints that differ
    in ``budget`` bits or fewer. Null and empty texts have fingerprint 0 and link
    like any other; equal fingerprints are one node, however many rows have it;
    null ids never name a component (its id is null if it has no other). Ids that
    repeat may name two components; ``component``, a fingerprint in it, tells all
    apart. An empty table gives an empty result.
    """
    signed = stage(fingerprints(docs, words, seed, keep))
    nodes = stage(signed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(link_prints(nodes.select("fp"), budget))
    named = stage(nodes.join(labels, nodes["fp"] == labels["node"], "left")
                  .select("fp", "least", F.coalesce("label", "fp").alias("label")))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    found = named.join(names, "label").select("fp", "component_id", F.col("label").alias("component"))
    return signed.join(found, "fp").select("doc_id", *keep, "fp", "component_id", "component")
