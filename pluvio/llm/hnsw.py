"""Approximate nearest neighbours: a navigable small-world graph per shard, results merged."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import stage

#: Vectors in a shard, links of a node (twice as many on the lowest level), candidates for a node's links,
#: length of the list kept in a search, and queries searched together.
SHARD, LINKS, CANDIDATES, BEAM, TOGETHER = 8192, 16, 64, 96, 256


def usable(vector: Column) -> Column:
    """Not null or empty, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _levels(n: int) -> np.ndarray:
    """The highest level of each node: geometric, from a hash of its place, so that a rebuilt shard is the same."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    return np.floor(-np.log((x >> np.uint64(11)).astype(float) / 2**53 + 2**-54) / np.log(LINKS)).astype(int)


def _linked(unit: np.ndarray, links: int) -> np.ndarray:
    """(n, 2 * links) neighbour places, -1 where there are fewer.

    A node's candidates are its nearest on this level; it links to a candidate
    that is nearer to it than to any chosen before, then to the nearest of the
    others. Links run both ways as far as there is room.
    """
    n = len(unit)
    chosen = np.full((n, links), -1, np.int32)
    wide = min(CANDIDATES, n - 1)
    for s in range(0, n, 512):
        block = unit[s:s + 512]
        near = block @ unit.T
        near[np.arange(len(block)), np.arange(s, s + len(block))] = -np.inf
        cand = np.argpartition(-near, wide - 1, axis=1)[:, :wide]
        sim = np.take_along_axis(near, cand, 1)
        order = np.argsort(-sim, axis=1, kind="stable")
        cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
        among = np.einsum("bcd,bed->bce", unit[cand], unit[cand], optimize=True)
        kept = np.zeros(cand.shape, bool)
        kept[:, 0] = True
        for t in range(1, wide):
            closest = np.where(kept[:, :t], among[:, t, :t], -np.inf).max(1)
            kept[:, t] = (closest < sim[:, t]) & (kept[:, :t].sum(1) < links)
        first = np.argsort(~kept, axis=1, kind="stable")[:, :links]
        own = np.take_along_axis(cand, first, 1)
        chosen[s:s + len(block), :own.shape[1]] = own
    src = np.repeat(np.arange(n), links)
    dst = chosen.ravel()
    src, dst, rank = src[dst >= 0], dst[dst >= 0], np.tile(np.arange(links), n)[dst >= 0]
    both = np.concatenate([np.stack([src, dst, rank]), np.stack([dst, src, rank + links])], 1)
    both = both[:, np.lexsort((both[2], both[1], both[0]))]
    both = both[:, np.concatenate(([True], (both[0, 1:] != both[0, :-1]) | (both[1, 1:] != both[1, :-1])))]
    both = both[:, np.lexsort((both[2], both[0]))]
    place = np.arange(both.shape[1]) - np.searchsorted(both[0], both[0])
    fits = place < 2 * links
    graph = np.full((n, 2 * links), -1, np.int32)
    graph[both[0, fits], place[fits]] = both[1, fits]
    return graph


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near 1: the cosine stays as it is to the last bit,
    and no square overflows or vanishes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


class Graph:
    """The vectors of a shard and, per level, its nodes and their flat neighbour array."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        vectors = _scaled(vectors)
        self.vectors, self.ids = vectors, ids  # ids: (n, k + 1), least first, -1 where a vector has fewer
        self.unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
        top = _levels(len(vectors))
        self.nodes, self.links = [], []
        for level in range(top.max() + 1):
            nodes = np.flatnonzero(top >= level)
            if level and len(nodes) < 2:
                break
            plain = _linked(self.unit[nodes], LINKS if level == 0 else LINKS // 2) if len(nodes) > 1 else np.full((1, 2), -1)
            self.nodes.append(nodes)
            self.links.append(np.where(plain < 0, -1, nodes[plain]))  # places in the shard

    def dump(self) -> bytes:
        out = io.BytesIO()
        arrays = {f"nodes{i}": x for i, x in enumerate(self.nodes)} | {f"links{i}": x.astype(np.int32) for i, x in enumerate(self.links)}
        np.savez(out, vectors=self.vectors, ids=self.ids, **arrays)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Graph:
        stored = np.load(io.BytesIO(data))
        graph = cls.__new__(cls)
        graph.vectors, graph.ids = stored["vectors"], stored["ids"]
        graph.unit = (graph.vectors / np.linalg.norm(graph.vectors, axis=1, keepdims=True)).astype(np.float32)
        count = sum(k.startswith("nodes") for k in stored)
        graph.nodes = [stored[f"nodes{i}"] for i in range(count)]
        graph.links = [stored[f"links{i}"] for i in range(count)]
        return graph

    def _beam(self, level: int, queries: np.ndarray, entry: np.ndarray, width: int) -> np.ndarray:
        """(q, width) nearest nodes found on a level from the entries (q, e), nearest first; -1 where fewer."""
        row = np.full(len(self.unit), -1, np.int64)
        row[self.nodes[level]] = np.arange(len(self.nodes[level]))
        links = self.links[level]
        q = len(queries)
        lines = np.arange(q)[:, None]
        seen = np.zeros((q, len(self.unit) + 1), bool)  # the last column stands for "none"
        seen[:, -1] = True
        seen[lines, entry] = True
        ids = entry
        sims = np.where(entry >= 0, np.einsum("qd,qed->qe", queries, self.unit[entry], optimize=True), -np.inf)
        done = entry < 0
        while True:
            open_sims = np.where(done, -np.inf, sims)
            pick = np.argsort(-open_sims, axis=1, kind="stable")[:, :4]
            live = np.take_along_axis(open_sims, pick, 1) > -np.inf
            if not live.any():
                break
            nodes = np.where(live, np.take_along_axis(ids, pick, 1), -1)
            done[lines, pick] = True
            near = np.where((nodes >= 0)[:, :, None], links[row[nodes]], -1).reshape(q, -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[lines, near]] = -1
            seen[lines, near] = True
            got = np.where(near >= 0, np.einsum("qd,qed->qe", queries, self.unit[near], optimize=True), -np.inf)
            ids, sims = np.concatenate([ids, near], 1), np.concatenate([sims, got], 1)
            done = np.concatenate([done, near < 0], 1)
            keep = np.argsort(-sims, axis=1, kind="stable")[:, :width]
            ids, sims, done = (np.take_along_axis(x, keep, 1) for x in (ids, sims, done))
        return np.where(sims > -np.inf, ids, -1)

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        """(query, id, score): up to k of each query, by cosine in double precision, ties to the smaller id."""
        queries = _scaled(queries)
        unit = (queries / np.linalg.norm(queries, axis=1, keepdims=True)).astype(np.float32)
        if len(self.unit) <= BEAM:
            found = np.tile(np.arange(len(self.unit)), (len(queries), 1))
        else:
            found = np.tile(self.nodes[-1][:BEAM], (len(queries), 1))
            for level in range(len(self.nodes) - 1, -1, -1):
                found = self._beam(level, unit, found, BEAM if level == 0 else 16)
        norms = np.sqrt((self.vectors * self.vectors).sum(1))
        rows = []
        for query, own, vector in zip(query_ids.tolist(), found, queries):
            own = own[own >= 0]
            score = (self.vectors[own] * vector).sum(1) / (norms[own] * np.sqrt((vector * vector).sum()))
            members = self.ids[own]
            pairs = [(-s, i) for s, ids in zip(score.tolist(), members.tolist()) for i in ids if i != query and i != NONE]
            rows += [(query, i, -s) for s, i in sorted(pairs)[:k]]
        return rows


#: Fills a vector's list of ids; no id that is stored equals it.
NONE = -(2**63)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["h1", "h2"], ignore_index=True)
    width = max(map(len, pdf["ids"]))
    ids = np.full((len(pdf), width), NONE, np.int64)
    for i, own in enumerate(pdf["ids"]):
        ids[i, :len(own)] = own
    made = Graph(np.stack([np.asarray(v, float) for v in pdf["vector"]]), ids)
    return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "shard": [pdf["shard"].iloc[0]], "graph": [made.dump()]})


def build_index(vectors: DataFrame, k: int = 5, shard_rows: int = SHARD) -> DataFrame:
    """(dim, shard, graph) over every usable row of (vec_id, embedding); staged.

    Equal vectors are one node, which keeps its k + 1 least ids: no search of k
    can return more of them. A row's shard follows from a hash of the vector;
    vectors of one length are searched together.
    """
    rows = (vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"),
                    F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")))
    least = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    ids = rows.distinct().withColumn("n", least).filter(F.col("n") <= k + 1)
    nodes = stage(ids.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector"))
                  .withColumn("dim", F.size("vector")))
    shards = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = nodes.join(F.broadcast(shards), "dim").withColumn("shard", F.pmod(F.xxhash64("h1", "h2"), F.col("shards")).cast("int"))
    return stage(dealt.select("dim", "shard", "h1", "h2", "ids", "vector").groupBy("dim", "shard")
                 .applyInPandas(_build, "dim int, shard int, graph binary"))


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, key = None, None
        for batch in batches:
            query, vector = batch["query_id"], batch["vector"]
            dim, shard = batch["dim"].to_pylist(), batch["shard"].to_pylist()
            heads = np.flatnonzero(np.asarray(query.is_null())).tolist()
            cuts = sorted({0, *heads, *(h + 1 for h in heads), len(batch)})
            for s, e in zip(cuts, cuts[1:]):
                if not query[s].is_valid:
                    graph, key = Graph.load(batch["graph"][s].as_py()), (dim[s], shard[s])
                    continue
                assert key == (dim[s], shard[s]) == (dim[e - 1], shard[e - 1])
                for at in range(s, e, TOGETHER):
                    own = slice(at, min(at + TOGETHER, e))
                    vectors = np.stack([np.frombuffer(v.as_py(), "<f8") for v in vector[own]])
                    rows = graph.search(vectors, query[own].to_numpy(), k)
                    cols = list(zip(*rows)) if rows else [[], [], []]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
                                                     ["query_id", "vec_id", "score"])
    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [np.asarray(v.as_py(), "<f8").tobytes() for v in batch["embedding"]]
        yield pa.RecordBatch.from_arrays([batch["query_id"], batch["dim"], pa.array(data, pa.binary())], ["query_id", "dim", "vector"])


def search_index(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row (vec_id, embedding), itself left out.

    Queries go to all shards of their length and pass by the shard's graph in
    blocks; a shard returns k rows of a query and these are merged. Queries that
    aren't usable have no rows; of rows that repeat, one is searched.
    """
    asked = stage(queries.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
                  .select(F.col("vec_id").cast("long").alias("query_id"), F.size("embedding").alias("dim"),
                          F.col("embedding").cast("array<double>").alias("embedding")).distinct()
                  .mapInArrow(_packed, "query_id long, dim int, vector binary"))
    per_dim = index.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    sent = asked.join(F.broadcast(per_dim), "dim").select("dim", F.explode("shards").alias("shard"), "query_id", "vector", F.lit(None).cast("binary").alias("graph"))
    both = index.select("dim", "shard", F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("binary").alias("vector"), "graph").unionByName(sent)
    found = (both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", F.col("query_id").asc_nulls_first())
             .mapInArrow(_search(k), "query_id long, vec_id long, score double"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD) -> DataFrame:
    """``search_index`` of ``queries`` over an index of ``vectors``; an empty table gives an empty result."""
    return search_index(build_index(vectors, k, shard_rows), queries, k)
