"""Reversible line dedup: exact reference counts behind sharded cuckoo filters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import stage, text_bytes

#: Keys that one filter shard holds at most on average, bytes of filters that may be broadcast, and lines that meet one copy of a filter.
SHARD_KEYS, BROADCAST_BYTES, LINES_PART = 32_768, 32 << 20, 2_000_000


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; keys are 16-byte digests. Full tables double."""

    SLOTS, KICKS = 4, 500

    def __init__(self, buckets: int = SHARD_KEYS // 2, table: bytes | None = None):
        cells = np.zeros(buckets * self.SLOTS, np.uint16) if table is None else np.frombuffer(table, np.uint16).copy()
        self.table = cells.reshape(-1, self.SLOTS)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """keys: (n, 2) uint64. Fingerprints and both buckets of each."""
        mask = np.uint64(len(self.table) - 1)
        mark = (keys[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (keys[:, 1] >> np.uint64(16)) & mask
        return mark, first.astype(np.int64), self._other(first, mark)

    def _other(self, bucket, mark):
        step = (np.uint64(mark) if np.isscalar(mark) else mark.astype(np.uint64)) * np.uint64(0x5BD1E995)
        return (np.uint64(bucket) ^ step & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, a, b = self._places(keys)
        return ((self.table[a] == mark[:, None]) | (self.table[b] == mark[:, None])).any(1)

    def delete(self, keys: np.ndarray) -> None:
        """Remove one fingerprint of each key; only keys that were inserted may be given."""
        for mark, a, b in zip(*self._places(keys)):
            for bucket in (a, b):
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break

    def insert(self, keys: np.ndarray) -> bool:
        """False if a fingerprint found no place: build a larger filter then."""
        turn = 0
        for mark, a, b in zip(*self._places(keys)):
            for bucket in (a, b):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = mark
                    break
            else:
                bucket = a
                for _ in range(self.KICKS):
                    turn = (turn + 1) % self.SLOTS
                    mark, self.table[bucket, turn] = self.table[bucket, turn], mark
                    bucket = int(self._other(np.uint64(bucket), np.uint16(mark)))
                    free = np.flatnonzero(self.table[bucket] == 0)
                    if len(free):
                        self.table[bucket, free[0]] = mark
                        break
                else:
                    return False
        return True

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        buckets = SHARD_KEYS // 2
        while not (made := cls(buckets)).insert(keys):
            buckets *= 2
        return made


def pairs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased (bytes methods touch ASCII only)."""
    return line.strip(b" \t\n\x0b\f\r").lower()


def _digests(text: bytes) -> set[bytes]:
    return {xxhash.xxh3_128_digest(k) for k in map(line_key, set(text.split(b"\n"))) if k}


LINES = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("h", pa.binary())])


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d1, d2, h = [], [], []
        for a, b, text in zip(batch["d1"].to_pylist(), batch["d2"].to_pylist(), batch["text"]):
            own = _digests(text.as_py())
            d1 += [a] * len(own)
            d2 += [b] * len(own)
            h += own
            if len(h) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((d1, d2, h), LINES.types)], schema=LINES)
                d1, d2, h = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((d1, d2, h), LINES.types)], schema=LINES)


def _key(docs: DataFrame) -> list:
    """What names a document's text: its id and hash. Rows that agree lose the same lines."""
    text = F.coalesce(docs["text"], F.lit(""))
    return [F.coalesce(docs["doc_id"], F.lit(0)).cast("long").alias("d1"), F.xxhash64(text).alias("d2")]


def document_lines(docs: DataFrame) -> DataFrame:
    """(d1, d2, h): the digest of each different line key of each document row."""
    return docs.select(*_key(docs), text_bytes(docs).alias("text")).mapInArrow(_explode, "d1 long, d2 long, h binary")


def count_lines(lines: DataFrame) -> DataFrame:
    """The exact reference-count table: h, n_docs."""
    return lines.groupBy("h").agg(F.count("*").alias("n_docs"))


def update_counts(counts: DataFrame, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """The table after documents came or went (their ``document_lines``); counts of 0 leave it."""
    parts = counts.select("h", "n_docs")
    for lines, sign in ((added, 1), (removed, -1)):
        if lines is not None:
            parts = parts.unionByName(count_lines(lines).select("h", (F.col("n_docs") * sign).alias("n_docs")))
    return parts.groupBy("h").agg(F.sum("n_docs").alias("n_docs")).filter("n_docs > 0")


def _shard(n_shards: int):
    return F.pmod(F.xxhash64("h"), F.lit(n_shards)).cast("int")


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    made = CuckooFilter.of(pairs(sorted(pdf["h"])))
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "filter": [made.table.tobytes()]})


def build_filters(repeated: DataFrame) -> tuple[DataFrame, int]:
    """(shard, filter) over the digests of ``repeated``, and the number of shards."""
    n_shards = max(1, -(-repeated.count() // SHARD_KEYS))
    keyed = repeated.select("h", _shard(n_shards).alias("shard"))
    return keyed.groupBy("shard").applyInPandas(_build, "shard int, filter binary"), n_shards


def update_filters(filters: DataFrame, n_shards: int, entered: DataFrame, left: DataFrame) -> DataFrame:
    """Filters after the digests of ``entered`` became repeated and those of ``left`` no longer are.

    A shard whose inserts no longer fit must be built anew from the counts: its
    filter comes back null.
    """
    def change(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        shard = (old if len(old) else new)["shard"].iloc[0]
        table = CuckooFilter(table=old["filter"].iloc[0]) if len(old) else CuckooFilter()
        gone, come = new["h"][new["gone"]].tolist(), new["h"][~new["gone"]].tolist()
        if gone:
            table.delete(pairs(gone))
        fits = not come or table.insert(pairs(come))
        return pd.DataFrame({"shard": [shard], "filter": [table.table.tobytes() if fits else None]})

    moved = entered.select("h", F.lit(False).alias("gone")).unionByName(left.select("h", F.lit(True).alias("gone")))
    return (filters.groupBy("shard").cogroup(moved.withColumn("shard", _shard(n_shards)).groupBy("shard"))
            .applyInPandas(change, "shard int, filter binary"))


def _probe(tables: dict[int, bytes]) -> Callable:
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {s: CuckooFilter(table=t) for s, t in tables.items()}
        for batch in batches:
            if not len(batch):
                continue
            keys, shard = pairs(batch["h"].to_pylist()), batch["shard"].to_numpy()
            hit = np.zeros(len(keys), bool)
            for s, table in filters.items():
                own = shard == s
                hit[own] = table.contains(keys[own])
            yield batch.filter(pa.array(hit))
    return probe


def _probe_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, its filter's row (without h) ahead of its lines: one filter is held at a time."""
    table, own = None, None
    for batch in batches:
        shards = batch["shard"].to_numpy()
        heads = np.flatnonzero(np.asarray(batch["h"].is_null())).tolist()
        changes = (np.flatnonzero(np.diff(shards)) + 1).tolist()
        cuts = sorted({0, *heads, *(k + 1 for k in heads), *changes, len(batch)})
        for s, e in zip(cuts, cuts[1:]):
            if not batch["h"][s].is_valid:
                table, own = CuckooFilter(table=batch["filter"][s].as_py()), shards[s]
            elif own == shards[s]:  # a shard without a filter has no repeated line
                part = batch.slice(s, e - s)
                hit = table.contains(pairs(part["h"].to_pylist()))
                yield pa.RecordBatch.from_arrays([part["d1"], part["d2"], part["h"]], schema=LINES).filter(pa.array(hit))


def probe_shards(lines: DataFrame, filters: DataFrame, n_shards: int) -> DataFrame:
    """The ``lines`` whose digest its shard's filter may hold, each shard's lines beside its filter.

    Lines are counted by shard first: one of more than LINES_PART is dealt to as
    many parts as it asks for, each with a copy of the filter, so a hot line
    gathers nowhere. No task holds more than one filter, however many there are.
    """
    keyed = lines.withColumn("shard", _shard(n_shards))
    parts = stage(keyed.groupBy("shard").agg(F.ceil(F.count("*") / LINES_PART).cast("int").alias("parts")))
    hot = F.broadcast(parts.filter("parts > 1"))  # at most lines / LINES_PART rows
    part = F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = keyed.join(hot, "shard", "left").select("shard", part.alias("part"), "d1", "d2", "h", F.lit(None).cast("binary").alias("filter"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    none = [F.lit(None).cast(kind).alias(n) for n, kind in (("d1", "long"), ("d2", "long"), ("h", "binary"))]
    beside = filters.join(hot, "shard", "left").select("shard", copies.alias("part"), *none, "filter")
    return (dealt.unionByName(beside).repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("h").isNotNull())
            .mapInArrow(_probe_shards, "d1 long, d2 long, h binary"))


def repeated_lines(lines: DataFrame, counts: DataFrame, min_docs: int) -> DataFrame:
    """(d1, d2, drop): the digests that each document loses; ``lines`` and ``counts`` staged.

    The filters leave few lines for the exact join: within BROADCAST_BYTES they go
    to every task, beyond that lines go to their shard's filter. The result is the same.
    """
    repeated = stage(counts.filter(F.col("n_docs") >= min_docs))
    filters, n_shards = build_filters(repeated)
    filters = stage(filters)
    if (filters.agg(F.sum(F.length("filter"))).first()[0] or 0) <= BROADCAST_BYTES:
        tables = {r["shard"]: bytes(r["filter"]) for r in filters.collect()}
        lines = (lines.withColumn("shard", _shard(n_shards))
                 .mapInArrow(_probe(tables), "d1 long, d2 long, h binary, shard int").drop("shard"))
    else:
        lines = probe_shards(lines, filters, n_shards)
    return lines.join(repeated.select("h"), "h").groupBy("d1", "d2").agg(F.collect_set("h").alias("drop"))


def _apply(names: list[str], digest: bool) -> Callable:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, drop in zip(batch["_bytes"], batch["drop"]):
                text, drop = text.as_py(), drop.as_py()
                lines = text.split(b"\n")
                if drop:
                    gone = set(drop)
                    left = [x for x in lines if xxhash.xxh3_128_digest(line_key(x)) not in gone]
                else:
                    left = lines
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                kept.append(hashlib.sha256(b"\n".join(left)).hexdigest() if digest else b"\n".join(left).decode())
            out = [batch[n] for n in names]
            out += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(out, [*names, "n_lines", "n_dropped", "kept"])
    return apply


def dedup_lines(docs: DataFrame, min_docs: int = 10, digest: bool = False) -> DataFrame:
    """Every document with the lines dropped whose key stands in ``min_docs`` documents or more.

    Adds n_lines, n_dropped and kept: the text that stays, or with ``digest``
    its SHA-256 (then only doc_id comes along). A document is a row: repeated
    rows count each. A null text is one empty line; keys of no characters are
    never dropped; n_lines, n_dropped and kept of the input are replaced.
    """
    if digest:
        docs = docs.select("doc_id", "text")
    docs = docs.drop("n_lines", "n_dropped", "kept", "drop", "_bytes", "d1", "d2")
    lines = stage(document_lines(docs))
    drops = repeated_lines(lines, stage(count_lines(lines)), min_docs)
    names = ["doc_id"] if digest else docs.columns
    rows = docs.select(*([docs["doc_id"]] if digest else [docs[n] for n in names]), text_bytes(docs).alias("_bytes"), *_key(docs))
    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return (rows.join(drops, ["d1", "d2"], "left").drop("d1", "d2")
            .mapInArrow(_apply(names, digest), f"{fields}, n_lines long, n_dropped long, kept string"))
