"""Target-distribution importance resampling over hashed n-grams.

Per batch, n-grams are interned in an open-addressed table of numpy arrays: keys
are 64-bit hashes, a hit is verified byte by byte, and a slot stores its n-gram's
bucket and count. Each occurrence keeps its slot's number, so a bucket is hashed
once per different n-gram and an occurrence's gain is two gathers away.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pluvio.llm.common import numbered, stage, text_bytes
from pluvio.llm.words import split_words, word_table

#: Longest n-gram in words, buckets, gain of a factor e, words of a document that may be drawn, per cent drawn, seed of the draw.
GRAMS, BUCKETS, SCALE, LEAST_WORDS, PERCENT, SEED = 2, 10_000, 1000, 20, 25, 7
#: Words that are interned together; n-grams up to this many bytes are verified eight bytes at a time, longer ones one by one.
CHUNK, LANES_BYTES = 50_000, 64
_TABLE = word_table(digits=True)


class GramTable:
    """The n-grams of a chunk of words, interned: ``slot`` per occurrence; ``owner`` (-1: free), ``key``, ``bucket`` and ``count`` per slot."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray, buckets: int = BUCKETS, hashed=xxh64_intdigest, first: Sequence[bytes] = ()):
        """``first``: the bytes of the first occurrences, where the caller has them."""
        self.data, self.starts, self.sizes = data, starts, ends - starts
        padded = np.frombuffer(data + b"\0" * 8, np.uint8)
        self.lanes = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (max(1, len(padded) - 7),), (1,))
        spans = [*first, *[data[s:e] for s, e in zip(starts[len(first):].tolist(), ends[len(first):].tolist())]]
        self.hashes = np.fromiter(map(hashed, spans), np.uint64, len(spans))
        room = 1 << max(4, (2 * len(spans)).bit_length())
        self.owner = np.full(room, -1, np.int64)
        self.slot = self._probe(room - 1)
        self.used = np.flatnonzero(self.owner >= 0)
        self.key, self.bucket = np.zeros(room, np.uint64), np.zeros(room, np.int64)
        self.key[self.used] = self.hashes[self.owner[self.used]]
        owners = np.sort(self.owner[self.used])  # in the order in which their bytes lie
        self.bucket[self.slot[owners]] = np.fromiter(map(zlib.crc32, map(spans.__getitem__, owners.tolist())), np.int64, len(owners)) % buckets
        self.count = np.bincount(self.slot, minlength=room)

    def _probe(self, mask: int) -> np.ndarray:
        """Linear probing, all occurrences a step at a time: the first to reach a free slot owns it, equals of its owner stay, others go on."""
        slot = (self.hashes & np.uint64(mask)).astype(np.int64)
        live = np.arange(len(slot))
        while len(live):
            at = slot[live]
            free = self.owner[at] < 0
            # of those that reach one slot together the last in this order, the first occurrence, stays written
            self.owner[at[free][::-1]] = live[free][::-1]
            owner = self.owner[at]
            same = self.hashes[owner] == self.hashes[live]
            check = np.flatnonzero(same & (owner != live))
            same[check] = self._equal(owner[check], live[check])
            live = live[~same]
            slot[live] = (slot[live] + 1) & mask
        return slot

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of occurrences a[i] and b[i] are the same."""
        same = self.sizes[a] == self.sizes[b]
        live, at = np.flatnonzero(same & (self.sizes[a] <= LANES_BYTES)), 0
        while len(live):
            left = self.sizes[a[live]] - at
            differ = self.lanes[self.starts[a[live]] + at] ^ self.lanes[self.starts[b[live]] + at]
            differ &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * np.maximum(8 - left, 0)).astype(np.uint64)
            same[live[differ != 0]] = False
            live = live[(differ == 0) & (left > 8)]
            at += 8
        for i in np.flatnonzero(same & (self.sizes[a] > LANES_BYTES)).tolist():
            (s, t), n = (self.starts[a[i]], self.starts[b[i]]), self.sizes[a[i]]
            same[i] = self.data[s:s + n] == self.data[t:t + n]
        return same


class Chunk:
    """Words of some texts with the n-grams that end in them: ``table``, and the text's number ``of`` each occurrence."""

    def __init__(self, words: list[bytes], of: np.ndarray, context: int, grams: int = GRAMS, buckets: int = BUCKETS):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + 1) - sizes - 1
        ends, last = starts + sizes, np.arange(context, len(words))
        begin, end, own = [], [], []
        for n in range(1, grams + 1):
            at = last[last >= n - 1]
            at = at[of[at - n + 1] == of[at]]
            begin.append(starts[at - n + 1]), end.append(ends[at]), own.append(of[at])
        self.of = np.concatenate(own)
        self.table = GramTable(b" ".join(words), np.concatenate(begin), np.concatenate(end), buckets, first=words[context:])


def chunks(texts: Iterator[bytes], grams: int = GRAMS, buckets: int = BUCKETS, size: int = CHUNK) -> Iterator[tuple[Chunk, np.ndarray]]:
    """All words of all texts in chunks, and the number of the text that each new word is of.

    A chunk's first words may be the last ones of the chunk before, so that no
    n-gram is lost between two; they count there alone.
    """
    words: list[bytes] = []
    of: list[int] = []
    context = 0
    for n, text in enumerate(texts):
        for part in split_words(text, _TABLE):
            for at in range(0, len(part), size):
                new = part[at:at + size]
                words += new
                of += [n] * len(new)
                if len(words) >= size:
                    number = np.array(of, np.int64)
                    yield Chunk(words, number, context, grams, buckets), number[context:]
                    context = min(grams - 1, len(words))
                    words, of = words[len(words) - context:], of[len(of) - context:]
    if len(words) > context:
        number = np.array(of, np.int64)
        yield Chunk(words, number, context, grams, buckets), number[context:]


def _bucket_counts(grams: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for chunk, _ in chunks((x.as_py() for x in batch["text"]), grams, buckets):
                table = chunk.table
                np.add.at(total, table.bucket[table.used], table.count[table.used])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket; a task passes on at most ``buckets`` rows."""
    counted = texts.select(text_bytes(texts).alias("text")).mapInArrow(_bucket_counts(grams, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(corpus: Sequence[int], target: Sequence[int], scale: int = SCALE) -> list[int]:
    """Per bucket: floor(scale * ln of the target's smoothed share over the corpus's), in doubles."""
    n, all_corpus, all_target = len(corpus), int(sum(corpus)), int(sum(target))
    return [math.floor(scale * math.log(float((int(t) + 1) * (all_corpus + n)) / float((int(s) + 1) * (all_target + n)))) for s, t in zip(corpus, target)]


def gumbel(doc_id: int | None, seed: int = SEED, scale: int = SCALE) -> int:
    """The document's draw: floor(-scale * ln(-ln(u))), u from the first 8 hex digits of sha256(seed:doc_id); a null id is empty."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gains: list[int], grams: int, seed: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.array(gains, np.int64)
        for batch in batches:
            rows = len(batch)
            n_words, n_features, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for chunk, new in chunks((x.as_py() for x in batch["text"]), grams, len(gains)):
                np.add.at(n_words, new, 1)
                np.add.at(n_features, chunk.of, 1)
                of_slot = gain[chunk.table.bucket]
                np.add.at(total, chunk.of, of_slot[chunk.table.slot])
            weight = total // np.maximum(n_features, 1)
            score = weight + np.array([gumbel(x, seed, scale) for x in batch["doc_id"].to_pylist()], np.int64)
            made = [pa.array(x, pa.int64()) for x in (n_words, n_features, weight, score)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *made], ["doc_id", "n_words", "n_features", "weight", "score"])
    return run


def score_documents(docs: DataFrame, gains: list[int], grams: int = GRAMS, seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain; 0 without n-grams) and score (weight and draw) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes(docs).alias("text")).mapInArrow(
        _score(gains, grams, seed, scale), f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, grams: int = GRAMS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank: draw the documents whose n-grams look like the target's.

    Of the rows with ``least_words`` words, floor(percent * rows / 100) of the
    highest scores have a rank from 1, ties by the smaller doc_id (null last;
    equal rows in any order); all others have null. Null texts have no words, an
    empty target has no n-grams, an empty table gives no rows; other columns take
    no part. The driver holds one number per bucket; ranks come from a sort in many tasks.
    """
    gains = bucket_gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
    scored = stage(score_documents(docs, gains, grams, seed))
    able = scored.filter(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    placed = numbered(able, [F.desc("score"), F.col("doc_id").asc_nulls_last()], "_place")
    ranked = placed.withColumn("rank", F.when(F.col("_place") < drawn, F.col("_place") + 1)).drop("_place")
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)
