"""Best-fit packing: a configuration linear program over the length histogram."""

from __future__ import annotations

import base64
import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.bpe import NEAR
from pluvio.llm.common import running, spread, stage, text_bytes

CAPACITY, END = 2048, 0
#: Rounds of multiplicative weights, their rate, the part of what a configuration's lengths have left that
#: a round takes, and the power of a length that is its first price.
ROUNDS, RATE, STEP, LONGER = 40, 4.0, 0.5, 1.02


#: Runs of white space from which the fast coder's split pattern may exhaust its stack; such texts go to the library.
LONG_RUN = 10_000


class Encoder:
    """Ids by the tokenizers file. Texts on which the rank file of the same vocabulary provably gives the same ids go to the
    faster tiktoken: those without an added token of the file, without characters from NEAR on (where the two libraries'
    tables of letters may differ), and without a run of LONG_RUN white-space characters."""

    def __init__(self, tokenizer_file: str, ranks_file: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer
        with open(ranks_file, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(tokenizer_file)
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(tokenizer_file, encoding="utf-8") as file:
            added = [re.escape(t["content"]) for t in json.load(file)["added_tokens"]]
        self.odd = re.compile("|".join([*added, f"[^\\x00-{chr(NEAR - 1)}]", f"\\s{{{LONG_RUN}}}"]))

    def encode(self, text: str) -> list[int]:
        if self.odd.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str, ranks_file: str, pattern: str) -> Encoder:
    return Encoder(tokenizer_file, ranks_file, pattern)


def _pieces(capacity: int, files: tuple[str, str, str], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(*files)
        for batch in batches:
            rows: list[tuple] = []
            source: list[int] = []
            for at, text in enumerate(batch["text"]):
                ids = np.array([*coder.encode(text.as_py()), END], "<u4")
                head = len(ids) % capacity or capacity
                starts = [0, *range(head, len(ids), capacity)]
                for piece, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    own = ids[s:e]
                    rows.append((piece, s, e - s, zlib.crc32(own.tobytes()), own.tolist() if with_ids else None))
                source += [at] * len(starts)
            cols = list(zip(*rows)) if rows else [[]] * 5
            arrays = [batch["doc_id"].take(pa.array(source, pa.int64())), pa.array(cols[0], pa.int32())]
            arrays += [pa.array(c, pa.int64()) for c in cols[1:4]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(cols[4], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
    return run


def pieces(docs: DataFrame, tokenizer_file: str, ranks_file: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every row.

    A text's ids and END; only what is longer than ``capacity`` is cut, the rest
    of the division first. A null text is empty and has END alone.
    """
    rows = spread(docs.select("doc_id", text_bytes(docs).cast("string").alias("text")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_pieces(capacity, (tokenizer_file, ranks_file, pattern), with_ids),
                           f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def knapsack(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per room: the most value that lengths fill it with, and one length to begin with (0: leave a place free).

    value[l] is a length's worth, 0 where none is wanted; dynamic programming over the room.
    """
    best, pick = np.zeros(len(value)), np.zeros(len(value), np.int64)
    lengths = np.flatnonzero(value > 0)
    worth = value[lengths]
    for room in range(1, len(value)):
        n = bisect_right(lengths, room)
        best[room] = best[room - 1]
        if n:
            got = best[room - lengths[:n]] + worth[:n]
            k = int(got.argmax())
            if got[k] > best[room]:
                best[room], pick[room] = got[k], lengths[k]
    return best, pick


def fill(pick: np.ndarray, room: int, config: dict[int, int]) -> dict[int, int]:
    """Fill a configuration's room by the knapsack's picks: {length: times}."""
    while room > 0:
        x = int(pick[room])
        if x:
            config[x] = config.get(x, 0) + 1
        room -= x or 1
    return config


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Configurations ({length: times}, sequences) that hold all pieces of the histogram, few sequences in all.

    Multiplicative weights on the covering program: a length's price is its size
    (to a power a little over 1, so that of equal fillings the one of longer
    pieces comes first) times a factor that rises where less of it is covered
    than on average. A round solves the knapsack for its prices once and takes,
    for each length from the longest, a part of the best configuration that holds
    it. Rounded down, these leave few pieces of each length; those are filled in
    from the longest, each next one the longest that fits, and such a filling is
    repeated as often as its lengths last. The work depends on the number of
    different lengths, at most ``capacity``, not on the number of pieces.
    """
    have = np.zeros(capacity + 1)
    for length, n in histogram.items():
        have[length] = n
    full = int(have[capacity])
    have[capacity] = 0
    left, sizes = have.copy(), (np.arange(capacity + 1) / capacity) ** LONGER
    solution: dict[tuple, float] = {}
    for _ in range(rounds):
        wanted = left >= 1
        if not wanted.any():
            break
        covered = 1 - left[wanted] / have[wanted]
        value = np.zeros(capacity + 1)
        value[wanted] = sizes[wanted] * np.exp(RATE * (covered.mean() - covered))
        _, pick = knapsack(value)
        for x in np.flatnonzero(wanted)[::-1].tolist():
            config = fill(pick, capacity - x, {x: 1})
            share = STEP * min(left[y] / n for y, n in config.items())
            if share >= 1:
                for y, n in config.items():
                    left[y] -= n * share
                key = tuple(sorted(config.items(), reverse=True))
                solution[key] = solution.get(key, 0.0) + share
    found = [(dict(k), int(v)) for k, v in solution.items()]
    rest = {int(x): int(have[x]) for x in np.flatnonzero(have)}
    for config, times in found:
        for x, n in config.items():
            rest[x] -= n * times
    lengths = sorted(x for x, n in rest.items() if n)
    while lengths:
        room, config = capacity, {}
        while k := bisect_right(lengths, room):
            while k and config.get(lengths[k - 1], 0) >= rest[lengths[k - 1]]:
                k -= 1
            if not k:
                break
            x = lengths[k - 1]
            n = min(room // x, rest[x] - config.get(x, 0))
            config[x] = config.get(x, 0) + n
            room -= n * x
        times = min(rest[x] // n for x, n in config.items())
        found.append((config, times))
        for x, n in config.items():
            rest[x] -= n * times
        lengths = [x for x in lengths if rest[x]]
    return found + ([({capacity: 1}, full)] if full else [])


def places(solution: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: rank where each run of equal places begins, its first sequence, its offset.

    The run's i-th piece goes to the i-th sequence from its first.
    """
    runs: dict[int, list] = {}
    ranks: dict[int, int] = {}
    first = 0
    for config, times in solution:
        offset = 0
        for length, n in sorted(config.items(), reverse=True):
            for _ in range(n):
                runs.setdefault(length, []).append((ranks.get(length, 0), first, offset))
                ranks[length] = ranks.get(length, 0) + times
                offset += length
        first += times
    return {length: tuple(np.array(x, np.int64) for x in zip(*own)) for length, own in runs.items()}


def _place(where: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for x in np.unique(length):
                own = length == x
                starts, first, at = where[int(x)]
                k = np.searchsorted(starts, rank[own], side="right") - 1
                sequence[own] = first[k] + rank[own] - starts[k]
                offset[own] = at[k]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(sequence), pa.array(offset)],
                                             [*names, "sequence_id", "offset"])
    return run


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to staged ``pieces``: gapless places in few sequences of at most ``capacity``.

    The histogram (at most ``capacity`` rows) is all that reaches the driver. The
    solution sent to the tasks has a bound by capacity and ROUNDS. Pieces of a
    length, however many, are ranked by hash in many tasks. Repeated rows are
    pieces of their own; an empty table gives an empty result.
    """
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    solution = solve(histogram, capacity)
    ranked = running(cut.withColumn("one", F.lit(1).cast("long")), ["length"], F.xxhash64("doc_id", "piece", "ids_crc32"),
                     ["doc_id", "piece", "ids_crc32"], "one", "rank").select(*cut.columns, "rank")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(_place(places(solution)), f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces that carry ids: the packed sequences themselves."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_file: str, ranks_file: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` of all rows, packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stage(pieces(docs, tokenizer_file, ranks_file, pattern, capacity)), capacity)
