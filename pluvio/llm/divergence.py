"""Source divergence audit: how far the word shares of a language's sources lie apart, and by which words.

Words are counted per (language, source); a language's kept words are numbered,
and each group's (number, count) pairs become sorted arrays, one per block of
numbers. Tasks co-group the arrays of two sides and merge each unordered pair of
groups once: shared words are found by galloping search, words of one side alone
and words of neither are priced by their number, and the sum counts both ways.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import join_groups, numbered, stage, text_bytes
from pluvio.llm.words import split_words, word_table

#: Documents of a language that a kept word is in at least, the unit of shares, what is added to each count, ranks of the report.
LEAST, UNIT, PRIOR, RANKS = 30, 1_000_000_000, 5, 50
#: Numbers of a block of words (2 ** BLOCK_BITS), groups on a side of a task (on average), words a counting task holds.
BLOCK_BITS, SIDE, HELD = 16, 16, 300_000
_TABLE = word_table(digits=False)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in found.items():
            # the row without a word tells of the group
            terms, k = [None, *n], len(n) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(terms, pa.binary()),
                 pa.array([0, *n.values()], pa.int64()), pa.array([0, *(d[t] for t in n)], pa.int64())],
                ["lang", "source", "term", "n", "d"])
        found.clear()

    for batch in batches:
        for text, lang, source in zip(batch["text"], batch["lang"].to_pylist(), batch["source"].to_pylist()):
            n, d = found.setdefault((lang, source), (Counter(), Counter()))
            own: set[bytes] = set()
            before = len(n)
            for words in split_words(text.as_py(), _TABLE):
                n.update(words)
                own.update(words)
            d.update(own)
            held += len(n) - before + 1
            if held > HELD:
                yield from out()
                held = 0
    yield from out()


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents of each word in each group; a null term per group as well.

    Nulls are ''. Tasks pass on their counts, so a word makes one row per task and group before the shuffle.
    """
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    counted = docs.select(text_bytes(docs).alias("text"), *named).mapInArrow(_count, "lang string, source string, term binary, n long, d long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def price(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * terms)), exact: the division goes three digits at a time."""
    if not terms:
        return np.zeros(len(count), np.int64)
    rest, below, share = np.asarray(count, np.int64) + PRIOR, total + PRIOR * terms, 0
    digits = UNIT
    while digits > 1:
        rest = rest * 1000
        share, rest, digits = share * 1000 + rest // below, rest % below, digits // 1000
    return 1 + share


def priced(count: str, total: str, terms: str) -> Column:
    """``price`` as an expression."""
    return F.expr(f"1 + (cast(cast({UNIT} as decimal(10,0)) * cast({count} + {PRIOR} as decimal(20,0)) as decimal(38,0))"
                  f" div cast({total} + {PRIOR} * {terms} as decimal(20,0)))")


def gallop(few: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``few`` and ``many`` (both sorted, no repeats) of the numbers that both hold.

    Each number of ``few`` starts where one of every 16 before it was found and
    doubles its steps until it has passed its value; the last step is then halved.
    All numbers take their steps together.
    """
    if not len(few) or not len(many):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.repeat(np.searchsorted(many, few[::16]), 16)[:len(few)]
    step = np.ones(len(few), np.int64)
    live = np.flatnonzero(many[np.minimum(low, len(many) - 1)] < few)
    while len(live):
        ahead = low[live] + step[live]
        go = (ahead < len(many)) & (many[np.minimum(ahead, len(many) - 1)] < few[live])
        live, ahead = live[go], ahead[go]
        low[live] = ahead
        step[live] *= 2
    # the value lies after low (or at it) and at most one step ahead
    high = np.minimum(low + step, len(many))
    while (live := np.flatnonzero(low < high)).size:
        middle = (low[live] + high[live]) // 2
        less = many[middle] < few[live]
        low[live[less]] = middle[less] + 1
        high[live[~less]] = middle[~less]
    hit = np.flatnonzero((low < len(many)) & (many[np.minimum(low, len(many) - 1)] == few))
    return hit, low[hit]


class _Side:
    """A group's prices in a block: of its own words, and of the words that it lacks."""

    def __init__(self, source: str, total: int, terms: int, ids, counts):
        self.source = source
        self.ids = np.asarray(ids if ids is not None else (), np.int64)
        self.prices = price(np.asarray(counts if counts is not None else (), np.int64), total, terms)
        self.none = int(price(np.zeros(1, np.int64), total, terms)[0])


def pair_value(a: _Side, b: _Side, terms: int) -> int:
    """The sum of price differences over a block's ``terms`` words; the same both ways."""
    if len(a.ids) > len(b.ids):
        a, b = b, a
    in_a, in_b = gallop(a.ids, b.ids)
    both_a, both_b = a.prices[in_a], b.prices[in_b]
    shared = np.abs(both_a - both_b).sum()
    only_a = np.abs(a.prices - b.none).sum() - np.abs(both_a - b.none).sum()
    only_b = np.abs(b.prices - a.none).sum() - np.abs(both_b - a.none).sum()
    neither = terms - len(a.ids) - len(b.ids) + len(in_a)
    return int(shared + only_a + only_b) + neither * abs(a.none - b.none)


def _merge(left: pa.Table, right: pa.Table) -> pa.Table:
    sides = [[_Side(r["source"], r["total"], r["v"], r["ids"], r["counts"]) for r in t.to_pylist()] for t in (left, right)]
    some = left if left.num_rows else right
    rows = []
    if some.num_rows:
        lang, terms = some["lang"][0].as_py(), some["block_terms"][0].as_py()
        inner = some["ti"][0].as_py() == some["tj"][0].as_py()
        pairs = ((a, b) for i, a in enumerate(sides[0]) for b in sides[0][i + 1:]) if inner else ((a, b) for a in sides[0] for b in sides[1])
        rows = [(lang, a.source, b.source, pair_value(a, b, terms)) for a, b in pairs]
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.table([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string()),
                     pa.array(columns[3], pa.int64())], ["lang", "a", "b", "value"])


def _keyed(df: DataFrame) -> DataFrame:
    """With ``gkey``, one text for (lang, source)."""
    return df.withColumn("gkey", F.concat(F.length("lang").cast("string"), F.lit(":"), F.col("lang"), F.col("source")))


def divergence(docs: DataFrame, least: int = LEAST, ranks: int = RANKS, block_bits: int = BLOCK_BITS, side: int = SIDE) -> DataFrame:
    """lang, source, part, item, value, rank: how far each group is from the others of its language, and by which words.

    ``pair``: each other source of the language with the summed difference of
    prices over all kept words (0 where none is kept). ``term``: the first
    ``ranks`` kept words that the group has and prices higher than its language does.
    Null text, lang and source are ''; repeated rows count each; ties go by the
    item's bytes; an empty table gives no rows; other columns take no part.
    A task holds two sides of about ``side`` groups in one block, so an array is
    sent once per side of its language, and no array is longer than a block.
    """
    counts = stage(count_terms(docs))
    terms = counts.filter("term is not null")
    kept = terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("d").alias("d")).filter(F.col("d") >= least)
    vocabulary = stage(numbered(kept.drop("d"), ["lang", "term"], "id"))
    entries = stage(terms.drop("d").join(vocabulary, ["lang", "term"]))
    groups = counts.select("lang", "source").distinct()
    of_lang = vocabulary.groupBy("lang").agg(F.min("id").alias("first"), F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    langs = stage(groups.groupBy("lang").agg(F.count("*").alias("sources")).join(of_lang, "lang", "left").fillna(0))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_group = stage(_keyed(groups.join(totals, ["lang", "source"], "left").fillna(0, ["total"]).join(langs, "lang")))

    # words: both prices are plain expressions
    shares = join_groups(_keyed(entries), of_group.select("gkey", "total", "v", "lang_total"), "gkey")
    gain = priced("n", "total", "v") - priced("lang_n", "lang_total", "v")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    words = (shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), gain.alias("value"))
             .filter("value > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks))

    # pairs: arrays per block, a row for each group and block of its language, two sides per task
    block = 1 << block_bits
    placed = join_groups(entries.select("lang", "source", "id", "n"), langs.select("lang", "first"), "lang")
    at = F.col("id") - F.col("first")
    arrays = (placed.select("lang", "source", F.shiftright(at, block_bits).alias("block"), F.struct(at.bitwiseAND(block - 1).alias("at"), "n").alias("e"))
              .groupBy("lang", "source", "block").agg(F.array_sort(F.collect_list("e")).alias("e"))
              .select("lang", "source", "block", F.col("e.at").alias("ids"), F.col("e.n").alias("counts")))
    blocks = F.sequence(F.lit(0).cast("long"), F.shiftright(F.greatest(F.col("v") - 1, F.lit(0).cast("long")), block_bits))
    every = of_group.withColumn("block", F.explode(blocks)).join(arrays, ["lang", "source", "block"], "left")
    block_terms = F.least(F.col("v") - F.col("block") * block, F.lit(block).cast("long"))
    sides = F.ceil(F.col("sources") / side).cast("long")
    tile = F.pmod(F.xxhash64("source"), F.col("_sides"))
    laid = stage(every.withColumn("_sides", sides).withColumn("_tile", tile)
                 .select("lang", "block", "source", "total", "v", block_terms.alias("block_terms"), "ids", "counts", "_sides", "_tile"))
    left = laid.withColumn("tj", F.explode(F.sequence("_tile", F.col("_sides") - 1))).withColumn("ti", F.col("_tile"))
    right = laid.filter("_tile > 0").withColumn("ti", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tile") - 1))).withColumn("tj", F.col("_tile"))
    keys = ["lang", "block", "ti", "tj"]
    merged = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_merge, "lang string, a string, b string, value long")
    summed = stage(merged.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = summed.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        summed.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.unionByName(words)
