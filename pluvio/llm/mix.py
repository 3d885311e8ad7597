"""Mixing sources to target weights by a low-discrepancy schedule. No Python runs in tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import numbered, running, stage

WORD = r"[^\x20\x09-\x0D]+"
#: Words in a block, and schedule points that one task ranks together.
BLOCK, RANGE = 2048, 65_536


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A text that is never null and sorts like the source, null last."""
    return F.when(source.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), source))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(skey, source_size, sid, target) of every source, staged.

    Sources in order of their code points take the weights in turn and divide
    ``share`` of all words by them; a target stops at ``most`` times its source
    and the others share the rest, until none is above.
    """
    per_source = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    sources = stage(numbered(per_source, ["skey"], "sid")
                    .withColumn("weight", F.get(cycle, F.pmod("sid", F.lit(len(weights))).cast("int"))))
    wanted = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    cap = most * F.col("source_size")
    level = 0.0
    while True:  # every turn stops one source more at least; one row comes back
        full = F.col("weight") * level > cap
        row = sources.agg(F.sum(F.when(full, cap)).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if not row["weight"]:
            break
        higher = max(level, (wanted - (row["full"] or 0.0)) / row["weight"])
        if higher == level:
            break
        level = higher
    return stage(sources.select("skey", "source_size", "sid", F.least(F.col("weight") * level, cap).alias("target")))


def _word_blocks(docs: DataFrame, sources: DataFrame, block: int, seed: int) -> DataFrame:
    """Each document's words, laid end to end in its source's shuffled order, cut at block borders.

    One row per document and block that it touches: first word of the piece in
    the document and in the block. A document without words has one row in a
    block that no slot has.
    """
    laid = running(docs, ["skey"], F.xxhash64(F.lit(seed), "doc_id", "size"), ["doc_id", "size"], "size", "at")
    some = F.col("size") > 0
    blocks = F.when(some, F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))) \
        .otherwise(F.array(-1 - F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))))
    pieces = laid.join(sources, "skey").withColumn("block", F.explode(blocks))
    start, end = F.col("block") * block, F.col("at") + F.col("size")
    return (pieces.withColumn("first_word", F.when(some, F.greatest(start - F.col("at"), F.lit(0))))
            .withColumn("block_word", F.when(some, F.greatest(F.col("at") - start, F.lit(0))))
            .withColumn("n_words", F.when(some, F.least(end, start + block) - F.greatest(F.col("at"), start)).otherwise(0)))


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, sid, rank, block, words): which block of which source comes when, and how many of its words.

    The 2**m van der Corput points are the multiples of 2**-m, so that a source
    that holds the cumulative weights [a, b) holds the points with numbers a to
    b - 1, as many as it has blocks to give; the point's digits in reverse are
    its slot. Slots of a source are ranked and take its blocks in turn, from the
    first again after the last; its last slot takes what its target still wants.
    """
    per_pass = F.ceil(F.col("source_size") / block)
    want = F.floor("target").cast("long")
    passes = F.floor(want / F.col("source_size"))
    quota = F.when(F.col("source_size") > 0, passes * per_pass + F.ceil((want - passes * F.col("source_size")) / block)).otherwise(0)
    counted = sources.withColumn("per_pass", per_pass).withColumn("want", want).withColumn("quota", quota.cast("long"))
    first = stage(running(stage(counted.withColumn("all", F.lit(1))), ["all"], F.xxhash64("sid"), ["sid"], "quota", "first"))
    total = first.agg(F.sum("quota")).first()[0] or 0
    bits = max(1, (max(1, total) - 1).bit_length())
    ranges = first.filter("quota > 0").withColumn(
        "range", F.explode(F.sequence(F.floor(F.col("first") / RANGE), F.floor((F.col("first") + F.col("quota") - 1) / RANGE))))
    point = F.explode(F.sequence(F.greatest(F.col("first"), F.col("range") * RANGE),
                                 F.least(F.col("first") + F.col("quota"), (F.col("range") + 1) * RANGE) - 1))
    points = ranges.repartition("sid", "range").select("sid", "source_size", "per_pass", "want", point.alias("point"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    slots = stage(points.withColumn("slot", slot).withColumn("one", F.lit(1).cast("long")))
    # the slot is its own order: its top bits as the hash's, so that ranks follow the schedule
    ranked = running(slots, ["sid"], F.shiftleft("slot", 64 - bits), ["slot"], "one", "rank", RANGE)
    number = F.pmod("rank", F.col("per_pass"))
    given = F.floor(F.col("rank") / F.col("per_pass")) * F.col("source_size") + number * block
    length = F.least(F.lit(block), F.col("source_size") - number * block, F.col("want") - given)
    return ranked.select("slot", "sid", "rank", number.cast("long").alias("block"), length.cast("long").alias("words"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        block: int = BLOCK, seed: int = 7) -> DataFrame:
    """The mix: one row per piece of a document and slot that takes it.

    doc_id, source, size, source_size, target, at (the document's place in its
    source), slot, first_word and n_words (the piece), slot_word (where it
    starts in its slot). Documents that nothing takes have one row with a null
    slot. Read by slot and slot_word this is the mixed stream. Null and empty
    texts have no words; a null source is a source; repeated rows are documents
    of their own; extra columns are left out. An empty table gives none.
    """
    rows = stage(docs.select("doc_id", "source", source_key(docs["source"]).alias("skey"), word_count(docs["text"]).alias("size")))
    sources = source_targets(rows, weights, share, most)
    pieces = _word_blocks(rows, sources, block, seed)
    slots = schedule(sources, block).select("slot", "sid", "block", "words")
    taken = F.when(F.col("slot").isNotNull(), F.greatest(F.lit(0), F.least(F.col("n_words"), F.col("words") - F.col("block_word"))))
    return pieces.join(slots, ["sid", "block"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "at", "slot", "first_word",
        F.coalesce(taken, F.lit(0)).cast("long").alias("n_words"), F.col("block_word").alias("slot_word"))


def document_shares(mixed: DataFrame) -> DataFrame:
    """Per document row: doc_id, size, source_size, target, taken (its words in the mix, repeats counted)."""
    keys = ["doc_id", "source", "size", "source_size", "target"]
    none = mixed.filter("size = 0").select(*keys, F.col("n_words").alias("taken"))
    some = mixed.filter("size > 0").groupBy(*keys, "at").agg(F.sum("n_words").alias("taken")).select(*keys, "taken")
    return some.unionByName(none)
