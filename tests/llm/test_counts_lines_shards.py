"""Operators 1, 4, 6 and 7 against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import common, lines, mix, quality, shards

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = " \t\n\x0b\f\r"


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WHITE))


# ---- 1 mixing

def brute_targets(rows):
    sizes = Counter()
    for source, n in rows:
        sizes[source] += n
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        level = (total - sum(full.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not over:
            return sizes, {s: full.get(s, weight[s] * level) for s in order}
        full |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("block", [64, 2048])
def test_mix_meets_its_targets(documents, odd_documents, block):
    for docs in (documents, odd_documents):
        plain = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in docs.collect()]
        sizes, targets = brute_targets([(s, n) for _, s, n in plain])
        mixed = mix.mix(docs, block=block)
        shares = mix.document_shares(mixed)
        assert Counter(rows_of(shares, "doc_id", "source", "size")) == Counter(plain)
        taken = Counter()
        for r in shares.collect():
            assert r["source_size"] == sizes[r["source"]]
            assert r["target"] == pytest.approx(targets[r["source"]], rel=1e-9, abs=1e-6)
            assert 0 <= r["taken"] <= 2 * r["size"]
            taken[r["source"]] += r["taken"]
        for source, target in targets.items():
            assert abs(taken[source] - target) <= 1 + 1e-6 * target
        again = mix.document_shares(mix.mix(docs, block=block))
        assert Counter(rows_of(again, *again.columns)) == Counter(rows_of(shares, *shares.columns))


def test_mix_schedule_is_even(documents):
    """Any prefix of the schedule holds a source's slots in near proportion to its share."""
    mixed = mix.mix(documents, block=64)
    slots = sorted({(r["slot"], r["source"]) for r in mixed.filter("n_words > 0").select("slot", "source").collect()})
    assert len({s for s, _ in slots}) == len(slots)
    share, n = Counter(s for _, s in slots), len(slots)
    for end in (n // 7, n // 3, n // 2):
        seen = Counter(s for _, s in slots[:end])
        for source, all_of in share.items():
            assert abs(seen[source] - end * all_of / n) <= 2 + np.log2(n)


# ---- 4 quality rules

def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, first, covered = set(), {}, set()
    for i in range(len(words) - 7):
        window = tuple(words[i:i + 8])
        if window in seen:
            covered |= {*range(i, i + 8), *range(first[window], first[window] + 8)}
        seen.add(window)
        first.setdefault(window, i)
    full = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_quality_counts(documents, odd_documents):
    for docs in (documents, odd_documents):
        judged = quality.judge_documents(docs, ["doc_id"])
        got = rows_of(judged, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert Counter(got) == Counter((r["doc_id"], *brute_counts(r["text"])) for r in docs.collect())
        assert judged.filter("kept and base_failed").count() == 0


def test_quality_keeps_plain_prose(spark, documents):
    """Junk that the labels name goes, prose stays."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.judge_documents(documents, ["doc_id"]).filter("not base_failed").join(labels, "doc_id")
    kept = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert kept.get((1, False), 0) <= 0.01 * kept[1, True]
    assert kept.get((0, False), 0) >= 0.8 * sum(kept.get((0, k), 0) for k in (True, False))


def test_quality_estimates_match_plain_arithmetic(spark):
    """One group of correlated normal rows with far outliers: means of the core, outliers far."""
    rng = np.random.default_rng(1)
    core = rng.normal(size=(2000, 5)) @ np.diag([.5, .4, .6, .3, .5]) + 1
    rows = [("en", "s", *map(float, x)) for x in core] + [("en", "s", 40., 40., 40., 40., 40.)] * 300
    stats = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{x} double" for x in quality.STATISTICS))
    best = quality.robust_estimates(stats.repartition(3).cache()).collect()
    assert len(best) == 1
    assert np.allclose([best[0][f"m_{i}"] for i in range(5)], core.mean(0), atol=0.1)
    chol = np.array([[best[0][f"l_{i}_{j}"] if j <= i else 0 for j in range(5)] for i in range(5)])
    assert np.allclose(chol @ chol.T, np.cov(core.T), atol=0.12)


def test_quality_with_groups_too_large_to_broadcast(documents, odd_documents, monkeypatch):
    for docs in (documents, odd_documents):
        # sums of moments depend on the order of rows in the last places
        verdicts = quality.judge_documents(docs, ["doc_id"]).withColumn("d2", F.round("d2", 6))
        want = Counter(map(str, verdicts.collect()))
        with monkeypatch.context() as m:
            m.setattr(common, "BROADCAST_BYTES", -1)
            salted = quality.judge_documents(docs, ["doc_id"]).withColumn("d2", F.round("d2", 6))
            assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
            assert Counter(map(str, salted.collect())) == want


def test_quality_empty(no_documents):
    assert quality.judge_documents(no_documents, ["doc_id"]).count() == 0
    assert quality.keep_good(no_documents).count() == 0


def test_keep_good_agrees_with_verdicts(documents, odd_documents):
    for docs in (documents, odd_documents):
        want = Counter(rows_of(quality.judge_documents(docs, ["doc_id"]).filter("kept"), "doc_id"))
        kept = quality.keep_good(docs)
        assert kept.columns == docs.columns
        assert Counter(rows_of(kept, "doc_id")) == want


# ---- 6 line dedup

def brute_lines(texts, least=10):
    docs = Counter()
    for t in texts:
        docs.update({key(x) for x in (t or "").split("\n")} - {""})
    for t in texts:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if docs[key(x)] < least]
        yield len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_line_dedup(documents, odd_documents, monkeypatch, bound):
    monkeypatch.setattr(lines, "BROADCAST_BYTES", bound)
    if not bound:  # several shards, each dealt to several parts
        monkeypatch.setattr(lines, "SHARD_KEYS", 4)
        monkeypatch.setattr(lines, "LINES_PART", 500)
    for docs in (documents, odd_documents):
        rows = docs.select("doc_id", "text").collect()
        want = Counter((r[0], *x) for r, x in zip(rows, brute_lines([r[1] for r in rows])))
        got = lines.dedup_lines(docs, digest=True)
        assert Counter(rows_of(got, "doc_id", "n_lines", "n_dropped", "kept")) == want


def test_sharded_filters_leave_few_lines(documents, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 4)
    monkeypatch.setattr(lines, "LINES_PART", 500)
    own = lines.document_lines(documents).cache()
    repeated = lines.count_lines(own).filter("n_docs >= 10")
    filters, n_shards = lines.build_filters(repeated)
    left = lines.probe_shards(own, filters, n_shards)
    hits, total = own.join(repeated.select("h"), "h").count(), own.count()
    assert n_shards > 1 and hits <= left.count() <= hits + total // 100
    assert left.join(repeated.select("h"), "h").count() == hits
    assert lines.probe_shards(own.filter("false"), filters, n_shards).count() == 0


def test_line_counts_and_filters_are_reversible(documents):
    half = lines.document_lines(documents.filter("doc_id % 2 = 0")).cache()
    other = lines.document_lines(documents.filter("doc_id % 2 = 1")).cache()
    whole = lines.count_lines(half.unionByName(other))
    grown = lines.update_counts(lines.count_lines(half), added=other)
    assert set(rows_of(grown, "h", "n_docs")) == set(rows_of(whole, "h", "n_docs"))
    back = lines.update_counts(grown, removed=other)
    assert set(rows_of(back, "h", "n_docs")) == set(rows_of(lines.count_lines(half), "h", "n_docs"))

    before, after = (c.filter("n_docs >= 10").select("h") for c in (lines.count_lines(half), whole))
    filters, n_shards = lines.build_filters(before)
    filters = lines.update_filters(filters, n_shards, after.subtract(before), before.subtract(after))
    tables = [lines.CuckooFilter(table=bytes(r["filter"])) for r in filters.collect()]
    hits = [r[0] for r in after.collect()]
    assert n_shards == len(tables) == 1 and tables[0].contains(lines.pairs([bytes(h) for h in hits])).all()


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**64, size=(60_000, 2), dtype=np.uint64)
    made = lines.CuckooFilter.of(keys[:40_000])
    assert made.contains(keys[:40_000]).all()
    assert made.contains(keys[40_000:]).mean() < 0.01
    made.delete(keys[:20_000])
    assert made.contains(keys[20_000:40_000]).all()
    assert made.contains(keys[:20_000]).mean() < 0.01


def test_line_dedup_keeps_other_columns(odd_documents, no_documents):
    got = lines.dedup_lines(odd_documents.select("doc_id", "text", "lang", "source"))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_lines", "n_dropped", "kept"]
    assert got.filter("kept = 'own line 3'").count() == 1
    assert lines.dedup_lines(no_documents).count() == 0


# ---- 7 sharding

def test_shards(documents, odd_documents, no_documents):
    for docs in (documents, odd_documents):
        rows = docs.select("doc_id", "text").collect()
        got = shards.shard_documents(docs, 4).collect()
        want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
        where = defaultdict(set)
        for r in got:
            where[r["text_crc32"], r["size"]].add(r["shard"])
        # repeated texts have sizes that are sums; only equal texts share checksum and size here
        assert all(len(x) == 1 for x in where.values())
    assert shards.shard_documents(no_documents).count() == 0


def test_shards_are_balanced(documents):
    got = shards.shard_documents(documents).groupBy("shard").sum("size").collect()
    sums = [r[1] for r in got]
    assert len(sums) == 16 and max(sums) - min(sums) < 0.001 * np.mean(sums)


@pytest.mark.parametrize("giant", [0, 12_000, 60_000])
def test_large_groups_are_made_up_for(spark, monkeypatch, giant):
    """Many tasks and one group of a good part of all: no shard is above the mean or the group itself."""
    monkeypatch.setattr(shards, "TASK_GROUPS", 300)
    rng = np.random.default_rng(2)
    sizes = [giant] * bool(giant) + rng.integers(1, 40, 8000).tolist()
    groups = spark.createDataFrame([(i, -i, int(n)) for i, n in enumerate(sizes)], "g1 long, g2 long, bytes long").cache()
    got = shards.assign_groups(groups).collect()
    assert Counter((r["g1"], r["bytes"]) for r in got) == Counter(enumerate(sizes))
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["bytes"]
    rest = sorted(sums.values())[:-1] if giant > sum(sizes) / 16 else list(sums.values())
    assert len(sums) == 16 and max(rest) - min(rest) < 0.01 * np.mean(rest)


def test_difference_is_optimal_on_a_known_case():
    """Two-way differencing of 4 5 6 7 8 ends at 16 and 14."""
    sums = [s for s, _ in shards.difference([[(n, i), (0, None)] for i, n in enumerate([8, 7, 6, 5, 4])])]
    assert sums == [16, 14]
