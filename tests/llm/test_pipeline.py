"""The pipeline: every stage against brute force on what the stage before kept."""

from collections import Counter

import pytest

import corpus_pipeline as P
from pluvio.llm import mix, quality, simhash
from pluvio.llm.common import stage
from .test_counts_lines_shards import brute_targets, key, WORD
from .test_simhash_pack import brute_classes, brute_print


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_stages(spark, request, name):
    docs = request.getfixturevalue(name)
    if "n_chars" not in docs.columns:
        docs = docs.withColumn("n_chars", quality.F.length("text").cast("long"))
    docs = docs.select(*P.COLUMNS)
    rows = [tuple(r) for r in docs.collect()]

    good = stage(P.quality_rules(spark, docs, ""))
    left = [tuple(r) for r in good.collect()]
    kept = Counter((r["doc_id"], r["h"]) for r in quality.judge_documents(docs.withColumn("h", quality.F.hash("text", "lang", "source")), ["doc_id", "h"])
                   .filter("kept").collect())
    assert Counter((r[0],) for r in left) == Counter({(i,): 0 for i, _ in kept}) + Counter((i,) for (i, _), n in kept.items() for _ in range(n))
    assert not Counter(left) - Counter(rows)

    cleaned = stage(P.line_dedup(spark, good, ""))
    count = Counter()
    for r in left:
        count.update({key(x) for x in (r[1] or "").split("\n")} - {""})
    want = Counter()
    for i, text, lang, source, n in left:
        own = [x for x in (text or "").split("\n")]
        stay = [x for x in own if count[key(x)] < 10]
        new = "\n".join(stay)
        want[i, text if len(own) == len(stay) else new, lang, source, n if len(own) == len(stay) else len(new)] += 1
    now = [tuple(r) for r in cleaned.collect()]
    assert Counter(now) == want

    single = stage(P.near_dedup(spark, cleaned, ""))
    after = [tuple(r) for r in single.collect()]
    prints = [brute_print(r[1]) for r in now]
    groups = brute_classes(prints, range(len(now))) if now else []  # the place of a row of the group names it
    members = {}
    for row, group in zip(now, groups):
        members.setdefault(group, []).append(row)
    assert not Counter(after) - Counter(now)
    group_of = dict(zip(now, groups))
    assert Counter(group_of[r] for r in after) == Counter(members.keys())
    for r in after:
        ids = [m[0] for m in members[group_of[r]] if m[0] is not None]
        assert r[0] == (min(ids) if ids else None)

    mixed = stage(P.mix_sources(spark, single, ""))
    out = Counter(tuple(r) for r in mixed.collect())
    assert set(out) <= set(after) and all(n <= 2 * Counter(after)[r] for r, n in out.items())
    sizes, targets = brute_targets([(r[3], len(WORD.findall(r[1] or ""))) for r in after])
    for source, target in targets.items():
        words = sum(n * len(WORD.findall(r[1] or "")) for r, n in out.items() if r[3] == source)
        longest = max(len(WORD.findall(r[1] or "")) for r in after if r[3] == source)
        assert target - 1 <= words <= target + longest

    packed = P.best_fit_packing(spark, mixed, "").collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r[0] for r in out.elements())


def test_ids_that_repeat_or_lack_keep_a_row_of_each_group(spark):
    a, b, c = (" ".join(f"{w}{k}" for k in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 2), (2, b, "en", "s", 2), (2, b, "en", "s", 2), (None, a, None, None, None),
            (None, c, None, "s", 3), (None, c, "en", None, 3), (None, c, "en", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in P.near_dedup(spark, docs, "").collect()]
    assert sorted((r[1][0], r[0]) for r in got) == [("a", 1), ("b", 1), ("g", None)]
    assert set(got) <= set(rows)


def test_run_is_the_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, step in P.STAGES:
        docs = stage(step(spark, docs, ""))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = P.run(spark, "/root/testdata/sf0.001").select(*cols).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, docs.select(*cols).collect())) and got
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "best_fit_packing"]
    assert mix and simhash
