"""URL filters: a stated rule list, then association rules that FP-growth mines from labelled urls."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import join_groups, numbered, stage

#: (rule, verdict); a rule is a host suffix and a path prefix.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Least share of labelled urls that a rule's bad urls are (none: at any size LEAST urls do), and least share of its urls that are bad.
SUPPORT, LEAST, CONFIDENCE = 0.0, 10, 0.8
#: Rules that are broadcast at most; tokens of a bad url up to which FP-growth lists its combinations.
BROADCAST_RULES, WIDE = 50_000, 14
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """A struct of the longest rule that fits, null if none does. The list is a parameter and stays in the plan."""
    fits = []
    for rule, verdict in rules:
        suffix, slash, prefix = rule.partition("/")
        of_host = (host == suffix) | F.endswith(host, F.lit("." + suffix))
        fits.append(F.when(of_host & F.startswith(path, F.lit(slash + prefix)), F.struct(
            F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    if not fits:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    return F.array_max(F.array(*fits))


def url_tokens(url: Column) -> Column:
    """The different tokens of a url: scheme, host, its labels, the steps of the path with their places,
    the ending of its last step, and the names of its parameters."""
    host, path = url_parts(url)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("label="), x))
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    query = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&")
    names = F.transform(F.filter(query, lambda x: x != ""), lambda x: F.concat(F.lit("name="), F.split(x, "=")[0]))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)
    tokens = F.concat(F.array(F.concat(F.lit("scheme="), F.substring_index(url, "://", 1)), F.concat(F.lit("host="), host)), labels,
                      F.transform(steps, lambda x, i: F.concat(F.lit("step"), i.cast("string"), F.lit("="), x)), names,
                      F.when(ending != "", F.array(F.concat(F.lit("ending="), ending))).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.when(F.instr(url, "://") > 0, tokens).otherwise(F.array().cast("array<string>")))


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, wide: int = WIDE) -> DataFrame:
    """(tokens, key, confidence, support) of token combinations that mark bad urls; ``labelled``: url, bad.

    Every different url counts once, bad if any of its rows is, so that a page
    that is repeated many times is one. A rule is a combination that LEAST bad
    urls hold at any size of the table (more if ``support`` asks for it) and that
    is confident; it stays if no part of it is a rule at least as confident.
    ``key`` is its rarest token.

    FP-growth mines the bad urls' tokens; the inverted index then counts the
    combinations over all urls. Left out before are tokens of fewer bad urls and, of
    combinations, tokens that all urls have (as confident without) and tokens of
    bad urls alone (already rules that none holding them can better). An itemset
    list grows with 2 ** tokens of a url, so where a bad url keeps more than
    ``wide`` tokens the combinations are grown level by level instead, which drops
    implied tokens on the way; the rules are the same. No token and no length is left out.
    """
    urls = labelled.filter("url is not null").groupBy("url").agg(F.max("bad").alias("bad"))
    items = stage(urls.select("url", F.coalesce("bad", F.lit(False)).alias("bad"), url_tokens(F.col("url")).alias("items")).filter(F.size("items") > 0))
    total = items.count()
    empty = "tokens array<string>, key string, confidence double, support double"
    if total < LEAST:
        return stage(items.sparkSession.createDataFrame([], empty))
    least = max(support * total, LEAST)
    # numbers for the tokens that enough bad urls have, the rarest first; an order that all combinations are written in
    hits = F.count_if("bad").alias("hits")
    tokens = items.select("bad", F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("freq"), hits)
    tokens = stage(numbered(tokens.filter(F.col("hits") >= least), ["freq", "token"], "id").withColumn("key", F.concat("id", F.lit(","))))
    held = stage(join_groups(items.select("url", "bad", F.explode("items").alias("token")), tokens.select("token", "id", "freq", "hits"), "token"))
    grown = (held.filter((F.col("hits") < F.col("freq")) & (F.col("freq") < total))
             .groupBy("url", "bad").agg(F.array_sort(F.collect_list("id")).alias("ids")).filter(F.size("ids") > 1))
    grown = stage(grown)
    widest = grown.filter("bad").agg(F.max(F.size("ids"))).first()[0] or 0
    level = tokens.select("key", "freq", "hits")
    if widest > wide:
        found = level.unionByName(_by_levels(held.select("url", "bad", F.lit("").alias("front"), F.col("id").alias("last")), level, total, least))
    elif widest:
        found = level.unionByName(_by_growth(grown, least))
    else:
        found = level
    strong = found.withColumn("confidence", F.col("hits") / F.col("freq")).filter(F.col("confidence") >= confidence)
    named = (strong.withColumn("id", F.explode(F.split(F.rtrim(F.col("key"), F.lit(",")), ",").cast("array<long>"))).withColumnRenamed("key", "ids")
             .join(tokens.select("id", "token", F.col("freq").alias("n")), "id"))
    rules = stage(named.groupBy("ids").agg(F.array_sort(F.collect_list("token")).alias("tokens"), F.min_by("token", F.struct("n", "token")).alias("key"),
                                           F.first("confidence").alias("confidence"), (F.first("hits") / total).alias("support")).drop("ids"))
    inner = _matches(rules.select(F.col("tokens").alias("own"), F.col("confidence").alias("least"), F.col("tokens").alias("held")), rules, "own") \
        .filter((F.size("tokens") < F.size("own")) & (F.col("confidence") >= F.col("least"))).select(F.col("own").alias("tokens")).distinct()
    return stage(rules.join(inner, "tokens", "left_anti").select("tokens", "key", "confidence", "support"))


def _by_growth(grown: DataFrame, least: float) -> DataFrame:
    """(key, freq, hits) of the combinations of two tokens or more that ``least`` bad urls hold: FP-growth over (url, bad, ids)."""
    bad = grown.filter("bad").select("ids")
    n = bad.count()
    mined = FPGrowth(itemsCol="ids", minSupport=min(1.0, (math.ceil(least) - 0.5) / n)).fit(bad).freqItemsets
    sets = stage(mined.filter(F.size("items") > 1).select(F.array_sort("items").alias("set"), F.col("freq").alias("hits")))
    # every url against the sets of its tokens, by a set's first, its rarest
    index = sets.select(F.col("set")[0].alias("first"), "set", "hits")
    if index.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    held = grown.select("ids", F.explode("ids").alias("first")).join(index, "first").filter(F.size(F.array_except("set", "ids")) == 0)
    key = F.concat(F.array_join(F.col("set").cast("array<string>"), ","), F.lit(",")).alias("key")
    return stage(held.groupBy("set", "hits").agg(F.count("*").alias("freq")).select(key, "freq", "hits"))


def _by_levels(held: DataFrame, level: DataFrame, total: int, least: float) -> DataFrame:
    """(key, freq, hits) of the combinations of two tokens or more, grown by one token a level over (url, bad, front, last).

    One that as many urls hold as a part of it does (labels given their host, a
    path's steps that come together) is as confident as that part, and none
    that holds a combination of bad urls alone is more confident: neither they
    nor anything that holds them can stay, so they aren't grown.
    """
    hits = F.count_if("bad").alias("hits")
    found = level.filter("false")
    base = stage(level.filter((F.col("freq") > F.col("hits")) & (F.col("freq") < total)).select("key", "freq"))
    while not base.isEmpty():
        key = F.concat("front", F.col("last").cast("string"), F.lit(","))
        held = join_groups(held.withColumn("key", key), base.select("key"), "key")
        lasts = held.groupBy("url", "bad", "front").agg(F.sort_array(F.collect_set("last")).alias("lasts")).filter(F.size("lasts") > 1)
        held = (lasts.select("url", "bad", "front", "lasts", F.posexplode("lasts").alias("at", "one"))
                .select("url", "bad", F.concat("front", F.col("one").cast("string"), F.lit(",")).alias("front"),
                        F.explode(F.slice("lasts", F.col("at") + 2, F.size("lasts"))).alias("last")))
        held = stage(held)
        level = (held.groupBy("front", "last").agg(F.count("*").alias("freq"), hits).filter(F.col("hits") >= least)
                 .select(key.alias("key"), "freq", "hits"))
        # each with its parts of one token less, all of which must have been grown and be held by more urls
        ids = F.split(F.rtrim(F.col("key"), F.lit(",")), ",")
        parts = F.transform(ids, lambda x, i: F.concat(F.array_join(F.filter(ids, lambda y, j: j != i), ","), F.lit(",")))
        parts = stage(level.select(F.col("key").alias("whole"), F.col("freq").alias("n"), "hits", F.size(ids).alias("size"), F.explode(parts).alias("key")))
        level = stage(join_groups(parts, base, "key").groupBy("whole", "n", "hits", "size").agg(F.count("*").alias("known"), F.min("freq").alias("least"))
                      .filter("known = size and least > n").select(F.col("whole").alias("key"), F.col("n").alias("freq"), "hits"))
        found = found.unionByName(level)
        base = stage(level.filter("freq > hits").select("key", "freq"))
    return found


def _matches(sets: DataFrame, rules: DataFrame, held: str) -> DataFrame:
    """Pairs of a token set (column ``held``) and a rule all of whose tokens it has, by the inverted index on ``key``."""
    index = rules.select("key", "tokens", "confidence", "support")
    if index.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    return (sets.withColumn("key", F.explode(held)).join(index, "key")
            .filter(F.size(F.array_except("tokens", held)) == 0).drop("key"))


def judge_urls(pages: DataFrame, mined: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """One row per page row: page_id, host, path, rule, verdict, confidence.

    The longest rule of the list that fits decides (rule is its text); else a
    url is blocked if a mined rule matches, with that rule's confidence, and
    allowed if none does. Null urls and such without ``://`` have empty parts and
    are allowed. Repeated rows stay; an empty table gives an empty result.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn(
        "fit", longest_rule(F.col("host"), F.col("path"), rules))
    free = parts.filter("fit is null and url is not null").select("url").distinct().withColumn("held", url_tokens(F.col("url")))
    blocked = _matches(free, mined, "held").groupBy("url").agg(F.max("confidence").alias("confidence"))
    return parts.join(blocked, "url", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("confidence").isNotNull(), "block"), F.lit("allow")).alias("verdict"), "confidence")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of the pages that have a label (by id): bad if of low quality or toxic."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    marks = labels.filter(bad.isNotNull()).groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return pages.join(marks, pages["page_id"] == marks["doc_id"]).select(pages["url"], "bad")
