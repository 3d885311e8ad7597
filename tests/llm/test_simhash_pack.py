"""Operators 3 and 8 against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from tokenizers import Tokenizer

from pluvio.llm import pack, simhash
from pluvio.llm.queries import ranks_file


def brute_print(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, ids, budget=4):
    """The least id of each print's component."""
    a = np.array(sorted(set(prints)), np.uint64)
    root = np.arange(len(a))
    for i in range(len(a)):
        near = np.flatnonzero(np.bitwise_count(a ^ a[i]) <= budget)
        simhash.hook(root, np.full(len(near), i), near)
    label = dict(zip(a.tolist(), root.tolist()))
    least = {}
    for p, i in zip(prints, ids):
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    return [least.get(label[p]) for p in prints]


def test_near_duplicates(documents, odd_documents, no_documents):
    for docs in (documents, odd_documents):
        rows = docs.select("doc_id", "text").collect()
        prints = [brute_print(r[1]) for r in rows]
        want = Counter(zip((r[0] for r in rows), prints, brute_classes(prints, [r[0] for r in rows])))
        got = Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(docs).collect())
        assert got == want
    assert simhash.near_duplicates(no_documents).count() == 0


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(f"W{i % 97}" for i in range(1000))
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint(text.encode()) == brute_print(text)


@pytest.mark.parametrize("group, frontier", [(4096, 500_000), (16, 300)])
def test_links_of_clustered_prints(spark, monkeypatch, group, frontier):
    """Tight balls of prints, chains and random ones; sub-tries cut again and again."""
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**64, size=12, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(900)], np.uint64)
    prints = np.unique(np.concatenate([rng.choice(seeds, 900) ^ flips, rng.integers(0, 2**64, size=600, dtype=np.uint64),
                                       np.array([0, 1, 3, 7, 15, 31, 2**64 - 1], np.uint64)]))
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    edges = simhash.link_prints(df, group=group)
    assert edges.filter("u <= v").count() == 0
    label = {r["node"]: r["label"] for r in simhash.components(edges).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for p, c in zip(prints.tolist(), brute_classes(prints.tolist(), prints.tolist())):
        signed = int(np.uint64(p).view(np.int64))
        got[label.get(signed, signed)].add(p)
        want[c].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1001, 1000)], "u long, v long")
    got = {r["node"]: r["label"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


# ---- 3 packing

@pytest.fixture(scope="module")
def coder():
    made = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    made.no_truncation()
    made.no_padding()
    return made


def test_ids_of_odd_texts(coder):
    own = pack.Encoder(*ranks_file())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "", "<|endo", " " * 1_200_000, "\n" * 2_000_000 + "a", "a" + "\u3000" * 50_000 + "b"]
    texts += [f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}{chr(c)}  b" for c in [*range(pack.NEAR + 200), 0x558, 0x58B, 0x208F, 0xA7CE, 0x107BB, 0x1F600]]
    for text in texts:
        assert own.encode(text) == coder.encode(text, add_special_tokens=False).ids, text[:30]
    assert own.encode("a <|endoftext|> b").count(50256) == 1


def test_pieces_of_odd_texts(spark, coder):
    texts = ["a <|endoftext|> b", " " * 1_200_000 + "x", "\n" * 1_500_000, None]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    got = pack.pack_documents(docs, *ranks_file()).collect()
    sizes = [len(coder.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts]
    assert sum(r["length"] for r in got) == sum(sizes) and len(got) == sum(-(-n // 2048) for n in sizes)


def test_pack_documents(documents, odd_documents, coder):
    for docs in (documents, odd_documents):
        rows = docs.select("doc_id", "text").collect()
        want = Counter()
        total = 0
        for doc_id, text in rows:
            ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
            total += len(ids)
            head = len(ids) % 2048 or 2048
            starts = [0, *range(head, len(ids), 2048)]
            for k, s in enumerate(starts):
                own = np.array(ids[s:(starts + [len(ids)])[k + 1]], "<u4")
                want[doc_id, k, s, len(own), zlib.crc32(own.tobytes())] += 1
        got = pack.pack_documents(docs, *ranks_file()).collect()
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        placed = defaultdict(list)
        for r in got:
            placed[r["sequence_id"]].append((r["offset"], r["length"]))
        for own in placed.values():
            end = 0
            for offset, length in sorted(own):
                assert offset == end
                end += length
            assert end <= 2048
        assert len(placed) <= 1.01 * total / 2048 + 1


def test_sequences_hold_the_ids(odd_documents, coder):
    cut = pack.pieces(odd_documents, *ranks_file(), with_ids=True).cache()
    made = {r["sequence_id"]: r["ids"] for r in pack.sequences(pack.pack(cut)).collect()}
    ids = [x for own in made.values() for x in own]
    want = [x for r in odd_documents.collect() for x in [*coder.encode(r["text"] or "", add_special_tokens=False).ids, 0]]
    assert Counter(ids) == Counter(want) and max(map(len, made.values())) <= 2048


def test_empty_pack(no_documents):
    assert pack.pack_documents(no_documents, *ranks_file()).count() == 0


@pytest.mark.parametrize("histogram, least", [
    ({1000: 10, 1048: 10}, 10), ({2048: 5, 1: 3}, 6), ({700: 9, 648: 9, 500: 4, 48: 1}, 7), ({}, 0),
    ({x: 100_000 + x for x in range(1, 2049)}, None)])
def test_solve(histogram, least):
    found = pack.solve(histogram)
    held = Counter()
    for config, times in found:
        assert sum(x * n for x, n in config.items()) <= 2048 and times > 0
        for x, n in config.items():
            held[x] += n * times
    assert held == Counter(histogram)
    total = sum(x * n for x, n in histogram.items())
    assert sum(t for _, t in found) <= (least if least is not None else 1.003 * -(-total // 2048))


def test_knapsack_is_the_best():
    rng = np.random.default_rng(5)
    value = np.zeros(21)
    value[rng.choice(np.arange(3, 21), 6, replace=False)] = rng.random(6)
    best = [0.0] * 21
    for w in range(1, 21):
        best[w] = max([best[w - 1], *(best[w - x] + value[x] for x in range(1, w + 1) if value[x])])
    found, pick = pack.knapsack(value)
    assert found.tolist() == pytest.approx(best)
    assert sum(value[x] * n for x, n in pack.fill(pick, 20, {}).items()) == pytest.approx(best[20])
