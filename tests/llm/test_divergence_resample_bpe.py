"""Source divergence, importance resampling and BPE against brute force and the named library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import bpe, divergence, resample
from pluvio.llm.queries import QUERIES, tokenizer_file
from pluvio.llm.words import split_words, word_table

SF = "/root/testdata/sf0.01"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# source divergence

def brute_divergence(rows, least, ranks):
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(lang or "", source or "", term.findall(lower(text))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted((t for t, n in seen.items() if n >= least), key=lambda t: t.encode())
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(terms)
        whole = sum(counts.values(), Counter())

        def prices(c):
            below = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // below for t in kept}

        p, q = {s: prices(c) for s, c in counts.items()}, prices(whole)
        for s in p:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in p if o != s))
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)]
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:ranks]
            out += [(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(terms)]
    return sorted(out)


def table_rows(df):
    return [tuple(r) for r in df.collect()]


def divergence_rows(df, **options):
    found = divergence.divergence(df, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(table_rows(found))


def test_divergence_of_odd_documents(odd_documents, no_documents):
    rows = table_rows(odd_documents.select("text", "lang", "source"))
    assert divergence_rows(odd_documents, least=2, ranks=3) == brute_divergence(rows, 2, 3)
    # no word is kept: all pairs stay, at 0
    none = divergence_rows(odd_documents, least=1000)
    assert none == brute_divergence(rows, 1000, 50) and none and {r[4] for r in none} == {0}
    assert divergence_rows(no_documents) == []


@pytest.mark.parametrize("bits,side", [(16, 16), (2, 3), (3, 1)])
def test_divergence_over_blocks_and_sides(spark, bits, side):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "abcdefghé" for b in "xyzß"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(12))), rng.choice(["en", "de", None]), f"s{int(rng.paretovariate(1)) % 9}") for _ in range(400)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("n", F.lit("clash")).withColumn("term", F.lit(1))
    assert divergence_rows(df, least=5, ranks=4, block_bits=bits, side=side) == brute_divergence(rows, 5, 4)


def test_gallop_finds_what_both_hold():
    rng = np.random.default_rng(3)
    for n, m, top in ((0, 5, 9), (5, 0, 9), (1, 1, 1), (40, 4000, 5000), (300, 300, 400), (1000, 1000, 10**6), (17, 60000, 65536)):
        a, b = (np.sort(rng.choice(max(top, k), k, replace=False)) for k in (n, m))
        i, j = divergence.gallop(a, b)
        assert (a[i] == b[j]).all() and a[i].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_prices_are_exact_for_large_counts(spark):
    counts, total, terms = [0, 1, 10**12, 8 * 10**14], 9 * 10**14, 10**6
    want = [1 + 10**9 * (c + 5) // (total + 5 * terms) for c in counts]
    assert divergence.price(np.array(counts), total, terms).tolist() == want
    df = spark.createDataFrame([(c, total, terms) for c in counts], "n long, t long, v long")
    assert [r[0] for r in df.select(divergence.priced("n", "t", "v")).collect()] == want


# importance resampling

def brute_resample(rows, target, percent=25, least=20, buckets=10_000):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        w = word.findall(lower(text))
        return len(w), [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    docs = [(i, *features(text)) for i, text in rows]
    s, t = Counter(b for d in docs for b in d[2]), Counter(b for x in target for b in features(x)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in s}
    scored = []
    for i, n, bs in docs:
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        scored.append((i, n, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in scored if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = percent * len(able) // 100
    return Counter([(x[0], *x[2:], k + 1 if k < drawn else None) for k, x in enumerate(able)] + [(x[0], *x[2:], None) for x in scored if x[1] < least])


def resampled(docs, target, **options):
    return Counter(map(tuple, resample.resample(docs, target, **options).select("doc_id", "n_features", "weight", "score", "rank").collect()))


def test_resampling_of_odd_documents(spark, odd_documents, no_documents):
    target = spark.createDataFrame([(1, "some PROSE that goes on and on"), (2, None), (3, "")], "item_id long, text string")
    rows = table_rows(odd_documents.select("doc_id", "text"))
    assert resampled(odd_documents, target, percent=60) == brute_resample(rows, ["some PROSE that goes on and on", None, ""], 60)
    assert resampled(odd_documents, target.limit(0)) == brute_resample(rows, [])
    assert resampled(no_documents, target) == Counter()


def test_resampling_of_the_test_table(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute_resample(table_rows(documents.select("doc_id", "text")), [r["text"] for r in benchmark.collect()])
    assert Counter(map(tuple, QUERIES["op12_importance_resampling"](spark, SF).collect())) == want


@pytest.mark.parametrize("size", [1, 2, 7, 100_000])
@pytest.mark.parametrize("grams", [1, 2, 3])
def test_chunks_keep_every_gram_once(size, grams):
    texts = [b"", b"a b a b a", b"one", b"x y z x y z " * 9, b"a b"]
    found = Counter()
    for chunk, _ in resample.chunks(iter(texts), grams, size=size):
        t = chunk.table
        assert (t.bucket[t.slot] >= 0).all() and t.count.sum() == len(t.slot)
        for of, slot in zip(chunk.of, t.slot):
            owner = t.owner[slot]
            found[of, t.data[t.starts[owner]:t.starts[owner] + t.sizes[owner]]] += 1
    want = Counter()
    for n, text in enumerate(texts):
        w = text.split()
        want.update((n, b" ".join(w[i:i + k])) for k in range(1, grams + 1) for i in range(len(w) - k + 1))
    assert found == want


def test_equal_hashes_of_different_grams_are_told_apart():
    words = [b"w%d" % (i % 97) for i in range(500)] + [b"v" * 70 + b"%d" % (i % 3) for i in range(20)]
    data, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    for hashed in (lambda b: 5, lambda b: len(b), lambda b: 2**64 - 1):
        t = resample.GramTable(data, starts, ends, hashed=hashed)
        assert len(t.used) == len(set(words))
        assert [words[t.owner[s]] for s in t.slot] == words
        assert t.count[t.slot].tolist() == [words.count(w) for w in words]
        assert t.bucket[t.slot].tolist() == [zlib.crc32(w) % 10_000 for w in words]


def test_long_texts_split_in_steps_as_at_once():
    text = ("Ab cé 12;x " * 500 + "y" * 300).encode()
    whole = list(split_words(text, word_table(True)))
    assert len(whole) == 1 and sum(split_words(text, word_table(True), 7), []) == whole[0]
    assert b"ab" in whole[0] and "cé".encode() in whole[0] and b"12" in whole[0]
    assert b"12" not in next(split_words(text, word_table(False)))


# BPE

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(tokenizer_file())
    made.no_truncation()
    made.no_padding()
    return made


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(tokenizer_file())


def test_encoding_of_the_test_table(spark, documents, library):
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op13_bpe_encoding"](spark, SF).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        assert found[r["doc_id"]] == (len(ids), *digests)


def test_encoding_of_odd_documents(odd_documents, no_documents, library):
    want = Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd_documents.collect())
    encoded = bpe.encode_documents(odd_documents, tokenizer_file())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()) == want
    texts = Counter(map(tuple, bpe.decode_documents(encoded, tokenizer_file()).collect()))
    assert texts == Counter((r["doc_id"], r["text"] or "") for r in odd_documents.collect())
    for empty in (bpe.encode_documents(no_documents, tokenizer_file()), bpe.encode_documents(no_documents, tokenizer_file(), digest=True)):
        assert empty.count() == 0


def test_encoding_of_odd_texts(vocab, library):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "é", "ß", "1", "²", "'s", "'LL", "'ll", "<|endoftext|>", "<|endo", "漢", "字", "　", "\x85", "\xa0",
             "\U0001F600", "\x00", "\x1c", "￿", "՘", "́", "the", " the", "."]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["", "a <|endoftext|> b", "<|endoftext|>", " " * 2_000_000 + "a", "\n" * 1_200_000, "x" * 30_000, "é" * 300, "word " * 500_000 + "  \n end"]
    lexicon = bpe.compile_lexicon([b"the", b"a", "é".encode()], tokenizer_file())
    found = [[] for _ in texts]
    for n, ids, _ in bpe.Coder(vocab, lexicon).encode(iter(texts)):
        found[n] += ids.tolist()
    for text, ids in zip(texts, found):
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:40]
        assert vocab.decode(ids) == text
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(15)]
        assert vocab.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_near_characters_split_as_in_the_library(vocab):
    for c in range(bpe.NEAR + 100):
        ch = chr(c)
        text = f"a{ch}1{ch}!{ch} {ch}{ch}  b"
        assert vocab.words(text) == [text[s:e] for _, (s, e) in vocab.library.pre_tokenize_str(text)], hex(c)


def test_lexicon_is_minimal_and_gives_each_word_its_ids(vocab, tmp_path):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abc", k=rng.randrange(9))).encode() for _ in range(800)} | {"zoë".encode()})
    ids, counts = vocab.merge(words)
    made = bpe.Lexicon.compile(words, ids, counts)
    (tmp_path / "lexicon").write_bytes(made.to_bytes())
    lexicon = bpe.Lexicon.open(str(tmp_path / "lexicon"))
    assert isinstance(lexicon.ids.base, np.memmap) or isinstance(lexicon.ids, np.memmap)
    rows = lexicon.rows(words)
    assert rows.tolist() == list(range(len(words)))
    starts = np.concatenate([[0], np.cumsum(counts)])
    assert lexicon.starts.tolist() == starts.tolist() and lexicon.ids.tolist() == ids.tolist()
    others = [w for w in (b"abcabcabcabc", b"d", b"zo", "zoë!".encode(), b"c" * 100) if w not in set(words)]
    assert (lexicon.rows(others) == -1).all()
    # as many states as there are different sets of endings
    endings = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            endings[w[:i]].add(w[i:])
    assert len(lexicon.final) == len({frozenset(x) for x in endings.values()})


def test_frequent_words_are_counted_over_all_texts(documents):
    counts = Counter(w for r in documents.select("text").collect() for w in (r["text"] or "").encode().translate(bpe._DIVIDE).split() if len(w) < bpe.LONGEST)
    for size in (500, 5, 10**6):
        found = {bytes(r["word"]): r["n"] for r in bpe.frequent_words(documents, size).collect()}
        least = min(found.values(), default=max(counts.values()) + 1)
        assert found == {w: n for w, n in counts.items() if n >= least} and len(found) <= size
    assert len(found) == len(counts)
