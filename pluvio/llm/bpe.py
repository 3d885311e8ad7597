"""Byte-level BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Spark counts the words of all texts; the most frequent ones are compiled, with
their ids as output, into a minimal automaton (words share prefixes and suffixes)
whose arc outputs add up to a word's row in the id table. The automaton is one
file of flat arrays that every executor fetches once and its Python workers map
into memory. Words that it doesn't have are merged exactly, many at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm.common import scratch_dir, stage

#: Words of the lexicon, and their longest length in bytes. Others are merged; the result is the same.
WORDS, LONGEST = 60_000, 48
#: Different words that a counting task holds before it passes them on, and that an encoding task remembers.
HELD, REMEMBERED = 300_000, 400_000
#: Words that are encoded together, characters of a text that are split at once, bytes up to which words are merged as rows.
CHUNK, SLICE, ROW_BYTES = 500_000, 1_000_000, 32
#: Bins of a doubling in the histogram of word counts.
BINS = 16
NONE = np.iinfo(np.int64).max

#: The classes of the split pattern up to NEAR; texts with characters beyond it are split by the library itself.
NEAR = 0x250


def byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself if printable, else 256, 257 and so on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


def _near_pattern() -> re.Pattern:
    import unicodedata
    kinds = {"L": "", "N": "", "Z": ""}
    for ch in map(chr, range(NEAR)):
        kind = "Z" if ch in "\t\n\x0b\f\r\x85" else unicodedata.category(ch)[0]
        if kind in kinds:
            kinds[kind] += ch
    letter, digit, white = (re.escape(kinds[k]) for k in "LNZ")
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{digit}]+| ?[^{white}{letter}{digit}]+|[{white}]+(?![^{white}])|[{white}]+")


class Vocabulary:
    """A tokenizers file of a byte-level BPE: ids, merges, added tokens, and how it splits texts into words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model, before = made["model"], made["pre_tokenizer"] or {}
        options = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or not before.get("use_regex", True) or made["normalizer"] or any(options):
            raise ValueError("not a plain byte-level BPE")
        added = made["added_tokens"]
        if before["add_prefix_space"] or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that take in neighbours, or prefix spaces, are not supported")
        chars, ids = byte_chars(), model["vocab"]
        self.of_id: dict[int, bytes] = {i: bytes(chars[c] for c in token) for token, i in ids.items()}
        self.of_id.update({t["id"]: t["content"].encode() for t in added})
        self.byte_ids = np.zeros(256, np.int64)
        for char, byte in chars.items():
            self.byte_ids[byte] = ids[char]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: (left id, right id) as one number -> rank; rank -> id
        self.ranks = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = keys.argsort()
        self.keys, self.key_ranks = keys[order], np.fromiter(self.ranks.values(), np.int64, len(self.ranks))[order]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.added = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.near, self.far = _near_pattern(), re.compile(f"[^\\x00-{chr(NEAR - 1)}]")
        self.library = Tokenizer.from_file(path).pre_tokenizer

    def slices(self, text: str) -> Iterator[str]:
        """The text in parts of about SLICE characters. A word never goes on from a printable ASCII character over a space or
        line end, nor does the pattern look back, so parts split alone as they do in the whole."""
        start = 0
        while len(text) - start > SLICE:
            found = _CUT.search(text, start + SLICE)
            if not found:
                break
            yield text[start:found.start() + 1]
            start = found.start() + 1
        yield text[start:]

    def words(self, text: str) -> list[str | int]:
        """The words of a text as the tokenizer splits it; added tokens as their ids."""
        if not self.added_split or not self.added_split.search(text):
            return self._split(text)
        out: list[str | int] = []
        for i, part in enumerate(self.added_split.split(text)):
            out += [self.added[part]] if i % 2 else self._split(part)
        return out

    def _split(self, text: str) -> list[str]:
        if not self.far.search(text):
            return self.near.findall(text)
        return [text[s:e] for _, (s, e) in self.library.pre_tokenize_str(text)]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of ids, NONE where the vocabulary has none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], NONE) if len(self.keys) else np.full(key.shape, NONE)

    def merge(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has: lowest rank first, leftmost first."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        found: list[np.ndarray | None] = [None] * len(words)
        below = 0
        for top in (4, 8, 12, 16, 24, ROW_BYTES):
            own = np.flatnonzero((size > below) & (size <= top))
            for at, ids in zip(own.tolist(), self._merge_rows([words[i] for i in own.tolist()], size[own], top)):
                found[at] = ids
            below = top
        for at in np.flatnonzero(size > ROW_BYTES).tolist():
            found[at] = self._merge_long(words[at])
        empty = np.zeros(0, np.int64)
        found = [empty if x is None else x for x in found]
        return np.concatenate(found) if found else empty, np.fromiter(map(len, found), np.int64, len(found))

    def _merge_rows(self, words: list[bytes], size: np.ndarray, width: int) -> list[np.ndarray]:
        """One row per word; each round makes every unfinished row's best merge and moves the rest of the row up."""
        if not words:
            return []
        ids = self.byte_ids[np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)]
        size, column = size.copy(), np.arange(width)
        rank = np.full(ids.shape, NONE)
        rank[:, :-1] = np.where(column[None, 1:] < size[:, None], self.rank(ids[:, :-1], ids[:, 1:]), NONE)
        live = np.arange(len(words))
        while len(live):
            own_ids, own_rank = ids[live], rank[live]
            at, row = own_rank.argmin(axis=1), np.arange(len(live))
            least = own_rank[row, at]
            go = least < NONE
            live, at, least, own_ids, own_rank = live[go], at[go], least[go], own_ids[go], own_rank[go]
            if not len(live):
                break
            row, after = np.arange(len(live)), column[None, :] > at[:, None]
            own_ids[:, :-1] = np.where(after[:, :-1], own_ids[:, 1:], own_ids[:, :-1])
            own_rank[:, :-1] = np.where(after[:, :-1], own_rank[:, 1:], own_rank[:, :-1])
            own_rank[:, -1] = NONE
            own_ids[row, at] = self.merged[least]
            size[live] -= 1
            ends = size[live]
            right = np.minimum(at + 1, width - 1)
            own_rank[row, at] = np.where(at + 1 < ends, self.rank(own_ids[row, at], own_ids[row, right]), NONE)
            inner = np.flatnonzero(at > 0)
            own_rank[inner, at[inner] - 1] = self.rank(own_ids[inner, at[inner] - 1], own_ids[inner, at[inner]])
            ids[live], rank[live] = own_ids, own_rank
        return [ids[i, :n] for i, n in enumerate(size.tolist())]

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One word of any length by a heap of its pairs and links between neighbours."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        last = len(ids)
        after, before, ranks = list(range(1, last + 1)), list(range(-1, last - 1)), self.ranks
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(last - 1) if (r := ranks.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= last or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = int(self.merged[r]), -1, after[j]
            if after[j] < last:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else last
                if b < last and (r := ranks.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return np.array([x for x in ids if x >= 0], np.int64)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, ids that the vocabulary lacks are left out."""
        return b"".join([self.of_id.get(i, b"") for i in ids]).decode("utf-8", "replace")


_CUT = re.compile(r"[!-~](?=[ \n][!-~])")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lexicon:
    """A minimal acyclic transducer as flat arrays: sorted arc keys (state * 256 + byte), targets, arc outputs, final states,
    and the ids of each word. The outputs along a word's arcs add up to its row."""

    NAMES = ("keys", "targets", "outputs", "final", "starts", "ids", "root")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, words: Sequence[bytes], ids: np.ndarray, counts: np.ndarray) -> Lexicon:
        """``words`` sorted and different, ``ids`` and ``counts`` as ``Vocabulary.merge`` gives them.

        States are closed from the end of a word as soon as the next word leaves
        them; one with the same arcs and finality as an earlier one becomes it.
        """
        known: dict[tuple, int] = {}
        path: list[list] = [[False, []]]
        previous = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                state = known.setdefault((final, tuple(arcs)), len(known))
                path[-1][1].append((previous[len(path) - 1], state))

        for word in words:
            same = next((i for i, (a, b) in enumerate(zip(previous, word)) if a != b), min(len(previous), len(word)))
            close(same)
            path += [[False, []] for _ in range(len(word) - same)]
            path[-1][0], previous = True, word
        close(0)
        known.setdefault((path[0][0], tuple(path[0][1])), len(known))
        root = known[path[0][0], tuple(path[0][1])]
        reach, keys, targets, outputs = [], [], [], []
        for state, (final, arcs) in enumerate(known):
            n = int(final)
            for byte, target in arcs:
                keys.append(state << 8 | byte)
                targets.append(target)
                outputs.append(n)
                n += reach[target]
            reach.append(n)
        starts = np.concatenate([[0], np.cumsum(counts)])
        final = np.fromiter((f for f, _ in known), np.int8, len(known))
        found = (np.array(keys, np.int64), np.array(targets, np.int32), np.array(outputs, np.int32), final, starts, ids.astype("<u4"), np.array([root]))
        return cls(dict(zip(cls.NAMES, found)))

    def to_bytes(self) -> bytes:
        head, body, at = {}, [], 0
        for name in self.NAMES:
            data = np.ascontiguousarray(getattr(self, name))
            head[name] = (at, data.dtype.str, len(data))
            body.append(data.tobytes().ljust(-(-data.nbytes // 8) * 8, b"\0"))
            at += len(body[-1])
        text = json.dumps(head).encode()
        text = text.ljust(-(-len(text) // 8) * 8)
        return len(text).to_bytes(8, "little") + text + b"".join(body)

    @classmethod
    def open(cls, path: str) -> Lexicon:
        """The arrays as views of the file, mapped into memory and shared by the processes of a machine."""
        data = np.memmap(path, np.uint8, "r")
        end = 8 + int.from_bytes(data[:8].tobytes(), "little")
        head = json.loads(data[8:end].tobytes())
        return cls({k: data[end + at:end + at + n * np.dtype(kind).itemsize].view(kind) for k, (at, kind, n) in head.items()})

    def rows(self, words: Sequence[bytes]) -> np.ndarray:
        """Each word's row, -1 where the lexicon lacks it; all words take a step through the automaton together."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        state, row = np.full(len(words), self.root[0], np.int64), np.zeros(len(words), np.int64)
        if not len(self.keys):
            return np.full(len(words), -1)
        live = np.flatnonzero(size <= LONGEST)
        state[size > LONGEST] = -1
        for step in range(LONGEST):
            live = live[size[live] > step]
            if not len(live):
                break
            key = state[live] << 8 | flat[begin[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            state[live] = np.where(hit, self.targets[arc], -1)
            row[live] += self.outputs[arc]
            live = live[hit]
        ends = (state >= 0) & (self.final[state] == 1)
        return np.where(ends, row, -1)


class _Codes(dict):
    """word -> number, in the order in which words come; ``new`` holds those without ids yet."""

    def __init__(self):
        self.new: list[str | int] = []

    def __missing__(self, word):
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Coder:
    """Encodes texts: words are looked up in the lexicon, the others merged; up to REMEMBERED words are kept for the next texts."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon):
        self.vocab, self.lexicon = vocab, lexicon
        self._forget()

    def _forget(self) -> None:
        self.codes, self.ids, self.starts = _Codes(), np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _learn(self) -> None:
        new = self.codes.new
        plain = np.array([not isinstance(w, int) for w in new])
        words = [w.encode() for w in new if not isinstance(w, int)]
        row = np.full(len(new), -1)
        row[plain] = self.lexicon.rows(words)
        known = row >= 0
        counts = np.ones(len(new), np.int64)
        counts[known] = self.lexicon.starts[row[known] + 1] - self.lexicon.starts[row[known]]
        rest = np.flatnonzero(plain & ~known)
        merged, n = self.vocab.merge([new[i].encode() for i in rest.tolist()])
        counts[rest] = n
        starts = np.concatenate([[0], np.cumsum(counts)])
        ids = np.zeros(starts[-1], "<u4")
        ids[_spans(starts[:-1][known], counts[known])] = self.lexicon.ids[_spans(self.lexicon.starts[row[known]], counts[known])]
        ids[_spans(starts[:-1][rest], counts[rest])] = merged
        ids[starts[:-1][~plain]] = [w for w in new if isinstance(w, int)]
        self.starts = np.concatenate([self.starts, starts[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        new.clear()

    def encode_words(self, words: list[str | int], ends: Sequence[int]) -> list[np.ndarray]:
        """The ids of words[0:ends[0]], words[ends[0]:ends[1]] and so on."""
        if len(self.codes) > REMEMBERED:
            self._forget()
        code = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        if self.codes.new:
            self._learn()
        count = self.starts[code + 1] - self.starts[code]
        ids = self.ids[_spans(self.starts[code], count)]
        upto = np.concatenate([[0], np.cumsum(count)])
        return [ids[upto[a]:upto[b]] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: Iterator[str]) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(number of the text, some of its ids, whether these are its last) in order, never more than CHUNK words and a slice at once."""
        words: list[str | int] = []
        marks: list[tuple[int, bool]] = []
        ends: list[int] = []

        def flush():
            yield from ((n, ids, last) for (n, last), ids in zip(marks, self.encode_words(words, ends)))
            words.clear(), marks.clear(), ends.clear()

        for n, text in enumerate(texts):
            parts = [text] if len(text) <= SLICE else self.vocab.slices(text)
            part = next(parts := iter(parts))
            while part is not None:
                following = next(parts, None)
                words += self.vocab.words(part)
                ends.append(len(words))
                marks.append((n, following is None))
                if len(words) >= CHUNK:
                    yield from flush()
                part = following
        yield from flush()


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[0], starts[0] + 1, ... of all spans one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


#: ASCII other than letters and digits divides the words that are counted.
_DIVIDE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return made

    for batch in batches:
        for text in batch["text"]:
            words = (text.as_py() or b"").translate(_DIVIDE).split()
            for at in range(0, len(words), CHUNK):
                held.update(words[at:at + CHUNK])
                if len(held) > HELD:
                    yield out()
    yield out()


def frequent_words(docs: DataFrame, words: int = WORDS, text: str = "text") -> DataFrame:
    """(word, n): the most frequent words of all texts, ``words`` at most; words over LONGEST bytes take no part.

    Words here are runs between ASCII characters that are neither letters nor
    digits. Each task passes on its counts, so a word that is everywhere makes a
    row per task. The least count that leaves no more than ``words`` is found on a
    histogram of the counts, BINS to a doubling, which has no more rows at any size.
    """
    counted = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(_count_words, "word binary, n long")
    short = counted.filter(F.octet_length("word") < LONGEST).groupBy("word").agg(F.sum("n").alias("n"))
    counts = stage(short.withColumn("bin", F.floor(F.log2("n") * BINS).cast("int")))
    cut, found = None, 0
    for row in sorted(counts.groupBy("bin").count().collect(), reverse=True):
        found += row["count"]
        if found > words:
            break
        cut = row["bin"]
    return counts.filter(F.col("bin") >= cut if cut is not None else F.lit(False)).select("word", "n")


def compile_lexicon(words: Sequence[bytes], tokenizer_file: str) -> Lexicon:
    """The transducer of the words that the tokenizer finds in ``words``, alone and after a space."""
    vocab = vocabulary(tokenizer_file)
    split: set[bytes] = set()
    for word in words:
        text = word.decode("utf-8", "ignore")
        for form in (text, " " + text):
            split.update(w.encode() for w in vocab.words(form) if not isinstance(w, int))
    found = sorted(w for w in split if len(w) <= LONGEST)
    return Lexicon.compile(found, *vocab.merge(found))


def publish(spark: SparkSession, lexicon: Lexicon) -> str:
    """Write the lexicon into the shared folder and let every executor fetch it once; returns its name for ``SparkFiles.get``."""
    name = f"pluvio-lexicon-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/{name}")
    out = path.getFileSystem(conf).create(path)
    out.write(lexicon.to_bytes())
    out.close()
    spark.sparkContext.addFile(path.getFileSystem(conf).makeQualified(path).toString())
    return name


def build_lexicon(docs: DataFrame, tokenizer_file: str, words: int = WORDS, text: str = "text") -> str:
    """Count, compile and publish; the driver holds ``words`` words of at most LONGEST bytes. An empty table gives an empty lexicon."""
    found = [bytes(r["word"]) for r in frequent_words(docs, words, text).collect()]
    return publish(docs.sparkSession, compile_lexicon(found, tokenizer_file))


@lru_cache(maxsize=2)
def _coder(tokenizer_file: str, lexicon: str) -> Coder:
    return Coder(vocabulary(tokenizer_file), Lexicon.open(SparkFiles.get(lexicon)))


def _encode(tokenizer_file: str, lexicon: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer_file, lexicon)
        for batch in batches:
            if digest:
                yield _digests(coder, batch)
            else:
                parts: list[list[np.ndarray]] = [[] for _ in range(len(batch))]
                for n, ids, _ in coder.encode(x.as_py() or "" for x in batch["text"]):
                    parts[n].append(ids)
                ids = pa.array([np.concatenate(x) for x in parts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])
    return run


def _digests(coder: Coder, batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes, of_ids, of_texts = [], [], []
    size, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
    for _, ids, last in coder.encode(x.as_py() or "" for x in batch["text"]):
        size += len(ids)
        ids_sha.update(ids.tobytes())
        # a part's decoded text: parts end between words, and a word's bytes are whole characters
        text_sha.update(coder.vocab.decode(ids.tolist()).encode())
        if last:
            sizes.append(size), of_ids.append(ids_sha.hexdigest()), of_texts.append(text_sha.hexdigest())
            size, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
    columns = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode_documents(docs: DataFrame, tokenizer_file: str, lexicon: str | None = None, digest: bool = False) -> DataFrame:
    """doc_id and ids of every row's whole text, as the tokenizers library encodes it without added special tokens.

    ``tokenizer_file`` is a byte-level BPE in that library's format and must be
    there on every machine. ``lexicon`` names a published one; by default it is
    built from ``docs``. With ``digest``, n_tokens and the SHA-256 of the ids
    (little-endian unsigned 32-bit) and of the text decoded from them take the
    ids' place. A null text is empty and has no ids; repeated rows and null ids
    each give a row; an empty table gives none; other columns take no part.
    There is no shuffle: tasks read whole rows, split very long texts into parts,
    and fetch the lexicon again wherever they are run again.
    """
    lexicon = lexicon or build_lexicon(docs, tokenizer_file)
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>"
    return docs.select("doc_id", "text").mapInArrow(_encode(tokenizer_file, lexicon, digest), f"doc_id {kind}, {made}")


def decode_documents(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id and the text of ``ids`` per row, special tokens included; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer_file)
        for batch in batches:
            texts = [vocab.decode(x.as_py() or ()) for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
