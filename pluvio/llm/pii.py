"""Personal data: base patterns, and spans that a trained character tagger adds."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import spread
from pluvio.llm.tagger import KINDS, Tagger, char_classes, spans_of, tags_of

#: A window, and the step to the next: a span of up to half a window is whole in one of them.
WINDOW, STRIDE = 96, 48
#: Labelled windows that the tagger is fitted on at most, of either kind (with and without a span).
SAMPLE = 1500
#: Windows decoded together.
TOGETHER = 512

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBER = re.compile(r"\+?[0-9(][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 8 <= len(_digits(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them, from each @ outwards: long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, whether it holds) in code points: leftmost matches that don't overlap within a kind."""
    yield from ((0, s, e, True) for s, e in _emails(text))
    if re.search("[0-9]", text):
        for kind, pattern, good in ((1, IP, is_ip), (2, CARD, is_card), (3, PHONE, is_phone)):
            yield from ((kind, m.start(), m.end(), good(m[0])) for m in pattern.finditer(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the matches that hold, by kind, then start."""
    return [(kind, s, e) for kind, s, e, good in matches(text) if good]


def plausible(kind: int, text: str) -> bool:
    """Whether a span that the tagger proposes is of its kind's form; phones without + need their groups."""
    if kind == 0:
        return bool(EMAIL.fullmatch(text))
    if kind == 1:
        return bool(IP.fullmatch(text)) and is_ip(text)
    if kind == 2:
        return bool(CARD.fullmatch(text)) and is_card(text)
    groups = len(re.findall("[0-9]+", text))
    return bool(NUMBER.fullmatch(text)) and is_phone(text) and (text[0] == "+" or "(" in text or groups >= 3) \
        and not re.fullmatch(r"[0-9]+(\.[0-9]+)+", text)


def window_starts(text: str) -> list[int]:
    """Starts of the windows with a digit or @. Every kind of span has one, so no span is in any other window."""
    starts: list[int] = []
    hit = TRIGGER.search(text)
    while hit:
        k = hit.start() // STRIDE
        starts += [s for s in ((k - 1) * STRIDE, k * STRIDE) if s >= 0 and (not starts or s > starts[-1])]
        hit = TRIGGER.search(text, (k + 1) * STRIDE)
    return starts


def _classes(texts: list[str]) -> np.ndarray:
    x = np.zeros((WINDOW, len(texts)), np.int64)
    for i, t in enumerate(texts):
        x[:len(t), i] = char_classes(t)
    return x


def reconcile(text: str, found: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of the spans that all windows propose, those to add: of their kind's form, clear of the base spans, and,
    where proposals overlap, the longest, then the first."""
    taken = [(s, e) for _, s, e in base]
    added = []
    for kind, s, e in sorted(set(found), key=lambda p: (p[1] - p[2], p[1], p[0])):
        if all(e <= a or s >= b for a, b in taken) and plausible(kind, text[s:e]):
            taken.append((s, e))
            added.append((kind, s, e))
    return added


def _tag(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Proposed spans of each text; windows of many texts are decoded together."""
    todo = [(i, s) for i, t in enumerate(texts) for s in window_starts(t)]
    found: list[list] = [[] for _ in texts]
    for k in range(0, len(todo), TOGETHER):
        part = todo[k:k + TOGETHER]
        tags = tagger.decode(_classes([texts[i][s:s + WINDOW] for i, s in part]))
        for (i, s), own in zip(part, tags.T):
            size = len(texts[i])
            for kind, a, b in spans_of(own[:min(WINDOW, size - s)]):
                # a span that a border may have cut is whole in the next window
                if (a or not s) and (b < WINDOW or s + WINDOW >= size):
                    found[i].append((kind, s + a, s + b))
    return found


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _find(weights: dict[str, np.ndarray] | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(weights) if weights else None
        for batch in batches:
            texts = batch["text"].to_pylist()
            proposed = _tag(tagger, texts) if tagger else [[]] * len(texts)
            counts, base_text, all_text = [], [], []
            for text, own in zip(texts, proposed):
                base = base_spans(text)
                counts.append([sum(k == j for k, _, _ in base) for j in range(len(KINDS))])
                base_text.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                all_text.append(_listed(base + reconcile(text, own, base)))
            columns = [batch["doc_id"], *(pa.array([c[j] for c in counts], pa.int64()) for j in range(len(KINDS))),
                       pa.array(base_text, pa.string()), pa.array(all_text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        window, spans = [], []
        for text in batch["text"].to_pylist():
            # a card's number differs from another one by its check digit alone, which no tagger can tell: windows
            # with matches of a span's length that don't hold teach nothing
            near = [(k, a, b, good) for k, a, b, good in matches(text) if good or b - a >= 7]
            for s in window_starts(text):
                in_window = [(k, a - s, b - s, good) for k, a, b, good in near if a < s + WINDOW and b > s]
                own = [(k, a, b) for k, a, b, good in in_window if good]
                held = {(a, b) for _, a, b in own}
                if all(a >= 0 and b <= WINDOW for _, a, b in own) and all(
                        good or any(a < y and b > x for x, y in held) for _, a, b, good in in_window):
                    window.append(text[s:s + WINDOW])
                    spans.append(_listed(own))
        yield pa.RecordBatch.from_arrays([pa.array(window, pa.string()), pa.array(spans, pa.string())], ["window", "spans"])


def labelled_windows(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Up to ``sample`` different windows with a base span and as many without, the first by a hash of the window.

    The base spans are the labels. The bound is all that reaches the driver.
    """
    made = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_windows, "window string, spans string").distinct()
    rows = []
    for has in (True, False):
        part = made.filter((F.col("spans") != "") == has).orderBy(F.xxhash64("window"), "window", "spans").limit(sample)
        rows += part.collect()
    return [(r["window"], [(KINDS.index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)]) for r in rows]


def train_tagger(labelled: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 250) -> Tagger | None:
    """A tagger fitted to labelled windows; none without a labelled span."""
    if not any(spans for _, spans in labelled):
        return None
    x = _classes([w for w, _ in labelled])
    y = np.zeros_like(x)
    for i, (window, spans) in enumerate(labelled):
        y[:len(window), i] = tags_of(len(window), spans)
    return Tagger.fresh().fit(x, y, rounds)


def find_personal(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are of the base patterns, over whole texts; spans
    also has what the tagger adds. The tagger is fitted on a bounded sample of
    windows labelled by the base patterns and reads every window of every text
    that has a digit or @. Null texts are empty; repeated rows stay; without any
    base span in the table nothing is added; an empty table gives an empty result.
    """
    tagger = train_tagger(labelled_windows(docs, sample))
    rows = spread(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_find(tagger.w if tagger else None), f"doc_id {kind}, {counts}, base_sha256 string, spans string")
