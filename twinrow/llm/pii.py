"""Personal data in texts: base patterns, and spans a trained tagger adds.

**Base.** Email addresses, IPv4 addresses, card numbers (Luhn) and phone numbers by
fixed patterns, leftmost and non-overlapping per kind.

**Tagger.** A character-level bidirectional LSTM with CRF transitions (``lstm``)
marks spans of the same kinds. It is trained on windows of a bounded sample of
documents (``SAMPLE``): their base spans are the labels, and more labelled spans
are made by writing values of each kind, also in disguised spellings such as
``name (at) host [dot] org`` or dotted card numbers, into windows without any.

**Windows.** Every kind holds a digit or an "at": a sign, the word in brackets, or the
word alone before a spelt or dotted domain. Stretches around all such characters are
decoded by Viterbi in pieces of ``PIECE`` characters, each sharing half with the next,
and a stretch grows while a span touches its end. A span cut by the end of a piece is
joined with the part of the same kind that the next piece shows. The spans of a text
are then reconciled globally: equal spans add up their margins, and the
non-overlapping set of greatest total margin stays. Spans that touch a base span are
dropped, so base ones always stay as they are.

Null texts count as empty. With no documents there is nothing to train on or to tag.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinrow.llm import lstm, spans
from twinrow.llm.common import by_bytes, in_batches, thinned

KINDS = ("email", "ip", "card", "phone")
LENGTH = 64
STRIDE = 32
#: Characters that are decoded at once; every other piece begins half as many later.
PIECE = 256
#: Windows of the documents that train the tagger; about 64 characters each.
SAMPLE = 2000
#: Spans are at least this long and have at least this mean margin.
SHORTEST = 7
MARGIN = 0.25

# The base patterns.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TRIGGER = re.compile(
    r"[\d@＠﹫]|[(\[{<]\s?at\s?[)\]}>]"
    r"|\bat\b(?=\s+[\w-]+(?:\s+[\w-]+){0,6}\s+dot\b|\s+[\w-]+\.[a-z]{2})",
    re.IGNORECASE,
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # Going back from each "@" finds the leftmost start in linear time.
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start."""
    found = [("email", *s) for s in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        # Leading zeros go first: a number of thousands of digits is no number to int.
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def allowed_steps() -> np.ndarray:
    """Tag 0 is outside; kind k begins by 2k + 1 and goes on by 2k + 2."""
    tags = 2 * len(KINDS) + 1
    allowed = np.ones((tags, tags))
    for k in range(len(KINDS)):
        inside = 2 * k + 2
        allowed[:, inside] = 0
        allowed[[inside - 1, inside], inside] = 1
    return allowed


def windows(text: str) -> list[int]:
    """Starts of the windows around everything a span must hold."""
    near = {m.start() // STRIDE for m in _TRIGGER.finditer(text)}
    starts = {k + d for k in near for d in (-1, 0, 1)}
    return sorted({max(0, k * STRIDE - STRIDE // 2) for k in starts if k * STRIDE < len(text) + STRIDE})


def reconciled(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int]]:
    """The non-overlapping spans of greatest total weight; equal ones add up."""
    total: dict[tuple[str, int, int], float] = {}
    for kind, start, end, weight in found:
        total[kind, start, end] = total.get((kind, start, end), 0.0) + weight
    order = sorted(total, key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in order]
    best = [0.0]
    take = []
    for i, s in enumerate(order):
        before = bisect_right(ends, s[1], hi=i)
        with_it = best[before] + total[s]
        take.append((with_it > best[i], before))
        best.append(max(best[i], with_it))
    chosen, i = [], len(order)
    while i:
        taken, before = take[i - 1]
        if taken:
            chosen.append(order[i - 1])
            i = before
        else:
            i -= 1
    return chosen[::-1]


def free_of(
    spans_: list[tuple[str, int, int]], taken: list[tuple[str, int, int]]
) -> list[tuple[str, int, int]]:
    """The spans that touch none of the others, found by bisection."""
    order = sorted((s[1], s[2]) for s in taken)
    starts = [start for start, _ in order]
    reach = list(accumulate((end for _, end in order), max))
    found = []
    for s in spans_:
        before = bisect_left(starts, s[2])
        if not before or reach[before - 1] <= s[1]:
            found.append(s)
    return found


def _runs(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """Kind, start and end of the marked runs of one window."""
    found, at = [], 0
    for at in np.flatnonzero(tags % 2 == 1):
        end = at + 1
        while end < len(tags) and tags[end] == tags[at] + 1:
            end += 1
        found.append((int(tags[at]) // 2, int(at), int(end)))
    return found


def _stretches(text: str) -> list[list[int]]:
    """Start and end of every stretch around windows that meet."""
    found: list[list[int]] = []
    for w in windows(text):
        start, end = max(0, w - LENGTH), min(len(text), w + 2 * LENGTH)
        if found and start <= found[-1][1]:
            found[-1][1] = end
        elif start < end:
            found.append([start, end])
    return found


Part = tuple[int, int, int, float, bool, bool]


def _joined(parts: list[Part]) -> list[Part]:
    """Spans in order of start, those that pieces cut joined; whether either end is cut."""
    found = []
    last: dict[int, Part] = {}
    for part in sorted(parts):
        k, a, b, weight, left, right = part
        before = last.pop(k, None)
        if before and left and a < before[2]:
            part = (k, before[1], b, before[3] + weight, before[4], right)
        elif before:
            found.append(before)
        if part[5]:
            last[k] = part
        else:
            found.append(part)
    return found + list(last.values())


def tagged(tagger: lstm.Tagger, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Reconciled spans of every text."""
    found: dict[str, list[tuple[int, int, int, float]]] = {}
    gathered: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    open_ = [(i, *stretch) for i, t in enumerate(texts) for stretch in _stretches(t)]
    while open_:
        pieces = [
            [(w, min(w + PIECE, end)) for w in range(start, max(start + 1, end - PIECE // 2), PIECE // 2)]
            for _, start, end in open_
        ]
        # Padding is part of what is read, so it depends on the piece alone.
        by_length: dict[int, dict[str, None]] = {}
        for (i, _, _), own in zip(open_, pieces):
            for a, b in own:
                cut = texts[i][a:b]
                if cut not in found:
                    by_length.setdefault(-(-len(cut) // LENGTH) * LENGTH, {})[cut] = None
        for length, cuts in by_length.items():
            unique = list(cuts)
            for at in range(0, len(unique), 256):
                part = unique[at : at + 256]
                tags, margin = tagger.decode(lstm.classes(part, length))
                for text, own, by in zip(part, tags, margin):
                    found[text] = [
                        (k, a, min(b, len(text)), float(by[a:b].sum())) for k, a, b in _runs(own)
                        if a < len(text) and by[a:b].mean() >= MARGIN
                    ]
        more = []
        for (i, start, end), own in zip(open_, pieces):
            size = len(texts[i])
            spans_ = _joined([
                (k, w + a, w + b, weight, a == 0 and w > 0, w + b == e and e < size)
                for w, e in own for k, a, b, weight in found[texts[i][w:e]]
            ])
            early = any(s[4] and s[1] == start for s in spans_)
            late = any(s[5] and s[2] == end for s in spans_)
            if early or late:
                more.append((i, max(0, start - PIECE * early), min(size, end + PIECE * late)))
            else:
                gathered[i] += [(KINDS[s[0]], *s[1:4]) for s in spans_ if not s[4] and not s[5]]
        open_ = more
    return [
        [s for s in reconciled(own)
         if s[2] - s[1] >= SHORTEST and _TRIGGER.search(t[s[1] : s[2]])]
        for t, own in zip(texts, gathered)
    ]


def _word(rng: np.random.Generator, low: int = 2, high: int = 9) -> str:
    return "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(low, high)))


def made_up(kind: str, rng: np.random.Generator) -> str:
    """A value of a kind, half of the time in a spelling the base patterns miss."""
    plain = rng.random() < 0.5
    pick = lambda *options: options[rng.integers(len(options))]
    if kind == "email":
        local = _word(rng) + pick("", ".", "_") + pick(_word(rng), str(rng.integers(100)))
        host = pick(_word(rng), f"mail{rng.integers(10)}.{_word(rng)}", f"{_word(rng)}.{_word(rng)}")
        top = pick("com", "org", "net", "de", "fr")
        if plain:
            return f"{local}@{host}.{top}"
        at = pick(" (at) ", " [at] ", "(at)", "[at]", " at ", "{at}", " <at> ", "\uff20")
        dot = " dot " if at == " at " else pick(" (dot) ", " [dot] ", "[dot]", ".")
        return f"{local}{at}{host.replace('.', dot)}{dot}{top}"
    if kind == "ip":
        parts = [str(p) for p in rng.integers(0, 256, 4)]
        return ".".join(parts) if plain else pick("[.]", " . ", "(.)").join(parts)
    if kind == "card":
        digits = "".join(map(str, rng.integers(0, 10, 15)))
        digits += next(c for c in "0123456789" if luhn(digits + c))
        groups = [digits[i : i + 4] for i in range(0, 16, 4)]
        return pick("", " ", "-").join(groups) if plain else pick(".", "/", "_").join(groups)
    area, first, last = rng.integers(100, 1000), rng.integers(100, 1000), rng.integers(0, 10000)
    if plain:
        return f"+{rng.integers(1, 99)} ({area}) {first}-{last:04d}"
    return pick(f"({area}) {first}-{last:04d}", f"{area}-{first}-{last:04d}", f"tel. {area} {first} {last:04d}"[5:])


def examples(contexts: list[str], seed: int = 0) -> tuple[list[str], np.ndarray]:
    """Windows and tags: the contexts with their base spans as labels, and for each
    context another one into which a value was written."""
    rng = np.random.default_rng(seed)
    texts, marks = [], []
    for context in contexts:
        own = base_spans(context)
        texts.append(context)
        marks.append(own)
        if own:
            continue
        kind = KINDS[rng.integers(len(KINDS))]
        value = made_up(kind, rng)
        at = int(rng.integers(0, max(1, LENGTH - len(value))))
        head = context[:at]
        if head and head[-1].isalnum():
            head = head[:-1] + " "
        tail = context[at : LENGTH - len(value)]
        if tail and tail[0].isalnum():
            tail = " " + tail[1:]
        texts.append((head + value + tail)[:LENGTH])
        marks.append([(kind, len(head), min(LENGTH, len(head) + len(value)))])
    tags = np.zeros((len(texts), LENGTH), np.int64)
    for i, own in enumerate(marks):
        for kind, start, end in own:
            k = KINDS.index(kind)
            tags[i, start] = 2 * k + 1
            tags[i, start + 1 : end] = 2 * k + 2
    return texts, tags


def contexts_of(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> list[str]:
    """Windows to train on, at most ``sample``: of about ``sample`` texts, picked by
    their hash, one at a place that the length picks and the first around a trigger."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            out = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                near = windows(text)[:3]
                some = [(len(text) * 2654435761 % (len(text) + 1)) // STRIDE * STRIDE]
                out += [text[w : w + LENGTH] for w in near + some]
            yield pa.RecordBatch.from_arrays([pa.array([c for c in out if c.strip()], pa.string())], ["cut"])

    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    cuts = in_batches(thinned(texts, F.col("text"), sample), cut, "cut string")
    rows = cuts.orderBy(F.xxhash64("cut"), "cut").limit(sample).collect()
    return [r["cut"] for r in rows]


def trained(contexts: list[str], seed: int = 0) -> lstm.Tagger | None:
    """A tagger trained on the contexts; none without any."""
    if not contexts:
        return None
    texts, tags = examples(contexts, seed)
    return lstm.train(lstm.classes(texts, LENGTH), tags, allowed_steps(), seed=seed)


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    tagger: lstm.Tagger | None = None, sample: int = SAMPLE,
) -> DataFrame:
    """Id and spans of every row; trains a tagger on the documents if none is given."""
    tagger = tagger or trained(contexts_of(docs, text_col, sample))
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def finder():
        model = shared.value

        def find(texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
            more = tagged(model, texts) if model is not None else [[] for _ in texts]
            out = []
            for text, own in zip(texts, more):
                base = base_spans(text)
                out.append([(*s, True) for s in base] + [(*s, False) for s in free_of(own, base)])
            return out

        return find

    return spans.scanned(docs, finder, id_col, text_col)
