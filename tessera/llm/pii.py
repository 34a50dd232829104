"""Personal data: base patterns, and a semi-Markov conditional random field for what they miss."""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, held, least_hashes, pick

KINDS = ("email", "ip", "card", "phone")
#: Documents whose windows the field is fitted on, those of the least hashes.
FIT_DOCS = 1500
FIT_WINDOWS = 800
ROUNDS = 15
#: Tokens of an entity, and characters of context on either side of a digit or @ at most.
LONGEST = 20
CONTEXT = 32
#: Digits of an entity without an @ at most.
MOST_DIGITS = 19
#: Characters of a window that is cut whole; a longer one without line ends is cut block by block of so many tokens,
#: each seen with so many tokens beside it.
WHOLE = 2000
BLOCK = 400
BESIDE = 3 * LONGEST
#: Posterior that a span beyond the base patterns needs.
SURE = 0.9

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    """As `[A-Za-z0-9._%+-]+@domain` from left to right, in time linear in the text."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            free = domain.end()
            found.append(("email", start, free))
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[Span]:
    """The spans of the base patterns by kind, then start; matches that fail their check are dropped."""
    found = _emails(text) if "@" in text else []
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def windows(text: str) -> list[tuple[int, int]]:
    """Parts of the text around digits and @, CONTEXT characters to each side, merged where they meet."""
    found: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if found and a <= found[-1][1]:
            found[-1][1] = b
        else:
            found.append([a, b])
    return [(a, b) for a, b in found]


def _around(c: str) -> str:
    return "edge" if not c else "space" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def _features(text: str, a: int, b: int) -> list[str]:
    """Features of a whole span; each counts apart for every kind."""
    span = text[a:b]
    digits = _digits(span)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"9{len(m[0])}" if len(m[0]) < 5 else "9n", span))
    loose = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", span))
    parts = re.split(r"[^0-9]+", span.strip("+()"))
    n = len(digits)
    return [
        "bias",
        f"shape {shape if len(shape) <= 40 else 'long'}",
        f"loose {loose if len(loose) <= 24 else 'long'}",
        f"digits {n if n < 20 else 'many'}",
        f"left {_around(text[a - 1 : a])}",
        f"right {_around(text[b : b + 1])}",
        f"luhn {16 <= n <= 19 and luhn(digits)}",
        f"quad {len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)} {'.' in span}",
        f"at {span.count('@')} {bool(re.search(r'@ ?[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+$', span))}",
        f"plus {span[0] == '+'} {8 <= n <= 15}",
        f"letters {any(c.isalpha() for c in span)} {'@' in span}",
        f"first {_around(span[0])} last {_around(span[-1])}",
    ]


def candidates(text: str, a: int, b: int) -> tuple[int, list[tuple[int, int, int, int]]]:
    """Tokens in a window, and segments (first token, end token, start, end) of at most LONGEST tokens.

    Segments begin and end at the borders of words, hold a digit or an @, do not end in white space and do not
    cross a line end; without an @ they hold at most MOST_DIGITS digits.
    """
    tokens = [(a + m.start(), a + m.end()) for m in _TOKEN.finditer(text[a:b])]
    found = []
    for i, (start, _) in enumerate(tokens):
        c = text[start]
        if not (c.isalnum() or c in "+(") or (start and text[start - 1].isalnum() and c.isalnum()):
            continue
        digits, address = 0, False
        for j in range(i, min(len(tokens), i + LONGEST)):
            end = tokens[j][1]
            if "0" <= text[tokens[j][0]] <= "9":
                digits += end - tokens[j][0]
            address = address or text[tokens[j][0]] == "@"
            if (address or 0 < digits <= MOST_DIGITS) and text[end - 1].isalnum() and not text[end : end + 1].isalnum():
                found.append((i, j + 1, start, end))
            if "\n" in text[tokens[j][0] : end]:
                break
    return len(tokens), found


class Field:
    """Scores of kinds for segments: sums of weights of their features. Tokens outside score 0."""

    def __init__(self, names: dict[str, int], weights: np.ndarray) -> None:
        self.names, self.weights = names, weights

    def ids(self, text: str, segments: list[tuple[int, int, int, int]]) -> list[list[int]]:
        return [[self.names[f] for f in _features(text, a, b) if f in self.names] for _, _, a, b in segments]

    def scores(self, ids: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[x].sum(axis=0) for x in ids]) if ids else np.zeros((0, len(KINDS)))


def _log_add(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x + math.log1p(math.exp(y - x)) if y > -700 + x else x


def marginals(n: int, segments: list, scores: np.ndarray) -> np.ndarray:
    """Probability of each segment and kind, over all ways to cut n tokens into segments and single tokens."""
    sums = [float(x) for x in np.logaddexp.reduce(scores, axis=1)] if len(segments) else []
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    starting: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (i, j, _, _) in enumerate(segments):
        ending[j].append(k)
        starting[i].append(k)
    ahead, back = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        total = ahead[j - 1]
        for k in ending[j]:
            total = _log_add(total, ahead[segments[k][0]] + sums[k])
        ahead[j] = total
    for i in range(n - 1, -1, -1):
        total = back[i + 1]
        for k in starting[i]:
            total = _log_add(total, back[segments[k][1]] + sums[k])
        back[i] = total
    at = np.array([ahead[i] + back[j] - ahead[n] for i, j, _, _ in segments])
    return np.exp(np.minimum(at[:, None] + scores, 0)) if len(segments) else scores


def decode(n: int, segments: list, scores: np.ndarray) -> list[tuple[int, int]]:
    """Segments and kinds of the best cut of a window, jointly."""
    kinds, tops = (scores.argmax(axis=1), scores.max(axis=1)) if len(segments) else ([], [])
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for k, s in enumerate(segments):
        ending[s[1]].append(k)
    best, came = [0.0] * (n + 1), [-1] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for k in ending[j]:
            if best[segments[k][0]] + tops[k] > best[j]:
                best[j], came[j] = best[segments[k][0]] + tops[k], k
    found, j = [], n
    while j > 0:
        k = came[j]
        if k < 0:
            j -= 1
        else:
            found.append((k, int(kinds[k])))
            j = segments[k][0]
    return found[::-1]


def _variants(text: str, spans: list[Span], rng: random.Random) -> Iterator[tuple[str, list[Span]]]:
    """A window as it is; its spans in forms that the base patterns miss; and look-alikes that are none."""
    yield text, spans
    for real in (True, False):
        out, kept, at = [], [], 0
        for kind, a, b in sorted(spans, key=lambda s: s[1]):
            if a < at:
                continue
            span = text[a:b]
            digits = _digits(span)
            if real:
                new = {"email": span.replace("@", " @ "), "card": ".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), "phone": re.sub(r"^\+[0-9]+[ .-]?", "", span)}.get(kind, span)
            else:
                new = {
                    "email": span.replace("@", " "),
                    "ip": rng.choice([re.sub(r"[0-9]+$", str(rng.randint(256, 999)), span), f"{rng.randint(0, 30)}.{rng.randint(0, 40)}.{rng.randint(1, 20)}"]),
                    "card": "".join(rng.choice("123456789") for _ in range(rng.choice([9, 12, 14, 22]))),
                    "phone": rng.choice([f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{rng.randint(1, 99)}%", f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", f"{rng.randint(0, 23)}:{rng.randint(10, 59)}"]),
                }[kind]
            out.append(text[at:a])
            start = sum(map(len, out))
            out.append(new)
            if real:
                kept.append((kind, start, start + len(new)))
            at = b
        if spans:
            yield "".join([*out, text[at:]]), kept


def fit(found: list[tuple[str, list[Span]]], rounds: int = ROUNDS, seed: int = 7, rate: float = 0.5, shrink: float = 1e-3) -> Field:
    """Weights of largest conditional likelihood, by gradient steps with a running scale for each weight."""
    rng = random.Random(seed)
    names: dict[str, int] = {}
    cases = []
    for window, spans in found:
        for text, gold in _variants(window, spans, rng):
            n, segments = candidates(text, 0, len(text))
            true = {(a, b): KINDS.index(kind) for kind, a, b in gold}
            ids = [[names.setdefault(f, len(names)) for f in _features(text, a, b)] for _, _, a, b in segments]
            if segments:
                cases.append((n, segments, ids, [(k, true[s[2], s[3]]) for k, s in enumerate(segments) if (s[2], s[3]) in true]))
    field = Field(names, np.zeros((len(names), len(KINDS))))
    if not cases:
        return field
    scale = np.full(field.weights.shape, 1e-2)
    for _ in range(rounds):
        rng.shuffle(cases)
        for a in range(0, len(cases), 64):
            step = np.zeros(field.weights.shape)
            for n, segments, ids, gold in cases[a : a + 64]:
                p = marginals(n, segments, field.scores(ids))
                for k, kind in gold:
                    p[k, kind] -= 1
                np.add.at(step, np.concatenate(ids), -np.repeat(p, [len(x) for x in ids], axis=0))
            step = step / 64 - shrink * field.weights
            scale += step * step
            field.weights += rate * step / np.sqrt(scale)
    return field


def stretches(text: str, a: int, b: int) -> Iterator[tuple[int, int, int, int]]:
    """Parts of a window that are cut by themselves (from, to), and where the segments that count begin (first, end).

    No segment crosses a line end, so lines are cut apart with the same result. A line of more than WHOLE
    characters is taken in blocks; what lies more than BESIDE tokens away hardly weighs.
    """
    at = a
    while at < b:
        end = text.find("\n", at, b) + 1 or b
        if end - at <= WHOLE:
            yield at, end, at, end
        else:
            borders: list[int] = []
            left = at
            for m in _TOKEN.finditer(text, at, end):
                borders.append(m.start())
                if len(borders) == BLOCK + 2 * BESIDE:
                    yield left, m.start(), borders[0] if left == at else borders[BESIDE], borders[BLOCK + BESIDE]
                    borders = borders[BLOCK:]
                    left = borders[0]
            yield left, end, borders[0] if left == at else borders[BESIDE], end
        at = end


def find(text: str, field: Field, sure: float = SURE) -> tuple[list[Span], list[Span]]:
    """Base spans, and spans that the field adds: of its best cut, with posterior of at least `sure`, clear of base spans."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added: list[Span] = []
    free = 0
    for a, b, first, last in (part for window in windows(text) for part in stretches(text, *window)):
        n, segments = candidates(text, a, b)
        if not segments or all(any(x <= s[2] and s[3] <= y for x, y in taken) for s in segments):
            continue
        ids = field.ids(text, segments)
        scores = field.scores(ids)
        best = decode(n, segments, scores)
        if not best:
            continue
        p = marginals(n, segments, scores)
        for k, kind in best:
            start, end = segments[k][2:]
            if first <= start < last and start >= free:
                free = end
                if p[k, kind] >= sure and not any(x < end and start < y for x, y in taken):
                    added.append((KINDS[kind], start, end))
    return base, added


def _said(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            for a, b in windows(text):
                inside = [(k, x - a, y - a) for k, x, y in base if a <= x and y <= b]
                if b - a <= WHOLE:
                    rows.append((text[a:b], _said(inside)))
        yield pa.record_batch({"text": pa.array([r[0] for r in rows], pa.string()), "spans": pa.array([r[1] for r in rows], pa.string())})


def fit_sample(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_windows: int = FIT_WINDOWS) -> list[tuple[str, list[Span]]]:
    """Windows of up to WHOLE characters and base spans of at most fit_docs whole documents of the least hashes, at most fit_windows of them."""
    chosen = least_hashes(docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h")), fit_docs)
    rows = chosen.select("text").mapInArrow(_windows, "text string, spans string").distinct().orderBy(F.xxhash64("text", "spans"), "text").limit(fit_windows).toArrow()
    found = []
    for text, spans in zip(rows["text"].to_pylist(), rows["spans"].to_pylist()):
        found.append((text, [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)]))
    return found


def _mark(field, carried: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        model = field.value
        for batch in (part for whole in batches for part in chunks(whole)):
            base, every, counts = [], [], {kind: [] for kind in KINDS}
            for text in batch.column("text").to_pylist():
                found, added = find(text, model) if text else ([], [])
                base.append(_said(found))
                every.append(_said(found + added))
                for kind in KINDS:
                    counts[kind].append(sum(s[0] == kind for s in found))
            yield pa.record_batch(
                {
                    carried: batch.column(carried),
                    **{f"n_{kind}": pa.array(counts[kind], pa.int64()) for kind in KINDS},
                    "base": pa.array(base, pa.string()),
                    "spans": pa.array(every, pa.string()),
                }
            )

    return run


def find_personal(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base, spans.

    The counts and base are of the base patterns; spans holds these and what the field adds, as
    kind:start:end by kind, then start, in code points with exclusive ends. The field is fitted on windows of at
    most fit_docs whole documents with the base spans as labels, in their own form, in forms the
    patterns miss, and beside look-alikes. Where there is nothing to learn from it adds nothing. Entities have at
    most LONGEST tokens in the field, of any length in the patterns. Long lines are cut block by block, so that
    a text of numbers takes memory for some hundred tokens. A null or empty text has no
    spans. Null ids stay null, repeated rows come back alike, an empty table gives no rows; other
    columns are ignored.
    """
    docs = pick(docs, "doc_id", "text")
    field = docs.sparkSession.sparkContext.broadcast(fit(fit_sample(docs, fit_docs)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # texts without a digit or @ have no spans and need not leave the JVM
    rows = docs.select("doc_id", F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text"))
    return rows.mapInArrow(_mark(field, "doc_id"), f"doc_id {kind}, {', '.join(f'n_{k} bigint' for k in KINDS)}, base string, spans string")


def op5_personal_data(spark, sf_dir):
    found = find_personal(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
