"""Personal data: e-mail addresses, IP addresses, payment cards and phone numbers.

Three steps. Generators of high recall propose overlapping spans: strict patterns, whose matches
always stay (the base), and loose ones for addresses and numbers written in other ways. Boosted trees,
one ensemble per kind, judge the loose proposals by format and context features. Per kind, a threshold
on the calibrated probability, chosen on proposals that were not learned from, selects the spans that
are added.

Nobody labels the data, so the trees learn from the corpus itself: base spans in their real context
are right, also when rewritten as people do to evade patterns (``VARIANTS``); loose proposals without
a valid base form, and dates, versions, prices and the like put into the same contexts, are wrong.
What is learned from is bounded: of each kind at most ``SAMPLE`` distinct base spans and ``SAMPLE``
other proposals, those of the smallest hash. Everything else covers every whole text.

All patterns take time in proportion to the text: no run of characters is scanned twice.

Defined results: null and empty texts have no spans; repeated rows each stay a row; a kind without a
base span in the corpus gets no added spans; an empty table gives an empty result; columns besides
the text are returned if named in ``keep``, result columns of the same names replace them.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm import boosting

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 1_024
PRECISION = 0.98  # of added spans, among calibration proposals
CONTEXT = 48  # characters on either side that features may read

# ---- base spans: fixed patterns of the contract, in possessive form ----------------------------

_AFTER_AT = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*+\Z")
_NUMBERS = re.compile(r"[0-9+][0-9 ().+-]*+")  # every number pattern matches inside one such island
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # where the last address, or the last @ without one, ends
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        found = _AFTER_AT.match(text, at + 1) if start < at else None
        free = at + 1
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", free)


def _ips(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text, start, end):
        parts = [m.span() for m in _DIGITS.finditer(text, *chain.span())]
        for i in range(0, len(parts) - 3, 4):
            values = [text[a:b].lstrip("0") for a, b in parts[i : i + 4]]
            if all(len(v) <= 3 and int(v or 0) <= 255 for v in values):
                yield parts[i][0], parts[i + 3][1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind; code points, end exclusive."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for island in _NUMBERS.finditer(text):
        start, end = island.span()
        if end - start < 7:
            continue
        out += [(a, 1, b) for a, b in _ips(text, start, end)]
        for m in _CARD.finditer(text, start, end):
            if m.end() - m.start() >= 12 and 12 <= len(digits := _only_digits(m[0])) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text, start, end):
            if 9 <= len(_only_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---- loose proposals ----------------------------------------------------------------------------

_AT = re.compile(r"@|[ \[({<](?:at|AT)[ \])}>]")
_LOOSE_HOST = re.compile(r" ?[\w-]{1,63}(?:(?:[.]| [.] | ?[\[({<](?:dot|DOT|\.)[\])}>] ?| (?:dot|DOT) )[\w-]{1,63})+")
_LOOSE_LOCAL = re.compile(r"[\w.%+-]{1,64} ?\Z")
_LOOSE_NUMBERS = re.compile(r"[0-9+(][0-9 ().+\-\[\],/:_ ‐-―]*+")
_GAP = re.compile(r"  +|, | - |(?<=[0-9]) ?/ ?|: ")
_EDGE = " .,-:/_[] ‐‑‒–—―"


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of loose candidates; they may overlap, and contain no verdict."""
    out = []
    if "@" in text or "at" in text or "AT" in text:
        for m in _AT.finditer(text):
            local = _LOOSE_LOCAL.search(text, max(0, m.start() - 65), m.start())
            host = _LOOSE_HOST.match(text, m.end()) if local else None
            if host:
                out.append((local.start(), 0, host.end()))
    for island in _LOOSE_NUMBERS.finditer(text):
        if island.end() - island.start() < 7:
            continue
        pieces = [(island.start(), island.end())]
        cuts = [m.span() for m in _GAP.finditer(text, *island.span())]
        if cuts:
            edges = [island.start(), *(x for cut in cuts for x in cut), island.end()]
            pieces += list(zip(edges[::2], edges[1::2]))
        for start, end in pieces:
            while end > start and text[end - 1] in _EDGE + "(+":
                end -= 1
            while start < end and text[start] in _EDGE + ")":
                start += 1
            groups = _DIGITS.findall(text, start, end) if end - start <= 64 else ()
            digits = sum(map(len, groups))
            if 7 <= digits <= 15:
                out.append((start, 3, end))
            if 12 <= digits <= 19:
                out.append((start, 2, end))
            if len(groups) == 4 and digits <= 12:
                out.append((start, 1, end))
    return sorted(set(out))


# ---- features -----------------------------------------------------------------------------------

# Words that speak for a kind, and words that speak against all, as they stand in context.
_FOR = (
    ("mail", "contact", "write", "courriel", "correo", "schreib", "kontakt"),
    ("ip", "host", "server", "address", "adresse", "dirección", "login", "from"),
    ("card", "visa", "credit", "mastercard", "karte", "carte", "tarjeta", "payment"),
    ("phone", "tel", "call", "fax", "mobile", "whatsapp", "cell", "teléfono", "téléphone", "ruf"),
)
_AGAINST = ("version", "isbn", "order", "date", "invoice", "no.", "nr", "id", "page", "price", "usd", "eur", "serial", "build", "hash")
_WORD = re.compile(r"[^\W\d_]+\.?")
_SEPARATORS = re.compile(r"[^0-9]+")


def _class(char: str) -> int:
    return 0 if not char else 1 if char.isspace() else 2 if char.isdigit() else 3 if char.isalpha() else 4 if char in ".,;:!?)(\"'" else 5


def features(before: str, span: str, after: str, kind: int) -> list[float]:
    groups = _DIGITS.findall(span)
    digits = "".join(groups)
    seps = _SEPARATORS.findall(span[1:-1]) if len(span) > 2 else []
    sizes = [len(g) for g in groups] or [0]
    values = [int(g[:6]) for g in groups] or [0]
    words = [w.lower() for w in _WORD.findall(before[-CONTEXT:])[-5:]]
    tail = re.split(r"[.\])} >]", span)[-1]
    return [
        len(span), len(digits), sum(c.isalpha() for c in span), len(seps), len(set(seps)), max(map(len, seps), default=0),
        len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], values[0], values[-1], max(values),
        len(set(digits)), max((digits.count(d) for d in set(digits)), default=0), float(bool(digits) and luhn(digits)),
        span.startswith("+"), span.startswith("00"), "(" in span, "." in span, "," in span, ":" in span, "/" in span, "[" in span or "{" in span,
        "@" in span, span.count("."), sum(c.isupper() for c in span), " " in span, len(tail), tail.isalpha(),
        1900 <= values[0] <= 2100 or 1900 <= values[-1] <= 2100, all(v <= 255 for v in values), sizes.count(4), sizes.count(3),
        _class(before[-1:]), _class(after[:1]), before[-2:-1].isdigit(), after[1:2].isdigit(),
        sum(any(k in w for k in _FOR[kind]) for w in words), sum(w in _AGAINST for w in words),
        any(c in "$€£%#" for c in before[-2:] + after[:2]), "=" in before[-2:] or '"' in before[-2:],
        sum(c.isdigit() for c in before[-CONTEXT:]) + sum(c.isdigit() for c in after[:CONTEXT]),
    ]


# ---- examples -----------------------------------------------------------------------------------


def variants(span: str, kind: int) -> list[str]:
    """Other ways to write a base span."""
    digits = _only_digits(span)
    if kind == 0:
        local, host = span.rsplit("@", 1)
        spelled = [(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" AT ", " DOT "), ("(at)", "."), (" @ ", "."), ("{at}", "{dot}"), (" at ", ".")]
        return [local + a + host.replace(".", d) for a, d in spelled]
    if kind == 1:
        parts = span.split(".")
        return [s.join(parts) for s in ("[.]", "(.)", " . ", "-", "_", "[.")]
    if kind == 2:
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [s.join(fours) for s in (".", "/", "  ", " ", " - ", "_", "–")]
    rest = digits[-10:]
    a, b, c = rest[:3], rest[3:6], rest[6:]
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits[:-10]} {a} {b} {c}", f"{a} {b} {c}", f"({a}){b}-{c}", f"{a}/{b}{c}"]


def decoys(span: str, kind: int) -> list[str]:
    """What a loose pattern would also propose in the place of a base span, and should not."""
    x = int(xxhash.xxh64_hexdigest(span.encode()), 16)
    pick = lambda low, high, salt: low + (x >> salt) % (high - low)
    year, month, day, a, b = pick(1950, 2040, 0), pick(1, 13, 11), pick(1, 29, 17), pick(0, 100000, 23), pick(0, 1000, 41)
    if kind == 0:
        return [f"look at this.Then{b}", f"was at {a}.{b}", f"code @user{b}.x", "arrived at noon.The", f"{a}@{b}.{day}", f"met at {day}.{month}.{year}", "stayed at home.And"]
    if kind == 1:
        return [f"{year}-{month:02}-{day:02}-{b}", f"{b}, {a % 997}, {day}, {month}", f"{day}/{month}/{year} {b}", f"{day}:{month:02}:{day:02}.{b}", f"{b + 256}.{a % 900 + 256}.{b}.{day}", f"{month} {day} {b} {a % 999}"]
    if kind == 2:
        wrong = _only_digits(span)
        wrong = wrong[:-1] + str((int(wrong[-1:] or 0) + 1 + x % 8) % 10)
        return [wrong, f"{year}{month:02}{day:02}{a:05}{b:03}", f"{a}.{b:03}{a:05}{day:02}", f"{year}-{month:02}-{day:02} {day:02}:{month:02}:{day:02}", f"{b},{b:03},{a % 999:03},{day:03},{b:03}"]
    return [f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{b},{a % 999:03},{day:03}", f"{a}.{b:03}", f"{year}/{year + 1}", f"{a:05}{b:03}", f"{month}.{day}.{b}.{a}", f"{day:02}:{month:02}:{day:02}.{b:03}"]


@dataclass(frozen=True)
class Model:
    """Per kind: trees, the slope and offset that make their scores probabilities, and the least probability."""

    trees: tuple
    slope: tuple
    offset: tuple
    least: tuple

    def probabilities(self, kind: int, x: np.ndarray) -> np.ndarray:
        return boosting.sigmoid(self.slope[kind] * self.trees[kind].scores(x) + self.offset[kind])


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through (score, truth), by Newton steps on smoothed targets."""
    right, wrong = y.sum(), (~y).sum()
    goal = np.where(y, (right + 1) / (right + 2), 1 / (wrong + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = boosting.sigmoid(a * z + b)
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([((goal - p) * z).sum() - 1e-3 * (a - 1), (goal - p).sum()])
        curve = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(curve, gradient)
        a, b = float(np.clip(a + step[0], 1e-3, 10)), float(np.clip(b + step[1], -20, 20))
    return a, b


def _least(p: np.ndarray, y: np.ndarray) -> float:
    """The lowest probability from which on proposals are right often enough; never below one half."""
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.flatnonzero(np.diff(p[order], append=-1) < 0)  # equal probabilities stand or fall together
    good = last[share[last] >= PRECISION]
    return max(0.5, float(p[order][good[-1]])) if len(good) else 2.0


def train(rows: list[tuple[int, bool, str, str, str]]) -> Model:
    """The model of (kind, is base, before, span, after); a third of the contexts calibrates."""
    parts = []
    for kind in range(len(KINDS)):
        x, y, held = [], [], []
        for k, base, before, span, after in sorted(rows):
            if k != kind:
                continue
            forms = [(span, base)]
            if base:
                forms += [(s, True) for s in variants(span, kind)] + [(s, False) for s in decoys(span, kind)]
            third = xxhash.xxh64_intdigest(f"{before}\0{span}\0{after}".encode(errors="replace"), 7) % 3 == 0
            x += [features(before, s, after, kind) for s, _ in forms]
            y += [right for _, right in forms]
            held += [third] * len(forms)
        x, y, held = np.array(x, float), np.array(y, bool), np.array(held, bool)
        if not y[~held].any() or not y[held].any():
            parts.append((None, 1.0, 0.0, 2.0))  # nothing to learn from, or to calibrate by
            continue
        trees = boosting.fit(x[~held], y[~held])
        z = trees.scores(x[held])
        a, b = _platt(z, y[held])
        parts.append((trees, a, b, _least(boosting.sigmoid(a * z + b), y[held])))
    return Model(*zip(*parts))


def fit_model(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """Train on base spans and other proposals of the corpus, at most ``sample`` of each kind.

    Every task keeps the distinct examples of the smallest hashes, and so does the window over all.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, dict] = {}
        for batch in batches:
            for value in batch.column(0):
                found = value.as_py()
                if not found:
                    continue
                base = base_spans(found)
                others = _apart(proposals(found), base)
                for right, spans in ((True, base), (False, others)):
                    for start, kind, end in spans:
                        row = (found[max(0, start - CONTEXT) : start], found[start:end], found[end : end + CONTEXT])
                        name = xxhash.xxh64_intdigest("\0".join(row).encode(errors="replace")) >> 1
                        own = kept.setdefault((kind, right), {})
                        own[name] = row
                        if len(own) >= 2 * sample:
                            kept[kind, right] = {n: own[n] for n in heapq.nsmallest(sample, own)}
        rows = [(k, r, n, *row) for (k, r), own in kept.items() for n, row in own.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["kind", "base", "name", "before", "span", "after"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(gather, "kind long, base boolean, name long, before string, span string, after string")
    order = Window.partitionBy("kind", "base").orderBy("name")
    best = found.withColumn("at", F.dense_rank().over(order)).where(F.col("at") <= sample).distinct()
    return train([(r.kind, r.base, r.before, r.span, r.after) for r in best.collect()])  # 8 * sample at most


# ---- the scan -----------------------------------------------------------------------------------


def _apart(spans: list[tuple], base: list[tuple]) -> list[tuple]:
    """The spans that overlap no base span."""
    if not base or not spans:
        return spans
    taken = []  # disjoint intervals
    for start, _, end in base:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    starts = [a for a, _ in taken]
    at = np.searchsorted(starts, [s[2] for s in spans]) - 1  # the last interval that starts before the span's end
    return [s for s, i in zip(spans, at) if i < 0 or taken[i][1] <= s[0]]


def select(spans: list[tuple], p: np.ndarray, model: Model) -> list[tuple]:
    """The proposals above their kind's threshold, the likelier first where they overlap."""
    likely = sorted((-q, s) for q, s in zip(p, spans) if q >= model.least[s[1]])
    chosen: list[tuple] = []
    for _, s in likely:
        chosen += _apart([s], sorted(chosen))
    return sorted(chosen)


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find_pii(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns with ``spans``, by start and then kind; one row per document."""
    source = docs.select(*[c for c in keep if c != "spans"], F.coalesce(F.col(text), F.lit("")).alias("_scanned"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = T.StructType.fromDDL(f"spans {SPANS}")["spans"]
    schema = T.StructType([*source.schema.fields[:-1], kind])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            bases, loose, x = [], [], [[] for _ in KINDS]
            for value in batch.column(batch.num_columns - 1):
                found = value.as_py()
                base = base_spans(found)
                others = [s for s in _apart(proposals(found), base) if model.trees[s[1]] is not None]
                for start, kind, end in others:
                    x[kind].append(features(found[max(0, start - CONTEXT) : start], found[start:end], found[end : end + CONTEXT], kind))
                bases.append(base)
                loose.append(others)
            p = [iter(model.probabilities(k, np.array(rows, float)) if rows else ()) for k, rows in enumerate(x)]
            out = []
            for base, others in zip(bases, loose):
                added = select(others, np.array([next(p[s[1]]) for s in others]), model)
                merged = sorted([(*s, True) for s in base] + [(*s, False) for s in added])
                out.append([{"kind": KINDS[k], "start": a, "end": b, "base": is_base} for a, k, b, is_base in merged])
            columns = [*batch.columns[:-1], pa.array(out, arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return source.mapInArrow(scan, schema)


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: str, spans: list) -> str:
    """``text`` with every span, or run of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def redacted(found: DataFrame, text: str = "text", target: str = "redacted") -> DataFrame:
    """``found``, which holds ``text`` and ``spans``, with the text redacted; null stays null."""
    schema = T.StructType([*[f for f in found.schema.fields if f.name != target], T.StructField(target, T.StringType())])
    names = [n for n in schema.names if n != target]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(names.index(text)).to_pylist(), batch.column(names.index("spans")).to_pylist()
            new = [None if t is None else redact(t, s or []) for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*names, target])

    return found.select(*names).mapInArrow(apply, schema)
