"""Secret scans: patterns, and the Shannon entropy of sliding windows over candidate strings.

Patterns (the base): assignments to names such as `password`, access keys, long hexadecimal runs; leftmost matches of
each kind that don't overlap, those too short dropped afterwards.

Windows (the method): a candidate is a maximal run of key characters, `MIN_RUN` at least. A window of `WINDOW`
characters moves over it; one count goes up and one down for each step, for characters and for
character classes, and the sum of c log2 c follows from the two counts that changed (in whole numbers,
so that no rounding adds up). A window belongs to the narrowest class that holds its characters; it
is a secret where its entropy reaches the threshold of that class. Plain words, plain numbers and CamelCase have classes that
no window of theirs reaches. Windows that overlap make one span.

The allow-list suppresses what is known to be none: UUIDs, integrity digests, alphabets written out, placeholders, and paths of
words. It never removes a match of a pattern; a span inside such a match isn't added again.

Defined cases: a null text is empty, without spans; null and repeated ids are carried as they are; ties of starts are ordered by
kind; a text of any length is scanned whole, in memory that grows with the text and its spans; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from framewright.llm import common

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # maximal runs
MIN_VALUE, MIN_ACCESS = 6, 20
MIN_RUN = WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Classes from narrow to wide, and the entropy in bits that a window needs (None: never a secret).
THRESHOLDS = {"digits": None, "letters": None, "hexadecimal": 3.0, "base36": 3.5, "base62": 3.75, "base64": 3.85}
BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + tuple(f"entropy_{c}" for c, t in THRESHOLDS.items() if t)
#: Candidates that match one of these whole, in either case, are no secrets.
ALLOWED = (
    r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",  # UUID
    r"sha(?:1|256|384|512)-.*",  # integrity digest
    r".*(?:example|placeholder|changeme|xxxxx|00000|12345678).*",
    r"/?(?:[a-z]++[0-9]{0,3}+(?:[_-][a-z0-9]{1,12}+)*+/)+[a-z]++[0-9]{0,3}+(?:[_-][a-z0-9]{1,12}+)*+/?",  # path of words; possessive, so without backtracking
)
_ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")
SCALE = 1 << 32
WEIGHT = [0] + [round(c * math.log2(c) * SCALE) for c in range(1, WINDOW + 1)]
#: The sum of c log2 c may be this at most: H = log2(WINDOW) - sum / WINDOW.
LIMIT = {c: None if t is None else math.floor((math.log2(WINDOW) - t) * WINDOW * SCALE) for c, t in THRESHOLDS.items()}
_GROUP = {c: g for g, chars in enumerate(("0123456789", "abcdef", "ABCDEF", "ghijklmnopqrstuvwxyz", "GHIJKLMNOPQRSTUVWXYZ", "+/_=-")) for c in chars}


def window_class(groups: Sequence[int]) -> str:
    """The narrowest class; groups: how many digits, a-f, A-F, g-z, G-Z and other characters a window has."""
    digits, low_hex, high_hex, low, high, other = groups
    lower, upper = low_hex + low, high_hex + high
    if not lower and not upper:
        return "digits"
    if not digits:
        return "letters"
    if not (low or high or other) and not (low_hex and high_hex):
        return "hexadecimal"
    if not other:
        return "base62" if lower and upper else "base36"
    return "base64"


def entropy_spans(run: str) -> list[tuple[int, int, str]]:
    """(start, end, class) of the windows of a run that reach their thresholds, overlapping ones made one of the widest class."""
    counts: dict[str, int] = {}
    groups, total, spans = [0] * 6, 0, []
    order = list(THRESHOLDS)
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        if i >= WINDOW:
            gone = run[i - WINDOW]
            if gone != c:
                m = counts[gone]
                total += WEIGHT[m - 1] - WEIGHT[m] + WEIGHT[n + 1] - WEIGHT[n]
                counts[gone], counts[c] = m - 1, n + 1
                groups[_GROUP[gone]] -= 1
                groups[_GROUP[c]] += 1
        else:
            total += WEIGHT[n + 1] - WEIGHT[n]
            counts[c] = n + 1
            groups[_GROUP[c]] += 1
        if i < WINDOW - 1:
            continue
        name = window_class(groups)
        limit = LIMIT[name]
        if limit is not None and total <= limit:
            start = i - WINDOW + 1
            if spans and start < spans[-1][1]:
                first, _, before = spans[-1]
                spans[-1] = (first, i + 1, max(before, name, key=order.index))
            else:
                spans.append((start, i + 1, name))
    return spans


def _written_out(text: str) -> bool:
    """Whether some seven characters in a row are those of an alphabet in its order."""
    return any(text[i:i + 7] in alphabet for alphabet in _ALPHABETS for i in range(len(text) - 6))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    low = text.lower()
    assign = [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE] if any(n in low for n in NAMES) else []
    access = [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS] if "AKIA" in text else []
    return {"assign": assign, "access": access, "hex": [m.span() for m in HEX.finditer(text)]}


def secrets_of(text: str, allowed: re.Pattern) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[int, int, str]]]:
    """Base spans by kind, and the method's (start, end, kind)."""
    base = base_spans(text)
    known = sorted(s for spans in base.values() for s in spans)
    added: list[tuple[int, int, str]] = []
    at, reach = 0, -1  # the base spans that begin before a span's end, and how far they reach
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if run.isalpha() or run.isdigit() or allowed.fullmatch(run):
            continue
        for start, end, name in entropy_spans(run):
            if _written_out(run[start:end]):
                continue
            start, end = start + m.start(), end + m.start()
            while at < len(known) and known[at][0] <= start:
                reach, at = max(reach, known[at][1]), at + 1
            if end > reach:
                added.append((start, end, f"entropy_{name}"))
    return base, added


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """`RESULT` of every row of `docs` (doc_id, text); `spans` has `kind:start:end` in code points, by start."""
    common.ship(docs.sparkSession)
    pattern = "|".join(f"(?:{p})" for p in allowed) or r"(?!)"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = re.compile(pattern, re.IGNORECASE | re.DOTALL)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text in batch.column(1):
                base, added = secrets_of(text.as_py() or "", known)
                plain = [(a, b, k) for k in BASE_KINDS for a, b in base[k]]
                row = (*(len(base[k]) for k in BASE_KINDS), hashlib.sha256(_joined(plain).encode()).hexdigest(), _joined(plain + added))
                for column, value in zip(out, row):
                    column.append(value)
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, types))], [c.split()[0] for c in RESULT.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
