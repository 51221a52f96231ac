"""Secret scans: fixed forms, and sliding-window entropy per character class.

Base spans are the leftmost non-overlapping matches of three forms (an assignment to
a name such as ``token``, an access key, a run of hex digits), kept from a least
length on. The entropy scan adds spans: a candidate is a run of at least ``WINDOW``
characters of the base64 or URL-safe alphabet; inside it, for each character class,
a window slides over every stretch of that class. Symbol counts change by one symbol
in and one out, and with them the sum of c * log2(c), so each step costs constant
time. A window counts as random where its entropy, and its number of changes between capitals,
small letters and digits, reach what all but ``MISSED`` of random windows of the class's
alphabet reach; such windows are joined into spans. What is on the allow-list (UUIDs, dates, running alphabets, hosts and
paths of links but not their user info and query, parts between = or / with a name that
says placeholder, names joined of words) and spans inside a base span are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm.common import importable, map_arrow, table, text_udf

KINDS = ("assign", "access", "hex", "entropy")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# greedy runs of one class: the least length can stand in the pattern
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
DIGITS = frozenset("0123456789")
PLACEHOLDER = re.compile("example|sample|placeholder|changeme|dummy|redacted|x{4,}", re.IGNORECASE | re.ASCII)
# at the edge of a word: a name, not chance
NAMED = re.compile(rf"(?<![A-Za-z0-9])(?:{PLACEHOLDER.pattern})|(?:{PLACEHOLDER.pattern})(?![A-Za-z0-9])", re.IGNORECASE | re.ASCII)
PART = re.compile(r"[^/=]+")
LINK_END = re.compile(r"""[\s"'`<>(){}\[\]|\\^,;?#&]|://""")
PORT = re.compile(r"[^:]*(:\d*)?$|\[")
RUNNING = "abcdefghijklmnopqrstuvwxyz0123456789abcdefghijklmnopqrstuvwxyz"
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"[-_/=+]*(\d{1,4}[-_/])+\d[\dTZ_/+-]*"),  # dates and numbers
    re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)(?:[-_/+=](?:[A-Z]?[a-z]+|[A-Z]+))*[-_/+=]*\d{0,4}"),  # words, at most a number behind
)

# Joined names (someNameOfAThing): words with a vowel, a capital at most in front, that fill so much of a span.
NAME_PART = re.compile(r"(?=[A-Z]?[a-z]*[aeiouy]|[AEIOU])[A-Z]?[a-z]{2,}")
NAMED_SHARE = 0.75


@dataclass(frozen=True)
class CharClass:
    """Stretches of one class of characters, and its alphabet."""

    run: re.Pattern
    alphabet: str
    # whether names of words with capitals in between look like it
    names: bool = False


UPPER, LOWER, NUMBERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
CLASSES = (
    CharClass(re.compile(r"[0-9a-f]{%d,}|[0-9A-F]{%d,}|[0-9a-fA-F]{%d,}" % (WINDOW, WINDOW, WINDOW)), NUMBERS + "abcdef"),
    CharClass(re.compile(r"[A-Z0-9]{%d,}|[a-z0-9]{%d,}" % (WINDOW, WINDOW)), NUMBERS + LOWER),
    CharClass(re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW), UPPER + LOWER + NUMBERS, True),
    CharClass(re.compile(r"[A-Za-z]{%d,}" % WINDOW), UPPER + LOWER, True),
)
C_LOG_C = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
# Share of random windows that may fall short of each of the two levels of their class.
MISSED = 0.01
KIND = {c: k for k, group in enumerate((LOWER, UPPER, NUMBERS)) for c in group}


def levels(alphabet: str, missed: float = MISSED, draws: int = 20_000) -> tuple[float, int]:
    """(most sum of c * log2(c), least changes between capitals, small letters and digits) of all but ``missed`` of random windows.

    Found by seeded draws from the alphabet, so the levels follow from its size and make-up and from the
    rate of misses alone.
    """
    rng = np.random.default_rng(17)
    drawn = rng.integers(0, len(alphabet), (draws, WINDOW))
    counts = np.stack([(drawn == i).sum(axis=1) for i in range(len(alphabet))], axis=1)
    sums = np.array(C_LOG_C)[counts].sum(axis=1)
    kinds = np.array([KIND[c] for c in alphabet])[drawn]
    changes = (kinds[:, 1:] != kinds[:, :-1]).sum(axis=1)
    return float(np.quantile(sums, 1 - missed)) + 1e-9, int(np.quantile(changes, missed))


LEVELS = [levels(kind.alphabet) for kind in CLASSES]


def high_windows(s: str, most: float, least: int) -> list[tuple[int, int]]:
    """Joined windows of ``s`` whose sum of c * log2(c) is at most ``most`` (so their entropy high) with at least ``least`` changes of kind."""
    counts: dict[str, int] = {}
    total, changes, spans = 0.0, 0, []
    kinds = [KIND.get(c, 3) for c in s]
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += C_LOG_C[n + 1] - C_LOG_C[n]
        counts[c] = n + 1
        changes += i > 0 and kinds[i] != kinds[i - 1]
        if i < WINDOW - 1:
            continue
        start = i - WINDOW + 1
        if total <= most and changes >= least:
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
        out = s[start]
        n = counts[out]
        total += C_LOG_C[n - 1] - C_LOG_C[n]
        counts[out] = n - 1
        changes -= kinds[start] != kinds[start + 1]
    return spans


def link_parts(text: str) -> list[tuple[int, int]]:
    """Hosts and paths of the links in ``text``, with the slashes in front.

    A link ends at white space, quotes, commas, brackets and the like. User info, query
    and fragment are no part of it, nor is what follows an ``@`` in the path: they hold keys.
    """
    parts, at = [], text.find("://")
    while at >= 0:
        start = at + 3
        found = LINK_END.search(text, start)
        end = found.start() if found else len(text)
        slash = text.find("/", start, end)
        slash = end if slash < 0 else slash
        user = text.rfind("@", start, slash)
        if user < 0 and not PORT.match(text[start:slash]):
            user = text.find("@", slash, end)  # a password with a slash
        start = max(start, user + 1)
        sign = text.find("@", start, end)
        parts += [(at + 1, at + 3), (start, end if sign < 0 else sign)]
        at = text.find("://", end)
    return parts


def blanks(s: str) -> list[tuple[int, int]]:
    """Stretches of a candidate that are known to be no key; what = or / joins to them is judged by itself.

    A part between = or / that is a UUID or date, or has a placeholder name at the edge of
    a word; a placeholder amid other letters; a running alphabet.
    """
    found = []
    for m in PART.finditer(s):
        if any(p.fullmatch(m.group()) for p in ALLOWED[:2]) or NAMED.search(m.group()):
            found.append(m.span())
    found += [m.span() for m in PLACEHOLDER.finditer(s)]
    low = s.lower()
    found += [(i, i + 8) for i in range(len(low) - 7) if low[i:i + 8] in RUNNING]
    return sorted(found)


def without(start: int, end: int, gaps: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the sorted ``gaps`` leave of a stretch."""
    left = []
    for a, b in gaps:
        if b <= start:
            continue
        if a >= end:
            break
        left.append((start, a))
        start = b
    return [(a, b) for a, b in [*left, (start, end)] if b - a >= WINDOW]


def random_spans(s: str) -> list[tuple[int, int]]:
    """Windows of ``s`` that count as random in one of the classes."""
    if len(s) < WINDOW or s.islower() and s.isalpha() or s.isdigit() or any(p.fullmatch(s) for p in ALLOWED):
        return []
    found = [(run.start() + a, run.start() + b, kind) for kind, level in zip(CLASSES, LEVELS) for run in kind.run.finditer(s) for a, b in high_windows(run.group(), *level)]
    return [(a, b) for a, b, kind in found if not kind.names or sum(map(len, NAME_PART.findall(s, a, b))) < NAMED_SHARE * (b - a)]


def entropy_spans(text: str) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    links, ends = None, []
    for m in CANDIDATE.finditer(text):
        if m.group().isalpha() and (m.group()[1:].islower() or m.group().isupper()) or m.group().isdigit():
            continue
        if links is None:
            links = link_parts(text)
            ends = [b for _, b in links]
        near = links[bisect_right(ends, m.start()):bisect_right(ends, m.end()) + 1]
        for a, b in without(m.start(), m.end(), near):
            s = text[a:b]
            spans = random_spans(s)
            if spans and (gaps := blanks(s)):
                spans = [(x + i, x + j) for x, y in without(0, len(s), gaps) for i, j in random_spans(s[x:y])]
            found += [(a + i, a + j) for i, j in spans]
    joined: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if joined and a <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    return joined


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, sorted."""
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    low = text.lower()
    if any(n in low for n in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    return sorted(found)


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans, of one text (null: empty)."""
    text = text or ""
    base = base_spans(text)
    more = [(a, 3, b) for a, b in entropy_spans(text) if not any(x <= a and b <= y for x, _, y in base)]
    return base, sorted(base + more)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts per kind, base digest and all spans (code points, end exclusive) of every row.

    One pass, no shuffle; a null or empty text has no spans, repeated rows give equal
    rows, texts are scanned whole, columns other than doc_id and text are ignored.
    """
    def scanned(batch: pa.RecordBatch) -> dict:
        rows = [scan(t) for t in batch.column("text").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            **{f"n_{kind}": [sum(x[1] == k for x in every) for _, every in rows] for k, kind in enumerate(KINDS)},
            "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows],
            "spans": [joined(every) for _, every in rows],
        }

    return map_arrow(
        docs.select("doc_id", "text"), scanned,
        "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string")


def redact(text: str | None, mark: str) -> str | None:
    """``text`` with every span replaced by ``mark``; touching and overlapping spans become one."""
    spans = scan(text)[1]
    if not spans:
        return text
    out, at, end = [], 0, -1
    for a, _, b in spans:
        if a > end:
            out += [text[at:a], mark]
        end = at = max(at, b)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets in ``text_col`` replaced by ``mark``; a null text stays null.

    Repeated rows get equal texts, a text of any length is read whole, other columns stay as they
    are, and an empty table gives an empty one.
    """
    importable(docs.sparkSession)

    def clean(text: pd.Series) -> pd.Series:
        return pd.Series([redact(t, mark) for t in text], dtype=object)

    return docs.withColumn(text_col, text_udf(clean, "string")(F.col(text_col)))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
