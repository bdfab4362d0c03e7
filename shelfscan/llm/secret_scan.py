"""Secrets in texts: fixed kinds, and weak candidates linked with their other part.

An access identifier, a secret or an endpoint that is too weak to report alone is reported when
its counterpart stands in the same scope. Scopes are stretches of text around each part inside a
paragraph; the parts are joined by a sweep over their intervals, sorted by start.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
import hashlib
from itertools import accumulate
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import arrow_pass

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

IDENTIFIER = re.compile(
    r"""\b(?:A[KS]IA[A-Z0-9]{8,}|(?:access_?key(?:_?id)?|client_?id|account_?id|user(?:name)?)"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{4,}|"""
    r"""(?i:account_?name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]+)""")
#: May stand right after "=", as in key=value; the key itself is followed by more and no secret.
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""\b[a-z][a-z0-9+.-]{1,20}://[^\s"'<>()]{4,}""")
PARAGRAPH = re.compile(r"\n\s*\n")

#: Code points on either side of a part that belong to its scope.
SCOPE = 240
#: Bits per character of a weak secret, at least.
MIN_ENTROPY = 3.3

FOUND = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
         "spans string")

Span = tuple[int, int, int]  # start, kind number, end


def base_spans(text: str) -> list[Span]:
    """The fixed kinds, in order of start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_looking(token: str) -> bool:
    if not (re.search("[0-9]", token) and re.search("[A-Za-z]", token)):
        return False
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values()) >= MIN_ENTROPY


def near(parts: list[tuple[int, int]], others: list[tuple[int, int]],
         walls: list[int]) -> list[bool]:
    """Which parts have one of the others in their scope. Both are sorted by start."""
    reach, far = [], -1  # the furthest end of the others up to each
    for begin, end in others:
        far = max(far, end)
        reach.append(far)
    begins = [begin for begin, _ in others]
    found = []
    for begin, end in parts:
        wall = bisect_left(walls, begin + 1)
        low = max(begin - SCOPE, walls[wall - 1] if wall else 0)
        high = min(end + SCOPE, walls[wall] if wall < len(walls) else end + SCOPE)
        last = bisect_left(begins, high) - 1
        found.append(last >= 0 and reach[last] > low)
    return found


def apart(spans: list[tuple[int, int]],
          others: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none of the others, which are sorted by start."""
    begins = [begin for begin, _ in others]
    reach = list(accumulate((end for _, end in others), max))
    found = []
    for begin, end in spans:
        last = bisect_left(begins, end) - 1
        if last < 0 or reach[last] <= begin:
            found.append((begin, end))
    return found


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates whose complementary parts stand in one scope."""
    taken = [(start, end) for start, _, end in base]

    def weak(pattern, test=None):
        return apart([m.span() for m in pattern.finditer(text)
                      if test is None or test(m.group())], taken)

    identifiers = weak(IDENTIFIER)
    endpoints = weak(ENDPOINT) if "://" in text else []
    strong_identifiers = [(s, e) for s, kind, e in base if kind == 1]
    if not (identifiers or endpoints or strong_identifiers):
        return []
    secrets = apart(weak(SECRET, random_looking), sorted(identifiers + endpoints))
    all_identifiers = sorted(identifiers + strong_identifiers)
    all_secrets = sorted(secrets + [(s, e) for s, kind, e in base if kind != 1])
    walls = [m.end() for m in PARAGRAPH.finditer(text)]
    keep = [(s, 3, e) for (s, e), hit in zip(identifiers, near(identifiers, all_secrets, walls))
            if hit]
    by_name = near(secrets, all_identifiers, walls)
    by_place = near(secrets, endpoints, walls)
    keep += [(s, 4, e) for (s, e), a, b in zip(secrets, by_name, by_place) if a or b]
    by_name = near(endpoints, all_identifiers, walls)
    by_secret = near(endpoints, all_secrets, walls)
    keep += [(s, 5, e) for (s, e), a, b in zip(endpoints, by_name, by_secret) if a and b]
    return keep


def secret_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    return base, sorted(base + linked_spans(text, base))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Counts and spans per row of ``docs``.

    Null text counts as empty; a null ``doc_id`` stays null; repeated rows give repeated rows;
    extra columns are ignored; an empty table gives an empty table.
    """

    def make():
        def step(columns):
            rows = []
            for doc_id, text in zip(*columns):
                base, spans = secret_spans(text or "")
                kinds = Counter(kind for _, kind, _ in base)
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((doc_id, kinds[0], kinds[1], kinds[2], digest, listed(spans)))
            return list(zip(*rows)) if rows else [[]] * 6

        return step

    return arrow_pass(docs.select("doc_id", "text"), FOUND, make)


def redacted(text: str) -> str:
    """The text with every span, overlapping ones merged, replaced by its kind in brackets."""
    out, at = [], 0
    for start, kind, end in secret_spans(text)[1]:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if at else text


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``n_chars`` set anew; all rows stay."""
    return rewritten(docs, lambda: lambda texts: [text and redacted(text) for text in texts])


def rewritten(docs: DataFrame, make) -> DataFrame:
    """``docs`` with ``text`` mapped by the function of a list that ``make`` returns in each task.

    A changed text gets its ``n_chars`` anew; other rows and columns stay as they are.
    """
    columns = docs.columns
    text_at = columns.index("text")
    count_at = columns.index("n_chars") if "n_chars" in columns else None

    def once():
        change = make()

        def step(values):
            old = values[text_at]
            new = change(old)
            values[text_at] = new
            if count_at is not None:
                values[count_at] = [n if a == b else len(b)
                                    for a, b, n in zip(old, new, values[count_at])]
            return values

        return step

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return arrow_pass(docs.select(*[F.col(f"`{c}`") for c in columns]), schema, once)
