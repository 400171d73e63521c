"""Secrets in texts: single spans by their form, and weak ones by the parts that occur with them.

A lone token or password-like word says little, and neither does a user name or an address. They
are reported only together: parts are joined with the scopes they lie in, and a weak part counts if
its scope also holds parts that complete it: a secret an identifier or an endpoint, an identifier or
endpoint a secret. A scope is the text between blank lines, however long; the section of a
configuration file, from a line like [name] to the next one, and a fenced block of code are
scopes as a whole, blank lines included.

Every pattern goes over a text once: mail addresses and links are found by their @ and :// and then
extended to both sides.

Edge cases: a null or empty text has no spans. Spans of one kind never overlap; spans of different
kinds may. Repeated rows each get their row. An empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcohorts.llm.common import map_texts, text_of

#: The kinds with a form of their own, in their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20

#: Kinds that the linking adds, after the fixed ones.
KINDS = ("assign", "access", "hex", "secret", "identifier", "endpoint")
BASE_KINDS = KINDS[:3]

#: Weak parts.
_WEAK_VALUE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}(?![A-Za-z0-9+/_=-])", re.ASCII)
_WEAK_PASS = re.compile(r"""\b(?:pass|pwd|pin|auth|bearer|private_?key)["']?\x20*+(?:[:=]\x20*+)?["']?([^\s"',;]{4,})""", re.IGNORECASE | re.ASCII)
_IDENTIFIER = re.compile(
    r"""\b(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
_NAME_BACKWARDS = re.compile(r"[A-Za-z0-9._%+-]+", re.ASCII)
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.ASCII)
_SCHEME_BACKWARDS = re.compile(r"[a-z0-9+.-]+", re.IGNORECASE | re.ASCII)
_SCHEME_START = re.compile(r"\b[a-z]", re.IGNORECASE | re.ASCII)
_REST_OF_LINK = re.compile(r"""[^\s"'<>]+""")
_ADDRESS = re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{2,5})?(?![0-9.])", re.ASCII)

#: Bits for each character of a weak token.
LEAST_ENTROPY = 3.0

#: Beginnings of scopes: blank lines, lines like [name], and fences of code.
_BORDER = re.compile(r"^(?:[^\S\n]*$|\[[^\[\]\n]{1,80}\][^\S\n]*$|(?:```|~~~).*$)", re.MULTILINE)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_WEAK_WORDS = re.compile(r"pass|pwd|pin|auth|bearer|private|user|login|account|client|access", re.IGNORECASE | re.ASCII)

Span = tuple[str, int, int]


def _entropy(token: str) -> float:
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())


def base_spans(text: str) -> list[Span]:
    """Spans that need no other part."""
    spans: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in _ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: a name before each @, which begins after the one before, and a domain with a dot."""
    done, at = 0, text.find("@")
    while at >= 0:
        name = _NAME_BACKWARDS.match(text[done:at][::-1])
        domain = name and _DOMAIN.match(text, at + 1)
        if domain:
            yield at - name.end(), domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _links(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost links: from a letter at the beginning of a word before each :// up to white space, a quote or an angle."""
    done, at = 0, text.find("://")
    while at >= 0:
        scheme = _SCHEME_BACKWARDS.match(text[done:at][::-1])
        start = scheme and _SCHEME_START.search(text, at - scheme.end(), at)
        rest = start and _REST_OF_LINK.match(text, at + 3)
        if rest:
            yield start.start(), rest.end()
        done = rest.end() if rest else at + 3
        at = text.find("://", done)


def weak_spans(text: str) -> list[Span]:
    """Parts that say little by themselves."""
    spans: list[Span] = []
    spans += [("identifier", *span) for span in _mails(text)]
    spans += [("endpoint", *span) for span in _links(text)]
    spans += [("endpoint", *m.span()) for m in _ADDRESS.finditer(text)]
    if _WEAK_WORDS.search(text):
        spans += [("identifier", *m.span(1)) for m in _IDENTIFIER.finditer(text)]
        spans += [("secret", *m.span(1)) for m in _WEAK_PASS.finditer(text)]
    spans += [("secret", *m.span()) for m in _WEAK_VALUE.finditer(text) if _entropy(m[0]) >= LEAST_ENTROPY]
    return _without_overlaps(spans)


def _without_overlaps(spans: list[Span]) -> list[Span]:
    """Leftmost, then longest, of the overlapping spans of each kind."""
    kept, reached = [], dict.fromkeys(KINDS, -1)
    for kind, start, end in sorted(set(spans), key=lambda s: (s[1], -s[2])):
        if start >= reached[kind]:
            kept.append((kind, start, end))
            reached[kind] = end
    return kept


#: What completes a part of each kind.
_COMPLETED_BY = {
    "secret": ("access", "identifier", "endpoint"),
    "identifier": ("assign", "hex", "secret"),
    "endpoint": ("assign", "hex", "secret"),
}


def scopes(text: str) -> list[int]:
    """Where scopes begin, but for the first.

    A blank line begins a scope unless a section or a fence is open; those begin scopes and end at the next
    section, or at the closing fence.
    """
    starts, section, fence = [], False, ""
    for border in _BORDER.finditer(text):
        line = border[0].strip()
        if fence:
            if line.startswith(fence):
                fence, section = "", False
                starts.append(border.end())
        elif line[:3] in ("```", "~~~"):
            fence = line[:3]
            starts.append(border.start())
        elif line:
            section = True
            starts.append(border.start())
        elif not section:
            starts.append(border.end())
    return starts


def linked(text: str, base: list[Span], weak: list[Span]) -> list[Span]:
    """Weak parts with a part that completes them in the scope they begin in: a join of sorted intervals."""
    weak = _outside(weak, base)
    if not weak:
        return []
    starts = scopes(text)
    kinds: dict[int, set[str]] = {}
    for kind, start, _ in [*base, *weak]:
        kinds.setdefault(bisect_right(starts, start), set()).add(kind)
    return [
        span for span in weak if not kinds[bisect_right(starts, span[1])].isdisjoint(_COMPLETED_BY[span[0]])
    ]


def _outside(weak: list[Span], base: list[Span]) -> list[Span]:
    """Weak parts that do not overlap a base span."""
    taken = sorted((start, end) for _, start, end in base)
    reach = list(accumulate((end for _, end in taken), max))
    starts = [start for start, _ in taken]

    def free(span: Span) -> bool:
        before = bisect_left(starts, span[2])
        return not before or reach[before - 1] <= span[1]

    return [span for span in weak if free(span)]


def scan_text(text: str) -> list[Span]:
    """All spans by start, then by kind as listed."""
    base = base_spans(text)
    spans = base + linked(text, base, weak_spans(text))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of every document, and `spans`: array of (kind, start, end) in code points."""

    def work(part: pa.RecordBatch) -> dict:
        found = [
            [{"kind": kind, "start": start, "end": end} for kind, start, end in scan_text(text)]
            for text in part.column("text").to_pylist()
        ]
        return {name: part.column(name) for name in keep} | {"spans": found}

    kinds = ", ".join(f"{name} {documents.schema[name].dataType.simpleString()}" for name in keep)
    rows = documents.select(*[name for name in keep if name != "text"], text_of().alias("text"))
    return map_texts(rows, work, f"{kinds}, spans array<struct<kind: string, start: long, end: long>>")


def _joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", each)


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of the fixed kinds, base_sha256 and all spans as a string."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return scanned.select(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


MASK = "[SECRET]"


def redact_text(text: str) -> str:
    """The text with every span replaced; spans that overlap become one mask."""
    pieces, at = [], 0
    for _, start, end in scan_text(text):
        if start >= at:
            pieces += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def redact(documents: DataFrame) -> DataFrame:
    """The documents, all columns kept, with masked secrets; n_chars follows the text if there."""
    names = documents.columns

    def work(part: pa.RecordBatch) -> dict:
        texts = [None if text is None else redact_text(text) for text in part.column("text").to_pylist()]
        return {name: part.column(name) for name in names} | {"text": texts}

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    masked = map_texts(documents, work, kinds)
    return masked.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)) if "n_chars" in names else masked
