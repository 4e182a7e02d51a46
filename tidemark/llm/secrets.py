"""Secret scans with multipart credential linking.

Strong findings (assignments, access identifiers, long hexadecimal runs) are reported as they
are. Many credentials only matter in parts: an identifier, a secret and an endpoint. Weak
candidates for each part are found too, joined by position within scopes of a text, and
reported only where complementary parts meet.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.arrays import python_ready, text_chunks
from tidemark.llm.columns import folded, unfolded

SCOPE = 400
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")

# The base patterns and the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

IDENTIFIER = re.compile(
    r"""(?:access_?key(?:_?id)?|key_?id|client_?id|account|user(?:name)?|login)["']?[\x20\t]*[:=][\x20\t]*["']?[A-Za-z0-9_.@-]{3,}""",
    re.IGNORECASE | re.ASCII,
)
SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(
    r"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{3,}|(?:endpoint|host(?:name)?|server)["']?[\x20\t]*[:=][\x20\t]*["']?[A-Za-z0-9.-]{3,}(?::[0-9]{1,5})?""",
    re.IGNORECASE | re.ASCII,
)
IDENTIFIER_WORDS = ("key", "client", "account", "user", "login")
ENDPOINT_WORDS = ("://", "endpoint", "host", "server")
Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str, low: str) -> list[Span]:
    """Strong findings; ``low`` is the text in lower case, used to pass over texts without any."""
    found: list[Span] = []
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return found


def _made(token: str) -> tuple[bool, bool]:
    """Whether a run looks made by a machine, with digits and letters, and whether these have both cases."""
    digit, small, large = (any(a <= c <= z for c in token) for a, z in ("09", "az", "AZ"))
    return digit and (small or large), small and large


def _apart(found: list[Span], taken: list[Span]) -> list[Span]:
    """Those of ``found`` that overlap none of ``taken``."""
    if not found or not taken:
        return found
    held = sorted(taken)
    starts, ends = np.array([s[0] for s in held]), np.maximum.accumulate([s[2] for s in held])
    at = np.searchsorted(starts, [f[2] for f in found]) - 1  # the last one that starts before its end
    return [f for f, k in zip(found, at.tolist(), strict=True) if k < 0 or ends[k] <= f[0]]


def weak_spans(text: str, low: str, taken: list[Span], runs: bool) -> list[Span]:
    """Candidates for parts that stand apart from all strong findings; ``runs``: long runs exist.

    A run of one case is a secret only apart from identifiers and endpoints, of whose names,
    values and paths it would be a piece.
    """
    found: list[Span] = []
    if any(w in low for w in IDENTIFIER_WORDS):
        found += [(m.start(), 3, m.end()) for m in IDENTIFIER.finditer(text)]
    if any(w in low for w in ENDPOINT_WORDS):
        found += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    if runs:
        secrets = [((m.start(), 4, m.end()), *_made(m[0])) for m in SECRET.finditer(text)]
        plain = _apart([s for s, made, both in secrets if made and not both], found)
        found += [s for s, made, both in secrets if made and both] + plain
    return _apart(found, taken)


def linked(strong: list[Span], weak: list[Span], scope: int) -> list[Span]:
    """Weak parts with a complementary part in scope: an interval join on sorted positions.

    Two spans are in scope if at most ``scope`` characters lie between them. An identifier or an
    endpoint needs a secret (a weak one, an assignment or a hexadecimal run); a weak secret
    needs an identifier (a weak one or an access identifier) or an endpoint.
    """
    parts = strong + weak
    secrets = [s for s in parts if s[1] in (0, 2, 4)]
    others = [s for s in parts if s[1] in (1, 3, 5)]

    def near(spans: list[Span], among: list[Span]) -> list[Span]:
        if not spans or not among:
            return []
        among = sorted(among)
        start = np.array([s[0] for s in among])
        reach = np.maximum.accumulate([s[2] for s in among])
        last = np.searchsorted(start, [s[2] + scope for s in spans], "right") - 1  # starts in scope
        return [s for s, k in zip(spans, last.tolist(), strict=True) if k >= 0 and reach[k] >= s[0] - scope]

    return near([s for s in weak if s[1] == 4], others) + near([s for s in weak if s[1] != 4], secrets)


def _digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _long_runs(data: np.ndarray, bounds: np.ndarray, allowed: np.ndarray, least: int) -> np.ndarray:
    """Which rows hold a run of at least ``least`` allowed bytes."""
    inside = np.concatenate(([False], allowed[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    long = edges[::2][edges[1::2] - edges[::2] >= least]
    ends = edges[1::2][edges[1::2] - edges[::2] >= least]
    out = np.zeros(len(bounds) - 1, bool)
    # a run may cross rows; marking all it touches only costs a look at them
    first, last = np.searchsorted(bounds, long, "right") - 1, np.searchsorted(bounds, ends, "left") - 1
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        out[a : b + 1] = True
    return out


def _allowed(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


_HEX = _allowed("0123456789abcdef")
_TOKEN = _allowed("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_sha256 and spans.

    ``docs`` needs text; other columns pass through, but for those that bear one of the five
    names. A span is ``kind:start:end`` in code points, end exclusive; ``spans`` lists all by
    start, then kind in the order of ``KINDS``, joined by commas; ``base_sha256`` is the hash of
    the strong ones alone. Weak candidates that touch a strong finding are that finding's. All
    of a text is scanned, however long; parts are linked within a text only, so no rows meet.
    Null and empty texts have no spans. Repeated rows are scanned each for itself. An empty
    table gives an empty table.
    """
    python_ready(docs.sparkSession)
    new = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    given, docs = docs, folded(docs, ["text"], new)
    kinds = [T.LongType()] * 3 + [T.StringType()] * 2
    schema = T.StructType(docs.schema.fields + [T.StructField(n, k) for n, k in zip(new, kinds, strict=True)])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros((3, batch.num_rows), np.int64)
            sums, lists = [], []
            for first, end, data, bounds in text_chunks(batch.column("text")):
                hexes, tokens = _long_runs(data, bounds, _HEX, LEAST["hex"]), _long_runs(data, bounds, _TOKEN, 20)
                raw = data.tobytes()
                for row in range(end - first):
                    text = raw[bounds[row] : bounds[row + 1]].decode()
                    low = text.lower()
                    strong = base_spans(text, low)
                    if hexes[row]:
                        strong += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
                    weak = weak_spans(text, low, strong, bool(tokens[row]))
                    for span in strong:
                        counts[span[1], first + row] += 1
                    sums.append(hashlib.sha256(_digest(strong).encode()).hexdigest())
                    lists.append(_digest(strong + (linked(strong, weak, scope) if weak else [])))
            more = [pa.array(c) for c in counts] + [pa.array(sums, pa.string()), pa.array(lists, pa.string())]
            yield pa.RecordBatch.from_arrays(batch.columns + more, batch.schema.names + new)

    return docs.mapInArrow(look, schema).select(*unfolded(given, ["text"], new), *new)
