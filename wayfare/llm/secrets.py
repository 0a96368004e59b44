"""Operator 4: secrets by pattern, and credential values rated by what it costs to guess them.

The base patterns find assignments, access keys and hex strings. Values that stand in a wider
credential context are segmented at least cost into common words, dates, repeats, keyboard walks
and brute-force characters (dynamic programming, costs in bits, linear in the value's length);
those that cost at least ``min_bits`` are added as ``guess`` spans unless a base span covers them
whole; where it breaks off at a sign, the ``guess`` span has all of the value. After "password is" and
the like, and after a bare "bearer", a common word of prose is no value.

Null and empty texts have no spans. Spans are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import DataFrame

from .common import id_text, map_texts

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
HINTS = ("password", "passwd", "secret", "token", "api")
CONTEXT = re.compile(
    r"""(?:
    (?P<base>password|passwd|secret|token|api_?key)
    | (?<![A-Za-z])(?:pwd|passphrase|passcode|pass|credentials?|bearer|auth_?key|access_?key|private_?key|client_?key|login_?key)
    )(?![A-Za-z])["']?\x20*(?:[:=]|(?P<is>\x20is\x20))\x20*["']?(?:bearer\x20+)?(?P<value>[!#-&(-~]+)
    | (?<![A-Za-z])bearer\x20+["']?(?P<bare>(?!is\x20)[!#-&(-~]+)""",
    re.I | re.A | re.X,
)
# Words as prose has them: letters in one case, or one capital; longer ones are run together.
PROSE = re.compile(r"[A-Za-z]?(?:[a-z]{0,18}|[A-Z]{0,18})(?:[-/'][a-z]+)*")
TAIL = ".,;:!?)]}>"  # signs behind a value that are most likely not of it
CONTEXT_HINTS = ("pwd", "pass", "credential", "bearer", "key", "secret", "token")
MIN_BITS = 40.0

# Common words of passwords, most common first.
COMMON_WORDS = (
    "password love qwerty monkey dragon letmein master sunshine princess shadow football baseball welcome login admin "
    "hello freedom whatever trustno summer winter spring autumn secret flower angel michael jordan hunter ranger soccer "
    "hockey killer george charlie andrew superman batman thomas robert daniel joshua matthew jessica ashley jennifer "
    "amanda nicole maggie ginger pepper cookie banana orange purple yellow silver golden diamond tiger lion eagle wolf "
    "buddy lucky happy money computer internet access server test guest root user default changeme pass word king queen "
    "star moon sun blue red green black white apple cheese chicken pizza music guitar family mother father friend baby "
    "sweet heart peace magic power phoenix mustang corvette ferrari yankees dallas london paris berlin january february "
    "march april june july august september october november december monday friday sunday"
).split()
WORD_BITS = {w: math.log2(i + 2) + 1 for i, w in enumerate(COMMON_WORDS)}
LONGEST_WORD = max(map(len, COMMON_WORDS))
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "!@#$%^&*()")
NEXT = {(a, b) for row in WALKS for x in (row, row[::-1]) for a, b in zip(x, x[1:], strict=False)}
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")
LEET = str.maketrans("@430157$!", "aaeolstsi")
SEGMENT = 1.0  # bits for each change of segment


def char_bits(c: str) -> float:
    """Bits of one brute-force character by its class."""
    return math.log2(10) if c.isdigit() else math.log2(26) if c.isalpha() else math.log2(33)


def guess_bits(value: str) -> float:
    """Least bits over all segmentations of ``value``."""
    n = len(value)
    low = value.lower()
    plain = low.translate(LEET)
    best = [0.0] + [math.inf] * n
    dates = [DATE.match(value, i) for i in range(n)]
    same = walk = 1  # length of the run of equal or neighbouring characters that ends here
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, m in enumerate(dates):
        if m:
            ends[m.end()].append((i, math.log2(100 * (366 if m.end() - i > 4 else 1)) + 1))
    for i in range(1, n + 1):
        if i > 1:
            same = same + 1 if low[i - 1] == low[i - 2] else 1
            walk = walk + 1 if (low[i - 2], low[i - 1]) in NEXT else 1
        cost = best[i - 1] + char_bits(value[i - 1])
        if same >= 3:
            cost = min(cost, best[i - same] + char_bits(value[i - 1]) + math.log2(same) + SEGMENT)
        if walk >= 3:
            cost = min(cost, best[i - walk] + math.log2(len(WALKS) * 26 * 2) + math.log2(walk) + SEGMENT)
        for j, bits in ends[i]:
            cost = min(cost, best[j] + bits + SEGMENT)
        for j in range(max(0, i - LONGEST_WORD), i - 2):
            bits = WORD_BITS.get(low[j:i], math.inf)
            if bits == math.inf:
                bits = WORD_BITS.get(plain[j:i], math.inf) + 2
            if bits < math.inf:
                upper = sum(c.isupper() for c in value[j:i])
                case = 0 if not upper else 1 if upper in (1, i - j) else i - j
                cost = min(cost, best[j] + bits + case + SEGMENT)
        best[i] = cost
    return best[n]


def find_secrets(text: str, min_bits: float = MIN_BITS) -> tuple[list[tuple[int, int, int]], float]:
    """Spans as ``(start, kind, end)`` in order, and the bits of the strongest credential value."""
    low = text.lower()
    spans: list[tuple[int, int, int]] = []
    strongest = 0.0
    if any(h in low for h in HINTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                spans.append((m.start(), 0, m.end()))
                strongest = max(strongest, guess_bits(m[2]))
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(h in low for h in CONTEXT_HINTS):
        base = list(spans)
        for m in CONTEXT.finditer(text):
            group = "bare" if m["bare"] else "value"
            value, (start, end) = m[group], m.span(group)
            core = value.rstrip(TAIL)
            prose = (m["bare"] or m["base"] and m["is"]) and PROSE.fullmatch(core)
            if len(value) >= 6 and not prose and not any(s <= start and start + len(core) <= e for s, _, e in base):
                bits = guess_bits(value)
                strongest = max(strongest, bits)
                if bits >= min_bits:
                    spans.append((start, 3, end))
    return sorted(spans), strongest


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bits: float = MIN_BITS) -> DataFrame:
    """One row for each document: counts by kind, digest of the base spans, all spans, strongest value."""
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "strongest_bits"]

    def make(texts: list[str]) -> tuple[dict, None]:
        rows = []
        for text in texts:
            spans, bits = find_secrets(text, min_bits)
            n = [sum(k == i for _, k, _ in spans) for i in range(4)]
            digest = hashlib.sha256(joined([x for x in spans if x[1] < 3]).encode()).hexdigest()
            rows.append((*n[:3], digest, joined(spans), n[3], bits))
        return dict(zip(names, zip(*rows, strict=True), strict=True)), None

    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, strongest_bits double"
    return map_texts(id_text(df, id_col, text_col), make, fields)
