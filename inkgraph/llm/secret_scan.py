"""Secrets in texts: fixed patterns, and guess costs of values in credential contexts.

The cost of a value is the least product of guesses over all ways to cut it
into common words, dates, repeats, keyboard walks, sequences and brute-force
spans, found by dynamic programming over its characters.  Values that are cheap
to guess are placeholders; dear ones are reported as spans of kind ``guess``.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from inkgraph.llm.common import texts
from inkgraph.llm.hashed_words import chunks

KINDS = ["assign", "access", "hex", "guess"]

# The base patterns and the least lengths of what they match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

#: Names before a value that make it a credential; a value ends at white space, quotes or brackets.
CONTEXT = re.compile(
    r"""(?:password|passwd|pwd|passphrase|secret|token|api_?key|access_?key|private_?key|credentials?|auth|bearer)"""
    r"""["']?\x20*(?:[:=]|=>|\bis\b)\x20*["']?([^\s"'<>(){}\[\],;]{6,})""", re.I | re.A,
)
ANY = r"(?i:pass|pwd|secret|token|key|credential|auth|bearer)|AKIA|[0-9a-f]{24}"
DEAR = 8.0               # log10 of the guesses from which a value counts as a secret

# Frequent passwords and words in them, most frequent first.
COMMON = """password admin welcome login letmein qwerty dragon monkey master shadow football baseball sunshine princess
iloveyou superman trustno changeme secret default example test guest root user token hello summer winter spring autumn
love money freedom whatever michael jordan charlie thomas hunter ranger daniel george computer internet server database
company office access public private system manager security network cloud service account dummy sample placeholder
none null undefined value string key pass word your my the and for insert enter here replace xxxx""".split()
RANK = {word: i + 1 for i, word in enumerate(COMMON)}
LONGEST_WORD = max(map(len, COMMON))
# Look-alike characters.
LEET = str.maketrans("@4301!$57", "aaeoiisst")
ROWS = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"]
PLACE = {c: (r, i) for r, row in enumerate(ROWS) for i, c in enumerate(row)}
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)\d{1,2}\1\d{1,2}|\d{1,2}([-/._]?)\d{1,2}\2(?:19|20)?\d\d|(?:19|20)\d\d)")


def _near(a: str, b: str) -> bool:
    p, q = PLACE.get(a), PLACE.get(b)
    return bool(p and q and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1)


def _spans(value: str):
    """(start, end, log10 of guesses) of all words, dates, repeats, walks and sequences in a value."""
    low = value.lower()
    plain = low.translate(LEET)
    n = len(value)
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            rank = RANK.get(low[i:j])
            extra = 0.0
            if rank is None:
                rank, extra = RANK.get(plain[i:j]), math.log10(4)
            if rank:
                if value[i:j] != low[i:j]:
                    extra += math.log10(2 if value[i].isupper() or value[i:j].isupper() else 2 ** min(10, j - i))
                yield i, j, math.log10(rank) + extra
        found = DATE.match(value, i)
        if found:
            year = re.search(r"(?:19|20)\d\d", found[0])
            span = max(20, abs(int(year[0]) - 2025)) if year else 100
            yield i, found.end(), math.log10(span * (1 if len(found[0]) == 4 else 365) * (4 if found[1] or found[2] else 1))
    for unit in (1, 2, 3, 4):
        i = 0
        while i + 2 * unit <= n:
            j = i + unit
            while j < n and low[j] == low[j - unit]:
                j += 1
            times = (j - i) / unit
            if times >= 2 and j - i >= 3:
                yield i, j, unit + math.log10(times)
                i = j
            else:
                i += 1
    for linked, start_cost in ((_near, math.log10(47)), (lambda a, b: abs(ord(a) - ord(b)) == 1 and a.isalnum() and b.isalnum(), math.log10(20))):
        i = 0
        while i < n:
            j, turns, last = i + 1, 0, None
            while j < n and linked(low[j - 1], low[j]):
                step = (PLACE.get(low[j], (0, 0))[1] - PLACE.get(low[j - 1], (0, 0))[1], ord(low[j]) - ord(low[j - 1]))
                turns, last, j = turns + (step != last), step, j + 1
            if j - i >= 3:
                yield i, j, start_cost + math.log10(j - i) + turns * math.log10(4)
            i = j if j - i >= 3 else i + 1


def guess_cost(value: str) -> float:
    """log10 of the guesses for a value: the cheapest segmentation; brute force costs 10 guesses a character, a further part twice."""
    ends: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in _spans(value):
        ends.setdefault(j, []).append((i, cost))
    part = math.log10(2)
    least = [0.0] + [math.inf] * len(value)           # cheapest cost up to here
    brute = [math.inf] * (len(value) + 1)             # the same, ending in a brute-force span
    for j in range(1, len(value) + 1):
        brute[j] = min(brute[j - 1], least[j - 1] + part * (j > 1)) + 1.0
        least[j] = min([brute[j]] + [least[i] + cost + part * (i > 0) for i, cost in ends.get(j, ())])
    return least[-1]


known_cost = lru_cache(200_000)(guess_cost)


def find(text: str) -> tuple[list[tuple[int, int, int]], float]:
    """(start, kind, end) of all spans of a text in order, and the largest guess cost among its credential values (else 0)."""
    spans, taken, dearest = [], [], 0.0
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= LEAST_VALUE:
            spans.append((m.start(), 0, m.end()))
            taken.append(m.span(2))
            dearest = max(dearest, known_cost(m[2]))
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    taken += [(start, end) for start, kind, end in spans if kind]
    for m in CONTEXT.finditer(text):
        cost = known_cost(m[1])
        dearest = max(dearest, cost)
        if cost >= DEAR and not any(m.start(1) < end and start < m.end(1) for start, end in taken):
            spans.append((m.start(1), 3, m.end(1)))
    return sorted(spans), dearest


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


NOTHING = hashlib.sha256(b"").hexdigest()


def _suspects(column: pa.Array) -> set[int]:
    """Rows that may hold any span, by one scan of the whole batch."""
    return set(pc.indices_nonzero(pc.match_substring_regex(column, ANY)).to_pylist())


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess, max_guess_log10) of every row.

    Offsets count code points, ends are exclusive.  A null or empty text has no
    spans; repeated rows give repeated results.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "max_guess_log10"]

    def run(batches):
        for batch in batches:
            for low, high, data in chunks(batch["text"]):
                part = batch["text"].slice(low, high - low)
                rows = [(0, 0, 0, NOTHING, "", 0, 0.0)] * len(data)
                for i in _suspects(part):
                    spans, dearest = find(data[i].decode("utf-8", "replace"))
                    count = [sum(kind == k for _, kind, _ in spans) for k in range(4)]
                    base = written([s for s in spans if s[1] < 3])
                    rows[i] = (*count[:3], hashlib.sha256(base.encode()).hexdigest(), written(spans), count[3], dearest)
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].slice(low, high - low), *[pa.array(c, pa.int64()) for c in columns[:3]],
                    pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string()),
                    pa.array(columns[5], pa.int64()), pa.array(columns[6], pa.float64()),
                ], names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, max_guess_log10 double"
    return texts(docs).mapInArrow(run, schema)


def mask(text: str, by: str = "[SECRET]") -> str:
    """The text with every found span replaced; overlapping spans are one."""
    out, at = [], 0
    for start, _, end in find(text)[0]:
        if start >= at:
            out += [text[at:start], by]
        at = max(at, end)
    return "".join(out) + text[at:]


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of their texts masked, and n_chars counted anew where it is a column; null texts stay null."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            at = names.index("text")
            part = batch.column(at)
            hits = _suspects(part)
            if hits:
                values = part.to_pylist()
                for i in hits:
                    values[i] = mask(values[i])
                part = pa.array(values, part.type)
            yield pa.RecordBatch.from_arrays([part if i == at else c for i, c in enumerate(batch.columns)], names)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out
