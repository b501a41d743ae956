"""Secret scans: known forms, and windows of high entropy.

A candidate is a run of characters that keys are written in, without the known forms inside it. A window slides over
it, and the window's class (hexadecimal, letters and digits, or all of base64) sets a bound for its Shannon entropy.
Moving the window by one character changes two counts, so a candidate costs one step per character. Candidates of the
allow-list (words, numbers, addresses, dates, paths) and windows of words and numbers give nothing.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import slices

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
LEAST_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a run from its first AKIA on, 18 characters or more
HEX = re.compile(r"[0-9a-f]{16,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# Characters of the window, for long candidates and for those below 20 characters, and the bits per character that a
# window must exceed, by class. 20 random characters have about 3.3 bits (16 symbols), 4.0 (62) and 4.1 (64 and more).
WINDOW, SHORT_WINDOW = 20, 16
BOUNDS = {"hex": 2.9, "alnum": 3.6, "base64": 3.7}
WORDY = 2.9  # characters of a run, on average, from which on a window is words and numbers; random ones have about 2
SHORT_BOUNDS = {"hex": 2.75, "alnum": 3.45, "base64": 3.5}
ALLOWED = [
    re.compile(p)
    for p in (
        r"[A-Za-z]+",  # a word
        r"[A-Za-z][a-z]*+(?:[-_/][A-Za-z][a-z]*+)*+[-_/]?",  # words joined
        r"[0-9+/_=-]+",  # digits, dates, rules
        r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # a UUID
        r"/?[A-Za-z]++[0-9]{0,4}+(?:[/_=-]++[A-Za-z]*+[0-9]{0,4}+)*+",  # a path or a name with short numbers
    )
]
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
_DIGIT, _LOWER, _UPPER, _OTHER, _SIGN = range(5)
_GROUP = {c: _OTHER for c in string.ascii_letters} | {c: _DIGIT for c in string.digits} | {
    c: _LOWER for c in "abcdef"} | {c: _UPPER for c in "ABCDEF"} | {c: _SIGN for c in "+/_=-"}


def allowed(candidate: str) -> bool:
    """Whether the allow-list suppresses the candidate: one of its patterns, or a missing mix of letters and digits."""
    return any(p.fullmatch(candidate) for p in ALLOWED) or not re.search(r"[A-Za-z]", candidate) or not re.search(
        r"[0-9]", candidate
    )


def windows(text: str, window: int = WINDOW) -> Iterator[tuple[float, str]]:
    """Shannon entropy and class of every window, from counts that change by one character at either end."""
    counts: dict[str, int] = {}
    groups = [0] * 5
    total = 0.0  # sum of c log2 c
    full = math.log2(window)
    for i, char in enumerate(text):
        c = counts.get(char, 0)
        counts[char] = c + 1
        groups[_GROUP[char]] += 1
        total += _TERM[c + 1] - _TERM[c] if c < window else 0.0
        if i >= window:
            out = text[i - window]
            c = counts[out]
            counts[out] = c - 1
            groups[_GROUP[out]] -= 1
            total += _TERM[c - 1] - _TERM[c] if c <= window else 0.0
        if i >= window - 1:
            yield full - total / window, _class(groups)


def _class(groups: list[int]) -> str:
    """Hexadecimal digits of one case are a class if letters and digits are among them."""
    if groups[_SIGN]:
        return "base64"
    one_case = bool(groups[_LOWER]) != bool(groups[_UPPER])
    return "hex" if groups[_DIGIT] and one_case and not groups[_OTHER] else "alnum"


def run_starts(text: str) -> tuple[list[int], list[int]]:
    """Up to every place of the text, how many runs have begun and how many characters are no signs.

    A run is a word in small or capital letters or one with a capital, or a number; signs part runs.
    """
    begun, letters, before = [0], [0], ""
    for char in text:
        kind = "9" if char.isdigit() else "a" if char.islower() else "A" if char.isupper() else "-"
        new = kind != "-" and kind != before and not (before == "A" and kind == "a")
        begun.append(begun[-1] + new)
        letters.append(letters[-1] + (kind != "-"))
        before = kind
    return begun, letters


def random_looking(candidate: str) -> bool:
    """Whether some window's entropy exceeds the bound of the window's class, and it is not made of words and numbers:
    its runs are shorter than `WORDY` characters on average."""
    long = len(candidate) >= WINDOW
    size, bounds = (WINDOW, BOUNDS) if long else (SHORT_WINDOW, SHORT_BOUNDS)
    begun, letters = run_starts(candidate)
    for start, (entropy, kind) in enumerate(windows(candidate, size)):
        if entropy > bounds[kind]:
            inside = letters[start + 1] > letters[start] and begun[start + 1] == begun[start]  # the first run began before
            runs = begun[start + size] - begun[start] + inside
            if letters[start + size] - letters[start] < WORDY * runs:
                return True
    return False


def outside(start: int, end: int, base: list[tuple[int, int]], at: int) -> Iterator[tuple[int, int]]:
    """The runs of at least `SHORT_WINDOW` characters from start to end that no span covers; the sorted spans from `at`
    on."""
    while at < len(base) and base[at][0] < end:
        if base[at][0] - start >= SHORT_WINDOW:
            yield start, base[at][0]
        start = max(start, base[at][1])
        at += 1
    if end - start >= SHORT_WINDOW:
        yield start, end


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of all secrets, in code points; at the same start in the order of KINDS."""
    if not text:
        return []
    lower = text.lower()
    found = []
    if "token" in lower or "passw" in lower or "secret" in lower or "api" in lower:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted((a, b) for a, _, b in found)
    next_base = 0
    for m in CANDIDATE.finditer(text):
        if m[0].isalpha() and not base:
            continue
        while next_base < len(base) and base[next_base][1] <= m.start():
            next_base += 1
        for start, end in outside(m.start(), m.end(), base, next_base):
            candidate = text[start:end]
            if not candidate.isalpha() and not allowed(candidate) and random_looking(candidate):
                found.append((start, 3, end))
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end, comma-joined."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256 (of the known forms' spans) and spans.

    A null text counts as empty, and so does an empty table. Texts of any length are scanned whole. Repeated rows stay;
    other columns, whatever their names, are not read.
    """

    def find(batches):
        for batch in slices(batches):
            rows = [scan(t) for t in batch.column("text").to_pylist()]
            base = [written([s for s in spans if s[1] < 3]) for spans in rows]
            columns = {"doc_id": batch.column("doc_id")}
            for number, kind in enumerate(KINDS):
                columns[f"n_{kind}"] = pa.array([sum(s[1] == number for s in spans) for spans in rows], pa.int64())
            columns["base_sha256"] = pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string())
            columns["spans"] = pa.array([written(spans) for spans in rows], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    kind = documents.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(find, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def masked(text: str | None, mask: str = "[secret]") -> str | None:
    """The text with every secret replaced; spans that overlap are replaced together. Null stays null."""
    if text is None:
        return None
    out, done = [], 0
    for start, _, end in scan(text):
        if start >= done:
            out += [text[done:start], mask]
        done = max(done, end)
    return "".join(out) + text[done:]


def mask_secrets(documents: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The documents, all of them, with the secrets in `text` replaced and n_chars, if there is one, counted anew."""

    def replace(batches):
        for batch in slices(batches):
            texts = pa.array([masked(t, mask) for t in batch.column("text").to_pylist()], pa.string())
            yield batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"), texts)

    new = documents.mapInArrow(replace, documents.schema)
    if "n_chars" not in documents.columns:
        return new
    kind = documents.schema["n_chars"].dataType
    return new.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
