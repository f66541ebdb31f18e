"""Secret scans: fixed patterns, and guess costs of values that stand in a credential's context."""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plumbago.llm.common import extended, in_batches, slices

# Fixed patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of [0-9a-f]+ that have 32 characters or more
#: Where a value counts as a credential: after one of these words and a sign or "is".
CONTEXT = re.compile(r"""(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|credentials?)["']?(?:[ \t]*(?::=|=>|->|[:=])[ \t]*|[ \t]+is[ \t]+)(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"']+))""", re.I | re.A)
KINDS = ("assign", "access", "hex", "guess")
#: Frequent passwords, most frequent first.
FREQUENT = (
    "password", "qwerty", "admin", "welcome", "letmein", "iloveyou", "monkey", "dragon", "football", "baseball", "master", "sunshine", "princess", "shadow",
    "superman", "login", "hello", "freedom", "whatever", "trustno", "secret", "changeme", "default", "test", "guest", "root", "pass", "user", "token", "example",
)
#: The rows of a keyboard, each shifted half a key against the next, and their shifted signs.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
#: Letters and the signs that stand for them.
LOOKALIKE = str.maketrans("4@301!$57", "aaeoiisst")
DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d")
#: log10 guesses: for another segment of a split, for a brute-force character, for a date, for a year.
SPLIT, BRUTE, DAY, YEAR = 0.5, 1.0, math.log10(365 * 120), math.log10(120)
LONGEST_WORD = 24


def _neighbours() -> dict[str, str]:
    at = {c: (x + y / 2, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    return {a: "".join(b for b, (u, v) in at.items() if a != b and abs(v - y) <= 1 and abs(u - x) <= 1) for a, (x, y) in at.items()}


NEIGHBOURS = _neighbours()


def words_of(path: str | None) -> dict[str, float]:
    """log10 ranks: the frequent passwords, then the vocabulary's words of three letters and more in its order."""
    words = list(FREQUENT)
    if path:
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        words += [w for t in sorted(vocabulary, key=vocabulary.get) if (w := t.removeprefix("Ġ").removesuffix("</w>").lower()).isalpha() and len(w) > 2]
    return {w: math.log10(k + 2) for k, w in reversed(list(enumerate(words)))}


#: Walks, sequences and repeats longer than this are tried from the first or to the last character of theirs only.
LONG = 64
UNITS = (1, 2, 3, 4)


def _run_starts(value: str, keys: str) -> list[list[int]]:
    """For each kind of run (walk, sequence, and repeats by unit size) and each character: where the longest run that it ends or goes on with starts."""
    walk, sequence, step = [], [], 0
    repeats: list[list[int]] = [[] for _ in UNITS]
    for k in range(len(value)):
        walk.append(walk[-1] if k and keys[k] in NEIGHBOURS.get(keys[k - 1], "") else k)
        now = ord(value[k]) - ord(value[k - 1]) if k else 0
        sequence.append(k if now not in (1, -1) else sequence[-1] if now == step else k - 1)
        step = now
        for size, own in zip(UNITS, repeats, strict=True):
            own.append(max(0, k - size + 1) if k < size or value[k] != value[k - size] else own[-1])
    return [walk, sequence, *repeats]


def _word_cost(value: str, lower: str, plain: str, words: dict[str, float]) -> float:
    """log10 guesses of a word of the list, as it stands or with look-alike signs and capitals; infinite for any other."""
    rank, more = words.get(lower), 0.0
    if rank is None and (rank := words.get(plain)) is not None:
        more = math.log10(2) * sum(a != b for a, b in zip(lower, plain, strict=True))
    if rank is None:
        return math.inf
    capitals = sum(c.isupper() for c in value)
    return rank + more + (0 if not capitals else math.log10(2) if capitals == len(value) or value[0].isupper() and capitals == 1 else capitals * math.log10(len(value)))


def run_cost(size: int, unit: int = 0) -> float:
    """log10 guesses of a walk or sequence of so many characters, or of so many characters of repeated units; infinite where that is none."""
    if size < 3 or unit and (size % unit or size < 2 * unit):
        return math.inf
    return unit * BRUTE + math.log10(size / unit) if unit else math.log10(50) + math.log10(5) * math.log2(size)


def guess_cost(value: str, words: dict[str, float], enough: float = math.inf) -> float:
    """log10 of the guesses that the cheapest segmentation of value needs; any number of at least `enough` if it needs that many.

    best[j] is the least cost of value[:j], by whether it ends in brute force. Segments: a word of the list (also with
    capitals or look-alike signs), a date or year (as the pattern matches at its start), a repeated unit of up to 4 characters, a
    keyboard walk, a rising or falling sequence, and single brute-force characters. All starts and ends are tried, but of
    the parts of a run that are longer than LONG only those that hold its first or its last character; so the time is
    in proportion to the length. It stops once every boundary from which a segment may go on costs enough.
    """
    n = len(value)
    if not n:
        return 0.0
    lower = value.lower() if len(value.lower()) == n else value
    plain, keys = lower.translate(LOOKALIKE), lower.translate(SHIFTED)
    starts = _run_starts(value, keys)
    solid, brute, start = [math.inf] * (n + 1), [math.inf] * (n + 1), np.full(n + 1, math.inf)
    solid[0] = start[0] = 0.0  # start[i]: what the next segment from i on begins with
    dates: dict[int, float] = {}
    for j in range(1, n + 1):
        if match := DATE.match(value, j - 1):
            dates[match.end()] = min(dates.get(match.end(), math.inf), start[j - 1] + (YEAR if match.end() - j == 3 else DAY))
        brute[j] = min(brute[j - 1] + BRUTE, solid[j - 1] + BRUTE + (SPLIT if j > 1 else 0))
        here = dates.pop(j, math.inf)
        for i in range(max(0, j - LONGEST_WORD), j - 2):
            here = min(here, start[i] + _word_cost(value[i:j], lower[i:j], plain[i:j], words))
        back = j - LONG
        for unit, own in zip((0, 0, *UNITS), starts, strict=True):
            first = own[j - 1]
            if j - first < max(3, 2 * unit):
                continue
            low = first if j == n or own[j] != first else max(first, j - LONG)
            sizes = np.arange(j - low, max(3, 2 * unit) - 1, -1)
            costs = RUN_COSTS[unit][sizes] if j - low <= LONG else np.array([run_cost(int(x), unit) for x in sizes])
            here = min(here, float((start[low : low + len(sizes)] + costs).min()), float(start[first]) + run_cost(j - first, unit))
            back = min(back, first)
        solid[j] = here
        start[j] = min(solid[j], brute[j]) + SPLIT
        if j % LONG == 0 and back == j - LONG and not dates and min(float(start[back : j + 1].min()) - SPLIT, min(brute[back : j + 1])) >= enough:
            return enough
    return min(solid[n], brute[n])


RUN_COSTS = {unit: np.array([run_cost(size, unit) for size in range(LONG + 1)]) for unit in (0, *UNITS)}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns. Checking for the words first spares most texts the costly pattern."""
    found = []
    lower = text.lower()
    if any(w in lower for w in ("password", "passwd", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def guessed_spans(text: str, words: dict[str, float], least: float) -> list[tuple[int, int, int]]:
    found = []
    lower = text.lower()
    if any(w in lower for w in ("password", "passwd", "passphrase", "pwd", "secret", "token", "api", "credential")):
        for m in CONTEXT.finditer(text):
            group = m.lastindex
            value = m[group].rstrip(".,;:!?)") if group == 3 else m[group]
            if len(value) >= 6 and guess_cost(value, words, least) >= least:
                found.append((m.start(group), 3, m.start(group) + len(value)))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


_words: dict[str | None, dict[str, float]] = {}

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_secrets(docs: DataFrame, words_path: str | None = None, least: float = 8.0, texts: bool = False) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess, and with `texts` all columns of docs and `redacted`.

    Every whole text is scanned once, without a shuffle. A null text is empty and has no spans; null and repeated doc_ids are
    kept; an empty table gives no rows. Kinds: the patterns assign, access and hex, and guess for a value in a credential's context
    whose cheapest segmentation takes 10**least guesses or more; words_path is a tokenizer file whose words count as guessable.
    With `texts`, redacted is the text in which each span, joined with those that it meets, is `<secret>` (null stays null); columns of
    docs with one of these names are replaced, others may have any name.
    """
    names = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", *(["redacted"] if texts else []))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if words_path not in _words:
            _words[words_path] = words_of(words_path)
        words = _words[words_path]
        for batch in slices(batches, "text"):
            out: dict[str, list] = {k: [] for k in names}
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                more = guessed_spans(text or "", words, least)
                for k in range(3):
                    out[f"n_{KINDS[k]}"].append(sum(s[1] == k for s in base))
                out["n_guess"].append(len(more))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + more))
                if texts:
                    out["redacted"].append(redacted(text, base + more) if text is not None else None)
            kinds = {"base_sha256": pa.string(), "spans": pa.string(), "redacted": pa.string()}
            kept = batch if texts else batch.select(["doc_id"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items())], [*kept.schema.names, *out])

    taken = docs.drop(*names) if texts else docs.select("doc_id", "text")
    more = ", ".join(f"{k} {'string' if k in ('base_sha256', 'spans', 'redacted') else 'long'}" for k in names)
    return taken.transform(in_batches, scan, extended(taken if texts else taken.select("doc_id"), more))


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "<secret>") -> str:
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start > at or not out and start == at:
            out += [text[at:start], mark]
        elif start == at:
            pass  # it meets the last one
        at = max(at, end)
    return "".join(out) + text[at:]
