"""Secret scans: pattern spans plus guess-cost dynamic programming on credential values.

Base spans come from three patterns (``assign``, ``access``, ``hex``).  The
method adds spans of kind ``guess``: where a text names a credential
(password, passphrase, bearer, private key, ...) and gives it a value, the
value's cost to a guesser is the minimum over all segmentations into

* words of common passwords (with case and digit-for-letter variants), and of
  a language's ranked vocabulary where one is given: a tokenizer file, whose
  order is about that of frequency (``vocabulary``),
* dates, repeats and alphabetic or numeric runs, walks on the keyboard,
* brute-force stretches (per character, the size of its character class),

found by dynamic programming over the positions of the value.  A value that
opens with a quote goes to the matching quote on its line, any other one over
all visible characters that follow, without punctuation at its end; after
``passphrase:`` or ``passphrase=`` plain words up to the end of the line are
one value.  The words of a value with spaces cost at most a draw from a word
list each.  After `` is `` or ``bearer`` prose may go on, so a value of letters
alone costs at most a draw from all words of a language there.  A value in
angle brackets is a placeholder.  A value whose
cost reaches ``min_log10`` (log10 of guesses) is a secret: it cannot be a
placeholder or a word.  Base spans always stay; a value that a base span
covers adds none.

Defined results: null or empty text has no spans.  Offsets are code points,
end exclusive.  Very long values are costed whole, very long texts in time
that grows with them; repeated rows are scanned one by one; an empty table
gives no rows; spans with equal start go by kind.  Extra columns of any name
are kept, one named as the spans column is replaced.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import hold, ship_code, slices

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Where a credential's value may stand: a wider list of names, other separators.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code|_?key)|pwd|secret(?:_?key)?|(?:access|auth|refresh|session)?_?token|(?:api|access|private|signing)[_-]?key|credentials?|authorization|bearer)"""
    r"""["']?(?:\x20*(?::=|=>|[:=])\x20*|\x20+is\x20+|(?<=[Bb]earer)\x20+)(?:(?:basic|bearer)\x20+)?""", re.I | re.A)
_QUOTED = {q: re.compile(rf"{q}((?:\\[^\n]|[^{q}\\\n])*+){q}") for q in "\"'`"}
_PROSE = re.compile(r"[A-Za-z]\x20+(?:is\x20+)?\Z")  # the name or "is", then spaces only
_VISIBLE = re.compile(r"\S*")
_PHRASE = re.compile(r"([A-Za-z]+(?:\x20+[A-Za-z]+)+)[\x20.]*+(?=\r?\n|\Z)")
_BEFORE_PHRASE = re.compile(r"passphrase[\"']?\x20*(?::=|=>|[:=])\x20*\Z", re.I | re.A)
#: What may stand after a value without being part of it.
_AFTER = ".,;:!?)]}>\"'`"
#: A word of a word list that dice choose from.
_LOG_WORD = math.log10(7776)
#: A word of a language, in no order that a guesser knows.
_LOG_LANGUAGE = 6.0
#: Values from 10^10 guesses on.
MIN_LOG10 = 10.0

# Common passwords and words of passwords, most used first.
COMMON = (
    "password 123456 qwerty admin welcome letmein monkey dragon master login abc123 football baseball shadow sunshine "
    "princess iloveyou superman batman trustno1 hello freedom whatever secret test guest root user default changeme "
    "example sample placeholder token key pass pwd api access private public service system server database account "
    "summer winter spring autumn monday friday love money company office home house orange banana cookie pepper ginger "
    "hunter killer soccer hockey george michael jordan thomas robert daniel andrew joshua charlie matthew jennifer "
    "ashley jessica amanda nicole flower purple yellow silver golden black white green blue red none null true false "
    "undefined redacted your my the and for not here insert enter value string demo dummy foobar foo bar").split()
# Rows of the keyboard.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
# Digits and signs that stand for letters.
LEET = {"4": "a", "@": "a", "8": "b", "3": "e", "6": "g", "1": "l", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t", "2": "z"}

_RANK = {w: k + 1 for k, w in enumerate(COMMON)}
_LONGEST = max(map(len, COMMON))
#: Letters of a vocabulary's word at most; longer ones are costed in parts.
LONGEST_WORD = 20
_DATES = tuple(map(re.compile, (
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)\d\d",
    r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1\d\d", r"(?:19|20)\d\d")))
_LOG_DAY, _LOG_YEAR = math.log10(365 * 120), math.log10(120)


def _neighbours() -> dict[str, set[str]]:
    """Keys that touch: beside each other in a row, or shifted by at most one in the next."""
    at = {c: (r, k) for r, row in enumerate(KEY_ROWS) for k, c in enumerate(row)}
    return {c: {d for d, (r2, k2) in at.items() if d != c and (r2 == r and abs(k2 - k) == 1 or abs(r2 - r) == 1 and 0 <= (k2 - k) * (r - r2) <= 1)}
            for c, (r, k) in at.items()}


_NEXT = _neighbours()
_LOG_KEYS = math.log10(sum(map(len, KEY_ROWS)))
_LOG_TURN = math.log10(sum(map(len, _NEXT.values())) / len(_NEXT))


@functools.cache
def vocabulary(path: str) -> dict[str, int]:
    """Rank from 1 of the words of three letters or more in a tokenizer file, lower case, in the file's order."""
    entries = json.loads(open(path, encoding="utf-8").read())["model"]["vocab"]
    order = sorted(entries, key=entries.get) if isinstance(entries, dict) else [e[0] for e in entries]
    words = dict.fromkeys(w for e in order if len(w := e.lstrip("\u0120\u2581#").removesuffix("</w>").lower()) > 2 and w.isascii() and w.isalpha())
    return {w: k for k, w in enumerate(words, 1)}


def _brute(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100)


def _runs(text: str, linked) -> list[int]:
    """For each position, the start of the longest stretch ending there whose neighbours are all ``linked``."""
    start = list(range(len(text)))
    for k in range(1, len(text)):
        if linked(text[k - 1], text[k]):
            start[k] = start[k - 1]
    return start


def guess_cost(value: str, words: dict[str, int] | None = None) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes; ``words`` are ranked words beside ``COMMON``."""
    words = words or {}
    longest = max(_LONGEST, LONGEST_WORD if words else 0)
    n, low = len(value), value.lower()
    if len(low) != n:  # a letter whose lower case has several code points
        low = "".join(c.lower()[0] for c in value)
    plain = "".join(LEET.get(c, c) for c in low)
    best = [0.0] + [math.inf] * n
    ends: dict[int, list[tuple[int, float]]] = {}
    for at in range(n):
        for date in _DATES if value[at].isdigit() else ():
            if m := date.match(value, at):
                ends.setdefault(m.end(), []).append((at, _LOG_YEAR if m.end() - at == 4 else _LOG_DAY))
    same = _runs(low, lambda a, b: a == b)
    up = _runs(low, lambda a, b: ord(b) - ord(a) == 1 and a.isalnum())
    down = _runs(low, lambda a, b: ord(a) - ord(b) == 1 and b.isalnum())
    walk = _runs(low, lambda a, b: b in _NEXT.get(a, ()))
    kinds = tuple((starts, first, turn, []) for starts, first, turn in ((same, 1.5, 0.0), (up, 1.0, 0.0), (down, 1.0, 0.0), (walk, _LOG_KEYS, _LOG_TURN)))
    for end in range(1, n + 1):
        cost = best[end - 1] + _brute(value[end - 1])
        for size in range(2, min(longest, end) + 1):
            at = end - size
            rank = _RANK.get(low[at:end]) or _RANK.get(plain[at:end], 0) * 4 or words.get(low[at:end], 0) + len(_RANK) * (low[at:end] in words)
            if rank:
                part = value[at:end]
                cost = min(cost, best[at] + math.log10(rank * (1 if part == part.lower() else 2 if part == part.capitalize() or part.isupper() else 2 ** size)) + 0.3)
        for at, date in ends.get(end, ()):
            cost = min(cost, best[at] + date)
        for starts, first, turn, live in kinds:
            if starts[end - 1] > end - 3:
                live.clear()
                continue
            live.append(end - 3)
            least, still = math.inf, []
            for at in live:  # a start that an earlier one beats stays beaten: the longer both get, the nearer their lengths' logarithms
                size = end - at
                own = best[at] + first + math.log10(size) + turn * (size - 1) / 2
                if own < least:
                    least = own
                    still.append(at)
            live[:] = still
            cost = min(cost, least)
        best[end] = cost
    return best[n]


def value_cost(value: str, words: dict[str, int] | None = None, prose: bool = False) -> float:
    """``guess_cost`` of a value; of one with spaces the sum over its words, where plain words may come from a word list.

    ``prose``: the value may be the next word of a sentence.
    """
    parts = value.split()
    if len(parts) < 2:
        cost = guess_cost(value, words)
        return min(cost, _LOG_LANGUAGE) if prose and value.isalpha() and (value.islower() or value.istitle()) else cost
    return sum(min(guess_cost(w, words), _LOG_WORD) if w.isalpha() else guess_cost(w, words) for w in parts)


def value_at(text: str, name: int, at: int) -> tuple[int, int]:
    """Start and end of the value that stands at ``at``, after a credential's name from ``name`` on."""
    if (quoted := _QUOTED.get(text[at:at + 1])) is not None:
        if m := quoted.match(text, at):
            return m.span(1)
        at += 1  # the quote stays open
    elif _BEFORE_PHRASE.search(text[name:at]) and (m := _PHRASE.match(text, at)):
        return m.span(1)
    end = _VISIBLE.match(text, at).end()
    if text[at:at + 1] == "<" and ">" in text[at:end]:
        return at, at
    while end > at and text[end - 1] in _AFTER:
        end -= 1
    return at, end


def scan_text(text: str | None, min_log10: float = MIN_LOG10, words: dict[str, int] | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every span by start, then kind as listed in ``KINDS``."""
    if not text:
        return []
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted((s, e) for s, _, e in found)
    at, passed, reach = 0, 0, 0  # reach: the furthest end of the base spans that start no later than the value
    while m := CONTEXT.search(text, at):
        s, e = value_at(text, m.start(), m.end())
        at = m.end()
        if e - s >= 6:
            at = e
            while passed < len(base) and base[passed][0] <= s:
                reach = max(reach, base[passed][1])
                passed += 1
            if reach < e and value_cost(text[s:e], words, bool(_PROSE.search(m[0]))) >= min_log10:
                found.append((s, 3, e))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, min_log10: float = MIN_LOG10, text: str = "text", keep_text: bool = True,
                 spans: str = "secret_spans", words: str | None = None) -> DataFrame:
    """``docs`` with an array of (kind, start, end) in the column ``spans``; ``words`` is the path of a tokenizer file on every machine."""
    ship_code(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() == spans.lower()]).withColumn(text, F.col(text).cast("string"))
    carried = [f for f in docs.schema.fields if keep_text or f.name != text]
    names = [f.name for f in carried]

    def scan(batches):
        ranked = vocabulary(words) if words else None
        for b in slices(batches):
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in scan_text(t, min_log10, ranked)] for t in b[text].to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b[n] for n in names], pa.array(rows, _SPANS)], names=[*names, spans])

    return docs.mapInArrow(scan, T.StructType([*carried, T.StructField(spans, SPANS)]))


def mask_text(text: str, found: list[tuple[str, int, int]]) -> str:
    """``text`` with every stretch that spans cover replaced by ``[SECRET]``."""
    out, at = [], 0
    stretches: list[list[int]] = []
    for _, s, e in sorted(found, key=lambda x: x[1]):
        if stretches and s <= stretches[-1][1]:
            stretches[-1][1] = max(e, stretches[-1][1])
        else:
            stretches.append([s, e])
    for s, e in stretches:
        out += [text[at:s], "[SECRET]"]
        at = e
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, min_log10: float = MIN_LOG10, words: str | None = None) -> DataFrame:
    """``docs`` with its columns, all rows, and secrets masked in ``text``; n_chars (if present) follows the new text."""
    ship_code(docs.sparkSession)
    held, text = hold(docs.withColumn("text", F.col("text").cast("string")))
    names = held.columns

    def scan(batches):
        ranked = vocabulary(words) if words else None
        for b in slices(batches):
            rows = [t and mask_text(t, f) if (f := scan_text(t, min_log10, ranked)) else t for t in b[text].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string()) if n == text else b[n] for n in names], names=names)

    out = held.mapInArrow(scan, held.schema).toDF(*docs.columns)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out


def digest_spans(found: list[tuple[str, int, int]]) -> str:
    """Lowercase hex SHA-256 of kind:start:end, comma-joined."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in found).encode()).hexdigest()
