"""Porter stemming (Porter, 1980) as Column expressions.

The rules follow the published algorithm with the common NLTK variations
(irregular forms, no stemming of words of two letters or fewer, ``ies``/``ied``
on four-letter words, ``y -> i`` only after a consonant, ``bli -> ble``,
``alli``, ``fulli``, ``logi``, and a two-letter vowel-consonant stem counting
as *o).

Each word is mapped to a consonant/vowel signature (``C``/``V``, one letter
per character); the measure *m* of a stem is the number of ``VC`` pairs in
the signature of that prefix.  A step is a ``when`` chain over its suffixes in
rule order: the first suffix that matches decides, and when its condition
fails the word is left as it is.

Steps are applied as successive projections of a DataFrame (``stem_terms``)
so that each step reads a materialised column instead of inlining the
previous step's expression many times over.  The signature is computed once
per word and then edited along with it (a suffix rule removes characters and
appends a fixed replacement whose signature is known), which keeps the
generated code small enough for whole-stage codegen.  Each step is written
as one SQL expression (``F.expr``), so building the plan costs a handful of
calls instead of thousands.  Use it on the distinct
vocabulary and join the stems back; the vocabulary is much smaller than the
token stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Irregular forms and their stems.
IRREGULAR_FORMS = {
    "skies": "sky",
    "sky": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}


# Signature rules; capture groups instead of look-behind, so the same rules
# run on RE2 engines too.  A "y" at the start or after a vowel is a consonant;
# the rest of its run alternates from there, whatever its length.
_SIG_RULES = [("[aeiou]", "V"), ("[^Vy]", "C"), ("(^|V)y", "{1}C"), ("yy", "VC"), ("y", "V")]


def signature(word: Column) -> Column:
    """``C``/``V`` per character; ``y`` is a vowel right after a consonant."""
    s = word
    for pattern, repl in _SIG_RULES:
        s = F.regexp_replace(s, pattern, repl.replace("{1}", "$1"))
    return s


def signature_sql(word: str, dialect: str = "spark") -> str:
    """``signature`` as SQL text (``spark`` or ``duckdb``)."""
    _DIALECT[0] = dialect
    try:
        s = word
        for pattern, repl in _SIG_RULES:
            if dialect == "duckdb":
                s = f"regexp_replace({s}, {_lit(pattern)}, {_lit(repl.replace('{1}', chr(92) + '1'))}, 'g')"
            else:
                s = f"regexp_replace({s}, {_lit(pattern)}, {_lit(repl.replace('{1}', '$1'))})"
        return s
    finally:
        _DIALECT[0] = "spark"


# --- SQL text builders ------------------------------------------------------
# W and S name the current word and signature columns inside a step.
W, S = "__cs_w", "__cs_sig"


# Target SQL dialect of the builders below ("spark" or "duckdb").
_DIALECT = ["spark"]


def _lit(text: str) -> str:
    if _DIALECT[0] == "duckdb":
        return "'" + text.replace("'", "''") + "'"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _drop(x: str, k: int) -> str:
    return f"left({x}, length({x}) - {k})" if k else x


def _measure(sig: str) -> str:
    return f"((length({sig}) - length(replace({sig}, 'VC', ''))) / 2)"


def _has_vowel(sig: str) -> str:
    return f"(instr({sig}, 'V') > 0)"


def _ends_cvc(stem: str, sig: str) -> str:
    return (f"((length({sig}) >= 3 AND {_ends(sig, 'CVC')} "
            f"AND substring({stem}, -1, 1) NOT IN ('w', 'x', 'y')) "
            f"OR (length({sig}) = 2 AND {sig} = 'VC'))")


def _ends_double_consonant(stem: str, sig: str) -> str:
    return (f"(length({stem}) >= 2 AND substring({stem}, -1, 1) = substring({stem}, -2, 1) "
            f"AND {_ends(sig, 'C')})")


def _ends(x: str, suffix: str) -> str:
    fn = "ends_with" if _DIALECT[0] == "duckdb" else "endswith"
    return f"{fn}({x}, {_lit(suffix)})"


def _sig_of(text: str) -> str:
    """Signature of a replacement suffix (none of them holds a ``y``)."""
    return "".join("V" if ch in "aeiou" else "C" for ch in text)


def _edit(k: int, repl: str = "") -> str:
    """Drop ``k`` trailing characters, append ``repl``."""
    if _DIALECT[0] == "duckdb":
        return f"struct_pack(k := {k}, r := {_lit(repl)}, s := {_lit(_sig_of(repl))})"
    return f"named_struct('k', {k}, 'r', {_lit(repl)}, 's', {_lit(_sig_of(repl))})"


def _keep() -> str:
    return _edit(0)


def _m_gt(n):
    return lambda stem, sig: f"({_measure(sig)} > {n})"


def _rules(rules) -> str:
    """First matching suffix decides; a failed condition keeps the word."""
    arms = []
    for suffix, repl, cond in rules:
        k = len(suffix)
        val = _edit(k, repl) if cond is None else \
            f"CASE WHEN {cond(_drop(W, k), _drop(S, k))} THEN {_edit(k, repl)} ELSE {_keep()} END"
        arms.append(f"WHEN {_ends(W, suffix)} THEN {val}")
    return "CASE " + " ".join(arms) + f" ELSE {_keep()} END"


def _step1a() -> str:
    rules = _rules([("sses", "ss", None), ("ies", "i", None), ("ss", "ss", None), ("s", "", None)])
    return f"CASE WHEN {_ends(W, 'ies')} AND length({W}) = 4 THEN {_edit(3, 'ie')} ELSE {rules} END"


# Marks a word whose "ed"/"ing" was removed, for the follow-up rules.
_MARK = "\u0001"


def _step1b() -> str:
    ied = f"CASE WHEN length({W}) = 4 THEN {_edit(3, 'ie')} ELSE {_edit(3, 'i')} END"
    eed = f"CASE WHEN {_measure(_drop(S, 3))} > 0 THEN {_edit(3, 'ee')} ELSE {_keep()} END"
    return (f"CASE WHEN {_ends(W, 'ied')} THEN {ied} "
            f"WHEN {_ends(W, 'eed')} THEN {eed} "
            f"WHEN {_ends(W, 'ed')} AND {_has_vowel(_drop(S, 2))} THEN {_edit(2, _MARK)} "
            f"WHEN {_ends(W, 'ing')} AND {_has_vowel(_drop(S, 3))} THEN {_edit(3, _MARK)} "
            f"ELSE {_keep()} END")


def _step1b_tail() -> str:
    """Follow-up rules of step 1b on a marked stem."""
    stem, sig = _drop(W, 1), _drop(S, 1)
    last = f"substring({stem}, -1, 1)"
    tail = (f"CASE WHEN {_ends(stem, 'at')} OR {_ends(stem, 'bl')} OR {_ends(stem, 'iz')} "
            f"THEN {_edit(1, 'e')} "
            f"WHEN {_ends_double_consonant(stem, sig)} THEN "
            f"CASE WHEN {last} NOT IN ('l', 's', 'z') THEN {_edit(2)} ELSE {_edit(1)} END "
            f"WHEN {_measure(sig)} = 1 AND {_ends_cvc(stem, sig)} THEN {_edit(1, 'e')} "
            f"ELSE {_edit(1)} END")
    return f"CASE WHEN {_ends(W, _MARK)} THEN {tail} ELSE {_keep()} END"


def _step1c() -> str:
    stem, sig = _drop(W, 1), _drop(S, 1)
    return (f"CASE WHEN {_ends(W, 'y')} AND length({stem}) > 1 AND {_ends(sig, 'C')} "
            f"THEN {_edit(1, 'i')} ELSE {_keep()} END")


def _step2_alli() -> str:
    return (f"CASE WHEN {_ends(W, 'alli')} AND {_measure(_drop(S, 4))} > 0 "
            f"THEN {_edit(4, 'al')} ELSE {_keep()} END")


_M0 = _m_gt(0)
_STEP2 = [
    ("ational", "ate", _M0), ("tional", "tion", _M0), ("enci", "ence", _M0),
    ("anci", "ance", _M0), ("izer", "ize", _M0), ("bli", "ble", _M0),
    ("alli", "al", _M0), ("entli", "ent", _M0), ("eli", "e", _M0),
    ("ousli", "ous", _M0), ("ization", "ize", _M0), ("ation", "ate", _M0),
    ("ator", "ate", _M0), ("alism", "al", _M0), ("iveness", "ive", _M0),
    ("fulness", "ful", _M0), ("ousness", "ous", _M0), ("aliti", "al", _M0),
    ("iviti", "ive", _M0), ("biliti", "ble", _M0), ("fulli", "ful", _M0),
    # "logi -> log" tests the measure of the stem plus its "l".
    ("logi", "log", lambda stem, sig: f"({_measure(_drop(S, 3))} > 0)"),
]

_STEP3 = [
    ("icate", "ic", _M0), ("ative", "", _M0), ("alize", "al", _M0),
    ("iciti", "ic", _M0), ("ical", "ic", _M0), ("ful", "", _M0), ("ness", "", _M0),
]

_M1 = _m_gt(1)
_STEP4 = [
    ("al", "", _M1), ("ance", "", _M1), ("ence", "", _M1), ("er", "", _M1),
    ("ic", "", _M1), ("able", "", _M1), ("ible", "", _M1), ("ant", "", _M1),
    ("ement", "", _M1), ("ment", "", _M1), ("ent", "", _M1),
    ("ion", "", lambda stem, sig: f"({_measure(sig)} > 1 AND substring({stem}, -1, 1) IN ('s', 't'))"),
    ("ou", "", _M1), ("ism", "", _M1), ("ate", "", _M1), ("iti", "", _M1),
    ("ous", "", _M1), ("ive", "", _M1), ("ize", "", _M1),
]


def _step5a() -> str:
    stem, sig = _drop(W, 1), _drop(S, 1)
    m = _measure(sig)
    return (f"CASE WHEN {_ends(W, 'e')} AND ({m} > 1 OR ({m} = 1 AND NOT {_ends_cvc(stem, sig)})) "
            f"THEN {_edit(1)} ELSE {_keep()} END")


def _step5b() -> str:
    return (f"CASE WHEN {_ends(W, 'll')} AND {_measure(_drop(S, 1))} > 1 "
            f"THEN {_edit(1)} ELSE {_keep()} END")


_STEPS = (_step1a, _step1b, _step1b_tail, _step1c, _step2_alli,
          lambda: _rules(_STEP2), lambda: _rules(_STEP3), lambda: _rules(_STEP4),
          _step5a, _step5b)

EDIT = "__cs_edit"


def step_sql(dialect: str = "spark") -> list[str]:
    """The edit expression of every step, as SQL text over ``W`` and ``S``."""
    _DIALECT[0] = dialect
    try:
        return [step() for step in _STEPS]
    finally:
        _DIALECT[0] = "spark"


def apply_sql() -> tuple[str, str]:
    """New word and signature from the current ones and the step's edit."""
    return (f"concat(left({W}, length({W}) - {EDIT}.k), {EDIT}.r)",
            f"concat(left({S}, length({S}) - {EDIT}.k), {EDIT}.s)")


def final_sql(word: str, dialect: str = "spark") -> str:
    """Irregular forms first, words of two letters or fewer unchanged."""
    _DIALECT[0] = dialect
    try:
        pool = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in IRREGULAR_FORMS.items())
        return (f"coalesce(CASE {word} {pool} END, "
                f"CASE WHEN length({word}) <= 2 THEN {word} ELSE {W} END)")
    finally:
        _DIALECT[0] = "spark"


def stem_terms(df: DataFrame, col: str = "term", out: str = "stem") -> DataFrame:
    """Append ``out`` = Porter stem of the lowercase word in ``col``.

    The signature is computed once; every step yields an edit (drop k
    characters, append a suffix whose signature is a constant), applied to
    the word and its signature alike.
    """
    keep = [F.col(c) for c in df.columns]
    cur = df.select(*keep, F.col(col).alias(W), signature(F.col(col)).alias(S))
    new_w, new_s = apply_sql()
    for step in step_sql("spark"):
        cur = (cur.select(*keep, W, S, F.expr(step).alias(EDIT))
                  .select(*keep, F.expr(new_w).alias(W), F.expr(new_s).alias(S)))
    return cur.select(*keep, F.expr(final_sql(f"`{col}`")).alias(out))
