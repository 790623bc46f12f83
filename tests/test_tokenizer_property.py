"""Property: the Spark tokenizer equals a per-token Python statement of the rules.

The Spark chain strips token edges with boundary-aware regexes on the whole
text; the reference statement below splits first and strips each token, as
the rules are written.  Random text over an alphabet rich in quotes,
periods, clitics, colons, digits and Unicode spaces must tokenize the same.
"""

import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.functions import text as T

WORDS = ["don't", "it's", "we'll", "cannot", "gonna", "'tis", "u.s.", "3-point", "1,000", "a:b",
         "x,y", "end.", "...", "--", "(hi)", "“q”", "‘s’", "’", "'", "''", "é", "Ünïcode", "vs.",
         "NIGHT:", "6,a", "o'neil", "rock'n'roll", "mp3", "..a..", ".'", "'.", "wanna", "gotta"]
SPACES = [" ", "  ", "\n", "\t", " ", " "]


def reference_tokens(text: str) -> list[str]:
    c = text.lower()
    c = regex.sub(T.RE_TOK_CONTRACTIONS,
                  lambda m: "".join(m.group(i) or "" for i in (1, 3, 5, 7)) + " " +
                  "".join(m.group(i) or "" for i in (2, 4, 6, 8)), c)
    c = regex.sub(T.RE_TOK_TIS, lambda m: m.group(1) + " " + m.group(2), c)
    c = regex.sub(T.RE_TOK_PUNCT, " ", c)
    c = regex.sub(T.RE_TOK_COLON_COMMA, lambda m: " " + m.group(1), c)
    c = regex.sub(T.RE_TOK_NEG, " ", c)
    c = regex.sub(T.RE_TOK_CLITIC, " ", c)
    out = []
    for tok in regex.split(T.RE_TOK_SPLIT, c.strip(" ")):
        tok = regex.sub(r"^['’‘]+", "", tok)
        tok = regex.sub(r"[.'’‘]+$", "", tok)
        if tok:
            out.append(tok)
    return out


texts = st.lists(st.sampled_from(WORDS), min_size=1, max_size=12).flatmap(
    lambda ws: st.lists(st.sampled_from(SPACES), min_size=len(ws), max_size=len(ws)).map(
        lambda sp: "".join(w + s for w, s in zip(ws, sp))))


@settings(max_examples=25, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_spark_tokenizer_matches_per_token_rules(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, t string")
    got = {r.i: list(r.toks) for r in df.select("i", T.word_tokens("t").alias("toks")).collect()}
    for i, t in enumerate(batch):
        assert got[i] == reference_tokens(t), (t, got[i])
