"""Text rules as Column expressions: HTML to text, tokenizing, term filters.

Everything here is built-in functions, run inside the executors' JVM without
a Python worker.  The patterns avoid look-around so that the same rules also run on RE2-based
engines (the DuckDB oracle in ``plans.oracle`` uses these constants).
"""

from __future__ import annotations

from html.entities import codepoint2name

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# HTML -> text
# ---------------------------------------------------------------------------

# One tag grammar, shared by both kinds of text and by the links: a tag ends at
# the first ">" outside a quoted attribute value (a quote begins a value only
# right after "="), or, when a quote is never closed, at the first ">" at all.
# After "=" the next character decides the branch, so no input makes the
# pattern backtrack over more than one attribute.  The matcher keeps a stack
# frame per attribute; a tag of more than 100 ends at its first ">".
MAX_ATTRIBUTES = 100
RE_TAG_QUOTED = r"""<[A-Za-z/!?][^>=]*(?:=\s*(?:(?:"[^"]*"|'[^']*'|[^"'>=\s])[^>=]*)?){0,%d}>""" % MAX_ATTRIBUTES
RE_TAG = RE_TAG_QUOTED + r"|<[A-Za-z/!?][^>]*>"
# Script, style and template bodies go first: page scripts can hold a literal
# "</p>" inside a string, which a plain tag pattern would cut in half.
# Each ends at the close tag of its own kind, or with the page.
HIDDEN_TAGS = ("script", "style", "template")
RE_HIDDEN_BLOCKS = "(?is)" + "|".join(rf"<{t}\b.*?(?:</{t}\s*>|\z)" for t in HIDDEN_TAGS)
RE_COMMENTS = r"(?s)<!--.*?(?:-->|\z)"
RE_COMMENTS_AND_TAGS = rf"{RE_COMMENTS}|{RE_TAG}"
# The same two for the JVM's matcher, with the "<" that every branch begins with
# ahead of them: it then tries the branches at a "<" instead of at each character.
JVM_HIDDEN_BLOCKS = "(?is)<(?:" + "|".join(rf"{t}\b.*?(?:</{t}\s*>|\z)" for t in HIDDEN_TAGS) + ")"
JVM_COMMENTS_AND_TAGS = rf"(?s)<(?:!--.*?(?:-->|\z)|{RE_TAG_QUOTED[1:]}|[A-Za-z/!?][^>]*>)"
RE_WHITESPACE_RUN = r"\s+"
# A text-node boundary: tags are first replaced by this marker; whitespace
# next to markers is the stripped end of a text node.
NODE_MARK = "\u0001"
RE_NODE_GAP = r"[\s\p{Z}]*\x01[\s\p{Z}\x01]*"
RE_OUTER_SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"

# Character references: Latin-1 names by the standard library's table, the
# markup characters, and typographic signs; any number in decimal or hex.
ENTITY_CHARS = {name: chr(code) for code, name in sorted(codepoint2name.items())
                if 160 <= code <= 255 or name in ("quot", "amp", "lt", "gt", "ndash", "mdash", "lsquo", "rsquo", "ldquo", "rdquo", "hellip", "bull", "euro", "trade")}
ENTITY_CHARS["apos"] = "'"
NBSP_ENTITY = ("&nbsp;", "\u00a0")
RE_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]+[0-9]*);"


def decode_entities(col: Column) -> Column:
    """Character references decoded once, left to right; unknown ones stay as written.

    The text is cut at its ``&``; what stands before a piece's ``;`` is looked
    up in one map literal or decoded as a code point.
    """
    names = F.create_map(*[F.lit(x) for pair in ENTITY_CHARS.items() for x in pair])

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, RE_ENTITY, 1)
        code = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8)).try_cast("int")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.when(name.startswith("#"), F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))).otherwise(F.element_at(names, name))
        rest = F.substr(p, F.length(name) + F.lit(2))
        return F.when((name != "") & char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), p))

    parts = F.split(col, "&", -1)
    decoded = F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), piece), ""))
    return F.when(F.contains(col, F.lit("&")), decoded).otherwise(col)


def html_to_text(html: Column | str) -> Column:
    """Visible text nodes, each stripped, joined by one space.

    Tags (and script/style/template blocks, comments) become node
    boundaries; whitespace at a boundary is the stripped end of a node, so
    it collapses to the single joining space, while whitespace inside a node
    is kept.  ``&nbsp;`` is decoded first because stripping removes it too.
    """
    c = F.coalesce(_col(html), F.lit(""))
    c = F.replace(c, F.lit(NBSP_ENTITY[0]), F.lit(NBSP_ENTITY[1]))
    c = F.regexp_replace(c, JVM_HIDDEN_BLOCKS, NODE_MARK)
    c = F.regexp_replace(c, JVM_COMMENTS_AND_TAGS, NODE_MARK)
    c = F.regexp_replace(c, RE_NODE_GAP, " ")
    c = F.regexp_replace(c, RE_OUTER_SPACE, "")
    return decode_entities(c)


def without_markup(html: Column | str) -> Column:
    """The page without hidden blocks, comments and tags; character references stay as written."""
    c = F.coalesce(_col(html), F.lit(""))
    return F.regexp_replace(F.regexp_replace(c, JVM_HIDDEN_BLOCKS, ""), JVM_COMMENTS_AND_TAGS, "")


def html_raw_text(html: Column | str) -> Column:
    """Text nodes concatenated with no separator, whitespace kept.

    ``<td>a</td><td>b</td>`` gives ``ab``.  Decoding uses its input more than
    once: a large table takes ``without_markup`` in a projection of its own
    and ``decode_entities`` of that column, so that tags are matched once.
    """
    return decode_entities(without_markup(html))


# ---------------------------------------------------------------------------
# Tokenizer (Treebank-style word split, C4) and term filters
# ---------------------------------------------------------------------------

# Punctuation that always stands alone, plus "--" and "...".
RE_TOK_PUNCT = r"""[;@#$%&?!()\[\]{}<>"“”«»…]|--|\.\.\."""
# Colon/comma split off unless a digit follows ("1,000" stays whole).
RE_TOK_COLON_COMMA = r"[:,]([^0-9]|$)"
# Clitics: "n't" and "'s 'm 'd 'll 're 've" are split off (and then dropped,
# since they are not alphanumeric).
RE_TOK_NEG = "n['’]t\\b"
RE_TOK_CLITIC = "['’](s|m|d|ll|re|ve)\\b"
# Contractions the word tokenizer splits in two ("cannot" ->
# "can not", "gonna" -> "gon na", "gotta" -> "got ta", "gimme"/"lemme" ->
# "gim me"/"lem me", "wanna" -> "wan na", "'tis"/"'twas" -> "'t is"/"'t was").
# Unmatched groups expand to nothing, so one pass serves all of them.
RE_TOK_CONTRACTIONS = r"\b(?:(can)(not)|(gon|wan)(na)|(got)(ta)|(gim|lem)(me))\b"
TOK_CONTRACTIONS_REPL = "$1$3$5$7 $2$4$6$8"
RE_TOK_TIS = r"(['’]t)(is|was)\b"
# Strings without which the two rules above, and the one on leading quotes, change nothing.
TOK_CONTRACTED = ("cannot", "gonna", "gotta", "gimme", "lemme", "wanna")
TOK_TIS = ("'t", "’t")
TOK_QUOTES = ("'", "’", "‘")
# Punctuation, "n't" and clitics all become a space and touch disjoint
# characters, so one pass handles the three.
RE_TOK_SPACED = f"{RE_TOK_PUNCT}|{RE_TOK_NEG}|{RE_TOK_CLITIC}"
# Unicode-aware whitespace split; \p{Z} catches NBSP and friends.
RE_TOK_SPLIT = r"[\s\p{Z}]+"
# Leading quotes and trailing periods/quotes are separate tokens.  Written
# against token boundaries (string edge or whitespace, captured and put back)
# so they run on the whole text before the split.
RE_TOK_TRAILING = "[.'’‘]+([\\s\\p{Z}]|$)"
RE_TOK_LEADING = "(^|[\\s\\p{Z}])['’‘]+"
RE_ALNUM = r"^[\p{L}\p{N}]+$"
RE_HAS_DIGIT = r"\p{Nd}"


def _where(c: Column, signs: tuple[str, ...], rule) -> Column:
    """``rule`` on texts that hold one of ``signs``; it would leave others as they are.

    A plain search costs a fraction of the rule's.  The one-element array
    names the text, so that it is computed once for the search and the rule.
    """
    def one(x: Column) -> Column:
        found = F.contains(x, F.lit(signs[0]))
        for s in signs[1:]:
            found = found | F.contains(x, F.lit(s))
        return F.when(found, rule(x)).otherwise(x)

    return F.element_at(F.transform(F.array(c), one), 1)


def word_tokens(text: Column | str) -> Column:
    """``array<string>`` of lowercase word tokens in document order.

    Tokens that are not purely alphanumeric are kept here (as the reference
    tokenizer emits them); ``is_alnum`` drops them later.
    """
    c = F.lower(F.coalesce(_col(text), F.lit("")))
    c = _where(c, TOK_CONTRACTED, lambda x: F.regexp_replace(x, RE_TOK_CONTRACTIONS, TOK_CONTRACTIONS_REPL))
    c = _where(c, TOK_TIS, lambda x: F.regexp_replace(x, RE_TOK_TIS, "$1 $2"))
    c = F.regexp_replace(c, RE_TOK_SPACED, " ")
    c = F.regexp_replace(c, RE_TOK_COLON_COMMA, " $1")
    c = F.regexp_replace(c, RE_TOK_TRAILING, "$1")
    c = _where(c, TOK_QUOTES, lambda x: F.regexp_replace(x, RE_TOK_LEADING, "$1"))
    return F.array_remove(F.split(F.trim(c), RE_TOK_SPLIT), "")


def whitespace_tokens(text: Column | str) -> Column:
    """``str.split()``: Unicode whitespace, punctuation stays attached."""
    return F.array_remove(F.split(F.coalesce(_col(text), F.lit("")), RE_TOK_SPLIT), "")


def is_alnum(term: Column | str) -> Column:
    """Whole token is letters/digits (C5): ``3-point`` and ``1,000`` fail."""
    return _col(term).rlike(RE_ALNUM)


def has_digit(term: Column | str) -> Column:
    """Token holds any decimal digit."""
    return _col(term).rlike(RE_HAS_DIGIT)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
