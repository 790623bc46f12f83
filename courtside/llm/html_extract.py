"""HTML extraction with a site style tree.

The pages of one host are merged into one tree of branches (paths of
elements with their class or id).  Each branch has two importances, from
entropies over the host's pages:

* *presentation*: the entropy of its sequences of child elements, divided by
  log(pages): a menu looks alike on every page, an article does not;
* *content*: 1 minus the mean of log(pages with the same text) / log(pages):
  text that stands on every page says nothing about the page.

A branch's importance is the larger of the two, times the share of its text
outside links.  A branch seen once keeps importance 1.  From each page the
branches below ``LEAST`` go, and whatever marks itself as a menu, header,
footer, sidebar, notice, advert, form, script, style or reader comment.

The branches inside an article (or main part) that a page names are branches of
the tree too.  The mark is a prior: copies of one article are counted once, and
of a low branch only those texts go that stand on at least half of the host's
different articles with that branch, and on ``SITE_ARTICLES`` of them.  What the
tree leaves of the named part is the page's text, without the page's other
branches; a named part of which it would leave nothing stays.  Inside a
form or a wrapper with the words of a menu, notice and so on, an article or
main part is none of that: the parts of one wrapper are a group, which is
read in place of the page's other parts if it has more text (under a mark of
reader comments: more than all the rest of the page).  An article goes before
the main part if it has at least half the text of both.

Page trees are made where the page lies; only hashes and counts are shuffled.
Counts are summed per (host, branch, text) before the sums per branch, so a
host with a third of all pages makes no large group.  The removals
are broadcast up to ``BROADCAST_BYTES``; beyond that each page's removals are
found by a join on (host, branch) and brought back to the page's row.

Defined results: null or empty html gives an empty text; broken markup is
read as far as it goes; repeated rows are pages of their own; a null url is a
host of its own; whole pages of any length are read.  An empty table gives no
rows; branches that tie share a verdict; other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import materialize, ship_code, slices

LEAST = 0.35
#: Different articles of a host that must hold a text before the tree takes it out of an article.
SITE_ARTICLES = 4
BROADCAST_BYTES = 8 << 20

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
            "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
ENDED_BY = {"li": ("li", "ul ol menu"), "dd": ("dd dt", "dl"), "dt": ("dd dt", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
            "th": ("td th", "tr table"), "option": ("option", "select")}
SCOPE = set("html body table td th caption".split())
# Elements, and words of classes, ids and roles, that are no article text.
NOISE = set("head script style noscript template svg iframe object embed form select button textarea nav aside footer canvas audio video dialog menu".split())
HINTS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay "
            "newsletter subscribe signup login sidebar widget menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer copyright masthead "
            "topbar toolbar share sharing social related recommended comment comments reply replies respond disqus contentinfo complementary search".split())
#: Words that a hint may stand with inside an article and still name what the whole element is.
BESIDE_HINTS = set("area bar block blocks body box btn button buttons card cards container content form group holder icon icons inner item items links list main module "
                   "outer panel post posts section site slot slots unit wrap wrapper zone".split())
HEADERS = {"header", "banner", "masthead"}
READERS = {"comment", "comments", "reply", "replies"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
_HEADING = re.compile(r"h[1-6]")


class Element:
    """``noise`` is 2 where nothing counts, 1 where articles and main parts do; ``group`` is the number of the outermost noise of kind 1, else 0."""

    __slots__ = ("name", "path", "noise", "part", "group", "children")

    def __init__(self, name: str, path: str, noise: int, part: int, group: int):
        self.name, self.path, self.noise, self.part, self.group, self.children = name, path, noise, part, group, []


class Page:
    """Blocks of one page: (path, text, characters in links, part); and the children of each path (``inner``: inside a named part).

    ``part`` is 2 inside an article, 1 inside the main part, else 0.
    """

    def __init__(self, html: str | None):
        self.blocks: list[tuple[str, str, int, int]] = []
        self.presentations: list[tuple[str, str]] = []
        self.inner: list[tuple[str, str]] = []
        self._groups: list[int] = []  # of each block
        self._readers: list[bool] = [False]  # of each group, whether it is marked as reader comments
        self._text: list[str] = []
        self._linked = 0
        self._stack = [Element("", "", 0, 0, 0)]
        self._read(html or "")

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            top = next(e for e in reversed(self._stack) if e.name in BLOCK or not e.name)
            if text:
                self.blocks.append((top.path, text, self._linked, self._stack[-1].part))
                self._groups.append(self._stack[-1].group)
            self._text, self._linked = [], 0

    def _pop(self) -> None:
        e = self._stack.pop()
        if e.name in BLOCK and not e.noise:
            (self.inner if e.part else self.presentations).append((e.path, " ".join(e.children)))

    def _close(self, names, stop) -> None:
        """Close the innermost element of ``names`` that is open above any of ``stop``."""
        for k in range(len(self._stack) - 1, 0, -1):
            e = self._stack[k]
            if e.name in names:
                while len(self._stack) > k:
                    self._pop()
                return
            if e.name in stop:
                return

    def _open(self, name: str, rest: str) -> None:
        top = self._stack[-1]
        marks, label, whole = set(), "", set()
        if "=" in rest:
            for m in _ATTRIBUTE.finditer(rest):
                value = m[2] or m[3] or m[4] or ""
                marks |= {w.lower() for w in _WORDS.findall(value)}
                if not (_HEADING.fullmatch(name) and m[1].lower() == "id"):  # a heading's id is made from its words
                    for token in value.split():
                        own = {w.lower() for w in _WORDS.findall(token)}
                        whole |= own & HINTS if own <= HINTS | BESIDE_HINTS else set()
                if m[1].lower() in ("class", "id") and not label and value.split():
                    label = "." + _DIGITS.sub("0", value.split()[0])
        part = 2 if name == "article" or "articlebody" in marks or {"article", "body"} <= marks and "itemprop" in rest.lower() else 1 if name == "main" or "main" in marks and "role" in rest.lower() else 0
        hints = marks & HINTS
        if name in ("html", "body"):
            hints = set()
        elif part:
            hints &= READERS
        elif top.part:  # inside an article a hint must be what the element is called, not one word of a title
            hints = whole - HEADERS
        own = 0
        if part and hints or name in NOISE and name != "form" or name == "header" and not top.part:
            own = 2
        elif hints or name == "form":
            own = 1
        noise, group = max(top.noise, own), top.group
        if noise == 1 and part and top.part < 2:
            noise = 0
        elif noise == 1 and not group and top.part < 2:
            self._readers.append(bool(hints & READERS))
            group = len(self._readers) - 1
        block = next((e for e in reversed(self._stack) if e.name in BLOCK or not e.name))
        if name in BLOCK:
            block.children.append(name + label)
        path = f"{block.path}/{name}{label}" if name in BLOCK else block.path
        self._stack.append(Element(name, path, noise, max(top.part, part), group))

    def _say(self, raw: str) -> None:
        if raw and not self._stack[-1].noise:
            text = entities.unescape(raw)
            self._text.append(text)
            if any(e.name == "a" for e in self._stack):
                self._linked += len("".join(text.split()))

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = _TAG.search(html, at)
            if m is None:
                self._say(html[at:])
                break
            self._say(html[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if m[1]:
                if name in BLOCK:
                    self._flush()
                    self._close((name,), SCOPE - {name})
                elif name == "br":
                    self._text.append(" ")
                else:
                    self._close((name,), BLOCK)
                continue
            if not m[4] and at >= n:  # the page ends inside this tag
                break
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(html, at)
                at = end.end()
                continue
            if name in BLOCK:
                self._flush()
                self._close(("p",), BLOCK - {"p"})
            if name in ENDED_BY:
                names, stop = ENDED_BY[name]
                self._close(names.split(), stop.split())
            if name == "br":
                self._text.append(" ")
            elif name not in VOID and not m[3].endswith("/"):
                self._open(name, m[3])
        self._flush()
        while len(self._stack) > 1:
            self._pop()

    def region(self, left=None) -> set[int]:
        """Numbers of the blocks of the part that the page names, of those ``left`` (all by default); empty without one."""
        left = range(len(self.blocks)) if left is None else left
        size = [0] * len(self.blocks)
        for k in left:
            size[k] = len(self.blocks[k][1])

        def chars(blocks) -> int:
            return sum(size[k] for k in blocks)

        parts: dict[int, list[int]] = {0: []}
        for k in left:
            if self.blocks[k][3]:
                parts.setdefault(self._groups[k], []).append(k)
        best = parts.pop(0)
        article = [k for k in best if self.blocks[k][3] == 2]
        best = article if 2 * chars(article) >= chars(best) else best
        for g, found in sorted(parts.items()):
            if chars(found) > (sum(size) - chars(found) if self._readers[g] else chars(best)):
                article = [k for k in found if self.blocks[k][3] == 2]
                best = article if 2 * chars(article) >= chars(found) else found
        return set(best)

    def article(self) -> int:
        """Hash of the text of the part that the page names."""
        return _hash("\n".join(self.blocks[k][1] for k in sorted(self.region())))

    def text(self, remove=None) -> str:
        """The article's blocks: of the branches that the tree leaves, those of the part that the page names, if it names one.

        ``remove`` maps a branch to the hashes of its texts to remove (null: all of them).
        """
        remove = remove or {}
        left = [k for k, (path, text, _, part) in enumerate(self.blocks)
                if (name := branch(path, part)) not in remove or remove[name] is not None and _hash(text) not in remove[name]]
        region = self.region(left) or self.region()
        return "\n".join(self.blocks[k][1] for k in (sorted(region) if region else left) if region or not self.blocks[k][3])


def branch(path: str, part: int) -> str:
    """Name of a branch of the host's tree: a path inside a named part is another branch than the same path outside."""
    return f"article:{path}" if part else path


def host_of(column):
    """Lower-cased host of a url column; null and odd urls have an empty one."""
    return F.lower(F.coalesce(F.regexp_extract(column.cast("string"), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _input(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.col("url").cast("string").alias("url"), host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))


OBSERVED = T.StructType([T.StructField("host", T.StringType()), T.StructField("branch", T.StringType()), T.StructField("kind", T.IntegerType()),
                         T.StructField("what", T.LongType()), T.StructField("chars", T.LongType()), T.StructField("linked", T.LongType()),
                         T.StructField("article", T.LongType())])


def observe(pages: DataFrame) -> DataFrame:
    """What the branches of all pages show: hashes of child sequences (kind 0) and of texts (kind 1).

    Branches inside a named part also show their article (kind 2); ``article``
    is its hash there and null elsewhere.
    """
    ship_code(pages.sparkSession)

    def run(batches):
        for b in slices(batches, 128):
            out = []
            for host, raw in zip(b["host"].to_pylist(), b["html"].to_pylist()):
                page = Page(raw)
                own = page.article() if any(x[3] for x in page.blocks) else None
                out += [(host, path, 0, _hash(children), 0, 0, None) for path, children in page.presentations if children]
                out += [(host, branch(path, part), 1, _hash(t), len(t), linked, own if part else None) for path, t, linked, part in page.blocks]
                out += [(host, name, 2, own, 0, 0, own) for name in {branch(x[0], x[3]) for x in page.blocks if x[3]}]
                out += [(host, branch(path, 2), 0, _hash(children), 0, 0, own) for path, children in page.inner if children and own is not None]
            cols = list(zip(*out)) or [()] * 7
            kinds = (pa.string(), pa.string(), pa.int32(), *(pa.int64(),) * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=OBSERVED.names)

    return _input(pages).select("host", "html").mapInArrow(run, OBSERVED)


def count_texts(observed: DataFrame) -> DataFrame:
    """(host, branch, kind, what, c, chars, linked, named): inside named parts ``c`` counts different articles, elsewhere occurrences."""
    key = ["host", "branch", "kind", "what"]
    once = observed.groupBy(*key, "article").agg(F.count("*").alias("c"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    inside = F.col("article").isNotNull()
    return once.groupBy(*key, inside.alias("named")).agg(
        F.sum(F.when(inside, 1).otherwise(F.col("c"))).alias("c"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))


def _importances(counted: DataFrame) -> DataFrame:
    look, say = F.col("kind") == 0, F.col("kind") == 1
    c = F.col("c")
    sums = counted.groupBy("host", "branch", "named").agg(
        *[F.coalesce(F.sum(F.when(k, x)), F.lit(0.0)).alias(n) for k, s in ((look, "look"), (say, "say")) for n, x in ((f"m_{s}", c), (f"clog_{s}", c * F.log(c)))],
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.coalesce(F.sum(F.when(F.col("kind") == 2, c)), F.lit(0)).alias("articles"))

    def spread(s: str):
        """log m minus the mean of log c, over log m: 1 if all differ, 0 if all are alike."""
        m = F.col(f"m_{s}")
        return F.when(m > 1, 1 - F.col(f"clog_{s}") / (m * F.log(m))).when(m == 1, 1.0).otherwise(0.0)

    free = F.when(F.col("chars") > 0, 1 - F.least(F.lit(1.0), F.col("linked") / F.col("chars"))).otherwise(1.0)
    return sums.select("host", "branch", "named", "articles", spread("look").alias("presentation"), spread("say").alias("content"),
                       (F.greatest(spread("look"), spread("say")) * free).alias("importance"))


def importances(observed: DataFrame) -> DataFrame:
    """(host, branch, presentation, content, importance) of the merged trees outside the parts that pages name."""
    return _importances(count_texts(observed)).where("NOT named").drop("named", "articles")


def removals(observed: DataFrame, least: float = LEAST) -> DataFrame:
    """(host, branch, what): branches below ``least``, whole (``what`` is null) or, inside named parts, their site-wide texts."""
    counted = materialize(count_texts(observed), "branch-texts")
    low = materialize(_importances(counted).filter(F.col("importance") < least).select("host", "branch", "named", "articles"), "low-branches")
    # few texts stand on so many articles: the frequent branch of a large host sends only those to the join
    often = counted.where(F.col("named") & (F.col("kind") == 1) & (F.col("c") >= SITE_ARTICLES)).select("host", "branch", "what", "c")
    shared = often.join(low.where("named").drop("named"), ["host", "branch"]).where(2 * F.col("c") >= F.col("articles"))
    return low.where("NOT named").select("host", "branch", F.lit(None).cast("long").alias("what")).unionByName(shared.select("host", "branch", "what"))


def _by_branch(pairs) -> dict:
    """``Page.text``'s ``remove`` of (branch, what) pairs."""
    remove: dict = {}
    for name, what in pairs:
        remove[name] = None if what is None else {*remove.get(name, ()), what}
    return remove


def extract(pages: DataFrame, least: float = LEAST, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, text) of every page."""
    ship_code(pages.sparkSession)
    low = materialize(removals(observe(pages), least), "removals")
    held = _input(pages)
    size = low.agg(F.sum(F.length("host") + F.length("branch") + 40)).first()[0] or 0
    kept = [held.schema["page_id"], held.schema["url"]]
    schema = T.StructType([*kept, T.StructField("text", T.StringType())])
    if size <= broadcast_bytes:
        found: dict[str, list] = {}
        for r in low.collect():
            found.setdefault(r["host"], []).append((r["branch"], r["what"]))
        shared = pages.sparkSession.sparkContext.broadcast({host: _by_branch(pairs) for host, pairs in found.items()})

        def run(batches):
            for b in slices(batches, 128):
                text = [Page(h).text(shared.value.get(host)) for host, h in zip(b["host"].to_pylist(), b["html"].to_pylist())]
                yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(text, pa.string())], names=schema.names)

        return held.mapInArrow(run, schema)
    return _extract_joined(held, low, schema)


def _extract_joined(held: DataFrame, low: DataFrame, schema: T.StructType) -> DataFrame:
    """The same with each page's removals joined to its row."""
    kind = T.StructType([*held.schema.fields, T.StructField("row", T.LongType()), T.StructField("branches", T.ArrayType(T.StringType()))])

    def list_branches(batches):
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        for b in slices(batches, 128):
            branches = []
            for h in b["html"].to_pylist():
                page = Page(h)
                branches.append(sorted({branch(x[0], x[3]) for x in page.blocks}))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(range(row, row + b.num_rows), pa.int64()), pa.array(branches, pa.list_(pa.string()))], names=kind.names)
            row += b.num_rows

    listed = materialize(held.mapInArrow(list_branches, kind), "page-branches")
    own = listed.select("row", "host", F.explode("branches").alias("branch")).join(low, ["host", "branch"]).groupBy("row").agg(F.collect_list(F.struct("branch", "what")).alias("remove"))

    def run(batches):
        for b in slices(batches, 128):
            text = [Page(h).text(_by_branch((x["branch"], x["what"]) for x in r or ())) for h, r in zip(b["html"].to_pylist(), b["remove"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(text, pa.string())], names=schema.names)

    return listed.drop("branches").join(own, "row", "left").mapInArrow(run, schema)
