"""Main text of web pages, by container paths that the pages of a host agree on.

A container is a block element that holds others, and its path is the chain of tags and classes down
to it, digits generalised. Every page scores its containers by their text; per host, Spark adds up the
votes of all pages and the path with most of them wins. Where the rest of an article stands beside that
container, in a wrapper of both, the wrapper wins: its other text differs from page to page, which what
surrounds an article doesn't. A second pass extracts the path from each page.
"""

import re
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import functions as F

from pergamon.llm.graph import stored
from pergamon.llm.text import text_bytes

#: Elements whose text never counts.
SKIPPED = frozenset(
    "head title script style noscript template svg math canvas iframe object video audio map nav header footer "
    "aside form button select textarea input label menu dialog".split())

#: Words that mark what surrounds an article: as a whole class or role of any element, as a word of a class of
#: a container or list, and as the id of one if no word of it is other than these and AROUND. Generated ids of
#: headings and sections are their titles, so one word says nothing there.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs header masthead footer comment comments respond disqus cookie cookies "
    "consent notice notices popup modal newsletter subscribe signup login share sharing social related recommended "
    "pagination pager widget toolbar hidden complementary contentinfo search".split())

AROUND = frozenset(
    "site page top bottom left right main box bar wrapper wrap container area block list section links global primary "
    "secondary slot unit outer inner".split())

#: Words beside which these marks name a part of the article, as in `post-header`.
PARTS = frozenset("article post entry story content page section chapter title".split())
PART_MARKS = frozenset(("header", "masthead"))

#: Elements of which a word of a class, or the id, can be a mark.
MARKABLE = frozenset("blockquote center details div dl fieldset li ol section span table tbody td th tr ul".split())

#: Elements that hold no text end at once.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())

#: Blocks that are containers; articles and the like get more weight.
CONTAINERS = frozenset("article blockquote body div main section table td".split())
ARTICLES = frozenset(("article", "main"))

#: Permille of a container's score that its parent gets too, and the weight of an article's votes.
INHERITED = 500
ARTICLE_WEIGHT = 2

#: Winning paths are sent to the tasks whole if they have at most so many bytes; else they are joined.
BROADCAST_BYTES = 8 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe")}
_MARKING = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"[0-9]+")


def _attributes(tag, text):
    """(whether it is marked or hidden, generalised classes) of a tag's attributes."""
    classes, marked = [], False
    for m in _MARKING.finditer(text):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "style":
            marked |= "display:none" in value.replace(" ", "")
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            marked = True
        elif name == "id":
            words = set(_WORDS.findall(value))
            marked |= tag in MARKABLE and not MARKS.isdisjoint(words) and words <= MARKS | AROUND
        elif name in ("class", "role"):
            for token in value.split():
                words = {token}
                if tag in MARKABLE and not token.startswith(("has-", "with-", "no-", "is-")):
                    words = set(_WORDS.findall(token))
                    words -= set() if PARTS.isdisjoint(words) else PART_MARKS
                marked |= not MARKS.isdisjoint(words)
            if name == "class":
                classes = sorted({_DIGITS.sub("#", c).replace("/", "|") for c in value.split()})
    return marked, classes


class Page:
    """Blocks of a page in order: (text, containers above it, inside a link only)."""

    def __init__(self, html):
        self.paths, self.parents, self.tags, self.blocks = [], [], [], []
        self._stack, self._open, self._skip, self._links = [], {}, 0, 0
        self._parts, self._linked = [], 0
        self._container = -1
        at, raw = 0, None
        while True:
            m = _TOKEN.search(html, at)
            if not m:
                break
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:-3], decode=False)
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
            else:
                self._begin(tag, m[3])
                raw = _RAW_END.get(tag)
                if raw and not m[3].rstrip().endswith("/"):
                    end = raw.search(html, at)
                    at = end.end() if end else len(html)
                    self._close(tag)
        if at < len(html):
            self._text(html[at:])
        self._flush()

    def _text(self, text, decode=True):
        if not self._skip:
            text = unescape(text) if decode and "&" in text else text
            self._parts.append(text)
            if self._links:
                self._linked += len(text)

    def _flush(self):
        text = " ".join("".join(self._parts).split())
        if text:
            self.blocks.append((text, self._container, 2 * self._linked > len(text)))
        self._parts, self._linked = [], 0

    def _begin(self, tag, attributes):
        if tag == "br":
            self._text(" ", decode=False)
        if tag in ARTICLES and self._skip:
            while self._skip:  # an element that was never closed doesn't swallow an article
                self._pop()
        if tag in BLOCKS:
            self._flush()
        if tag in VOID:
            return
        before, skip, linked = self._container, tag in SKIPPED, tag == "a"
        if not skip and (tag in BLOCKS or tag == "span") and attributes:
            marked, classes = _attributes(tag, attributes)
            skip = marked and tag not in ARTICLES and tag != "body"
        else:
            classes = ()
        if tag in CONTAINERS and not skip and not self._skip:
            name = ".".join((tag, *classes))
            self.parents.append(before)
            self.paths.append(f"{self.paths[before]}/{name}" if before >= 0 else name)
            self.tags.append(tag)
            self._container = len(self.paths) - 1
        self._skip += skip
        self._links += linked
        self._stack.append((tag, before, skip, linked))
        self._open[tag] = self._open.get(tag, 0) + 1

    def _pop(self):
        tag, before, skip, linked = self._stack.pop()
        if tag in BLOCKS:
            self._flush()
        self._open[tag] -= 1
        self._container = before
        self._skip -= skip
        self._links -= linked
        return tag

    def _close(self, tag):
        if tag in BLOCKS:
            self._flush()
        if self._open.get(tag):
            while self._pop() != tag:
                pass

    def votes(self):
        """{path: permille of the page's score}."""
        scores = [0] * len(self.paths)
        for text, container, link in self.blocks:
            if container >= 0 and not link:
                scores[container] += len(text)
        for i in range(len(scores) - 1, -1, -1):  # a parent is always numbered before its children
            if self.parents[i] >= 0:
                scores[self.parents[i]] += scores[i] * INHERITED // 1000
        votes = {}
        for i, path in enumerate(self.paths):
            weight = ARTICLE_WEIGHT if self.tags[i] in ARTICLES else 1
            votes[path] = votes.get(path, 0) + scores[i] * weight
        total = sum(votes.values())
        return {p: v * 1000 // total for p, v in votes.items() if v * 1000 // total} if total else {}

    def own(self):
        """{path: (characters, hash)} of the text that stands in the containers of a path itself, links left out."""
        texts = {}
        for text, container, link in self.blocks:
            if container >= 0 and not link:
                texts.setdefault(self.paths[container], []).append(text)
        return {p: (sum(map(len, t)), blake2b("\n".join(t).encode("utf-8", "replace"), digest_size=8).digest())
                for p, t in texts.items()}

    def text(self, path):
        """The text of the blocks under the containers of a path; of the page's best one if it has none."""
        inside = self._under(path)
        if not any(inside):
            votes = self.votes()
            inside = self._under(min(votes, key=lambda p: (-votes[p], p))) if votes else inside
        if not any(inside):
            inside = [True] * len(self.paths)
        return "\n".join(t for t, c, _ in self.blocks if c < 0 and not self.paths or c >= 0 and inside[c])

    def _under(self, path):
        inside = []
        for i, own in enumerate(self.paths):
            inside.append(own == path or self.parents[i] >= 0 and inside[self.parents[i]])
        return inside


def _host(url):
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _votes(batches):
    for batch in batches:
        rows = []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            page = Page(html.as_py().decode("utf-8", "replace"))
            votes, own = page.votes(), page.own()
            rows += [(host, path, votes.get(path, 0), *own.get(path, (0, None))) for path in dict.fromkeys([*votes, *own])]
        columns = list(zip(*rows)) or [()] * 5
        types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         ["host", "path", "votes", "chars", "text"])


def _texts(batches):
    for batch in batches:
        texts = [Page(html.as_py().decode("utf-8", "replace")).text(path)
                 for html, path in zip(batch.column(2), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64()), batch.column(3)],
            ["page_id", "url", "text", "n_chars", "host_path"])


def _tag(path):
    """The tag of the last container of a path."""
    return F.regexp_extract(path, "([^/.]+)[^/]*$", 1)


def _under(path, above):
    return (path == above) | path.startswith(F.concat(above, F.lit("/")))


def host_paths(pages, url="url", html="html"):
    """(host, path, votes): the container of each host that holds its articles.

    The path with most votes, or the nearest wrapper of it (body, articles and what is in them apart) where more than
    half of the other text differs from page to page: has more than half as many texts as the path itself.
    """
    rows = pages.select(_host(url).alias("host"), text_bytes(html).alias("html"))
    found = rows.mapInArrow(_votes, "host string, path string, votes long, chars long, text binary")
    found = found.groupBy("host", "path", "text").agg(F.sum("votes").alias("votes"), F.sum("chars").alias("chars"))
    paths = found.groupBy("host", "path").agg(
        F.sum("votes").alias("votes"), F.sum("chars").alias("chars"), F.count("text").alias("texts"))
    paths = stored(paths, "container-paths")
    best = paths.where("votes > 0").groupBy("host").agg(
        F.min(F.struct((-F.col("votes")).alias("less"), "path")).alias("m"))
    best = best.select("host", F.col("m.path").alias("best"), (-F.col("m.less")).alias("votes"))

    open_ = best.where(~F.concat(F.lit("/"), "best").rlike("/(article|main)[./]|/(article|main)$"))
    beside = paths.where("chars > 0").join(open_.select("host", "best"), "host").withColumn(
        "inside", _under(F.col("path"), F.col("best")))
    size = beside.where("inside").groupBy("host").agg(F.max("texts").alias("n"))
    parts = F.split("best", "/")
    wrappers = open_.where(F.size(parts) > 1).select(
        "host", "best", F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("depth"))
    wrappers = wrappers.select("host", "depth", F.array_join(F.slice(parts, 1, F.col("depth")), "/").alias("wrapper"))
    wrappers = wrappers.where(~_tag(F.col("wrapper")).isin("body", "html")).join(size, "host")
    others = beside.where("NOT inside").select("host", "path", "chars", "texts").join(wrappers, "host").where(
        _under(F.col("path"), F.col("wrapper")))
    differing = F.when(2 * F.col("texts") > F.col("n"), F.col("chars")).otherwise(0)
    nearest = others.groupBy("host", "depth", "wrapper").agg(
        F.sum("chars").alias("all"), F.sum(differing).alias("differing")).where("2 * differing > all").groupBy("host").agg(
        F.max(F.struct("depth", "wrapper")).alias("w")).select("host", F.col("w.wrapper").alias("wrapper"))
    return best.join(nearest, "host", "left").select("host", F.coalesce("wrapper", "best").alias("path"), "votes")


def main_texts(pages, page_id="page_id", url="url", html="html"):
    """page_id, url, text, n_chars (code points) and host_path of every row.

    Blocks are joined by one line feed; inside a block white space, line breaks and non-breaking spaces
    become one space. Pages without a container of the winning path use their own best one; null
    and empty pages give an empty text. Pages without a host vote together. Ties between paths go to
    the first by code point. Pages aren't shuffled while the winning paths are few (BROADCAST_BYTES);
    more are joined by host, where Spark can split a hot one. Repeated rows are repeated.
    """
    winners = stored(host_paths(pages, url, html).select("host", "path"), "host-paths")
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length("path"))).first()[0] or 0
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), text_bytes(html).alias("html"),
                        _host(url).alias("host"))
    winners = F.broadcast(winners) if size <= BROADCAST_BYTES else winners
    rows = rows.join(winners, "host", "left").select("page_id", "url", "html", "path")
    id_type = pages.schema[page_id].dataType.simpleString()
    return rows.mapInArrow(_texts, f"page_id {id_type}, url string, text string, n_chars long, host_path string")
