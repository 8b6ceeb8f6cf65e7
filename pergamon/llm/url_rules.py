"""URL filtering by rules: given ones by host and path, and association rules mined from labels.

A page's label is that of the document whose number ends its URL path. FP-growth finds combinations of URL tokens that labelled rows share with a bad label. Rules below
the support, confidence or lift asked for go, and so do rules that a shorter one makes needless. An
inverted index from tokens to rules then tells which rules a URL meets.
"""

import math
import re

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

#: Fixed values: (verdict, host, path). A rule fits its host and all subdomains; the longest wins.
GIVEN = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Rows to mine at most, chosen by hash of the id; a documented bound, needed by the mining alone.
LABELLED_ROWS = 200_000

#: What a mined rule needs: share of the labelled rows and rows at least, confidence, lift.
SUPPORT = 0.002
LEAST_ROWS = 8
CONFIDENCE = 0.6
LIFT = 2.0

BAD = "label:bad"
_WORD = re.compile(r"[^\W_]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _parts(url):
    """Host and path columns of a URL column."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _given(rules):
    """The longest given rule that fits, as a struct of its name and verdict."""
    fits = []
    for verdict, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        of_host = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        fits.append(F.when(of_host & F.startswith(F.col("path"), F.lit(path)),
                           F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def _document(url):
    """The number that ends the path of a URL column, before a file extension or slash; null without one."""
    return F.regexp_extract(_parts(url)[1], r"(?:^|/)([0-9]+)(?:\.[A-Za-z0-9]+)?/?$", 1).try_cast("long")


def url_tokens(url, host, path):
    """At most ten tokens of a URL: a fixed number of views of it, none of them unbounded in count."""
    labels = host.split(".")
    steps = [s for s in path.split("/") if s]
    rest = url[url.find("://") + 3 :] if "://" in url else url
    query = rest.partition("#")[0].partition("?")[2]
    last = steps[-1] if steps else ""
    tokens = {"scheme:" + url.partition("://")[0].lower()[:16], "top:" + labels[-1], "site:" + ".".join(labels[-2:]),
              "name:" + ".".join(labels[-3:]), "sub:" + (labels[0] if len(labels) > 2 else ""),
              "dir:" + re.sub("[0-9]+", "#", steps[0] if steps else "")[:64], f"depth:{min(len(steps), 6)}",
              "end:" + (last.rpartition(".")[2][:8] if "." in last else "/" if path.endswith("/") else ""),
              "query:" + query.partition("=")[0][:32]}
    if any("-" in x for x in labels):
        tokens.add("dashed")
    return sorted(tokens)


def _worded(kind, text):
    """A piece of a URL whole and by its words, in lower case."""
    text = text.lower()
    return [kind + text, *(kind + w for w in _WORD.findall(text))]


def url_items(url, host, path):
    """All tokens of a URL: its views, and all host labels, path segments, query keys and values, the fragment, with their words."""
    rest = url[url.find("://") + 3 :] if "://" in url else url
    rest, _, mark = rest.partition("#")
    found = set(url_tokens(url, host, path))
    for label in host.split("."):
        found.update(_worded("host:", label))
    for step in path.split("/"):
        found.update(_worded("path:", step))
    for pair in re.split("[&;]", rest.partition("?")[2]):
        key, _, value = pair.partition("=")
        found.update(_worded("key:", key))
        found.update(_worded("value:", value))
    found.update(_worded("mark:", mark))
    return sorted(found)


def _tokens(batches):
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:3]]
        items = [url_items(*row) for row in zip(*columns)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.list_(pa.string())), *batch.columns[3:]], ["items", "bad", "lo", "hi"])


def _names(items, n, least):
    """{token: name} of the tokens that a rule can need; tokens of the very same rows have one name.

    A token in fewer than `least` bad rows is in no rule, and one in all rows adds nothing to any. At most
    `rows / least` times a row's tokens are left, so they fit the driver. Sets of rows are told apart by
    their number and two sums of hashes.
    """
    counts = items.select(F.explode("items").alias("item"), "bad", "lo", "hi").groupBy("item").agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"), F.sum("lo").alias("lo"), F.sum("hi").alias("hi"))
    names, first = {}, {}
    for r in sorted(counts.filter((F.col("bad") >= least) & (F.col("n") < n)).collect(), key=lambda r: r.item):
        names[r.item] = first.setdefault((r.n, r.lo, r.hi), r.item)
    return names


def mined_rules(pages, labels, label_id="doc_id", url="url", bad="quality = 0 or toxic = 1",
                support=SUPPORT, confidence=CONFIDENCE, lift=LIFT, rows=LABELLED_ROWS):
    """[(tokens, confidence)]: rules that lead to the bad label, fewest tokens first; see `mined`."""
    return mined(pages, labels, label_id, url, bad, support, confidence, lift, rows)[0]


def mined(pages, labels, label_id="doc_id", url="url", bad="quality = 0 or toxic = 1",
          support=SUPPORT, confidence=CONFIDENCE, lift=LIFT, rows=LABELLED_ROWS):
    """(rules, names): [(names, confidence)], fewest first, and the name of each token.

    Tokens that stand in the very same labelled rows have one name, and a rule is met by any of them.
    Labelled rows are pages whose URL path ends with the number of a labelled document; an id labelled more than once is bad if any label is.
    Beyond `rows` of them about as many, chosen by hash of the id, are mined. With fewer than LEAST_ROWS labelled rows,
    or without both kinds, there are no rules.
    """
    marks = labels.select(F.col(label_id).alias("_id"), F.expr(bad).alias("_bad")).filter("_id is not null").groupBy(
        "_id").agg(F.max(F.coalesce("_bad", F.lit(False))).alias("_bad"))
    found = pages.select(F.col(url).alias("url"))
    url = "url"
    host, path = _parts(F.col(url))
    known = found.join(marks, _document(F.col(url)) == F.col("_id")).select(
        F.coalesce(F.col(url), F.lit("")).alias("url"), host.alias("host"), path.alias("path"), F.col("_bad").alias("bad"), "_id")
    total = known.count()
    if total > rows:
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < int(1_000_003 * rows / total))
    hashed = F.xxhash64("url")
    known = known.select("url", "host", "path", "bad", hashed.bitwiseAND(0x7FFFFFFF).alias("lo"),
                         F.shiftrightunsigned(hashed, 33).alias("hi"))
    items = known.mapInArrow(_tokens, "items array<string>, bad boolean, lo long, hi long").persist()
    try:
        n, n_bad = items.agg(F.count("*"), F.sum(F.col("bad").cast("long"))).first()
        if n < LEAST_ROWS or not n_bad or n_bad == n:
            return [], {}
        share = max(support, LEAST_ROWS / n)
        names = _names(items, n, math.ceil(share * n - 1e-9))

        def named(batches):
            for batch in batches:
                rows = [[*sorted({names[t] for t in tokens if t in names}), *([BAD] if bad else [])]
                        for tokens, bad in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["items"])

        model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(
            items.mapInArrow(named, "items array<string>"))
        found = model.associationRules.filter(
            (F.col("consequent") == F.array(F.lit(BAD))) & (F.col("lift") >= lift)).collect()
    finally:
        items.unpersist()
    kept = []
    for row in sorted(found, key=lambda r: (len(r.antecedent), sorted(r.antecedent))):
        tokens = frozenset(row.antecedent)
        if not any(shorter < tokens and c >= row.confidence for shorter, c in kept):
            kept.append((tokens, row.confidence))
    return kept, names


class Index:
    """Rules by token: a rule is met when all its tokens, or others of their names, have been seen."""

    def __init__(self, rules, names=None):
        self.names = names
        self.sizes = [len(tokens) for tokens, _ in rules]
        self.rules = {}
        for i, (tokens, _) in enumerate(rules):
            for t in tokens:
                self.rules.setdefault(t, []).append(i)

    def meets(self, tokens):
        left = {}
        if self.names is not None:
            tokens = {self.names[t] for t in tokens if t in self.names}
        for t in tokens:
            for i in self.rules.get(t, ()):
                left[i] = left.get(i, self.sizes[i]) - 1
                if not left[i]:
                    return True
        return False


def url_verdicts(pages, labels, page_id="page_id", url="url", rules=GIVEN, **mining):
    """page_id, host, path, rule and verdict of every row.

    A given rule decides where one fits; elsewhere the verdict is block if a mined rule is met, else allow.
    Null URLs and such without :// have an empty host and path. Rows are independent and never
    shuffled; repeated rows are repeated. Mined rules are few: each holds for at least `support`
    of a bounded number of rows.
    """
    index = Index(*mined(pages, labels, url=url, **mining))
    host, path = _parts(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                        host.alias("host"), path.alias("path"))
    rows = rows.withColumn("given", _given(rules)).select(
        "page_id", "url", "host", "path", F.col("given.rule").alias("rule"), F.col("given.verdict").alias("verdict"))

    def judge(batches):
        for batch in batches:
            urls, hosts, paths, given = (batch.column(i).to_pylist() for i in (1, 2, 3, 5))
            verdicts = [v or ("block" if index.meets(url_items(u, h, p)) else "allow")
                        for u, h, p, v in zip(urls, hosts, paths, given)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:5], pa.array(verdicts, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    id_type = pages.schema[page_id].dataType.simpleString()
    return rows.mapInArrow(judge, f"page_id {id_type}, host string, path string, rule string, verdict string")
