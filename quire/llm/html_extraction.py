"""Main text of web pages by a site style tree.

Pages of a host share templates. Their DOMs are merged into one style tree: a node is the path of
(tag, class, id) from the root, and every block node with text is in it, whatever its tag. For each node the tree keeps how its content
and its children's style are distributed over the pages that show it; a branch whose content hardly varies says nothing about
its page. Importance is ``GAMMA`` x content entropy + (1 - ``GAMMA``) x style entropy, each over the log of the number of
showings (between 0 and 1); of a node that never has children, content entropy alone. A content that c showings share weighs 1 + ln c, so one text that is shown very often does not make a
template of a node whose other texts vary. Equal pages of a host count once; the host's own name is no content.

Trees are merged at three levels: by host, by host family (hosts that share a domain), and over all hosts. What n showings say
counts as w = min(1, ln n / ln ``EVIDENCE``), the rest is what was thought before: of a node of all hosts 0 if a list names its tag, role
or class (menus, footers, adverts) and 1 otherwise, of a family's node what all hosts say, of a host's node what its family says. So each
(host, node) has a score at each level, whatever the number of pages; a branch goes where the lowest of the three
is under ``THRESHOLD``. The lists are no rule of their own: they are the prior, and give way to the pages as these grow. What is never
main text whatever its entropy (scripts, styles, forms, hidden elements, readers' comments, which vary like an article) goes by its tag or
name at once. A page that the tree would leave without any text keeps all that no list names.

The tree is never gathered whole: counts of (level, node, content) are pre-aggregated before their shuffle and reduced to sums
that combine; levels meet by joins on their nodes, those of very many hosts by broadcast. Of the low branches only the topmost of each path are kept,
by host, so a list is as long as a host's template. They reach the pages by a broadcast while they take
``broadcast_bytes`` at most; beyond that by a join on (host, salt), where a host is dealt over ``salts`` tasks, and one with over
``salts * salt_pages`` pages over as many as make about ``salt_pages`` each.

Cases: null or empty html gives an empty text; a null url is a host of its own; repeated rows give repeated results; ties
(a score at the threshold) stay; very long pages are parsed whole, and without recursion; an empty table gives none;
extra columns are ignored; unclosed tags are closed by what follows and a cut-off tag ends the page.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Table
from .near_copies import meet

GAMMA, THRESHOLD, EVIDENCE, SALTS, SALT_PAGES = 0.9, 0.85, 100, 16, 5_000
#: A host with over this part of all pages may get more salts; there are HOT_PARTS of them at most.
HOT_PARTS = 1000
#: Low branches are broadcast up to so many bytes, at ROW_BYTES a branch.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 48

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[/!?a-zA-Z](?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>|<[/!?a-zA-Z][^<>]*+>?|[^<]++|<""", re.S)
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
#: One attribute: its name and its value, so that a search never looks inside a value.
ATTR = re.compile(r"""([^\s/>="'][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
USED = frozenset("class id role hidden style aria-hidden".split())

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg object canvas audio video textarea title xmp".split())
#: Never main text.
NEVER_TAGS = RAW | frozenset("head menu button select dialog fieldset annotation annotation-xml".split())
NEVER_NAMES = frozenset("disqus disqus_thread".split())
#: Names of readers' comments and their parts, but not those that say that a page has, takes or closes comments.
COMMENTS = re.compile(r"(?!(?:has|have|with|without|no|allow|show|hide|open|close|closed|enable|enabled)[-_])(?:[a-z0-9]+[-_]{1,2})*comments?(?:list|area|section|thread|wrap|wrapper|box|body|text|respond|item|block|container|feed|s)?(?:[-_]{1,2}(?!open|close|closed|enabled|disabled|on|off)[a-z0-9]+)*")
#: Not main text to begin with.
LIKELY_TAGS = frozenset("nav header footer aside".split())
LIKELY_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog toolbar".split())
#: Whole class names and ids, so that "with-sidebar" or "article-header" are none.
LIKELY_NAMES = frozenset(
    """ad ads adv advert adverts advertisement adbox ad-box adslot ad-slot sponsor sponsored promo promotion banner nav navbar navigation menu main-menu breadcrumb breadcrumbs
    footer site-footer page-footer header site-header page-header masthead sidebar side-bar widget widgets cookie cookies cookie-notice cookie-banner cookie-consent consent gdpr
    notice popup modal overlay share sharing share-buttons social-share related related-posts recommended newsletter subscribe signup login pagination pager skip-link toolbar""".split()
)
INLINE = frozenset(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr
    math semantics mrow mi mo mn ms mtext mspace msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mpadded mfenced menclose mphantom""".split()
)
LANDMARK = frozenset(("article", "main"))
#: A start tag of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: A start tag of the first ends an open one of the second, within the same list or table.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table html body article main section div".split())


class Node:
    __slots__ = ("tag", "style", "path", "never", "likely", "parent", "parts")

    def __init__(self, tag: str, style: str, parent: Node | None, never: bool, likely: bool):
        self.tag, self.style, self.never, self.likely, self.parent = tag, style, never, likely, parent
        self.path = xxhash.xxh64_intdigest(style, parent.path if parent else 0) >> 1
        self.parts: list = []  # of str, Node


def attributes(tag: str, at: int) -> dict[str, str]:
    """The attributes that are used here, from the text of a start tag; the first of a name holds."""
    found: dict[str, str] = {}
    for name, a, b, c in ATTR.findall(tag, at):
        if (name := name.lower()) in USED:
            found.setdefault(name, a or b or c)
    return found


def parse(html: str) -> Node:
    """The page's element tree without what is never main text; character references are decoded in its strings."""
    root = Node("#", "#", None, False, False)
    stack = [root]
    raw = None
    for m in TOKEN.finditer(html):
        s = m.group()
        if raw:  # only its own end tag ends it
            if s[:2] == "</" and s[2 : 2 + len(raw)].lower() == raw:
                raw = None
            continue
        if s[0] != "<" or len(s) == 1:
            if not stack[-1].never:
                stack[-1].parts.append(unescape(s) if "&" in s else s)
            continue
        if s[1] in "!?":
            continue
        t = TAG.match(s)
        if not t:
            continue
        tag = t.group(1).lower()
        if s[1] == "/":
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in ENDS_P:
            close(stack, ("p",), INLINE)
        elif tag in ENDS:
            close(stack, ENDS[tag], None)
        if tag in VOID:
            stack[-1].parts.append(" ")
            continue
        style, never, likely = tag, tag in NEVER_TAGS or stack[-1].never, tag in LIKELY_TAGS and not (tag == "header" and within(stack))
        if len(s) > t.end() + 1:
            found = attributes(s, t.end())
            names = " ".join(x for x in (found.get("class"), found.get("id")) if x).lower()
            if names:
                style = f"{tag}.{names}"
            if tag not in ("html", "body", *LANDMARK):
                own = names.split()
                never = never or not NEVER_NAMES.isdisjoint(own) or ("comment" in names and any(COMMENTS.fullmatch(x) for x in own))
                likely = likely or not LIKELY_NAMES.isdisjoint(own) or found.get("role", "").lower() in LIKELY_ROLES
                never = never or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        node = Node(tag, style, stack[-1], never, likely)
        if not never:
            stack[-1].parts.append(node)
        if s.endswith("/>") and tag in RAW:
            continue
        if tag in ("script", "style", "textarea", "title", "xmp", "noscript", "iframe"):
            raw = tag
            continue
        stack.append(node)
    forms(root)
    return root


def within(stack: list[Node]) -> bool:
    """In an article or main element a header is the article's own."""
    return any(x.tag in LANDMARK for x in stack)


def forms(root: Node) -> None:
    """A form is no main text, unless it wraps an article or the page's main element."""
    held: list[tuple[Node, Node]] = []
    todo = [root]
    landmarks = set()
    while todo:
        x = todo.pop()
        if x.tag == "form":
            held.append((x, x.parent))
        if x.tag in LANDMARK:
            while x.parent is not None and id(x) not in landmarks:
                landmarks.add(id(x))
                x = x.parent
            continue
        todo.extend(c for c in x.parts if isinstance(c, Node))
    for form, parent in held:
        if id(form) not in landmarks:
            parent.parts.remove(form)


def close(stack: list[Node], tags: tuple[str, ...], through: frozenset | None) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in SCOPE or (through is not None and stack[i].tag not in through):
            return


def blocks(root: Node, low: frozenset = frozenset(), lists: bool = True) -> list[str]:
    """The text of every block that stays, white space made one space. ``low`` are nodes that go; with ``lists`` those that a list names do too."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run and (t := " ".join("".join(run).split())):
            out.append(t)
        run.clear()

    todo: list = [root]
    while todo:  # not by recursion: pages can be nested deeply
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.path not in low and not (lists and x.likely):
            inline = x.tag in INLINE
            if not inline:
                flush()
                todo.append(None)
            todo.extend(reversed(x.parts))
    flush()
    return out


def features(root: Node, name: str = "") -> set[tuple[int, int, int, int, bool]]:
    """(node, parent, content, style of children, whether a list names it) of the page's block nodes with text, each once."""
    out = set()
    order: list[Node] = []
    todo = [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo.extend(c for c in x.parts if isinstance(c, Node))
    held: dict[int, tuple[int, bool]] = {}
    for x in reversed(order):  # children before parents
        content, some = xxhash.xxh64(), False
        for c in x.parts:
            if isinstance(c, str):
                t = " ".join(c.split())
                some = some or bool(t)
                content.update(t.replace(name, "") if name else t)
            else:
                digest, inside = held.pop(id(c))
                some = some or inside
                content.update(digest.to_bytes(8, "little"))
        held[id(x)] = digest, _ = content.intdigest(), some
        if some and x.tag not in INLINE and x.tag not in ("#", "html", "body"):
            style = xxhash.xxh64_intdigest("|".join(c.style for c in x.parts if isinstance(c, Node)))
            out.add((x.path, x.parent.path, digest >> 1, style >> 2, x.likely))
    return out


def host(url) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


#: Second-level labels under which countries give out domains; with them a domain has three labels.
SECOND_LEVEL = "ac co com edu gov gob net ne or org".split()


def family(host_) -> F.Column:
    """The host's domain: its last two labels, or three where the last is a country's and the one before is for all (co.uk); an address of digits is its own."""
    name = F.regexp_replace(host_, r":[0-9]*$", "")
    wide = name.rlike(rf"(^|\.)({'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}$")
    last = F.when(wide, F.regexp_extract(name, r"([^.]*\.?[^.]*\.[^.]*)$", 1)).otherwise(F.regexp_extract(name, r"([^.]*\.?[^.]*)$", 1))
    return F.concat(F.lit("*."), F.when(host_.rlike(r"[a-z]"), last).otherwise(host_))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: tuple[list, ...] = ([], [], [], [], [], [], [])
        for h, f, name, html in zip(*[batch.column(c).to_pylist() for c in ("host_key", "family_key", "host", "html")], strict=True):
            page = xxhash.xxh64_intdigest((html or "").encode("utf-8", "surrogatepass"), h & 0xFFFFFFFF) >> 1  # by host: equal pages of two hosts are two
            for node, parent, content, style, likely in features(parse(html or ""), name):
                for c, v in zip(cols, (h, f, page, node, parent, content, style << 1 | likely), strict=True):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["host_key", "family_key", "page", "node", "parent", "content", "style"])


ALL = 0  # the level of all hosts
NO_CHILDREN = xxhash.xxh64_intdigest("") >> 2  # the style of a node without children


def style_tree(pages: DataFrame) -> DataFrame:
    """(level, above, node, parent, likely, n, importance) of the merged trees; pages has host and html.

    ``level`` is a hash of the host or its family, or ALL; ``above`` is the next wider one, null for ALL.
    """
    pages = pages.select("host", "html", F.xxhash64("host").alias("host_key"), F.xxhash64(family(F.col("host"))).alias("family_key"))
    seen = pages.mapInArrow(_feature_rows, "host_key long, family_key long, page long, node long, parent long, content long, style long")
    likely = F.max(F.col("style").bitwiseAND(F.lit(1)) == 1).alias("likely")
    pairs = seen.groupBy("host_key", "family_key", "node", "content", "style").agg(F.countDistinct("page").alias("c"), F.min("parent").alias("parent"), likely)
    all_, none = F.lit(ALL).cast("long"), F.lit(None).cast("long")
    levels = F.array(*[F.struct(x.alias("level"), y.alias("above")) for x, y in ((F.col("host_key"), F.col("family_key")), (F.col("family_key"), all_), (all_, none))])
    pairs = pairs.select(F.explode(levels).alias("l"), "node", "parent", "likely", "content", "style", "c").select("l.*", "node", "parent", "likely", "content", "style", "c")
    w = 1 + F.log("c")

    def entropy(of: str) -> DataFrame:
        own = [F.min(c).alias(c) for c in ("above", "parent")] + [F.max("likely").alias("likely")] if of == "content" else [F.min("leaf").alias("leaf")]
        each = pairs.withColumn("leaf", F.shiftright("style", 1) == NO_CHILDREN).groupBy("level", "node", of).agg(F.sum("c").alias("c"), *own)
        sums = each.groupBy("level", "node").agg(F.sum("c").alias("n"), F.sum(w).alias("w"), F.sum(w * F.log(w)).alias("s"), *own)
        value = F.when(F.col("n") < 2, 1.0).otherwise(F.greatest(F.log("w") - F.col("s") / F.col("w"), F.lit(0.0)) / F.log("n"))
        return sums.select("level", "node", *(("above", "parent", "likely", "n") if of == "content" else ("leaf",)), value.alias(of))

    both = entropy("content").join(entropy("style").select("level", "node", "style", "leaf"), ["level", "node"])
    mixed = F.when(F.col("leaf"), F.col("content")).otherwise(GAMMA * F.col("content") + (1 - GAMMA) * F.col("style"))
    return both.select("level", "above", "node", "parent", "likely", "n", mixed.alias("importance"))


def scores(spark: SparkSession, tree: DataFrame, evidence: int = EVIDENCE, lists: bool = True) -> DataFrame:
    """(level, node, parent, score) of every node of every host: the lowest of its scores at the three levels (see the module).

    Without ``lists`` nothing is thought of a node before.
    """
    counts = F.least(F.lit(1.0), F.log(F.col("n").cast("double")) / math.log(evidence))
    tree = Table(spark, tree.select("level", "above", "node", "parent", "likely", counts.alias("w"), "importance")).df
    value = lambda prior: F.col("w") * F.col("importance") + (1 - F.col("w")) * prior
    hosts = lambda df: df.withColumn("key", F.xxhash64("above", "node"))
    star = tree.where(F.col("level") == ALL).withColumn("score", value(F.when(F.col("likely") & F.lit(lists), 0.0).otherwise(1.0)))
    wide = star.select(F.xxhash64("level", "node").alias("key"), F.col("score").alias("before"), F.col("score").alias("low"))
    for below in (tree.where(F.col("above") == ALL), tree.where((F.col("level") != ALL) & (F.col("above") != ALL))):
        mine = hosts(below)
        fan = mine.groupBy("key").agg(F.count("*").alias("fan"))
        wide_ = Table(spark, wide.join(fan, "key")).df  # every node below has its node above
        joined = meet(mine, wide_, "key", "fan", max(below.count() / HOT_PARTS, 1)).withColumn("score", value(F.col("before")))
        joined = joined.select("level", "node", "parent", "score", F.least("score", "low").alias("low"))
        wide = joined.select(F.xxhash64("level", "node").alias("key"), F.col("score").alias("before"), "low")
    return joined.select("level", "node", "parent", F.col("low").alias("score"))


def verdicts(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(level, node): the nodes of each host that go, topmost ones only."""
    low = scored.where(F.col("score") < threshold)
    return low.join(low.select("level", F.col("node").alias("parent")), ["level", "parent"], "left_anti").select("level", "node")


def extract(spark: SparkSession, pages: DataFrame, threshold: float = THRESHOLD, evidence: int = EVIDENCE, lists: bool = True, salts: int = SALTS, salt_pages: int = SALT_PAGES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    scored = Table(spark, scores(spark, style_tree(pages), evidence, lists)).df
    found = Table(spark, verdicts(scored, threshold)).df
    templates = found.groupBy(F.col("level").alias("host_key")).agg(F.collect_list("node").alias("low"))  # as long as a host's template
    dealt = pages.withColumn("host_key", F.xxhash64("host"))
    if found.count() * ROW_BYTES <= broadcast_bytes:
        dealt = dealt.join(F.broadcast(templates), "host_key", "left")
    else:
        least = max(pages.count() / HOT_PARTS, salts * salt_pages)
        large = dealt.groupBy("host_key").count().where(F.col("count") > least).select("host_key", F.ceil(F.col("count") / salt_pages).cast("int").alias("more"))
        large = F.broadcast(spark.createDataFrame(large.collect(), "host_key long, more int"))  # under HOT_PARTS rows
        salts_of = F.coalesce("more", F.lit(salts))
        side = templates.join(large, "host_key", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts_of - 1))).drop("more")
        salted = dealt.join(large, "host_key", "left").withColumn("salt", F.pmod(F.xxhash64("page_id", "url", F.xxhash64("html")), salts_of).cast("int")).drop("more")
        dealt = salted.join(side, ["host_key", "salt"], "left").drop("salt")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html, low in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True):
                root = parse(html or "")
                out.append("\n".join(blocks(root, frozenset(low or ()), lists=False) or blocks(root)))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return dealt.select("page_id", "url", "html", "low").mapInArrow(texts, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
