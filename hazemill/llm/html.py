"""Main text of web pages: templates deduced from equivalence classes of tokens."""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from html import unescape
from itertools import accumulate
from urllib.parse import urlsplit

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.llm.common import map_rows, stored

#: A class is on so many pages of its host at least, and so large a part of them if it has no tag.
LEAST_PAGES, LEAST_SHARE = 3, 0.2
#: Of a class's pages so many have its tokens in one order and one place of the class around it.
REGULAR_SHARE = 0.9
#: What lies in the article's class is part of it if it is on so large a part of its pages.
NESTED_SHARE = 0.5
#: Templates of up to so many tokens together are sent to every task.
BROADCAST_TOKENS = 200_000

# What elements mean.
_RAW = "script|style|template|textarea|svg|iframe|select|button|audio|video|canvas"
#: What follows a tag's name. Outside quotes a tag ends before the next one begins, and nothing
#: is tried twice, so a tag that is never closed costs no more than its own characters.
_REST = r"(?:\"[^\"]*\"|'[^']*'|[^<>\"']++)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<(?P<raw>{_RAW})\b{_REST}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attributes>{_REST})>"
    r"|<[!?/][^<>]*>|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
_NAMED = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var object math annotation mfrac mi mn mo mover mroot mrow ms"
    " mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
_SPACE = frozenset(("br", "wbr", "img"))
_DROPPED = frozenset("head nav footer aside form menu title".split())
_MAIN = frozenset(("article", "main"))
_MAIN_NAME = re.compile(r"(?i)\b(article-?body|main-?content|post-?(content|body)|entry-?content|story-?body)\b")
#: Parts of a class that make it boilerplate, and parts that such a class may have besides.
_BOILERPLATE = re.compile(
    r"(?i)ads?|adsby\w*|advert\w*|sponsor\w*|banner|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal"
    r"|sidebar|widget|menu|nav\w*|breadcrumbs?|header|masthead|footer|foot|comments?(list)?|disqus|repl(y|ies)"
    r"|social|share|sharing|related|newsletter|subscribe|signup|login|search|pagination|pager|skip|hidden"
)
_BESIDES = re.compile(
    r"(?i)area|articles|bar|block|body|bottom|box|buttons?|container|desktop|footer|form|global|inner|item|left|links?|list|main"
    r"|mobile|outer|overlay|page|panel|posts?|primary|right|secondary|section|side|site|slot|thread|top|user|wrap(per)?|\d*"
)
_CLASS = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
#: Elements that no class makes boilerplate.
_NEVER = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())


def _is_boilerplate(attributes: str, inside: bool) -> bool:
    """Whether a whole class, role or id (no id in an article: there it is a link's target)
    says so: all its parts are boilerplate, or usual beside one that is."""
    for kind, value in _CLASS.findall(attributes):
        if inside and kind.lower() == "id":
            continue
        for name in value.strip("\"'").split():
            parts = [x for x in re.split(r"[-_]+", re.sub(r"(?i)side[-_]bar", "sidebar", name)) if x]
            found = [bool(_BOILERPLATE.fullmatch(x)) for x in parts]
            if any(found) and all(f or _BESIDES.fullmatch(x) for f, x in zip(found, parts)):
                return True
    return False


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


class Page:
    """A page as tokens: tags and texts told apart by the elements that they are in.

    ``tokens`` has the 64-bit number of each (odd for tags, even for texts); ``texts`` has, in
    page order, the number, the block and the text of every text outside dropped elements, and
    the number of the tag that opens the article around it (0 if none does).
    """

    def __init__(self, html: str) -> None:
        self.tokens: list[int] = []
        self.texts: list[tuple[int, int, str, int]] = []
        stack: list[tuple[str, str, bool, int]] = []  # tag, path, dropped, the article's tag
        still_open: Counter[str] = Counter()  # of the tags in the stack
        block, path, dropped, main = 0, "", False, 0
        for m in _TOKEN.finditer(html):
            text, tag = m["text"], m["tag"]
            if text is not None:
                number = self._number(path, text) & -2
                if text.strip():
                    self.tokens.append(number)
                if not dropped:
                    self.texts.append((number, block, unescape(text), main))
                continue
            if tag is None:
                continue
            tag = tag.lower()
            if tag in _SPACE:
                if not dropped:
                    self.texts.append((0, block, " ", main))
                continue
            if tag in _INLINE:
                continue
            block += 1
            if tag in _VOID or m["end"]:
                number = self._number(path, f"<{m['end']}{tag}>") | 1
                self.tokens.append(number)
            if tag in _VOID:
                continue
            if m["end"]:
                while still_open[tag]:
                    closed = stack.pop()[0]
                    still_open[closed] -= 1
                    if closed == tag:
                        break
            else:
                if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                    still_open[stack.pop()[0]] -= 1  # these end where the next one begins
                names = " ".join(x.strip("\"'") for x in _NAMED.findall(m["attributes"]))
                opens = tag in _MAIN or bool(names and _MAIN_NAME.search(names))
                if opens:  # an article in an unclosed menu or notice is none of it
                    while stack and stack[-1][2] and not stack[-1][3] and stack[-1][0] != "aside":
                        still_open[stack.pop()[0]] -= 1
                _, above, drop, inside = stack[-1] if stack else ("", "", False, 0)
                number = self._number(above, f"<{tag}>{names}") | 1
                self.tokens.append(number)
                boiler = bool(names) and not opens and tag not in _NEVER and _is_boilerplate(m["attributes"], bool(inside))
                drop = drop or tag in _DROPPED or boiler or (tag == "header" and not inside)
                stack.append((tag, f"{above}/{tag}.{names}" if len(above) < 400 else above, drop, number if opens else inside))
                still_open[tag] += 1
            path, dropped, main = stack[-1][1:] if stack else ("", False, 0)

    @staticmethod
    def _number(path: str, token: str) -> int:
        key = f"{path}\0{' '.join(token.split())}".encode("utf-8", "replace")
        return xxhash.xxh64_intdigest(key) - (1 << 63)

    def extract(self, template: Template) -> str:
        """The slots that the template leaves of the article; of the whole page but its
        dropped elements, if it has no article. In an article only what belongs to its own
        class is template: a text that merely some other pages repeat is content."""
        has_main = any(main and text.strip() for _, _, text, main in self.texts)
        blocks: dict[int, list[str]] = {}
        for number, block, text, main in self.texts:
            if (main and not template.is_part(number, main)) if has_main else number not in template.of:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n\n".join(line for line in lines if line)

    def forms(self, template: Template) -> Iterator[tuple[int, bool, int, int, int, int]]:
        """How each class lies on the page: ``class_id, regular, form, parent_id, gap, span``.

        A class is regular here if its tokens come in one order, over and over (``form`` is a
        number of that order), and each time inside one and the same gap of one other class
        (``parent_id``, 0 for none, and ``gap``). Of two that cross, the one on fewer pages is
        not, unless it occurs once: as a layout's own texts lie in several gaps of what layouts
        share, it then lies in the widest class, and ``gap`` is a number of these gaps. ``span``
        tells apart what lies between the first and last token.
        """
        tokens = self.tokens
        where: dict[int, list[int]] = {}
        for i, token in enumerate(tokens):
            if token in template.of:
                where.setdefault(template.of[token], []).append(i)
        order: dict[int, dict[int, int]] = {}  # of a class that is regular so far: its tokens' places
        for name, at in where.items():
            found = [tokens[i] for i in at]
            places = {token: n for n, token in enumerate(dict.fromkeys(found))}
            size = len(places)
            if size > 1 and all(places[token] == n % size for n, token in enumerate(found)):
                order[name] = places
        crossing: set[int] = set()
        parents: dict[int, tuple[int, int]] = {}
        stack: list[int] = []  # classes whose tokens are being passed
        reached: dict[int, int] = {}  # of those, the place of the last token
        for token in tokens:
            name = template.of.get(token, 0)
            if name not in order or name in crossing:
                continue
            place = order[name][token]
            if place == 0:
                # What has fewer pages has none of this class inside.
                while stack and (stack[-1] not in reached or template.pages[stack[-1]] < template.pages[name]):
                    if reached.pop(stack[-1], None) is not None:
                        crossing.add(stack[-1])
                    stack.pop()
                parent = (stack[-1], reached[stack[-1]]) if stack else (0, 0)
                if parents.setdefault(name, parent) != parent:
                    crossing.add(name)
                    continue
                stack.append(name)
            while stack and stack[-1] != name and name not in crossing:
                if stack[-1] in reached and template.pages[stack[-1]] > template.pages[name]:
                    crossing.add(name)
                    reached.pop(name, None)
                else:
                    above = stack.pop()
                    if reached.pop(above, None) is not None:
                        crossing.add(above)
            if name in crossing:
                continue
            reached[name] = place
            if place == len(order[name]) - 1:
                del reached[stack.pop()]
        once = [name for name in order if len(where[name]) == len(order[name])]
        widest = max(once, key=lambda name: (template.pages[name], len(order[name]), name), default=0)
        once = set(once)
        sums = [0, *accumulate(tokens)]
        for name, at in where.items():
            regular = name in order and name not in crossing
            if name in crossing and name in once:
                regular = True
                gaps = repr([bisect(where[widest], i) for i in at]).encode()
                parents[name] = (widest, xxhash.xxh32_intdigest(gaps)) if name != widest else (0, 0)
            form = xxhash.xxh64_intdigest(repr(list(order[name])).encode()) - (1 << 63) if regular else 0
            span = (sums[at[-1] + 1] - sums[at[0]]) % (1 << 63)
            yield name, regular, form, *(parents[name] if regular else (0, 0)), span


class Template:
    """The classes of a host: ``of`` has a token's class, ``pages`` a class's pages, and
    ``parent`` the class that one lies in. Rows are ``token, class_id, parent_id, pages, tags``."""

    def __init__(self, rows: Iterable[tuple[int, int, int, int, bool]] = ()) -> None:
        self.of: dict[int, int] = {}
        self.pages: dict[int, int] = {}
        self.parent: dict[int, int] = {}
        for token, name, parent, pages, tags in rows:
            self.of[token] = name
            self.pages[name] = pages
            self.parent[name] = parent if tags else 0

    def is_part(self, token: int, article: int) -> bool:
        """Whether a text is of the class that opens the article, or of one nested in it."""
        name, top = self.of.get(token, 0), self.of.get(article, 0)
        passed = 0
        while name and top and name != top and passed < len(self.parent):
            above = self.parent.get(name, 0)
            if self.pages[name] < NESTED_SHARE * self.pages.get(above, 0):
                return False
            name, passed = above, passed + 1
        return bool(name) and name == top


def _with_host(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host``: the one column that tells a page's host."""

    @F.pandas_udf("string")
    def host(urls: pd.Series) -> pd.Series:
        return urls.map(host_of)

    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return given.withColumn("host", host("url"))


def _occurrences(pages: DataFrame) -> DataFrame:
    """``host, token, times, mark`` of every page; ``mark`` is the page's own number."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            hosts, tokens, times, marks = [], [], [], []
            for host, url, page, html in zip(*(batch[k].to_pylist() for k in ("host", "url", "page_id", "html"))):
                mark = xxhash.xxh32_intdigest(f"{page}\0{url}".encode("utf-8", "replace"))
                for token, n in Counter(Page(html or "").tokens).items():
                    hosts.append(host)
                    tokens.append(token)
                    times.append(n)
                    marks.append(mark)
                if len(hosts) >= 100_000:
                    yield {"host": hosts, "token": tokens, "times": times, "mark": marks}
                    hosts, tokens, times, marks = [], [], [], []
            yield {"host": hosts, "token": tokens, "times": times, "mark": marks}

    return map_rows(pages, run, "host string, token long, times long, mark long")


def _per_page(
    hosted: DataFrame, tokens: DataFrame, work: Callable[[dict, list[Template]], dict], schema: str
) -> DataFrame:
    """``work`` over the batches of pages, each page with its host's template.

    ``tokens`` is ``host, token, class_id, parent_id, pages, tags``. Pages are not shuffled
    while it is small; if it is larger both are joined by host.
    """
    if tokens.count() <= BROADCAST_TOKENS:
        rows: dict[str, list[tuple]] = {}
        for host, *row in zip(*(column.to_pylist() for column in tokens.toArrow().columns)):
            rows.setdefault(host, []).append(tuple(row))
        shared = hosted.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[dict]) -> Iterator[dict]:
            known: dict[str, Template] = {}
            for batch in batches:
                hosts = batch["host"].to_pylist()
                for host in hosts:
                    if host not in known:
                        known[host] = Template(shared.value.get(host, ()))
                yield work(batch, [known[host] for host in hosts])

        return map_rows(hosted, run, schema)

    fields = tokens.columns[1:]
    listed = tokens.groupBy("host").agg(F.collect_list(F.struct(*fields)).alias("template"))

    def run_joined(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            given = batch["template"].to_pylist()
            yield work(batch, [Template([tuple(row[f] for f in fields) for row in rows or ()]) for rows in given])

    return map_rows(hosted.join(listed, "host", "left"), run_joined, schema)


def templates(pages: DataFrame) -> DataFrame:
    """``host, token, class_id, parent_id, pages, tags``: the template tokens of every host.

    The occurrence vector of a token has its count on each page of the host. It is never
    written out: its length, sum and two weighted sums are, which partial aggregation adds
    up, and tokens with equal ones form a class. A class of two tokens or more on enough pages
    is valid if on nearly all of them its tokens come in one order and inside one gap of the
    class around it, ``parent_id`` (0: none), and if something between them differs from page to
    page: without that slot it is a passage that pages repeat. ``tags`` tells whether a class
    has a tag.
    """
    return _templates(_with_host(pages))


def _templates(hosted: DataFrame) -> DataFrame:
    seen = _occurrences(hosted).groupBy("host", "token").agg(
        F.count("*").alias("pages"),
        F.sum("times").alias("times"),
        F.sum(F.col("times").cast("decimal(20,0)") * F.col("mark")).alias("weighted"),
        F.sum(F.col("times") * F.col("times")).alias("squares"),
    )
    seen = stored(seen.filter(F.col("pages") >= LEAST_PAGES), "html-tokens")
    vector = ["host", "pages", "times", "weighted", "squares"]
    is_tag = F.col("token").bitwiseAND(F.lit(1)) == 1
    classes = seen.groupBy(*vector).agg(F.count("*").alias("size"), F.max(is_tag).alias("tags")).filter("size >= 2")
    most = seen.groupBy("host").agg(F.max("pages").alias("all_pages"))
    classes = classes.join(most, "host").filter(F.col("tags") | (F.col("pages") >= LEAST_SHARE * F.col("all_pages")))
    classes = classes.withColumn("class_id", F.xxhash64("pages", "times", "weighted", "squares"))
    candidates = stored(
        seen.join(classes.select(*vector, "class_id", "tags"), vector).select(
            "host", "token", "class_id", F.lit(0).cast("long").alias("parent_id"), "pages", "tags"
        ),
        "html-classes",
    )

    def forms(batch: dict, known: list[Template]) -> dict:
        rows = [
            (host, *row)
            for host, html, template in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), known)
            for row in Page(html or "").forms(template)
        ]
        return dict(zip(names, zip(*rows))) if rows else {name: [] for name in names}

    schema = "host string, class_id long, regular boolean, form long, parent_id long, gap long, span long"
    names = [field.split()[0] for field in schema.split(",")]
    form = ["regular", "form", "parent_id", "gap"]
    lies = _per_page(hosted, candidates, forms, schema).groupBy("host", "class_id", *form).agg(
        F.count("*").alias("n"), F.min("span").alias("low"), F.max("span").alias("high")
    )
    nested = lies.groupBy("host", "class_id").agg(
        F.max(F.struct("n", *form)).alias("most"), F.sum("n").alias("on"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    valid = nested.filter(
        F.col("most.regular") & (F.col("most.n") >= REGULAR_SHARE * F.col("on")) & (F.col("low") != F.col("high"))
    ).select("host", "class_id", F.col("most.parent_id").alias("parent_id"))
    return candidates.drop("parent_id").join(valid, ["host", "class_id"]).select(
        "host", "token", "class_id", "parent_id", "pages", "tags"
    )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every whole page.

    A null page or one without main text has an empty text of 0 characters. Pages of a host
    are those with the host name of ``url`` (null and unreadable ones are one host). One
    row per input row, repeated or without id; an empty table gives no rows; other columns
    are not looked at. Pages are not shuffled while the templates are few; more of them are
    joined by host.
    """
    given = _with_host(pages)

    def texts(batch: dict, known: list[Template]) -> dict:
        found = [Page(html or "").extract(template) for html, template in zip(batch["html"].to_pylist(), known)]
        return {"page_id": batch["page_id"], "url": batch["url"], "text": found, "n_chars": [len(t) for t in found]}

    tokens = stored(_templates(given), "html-templates")
    return _per_page(given, tokens, texts, "page_id long, url string, text string, n_chars long")
