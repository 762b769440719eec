"""Main text of web pages with a tree-structured graphical model.

Each element of a page's tree has a hidden label: content or not. Its own
evidence (tag, words of class and id, length of text, share of text in links,
paragraphs inside) and the potential between a child's and its parent's label
make a tree-shaped model; messages passed up and then down give the exact
marginal of every element. Text is taken from elements whose marginal is over
one half. Evidence and potentials are learned from labelled pages: pages whose
authors mark the article (``article``, ``main``), from a bounded sample, and
labelled layouts, combined from the parts below, for pages that mark less. The
tag that marks an article is no evidence on the page that it labels, and what
stands below a part named as comments, notice or side column has potentials of
its own, so an ``article`` among comments is not taken for the article.

Defined results: a null or empty page gives an empty text. Character
references are decoded, white space inside a block becomes one space, blocks
are trimmed and joined by a line feed in page order. Unclosed, stray or
truncated markup is repaired as browsers do for paragraphs and list items.
Pages may have any length. Repeated rows are extracted one by one; further
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from math import exp, log, log1p

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.llm.common import query, table

#: Pages that the model is fitted on, chosen by a hash of their key.
MAX_LABELLED = 500

# Element names by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript head title iframe object svg math canvas select textarea button".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td
    tfoot th thead tr ul""".split()
)
CLOSES_P = BLOCKS - frozenset("body html".split())
CLOSES_SAME = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
BOUNDARY = frozenset("ul ol dl table nav section article aside div main body form footer header".split())

# What class, id and role names say that an element is for; the first kind that is found counts.
HINTS = {
    "comments": r"comment(?!ar)|disqus|\bdiscussion|\brespond|\brepl(?:y|ies)\b|reader-?(?:letter|opinion)",
    "notice": r"\bnotice|cookie|consent|gdpr|\balert|popup|modal|overlay|toast|paywall|subscri|newsletter|\bsign-?(?:up|in)\b|login|\bdialog",
    "ad": r"\bads?\b|advert|sponsor|\bpromo|banner",
    "side": r"side-?(?:bar|col|nav|rail|panel)|right-?(?:col|rail|side|bar|panel)|widget|\brelated|recommend|trending|popular|teaser"
    r"|\bshar(?:e|ing)\b|\bsocial|complementary",
    "navigation": r"\bnav|menu|breadcrumb|\bpager|pagination|toolbar|topbar|\bskip-?link|\btoc\b",
    "frame": r"\bheader|masthead|footer|copyright|imprint|\blegal|colophon|contentinfo|byline|\bform\b|\bsearch",
    "content": r"article|content|entry|\bmain|\bpost\b|story|\btext|\bbody",
}
HINT_PATTERN = re.compile("|".join(f"(?P<{kind}>{words})" for kind, words in HINTS.items()))
#: Elements that never are the main text themselves, by the kind that they stand for.
OTHER_TAGS = {"nav": "navigation", "menu": "navigation", "aside": "side", "footer": "frame", "form": "frame", "dialog": "notice"}

# Parts of the labelled layouts. Elements with ``data-main`` are the main text, with ``data-not`` are not; {n words} stands for a text.
WRAPS = [
    "<article data-main><h1>{5}</h1>{story}</article>",
    "<main data-main><article><h1>{6}</h1>{story}</article></main>",
    "<div class=content data-main><h1>{4}</h1>{story}</div>",
    "<div id=main><div data-main><h1>{3}</h1><div>{story}</div></div></div>",
    "<div><div data-main><h1>{7}</h1>{story}</div></div>",
    '<div class="col-md-8"><section data-main><h1>{5}</h1>{story}</section></div>',
    '<div data-main class="post hentry"><header class=entry-header><h1>{6}</h1></header><div class=entry-content>{story}</div></div>',
    "<table><tr><td data-main><h1>{4}</h1>{story}</td></tr></table>",
    "<main><div data-main><h2>{5}</h2>{story}</div></main>",
    "<section data-main><h1>{8}</h1><div>{story}</div></section>",
    "<div class=leftcol data-main><h1>{4}</h1>{story}</div>",
]
STORIES = [
    "<p>{40}</p><p>{25} <a href=/x>{2}</a> {9}</p>{inside}<p>{30}</p>",
    "<p>{18}<p>{22} <em>{3}</em> {4}{inside}<h2>{3}</h2><p>{60}<ul><li>{6}<li>{9}</ul>",
    "<div><p>{12}</p><p>{15}</p></div>{inside}<blockquote><p>{14}</p></blockquote><p>{33}</p>",
    "<section><h2>{2}</h2><p>{28}</p>{inside}</section><section><h2>{3}</h2><p>{35}</p><pre>{6}</pre></section>",
    "<p>{9}</p>{inside}<figure><img src=/i><figcaption>{7}</figcaption></figure><p>{21}</p><table><tr><th>{1}<td>{2}</table>",
    "{20}<br><br>{31}{inside}<p>{26}</p><ol><li>{5}<li>{8}<li>{4}</ol><p>{80}</p>",
    "<p>{7}</p>{inside}<p>{150}</p><p>{90}</p><h3>{2}</h3><p>{110}</p><p>{6}</p>",
]
INSIDE = [
    "",
    "<div class=notice><p>{12}</p></div>",
    "<div class=ad data-not><p>{8}</p></div>",
    "<aside><p>{9}</p></aside>",
    "<form><p>{6}</p><input name=q></form>",
    "<div class=share><a href=/s>{1}</a> <a href=/t>{1}</a></div>",
    "<div class=newsletter-signup><h3>{4}</h3><p>{14}</p></div>",
    "<div class=related-posts><ul><li><a href=/r>{5}</a><li><a href=/q>{6}</a></ul></div>",
    "<div class=advertisement>{5}</div>",
    "<p class=notice>{15}</p>",
    "<nav class=toc><ul><li><a href=#a>{2}</a><li><a href=#b>{3}</a></ul></nav>",
    "<div class=sponsored><p>{22}</p><p>{16}</p></div>",
    "<div class=alert>{17}</div>",
]
BEFORE = [
    "<header><a href=/>{1}</a><h2>{2}</h2></header><nav><ul><li><a href=/a>{1}</a><li><a href=/b>{1}</a></ul></nav>",
    "<div id=header><a href=/>{2}</a><p>{5}</p></div><div class=menu><a href=/a>{1}</a><a href=/b>{1}</a></div>",
    "<ul><li><a href=/1>{2}</a><li><a href=/2>{1}</a><li><a href=/3>{1}</a></ul>",
    '<div class="cookie-notice"><p>{19}</p><button>{1}</button></div><nav><a href=/a>{1}</a> <a href=/b>{1}</a></nav>',
    "<div class=banner><p>{9}</p></div><div role=navigation><ul><li><a href=/a>{1}</a></ul></div>",
]
AFTER = [
    "<section class=comments><h3>{2}</h3><article><p>{23}</p></article><article><p>{11}</p></article></section>",
    "<div id=comments><h3>{1}</h3><p>{9}<p>{31}</div>",
    "<section class=comments-area><ol><li><article class=comment><div class=comment-content><p>{26}</p></div></article></ol></section>",
    "<section id=comments><article class=comment><header>{2}</header><p>{44}</p></article><article class=comment><p>{8}</p></article></section>",
    "<div id=rightcol><h3>{2}</h3><p>{17}</p></div>",
    "<aside class=sidebar><h3>{1}</h3><ul><li><a href=/c>{4}</a><li><a href=/d>{3}</a></ul><p>{12}</p></aside>",
    "<div class=right-column><div><p>{25}</p></div></div>",
    "<div class=widget-area><section><h3>{2}</h3><p>{20}</p></section></div>",
    "<div class=related><article><h3><a href=/e>{5}</a></h3><p>{13}</p></article></div>",
    "<form><p>{6}</p><input name=m></form>",
    "<div id=discussion><div><p>{35}</p><p>{28}</p></div></div>",
]
ENDS = [
    "<footer><p>{5} <a href=/i>{1}</a></p></footer>",
    "<div class=footer><p>{9}</p></div>",
    "<p class=copyright>{4}</p>",
    "<div id=footer><ul><li><a href=/i>{1}</a><li><a href=/k>{1}</a></ul>{6}</div>",
]
#: Number of layouts: each combines the parts anew, as the lists' lengths share no divisor but for one pair.
N_LAYOUTS = 143


def layout(i: int) -> str:
    """The ``i``-th labelled layout."""
    pick = lambda parts, step=1: parts[i * step % len(parts)]
    story = pick(STORIES).replace("{inside}", pick(INSIDE))
    after = AFTER[(i + i // 11) % len(AFTER)] + (AFTER[(i * 3 + 4) % len(AFTER)] if i % 2 else "")
    page = f"<body>{pick(BEFORE)}{pick(WRAPS).replace('{story}', story)}{after}{pick(ENDS)}</body>"
    # Texts of half to one and a half times the stated number of words.
    return re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * max(1, int(m[1]) * (5 + (i * 7 + m.start()) % 11) // 10)), page)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "own", "linked", "paragraphs", "titled", "hint", "under")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.own = self.linked = self.paragraphs = 0
        self.titled = False
        self.hint = self.under = "none"


class Tree(HTMLParser):
    """Elements and texts of a page; never fails."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", {}, None)
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag in CLOSES_P:
            self._close(("p",))
        if tag in CLOSES_SAME:
            self._close(tuple(CLOSES_SAME[tag].split()))
        node = Node(tag, {k: v or "" for k, v in attrs if k in ("class", "id", "role", "href", "data-main", "data-not")}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def _close(self, tags: tuple[str, ...]) -> None:
        node = self.at
        while node.parent and node.tag not in tags:
            if node.tag in BOUNDARY:
                return
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.tag != tag:
            # Inline elements end with the block around them; an inline end tag does not end a block.
            if tag not in BLOCKS and node.tag in BLOCKS:
                return
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def elements(root: Node) -> list[Node]:
    """Elements in page order, parents before children; what is never shown is left out."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if not isinstance(c, str) and c.tag not in HIDDEN]
    for node in reversed(order):  # children first
        text = sum(len(c.split()) for c in node.children if isinstance(c, str))
        inner = [c for c in node.children if not isinstance(c, str) and c.tag not in HIDDEN]
        node.own = text + sum(c.own for c in inner)
        node.linked = node.own if node.tag == "a" else sum(c.linked for c in inner)
        node.paragraphs = (node.tag == "p") + sum(c.paragraphs for c in inner)
        node.titled = node.tag in ("h1", "main") or any(c.titled for c in inner)
    for node in order:  # parents first
        node.hint = hint_of(node)
        above = node.parent
        if above:
            # What the nearest part of another purpose above is for.
            node.under = above.hint if above.hint not in ("none", "content") else above.under
    return order


def hint_of(node: Node) -> str:
    """The kind that tag and names state; names of what holds the page's title say nothing of a part."""
    if node.tag in OTHER_TAGS and not (node.tag == "form" and node.titled):
        return OTHER_TAGS[node.tag]
    named = " ".join(node.attrs[a] for a in ("class", "id", "role") if a in node.attrs)
    if not named or node.tag in ("body", "html"):
        return "none"
    found = HINT_PATTERN.findall(re.sub(r"(?<=[a-z])(?=[A-Z])|_", "-", named).lower())
    if not found:
        return "none"
    kind = [*HINTS][min(next(k for k, hit in enumerate(hits) if hit) for hits in found)]
    return "none" if kind != "content" and node.titled else kind


def evidence(node: Node) -> tuple[str, ...]:
    """What is seen of an element."""
    links = node.linked / node.own if node.own else 0
    share = node.own / node.parent.own if node.parent and node.parent.own else 0
    return (
        f"words:{min(7, int(log1p(node.own)))}",
        f"links:{min(4, int(links * 5))}",
        f"paragraphs:{min(3, node.paragraphs)}",
        f"share:{min(3, int(share * 4))}",
        f"titled:{node.titled}",
        f"hint:{node.hint}",
        f"under:{node.under}",
        f"tag:{node.tag}",
    )


def relation(node: Node) -> str:
    """Potentials differ by the kind of the child: below a part of another purpose, such a part, inline, named as content, or plain."""
    if node.under != "none":
        return "below"
    if node.hint not in ("none", "content"):
        return "other"
    if node.tag not in BLOCKS:
        return "inline"
    return "content" if node.hint == "content" or node.tag in ("main", "article") else "block"


def labels(order: list[Node]) -> list[int] | None:
    """Label of each element of a labelled page, None if its author marked nothing.

    The main text is what ``data-main``, else ``article``, else ``main`` holds, less what
    ``data-not`` or an element of another purpose inside holds. An article among comments marks nothing.
    """
    marked = [n for n in order if "data-main" in n.attrs]
    for tag in ("article", "main"):
        marked = marked or [n for n in order if n.tag == tag and n.hint in ("none", "content") and n.under == "none"]
    if not marked:
        return None
    inside, out = {id(n) for n in marked}, []
    label: dict[int, int] = {}
    for node in order:
        above = label.get(id(node.parent), 0) if node.parent else 0
        other = "data-not" in node.attrs or node.hint not in ("none", "content")
        label[id(node)] = 1 if id(node) in inside else 0 if other else above
        out.append(label[id(node)])
    return out


def count(page: str) -> Counter:
    """Counts of evidence by label, and of label pairs of child and parent, on a labelled page."""
    order = elements(Tree(page).root)
    truth = labels(order)
    seen: Counter = Counter()
    if truth is None:
        return seen
    label = {id(n): y for n, y in zip(order, truth, strict=True)}
    stated = any("data-main" in n.attrs for n in order)
    for node, y in zip(order, truth, strict=True):
        # The tag that gave the label is hidden.
        known = evidence(node) if stated or node.tag not in ("article", "main") else evidence(node)[:-1]
        for e in known:
            seen[f"e|{e}|{y}"] += 1
        seen[f"n|{y}"] += 1
        if node.parent:
            seen[f"t|{relation(node)}|{label[id(node.parent)]}|{y}"] += 1
    return seen


def layout_counts() -> Counter:
    """Counts of all labelled layouts."""
    seen: Counter = Counter()
    for i in range(N_LAYOUTS):
        seen.update(count(layout(i)))
    return seen


class Model:
    """Log potentials from counts."""

    def __init__(self, seen: dict[str, float]):
        total = [seen.get(f"n|{y}", 0) + 1 for y in (0, 1)]
        self.own: dict[str, tuple[float, float]] = {}
        for key in {k.split("|")[1] for k in seen if k.startswith("e|")}:
            a, b = ((seen.get(f"e|{key}|{y}", 0) + 0.5) / (total[y] + 1) for y in (0, 1))
            self.own[key] = (log(a), log(b))
        self.step = {}
        for kind in ("inline", "block", "content", "other", "below"):
            n = [[seen.get(f"t|{kind}|{x}|{y}", 0) + 0.05 for y in (0, 1)] for x in (0, 1)]
            # Divided by the child's share, as its own evidence holds that already.
            self.step[kind] = [[log(n[x][y] / sum(n[x]) / (total[y] / sum(total))) for y in (0, 1)] for x in (0, 1)]
        self.prior = [log(t / sum(total)) for t in total]

    def marginals(self, order: list[Node]) -> dict[int, float]:
        """Probability of content of each element, by messages up and then down the tree."""
        up, sent, seen = {}, {}, {}
        for node in order:
            a, b = self.prior
            for e in evidence(node):
                own = self.own.get(e)
                if own:
                    a, b = a + own[0], b + own[1]
            seen[id(node)] = [a, b]
        kinds = {id(node): relation(node) for node in order}
        for node in reversed(order):
            mine = up[id(node)] = seen[id(node)]
            if node.parent:
                step = self.step[kinds[id(node)]]
                message = sent[id(node)] = [_logsum(step[x][0] + mine[0], step[x][1] + mine[1]) for x in (0, 1)]
                above = seen[id(node.parent)]
                above[0] += message[0]
                above[1] += message[1]
        belief, out = {}, {}
        for node in order:
            a, b = up[id(node)]
            if node.parent:
                step, above, message = self.step[kinds[id(node)]], belief[id(node.parent)], sent[id(node)]
                rest = [above[0] - message[0], above[1] - message[1]]
                a += _logsum(rest[0] + step[0][0], rest[1] + step[1][0])
                b += _logsum(rest[0] + step[0][1], rest[1] + step[1][1])
            belief[id(node)] = (a, b)
            out[id(node)] = 1 / (1 + exp(max(-700.0, min(700.0, a - b))))
        return out


def _logsum(a: float, b: float) -> float:
    return max(a, b) + log1p(exp(-abs(a - b)))


def text_of(root: Node, chosen: dict[int, float]) -> str:
    """Text of the chosen elements, a line for each block."""
    blocks: list[list[str]] = [[]]
    stack: list[Node | str | None] = [root]
    at: list[Node] = []
    while stack:
        item = stack.pop()
        if item is None:  # the end of an element
            if at.pop().tag in BLOCKS:
                blocks.append([])
        elif isinstance(item, str):
            if chosen.get(id(at[-1]), 0.0) > 0.5:
                blocks[-1].append(item)
        elif item.tag == "br":
            blocks[-1].append(" ")
        elif item.tag not in HIDDEN:
            if item.tag in BLOCKS:
                blocks.append([])
            at.append(item)
            stack.append(None)
            stack += reversed(item.children)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for page in batch["html"].to_pylist():
            seen.update(count(page or ""))
    yield pa.RecordBatch.from_pydict({"key": pa.array([*seen], pa.string()), "n": pa.array([*seen.values()], pa.int64())})


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", limit: int = MAX_LABELLED) -> dict[str, int]:
    """Counts from the labelled layouts and from at most ``limit`` pages, added up by Spark."""
    # The smallest hashes first, so that only this many pages are moved.
    ids = pages.where(F.col(html).isNotNull()).select(key).orderBy(F.xxhash64(key), key).limit(limit)
    sample = pages.select(key, F.col(html).alias("html")).join(F.broadcast(ids.distinct()), key, "left_semi").select("html")
    found = sample.mapInArrow(_counts, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    seen: Counter = Counter({r["key"]: r["n"] for r in found.collect()})  # a few hundred kinds of evidence
    # Layouts weigh as much as the sample, so that rare kinds are heard.
    stated = layout_counts()
    weight = max(1, seen["n|1"] // stated["n|1"])
    seen.update({k: n * weight for k, n in stated.items()})
    return dict(seen)


def _extract(seen: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(seen)
        for batch in batches:
            texts = []
            for page in batch["html"].to_pylist():
                root = Tree(page or "").root
                texts.append(text_of(root, model.marginals(elements(root))))
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], *made], ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, seen: dict[str, int]) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    rows = pages.select("page_id", "url", "html")
    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(_extract(seen), schema)


@query()
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
