"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: an element's place is the path of (tag, class or id, with its numbers
folded) from the root, and a place's *presentations* are the sequences of child elements it has on the pages.
Importance after entropy:

* presentation: ``-sum p log_m p`` over the presentations of a place on its m pages: a place that looks the same on
  every page is template;
* content: 1 minus the mean over a place's features (its sentences) of their entropy over the m pages,
  ``-sum p log_m p``: a sentence that stands on one page has entropy 0, one that stands on all pages entropy 1;
* a place's composite importance mixes its own presentation with its children's importance by their use,
  ``(1 - 0.9**l) * presentation + 0.9**l * mean of children`` for l presentations.

Branches whose composite importance falls below ``least_importance`` are removed from each page of the host, and with
them branches that their tag or role says are furniture (menus, headers, footers, asides, forms; scripts and styles are
never text). A class or id that names furniture never removes a branch that holds an article or main. Other named
branches go where they stand beside an article or main; and, within one or on a page without, where the name is a
strong one (adverts, comments, sidebars, notices ...), unless they hold over ``MOST`` of the page's text, or where their
importance is below ``NAMED_IMPORTANCE``. If the whole page would go, or the host has fewer pages
than ``least_pages``, only furniture by tag, role or name goes: a few pages can't show what is template.

Spark does the merging: pages are parsed in the tasks, statistics are summed per (host, place, feature) with partial
aggregation, so a host that owns a third of all pages is no hot task; the trees' importances (places, not pages) go
back to the pages by a join on the host. Null pages are empty, pages without text give "". Broken markup is read as
browsers do for the common cases (void elements, unclosed paragraphs and items, stray ends). Repeated rows give
repeated results. Columns other than those named are not read. Nothing is cut or capped.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, ship_package, stored
from curbline.llm.urls import host_of

LEAST_IMPORTANCE = 0.15
LEAST_PAGES = 4
NAMED_IMPORTANCE = 0.5  # for places whose class or id names furniture
MOST = 0.5
NAMED = " named"  # ends the names of such places; labels hold no blanks
DECAY = 0.9

# fixed values of the HTML vocabulary
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p
    pre search section summary table tbody td tfoot th thead tr ul""".split())
SILENT = frozenset("""script style head title template noscript iframe object svg math canvas audio video select
    textarea button datalist""".split())
RAW = frozenset("script style textarea title iframe noscript".split())  # no markup inside
FURNITURE = frozenset("nav menu header footer aside form dialog search".split())
ENDS_PARAGRAPH = BLOCK - frozenset("body html".split())
# an open element of the key ends where one of these begins, up to the nearest element that holds them
ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "tbody", "tfoot", "thead"}, {"table"}), "td": ({"td", "th", "tr", "tbody"}, {"table"}),
            "th": ({"td", "th", "tr", "tbody"}, {"table"}), "option": ({"option", "optgroup"}, {"select"})}
FURNITURE_NAMES = re.compile(
    r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|comment-?list|consent|cookies?|"
    r"disqus|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo|"
    r"promoted|related|replies|reply|respond|share|sharing|sidebar|side-?bar|signup|social|sponsor|sponsored|subscribe|"
    r"toolbar|widget)(?:$|[-_ \d])", re.I)
# of these a page's own text may have the name too: evidence for the entropies
WEAK_NAMES = re.compile(r"(?:header|masthead|banner|widget|modal|toolbar|social|notices?|promo|promoted|related|footer|menu)", re.I)
OWN_HEADS = re.compile(r"\b(?:header|masthead|banner)\b", re.I)  # names that an article's own head may bear
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))""")
_SPACE = re.compile(r"\s+")
# what numbers a page or an element in its class or id: digits, and hexadecimal words of 6 or more with a digit
_NUMBER = re.compile(r"(?<![a-z0-9])(?=[a-f]*[0-9])[0-9a-f]{6,}(?![a-z0-9])|[0-9]+", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


class Node:
    __slots__ = ("tag", "name", "path", "children", "furniture", "named", "strong", "inside_article", "holds_article", "size")

    def __init__(self, tag: str, name: str, parent: Node | None, furniture: bool, named: bool = False, strong: bool = False):
        self.tag, self.name, self.children = tag, name, []
        self.path = f"{parent.path}/{name}" if parent else name
        self.furniture, self.named, self.strong, self.holds_article, self.size = furniture, named, strong, False, 0
        self.inside_article = bool(parent and (parent.inside_article or parent.tag in ("article", "main")))


def _node(tag: str, raw: str, parent: Node) -> Node:
    if not raw or raw.isspace():
        attributes = {}
    else:
        attributes = {m[0].lower(): entities.unescape(m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(raw)}
    names = " ".join(attributes.get(k, "") for k in ("class", "id")).strip()
    inside = parent.inside_article or parent.tag in ("article", "main")
    # a header inside the article is the article's own
    by_tag = tag in FURNITURE and not (tag == "header" and inside)
    if inside:
        names = OWN_HEADS.sub("", names)
    furniture = (by_tag or attributes.get("role", "").lower() in FURNITURE_ROLES
                 or "hidden" in _ATTRIBUTE.sub(" ", raw).lower().split() or attributes.get("aria-hidden") == "true")
    named = bool(names and tag not in ("html", "body", "article", "main") and FURNITURE_NAMES.search(names))
    strong = named and any(not WEAK_NAMES.search(m[0]) for m in FURNITURE_NAMES.finditer(names))
    label = _SPACE.sub(".", _NUMBER.sub("#", (attributes.get("class") or attributes.get("id") or "").strip()))
    return Node(tag, (f"{tag}.{label}" if label else tag) + NAMED * named, parent, furniture, named, strong)


def parse(page: str | None) -> Node:
    """The page as a tree; children are nodes and strings (character references decoded)."""
    root = Node("#page", "", None, False)
    stack, at, page = [root], 0, page or ""
    find = _TOKEN.search
    while token := find(page, at):
        if token.start() > at:
            stack[-1].children.append(entities.unescape(page[at:token.start()]))
        at = token.end()
        if token[2]:
            tag = token[2].lower()
            if tag in ENDS_PARAGRAPH:
                _close(stack, {"p"}, {"article", "div", "section", "td", "th", "li", "button", "table", "#page"})
            for open_tag, (enders, holders) in ENDED_BY.items():
                if tag in enders:
                    _close(stack, {open_tag}, holders)
            node = _node(tag, token[3].rstrip("/"), stack[-1])
            stack[-1].children.append(node)
            if tag in ("article", "main"):
                for holder in stack:
                    holder.holds_article = True
            if tag in VOID or token[3].endswith("/") and tag not in BLOCK | RAW:
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                node.children.append(page[at:end.start() if end else len(page)])
                at = end.start() if end else len(page)
            stack.append(node)
        elif token[1]:
            tag = token[1].lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break  # a stray inline end doesn't close blocks
    if at < len(page):
        stack[-1].children.append(entities.unescape(page[at:]))
    return root


def _close(stack: list[Node], tags: set[str], holders: set[str]) -> None:
    """Close the innermost open element of ``tags`` unless one of ``holders`` is nearer."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in holders:
            return


def statistics(page: str | None) -> Iterator[tuple[str, str, int, str, int]]:
    """What a page adds to its site's tree: (place, kind, feature hash, child or "", count). Kinds: ``pages`` (the place
    is on the page), ``style`` (its sequence of children), ``child`` (a use of a child place), ``text`` (a sentence)."""
    found: Counter = Counter()
    stack = [parse(page)]
    places = set()
    while stack:
        node = stack.pop()
        if node.furniture or node.tag in SILENT:
            continue
        places.add(node.path)
        kids = [k for k in node.children if isinstance(k, Node) and k.tag not in SILENT and not k.furniture]
        shape = [k.name for n, k in enumerate(kids) if n == 0 or kids[n - 1].name != k.name]  # runs count once
        found[node.path, "style", xxhash.xxh64_intdigest("|".join(shape).encode()) >> 1, ""] += 1
        for name in set(shape):
            found[node.path, "child", 0, f"{node.path}/{name}"] += 1
        text = " ".join(k for k in node.children if isinstance(k, str)).strip()
        for sentence in _SENTENCE.split(text) if text else ():
            found[node.path, "text", xxhash.xxh64_intdigest(_SPACE.sub(" ", sentence).encode()) >> 1, ""] += 1
        stack += kids
    for place in places:
        yield place, "pages", 0, "", 1
    for (place, kind, feature, child), n in found.items():
        yield place, kind, feature, child, n


def site_statistics(pages: DataFrame) -> DataFrame:
    """``host``, ``place``, ``pages``, ``styles``, ``presentation``, ``content`` (null without text), ``children``
    (uses of each child place) from ``host``, ``html``."""

    # a page's statistics, packed, and its digest travel, not the page; copies of a page are no proof of template
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [zlib.compress(json.dumps(list(statistics(page))).encode(), 1) for page in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary())],
                                             ["host", "digest", "packed"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [], [], [])
            for host, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                for place, kind, feature, child, n in json.loads(zlib.decompress(packed.as_py())):
                    for column, value in zip(columns, (host, place, kind, feature, child, n, n * math.log(n))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(),
                                                          pa.int64(), pa.float64()))],
                ["host", "place", "kind", "feature", "child", "n", "n_log_n"])

    digested = pages.select("host", "html", F.unhex(F.md5(F.coalesce("html", F.lit("")))).alias("digest"))
    once = arrow_map(digested, pack, "host string, digest binary, packed binary").groupBy("host", "digest").agg(
        F.first("packed").alias("packed"))
    rows = arrow_map(once.select("host", "packed"), unpack, "host string, place string, kind string, feature long, "
                                                            "child string, n long, n_log_n double")
    # per feature: over how many pages, how often, and sum n log n: enough for its entropy
    features = rows.groupBy("host", "place", "kind", "feature", "child").agg(
        F.sum("n").alias("n"), F.sum("n_log_n").alias("n_log_n"))
    n, log_n = F.col("n").cast("double"), F.log(F.col("n").cast("double"))
    is_style, is_text = F.col("kind") == "style", F.col("kind") == "text"
    totals = features.groupBy("host", "place").agg(
        F.max(F.when(F.col("kind") == "pages", F.col("n"))).alias("pages"),
        F.count(F.when(is_style, 1)).alias("styles"),
        F.sum(F.when(is_style, n)).alias("uses"),
        F.sum(F.when(is_style, n * log_n)).alias("uses_log"),
        F.avg(F.when(is_text, log_n - F.col("n_log_n") / n)).alias("spread"),  # mean entropy, natural logarithm
        F.collect_list(F.when(F.col("kind") == "child", F.struct("child", "n"))).alias("children"))
    base = F.log(F.col("pages").cast("double"))
    many = F.col("pages") > 1
    return totals.select(
        "host", "place", "pages", "styles", "children",
        F.when(many, (F.log("uses") - F.col("uses_log") / F.col("uses")) / base).otherwise(1.0).alias("presentation"),
        F.when(F.col("spread").isNotNull(),
               F.when(many, F.greatest(F.lit(0.0), 1 - F.col("spread") / base)).otherwise(1.0)).alias("content"))


def importances(places: dict[str, tuple]) -> tuple[dict[str, float], dict[str, float]]:
    """Composite importance of each place of a site from (styles, presentation, content, children), and the largest
    in each place's branch: a branch is noise only if all of it is unimportant."""
    done: dict[str, float] = {}
    branch: dict[str, float] = {}
    for place in sorted(places, key=lambda p: -p.count("/")):  # children before parents
        styles, presentation, content, children = places[place]
        parts = [(done[child], n) for child, n in children if child in done]
        if content is not None:
            parts.append((content, max([n for _, n in parts], default=1)))
        below = sum(value * n for value, n in parts) / sum(n for _, n in parts) if parts else 0.0
        weight = DECAY ** styles if styles > 1 else 1.0
        own = min(1.0, max(0.0, presentation))
        done[place] = max((1 - weight) * own + weight * below, content or 0.0) if parts else 0.0
        branch[place] = max([done[place], *(branch[child] for child, _ in children if child in branch)])
    return done, branch


def measure(root: Node) -> None:
    """Sets each node's ``size``: the characters of its text that no furniture by tag or role holds, without blanks."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        if not (node.furniture or node.tag in SILENT):
            order.append(node)
            todo += [k for k in node.children if isinstance(k, Node)]
    for node in reversed(order):
        node.size = sum(k.size if isinstance(k, Node) else len(k) - sum(map(k.count, " \n\t\r")) for k in node.children)


def main_text(page: str | None, noise: frozenset[str] = frozenset()) -> str:
    """The text blocks that stay, in page order, joined by a blank line. ``noise``: places to remove."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if text := _SPACE.sub(" ", "".join(run)).strip():
            blocks.append(text)
        run.clear()

    root = parse(page)
    measure(root)

    def dropped(node: Node) -> bool:
        if node.tag in SILENT or node.furniture or node.path in noise:
            return True
        if not node.named or node.holds_article:
            return False
        if root.holds_article and not node.inside_article:
            return True
        return node.strong and node.size <= MOST * root.size

    todo: list = [root]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            run.append(item)
        elif item.tag == "br":
            run.append(" ")
        elif not dropped(item):
            edge = [None] if item.tag in BLOCK or item.tag == "#page" else []
            todo += edge + item.children[::-1] + edge
        elif item.tag in BLOCK:
            flush()
    flush()
    return "\n\n".join(blocks)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            least_importance: float = LEAST_IMPORTANCE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` for every row."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host"))
    # pages without host share no site
    sites = stored(site_statistics(rows.where("host <> ''").select("host", "html")), "style-trees", tidy=True)
    ship_package(pages.sparkSession)

    @F.arrow_udf("array<string>")
    def noise_of(trees: pa.Array) -> pa.Array:
        out = []
        for tree in trees.to_pylist():
            by_place = {t["place"]: (t["styles"], t["presentation"], t["content"],
                                     [(c["child"], c["n"]) for c in t["children"]]) for t in tree}
            pages_of = {t["place"]: t["pages"] for t in tree}
            _, branch = importances(by_place)
            holders = _holders(by_place)
            least = {p: NAMED_IMPORTANCE if p.endswith(NAMED) else least_importance for p in branch}
            out.append(sorted(p for p, v in branch.items() if v < least[p] and pages_of[p] >= least_pages
                              and p not in holders and not _holds_article(p)))
        return pa.array(out, pa.list_(pa.string()))

    # names are folded by their numbers, so post-1 and post-2 are one place; names that differ in words from page to
    # page still make places of their own, and a host's tree grows with them
    trees = sites.groupBy("host").agg(F.collect_list(F.struct(
        "place", "pages", "styles", "presentation", "content", "children")).alias("tree"))
    noise = stored(trees.select("host", noise_of("tree").alias("noise")).where(F.size("noise") > 0), "style-noise")

    @F.arrow_udf("string")
    def text_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for html, noisy in batches:
            out = []
            for page, places in zip(html, noisy):
                places = places.as_py()
                text = main_text(page.as_py(), frozenset(places or ()))
                out.append(text if text or not places else main_text(page.as_py()))
            yield pa.array(out, pa.string())

    return (rows.join(noise, "host", "left")
            .select("page_id", "url", text_of("html", "noise").alias("text")))


def _holders(places: dict[str, tuple]) -> set[str]:
    """The places of a site's tree that lead to an article or main."""
    parent = {child: place for place, (_, _, _, children) in places.items() for child, _ in children}
    found: set[str] = set()
    for place in places:
        if _holds_article(place):
            while (place := parent.get(place)) is not None and place not in found:
                found.add(place)
    return found


def _holds_article(place: str) -> bool:
    """An article or main and the places in one are never template: what an article repeats is its text."""
    parts = {part.removesuffix(NAMED).split(".")[0] for part in place.split("/")}
    return bool(parts & {"article", "main"})
