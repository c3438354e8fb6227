"""Main text of HTML pages from per-host style trees.

The pages of a host are merged into one tree: an element's place is the chain of
tags and classes above it; the different child sequences seen at a place are its
presentations, the different texts below it its contents.  A place's presentation
importance is the entropy of its presentations over the m pages that have it, to
the base m; a content seen on k of them has importance 1 - log k / log m.  An
element's composite importance is (1 - GAMMA^l) times the first plus GAMMA^l times
the second, with l children: a branch that looks the same and says the same
everywhere has 0.  Elements below their bar are removed, with all below them.

The tree is built from all block elements with text, of the whole page.  Tags, roles
and class names, and ``article`` or ``main``, are the prior: they shift the bar (BARS).
A plain element has the lowest.  Text outside the article of a page that has one stays
only where the tree finds its place important.  Branches whose marks say what they are
(navigation, footer, advert, form, reader comments ...) have the highest bar.  Their texts
differ a little from page to page, so a place of theirs is judged by its features: the words,
link targets and labels below it.  A feature on k of the place's m pages has importance
1 - log k / log m, the entropy of the feature taken from one; a place's content
importance is the mean of its features'.  What the tree leaves of marked branches (texts as
unique as an article's, such as reader comments, and hosts with too few pages) goes by its
marks, unless ``marks`` is off.  Inside ``article`` or
``main``, headings, paragraphs and the like always stay and only containers are
judged, so that a sentence quoted on many pages is not lost; there a word of a class or
id only raises a container's bar, and it must be seen on several pages to go, unless a
class is exactly the name of a known widget.  Where the tree has too
few pages, the prior decides alone.  A page of which the tree would leave nothing keeps what
the prior keeps.

Copies of a page weigh one: pages of a host with the same kept text are one page in all
counts.  Work per host is counts only: (host, place, content) and (host, place,
presentation) and (host, place, feature) are partial aggregates.  What a host's pages get back are
its unimportant branches, each on at least MIN_SHARE of the pages that have the place, and its
important places outside the article; where those are many, each page looks up its own.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import free_name, map_texts, plus, settle
from tabforge.llm.urlfilter import host_and_path

GAMMA = 0.9
#: Kinds of evidence, and the importance below which an element of the kind is removed.
PLAIN, OUTSIDE, MARKED, HINTED = 0, 1, 2, 3
BARS = (0.35, 0.85, 0.985, 0.7)
#: Pages, and share of a place's pages, on which an unimportant branch is seen at least.
MIN_PAGES, MIN_SHARE = 4, 0.02
#: Feature of a marked branch that stands for the branch itself.
WHOLE = 0
#: Counted bytes of all hosts' lists up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
#: Findings of a host up to which all of them go to each of its pages.
HOST_KEYS = 2048

# Fixed values of HTML: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg canvas object select math".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul caption search".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr tbody thead tfoot caption figcaption summary".split())
#: Start tags that end an open element of the same family.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "body": {"head"},
}
#: Elements that an implied end tag does not reach beyond.
SCOPE = frozenset("table ul ol dl article section div body html td th".split())
NOISE_TAGS = frozenset("nav footer aside form dialog menu search button fieldset head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class and id that name a branch that is not the article.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside widget widgets cookie cookies consent gdpr "
    "notice notices alert alerts banner banners announcement popup modal overlay subscribe subscription newsletter signup login share sharing social related recommended "
    "recommendations trending comment comments commentlist reply replies responses discussion disqus respond pagination pager skip toolbar".split()
)
#: Classes that name a widget inside the article, as a whole.
WIDGETS = frozenset(
    "ad ads advert adverts advertisement adsbygoogle adsense sponsored promo navbar breadcrumb breadcrumbs pagination pager "
    "share sharing share-buttons social-share social-links sharedaddy addtoany newsletter newsletter-signup subscribe "
    "cookie-notice cookie-banner cookie-consent comments comments-area comment comment-list commentlist comment-respond "
    "related related-posts related-articles recommended sidebar toolbar widget popup modal".split()
)
#: Words that do so only outside the article.
OUTER_WORDS = frozenset("header footer masthead topbar".split())
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[\"'=])*+)(?:>|(?=<)|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
#: Class names that tell what a branch has or lacks, not what it is.
_ABOUT = re.compile(r"(?<!\S)(?:has|with|no|without)[-_]\S+", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Elements of a page in order: parent, tag, label (tag with classes), noise; and its text blocks."""

    __slots__ = ("parent", "tag", "label", "noise", "hinted", "inside", "blocks", "when", "links", "homes", "_known")

    def __init__(self, source: str):
        self.parent, self.tag, self.label = [-1], ["#"], ["#"]
        self.noise, self.hinted, self.inside = [False], [False], [""]
        self.blocks: list[tuple[int, str]] = []
        self._known: dict = {}
        self.when: list[int] = []  # elements opened before each block
        self.links: list[tuple[int, str]] = []
        self._read(source)
        self._settle_noise()

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        noise, hinted, label = tag in NOISE_TAGS, False, tag
        inside = self.inside[parent]
        if attrs and not attrs.isspace():
            named = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
            names = f"{named.get('class', '')} {named.get('id', '')}"
            if names != " ":
                words = {w.lower() for w in _CLASS_WORD.findall(_ABOUT.sub(" ", names))}
                if not inside or tag == "article":
                    noise = noise or bool(words & NOISE_WORDS) or (not inside and bool(words & OUTER_WORDS))
                elif tag not in PROSE:
                    noise = noise or not WIDGETS.isdisjoint(named.get("class", "").lower().split())
                    hinted = bool(words & NOISE_WORDS)
                label = f"{tag}.{named.get('class', '')}"
            target = named.get("href") if tag == "a" else None
            if target:
                self.links.append((len(self.tag), target))
            role = named.get("role", "").lower()
            noise = noise or role in NOISE_ROLES
            noise = noise or "hidden" in named or named.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(named.get("style", "")))
            if role == "main":
                inside = inside or "main"
        if tag == "header" and not inside:
            noise = True
        if tag in ("article", "main"):
            inside = "article" if tag == "article" or inside == "article" else "main"
        self.parent.append(parent)
        self.tag.append(tag)
        self.label.append(label)
        self.noise.append(noise and tag not in ("html", "body"))
        self.hinted.append(hinted)
        self.inside.append(inside)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack, near, text, at, pos = [0], [0], [], 0, 0
        open_at: dict[str, list[int]] = {}  # by tag, its places in the stack: nothing walks the stack
        find = _TOKEN.search
        size = len(source)

        def flush() -> None:
            if text:
                joined = "".join(text)
                joined = " ".join((html_lib.unescape(joined) if "&" in joined else joined).split())
                if joined:
                    self.blocks.append((near[-1], joined))
                    self.when.append(len(self.tag))
                text.clear()

        def leave(depth: int) -> None:
            """Close all elements from ``depth`` on."""
            for n in stack[depth:]:
                open_at[self.tag[n]].pop()
            del stack[depth:], near[depth:]

        while pos < size:
            m = find(source, pos)
            if m is None:
                text.append(source[pos:])
                break
            at = m.start()
            if at > pos:
                text.append(source[pos:at])
            pos = m.end()
            if m.group(2) is None:
                if source.startswith("<![CDATA[", at):
                    text.append(html_lib.escape(source[at + 9 : pos - 3]))
                continue
            tag = m.group(2).lower()
            if m.group(1):
                depth = (open_at.get(tag) or [0])[-1]
                if depth:
                    if any(self.tag[n] in BLOCK for n in stack[depth:]):
                        flush()
                    leave(depth)
                continue
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(source, pos)
                if not m.group(3).rstrip().endswith("/"):
                    pos = size if end is None else end.start()
                    close = source.find(">", pos)
                    pos = size if close < 0 else close + 1
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                else:
                    text.append(" " if tag in ("br", "wbr") or tag == "img" else "")
                continue
            if tag in BLOCK:
                flush()
                ends = CLOSES.get(tag, set()) | {"p"} if tag != "option" else {"option"}
                ended, fence = (max((open_at[t][-1] for t in tags if open_at.get(t)), default=0) for tags in (ends, SCOPE))
                if ended and ended >= fence:
                    leave(ended)
            node = self._open(tag, m.group(3), stack[-1])
            if not m.group(3).rstrip().endswith("/") or tag in BLOCK:
                open_at.setdefault(tag, []).append(len(stack))
                stack.append(node)
                near.append(node if tag in BLOCK else near[-1])
        flush()

    def _settle_noise(self) -> None:
        """A class name does not make a branch that holds the article noise; noise reaches down;
        the text is in the articles if there are any, else in main, else anywhere."""
        homes = {"article": set(), "main": set()}
        for n, tag in enumerate(self.tag):
            if tag in homes and not self.noise[n]:
                homes[tag].add(n)
                up = self.parent[n]
                while up > 0:
                    if self.tag[up] == "form" or (self.tag[up] not in NOISE_TAGS and self.tag[up] != "header"):
                        self.noise[up] = False
                    up = self.parent[up]
        for n in range(1, len(self.tag)):
            self.noise[n] = self.noise[n] or self.noise[self.parent[n]]
        homes = {k: {n for n in v if not self.noise[n]} for k, v in homes.items()}
        self.homes = homes["article"] or homes["main"] or set()
        titles = [n for n in range(len(self.tag)) if self.tag[n] == "h1" and not self.noise[n] and self.inside[n]]
        if homes["article"] and not any(self.inside[n] == "article" for n in titles):
            self.homes = self.homes | set(titles)  # the title may stand in main, before the article

    def kept(self) -> list[bool]:
        """Whether each element's own text may be the article's, before the tree judges."""
        out = [False] * len(self.tag)
        for n in range(len(self.tag)):
            home = n in self.homes or (n > 0 and out[self.parent[n]]) if self.homes else True
            out[n] = home and not self.noise[n]
        return out

    def judged(self) -> list[tuple[int, int, int, int, int, int]]:
        """Elements that the style tree judges: (element, place, presentation, content, children, kind)."""
        if "judged" not in self._known:
            self._known["judged"] = self._judged()
        return self._known["judged"]

    def _judged(self) -> list[tuple[int, int, int, int, int, int]]:
        kept = self.kept()
        said = self._contents()
        kids: list[list[int]] = [[] for _ in self.tag]
        for n in range(1, len(self.tag)):
            kids[self.parent[n]].append(n)
        around, place = self.around(), self.places()
        out = []
        for n in range(1, len(self.tag)):
            if said[n] is None or n in around or self.tag[n] in ("html", "body", "article", "main") or self.tag[n] not in BLOCK:
                continue
            if kept[n] and self.homes and self.tag[n] in PROSE:
                continue
            kind = MARKED if self.noise[n] else OUTSIDE if not kept[n] else HINTED if self.hinted[n] else PLAIN
            look = xxhash.xxh64_intdigest(" ".join(self.label[k] for k in kids[n]))
            out.append((n, _signed(place[n]), _signed(look), _signed(said[n]), len(kids[n]), kind))
        return out

    def places(self) -> list[int]:
        """Hash of the chain of labels down to each element."""
        if "places" not in self._known:
            place = self._known["places"] = [0] * len(self.tag)
            for n in range(1, len(self.tag)):
                place[n] = xxhash.xxh64_intdigest(f"{place[self.parent[n]]}>{self.label[n]}")
        return self._known["places"]

    def _contents(self) -> list[int | None]:
        """Hash of what is below each element, from those of its children; None without text."""
        parts: list[list[tuple[int, int, object]]] = [[] for _ in self.tag]
        for (n, t), when in zip(self.blocks, self.when):
            parts[n].append((when, 0, t))
        out: list[int | None] = [None] * len(self.tag)
        for n in range(len(self.tag) - 1, 0, -1):
            if parts[n]:
                out[n] = xxhash.xxh64_intdigest("\n".join(str(x) for *_, x in sorted(parts[n], key=lambda p: p[:2])))
                parts[self.parent[n]].append((n, 1, out[n]))
        return out

    def marked(self) -> list[tuple[int, set[int]]]:
        """Place and features of each marked branch that is in no other: the words, link targets
        and labels below it."""
        place, top = self.places(), self._tops()
        found = {n: names for n, names in self.marked_tops()}
        for n, target in self.links:
            if top[n] in found:
                found[top[n]].add(f"h{target}")
        for n in range(1, len(self.tag)):
            if top[n] in found:
                found[top[n]].add(f"l{self.label[n]}")
        return [(_signed(place[n]), {_signed(xxhash.xxh64_intdigest(f)) for f in names}) for n, names in found.items()]

    def _tops(self) -> list[int]:
        """For each element the marked block that it is in and that is in no other, or 0."""
        top = [0] * len(self.tag)
        for n in range(1, len(self.tag)):
            top[n] = top[self.parent[n]] or (n if self.noise[n] and self.tag[n] in BLOCK else 0)
        return top

    def marked_tops(self) -> list[tuple[int, set[str]]]:
        """Those marked blocks that have text, with its words."""
        top, found = self._tops(), {}
        for n, t in self.blocks:
            if top[n]:
                found.setdefault(top[n], set()).update(f"w{w}" for w in t.lower().split())
        return list(found.items())

    def around(self) -> set[int]:
        """Elements that the article lies in."""
        out = set()
        for n in self.homes:
            up = self.parent[n]
            while up > 0 and up not in out:
                out.add(up)
                up = self.parent[up]
        return out

    def removed(self, found: set[int]) -> int:
        """Branches that the tree itself removes: marked places and repeated branches."""
        place, top = self.places(), self._tops()
        tops = {top[n] for n, _ in self.blocks if top[n]}
        return sum(~_signed(place[n]) in found for n in tops) + sum(branch_key(p, c, k) in found for _, p, _, c, _, k in self.judged() if k != MARKED)

    def text(self, found: set[int] | None = None, marks: bool = True) -> str:
        """The article's blocks, by the prior and what the tree ``found``: unimportant branches
        are left out with all below them, important places outside the article come in, marked
        ones only with ``marks`` off."""
        kept = self.kept()
        whole = "\n\n".join(t for n, t in self.blocks if kept[n])
        if not found:
            return whole
        judged = self.judged()
        cut = {n for n, place, _, said, _, kind in judged if branch_key(place, said, kind) in found}
        more = {n for n, place, _, _, _, kind in judged if kind == OUTSIDE and n not in cut and place in found}
        if not marks:
            more |= {n for n, place, _, _, _, kind in judged if kind == MARKED and place in found}
        if not cut and not more:
            return whole
        around = self.around() if more else set()
        stays = [True] + [False] * (len(self.tag) - 1)
        for n in range(1, len(self.tag)):
            up = self.parent[n]
            if kept[n]:
                stays[n] = n not in cut and (not kept[up] or stays[up])
            elif n in more and self.noise[n]:
                stays[n] = True
            elif self.noise[n]:
                stays[n] = not marks and stays[up] and self.noise[up]
            else:
                free = up == 0 or up in around or self.tag[up] in ("html", "body")
                stays[n] = n in more and (free or stays[up]) or (self.tag[n] not in BLOCK and not free and stays[up])
        stays[0] = kept[0]
        return "\n\n".join(t for n, t in self.blocks if stays[n]) or whole


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def branch_key(place: int, content: int, kind: int) -> int:
    return _signed(xxhash.xxh64_intdigest(f"{place}|{content}|{kind}"))


def style_rows(pages: DataFrame) -> DataFrame:
    """(host, place, look, said, kids, kind, key, page): the judged elements of all pages, once a
    page each; ``page`` is a hash of the text that the prior keeps."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if host and source:
                page = Page(source)
                own = _signed(xxhash.xxh64_intdigest(page.text() or source))
                rows = {(p, s, e): (host, p, look, s, k, e, branch_key(p, s, e), own) for _, p, look, s, k, e in page.judged()}
                out.extend(rows.values())
        cols = list(zip(*out)) if out else [()] * 8
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], names=["host", "place", "look", "said", "kids", "kind", "key", "page"]
        )

    schema = "host string, place long, look long, said long, kids int, kind int, key long, page long"
    return map_texts(pages.select("host", "html"), run, schema, "html")


def feature_rows(pages: DataFrame) -> DataFrame:
    """(host, place, feature, page): the features of each marked branch, once a page each, and
    WHOLE, a feature that every such branch has."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if host and source:
                page = Page(source)
                own = _signed(xxhash.xxh64_intdigest(page.text() or source))
                out.extend({(host, place, f, own) for place, names in page.marked() for f in (*names, WHOLE)})
        cols = list(zip(*out)) if out else [()] * 4
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["host", "place", "feature", "page"])

    return map_texts(pages.select("host", "html"), run, "host string, place long, feature long, page long", "html")


def marked_places(features: DataFrame, places: DataFrame) -> DataFrame:
    """(host, place, m, importance) of the marked places that the tree judges: their presentations'
    importance, and the mean importance of their features over the pages that have the place."""
    k = features.distinct().groupBy("host", "place", "feature").agg(F.count(F.lit(1)).alias("k"))
    own = F.col("feature") != WHOLE
    # a copy of a page may differ outside its article: it has its features, but is no page of its own
    told = k.groupBy("host", "place").agg(
        F.max(F.when(~own, F.col("k"))).alias("m"), F.count_if(own).alias("n"), F.sum(F.when(own, F.log("k"))).alias("logk")
    )
    met = told.where(F.col("m") >= MIN_PAGES).join(places.select("host", "place", "kids", "shown"), ["host", "place"])
    fade = F.pow(F.lit(GAMMA), F.col("kids"))
    mean = 1 - F.col("logk") / (F.col("n") * F.log("m"))
    return met.select("host", "place", "m", ((1 - fade) * F.col("shown") + fade * mean).alias("importance"))


def _spread(nlogn, m):
    """Entropy to the base m of counts n with sum m: (log m - sum(n log n) / m) / log m."""
    return F.when(m > 1, 1 - nlogn / (m * F.log(m))).otherwise(1.0)


def judge(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Branches seen on MIN_PAGES pages (host, place, said, key, kind, k, m, importance), and places
    (host, place, m, kids, kind, shown, told: importance of presentations and of all contents)."""
    once = rows.groupBy("host", "page", "place", "look", "said", "kind", "key").agg(F.max("kids").alias("kids"))
    cells = settle(
        once.groupBy("host", "place", "look", "said", "kind", "key").agg(F.count(F.lit(1)).alias("n"), F.max("kids").alias("kids"))
    )
    looks = cells.groupBy("host", "place", "look").agg(F.sum("n").alias("n"))
    looks = looks.groupBy("host", "place").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    looks = looks.where(F.col("m") >= MIN_PAGES).select("host", "place", "m", _spread(F.col("nlogn"), F.col("m")).alias("shown"))
    said = cells.groupBy("host", "place", "said", "kind", "key").agg(F.sum("n").alias("k"), F.max("kids").alias("kids"))
    contents = said.groupBy("host", "place").agg(
        F.sum(F.col("k") * F.log("k")).alias("klogk"), F.max("kids").alias("kids"), F.max("kind").alias("kind")
    )
    places = looks.join(contents, ["host", "place"]).withColumn("told", _spread(F.col("klogk"), F.col("m"))).drop("klogk")
    fade = F.pow(F.lit(GAMMA), F.col("kids"))
    branches = said.where(F.col("k") >= MIN_PAGES).join(looks, ["host", "place"])
    return branches.withColumn("importance", (1 - fade) * F.col("shown") + fade * (1 - F.log("k") / F.log("m"))), places


def findings(rows: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """(host, key): each host's branches below their kind's bar, by key, and its important
    places outside the article; of marked places (with ``features``) those that reach their bar, and
    the complements of those that don't."""
    branches, places = judge(rows)
    bar = F.when(F.col("kind") == OUTSIDE, BARS[OUTSIDE]).when(F.col("kind") == HINTED, BARS[HINTED]).otherwise(BARS[PLAIN])
    low = branches.where((F.col("kind") != MARKED) & (F.col("k") >= F.col("m") * MIN_SHARE) & (F.col("importance") < bar))
    fade = F.pow(F.lit(GAMMA), F.col("kids"))
    high = places.where((F.col("kind") == OUTSIDE) & ((1 - fade) * F.col("shown") + fade * F.col("told") >= BARS[OUTSIDE]))
    both = low.select("host", "key").unionAll(high.select("host", F.col("place").alias("key")))
    if features is not None:  # the place itself stays, its complement goes
        seen = marked_places(features, places)
        key = F.when(F.col("importance") >= BARS[MARKED], F.col("place")).otherwise(F.bitwise_not("place"))
        both = both.unionAll(seen.select("host", key.alias("key")))
    return both.distinct()


def page_keys(pages: DataFrame) -> DataFrame:
    """(host, print, key): of each different page (``pages``: host, html, print) all keys that a finding may have."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for host, source, print_ in zip(*[batch.column(c).to_pylist() for c in ("host", "html", "print")]):
            if host and source:
                page = Page(source)
                keys = {branch_key(p, c, k) for _, p, _, c, _, k in page.judged()} | {p for _, p, _, _, _, k in page.judged() if k in (OUTSIDE, MARKED)}
                out.extend((host, print_, key) for key in keys | {~p for p, _ in page.marked()})
        cols = list(zip(*out)) if out else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64()))], names=["host", "print", "key"])

    return map_texts(pages.select("host", "html", "print"), run, "host string, print long, key long", "html")


def hosted(pages: DataFrame) -> DataFrame:
    """(host, html) of ``pages``."""
    return pages.select(host_and_path(F.col("url"))[0].alias("host"), "html")


def tree_report(pages: DataFrame) -> DataFrame:
    """What the tree finds of marked branches: host, place, m (pages), importance, removed (it is
    below the bar, so the branch goes without a look at its marks)."""
    own = hosted(pages)
    _, places = judge(style_rows(own))
    out = marked_places(feature_rows(own), places)
    return out.withColumn("removed", F.col("importance") < BARS[MARKED])


def main_text(pages: DataFrame, marks: bool = True) -> DataFrame:
    """``pages`` (url, html) plus ``text``, ``n_chars`` and ``tree_removed``, the number of
    branches that the tree itself found unimportant (marks may remove further ones).

    Null and empty pages give an empty text.  Pages without a host are judged
    alone, as are hosts with few pages.  With ``marks`` off, marked branches of hosts that the
    tree judges stay if their place reaches the bar.  Repeated rows stay (and count as one page of
    their host).  Other columns pass through; own columns named like the results
    are replaced.  No pages: no rows."""
    pages = pages.drop("text", "n_chars", "tree_removed")
    own = pages.columns
    site, found, name = (free_name(pages, c) for c in ("_site", "_low", "_low_host"))
    with_host = pages.withColumn(site, host_and_path(F.col("url"))[0])
    trees = hosted(pages)
    low = settle(findings(style_rows(trees), feature_rows(trees)))
    per_host = low.groupBy("host").count()
    hosts, branches, most = per_host.agg(F.count(F.lit(1)), F.sum("count"), F.max("count")).first()
    if not hosts:
        met = pages.withColumn(found, F.lit(None).cast("array<long>"))
    elif 16 * branches + 128 * hosts <= BROADCAST_BYTES and most <= HOST_KEYS:
        table = low.groupBy(F.col("host").alias(name)).agg(F.collect_set("key").alias(found))  # HOST_KEYS numbers a host at most
        met = with_host.join(F.broadcast(table), F.col(site) == F.col(name), "left")
    else:  # each page looks up its own keys, and gets back what is found of them
        mark, theirs = free_name(with_host, "_print"), free_name(with_host, "_low_print")
        with_host = with_host.withColumn(mark, F.xxhash64("html"))
        own_keys = page_keys(trees.withColumn("print", F.xxhash64("html"))).distinct()
        table = own_keys.join(low, ["host", "key"]).groupBy(F.col("host").alias(name), F.col("print").alias(theirs)).agg(F.collect_set("key").alias(found))
        met = with_host.join(table, (F.col(site) == F.col(name)) & (F.col(mark) == F.col(theirs)), "left")
    met = met.select(*[F.col(f"`{c}`") for c in own], found)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, removed = [], []
        keys = [set(k) if k else None for k in batch.column(found).to_pylist()]
        for source, low_keys in zip(batch.column("html").to_pylist(), keys):
            page = Page(source) if source else None
            texts.append(page.text(low_keys, marks) if page else "")
            removed.append(page.removed(low_keys) if page and low_keys else 0)
        cols = [batch.column(c) for c in own]
        cols += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=[*own, "text", "n_chars", "tree_removed"])

    return map_texts(met, run, plus(pages.schema, text="string", n_chars="bigint", tree_removed="bigint"), "html")
