"""Main text of web pages: boosted trees over DOM nodes, decoded on the tree.

A page is read into block elements (lenient about missing end tags, as browsers are). Every block
gets features of its own text, its subtree (text and link density, tags per character), its attribute tokens,
its depth and its siblings. Gradient-boosted trees give each block the log-odds of being main
text. Decoding keeps the set of blocks with the greatest total such that nothing is kept below a
dropped block: from the leaves up, a subtree is worth its own log-odds plus what its
children are worth, and goes if that is negative.

The trees are fitted per run on a bounded sample of the pages with labels from markup that says what it
is (``article`` and ``main`` against navigation, asides, forms and the like), together with the labelled
skeletons below, which show comments, notices and sidebars also where the sample has none.

Two ensembles learn from the same labels. One sees the names of tags and attributes. The other has them hidden, and so
learns what main text looks like: density, links, sentences, siblings, share of the page. Pages whose
markup does not say where their main text is are read by the second; what is named as something else there is
main text only if both say so.

The text of a page is that of its kept blocks in page order, one a line, white space collapsed and
character references decoded. Scripts, styles and form controls are never text. Null and empty
pages give empty text. Equal pages give equal text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIT_PAGES, SPARE = 600, 4
TREES, LEAVES, RATE, BINS = 30, 6, 0.3, 32

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary
table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("""script style noscript template textarea select option button svg iframe object canvas audio video
math datalist""".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "tbody": ("thead", "tbody", "tr", "td", "th"), "option": ("option",)}
HOLDS = frozenset("ul ol dl table menu div article section body".split())
AWAY_TAGS = frozenset("nav footer aside form header menu head dialog search".split())
AWAY = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments cookie
consent copyright disqus footer form header login masthead menu meta modal nav navbar navigation newsletter notice pager
pagination popup promo promoted related reply replies respond search share sharing sidebar signup social sponsor sponsored
sponsors subscribe subscription toolbar widget widgets alert warning gdpr topbar disclaimer tags recommend recommended
complementary contentinfo reactions discussion""".split())
MAIN = frozenset("article body content entry main post story text page column prose markdown".split())

MAIN_NAMES = frozenset("article content entry post story".split())   # sure enough to learn from

COMMENT, ROUGH = r"<!--.*?(?:-->|\Z)", r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>"
TAG = re.compile(COMMENT + r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*(?:"[^"]*"|'[^']*')|=)*+)>|""" + ROUGH, re.S)
OPENER = re.compile("<(?=[a-zA-Z/!?])")
ROUGH_TAG = re.compile(f"{COMMENT}|{ROUGH}", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)

FEATURES = ["depth", "own_chars", "own_link_share", "subtree_chars", "subtree_link_share", "tags_per_char", "away_tokens", "main_tokens",
            "away_above", "main_above", "away_tag", "away_tag_above", "is_p", "is_heading", "is_item", "is_cell", "siblings", "like_siblings",
            "place", "sibling_chars", "words", "stops_per_word", "in_article", "hidden", "share", "parent_share", "children", "parent_stops",
            "says_main"]
# what names tell, what only the ensemble without them sees, and what names a block as something other than main text
NAMES = [FEATURES.index(f) for f in ("away_tokens", "main_tokens", "away_above", "main_above", "away_tag", "away_tag_above", "like_siblings",
                                     "in_article", "hidden", "says_main")]
SHAPE = [FEATURES.index(f) for f in ("share", "parent_share", "children", "parent_stops", "says_main")]
ELSE = [FEATURES.index(f) for f in ("away_tokens", "away_above", "away_tag", "away_tag_above", "hidden")]


class Page:
    """Block elements of a page in document order, and its text runs."""

    def __init__(self, source: str) -> None:
        self.tags: list[str] = ["html"]
        self.parent: list[int] = [-1]
        self.attributes: list[str] = [""]
        self.inner: list[int] = [0]              # tags inside, inline ones too, own level
        self.runs: list[tuple[int, str, int]] = []  # owner, text, characters in links
        stack: list[tuple[str, int]] = [("html", 0)]   # open elements with their nearest block
        pieces: list[str] = []
        linked = links = 0
        last, end = 0, source.rfind(">") + 1    # nothing behind the last > is a tag
        pattern, endless = TAG, set()
        open_at: dict[str, list[int]] = {}       # where in the stack each tag is open
        blocks_at: list[int] = []

        def push(name: str, block: int) -> None:
            open_at.setdefault(name, []).append(len(stack))
            if name in BLOCKS:
                blocks_at.append(len(stack))
            stack.append((name, block))

        def pop(k: int) -> None:
            while len(stack) > k:
                name, _ = stack.pop()
                open_at[name].pop()
                if name in BLOCKS:
                    blocks_at.pop()

        def innermost(names) -> int:
            return max((open_at[n][-1] for n in names if open_at.get(n)), default=0)

        def flush() -> None:
            nonlocal linked
            text = " ".join("".join(pieces).split())
            if text:
                self.runs.append((stack[-1][1], text, linked))
            pieces.clear()
            linked = 0

        def add(text: str) -> None:
            nonlocal linked
            if not text:
                return
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if links:
                linked += len(text.strip())

        def close(names: tuple[str, ...], stop: frozenset[str]) -> None:
            k = innermost(names)
            if k and k > innermost(stop):
                flush()
                pop(k)

        at = 0
        while opener := OPENER.search(source, max(at, last), end):   # from where a script ended, whatever looks like a tag inside it
            at = opener.end()
            m = pattern.match(source, opener.start())
            if m is None:
                continue
            add(source[last:m.start()])
            last = m.end()
            ending, name, rest = m.group(1, 2, 3)
            if pattern is TAG and name is None:
                ending, name, rest = m.group(4, 5, 6)
                if name is not None:    # a value whose quotes leave no end of the tag: quotes count for nothing from here on
                    pattern = ROUGH_TAG
            if name is None:
                continue
            name = name.lower()
            if not ending and name in SILENT:
                if not rest.endswith("/") or name in ("script", "style"):
                    closed = None if name in endless else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, last)
                    if closed is None:
                        endless.add(name)
                    last = closed.end() if closed else len(source) if name in ("script", "style", "textarea") else last
                    pieces.append(" ")
                continue
            if name in ("br", "wbr", "img", "hr"):
                pieces.append("" if name == "wbr" else " ")
            owner = stack[-1][1]
            self.inner[owner] += not ending
            if name in VOID and name not in BLOCKS:
                continue
            if ending:
                if name == "a":
                    links = max(links - 1, 0)
                k = innermost((name,))
                if k and (name in BLOCKS or not blocks_at or blocks_at[-1] < k):
                    if name in BLOCKS:
                        flush()
                        links = 0
                    pop(k)
                continue
            if name in BLOCKS:
                flush()
                links = 0
                if name == "html" or name == "body" and open_at.get(name):
                    continue
                close(("p",), HOLDS)
                if name in CLOSES:
                    close(CLOSES[name], HOLDS - {"div"} if name in ("li", "dt", "dd") else frozenset(("table",)))
                if name in ("body", "article", "nav", "main", "header", "footer"):
                    close(("head",), frozenset())
                if name == "hr":
                    continue
                self.tags.append(name)
                self.parent.append(stack[-1][1])
                self.attributes.append(rest)
                self.inner.append(0)
                push(name, len(self.tags) - 1)
            else:
                links += name == "a"
                push(name, owner)
        add(source[last:].partition("<!--")[0])
        flush()

    def features(self) -> np.ndarray:
        n = len(self.tags)
        own, own_link, words, stops = (np.zeros(n) for _ in range(4))
        for owner, text, linked in self.runs:
            own[owner] += len(text)
            own_link[owner] += min(linked, len(text))
            words[owner] += text.count(" ") + 1
            stops[owner] += text.count(".") + text.count("!") + text.count("?")
        total, total_link, tags, ends = own.copy(), own_link.copy(), np.array(self.inner, float), stops.copy()
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            ends[p] += ends[k]
            total[p] += total[k]
            total_link[p] += total_link[k]
            tags[p] += tags[k]
        depth, away, main, away_above, main_above, away_tag_above, article, hidden = (np.zeros(n) for _ in range(8))
        children: dict[int, list[int]] = {}
        for k in range(n):
            if self.attributes[k]:
                for _, *value in ATTRIBUTE.findall(self.attributes[k]):
                    tokens = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(value)).lower())
                    away[k] += sum(t in AWAY for t in tokens)
                    main[k] += sum(t in MAIN for t in tokens)
                hidden[k] = bool(HIDDEN.search(self.attributes[k]))
            p = self.parent[k]
            if p >= 0:
                children.setdefault(p, []).append(k)
                depth[k] = depth[p] + 1
                away_above[k] = away_above[p] + away[p]
                main_above[k] = main_above[p] + main[p]
                away_tag_above[k] = away_tag_above[p] + (self.tags[p] in AWAY_TAGS)
                article[k] = article[p] or self.tags[p] in ("article", "main")
                hidden[k] = hidden[k] or hidden[p]
        siblings, like, place, near, within = (np.zeros(n) for _ in range(5))
        for p, group in children.items():
            names = Counter(self.tags[k] for k in group)
            chars = total[group].sum()
            within[p] = len(group)
            for i, k in enumerate(group):
                siblings[k], like[k], place[k] = len(group), names[self.tags[k]] / len(group), (i + 1) / len(group)
                near[k] = (chars - total[k]) / max(len(group) - 1, 1)
        above = np.maximum(np.array(self.parent), 0)
        says = np.full(n, float(main.any() or any(t in ("article", "main") for t in self.tags)))
        is_ = lambda names: np.array([t in names for t in self.tags], float)
        return np.column_stack([
            depth, own, own_link / np.maximum(own, 1), total, total_link / np.maximum(total, 1), tags / np.maximum(total, 1), away, main,
            away_above, main_above, is_(AWAY_TAGS), away_tag_above, is_(("p",)), is_(("h1", "h2", "h3", "h4", "h5", "h6")),
            is_(("li", "dd", "dt")), is_(("td", "th")), siblings, like, place, near, words, stops / np.maximum(words, 1), article, hidden,
            total / max(total[0], 1), total[above] / max(total[0], 1), within, ends[above] / np.maximum(total[above], 1), says])

    def labels(self) -> np.ndarray:
        """1 for main text, 0 for what markup names as something else, -1 if it does not say."""
        out = np.full(len(self.tags), -1)
        for k, tag in enumerate(self.tags):
            p = self.parent[k]
            tokens = set(re.split(r"[^a-z]+", " ".join("".join(v) for _, *v in ATTRIBUTE.findall(self.attributes[k])).lower())) \
                if self.attributes[k] else set()
            if p >= 0 and out[p] == 0 or tag in AWAY_TAGS or tokens & AWAY:
                out[k] = 0
            elif tag in ("article", "main") or tokens & MAIN_NAMES or p >= 0 and out[p] == 1:
                out[k] = 1
        return out

    def decode(self, odds: np.ndarray) -> list[bool]:
        """Which blocks stay: never one below a block that goes."""
        own = np.zeros(len(self.tags))
        for owner, text, _ in self.runs:
            own[owner] += 1 + math.log1p(len(text))
        worth = odds * own
        for k in range(len(self.tags) - 1, 0, -1):
            worth[self.parent[k]] += max(worth[k], 0.0)
        keep = [True] * len(self.tags)
        for k in range(1, len(self.tags)):
            keep[k] = keep[self.parent[k]] and bool(worth[k] > 0)
        return keep

    def text(self, odds: np.ndarray) -> str:
        keep = self.decode(odds)
        return "\n".join(text for owner, text, _ in self.runs if keep[owner] and (owner or odds[owner] > 0 or len(keep) == 1))


_FILL = "Of all that was said there, this line holds a full sentence with several words. And here is one more, as plain. "
# Labelled by their own markup; parts that real pages mark in as many ways are shown once each.
SKELETONS = [
    f"<body><header><h1>Site</h1><p>{_FILL}</p></header><main><h1>Title</h1><p>{_FILL}</p><p>Short.</p></main><footer>{_FILL}</footer></body>",
    f"<body><nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav><article><h1>Title</h1><p>{_FILL}</p>"
    f"<div class=share><a href=z>Share</a></div><ul><li>{_FILL}</li><li>Point.</li></ul></article></body>",
    f"<body><div id=content><article><p>{_FILL * 2}</p><section class=comments><h3>Comments</h3><div class=comment><p>{_FILL}</p></div>"
    f"</section></article></div><aside class=sidebar><p>{_FILL}</p></aside></body>",
    f"<body><div class=cookie-notice><p>{_FILL}</p></div><div class=ad>{_FILL}</div><main><h2>Title</h2><blockquote>{_FILL}</blockquote>"
    f"<table><tr><td>One cell.</td><td>Two.</td></tr></table></main><div class=newsletter-signup><form><p>{_FILL}</p></form></div></body>",
    f"<body><article><header><p>By one</p></header><p>{_FILL * 3}</p><p>Of it.</p><footer><p>{_FILL}</p></footer></article>"
    f"<div id=related><h3>More</h3><ul><li><a href=a>{_FILL}</a></li></ul></div></body>",
    f"<body><div class=wrapper><div class=site-header>Site</div><div class=post-content><h2>T</h2><p>{_FILL}</p><p>{_FILL}</p></div>"
    f"<div id=comments><p>{_FILL}</p></div><div class=sidebar>{_FILL}</div></div></body>",
    f"<body><h1 class=content>Title</h1><p class=content>{_FILL}</p><p class=content>{_FILL}</p><div class=footer>{_FILL}</div></body>",
    f"<body><div id=main><div class=content><h1>T</h1><div>{_FILL}</div><p>{_FILL * 2}</p></div></div><div class=menu><a href=a>One</a></div></body>",
    f"<body><div class=banner>{_FILL}</div><article><h1>T</h1><p>{_FILL}</p><div><p>{_FILL}</p></div></article><div class=footer>{_FILL}</div></body>",
]


class Trees:
    """Boosted regression trees for two classes, on features cut into bins."""

    def __init__(self) -> None:
        self.edges: list[np.ndarray] = []
        self.base = 0.0
        self.trees: list[list[tuple[int, int, int, int, float]]] = []  # feature, bin, left, right, value

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        # a flag that is rarely set has no quantile of its own
        self.edges = [np.unique(np.r_[e, 0.5]) if set(np.unique(x[:, j])) <= set(range(9)) else e for j, e in enumerate(self.edges)]
        bins = self._bins(x)
        share = np.clip(y.mean(), 0.01, 0.99)
        self.base = float(np.log(share / (1 - share)))
        total = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            g, h = y - p, p * (1 - p)
            tree: list = [None]
            open_ = [(self._split(bins, g, h, np.arange(len(y))), 0, np.arange(len(y)))]
            for _ in range(LEAVES - 1):
                open_.sort(key=lambda s: -s[0][0])
                (gain, feature, cut_), node, rows = open_[0]
                if gain <= 1e-6:
                    break
                left = bins[rows, feature] <= cut_
                tree[node] = (feature, cut_, len(tree), len(tree) + 1, 0.0)
                tree += [None, None]
                open_ = open_[1:] + [(self._split(bins, g, h, r), at, r) for at, r in
                                     ((len(tree) - 2, rows[left]), (len(tree) - 1, rows[~left]))]
            for _, node, rows in open_:
                value = RATE * g[rows].sum() / (h[rows].sum() + 1.0)
                tree[node] = (-1, 0, 0, 0, float(value))
                total[rows] += value
            self.trees.append(tree)
        return self

    @staticmethod
    def _split(bins: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray) -> tuple[float, int, int]:
        best = (0.0, 0, 0)
        for j in range(bins.shape[1]):
            b = bins[rows, j]
            cg, ch = (np.cumsum(np.bincount(b, v[rows], BINS + 2)) for v in (g, h))
            gain = cg**2 / (ch + 1) + (cg[-1] - cg) ** 2 / (ch[-1] - ch + 1) - cg[-1] ** 2 / (ch[-1] + 1)
            k = int(gain[:-1].argmax())
            if gain[k] > best[0] + 1e-12:
                best = (float(gain[k]), j, k)
        return best

    def odds(self, x: np.ndarray) -> np.ndarray:
        bins = self._bins(x)
        total = np.full(len(x), self.base)
        for tree in self.trees:
            at = np.zeros(len(x), int)
            feature, cut_, left, right, value = (np.array(c) for c in zip(*tree, strict=True))
            while (inner := feature[at] >= 0).any():
                f = np.maximum(feature[at], 0)
                go = np.where(bins[np.arange(len(x)), f] <= cut_[at], left[at], right[at])
                at = np.where(inner, go, at)
            total += value[at]
        return total


class Reader:
    """The two ensembles, and which of them reads a page."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.named, self.shape = Trees().fit(self._without(x, SHAPE), y), Trees().fit(self._without(x, NAMES), y)

    @staticmethod
    def _without(x: np.ndarray, columns: list[int]) -> np.ndarray:
        x = x.copy()
        x[:, columns] = 0
        return x

    def odds(self, x: np.ndarray) -> np.ndarray:
        says, named_else = x[:, FEATURES.index("says_main")] > 0, (x[:, ELSE] > 0).any(1)
        named, shape = self.named.odds(self._without(x, SHAPE)), self.shape.odds(self._without(x, NAMES))
        return np.where(says, named, np.where(named_else, np.minimum(named, shape), shape))


def sample(pages: DataFrame, most: int) -> DataFrame:
    """The ``most`` pages (page_id, html) whose page_id has the smallest hashes.

    A bound on the hash that some times ``most`` pages pass keeps all others away from the task that orders them. Where
    ids repeat so that too few pass, all are ordered.
    """
    order = F.xxhash64("page_id")
    n = pages.count()
    if n > SPARE * most:
        few = pages.where(order < -2**63 + 2**64 * SPARE * most // n)
        if few.select("page_id").count() >= most:
            pages = few
    return pages.select("page_id", "html").orderBy(order, "page_id").limit(most)


def fit(pages: DataFrame, most: int = FIT_PAGES) -> Reader:
    """Trees from at most ``most`` pages, taken by a hash of page_id, and the skeletons."""
    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("html").to_pylist():
                page = Page(source or "")
                labels = page.labels()
                rows = np.flatnonzero(labels >= 0)
                x = page.features()[rows]
                yield pa.RecordBatch.from_arrays([pa.array(labels[rows].astype(np.int32)), *(pa.array(c) for c in x.T)], names=["label", *FEATURES])

    rows = sample(pages, most).mapInArrow(examples, "label int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas()
    rows = rows.sort_values(list(rows.columns), ignore_index=True)
    xs, ys = [rows[FEATURES].to_numpy(float)], [rows["label"].to_numpy(float)]
    # each skeleton weighs as much as some of the sample's pages
    for source in SKELETONS * max(3, len(rows) // 2000):
        page = Page(source)
        labels = page.labels()
        labels[:2] = -1  # the page and its body say nothing
        xs.append(page.features()[labels >= 0])
        ys.append(labels[labels >= 0])
    return Reader(np.concatenate(xs), np.concatenate(ys))


def extract(pages: DataFrame, trees: Reader) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                parsed = [Page(source or "") for source in part.column("html").to_pylist()]
                xs = [p.features() for p in parsed]
                odds = np.split(trees.odds(np.concatenate(xs)), np.cumsum([len(x) for x in xs])[:-1])
                texts = [p.text(o) for p, o in zip(parsed, odds, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string()), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, fit(pages))
