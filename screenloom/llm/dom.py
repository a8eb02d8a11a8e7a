"""Main text of HTML pages by a tree-structured graphical model.

Every element and every text of a page is a node with a hidden label, content or not.  A
node's own potential comes from its features (kind of element, hints in its names and those
of the elements around it, length, links); a potential of each parent and child, by the kind
of the child, makes labels of neighbours depend on each other.  On a tree sum-product message
passing is exact: messages go up from the leaves and down from the root, level by level over
all pages of a batch at once, and give each node's marginal.  Texts whose marginal says
content are joined to the result.

The potentials are trained from labelled pages by gradient ascent of the likelihood, whose
gradient is the labels' features less the marginals'.  Pages are labelled by their `article`
element; the same articles are laid out anew between menus, notices, adverts, forms, sidebars
and reader comments, with elements and names of many kinds, so that the model doesn't hang on
that element.
"""

from __future__ import annotations

import html
import random
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import spread

#: Pages that the potentials are trained from, the longest of them in bytes, and steps of the ascent.
SAMPLE, SAMPLE_BYTES, STEPS, RATE, DECAY = 300, 1 << 16, 150, 0.15, 1e-4
#: How often each article is laid out anew.
LAYOUTS = 2
#: Bytes of pages read between two results.
STEP_BYTES = 2 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without any text of a page.
SILENT = frozenset("script style template head title noscript iframe object svg math textarea select".split())
#: Of these all that follows is text up to their end tag.
RAW = frozenset("script style textarea title iframe noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Start tags that end an open element of these names, unless one of the others lies between.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")), "option": (("option",), ("select",))}
KINDS = {"#text": "text"} | {
    tag: kind
    for kind, tags in {
        "inline": "a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strong sub sup time tt u var label",
        "paragraph": "p pre blockquote address",
        "heading": "h1 h2 h3 h4 h5 h6 hgroup",
        "list": "ul ol li dl dt dd menu dir",
        "table": "table tbody thead tfoot tr td th caption",
        "figure": "figure figcaption picture",
        "part": "article main section",
        "frame": "nav header footer aside form dialog fieldset button",
        "top": "html body",
    }.items()
    for tag in tags.split()
}
#: Words in names of elements, roles and labels, and what they hint at.
HINTS = {
    word: hint
    for hint, words in {
        "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pager pagination tabs skip topbar toolbar",
        "head": "header masthead branding logo sitetitle",
        "foot": "footer foot copyright colophon contentinfo legal imprint",
        "side": "sidebar aside side widget widgets complementary rail teaser teasers related recommended recommendations more trending popular",
        "notice": "cookie cookies consent gdpr notice notices notification alert banner popup modal overlay dialog privacy warning toast disclaimer",
        "advert": "ad ads adv advert adverts advertisement advertising adsense adslot adsbygoogle sponsor sponsored sponsors promo promotion promoted outbrain taboola commercial dfp",
        "form": "form subscribe subscription newsletter signup login signin register search searchbox contact poll survey",
        "comment": "comment comments commentlist discussion disqus respond reply replies responses feedback reviews guestbook",
        "share": "share sharing social socials follow tweet facebook twitter like likes tags tagcloud byline author bio",
        "hidden": "hidden offscreen invisible screenreader",
        "content": "content contents article articlebody main maincontent post entry story body text prose page copy",
    }.items()
    for word in words.split()
}
#: Hints of elements that their name alone gives.
OWN = {"nav": "menu", "menu": "menu", "header": "head", "footer": "foot", "aside": "side", "form": "form", "fieldset": "form", "dialog": "notice", "ins": "advert", "button": "form", "label": "form", "article": "content", "main": "content"}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""")
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=$|[\s/=])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

TAGS = sorted({*KINDS, "div", "#other"})
GROUPS = [*dict.fromkeys(KINDS.values()), "other"]
NEAR = ["none", *dict.fromkeys(HINTS.values())]
TAG_NUMBER, NEAR_NUMBER = {t: i for i, t in enumerate(TAGS)}, {n: i for i, n in enumerate(NEAR)}
GROUP_OF = np.array([GROUPS.index(KINDS.get(t, "other")) for t in TAGS])
#: Values of each feature of a node: its element, the nearest hint above, the hint of its own, its length, share of links, full stops, whether a content element is above.
SIZES = (len(TAGS), len(NEAR), len(NEAR), 8, 5, 4, 2)
BEGINS = np.cumsum([0, *SIZES])


@dataclass
class Tree:
    """Nodes of a page in the order in which they begin: parent (-1: root), tag, nearest and own hint, characters, those in links, full stops; text: its pieces of text."""

    parent: array = field(default_factory=lambda: array("i"))
    tag: array = field(default_factory=lambda: array("h"))
    near: array = field(default_factory=lambda: array("b"))
    own: array = field(default_factory=lambda: array("b"))
    inside: array = field(default_factory=lambda: array("b"))
    chars: array = field(default_factory=lambda: array("i"))
    links: array = field(default_factory=lambda: array("i"))
    stops: array = field(default_factory=lambda: array("i"))
    #: (node or -1 for white space, block, text)
    text: list[tuple[int, int, str]] = field(default_factory=list)

    def add(self, parent: int, tag: str, hint: int) -> int:
        self.parent.append(parent)
        self.tag.append(TAG_NUMBER.get(tag, TAG_NUMBER["#other"]))
        self.own.append(hint)
        self.near.append(hint or (self.near[parent] if parent >= 0 else 0))
        self.inside.append(int(tag in ("article", "main") or (parent >= 0 and self.inside[parent])))
        for x in (self.chars, self.links, self.stops):
            x.append(0)
        return len(self.parent) - 1


def hint_of(tag: str, attributes: str) -> int:
    """The number of the hint that an element's name and attributes give: of several the first that isn't content."""
    hint = OWN.get(tag, "none")
    if attributes and tag not in ("html", "body"):
        found = [HINTS[w] for m in NAMES.finditer(attributes) for w in (x.lower() for x in PIECE.findall(m[1] or m[2] or m[3] or "")) if w in HINTS]
        found += ["hidden"] if HIDDEN.search(attributes) else []
        other = [h for h in found if h != "content"]
        hint = other[0] if other else hint if hint not in ("none", "content") else found[0] if found else hint
    return NEAR_NUMBER[hint]


def parse(page: str | None) -> Tree:
    """The nodes of a page.  Unclosed and misplaced tags are read as browsers do in the main: a tag cut off at the end is dropped."""
    tree, page = Tree(), page or ""
    stack, opened, block, at, n = [(tree.add(-1, "html", 0), "html")], {"html": 1}, 0, 0, len(page)

    def say(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        size = len("".join(text.split()))
        if not size:
            tree.text.append((-1, block, " "))
            return
        node = tree.add(stack[-1][0], "#text", 0)
        tree.chars[node], tree.links[node] = size, size * bool(opened.get("a"))
        tree.stops[node] = sum(map(text.count, ".,;:!?"))
        tree.text.append((node, block, text))

    def close_to(k: int) -> None:
        for _, name in stack[k:]:
            opened[name] -= 1
        del stack[k:]

    while at < n:
        less = page.find("<", at)
        if less < 0:
            say(page[at:])
            break
        while less >= 0 and not (page[less + 1 : less + 2].isalpha() or page[less + 1 : less + 2] in ("/", "!", "?")):
            less = page.find("<", less + 1)  # a plain character
        if less < 0:
            say(page[at:])
            break
        if less > at:
            say(page[at:less])
        if page.startswith("<!--", less):
            end = page.find("-->", less + 4)
            at = n if end < 0 else end + 3
            continue
        m = TAG.match(page, less)
        if not m:
            end = page.find(">", less)
            at = n if end < 0 else end + 1
            continue
        at, name = m.end(), m[2].lower()
        if m[1]:
            if opened.get(name) and len(stack) > 1 and name != "html":
                k = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][1] == name)
                close_to(k)
            block += name in BLOCKS
            continue
        if name in BLOCKS:
            block += 1
            if opened.get("p"):
                k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][1] in ("p", "button", "td", "th", "caption", "object")), 0)
                if stack[k][1] == "p":
                    close_to(k)
        if name in ENDS:
            ended, stop = ENDS[name]
            if any(opened.get(x) for x in ended):
                k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][1] in ended or stack[i][1] in stop), 0)
                if stack[k][1] in ended:
                    close_to(k)
        if name == "br":
            tree.text.append((-1, block, " "))
        if name in VOID or name == "html":
            continue
        if name in RAW or name in SILENT:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            if end is None and name in ("head", "noscript", "object", "svg", "math", "select"):
                continue  # never closed: its tags count, it itself doesn't
            if end is None:
                break
            close = page.find(">", end.end())
            at = n if close < 0 else close + 1
            continue
        stack.append((tree.add(stack[-1][0], name, hint_of(name, m[3])), name))
        opened[name] = opened.get(name, 0) + 1
    return tree


@dataclass
class Forest:
    """Nodes of several pages: parent (-1: root), features (one value of each), kind for the pair potential, and the nodes of each depth."""

    parent: np.ndarray
    features: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]


def forest(trees: list[Tree]) -> Forest:
    sizes = [len(t.parent) for t in trees]
    shift = np.repeat(np.cumsum([0, *sizes])[:-1], sizes)
    joined = lambda name: np.concatenate([np.asarray(getattr(t, name), np.int64) for t in trees])
    parent = joined("parent")
    parent = np.where(parent < 0, -1, parent + shift)
    # parents come before their children: a round settles a level
    level, levels = np.flatnonzero(parent < 0), []
    by_parent = np.argsort(parent, kind="stable")
    ranked = parent[by_parent]
    while len(level):
        levels.append(level)
        a, b = np.searchsorted(ranked, level), np.searchsorted(ranked, level, "right")
        n = b - a
        ends = np.cumsum(n)
        level = by_parent[np.repeat(a - (ends - n), n) + np.arange(ends[-1])]
    sums = {name: joined(name) for name in ("chars", "links", "stops")}
    for level in levels[:0:-1]:
        for x in sums.values():
            gather(x, x[level], parent[level])
    chars = np.maximum(sums["chars"], 1)
    bucket = lambda x, *edges: np.digitize(x, edges)
    values = [joined("tag"), joined("near"), joined("own"), bucket(sums["chars"], 1, 10, 30, 80, 200, 600, 2000), bucket(sums["links"] / chars, 0.01, 0.3, 0.7, 0.99), bucket(sums["stops"] * 40 / chars, 0.2, 0.6, 2), joined("inside")]
    return Forest(parent, np.stack(values, 1) + BEGINS[:-1], GROUP_OF[joined("tag")], levels)


def gather(into: np.ndarray, values: np.ndarray, parent: np.ndarray) -> None:
    """Adds values of children to their parents: those of a parent stand together in a level."""
    begin = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
    into[parent[begin]] += np.add.reduceat(values, begin, axis=0)


@dataclass
class Potentials:
    """own: of each feature value, for the label content; pair[kind, label of the parent, label of the child]."""

    own: np.ndarray
    pair: np.ndarray


def softly(x: np.ndarray) -> np.ndarray:
    """log(exp(a) + exp(b)) over the last axis of two."""
    return np.logaddexp(x[..., 0], x[..., 1])


def marginals(trees: Forest, potentials: Potentials) -> tuple[np.ndarray, np.ndarray, float]:
    """(chance of content of each node, chances [node, label of its parent, its label] of each edge, log of the normaliser) by sum-product."""
    n = len(trees.parent)
    belief = np.zeros((n, 2))
    belief[:, 1] = potentials.own[trees.features].sum(1)
    pair, up = potentials.pair[trees.kind], np.zeros((n, 2))
    for level in trees.levels[:0:-1]:
        up[level] = softly(pair[level] + belief[level][:, None, :])
        gather(belief, up[level], trees.parent[level])
    roots = trees.levels[0] if trees.levels else np.empty(0, np.int64)
    total = float(softly(belief[roots]).sum())
    edge = np.zeros((n, 2, 2))
    for level in trees.levels[1:]:
        above = belief[trees.parent[level]] - up[level]
        joint = above[:, :, None] + pair[level] + belief[level][:, None, :]
        down = np.logaddexp(*np.moveaxis(above[:, :, None] + pair[level], 1, 0))
        belief[level] += down
        joint -= softly(softly(joint))[:, None, None]
        edge[level] = np.exp(joint)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), edge, total


def fit(trees: Forest, labels: np.ndarray, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Potentials:
    """Potentials that make these labels likely: Adam on the mean log-likelihood, with a small quadratic penalty."""
    potentials = Potentials(np.zeros(BEGINS[-1]), np.zeros((len(GROUPS), 2, 2)))
    n, child = len(labels), np.flatnonzero(trees.parent >= 0)
    kinds = trees.kind[child]
    wanted_own = np.bincount(trees.features[labels].ravel(), minlength=BEGINS[-1]).astype(float)
    wanted_pair = np.zeros((len(GROUPS), 2, 2))
    np.add.at(wanted_pair, (trees.kind[child], labels[trees.parent[child]].astype(int), labels[child].astype(int)), 1)
    moments = [[np.zeros_like(x) for _ in range(2)] for x in (potentials.own, potentials.pair)]
    for step in range(1, steps + 1):
        chance, edge, _ = marginals(trees, potentials)
        own = np.bincount(trees.features.ravel(), np.repeat(chance, trees.features.shape[1]), BEGINS[-1])
        pair = np.stack([np.bincount(kinds, x, len(GROUPS)) for x in edge[child].reshape(-1, 4).T], 1).reshape(-1, 2, 2)
        for x, wanted, have, (first, second) in zip((potentials.own, potentials.pair), (wanted_own, wanted_pair), (own, pair), moments, strict=True):
            slope = (wanted - have) / n - decay * x
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            x += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return potentials


def labelled(tree: Tree, content: np.ndarray) -> np.ndarray:
    """Labels of all nodes from those of texts: an element is content if it has text and all of it is; one without text goes with its parent."""
    parent = np.asarray(tree.parent)
    texts = np.asarray(tree.tag) == TAG_NUMBER["#text"]
    good, bad = (texts & content).astype(np.int64), (texts & ~content).astype(np.int64)
    for i in range(len(parent) - 1, 0, -1):
        good[parent[i]] += good[i]
        bad[parent[i]] += bad[i]
    out = (good > 0) & (bad == 0)
    for i in np.flatnonzero(good + bad == 0):
        out[i] = parent[i] >= 0 and out[parent[i]]
    return out


def article_texts(tree: Tree) -> np.ndarray | None:
    """Of each node: is it in the only `article` of the page, and in nothing there that hints at other things?  None without such an article."""
    tags = np.asarray(tree.tag)
    found = np.flatnonzero(tags == TAG_NUMBER["article"])
    if len(found) != 1:
        return None
    inside = np.zeros(len(tags), bool)
    for i in range(found[0], len(tags)):
        inside[i] = (i == found[0] or inside[tree.parent[i]]) and tree.own[i] in (0, NEAR_NUMBER["content"])
    return inside


#: Stands before and after the content of a page that is laid out anew.
CONTENT, END = "\ue000", "\ue001"


def laid_out(body: str, lines: list[str], dice: random.Random) -> str:
    """An article's inner HTML between other parts of a page; its own text stands between CONTENT and END.

    lines: texts for those other parts.
    """
    pick, line = dice.choice, lambda: html.escape(dice.choice(lines), quote=False)
    links = lambda n: "".join(f'<li><a href="/{i}">{line()[:20]}</a></li>' for i in range(n))
    prose = lambda n: "".join(f"<p>{line()}</p>" for _ in range(n))
    sometimes = lambda f, chance=0.5: f() if dice.random() < chance else ""
    box = lambda names, inner, tag="div": f'<{tag} {pick(["class", "id", "class"])}="{pick(names)}">{inner}</{tag}>'

    def menu() -> str:
        return pick([lambda: f"<nav><ul>{links(dice.randint(2, 8))}</ul></nav>", lambda: box(["menu", "main-nav", "navbar", "navigation", "breadcrumbs", "top-menu"], f"<ul>{links(dice.randint(2, 8))}</ul>"), lambda: f'<ul class="{pick(["nav", "menu", "pagination"])}">{links(4)}</ul>'])()

    def header() -> str:
        inner = f"{sometimes(lambda: f'<h1>{line()[:30]}</h1>')}{sometimes(lambda: f'<p>{line()[:60]}</p>')}{sometimes(menu)}<span>{line()[:20]}</span>"
        return pick([lambda: f"<header>{inner}</header>", lambda: box(["header", "site-header", "masthead", "page-header", "branding"], inner)])()

    def footer() -> str:
        inner = f"&copy; {line()[:30]} &middot; {line()}{sometimes(lambda: f'<ul>{links(3)}</ul>')}{sometimes(lambda: prose(1))}"
        return pick([lambda: f"<footer>{inner}</footer>", lambda: box(["footer", "site-footer", "copyright", "page-footer"], inner), lambda: f"<footer><p>{inner}</p></footer>"])()

    def side() -> str:
        inner = sometimes(lambda: f"<h3>{line()[:20]}</h3>") + pick([lambda: prose(dice.randint(1, 3)), lambda: f"<ul>{links(4)}</ul>", lambda: line()])()
        return pick([lambda: f"<aside>{inner}</aside>", lambda: box(["sidebar", "widget", "related", "right-rail", "related-posts", "teaser"], inner), lambda: box(["sidebar"], inner, "section")])()

    def notice() -> str:
        inner = pick([f"<p>{line()}</p>", line()]) + sometimes(lambda: f"<button>{line()[:10]}</button>")
        return pick([lambda: box(["cookie-notice", "cookie-banner", "notice", "consent", "popup", "alert", "gdpr", "notification"], inner), lambda: f'<div role="{pick(["alert", "dialog"])}">{inner}</div>', lambda: f"<dialog open>{inner}</dialog>", lambda: box(["notice", "warning"], inner, "p") if "<" not in inner else box(["notice"], inner)])()

    def advert() -> str:
        inner = pick([line(), f"<p>{line()}</p>", f'<a href="/x">{line()}</a>'])
        return pick([lambda: box(["ad", "ads", "advert", "ad-slot", "advertisement", "sponsored", "promo"], inner), lambda: f'<ins class="adsbygoogle">{inner}</ins>', lambda: box(["ad", "promo"], inner, "section"), lambda: box(["ad"], inner, "aside")])()

    def form() -> str:
        inner = f"{sometimes(lambda: f'<p>{line()}</p>')}<label>{line()[:20]}</label><input name=q><button>{line()[:12]}</button>"
        return pick([lambda: f"<form action=/s>{inner}</form>", lambda: box(["newsletter", "subscribe", "search-form", "login"], f"<form>{inner}</form>"), lambda: box(["newsletter", "subscribe"], inner)])()

    def comments() -> str:
        tag = pick(["div", "article", "li", "section"])
        each = "".join(f'<{tag} class="{pick(["comment", "comment-body", "reply"])}">{sometimes(lambda: f"<b>{line()[:12]}</b>")}{prose(dice.randint(1, 2))}</{tag}>' for _ in range(dice.randint(1, 5)))
        return pick([lambda: f'<section id="comments"><h2>{line()[:20]}</h2>{each}</section>', lambda: box(["comments", "comment-list", "discussion", "responses"], each), lambda: f'<ol class="commentlist">{each}</ol>'])()

    def share() -> str:
        return pick([lambda: box(["share", "social", "share-buttons", "tags"], f"<ul>{links(3)}</ul>"), lambda: box(["byline", "author-bio"], line(), "p")])()

    def rich() -> str:
        more = [lambda: f"<h2>{line()[:40]}</h2>", lambda: f"<ul><li>{line()}</li><li>{line()}</li></ul>", lambda: f"<blockquote><p>{line()}</p></blockquote>", lambda: f'<p>{line()} <a href="/y">{line()[:15]}</a> <em>{line()[:15]}</em></p>', lambda: f"<table><tr><td>{line()[:20]}</td><td>{line()[:20]}</td></tr></table>", lambda: f"<ol><li>{line()}<li>{line()}</ol>", lambda: f"<pre>{line()}</pre>", lambda: f"<figure><img src=x><figcaption>{line()}</figcaption></figure>", lambda: f"<div><p>{line()}</p></div>", lambda: f"<p>{line()[:12]}</p>"]
        return "".join(pick(more)() for _ in range(dice.randint(0, 4)))

    extras = lambda chance: "".join(sometimes(f, chance) for f in dice.sample([advert, share, form, notice, side], 5))
    inner = CONTENT + (body if dice.random() < 0.7 else prose(dice.randint(1, 3))) + END + sometimes(advert, 0.3) + CONTENT + rich() + END + extras(0.12)
    opens = pick(["article", "article", "main", "div", "div", "div", "section", "none"])
    names = ["content", "main-content", "post", "entry-content", "article-body", "story", "post-content", "text", "article"]
    attributes = pick([f' class="{pick(names)}"', f' id="{pick(names)}"', "", ""]) if opens != "div" else pick([f' class="{pick(names)}"', f' id="{pick(names)}"', f' class="{pick(names)}"', ' role="main"', ""])
    main = inner if opens == "none" else f"<{opens}{attributes}>{inner}</{opens}>"
    main = f"<main>{main}{sometimes(comments, 0.2)}</main>" if opens != "main" and dice.random() < 0.2 else main
    main = f'<div class="{pick(["wrapper", "container", "row", "site", "page"])}">{main}</div>' if dice.random() < 0.3 else main
    before = "".join(sometimes(f) for f in dice.sample([menu, header, notice, advert, side, form], 6))
    after = "".join(sometimes(f) for f in dice.sample([comments, side, share, advert, form, notice, menu], 7)) + sometimes(footer, 0.8)
    return f"<html><head><title>{line()}</title></head><body>{before}{main}{after}</body></html>"


def relaid(pages: list[str], seed: int = 1) -> Iterator[tuple[Tree, np.ndarray]]:
    """(tree, labels) of pages with one article, as they are and laid out anew."""
    dice, bodies, lines, whole = random.Random(seed), [], [], []
    for page in pages:
        tree = parse(page)
        content = article_texts(tree)
        if content is None or not any(k >= 0 and content[k] for k, _, _ in tree.text):
            continue
        begin, end = page.find(">", page.lower().find("<article")) + 1, page.lower().rfind("</article")
        bodies.append(page[begin : end if end > begin else len(page)])
        lines += [s for k, _, text in tree.text if k >= 0 for s in [" ".join(text.split())[:300]] if s]
        whole.append((tree, labelled(tree, content)))
    yield from whole
    for body in bodies * LAYOUTS:
        yield marked(laid_out(body.replace(CONTENT, "").replace(END, ""), lines, dice))


def marked(page: str) -> tuple[Tree, np.ndarray]:
    """(tree, labels) of a page whose content stands between CONTENT and END."""
    tree, inside = parse(page.replace(CONTENT, f"<x>{CONTENT}</x>").replace(END, f"<x>{END}</x>")), False
    plain = parse(page.replace(CONTENT, "").replace(END, ""))
    content, at = np.zeros(len(plain.parent), bool), 0
    own = [k for k, _, _ in plain.text if k >= 0]
    for k, _, text in tree.text:
        if k < 0:
            continue
        if text in (CONTENT, END):
            inside = text == CONTENT
            continue
        content[own[at]] = inside
        at += 1
    return plain, labelled(plain, content)


def train(pages: DataFrame, source: str = "html", sample: int = SAMPLE, seed: int = 1) -> Potentials:
    """Potentials from at most `sample` pages of at most SAMPLE_BYTES that have one `article` element, those with the smallest hashes, each as it is and laid out anew.

    Without any such page no text is content.
    """
    page = F.col(source)
    usable = pages.where((F.octet_length(page) <= SAMPLE_BYTES) & F.lower(page).contains("<article")).select(page.alias("page"), F.xxhash64(page).alias("_h"))
    # hashes first, so that tasks send no pages but those that are picked; copies of a page count once
    picked = usable.select("_h").distinct().orderBy("_h").limit(sample)
    rows = usable.join(F.broadcast(picked), "_h").groupBy("_h").agg(F.min("page").alias("page")).orderBy("_h").collect()
    known = [*relaid([r["page"] for r in rows], seed)]
    if not known:
        return Potentials(np.full(BEGINS[-1], -1.0), np.zeros((len(GROUPS), 2, 2)))
    return fit(forest([t for t, _ in known]), np.concatenate([y for _, y in known]))


def joined(tree: Tree, content: np.ndarray) -> str:
    """Texts of content nodes: white space within a block as one space, blocks in lines."""
    out, last, held = [], -1, []
    for node, block, text in [*tree.text, (-1, -2, "")]:
        if block != last:
            line = " ".join("".join(held).split())
            if line:
                out.append(line)
            last, held = block, []
        if node < 0 or content[node]:
            held.append(text)
    return "\n".join(out)


def texts(pages: list[str | None], potentials: Potentials) -> list[str]:
    """The main text of each page."""
    if not pages:
        return []
    trees = [parse(p) for p in pages]
    content = marginals(forest(trees), potentials)[0] > 0.5
    at = np.cumsum([0, *(len(t.parent) for t in trees)])
    return [joined(t, content[a:b]) for t, a, b in zip(trees, at[:-1], at[1:], strict=True)]


def extract(pages: DataFrame, potentials: Potentials, source: str = "html", name: str = "text") -> DataFrame:
    """pages with `text`: the main text, of which nothing is dropped; a column of that name is replaced.

    Null and empty pages, and pages without content, have an empty text.  Markup that isn't
    closed is read as far as it goes.  Other columns, null and repeated keys are carried
    along.  An empty table gives an empty result.
    """
    keep = [c for c in pages.columns if c != name]
    rows = pages.select(F.struct(*keep).alias("_row"), F.col(source).alias("_page"))
    schema = rows.select("_row").schema.add("_text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in spread(batch["_page"], STEP_BYTES):
                part = batch.slice(a, b - a)
                yield pa.record_batch({"_row": part["_row"], "_text": pa.array(texts(part["_page"].to_pylist(), potentials), pa.string())})

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], F.col("_text").alias(name))
