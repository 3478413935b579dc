"""Main text of web pages: boosted trees over DOM-node features with hierarchical decoding."""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import slices

#: A tag, read in one pass: quotes count after an equals sign alone, as one that never closes does not.
TAG_TEXT = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)>""")
#: The same without quotes, for pages in which a tag does not end.
BARE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PART = re.compile(r"[A-ZÀ-Þ]?[a-zß-ÿ]+|[A-ZÀ-Þ]+")

# HTML elements by their role in the tree.
#: Their content is no text of the page; one that never closes is passed over, but for ENDLESS, which take the rest.
RAW = frozenset(("script", "style", "noscript", "template", "iframe", "object", "svg", "title", "textarea", "select", "canvas", "audio", "video", "head"))
ENDLESS = frozenset(("script", "style"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr path rect circle line polygon polyline ellipse use stop".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo mrow ms mtext msup msub msubsup mfrac msqrt mroot mover munder mstyle semantics annotation".split())
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table menu html body article section div".split())
TAGS = ("#", "p", "h1 h2 h3 h4 h5 h6", "article main", "section", "div", "nav menu", "header", "footer", "aside", "form fieldset button", "ul ol dl", "li dt dd", "table tbody tr td th", "blockquote pre figure figcaption", "body html")
TAG = {name: i for i, group in enumerate(TAGS) for name in group.split()}
#: Hashes of attribute tokens; a token's weight is learned.
TOKENS = 1 << 14
#: Bits of the tags of ancestors.
TAG_BIT = {i: 1 << i for i in range(len(TAGS))}
MARKS = re.compile(r"[.!?,;:]")


@dataclass
class Nodes:
    """Nodes of pages in document order: elements, and a leaf for each block of text. A subtree is a range."""

    tag: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    names: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)
    before: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    memo: dict[str, int] = field(default_factory=dict)
    tokens: list[tuple[int, ...]] = field(default_factory=lambda: [()])

    def _named(self, attributes: str) -> int:
        """The number of the node's set of hashed class, id and role tokens in ``tokens``."""
        value = " ".join([m[1] or m[2] or m[3] or "" for m in NAMES.finditer(attributes)])
        at = self.memo.get(value)
        if at is None:
            own = tuple(sorted({crc32(w.lower().encode()) % TOKENS for w in PART.findall(value)}))
            at = self.memo[value] = len(self.tokens) if own else 0
            if own:
                self.tokens.append(own)
        return at

    def _add(self, tag: str, parent: int, names: int, chars: int = 0, linked: int = 0, marks: int = 0, text: str | None = None) -> int:
        i, kind = len(self.tag), TAG.get(tag, len(TAGS))
        self.tag.append(kind)
        self.parent.append(parent)
        self.end.append(i + 1)
        self.names.append(names)
        self.last.append(-1)
        self.chars.append(chars)
        self.linked.append(linked)
        self.marks.append(marks)
        self.text.append(text)
        if parent < 0:
            self.depth.append(0)
            self.above.append(0)
            self.before.append(-1)
            self.rank.append(0)
        else:
            self.depth.append(self.depth[parent] + 1)
            self.above.append(self.above[parent] | TAG_BIT.get(self.tag[parent], 0))
            old = self.last[parent]
            self.before.append(old)
            self.rank.append(self.rank[old] + 1 if old >= 0 else 0)
            self.last[parent] = i
        return i

    def page(self, html: str) -> None:
        """Adds a page. Markup that doesn't end is text, as are unknown references; end tags without a start are passed over."""
        root = self._add("html", -1, 0)
        self.roots.append(root)
        open_: list[tuple[str, int]] = [("html", root)]
        run: list[str] = []
        linked, links, at, size = 0, 0, 0, len(html)

        def flush():
            nonlocal linked
            if run:
                text = " ".join("".join(run).split())
                if text:
                    self._add("#", open_[-1][1], 0, len(text), min(linked, len(text)), len(MARKS.findall(text)), text)
                run.clear()
            linked = 0

        def close(depth: int) -> None:
            here = len(self.tag)
            for _, i in open_[depth:]:
                self.end[i] = here
            del open_[depth:]

        tag, closed = TAG_TEXT, {}  # closed: ends that are searched in vain
        last = html.rfind(">")

        def skipped(mark: str, start: int) -> int:
            """The place after ``mark``, or -1; a search in vain is not repeated."""
            if mark in closed:
                return -1
            found = html.find(mark, start)
            if found < 0:
                closed[mark] = True
                return -1
            return found + len(mark)

        def write(chunk: str) -> None:
            nonlocal linked
            if "&" in chunk:
                chunk = unescape(chunk)
            run.append(chunk)
            if links:
                linked += len(chunk.strip())

        while at < size:
            stop = html.find("<", at)
            if stop < 0 or stop > last:
                write(html[at:])
                break
            if stop > at:
                write(html[at:stop])
            second = html[stop + 1]
            if second in "!?":
                at = -1
                if html.startswith("!--", stop + 1):
                    at = skipped("-->", stop + 4)
                elif html.startswith("![CDATA[", stop + 1):
                    at = skipped("]]>", stop + 9)
                at = html.find(">", stop) + 1 if at < 0 else at
                continue
            m = tag.match(html, stop)
            if not m and tag is TAG_TEXT and (second == "/" or second.isalpha()):
                tag = BARE_TAG
                m = tag.match(html, stop)
            if not m:
                write("<")
                at = stop + 1
                continue
            at = m.end()
            name = m[2].lower()
            if m[1]:
                if name in INLINE:
                    links -= name == "a" and links > 0
                    continue
                flush()
                for d in range(len(open_) - 1, 0, -1):
                    if open_[d][0] == name:
                        close(d)
                        break
                continue
            if name in INLINE:
                if name == "a":
                    links += 1
                elif name == "br":
                    run.append(" ")
                continue
            flush()
            if name in RAW:
                if not m[3].rstrip().endswith("/") and name not in closed:
                    out = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(html, at)
                    if out:
                        at = html.find(">", out.start()) + 1 or size
                    elif name in ENDLESS:
                        at = size
                    else:
                        closed[name] = True
                continue
            if name in ("html", "body") and any(n == name for n, _ in open_):
                self.names[root] |= self._named(m[3])
                continue
            if name in ENDS_P:
                for d in range(len(open_) - 1, 0, -1):
                    if open_[d][0] == "p":
                        close(d)
                        break
                    if open_[d][0] in SCOPE:
                        break
            for d in range(len(open_) - 1, 0, -1):
                if open_[d][0] in SAME.get(name, ()):
                    close(d)
                    break
                if open_[d][0] in SCOPE:
                    break
            links = 0 if name != "li" else links
            i = self._add(name, open_[-1][1], self._named(m[3]) if m[3] else 0)
            if name not in VOID:
                open_.append((name, i))
        flush()
        close(0)

    def named(self, weights: np.ndarray) -> np.ndarray:
        """Sum, least and greatest weight of the tokens of each node, and of those above it."""
        each = np.zeros((len(self.tokens), 3))
        for i, own in enumerate(self.tokens):
            if own:
                w = weights[list(own)]
                each[i] = w.sum(), min(w.min(), 0), max(w.max(), 0)
        own = each[self.names]
        above, depth, parent = np.zeros_like(own), np.array(self.depth), np.array(self.parent)
        order = np.argsort(depth, kind="stable")
        for level in np.split(order, np.nonzero(np.diff(depth[order]))[0] + 1)[1:]:
            p = parent[level]
            above[level, 0] = above[p, 0] + own[p, 0]
            above[level, 1] = np.minimum(above[p, 1], own[p, 1])
            above[level, 2] = np.maximum(above[p, 2], own[p, 2])
        return np.concatenate([own, above], axis=1)

    def matrix(self, weights: np.ndarray) -> np.ndarray:
        """Features of all nodes; weights: of the attribute tokens."""
        a = lambda x, kind=np.float64: np.array(x, dtype=kind)
        tag, parent, end, n = a(self.tag, int), a(self.parent, int), a(self.end, int), len(self.tag)
        up = np.where(parent < 0, np.arange(n), parent)
        root = a(self.roots, int)
        page = np.repeat(root, np.diff(np.append(root, n)))
        here = np.arange(n)
        chars, linked, marks = a(self.chars), a(self.linked), a(self.marks)
        leaf, element = (tag == 0).astype(float), (tag != 0).astype(float)
        para = ((tag == TAG["p"]) & (here < n)).astype(float)
        head = (tag == TAG["h1"]).astype(float)
        sums = {}
        for name, x in (("head", head), ("chars", chars), ("linked", linked), ("marks", marks), ("leaf", leaf), ("element", element), ("para", para), ("long", (chars > 80).astype(float))):
            total = np.append(0, np.cumsum(x))
            sums[name] = total[end] - total[here]
            sums["to " + name] = total[here] - total[page]
        size = np.maximum(sums["chars"], 1)
        whole = np.maximum(sums["chars"][page], 1)
        density, links, stops = np.log1p(sums["chars"] / (sums["element"] + 1)), sums["linked"] / size, sums["marks"] / size
        before = a(self.before, int)
        after = np.full(n, -1)
        after[before[before >= 0]] = here[before >= 0]
        count = a(self.rank) + 1
        last = a(self.last, int)
        siblings = np.where(last[up] >= 0, count[np.maximum(last[up], 0)], 1)
        most = np.zeros(n)
        np.maximum.at(most, up, np.where(parent < 0, 0, sums["chars"]))
        near = lambda x, at, none: np.where(at >= 0, x[np.maximum(at, 0)], none)
        above = a(self.above, np.int64)
        columns = [
            np.log1p(sums["chars"]), density, links, stops, sums["long"], sums["leaf"], sums["para"], sums["chars"] / np.maximum(sums["leaf"], 1),
            sums["chars"] / whole, sums["to chars"] / whole, a(self.depth), count / siblings, siblings, sums["chars"] / size[up], links[up], density[up],
            near(links, before, -1), near(links, after, -1), near(np.log1p(sums["chars"]), before, -1), near(np.log1p(sums["chars"]), after, -1),
            near(tag.astype(float), before, -1), near(tag.astype(float), after, -1), near(sums["marks"], before, 0), near(sums["marks"], after, 0),
            sums["head"], sums["to head"], sums["to long"], sums["element"], sums["chars"] / np.maximum(most[up], 1), most / size, near(sums["chars"], before, 0) / np.maximum(most[up], 1),
        ]
        columns += [(tag == i).astype(float) for i in range(len(TAGS))]
        columns += [(above >> i & 1).astype(float) for i in range(len(TAGS))]
        columns += list(self.named(weights).T)
        return np.stack(columns, axis=1).astype(np.float32)


@dataclass
class Boosted:
    """Gradient-boosted trees for log odds; each tree is a full one of ``DEPTH`` levels over feature thresholds."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves
    start: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        row = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[row, f[at]] > c[at])
            out += v[at - len(f)]
        return out


DEPTH, TREES, BINS, RATE, RIDGE = 5, 40, 32, 0.25, 2.0
#: Share of its parent's odds that a node gets.
PULL = 0.09


def boost(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Newton boosting of the logistic loss on binned features."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    start = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score, features, thresholds, values = np.full(len(y), start), [], [], []
    inner, width = 2**DEPTH - 1, BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        f, c, at = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            first, nodes = 2**level - 1, 2**level
            best = np.zeros(nodes)
            for j in range(x.shape[1]):
                key = (at - first) * width + binned[:, j]
                gl = np.cumsum(np.bincount(key, weights=g, minlength=nodes * width).reshape(nodes, width), axis=1)
                hl = np.cumsum(np.bincount(key, weights=h, minlength=nodes * width).reshape(nodes, width), axis=1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[:, len(cuts[j]) :] = 0
                k = gain.argmax(axis=1)
                better = np.nonzero(gain[np.arange(nodes), k] > best + 1e-6)[0]
                best[better] = gain[better, k[better]]
                f[first + better], c[first + better] = j, cuts[j][k[better]] if len(cuts[j]) else np.inf
            at = 2 * at + 1 + (x[np.arange(len(y)), f[at]] > c[at])
        leaf = at - inner
        v = -RATE * np.bincount(leaf, weights=g, minlength=inner + 1) / (np.bincount(leaf, weights=h, minlength=inner + 1) + RIDGE)
        score += v[leaf]
        features.append(f)
        thresholds.append(c.astype(np.float32))
        values.append(v)
    return Boosted(np.array(features), np.array(thresholds), np.array(values), start)


OWN = "\ue000"  # stands in the article's text of pages to learn from
#: Names that pages to learn from give their parts, in four languages; the model knows them as hashed tokens alone.
PARTS = {
    "main": (("article", "content", "post", "entry", "story", "body", "text", "prose"), ("inhalt", "artikel", "beitrag", "haupttext"), ("contenu", "texte", "billet"), ("contenido", "articulo", "cuerpo")),
    "menu": (("nav", "navbar", "menu", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "tabs"), ("navigation", "hauptmenue", "pfad"), ("menu", "fil"), ("navegacion", "migas")),
    "top": (("header", "masthead", "topbar", "head", "logo", "brand"), ("kopfzeile", "kopf"), ("entete", "bandeau"), ("cabecera", "encabezado")),
    "foot": (("footer", "foot", "copyright", "colophon", "bottom", "legal"), ("fusszeile", "impressum"), ("pied", "mentions"), ("pie", "aviso")),
    "side": (("sidebar", "side", "aside", "widget", "rail", "related", "recommended", "popular", "trending"), ("seitenleiste", "rand", "verwandt"), ("colonne", "lateral"), ("lateral", "relacionados")),
    "note": (("notice", "cookie", "cookies", "consent", "alert", "popup", "modal", "gdpr", "warning", "overlay", "message"), ("hinweis", "meldung", "datenschutz"), ("avis", "alerte"), ("aviso", "alerta")),
    "ad": (("ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner"), ("werbung", "anzeige"), ("pub", "publicite"), ("publicidad", "anuncio")),
    "form": (("form", "search", "login", "subscribe", "newsletter", "signup", "contact"), ("suche", "formular", "anmeldung"), ("recherche", "formulaire"), ("buscar", "formulario")),
    "talk": (("comment", "comments", "discussion", "reply", "replies", "respond", "responses", "thread"), ("kommentare", "kommentar", "antworten"), ("commentaires", "reponses"), ("comentarios", "respuestas")),
    "share": (("share", "social", "follow", "tags", "meta", "byline"), ("teilen", "schlagworte"), ("partager", "motscles"), ("compartir", "etiquetas")),
}
#: Chances that a page names its parts in each of the languages, at random, or not at all.
NAMING = (0.28, 0.08, 0.07, 0.07, 0.2, 0.3)
SEMANTIC = re.compile(r"(</?)(?:nav|header|footer|aside|article|main|section)\b")


def _sample_page(r: random.Random) -> str:
    """A page of a random layout whose article's blocks start with OWN."""
    naming = r.choices(range(6), NAMING)[0]
    page = _layout(r, naming)
    return SEMANTIC.sub(r"\1div", page) if r.random() < (0.35 if naming < 4 else 0.6) else page


def _layout(r: random.Random, naming: int) -> str:
    syllables = "ba co di fu ge ha ki lo mu ne pa ri so tu ve wi za tion er an th st".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    sentence = lambda: words(3, 18).capitalize() + r.choice([".", ".", ".", ",", "!", "?"])
    prose = lambda a=1, b=6: " ".join(sentence() for _ in range(r.randint(a, b)))
    links = lambda a, b, wrap="li": "".join(f'<{wrap}><a href="/{word()}">{words(1, 3)}</a></{wrap}>' for _ in range(r.randint(a, b)))
    noise = lambda: r.choice(["", "", f' class="{word()}"', f' id="{word()}{r.randint(1, 99)}"', f' class="{word()} {word()}"'])
    chance = {part: word() + r.choice(["", str(r.randint(1, 9))]) for part in PARTS}

    def named(part: str) -> str:
        if naming == 5:
            return ""
        own = chance[part] if naming == 4 else r.choice(PARTS[part][naming])
        return f' {r.choice(["class", "class", "id"])}="{own}{r.choice(["", "-" + word(), " " + word()]) if naming < 4 else ""}"'

    odd = lambda: "".join(r.choice(["%%%", "***", "$$$", "!!", " | "]) + word() for _ in range(r.randint(3, 30)))

    def own() -> str:
        kind = r.random()
        text = OWN + (prose(1, 8) if kind < 0.72 else words(1, 6) if kind < 0.84 else odd() if kind < 0.92 else f"{word()} <b>{words(1, 3)}</b>, <a href='/{word()}'>{words(1, 2)}</a> {prose(1, 3)}")
        tag = r.choices(["p", "h2", "li", "blockquote", "pre", "div", "td"], [20, 2, 2, 1, 1, 1, 0.6])[0]
        if tag == "li":
            return "<ul>" + "".join(f"<li>{OWN}{words(2, 12)}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
        if tag == "td":
            return "<table>" + "".join(f"<tr><td>{OWN}{words(1, 4)}</td><td>{OWN}{words(1, 4)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
        if tag == "p" and r.random() < 0.25:
            return f"<p><b>{text}<br>"
        return f"<{tag}>{text}</{tag}>" if r.random() < 0.9 else f"<{tag}>{text}"

    def note(group: str, tag: str) -> str:
        body = r.choice([sentence(), prose(1, 2), f"<p>{sentence()}</p>", f'<span>{words(1, 5)}</span> <a href="#">{words(1, 2)}</a>', f"<h3>{words(1, 3)}</h3><p>{prose(1, 2)}</p>"])
        return f"<{tag}{named(group)}>{body}</{tag}>"

    def talk() -> str:
        each = "".join(f"<{(t := r.choice(['div', 'li', 'article', 'p']))}{named('talk') if r.random() < 0.7 else noise()}><b>{word()}</b> {prose(1, 3)}</{t}>" for _ in range(r.randint(1, 6)))
        return f"<{(t := r.choice(['section', 'div', 'aside', 'ol']))}{named('talk')}><h3>{words(1, 2)}</h3>{each}</{t}>"

    menu = lambda: r.choice([f"<nav{noise()}><ul>{links(2, 9)}</ul></nav>", f"<div{named('menu')}><ul>{links(2, 9)}</ul></div>", f"<div{named('menu')}>{links(2, 9, 'span')}</div>", f"<ul{named('menu')}>{links(2, 9)}</ul>"])
    ad = lambda: note('ad', r.choice(["div", "div", "aside", "section"]))
    side = lambda: r.choice([f"<aside{noise()}><h3>{words(1, 3)}</h3><ul>{links(2, 6)}</ul></aside>", f"<div{named('side')}><h4>{words(1, 3)}</h4>{links(2, 5, 'p')}</div>", f"<aside{named('side')}><p>{prose(1, 2)}</p></aside>", note('side', "div")])
    form = lambda: r.choice([f"<form{noise()}><label>{words(1, 3)}</label><input name=q><button>{word()}</button></form>", f"<form{named('form')}><p>{sentence()}</p><input><button>{words(1, 2)}</button></form>", note('form', "div")])
    top = lambda: r.choice([f"<header{noise()}><h1>{words(1, 3)}</h1><p>{sentence()}</p></header>", f"<div{named('top')}><a href='/'>{words(1, 2)}</a> {sentence()}</div>", f"<header><a href='/'>{words(1, 3)}</a>{menu()}</header>"])
    foot = lambda: r.choice([f"<footer{noise()}>&copy; {word()}.example.com &middot; {sentence()}</footer>", f"<div{named('foot')}><p>&copy; {r.randint(1990, 2030)} {words(1, 4)}</p>{links(0, 4, 'span')}</div>", f"<footer><ul>{links(1, 6)}</ul><p>{prose(1, 2)}</p></footer>"])
    share = lambda: f"<div{named('share')}>{links(1, 4, 'span')}</div>"

    blocks = [own() for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14, 25]))]
    title = f"<h1>{OWN}{words(1, 12)}</h1>" if r.random() < 0.85 else ""
    inside = [f() for f in (ad, form, share, side, lambda: note('note', "div")) if r.random() < 0.12]
    for piece in inside:
        blocks.insert(r.randint(0, len(blocks)), piece)
    main = title + "".join(blocks)
    main = r.choices([f"<article{noise()}>{main}</article>", f"<article>{main}</article>", f"<main{noise()}>{main}</main>", f"<main><article>{main}</article></main>", f"<div{named('main')}>{main}</div>", f"<section{noise()}>{main}</section>", f"<div{noise()}>{main}</div>"], [4, 4, 2, 2, 3, 1, 1])[0]
    before = [f() for f, p in ((lambda: note('note', "div"), 0.3), (top, 0.5), (menu, 0.8), (ad, 0.5), (form, 0.2), (side, 0.2)) if r.random() < p]
    after = [f() for f, p in ((share, 0.2), (talk, 0.4), (side, 0.4), (ad, 0.3), (form, 0.25), (menu, 0.15), (lambda: note('note', "div"), 0.2), (foot, 0.85)) if r.random() < p]
    body = "".join(before) + main + "".join(after)
    if r.random() < 0.2:
        body = f"<div{noise()}>{body}</div>"
    tail = "</body></html>" if r.random() < 0.9 else ""
    return f"<!DOCTYPE html><html><head><title>{words(1, 6)}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head><body>{body}{tail}"


#: Pages of the generator that the token weights, and the trees, are fitted on.
PAGES = 800


@dataclass
class Model:
    weights: np.ndarray  # of hashed attribute tokens
    trees: Boosted

    def __call__(self, nodes: Nodes) -> np.ndarray:
        """Log odds of each node, drawn a little towards those of the nodes above it; text that is all of its element
        has the element's, whose siblings tell more."""
        odds = self.trees(nodes.matrix(self.weights))
        tag, parent, end, depth = np.array(nodes.tag), np.array(nodes.parent), np.array(nodes.end), np.array(nodes.depth)
        order = np.argsort(depth, kind="stable")
        for level in np.split(order, np.nonzero(np.diff(depth[order]))[0] + 1)[1:]:
            odds[level] += PULL * np.clip(odds[parent[level]], -9, 9)
        only = np.nonzero((tag == 0) & (parent >= 0))[0]
        only = only[(parent[only] == only - 1) & (end[parent[only]] == only + 1)]
        odds[only] = odds[parent[only]]
        return odds


def _labelled(r: random.Random, pages: int) -> tuple[Nodes, np.ndarray]:
    nodes = Nodes()
    for _ in range(pages):
        nodes.page(_sample_page(r))
    own = np.array([t is not None and OWN in t for t in nodes.text], dtype=float)
    total = np.append(0, np.cumsum(own))
    return nodes, (total[np.array(nodes.end)] - total[np.arange(len(own))] > 0).astype(float)


@lru_cache(maxsize=2)
def trained(pages: int = PAGES, seed: int = 7) -> Model:
    """The model, fitted on generated pages: no page of the data has labels.

    A token's weight is the logarithm of how often nodes that have it are kept, against how often they are left out;
    the trees are fitted on other pages than the weights, so they learn how far to trust them.
    """
    r = random.Random(seed)
    nodes, label = _labelled(r, pages)
    kept, left = np.ones(TOKENS), np.ones(TOKENS)
    for name, y in zip(nodes.names, label):
        for t in nodes.tokens[name]:
            (kept if y else left)[t] += 1
    weights = np.where(kept + left > 5, np.log(kept / left), 0.0)
    nodes, label = _labelled(r, pages)
    return Model(weights, boost(nodes.matrix(weights), label))


def decode(nodes: Nodes, odds: np.ndarray) -> list[bool]:
    """The labels of greatest total log odds in which no node outside the main text has one inside below it."""
    gain, parent = odds.tolist(), nodes.parent
    for i in range(len(gain) - 1, -1, -1):
        p = parent[i]
        if p >= 0 and gain[i] > 0:
            gain[p] += gain[i]
    keep: list[bool] = []
    for i, g in enumerate(gain):
        p = parent[i]
        keep.append(g > 0 and (p < 0 or keep[p]))
    return keep


def main_texts(pages: list[str], model: Model) -> list[str]:
    nodes = Nodes()
    for html in pages:
        nodes.page(html)
    if not pages:
        return []
    keep = decode(nodes, model(nodes))
    out = []
    for a, b in zip(nodes.roots, [*nodes.roots[1:], len(keep)]):
        out.append("\n\n".join(t for t, k in zip(nodes.text[a:b], keep[a:b]) if k and t))
    return out


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row: the article's blocks, two newlines between them.

    Character references are decoded and white space within a block is one space. A
    null or empty page has an empty text; repeated rows and rows without an id give a row each; an
    empty table gives none; other columns are not read.
    """
    model = trained()

    def run(batches):
        for batch in batches:
            texts = [t for _, raws in slices(batch, "html") for t in main_texts([r.decode("utf-8", "replace") for r in raws], model)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
