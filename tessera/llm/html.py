"""Main text of HTML pages: a linear-chain conditional random field over DOM leaf blocks, decoded by Viterbi.

A page is read once into leaf blocks, runs of text between the bounds of block elements; each knows its open
elements by what their tags, classes, ids and roles say, and the nearest that says anything apart. The field has a weight for each feature of a block and for
each pair of neighbouring verdicts (main text or not). It is trained here on labelled pages that `labelled_page`
composes at random from the parts that pages are made of, by gradient ascent on the exact log-likelihood.

Defined results: null or empty html, and a page without main text, give an empty text; repeated rows give the same;
unclosed elements, comments and scripts end with the page; blocks of white space alone are none.
"""

from __future__ import annotations

import html as _html
import random
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import made, pick, ship, small_batches, table

#: Pages that the field is trained on, and its gradient steps.
TRAINING_PAGES, STEPS = 400, 240

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|iframe|svg|math|title|textarea|object)\b|<(/?)([a-zA-Z][^\s/<>]*)|<[!?]", re.S | re.I)
# The attributes of a tag, to its end or to what keeps it from being one. A quote opens a value only after an equals
# sign; one that is never closed is passed over, of which there is at most one of a kind on a page.
_REST = re.compile(r"((?:[^<>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[\"'=])*+)(>?)")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in "script style template noscript iframe svg math title textarea object".split()}
_VALUE = r"=\s*(?:\"[^\"]*\"|'[^']*')"
_NAMES = re.compile(rf"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|{_VALUE}", re.I)
_OTHER = re.compile(rf"((?<![\w-])(?:class|style|aria-hidden)\s*{_VALUE})|{_VALUE}", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
# Fixed values of the HTML standard: elements without end tag, and elements inside a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
LIKE_P = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6"))
ENDS_OWN = {"li": ("ul", "ol", "menu"), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}
#: What the parts of class names, ids and roles say, as whole words. In one name, text gives way to any other group.
GROUPS = {
    "menu": "nav navs navbar navigation menu menus menubar breadcrumb breadcrumbs navbox toc toolbar tabs pagination pager subnav topnav sidenav",
    "head": "header siteheader pageheader masthead banner logo topbar",
    "foot": "foot footer sitefooter pagefooter copyright legal colophon bottom imprint",
    "side": "sidebar sidebars aside widget widgets rail infobox complementary related recommend recommended recommendations popular trending",
    "ad": "ad ads advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos promotion adsbox adslot adbox adsense",
    "notice": "cookie cookies consent notice notices alert alerts gdpr popup popups modal overlay warning dialog",
    "talk": "comment comments commentlist disqus respond replies reply discussion discussions reader readers",
    "form": "form forms login search searchbox subscribe subscription newsletter newsletters signup signin register",
    "share": "share sharing social follow",
    "text": "article articles content contents post posts entry story stories main body text prose",
}
_GROUP_OF = {word: group for group, words in GROUPS.items() for word in words.split()}
#: A name with such a part tells of what an element lacks, or how a page is laid out.
_STATES = frozenset("no not non without with has have hide free is layout".split())
#: Names that begin so and end in a word of text, or are such a word, outweigh other names of their element.
_STRONG = frozenset("article post entry story prose".split())
#: Groups that a word of text may follow in the name of an article: an alert-article is an article, a sponsored-post none.
_BEFORE_TEXT = frozenset(("menu", "head", "foot", "notice", "text"))
#: What an element says that may stand around text, and what says that something isn't text.
_AROUND_TEXT = frozenset(("in article", "in main", "named text"))
_NO_TEXT = frozenset(("in nav", "in aside", "in form", "in header", "in footer", "in dialog", "in button", "in select", "in label", "in menu", "hidden", *(f"named {g}" for g in GROUPS if g != "text")))
_HEADS = frozenset(("in header", "in head", "named head"))
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def said_by(names: str) -> frozenset:
    """The groups that an element's names belong to."""
    out, strong = set(), False
    for name in names.split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        groups = {_GROUP_OF[p] for p in parts if p in _GROUP_OF}
        if not groups or not _STATES.isdisjoint(parts):
            continue
        strong |= groups == {"text"} and parts[0] in _STRONG or len(parts) > 1 and parts[-1] in _STRONG and groups <= _BEFORE_TEXT
        out |= groups - {"text"} or groups
    return frozenset({"text"} if strong else out)


_TAGS = frozenset("article main section nav header footer aside form figure table ul ol blockquote pre dialog button select label details fieldset menu head address".split())
_SAYS = (
    ("rights", re.compile(r"©|\(c\)|copyright|all rights|droits|derechos|rechte", re.I)),
    ("cookies", re.compile(r"cookie|privacy|consent|datenschutz", re.I)),
    ("sign", re.compile(r"subscribe|sign (?:up|in)|log ?in|newsletter|password|e-?mail", re.I)),
    ("sold", re.compile(r"advert|sponsor|promo|buy now|offer", re.I)),
)
#: Where a block says that it is inside the text, its place on the page says nothing.
_INSIDE = frozenset(("in article", "in main", "named text"))
_END = re.compile(r"[.!?…。:;][\"'»”)]?$")


def tags(page: str):
    """(start, end, tag, slash, attributes) of each tag; comments and elements whose content isn't text have no tag.

    No character is passed twice, whatever the lengths of values: what turns out not to be a tag is text up to there.
    """
    at = 0
    while m := _TOKEN.search(page, at):
        start, at = m.span()
        if page.startswith("<!--", start):
            yield start, at, "", "", ""
            continue
        rest = _REST.match(page, at) if m[1] or m[3] else None
        if m[3]:
            at = rest.end()
            if rest[2]:
                yield start, at, m[3].lower(), m[2], rest[1]
            continue
        at = rest.end() if rest and rest[2] else page.find(">", at) + 1
        if not at:
            return
        if m[1]:
            end = _RAW_END[m[1].lower()].search(page, at)
            at = end.end() if end else len(page)
        yield start, at, "", "", ""


def leaf_blocks(page: str | None):
    """(text, features) of each leaf block with text, in page order."""
    page = page or ""
    stack: list[tuple[str, frozenset, frozenset]] = [("", frozenset(), frozenset())]
    held: list[str] = []
    linked, in_link = 0, 0
    out = []

    def opened(tag: str, attributes: str) -> tuple[str, frozenset, frozenset]:
        """The element with what it and those around it say, and what the nearest that says anything does."""
        _, around, nearest = stack[-1]
        more = {f"in {tag}"} if tag in _TAGS else set()
        if "=" in attributes and tag not in ("html", "body"):
            names = " ".join(x for a, b, c in _NAMES.findall(attributes) if (x := a or b or c))
            more.update(f"named {g}" for g in (said_by(names) if names else ()))
        if not _AROUND_TEXT.isdisjoint(around) and not more.isdisjoint(_HEADS):
            # A header inside an article is the article's own: its title, not the page's banner.
            more = more - _HEADS | {"own header"}
        near = frozenset(f"nearest {x}" for x in more) or nearest
        if attributes and _HIDDEN.search(attributes) and _HIDDEN.search(_OTHER.sub(lambda m: m[1] or "=", attributes)):
            more.add("hidden")
        return tag, around | more, near

    def flush() -> None:
        nonlocal linked
        text = " ".join(_html.unescape("".join(held)).split())
        if text:
            around = stack[-1][1]
            plain = ["text alone"] if not _AROUND_TEXT.isdisjoint(around) and _NO_TEXT.isdisjoint(around) else []
            out.append((text, [*around, *stack[-1][2], *plain, *told(text, linked, stack[-1][0])]))
        held.clear()
        linked = 0

    def pop_to(tag: str, stop: tuple = ()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    at = 0
    for start, end, tag, closing, attributes in tags(page):
        if start > at:
            piece = page[at:start]
            held.append(piece)
            linked += len(piece) if in_link else 0
        at = end
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br":
                held.append(" ")
            elif tag == "a":
                in_link = 0 if closing else 1
            continue
        flush()
        in_link = 0
        if closing:
            pop_to(tag)
            continue
        if tag not in VOID:
            if any(s[0] in LIKE_P for s in stack[-3:]):
                for p in LIKE_P:
                    pop_to(p, ("article", "div", "section", "body", "li", "td", "blockquote"))
            if tag in ENDS_OWN:
                pop_to(tag, ENDS_OWN[tag])
            stack.append(opened(tag, attributes))
    if at < len(page):
        held.append(page[at:] if not page[at:].startswith("<") or " " in page[at : at + 2] else "")
    flush()
    return out


def told(text: str, linked: int, tag: str) -> list[str]:
    """What a block's own text says."""
    n, words = len(text), text.count(" ") + 1
    share = linked / max(1, n)
    out = [f"tag {tag}", f"size {0 if n < 25 else 1 if n < 80 else 2 if n < 200 else 3}", f"links {0 if share == 0 else 1 if share < 0.5 else 2}", f"words {min(3, words // 5)}"]
    if _END.search(text[-3:]):
        out.append("ends")
    out += [f"says {name}" for name, p in _SAYS if p.search(text)]
    return out


def placed(blocks: list) -> list[tuple[str, list[str]]]:
    """The blocks with features of their place on the page."""
    n = len(blocks)
    for i, (_, features) in enumerate(blocks):
        features.append("any")
        if n > 1 and not _INSIDE.intersection(features):
            features += ["first"] if i == 0 else ["last"] if i == n - 1 else []
    return blocks


class Field:
    """Weights of features, and of neighbouring verdicts. Two labels need one weight a feature."""

    def __init__(self, weights: dict[str, float], step: np.ndarray):
        self.weights, self.step = weights, step.tolist()

    def decode(self, blocks: list) -> list[bool]:
        """The best chain of verdicts."""
        w, ((oo, om), (mo, mm)) = self.weights, self.step
        o = m = 0.0
        back = []
        for i, (_, features) in enumerate(blocks):
            e = sum(w.get(f, 0.0) for f in features)
            if i == 0:
                o, m = 0.0, e
                continue
            from_o, from_m = (o + oo >= m + mo), (o + om >= m + mm)
            back.append((from_o, from_m))
            o, m = max(o + oo, m + mo), max(o + om, m + mm) + e
        if not blocks:
            return []
        at = m > o
        chain = [at]
        for from_o, from_m in reversed(back):
            at = not (from_m if at else from_o)
            chain.append(at)
        return chain[::-1]

    @classmethod
    def train(cls, pages: list[tuple[list, list[bool]]], steps: int = STEPS, rate: float = 0.2, keep: float = 1e-5) -> Field:
        names = sorted({f for blocks, _ in pages for _, features in blocks for f in features})
        index = {f: i for i, f in enumerate(names)}
        n, long = len(pages), max(len(b) for b, _ in pages)
        x, y, live = np.zeros((n, long, len(names))), np.zeros((n, long)), np.zeros((n, long), bool)
        for p, (blocks, truth) in enumerate(pages):
            for t, (_, features) in enumerate(blocks):
                x[p, t, [index[f] for f in features]] = 1
                y[p, t], live[p, t] = truth[t], True
        w, step = np.zeros(len(names)), np.zeros((2, 2))
        mean, square = np.zeros(len(names) + 4), np.zeros(len(names) + 4)
        pairs = live[:, 1:] & live[:, :-1]
        seen = np.stack([[((y[:, :-1] == a) & (y[:, 1:] == b) & pairs).sum() for b in (0, 1)] for a in (0, 1)])
        total = live.sum()
        for i in range(1, steps + 1):
            score = np.stack([np.zeros((n, long)), x @ w], axis=2)
            fore, rear = np.zeros((n, long, 2)), np.zeros((n, long, 2))
            fore[:, 0] = score[:, 0]
            for t in range(1, long):
                to = score[:, t] + np.logaddexp(fore[:, t - 1, :1] + step[0], fore[:, t - 1, 1:] + step[1])
                fore[:, t] = np.where(live[:, t, None], to, fore[:, t - 1])
            for t in range(long - 2, -1, -1):
                nxt = score[:, t + 1] + rear[:, t + 1]
                to = np.stack([np.logaddexp(step[a, 0] + nxt[:, 0], step[a, 1] + nxt[:, 1]) for a in (0, 1)], axis=1)
                rear[:, t] = np.where(live[:, t + 1, None], to, rear[:, t + 1] * 0)
            both = fore + rear
            z = np.logaddexp(both[:, 0, 0], both[:, 0, 1])
            p_main = np.where(live, np.exp(both[:, :, 1] - z[:, None]), 0)
            joint = np.exp(fore[:, :-1, :, None] + step + (score + rear)[:, 1:, None, :] - z[:, None, None, None]) * pairs[:, :, None, None]
            g = np.concatenate([np.einsum("pt,ptf->f", np.where(live, y, 0) - p_main, x) / total - keep * w, ((seen - joint.sum(axis=(0, 1))) / total - keep * step).ravel()])
            mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
            move = rate * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
            w, step = w + move[:-4], step + move[-4:].reshape(2, 2)
        return cls(dict(zip(names, w.tolist(), strict=True)), step)


def labelled_page(seed: int) -> tuple[str, list[str]]:
    """A page, and the blocks of its main text."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("an", "er", "on", "th", "re", "st", "la", "de", "ou", "ing", "ver", "é", "ß", "ción")) for _ in range(r.randint(1, 4)))
    sentence = lambda low, high: " ".join(word() for _ in range(r.randint(low, high))).capitalize() + r.choice(".....!?")
    prose = lambda: " ".join(sentence(2, 18) for _ in range(r.choice((1, 1, 2, 3, 4, 6))))
    some = lambda *x: r.choice(x)
    link = lambda: f'<a href="/{word()}">{" ".join(word() for _ in range(r.randint(1, 4)))}</a>'
    listed = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 9))) + "</ul>"
    main: list[str] = []

    def box(tags: tuple, names: tuple, inner: str) -> str:
        tag = r.choice(tags)
        name = r.choice(names) if tag in ("div", "section", "ul", "p") or r.random() < 0.4 else ""
        return f"<{tag}{f' {some("class", "id")}={chr(34)}{name}{chr(34)}' if name else ''}>{inner}</{tag}>"

    menu = lambda: box(("nav", "nav", "div"), ("menu", "nav", "main-nav", "navbar", "breadcrumbs", "top-menu"), listed())
    ad = lambda: box(("div", "div", "aside", "section"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad"), some(sentence(2, 9), f"<p>{prose()}</p>", f"<p>{link()}</p>", sentence(3, 7) + "\n" + sentence(1, 6)))
    side = lambda: box(("aside", "aside", "div"), ("sidebar", "widget", "related", "right-rail", "popular", "recommended"), some("", f"<h3>{sentence(1, 3)}</h3>") + some(listed(), f"<p>{prose()}</p>", f"<p>{sentence(3, 10)}</p>{listed()}"))
    notice = lambda: box(("div", "div", "dialog", "section"), ("cookie-notice", "notice", "alert", "consent", "gdpr-banner", "popup", "modal"), some(f"<p>{prose()}</p>", sentence(4, 14), f"<p>We use cookies. {sentence(3, 9)}</p><button>{word()}</button>"))
    form = lambda: f"<form{some('', ' class=newsletter', ' id="search"')}><label>{sentence(1, 4)}</label><input name=q>{some('', f'<p>{sentence(3, 12)}</p>')}<button>{word()}</button></form>"
    talk = lambda: box(("section", "div", "div"), ("comments", "comment-list", "reader-comments", "discussion", "replies", "disqus"), some("", f"<h2>{sentence(1, 2)}</h2>") + "".join(some(f'<div class="comment"><p>{prose()}</p></div>', f"<p>{prose()}</p>", f"<article class=comment><b>{word()}</b><p>{prose()}</p></article>") for _ in range(r.randint(1, 4))))
    head = lambda: box(("header", "header", "div"), ("header", "site-header", "masthead", "topbar"), some("", f"<h1>{sentence(1, 3)}</h1>", f"<p>{sentence(2, 6)}</p>", f"<div class=logo>{word()}</div>") + some("", menu(), listed()))
    foot = lambda: box(("footer", "footer", "footer", "div"), ("footer", "site-footer", "copyright", "legal"), some(f"&copy; {word()}.example &middot; {prose()}", f"<p>{sentence(3, 12)}</p>", f"<p>&copy; {sentence(1, 5)}</p>{listed()}", prose()))

    def article() -> str:
        parts = []
        if r.random() < 0.8:
            title = " ".join(word() for _ in range(r.randint(2, 9))).capitalize()
            main.append(title)
            parts.append(some(f"<h1>{title}</h1>", f"<h2>{title}</h2>", f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", f'<div class="{some("post", "entry", "article", "story")}-{some("header", "head")}"><h1>{title}</h1></div>') if r.random() < 0.6 else f"<h1>{title}</h1>")
        for _ in range(r.choice((0, 1, 2, 3, 5, 8, 12)) or (not main)):
            text, kind = prose() if r.random() < 0.8 else sentence(1, 5), r.random()
            main.append(text)
            end = some("</p>", "</p>", "</p>", "")
            if kind < 0.6:
                parts.append(f"<p>{text}{end}")
            elif kind < 0.68:
                parts.append(f"<p><b>{text}<br>")
            elif kind < 0.74:
                main[-1] = text = " ".join(word() for _ in range(r.randint(1, 5))).capitalize()
                parts.append(f"<h{(k := r.randint(2, 4))}>{text}</h{k}>")
            elif kind < 0.82:
                parts.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.9:
                items = [sentence(2, 9) if kind < 0.86 else " ".join(word() for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 4))]
                main[-1:] = items
                parts.append("<ul>" + "".join(f"<li>{x}</li>" if kind < 0.86 else f'<li><a href="/{word()}">{x}</a></li>' for x in items) + "</ul>")
            else:
                words = text.split(" ")
                words[0] = f'<a href="x">{words[0]}</a>'
                parts.append(f"<p>{' '.join(words)}{end}")
            if r.random() < 0.12:
                parts.append(some(ad, side, notice, form)())
        if r.random() < 0.1:
            parts.append(talk())
        inner = "".join(parts)
        if r.random() < 0.12:
            return some(inner, f"<div>{inner}</div>", f'<div class="{some("col-8", "page", "wrap", "container", word())}">{inner}</div>')
        if r.random() < 0.3:
            tag, noise = some("article", "article", "main", "div"), [f"post-{r.randint(1, 9999)}", *r.sample(("no-sidebar", "has-header", "page-with-nav", "content-sidebar", "ads-free", "commentary", "hentry", "has-thumbnail", "layout-wide", "without-comments", word()), r.randint(0, 3))]
            r.shuffle(noise)
            return f'<{tag} class="{some("article-body ", "post ", "entry-content ", "") if tag != "div" else some("post-content ", "article-body ")}{" ".join(noise)}">{inner}</{tag}>'
        return some(f"<article>{inner}</article>", f"<article>{inner}</article>", f"<main>{inner}</main>", f'<div class="{some("content", "post-body", "entry-content", "article-text", "story")}">{inner}</div>', f"<main><article>{inner}</article></main>", f'<section class="post">{inner}</section>')

    bare = r.random() < 0.12
    before = [] if bare else [f() for f in (head, menu, notice, ad, side, form) if r.random() < 0.45]
    r.shuffle(before)
    body = article()
    after = [] if bare else [f() for f in (talk, side, ad, form, notice, menu) if r.random() < 0.35]
    r.shuffle(after)
    if not bare and r.random() < 0.85:
        after.append(foot())
    start, end = some(("", ""), ("", ""), ('<div id="page" class="site">', "</div>"), ('<div class="wrapper">', "</div>"), ('<div class="container row">', "</div>"))
    names = some("", "", "", ' class="no-sidebar has-header"', ' class="page-with-nav home blog"', ' id="top" class="js ads sidebar"')
    page = f"<!DOCTYPE html><html><head><title>{sentence(1, 5)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body{names}>{start}{''.join(before)}{body}{''.join(after)}{end}{some('</body></html>', '')}"
    return page, main


@cache
def trained(pages: int = TRAINING_PAGES, seed: int = 1) -> Field:
    out = []
    for i in range(pages):
        page, main = labelled_page(seed * 100_000 + i)
        blocks, left = placed(leaf_blocks(page)), list(main)
        truth = []
        for text, _ in blocks:
            truth.append(bool(left) and text == left[0])
            if truth[-1]:
                left.pop(0)
        if blocks and not left:
            out.append((blocks, truth))
    return Field.train(out)


def main_text(page: str | None, field: Field) -> str:
    blocks = placed(leaf_blocks(page))
    return "\n\n".join(text for (text, _), main in zip(blocks, field.decode(blocks), strict=True) if main)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages."""
    ship(pages.sparkSession)
    field = trained()
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in small_batches(batches):
            texts = [main_text(h, field) for h in b.column("html").to_pylist()]
            yield made({"page_id": b.column("page_id"), "url": b.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}, schema)

    return pick(pages, {"page_id": "bigint", "url": "string", "html": "string"}).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
