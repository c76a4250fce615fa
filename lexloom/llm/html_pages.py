"""Labelled pages to train the extractor on: generated web pages whose main text is known.

Pages are assembled from layouts, element names and class names that are common
on the web, with words made up at random, so that nothing but structure and the
shape of blocks tells main text from the rest.  A share of the pages has names that
mean nothing, and another share no element that holds the main text, so that the
chain does not take unfamiliar markup for boilerplate.
"""

from __future__ import annotations

import random

_MAIN = [
    ("article", ""), ("article", "post"), ("article", "entry hentry"), ("main", ""), ("main", "content"), ("div", "article"), ("div", "article-body"), ("div", "post-content"),
    ("div", "entry-content"), ("div", "story"), ("div", "main-content"), ("div", "content"), ("section", "article-text"), ("section", "body"), ("div", "text"), ("div", "page-body"), ("div", "main"),
]
#: Kinds of boilerplate: elements and class names that hold it.
_REST = {
    "menu": [("nav", ""), ("nav", "main-nav"), ("div", "menu"), ("ul", "nav navbar-nav"), ("div", "navigation"), ("div", "breadcrumb"), ("div", "topbar"), ("ul", "menu"), ("div", "pagination"), ("div", "tabs"), ("nav", "breadcrumbs"), ("div", "toc")],
    "header": [("header", ""), ("header", "site-header"), ("div", "header"), ("div", "masthead"), ("div", "banner"), ("div", "logo"), ("div", "site-title")],
    "footer": [("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "copyright"), ("div", "bottom"), ("div", "legal"), ("div", "colophon")],
    "sidebar": [("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget"), ("div", "related"), ("div", "related-posts"), ("section", "recommended"), ("div", "trending"), ("div", "tags"), ("div", "author-bio"), ("div", "side"), ("div", "right-column"), ("aside", "related"), ("div", "most-read"), ("div", "see-also")],
    "notice": [("div", "cookie-banner"), ("div", "notice"), ("div", "alert"), ("div", "consent"), ("div", "gdpr"), ("div", "popup"), ("div", "modal"), ("div", "message"), ("div", "cookie-notice"), ("div", "paywall"), ("p", "notice"), ("div", "disclaimer"), ("section", "notice"), ("div", "cookies")],
    "advert": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("div", "promo"), ("ins", "adsbygoogle"), ("div", "banner-ad"), ("aside", "ad"), ("section", "sponsor"), ("div", "promotion"), ("p", "ad"), ("div", "ad-slot"), ("aside", "advert")],
    "form": [("form", ""), ("form", "search"), ("div", "newsletter"), ("div", "subscribe"), ("form", "login"), ("div", "signup"), ("form", "contact"), ("form", "newsletter"), ("div", "search-box")],
    "comments": [("div", "comments"), ("section", "comments"), ("ol", "comment-list"), ("div", "comment"), ("div", "disqus_thread"), ("section", "responses"), ("div", "reviews"), ("div", "discussion"), ("section", "reader-comments"), ("div", "replies"), ("ul", "comments")],
    "share": [("div", "share"), ("div", "social"), ("ul", "social-links"), ("div", "meta"), ("div", "byline"), ("div", "post-meta"), ("div", "sharing")],
}
#: Pages of which the names mean nothing, and pages without a main element, of all pages.
FOREIGN, BARE = 0.2, 0.2
#: Kinds that are told by their elements or the shape of their text even where names mean nothing, and the elements that tell the others.
_PLAIN, _TELLING = ("menu", "form", "share"), ("nav", "header", "footer", "aside", "form", "ins")
#: Kinds that also stand within the main element.
_INSIDE = ("advert", "share", "sidebar", "form", "notice", "comments", "menu")


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        kind = self.r.random()
        self.foreign, self.bare = kind < FOREIGN, FOREIGN <= kind < FOREIGN + BARE
        # A bare page may lack its head and body, or all boilerplate, as well.
        self.headless, self.plain = (self.bare and self.r.random() < 0.4), (self.bare and self.r.random() < 0.4)

    def word(self) -> str:
        r = self.r
        return "".join(r.choice("bcdfghlmnprstvwz") + r.choice(["a", "e", "i", "o", "u", "é", "ö", "ia"]) for _ in range(r.randint(1, 3)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentence(self) -> str:
        return self.words(1, 14).capitalize() + self.r.choice([".", ".", ".", "?", "!", ":", ""])

    def prose(self) -> str:
        """Text of a main block; very short and very long ones occur."""
        many = self.r.choice([1, 1, 2, 3, 5, 8])
        return " ".join(self.sentence() for _ in range(many))

    def attribute(self, names: str) -> str:
        if not names:
            return ""
        kind = self.r.choice(["class", "class", "id"])
        more = f" {self.word()}" if kind == "class" and self.r.random() < 0.3 else ""
        return f' {kind}="{names.split()[0] if kind == "id" else names}{more}"'

    def unknown(self) -> str:
        """A name that means nothing, or none."""
        return self.r.choice(["", self.word() + self.word() + self.word(), "x" + str(self.r.randint(1, 99)), self.word() + self.word() + self.word()])

    def inline(self, text: str) -> str:
        if self.r.random() < 0.25 and " " in text:
            a, b = text.split(" ", 1)
            tag = self.r.choice(["b", "i", "em", "strong", "a", "span"])
            return f"<{tag}{' href=/x' if tag == 'a' else ''}>{a}</{tag}> {b}"
        return text

    def rest(self, kind: str) -> list[tuple[str, str, bool]]:
        """Pieces (markup before, text, in main) of one piece of boilerplate."""
        known = _REST[kind]
        legal = kind == "footer" and self.r.random() < 0.6
        if self.foreign and kind not in _PLAIN and not legal:
            known = [x for x in known if x[0] in _TELLING]
            if not known:
                return []
        tag, names = self.r.choice(known)
        if self.foreign:
            names = self.unknown()
        out = [(f"<{tag}{self.attribute(names)}>", "", False)]
        if kind in ("menu", "share"):
            for _ in range(self.r.randint(1, 7)):
                out.append((self.r.choice(["<li><a href=/x>", "<a href=/x>", "<span>"]), self.words(1, 3), False))
                out.append(("</a></li>" if out[-1][0].startswith("<li>") else "</a> " if out[-1][0].startswith("<a") else "</span>", "", False))
        elif kind == "form":
            for _ in range(self.r.randint(1, 4)):
                out += [("<label>", self.words(1, 4), False), ("</label><input type=text>", "", False)]
            out += [("<button>", self.words(1, 2), False), ("</button>", "", False)]
        elif legal:
            out += [("<p>", self.r.choice(["© ", "© 20 ", self.word() + " © "]) + self.words(1, 6), False), ("</p>", "", False)]
        elif kind in ("comments", "sidebar", "notice", "advert", "footer", "header"):
            if self.r.random() < 0.5:
                h = self.r.choice(["h2", "h3", "h4", "div"])
                out += [(f"<{h}>", self.words(1, 4), False), (f"</{h}>", "", False)]
            for _ in range(self.r.randint(1, 4)):
                t = self.r.choice(["p", "p", "div", "li", "span"])
                out += [(f"<{t}>", self.prose() if self.r.random() < 0.7 else self.words(1, 6), False), (f"</{t}>", "", False)]
        out.append((f"</{tag}>", "", False))
        return out

    def main(self) -> list[tuple[str, str, bool]]:
        tag, names = self.r.choice(_MAIN)
        if self.foreign:
            names = self.unknown()
        if self.plain and self.headless and self.r.random() < 0.2:
            return [("", self.prose(), True)]
        out = [] if self.bare else [(f"<{tag}{self.attribute(names)}>", "", False)]
        if self.r.random() < 0.75:
            h = self.r.choice(["h1", "h1", "h2"])
            if self.r.random() < 0.2:
                out += [("<header>", "", False), (f"<{h}>", self.words(1, 12), True), (f"</{h}></header>", "", False)]
            else:
                out += [(f"<{h}>", self.words(1, 12), True), (f"</{h}>", "", False)]
        for _ in range(self.r.randint(1, 3) if self.plain else self.r.randint(1, 9)):
            kind = self.r.random()
            if kind < 0.12 and not self.plain:
                out += self.rest(self.r.choice(_INSIDE))
            elif kind < 0.2:
                out.append(("<ul>", "", False))
                for _ in range(self.r.randint(1, 5)):
                    out += [("<li>", self.words(1, 10), True), ("</li>", "", False)]
                out.append(("</ul>", "", False))
            else:
                t = self.r.choice(["p", "p", "p", "p", "p", "div", "h2", "h3", "blockquote", "pre", "td", "figcaption", "section"])
                wrap = {"td": ("<table><tr><td>", "</td></tr></table>")}.get(t, (f"<{t}>", "" if t == "p" and self.r.random() < 0.3 else f"</{t}>"))
                out += [(wrap[0], self.inline(self.prose()), True), (wrap[1], "", False)]
        if not self.bare:
            out.append((f"</{tag}>", "", False))
        return out

    def page(self) -> list[tuple[str, str, bool]]:
        r = self.r
        out = [] if self.headless else [(f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title></head><body>", "", False)]
        wrapped = r.random() < 0.4 and not self.headless
        if wrapped:
            out.append((f"<div{self.attribute(self.unknown() if self.foreign else r.choice(['wrapper', 'container', 'page', 'site', '']))}>", "", False))
        if not self.plain:
            for kind in r.sample(["menu", "header", "notice", "advert", "form", "sidebar"], r.randint(0, 4)):
                out += self.rest(kind)
        out += self.main()
        if not self.plain:
            for kind in r.sample(["comments", "sidebar", "advert", "share", "form", "notice", "menu"], r.randint(0, 4)):
                out += self.rest(kind)
            if r.random() < 0.8:
                out += self.rest("footer")
        out.append(("" if self.headless else "</div></body></html>" if wrapped else "</body></html>", "", False))
        return out


def labelled_page(seed: int) -> tuple[str, list[bool]]:
    """Html of a page, and of each of its leaf blocks with text whether it is main text.

    A title comes first and is not main text.
    """
    pieces = _Maker(seed).page()
    html = "".join(a + b for a, b, _ in pieces)
    return html, [*([False] if "<title>" in html else []), *(main for _, text, main in pieces if text)]


#: Marks that the trainer puts into a page's texts to find its blocks again.
MAIN_MARK, REST_MARK = "\ue000", "\ue001"


def marked_page(seed: int) -> str:
    """Html of a page in which every text begins with the mark of its label."""
    return "".join(a + ((MAIN_MARK if main else REST_MARK) + b if b else "") for a, b, main in _Maker(seed).page())
