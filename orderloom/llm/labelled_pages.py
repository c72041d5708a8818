"""Labelled pages to train on: layouts drawn at random, with each block's label.

Words are random letters. Only how a page is built and how long, linked and
punctuated its blocks are can be learnt.
"""

from __future__ import annotations

import random

PAGES = 900


class _Page:
    def __init__(self, draw: random.Random):
        self.draw, self.html, self.labels, self.tag = draw, [], [], ""

    def words(self, low: int, high: int, end: str = "") -> str:
        letters = "abcdefghijklmnopqrstuvwxyzéüñ"
        found = []
        for _ in range(self.draw.randrange(low, high + 1)):
            found.append("".join(self.draw.choice(letters) for _ in range(self.draw.randrange(2, 10))))
            found[-1] += self.draw.choice(["", "", "", "", "", "", ",", "."])
        text = " ".join(found).rstrip(",. ")
        return (text[:1].upper() + text[1:]) + end

    def leaf(self, tag: str, text: str, label: int, inner: str = "", attrs: str = ""):
        if inner:
            text = f"<{inner}>{text}</{inner.split()[0]}>"
        self.html.append(f"<{tag}{attrs}>{text}</{tag}>")
        self.labels.append(label)

    def box(self, tag: str, names: list[str], fill):
        attrs = ""
        if names and self.draw.random() < 0.85:
            kind = self.draw.choice(["class", "class", "id"])
            more = self.draw.choice(["", "", " wrap", "-box", "-inner", "-1", " row"])
            attrs = f' {kind}="{self.draw.choice(names)}{more}"'
        self.html.append(f"<{tag}{attrs}>")
        fill()
        self.html.append(f"</{tag}>")

    def links(self, low: int, high: int):
        def items():
            for _ in range(self.draw.randrange(low, high + 1)):
                self.leaf("li", self.words(1, 4), 0, 'a href="/x"')

        if self.draw.random() < 0.75:
            self.box("ul", ["menu", "links", "list", "nav"], items)
        else:
            for _ in range(self.draw.randrange(low, high + 1)):
                self.leaf("div", self.words(1, 4), 0, 'a href="/x"')

    def menu(self):
        self.box(self.draw.choice(["nav", "nav", "div"]), ["nav", "menu", "navbar", "navigation", "breadcrumb", "topnav"], lambda: self.links(3, 9))

    def header(self):
        def fill():
            self.leaf(self.draw.choice(["div", "h1", "h1", "p"]), self.words(1, 5), 0, self.draw.choice(["", 'a href="/"']))
            if self.draw.random() < 0.5:
                self.leaf("p", self.words(3, 9), 0)
            if self.draw.random() < 0.5:
                self.menu()

        self.box(self.draw.choice(["header", "header", "div"]), ["header", "masthead", "banner", "top", "site-header", "logo"], fill)

    def footer(self):
        def fill():
            if self.draw.random() < 0.4:
                self.links(2, 6)
            for _ in range(self.draw.randrange(1, 3)):
                sign = self.draw.choice(["&copy; ", "&copy; 2024 ", "", "&middot; "])
                self.leaf(self.draw.choice(["p", "div", "p"]), sign + self.words(2, 25, self.draw.choice([".", ""])), 0)
            if self.draw.random() < 0.5:
                self.html.append("&copy; " + self.words(1, 3) + " &middot; " + self.words(4, 30, "."))
                self.labels.append(0)

        self.box(self.draw.choice(["footer", "footer", "footer", "div"]), ["footer", "bottom", "copyright", "site-footer", "colophon"], fill)

    def advert(self):
        def fill():
            if self.draw.random() < 0.6:
                self.html.append(self.words(3, 18, self.draw.choice([".", "!", ""])))
                self.labels.append(0)
            else:
                self.leaf("p", self.words(3, 25, "."), 0, self.draw.choice(["", 'a href="/b"']))

        self.box("div", ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor"], fill)

    def notice(self):
        def fill():
            self.leaf(self.draw.choice(["p", "div"]), self.words(6, 40, "."), 0)
            if self.draw.random() < 0.7:
                self.leaf("button", self.words(1, 3), 0)

        self.box(self.draw.choice(["div", "section", "aside"]), ["cookie", "cookies", "consent", "notice", "banner", "popup", "modal", "alert", "gdpr", "newsletter"], fill)

    def sidebar(self):
        def fill():
            for _ in range(self.draw.randrange(1, 4)):
                if self.draw.random() < 0.6:
                    self.leaf(self.draw.choice(["h2", "h3", "h4"]), self.words(1, 4), 0)
                self.draw.choice([lambda: self.links(2, 6), self.advert, lambda: self.leaf("p", self.words(5, 40, "."), 0)])()

        self.box(self.draw.choice(["aside", "aside", "div"]), ["sidebar", "widget", "related", "aside", "rail", "recommended", "trending", "popular"], fill)

    def form(self):
        def fill():
            for _ in range(self.draw.randrange(1, 4)):
                self.leaf("label", self.words(1, 3), 0)
                self.html.append('<input type="text">')
            if self.draw.random() < 0.4:
                self.leaf("p", self.words(5, 25, "."), 0)
            self.leaf("button", self.words(1, 2), 0)

        self.box("form", ["search", "subscribe", "login", "signup", "newsletter", "contact"], fill)

    def comments(self):
        def one():
            if self.draw.random() < 0.6:
                self.leaf(self.draw.choice(["div", "h4", "p"]), self.words(1, 3), 0)
            for _ in range(self.draw.randrange(1, 3)):
                self.leaf("p", self.words(4, 60, "."), 0)

        def fill():
            if self.draw.random() < 0.7:
                self.leaf(self.draw.choice(["h2", "h3"]), self.words(1, 3), 0)
            for _ in range(self.draw.randrange(1, 5)):
                self.box(self.draw.choice(["div", "li", "article", "section"]), ["comment", "reply", "comment-body", "response"], one)

        self.box(self.draw.choice(["section", "div", "ol", "ul"]), ["comments", "comment-list", "discussion", "responses", "disqus", "replies"], fill)

    def paragraph(self) -> str:
        least, most = self.draw.choice([(1, 3), (2, 30), (12, 60), (30, 160)])
        return self.words(least, most, self.draw.choice([".", ".", ".", "", "?", "!"]))

    def odd(self, text: str) -> str:
        """Now and then text that looks like a menu, a shout, data or a notice."""
        kind = self.draw.random()
        if kind < 0.07:
            return text.replace(" ", " | ")
        if kind < 0.11:
            return text.upper().replace(" ", "!! ")
        if kind < 0.16:
            return f"{text} {self.draw.randrange(10**9)} {self.draw.randrange(256)}.7.{self.draw.randrange(256)}.9"
        if kind < 0.19:
            return self.draw.choice(["&copy; ", "&middot; ", "&raquo; "]) + text
        return text

    def body(self):
        p = "p"
        if self.draw.random() < 0.9:
            wrapped = self.draw.random() < 0.2 and self.tag in ("article", "main")
            self.html.append("<header>" * wrapped)
            self.leaf(self.draw.choice(["h1", "h1", "h2"]), self.odd(self.words(1, 14)), 1)
            self.html.append("</header>" * wrapped)
        for _ in range(self.draw.randrange(1, 12)):
            kind = self.draw.random()
            if kind < 0.72:
                self.leaf(p, self.odd(self.paragraph()), 1, self.draw.choice(["", "", "", "b", "em", "span"]))
            elif kind < 0.8:
                self.leaf(self.draw.choice(["h2", "h3", "h4"]), self.odd(self.words(1, 10)), 1)
            elif kind < 0.86:
                tag = self.draw.choice(["ul", "ol"])
                self.html.append(f"<{tag}>")
                for _ in range(self.draw.randrange(2, 6)):
                    self.leaf("li", self.words(2, 30, self.draw.choice([".", ""])), 1)
                self.html.append(f"</{tag}>")
            elif kind < 0.9:
                self.html.append("<blockquote>")
                self.leaf(p, self.words(5, 50, "."), 1)
                self.html.append("</blockquote>")
            elif kind < 0.92:
                self.html.append("<table><tr>")
                for _ in range(self.draw.randrange(2, 6)):
                    self.leaf("td", self.words(1, 6), 1)
                self.html.append("</tr></table>")
            elif kind < 0.94:
                self.leaf("pre", self.words(3, 30), 1)
            elif kind < 0.97:
                self.leaf(p, self.words(8, 40) + ' <a href="/y">' + self.words(1, 4) + "</a> " + self.words(4, 30, "."), 1)
            else:
                self.draw.choice([self.advert, self.sidebar, self.form, self.notice])()

    def whole(self) -> tuple[str, list[int]]:
        draw = self.draw
        self.html.append("<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>")
        for part, chance in ((self.notice, 0.25), (self.header, 0.8), (self.menu, 0.6), (self.advert, 0.4), (self.sidebar, 0.2), (self.form, 0.15)):
            if draw.random() < chance:
                part()
        tag = self.tag = draw.choice(["article", "article", "article", "main", "div", "section"])
        names = ["content", "post", "entry", "article", "story", "article-body", "post-content", "text", "body", "main"]
        if draw.random() < 0.3:
            self.box(draw.choice(["main", "div"]), ["main", "container", "content", "page"], lambda: self.box(tag, names if tag in ("div", "section") or draw.random() < 0.5 else [], self.body))
        else:
            self.box(tag, names if tag in ("div", "section") or draw.random() < 0.5 else [], self.body)
        for part, chance in ((self.advert, 0.2), (self.comments, 0.35), (self.sidebar, 0.35), (self.form, 0.2), (self.menu, 0.15), (self.notice, 0.1), (self.footer, 0.85)):
            if draw.random() < chance:
                part()
        self.html.append("</body></html>")
        return "".join(self.html), self.labels


def labelled_pages(count: int = PAGES, seed: int = 8) -> list[tuple[str, list[int]]]:
    """Pages and the label of each of their blocks, 1 for main text."""
    draw = random.Random(seed)
    return [_Page(draw).whole() for _ in range(count)]
