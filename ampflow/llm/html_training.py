"""Labelled training pages: made-up sites whose blocks carry their label in a ``data-part`` attribute.

Every page has a layout of its own: which elements and names hold the article, if any (it may stand in the body itself, in
an element without a name, or in one with a name of no meaning), which of the usual page parts surround
or interrupt it, how long texts are. Texts are random letters in all parts, so structure and not vocabulary tells
parts apart. The number of pages is the bound of the training sample.
"""

from __future__ import annotations

import random

PAGES = 600
SEED = 11

ARTICLES = (
    ("article", ""), ("article", "post"), ("article", "entry hentry"), ("main", ""), ("main", "content"), ("div", "content"),
    ("div", "article-body"), ("div", "post-content"), ("div", "entry-content"), ("div", "story"), ("section", "main-text"),
    ("div", "main"), ("td", "content"), ("section", "article"), ("div", "text"), ("div", "page-content"),
)
MENUS = (("nav", ""), ("nav", "main-nav"), ("div", "menu"), ("div", "navbar"), ("ul", "navigation"), ("div", "breadcrumbs"), ("ol", "breadcrumb"), ("div", "topnav"), ("div", "pagination"), ("menu", ""))
HEADERS = (("header", ""), ("header", "site-header"), ("div", "header"), ("div", "masthead"), ("div", "banner"), ("div", "topbar"), ("div", "logo"))
FOOTERS = (("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "copyright"), ("div", "bottom"), ("div", "legal"), ("section", "colophon"))
SIDES = (("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget"), ("div", "related-posts"), ("div", "rail"), ("section", "recommended"), ("div", "popular"), ("div", "share-buttons"), ("div", "social"), ("div", "author-bio"), ("div", "tags"))
NOTICES = (("div", "cookie-notice"), ("div", "cookie-banner"), ("div", "notice"), ("div", "alert"), ("div", "consent"), ("div", "gdpr"), ("div", "newsletter"), ("div", "subscribe"), ("div", "popup"), ("dialog", ""), ("div", "modal"), ("div", "paywall"), ("div", "message"), ("p", "notice"))
ADVERTS = (("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("div", "promo"), ("aside", "ad-slot"), ("div", "banner-ad"), ("section", "sponsor"), ("p", "ad"), ("div", "adsbygoogle"))
FORMS = (("form", ""), ("form", "search"), ("form", "login"), ("form", "contact-form"), ("div", "search-box"))
CONTROLS = (("button", ""), ("select", ""), ("button", "share"), ("label", ""))
COMMENTS = (("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("ol", "commentlist"), ("div", "discussion"), ("div", "disqus-thread"), ("section", "responses"), ("div", "reviews"))


class _Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def word(self) -> str:
        letters = "abcdefghijklmnopqrstuvwxyzéäñ"
        return "".join(self.random.choices(letters, k=self.random.randint(1, 10)))

    def plain_word(self) -> str:
        return "".join(self.random.choices("abcdefghijklmnopqrstuvwxyz", k=self.random.randint(2, 9)))

    def text(self, low: int, high: int) -> str:
        words = [self.word() for _ in range(self.random.randint(low, high))]
        words = [f"<b>{w}</b>" if self.random.random() < 0.02 else w + self.random.choice(["", "", "", ",", "."]) for w in words]
        if self.random.random() < 0.1:
            words = [w + self.random.choice(["***", "!!", " |"]) for w in words]
        return " ".join(words) + self.random.choice([".", ".", "", "!"])

    def opened(self, kind: tuple[str, str], part: str) -> str:
        tag, names = kind
        marks = f' data-part="{part}"'
        if names:
            marks += f' {self.random.choice(["class", "class", "id"])}="{names}"'
        return f"<{tag}{marks}>"

    def wrapped(self, kind: tuple[str, str], part: str, inner: str) -> str:
        return f"{self.opened(kind, part)}{inner}</{kind[0]}>"

    def pick(self, kinds: tuple) -> tuple[str, str]:
        return self.random.choice(kinds)

    def links(self) -> str:
        count = self.random.randint(1, 8)
        items = [f'<a href="/{self.word()}">{self.text(1, 3)}</a>' for _ in range(count)]
        return "".join(f"<li>{i}</li>" for i in items) if self.random.random() < 0.6 else " ".join(items)

    def passages(self) -> str:
        """What any other part may hold: lines, paragraphs, headings or links, short or long."""
        kind = self.random.random()
        if kind < 0.35:
            return self.text(1, 40)
        if kind < 0.6:
            return "".join(f"<p>{self.text(1, 40)}</p>" for _ in range(self.random.randint(1, 3)))
        if kind < 0.8:
            return f"<h{self.random.randint(1, 4)}>{self.text(1, 6)}</h3><p>{self.text(2, 30)}</p>"
        return f"<ul>{self.links()}</ul>"

    def other(self, where: str) -> str:
        choice = {
            "top": (HEADERS, MENUS, NOTICES, ADVERTS, FORMS, SIDES),
            "inside": (ADVERTS, NOTICES, SIDES, FORMS),
            "bottom": (COMMENTS, SIDES, ADVERTS, NOTICES, FORMS, MENUS),
        }[where]
        kinds = self.random.choice(choice)
        if kinds is MENUS:
            return self.wrapped(self.pick(MENUS), "other", f"<ul>{self.links()}</ul>" if self.random.random() < 0.5 else self.links())
        if kinds is FORMS:
            fields = f"<label>{self.text(1, 4)}</label><input><button>{self.text(1, 2)}</button>"
            return self.wrapped(self.pick(FORMS), "other", fields + (self.passages() if self.random.random() < 0.4 else ""))
        if kinds is COMMENTS:
            single = self.random.choice((("div", "comment"), ("li", "comment"), ("article", "comment"), ("p", ""), ("div", "comment-body")))
            inner = "".join(self.wrapped(single, "other", self.passages()) for _ in range(self.random.randint(1, 4)))
            return self.wrapped(self.pick(COMMENTS), "other", f"<h3>{self.text(1, 3)}</h3>{inner}")
        return self.wrapped(self.pick(kinds), "other", self.passages())

    def body(self) -> str:
        out = []
        if self.random.random() < 0.8:
            title = f"<h1>{self.text(1, 12)}</h1>"
            out.append(f"<header>{title}</header>" if self.random.random() < 0.1 else title)
        for _ in range(self.random.randint(0, 8)):
            kind = self.random.random()
            if kind < 0.7:
                out.append(f"<p>{self.random.choice(['', '<b>'])}{self.text(1, 90)}{self.random.choice(['</p>', '<br>', '</p>'])}")
            elif kind < 0.76:
                out.append(f"<h{self.random.randint(2, 4)}>{self.text(1, 8)}</h2>")
            elif kind < 0.82:
                out.append("<ul>" + "".join(f"<li>{self.text(1, 20)}</li>" for _ in range(self.random.randint(1, 4))) + "</ul>")
            elif kind < 0.86:
                out.append(f"<blockquote>{self.text(3, 40)}</blockquote>")
            elif kind < 0.89:
                out.append(f"<pre>{self.text(3, 40)}</pre>")
            elif kind < 0.92:
                out.append(f"<table><tr><td>{self.text(1, 5)}</td><td>{self.text(1, 5)}</td></tr></table>")
            elif kind < 0.95:
                out.append(f"<figure><img><figcaption>{self.text(1, 15)}</figcaption></figure>")
            else:
                out.append(f"<p>{self.text(1, 20)} <a href='/x'>{self.text(1, 4)}</a> {self.text(1, 20)}</p>")
            if self.random.random() < 0.12:
                out.append(self.other("inside"))
            if self.random.random() < 0.05:
                kind = self.pick(CONTROLS)
                shown = self.text(1, 3)
                inner = f"<option>{shown}</option><option>{self.word()}</option>" if kind[0] == "select" else shown
                out.append(self.wrapped(kind, "other", inner))
        return "".join(out)

    def page(self) -> str:
        top = [self.other("top") for _ in range(self.random.randint(0, 3))]
        if self.random.random() < 0.7:
            top.append(self.wrapped(self.pick(MENUS), "other", f"<ul>{self.links()}</ul>"))
        self.random.shuffle(top)
        layout, body = self.random.random(), ' data-part="main"'
        if layout < 0.12:
            article = self.body()  # in the body itself
        elif layout < 0.24:
            article, body = self.wrapped((self.random.choice(("div", "div", "section", "td")), ""), "main", self.body()), ""
        elif layout < 0.36:
            names = " ".join(self.plain_word() for _ in range(self.random.randint(1, 2)))
            article, body = self.wrapped((self.random.choice(("div", "div", "section")), names), "main", self.body()), ""
        else:
            article, body = self.wrapped(self.pick(ARTICLES), "main", self.body()), ""
        if not body and self.random.random() < 0.3:
            article = self.random.choice(("<div class='container'>{}</div>", "<div id='wrapper'>{}</div>", "<main>{}</main>", "<section>{}</section>")).format(article)
        plain = layout < 0.36 and self.random.random() < 0.5
        bottom = [] if plain else [self.other("bottom") for _ in range(self.random.randint(0, 3))]
        if self.random.random() < (0.3 if plain else 0.9):
            mark = self.random.choice(["&copy; ", "© 2020 ", "Copyright ", ""])
            bottom.append(self.wrapped(self.pick(FOOTERS), "other", mark + self.passages()))
        return f"<html><body{body}>{''.join(top)}{article}{''.join(bottom)}</body></html>"


def labelled_pages(count: int = PAGES, seed: int = SEED) -> list[str]:
    """``count`` pages with labels, the same for the same seed."""
    return [_Writer(seed * 1_000_003 + i).page() for i in range(count)]
