"""Labelled training pages for the content model, made by rule.

Every page is built from a random layout: an article (headings, paragraphs, lists,
quotes, tables, figures) among menus, headers, footers, sidebars, notices, adverts,
forms and reader comments, with varied tags, class names and nesting.  The attribute
``data-y`` on an element is the label of it and of what stands below it, until another
one; the model never sees the attribute.
"""

from __future__ import annotations

import random

# Class names that sites commonly use, by part of the page (fixed values).
NAMES = {
    "menu": ["nav", "menu", "navbar", "main-nav", "breadcrumb", "topnav", "site-menu", "pagination"],
    "header": ["header", "site-header", "masthead", "top-bar", "branding", "logo"],
    "footer": ["footer", "site-footer", "copyright", "bottom", "colophon"],
    "side": ["sidebar", "aside", "widget", "related", "recommended", "rail"],
    "notice": ["cookie", "cookie-notice", "banner", "consent", "alert", "popup", "notice", "disclaimer"],
    "advert": ["ad", "ads", "advert", "sponsored", "promo", "advertisement", "banner-ad"],
    "form": ["form", "newsletter", "subscribe", "search", "login", "signup"],
    "comments": ["comments", "comment-list", "replies", "discussion", "responses"],
    "share": ["share", "social", "share-buttons", "toolbar", "tags", "meta"],
    "content": ["content", "article", "post", "entry-content", "main", "story", "article-body", "text", "post-body"],
    "plain": ["row", "col", "wrap", "inner", "box", "section", "block", "container", "x1", "c2"],
}
SYLLABLES = ["ka", "lo", "mi", "ren", "tu", "sha", "ver", "on", "di", "pel", "as", "ti", "or", "en", "gu", "fa"]


class _Page:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.r
        return " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def sentence(self) -> str:
        return self.words(4, 18).capitalize() + self.r.choice([".", ".", ".", "!", "?"])

    def prose(self, low: int = 1, high: int = 6) -> str:
        text = " ".join(self.sentence() for _ in range(self.r.randint(low, high)))
        if self.r.random() < 0.25:
            text += f" <a href='/x'>{self.words(1, 3)}</a> {self.sentence()}"
        if self.r.random() < 0.2:
            text = f"<{(t := self.r.choice(['b', 'em', 'span', 'strong']))}>{self.words(1, 4)}</{t}> " + text
        return text

    def names(self, kind: str) -> str:
        """Class or id of a part; sometimes none that tells."""
        r = self.r
        if r.random() < 0.25:
            return ""
        value = r.choice(NAMES[kind] if r.random() < 0.8 else NAMES["plain"])
        return f' {r.choice(["class", "id"])}="{value}"'

    def links(self, low: int, high: int) -> str:
        r = self.r
        items = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(r.randint(low, high))]
        style = r.randrange(3)
        if style == 0:
            return "<ul>" + "".join(f"<li>{a}</li>" for a in items) + "</ul>"
        return (" | " if style == 1 else "").join(items)

    def part(self, kind: str) -> str:
        r = self.r
        tags = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "side": ["aside", "div", "section"], "notice": ["div", "section"], "advert": ["div", "aside", "ins"], "form": ["form", "div"], "comments": ["section", "div", "ol"], "share": ["div", "ul"]}
        tag = r.choice(tags[kind])
        if tag == "ul":
            return f'<ul{self.names(kind)} data-y="0">' + "".join(f'<li><a href="/{i}">{self.words(1, 2)}</a></li>' for i in range(r.randint(2, 8))) + "</ul>"
        body = {
            "menu": lambda: self.links(3, 10),
            "header": lambda: r.choice([f"<h1>{self.words(1, 4)}</h1>", f"<a href='/'>{self.words(1, 3)}</a>", f"<p>{self.words(2, 6)}</p>"]) + r.choice(["", self.links(2, 6)]),
            "footer": lambda: r.choice(["&copy; ", "Copyright ", ""]) + self.words(1, 4) + r.choice([" &middot; ", " ", " | "]) + r.choice([self.sentence(), self.links(2, 5), f"<p>{self.sentence()}</p>"]),
            "side": lambda: f"<h{r.randint(2, 4)}>{self.words(1, 3)}</h3>" + r.choice([self.links(3, 8), f"<p>{self.prose(1, 3)}</p>", f"<p>{self.sentence()}</p><p>{self.links(1, 2)}</p>"]),
            "notice": lambda: r.choice([f"<p>{self.prose(1, 2)}</p><button>{self.words(1, 2)}</button>", self.prose(1, 2), f"<span>{self.sentence()}</span> <a href='/ok'>{self.words(1, 2)}</a>"]),
            "advert": lambda: r.choice([self.sentence(), f"<p>{self.sentence()}</p>", f"<a href='http://ad'>{self.words(2, 6)}</a>", self.prose(1, 2)]),
            "form": lambda: f"<label>{self.words(1, 3)}</label><input><p>{self.sentence()}</p><button>{self.words(1, 2)}</button>",
            "comments": lambda: r.choice(["", f"<h3>{self.words(1, 2)}</h3>"]) + "".join(f'<{(t := r.choice(["div", "li", "article"]))} class="{r.choice(["comment", "reply", "c"])}"><p>{self.prose(1, 3)}</p></{t}>' for _ in range(r.randint(1, 5))),
            "share": lambda: self.links(2, 5),
        }[kind]()
        role = {"menu": ' role="navigation"', "footer": ' role="contentinfo"', "header": ' role="banner"', "side": ' role="complementary"'}.get(kind, "") if r.random() < 0.15 else ""
        # A part inside the article keeps its tell-tale name or tag.
        return f'<{tag}{self.names(kind)}{role} data-y="0">{body}</{tag}>'

    def article(self) -> str:
        r, out = self.r, []
        if r.random() < 0.8:
            out.append(f"<h1>{self.words(2, 10)}</h1>")
        for _ in range(1 if r.random() < 0.15 else r.randint(1, 14)):
            x = r.random()
            if x < 0.7:
                out.append(f"<p>{self.prose()}" + ("</p>" if r.random() < 0.9 else ""))
            elif x < 0.79:
                out.append(f"<p>{self.words(1, 3).capitalize()}{r.choice([".", "", ",", " |"])}</p>")
            elif x < 0.82:
                out.append(f"<h{(k := r.randint(2, 4))}>{self.words(1, 7)}</h{k}>")
            elif x < 0.87:
                out.append("<ul>" + "".join(f"<li>{self.prose(1, 2)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif x < 0.91:
                out.append(f"<blockquote><p>{self.prose(1, 2)}</p></blockquote>")
            elif x < 0.94:
                out.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif x < 0.97:
                out.append(f"<pre>{self.words(3, 12)}</pre>")
            else:
                out.append(self.part(r.choice(["advert", "share", "notice", "side"])))
        if r.random() < 0.12:
            out.append(f"<p><b>{self.sentence()}<br><p>{self.prose()}</p>")
        if r.random() < 0.1:  # text straight in the container
            out.append(f"{self.prose()}<br>{self.prose()}")
        return "".join(out)

    def html(self) -> str:
        r = self.r
        tag = r.choice(["article", "article", "main", "div", "section"])
        name = self.names("content") if tag in ("article", "main") or r.random() < 0.2 else f' class="{r.choice(NAMES["content"])}"'
        body = f'<{tag}{name} data-y="1">{self.article()}</{tag}>'
        if r.random() < 0.4:
            body = f"<div{self.names('plain')} data-y=\"1\">{body}{self.part('share') if r.random() < 0.3 else ''}</div>"
        before = [self.part(k) for k in ("notice", "header", "menu", "advert", "form") if r.random() < 0.55]
        after = [self.part(k) for k in ("side", "comments", "share", "form", "advert", "menu", "footer", "notice") if r.random() < 0.4]
        r.shuffle(before)
        page = "".join(before) + body + "".join(after)
        if r.random() < 0.4:
            page = f"<div{self.names('plain')}>{page}</div>"
        return f'<html><body data-y="1">{page}</body></html>'


def pages(count: int, seed: int = 11) -> list[str]:
    return [_Page(seed * 100_003 + i).html() for i in range(count)]
