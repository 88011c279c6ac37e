"""Labelled pages: layouts drawn from a grammar of page parts, each part marked as content or not.

They teach the parts that a table of pages may not show: comments, notices, forms, sidebars, pages without
landmark elements. An element says by ``data-content`` whether what is in it belongs to the article.
"""

from __future__ import annotations

import random

# Usual class and id names of page parts.
NAMES = {
    "content": "content article post entry story main body text article-body post-content entry-content mainText",
    "nav": "nav menu navbar navigation main-menu topnav breadcrumb breadcrumbs tabs pagination pager",
    "header": "header masthead topbar site-header banner branding logo",
    "footer": "footer site-footer bottom copyright colophon legal",
    "sidebar": "sidebar aside side rail widget secondary related recommended trending more-stories",
    "notice": "notice cookie cookie-banner consent gdpr alert popup modal paywall announcement",
    "advert": "ad ads advert advertisement ad-slot sponsor sponsored promo promotion banner-ad adsbygoogle",
    "form": "form search newsletter subscribe signup login contact searchbox",
    "share": "share social sharing share-buttons follow tags toolbar tools",
    "comments": "comments comment-list commentlist discussion responses reader-comments disqus replies",
    "comment": "comment reply response commentBody comment-text",
}
LETTERS = "aeiounrstlmd"


class Layout:
    def __init__(self, seed: int):
        self.chance = random.Random(seed)
        plain = [""] * 8 + [",", "."]
        odd = [[""], ["!!", "!"], ["***", "&amp;", " 12%", "#"]]
        self.marks = self.chance.choice([plain, plain, plain, *odd])
        self.upper = self.chance.random() < 0.08

    def words(self, low: int, high: int) -> list[str]:
        return [
            "".join(self.chance.choices(LETTERS, k=self.chance.choice([2, 3, 4, 5, 5, 7, 9])))
            for _ in range(self.chance.randint(low, high))
        ]

    def sentences(self, low: int, high: int) -> str:
        text = []
        for word in self.words(low, high):
            text.append(word + self.chance.choice(self.marks))
        joined = " ".join(text).strip(",.").capitalize() + self.chance.choice([".", ".", ".", ""])
        return joined.upper() if self.upper else joined

    def title(self) -> str:
        return " ".join(self.words(2, 12)).capitalize() + self.chance.choice(["", "", "."])

    def mark(self, tags: str, part: str, content: bool, inner: str) -> str:
        """``inner`` in an element of one of the tags, mostly with a name of its part."""
        tag, names = self.chance.choice(tags.split()), ""
        if self.chance.random() < (0.85 if tag == "div" else 0.4):
            attribute = self.chance.choice(["class", "class", "id"])
            names = f' {attribute}="{self.chance.choice(NAMES[part].split())}"'
        return f'<{tag}{names} data-content="{int(content)}">{inner}</{tag}>'

    def some(self, chance: float, part: str) -> str:
        return part if self.chance.random() < chance else ""

    def links(self, low: int, high: int) -> str:
        many = self.chance.randint(low, high)
        shown = [f'<a href="/{k}">{" ".join(self.words(1, 4))}</a>' for k in range(many)]
        kind = self.chance.choice(["list", "list", "plain", "blocks"])
        if kind == "list":
            return "<ul>" + "".join(f"<li>{x}</li>" for x in shown) + "</ul>"
        return " ".join(shown) if kind == "plain" else "".join(f"<div>{x}</div>" for x in shown)

    def fields(self) -> str:
        asked = f"<label>{self.title()}</label><input name=q>"
        return asked + self.some(0.6, f"<p>{self.sentences(3, 14)}</p>")

    def paragraph(self) -> str:
        kind = self.chance.random()
        if kind < 0.72:
            text = self.sentences(1, self.chance.choice([4, 12, 40, 90]))
            if self.chance.random() < 0.2:
                text = f"<b>{self.title()}<br>" + self.some(0.5, f"<p>{text}")
            elif self.chance.random() < 0.2:
                linked = " ".join(self.words(1, 3))
                text += f' <a href="/x">{linked}</a> {self.sentences(2, 9)}'
            return f"<p>{text}" + self.some(0.8, "</p>")
        if kind < 0.8:
            return f"<h2>{self.title()}</h2>"
        if kind < 0.87:
            many = self.chance.randint(2, 5)
            return "<ul>" + "".join(f"<li>{self.sentences(1, 14)}</li>" for _ in range(many)) + "</ul>"
        if kind < 0.91:
            return f"<blockquote><p>{self.sentences(4, 25)}</p></blockquote>"
        if kind < 0.95:
            return f"<pre>{self.sentences(4, 25)}</pre>"
        cells = "".join(f"<td>{' '.join(self.words(1, 3))}</td>" for _ in range(3))
        return f"<table><tr>{cells}</tr><tr>{cells}</tr></table>"

    def inside(self) -> str:
        """Something that stands among an article's paragraphs without being part of it."""
        kind = self.chance.choice(["advert", "form", "share", "sidebar", "notice"])
        if kind == "form":
            return self.mark("form div", "form", False, self.fields())
        if kind in ("share", "sidebar"):
            return self.mark("div aside nav", kind, False, self.links(2, 6))
        return self.mark("div aside", kind, False, self.sentences(3, 16))

    def comments(self) -> str:
        shown = "".join(
            self.mark("div li article", "comment", False, f"<b>{self.title()}</b><p>{self.sentences(3, 45)}</p>")
            for _ in range(self.chance.randint(1, 6))
        )
        return self.mark("div section", "comments", False, f"<h3>{self.title()}</h3>{shown}")

    def page(self) -> str:
        parts = [f"<p>{self.sentences(1, self.chance.choice([4, 30, 90]))}</p>"]
        for _ in range(self.chance.choice([0, 1, 3, 6, 9])):
            parts.append(self.paragraph())
            parts.append(self.some(0.12, self.inside()))
        inner = self.some(0.8, f"<h1>{self.title()}</h1>") + "".join(parts)
        inner += self.some(0.15, self.comments())
        article, body = self.mark("article article main div div section", "content", True, inner), 0
        if self.chance.random() < 0.1:
            # No element of its own: what is not marked otherwise is the article.
            article, body = inner, 1
        banner = f"<h1>{self.title()}</h1>" + self.some(0.5, f"<p>{self.title()}</p>")
        notice = f"<p>{self.sentences(4, 25)}</p>"
        top = [
            self.some(0.5, self.mark("header div", "header", False, banner)),
            self.some(0.8, self.mark("nav nav div ul", "nav", False, self.links(3, 9))),
            self.some(0.3, self.mark("div section", "notice", False, notice)),
            self.some(0.5, self.mark("div aside", "advert", False, self.sentences(2, 16))),
            self.some(0.3, self.mark("form div", "form", False, self.fields())),
        ]
        self.chance.shuffle(top)
        side = self.chance.choice([self.links(3, 8), f"<p>{self.sentences(5, 30)}</p>"])
        side = f"<h3>{self.title()}</h3>{side}"
        end = [
            self.some(0.35, self.comments()),
            self.some(0.4, self.mark("aside div section", "sidebar", False, side)),
            self.some(0.3, self.mark("div aside", "advert", False, self.sentences(2, 16))),
            self.some(0.25, self.mark("form div", "form", False, self.fields())),
            self.some(0.2, self.mark("div section", "notice", False, notice)),
        ]
        self.chance.shuffle(end)
        last = self.chance.choice(["&copy; ", "", "2024 "]) + self.sentences(2, 14)
        last += self.some(0.4, self.links(2, 5))
        end.append(self.some(0.85, self.mark("footer footer div", "footer", False, last)))
        before, after = "".join(top), "".join(end)
        if self.chance.random() < 0.3:
            around = self.chance.choice(["wrapper", "container", "page", "row", "layout"])
            article, after = f'<div class="{around}">{article}{end[0]}</div>', "".join(end[1:])
        return f"<html><body data-content={body}>{before}{article}{after}</body></html>"


def labelled_pages(count: int, seed: int = 0) -> list[str]:
    """The same pages for the same arguments."""
    return [Layout(seed * 1_000_003 + k).page() for k in range(count)]
