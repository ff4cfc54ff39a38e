"""Labelled pages for the extraction weights: what stands between the comments
``[`` and ``]`` is the main text. A few are written out; any number more are
laid out by a rule from a seed, in many frames and with made-up words."""

from __future__ import annotations

import random

_NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/shop">Shop</a></li></ul></nav>'
_LONG = (
    "The river had risen in the night, and by morning the lower road was under water. People who live there know the signs "
    "well, so most of them had moved their cars before dark. <b>Nobody was hurt</b>, said the mayor, but the bridge stays "
    "closed until engineers have looked at its piers."
)
_MORE = (
    "Rain is expected again on Thursday. The council has asked residents to keep drains clear, and sandbags can be fetched "
    'from the depot on <a href="/mill">Mill Street</a> between eight and six.'
)

PAGES = [
    f"<html><head><title>Flood</title></head><body>{_NAV}<article><!--[--><h1>River floods the lower road</h1><p>{_LONG}</p><p>{_MORE}</p>"
    "<p>More to come.</p><!--]--></article><footer>&copy; The Daily. <a href='/imprint'>Imprint</a> <a href='/privacy'>Privacy</a></footer></body></html>",
    f"<body><header><a href='/'>The Daily</a> <form><input name=q><button>Search</button></form></header>{_NAV}<div class=ad>Buy two, get one</div>"
    f"<main><!--[--><h2>Council meets</h2><p>{_MORE}<p>{_LONG}<ul><li>Keep drains clear, please.</li><li>Move cars uphill before dark.</li></ul><!--]--></main>"
    "<aside><h3>Most read</h3><ul><li><a href='/1'>Bridge closed</a></li><li><a href='/2'>Market moved</a></li></ul></aside><footer>Contact us</footer>",
    f"<body><div id=top><a href='/a'>A</a> <a href='/b'>B</a> <a href='/c'>C</a></div><div id=content><!--[--><h1>Rain again</h1><div>{_LONG}</div>"
    f"<div>{_MORE}</div><blockquote>We were lucky this time.</blockquote><!--]--></div><div class=comments><h3>Comments</h3><div>First!</div>"
    "<div>I was there and it was not that bad.</div></div><div id=bottom><a href='/x'>Terms</a> <a href='/y'>Help</a></div></body>",
    f"<body><div class='cookie-notice'>We use cookies. <button>Fine</button></div><table><tr><td><a href='/1'>One</a><br><a href='/2'>Two</a></td><td>"
    f"<!--[--><p>{_LONG}</p><p>{_LONG}</p><p>{_MORE}</p><!--]--></td></tr></table><div>Share: <a href='#'>this</a> <a href='#'>that</a></div></body>",
    f"<body>{_NAV}<article><!--[--><h1>Depot opens</h1><p>{_LONG}</p><div class=ad>Pumps, half price</div><form>Your town <input></form><p>Soon more.</p>"
    "<!--]--></article><div>All pictures by our readers, who keep their rights, unless named otherwise there</div></body>",
    f"<body><div><div><!--[--><p>{_MORE}</p><p>{_LONG}</p><p>Thanks.</p><!--]--></div></div><div><div>Weather: dry tomorrow, wind from the west, and "
    "cooler at night</div></div><div><div>Exchange rates are of yesterday evening and given without warranty</div></div></body>",
    f"<body><ul><li><a href='/en'>English</a></li><li><a href='/de'>Deutsch</a></li></ul><section><!--[--><h1>Sandbags</h1><p>{_MORE}</p>"
    f"<figure><figcaption>Sandbags at the depot on Monday.</figcaption></figure><p>{_LONG}</p><!--]--></section><section><h2>Read on</h2>"
    "<ul><li><a href='/p'>Pumps</a></li><li><a href='/q'>Quays</a></li></ul></section><form>Your mail <input><button>Subscribe</button></form></body>",
]

_SYLLABLES = "an ber co dar el fi gor hu in ka lo mar ne or pa qui ro sel ti ul ver wen ya zo".split()


class _Layout:
    """One page: a frame around the main text, its blocks, and what stands before, between and after them."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, least: int, most: int) -> str:
        return " ".join("".join(self.rng.choices(_SYLLABLES, k=self.rng.randint(1, 3))) for _ in range(self.rng.randint(least, most)))

    def sentence(self, least: int = 4, most: int = 18) -> str:
        return self.words(least, most).capitalize() + "."

    def links(self, n: int) -> list[str]:
        return [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(n)]

    def menu(self) -> str:
        links = self.links(self.rng.randint(3, 8))
        return self.rng.choice([
            "<nav><ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul></nav>",
            "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>",
            "<div>" + " | ".join(links) + "</div>",
            "<table><tr>" + "".join(f"<td>{x}</td>" for x in links) + "</tr></table>",
        ])

    def notice(self) -> str:
        return self.rng.choice([
            f'<div class="ad">{self.sentence()}</div>', f"<div>{self.sentence(3, 8)} <button>{self.words(1, 1)}</button></div>",
            f"<form>{self.words(1, 4)} <input><button>{self.words(1, 2)}</button></form>", f'<div class="cookie-notice">{self.sentence()}</div>', "",
        ])

    def rich(self, sentences: int) -> str:
        out = []
        for _ in range(sentences):
            kind, s = self.rng.random(), self.sentence()
            out.append(f"<b>{s}</b>" if kind < 0.08 else f"<em>{s}</em>" if kind < 0.12 else f'{s[:-1]} <a href="/x">{self.words(1, 3)}</a>.' if kind < 0.2 else s)
        return " ".join(out)

    def block(self) -> str:
        kind = self.rng.random()
        if kind < 0.1:
            return f"<h2>{self.words(2, 6)}</h2>"
        if kind < 0.2:
            return "<ul>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(self.rng.randint(2, 4))) + "</ul>"
        if kind < 0.26:
            return f"<blockquote>{self.rich(2)}</blockquote>"
        if kind < 0.32:
            return f"<figure><img src=x><figcaption>{self.sentence(3, 8)}</figcaption></figure>"
        if kind < 0.4:
            return f"<div>{self.rich(self.rng.randint(1, 4))}</div>"
        if kind < 0.5:
            return f"<p>{self.sentence(1, 4)}</p>"
        return f"<p>{self.rich(self.rng.randint(2, 6))}" + self.rng.choice(["</p>", "</p>", "<br>" + self.rich(1) + "</p>", ""])

    def comments(self) -> str:
        said = "".join(f"<div>{self.words(1, 2)}: {self.rich(self.rng.randint(1, 3))}</div>" for _ in range(self.rng.randint(1, 4)))
        return f'<div class="comments"><h3>{self.words(1, 2)}</h3>{said}</div>'

    def related(self) -> str:
        rows = "".join(f"<li>{x}</li>" for x in self.links(self.rng.randint(2, 6)))
        return self.rng.choice([f"<aside><h3>{self.words(1, 3)}</h3><ul>{rows}</ul></aside>", f"<section><h2>{self.words(1, 3)}</h2><ul>{rows}</ul></section>"])

    def page(self) -> str:
        head = f"<h1>{self.words(2, 9)}</h1>" if self.rng.random() < 0.8 else ""
        blocks = [f"<p>{self.rich(self.rng.randint(3, 6))}</p>", *(self.block() for _ in range(self.rng.randint(1, 8)))]
        if self.rng.random() < 0.3:
            blocks.insert(self.rng.randint(1, len(blocks)), f'<div class="ad">{self.sentence()}</div>')
        text = f"<!--[-->{head}{''.join(blocks)}<!--]-->"
        frame = self.rng.choice(["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", "<section>{}</section>", "<div>{}</div>", "<div id=content><div>{}</div></div>", "<table><tr><td>{}</td></tr></table>"])
        before = "".join(self.rng.sample([self.menu(), self.notice(), f"<header>{self.words(1, 3)} {self.links(1)[0]}</header>"], self.rng.randint(1, 3)))
        after = "".join(self.rng.sample([self.comments(), self.related(), self.menu(), self.notice()], self.rng.randint(0, 3)))
        foot = self.rng.choice([f"<footer>&copy; {self.words(2, 8)} {' '.join(self.links(2))}</footer>", f"<div>{' '.join(self.links(3))}</div>"])
        return f"<html><head><title>{self.words(2, 6)}</title></head><body>{before}{frame.format(text)}{after}{foot}</body></html>"


def labelled_pages(n: int, seed: int = 1) -> list[str]:
    """The pages written out, and ``n`` laid out by the rule; another seed gives other pages."""
    return PAGES + [_Layout(1_000_003 * seed + i).page() for i in range(n)]
