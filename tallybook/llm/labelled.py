"""Labelled pages to train the extraction on, made by rule: invented words in common page layouts."""

from __future__ import annotations

from collections.abc import Callable
from random import Random

from tallybook.llm.blocks import blocks_of

MARK = "\ue000"  # stands in main text until the labels are taken
SYLLABLES = "ba do ka li mo ne pu ri sa te vo zu chen lor mi tan ver ost ing ét ñal üb".split()


def _word(r: Random) -> str:
    return "".join(r.choice(SYLLABLES) for _ in range(r.choice((1, 1, 2, 2, 3, 4))))


def _sentence(r: Random, most: int = 18) -> str:
    words = [_word(r) + ("," if r.random() < 0.08 else "") for _ in range(r.randint(1, most))]
    return " ".join(words).capitalize() + r.choice(("...", ".", ".", ".", ".", "?", "!"))


def _prose(r: Random) -> str:
    text = " ".join(_sentence(r) for _ in range(r.choice((1, 1, 1, 2, 3, 5, 9))))
    if r.random() < 0.15:
        text = "".join(w + r.choice(("%%% ", "*** ", "&amp;&amp; ", "| ", "!! ")) for w in text.split())
    return text.upper() if r.random() < 0.05 else text


def _label(r: Random) -> str:
    return " ".join(_word(r) for _ in range(r.randint(1, 4))).capitalize()


def _inline(r: Random, text: str) -> str:
    words = text.split(" ")
    for tag in ("a", "b", "em", "i", "span", "strong", "code"):
        if r.random() < 0.12:
            i = r.randrange(len(words))
            words[i] = f'<{tag}{" href=#" if tag == "a" else ""}>{words[i]}</{tag}>'
    return " ".join(words)


def _class(r: Random, *names: str) -> str:
    name = r.choice(names)
    if r.random() < 0.3:
        name = f"{r.choice(('site', 'page', 'block', 'js', 'main', 'box', 'wrap'))}-{name}"
    if r.random() < 0.2:
        name += r.choice((" clearfix", "-wrapper", "-inner", " col", "s"))
    return f' {r.choice(("class", "class", "class", "id"))}="{name}"'


def _links(r: Random, few: int = 2, many: int = 9) -> str:
    kind = r.choice(("ul", "ul", "ol", "div"))
    items = [f'<a href="/{_word(r)}">{_label(r)}</a>' for _ in range(r.randint(few, many))]
    if kind == "div":
        return "".join(f"<div>{i}</div>" for i in items) if r.random() < 0.5 else " | ".join(items)
    return f"<{kind}>" + "".join(f"<li>{i}</li>" for i in items) + f"</{kind}>"


def _some(r: Random) -> str:
    """Text as boilerplate has it too: often sentences, no different from main text."""
    return r.choice((_label, _sentence, _prose))(r)


def _p(r: Random, text: str) -> str:
    return r.choice((text, f"<p>{text}</p>", f"<p>{text}", f"<div>{text}</div>", f"<span>{text}</span>"))


def _menu(r: Random) -> str:
    if r.random() < 0.6:
        return f"<nav{r.choice(('', _class(r, 'nav', 'menu', 'breadcrumb', 'pagination', 'toc')))}>{_links(r)}</nav>"
    return f"<div{_class(r, 'nav', 'menu', 'navbar', 'navigation', 'breadcrumb', 'breadcrumbs', 'topbar', 'pagination', 'pager', 'toc', 'tabs', 'share', 'social')}>{_links(r)}</div>"


def _header(r: Random) -> str:
    inside = r.choice((f"<h1>{_label(r)}</h1>", f'<a href="/">{_label(r)}</a>', f"<div>{_label(r)}</div>", "")) + r.choice((f"<p>{_some(r)}</p>", _some(r), ""))
    inside += _menu(r) if r.random() < 0.4 else ""
    return f"<header>{inside}</header>" if r.random() < 0.6 else f"<div{_class(r, 'header', 'masthead', 'banner', 'logo', 'branding', 'top')}>{inside}</div>"


def _footer(r: Random) -> str:
    inside = r.choice(("&copy; ", "© ", "")) + r.choice((_label(r), "example.com &middot; " + _some(r), _some(r)))
    inside = _p(r, inside) + (_links(r) if r.random() < 0.3 else "") + (f"<p>{_some(r)}</p>" if r.random() < 0.3 else "")
    return f"<footer{r.choice(('', _class(r, 'footer')))}>{inside}</footer>" if r.random() < 0.7 else f"<div{_class(r, 'footer', 'copyright', 'colophon', 'legal', 'bottom')}>{inside}</div>"


def _aside(r: Random) -> str:
    inside = r.choice(("", f"<h2>{_label(r)}</h2>", f"<h3>{_label(r)}</h3>", f"<h4>{_label(r)}</h4>"))
    inside += "".join(r.choice((_links(r), f"<p>{_some(r)}</p>", _p(r, _some(r)))) for _ in range(r.randint(1, 3)))
    return f"<aside{r.choice(('', _class(r, 'sidebar', 'widget', 'related')))}>{inside}</aside>" if r.random() < 0.5 else f"<div{_class(r, 'sidebar', 'side', 'aside', 'widget', 'related', 'recommended', 'trending', 'popular', 'rail', 'teaser')}>{inside}</div>"


def _notice(r: Random) -> str:
    names = ("notice", "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "paywall", "message", "warning", "disclaimer", "banner", "privacy", "toast")
    tag, extra = r.choice(("div", "div", "section", "p", "dialog")), r.choice(("", ' role="alert"', ' role="dialog"'))
    inside = _some(r) if tag == "p" else _p(r, _some(r))
    return f"<{tag}{_class(r, *names)}{extra}>{inside}{f'<button>{_label(r)}</button>' if r.random() < 0.4 else ''}</{tag}>"


def _advert(r: Random) -> str:
    names = ("ad", "ads", "advert", "adverts", "advertisement", "ad-slot", "sponsored", "sponsor", "promo", "promotion", "banner-ad", "adsense", "commercial")
    tag = r.choice(("div", "div", "div", "aside", "section", "ins", "p"))
    tag = "div" if tag == "ins" else tag
    return f"<{tag}{_class(r, *names)}>{_some(r) if tag == 'p' else _p(r, _some(r))}</{tag}>"


def _form(r: Random) -> str:
    rows = "".join(r.choice((f"<label>{_label(r)}</label><input name=x>", f"<p>{_some(r)}</p>", f"<button>{_label(r)}</button>", f"<select><option>{_label(r)}<option>{_label(r)}</select>", f"<legend>{_label(r)}</legend>")) for _ in range(r.randint(1, 4)))
    return f"<form{r.choice(('', _class(r, 'search', 'login', 'signup', 'contact', 'form')))}>{rows}</form>"


def _comments(r: Random) -> str:
    one = r.choice((
        lambda: f'<div class="{r.choice(("comment", "reply", "comment-body", "response"))}"><p>{_label(r)}</p><p>{_prose(r)}</p></div>',
        lambda: f"<li>{_label(r)}: {_prose(r)}</li>",
        lambda: f"<p>{_prose(r)}</p>",
        lambda: f'<article class="comment"><p>{_prose(r)}</p></article>',
    ))
    inside = r.choice(("", f"<h2>{_label(r)}</h2>", f"<h3>{_label(r)}</h3>")) + "".join(one() for _ in range(r.randint(1, 5)))
    tag = r.choice(("section", "div", "div", "ol", "ul"))
    return f"<{tag}{_class(r, 'comments', 'comment', 'comment-list', 'discussion', 'responses', 'replies', 'disqus', 'respond', 'thread', 'reviews')}>{inside}</{tag}>"


def _code(r: Random) -> str:
    return r.choice((f'<script>var t="</p><p>{_label(r)}</p>";</script>', f"<style>p{{margin:0}} /* {_label(r)} */</style>", f"<!-- {_label(r)} <p>{_label(r)}</p> -->", f"<noscript><p>{_sentence(r)}</p></noscript>"))


def _main_block(r: Random) -> str:
    def said(text: str) -> str:
        return _inline(r, text) + MARK

    kinds: tuple[Callable[[], str], ...] = (
        lambda: f"<p>{said(_prose(r))}</p>",
        lambda: f"<p>{said(_prose(r))}</p>",
        lambda: f"<p>{said(_prose(r))}</p>",
        lambda: f"<p>{said(_prose(r))}",
        lambda: f"<p><b>{_prose(r)}{MARK}<br>",
        lambda: f"<p>{said(_label(r))}</p>",
        lambda: f"<{(h := r.choice(('h2', 'h3', 'h4')))}>{said(_label(r))}</{h}>",
        lambda: "<ul>" + "".join(f"<li>{said(_some(r))}</li>" for _ in range(r.randint(1, 4))) + "</ul>",
        lambda: "<ol>" + "".join(f"<li>{said(_some(r))}" for _ in range(r.randint(1, 4))) + "</ol>",
        lambda: f"<blockquote><p>{said(_prose(r))}</p></blockquote>",
        lambda: f"<pre>{said(_prose(r))}</pre>",
        lambda: f"<figure><img src=x><figcaption>{said(_label(r))}</figcaption></figure>",
        lambda: f"<table><tr><th>{said(_label(r))}<td>{said(_label(r))}</table>",
        lambda: f"<div>{said(_prose(r))}</div>",
        lambda: f"<section><h2>{said(_label(r))}</h2><p>{said(_prose(r))}</p></section>",
    )
    return r.choice(kinds)()


def page(seed: int) -> tuple[str, list[bool]]:
    """One page and, for each of its blocks, whether it is main text."""
    r = Random(seed)
    boiler = (_menu, _header, _footer, _aside, _notice, _advert, _form, _comments, _code)
    title = _label(r)
    heading = r.choice((f"<h1>{title}{MARK}</h1>", f"<h1>{title}{MARK}</h1>", f"<header><h1>{title}{MARK}</h1></header>", ""))
    body = heading
    for _ in range(r.choice((1, 2, 4, 8, 14))):
        body += _main_block(r)
        if r.random() < 0.08:
            body += r.choice((_advert, _aside, _notice, _form, _code))(r)
    after = "".join(x(r) for x in (_comments, _menu, _aside) if r.random() < 0.15)
    inner = r.choice(("article", "article", "article", "main", "div", "section", "td", "bare"))
    names = ("content", "post", "entry", "story", "article", "article-body", "post-content", "entry-content", "text", "maincontent", "body")
    if inner == "td":
        body = f"<table><tr><td{_class(r, *names)}>{body}{after}</td></tr></table>"
    elif inner == "bare":
        body += after
    else:
        name = _class(r, *names) if inner in ("div", "section") or r.random() < 0.3 else ""
        body = f"<{inner}{name}>{body}{after}</{inner}>"
    if r.random() < 0.3:
        body = f"<div{_class(r, 'content', 'container', 'wrapper', 'page', 'layout')}>{_menu(r) if r.random() < 0.3 else ''}{body}{_aside(r) if r.random() < 0.4 else ''}</div>"
    elif r.random() < 0.2 and inner != "main":
        body = f"<main>{body}</main>"
    before = "".join(x(r) for x in (_notice, _header, _menu, _advert, _form, _code) if r.random() < 0.45)
    behind = "".join(x(r) for x in (_comments, _aside, _advert, _form, _notice, _footer) if r.random() < 0.35)
    if r.random() < 0.5:
        behind += _footer(r)
    if not before and r.random() < 0.5:
        before = r.choice(boiler)(r)
    html = f'<!DOCTYPE html><html lang="xx"><head><meta charset="utf-8"><title>{title}</title>{_code(r)}</head><body>{before}{body}{behind}'
    html += r.choice(("</body></html>", "</body></html>", ""))
    labels = [MARK in b.text for b in blocks_of(html)]
    plain = html.replace(MARK, "")
    if len(blocks_of(plain)) != len(labels):
        raise AssertionError("a block was the mark alone")
    return plain, labels


def pages(n: int, first: int = 0) -> list[tuple[str, list[bool]]]:
    return [page(seed) for seed in range(first, first + n)]
