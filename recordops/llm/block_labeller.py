"""Main text of web pages by a recurrent labeller of blocks.

A page becomes its sequence of text blocks (leaves). A bidirectional LSTM in numpy reads,
for each block, hashed vectors of its tag path (tags, classes, ids), of its words, and a
few measures (length, share of links, place), and labels every block with the whole page
as context. The model is trained here, on pages that `sample_page` makes up from many
layouts, with a fixed seed; nothing is read from the data.

Null and empty html have an empty text. Pages are read whole and independently of one
another, so repeated rows repeat. Tags may be unclosed or misplaced: elements without text
(icons, frames, templates) end at the close that matches, an empty or unclosed one is its
tag only; scripts and styles end at the next close or with the page.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordops.llm.base import LOWER, NOT_BLANK, bounded, flat_bytes, slices, word_hashes, word_spans

PATH, LAST, WORD, PLAIN = 48, 24, 16, 8
INPUT, HIDDEN = PATH + LAST + WORD + PLAIN, 16
MAIN = "\ue000"  # begins the blocks of made-up pages that are main text
NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
EDGE = re.compile("[>\"']")
LONG_NUMBER = re.compile(r"&#[0-9]{4000,};?")  # beyond what a decimal number may hold, as of 1,114,112 on
DEEP = 40  # innermost levels of a path that count
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TOKEN = re.compile(r"[a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input svg path".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template iframe object svg math canvas".split())
RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "iframe")}  # hold no tags
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class Tags:
    """The tags of a page from any place on, in time proportional to its length whatever is left open in it."""

    def __init__(self, page: str):
        self.page = page
        self.closed = page.rfind(">")  # no tag ends behind it
        self.dead: set[int] = set()  # quotes from which no end of a tag is reached

    def next(self, place: int):
        """Start, end, whether it closes, name and attributes of the next tag; comments and the like have no name."""
        page = self.page
        while (start := page.find("<", place)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, False, "", ""
            if start > self.closed:
                # Only a comment can still begin; nothing else ends any more.
                place = page.find("<!--", start)
                if place < 0:
                    return None
                continue
            if page.startswith(("<!", "<?"), start):
                return start, page.find(">", start) + 1, False, "", ""
            if m := NAME.match(page, start + 1):
                end = self.end_of(m.end())
                return start, end, bool(m.group(1)), m.group(2).lower(), page[m.end() : end - 1]
            place = start + 1
        return None

    def end_of(self, place: int) -> int:
        """Behind the next `>` outside quotes, or if a quote stays open, behind the very next one."""
        first, passed = place, []
        while (m := EDGE.search(self.page, place)) and m.start() not in self.dead:
            if m.group() == ">":
                return m.end()
            passed.append(m.start())
            close = self.page.find(m.group(), m.end())
            if close < 0:
                break
            place = close + 1
        self.dead.update(passed)
        return self.page.find(">", first) + 1


def silent_ends(page: str, tags: Tags) -> dict[int, int]:
    """Where the elements without text end, by the start of their opening tags; unclosed ones have no entry."""
    found: dict[int, int] = {}
    opened: dict[str, list[int]] = {name: [] for name in SILENT}
    endless = False
    place = 0
    while tag := tags.next(place):
        start, place, closing, name, _ = tag
        if name not in SILENT:
            continue
        if closing:
            if opened[name]:
                found[opened[name].pop()] = place
        elif page.startswith("/>", place - 2) and (name in ("svg", "math") or opened["svg"] or opened["math"]):
            found[start] = place
        elif name not in RAW:
            opened[name].append(start)
        elif not (name == "iframe" and endless):
            stop = RAW[name].search(page, place)
            if stop or name != "iframe":
                place = found[start] = stop.end() if stop else len(page)
            endless = endless or not stop
    return found


def blocks(page: str) -> list[tuple[str, str, str, float]]:
    """Text blocks in page order: text, tag path, innermost tags, share of text in links."""
    out: list = []
    stack: list[tuple[str, str]] = []
    levels: Counter[str] = Counter()  # of the stack by name
    text: list[str] = []
    linked = 0
    in_link = 0
    place = 0

    def flush():
        nonlocal linked
        if text:
            joined = entities.unescape(LONG_NUMBER.sub("\ufffd", "".join(text)))
            words = joined.split()
            if words:
                clean = " ".join(words)
                path = " ".join(x for _, x in stack[-DEEP:])
                out.append((clean, path, " ".join(n for n, _ in stack[-2:]), min(1.0, linked / max(len(joined), 1))))
            text.clear()
        linked = 0

    def add(piece: str):
        nonlocal linked
        text.append(piece)
        if in_link:
            linked += len(piece)

    tags = Tags(page)
    ends = silent_ends(page, tags)
    while tag := tags.next(place):
        start, end, closing, name, attributes = tag
        if start > place:
            add(page[place:start])
        place = end
        if not name:
            continue
        if name in SILENT and not closing:
            place = ends.get(start, end)
            continue
        if name == "a":
            in_link = 0 if closing else 1
        if name == "br":
            add(" ")
        if name in INLINE:
            continue
        flush()
        in_link = 0
        if closing:
            while levels[name]:
                top = stack.pop()[0]
                levels[top] -= 1
                if top == name:
                    break
            continue
        if name in VOID:
            continue
        if stack and (stack[-1][0] in CLOSES.get(name, ()) or (stack[-1][0] == "p" and name in ENDS_PARAGRAPH)):
            levels[stack.pop()[0]] -= 1
        found = " ".join(a or b or c for a, b, c in NAMES.findall(attributes))
        stack.append((name, name + " " + found.lower()))
        levels[name] += 1
    if place < len(page):
        add(page[place:])
    flush()
    return out


@lru_cache(20_000)
def hashed(path: str, width: int) -> np.ndarray:
    out = np.zeros(width, np.float32)
    for token in TOKEN.findall(path):
        h = zlib.crc32(token.encode())
        out[h % width] += 1.0 if h >> 20 & 1 else -1.0
    return np.clip(out, -2, 2)


def features(found: list[tuple[str, str, str, float]]) -> np.ndarray:
    """The input of the model for the blocks of a page."""
    n = len(found)
    out = np.zeros((n, INPUT), np.float32)
    out[:, :PATH] = [hashed(b[1], PATH) for b in found]
    out[:, PATH : PATH + LAST] = [hashed(b[2], LAST) for b in found]
    data, offsets = flat_bytes(pa.array([b[0] for b in found], pa.large_string()).cast(pa.large_binary()))
    starts, ends, before = word_spans(data, offsets, NOT_BLANK)
    words = np.diff(before)
    bins = (word_hashes(LOWER[data], starts, ends) >> np.uint64(60)).astype(np.int64)
    counts = np.bincount(np.repeat(np.arange(n), words) * WORD + bins, minlength=n * WORD).reshape(n, WORD)
    out[:, PATH + LAST : PATH + LAST + WORD] = counts / np.maximum(words, 1)[:, None]
    length = np.diff(offsets)
    rest = out[:, -PLAIN:]
    rest[:, 0] = np.log1p(words) / 5
    rest[:, 1] = [b[3] for b in found]
    rest[:, 2] = np.arange(n) / n
    rest[:, 3] = length / np.maximum(words, 1) / 10
    rest[:, 4] = words < 4
    rest[:, 5] = words > 15
    rest[:, 6] = np.log1p(n) / 5
    rest[:, 7] = 1
    return out


class Labeller:
    """LSTM in both directions and a logistic output for each block."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        f = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.w = {}
        for d in "fb":
            self.w |= {f"x{d}": f(INPUT, 4 * HIDDEN), f"h{d}": f(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.w[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1
        self.w |= {"o": f(2 * HIDDEN, 1)[:, 0], "p": np.zeros(1, np.float32)}

    def run(self, x: np.ndarray, d: str, keep: bool = False):
        """States (steps x pages x HIDDEN) of one direction over steps x pages x INPUT."""
        steps, pages, _ = x.shape
        ready = x.reshape(-1, INPUT) @ self.w[f"x{d}"] + self.w[f"c{d}"]
        ready = ready.reshape(steps, pages, -1)
        h = c = np.zeros((pages, HIDDEN), np.float32)
        out = np.empty((steps, pages, HIDDEN), np.float32)
        trace = []
        for t in range(steps):
            z = ready[t] + h @ self.w[f"h{d}"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            old, last = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                trace.append((i, f, o, g, old, last, tc))
        return (out, trace) if keep else out

    def chances(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of main text, steps x pages; pages shorter than the longest end in padding."""
        at = flipped(lengths, x.shape[0])
        cols = np.arange(x.shape[1])
        ahead = self.run(x, "f")
        back = self.run(x[at, cols], "b")[at, cols]
        z = ahead @ self.w["o"][:HIDDEN] + back @ self.w["o"][HIDDEN:] + self.w["p"]
        return 1 / (1 + np.exp(-z))

    def step(self, x, lengths, y, weight) -> dict:
        """Gradients of the mean cross entropy."""
        steps, pages, _ = x.shape
        at, cols = flipped(lengths, steps), np.arange(pages)
        runs = {"f": (x, *self.run(x, "f", True)), "b": (x[at, cols], *self.run(x[at, cols], "b", True))}
        hf, hb = runs["f"][1], runs["b"][1][at, cols]
        z = hf @ self.w["o"][:HIDDEN] + hb @ self.w["o"][HIDDEN:] + self.w["p"]
        dz = ((1 / (1 + np.exp(-z)) - y) * weight / weight.sum()).astype(np.float32)
        grad = {"o": np.concatenate([np.einsum("tb,tbh->h", dz, hf), np.einsum("tb,tbh->h", dz, hb)]), "p": dz.sum(keepdims=True).reshape(1)}
        outer = {"f": dz[:, :, None] * self.w["o"][:HIDDEN], "b": (dz[:, :, None] * self.w["o"][HIDDEN:])[at, cols]}
        for d, (inp, _, trace) in runs.items():
            dh, dc = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
            gx = np.empty((steps, pages, 4 * HIDDEN), np.float32)
            gh = np.zeros_like(self.w[f"h{d}"])
            for t in range(steps - 1, -1, -1):
                i, f, o, g, old, last, tc = trace[t]
                dh = dh + outer[d][t]
                dc = dc + dh * o * (1 - tc * tc)
                gx[t] = np.concatenate([dc * g * i * (1 - i), dc * old * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
                gh += last.T @ gx[t]
                dh, dc = gx[t] @ self.w[f"h{d}"].T, dc * f
            flat = gx.reshape(-1, 4 * HIDDEN)
            grad |= {f"x{d}": inp.reshape(-1, INPUT).T @ flat, f"h{d}": gh, f"c{d}": flat.sum(0)}
        return grad


def flipped(lengths: np.ndarray, steps: int) -> np.ndarray:
    """For each page the steps in reverse; padding stays behind."""
    t = np.arange(steps)[:, None]
    return np.where(t < lengths, lengths - 1 - t, t)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in pages])
    x = np.zeros((lengths.max(), len(pages), INPUT), np.float32)
    for i, p in enumerate(pages):
        x[: len(p), i] = p
    return x, lengths


#: Names of classes and ids by what they hold, from which pages are made up.
LAYOUT = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs toc pagination sitelinks",
    "head": "header masthead banner logo top siteheader tagline",
    "foot": "footer bottom copyright legal colophon siteinfo imprint",
    "side": "sidebar aside widget related recommended popular trending tags share social rail",
    "ad": "ad ads advert advertisement promo sponsor sponsored adslot banner commercial",
    "notice": "cookie consent notice alert gdpr popup modal overlay subscribe newsletter paywall",
    "comment": "comment comments commentlist replies discussion responses respond thread disqus",
    "main": "content main article post entry story body text articlebody maincontent page",
}
CUES = {
    "foot": ["Copyright", "All rights reserved", "Privacy", "Terms"],
    "notice": ["We use cookies", "Accept", "Sign up"],
    "comment": ["Reply", "says", "Comments"],
    "side": ["Related", "Most read", "Share"],
    "ad": ["Advertisement", "Sponsored"],
}


def sample_page(rng: random.Random) -> str:
    """A made-up page; its main blocks begin with MAIN."""
    letters = "aeioubcdfghlmnprstvz"
    lexicon = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(60)]

    def prose(low: int, high: int) -> str:
        words = [rng.choice(lexicon) for _ in range(rng.randint(low, high))]
        junk = rng.random() < 0.05
        words = [w + rng.choice(["", "", ",", "."]) + ("***" if junk else "") for w in words]
        return (" ".join(words)).capitalize() + rng.choice([".", "", "!", "."])

    def named(tag: str, kind: str, body: str, bare: float = 0.1) -> str:
        if rng.random() < bare:
            return f"<{tag}>{body}</{tag}>"
        name = rng.choice(LAYOUT[kind].split())
        name = rng.choice([name, name, f"{name}-{rng.choice(['box', 'wrap', 'list', 'main', 'inner', '1'])}", f"{rng.choice(['site', 'page', 'js'])}-{name}"])
        return f"<{tag} {rng.choice(['class', 'class', 'id'])}=\"{name}\">{body}</{tag}>"

    def wrapped(tag: str, body: str) -> str:
        """Without a name, or with one that tells nothing."""
        name = rng.choice(["", "", f' class="{rng.choice(lexicon)}"', f' id="{rng.choice(letters)}{rng.randint(1, 99)}"'])
        return f"<{tag}{name}>{body}</{tag}>"

    def links(n: int) -> str:
        items = [f'<a href="/{rng.choice(lexicon)}">{prose(1, 3)}</a>' for _ in range(n)]
        return rng.choice(["<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", " ".join(items), "<ol><li>" + "<li>".join(items) + "</ol>"])

    def extra(kind: str) -> str:
        cue = rng.choice(CUES.get(kind, [""])) if rng.random() < 0.4 else ""
        if kind == "menu":
            return f"<nav>{links(rng.randint(2, 8))}</nav>" if rng.random() < 0.6 else named("div", kind, links(rng.randint(2, 8)), 0)
        if kind == "head":
            body = rng.choice([f"<h1>{prose(1, 4)}</h1>", prose(2, 8), f'<a href="/">{prose(1, 2)}</a><p>{prose(2, 9)}</p>'])
            return f"<header>{body}</header>" if rng.random() < 0.6 else named("div", kind, body, 0)
        if kind == "foot":
            body = rng.choice(["&copy; ", "", cue + " "]) + rng.choice([prose(1, 25), links(3), f"<p>{prose(2, 20)}</p>"])
            if rng.random() < 0.15:  # under a line
                return f"<hr>{rng.choice(['Copyright', '&copy;', 'Contact:', 'Imprint'])} {prose(1, 8)}"
            return f"<footer>{body}</footer>" if rng.random() < 0.7 else named("div", kind, body, 0)
        if kind == "side":
            body = rng.choice([f"<h3>{cue or prose(1, 3)}</h3>{links(rng.randint(2, 6))}", f"<p>{prose(4, 30)}</p>", f"<div>{cue} {prose(2, 20)}</div>"])
            return f"<aside>{body}</aside>" if rng.random() < 0.5 else named("div", kind, body, 0)
        if kind == "comment":
            one = lambda: rng.choice([f"<p>{prose(3, 40)}</p>", f'<div class="comment"><b>{prose(1, 2)}</b> {prose(3, 40)}</div>', f"<li>{cue} {prose(3, 30)}</li>"])
            body = (f"<h3>{cue or 'Comments'}</h3>" if rng.random() < 0.5 else "") + "".join(one() for _ in range(rng.randint(1, 5)))
            if rng.random() < 0.3:  # a list that only its words give away
                heading = rng.choice(["Comments", "Replies", "Discussion", f"{rng.randint(2, 40)} comments", "Leave a reply"])
                says = lambda: rng.choice([f"{prose(1, 2)} says: {prose(3, 30)}", f"<b>{prose(1, 1)}</b> {prose(3, 30)} <a href=\"#r\">Reply</a>", f"<p>{prose(3, 30)} Reply</p>"])
                return f"<h3>{heading}</h3>" + wrapped(rng.choice(["ul", "ol", "div"]), "".join(f"<li>{says()}</li>" for _ in range(rng.randint(1, 5))))
            return named(rng.choice(["div", "section", "ol", "ul"]), kind, body, 0)
        if kind == "form":
            return f'<form action="/x"><label>{prose(1, 3)}</label> <input type="text"><button>{prose(1, 2)}</button>' + (f"<p>{prose(3, 15)}</p>" if rng.random() < 0.3 else "") + "</form>"
        body = rng.choice([f"{cue} {prose(3, 30)}", f"<p>{cue} {prose(3, 40)}</p>", f"<p>{prose(3, 20)}</p><button>{prose(1, 2)}</button>"])
        return named(rng.choice(["div", "div", "section", "p"]), kind, body, 0)

    def part() -> str:
        kind = rng.random()
        if kind < 0.68:
            body = prose(1, 90)
            if rng.random() < 0.2:
                body = body.replace(" ", f' <a href="/l">{rng.choice(lexicon)}</a> ', 1)
            return rng.choice([f"<p>{MAIN}{body}</p>", f"<p>{MAIN}{body}", f"<div>{MAIN}{body}</div>", f"<p><b>{MAIN}{body}<br>"])
        if kind < 0.78:
            return f"<h{(k := rng.randint(2, 4))}>{MAIN}{prose(1, 8)}</h{k}>"
        if kind < 0.88:
            return "<ul>" + "".join(f"<li>{MAIN}{prose(1, 18)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.93:
            return f"<blockquote>{MAIN}{prose(4, 40)}</blockquote>"
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{MAIN}{prose(1, 4)}</td><td>{MAIN}{prose(1, 4)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>"
        return extra(rng.choice(["ad", "notice", "side", "form"]))

    inner = "".join(part() for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9, 15])))
    title = prose(1, 9)
    if rng.random() < 0.85:
        inner = f"<h1>{MAIN}{title}</h1>" + inner
    style = rng.random()
    layout = rng.random()
    if layout < 0.16:  # text between breaks, straight in the body or in a wrapper that tells nothing
        inner = (f"<h1>{MAIN}{title}</h1>" if rng.random() < 0.7 else "") + (cut := rng.choice(["<br><br>", "<br>", "<p>"])).join(f"{MAIN if k == 0 or cut == '<p>' else ''}{prose(8, 90)}" for k in range(rng.randint(1, 5)))
        main = rng.choice([inner, inner, inner + "".join(part() for _ in range(rng.randint(0, 3))), wrapped("div", inner), wrapped("center", inner), f"<main>{wrapped('div', inner)}</main>", wrapped("td", inner)])
    elif layout < 0.46:  # sections and divisions without names
        main = "".join(wrapped(rng.choice(["section", "section", "div"]), x) for x in (inner, *("".join(part() for _ in range(rng.randint(1, 4))) for _ in range(rng.choice([0, 0, 1, 2])))))
        main = rng.choice([f"<main>{main}</main>", f"<main>{main}</main>", main, wrapped("div", main), wrapped("div", wrapped("div", main))])
    elif style < 0.6:
        main = f"<article>{inner}</article>"
    elif style < 0.7:
        main = f"<main>{inner}</main>"
    else:
        main = named("div", "main", inner, 0.1)
    if rng.random() < 0.3:
        main = named("div", "main", main, 0.3)
    before = "".join(extra(k) for k in ("notice", "head", "menu", "ad", "side", "form") if rng.random() < 0.4)
    after = "".join(extra(k) for k in ("ad", "comment", "side", "form", "notice", "menu") if rng.random() < 0.3)
    after += extra("foot") if rng.random() < 0.8 else ""
    if rng.random() < 0.08:  # nothing but the text
        before = after = ""
    if rng.random() < 0.1:  # columns of a table
        menu = rng.choice([links(rng.randint(2, 8)), f"<b>{prose(1, 2)}</b><br>" + "<br>".join(f'<a href="/{rng.choice(lexicon)}">{prose(1, 3)}</a>' for _ in range(rng.randint(2, 7)))])
        beside = rng.choice(["", f"<b>{rng.choice(['Weather', 'Related', 'News', 'Tip'])}</b><br>{prose(2, 12)}", f"<p>{prose(2, 15)}</p>" + links(2)])
        right = f"<td{rng.choice(['', ' width=120'])}>{beside}</td>" if beside else ""
        main = f"<table><tr><td{rng.choice(['', ' width=150'])}>{menu}</td><td>{main}</td>{right}</tr></table>"
    return f"<html><head><title>{title}</title><style>p{{}}</style></head><body>{before}{main}{after}</body></html>"


@lru_cache(1)
def trained(rounds: int = 800, pages: int = 24) -> Labeller:
    """The model, trained with Adam on made-up pages; the same each time."""
    rng, model = random.Random(2024), Labeller()
    mean = {k: np.zeros_like(v) for k, v in model.w.items()}
    square = {k: np.zeros_like(v) for k, v in model.w.items()}
    for r in range(1, rounds + 1):
        batch = [b for b in (blocks(sample_page(rng)) for _ in range(pages)) if b]
        x, lengths = padded([features([(t.lstrip(MAIN), *rest) for t, *rest in b]) for b in batch])
        y = np.zeros(x.shape[:2], np.float32)
        weight = np.zeros_like(y)
        for i, b in enumerate(batch):
            y[: len(b), i] = [t.startswith(MAIN) for t, *_ in b]
            weight[: len(b), i] = 1
        rate = 0.01 * (1 if r < rounds * 0.7 else 0.2)
        for k, g in model.step(x, lengths, y, weight).items():
            g = np.clip(g, -1, 1)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            model.w[k] = (model.w[k] - rate * (mean[k] / (1 - 0.9**r)) / (np.sqrt(square[k] / (1 - 0.99**r)) + 1e-6)).astype(np.float32)
    return model


def label(pages: list[list], model: Labeller) -> list[np.ndarray]:
    """Probabilities of main text for the blocks of several pages; pages of like length run in step."""
    out: list = [np.zeros(0)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    for lo in range(0, len(order), 128):
        part = order[lo : lo + 128]
        x, lengths = padded([features(pages[i]) for i in part])
        found = model.chances(x, lengths)
        for k, i in enumerate(part):
            out[i] = found[: lengths[k], k]
    return out


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", threshold: float = 0.5, keep_blocks: bool = False) -> DataFrame:
    """One row for each page: id, URL, main text, its code points and, if wanted, all blocks with their probabilities."""
    held = pages.sparkSession.sparkContext.broadcast(trained())  # some 10,000 weights
    kind = pages.schema[id_column].dataType.simpleString()
    block = pa.list_(pa.struct([("text", pa.string()), ("path", pa.string()), ("main", pa.float64())]))

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(2), 1 << 19):
                found = [blocks(bytes(x.as_buffer()).decode("utf-8", "replace")) if x.is_valid else [] for x in batch.column(2)[a:b]]
                chances = label(found, held.value)
                texts = [" ".join(t[0] for t, p in zip(f, c) if p >= threshold) for f, c in zip(found, chances)]
                columns = [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                names = [id_column, url_column, "text", "n_chars"]
                if keep_blocks:
                    columns.append(pa.array([[{"text": t[0], "path": t[1], "main": float(p)} for t, p in zip(f, c)] for f, c in zip(found, chances)], block))
                    names.append("blocks")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"{id_column} {kind}, {url_column} string, text string, n_chars long" + ", blocks array<struct<text:string,path:string,main:double>>" * keep_blocks
    return bounded(pages).select(F.col(id_column), F.col(url_column), F.col(html_column).cast("binary").alias("html")).mapInArrow(run, schema)
