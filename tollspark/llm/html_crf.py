"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into leaf blocks, the runs of text between block-level tags, each with its open ancestors. Features of a
block are its ancestors' tags and the words of their class and id attributes, its parent, its link share, length,
punctuation and place; the labels are main text or not. Weights are learned from labelled pages by gradient ascent on
the conditional log-likelihood (forward-backward in numpy, all pages at once), and pages are decoded by Viterbi.

There is no table of labelled pages, so `labelled_pages` makes them from the pages themselves: from a bounded sample,
pages with one `article` or `main` are labelled by their markup, and their blocks are laid out again in pages of other
make (plain containers with class names, side columns, notices, forms, reader comments and so on), with known labels.

Scripts, styles and other content that is not shown never make blocks. Character references are decoded, white space in
a block becomes one space. A null or empty page has an empty text; pages that break off or nest tags wrongly are read as
far as they go.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollspark.llm.common import batches_with, column, widened

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)"
                    r"|</?([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
# Elements by their meaning in HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style template noscript textarea title iframe svg math select object canvas".split())
_INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                    "strong sub sup time tt u var wbr img br input button".split())
_CLOSED_BY = {"p": frozenset("p div section article ul ol table h1 h2 h3 h4 h5 h6 header footer nav aside form main "
                             "blockquote pre figure dl hr".split()),
              "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
              "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
              "option": frozenset(["option"])}


@dataclass
class Block:
    text: str
    path: list[tuple[str, tuple[str, ...]]]  # open elements: tag, words of class, id and role
    linked: int                              # code points inside links


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks in page order. Only block-level tags end a block."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    buffer: list[str] = []
    linked = 0
    page = page or ""

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                out.append(Block(text, list(stack), linked))
            buffer.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            buffer.append(text)
            if any(tag == "a" for tag, _ in stack):
                linked += len(text.strip())

    at = 0
    while True:
        found = _TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at:found.start()])
        at = found.end()
        tag = (found[1] or found[4] or "").lower()
        if not tag:
            continue
        if not (found[3] or found[6]):
            break  # the page ends inside a tag
        inline = tag in _INLINE
        if found[0][1] == "/":
            if any(name == tag for name, _ in stack):
                if not inline:
                    flush()
                while stack and stack.pop()[0] != tag:
                    pass
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in ("br", "img"):
            buffer.append(" ")
        if not inline:
            flush()
            while stack and (tag in _CLOSED_BY.get(stack[-1][0], ()) or stack[-1][0] in _INLINE
                             and any(tag in _CLOSED_BY.get(name, ()) for name, _ in stack)):
                stack.pop()
        attributes = found[2] or found[5] or ""
        if tag not in _VOID and not attributes.endswith("/"):
            words = tuple(word for name in _ATTRIBUTE.findall(attributes)
                          for word in _PART.findall("".join(name[1:]).lower()))
            stack.append((tag, words))
    flush()
    return out


def features_of(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that each block has."""
    out = []
    for i, block in enumerate(blocks):
        text, n = block.text, len(block.text)
        tags = [tag for tag, _ in block.path if tag not in ("html", "body")]
        own = {f"in:{tag}" for tag in tags} | {f"is:{word}" for _, words in block.path for word in words}
        own.add(f"parent:{tags[-1] if tags else ''}")
        own.add(f"inner:{next((t for t in reversed(tags) if t not in _INLINE), '')}")
        share = block.linked / n
        own.add(f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.9 else 3}")
        own.add(f"length:{min(n.bit_length(), 11)}")
        own.add(f"ends:{text[-1] in '.!?…:»”\"'}")
        own.add(f"stops:{min(sum(map(text.count, '.!?,')), 4)}")
        if text[0] in "©" or "©" in text:
            own.add("copyright")
        own.add(f"place:{'first' if i == 0 else 'last' if i + 1 == len(blocks) else 'inside'}")
        out.append(sorted(own))
    return out


@dataclass
class Crf:
    """Weights: features x 2 labels, and 2 x 2 transitions."""

    names: dict[str, int]
    unary: np.ndarray
    step: np.ndarray

    def decode(self, features: list[list[str]]) -> list[int]:
        """The best labelling, by Viterbi."""
        if not features:
            return []
        known = self.names
        scores = [self.unary[[known[f] for f in own if f in known]].sum(axis=0).tolist() for own in features]
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = scores[0]
        back = []
        for x, y in scores[1:]:
            from_a, from_b = a + s01 > b + s11, a + s00 >= b + s10
            back.append((0 if from_b else 1, 0 if from_a else 1))
            a, b = max(a + s00, b + s10) + x, max(a + s01, b + s11) + y
        label = 0 if a >= b else 1
        out = [label]
        for choice in reversed(back):
            label = choice[label]
            out.append(label)
        return out[::-1]

    def extract(self, page: str | None) -> str:
        blocks = blocks_of(page)
        labels = self.decode(features_of(blocks))
        return " ".join(block.text for block, label in zip(blocks, labels, strict=True) if label)


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 200, rate: float = 0.1,
          ridge: float = 1e-3, rarest: int = 3) -> Crf:
    """Maximise the conditional log-likelihood of (features per block, label per block) by Adam."""
    pages = [page for page in pages if page[0]]
    seen = Counter(name for features, _ in pages for own in features for name in own)
    names = {name: i for i, name in enumerate(sorted(name for name, n in seen.items() if n >= rarest))}
    deep, wide = max((len(labels) for _, labels in pages), default=1), len(pages)
    x = np.zeros((max(wide, 1), deep, len(names) + 1), dtype=np.float32)
    y, mask = np.zeros((max(wide, 1), deep), dtype=np.int64), np.zeros((max(wide, 1), deep), dtype=bool)
    for i, (features, labels) in enumerate(pages):
        for j, own in enumerate(features):
            x[i, j, [names[name] for name in own if name in names]] = 1
        y[i, :len(labels)], mask[i, :len(labels)] = labels, True
    flat = x.reshape(-1, x.shape[2])
    gold = np.eye(2)[y] * mask[..., None]
    pairs = mask[:, 1:] & mask[:, :-1]
    gold_step = np.array([[np.sum(pairs & (y[:, :-1] == a) & (y[:, 1:] == b)) for b in (0, 1)] for a in (0, 1)], float)
    weights = [np.zeros((x.shape[2], 2)), np.zeros((2, 2))]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for turn in range(1, rounds + 1):
        unary = (flat @ weights[0].astype(np.float32)).reshape(*y.shape, 2).astype(float)
        expected, expected_step = _marginals(unary, weights[1], mask)
        slope = [flat.T @ (gold - expected).reshape(-1, 2).astype(np.float32) / max(wide, 1) - ridge * weights[0],
                 (gold_step - expected_step) / max(wide, 1) - ridge * weights[1]]
        for w, g, m, v in zip(weights, slope, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w += rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)
    return Crf(names, weights[0][:-1], weights[1])


def _marginals(unary: np.ndarray, step: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected labels of every block and expected transitions, by forward-backward in log space."""
    ahead, behind = unary.copy(), np.zeros_like(unary)
    deep = unary.shape[1]
    for t in range(1, deep):
        reach = np.logaddexp.reduce(ahead[:, t - 1, :, None] + step, axis=1)
        ahead[:, t] = np.where(mask[:, t, None], reach + unary[:, t], ahead[:, t - 1])
    for t in range(deep - 2, -1, -1):
        reach = np.logaddexp.reduce(step + (unary[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
        behind[:, t] = np.where(mask[:, t + 1, None], reach, 0)
    norm = np.logaddexp.reduce(ahead[:, -1], axis=1)
    labels = np.exp(np.clip(ahead + behind - norm[:, None, None], -50, 0)) * mask[..., None]
    both = (ahead[:, :-1, :, None] + step + (unary[:, 1:] + behind[:, 1:])[:, :, None, :] - norm[:, None, None, None])
    return labels, (np.exp(np.clip(both, -50, 0)) * (mask[:, 1:] & mask[:, :-1])[..., None, None]).sum(axis=(0, 1))


# Elements and class words that name parts of pages which are no main text.
_NOT_MAIN = frozenset("nav footer aside form header menu button dialog".split())
_ASIDE = {
    "nav": ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar", "toolbar", "pagination", "pager"],
    "header": ["header", "masthead", "branding", "site-header", "logo", "tagline", "banner"],
    "footer": ["footer", "site-footer", "copyright", "colophon", "legal", "bottom"],
    "aside": ["sidebar", "side", "widget", "related", "recommended", "popular", "trending", "teaser", "more", "links", "rail"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "promotion", "adbox", "banner-ad"],
    "notice": ["notice", "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "overlay", "disclaimer",
               "privacy", "warning", "paywall", "newsletter", "subscribe", "signup"],
    "form": ["form", "search", "login", "contact", "subscribe-form"],
    "comments": ["comments", "comment", "comment-list", "reply", "replies", "responses", "discussion", "disqus",
                 "reader-comments", "feedback", "reviews"],
    "share": ["share", "social", "sharing", "tags", "meta", "byline", "author", "print", "follow"],
}
_MAIN = ["content", "article", "post", "entry", "entry-content", "post-content", "article-body", "story", "text", "body",
         "main", "main-content", "page-content", "single"]


def _markup_labels(blocks: list[Block]) -> list[int] | None:
    """1 inside the page's `article` or `main` and in no part that is named otherwise; None without such an element."""
    aside = {word for words in _ASIDE.values() for word in words}
    labels = []
    for block in blocks:
        tags = [tag for tag, _ in block.path]
        named = any(word in aside for _, words in block.path for word in words)
        labels.append(int(("article" in tags or "main" in tags) and not named and not _NOT_MAIN.intersection(tags)))
    return labels if any(labels) else None


def _relaid(texts: list[str], pool: list[str], links: list[str], pick: random.Random) -> list[tuple[str, int]]:
    """A page of another make: (markup, label of the block in it or -1) in order. `texts` are its main blocks."""
    out: list[tuple[str, int]] = []

    def put(markup: str, label: int = -1) -> None:
        out.append((markup, label))

    def said(label: int, text: str, tag: str) -> None:
        put(f"<{tag}>")
        put(html.escape(text), label)
        put(f"</{tag}>")

    def attribute(word: str) -> str:
        return f' {pick.choice(["class", "class", "id"])}="{word}"'

    def menu(n: int) -> None:
        put("<ul>")
        for _ in range(n):
            put(f'<li><a href="/{pick.randrange(999)}">')
            put(html.escape(pick.choice(links)), 0)
            put("</a></li>")
        put("</ul>")

    def part(kind: str) -> None:
        word = attribute(pick.choice(_ASIDE[kind]))
        element = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, "div")
        # Half of the parts are told by their element, half by their class, some by both.
        element, word = pick.choice([(element, word), ("div", word), ("section", word), (element, "")]) \
            if element != "div" else (pick.choice(["div", "section", "p", "aside"]), word)
        put(f"<{element}{word}>")
        if kind in ("nav", "aside") and pick.random() < 0.7 or kind == "share":
            menu(pick.randrange(1, 7))
        elif kind == "comments" and element != "p":
            for _ in range(pick.randrange(1, 5)):
                said(0, pick.choice(pool), pick.choice(["p", "p", "div", "li", "blockquote"]))
        elif kind == "form":
            for _ in range(pick.randrange(1, 4)):
                put("<label>")
                put(html.escape(pick.choice(links if pick.random() < 0.6 else pool)), 0)
                put("</label><input type=text><br>") if pick.random() < 0.5 else put("</label><p></p>")
        elif kind == "header" and pick.random() < 0.5:
            said(0, pick.choice(links), pick.choice(["h1", "h2", "p", "div"]))
        elif pick.random() < 0.5 and element != "p":
            said(0, pick.choice(pool), pick.choice(["p", "div", "span", "small", "h3"]))
        else:
            put(html.escape(("© " if kind == "footer" and pick.random() < 0.6 else "") + pick.choice(pool)), 0)
        put(f"</{element}>")

    def some(kinds: list[str], most: int) -> None:
        for kind in pick.sample(kinds, pick.randrange(0, most + 1)):
            part(kind)

    put("<html><body>")
    some(["header", "nav", "notice", "ad", "nav"], 4)
    if pick.random() < 0.3:
        put(f"<div{attribute(pick.choice(['page', 'wrapper', 'container', 'layout', 'row']))}>")
    if pick.random() < 0.2:
        part("aside")
    opened = pick.choice(["article", "article", "main", "main><article", "div", "div", "section", "td"])
    word = attribute(pick.choice(_MAIN)) if opened in ("div", "section", "td") or pick.random() < 0.4 else ""
    put(f"<{opened}{word}>")
    for i, text in enumerate(texts):
        head = i == 0 and pick.random() < 0.8
        wrapped = head and pick.random() < 0.15
        said(1, text, pick.choice(["h1", "h1", "h2"]) if head else
             pick.choices(["p", "h2", "li", "blockquote", "div", "pre", "td"], [20, 2, 2, 1, 2, 0.5, 0.5])[0])
        if wrapped and pick.random() < 0.5:
            part("share")
        if pick.random() < 0.12:
            part(pick.choice(["ad", "aside", "share", "notice", "form"]))
    if pick.random() < 0.3:
        part("comments")
    put(f"</{opened.split('><')[-1]}>")
    some(["comments", "aside", "share", "ad", "form", "notice"], 3)
    some(["footer", "nav", "notice"], 2)
    return out


def labelled_pages(pages: list[str], copies: int = 3, seed: int = 7) -> list[tuple[list[list[str]], list[int]]]:
    """Labelled pages from raw ones: each by its own markup and `copies` times in another make."""
    pick, out = random.Random(seed), []
    read = [(blocks, labels) for blocks in map(blocks_of, pages) if (labels := _markup_labels(blocks))]
    pool = [block.text for blocks, labels in read for block, label in zip(blocks, labels, strict=True)
            if len(block.text) < 600]
    links = [text[:40].rsplit(" ", 1)[0] for text in pool] or ["home"]
    for blocks, labels in read:
        if len(blocks) > 80:
            continue  # a training page is padded to the longest; decoding has no such bound
        out.append((features_of(blocks), labels))
        main = [block.text for block, label in zip(blocks, labels, strict=True) if label]
        for _ in range(copies):
            laid = _relaid(main[:pick.randrange(1, 30)], pool, links, pick)
            # Markup and labels are put together by marks that the parser keeps in the text.
            marked = "".join(f"{text}\x02{label}\x03" if label >= 0 else text for text, label in laid)
            found = blocks_of(marked)
            told = [[int(x) for x in re.findall("\x02(\\d)\x03", block.text)] for block in found]
            for block in found:
                block.text = " ".join(re.sub("\x02\\d\x03", "", block.text).split()) or "."
            if all(told):
                out.append((features_of(found), [max(x) for x in told]))
    return out


def fit(pages: DataFrame, sample: int = 300, longest: int = 50_000) -> Crf:
    """Train on at most `sample` pages (page_id, html), drawn in the order of a hash of the page, of at most `longest`
    code points each; both bounds concern training only."""
    rows = pages.select("html", F.xxhash64("html").alias("h")).where(F.length("html").between(1, longest))
    # The hashes are drawn first and alone: ordering whole pages would send a sample from every task to the driver.
    chosen = rows.select("h").distinct().orderBy("h").limit(sample).collect()
    chosen = F.broadcast(pages.sparkSession.createDataFrame([(row.h,) for row in chosen], "h long"))
    drawn = rows.join(chosen, "h", "left_semi").groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect()
    return train(labelled_pages([row.html for row in drawn]))


def extract(pages: DataFrame, model: Crf, keep: list[str]) -> DataFrame:
    """The columns `keep` of every row with the main text of its html as `text`."""
    held = pages.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> dict:
        return {"text": pa.array([held.value.extract(page) for page in column(batch, "_html")], pa.string())}

    return pages.select(*keep, F.col("html").alias("_html")).mapInArrow(
        lambda batches: batches_with(batches, keep, make), widened(pages, keep, "text string"))
