"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read into leaf blocks: runs of text between the tags of block
elements. A block's features are its ancestors' tags, the words of their class,
id and role, and what its text is like. The field labels each block as main text
or not; it is trained on labelled pages and decoded by Viterbi. Labelled pages
are made pages of many layouts, whose labels are known, and at most
``SAMPLE_PAGES`` pages of the corpus that mark their article by an element.

Cases: a NULL or empty page, or one without text, has the empty text. Elements
left open end with the page; a tag that never ends is text. Repeated rows get
equal results. Empty tables give no rows. Pages are read whole, in time linear
in their length. Only the named columns of the input are read.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.llm.common import spread, table

#: Pages of the corpus used for training, at most, in the order of a hash of their addresses.
SAMPLE_PAGES = 200
MADE_PAGES = 400
BUCKETS = 1 << 13
EPOCHS = 8

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math".split())
#: Raw elements that may hold others of their name, and those that may end in their own tag.
NESTED, SELF_CLOSED = frozenset("template object svg math".split()), frozenset("svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr img ruby rb rt rp".split()
)
#: An opening tag that ends an open element of the same group.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf block: its text so far, the characters of it in links, and the names of its ancestors."""

    path: list[tuple[str, tuple[str, ...]]]
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _tag_end(page: str, start: int, missing: dict[str, int]) -> int:
    """Where the tag that begins at ``start`` ends; -1 if nowhere. Quoted values may hold ``>``."""
    at = start + 1
    while True:
        close = page.find(">", at) if start < missing.get(">", len(page) + 1) else -1
        if close < 0:
            missing[">"] = min(start, missing.get(">", start))
            return -1
        quote = min((q for q in (page.find('"', at, close), page.find("'", at, close)) if q >= 0), default=-1)
        if quote < 0 or page[quote - 1] not in "= \t\r\n\f":
            return close
        mark = page[quote]
        end = page.find(mark, quote + 1) if quote < missing.get(mark, len(page) + 1) else -1
        if end < 0:
            missing[mark] = min(quote, missing.get(mark, quote))
            return close
        at = end + 1


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page that hold text, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    current: Block | None = None
    links = 0
    missing: dict[str, int] = {}
    at = 0

    def add(text: str) -> None:
        nonlocal current
        if current is None:
            if not text.strip():
                return
            current = Block([x for x in stack if x[0] not in INLINE])
            found.append(current)
        text = html.unescape(text)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    while at < len(page):
        tag = page.find("<", at)
        if tag < 0:
            add(page[at:])
            break
        if tag > at:
            add(page[at:tag])
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = len(page) if end < 0 else end + 3
            continue
        closing = page.startswith("/", tag + 1)
        name_match = _NAME.match(page, tag + 1 + closing)
        if name_match is None:
            if page[tag + 1 : tag + 2] in ("!", "?", "/"):
                end = page.find(">", tag)
                at = len(page) if end < 0 else end + 1
            else:
                add("<")
                at = tag + 1
            continue
        end = _tag_end(page, tag, missing)
        if end < 0:
            add(page[tag:])
            break
        name = name_match.group().lower()
        at = end + 1
        if name not in INLINE:
            current = None
        if closing:
            names = [x[0] for x in stack]
            if name in names:
                cut = len(names) - 1 - names[::-1].index(name)
                # An inline end tag does not end block elements opened since.
                if name not in INLINE or all(n in INLINE for n in names[cut:]):
                    links -= sum(n == "a" for n in names[cut:])
                    del stack[cut:]
                else:
                    links -= name == "a"
                    del stack[cut]
            continue
        if name in RAW:
            if name in SELF_CLOSED and page[end - 1] == "/":
                continue
            # Where an end tag is missing, the last one there is ends the element.
            depth, last = 1, -1
            for mark in re.compile(f"<(/?){re.escape(name)}(?![\\w-])", re.I).finditer(page, at):
                opens = not mark.group(1)
                if opens and name not in NESTED:
                    continue
                stop = page.find(">", mark.end())
                if stop < 0:
                    break
                if opens:
                    depth += not (name in SELF_CLOSED and page[stop - 1] == "/")
                else:
                    depth, last = depth - 1, stop
                if not depth:
                    break
            at = len(page) if last < 0 else last + 1
            continue
        if name in VOID or page[end - 1] == "/" and name in INLINE:
            continue
        if name not in INLINE:
            for k in range(len(stack) - 1, -1, -1):
                above = stack[k][0]
                if above == "p" or above in CLOSES.get(name, ()):
                    links -= sum(n == "a" for n, _ in stack[k:])
                    del stack[k:]
                    break
                if above not in INLINE and above not in ("p",):
                    break
        attributes = page[name_match.end() : end]
        words = tuple(
            w for _, value in _ATTRIBUTE.findall(attributes) for w in _WORDS.findall(value.lower())
        ) if "=" in attributes else ()
        stack.append((name, words))
        links += name == "a"
    return [b for b in found if b.text]


def features(page_blocks: list[Block]) -> list[np.ndarray]:
    """The hashed features of every block of a page."""
    rows = []
    for i, block in enumerate(page_blocks):
        text = block.text
        words = text.split(" ")
        link = min(block.linked, len(text)) / len(text)
        tags = [t for t, _ in block.path]
        named = [f"in {t}" for t in set(tags)] + [f"class {w}" for _, ws in block.path for w in ws]
        named += [
            f"leaf {tags[-1] if tags else ''}", f"words {min(len(words), 64).bit_length()}", f"links {int(link * 4)}",
            f"stop {text[-1] in '.!?…'}", f"sign {'©' in text or '|' in text}", f"first {i == 0}",
            f"last {i == len(page_blocks) - 1}", f"words links {min(len(words), 64).bit_length()} {link > 0.5}", "any",
        ]
        rows.append(np.unique([zlib.crc32(n.encode()) % BUCKETS for n in named]))
    return rows


@dataclass
class Field:
    """Weights of a chain with labels 0 (other) and 1 (main text)."""

    unary: np.ndarray
    pair: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.stack([self.unary[r].sum(axis=0) for r in rows])

    def decode(self, rows: list[np.ndarray]) -> list[int]:
        """The best labelling, by Viterbi; a tie goes to the lower label."""
        score = self.scores(rows).tolist()
        (p00, p01), (p10, p11) = self.pair.tolist()
        a, b = score[0]
        came = []
        for s0, s1 in score[1:]:
            from0, from1 = (0 if a + p00 >= b + p10 else 1), (0 if a + p01 >= b + p11 else 1)
            came.append((from0, from1))
            a, b = s0 + max(a + p00, b + p10), s1 + max(a + p01, b + p11)
        label = 0 if a >= b else 1
        path = [label]
        for step in reversed(came):
            label = step[label]
            path.append(label)
        return path[::-1]

    def marginals(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each block's label and the expected transitions, by forward-backward."""
        score = self.scores(rows)
        n = len(score)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[0] = score[0]
        for i in range(1, n):
            forward[i] = score[i] + np.logaddexp(*(forward[i - 1][:, None] + self.pair))
        for i in range(n - 2, -1, -1):
            backward[i] = np.logaddexp(*(self.pair + score[i + 1] + backward[i + 1]).T)
        total = np.logaddexp(*forward[-1])
        steps = forward[:-1, :, None] + self.pair + (score[1:] + backward[1:])[:, None, :] - total
        return np.exp(forward + backward - total), np.exp(steps).sum(axis=0)


def train_field(pages: list[tuple[list[np.ndarray], list[int]]], seed: int = 3) -> Field:
    """A field fitted to labelled pages by stochastic gradient ascent of their likelihood (AdaGrad, small decay)."""
    model = Field(np.zeros((BUCKETS, 2)), np.zeros((2, 2)))
    seen, seen_pair = np.full((BUCKETS, 2), 1e-2), np.full((2, 2), 1e-2)
    rng = random.Random(seed)
    order = list(range(len(pages)))
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for k in order:
            rows, truth = pages[k]
            p, steps = model.marginals(rows)
            gap = np.eye(2)[truth] - p
            grad = np.zeros((BUCKETS, 2))
            np.add.at(grad, np.concatenate(rows), np.repeat(gap, [len(r) for r in rows], axis=0))
            touched = np.unique(np.concatenate(rows))
            grad = grad[touched] - 1e-3 * model.unary[touched]
            seen[touched] += grad**2
            model.unary[touched] += 0.5 * grad / np.sqrt(seen[touched])
            true_steps = np.zeros((2, 2))
            np.add.at(true_steps, (truth[:-1], truth[1:]), 1)
            step = true_steps - steps - 1e-3 * model.pair
            seen_pair += step**2
            model.pair += 0.5 * step / np.sqrt(seen_pair)
    return model


#: Names that layouts give to parts that are main text, and to parts that are not.
MAIN_NAMES = "content main article post entry story text body single prose".split()
OTHER_PARTS = {
    "nav": "nav menu navbar navigation topnav breadcrumb pagination toc".split(),
    "header": "header masthead topbar branding logo site banner".split(),
    "footer": "footer bottom copyright colophon legal credits".split(),
    "aside": "sidebar aside widget related recommended popular tags promo".split(),
    "div": "ad ads advert advertisement sponsor sponsored cookie consent notice alert banner popup newsletter share social".split(),
    "section": "comments comment respond replies discussion reader reply".split(),
    "form": "form search subscribe login signup contact newsletter".split(),
}


def made_page(rng: random.Random) -> tuple[str, str]:
    """A page of a random layout, with every main block's text begun by ``mainmark``."""
    def prose(low: int, high: int) -> str:
        words = ["".join(rng.choice("aeioubdglmnrst") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(low, high))]
        return " ".join(words).capitalize() + rng.choice((".", ".", ".", "", "!"))

    def named(names: list[str]) -> str:
        return f' {rng.choice(("class", "class", "id"))}="{rng.choice(names)}{rng.choice(("", "-box", " wide", "_area"))}"'

    def other(kind: str) -> str:
        tag = kind if rng.random() < 0.7 else "div"
        head = f"<{tag}{named(OTHER_PARTS[kind]) if tag == 'div' or rng.random() < 0.5 else ''}>"
        if kind in ("nav", "header", "aside"):
            inner = "<ul>" + "".join(f'<li><a href="/x">{prose(1, 4)}</a></li>' for _ in range(rng.randint(2, 7))) + "</ul>"
            inner = inner if kind != "header" else f"<h1>{prose(1, 3)}</h1>" + inner
        elif kind == "form":
            inner = f"<label>{prose(1, 3)}</label><button>{prose(1, 2)}</button>"
        elif kind == "section":
            inner = f"<h3>{prose(1, 2)}</h3>" + "".join(f'<div class="comment"><p>{prose(3, 40)}</p></div>' for _ in range(rng.randint(1, 4)))
        elif kind == "footer":
            inner = f"<p>&copy; {prose(2, 12)}</p>"
        else:
            inner = rng.choice(("<p>%s</p>", "%s")) % prose(3, 25)
        return head + inner + f"</{tag}>"

    def main() -> str:
        tag = rng.choice(("article", "article", "main", "div", "section"))
        inner = f"<h1>mainmark {prose(2, 9)}</h1>"
        for _ in range(rng.randint(2, 12)):
            kind = rng.random()
            if kind < 0.75:
                inner += f"<p>{'<b>' * (rng.random() < 0.2)}mainmark {prose(1, 90)}{rng.choice(('</p>', '</p>', '<br>'))}"
            elif kind < 0.85:
                inner += f"<h2>mainmark {prose(1, 6)}</h2>"
            elif kind < 0.93:
                inner += "<ul>" + "".join(f"<li>mainmark {prose(2, 14)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>"
            else:
                inner += f"<blockquote>mainmark {prose(3, 30)}</blockquote>"
            if rng.random() < 0.08:
                inner += other(rng.choice(("aside", "div", "form")))
        if rng.random() < 0.3:
            inner += other("section")
        return f"<{tag}{named(MAIN_NAMES) if tag in ('div', 'section') or rng.random() < 0.4 else ''}>{inner}</{tag}>"

    before = [other(k) for k in ("header", "nav", "div") if rng.random() < 0.7]
    after = [other(k) for k in ("section", "aside", "form", "div", "footer") if rng.random() < 0.6]
    rng.shuffle(before)
    return f"<html><head><title>{prose(2, 8)}</title></head><body>{''.join(before)}{main()}{''.join(after)}</body></html>"


def labelled(page_blocks: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article by an element; None for other pages."""
    tags = [[t for t, _ in b.path] for b in page_blocks]
    article = "article" if any("article" in t for t in tags) else "main"
    other = {"nav", "aside", "footer", "form"} | ({"header"} if article == "main" else set())
    names = {w for kind, words in OTHER_PARTS.items() for w in words}
    truth = [
        int(article in t and not other & set(t) and not any(w in names for _, ws in b.path for w in ws))
        for b, t in zip(page_blocks, tags)
    ]
    return truth if any(truth) else None


def training_pages(sample: list[str], seed: int = 5) -> list[tuple[list[np.ndarray], list[int]]]:
    rng = random.Random(seed)
    found = []
    for _ in range(MADE_PAGES):
        page_blocks = blocks(made_page(rng))
        truth = [int(b.text.startswith("mainmark")) for b in page_blocks]
        for b in page_blocks:
            b.parts = [p.replace("mainmark ", "") for p in b.parts]
        kept = [(b, t) for b, t in zip(page_blocks, truth) if b.text]
        found.append((features([b for b, _ in kept]), [t for _, t in kept]))
    for page in sample:
        page_blocks = blocks(page)
        truth = labelled(page_blocks) if page_blocks else None
        if truth:
            found.append((features(page_blocks), truth))
    return found


def main_text(page: str | None, model: Field) -> str:
    page_blocks = blocks(page) if page else []
    if not page_blocks:
        return ""
    labels = model.decode(features(page_blocks))
    return "\n".join(b.text for b, label in zip(page_blocks, labels) if label)


def extract(pages: DataFrame, model: Field) -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["page_id", "url"]].assign(text=[main_text(p, model) for p in batch["html"]])

    return spread(pages.select("page_id", "url", "html")).mapInPandas(run, "page_id bigint, url string, text string")


def train(pages: DataFrame, limit: int = SAMPLE_PAGES) -> Field:
    """A field trained on made pages and on at most ``limit`` pages of the corpus."""
    usable = pages.where("html is not null and page_id is not null")
    picked = usable.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(limit)
    # At most ``limit`` ids, so they may be broadcast.
    rows = usable.select("page_id", "html").join(F.broadcast(picked), "page_id", "left_semi")
    sample = rows.groupBy("page_id").agg(F.min("html").alias("html")).orderBy("page_id").collect()
    return train_field(training_pages([r["html"] for r in sample]))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract(pages, train(pages))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
