"""Main text of web pages, with a host suffix array for text that markup does not settle.

A page is read into blocks.  Markup and the host suffix order decide about
them together.  Markup tells text inside an ``article`` or ``main`` element
from text in menus, headers, footers, sidebars, notices, adverts, forms and
comments.  The token streams of a host's distinct pages are laid end to end,
their suffixes are ordered by host and first ``run`` tokens, and neighbours in
that order that agree there and stand on different pages are repeats.

* Pages without such an element: all suffixes are taken, and tokens that a
  repeat covers are boilerplate; unique runs stay.
* Pages with one: the suffixes that begin a block of it are taken, to the end
  of the block in which they have ``run`` tokens.  What stands so on more than
  half of the host's distinct pages (three at least) is a notice, and goes.
  Fewer copies are no evidence there: headings, quoted and syndicated passages
  repeat as well.  Nor are they where they make up more than half of the
  words, for then the article itself has copies.

The suffix order is kept to that depth only: suffixes that agree in fewer
tokens are never asked for, so ordering by a hash of the first ``run`` tokens
brings the same suffixes together, and the group's least and greatest page
tell whether two pages share it.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import column, written
from .kernels import Powers, word_spans

# Element names, and words in class, id and role that mark page furniture.
RAW = {"script", "style", "noscript", "template", "svg", "textarea", "iframe", "title", "object", "canvas", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "rt", "rp"}
FURNITURE = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset"}
HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
         "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "masthead", "menu", "modal", "nav",
         "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "related", "share", "sharing",
         "sidebar", "social", "sponsor", "sponsored", "subscribe", "complementary", "contentinfo", "search", "alert"}
#: Hints of page parts that may hold a ``main`` of their own, as reader comments and adverts do.
NEVER_MAIN = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "disqus", "footer",
              "contentinfo", "related", "sponsor", "sponsored", "promo", "complementary"}
#: Classes that tell what a page has or is (``has-sidebar``, ``search-page``), not what an element is.
STATE_FIRST, STATE_LAST = {"has", "with", "no", "is", "without", "page"}, {"page", "layout", "template", "open", "enabled"}
MAIN = {"article", "main"}
START = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/<>]*+)")
INSIDE = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true", re.I)
BLANK = re.compile(r"\s+")
NONE, SOFT, HARD = 0, 1, 2


def _furniture(name: str, attributes: str, inside: bool) -> int:
    """Whether an element is page furniture: HARD if whatever it holds is, SOFT if a ``main`` in it is not."""
    if name in FURNITURE or name == "header" and not inside:
        return HARD
    if not attributes or name in MAIN or name in ("html", "body"):
        return NONE
    said = set()
    for token in " ".join("".join(m) for m in ATTRIBUTE.findall(attributes)).lower().split():
        words = [w for w in re.split(r"[^a-z]+", token) if w]
        if words and not (len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST)):
            said.update(words)
    if HIDDEN.search(attributes) or NEVER_MAIN & said:
        return HARD
    return SOFT if HINTS & said else NONE


class Tags:
    """Comments, declarations and tags of a page in order, in time linear in its length whatever it holds."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.ends = None

    def _end(self, at: int) -> int:
        """End of a tag whose attributes begin at ``at``: after the first ``>`` outside quotes, or -1."""
        if self.ends is None:
            found = INSIDE.match(self.page, at)
            if found:
                return found.end()
            # one tag without an end: from here on by a table of all ends, made once
            marks = [(m.start(), m[0]) for m in re.finditer("[>\"']", self.page)]
            self.places, self.ends = [x for x, _ in marks], [-1] * (len(marks) + 1)
            after = {'"': len(marks), "'": len(marks)}  # the next quote of each kind
            for k in range(len(marks) - 1, -1, -1):
                x, mark = marks[k]
                self.ends[k] = x + 1 if mark == ">" else self.ends[min(after[mark] + 1, len(marks))]
                if mark != ">":
                    after[mark] = k
        return self.ends[bisect_left(self.places, at)]

    def __iter__(self):
        """(start, end, closing, name, attributes); an empty name for what is no tag."""
        page, at = self.page, 0
        while (found := START.search(page, at)) is not None:
            begin, at = found.start(), found.end()
            if found[0] != "<!--" and begin > self.last:  # nothing but a comment can follow
                at = page.find("<!--", begin + 1)
                if at < 0:
                    return
            elif found[0] == "<!--":
                end = page.find("-->", at)
                at = len(page) if end < 0 else end + 3
                yield begin, at, False, "", ""
            elif found[2] is None:
                at = page.index(">", at) + 1
                yield begin, at, False, "", ""
            elif (end := self._end(at)) >= 0:
                name, closing, attributes = found[2].lower(), bool(found[1]), page[at: end - 1]
                at = end
                if name in RAW and not closing and not attributes.endswith("/"):
                    close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at, self.last + 1)
                    at = close.end() if close else len(page)
                yield begin, at, closing, name, attributes


def page_blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, in a main element, in page furniture) for each non-empty block in page order."""
    page = page or ""
    out: list[tuple[str, bool, bool]] = []
    held: list[str] = []
    # open elements: name, furniture, and what was soft around a main; places of the block elements among them
    stack: list[tuple[str, int, int]] = []
    blocks: list[int] = []
    names: Counter = Counter()
    inside = hard = soft = at = 0

    def flush():
        if held:
            text = BLANK.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                out.append((text, inside > 0, hard + soft > 0))

    def opened(name: str, kind: int):
        nonlocal inside, hard, soft
        around = 0
        if name in MAIN:
            inside += 1
            if name == "main" and not hard:  # what only wraps the main part is no furniture
                around, soft = soft, 0
        if name not in INLINE:
            blocks.append(len(stack))
        stack.append((name, kind, around))
        names[name] += 1
        hard += kind == HARD
        soft += kind == SOFT

    def closed(k: int):
        """Close the element at ``k`` and all in it."""
        nonlocal inside, hard, soft
        while len(stack) > k:
            name, kind, around = stack.pop()
            names[name] -= 1
            inside -= name in MAIN
            hard -= kind == HARD
            soft += around - (kind == SOFT)
        while blocks and blocks[-1] >= k:
            blocks.pop()

    for begin, end, closing, name, attributes in Tags(page):
        held.append(page[at: begin])
        at = end
        if not name:
            continue
        if name in RAW:
            if name not in INLINE:
                held.append(" ")
            continue
        if name == "br":
            held.append(" ")
            continue
        kind = NONE if closing else _furniture(name, attributes, inside > 0)
        if name in INLINE and not closing and not kind:
            if name not in VOID:
                opened(name, NONE)
            continue
        if name not in INLINE:
            flush()
        if not closing:
            if name in VOID:
                continue
            k = blocks[-1] if blocks else -1
            if k >= 0 and (stack[k][0] == "p" or stack[k][0] == name == "li"):  # their end tags may be left out
                closed(k)
            if kind:
                flush()
            opened(name, kind)
            continue
        if names[name]:
            k = len(stack) - 1
            while stack[k][0] != name:
                k -= 1
            if any(kind for _, kind, _ in stack[k:]):
                flush()
            closed(k)
    held.append(page[at:])
    flush()
    return out


def _block_suffixes(blocks: list[str], run: int, powers: Powers) -> tuple[list[int], list[int]]:
    """Of each block the hash of the stream from there to the first block end after ``run`` tokens, and that block's number.

    A stream that ends before has no such suffix: its block's number is -1.
    """
    tokens, block = _tokens(blocks, powers)
    prefix = powers.sums(tokens)
    begins = np.searchsorted(block, np.arange(len(blocks)))
    enough = begins + run <= len(tokens)
    last = np.where(enough, block[np.minimum(begins + run, len(tokens)) - 1] if len(tokens) else 0, -1)
    ends = np.append(begins, len(tokens))[np.where(enough, last + 1, 0)]
    hashed = powers.spans(prefix, begins, np.maximum(begins, ends))
    return hashed.view(np.int64).tolist(), last.tolist()


def _parsed(trust_markup: bool, run: int):
    def parse(frames):
        powers = Powers()
        for frame in frames:
            rows = []
            for page in frame.html:
                blocks = page_blocks(page)
                content = [t for t, main, bad in blocks if main and not bad]
                if trust_markup and content:
                    others = [t for t, main, _ in blocks if not main]
                    rows.append(("\n\n".join(content), others, [False] * len(others), *_block_suffixes(content, run, powers)))
                else:
                    keep = [not bad or not trust_markup for _, _, bad in blocks]
                    rows.append((None, [t for t, _, _ in blocks], keep, None, None))
            names = ["text", "blocks", "open", "suffixes", "reach"]
            made = pd.DataFrame(rows, columns=names, dtype=object, index=frame.index)
            yield pd.concat([frame[["page_id", "url", "host", "page_key"]], made], axis=1)
    return parse


def _suffixes(length: int):
    def run(frames):
        powers = Powers()
        for frame in frames:
            for host, key, blocks in zip(frame.host, frame.page_key, frame.blocks):
                tokens = _tokens(blocks, powers)[0]
                n = len(tokens) - length + 1
                if n > 0:
                    hashed = np.zeros(n, np.uint64)
                    for k in range(length):
                        hashed = hashed * np.uint64(0x100000001B3) + tokens[k: n + k]
                    yield pd.DataFrame({"host": host, "page_key": key, "suffix": hashed.view(np.int64),
                                        "at": np.arange(n, dtype=np.int32)})
    return run


def _tokens(blocks, powers):
    """Token hashes of a page's stream, and the block of each token."""
    parts = [b.encode("utf-8", "surrogatepass") for b in blocks]
    buf = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    a, b = word_spans(buf)
    starts = np.cumsum([0] + [len(p) + 1 for p in parts])
    return powers.spans(powers.prefix(buf), a, b), np.searchsorted(starts, a, side="right") - 1


def _unique_runs(length: int):
    def run(frames):
        powers = Powers()
        for frame in frames:
            texts = []
            for blocks, keep, repeats in zip(frame.blocks, frame.open, frame.repeats):
                tokens, block = _tokens(blocks, powers)
                covered = np.zeros(len(tokens) + 1, np.int32)
                if repeats is not None and len(repeats):
                    np.add.at(covered, np.asarray(repeats), 1)
                    np.add.at(covered, np.minimum(np.asarray(repeats) + length, len(tokens)), -1)
                free = np.cumsum(covered)[:-1] == 0
                kept = []
                for i, (text, ok) in enumerate(zip(blocks, keep)):
                    mine = free[block == i]
                    if ok and mine.all():
                        kept.append(text)
                    elif ok and mine.any():
                        words = [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]
                        kept.append(" ".join(w for w, f in zip(words, mine) if f))
                texts.append("\n\n".join(t for t in kept if t))
            frame["text"] = texts
            yield frame[["page_id", "url", "text"]]
    return run


def _without_notices(frames):
    for frame in frames:
        texts = []
        for text, suffixes, reach, common in zip(frame.text, frame.suffixes, frame.reach, frame.common):
            blocks, common = text.split("\n\n"), set(common)
            covered = [False] * len(blocks)
            for k, (suffix, last) in enumerate(zip(suffixes, reach)):
                if last >= 0 and suffix in common:
                    covered[k: last + 1] = [True] * (last + 1 - k)
            n_words = [len(b.split()) for b in blocks]
            if 2 * sum(n for n, c in zip(n_words, covered) if c) <= sum(n_words):
                text = "\n\n".join(b for b, c in zip(blocks, covered) if not c)
            texts.append(text)
        frame["text"] = texts
        yield frame[["page_id", "url", "text"]]


def main_text(df: DataFrame, run: int = 8, trust_markup: bool = True) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``df`` (page_id, url, html).

    Character references are decoded, white space in a block becomes one
    space, blocks are joined by two line feeds.  Null or empty html gives an
    empty text.  Pages with the same html count as one page, so copies of a
    page are no evidence of boilerplate.  A block of an article goes only where
    most pages of the host have it, with what follows up to ``run`` tokens.
    Null urls share one host.  With
    ``trust_markup=False`` the suffix array alone decides about every block.
    """
    page = F.coalesce(column(df, "html", "string"), F.lit(""))
    url = column(df, "url", "string")
    pages = df.select(column(df, "page_id", "bigint").cast("string").alias("page_id"), url.alias("url"),
                      F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]+)", 1)), F.lit("")).alias("host"),
                      F.xxhash64(page).alias("page_key"), page.alias("html"))
    kind = ("page_id string, url string, host string, page_key bigint, text string, "
            "blocks array<string>, open array<boolean>, suffixes array<bigint>, reach array<int>")
    parsed = written(pages.mapInPandas(_parsed(trust_markup, run), kind))
    unsettled = parsed.where(F.col("text").isNull())
    streams = parsed.join(unsettled.select("host").distinct(), "host", "left_semi").dropDuplicates(["host", "page_key"])
    suffixes = streams.select("host", "page_key", "blocks").mapInPandas(
        _suffixes(run), "host string, page_key bigint, suffix bigint, at int")
    shared = suffixes.groupBy("host", "suffix").agg(F.min("page_key").alias("a"), F.max("page_key").alias("b"))
    shared = written(shared.where("a <> b").select("host", "suffix"))
    covered = (suffixes.join(shared, ["host", "suffix"]).groupBy("host", "page_key")
               .agg(F.collect_list("at").alias("repeats")))
    mended = (unsettled.join(covered, ["host", "page_key"], "left").select("page_id", "url", "blocks", "open", "repeats")
              .mapInPandas(_unique_runs(run), "page_id string, url string, text string"))
    settled = parsed.where(F.col("text").isNotNull())
    # distinct pages of each host and of each of its suffixes; three pages at least, so that two copies are no majority
    pages_of = settled.groupBy("host").agg(F.count_distinct("page_key").alias("pages"))
    starts = settled.select("host", "page_key", F.explode(F.arrays_zip("suffixes", "reach")).alias("x")).where("x.reach >= 0")
    often = (starts.groupBy("host", F.col("x.suffixes").alias("suffix")).agg(F.count_distinct("page_key").alias("n"))
             .where("n >= 3").join(pages_of, "host").where("2 * n > pages"))
    common = written(often.groupBy("host").agg(F.collect_list("suffix").alias("common")))
    cleaned = settled.join(common, "host").select("page_id", "url", "text", "suffixes", "reach", "common").mapInPandas(
        _without_notices, "page_id string, url string, text string")
    whole = (settled.join(common, "host", "left_anti").select("page_id", "url", "text").unionAll(cleaned).unionAll(mended))
    return whole.withColumn("page_id", F.col("page_id").cast("bigint")).withColumn("n_chars", F.length("text").cast("bigint"))
