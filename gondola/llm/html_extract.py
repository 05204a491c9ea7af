"""Main text of HTML pages by consensus host paths.

Every page's containers are scored by the text of their paragraphs without links. From the best one
the page climbs to the whole article: the outermost ``article`` or ``main`` around it, else the lowest
container of all paragraphs. Its generalised tag-class path (digits become ``#``) is the page's vote,
votes are summed per host in Spark, and every page is extracted again from all containers on its own
path when that is a winning path of its host, else on the strongest winning path that it has, when that
holds the page's best container or more text than it; any other page keeps its own.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import spread_scan, written
from gondola.llm.url_filter import split_url

#: The table of winning paths is broadcast up to so many bytes; a larger one meets pages dealt by host and salt.
BROADCAST_BYTES, SALTS = 32 << 20, 64
#: A path wins on its host when it has this share of the votes; the strongest comes first.
WIN_SHARE = 0.1

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>", re.S)
_CLASS = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "canvas", "object", "textarea", "title", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_CONTAINER = set("article main section div body td center details blockquote".split())
#: Blocks whose text counts as a paragraph however short; text straight in another block counts from PROSE_WORDS words on.
_PARAGRAPH = set("p pre blockquote h1 h2 h3 h4 h5 h6 li dt dd td th figcaption caption summary article main section".split())
PROSE_WORDS = 10
_CLOSES_P = _BLOCK - {"body", "html", "head"}
_DROP = set("head nav footer aside form menu button select option label fieldset dialog input".split())
#: Words of a class, id or role that mark what isn't the article.
_DROP_WORDS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                  "notices alert popup modal overlay comment comments reply replies disqus respond sidebar aside menu nav navbar navigation navbox "
                  "breadcrumb breadcrumbs footer header masthead topbar share sharing social related recommended newsletter subscribe signup "
                  "login search widget pagination pager toolbar copyright legal skip".split())
#: Of these, inside an article, the ones that other blocks of an article carry too; they need to be confirmed.
_WEAK_WORDS = set("legal notice notices alert copyright banner header related search social skip pager widget promotion respond".split())
#: Elements whose id is a slug of their heading.
_TARGETS = set("h1 h2 h3 h4 h5 h6 section p".split())
#: An element that may be marked isn't the article when its text has fewer characters and no heading, or is mostly links.
SHORT = 80
_SPACE = re.compile(r"\s+")
_END_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in _RAW}


def _marks(attrs: str, tag: str, in_article: bool) -> tuple[str, bool, bool]:
    """Generalised class/id part of an element's path, whether it is marked as not the article, and whether
    it may be.

    The id of a heading, paragraph or section is a link target and marks nothing. Inside an article a class or
    id marks when it consists of marker words only, one of them no weak one; else with a marker word it may mark.
    A role names a landmark, so its weak words mark too.
    """
    words, drop, maybe = [], False, False
    for key, value in _CLASS.findall(attrs):
        key, value = key.lower(), html.unescape(value.strip("\"'"))
        if key in ("class", "id", "role"):
            if key != "role":
                words += value.split()
            if key == "id" and tag in _TARGETS:
                continue
            for token in value.lower().split():
                parts = [w for w in re.split(r"[^a-z]+", token) if w]
                hits = sum(w in _DROP_WORDS for w in parts)
                weak = key != "role" and all(w in _WEAK_WORDS for w in parts)
                drop |= hits > 0 and (not in_article or hits == len(parts) and not weak)
                maybe |= hits > 0
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            drop = True
    return ".".join(sorted({re.sub(r"[0-9]+", "#", w).replace(">", "_") for w in words})), drop, maybe and not drop


class Page:
    """Elements of a page with their paths, and its blocks of text in order.

    A path is kept as (parent's path, own part) and spelled out for single elements only; sums over
    ancestors run from the last element to the first, as parents come before their children. So time and
    memory are linear in the page however deep it nests.
    """

    def __init__(self, source: str):
        self.tag, self.path, self.parent, self.out = ["html"], [0], [-1], [False]
        self._ids: dict[tuple[int, str], int] = {(-1, "html"): 0}
        self._parts: list[tuple[int, str]] = [(-1, "html")]
        #: (element of the block, text, characters of link text)
        self.blocks: list[tuple[int, str, int]] = []
        self._buf: list[str] = []
        self._link = 0
        self._maybe: list[int] = []
        self._read(source)
        self._settle()

    def _path(self, up: int, part: str) -> int:
        at = self._ids.setdefault((up, part), len(self._parts))
        if at == len(self._parts):
            self._parts.append((up, part))
        return at

    def path_name(self, e: int) -> str:
        """The tag-class path of an element."""
        at, parts = self.path[e], []
        while at >= 0:
            at, part = self._parts[at]
            parts.append(part)
        return ">".join(reversed(parts))

    def path_id(self, name: str) -> int | None:
        at = -1
        for part in name.split(">"):
            at = self._ids.get((at, part))
            if at is None:
                return None
        return at

    def _flush(self, at: int) -> None:
        text = _SPACE.sub(" ", "".join(self._buf)).strip()
        if text:
            self.blocks.append((at, text, self._link))
        self._buf, self._link = [], 0

    def _read(self, s: str) -> None:
        stack, links, opened = [0], 0, Counter(["html"])

        def text(part: str) -> None:
            if part:
                part = html.unescape(part)
                self._buf.append(part)
                if links:
                    self._link += len(part.strip())

        def close_to(depth: int) -> None:
            nonlocal links
            for e in stack[depth:]:
                links -= self.tag[e] == "a"
                opened[self.tag[e]] -= 1
            del stack[depth:]

        pos, n = 0, len(s)
        while pos < n:
            m = _TOKEN.search(s, pos)
            if m is None:
                rest = s[pos:]
                cut = re.search(r"<[a-zA-Z/!][^<>]*\Z", rest)  # a tag that the page's end cuts off
                text(rest[:cut.start()] if cut else rest)
                break
            text(s[pos:m.start()])
            pos = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag == "br":
                    self._buf.append(" ")
                    continue
                if not opened[tag]:
                    continue
                # an end tag closes what is open inside, but not across a block from inside a line
                for d in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[d]] == tag:
                        if tag in _BLOCK:
                            self._flush(self._home(stack))
                        close_to(d)
                        break
                    if tag not in _BLOCK and self.tag[stack[d]] in _BLOCK:
                        break
                continue
            if tag in _RAW:
                if not m[0].endswith("/>") or tag in ("script", "style", "title"):
                    end = _END_RAW[tag].search(s, pos)
                    pos = end.end() if end else n
                continue
            if tag in _BLOCK or tag == "hr":
                self._flush(self._home(stack))
                if tag in ("html", "body") and opened[tag]:
                    continue
                if tag == "body":
                    close_to(1)
                self._imply(tag, stack, close_to)
            elif tag in ("br", "wbr"):
                if tag == "br":
                    self._buf.append(" ")
                continue
            if tag in _VOID:
                continue
            if tag == "a" and links:  # links don't nest
                for d in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[d]] == "a":
                        close_to(d)
                        break
                    if self.tag[stack[d]] in _BLOCK:
                        break
            up = stack[-1]
            in_article = opened["article"] + opened["main"] > 0
            marks, drop, maybe = _marks(m[3], tag, in_article) if m[3] and m[3].strip() else ("", False, False)
            self.tag.append(tag)
            self.path.append(self._path(self.path[up], f"{tag}.{marks}" if marks else tag) if tag in _BLOCK else self.path[up])
            self.parent.append(up)
            self.out.append(self.out[up] or tag in _DROP or drop and tag not in ("html", "body", "article", "main") or tag == "header" and not in_article)
            stack.append(len(self.tag) - 1)
            opened[tag] += 1
            if maybe and tag not in ("html", "body", "article", "main"):
                self._maybe.append(stack[-1])
            if tag == "a":
                links += 1
        self._flush(self._home(stack))

    def _settle(self) -> None:
        """Confirm by their text what may be marked as not the article."""
        if not self._maybe:
            return
        n = len(self.tag)
        size, linked, titled = [0] * n, [0] * n, [False] * n
        for e, text, link in self.blocks:
            size[e] += len(text)
            linked[e] += link
        for e in range(n - 1, 0, -1):
            titled[e] |= size[e] > 0 and re.fullmatch("h[1-6]", self.tag[e]) is not None
            up = self.parent[e]
            size[up] += size[e]
            linked[up] += linked[e]
            titled[up] |= titled[e]
        for x in self._maybe:
            self.out[x] |= 2 * linked[x] > size[x] or size[x] < SHORT and not titled[x]
        for e in range(1, len(self.tag)):
            self.out[e] |= self.out[self.parent[e]]

    def _home(self, stack: list[int]) -> int:
        """The innermost block, or the innermost element when that isn't part of the article."""
        e = stack[-1]
        while self.tag[e] not in _BLOCK and self.tag[e] != "html":
            if self.out[e] and not self.out[self.parent[e]]:
                return e
            e = self.parent[e]
        return e

    def _imply(self, tag: str, stack: list[int], close_to) -> None:
        """Close what an opening block tag ends without an end tag."""
        ends = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}.get(tag)
        stop = {"ul", "ol", "dl", "table"}
        for d in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[d]]
            if tag in _CLOSES_P and t == "p" or ends and t in ends:
                close_to(d)
                if not ends:
                    return
            elif t in _BLOCK and (t in stop or not ends):
                return

    def _up(self, e: int) -> list[int]:
        """An element and its ancestors, the innermost first."""
        up = []
        while e >= 0:
            up.append(e)
            e = self.parent[e]
        return up

    def scores(self) -> dict[int, float]:
        """Text of a container's paragraphs without links: whole for the nearest container, half for each next."""
        worth: dict[int, float] = defaultdict(float)
        for e, text, link in self.blocks:
            if not self.out[e]:
                worth[e] += len(text) - 2 * link
        got: dict[int, float] = {}
        for e in range(len(self.tag) - 1, -1, -1):
            if e in worth:
                x = worth.pop(e)
                if self.tag[e] in _CONTAINER:
                    got[e] = x * (1.2 if self.tag[e] in ("article", "main") else 1)
                    x /= 2
                if e:
                    worth[self.parent[e]] += x
        return got

    def _whole(self, best: int) -> int:
        """The container of the whole article around the best one: the outermost article or main, else
        the lowest that holds every paragraph too."""
        marked = [e for e in self._up(best) if self.tag[e] in ("article", "main")]
        if marked:
            return marked[-1]
        held = [0] * len(self.tag)
        for e, text, link in self.blocks:
            if not self.out[e] and len(text) > 2 * link and (self.tag[e] in _PARAGRAPH or text.count(" ") + 1 >= PROSE_WORDS):
                held[e] += 1
        for e in range(len(self.tag) - 1, 0, -1):
            held[self.parent[e]] += held[e]
        return next((e for e in self._up(best) if held[e] == held[0] and self.tag[e] in _CONTAINER), 0)

    def best(self, paths: list[str] | None = None) -> list[int] | None:
        """The containers of the article, the voted one first: all on the page's own path when it is one of
        ``paths`` (or the page has none of them), else all on the first of ``paths`` that the page has."""
        got = self.scores()
        if not got:
            return None
        top = max(got, key=lambda e: (got[e], -e))
        own = self._whole(top)
        path = self.path[own]
        voted = [x for x in (self.path_id(p) for p in paths or []) if x is not None]
        if voted and path not in voted:
            on = defaultdict(float)
            for e, x in got.items():
                if x > 0:
                    on[self.path[e]] += x
            host = next((p for p in voted if p in on), path)
            # the host's path must hold the page's best container, or more text than it
            if on[host] >= got[top] or host in {self.path[e] for e in self._up(top)}:
                path = host
        first = [own] if self.path[own] == path else []
        found = first + [e for e in range(len(self.tag)) if e != own and self.path[e] == path and (self.tag[e] in _CONTAINER or e == 0)]
        if first and self.tag[own] in ("article", "main"):  # articles side by side may differ in class
            found += [e for e, x in got.items() if x > 0 and self.tag[e] in ("article", "main") and e not in found]
        return found

    def text(self, containers: list[int] | None) -> str:
        """Blocks inside any of the containers, in page order; all blocks for None."""
        inside = [containers is None] * len(self.tag)
        for e in containers or []:
            inside[e] = True
        for e in range(1, len(self.tag)):
            inside[e] |= inside[self.parent[e]]
        return " ".join(text for e, text, _ in self.blocks if inside[e] and not self.out[e])


def _vote(batches):
    for batch in batches:
        hosts, paths = [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source or "")
            found = page.best()
            if found and max(page.scores().values()) > 0:
                hosts.append(host)
                paths.append(page.path_name(found[0]))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], names=["host", "path"])


def _extract(batches):
    for batch in batches:
        texts = []
        for source, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist()):
            page = Page(source or "")
            texts.append(page.text(page.best(paths)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])


def extract_main(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``df``: ``id``, ``url`` and ``text`` (empty if none).

    White space inside a block becomes one space, blocks are trimmed and joined in page order by one
    space. Null html counts as empty; a null url belongs to the empty host; pages that repeat vote and are
    extracted each; pages without any text in a container are taken whole. Time is linear in a page's length. Tables without rows give an
    empty result, extra columns are ignored.
    """
    host, _ = split_url(F.col(url_col))
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))
    votes = spread_scan(pages.select("host", "html")).mapInArrow(_vote, "host string, path string").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    by_host = Window.partitionBy("host")
    won = votes.withColumn("share", F.col("n") / F.sum("n").over(by_host)).where(F.col("share") >= WIN_SHARE)
    won = won.groupBy("host").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))), lambda x: x["path"]).alias("paths"))
    won = written(won, "html-paths")  # at most 1 / WIN_SHARE paths a host
    size = won.agg(F.sum(F.octet_length("host") + F.octet_length(F.concat_ws(",", "paths")) + 40)).first()[0] or 0
    if size <= BROADCAST_BYTES:  # no page is shuffled by host
        met = spread_scan(pages).join(F.broadcast(won), "host", "left")
    else:
        won = won.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = pages.withColumn("salt", F.pmod(F.xxhash64("id", "url", "html"), F.lit(SALTS)).cast("int")).join(won, ["host", "salt"], "left")
    schema = f"id {pages.schema['id'].dataType.simpleString()}, url string, text string"
    return met.select("id", "url", "html", "paths").mapInArrow(_extract, schema)
