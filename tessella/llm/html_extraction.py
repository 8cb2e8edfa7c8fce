"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of elements. Each has a hidden label, content or not.
Potentials tie a label to what is seen of the element (tag, words of its class
and id, amount of text, share of linked text, punctuation) and to the label of
its parent. Sum-product messages go up and down the tree once, which gives each
element's exact marginal; text stands where the marginal of its element says
content. Potentials are smoothed counts over labelled pages, which a rule writes.

Pages are independent, so this is one pass without a shuffle.

Defined cases: a null or empty page, or one without content, has an empty text;
pages with broken markup are read as far as they make sense (unclosed elements
end with their parents, unmatched end tags are ignored; a script or style without
an end tag reaches to the end of the page, as in browsers); a page of any length is
read whole, in linear time; equal rows get equal results; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import small_batches

# Element names by kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea template iframe".split())
KINDS = {
    "root": "html body", "article": "article main", "box": "div section center", "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "paragraph": "p blockquote pre", "list": "ul ol dl menu", "item": "li dt dd", "table": "table thead tbody tfoot tr td th caption",
    "nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form fieldset button label legend input dialog select option optgroup datalist",
    "figure": "figure figcaption picture details summary address", "link": "a", "head": "head",
}
KIND = {t: k for k, v in KINDS.items() for t in v.split()}
BLOCK = {t for k, v in KINDS.items() if k != "link" for t in v.split()} - {"label", "button", "input", "select", "option", "optgroup", "datalist"} | {"hr"}
#: What an opening element ends: the last of the first names, unless one of the second (or, third, any block) was opened in it.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist", "optgroup"), True), "optgroup": (("optgroup",), ("select",), True),
}
# Words of class, id and role, by what they speak for; content is the last.
WORDS = {
    "comments": "comment comments commentlist commenter reply replies respond disqus discussion thread responses",
    "notice": "cookie cookies consent gdpr notice alert banner popup modal overlay subscribe newsletter signup paywall promo promotion disclaimer toast",
    "advert": "ad ads advert adverts advertisement sponsor sponsored adsense doubleclick dfp commercial outbrain taboola",
    "chrome": "nav navbar navigation menu menubar header masthead footer foot bottom sidebar side aside widget widgets breadcrumb breadcrumbs toolbar topbar logo search login pagination pager skip copyright legal social share sharing related recommended recommendations more tags tag byline-links complementary contentinfo navigation",
    "content": "article content post entry story main body text blog hentry articlebody maincontent page-content prose markdown document",
}
WORD_KIND = {w: k for k, v in WORDS.items() for w in v.split()}

# As browsers read them: <!--> and <!---> are whole comments, --!> ends one, and <![CDATA[ outside foreign elements ends at >.
_COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
_TOKEN = re.compile(_COMMENT.pattern + r"|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)", re.S)
_QUOTE_OR_END = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_LABEL = re.compile(r" data-label=\"([01])\"")  # in pages that this module writes to learn from
_SENTENCE = re.compile(r"[.!?…。](?:\s|$)")


class Page:
    """Elements in page order: parents come before children; 0 is the page."""

    def __init__(self, source: str, labelled: bool = False):
        self.tag, self.parent, self.words, self.label = ["#page"], [0], [""], [None]
        self.runs: list[tuple[int, int, str]] = []  # element, block, text
        self._block, self._labelled = 0, labelled
        # of the open elements: places in the stack by name, and those of blocks
        self._open_at: dict[str, list[int]] = {}
        self._open_blocks = [0]
        self._read(source)

    def _read(self, source: str) -> None:
        stack, at = [0], 0
        end = len(source)
        last = {c: source.rfind(c) for c in ">\"'"}
        dead: set[int] = set()  # quotes from which no tag ends
        unclosed: set[str] = set()  # raw elements without a further end tag
        while at < end:
            m = _TOKEN.search(source, at)
            if m and m[2] and m.end() > last[">"]:
                m = _COMMENT.search(source, m.end())
            if not m:
                self._text(stack, source[at:])
                return
            if m.start() > at:
                self._text(stack, source[at : m.start()])
            at = m.end()
            if m.re is _COMMENT or m[2] is None:
                continue
            tag = m[2].lower()
            close = self._tag_end(source, at, last, dead)
            attributes, at = source[at:close], close + 1
            if m[1]:
                self._close(stack, tag)
                continue
            if tag in RAW:  # neither text nor evidence
                if not attributes.endswith("/") and tag not in unclosed:
                    if found := re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(source, at):
                        at = found.end()
                    elif tag in ("script", "style"):
                        at = end
                    else:  # goes on after the start tag
                        unclosed.add(tag)
            elif tag in VOID:
                if tag in BLOCK:
                    self._block += 1
                else:
                    self.runs.append((stack[-1], self._block, " "))
            else:
                self._open(stack, tag, attributes)
                if attributes.endswith("/") and tag not in BLOCK:
                    self._pop(stack, len(stack) - 1)

    @staticmethod
    def _tag_end(source: str, at: int, last: dict[str, int], dead: set[int]) -> int:
        """Place of the ``>`` outside quotes, or of the first one if a quote or the tag has no end."""
        start, seen = at, []
        while m := _QUOTE_OR_END.search(source, at):
            if m[0] == ">":
                return m.start()
            seen.append(m.start())
            if m.start() in dead or m.start() == last[m[0]]:
                break
            at = source.index(m[0], m.end()) + 1
        dead.update(seen)
        return source.index(">", start)

    def _text(self, stack: list[int], text: str) -> None:
        self.runs.append((stack[-1], self._block, html.unescape(text) if "&" in text else text))

    def _pop(self, stack: list[int], k: int) -> None:
        """End the elements from place ``k`` of the stack on."""
        while len(stack) > k:
            name = self.tag[stack.pop()]
            self._open_at[name].pop()
            if name in BLOCK:
                self._open_blocks.pop()

    def _last(self, names) -> int:
        """Place of the last open element with one of these names, or 0."""
        return max((self._open_at[n][-1] for n in names if self._open_at.get(n)), default=0)

    def _end(self, stack: list[int], names: tuple, barrier: tuple, blocks: bool = False) -> None:
        """End the last of ``names`` unless one of ``barrier`` (or a block) was opened in it."""
        at = self._last(names)
        if at and at >= self._last(barrier) and not (blocks and self._open_blocks[-1] > at):
            self._pop(stack, at)

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._block += 1
            self._end(stack, ("p",), (), True)
            self._end(stack, ("select", "datalist"), (), True)
            self._end(stack, ("option", "optgroup"), (), True)
        if tag in ENDS:
            self._end(stack, *ENDS[tag])
        words, label = "", None
        if attributes:
            words = "".join(" " + (a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(attributes))
            if self._labelled and (found := _LABEL.search(attributes)):
                label = int(found[1])
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.words.append(words)
        self.label.append(label)
        self._open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            self._open_blocks.append(len(stack))
        stack.append(len(self.tag) - 1)

    def _close(self, stack: list[int], tag: str) -> None:
        if tag in BLOCK:
            self._block += 1
        at = self._last((tag,))
        if at and (tag in BLOCK or at > self._open_blocks[-1]):  # an inline end tag ends no block
            self._pop(stack, at)

    def features(self) -> list[tuple[int, ...]]:
        """Of each element: kind, words of each kind of words, text, linked text, sentences."""
        n = len(self.tag)
        words, linked, sentences = [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.tag[i] in ("a", "button")
        for i, _, text in self.runs:
            w = len(text.split())
            words[i] += w
            linked[i] += w * in_link[i]
            sentences[i] += len(_SENTENCE.findall(text))
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            words[p] += words[i]
            linked[p] += linked[i]
            sentences[p] += sentences[i]
        out = []
        for i in range(n):
            kind = KIND_NUMBER.get(KIND.get(self.tag[i], "inline"), 0)
            out.append((kind, *_word_kinds(self.words[i]), _bin(words[i], TEXT), _bin(linked[i] / max(words[i], 1), LINKED) if words[i] else len(LINKED) + 1, _bin(sentences[i] / max(words[i], 1), SENTENCES)))
        return out


KIND_NUMBER = {k: i for i, k in enumerate(["inline", *KINDS])}
TEXT, LINKED, SENTENCES = (1, 3, 6, 12, 30, 80), (0.01, 0.3, 0.6, 0.9), (0.001, 0.03, 0.08)
SIZES = (len(KIND_NUMBER), *[3] * (len(WORDS) - 1), 9, len(TEXT) + 1, len(LINKED) + 2, len(SENTENCES) + 1)


def _bin(x: float, edges: tuple) -> int:
    return sum(x >= e for e in edges)


@lru_cache(maxsize=50_000)
def _word_kinds(words: str) -> tuple[int, ...]:
    """What speaks for each kind of clutter: nothing (0), a part of a name (1), a whole name (2); and for content, beside the strongest of these."""
    if not words:
        return (0,) * len(WORDS)
    whole = {WORD_KIND.get(w) for w in words.lower().split()}
    part = {WORD_KIND.get(w) for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", words).lower())}
    *clutter, content = (2 if k in whole else int(k in part) for k in WORDS)
    return (*clutter, 3 * content + max(clutter))


SAME = 0.5


class Model:
    """Log potentials of what is seen of an element, by kind and label, and of its label, by kind and parent's label."""

    def __init__(self, pages: list[str], smooth: float = 0.3):
        kinds = SIZES[0]
        seen = [np.full((kinds, 2, s), smooth) for s in SIZES[1:]]
        step = np.full((kinds, 2, 2), smooth) + np.eye(2) * 2
        root = np.full(2, smooth)
        for source in pages:
            page = Page(source, labelled=True)
            labels, rows = truth(page), page.features()
            root[labels[0]] += 1
            for i, (y, row) in enumerate(zip(labels, rows)):
                for k, v in enumerate(row[1:]):
                    seen[k][row[0], y, v] += 1
                if i:
                    step[row[0], labels[page.parent[i]], y] += 1
        # a kind with few examples of a label leans on its other label, and both on all kinds together
        share = lambda a: a / a.sum(axis=-1, keepdims=True)
        seen = [s + 12 * share(s.sum(axis=1, keepdims=True)) + 4 * share(s.sum(axis=0)) for s in seen]
        # what is seen of one element is partly the same thing said twice, so it counts with a power below 1
        self.seen = [(SAME * np.log(share(s))).transpose(0, 2, 1).tolist() for s in seen]
        self.step = np.log(step / step.sum(axis=2, keepdims=True)).tolist()
        self.root = np.log(root / root.sum()).tolist()

    def evidence(self, page: Page, rows: list[tuple[int, ...]]) -> list[list[float]]:
        """Log potential of each element's labels by what is seen of it."""
        alike = Counter(zip(page.parent, rows))  # siblings that look the same repeat each other
        own = []
        for p, row in zip(page.parent, rows):
            a = b = 0.0
            for table, v in zip(self.seen, row[1:]):
                x, y = table[row[0]][v]
                a += x
                b += y
            weight = alike[p, row] ** -0.5
            own.append([a * weight, b * weight])
        return own

    def marginals(self, page: Page) -> list[float]:
        """Probability of content of each element, by messages up and then down the tree."""
        rows, parent, n = page.features(), page.parent, len(page.tag)
        own = self.evidence(page, rows)
        up = [[0.0, 0.0]] * n  # the message of i to its parent
        for i in range(n - 1, 0, -1):
            t, (a, b) = self.step[rows[i][0]], own[i]
            up[i] = [_add(t[0][0] + a, t[0][1] + b), _add(t[1][0] + a, t[1][1] + b)]
            p = own[parent[i]]
            p[0] += up[i][0]
            p[1] += up[i][1]
        belief = [own[0][0] + self.root[0], own[0][1] + self.root[1]]
        out, beliefs = [_share(belief)], [belief]
        for i in range(1, n):
            t, above = self.step[rows[i][0]], beliefs[parent[i]]
            a, b = above[0] - up[i][0], above[1] - up[i][1]  # the parent without this child
            top = max(a, b)
            a, b = a - top, b - top
            mine = [own[i][0] + _add(t[0][0] + a, t[1][0] + b), own[i][1] + _add(t[0][1] + a, t[1][1] + b)]
            beliefs.append(mine)
            out.append(_share(mine))
        return out


def _add(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))


def _share(x: list[float]) -> float:
    d = x[0] - x[1]
    return 0.0 if d > 700 else 1 / (1 + math.exp(d))


def truth(page: Page) -> list[int]:
    """Labels of a labelled page: an element's own, or its parent's; an unlabelled wrapper is content if it holds any."""
    n = len(page.tag)
    label, known = [0] * n, [False] * n
    for i in range(1, n):
        if page.label[i] is not None:
            label[i], known[i] = page.label[i], True
        elif known[page.parent[i]]:
            label[i], known[i] = label[page.parent[i]], True
    good = [0] * n
    for i, _, text in page.runs:
        good[i] += len(text.split()) * label[i]
    for i in range(n - 1, 0, -1):
        good[page.parent[i]] += good[i]
    return [label[i] if known[i] else int(good[i] > 0) for i in range(n)]


def labelled_pages(n: int = 600, seed: int = 7) -> list[str]:
    """Pages written by a rule, with ``data-label`` on their parts."""
    rng = np.random.default_rng(seed)
    pick = lambda *x: x[int(rng.integers(len(x)))]
    chance = lambda p: rng.random() < p
    word = lambda: "".join(pick(*"abcdefghiklmnoprstuvwz") for _ in range(int(rng.integers(2, 9))))
    some = lambda a, b: " ".join(word() for _ in range(int(rng.integers(a, b))))
    style = {"plain": False}  # some pages have lists of words where others have sentences

    def sentence() -> str:
        if style["plain"]:
            return pick(some(1, 25), " ".join([word()] * int(rng.integers(2, 25))), some(2, 12).replace(" ", pick(" | ", "### ", "!! ")))
        return some(*pick((3, 18), (1, 4))).capitalize() + pick(".", ".", ".", "!", "?")

    prose = lambda a=1, b=6: " ".join(sentence() for _ in range(int(rng.integers(a, b))))

    def inked(text: str) -> str:
        return f"<{(t := pick('b', 'em', 'strong', 'i', 'code', 'span'))}>{text}</{t}>" if chance(0.25) else text

    def rich() -> str:
        text = prose()
        if chance(0.3):
            text += f' <{(t := pick("b", "em", "strong", "i", "code", "span"))}>{some(1, 5)}</{t}> {prose(1, 3)}'
        if chance(0.3):
            text += f' <a href="/{word()}">{inked(some(1, 4))}</a> {sentence()}'
        return text

    def paragraph() -> str:
        kind = rng.random()
        if kind < 0.7:
            return f"<p>{rich()}</p>" if chance(0.8) else f"<p>{rich()}"
        if kind < 0.78:
            return "<ul>" + "".join(f"<li>{pick(some(2, 9), sentence())}</li>" for _ in range(int(rng.integers(2, 5)))) + "</ul>"
        if kind < 0.84:
            return f"<blockquote><p>{prose(1, 3)}</p></blockquote>"
        if kind < 0.9:
            return f"<h{(k := pick(2, 3, 4))}>{some(1, 7)}</h{k}>"
        if kind < 0.94:
            return "<table>" + "".join(f"<tr><td>{some(1, 4)}</td><td>{some(1, 6)}</td></tr>" for _ in range(3)) + "</table>"
        return f"<pre>{some(4, 20)}</pre>" if chance(0.5) else f"<p>{some(1, 3)}.</p>"

    def links(a: int = 1, b: int = 9) -> str:
        items = [f'<a href="/{word()}">{inked(some(1, 3))}</a>' for _ in range(int(rng.integers(a, b)))]
        return pick("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", " ".join(items), " | ".join(items))

    plain_words = {kind: [w for w in words.split() if "-" not in w] for kind, words in WORDS.items()}

    def aside_words(kind: str) -> str:
        """Words of other kinds in a name: an article that is tagged or has comments, the footer of a post."""
        if kind == "content":
            about = pick(*plain_words[pick("chrome", "chrome", "comments", "notice", "advert")])
            return pick(f"{about}-{word()}", f"{pick('has', 'no', 'with')}-{about}", f"{pick('tag', 'tags')}-{word()} {pick(*plain_words['content'])}-{word()}")
        return f"{pick(*plain_words['content'])}-{pick(*plain_words[kind])}"

    def named(kind: str, *tags: str) -> str:
        names = plain_words[kind]
        if kind == "content" and chance(0.5):  # entry-content, post__body
            names = [f"{pick(*names)}{pick('-', '-', '_', '__')}{pick(*names)}"]
        more = f" {aside_words(kind)}" if chance(0.35) else ""
        if kind == "content" and chance(0.5):
            more += f" {pick(*names)}"
        if more and chance(0.35):  # in the other attribute
            return f'{pick(*tags)} id="{more.strip().replace(" ", "-")}" class="{pick(*names)}"'
        return f'{pick(*tags)} {pick("class", "class", "id")}="{pick("", word()[:3] + " ", "site-", "the-")}{pick(*names)}{pick("", "-" + word()[:4], " " + word()[:4])}{more}"'

    def part(opening: str, inner: str) -> str:
        tag = opening.split()[0]
        return f'<{opening} data-label="0">{inner}</{tag}>'

    def clutter() -> str:
        return pick(
            lambda: part(pick("nav", named("chrome", "div", "ul", "nav")), pick(links(), links(1, 3))),
            lambda: part(pick("header", named("chrome", "div", "header")), pick(f"<h1>{some(1, 3)}</h1>", f'<a href="/">{some(1, 3)}</a>', f"<p>{some(2, 6)}</p>") + links()),
            lambda: part(pick("footer", named("chrome", "div", "footer")), pick(f"&copy; {some(1, 4)} &middot; {prose(1, 3)}", f"&copy; {some(1, 3)}", f"<p>&copy; 20{some(1, 2)}. {sentence()}</p>" + links())),
            lambda: part(pick("aside", named("chrome", "div", "aside")), f"<h3>{some(1, 3)}</h3>" + pick(links(), f"<p>{prose(1, 4)}</p>")),
            lambda: part(named("advert", "div", "aside", "section"), pick(prose(1, 3), f'<a href="/x">{some(2, 8)}</a>', f"<p>{prose(1, 3)}</p>")),
            lambda: part(named("notice", "div", "section", "p"), pick(prose(1, 4), f"<p>{prose(1, 3)}</p><button>{word()}</button>")),
            lambda: part(pick("form", named("notice", "form", "div"), named("chrome", "form")), f"<label>{some(1, 4)}</label><input name=q><button>{some(1, 2)}</button>" + pick("", f"<p>{sentence()}</p>")),
            lambda: part(named("comments", "div", "section", "ol", "ul"), f"<h3>{some(1, 3)}</h3>" + "".join(f'<{pick("div", "li", "article")} {pick("", named("comments", "x")[2:])}><p>{pick(word(), some(1, 3))}</p><p>{prose(1, 4)}</p>' for _ in range(int(rng.integers(1, 5))))),
        )()

    def content() -> str:
        title = f"<h1>{some(1, 9)}</h1>" if chance(0.8) else ""
        inner = title + "".join(paragraph() for _ in range(int(rng.integers(1, pick(3, 9, 9)))))
        if chance(0.15):  # the same few words over and over
            line = pick(some(1, 4), sentence())
            inner += "".join(f"<p>{pick('', '', '', '<b>')}{pick(line, line, line, some(1, 4))}{pick('.', '', '<br>')}" + pick("</p>", "</p>", "") for _ in range(int(rng.integers(5, pick(50, 150)))))
        if chance(0.25):
            inner += clutter()
        kind = pick("article", "article", "main", "section", "div", named("content", "div", "div", "section", "article", "main"), named("content", "div"))
        whole = f'<{kind} data-label="1">{inner}</{kind.split()[0]}>'
        return pick(whole, whole, f"<main>{whole}</main>", f'<div class="{pick("container", "wrapper", "row", word())}">{whole}</div>')

    pages = []
    for _ in range(n):
        style["plain"] = False
        before, after = ("".join(clutter() for _ in range(int(rng.integers(0, 4)))) for _ in "ab")
        style["plain"] = chance(0.3)
        pages.append(f"<html><head><title>{some(2, 6)}</title><style>p{{}}</style></head><body>{before}{content()}{after}</body></html>")
    return pages


@lru_cache(maxsize=1)
def trained() -> Model:
    return Model(labelled_pages())


def main_text(source: str | None, model: Model, least: float = 0.5) -> str:
    """Blocks of content, one a line."""
    if not source:
        return ""
    page = Page(source)
    content = model.marginals(page)
    blocks: dict[int, list[str]] = {}
    for i, block, text in page.runs:
        if content[i] >= least:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and the main text of every page."""
    model = trained()
    small_batches(pages.sparkSession)

    def run(batches):
        for b in batches:
            texts = pa.array([main_text(x.as_py(), model) for x in b.column("__html")], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), texts], [*keep, "text"])

    source = pages.select(*(F.col(f"`{c}`") for c in keep), F.col(html_column).cast("string").alias("__html"))
    fields = source.schema.fields[:-1]
    return source.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", text string")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
