"""Markup residue: pages and file heads as clean text that keeps its structure.

Method: composite text density. A page becomes a DOM; each node gets its characters per tag, adjusted
for characters and tags inside links; a node's density sum is the sum of its children's densities; the
subtree of the greatest sum is the body, and the least density on the path from the page's root to it is
the threshold. Text comes out of the body, of every other subtree that reaches the threshold, and of loose
text beside them that is as dense; the rest (navigation, furniture) is left out. Syntaxes are reported of
all of a page, since what is left out may be markup too.

The content is then turned into text line by line: headings ``# x``, list items ``- x``, code blocks
indented by four spaces, table cells joined by `` | ``, formulas as written; inline markup of HTML,
Markdown, wiki and LaTeX is unwrapped. Which syntaxes were met is reported beside the text.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections.abc import Iterator
from html.entities import html5

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.sources.tables import only_current

# Elements that belong to hOCR files themselves.
HOCR_ELEMENTS = frozenset("html head title meta link body div span".split())
# HTML element names.
HTML_ELEMENTS = HOCR_ELEMENTS | frozenset(
    "a abbr acronym address area article aside audio b base bdi bdo big blockquote br button canvas caption center cite code col "
    "colgroup dd del details dfn dir dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 "
    "header hr i iframe img input ins kbd label legend li main map mark nav noscript object ol optgroup option p param pre q s samp "
    "script section select small source strike strong style sub summary sup svg table tbody td textarea tfoot th thead time tr tt u "
    "ul var video wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 head header html li main nav ol p pre section table tbody td tfoot th thead title tr ul".split())
HIDDEN = frozenset("script style".split())
#: Elements that a new one of the same kind closes.
SELF_CLOSING_KIN = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}

WORD = re.compile(r"<span\b[^>]*\bocrx_word\b[^>]*>([^<]*)</span\s*>", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<\?.*?(?:\?>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<![^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|([^<]+)|<", re.S)
CUT_TAG = re.compile(r"<(?:/?[A-Za-z][^<>]*|[!?/][^<>]*|)\Z")
LINE_CLASS = re.compile(r"\bocr_(?:line|header|caption|textfloat)\b")
REFERENCE = re.compile(r"&(#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
SHOWN_TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?/?>")
SHOWN_COMMENT = re.compile(r"<!--.*?-->", re.S)

#: Marks inside the text: a folded word element, a heading, a list item, and the ends of a kept span.
WORD_MARK, HEADING, ITEM, OPEN, SHUT = "\x02", "\x06", "\x07", "\x04", "\x05"
MARKS = re.compile("[\x02\x04-\x07]")


class Node:
    """One element with what it holds: strings and nodes, in order."""

    __slots__ = ("chars", "density", "items", "kids", "link_chars", "link_tags", "name", "sum", "tags", "text_line")

    def __init__(self, name: str, text_line: bool = False):
        self.name, self.text_line = name, text_line
        self.items: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def parse(page: str, found: set[str]) -> Node:
    """The DOM of a page; foreign elements are noted in ``found``. Never fails, whatever is open or cut."""
    page = MARKS.sub(" ", page)
    page = CUT_TAG.sub("", page)
    page = WORD.sub(rf" {WORD_MARK}\1 ", page)
    root = Node("#root")
    stack = [root]
    for m in TOKEN.finditer(page):
        cdata, close, name, attrs, text = m.groups()
        if text is not None:
            stack[-1].items.append(html.unescape(text) if "&" in text else text)
        elif name is not None:
            name = name.lower()
            if name not in HOCR_ELEMENTS:
                if name not in HTML_ELEMENTS and ":" not in name:
                    stack[-1].items.append(m.group())  # an angle bracket that is no tag
                    continue
                found.add("html")
            if close:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == name:
                        del stack[k:]
                        break
                continue
            kin = SELF_CLOSING_KIN.get(name)
            if kin and stack[-1].name in kin:
                stack.pop()
            node = Node(name, name in ("span", "div", "p") and bool(LINE_CLASS.search(attrs)))
            stack[-1].items.append(node)
            if name not in VOID and not attrs.endswith("/"):
                stack.append(node)
        elif cdata:
            stack[-1].items.append(cdata)
        elif m.group() == "<":
            stack[-1].items.append("<")
    return root


def measure(node: Node, depth: int = 0, in_link: bool = False) -> None:
    """Characters and tags of each subtree; deep trees are measured without recursion."""
    order, todo = [], [(node, in_link)]
    while todo:
        n, linked = todo.pop()
        order.append((n, linked))
        linked = linked or n.name == "a"
        todo += [(x, linked) for x in n.items if isinstance(x, Node)]
    for n, linked in reversed(order):
        linked = linked or n.name == "a"
        own = 0
        for x in n.items:
            if isinstance(x, Node):
                n.chars += x.chars
                n.tags += x.tags + 1
                n.link_chars += x.link_chars
                n.link_tags += x.link_tags + (x.name == "a")
            else:
                size = len(x) - x.count(" ")
                own += size
                n.tags += x.count(WORD_MARK)  # a folded word element counts as a tag
        n.chars += own
        n.link_chars += own if linked else 0


def densities(root: Node) -> tuple[Node, float]:
    """The subtree of the greatest density sum, and the threshold of the path to it."""
    measure(root)
    body_chars, body_links = max(root.chars, 1), root.link_chars
    best, path_of = root, {}
    todo = [root]
    while todo:
        n = todo.pop()
        c, t, lc, lt = n.chars, max(n.tags, 1), n.link_chars, max(n.link_tags, 1)
        plain = max(c - lc, 1)
        base = math.log(c * lc / plain + body_links * c / body_chars + math.e)
        inner = (c / max(lc, 1)) * (t / lt)
        n.density = (c / t) * (math.log(inner) / math.log(base) if inner > 1 and base > 1.0001 else 1.0) if c else 0.0
        n.kids = [x for x in n.items if isinstance(x, Node)]
        for x in n.kids:
            path_of[id(x)] = n
        todo += n.kids
    todo = [root]
    while todo:
        n = todo.pop()
        n.sum = sum(x.density for x in n.kids)
        if n.sum > best.sum:
            best = n
        todo += n.kids
    threshold, n = best.density, best
    while id(n) in path_of:
        n = path_of[id(n)]
        if n is not root:
            threshold = min(threshold, n.density)
    return best, threshold


def content_of(root: Node, best: Node, threshold: float) -> set[int]:
    """Ids of the nodes whose whole subtrees are content: the body, and what reaches the threshold beside the path to it."""
    path, todo, parent = set(), [root], {}
    while todo:
        n = todo.pop()
        for x in n.kids:
            parent[id(x)] = n
        todo += n.kids
    n = best
    while id(n) in parent:
        n = parent[id(n)]
        path.add(id(n))
    found, todo = set(), [root]
    while todo:
        n = todo.pop()
        if n is best or id(n) not in path and n.density >= threshold:
            found.add(id(n))
        else:
            todo += n.kids
    return found


SPACES = re.compile(r"[ \t\r\f\v\n\x02]+")


def lines_of(root: Node, content: set[int] | None = None, threshold: float = 0.0) -> list[str]:
    """Text lines of the content, block structure as marks at the line's start; without ``content``, of everything."""
    out: list[str] = []
    row: list[str] = []

    def flush(mark: str = "") -> None:
        text = SPACES.sub(" ", "".join(row)).strip()
        row.clear()
        if text:
            out.append(mark + text)

    def cells(n: Node | str) -> str:
        return SPACES.sub(" ", n if isinstance(n, str) else strings_of(n)).strip()

    def said(x: str, inside: bool) -> bool:
        return inside or len(x) - x.count(" ") >= max(threshold, 1.0)  # loose text is a node of one tag

    inside_all = content is None
    inside = [(root, 0, inside_all or id(root) in content)]
    # an explicit stack: (node, index of its next item, whether it is content); pages may nest deeply
    while inside:
        n, k, kept = inside.pop()
        if k == 0:
            if n.name in HIDDEN:
                continue
            if kept and n.name == "pre":
                flush()
                out.extend("    " + x for x in strings_of(n).replace(WORD_MARK, "").strip("\n").split("\n"))
                continue
            if kept and n.name == "tr":
                flush()
                out.append(" | ".join(cells(x) for x in n.items if isinstance(x, Node)) or cells(n))
                continue
            if n.name in BLOCKS or n.text_line:
                flush()
            if n.name in ("br", "hr"):
                flush()
                continue
        if k < len(n.items):
            inside.append((n, k + 1, kept))
            x = n.items[k]
            if isinstance(x, str):
                if not said(x, kept):
                    continue
                if not n.text_line and "\n" in x and WORD_MARK not in x and n.name in ("#root", "div", "body", "html", "head", "title", "p", "center"):
                    head, *rest = x.split("\n")
                    row.append(head)
                    for y in rest:
                        flush()
                        row.append(y)
                else:
                    row.append(x)
            else:
                inside.append((x, 0, kept or id(x) in content))
            continue
        if n.name in BLOCKS or n.text_line:
            mark = HEADING if n.name in ("h1", "h2", "h3", "h4", "h5", "h6") else ITEM if n.name == "li" else ""
            flush(mark)
    flush()
    return out


def strings_of(node: Node) -> str:
    """All strings below a node in order; deep trees without recursion."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += reversed(x.items)
    return "".join(out)


# Markdown, wiki and LaTeX in text lines.
FENCE = re.compile(r"(?m)^[ \t]*(`{3,}|~{3,})[^\n`]*\n(?:(.*?)\n)??[ \t]*\1[ \t]*$", re.S)
LONE_FENCE = re.compile(r"(?m)^[ \t]*(?:```|~~~)[\w+-]*[ \t]*$\n?")
VERBATIM = re.compile(r"\\begin\{(verbatim|lstlisting)\}(.*?)(?:\\end\{\1\}|\Z)", re.S)
DISPLAY = re.compile(r"\$\$.+?\$\$|\\\[.+?\\\]|\\begin\{(equation|align|gather|displaymath|eqnarray)(\*?)\}.+?\\end\{\1\2\}", re.S)
INLINE_MATH = re.compile(r"\\\(.+?\\\)|\$(?=[^\s$])[^$\n]*[\\^_{=][^$\n]*(?<=[^\s\\])\$")
CODE_SPAN = re.compile(r"(?<!`)(`{1,2})(?=[^`\s])([^`\n]+?)\1(?!`)")
MD_LINK = re.compile(r"!?\[([^\[\]]*)\]\(([^()\s]+)(?:\s+\"[^\"]*\")?\)")
MD_NOTE = re.compile(r"\[\^[\w-]+\]:?")
MD_HEAD = re.compile(r"(?m)^#{1,6}[ \t]+(?=\S)(.*?)[ \t]*#*$")
MD_QUOTE = re.compile(r"(?m)^>[ \t]?(?=[^\s>]).*\n>")
MD_LIST = re.compile(r"(?m)^([*+-])[ \t]+\S.*\n\1[ \t]+\S")
MD_RULE_ROW = re.compile(r"(?m)^\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$|^\|[ \t]*:?-{3,}:?[ \t]*\|[ \t]*$")
# Two or three signs hold over any text without the sign; a single one, which may be a note mark, not over a line that ends a sentence.
MD_STARS = re.compile(r"(?<![\w*\\])(\*{2,3})(?=[^\W_])([^*]*?[\w.,;:!?…»”\"'\]\)])\1(?![\w*])")
MD_STAR = re.compile(r"(?<![\w*\\])(\*)(?=[^\W_])((?:[^*.!?]|[.!?](?!\s*\n))*?[\w.,;:!?…»”\"'\]\)])\1(?![\w*])")
MD_LINES = re.compile(r"(?<![\w\\])(_{2,3})(?=[^\W_])([^_]*?[^\W_]?[.,;:!?…]?)\1(?!\w)")
MD_LINE = re.compile(r"(?<![\w\\])(_)(?=[^\W_])((?:[^_.!?]|[.!?](?!\s*\n))*?[^\W_]?[.,;:!?…]?)\1(?!\w)")
MD_STRIKE = re.compile(r"(?<![\w~])~~(?=[^\s~])([^~]+?)~~(?![\w~])")
WIKI_LINK = re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]+)\]\]")
WIKI_TEMPLATE = re.compile(r"\{\{([^{}]+)\}\}")
WIKI_QUOTES = re.compile(r"(?<![\w'])('{2,3}|'{5})(?=[^\s'])((?:[^']|'(?!'))*?[^\s'])\1(?![\w'])")
WIKI_HEAD = re.compile(r"(?m)^(={2,6})[ \t]*(?=[^=\s])(.*?[^=\s])[ \t]*\1[ \t]*$")
WIKI_TABLE = re.compile(r"(?m)^\{\|.*$")
TEX_WORD = re.compile(r"\\[A-Za-z]{2,}\*?(?![A-Za-z])|\\[a-zA-Z]\{|\\item\b")
TEX_ACCENT = re.compile(r"\\([`'^\"~=.])\{?([A-Za-z])\}?|\\([cvuHkrbd])\{([A-Za-z])\}")
TEX_GROUP = re.compile(r"\\([A-Za-z]+)\*?(?:\[[^\]\n]*\])*\{([^{}]*)\}")
TEX_BARE = re.compile(r"\\([A-Za-z]+)\*?(?:\[[^\]\n]*\])?[ \t]?")
ANY_MARK = re.compile(r"[\\`*_\[\]{}#$<>&|~]|''|==|^[+-] ", re.M)
# LaTeX accents and the combining characters they stand for.
TEX_COMBINING = {"`": "\u0300", "'": "\u0301", "^": "\u0302", '"': "\u0308", "~": "\u0303", "=": "\u0304", ".": "\u0307", "c": "\u0327", "v": "\u030c", "u": "\u0306", "H": "\u030b", "k": "\u0328", "r": "\u030a", "b": "\u0331", "d": "\u0323"}
# Commands whose argument is a heading, and those that leave no text.
TEX_HEADINGS = frozenset("part chapter section subsection subsubsection paragraph title".split())
TEX_SILENT = frozenset("begin end label ref pageref cite documentclass usepackage input include index vspace hspace pagestyle thispagestyle bibliography newcommand renewcommand setlength".split())


def convert(text: str, found: set[str]) -> str:
    """Lines of text without Markdown, wiki, LaTeX and twice-encoded HTML; syntaxes go to ``found``."""
    if not ANY_MARK.search(text):
        return text
    kept: list[str] = []

    def keep(s: str) -> str:
        kept.append(s)
        return f"{OPEN}{len(kept) - 1}{SHUT}"

    def note(syntax: str, pattern: re.Pattern, to) -> None:
        nonlocal text
        text, n = pattern.subn(to, text)
        if n:
            found.add(syntax)

    if "`" in text or "~~~" in text:
        note("markdown", FENCE, lambda m: keep("\n".join("    " + x for x in (m[2] or "").split("\n"))))
        note("markdown", LONE_FENCE, "")
        note("markdown", CODE_SPAN, lambda m: keep(m[2]))
    if "\\" in text or "$" in text:
        note("latex", VERBATIM, lambda m: keep("\n".join("    " + x for x in m[2].strip("\n").split("\n"))))
        note("latex", DISPLAY, lambda m: keep(m[0]))
        note("latex", INLINE_MATH, lambda m: keep(m[0]))
    if "<" in text:
        note("html", SHOWN_COMMENT, "") if "<!--" in text else None
        names = [m for m in SHOWN_TAG.finditer(text) if m[1].lower() in HTML_ELEMENTS]
        if names:
            found.add("html")
            text = SHOWN_TAG.sub(lambda m: "" if m[1].lower() in HTML_ELEMENTS else m[0], text)
    if "&" in text and any(m[1][0] == "#" or f"{m[1]};" in html5 for m in REFERENCE.finditer(text)):
        found.add("html")
        text = html.unescape(text)
    if "\\" in text:
        note("latex", TEX_ACCENT, lambda m: unicodedata.normalize("NFC", (m[2] or m[4]) + TEX_COMBINING[m[1] or m[3]]))
        if TEX_WORD.search(text):
            found.add("latex")
            text = text.replace("~\\", " \\")
            n = 1
            while n:  # nested groups from the inside out
                text, n = TEX_GROUP.subn(lambda m: "" if m[1] in TEX_SILENT else f"\n{HEADING}{m[2].strip()}\n" if m[1] in TEX_HEADINGS else f" ({m[2].strip()})" if m[1] == "footnote" else m[2], text)
            text = re.sub(r"\\item\b[ \t]*", ITEM, text)
            text = TEX_BARE.sub(" ", text)
    if "{" in text:
        note("wiki", WIKI_TABLE, "")
        if "wiki" in found:
            text = re.sub(r"(?m)^\|[-}].*$\n?", "", text)
            text = re.sub(r"(?m)^[|!][ \t]*(.*)$", lambda m: re.sub(r"[ \t]*(?:\|\||!!)[ \t]*", " | ", m[1]), text)
        note("wiki", WIKI_TEMPLATE, lambda m: m[1].rsplit("|", 1)[-1])
    if "[[" in text:
        note("wiki", WIKI_LINK, r"\1")
    if "''" in text:
        note("wiki", WIKI_QUOTES, r"\2")
    if "==" in text:
        note("wiki", WIKI_HEAD, rf"{HEADING}\2")
    if "](" in text:
        note("markdown", MD_LINK, r"\1")
    if "[^" in text:
        note("markdown", MD_NOTE, "")
    if "#" in text:
        note("markdown", MD_HEAD, rf"{HEADING}\1")
    if ">" in text and MD_QUOTE.search(text):
        found.add("markdown")
        text = re.sub(r"(?m)^>[ \t]?", "", text)
    if MD_LIST.search(text):
        found.add("markdown")
        text = re.sub(r"(?m)^[*+-][ \t]+(?=\S)", ITEM, text)
    if "|" in text:
        n = len(MD_RULE_ROW.findall(text))
        if n:
            found.add("markdown")
            text = MD_RULE_ROW.sub("", text)
            text = re.sub(r"(?m)^\|[ \t]*(.*?)[ \t]*\|[ \t]*$", lambda m: re.sub(r"[ \t]*\|[ \t]*", " | ", m[1]), text)
    if "*" in text:
        note("markdown", MD_STARS, r"\2")
        note("markdown", MD_STAR, r"\2")
    if "_" in text:
        note("markdown", MD_LINES, r"\2")
        note("markdown", MD_LINE, r"\2")
    if "~~" in text:
        note("markdown", MD_STRIKE, r"\1")
    if kept:
        text = re.sub(f"{OPEN}(\\d+){SHUT}", lambda m: kept[int(m[1])], text)
    return re.sub(r"\n{2,}", "\n", text)


def clean_page(page: str | None) -> tuple[str | None, list[str]]:
    """A page's clean text and the syntaxes its markup used; null gives null, empty gives empty."""
    if page is None:
        return None, []
    found: set[str] = set()
    root = parse(page, found)
    body, threshold = densities(root)
    content = content_of(root, body, threshold)
    every, lines = lines_of(root), lines_of(root, content, threshold)
    text = convert("\n".join(lines), found)
    if lines != every:
        convert("\n".join(every), found)  # markup in what is left out is markup of the page
    return text.replace(HEADING, "# ").replace(ITEM, "- ").strip("\n"), sorted(found)


CLEAN = T.StructType([T.StructField("text", T.StringType()), T.StructField("syntaxes", T.ArrayType(T.StringType()))])


def clean_pages(df: DataFrame, column: str, keys: list[str], with_text: bool = True) -> DataFrame:
    """keys, text and syntaxes of each row's markup in ``column``.

    Rows are worked on where they are read: no shuffle. Null text gives null text and no syntax,
    empty text an empty text; other columns are left out, whatever their names.
    """
    fields = [f for f in df.select(*keys).schema.fields]
    schema = T.StructType([*fields, *([CLEAN["text"]] if with_text else []), CLEAN["syntaxes"]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = [clean_page(p if isinstance(p, str) else None) for p in b["_page"]]
            out = b[keys].copy()
            if with_text:
                out["text"] = [t for t, _ in done]
            out["syntaxes"] = [s for _, s in done]
            yield out

    return df.select(*keys, F.col(column).alias("_page")).mapInPandas(run, schema)


def all_parts(hocr: DataFrame) -> DataFrame:
    """(hocr_id, loaded_at, page_idx, html): pages of every file, and its head with page_idx -1."""
    pages = hocr.select("hocr_id", "loaded_at", F.posexplode("pages_html").alias("page_idx", "html"))
    heads = hocr.select("hocr_id", "loaded_at", F.lit(-1).alias("page_idx"), F.col("prefix_before_body").alias("html"))
    return pages.unionByName(heads).filter(F.col("html").isNotNull())


def markup_found(hocr: DataFrame) -> DataFrame:
    """(hocr_id, page_idx, syntax) of current files: each syntax that a page or head holds."""
    done = clean_pages(all_parts(hocr), "html", ["hocr_id", "loaded_at", "page_idx"], with_text=False)
    found = done.select("hocr_id", "loaded_at", "page_idx", F.explode("syntaxes").alias("syntax"))
    return only_current(found, hocr, "hocr_id").select("hocr_id", "page_idx", "syntax").distinct()


def clean_text(hocr: DataFrame) -> DataFrame:
    """(hocr_id, page_idx, text) of current files: each page and head as clean text."""
    done = clean_pages(all_parts(hocr), "html", ["hocr_id", "loaded_at", "page_idx"])
    return only_current(done, hocr, "hocr_id").select("hocr_id", "page_idx", "text").distinct()
