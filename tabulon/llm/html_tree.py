"""A small tolerant reader of HTML pages: block elements as a tree, text as blocks."""

from __future__ import annotations

import hashlib
import html
import re

#: Fixed values of HTML: elements without content, with raw content, and block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|iframe|textarea|title|noframes|xmp|select|object|audio|video|canvas|annotation|annotation-xml"
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre
search section summary table tbody tfoot thead tr ul""".split())
#: Start tags that end an open svg, unless they stand in one of its elements that may hold HTML.
SVG_ENDS = BLOCK | frozenset("b big br code em embed i img nobr ruby s small span strike strong sub sup td th tt u var".split())
SVG_HTML = frozenset(["foreignobject", "desc"])
#: A start tag of the first closes an open element of the second, not looking past the third.
ENDS = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
        "tr": ("tr", ("table",)), "tbody": ("tbody thead tfoot", ("table",)),
        "tfoot": ("tbody thead tfoot", ("table",)), "thead": ("tbody thead tfoot", ("table",))}
#: Roles of page parts that are not the article, by tag, by ARIA role and by a word of class or id.
NOISE_TAGS = frozenset("nav footer aside form head menu dialog button fieldset search".split())
NOISE_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar
toolbar tablist status tooltip""".split())
#: Words that name menus, page headers and footers, sidebars, notices, adverts, forms and comments.
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adslot adbox banner breadcrumb breadcrumbs
comment comments commentlist consent cookie cookies disclaimer disqus dropdown footer gdpr login masthead menu modal nav
navbar navigation navi newsletter notice notices notification overlay pager pagination paywall popup promo promoted
promotion replies reply respond sidebar sidenav signup sponsor sponsored subscribe subscription toolbar topbar""".split())
#: Words that an article may use for parts of its own: noise outside of an article or main element.
HINT_WORDS = frozenset("byline legal recommended related search skip social teaser toc tracking widget widgets".split())
#: Noise, but not on inline elements there: an article may speak of what it shares.
BAR_WORDS = frozenset("share sharing".split())
#: The same, on block elements only: an article has a header of its own.
OUTER_WORDS = frozenset("header head side meta copyright top bottom".split())
CONTENT_TAGS, CONTENT_ROLES = frozenset(["article", "main"]), frozenset(["main", "article"])

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?>[^>\"']|\"[^\"]*\"|'[^']*')*+>"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?>\s+|/|[^\s\"'>/=]++(?>\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+))?|[\"'=])*+)>",
    re.S | re.I)
#: One whole attribute after another, as ``attrs`` above reads them; what is between has no name.
_ATTR = re.compile(r"""([^\s"'>/=]++)(?>\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*+)))?|[\s"'>/=]""")
_READ = frozenset("class id role hidden aria-hidden style".split())
_RAW_END = {tag: re.compile(rf"</{tag}\s*>|\Z", re.I) for tag in RAW.split("|")}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


def number(*parts) -> int:
    """A stable signed 64-bit hash."""
    raw = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


class Element:
    """A block element: its place in the site's tree (``key``), children and own text; whether it
    stands in an element that is hidden or noise by tag or ARIA role (``noise``) or in an article or
    main element (``content``), whether it is one (``head``: "article", "main" or ""), and the role
    words in its class and id."""

    __slots__ = ("tag", "key", "parent", "children", "noise", "content", "head", "words", "own")

    def __init__(self, tag: str, key: int, parent: Element | None, noise: bool, content: bool, head: str = "",
                 words: frozenset[str] = frozenset()):
        self.tag, self.key, self.parent = tag, key, parent
        self.children: list[Element] = []
        self.noise, self.content, self.head, self.words = noise, content, head, words
        self.own: list[str] = []


def _attributes(raw: str) -> dict[str, str]:
    """The attributes that tell an element's role; the first of a name holds."""
    found: dict[str, str] = {}
    if raw and not raw.isspace():
        for m in _ATTR.finditer(raw):
            if m[1] and (name := m[1].lower()) in _READ:
                found.setdefault(name, m[2] or m[3] or m[4] or "")
    return found


def _closed(attrs: str) -> bool:
    """Whether a tag of a drawing closes itself; the slash that ends a bare value is part of it."""
    return attrs.endswith("/") and [m[1] for m in _ATTR.finditer(attrs)][-1] is None


def _is_noise(tag: str, attrs: dict[str, str], in_content: bool) -> bool:
    if tag in NOISE_TAGS or (tag == "header" and not in_content):
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return True
    return attrs.get("role", "").lower() in NOISE_ROLES


def _role_words(tag: str, attrs: dict[str, str], in_content: bool) -> frozenset[str]:
    """The words of class and id that name a role other than the article's."""
    if not attrs or tag in ("html", "body"):
        return frozenset()
    known = NOISE_WORDS | BAR_WORDS if tag in BLOCK or not in_content else NOISE_WORDS
    if not in_content:
        known = known | HINT_WORDS
        if tag in BLOCK and tag != "article":
            known = known | OUTER_WORDS
    return frozenset({w.lower() for w in _WORD.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")} & known)


def parse(page: str) -> tuple[Element, list[tuple[Element, str, str]]]:
    """The root of the page's block elements, and its blocks of text in order, each with the
    element it stands in, without and with what inline elements of a role word hold. References are
    decoded, white space is collapsed, empty blocks are left out; what is hidden or noise by tag or
    ARIA role is not read, what stands below a role word is."""
    root = Element("", number("root"), None, False, False)
    stack, blocks, held, held_whole = [root], [], [], []
    inline_noise: list[str] = []  # open inline elements of a noise role
    inline_words: list[str] = []  # open inline elements of a role word
    keys: dict[tuple, tuple] = {}
    svg: list[str] = []  # open elements of a drawing
    svg_html = 0  # how many of them may hold HTML

    def hold(piece: str):
        held_whole.append(piece)
        if not inline_words:
            held.append(piece)

    def flush():
        if held_whole:
            text = " ".join(html.unescape("".join(held)).split())
            whole = " ".join(html.unescape("".join(held_whole)).split()) if len(held) < len(held_whole) else text
            held.clear()
            held_whole.clear()
            if whole:
                blocks.append((stack[-1], text, whole))
            if text:
                stack[-1].own.append(text)

    def close(to: int):
        flush()
        del stack[to:]

    pos = 0
    while m := _TOKEN.search(page, pos):
        if m.start() > pos and not stack[-1].noise and not inline_noise and not svg:
            hold(page[pos:m.start()])
        pos = m.end()
        tag = m["tag"]
        if tag is None:
            # an element of drawings and formulas that is closed by its own tag has no content
            if m["raw"] and not ((svg or m["raw"].lower().startswith("annotation")) and page[pos - 2] == "/"):
                pos = _RAW_END[m["raw"].lower()].search(page, pos).end()
            continue
        tag = tag.lower()
        if svg or tag == "svg" and not m["end"]:
            if m["end"]:
                if tag in svg or svg_html:
                    while tag in svg:
                        svg_html -= svg[-1] in SVG_HTML
                        if svg.pop() == tag:
                            break
                    continue
                svg.clear()
            elif svg and not svg_html and tag in SVG_ENDS:
                svg.clear()
            else:
                if not _closed(m["attrs"]):
                    svg.append(tag)
                    svg_html += tag in SVG_HTML
                continue
        if tag not in BLOCK:
            if tag in ("br", "td", "th", "wbr", "option"):
                hold(" " if tag != "wbr" else "")
            elif m["end"]:
                opened = inline_noise or inline_words
                if opened and tag == opened[-1]:
                    opened.pop()
            elif tag in VOID:
                pass
            elif inline_noise:
                if tag == inline_noise[-1]:
                    inline_noise.append(tag)
            elif tag in NOISE_TAGS or m["attrs"]:
                attrs = _attributes(m["attrs"])
                if _is_noise(tag, attrs, True):
                    inline_noise.append(tag)
                elif tag in inline_words[-1:] or not inline_words and _role_words(tag, attrs, stack[-1].content):
                    inline_words.append(tag)
            elif tag in inline_words[-1:]:
                inline_words.append(tag)
            continue
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    inline_noise.clear()
                    inline_words.clear()
                    break
            else:
                flush()
            continue
        inline_noise.clear()  # an inline element ends with its block
        inline_words.clear()
        flush()
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        if tag in ENDS:
            closed, scope = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closed.split():
                    close(k)
                    break
                if stack[k].tag in scope:
                    break
        if tag == "hr":
            continue
        up = stack[-1]
        at = (up.key, up.noise, up.content, tag, m["attrs"])
        if at not in keys:
            attrs = _attributes(m["attrs"])
            look = [_DIGITS.sub("0", attrs.get(n, "")) for n in ("class", "id", "role")]
            noise = up.noise or _is_noise(tag, attrs, up.content)
            role = attrs.get("role", "").lower()
            head = tag if tag in CONTENT_TAGS else role if role in CONTENT_ROLES else ""
            content = not noise and (up.content or head != "")
            keys[at] = (number(up.key, tag, *look), noise, content, head, _role_words(tag, attrs, up.content))
        element = Element(tag, keys[at][0], up, *keys[at][1:])
        up.children.append(element)
        stack.append(element)
    if pos < len(page) and not stack[-1].noise and not inline_noise and not svg:
        rest = page[pos:]
        hold(re.split(r"<[a-zA-Z/!?]", rest, maxsplit=1)[0])  # an unfinished tag ends the page
    close(1)
    return root, blocks
