"""Text blocks of one HTML page, with the region that each lies in.

A small tag reader, not a full HTML parser: it keeps the stack of open elements, ends raw-text
elements only at their own end tag, closes open paragraphs and list items where a new block begins, and
ignores end tags that match nothing.
"""

from __future__ import annotations

import html
import re

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li",
         "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "option"}
#: Elements that a new one of the listed kind closes.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "article", "main", "body", "html", "div", "section", "nav", "aside", "footer", "header", "form", "td", "th"}
#: Elements that never hold article text.
CHROME = {"nav", "footer", "aside", "form", "button", "select", "input", "dialog", "menu", "object", "audio", "video", "canvas", "svg", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
#: Words in a class or id that name page furniture, and those that name the article's own container.
FURNITURE = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar\w*|side-?bar|menu\w*|nav|navbar|navigation|breadcrumbs?|foot|footer|masthead|"
    r"topbar|cookies?|consent|gdpr|notices?|notification|popup|modal|overlay|newsletter|subscri\w+|signup|sign-up|shar(?:e|ing)|social|related|recommend\w*|"
    r"teasers?|comments?|commentlist|disqus|respond|repl(?:y|ies)|widgets?|toolbar|paginat\w+|pager|login|search\w*|hidden|skip\w*|copyright|tags?|byline-ads)(?=$|[-_\s])", re.I)
HEADER = re.compile(r"(?:^|[-_\s])(?:site-?header|page-?header|top-?header|header)(?=$|[-_\s])", re.I)
CONTENT = re.compile(r"^(?:(?:main|article|post|entry|story|page|blog|news)[-_]?)?(?:content|body|text|article|main|post|entry|story)$", re.I)


def _attributes(text: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(text)} if text else {}


def _is_furniture(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    if tag in CHROME or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or attributes.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    if tag == "main":
        return False
    return bool(FURNITURE.search(names)) or (not inside and bool(HEADER.search(names)))


def blocks(page: str) -> list[tuple[str, bool, bool]]:
    """(text, in the article's container, furniture) of every non-empty block in page order."""
    out: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, furniture so far, inside a container so far
    text: list[str] = []

    def flush():
        if text:
            words = " ".join("".join(text).split())
            text.clear()
            if words:
                furniture, inside = stack[-1][1:] if stack else (False, False)
                out.append((words, inside, furniture))

    def close(at: int):
        flush()
        del stack[at:]

    position, end = 0, len(page)
    while position < end:
        found = TOKEN.match(page, position)
        position = found.end()
        name = found[2]
        if name is None:
            piece = found[0]
            if piece[0] != "<" or piece == "<":
                text.append(html.unescape(piece) if "&" in piece else piece)
            elif piece.startswith("<![CDATA["):
                text.append(piece[9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if found[1]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == name:
                    if name in BLOCK or any(s[0] in BLOCK for s in stack[at:]) or stack[at][1] != (stack[at - 1][1] if at else False):
                        close(at)
                    else:
                        del stack[at:]
                    break
            continue
        if name in ("br", "hr"):
            text.append(" ")
            continue
        if name in VOID:
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, position)
            position = stop.end() if stop else end
            continue
        attributes = _attributes(found[3])
        if name in BLOCK:
            flush()
            for at in range(len(stack) - 1, -1, -1):
                tag = stack[at][0]
                if tag == "p":
                    del stack[at:]
                    break
                if tag in SCOPE:
                    break
        if name in CLOSED_BY:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in CLOSED_BY[name]:
                    close(at)
                    break
                if stack[at][0] in SCOPE - {"td", "th"}:
                    break
        furniture, inside = stack[-1][1:] if stack else (False, False)
        bad = furniture or _is_furniture(name, attributes, inside)
        if bad != furniture and name not in BLOCK:
            flush()
        if not bad and not inside:
            names = [*attributes.get("class", "").split(), attributes.get("id", "")]
            inside = name in ("article", "main") or attributes.get("role", "").lower() in ("main", "article") or any(map(CONTENT.match, names))
        if found[3].endswith("/") and name not in BLOCK:
            continue
        stack.append((name, bad, inside))
    flush()
    return out
