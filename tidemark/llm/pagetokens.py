"""An HTML page as a sequence of tokens: block tags and text blocks, each with the path of containers around it."""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/)?(?P<tag>[A-Za-z][^\s/<>]*)(?P<attrs>(?>[^<>\"']+|\"[^\"<]*\"|'[^'<]*')*+)>"
    r"|<(?P<loose_end>/)?(?P<loose>[A-Za-z][^\s/<>]*)[^<>]*(?:>|\Z)"  # an odd quote, or the page ends inside the tag
    r"|<[!?/][^<>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
_ATTR = re.compile(r"""([A-Za-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

# fixed values: elements by their role
CONTAINERS = frozenset(
    "html head body nav header footer aside main article section div form ul ol dl table tbody thead tr td th figure "
    "blockquote template noscript dialog fieldset menu details".split()
)
BREAKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address figcaption caption title option summary".split())
RAW = frozenset(["script", "style", "textarea", "title"])
NEVER_TEXT = frozenset("head script style nav footer aside form template noscript dialog menu button select iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HINT = re.compile(
    r"(?:^|[^a-z])(?:nav|navbar|navigation|menus?|sidebar|footer|masthead|topbar|breadcrumbs?|ads?|adverts?|advertisement|"
    r"sponsor(?:ed)?|promo|banner|cookies?|consent|gdpr|notices?|comments?|replies|disqus|share|sharing|social|related|"
    r"recommended|newsletter|subscribe|signup|login|popup|modal|overlay|widget|pagination|pager)(?:$|[^a-z])"
)


@dataclass(slots=True)
class Token:
    """`text` is None for a tag. `key` stands for the token with its path; `region` is True inside the page's main part."""

    key: int
    text: str | None
    skipped: bool
    region: bool


def _hash(*parts: str) -> int:
    data = "\x00".join(parts).encode("utf-8", "surrogatepass")
    return (zlib.crc32(data) << 31) ^ zlib.crc32(data[::-1], 0x5BD1E995)


def tokens(page: str) -> list[Token]:
    """Start tags of blocks and text blocks in page order; a block's white space is collapsed, references are decoded.

    Unclosed elements end where an outer one ends; an end tag that opens nothing is ignored. `skipped` marks text in
    elements that never hold a page's text and in containers whose class, id or role says menu, notice, advert, comment
    and the like. `region` is True in an article or main element.
    """
    out: list[Token] = []
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]
    words: list[str] = []

    def flush() -> None:
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            words.clear()
            if text:
                _, path, skipped, region = stack[-1]
                out.append(Token(_hash(path, "#", text), text, skipped, region))

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        if (text := m["text"]) is not None:
            words.append(text)
            continue
        tag, given = (m["tag"] or m["loose"] or "").lower(), m["attrs"] or ""
        if not tag:
            continue
        if m["end"] or m["loose_end"]:
            if tag in BREAKS:
                flush()
            if tag in CONTAINERS or tag in NEVER_TEXT:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, at)
            if tag == "title":
                out.append(Token(_hash(stack[-1][1], tag), None, True, False))
            at = end.end()
            continue
        if tag == "br":
            words.append(" ")
            continue
        if tag in BREAKS:
            flush()
        if tag == "body" and stack[-1][0] == "head":
            stack.pop()
        inside = tag in CONTAINERS or tag in NEVER_TEXT
        if not inside and tag not in BREAKS:
            continue
        _, path, skipped, region = stack[-1]
        attrs = {a.lower(): b or c or d for a, b, c, d in _ATTR.findall(given)} if given else {}
        name = f"{path}/{tag}.{attrs.get('class', '')}"
        out.append(Token(_hash(name), None, skipped, region))
        if not inside or tag in VOID or given.endswith("/"):
            continue
        hints = f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".lower()
        marked = tag not in ("html", "body", "article", "main") and bool(_HINT.search(hints))
        marked |= tag == "article" and bool(re.search(r"comment|reply", hints))
        marked |= tag == "header" and not region
        hidden = "hidden" in attrs or "display:none" in attrs.get("style", "").replace(" ", "")
        stack.append((
            tag, name, skipped or marked or hidden or tag in NEVER_TEXT,
            region or ((tag in ("article", "main") or attrs.get("role") == "main") and not (skipped or marked)),
        ))
    flush()
    return out


def main_text(page: str, template: frozenset[int]) -> str:
    """The text blocks of the main part that are neither skipped nor template tokens, joined by blank lines.

    The main part is what stands in article or main elements, or the whole page where these hold no such text.
    """
    blocks = [t for t in tokens(page) if t.text is not None and not t.skipped and t.key not in template]
    inside = [t for t in blocks if t.region]
    return "\n\n".join(t.text for t in inside or blocks)
