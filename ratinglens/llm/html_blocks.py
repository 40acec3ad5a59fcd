"""Flat text blocks of a page's HTML, with what the markup around each says about it.

A block is the text between two tags that begin or end a block-level element. For each block its words, the words
inside links and a set of flags are kept. Reading takes time in proportion to the page, whatever it holds: comments,
scripts and quotes that are never closed are looked for once.
"""

import re
from collections import Counter
from html import unescape

HEADING, BOILER_TAG, BAD_NAME, IN_ARTICLE, GOOD_NAME, IN_HEADER, SENTENCE = (1 << i for i in range(7))

_BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section
    summary table tbody td tfoot th thead title tr ul video audio button select textarea iframe object noscript""".split())
_VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
_RAW = frozenset("script style textarea title iframe noscript template svg".split())      # text inside is not the page's
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOILER_TAGS = frozenset("nav footer aside form menu dialog button select fieldset".split())
_BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_BAD_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion
    sidebar side sidenav menu menus nav navbar navigation navi breadcrumb breadcrumbs crumbs footer foot bottombar comment comments commentlist
    disqus respond reply replies discussion cookie cookies consent gdpr notice notices alert warning popup overlay modal dialog
    newsletter subscribe subscription signup login signin register share sharing social socials follow related recommended
    recommendations recirc more widget widgets copyright legal disclaimer imprint toolbar search pagination pager paging tags
    tagcloud skip hidden byline meta dateline feedback rating poll donate paywall""".split())
_GOOD_NAMES = frozenset("article content contents post entry story main body text maincontent articlebody prose".split())
_HEADER_NAMES = frozenset("header masthead topbar head branding sitename".split())
_NEUTRAL = frozenset("with has no without is js".split())
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?=[\s=/]|$)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s"'>]*)))?""", re.I)
_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_TAG_STEP = re.compile(r""">|=\s*(["'])""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _flags_of(tag: str, attributes: str, above: int) -> int:
    """Flags of an element's inside, from those around it."""
    flags = above
    if tag in _BOILER_TAGS:
        flags |= BOILER_TAG
    if tag in ("article", "main"):
        flags |= IN_ARTICLE
    if tag == "header":
        flags |= IN_HEADER
    if tag in ("html", "body") or not attributes:
        return flags
    good = bad = header = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "role" and value.strip().lower() in _BAD_ROLES or name == "hidden" or (
                name == "aria-hidden" and value.strip().lower() == "true") or (
                name == "style" and "display:none" in value.replace(" ", "").lower()):
            flags |= BOILER_TAG
        elif name == "role" and value.strip().lower() in ("main", "article"):
            flags |= IN_ARTICLE
        elif name in ("class", "id"):
            for token in value.split():
                parts = {p.lower() for p in _PART.findall(token)}
                if parts & _BAD_NAMES and not (parts & _GOOD_NAMES and parts & _NEUTRAL):
                    bad = True
                elif parts & _HEADER_NAMES:
                    header = True
                elif parts & _GOOD_NAMES:
                    good = True
    if bad:
        flags |= BAD_NAME
    elif good:
        flags |= GOOD_NAME
    if header:
        flags |= IN_HEADER
    return flags


def _end_of_tag(html: str, at: int, unclosed: dict[str, int]) -> int:
    """Place behind the '>' of the tag whose name ends at ``at``; quoted values may hold one. The end if there is none."""
    while True:
        step = _TAG_STEP.search(html, at)
        if step is None:
            return len(html)
        at, quote = step.end(), step.group(1)
        if not quote:
            return at
        close = -1 if at >= unclosed.get(quote, len(html)) else html.find(quote, at)
        if close < 0:
            unclosed[quote] = min(at, unclosed.get(quote, at))
        else:
            at = close + 1


def _end_of_raw(html: str, lower: str, tag: str, at: int) -> int:
    """Place of the end tag of a raw element, the end of the page if there is none."""
    close = lower.find(f"</{tag}", at)
    return len(html) if close < 0 else close


def text_blocks(html: str | None) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, flags) of each block with text, in page order; references decoded, white space single."""
    if not html:
        return []
    lower = html.lower() if html.isascii() else re.sub("[A-Z]+", lambda m: m.group().lower(), html)
    blocks, pieces, stack = [], [], []          # pieces: (text, whether in a link); stack: (tag, flags inside, whether heading)
    unclosed: dict[str, int] = {}
    opened = Counter()                          # elements of the stack by tag
    at, in_link, flags, heading = 0, False, 0, False

    def flush():
        nonlocal pieces
        text = " ".join(unescape("".join(p for p, _ in pieces)).split())
        if text:
            words = text.count(" ") + 1
            linked = sum(len(unescape(p).split()) for p, link in pieces if link)
            blocks.append((text, words, min(linked, words), flags | (HEADING if heading else 0) | (
                SENTENCE if text.rstrip("\"'»”’)").endswith((".", "!", "?", "…", ":", ";")) else 0)))
        pieces = []

    def leave(place):
        nonlocal flags, heading
        for tag, _, _ in stack[place:]:
            opened[tag] -= 1
        del stack[place:]
        _, flags, heading = stack[-1] if stack else ("", 0, False)

    while at < len(html):
        open_at = html.find("<", at)
        if open_at < 0:
            open_at = len(html)
        if open_at > at:
            pieces.append((html[at:open_at], in_link))
        if open_at == len(html):
            break
        after = html[open_at + 1:open_at + 2]
        closing = after == "/"
        named = _NAME.match(html, open_at + 1 + closing)
        if named is None:
            if html.startswith("<!--", open_at):
                end = html.find("-->", open_at + 4)
                at = len(html) if end < 0 else end + 3
            elif after in ("!", "?", "/"):
                end = html.find(">", open_at)
                at = len(html) if end < 0 else end + 1
            else:
                pieces.append(("&lt;", in_link))
                at = open_at + 1
            continue
        tag = named.group().lower()
        at = _end_of_tag(html, named.end(), unclosed)
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append((" ", in_link))
        if tag in _RAW and not closing:
            if not html.startswith("/>", at - 2) or tag != "svg":
                at = _end_of_raw(html, lower, tag, at)
        if tag not in _BLOCK_TAGS:
            continue
        flush()
        if closing:
            in_link = False
            if opened[tag]:
                leave(next(place for place in range(len(stack) - 1, -1, -1) if stack[place][0] == tag))
        elif tag not in _VOID:
            if stack and stack[-1][0] in _CLOSES.get(tag, ()):
                leave(len(stack) - 1)
            if stack and stack[-1][0] == "p" and tag != "p":
                leave(len(stack) - 1)
            flags, heading = _flags_of(tag, html[named.end():at - 1], flags), heading or tag in _HEADINGS
            stack.append((tag, flags, heading))
            opened[tag] += 1
    flush()
    return blocks
