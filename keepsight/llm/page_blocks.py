"""Blocks of text of a raw web page, with the roles of the elements around them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import xxhash

#: Elements inside a line of text; all others end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
HIDDEN = frozenset(
    "head title script style noscript template textarea svg math iframe object canvas audio video "
    "select option button form".split()
)
#: How an element is hidden; a main part inside a form that wraps the page is not.
SHOWN, IN_FORM, HIDES = range(3)
ASIDE = frozenset("nav footer aside menu dialog".split())
MAIN = frozenset("article main".split())
#: Words of names that hint at parts beside the text; all other words of the name must be neutral.
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer header login masthead menu modal nav navbar navigation "
    "newsletter notice notices pagination popup promo promotion recommended related replies search "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
NEUTRAL_WORDS = frozenset("area block box container inner list outer section slot unit user wrap wrapper".split())
MAIN_WORDS = frozenset("article content main entry story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/a-zA-Z][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[a-z]+")


@dataclass(frozen=True, slots=True)
class Element:
    tag: str
    #: Number of the path of block elements down to this one; digits in names are alike.
    role: int
    beside: bool
    main: bool
    link: bool
    inline: bool
    #: Inside an element whose content is never text.
    hidden: int


ROOT = Element("", 0, False, False, False, False, SHOWN)


@dataclass(slots=True)
class Block:
    role: int
    text: str
    #: Characters of the text that are links.
    link_chars: int
    beside: bool
    main: bool

    def digest(self) -> int:
        return xxhash.xxh3_64_intdigest(self.text.encode("utf-8", "surrogatepass")) - 2**63


@dataclass(slots=True)
class Token:
    """A role or a text of a page: how often it comes, and its place among all tokens at first."""

    #: Role of the element around; None for texts.
    parent: int | None
    at: int
    times: int = 0


def role_of(parent: int, name: str) -> int:
    """The number of the role `name` below the role `parent` (0 at the top)."""
    path = parent.to_bytes(8, "little", signed=True) + name.encode("utf-8", "surrogatepass")
    return xxhash.xxh3_64_intdigest(path, seed=1) - 2**63


def _named(names: list[list[str]], words: frozenset[str], neutral: frozenset[str] = frozenset()) -> bool:
    """Whether a name (given by its words) consists of such words alone, but for neutral ones."""
    return any(not words.isdisjoint(name) and all(w in words or w in neutral for w in name) for name in names)


def _open(tag: str, rest: str, parent: Element) -> Element:
    if tag in INLINE:
        link = parent.link or tag == "a"
        return Element(tag, parent.role, parent.beside, parent.main, link, True, parent.hidden)
    name, names = tag, []
    if "=" in rest:
        for attribute, *values in _NAMES.findall(rest):
            value = "".join(values).lower()
            names += [_PARTS.findall(one) for one in value.split()]
            name += f"[{attribute.lower()}={_DIGITS.sub('0', value)}]"
    main = parent.main or tag in MAIN or _named(names, MAIN_WORDS)
    role = role_of(parent.role, name)
    if tag in MAIN and parent.hidden == IN_FORM:
        return Element(tag, role, False, main, parent.link, False, SHOWN)
    hidden = max(parent.hidden, (IN_FORM if tag == "form" else HIDES) if tag in HIDDEN else SHOWN)
    beside = hidden != SHOWN or tag in ASIDE or (tag == "header" and not parent.main)
    named = tag not in ("html", "body") and _named(names, BESIDE_WORDS, NEUTRAL_WORDS)
    return Element(tag, role, parent.beside or beside or named, main, parent.link, False, hidden)


def parse(page: str) -> tuple[list[Block], dict[int, Token]]:
    """Blocks in page order, and the tokens: roles of elements and texts, in order of their first place."""
    blocks: list[Block] = []
    tokens: dict[int, Token] = {}
    stack = [ROOT]
    text: list[str] = []
    linked = 0

    def met(token: int, parent: int | None) -> None:
        tokens.setdefault(token, Token(parent, len(tokens))).times += 1

    def end_block() -> None:
        nonlocal linked
        whole = " ".join("".join(text).split())
        if whole:
            around = next(e for e in reversed(stack) if not e.inline)
            if not around.hidden:
                link_chars = min(linked, len(whole))
                blocks.append(Block(around.role, whole, link_chars, around.beside, around.main))
                met(blocks[-1].digest(), None)
        text.clear()
        linked = 0

    for token in _TOKEN.finditer(page):
        if token["text"] is not None:
            value = token["text"]
            if not (stack[-1].beside and stack[-1].tag in HIDDEN):
                value = html.unescape(value) if "&" in value else value
                text.append(value)
                if stack[-1].link:
                    linked += len(value.strip())
            continue
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if tag not in INLINE:
            end_block()
        if token["close"]:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if at:
                del stack[at:]
            continue
        if tag not in INLINE:
            while stack[-1].inline or stack[-1].tag == "p" or (stack[-1].tag == tag and tag in _ALONE):
                stack.pop()
            if tag in _LANDMARKS:  # an unclosed part beside the text ends here at the latest
                at = next((i for i, e in enumerate(stack) if e.tag in ("nav", "header")), 0)
                if at:
                    del stack[at:]
        element = _open(tag, token["rest"], stack[-1])
        if not element.inline:
            met(element.role, stack[-1].role)
        if tag not in VOID and not token["rest"].endswith("/"):
            stack.append(element)
    end_block()
    return blocks, tokens


_ALONE = frozenset("li dt dd tr td th option".split())
_LANDMARKS = frozenset("article main footer".split())
