"""HTML to text in built-in string functions.

Patterns have no back-references, a tag ends before the next ``<`` and an element that
is never closed runs to the end of the page, so a page is scanned in linear time.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose content is not text of the page.
DROPPED_ELEMENTS = [
    "head", "script", "style", "noscript", "template", "nav", "footer", "aside", "form", "button",
    "select", "textarea", "iframe", "object", "svg", "canvas", "audio", "video", "map", "menu", "dialog",
]
# Elements that end a line of text.
BLOCK_ELEMENTS = [
    "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "caption",
    "thead", "tbody", "tr", "section", "article", "main", "header", "blockquote", "pre", "figure",
    "figcaption", "address", "details", "summary", "body", "html", "hr", "br",
]
# Elements that hold no text even where a page has nothing else.
HIDDEN_ELEMENTS = ["script", "style", "noscript", "template"]


def _without(tags: list[str], head: str = "") -> str:
    elements = "|".join(rf"{tag}\b.*?(?:</{tag}[^<>]*>|\z)" for tag in tags)
    return rf"(?is)<!--.*?(?:-->|\z)|<(?:{head}{elements})"


DROP_PATTERN = _without(DROPPED_ELEMENTS)
# For pages that the rules leave without text: a head ends where it is closed or the body opens.
HIDDEN_PATTERN = _without(HIDDEN_ELEMENTS, r"head\b.*?(?:</head[^<>]*>|<body\b[^<>]*>|\z)|")
LINK_OPEN_PATTERN = r"(?i)<a\b[^<>]*>"
LINK_CLOSE_PATTERN = r"(?i)</a\s*>"
BLOCK_PATTERN = r"(?i)</?(?:" + "|".join(BLOCK_ELEMENTS) + r")\b[^<>]*>"
CELL_PATTERN = r"(?i)<t[dh]\b[^<>]*>"
TAG_PATTERN = r"<[A-Za-z/!?][^<>]*>"
BLANK_PATTERN = r"[ \t\x0B\f\r\x{00A0}]+"
LINE_PATTERN = r" ?\n[ \n]*"
ENTITY_PATTERN = r"^(#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"
# Private-use characters that mark link text while a page is split into blocks.
LINK_START, LINK_END = "", ""
MARK_PATTERN = f"[{LINK_START}{LINK_END}]"
LINK_SPAN_PATTERN = f"{LINK_START}[^{LINK_END}]*"
MAX_LINK_SHARE = 0.5


def _named_entities() -> Column:
    pairs = [F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))]
    return F.create_map(*pairs)


def _code_point(name: Column) -> Column:
    """The number of a reference; zeros in front do not count and zero itself is null."""
    hexadecimal = F.lower(F.substring(name, 2, 1)) == "x"
    digits = F.regexp_extract(name, "^#[xX]?0*(.*)$", 1)
    return F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.nullif(digits, F.lit(""))).cast("bigint")


def _character(code: Column) -> Column:
    valid = ((code >= 1) & (code <= 0xD7FF)) | ((code >= 0xE000) & (code <= 0x10FFFF))
    safe = F.when(valid, code).otherwise(F.lit(0xFFFD).cast("bigint"))
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def _decoded(piece: Column) -> Column:
    """What follows one ``&``, with the reference at its start resolved when it is known."""
    name = F.regexp_extract(piece, ENTITY_PATTERN, 1)
    char = (
        F.when(name == "", F.lit(None))
        .when(name == "amp", F.lit("&"))
        .when(F.startswith(name, F.lit("#")), _character(_code_point(name)))
        .otherwise(F.try_element_at(_named_entities(), name))
    )
    rest = F.substr(piece, F.length(name) + 2)
    return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))


def decode_entities(text: Column) -> Column:
    """Character references resolved once, left to right."""
    pieces = F.split(text, "&")
    resolved = F.transform(
        F.array(pieces),
        lambda p: F.concat(F.get(p, F.lit(0)), F.array_join(F.transform(F.slice(p, F.lit(2), F.size(p)), _decoded), "")),
    )
    return F.when(F.contains(text, F.lit("&")), F.get(resolved, F.lit(0))).otherwise(text)


def marked_text(html: Column, drop: str = DROP_PATTERN) -> Column:
    """Tags and what ``drop`` matches gone, blocks on lines of their own, link text between marks."""
    text = F.regexp_replace(html, drop, "")
    text = F.regexp_replace(text, LINK_OPEN_PATTERN, LINK_START)
    text = F.regexp_replace(text, LINK_CLOSE_PATTERN, LINK_END)
    text = F.regexp_replace(text, BLOCK_PATTERN, "\n")
    text = F.regexp_replace(text, CELL_PATTERN, " ")
    return F.regexp_replace(text, TAG_PATTERN, "")


def folded(text: Column) -> Column:
    """Runs of blanks to one space, runs of line breaks to one, none at the ends."""
    text = F.regexp_replace(text, BLANK_PATTERN, " ")
    return trimmed(F.regexp_replace(text, LINE_PATTERN, "\n"))


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")


def has_marks(text: Column) -> Column:
    return F.contains(text, F.lit(LINK_START)) | F.contains(text, F.lit(LINK_END))


def unmarked(text: Column) -> Column:
    """Already folded text without its marks, folded again; where it has none, only its ends can change."""
    return F.when(has_marks(text), folded(F.regexp_replace(text, MARK_PATTERN, ""))).otherwise(trimmed(text))


def is_prose(block: Column, max_link_share: float = MAX_LINK_SHARE) -> Column:
    """True when at most ``max_link_share`` of a block's characters are link text; most blocks have no mark."""
    visible = F.length(F.regexp_replace(block, MARK_PATTERN, ""))
    outside = F.length(F.regexp_replace(F.regexp_replace(block, LINK_SPAN_PATTERN, ""), MARK_PATTERN, ""))
    prose = (visible > 0) & ((visible - outside) <= F.lit(max_link_share) * visible)
    plain = (F.length(block) > 0) & F.lit(max_link_share >= 0)
    return F.when(has_marks(block), prose).otherwise(plain)
