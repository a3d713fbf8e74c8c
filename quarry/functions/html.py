"""Native HTML extraction: title and main text.

The extraction is a fixed chain of regular expressions, so it runs as Catalyst
expressions (no Python worker, no DOM).  Time is linear in well-formed pages; a
page with many unclosed boilerplate tags is searched again for each of them.  Steps for the main text:

1. drop comments;
2. drop boilerplate blocks (script, style, nav, header, footer, aside, form,
   table);
3. keep the inner HTML of ``<article>``, else ``<main>``, else ``<body>``,
   else everything;
4. line breaks and block-level tags become newlines;
5. remaining tags are removed;
6. blank space around newlines is squeezed to one newline;
7. character references are decoded (named, decimal and hexadecimal);
8. the result is stripped; empty becomes null.

The same pattern strings are valid in Java regex and RE2, so the SQL oracle
can replay them.  Nested boilerplate blocks of the same tag are a known limit
of a regex extractor (the first closing tag ends the block).
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import bind, strip

# The patterns and entity table of the extraction spec above.
COMMENT_RE = r"(?s)<!--.*?-->"
BOILERPLATE_TAGS = ["script", "style", "nav", "header", "footer", "aside", "form", "table"]
BOILERPLATE_RE = "(?is)" + "|".join(
    rf"<{t}\b.*?</{t}\s*>" for t in BOILERPLATE_TAGS)
# the same matches; the alternatives are tried only where a tag begins
BOILERPLATE_AT_TAG_RE = "(?is)<(?:" + "|".join(rf"{t}\b.*?</{t}\s*>" for t in BOILERPLATE_TAGS) + ")"
CONTAINER_TAGS = ["article", "main"]
BODY_RE = r"(?is)<body\b[^>]*>(.*?)(?:</body\s*>|\z)"
BREAK_RE = r"(?i)<br\b[^>]*>"
BLOCK_TAGS = ["p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol",
              "section", "blockquote", "pre", "tr", "td", "th", "dd", "dt",
              "article", "main", "header", "footer"]
BLOCK_RE = r"(?i)</?(?:" + "|".join(BLOCK_TAGS) + r")\b[^>]*>"
TAG_RE = r"<[^>]*>"
NEWLINE_SQUEEZE_RE = r"[ \t\r]*\n[ \t\r\n]*"
TITLE_RE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
OG_TITLE_RES = [  # content after and before the property, in double and in single quotes
    r"""(?is)<meta\b[^<>]*?\bproperty\s*=\s*["']og:title["'][^<>]*?\bcontent\s*=\s*"([^"]*)["]""",
    r"""(?is)<meta\b[^<>]*?\bproperty\s*=\s*["']og:title["'][^<>]*?\bcontent\s*=\s*'([^']*)'""",
    r"""(?is)<meta\b[^<>]*?\bcontent\s*=\s*"([^"]*)"[^<>]*?\bproperty\s*=\s*["']og:title["']""",
    r"""(?is)<meta\b[^<>]*?\bcontent\s*=\s*'([^']*)'[^<>]*?\bproperty\s*=\s*["']og:title["']""",
]
H1_RE = r"(?is)<h1\b[^>]*>(.*?)</h1\s*>"
# Named character references of HTML 4 (the standard library's table) and the
# apostrophe; numeric references follow from their number.
NAMED = {**name2codepoint, "apos": 39}
DECIMAL_RE, HEX_RE, NAME_RE = r"^#0*([0-9]{1,7});", r"^#[xX]0*([0-9a-fA-F]{1,6});", r"^([A-Za-z][A-Za-z0-9]{1,30});"
REPLACEMENT = 0xFFFD


def container_re(tag: str) -> str:
    return rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD for numbers that are none."""
    bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    number = F.when(bad, F.lit(REPLACEMENT)).otherwise(code)
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def decode_entities(col: Column) -> Column:
    """Character references decoded once, from left to right; an ampersand
    that starts none stays."""
    def piece(x: Column) -> Column:
        after = F.call_function("substr", x, F.call_function("instr", x, F.lit(";")) + 1)
        decimal, hexa, name = (F.regexp_extract(x, r, 1) for r in (DECIMAL_RE, HEX_RE, NAME_RE))
        table = F.create_map(*[F.lit(v) for k, n in NAMED.items() for v in (k, chr(n))])
        named = bind(F.element_at(table, name), lambda sign: F.when(sign.isNotNull(), F.concat(sign, after)).otherwise(F.concat(F.lit("&"), x)))
        return (F.when(decimal != "", F.concat(_character(decimal.cast("long")), after))
                 .when(hexa != "", F.concat(_character(F.conv(hexa, 16, 10).cast("long")), after))
                 .otherwise(named))

    def decoded(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(piece(x))), "")
    return bind(col, lambda c: F.when(c.contains("&"), bind(F.split(c, "&"), decoded)).otherwise(c))


def _nonempty(col: Column) -> Column:
    """Null for an empty text; ``col``, read twice, is evaluated once."""
    return bind(col, lambda c: F.nullif(c, F.lit("")))


def main_html(html: Column) -> Column:
    """Inner HTML of the main content container, boilerplate removed."""
    cleaned = F.regexp_replace(F.regexp_replace(html, COMMENT_RE, ""), BOILERPLATE_AT_TAG_RE, "")

    def pick(h: Column) -> Column:
        candidates = [_nonempty(F.regexp_extract(h, container_re(t), 1)) for t in CONTAINER_TAGS]
        candidates.append(_nonempty(F.regexp_extract(h, BODY_RE, 1)))
        candidates.append(h)
        return F.coalesce(*candidates)

    return bind(cleaned, pick)


def extract_text(html: Column) -> Column:
    """Main text of a page; null when nothing is left."""
    t = main_html(html)
    t = F.regexp_replace(t, BREAK_RE, "\n")
    t = F.regexp_replace(t, BLOCK_RE, "\n")
    t = F.regexp_replace(t, TAG_RE, "")
    t = F.regexp_replace(t, NEWLINE_SQUEEZE_RE, "\n")
    t = decode_entities(t)
    return _nonempty(strip(t))


def _clean_inline(col: Column) -> Column:
    return _nonempty(strip(decode_entities(F.regexp_replace(col, TAG_RE, ""))))


def extract_title(html: Column) -> Column:
    """Metadata title (og:title), else ``<title>``, else the first ``<h1>``."""
    og = F.coalesce(*[_clean_inline(F.regexp_extract(html, r, 1)) for r in OG_TITLE_RES])
    title = _clean_inline(F.regexp_extract(html, TITLE_RE, 1))
    h1 = _clean_inline(F.regexp_extract(html, H1_RE, 1))
    return F.coalesce(og, title, h1)


def char_count(text: Column) -> Column:
    """Characters (code points) of the stripped text; 0 when there is none."""
    return F.coalesce(F.length(text), F.lit(0)).cast("int")
