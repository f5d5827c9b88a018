"""`html_strip` character filter: one left-to-right scan.

One alternation finds, at each place, a comment, a raw-text element (script, style)
with its content, a tag, or an entity, whichever starts there; what it finds is
extracted once and classified: tags of block-level elements become a line break,
other markup nothing, an entity its character. Nothing is read twice, so
``&amp;lt;`` becomes the text ``&lt;``.

* A quoted attribute may hold ``>``; a tag whose quotes do not close ends at its first ``>``.
* An unclosed comment, script or style reaches to the end of the text.
* A tag starts with a letter, ``/``, ``!`` or ``?`` right after its bracket: ``a < b > c`` is text.
* Entities: the names of HTML 5, the old ones also without ``;`` and as the longest
  beginning of a longer name (``&notit;`` is ``¬it;``). Unknown names stay as they are.
  A number that is no character becomes the replacement character.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Block-level element names whose tags become a line break.
BLOCK_TAGS = ("address article aside blockquote br dd div dl dt fieldset figcaption figure "
              "footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre "
              "section table tbody td tfoot th thead title tr ul body").split()

#: Attributes: quoted values are skipped whole. Possessive, so a long tag needs no stack.
ATTRIBUTES = r"""[^"'>]*+(?:"[^"]*+"[^"'>]*+|'[^']*+'[^"'>]*+)*+"""


def _raw(name: str) -> str:
    return rf"<{name}(?:[\s/]{ATTRIBUTES})?>.*?(?:</{name}(?:[\s/][^>]*)?>|\z)"


MARKUP = "(?is)" + "|".join((
    r"<!--.*?(?:-->|\z)", _raw("script"), _raw("style"), rf"</?[a-z]{ATTRIBUTES}>", r"<[a-z/!?][^>]*+>",
    r"&(?:#x[0-9a-f]++;?|#[0-9]++;?|[a-z][a-z0-9]*+;?)"))
BLOCK = r"(?i)^</?(?:" + "|".join(BLOCK_TAGS) + r")[\s/>]"

#: Names that need no semicolon, longest first.
LEGACY = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: The names of HTML 4 and the legacy ones, looked up first; then the rest of HTML 5.
COMMON = {n: html5[n] for n in sorted({f"{n};" for n in name2codepoint} | {"apos;"} | set(LEGACY))}
RARE = {n: c for n, c in sorted(html5.items()) if n not in COMMON}


def _table(names: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])


def _entity(e: Column) -> Column:
    """The character(s) of an entity; the entity itself if its name is unknown."""
    is_hex = e.rlike("^&#[xX]")
    body = F.regexp_extract(e, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
    n = F.when(F.length(body).between(1, 7), F.when(is_hex, F.conv(body, 16, 10)).otherwise(body)).try_cast("bigint")
    ok = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    ch = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")  # big-endian when there is no byte-order mark
    name = F.substr(e, F.lit(2))
    old = F.regexp_extract(e, "^&(" + "|".join(LEGACY) + ")", 1)
    common = _table(COMMON)
    begins = F.concat(F.try_element_at(common, old), F.substr(e, F.length(old) + 2))
    return (F.when(e.startswith("&#"), F.when(ok, ch).otherwise(F.lit("�")))
             .otherwise(F.coalesce(F.try_element_at(common, name), F.try_element_at(_table(RARE), name), begins, e)))


def html_strip(s: Column) -> Column:
    pieces = F.split(s, MARKUP, -1)
    found = F.transform(F.regexp_extract_all(s, F.lit(MARKUP), 0),
                        lambda m: F.when(m.startswith("&"), _entity(m)).when(m.rlike(BLOCK), "\n").otherwise(""))
    merged = F.zip_with(pieces, F.concat(found, F.array(F.lit(""))), lambda p, m: F.concat(p, m))
    return F.when(s.contains("<") | s.contains("&"), F.array_join(merged, "")).otherwise(s)


CHAR_FILTERS = {"html_strip": html_strip}
