"""HTML cell expressions for listing extraction.

Pages are processed as text with built-in regex functions, executor-side:
scripts, styles and comments are removed first (they may contain markup such
as a ``</p>`` inside a string), every pattern is dot-all since pages contain
newlines, and tags are stripped from cell text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: entities decoded in cell text, in decoding order ('&amp;' last).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]

NOISE_PATTERN = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"
TAG_PATTERN = r"<[^>]*>"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_noise(html: str | Column) -> Column:
    return F.regexp_replace(_c(html), NOISE_PATTERN, "")


def element_pattern(tag: str) -> str:
    """Inner HTML of every ``<tag ...>...</tag>`` (non-greedy, dot-all)."""
    return rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"


def elements(html: str | Column, tag: str) -> Column:
    """array<string> of the inner HTML of each ``tag`` element."""
    return F.regexp_extract_all(_c(html), F.lit(element_pattern(tag)), 1)


def first_element(html: str | Column, tag: str) -> Column:
    """Inner HTML of the first ``tag`` element, or null when there is none."""
    inner = F.regexp_extract(_c(html), element_pattern(tag), 1)
    return F.when(_c(html).rlike(rf"(?is)<{tag}\b[^>]*>.*?</{tag}>"), inner)


def nested_elements(html: str | Column, tag: str) -> Column:
    """array<string>: inner HTML of each outermost ``tag`` element, elements of the same tag inside it included.

    The text is cut before every opening and closing ``tag``. Where the pieces
    open and close in turn, each opening piece is an element; otherwise an
    aggregate over the pieces, several times dearer, carries the depth. An
    element left open ends with the text; a closing tag without an opening one
    is passed over. Null gives null, a text without the tag an empty array.
    """
    # the blank keeps the piece before the first tag from looking like one
    pieces = F.split(F.concat(F.lit(" "), _c(html)), rf"(?i)(?=</?{tag}\b)")
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("inner"), F.array().cast("array<string>").alias("done"))

    def inside(x: Column) -> Column:
        return F.regexp_replace(x, r"^<[^>]*>?", "")

    def step(s: Column, x: Column) -> Column:
        closes = F.startswith(x, F.lit("</"))
        opens = F.startswith(x, F.lit("<")) & ~closes
        depth = s.depth + opens.cast("int") - (closes & (s.depth > 0)).cast("int")
        ends = closes & (s.depth == 1)
        inner = (F.when(ends, F.lit(""))
                 .when(s.depth > 0, F.concat(s.inner, x))
                 .when(opens, inside(x))
                 .otherwise(F.lit("")))
        return F.struct(depth.alias("depth"), inner.alias("inner"),
                        F.when(ends, F.concat(s.done, F.array(s.inner))).otherwise(s.done).alias("done"))

    def elements_of(cut: Column) -> Column:
        in_turn = F.transform(cut, lambda x, i: F.startswith(x, F.lit("</")) == ((i % 2 == 0) & (i > 0)))
        flat = F.transform(F.filter(cut, lambda x, i: i % 2 == 1), inside)
        by_depth = F.aggregate(cut, start, step, lambda s: F.when(s.depth > 0, F.concat(s.done, F.array(s.inner))).otherwise(s.done))
        return F.when(~F.array_contains(in_turn, False), flat).otherwise(by_depth)

    return F.get(F.transform(F.array(pieces), elements_of), F.lit(0))  # a lambda's argument: cut once


EDGE_SPACE_PATTERN = r"^\s+|\s+$"
# FIXED VALUES: the characters of \s.
EDGE_SPACE = " \t\n\x0b\f\r"


def text(fragment: str | Column) -> Column:
    """Visible text of a fragment: tags removed, entities decoded, leading and
    trailing whitespace of every kind stripped (inner whitespace kept)."""
    t = F.regexp_replace(_c(fragment), TAG_PATTERN, "")
    t = reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), ENTITIES, t)
    return F.btrim(t, F.lit(EDGE_SPACE))


def anchor_text(fragment: str | Column) -> Column:
    """Text of the first ``<a>`` in the fragment, '' when there is none."""
    frag = _c(fragment)
    return F.coalesce(text(first_element(frag, "a")), F.lit(""))


def anchor_href(fragment: str | Column) -> Column:
    """href of the first ``<a ... href="...">``, '' when there is none."""
    return F.regexp_extract(_c(fragment), r"(?is)<a\b[^>]*?href\s*=\s*\"([^\"]*)\"", 1)
