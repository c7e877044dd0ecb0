"""Column expressions of the cleaning job.

Every function returns a ``Column`` built from Spark built-ins, so it runs
inside whole-stage codegen; there is no Python UDF anywhere. A parser that
"raises" in the original application yields ``null`` here, and callers turn
that null into a reject flag.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valorem import schema as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- money / numbers --------------------------------------------------------

# Number forms that the original accepted (digits may be grouped by single underscores); Java's
# parser would also take suffixes such as 5D or 5f.
NUMBER_FORM = r"^\s*+[+-]?+(?:\d++(?:_\d++)*+(?:\.(?:\d++(?:_\d++)*+)?+)?+|\.\d++(?:_\d++)*+)(?:[eE][+-]?+\d++)?+\s*+$"


#: Characters with which the cast and the form may differ; a text without them is left to the cast alone.
ODD_NUMBER = r"[_A-DF-Za-df-z\x00-\x08\x0E-\x1F]"


def number(text: Column) -> Column:
    """Text -> double where it has the form of a number, else null."""
    odd = F.when(text.rlike(NUMBER_FORM), F.translate(F.trim(text), "_", "").try_cast("double"))
    return F.when(text.rlike(ODD_NUMBER), odd).otherwise(text.try_cast("double"))


def with_money(df: DataFrame, texts: dict[str, str | Column]) -> DataFrame:
    """Money text -> double, under the names that are the keys.

    null, '' and '-' -> 0; the currency sign and thousands commas are
    removed; an 'M' (tested first) multiplies by 1e6, a 'K' by 1e3. A bad
    plain number gives 0, a bad number next to 'M'/'K' gives null (the
    original raised and skipped the row).

    Step by step, each a projection of its own, so that each is done once a cell.
    """
    def text(n: str) -> Column:
        return _c(texts[n])

    bare = {f"_{n}_bare": F.when(text(n).isNull() | text(n).isin("", "-"), F.lit("0"))
            .otherwise(F.replace(F.replace(text(n), F.lit("€"), F.lit("")), F.lit(","), F.lit(""))) for n in texts}
    out = df.withColumns(bare)
    out = out.withColumns({f"_{n}_scale": F.when(F.contains(f"_{n}_bare", F.lit("M")), F.lit(1e6))
                           .when(F.contains(f"_{n}_bare", F.lit("K")), F.lit(1e3)) for n in texts})
    out = out.withColumns({f"_{n}_digits": F.when(F.col(f"_{n}_scale") == 1e6, F.replace(f"_{n}_bare", F.lit("M"), F.lit("")))
                           .when(F.col(f"_{n}_scale") == 1e3, F.replace(f"_{n}_bare", F.lit("K"), F.lit("")))
                           .otherwise(F.col(f"_{n}_bare")) for n in texts})
    out = out.withColumns({n: F.coalesce(number(F.col(f"_{n}_digits")) * F.coalesce(f"_{n}_scale", F.lit(1.0)),
                                         F.when(F.col(f"_{n}_scale").isNull(), F.lit(0.0))) for n in texts})
    return out.drop(*[f"_{n}_{part}" for n in texts for part in ("bare", "scale", "digits")])


def strip(text: str | Column) -> Column:
    """Leading and trailing whitespace of every kind removed (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(text), r"^\s+|\s+$", "")


def leading_int(text: str | Column) -> Column:
    """Leading integer of the stripped text ('80-1' -> 80), else 0."""
    digits = F.regexp_extract(strip(text), r"^(\d+)", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def digits_int(text: str | Column) -> Column:
    """All-digit stripped text -> int, anything else (or overflow) -> 0."""
    t = strip(text)
    return F.when(t.rlike(r"^\d+$"), F.coalesce(t.try_cast("int"), F.lit(0))).otherwise(F.lit(0))


def team(team_text: str | Column, contract_text: str | Column) -> Column:
    """'Free' when the contract mentions it or the team is empty."""
    tm = F.coalesce(strip(team_text), F.lit(""))
    ct = F.coalesce(strip(contract_text), F.lit(""))
    return F.when(ct.contains("Free") | (tm == ""), F.lit("Free")).otherwise(tm)


def position_category(code: str | Column) -> Column:
    """Position code -> category; unknown codes are lower-cased as they are."""
    c = _c(code)
    expr = None
    for category, codes in S.POSITION_GROUPS:
        cond = c.isin(codes)
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr.otherwise(F.lower(c))


# --- categories and segments -----------------------------------------------

def normalized_category(category: str | Column = "Position category") -> Column:
    """lower-case, null -> 'unknown'."""
    return F.coalesce(F.lower(_c(category)), F.lit(S.UNKNOWN_CATEGORY))


def category_index(category: str | Column = "Position category") -> Column:
    """Category -> 0.0..3.0, anything else 4.0 (applied to the normalised text)."""
    c = normalized_category(category)
    expr = reduce(lambda acc, kv: acc.when(c == kv[0], F.lit(float(kv[1]))),
                  S.CATEGORY_INDEX[1:],
                  F.when(c == S.CATEGORY_INDEX[0][0], F.lit(float(S.CATEGORY_INDEX[0][1]))))
    return expr.otherwise(F.lit(float(S.OTHER_CATEGORY_INDEX)))


def model_segment(index: str | Column) -> Column:
    """Category index -> 'goalkeeper' | 'field' | null (excluded)."""
    i = _c(index)
    return (F.when(i.isin([float(x) for x in S.GOALKEEPER_INDEXES]), F.lit("goalkeeper"))
            .when(i.isin([float(x) for x in S.FIELD_INDEXES]), F.lit("field")))


def feed_route(category: str | Column = "Position category") -> Column:
    """Listener routing: 'gardien' -> goalkeeper, everything else -> field."""
    c = F.lower(F.coalesce(_c(category), F.lit("")))
    return F.when(c == "gardien", F.lit("goalkeeper")).otherwise(F.lit("field"))


# --- numeric normalisation ---------------------------------------------------

def truncate_to_double(c: str | Column) -> Column:
    """Cast to integer (truncating toward zero) then back to double.

    Uses a 64-bit ``try_cast`` so values past the 32-bit range (3e9) neither
    throw under ANSI mode nor wrap.
    """
    return _c(c).try_cast("bigint").cast("double")


def capped(c: str | Column, cap: float) -> Column:
    """Upper cap; nulls stay null (``least`` would skip them)."""
    x = _c(c)
    return F.when(x > F.lit(cap), F.lit(float(cap))).otherwise(x)
