"""Column expressions shared by all plans. Every function is Column -> Column
and stays inside generated code; none of them is a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: grade sets, load rules and tier colours -----------------
PASS_GRADES = ("HD", "DI", "CR", "PA")
FAIL_GRADES = ("NN", "WN")
IN_PROGRESS_GRADE = "IP"
WITHDRAWN_PRE_CENSUS = "Withdrawn pre-census"
TIER_COLOURS = {"P1": "#F2B8B5", "P2": "#F7E1A0", "P3": "#BFE3DC"}
OTHER_TIER_COLOUR = "#E6E6E6"
# ---------------------------------------------------------------------------


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------- text --
def strip(c) -> Column:
    return F.trim(col(c))


def proper_case(c) -> Column:
    """First letter upper, all the rest lower: ``mary ANN`` gives ``Mary ann``."""
    tidy = F.lower(F.trim(col(c)))
    return F.concat(F.upper(F.left(tidy, F.lit(1))), F.substr(tidy, F.lit(2)))


def upper_trim(c) -> Column:
    return F.upper(F.trim(col(c)))


def null_if_empty(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def full_name(first, last) -> Column:
    """NULL when either part is NULL."""
    return F.concat(col(first), F.lit(" "), col(last))


def composite_key(*parts) -> Column:
    """``a|b|c``; NULL when any part is NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(col(part).cast("string"))
    return F.concat(*pieces)


def number_text(c) -> Column:
    """A double as plain digits, never in scientific notation."""
    c = col(c)
    size = F.abs(c)
    plain = (c == 0) | ((size >= F.lit(0.001)) & (size < F.lit(1e7)))
    digits = F.rtrim(c.try_cast("decimal(38,10)").cast("string"), F.lit("0"))
    digits = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(F.isnan(c), "nan").when(plain, c.cast("string")).otherwise(digits)


def starts_with(c, prefix: str) -> Column:
    return col(c).startswith(prefix)


def search_text(c, word: str) -> Column:
    """True where the word occurs anywhere, whatever its case; NULL text is no match."""
    return F.coalesce(F.lower(col(c)).contains(word.lower()), F.lit(False))


def left_text(c, n: int) -> Column:
    return F.substring(col(c), 1, n)


def has_item(c, item, sep: str = "|") -> Column:
    """Is ``item`` one of the ``sep``-joined parts of ``c``?"""
    return F.array_contains(split_items(c, sep), item if isinstance(item, Column) else F.lit(item))


def split_items(c, sep: str = "|") -> Column:
    return F.split(col(c), f"[{sep}]")


def list_min(c) -> Column:
    return F.array_min(col(c))


def default_to(c, value) -> Column:
    return F.coalesce(col(c), F.lit(value))


# ------------------------------------------------------------------ casts --
def to_double(c) -> Column:
    """Text to double; anything that is not a number becomes NULL.

    The JVM would read ``75F`` or ``75d`` as a number with a type suffix.
    """
    c = col(c)
    letters = F.lower(c) != F.upper(c)  # most texts have none and need no pattern
    return F.when(~(letters & c.rlike(r"[0-9.][dDfF]\s*$")), c.try_cast("double"))


def to_date(c) -> Column:
    """ISO text to date; a bare year or month is not a date."""
    c = col(c)
    return F.when(c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"), c.try_cast("date"))


def mixed_date(c) -> Column:
    """``31/12/1999`` or ``1999-12-31``; an impossible day becomes NULL."""
    c = col(c)
    return F.when(c.contains("/"), F.try_to_date(F.trim(c), "d/M/yyyy")).otherwise(to_date(c))


def strict(c, dtype: str) -> Column:
    """A cast that stops the job on a bad value (ANSI mode)."""
    return col(c).cast(dtype)


def tri_state(c, yes: str = "Y", no: str = "N") -> Column:
    c = col(c)
    return F.when(c == yes, "Yes").when(c == no, "No").otherwise("Unknown")


def term_year(c) -> Column:
    return F.substring(col(c), 1, 4).cast("int")


# ---------------------------------------------------------------- numbers --
def pass_flag(grade) -> Column:
    """True / False for final grades, NULL while a unit has none."""
    grade = col(grade)
    return F.when(grade.isin(*PASS_GRADES), True).when(grade.isin(*FAIL_GRADES), False)


def certified_load(status, load) -> Column:
    """Load that counts at census; an unknown status counts as none."""
    return F.when(col(status) != WITHDRAWN_PRE_CENSUS, col(load)).otherwise(F.lit(0.0))


def passed_load(grade, load) -> Column:
    return F.when(col(grade).isin(*PASS_GRADES), col(load)).otherwise(F.lit(0.0))


def day_diff(end, start) -> Column:
    """Days from start to end; NULL when either is missing, negative if reversed."""
    return F.datediff(col(end), col(start))


def safe_ratio(a, b) -> Column:
    """a / b, NULL for a zero denominator."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def rounded(c, digits: int) -> Column:
    return F.round(col(c), digits)


def clip(c, low=None, high=None) -> Column:
    """Clamp; NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    c = col(c)
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def cut(c, edges: Sequence[float], labels: Sequence[str], outside: str = "nan") -> Column:
    """Right-closed bins ``(edges[i], edges[i+1]]``; everything else gets ``outside``."""
    c = col(c)
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        test = (c > low) & (c <= high)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(outside)


def stratum_key(*parts) -> Column:
    return F.concat_ws("|", *[col(p) for p in parts])


def tier_colour(tier) -> Column:
    head = left_text(tier, 2)
    out = None
    for prefix, colour in TIER_COLOURS.items():
        out = F.when(head == prefix, colour) if out is None else out.when(head == prefix, colour)
    return out.otherwise(OTHER_TIER_COLOUR)
