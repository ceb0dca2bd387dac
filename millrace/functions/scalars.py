"""Column-to-column functions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Month names in calendar order.
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
# The patterns text cleaning removes or collapses. ``(?U)`` makes
# the classes cover Unicode digits and whitespace.
CITATION = r"(?U)\[\d+\]"
BLANKS = r"(?U)\s+"
HEADER = r"={2,}.*?={2,}"
# What identifiers may hold, and what stands in for the rest.
NOT_IN_ID = "[^a-z0-9_]"
VALID_ID = "^[a-zA-Z0-9_]+$"
ID_PREFIX = "user_"
ID_DEFAULT = "anonymous"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_as_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``df`` with null for NaN in the floating columns (of ``cols``): both mean that the value is missing."""
    cols = df.columns if cols is None else cols
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: F.nanvl(F.col(f"`{c}`"), F.lit(None).cast(kinds[c]))
        for c in cols if isinstance(kinds[c], (T.DoubleType, T.FloatType))})


def pct_to_double(c) -> Column:
    """``' 13.5%'`` → 13.5; text that is not a number gives null."""
    return F.regexp_replace(F.trim(_c(c)), "%", "").try_cast("double")


def month_no(c) -> Column:
    """English month name → 1..12; null for anything else."""
    pairs = [F.lit(v) for i, m in enumerate(MONTHS, 1) for v in (m, i)]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def yes_no(c) -> Column:
    """'yes' → 1, 'no' → 0, anything else null."""
    return F.when(_c(c) == "yes", 1).when(_c(c) == "no", 0)


def minutes_between(start, end) -> Column:
    """Minutes from ``start`` to ``end`` at whole-second precision."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / 60


def calendar_parts(df: DataFrame, c: str, prefix: str = "pickup") -> DataFrame:
    """Add hour, day of week (1 = Sunday), month and year of a timestamp as ints."""
    return df.withColumns({
        f"{prefix}_hour": F.hour(c),
        f"{prefix}_dayofweek": F.dayofweek(c),
        f"{prefix}_month": F.month(c),
        f"{prefix}_year": F.year(c),
    })


def clean_text(c) -> Column:
    """Strip ``[n]`` citations, collapse whitespace, strip ``== headers ==``, trim.

    Headers go after the whitespace collapse, so a removed header leaves a
    double space. Null gives the empty string.
    """
    text = F.coalesce(_c(c), F.lit(""))
    for pattern, stand_in in ((CITATION, ""), (BLANKS, " "), (HEADER, "")):
        text = F.regexp_replace(text, pattern, stand_in)
    return F.trim(text)


def snippet(c, width: int = 180, mark: str = "…") -> Column:
    """Whitespace-collapsed text, cut at the last whole word that leaves room for ``mark``."""
    text = F.trim(F.regexp_replace(_c(c), BLANKS, " "))
    room = width - len(mark)
    head = F.regexp_extract(text, r"^(.{1,%d})(?: .*)?$" % room, 1)
    return F.when(F.length(text) <= width, text).otherwise(F.concat(F.rtrim(head), F.lit(mark)))


def iso_dates(df: DataFrame) -> list[Column]:
    """All columns of ``df``, timestamps and dates as ``yyyy-MM-dd`` text."""
    return [
        F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
        else F.col(f.name)
        for f in df.schema.fields
    ]


def to_json_row(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON text per row; dates as ISO days, nulls kept."""
    return df.select(F.to_json(F.struct(*iso_dates(df)), {"ignoreNullFields": "false"}).alias(name))


def sanitize_id(c, prefix: str = ID_PREFIX, default: str = ID_DEFAULT) -> Column:
    """Lower-case, dots to ``_``, other characters dropped, digits prefixed, empty → default."""
    text = F.regexp_replace(F.replace(F.lower(_c(c)), F.lit("."), F.lit("_")), NOT_IN_ID, "")
    text = F.when(text.rlike("^[0-9]"), F.concat(F.lit(prefix), text)).otherwise(text)
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(default)).otherwise(text)


def is_valid_id(c) -> Column:
    """1 to 255 characters, only letters, digits and ``_``; null is not valid."""
    c = _c(c)
    return F.coalesce(F.length(c).between(1, 255) & c.rlike(VALID_ID), F.lit(False))


def first_pred(df: DataFrame, c: str) -> Column:
    """A scalar prediction column as it is, or the first element when it is an array."""
    if isinstance(df.schema[c].dataType, T.ArrayType):
        return F.try_element_at(F.col(c), F.lit(1))
    return F.col(c)


def pct_change(cur, prev) -> Column:
    """Signed percent change; a zero base gives +inf when the value rose, else 0."""
    cur, prev = _c(cur).cast("double"), _c(prev).cast("double")
    return F.when(
        prev == 0, F.when(cur > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    ).otherwise(F.try_divide(cur - prev, prev) * 100)


def trend_label(change) -> Column:
    """'increased' for a positive change, 'decreased' for every other known one."""
    change = _c(change)
    return F.when(change > 0, "increased").when(change.isNotNull(), "decreased")


def label_eq(c, value, name: str) -> Column:
    """Boolean label ``c == value``; a null stays null."""
    return (_c(c) == value).alias(name)


def tokens(c) -> Column:
    """Whitespace tokens of a text; none for blank or null text."""
    text = F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), BLANKS, " "))
    return F.filter(F.split(text, " "), lambda t: t != "")
