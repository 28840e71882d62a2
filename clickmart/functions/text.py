"""Text cleaning."""

from pyspark.sql import functions as F

# Every character that counts as white space in Unicode text, plus the four ASCII separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Words that stand for a missing value.
NULL_WORDS = ("none", "null", "nan")


def strip(column):
    return F.trim(column, F.lit(WHITESPACE))


def clean_text(column):
    """Trimmed text; null where it is blank or a word for null in any case."""
    text = strip(column.cast("string"))
    # The length test keeps long values (URLs) away from the lower-casing.
    null_word = (F.octet_length(text) <= 4) & F.lower(text).isin("", *NULL_WORDS)
    return F.when(~null_word, text)


def blank_to_null(column):
    return F.nullif(column, F.lit(""))


def first_filled(*columns):
    """First text that is neither null nor empty; the last one as it is."""
    return F.coalesce(*[blank_to_null(column) for column in columns[:-1]], columns[-1])


def collapse_spaces(column):
    """White space runs become one space, ends trimmed, blank becomes null."""
    return blank_to_null(strip(F.regexp_replace(column, WHITESPACE_RUN, " ")))


def present(df, names):
    """Those of ``names`` that are columns of ``df``, as text columns, in the order given."""
    known = set(df.columns)
    return [F.col(name).cast("string") for name in names if name in known]


def coalesce_raw(df, names):
    """First value that is not null. Empty text counts as a value."""
    columns = present(df, names)
    return F.coalesce(*columns) if columns else F.lit(None).cast("string")


def coalesce_clean(df, names):
    """First value left after cleaning."""
    columns = [clean_text(column) for column in present(df, names)]
    return F.coalesce(*columns) if columns else F.lit(None).cast("string")


def percentage(part, whole):
    """``part`` of ``whole`` in percent, two decimals, 0 where there is no whole."""
    share = F.round(part.cast("double") * F.lit(100.0) / F.nullif(whole, F.lit(0).cast("bigint")), 2)
    return F.when(whole <= 0, F.lit(0.0)).otherwise(share)
