"""Column expressions for names, phones, addresses and simple predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Titles that are removed from names.
TITLES = ["mr", "mrs", "ms", "sr", "sra", "dr", "dott", "sig", "mtro"]

# The characters that count as blank at either end of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Letters that have a case: a word for title-casing is a run of these.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def title_case(lowered: Column) -> Column:
    """Capitalise each run of cased letters, so ``o'neil`` gives ``O'Neil``.

    Plain words with blanks between them, the common case, take the cheap way.
    """
    runs = F.regexp_extract_all(lowered, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    special = lowered.rlike(r"[^\p{IsLowercase} ]")
    return F.when(special, F.array_join(F.transform(runs, F.initcap), "")).otherwise(
        F.initcap(lowered)
    )


def bare_name(c: Column) -> Column:
    """In lower case, without titles, brackets, dots and surrounding blanks."""
    titles = r"(?U)\b(" + "|".join(TITLES) + r")\b"
    return strip(F.translate(F.regexp_replace(F.lower(c), titles, ""), "().", ""))


def clean_name(c: Column) -> Column:
    return title_case(bare_name(c))


def clean_phone(c: Column) -> Column:
    return F.regexp_replace(c, "[^+0-9]", "")


def clean_address(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def fold(c: Column) -> Column:
    """Lower case without surrounding blanks: the form in which names are searched."""
    return strip(F.lower(c))


def truthy(c: Column) -> Column:
    """Neither null nor empty."""
    return c.isNotNull() & (c != "")


def or_default(c: Column, default: Column) -> Column:
    """``c``, or ``default`` where ``c`` is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), default)


def address_key(c: Column) -> Column:
    """Equal for two addresses that match; null where an address is missing."""
    return F.when(truthy(c), F.replace(F.lower(c), F.lit(" "), F.lit("")))


def address_match(a: Column, b: Column) -> Column:
    return F.coalesce(address_key(a) == address_key(b), F.lit(False))


def names_in_fullname(name: Column, last_name: Column, fullname: Column) -> Column:
    """Both names occur in the full name; accents count, case does not."""
    found = F.lower(fullname).contains(fold(name)) & F.lower(fullname).contains(fold(last_name))
    return F.coalesce(truthy(name) & truthy(last_name) & truthy(fullname) & found, F.lit(False))


def prefix_filter(c: Column, wanted: str) -> Column:
    """Case-sensitive prefix; ``all`` in any case, or an empty text, lets every row pass."""
    if wanted.lower() == "all" or wanted == "":
        return F.lit(True)
    return c.startswith(wanted)


def is_ipv4(c: Column) -> Column:
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return F.coalesce(c.rlike(rf"^{octet}(\.{octet}){{3}}\z"), F.lit(False))


def day_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def second_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
