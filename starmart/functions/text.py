"""Text repair rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank, i.e. Unicode white space and four ASCII separators.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_CASED = r"[\p{Lu}\p{Ll}\p{Lt}]"

# The accepted shape of an e-mail address and its one repairable defect.
EMAIL_SHAPE = r"(?U)^[^@\s]+@[^@\s]+\.[^@\s]+$"
SPELLED_AT = " at "

# Country spellings (lower case) and the one name each stands for.
COUNTRY_NAMES = {
    "uk": "United Kingdom",
    "u.k.": "United Kingdom",
    "great britain": "United Kingdom",
    "england": "United Kingdom",
    "united kingdom": "United Kingdom",
    "usa": "United States",
    "u.s.a.": "United States",
    "us": "United States",
    "united states of america": "United States",
    "united states": "United States",
    "deutschland": "Germany",
    "de": "Germany",
    "germany": "Germany",
    "fr": "France",
    "france": "France",
    "republic of ireland": "Ireland",
    "ie": "Ireland",
    "ireland": "Ireland",
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stripped(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind, not only spaces."""
    return F.btrim(col(c), F.lit(BLANKS))


def lowered(c: Column | str) -> Column:
    return F.lower(stripped(c))


def uppered(c: Column | str) -> Column:
    return F.upper(stripped(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# A word break for initcap, and a mark to find it again.
_BREAK = "\x01 "


def capitalised(c: Column | str) -> Column:
    """Capital after every non-letter: ``jack's rake`` becomes ``Jack'S Rake``.

    ``initcap`` starts a word at a space only. In ASCII text a break is put
    before each letter that follows another mark, and taken out again. Other
    text is capitalised run by run, because a capital may be two letters there.
    """
    value = col(c)
    broken = F.regexp_replace(value, "(?<=[^A-Za-z ])(?=[A-Za-z])", _BREAK)
    simple = (F.octet_length(value) == F.length(value)) & ~F.contains(value, F.lit(_BREAK[0]))
    return F.when(simple, F.replace(F.initcap(broken), F.lit(_BREAK), F.lit(""))).otherwise(_by_runs(value))


def _by_runs(value: Column) -> Column:
    runs = F.regexp_extract_all(value, F.lit(rf"({_CASED}+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+)"), F.lit(1))

    def fixed(run: Column) -> Column:
        # One capital may become two letters (sharp s); only the first stays upper case.
        first = F.upper(F.substring(run, 1, 1))
        rest = run.substr(F.lit(2), F.length(run))
        return F.concat(F.substring(first, 1, 1), F.lower(first.substr(F.lit(2), F.lit(2))), F.lower(rest))

    return F.array_join(F.transform(runs, fixed), "")


def titled(c: Column | str) -> Column:
    """Names and places: stripped, capitalised, blank becomes NULL."""
    return capitalised(blank_to_null(stripped(c)))


def email(c: Column | str) -> tuple[Column, Column]:
    """``(address, invalid)``; a spelled-out ``at`` is repaired when nothing else is wrong."""
    text = stripped(c)
    at = F.instr(text, SPELLED_AT)
    repaired = F.concat(
        text.substr(F.lit(1), at - 1), F.lit("@"), text.substr(at + len(SPELLED_AT), F.length(text))
    )
    repairable = (at > 0) & ~F.contains(text, F.lit("@")) & repaired.rlike(EMAIL_SHAPE)
    address = F.when(repairable, repaired).otherwise(text)
    invalid = ~F.coalesce(repairable | text.rlike(EMAIL_SHAPE), F.lit(False))
    return address, invalid


def country(c: Column | str) -> tuple[Column, Column]:
    """``(name, unrecognised)``; an unknown spelling is kept, capitalised, and flagged."""
    names = F.create_map(*[F.lit(x) for pair in COUNTRY_NAMES.items() for x in pair])
    known = F.try_element_at(names, lowered(c))
    return F.coalesce(known, capitalised(stripped(c))), known.isNull()


def slug(c: Column | str) -> Column:
    return F.replace(F.lower(col(c)), F.lit(" "), F.lit("-"))


def email_key(c: Column | str) -> Column:
    """Customer identity: lower-cased address, empty when missing."""
    return lowered(F.coalesce(col(c), F.lit("")))


def full_name(first: Column | str, last: Column | str) -> Column:
    return F.concat(col(first), F.lit(" "), col(last))
