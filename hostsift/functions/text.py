"""Column functions over raw list lines and host names.

The ASCII path is built-in functions only.  ``idna`` and ``folded`` need Python's own
tables for other characters; callers apply them to the rows that need them.
"""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What Python's strip and split take as white space.
BLANK = r"[\x09-\x0D\x1C-\x20\x85\xA0  -     　]"
LABEL = r"[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
SERVER_RULE = rf"^server=/([^/\x09-\x0D\x1C-\x20\x85\xA0]+)/([^\x09-\x0D\x1C-\x20\x85\xA0]+)\z"
BLOCK_RULE = r"^(?:@@)?\|\|[^\^\x09-\x0D\x1C-\x20\x85\xA0]+\^\z"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+\z", "")


def without_comments(raw: Column) -> Column:
    """The line before its first # and then its first !, stripped; empty for element-hiding rules."""
    cosmetic = raw.contains("##") | raw.contains("#@#")
    cut = F.split(F.split(raw, "#", 2)[0], "!", 2)[0]
    return F.when(cosmetic, F.lit("")).otherwise(stripped(cut))


def lowered_host(c: Column) -> Column:
    """Lower case without the trailing dots; the ASCII part of normalisation."""
    return F.regexp_replace(F.lower(c), r"\.+\z", "")


def is_ascii(c: Column) -> Column:
    return c.rlike(r"^[\x00-\x7F]*\z")


def ascii_host(c: Column) -> Column:
    """Normal form of an ASCII name: empty where a label is empty or longer than 63."""
    low = lowered_host(c)
    good = F.forall(F.split(low, r"\."), lambda p: (F.length(p) >= 1) & (F.length(p) <= 63))
    return F.when(good, low).otherwise(F.lit(""))


@F.pandas_udf(T.StringType())
def idna_host(names: pd.Series) -> pd.Series:
    """Normal form of any name by the standard library's IDNA codec; empty where it refuses."""

    def one(name):
        if name is None:
            return None
        try:
            return name.lower().rstrip(".").encode("idna").decode("ascii")
        except UnicodeError:
            return ""

    return names.map(one)


@F.pandas_udf(T.BooleanType())
def is_address(tokens: pd.Series) -> pd.Series:
    """True for IPv4 and IPv6 literals."""

    def one(token):
        if token is None:
            return None
        try:
            ipaddress.ip_address(token)
        except ValueError:
            return False
        return True

    return tokens.map(one)


@F.pandas_udf(T.StringType())
def folded(names: pd.Series) -> pd.Series:
    """Case folding in full, which lower() does not give."""
    return names.map(lambda n: None if n is None else n.casefold())


def valid_host(c: Column) -> Column:
    """1 to 253 characters of letter-digit-hyphen labels; one label is enough."""
    return (F.length(c) >= 1) & (F.length(c) <= 253) & c.rlike(rf"^{LABEL}(\.{LABEL})*\z")


def line_format(content: Column, first_is_address: Column, plain_host: Column) -> Column:
    """Format of a stripped line.  Plain is told from the normal form of the whole line."""
    tokens = F.size(F.split(content, rf"{BLANK}+"))
    return (
        F.when(content.rlike(SERVER_RULE), "dnsmasq")
        .when(content.rlike(BLOCK_RULE), "adblock")
        .when((tokens >= 2) & first_is_address, "hosts")
        .when(valid_host(plain_host), "plain")
        .otherwise("unknown")
    )


def rule_name(content: Column, form: Column) -> Column:
    """The name in a line of the given format, as written."""
    return (
        F.when(form == "plain", content)
        .when(form == "hosts", F.get(F.split(content, rf"{BLANK}+"), F.lit(1)))
        .when(form == "adblock", F.regexp_replace(F.regexp_replace(content, r"^[@|]+", ""), r"\^+\z", ""))
        .when(form == "dnsmasq", F.regexp_extract(content, SERVER_RULE, 1))
    )


def rule_scope(name: Column, form: Column) -> Column:
    """Struct of name without its marker, input_kind and apex_scope."""
    rule = form.isin("adblock", "dnsmasq")
    marked = rule & (name.startswith("*.") | name.startswith("."))
    bare = F.when(rule & name.startswith("*."), F.substring(name, 3, 1 << 30)).when(marked, F.substring(name, 2, 1 << 30)).otherwise(name)
    return F.struct(
        bare.alias("input_name"),
        F.when(rule, "suffix_rule").otherwise("exact_host").alias("input_kind"),
        F.when(~rule, "exact_only").when(marked, "exclude_apex").otherwise("include_apex").alias("apex_scope"),
    )


def region_name(c: Column) -> Column:
    """White space runs as one space, trimmed, lower case; rows that are not ASCII also need ``folded``."""
    return F.lower(stripped(F.regexp_replace(c, rf"{BLANK}+", " ")))


def code(c: Column) -> Column:
    return F.upper(stripped(c))
