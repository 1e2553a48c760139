"""The info text of a packet: verbs, direction, queried names, records, categories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from packetlens.functions.text import strip

# Fixed values that decide results.
VERBS = ("Standard", "Dynamic", "Zone", "Server", "Inverse", "DNS")
ERROR_TYPE = "Error/Unknown operation"
RECORD_TYPES = ("CNAME", "NS")
STATUS = "Server status"
STATUS_RESPONSE = "Server status request response"
OTHER_CATEGORY = "other"
# The first category with a matching substring wins, in this order.
CATEGORIES = {
    "search": ["google", "msn", "yahoo", "bing", "ucweb", "scorecardresearch"],
    "tech": ["apple", "cloud", "windows", "cloudfront", "amazonaws", "android", "ksmobile",
             "microsoft", "msftncsi", "flurry", "gmail", "appsflyer", "doubleclick", "truecaller"],
    "social": ["facebook", "whatsapp", "youtube", "skype", "twitter", "instagram"],
    "e-commerce": ["amazon"],
    "cdn": ["akamai", "fbcdn"],
    "danger": ["porn", "virus"],
}


def verb(info: Column) -> Column:
    """The first token."""
    return F.substring_index(info, " ", 1)


def two_words(info: Column) -> Column:
    """The first two tokens, or the only one."""
    return F.substring_index(info, " ", 2)


def is_standard(info: Column) -> Column:
    return verb(info) == "Standard"


def message_type(info: Column) -> Column:
    return F.when(verb(info).isin(*VERBS), two_words(info)).otherwise(F.lit(ERROR_TYPE))


# The functions below take the tokens of a text, an array column.


def word(words: Column, i: int) -> Column:
    """Token ``i``, null beyond the end."""
    return F.get(words, F.lit(i))


def is_query(words: Column) -> Column:
    """True for a query, false for a response, null where the text is too short to tell
    or the verb has no direction."""
    marker = F.when(word(words, 0).isin("Standard", "Inverse"), word(words, 2)).when(
        word(words, 0) == "DNS", word(words, 4)
    )
    return marker != "response"


def query_domain(words: Column) -> Column:
    """The last two labels of the last token, or its only label."""
    return F.substring_index(strip(F.element_at(words, -1)), ".", -2)


def record_type(words: Column, at: Column) -> Column:
    """What the token at position ``at`` of a Standard text stands for: the whole of a query
    is an "A", told by its first token; in a response every CNAME or NS token counts."""
    query = word(words, 2) != "response"
    return F.when(query & (at == 0), F.lit("A")).when(
        ~query & F.get(words, at).isin(*RECORD_TYPES), F.get(words, at)
    )


def record_name(words: Column, at: Column) -> Column:
    """The domain of a query, or the token after a record's; null if the text ends there."""
    return F.when(at == 0, query_domain(words)).otherwise(F.get(words, at + 1))


def category(name: Column) -> Column:
    def hit(parts: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [name.contains(p) for p in parts])

    cases = list(CATEGORIES.items())
    chain = F.when(hit(cases[0][1]), cases[0][0])
    for label, parts in cases[1:]:
        chain = chain.when(hit(parts), label)
    return chain.otherwise(OTHER_CATEGORY)
