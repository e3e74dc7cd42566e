"""Rules over titles, descriptions and card texts."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from tidemill.functions.strings import let, non_empty, strip

# Interface words that disqualify a line of card text.
JUNK_WORDS = (
    "sponsored", "trending", "results", "cart", "home", "orders", "shortcuts",
    "sign in", "sign up", "log in", "register", "subscribe", "newsletter",
    "cookie", "privacy policy", "terms of service", "footer", "navigation",
    "menu", "search", "filter", "sort by", "load more", "show more",
    "no results", "back to top", "follow us", "share", "bookmark",
)
# Role families in order, each with the substrings that select it.
ROLE_RULES = (
    ("Internship", ("intern", "internship", "trainee", "fellowship")),
    ("Data/ML", ("data scientist", "ml engineer", "machine learning", "deep learning", "llm", "ai engineer")),
    ("Frontend", ("frontend", "front-end", "react", "vue", "angular", "ui developer")),
    ("Backend", ("backend", "back-end", "api", "django", "flask", "fastapi", "node")),
    ("Fullstack", ("fullstack", "full stack", "full-stack")),
    ("DevOps/Infra", ("devops", "sre", "infrastructure", "platform", "cloud", "kubernetes", "docker")),
    ("Engineering", ("engineer", "developer", "swe", "sde", "software")),
    ("Design", ("design", "ux", "ui/ux", "product designer")),
    ("Business", ("market", "growth", "sales", "business development")),
)
# Where a job title names its company, in order of preference.
COMPANY_PATTERNS = (
    r"(?iU)\bat\s+([A-Za-z0-9][A-Za-z0-9\s&\.\-]+?)(?:\s*[-–|,\(]|$)",
    r"(?iU)^([A-Za-z0-9][A-Za-z0-9\s&\.]+?)\s*(?:is\s+hiring|hiring|–|-)",
    r"(?iU)\(([A-Za-z0-9][A-Za-z0-9\s&\.]+)\)",
)
# The marks that make a line a price.
PRICE_MARKS = ("$", "₹", "€", "Rs")


def has_any(text: Column, words) -> Column:
    """Whether any of the words is a substring; plain searches are several times faster than one pattern."""
    return reduce(or_, [F.contains(text, F.lit(w)) for w in words])


def company_at(title: Column) -> Column:
    """The words after "at" in a title; null when there are none."""
    pattern = r"(?iU)\bat\s+([A-Za-z0-9 ]+)"
    return F.when(title.rlike(pattern), strip(F.regexp_extract(title, pattern, 1)))


def company_from_title(title: Column) -> Column:
    """The first pattern whose company is 3 to 59 characters long; null when none is."""

    def accepted(pattern: str) -> Column:
        found = strip(F.regexp_extract(title, pattern, 1))
        return let(found, lambda c: F.when(F.length(c).between(3, 59), c))

    return F.coalesce(*[accepted(p) for p in COMPANY_PATTERNS])


def is_remote(title: Column, description: Column) -> Column:
    text = F.concat(title, F.lit(" "), F.coalesce(description, F.lit("")))
    return text.rlike(r"(?iU)\bremote\b")


def role_simple(title: Column) -> Column:
    return F.when(F.lower(title).rlike("engineer|developer"), "Engineering").otherwise("Other")


def role_family(title: Column, description: Column, rules=ROLE_RULES, default: str = "Other") -> Column:
    """The first rule one of whose substrings occurs in title and description."""
    text = F.lower(F.concat(title, F.lit(" "), F.coalesce(description, F.lit(""))))

    def chosen(t: Column) -> Column:
        result = F.lit(default)
        for name, words in reversed(rules):
            result = F.when(has_any(t, words), F.lit(name)).otherwise(result)
        return result

    return let(text, chosen)


def paper_title(title: Column) -> Column:
    return F.translate(strip(title), "\n", " ")


def clean_name(name: Column) -> Column:
    """A name without commas and full stops, stripped."""
    return strip(F.translate(name, ",.", ""))


def not_junk(line: Column, words=JUNK_WORDS) -> Column:
    return let(F.lower(line), lambda x: ~has_any(x, words))


def card_lines(text: Column) -> Column:
    """The non-empty parts of a card text between the bars."""
    return non_empty(F.split(text, r"\|", -1))


def heuristic_name(text: Column, min_chars: int = 15, words=JUNK_WORDS) -> Column:
    """The first line longer than ``min_chars`` without junk words; null when no line qualifies."""
    return F.get(F.filter(card_lines(text), lambda x: (F.length(x) > min_chars) & not_junk(x, words)), F.lit(0))


def heuristic_price(text: Column) -> Column:
    """The first line with a currency mark; null when there is none."""
    return F.get(F.filter(card_lines(text), lambda x: has_any(x, PRICE_MARKS)), F.lit(0))


def dollar_price(price: Column) -> Column:
    """``$`` before a non-empty price; null and empty stay as they are."""
    return F.when(price != "", F.concat(F.lit("$"), price)).otherwise(price)
