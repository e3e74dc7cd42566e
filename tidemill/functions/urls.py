"""URL expressions: joining, page numbers, absolute product links, path keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemill.functions.strings import first_group, let

_BASE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_REFERENCE = r"(?s)^([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _text(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _prefixed(mark: str, value: Column) -> Column:
    return F.when(value != "", F.concat(F.lit(mark), value)).otherwise(F.lit(""))


def _without_dots(segments: Column) -> Column:
    """Apply ``.`` and ``..`` segments; a trailing one leaves a trailing slash."""

    def step(done: Column, seg: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(seg == "..", up).when(seg == ".", done).otherwise(F.concat(done, F.array(seg)))

    walked = F.aggregate(segments, F.array().cast("array<string>"), step)
    closed = F.when(
        F.element_at(segments, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))
    ).otherwise(walked)
    return F.array_join(closed, "/")


def resolve_url(base: Column, href: Column) -> Column:
    """The absolute form of ``href`` found on the page ``base``."""

    def joined(p: Column) -> Column:
        scheme, host, path, query = (p[k] for k in ("scheme", "host", "path", "query"))
        to_path, to_query, to_fragment = (p[k] for k in ("to_path", "to_query", "to_fragment"))
        parts = F.split(path, "/", -1)
        folder = F.when(F.element_at(parts, -1) != "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
        chain = F.concat(folder, F.split(to_path, "/", -1))
        relative = F.filter(chain, lambda s, i: (s != "") | (i == 0) | (i == F.size(chain) - 1))
        target = (
            F.when(to_path == "", path)
            .when(to_path.startswith("/"), _without_dots(F.split(to_path, "/", -1)))
            .otherwise(_without_dots(relative))
        )
        rooted = let(
            target,
            lambda t: F.when((to_path != "") & ~t.startswith("/"), F.concat(F.lit("/"), t)).otherwise(t),
        )
        used = F.when((to_path == "") & (to_query == ""), query).otherwise(to_query)
        return F.concat(scheme, F.lit("://"), host, rooted, _prefixed("?", used), _prefixed("#", to_fragment))

    def resolved(h: Column) -> Column:
        parsed = F.struct(
            F.lower(F.regexp_extract(base, _BASE, 1)).alias("scheme"),
            F.regexp_extract(base, _BASE, 2).alias("host"),
            F.regexp_extract(base, _BASE, 3).alias("path"),
            F.regexp_extract(base, _BASE, 4).alias("query"),
            F.regexp_extract(h, _REFERENCE, 1).alias("to_path"),
            F.regexp_extract(h, _REFERENCE, 2).alias("to_query"),
            F.regexp_extract(h, _REFERENCE, 3).alias("to_fragment"),
        )
        return (
            F.when(h == "", base)
            .when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), h)
            .when(h.startswith("//"), F.concat(F.lower(F.regexp_extract(base, _BASE, 1)), F.lit(":"), h))
            .otherwise(let(parsed, joined))
        )

    return let(F.btrim(F.translate(href, "\t\r\n", ""), F.lit(" ")), resolved)


def _decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), F.regexp_replace(text, r"\+", " "))


def _encode(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def set_page(url: Column, page) -> Column:
    """The URL with its ``page`` parameter set.

    Parameters keep the order of their first occurrence, blank ones are dropped, the rest are encoded
    again; the fragment stays.
    """
    page = _text(page).cast("string")

    def rebuilt(pairs: Column) -> Column:
        keys = F.array_distinct(F.concat(F.transform(pairs, lambda p: p["k"]), F.array(F.lit("page"))))

        def values(key: Column) -> Column:
            own = F.filter(pairs, lambda p: p["k"] == key)
            return F.when(key == "page", F.array(page)).otherwise(F.transform(own, lambda p: p["v"]))

        groups = F.transform(
            keys, lambda k: F.transform(values(k), lambda v: F.concat(_encode(k), F.lit("="), _encode(v)))
        )
        return F.array_join(F.flatten(groups), "&")

    parts = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&", -1), lambda p: p.rlike("(?s)^[^=]*=."))
    pairs = F.transform(
        parts,
        lambda p: F.struct(
            _decode(F.regexp_extract(p, "(?s)^([^=]*)=", 1)).alias("k"),
            _decode(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )
    fragment = F.regexp_extract(url, r"(#.+)$", 1)
    return F.concat(F.regexp_extract(url, r"^([^?#]*)", 1), F.lit("?"), let(pairs, rebuilt), fragment)


def product_url(site, href: Column) -> Column:
    """Absolute product link without its (tracking) query."""
    absolute = F.when(href.startswith("/"), F.concat(_text(site), href)).otherwise(href)
    return F.substring_index(absolute, "?", 1)


def last_segment(url: Column) -> Column:
    """The last path segment, trailing slashes removed: the id in a paper's address."""
    return F.substring_index(F.rtrim(url, F.lit("/")), "/", -1)


def repo_key(text: Column) -> Column:
    """``owner/name`` of the first code repository linked in a text; null when there is none."""
    return first_group(text, r"(?U)github\.com/([\w-]+/[\w-]+)")


def repo_url(text: Column) -> Column:
    return F.concat(F.lit("https://github.com/"), repo_key(text))


def next_page_url(links: Column, url: Column) -> Column:
    """The next page named by a page's own links (see ``html.link_array``), or null.

    Strategies in order: ``rel=next``; then the first anchor whose text, class or label contains "next".
    Only the first match of each counts, and it must have an address.
    """

    def has_next(field: str):
        return lambda a: F.contains(F.lower(a[field]), F.lit("next"))

    def found(anchors: Column) -> Column:
        tests = [lambda a: F.array_contains(F.split(a["rel"], r"\s+"), "next"), *map(has_next, ("text", "class", "aria"))]
        return F.coalesce(*[F.nullif(F.get(F.filter(anchors, t), F.lit(0))["href"], F.lit("")) for t in tests])

    return let(let(links, found), lambda h: F.when(h.isNotNull(), resolve_url(url, h)))


def next_candidate(next_url: Column, url: Column, start_url: Column, page_num: Column) -> Column:
    """The address to fetch after a page: its next link, else the start address with the page number raised.

    Null when neither differs from the current address, which ends the listing.
    """
    bumped = set_page(start_url, page_num + 1)
    return F.coalesce(F.nullif(next_url, url), F.nullif(bumped, url))
