"""Date normalisation against a fixed ``as_of`` instant, never the wall clock.

All functions assume the session time zone is UTC; text without a zone is read as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemill.functions.strings import let, strip

# The zone names of RFC 2822 and their offsets in hours.
ZONE_HOURS = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -4, "ADT": -3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
}
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MAIL = (
    r"(?i)^(?:[a-z]+[,.]?\s+)?(\d{1,2})[\s-]+([a-z]{3})[a-z]*[\s-]+(\d{2,4})\s+"
    r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2}))?(?:\s*([+-]\d{4})|\s+\(?([a-z]+)\)?)?(?:\s+\(.*\))?$"
)
_ISO = (
    r"(?i)^(\d{4})-?(\d{2})-?(\d{2})"
    r"(?:[^\d](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?(z|[+-]\d{2}(?::?\d{2})?)?)?$"
)
# Further back than this a relative date leaves the range of dates.
_MAX_HOURS = 17_000_000


def _groups(text: Column, pattern: str, names: str) -> Column:
    """The groups of a whole-text pattern as a struct of texts, empty where a group is; null without a match.

    One replacement and one split, instead of one regex run per group.
    """
    fields = names.split()
    marked = F.regexp_replace(text, pattern, "".join(f"\u0001${i}" for i in range(1, len(fields) + 1)))

    def picked(parts: Column) -> Column:
        found = F.struct(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(fields, 1)])
        return F.when(F.size(parts) == len(fields) + 1, found)

    return let(F.split(marked, "\u0001", -1), picked)


def _int(text: Column, default: int = 0) -> Column:
    return F.when(text == "", F.lit(default)).otherwise(text.try_cast("int"))


def _instant(year, month, day, hour, minute, second, offset_minutes) -> Column:
    local = F.try_make_timestamp(year, month, day, hour, minute, second, F.lit("UTC"))
    return local - F.make_dt_interval(F.lit(0), F.lit(0), offset_minutes)


def _offset(sign_text: Column) -> Column:
    """Minutes east of UTC of ``+0530``, ``-05:00`` or ``+05``; zero for an empty text."""
    digits = F.rpad(F.regexp_replace(sign_text, "[^0-9]", ""), 4, "0")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    return F.when(sign_text.rlike(r"^[+-]"), F.when(sign_text.startswith("-"), -minutes).otherwise(minutes)).otherwise(0)


def parse_mail_date(text: Column) -> Column:
    """An RFC 2822 date, weekday optional; null when the text is none."""
    zones = F.create_map(*[F.lit(x) for k, v in ZONE_HOURS.items() for x in (k, v * 60)])

    def build(g: Column) -> Column:
        year = g["year"].cast("int")
        full = F.when(year < 69, year + 2000).when(year < 100, year + 1900).otherwise(year)
        month = (F.instr(F.lit(_MONTHS), F.lower(g["mon"])) + 2) / 3
        offset = F.when(g["zone"] != "", _offset(g["zone"])).otherwise(
            F.coalesce(F.try_element_at(zones, F.upper(g["name"])), F.lit(0))
        )
        built = _instant(
            full, F.when(month == F.floor(month), month).cast("int"), _int(g["day"]),
            _int(g["hour"]), _int(g["minute"]), _int(g["second"]).cast("decimal(8,6)"), offset,
        )
        return F.when(g.isNotNull(), built)

    return let(_groups(text, _MAIL, "day mon year hour minute second zone name"), build)


def parse_iso_date(text: Column) -> Column:
    """An ISO 8601 date or date-time; null when the text is none."""

    def build(g: Column) -> Column:
        second = F.concat(
            F.when(g["second"] == "", "0").otherwise(g["second"]), F.lit("."), F.rpad(g["fraction"], 6, "0")
        ).try_cast("decimal(8,6)")
        built = _instant(
            _int(g["year"]), _int(g["month"]), _int(g["day"]), _int(g["hour"]), _int(g["minute"]), second, _offset(g["zone"])
        )
        return F.when(g.isNotNull(), built)

    return let(_groups(text, _ISO, "year month day hour minute second fraction zone"), build)


def normalize_date(raw: Column, as_of: Column) -> Column:
    """The instant a feed date names: "3 hours ago", "2 days ago", RFC 2822 or ISO; ``as_of`` for anything else.

    Hours win over days when a text names both. A relative date before the first year gives null.
    """

    def ago(count: Column, hours: int) -> Column:
        # Nine digits are already far out of range, so the cast cannot overflow.
        n = F.substring(count, 1, 9).cast("int") * F.lit(hours).cast("bigint")
        in_range = (F.length(count) <= 9) & (n <= _MAX_HOURS)
        return as_of - F.make_dt_interval(F.lit(0), F.when(in_range, n).cast("int"))

    def parsed(s: Column) -> Column:
        hours, days = (F.regexp_extract(s, rf"(\d+)\s+{unit}", 1) for unit in ("hour", "day"))
        return (
            F.when(s == "", as_of)
            .when(hours != "", ago(hours, 1))
            .when(days != "", ago(days, 24))
            .otherwise(F.coalesce(parse_mail_date(s), parse_iso_date(s), as_of))
        )

    return let(strip(F.lower(F.coalesce(raw, F.lit("")))), parsed)


def parse_date(raw: Column, as_of: Column) -> Column:
    """The strict variant: RFC 2822, then ISO, else ``as_of``; relative forms are not read."""
    return let(
        strip(F.coalesce(raw, F.lit(""))),
        lambda s: F.coalesce(parse_mail_date(s), parse_iso_date(s), as_of),
    )


def parse_paper_date(raw: Column) -> Column:
    """Exactly ``yyyy-MM-ddTHH:mm:ssZ``; null for anything else."""
    return F.when(raw.rlike(r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}Z$"), F.try_to_timestamp(raw, F.lit("y-M-d'T'H:m:sX")))


def to_ist_iso(ts: Column) -> Column:
    """ISO text in UTC+05:30; microseconds are written only when there are any."""
    local = F.from_utc_timestamp(ts, "+05:30")
    micros = F.date_format(local, "SSSSSS")
    fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+05:30"))
