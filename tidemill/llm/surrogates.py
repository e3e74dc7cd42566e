"""Surrogates for personal data (operator 2). DataFrame functions only.

Entities are found by one pattern: secrets after their name (which may be part of a longer name, or in quotes), keys of known shapes, mail addresses,
telephone and card numbers, social security numbers, account numbers (IBAN, in groups or not), IP addresses of both versions and persons after a
title, with all capitalised words that follow. Each has a normal form, in which spellings of the same thing are equal (letter case and
separators are left out), and gets one surrogate that depends on the key, the type and the normal form alone:

* digits become digits, letters letters of the same case, hexadecimal secrets hexadecimal ones; separators and prefixes stay;
* telephone numbers keep the country code, cards their first digit and, if it holds, the check digit rule, account numbers the country;
* addresses go to reserved ranges (``example`` domains; 240/4; 2001:db8::/32), and equal domains to equal domains;
* a person's words are entities of their own: the last one is the surname, which keeps one surrogate wherever it stands, the others are given names,
  which get a name of the same script and of the gender the title tells. A given name under a title that tells none (Dr) takes the gender that
  other mentions of it tell, if they agree.

All distinct entities are then checked together: a surrogate that is an entity of the corpus itself, or that another entity already has, is drawn
again. So different entities stay different and all mentions of one entity stay the same. From ``WIDEN`` draws on a surrogate may
become longer, so that a crowded format cannot go on for ever.

What it does not find: persons without a title, postal addresses, and secrets that neither a name nor a known shape tells.

Without a key each run draws one of its own; give one to get the same surrogates again.

Defined cases: a null text stays null and an empty one empty; repeated rows and copies are replaced alike; an empty table gives no rows; all
columns are kept, whatever their names, a column ``n_chars`` is brought up to date, and a column ``n_entities`` gives way to the count.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.strings import let
from tidemill.session import cut

WIDEN = 8

#: Titles by gender, names by script and gender, and syllables of family names by script.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof", "Professor", "Doktor", "Docteur"),
}
GIVEN = {
    "latin": {"m": "adam bruno carl david emil felix hugo ivan jonas karl leon martin oscar paul robert simon", "f": "anna berta clara diana emma fiona greta helen ida julia klara laura maria nora olivia paula"},
    "cyrillic": {"m": "антон борис виктор глеб денис егор иван кирилл", "f": "анна вера галина дарья елена ирина мария ольга"},
    "greek": {"m": "αλέξης γιάννης δημήτρης ηλίας κώστας νίκος πέτρος σπύρος", "f": "άννα βασιλική γεωργία δέσποινα ελένη κατερίνα μαρία σοφία"},
}
FAMILY = {
    "latin": "ba be bo da de do ka ke ko la le lo ma me mo ra re ro sa se so ta te to va ve vo na ne no pa pe",
    "cyrillic": "ба бо ва во да до ка ко ла ло ма мо на но ра ро",
    "greek": "βα βο δα δο κα κο λα λο μα μο να νο ρα ρο σα σο",
}
#: The country codes of telephone numbers with one and two digits; all others have three.
COUNTRY = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
#: How keys of known shapes begin.
KEY_BEGINS = ("AKIA", "ASIA", "gh[pousr]_", "github_pat_", "sk-", "xox[abeprs]-", "AIza", "glpat-")

_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_BEGIN = "|".join(KEY_BEGINS)
_RUN = r"(?:[A-Za-z0-9/+_=~-]|\.(?=[A-Za-z0-9/+_=~-]))"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEX = "[0-9A-Fa-f]{1,4}"

SECRET = rf"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key)[\x22']?\s{{0,3}}[=:]\s{{0,3}}[\x22']?{_RUN}{{8,}}"
KNOWN_KEY = rf"(?:{_BEGIN})[A-Za-z0-9_-]{{16,}}"
EMAIL = r"[\w.+-]{1,64}+@[\w-]{1,63}(?:\.[\w-]{1,63}){1,5}"
PHONE = (
    r"\+?\d{0,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\d{3}[.-]\d{3}[.-]\d{4}(?!\d)"
    r"|\+(?=(?:[ .()-]{0,2}\d){7})\d{1,4}(?:[ .-]?\(?\d{1,8}\)?){1,6}(?!\d)"
)
IP = rf"{_OCTET}(?:\.{_OCTET}){{3}}(?![\w.]*\d)"
IPV6 = rf"(?:{_HEX}:){{7}}{_HEX}(?![\w:])|(?=[0-9A-Fa-f:]*\d)(?:{_HEX}(?::{_HEX}){{0,5}})?::(?:{_HEX}(?::{_HEX}){{0,5}})(?![\w:])"
SSN = r"\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"\d{4}(?:[ -]\d{4}){3}(?!\d)|\d{13,19}(?!\d)"
IBAN = r"[A-Z]{2}\d{2}(?: (?=[A-Z]{0,3}\d)[A-Z0-9]{4}){3,7}(?: (?=\d)[A-Z0-9]{1,3})?(?!\w)|[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)"
_WORD = r"\p{Lu}(?:['’]?\p{L})+"
PERSON = rf"(?:{_TITLE})\.? {_WORD}(?:[ -]{_WORD})*+"
ENTITY = rf"{SECRET}|(?<![\w.+-])(?:{KNOWN_KEY}|{EMAIL}|{PHONE}|{SSN}|{IP}|{IPV6}|{IBAN}|{CARD}|{PERSON})"
#: Texts that cannot hold an entity are told by this much cheaper pattern; a letter that begins no title is passed over at once.
HINT = rf"[@\d=:]|(?=[{''.join(sorted({t[0] for titles in TITLES.values() for t in titles} | set('Agsx')))}])(?:{_TITLE}|{_BEGIN})"


def _kind(e: Column) -> Column:
    def whole(pattern: str) -> Column:
        return e.rlike(rf"^(?:{pattern})$")

    return (
        F.when(whole(SECRET), "secret").when(whole(KNOWN_KEY), "key").when(whole(EMAIL), "email").when(whole(SSN), "ssn").when(whole(IP), "ip")
        .when(whole(IPV6), "ipv6").when(whole(IBAN), "iban").when(whole(CARD), "card").when(whole(PHONE), "phone").otherwise("person")
    )


def _prefix(e: Column, kind: Column) -> Column:
    """What comes before the value and stays: the name of a secret, the beginning that tells a key, a title."""
    return (
        F.when(kind == "secret", F.regexp_extract(e, r"^(.*?[=:]\s{0,3}[\x22']?)", 1)).when(kind == "person", F.regexp_extract(e, r"^(\S+ )", 1))
        .when(kind == "key", F.regexp_extract(e, rf"^({_BEGIN})", 1)).otherwise("")
    )


def _normal(value: Column, kind: Column) -> Column:
    digits = F.regexp_replace(value, r"\D", "")
    country = F.when(value.startswith("+"), F.regexp_extract(digits, rf"^({COUNTRY}|\d{{3}})", 1)).otherwise("")
    return (
        F.when(kind == "phone", F.concat(country, F.lit("-"), F.substr(digits, F.length(country) + 1)))
        .when(kind.isin("card", "ssn"), digits).when(kind.isin("email", "given", "surname", "ipv6"), F.lower(value))
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).otherwise(value)
    )


def _gender(prefix: Column) -> Column:
    title = F.regexp_replace(F.trim(prefix), r"\.$", "")
    return F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").otherwise("n")


def mentions(docs: DataFrame) -> DataFrame:
    """The entities of each different text: ``h1, h2`` (which text), ``pos, part, kind, prefix, value, normal, gender``.

    ``pos`` counts a text's mentions and ``part`` the words of a person; other mentions have one part.
    """
    texts = docs.filter(F.col("text").rlike(HINT)).withColumn("found", F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    texts = texts.filter(F.size("found") > 0).select(*_identity(), "found").dropDuplicates(["h1", "h2"])
    rows = texts.select("h1", "h2", F.posexplode("found").alias("pos", "e")).withColumn("kind", _kind(F.col("e")))
    rows = rows.withColumn("prefix", _prefix(F.col("e"), F.col("kind"))).withColumn("value", F.substr("e", F.length("prefix") + 1))
    is_person = F.col("kind") == "person"
    values = F.when(is_person, F.split("value", " ")).otherwise(F.array("value"))
    parts = rows.withColumns({"words": F.size(values), "gender": F.when(is_person, _gender(F.col("prefix"))).otherwise("")})
    parts = parts.select("h1", "h2", "pos", "prefix", "kind", "words", "gender", F.posexplode(values).alias("part", "value"))
    is_given = (F.col("kind") == "person") & (F.col("part") < F.col("words") - 1)
    kind = F.when(is_given, "given").when(F.col("kind") == "person", "surname").otherwise(F.col("kind"))
    parts = parts.withColumns({"gender": F.when(is_given, F.col("gender")).otherwise(""), "kind": kind})
    return parts.withColumn("normal", _normal(F.col("value"), F.col("kind"))).drop("words")


def _with_known_gender(found: DataFrame) -> DataFrame:
    """Given names without a gender take the one that other mentions tell, if they agree."""
    told = found.filter((F.col("kind") == "given") & (F.col("gender") != "n")).groupBy("normal").agg(F.min("gender").alias("g1"), F.max("gender").alias("g2"))
    told = told.filter("g1 = g2").select(F.lit("given").alias("kind"), "normal", F.lit("n").alias("gender"), F.col("g1").alias("told"))
    joined = found.join(told, ["kind", "normal", "gender"], "left")
    return joined.withColumn("gender", F.coalesce("told", "gender")).drop("told")


def _identity() -> list[Column]:
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2")]


def _stream(key: str, *what: Column) -> Column:
    """256 hexadecimal digits that depend on the key."""
    text = F.concat_ws("|", F.lit(key), *what)
    return F.concat(F.sha2(F.concat(text, F.lit("|0")), 512), F.sha2(F.concat(text, F.lit("|1")), 512))


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, 2 * (i % 128) + 1, F.lit(2)), 16, 10).cast("int")


def _letters(value: Column, stream: Column) -> Column:
    """Digits for digits, letters for letters of the same case; hexadecimal for wholly hexadecimal values."""

    def one(c: Column, i: Column) -> Column:
        def pick(b: Column) -> Column:
            def of(first: str, n: int) -> Column:
                return F.char(F.lit(ord(first)) + b % n)

            hexa = F.substr(F.lit("0123456789abcdef"), b % 16 + 1, F.lit(1))
            return (
                F.when(value.rlike("^[0-9a-f]{8,}$") & value.rlike("[a-f]"), hexa).when(c.between("0", "9"), of("0", 10))
                .when(c.between("a", "z"), of("a", 26)).when(c.between("A", "Z"), of("A", 26)).otherwise(c)
            )

        return let(_byte(stream, i), pick)

    return F.array_join(F.transform(F.split(value, "(?!^)(?!$)"), one), "")


def _luhn(digits: Column) -> Column:
    """The sum of the check digit rule, modulo ten."""

    def add(total: Column, x: Column) -> Column:
        doubled = x["d"] * (1 + x["i"] % 2)
        return (total + doubled - F.when(doubled > 9, 9).otherwise(0)).cast("int")

    return F.aggregate(F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i"))), F.lit(0), add) % 10


def _pick(words: str, b: Column) -> Column:
    options = words.split()
    return F.element_at(F.array(*map(F.lit, options)), b % len(options) + 1)


def _by_script(script: Column, make) -> Column:
    return F.when(script == "cyrillic", make("cyrillic")).when(script == "greek", make("greek")).otherwise(make("latin"))


def _script(normal: Column) -> Column:
    return F.when(normal.rlike(r"\p{IsCyrillic}"), "cyrillic").when(normal.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _syllables(script: str, stream: Column, first: int, n: int) -> Column:
    return F.concat(*[_pick(FAMILY[script], _byte(stream, F.lit(first + k))) for k in range(n)])


def _given(normal: Column, gender: Column, stream: Column) -> Column:
    """A name of the list; where those are taken, two of them as one, and then one with syllables."""

    def of(s: str) -> Column:
        def name(i: int) -> Column:
            b = _byte(stream, F.lit(i))
            return F.when(gender == "m", _pick(GIVEN[s]["m"], b)).when(gender == "f", _pick(GIVEN[s]["f"], b)).otherwise(_pick(GIVEN[s]["m"] + " " + GIVEN[s]["f"], b))

        return F.when(F.col("attempt") < 3, name(0)).when(F.col("attempt") < 5, F.concat(name(0), name(1))).otherwise(F.concat(name(0), _syllables(s, stream, 2, 3)))

    return _by_script(_script(normal), of)


def _surname(normal: Column, stream: Column) -> Column:
    return _by_script(_script(normal), lambda s: F.when(F.col("attempt") < 3, _syllables(s, stream, 0, 3)).otherwise(_syllables(s, stream, 0, 4)))


def _surrogate(key: str) -> Column:
    """The surrogate of the normal form, for columns ``kind, normal, gender, attempt``."""
    kind, normal = F.col("kind"), F.col("normal")
    stream = F.col("stream")
    local, domain = F.substring_index(normal, "@", 1), F.substring_index(normal, "@", -1)
    domain_stream = _stream(key, F.lit("domain"), domain)
    host = F.concat(_letters(F.lit("zzzzzzzz"), domain_stream), F.lit(".example."), _pick("com org net", _byte(domain_stream, F.lit(100))))
    country = F.substring_index(normal, "-", 1)
    card = F.concat(F.substring(normal, 1, 1), _letters(F.substr(normal, F.lit(2)), stream))
    but_last = F.substr(card, F.lit(1), F.length(card) - 1)
    check = (10 - _luhn(F.concat(but_last, F.lit("0")))) % 10
    address = F.concat_ws(".", (240 + _byte(stream, F.lit(0)) % 15).cast("string"), *[_byte(stream, F.lit(i)).cast("string") for i in (1, 2, 3)])
    made = (
        F.when(kind == "email", F.concat(_letters(local, stream), F.lit("@"), host))
        .when(kind == "phone", F.concat(country, F.lit("-"), _letters(F.substr(normal, F.length(country) + 2), stream)))
        .when(kind == "card", F.when(_luhn(normal) == 0, F.concat(but_last, check.cast("int").cast("string"))).otherwise(card))
        .when(kind == "ip", address).when(kind == "given", _given(normal, F.col("gender"), stream)).when(kind == "surname", _surname(normal, stream))
        .when(kind == "ipv6", F.concat(F.lit("2001:db8:"), F.concat_ws(":", *[F.substr(stream, F.lit(4 * i + 1), F.lit(4)) for i in range(6)])))
        .when(kind == "iban", F.concat(F.substring(normal, 1, 2), _letters(F.substr(normal, F.lit(3)), stream)))
        .otherwise(_letters(normal, stream))
    )
    extra = _letters(F.when(kind.isin("phone", "card", "ssn", "ip"), "0000").otherwise("zzzz"), F.substr(stream, F.lit(200)))
    parted = F.when(kind.isin("ip", "email"), F.concat(F.lit("."), extra)).when(kind == "ipv6", F.concat(F.lit(":"), F.substr(stream, F.lit(200), F.lit(4)))).otherwise(extra)
    return F.when(F.col("attempt") >= WIDEN, F.concat(made, parted)).otherwise(made)


def assign(entities: DataFrame, *, key: str | None = None) -> DataFrame:
    """``entities(kind, normal, gender)`` with ``surrogate``: of a kind no two alike, none of them an entity itself."""
    key = secrets.token_hex(16) if key is None else key
    known = cut(entities.select("kind", "normal", "gender").distinct())
    originals = known.select("kind", F.col("normal").alias("surrogate"))
    pending, done, attempt = known, None, 0
    while True:
        drawn = pending.withColumn("attempt", F.lit(attempt)).withColumn("stream", _stream(key, "kind", "normal", "gender", F.lit(str(attempt))))
        drawn = cut(drawn.withColumn("surrogate", _surrogate(key)).drop("stream", "attempt"))
        free = drawn.join(originals, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done, ["kind", "surrogate"], "left_anti")
        first = F.min(F.struct("normal", "gender")).alias("first")
        won = cut(free.groupBy("kind", "surrogate").agg(first).select("kind", "surrogate", "first.normal", "first.gender"))
        done = won if done is None else done.unionByName(won)
        pending = cut(pending.join(won, ["kind", "normal", "gender"], "left_anti"))
        attempt += 1
        if pending.isEmpty():
            return done


def _written(value: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the format of one mention."""
    digits = F.regexp_replace(surrogate, r"\D", "")

    def in_place(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substr(value, F.lit(1), i + 1), r"\D", ""))
        return F.when(c.between("0", "9"), F.substr(digits, nth, F.lit(1))).otherwise(c)

    spread = F.array_join(F.transform(F.split(value, "(?!^)(?!$)"), in_place), "")
    rest = F.substr(digits, F.length(F.regexp_replace(value, r"\D", "")) + 1)

    def in_groups(c: Column, i: Column) -> Column:
        nth = F.length(F.replace(F.substr(value, F.lit(1), i + 1), F.lit(" "), F.lit("")))
        return F.when(c == " ", c).otherwise(F.substr(surrogate, nth, F.lit(1)))

    groups = F.array_join(F.transform(F.split(value, "(?!^)(?!$)"), in_groups), "")
    more = F.substr(surrogate, F.length(F.replace(value, F.lit(" "), F.lit(""))) + 1)

    def cased(c: Column, i: Column) -> Column:
        return F.when(F.substr(value, i + 1, F.lit(1)).between("A", "Z"), F.upper(c)).otherwise(c)

    mail = F.array_join(F.transform(F.split(surrogate, "(?!^)(?!$)"), cased), "")
    name = F.when(F.upper(value) == value, F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.concat(spread, rest)).when(kind == "iban", F.concat(groups, more))
        .when(kind == "email", F.when(value == F.lower(value), surrogate).otherwise(mail)).when(kind.isin("given", "surname"), name).otherwise(surrogate)
    )


def pseudonymise(docs: DataFrame, *, key: str | None = None) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced; all columns are kept, and ``n_entities`` is added."""
    found = cut(_with_known_gender(mentions(docs.select("text"))))
    chosen = assign(found.select("kind", "normal", "gender"), key=key)
    written = _written(F.col("value"), F.col("kind"), F.col("surrogate")).alias("new")
    placed = found.join(chosen, ["kind", "normal", "gender"]).select("h1", "h2", "pos", "part", "prefix", written)

    def texts_of(parts: str, *what: str) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct(*what))), lambda x: x[parts])

    whole = placed.groupBy("h1", "h2", "pos").agg(F.concat(F.first("prefix"), F.array_join(texts_of("new", "part", "new"), " ")).alias("new"))
    per_text = cut(whole.groupBy("h1", "h2").agg(texts_of("new", "pos", "new").alias("new")))

    # The row travels as one value, so its columns may have any names.
    kept = [c for c in docs.columns if c != "n_entities"]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))

    def given_back(text: Column, n: Column) -> list[Column]:
        updated = {"text": text}
        if "n_chars" in kept:
            updated["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
        return [updated.get(c, F.col("row")[c]).alias(c) for c in kept] + [n.alias("n_entities")]

    plain = docs.filter(~hinted).select(row).select(*given_back(F.col("row.text"), F.lit(0)))
    some = docs.filter(hinted).select(row, *_identity())
    joined = some.join(per_text, ["h1", "h2"], "left")
    between = F.split("row.text", ENTITY, -1)
    text = F.array_join(F.flatten(F.zip_with(between, F.col("new"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    replaced = F.when(F.col("new").isNull(), F.col("row.text")).otherwise(text)
    changed = joined.withColumn("replaced", replaced).select(*given_back(F.col("replaced"), F.coalesce(F.size("new"), F.lit(0))))
    return plain.unionByName(changed)
