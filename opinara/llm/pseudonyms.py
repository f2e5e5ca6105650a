"""Format-preserving pseudonyms for personal numbers, dates and mail addresses.

Found values are validated and permuted within their format by a keyed Feistel network over mixed radices: the value's digits
are cut into two halves, and in each of ``ROUNDS`` rounds one half is shifted, digit by digit modulo its radix, by a hash of
key, kind, round and the other half. This is a bijection on the values of a format, so equal values get equal pseudonyms in
every document, different values of a format stay different, and a pseudonym is again valid. Separators stay where they are.

Kinds, in order of precedence where they overlap:
mail      letters and digits of the local part, each within its class; the domain stays
ip        dotted IPv4 address: four digits of radix 256
date      1900 to 2099 as y-m-d, y/m/d, d.m.y or m/d/y (d/m/y where only that is a date): the day number, 73049 = 17 * 4297,
          so one day has one pseudonym in all notations
ssn       ddd-dd-dddd with valid area (not 000, 666, 9xx), group and serial
phone     ten digits as (ddd) ddd-dddd, ddd-ddd-dddd, ddd.ddd.dddd or with blanks; a leading +1 stays
card      13 to 19 digits, also in groups with single blanks or hyphens, that pass the Luhn check; the last digit is made to
          pass it again. Between the other values every stretch of whole groups is tried; where some overlap, one group goes
          before the usual groups of cards and these before others, then the first, then the longest

A value ends where its own kind cannot go on: commas never belong to it, a T and a digit may follow a date, and points and
hyphens with a digit behind are refused only where the kind itself has them.

Everything is DataFrame functions. The key is a literal of the plan: keep event logs as safe as the key.

Cases: a null text stays null with 0 replacements; text without a valid value is unchanged, as are numbers that fail their
check. Whole texts are read. Rows are handled one by one, so repeated rows get equal results. Other columns pass through, but
``n_replaced`` is replaced if it exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
FIRST_DAY, DAYS = "1900-01-01", 73049
_MAIL_CHARS = "A-Za-z0-9._%+-"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
MAIL = rf"(?<![{_MAIL_CHARS}])[{_MAIL_CHARS}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}"
_BEFORE, _AFTER = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
IP = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_YMD = r"(?:19|20)[0-9]{2}([-/])[0-9]{1,2}\1[0-9]{1,2}"
_DMY = r"[0-9]{1,2}([./])[0-9]{1,2}\2(?:19|20)[0-9]{2}"
DATE = f"{_YMD}|{_DMY}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
PHONE = r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
_DATES = (
    rf"(?:(?:(?<![0-9]-)|(?=[0-9]{{4}}/)){_YMD}(?!(?<=-[0-9]{{1,2}})-[0-9])"
    rf"|(?:(?<![0-9]\.)|(?=[0-9]{{1,2}}/)){_DMY}(?!(?<=\.[0-9]{{4}})\.[0-9]))(?=T[0-9]|[^0-9A-Za-z]|$)"
)
_NUMBERS = rf"(?:(?<![0-9]\.){IP}(?!\.[0-9])|(?<![0-9]-){SSN}(?!-[0-9])|(?<![0-9][.-]){PHONE}(?![.-][0-9])){_AFTER}"
VALUE = f"{MAIL}|{_BEFORE}(?:{_DATES}|{_NUMBERS})"
#: Digit groups, and what follows them if that refuses the last one.
RUN = rf"{_BEFORE}(?<![0-9]\.)[0-9][0-9 -]{{12,}}+(?:[A-Za-z]|\.[0-9])?"
_CARD_GROUPS = r"^[0-9]{4}([ -])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{6}\1[0-9]{4,5})$"


def _digits(text: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(text, "[^0-9]", ""), ""), lambda d: d.cast("bigint"))


def _radices(values: Column, radix: int) -> Column:
    return F.transform(values, lambda v: F.lit(radix).cast("bigint"))


def _longs(*values: Column | int) -> Column:
    return F.array(*[(v if isinstance(v, Column) else F.lit(v)).cast("bigint") for v in values])


def permute(code: Column, key: str, rounds: int = ROUNDS) -> Column:
    """Keyed permutation of a code: ``values`` (array of digits), ``radices`` (each above its digit) and ``format``.

    Codes of different format or length are permuted apart.
    """

    def half(values: Column, second: bool) -> Column:
        n = F.floor((F.size(values) + 1) / 2).cast("int")
        return F.slice(values, n + 1, F.size(values) - n) if second else F.slice(values, F.lit(1), n)

    def step(state: Column, turn: Column) -> Column:
        """Shifts the half in ``own`` by a hash of the half in ``other``, then they change places."""
        told = F.concat_ws("|", F.lit(key), state["format"], turn.cast("string"), F.array_join(state["other"].cast("array<string>"), ","))

        def shift(value: Column, place: Column) -> Column:
            digest = F.sha2(F.concat_ws("|", told, place.cast("string")), 256)
            return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") + value

        shifted = F.zip_with(F.transform(state["own"], shift), state["own_radices"], lambda x, r: F.pmod(x, r))
        return F.struct(
            state["other"].alias("own"), state["other_radices"].alias("own_radices"),
            shifted.alias("other"), state["own_radices"].alias("other_radices"), state["format"].alias("format"),
        )

    start = F.struct(
        half(code["values"], False).alias("own"), half(code["radices"], False).alias("own_radices"),
        half(code["values"], True).alias("other"), half(code["radices"], True).alias("other_radices"), code["format"].alias("format"),
    )
    turns = F.sequence(F.lit(0), F.lit(2 * (rounds // 2) - 1))  # an even number: each half ends where it began
    return F.aggregate(turns, start, step, lambda s: F.concat(s["own"], s["other"]))


def _code(kind: str, values: Column, radices: Column, more: Column | None = None) -> Column:
    name = F.concat(F.lit(kind), more.cast("string")) if more is not None else F.lit(kind)
    return F.struct(F.lit(kind).alias("kind"), name.alias("format"), values.alias("values"), radices.alias("radices"))


def _refill(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced in order."""
    digits = F.concat(digits.cast("array<string>"), F.array(F.lit("")))
    return F.array_join(F.zip_with(F.split(text, "[0-9]"), digits, lambda gap, d: F.concat(gap, d)), "")


def _luhn_digit(payload: Column) -> Column:
    """Check digit for the digits before it."""
    doubled = F.transform(F.reverse(payload), lambda d, i: F.when(i % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    total = F.aggregate(doubled, F.lit(0).cast("bigint"), lambda a, d: a + d)
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("bigint")


def _card_code(value: Column) -> Column:
    """All digits but the last; a first digit other than 0 stays so."""
    digits = _digits(value)
    payload = F.slice(digits, F.lit(1), F.size(digits) - 1)
    zero = F.get(payload, 0) == 0
    values = F.transform(payload, lambda d, i: F.when((i == 0) & ~zero, d - 1).otherwise(d))
    radices = F.transform(payload, lambda d, i: F.when(i > 0, 10).when(zero, 1).otherwise(9).cast("bigint"))
    return _code("card", values, radices, F.concat(F.size(digits).cast("string"), zero.cast("string")))


def _card(value: Column, made: Column) -> Column:
    zero = value.startswith("0")
    payload = F.transform(made, lambda d, i: F.when((i == 0) & ~zero, d + 1).otherwise(d))
    return _refill(value, F.concat(payload, F.array(_luhn_digit(payload))))


def _phone_code(value: Column) -> Column:
    digits = _digits(value)
    national = F.slice(digits, F.size(digits) - 9, F.lit(10))
    return _code("phone", national, _radices(national, 10))


def _phone(value: Column, made: Column) -> Column:
    digits = _digits(value)
    return _refill(value, F.concat(F.slice(digits, F.lit(1), F.size(digits) - 10), made))


def _ip_code(value: Column) -> Column:
    octets = F.split(value, r"\.").cast("array<bigint>")
    return _code("ip", octets, _radices(octets, 256))


def _ssn_code(value: Column) -> Column:
    area, group, serial = (F.get(F.split(value, "-"), i).cast("bigint") for i in range(3))
    place = F.when(area < 666, area - 1).otherwise(area - 2)
    good = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(good, _code("ssn", _longs(place, group - 1, serial - 1), _longs(898, 99, 9999)))


def _ssn(made: Column) -> Column:
    place, group, serial = (F.get(made, i) for i in range(3))
    return F.format_string("%03d-%02d-%04d", F.when(place < 665, place + 1).otherwise(place + 2), group + 1, serial + 1)


def _parts(value: Column) -> list[Column]:
    return [F.get(F.split(value, "[-./]"), i) for i in range(3)]


def _day(year: Column, month: Column, day: Column) -> Column:
    padded = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.to_date(F.try_to_timestamp(padded, F.lit("yyyy-MM-dd")))


def _order(value: Column) -> Column:
    """ymd, mdy or dmy."""
    a, b, c = _parts(value)
    month_first = value.contains("/") & _day(c, a, b).isNotNull()
    return F.when(F.length(a) == 4, "ymd").when(month_first, "mdy").otherwise("dmy")


def _date_code(value: Column) -> Column:
    a, b, c = _parts(value)
    order = _order(value)
    day = F.when(order == "ymd", _day(a, b, c)).when(order == "mdy", _day(c, a, b)).otherwise(_day(c, b, a))
    number = F.date_diff(day, F.lit(FIRST_DAY).cast("date"))
    return F.when(number.isNotNull(), _code("date", _longs(F.floor(number / 4297), number % 4297), _longs(17, 4297)))


def _date(value: Column, made: Column) -> Column:
    """In the same order, with the same separator; a number of one digit stays so where the new one has one."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.get(made, 0) * 4297 + F.get(made, 1)).cast("int"))
    year, month, dom = (f(day).cast("string") for f in (F.year, F.month, F.day))
    order = _order(value)
    new = F.when(order == "ymd", F.array(year, month, dom)).when(order == "mdy", F.array(month, dom, year)).otherwise(F.array(dom, month, year))
    wide = F.zip_with(new, F.split(value, "[-./]"), lambda x, old: F.lpad(x, F.greatest(F.length(x), F.length(old)), "0"))
    return F.call_function("array_join", wide, F.regexp_extract(value, "[-./]", 0))


def _base(c: Column) -> Column:
    return F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65).otherwise(F.ascii(c)).cast("bigint")


def _mail_code(value: Column) -> Column:
    local = F.split(F.substring_index(value, "@", 1), "")
    bases = F.transform(local, _base)
    radices = F.transform(local, lambda c: F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1).cast("bigint"))
    return _code("mail", F.transform(local, lambda c: F.ascii(c) - _base(c)), radices, F.array_join(bases.cast("array<string>"), ","))


def _mail(value: Column, made: Column) -> Column:
    local = F.split(F.substring_index(value, "@", 1), "")
    new = F.zip_with(made, local, lambda d, c: F.char(d + _base(c)))
    return F.concat(F.array_join(new, ""), F.lit("@"), F.substring_index(value, "@", -1))


def code_of(value: Column) -> Column:
    """Code of a found value; null if it does not validate."""
    whole = lambda pattern: value.rlike(f"^(?:{pattern})$")
    passes = _luhn(value)
    return (
        F.when(value.contains("@"), _mail_code(value)).when(whole(IP), _ip_code(value)).when(whole(DATE), _date_code(value))
        .when(whole(SSN), _ssn_code(value)).when(whole(PHONE), _phone_code(value)).when(passes, _card_code(value))
    )


def rendered(value: Column, kind: Column, made: Column) -> Column:
    """Permuted digits in the notation of the found value."""
    return (
        F.when(kind == "mail", _mail(value, made)).when(kind == "ip", F.array_join(made.cast("array<string>"), "."))
        .when(kind == "date", _date(value, made)).when(kind == "ssn", _ssn(made))
        .when(kind == "phone", _phone(value, made)).when(kind == "card", _card(value, made))
    )


def _luhn(value: Column) -> Column:
    return F.call_function("luhn_check", F.regexp_replace(value, "[^0-9]", ""))


def _piece(text: Column, found: bool | Column) -> Column:
    return F.struct(text.alias("text"), (found if isinstance(found, Column) else F.lit(found)).alias("found"))


def _cards(run: Column) -> Column:
    """A run cut into pieces: cards and what stands between them. Digits have the even places among the tokens."""
    tokens = F.regexp_extract_all(run, F.lit("[0-9]+|[^0-9]+"), 0)

    def from_group(tokens: Column, begin: Column) -> Column:
        ends = F.sequence(begin, F.least(F.size(tokens) - 1, begin + 36), F.lit(2))
        stretches = F.transform(ends, lambda end: F.struct(end.alias("end"), F.array_join(F.slice(tokens, begin + 1, end - begin + 1), "").alias("text")))
        free = lambda end: F.coalesce(F.get(tokens, end + 1), F.lit(" ")).rlike("^[ -]")
        good = F.filter(stretches, lambda s: s["text"].rlike(f"^{CARD}$") & free(s["end"]) & _luhn(s["text"]))
        rank = lambda t: F.when(~t.rlike("[ -]"), 0).when(t.rlike(_CARD_GROUPS), 1).otherwise(2)
        return F.transform(good, lambda s: F.struct(
            rank(s["text"]).alias("rank"), begin.alias("begin"), (-s["end"]).alias("longest"), s["end"].alias("end"), s["text"].alias("text")))

    def cut(tokens: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1, F.lit(2)), lambda i: F.coalesce(F.get(tokens, i - 1), F.lit(" ")).rlike("[ -]$"))
        every = F.array_sort(F.flatten(F.transform(begins, lambda i: from_group(tokens, i))))
        chosen = F.aggregate(every, F.filter(every, lambda c: F.lit(False)), lambda held, c: F.when(
            F.exists(held, lambda h: (h["begin"] <= c["end"]) & (c["begin"] <= h["end"])), held).otherwise(F.concat(held, F.array(c))))

        def pieces(chosen: Column) -> Column:
            def piece(token: Column, i: Column) -> Column:
                own = F.get(F.filter(chosen, lambda c: (c["begin"] <= i) & (i <= c["end"])), 0)
                return F.when(own.isNull(), _piece(token, False)).when(own["begin"] == i, _piece(own["text"], True)).otherwise(_piece(F.lit(""), False))

            return F.transform(tokens, piece)

        return F.flatten(F.transform(F.array(chosen), pieces))

    return F.flatten(F.transform(F.array(tokens), cut))  # evaluates the tokens once


def _between(gap: Column) -> Column:
    """A text without other values, cut into pieces at its cards."""
    runs = F.concat(F.regexp_extract_all(gap, F.lit(RUN), 0), F.array(F.lit("")))
    parts = F.zip_with(F.split(gap, RUN, -1), runs, lambda t, r: F.concat(
        F.array(_piece(t, False)), F.when(r != "", _cards(r)).otherwise(F.array(_piece(r, False)))))
    return F.when(gap.rlike(RUN), F.flatten(parts)).otherwise(F.array(_piece(gap, False)))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``n_replaced``. ``key`` is the secret."""
    if not key:
        raise ValueError("a key is needed")
    own = docs[text]
    values = F.concat(F.regexp_extract_all(own, F.lit(VALUE), 0), F.array(F.lit("")))
    parts = F.zip_with(F.split(own, VALUE, -1), values, lambda gap, v: F.concat(_between(gap), F.array(_piece(v, v != ""))))
    rows = docs.withColumn("_pieces", F.when(own.rlike("[0-9@]"), F.filter(F.flatten(parts), lambda p: p["text"] != "")))
    rows = rows.withColumn("_found", F.transform(F.filter("_pieces", lambda p: p["found"]), lambda p: p["text"]))
    codes = F.transform("_found", lambda v: F.struct(v.alias("value"), code_of(v).alias("code")))
    rows = rows.withColumn("_codes", F.when(F.size("_found") > 0, codes))
    permuted = F.transform("_codes", lambda c: F.struct(c.value.alias("value"), c.code.kind.alias("kind"), F.when(c.code.isNotNull(), permute(c.code, key)).alias("made")))
    rows = rows.withColumn("_permuted", permuted)
    rows = rows.withColumn("_made", F.transform("_permuted", lambda p: rendered(p["value"], p["kind"], p["made"])))
    changed = F.zip_with("_made", "_found", lambda new, old: F.coalesce(new, old))
    rows = rows.withColumn("_changed", changed)
    start = F.struct(F.lit(0).alias("i"), F.array().cast("array<string>").alias("out"))
    filled = F.aggregate("_pieces", start, lambda s, p: F.struct(
        (s["i"] + p["found"].cast("int")).alias("i"),
        F.concat(s["out"], F.array(F.when(p["found"], F.get(F.col("_changed"), s["i"])).otherwise(p["text"]))).alias("out")),
        lambda s: F.array_join(s["out"], ""))
    n = F.coalesce(F.size(F.filter("_made", lambda v: v.isNotNull())), F.lit(0)).cast("long")
    out = rows.withColumns({text: F.when(F.col("_made").isNull(), F.col(text)).otherwise(filled), "n_replaced": n})
    return out.select(*dict.fromkeys([*docs.columns, "n_replaced"]))
