"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Found values are validated first: Luhn for payment cards, mod 97 for IBANs, octets of IPv4 addresses, ranges of
social security numbers, the calendar for dates, digits for phones, local part and domain for e-mail. What
fails is left alone. A valid value is permuted, under a key, within its own format by a Feistel network:
digits stay digits, letters stay letters, punctuation stays where it is, check digits are made anew, dates stay
dates. A permutation is a function of the value alone, so equal values have equal pseudonyms in all documents,
and different values different ones. Built-in expressions only; one projection, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import let

ROUNDS = 8
#: Steps a permutation is repeated until its value is valid again; the least share of valid values is 0.88.
WALK = 24

# The written forms that are looked for. Possessive or bounded repeats keep the search linear.
EMAIL = r"(?<![\p{IsLatin}0-9._%+-])[\p{IsLatin}0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}+"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
PHONE = (r"(?<![A-Za-z0-9])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![A-Za-z0-9])"
         r"|(?<![A-Za-z0-9])\+[0-9]{1,3}+[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![A-Za-z0-9])"
         r"|(?<![A-Za-z0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![A-Za-z0-9])"
         r"|(?<![A-Za-z0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![A-Za-z0-9]|[.-][0-9])")
#: Country codes of international numbers: those of one and two digits, else three; and a trunk 0 in parentheses, which is not dialled.
CALLING_CODE = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}|[0-9]{1,2})(?:[ .-]?\(0\))?"
#: National numbers with their trunk 0 (French in pairs; area and number as in Germany and Britain; unspaced), Spanish ones in groups that are not thousands,
#: and American ones with spaces.
NATIONAL = (r"(?<![A-Za-z0-9+]|[0-9][ ./-])(?:0[1-9](?:(?: [0-9]{2}){4}|(?:\.[0-9]{2}){4}|(?:-[0-9]{2}){4}|[0-9]{8,9})"
            r"|(?:\(0[1-9][0-9]{1,4}\) ?|0[1-9][0-9]{1,4}(?: ?/ ?| |-))(?:[0-9]{5,8}(?:-[0-9]{1,4})?|[0-9]{2,4}(?:[ -][0-9]{2,4}){2,3}|[0-9]{3,4}[ -][0-9]{3,4})"
            r"|[6-9][0-9]{2}(?:(?: [0-9]{2}){3}|(?:\.[0-9]{2}){3}|(?:-[0-9]{2}){3}|(?:-[0-9]{3}){2})|[89][0-9](?: [0-9]{3}(?: [0-9]{2}){2}|\.[0-9]{3}(?:\.[0-9]{2}){2})"
            r"|[2-9][0-9]{2} [0-9]{3} [0-9]{4})(?![A-Za-z0-9]|[./-][0-9])")
CARD = (r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})"
        r"(?![A-Za-z0-9])")
SSN = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9]|-[0-9])"
IPV4 = r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9]|\.[0-9])"
DATE = (r"(?<![A-Za-z0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.|-[0-9]{1,2}-)[0-9]{4})"
        r"(?:(?=[Tt][0-9]{2}:?[0-9]{2})|(?![A-Za-z0-9]|[./-][0-9]))")
ANY = "|".join(f"(?:{p})" for p in (EMAIL, IBAN, PHONE, SSN, CARD, IPV4, DATE, NATIONAL))
#: Days from 1900-01-01 to 2099-12-31, and two factors whose product is the next larger domain.
DAYS, DAY_A, DAY_B = 73049, 271, 270


def _noise(key: str, tweak: str, turn: Column, other: Column) -> Column:
    """128 hexadecimal digits that depend on key, kind of value, round and the other half."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"), other), 512)


def _number(noise: Column, i: Column | None = None) -> Column:
    at = F.lit(1) if i is None else F.pmod(i, F.lit(32)) * 4 + 1
    return F.conv(F.substring(noise, at, F.lit(4 if i is not None else 12)), 16, 10).cast("bigint")


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))


def _shift(half: Column, noise: Column) -> Column:
    """Every digit and letter moved within its own alphabet."""
    def one(c: Column, i: Column) -> Column:
        code, by = F.ascii(c), _number(noise, i)
        turn = lambda first, n: F.chr(F.pmod(code - first + by, F.lit(n)) + first)
        return (F.when(code.between(48, 57), turn(48, 10)).when(code.between(97, 122), turn(97, 26))
                .when(code.between(65, 90), turn(65, 26)).otherwise(c))

    return F.array_join(F.transform(_chars(half), one), "")


def permute_text(value: Column, key: str, tweak: str) -> Column:
    """Feistel network over the two halves of a text: the alphabet of each place is kept."""
    def go(v: Column) -> Column:
        n = F.floor(F.length(v) / 2).cast("int")
        halves = F.struct(F.substring(v, F.lit(1), n).alias("a"), F.substring(v, n + 1, F.length(v)).alias("b"))
        turns = F.sequence(F.lit(1), F.lit(ROUNDS))
        return F.aggregate(turns, halves, lambda h, t: F.when(t % 2 == 1, F.struct(
            _shift(h["a"], _noise(key, tweak, t, h["b"])).alias("a"), h["b"].alias("b"))).otherwise(F.struct(
                h["a"].alias("a"), _shift(h["b"], _noise(key, tweak, t, h["a"])).alias("b"))),
            lambda h: F.concat(h["a"], h["b"]))

    return let(value, go)


def permute_number(value: Column, a: int, b: int, key: str, tweak: str) -> Column:
    """Feistel network over [0, a * b)."""
    halves = F.struct(F.floor(value / b).cast("bigint").alias("a"), F.pmod(value, F.lit(b)).cast("bigint").alias("b"))
    turns = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(turns, halves, lambda h, t: F.when(t % 2 == 1, F.struct(
        F.pmod(h["a"] + _number(_noise(key, tweak, t, h["b"].cast("string"))), F.lit(a)).alias("a"), h["b"].alias("b"))).otherwise(F.struct(
            h["a"].alias("a"), F.pmod(h["b"] + _number(_noise(key, tweak, t, h["a"].cast("string"))), F.lit(b)).alias("b"))),
        lambda h: h["a"] * b + h["b"])


def _walk(value: Column, permute, valid) -> Column:
    """``permute`` once, and again while the result is not valid; still a permutation of the valid values."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), permute(value),
                       lambda v, _: F.when(valid(v), v).otherwise(permute(v)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(shape: Column, symbols: Column, kind: str) -> Column:
    """``shape`` with its characters of the class ``kind`` replaced, in order, by ``symbols``."""
    def one(c: Column, i: Column) -> Column:
        seen = F.length(F.regexp_replace(F.substring(shape, F.lit(1), i + 1), f"[^{kind}]", ""))
        return F.when(F.regexp_like(c, F.lit(f"[{kind}]")), F.substring(symbols, seen, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_chars(shape), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum, doubling every second digit from the one before the last."""
    def one(c: Column, i: Column) -> Column:
        d = F.ascii(c) - 48
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.reverse(_chars(digits)), one), F.lit(0), lambda n, x: n + x)


def _mod97(alnum: Column) -> Column:
    moved = F.concat(F.substring(alnum, F.lit(5), F.length(alnum)), F.substring(alnum, 1, 4))
    return F.aggregate(_chars(moved), F.lit(0), lambda n, c: F.when(
        F.ascii(c) < 58, F.pmod(n * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(F.pmod(n * 100 + F.ascii(c) - 55, F.lit(97))))


def _email(m: Column, key: str) -> Column:
    local, domain = F.lower(F.split_part(m, F.lit("@"), F.lit(1))), F.split_part(m, F.lit("@"), F.lit(2))
    return F.concat(permute_text(local, key, "email"), F.lit("@"), domain)


def _iban(m: Column, key: str) -> Column:
    def go(v: Column) -> Column:
        body = F.concat(F.substring(v, 1, 2), F.lit("00"), permute_text(F.substring(v, F.lit(5), F.length(v)), key, "iban"))
        made = let(body, lambda b: F.concat(F.substring(b, 1, 2), F.lpad((F.lit(98) - _mod97(b)).cast("string"), 2, "0"),
                                            F.substring(b, F.lit(5), F.length(b))))
        return F.when((F.length(v) >= 15) & (_mod97(v) == 1), _refill(m, made, "A-Z0-9")).otherwise(m)

    return let(F.regexp_replace(m, " ", ""), go)


def _card(m: Column, key: str) -> Column:
    def go(d: Column) -> Column:
        body = permute_text(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
        made = let(body, lambda b: F.concat(b, F.pmod(-_luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(F.pmod(_luhn_sum(d), F.lit(10)) == 0, _refill(m, made, "0-9")).otherwise(m)

    return let(_digits(m), go)


def _phone(m: Column, key: str, code: str = CALLING_CODE) -> Column:
    """The country code, or the trunk 0 of a national number, stays: it is part of the format. All other digits are permuted as one number, so
    spaced, unspaced, national and international spellings of a number stay linked."""
    code = F.regexp_extract(m, code, 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    def go(d: Column) -> Column:
        return F.when(F.length(d).between(7, 15), F.concat(code, _refill(rest, permute_text(d, key, "phone"), "0-9"))).otherwise(m)

    return let(_digits(rest), go)


def _valid_ssn(d: Column) -> Column:
    area = F.substring(d, 1, 3)
    return ~area.isin("000", "666") & (F.substring(d, 1, 1) != "9") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000")


def _ssn(m: Column, key: str) -> Column:
    def go(d: Column) -> Column:
        made = _walk(d, lambda v: permute_text(v, key, "ssn"), _valid_ssn)
        return F.when(_valid_ssn(d), _refill(m, made, "0-9")).otherwise(m)

    return let(_digits(m), go)


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    def go(o: Column) -> Column:
        number = F.aggregate(o, F.lit(0).cast("bigint"), lambda n, x: n * 256 + x)
        made = let(permute_number(number, 65536, 65536, key, "ip"), lambda n: F.concat_ws(
            ".", *[F.pmod(F.shiftright(n, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]))
        return F.when(F.array_max(o) < 256, made).otherwise(m)

    return let(octets, go)


def _date(m: Column, key: str) -> Column:
    """Year first, else day before month if that is a date, else month before day; the result keeps the order."""
    sep = F.regexp_extract(m, "[./-]", 0)
    def go(p: Column) -> Column:
        first = F.length(F.get(p, F.lit(0))) == 4
        day = lambda y, mo, d: F.try_make_timestamp(F.get(p, F.lit(y)).cast("int"), F.get(p, F.lit(mo)).cast("int"), F.get(p, F.lit(d)).cast("int"),
                                                    F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")).cast("date")
        ymd, dmy, mdy = day(0, 1, 2), day(2, 1, 0), day(2, 0, 1)
        value = F.when(first, ymd).otherwise(F.coalesce(dmy, mdy))
        begin = F.lit("1900-01-01").cast("date")

        def spell(d: Column) -> Column:
            pad = lambda c, n: F.when(F.length(F.get(p, F.lit(n))) == 2, F.lpad(c.cast("string"), 2, "0")).otherwise(c.cast("string"))
            y, mo, dd = F.lpad(F.year(d).cast("string"), 4, "0"), F.month(d), F.dayofmonth(d)
            return (F.when(first, F.concat(y, sep, pad(mo, 1), sep, pad(dd, 2)))
                    .when(dmy.isNotNull(), F.concat(pad(dd, 0), sep, pad(mo, 1), sep, y))
                    .otherwise(F.concat(pad(mo, 0), sep, pad(dd, 1), sep, y)))

        def permuted(v: Column) -> Column:
            number = F.datediff(v, begin).cast("bigint")
            made = _walk(number, lambda n: permute_number(n, DAY_A, DAY_B, key, "date"), lambda n: n < DAYS)
            within = F.datediff(v, begin).between(0, DAYS - 1)
            return F.when(within, let(F.date_add(begin, made.cast("int")), spell)).otherwise(m)

        return F.when(value.isNull(), m).otherwise(let(value, permuted))

    return let(F.split(m, "[./-]"), go)


def _pseudonym(m: Column, key: str) -> Column:
    whole = lambda p: F.regexp_like(m, F.lit(f"^(?:{p})$"))
    return (F.when(F.contains(m, F.lit("@")), _email(m, key)).when(whole(IPV4), _ip(m, key)).when(whole(SSN), _ssn(m, key))
            .when(whole(DATE), _date(m, key)).when(whole(IBAN), _iban(m, key)).when(whole(PHONE), _phone(m, key))
            .when(whole(CARD), _card(m, key)).otherwise(_phone(m, key, r"^\(?0")))


def pseudonymise(text: Column, key: str) -> Column:
    """The whole text with every valid personal value replaced; null stays null, text without any stays as it is."""
    def fill(found: Column) -> Column:
        made = F.transform(found, lambda m: _pseudonym(m, key))
        between = F.split(text, ANY, -1)
        return F.when(F.size(found) == 0, text).otherwise(F.array_join(F.zip_with(
            between, made, lambda b, m: F.concat(b, F.coalesce(m, F.lit("")))), ""))

    return F.when(F.regexp_like(text, F.lit("[0-9@]")), let(F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1)), fill)).otherwise(text)


def pseudonymise_column(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the column replaced. Every row stays, repeated rows alike; other columns are not touched."""
    return docs.withColumn(text, pseudonymise(F.col(text), key))
