"""Format-preserving pseudonyms for personal numbers, dates and addresses, with column functions only.

A value is found by its form, validated, split into symbols (digits, letters, octets, days), and the symbols are
permuted by a keyed Feistel network: two halves in turn take a hash of the key and the other half, symbol by symbol and
modulo the symbol's range. So a pseudonym has the form of its value and is valid itself, equal values get equal
pseudonyms in all documents, different values different ones, and nobody can go back without the key.

| kind | valid if | permuted | kept |
|---|---|---|---|
| email | an address with a domain | letters and digits of the local part | domain, other characters |
| iban | check digits fit; in one piece, or in groups of four as long as the country's numbers are | letters and digits of the account | country; check digits are made anew |
| ip | four octets of 0 to 255 | octets | |
| date | the day exists; year first, or day first with ``.`` or ``-``, or month first with ``/``, day first where month first is no date; ISO times may follow | the day within its 400-year cycle; day first with ``/`` stays above 12, so that no two days get one text | form, leading zeros |
| ssn | area, group and serial in use | the three numbers | |
| phone | 8 to 15 digits with ``+``, else ten in American groups, ``1`` before them or not | digits after the country code | form; no leading zero appears or goes |
| card | 13 to 19 digits with a right check digit | digits between the first and the last | first digit; the check digit is made anew |

What looks alike but is not valid stays as it is, and the search goes on one place behind its beginning. A number with
``+`` ends where its country's numbers do, if they have one length, else with the last group that fits; no number runs
into an address, a date or another number behind it.

* null text: null; empty text: itself; very long text: searched whole, in one pass;
* null or repeated ids and rows: every row is treated on its own;
* other columns: kept by ``pseudonymised``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions.common import let

ROUNDS = 8
# A hash gives 16 symbols of four hex digits; two hashes serve the longest half, that of a 64-character address.
HASHES = 2
SYMBOL_HEX = 4

# A name has 126 labels at most; without a bound the matcher would go one call deeper for each.
EMAIL = (
    r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9])"
)
# Lengths of account numbers by country, of which the printed groups of four do not tell the end (fixed values).
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_GROUPED = "|".join(
    rf"(?:{c.replace(' ', '|')})\d{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, c in _IBAN_LENGTHS.items()
)
IBAN = rf"(?<!\w)(?:[A-Z]{{2}}\d{{2}}[A-Z0-9]{{11,30}}|(?=[A-Z]{{2}}\d{{2}} )(?:{_GROUPED}))(?!\w)"
IP = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)"
_MARKS = ("-", "/", r"\.")
_YEAR_FIRST = "|".join(rf"\d{{4}}{m}\d{{1,2}}{m}\d{{1,2}}" for m in _MARKS)
_YEAR_LAST = "|".join(rf"\d{{1,2}}{m}\d{{1,2}}{m}\d{{4}}" for m in _MARKS)
# A time may follow a date of ISO form.
DATE = (
    rf"(?<![\w./-])(?:(?:{_YEAR_FIRST}|{_YEAR_LAST})(?![/-]?\w|\.\d)"
    r"|\d{4}-\d{1,2}-\d{1,2}(?=[Tt]\d{2}(?!\d{3})|Z(?!\w)))"
)
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?!-?\w)"
NATIONAL = (
    r"(?<!\w)(?:1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!-?\w)|(?<![\w-])(?:1-)?\d{3}-\d{3}-\d{4}(?!-?\w)"
    r"|(?<![\w.-])(?:1[ .])?\d{3}\.\d{3}\.\d{4}(?![.-]?\w)|(?<![\w.-])(?:1 )?\d{3} \d{3} \d{4}(?![.-]?\w)"
)
# What a number with spaces does not run into.
_OTHER = "|".join([IP, DATE, SSN, EMAIL])
CARD = (
    r"(?<![\w-])(?:\d{13,19}"
    + "".join(rf"|\d{{4}}{m}\d{{4}}{m}\d{{4}}{m}{n}\d{{1,7}}" for m, n in ((" ", f"(?!{_OTHER})"), ("-", "")))
    + r"|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?!-?\w)"
)
# Countries whose numbers have one length: digits after the country code (fixed values).
_LENGTHS = {10: "1|7|30|44|52|90|91", 9: "27|31|33|34|40|41|48|61|351|380|420|421", 8: "45|47|65|852"}


def _complete(n: int, countries: str) -> str:
    """Numbers of ``n`` digits after the country code, which end there whatever follows."""
    digit = rf"(?:(?: (?!{_OTHER})|[.-])?\d)"
    in_brackets = "|".join(rf"[ .-]?\(\d{{{k}}}\){digit}{{{n - k}}}" for k in range(2, 6))
    return rf"(?:{countries})(?:[ .-]?\(0\))?(?:{digit}{{{n}}}|{in_brackets})(?!\d)"


def _general() -> str:
    """8 to 15 digits in groups. A last group of one digit belongs to the number only behind another such group."""

    def digit(stop: str) -> str:
        return rf"(?:(?:(?: (?!{stop})|[.-])(?:(?<=[ .-]\d[ .-])|(?=\d[ .-]?\d)))?\d)"

    # Ten and more digits never belong to a number that has eight already; of a row of groups of four, the last ones
    # are the card.
    rest = rf"{digit(rf'{_OTHER}|{NATIONAL}|(?:{CARD})(?! \d{{4}}(?!\d))')}{{0,7}}"
    bracketed = "|".join(
        rf"\d{{{c}}}[ .-]?\(\d{{{k}}}\){digit(_OTHER)}{{{8 - c - k}}}" for c in range(1, 4) for k in range(1, 5)
    )
    return rf"(?:\d{digit(_OTHER)}{{7}}|{bracketed}){rest}(?!\w)"


PHONE = rf"(?<![\w+])\+(?:{'|'.join(_complete(*x) for x in _LENGTHS.items())}|{_general()})|{NATIONAL}"
# No value begins inside a word; what begins with a letter is an address or an account.
ANY = (
    rf"(?<!\w)(?:(?=[A-Za-z])(?:{EMAIL}|{IBAN})"
    rf"|(?=[0-9+(])(?:{'|'.join([EMAIL, IP, DATE, SSN, PHONE, CARD])}))"
)
# A text without these holds no value.
MARKS = "[0-9@]"
# So many places of a text are joined at a time.
PLACES = 256

# A Gregorian cycle of 400 years has 146,097 = 189 x 773 days.
CYCLE_YEARS, CYCLE_FACTORS = 400, (189, 773)
FIRST_CYCLE = 1700
# Three of five days are above 12; the chance that none of so many is: below 1e-25.
WALK = 64


def _permuted(values: Column, ranges: Column, tweak: Column, key: str) -> Column:
    """The values after the Feistel rounds; each value is below its range before and after."""

    def mixed(state: Column, round_no: Column) -> Column:
        other = F.array_join(F.transform(state.b, lambda x: x.cast("string")), ",")
        said = F.concat_ws(",", F.lit(key), state.tweak, round_no.cast("string"), other)
        noise = let(said, lambda x: F.concat(*[F.sha2(F.concat(x, F.lit(f"#{k}")), 256) for k in range(HASHES)]))

        def moved(hashed: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                drawn = F.conv(hashed.substr(i * SYMBOL_HEX + 1, F.lit(SYMBOL_HEX)), 16, 10).cast("int")
                return F.pmod(x.v + drawn, x.r)

            return F.transform(F.arrays_zip(state.a.alias("v"), state.ra.alias("r")), one)

        return F.struct(
            state.b.alias("a"),
            let(noise, moved).alias("b"),
            state.rb.alias("ra"),
            state.ra.alias("rb"),
            state.tweak.alias("tweak"),
        )

    def rounds(x: Column) -> Column:
        half = F.floor(F.size(x.v) / 2).cast("int")
        rest = F.size(x.v) - half
        start = F.struct(
            F.slice(x.v, F.lit(1), half).alias("a"),
            F.slice(x.v, half + 1, rest).alias("b"),
            F.slice(x.r, F.lit(1), half).alias("ra"),
            F.slice(x.r, half + 1, rest).alias("rb"),
            x.t.alias("tweak"),
        )
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, mixed, lambda done: F.concat(done.a, done.b))

    return let(F.struct(values.alias("v"), ranges.alias("r"), tweak.alias("t")), rounds)


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _put(chars: Column, new: Column, symbol: Callable[[Column], Column]) -> Column:
    """A text whose symbols are replaced by those of ``new``, one after the other."""

    def put(state: Column, c: Column) -> Column:
        return let(
            symbol(c),
            lambda is_symbol: F.struct(
                F.concat(state.s, F.when(is_symbol, F.get(state.new, state.k)).otherwise(c)).alias("s"),
                (state.k + is_symbol.cast("int")).alias("k"),
                state.new.alias("new"),
            ),
        )

    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"), new.alias("new"))
    return F.aggregate(chars, start, put, lambda done: done.s)


def _digit(c: Column) -> Column:
    return c.between("0", "9")


def _symbol(c: Column) -> Column:
    return _digit(c) | c.between("a", "z") | c.between("A", "Z")


def _permuted_chars(text: Column, tweak: str, key: str) -> Column:
    """Digits and ASCII letters permuted within their classes, other characters kept. The first symbol, if it is a
    digit but zero, stays above zero."""

    def spec(c: Column, i: Column) -> Column:
        # The lowest symbol of the class, and how many there are.
        low = F.when((i == 0) & c.between("1", "9"), 49).when(_digit(c), 48).when(c.between("a", "z"), 97).otherwise(65)
        many = F.when((i == 0) & c.between("1", "9"), 9).when(_digit(c), 10).otherwise(26)
        return F.struct((F.ascii(c) - low).alias("v"), many.alias("r"), low.alias("low"))

    def of(chars: Column) -> Column:
        def permuted(specs: Column) -> Column:
            classes = F.array_join(F.transform(specs, lambda x: F.concat_ws("/", x.low, x.r)), " ")
            ranges, values = F.transform(specs, lambda x: x.r), F.transform(specs, lambda x: x.v)
            new = _permuted(values, ranges, F.concat(F.lit(tweak + " "), classes), key)
            letters = F.zip_with(new, specs, lambda v, x: F.chr(v + x.low))
            return _put(chars, letters, _symbol)

        return let(F.transform(F.filter(chars, _symbol), spec), permuted)

    return let(_chars(text), of)


def _email(value: Column, key: str) -> Column:
    local = F.substring_index(value, "@", 1)
    return F.concat(_permuted_chars(local, "email", key), F.substr(value, F.length(local) + 1))


def _mod97(text: Column) -> Column:
    """A number of digits and letters (A is 10, Z is 35) modulo 97."""

    def add(rest: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.when(digit, F.pmod(rest * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(
            F.pmod(rest * 100 + F.ascii(c) - 55, F.lit(97))
        )

    return F.aggregate(_chars(text), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    country, account = F.substr(value, F.lit(1), F.lit(2)), F.substr(value, F.lit(5))

    def close(text: Column) -> Column:
        return F.replace(text, F.lit(" "), F.lit(""))

    def made_of(new: Column) -> Column:
        check = F.lit(98) - _mod97(F.concat(close(new), country, F.lit("00")))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), new)

    made = let(_permuted_chars(account, "iban", key), made_of)
    valid = _mod97(F.concat(close(account), F.substr(value, F.lit(1), F.lit(4)))) == 1
    return F.when(valid, made)


def _numbers(value: Column, separators: str) -> Column:
    return F.transform(F.split(value, separators), lambda x: x.cast("int"))


def _ip(value: Column, key: str) -> Column:
    def of(octets: Column) -> Column:
        new = _permuted(octets, F.array_repeat(F.lit(256), 4), F.lit("ip"), key)
        made = F.array_join(F.transform(new, lambda x: x.cast("string")), ".")
        return F.when(F.forall(octets, lambda x: x <= 255), made)

    return let(_numbers(value, r"\."), of)


def _ssn(value: Column, key: str) -> Column:
    def of(numbers: Column) -> Column:
        area, group, serial = (F.get(numbers, F.lit(i)) for i in range(3))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        # 898 areas are in use: 1 to 899 without 666.
        values = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)
        new = _permuted(values, F.array(F.lit(898), F.lit(99), F.lit(9999)), F.lit("ssn"), key)

        def made(x: Column) -> Column:
            first = F.get(x, F.lit(0))
            new_area = first + F.when(first >= 665, 2).otherwise(1)
            return F.format_string("%03d-%02d-%04d", new_area, F.get(x, F.lit(1)) + 1, F.get(x, F.lit(2)) + 1)

        return F.when(valid, let(new, made))

    return let(_numbers(value, "-"), of)


def _date(value: Column, key: str) -> Column:
    mark = F.regexp_extract(value, r"^\d+([-/.])", 1)

    def of(x: Column) -> Column:
        # x: the three numbers as written, and which comes first.
        numbers = F.transform(x.words, lambda w: w.cast("int"))
        at = [F.get(numbers, F.lit(i)) for i in range(3)]
        year = F.when(x.year_first, at[0]).otherwise(at[2])
        month = F.when(x.month_first, at[0]).otherwise(at[1])
        day = F.when(x.year_first, at[2]).when(x.month_first, at[1]).otherwise(at[0])
        parts = F.struct(x.alias("x"), year.alias("year"), month.alias("month"), day.alias("day"))
        return let(parts, checked)

    def checked(p: Column) -> Column:
        first = F.make_date(F.greatest(p.year, F.lit(1)), F.greatest(F.least(p.month, F.lit(12)), F.lit(1)), F.lit(1))
        valid = (p.year >= 1) & p.month.between(1, 12) & (p.day >= 1) & (p.day <= F.dayofmonth(F.last_day(first)))
        return F.when(valid, moved(p))

    def moved(p: Column) -> Column:
        # Days are counted in the cycle that begins with FIRST_CYCLE, which any other one repeats.
        cycles = F.floor((p.year - FIRST_CYCLE) / CYCLE_YEARS).cast("int") * CYCLE_YEARS
        begin = F.make_date(F.lit(FIRST_CYCLE), F.lit(1), F.lit(1))
        number = F.datediff(F.make_date(p.year - cycles, p.month, F.lit(1)), begin) + p.day - 1
        outer, inner = CYCLE_FACTORS
        tweak = F.concat_ws(" ", F.lit("date"), cycles.cast("string"))

        def step(number: Column) -> Column:
            values = F.array(F.floor(number / inner).cast("int"), F.pmod(number, F.lit(inner)).cast("int"))
            new = _permuted(values, F.array(F.lit(outer), F.lit(inner)), tweak, key)
            return let(new, lambda v: F.get(v, F.lit(0)) * inner + F.get(v, F.lit(1)))

        def walked(state: Column, _: Column) -> Column:
            def told(n: Column) -> Column:
                fits = ~p.x.day_first_slash | (F.dayofmonth(F.date_add(begin, n)) > 12)
                return F.struct(n.alias("n"), fits.alias("done"))

            return F.when(state.done, state).otherwise(let(step(state.n), told))

        # Day first with "/" is told by a day above 12, so the permutation goes on until it comes to such a day again.
        start = F.struct(number.alias("n"), F.lit(False).alias("done"))
        n = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, walked, lambda done: done.n)
        day = F.date_add(begin, n)
        return let(F.struct(day.alias("day"), cycles.alias("cycles"), p.x.alias("x")), written)

    def written(d: Column) -> Column:
        # A value that has a number of one digit has no leading zeros.
        padded = F.forall(d.x.words, lambda w: F.length(w) > 1)

        def two(n: Column) -> Column:
            return F.when(padded, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))

        year_no = F.year(d.day) + d.cycles
        year = F.lpad(year_no.cast("string"), 4, "0")
        month, day = two(F.month(d.day)), two(F.dayofmonth(d.day))
        made = (
            F.when(d.x.year_first, F.concat(year, mark, month, mark, day))
            .when(d.x.month_first, F.concat(month, mark, day, mark, year))
            .otherwise(F.concat(day, mark, month, mark, year))
        )
        # The first and the last cycle are not whole with years of four digits.
        return F.when(year_no.between(1, 9999), made).otherwise(value)

    words = F.split(value, "[-/.]")
    year_first = F.length(F.get(words, F.lit(0))) == 4
    slash = ~year_first & (mark == "/")
    # Month first wherever that can be.
    day_first = slash & (F.get(words, F.lit(0)).cast("int") > 12)
    forms = [year_first.alias("year_first"), (slash & ~day_first).alias("month_first"), day_first.alias("day_first_slash")]
    return let(F.struct(words.alias("words"), *forms), of)


def _phone(value: Column, key: str) -> Column:
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    # The country code, as far as the form tells: up to the first mark, else 1 or two digits; without "+" only 1.
    country = F.regexp_extract(value, r"^\+(?:1(?=[^0-9])|\d{1,3}(?=[^0-9])|1|\d{2})|^1(?=[ .(-])", 0)
    made = let(
        country, lambda c: F.concat(c, _permuted_chars(F.substr(value, F.length(c) + 1), "phone", key))
    )
    return F.when(~value.startswith("+") | digits.between(8, 15), made)


def _check_digit(digits: Column) -> Column:
    """The digit that makes the check sum of a number come out, given the digits before it."""
    turned = F.reverse(F.transform(digits, lambda c: c.cast("int")))
    doubled = F.transform(turned, lambda d, i: F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d, lambda total: F.pmod(-total, F.lit(10)))


def _card(value: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        n = F.size(digits)
        body = F.slice(digits, F.lit(1), n - 1)
        inner = F.transform(F.slice(digits, F.lit(2), n - 2), lambda c: c.cast("int"))
        tweak = F.concat_ws(" ", F.lit("card"), n.cast("string"))
        new = _permuted(inner, F.array_repeat(F.lit(10), n - 2), tweak, key)
        new_body = F.concat(F.slice(digits, F.lit(1), F.lit(1)), F.transform(new, lambda x: x.cast("string")))
        made = let(
            new_body,
            lambda b: _put(_chars(value), F.concat(b, F.array(_check_digit(b).cast("string"))), _digit),
        )
        valid = (n >= 13) & (_check_digit(body) == F.element_at(digits, -1).cast("int"))
        return F.when(valid, made)

    return let(F.filter(_chars(value), _digit), of)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a found value; null if it is not valid."""

    def is_(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    return (
        F.when(value.contains("@"), _email(value, key))
        .when(is_(r"[A-Z]{2}.*"), _iban(value, key))
        .when(is_(r"\d+(?:\.\d+){3}"), _ip(value, key))
        .when(is_(r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{4}"), _date(value, key))
        .when(is_(r"\d{3}-\d{2}-\d{4}"), _ssn(value, key))
        .when(is_(r"\+.*|(?:1[ .-]?)?(?:\(.*|\d{3}([ .-])\d{3}\1\d{4})"), _phone(value, key))
        .otherwise(_card(value, key))
    )


def _replaced(text: Column, found: Column, key: str) -> Column:
    """The text with pseudonyms, and how many values they changed.

    ``found`` has a value for each place of the text where one may begin. Places are taken from the left: one inside a
    value that was replaced is passed over, and behind a value that is not valid the next place counts.
    """
    parts = F.split(text, f"(?={ANY})", -1)

    def pairs_of(parts: Column) -> Column:
        # No place, if the text does not begin with one.
        ahead = F.when(F.size(parts) > F.size(found), F.array(F.lit(None).cast("string"))).otherwise(
            F.array().cast("array<string>")
        )
        return F.arrays_zip(parts.alias("part"), F.concat(ahead, found).alias("value"))

    def put(state: Column, x: Column) -> Column:
        def placed(new: Column) -> Column:
            taken = F.when(new.isNotNull(), F.length(x.value)).otherwise(state.taken)
            return F.struct(
                F.concat(
                    state.out,
                    F.array(F.concat(F.coalesce(new, F.lit("")), F.substr(x.part, taken + 1))),
                ).alias("out"),
                F.greatest(taken - F.length(x.part), F.lit(0)).alias("taken"),
                (state.n + F.coalesce(new != x.value, F.lit(False)).cast("long")).alias("n"),
            )

        return let(F.when((state.taken == 0) & x.value.isNotNull(), pseudonym(x.value, key)), placed)

    def joined(pairs: Column) -> Column:
        def portion(state: Column, begin: Column) -> Column:
            start = F.struct(F.array().cast("array<string>").alias("out"), state.taken.alias("taken"), state.n.alias("n"))
            done = F.aggregate(F.slice(pairs, begin, F.lit(PLACES)), start, put)
            return let(
                done,
                lambda d: F.struct(
                    F.concat(state.out, F.array(F.array_join(d.out, ""))).alias("out"),
                    d.taken.alias("taken"),
                    d.n.alias("n"),
                ),
            )

        start = F.struct(
            F.array().cast("array<string>").alias("out"), F.lit(0).alias("taken"), F.lit(0).cast("long").alias("n")
        )
        begins = F.sequence(F.lit(1), F.size(pairs), F.lit(PLACES))
        return F.aggregate(
            begins, start, portion, lambda d: F.struct(F.array_join(d.out, "").alias("text"), d.n.alias("n"))
        )

    return let(parts, lambda p: let(pairs_of(p), joined))


def pseudonymised(df: DataFrame, key: str, text: str = "text", count: str | None = "n_replaced") -> DataFrame:
    """``df`` with the values in ``text`` replaced, its columns in their order, and behind them, unless ``count`` is
    None, how many values were replaced.

    The key is a literal of the plan; keep plans and event logs as safe as the key.
    """
    names = df.columns
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col(f"`{text}`").alias("text"),
        F.when(
            F.col(f"`{text}`").rlike(MARKS),
            F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"(?=({ANY}))"), F.lit(1)),
        ).alias("found"),
    )
    hit = F.coalesce(F.size("found"), F.lit(0)) > 0
    rows = rows.select("row", "text", F.when(hit, _replaced(F.col("text"), F.col("found"), key)).alias("new"))
    result = rows.select(
        "row",
        F.coalesce("new.text", "text").alias("text"),
        F.coalesce("new.n", F.lit(0).cast("long")).alias("n"),
    )
    kept = [F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in names]
    return result.select(*kept, *([F.col("n").alias(count)] if count else []))
