"""Pseudonyms that keep the format: keyed Feistel permutations of private values, in DataFrame functions only.

A value is found by its pattern, validated where it has a rule (issuer, length and check
digit of a card number, the ranges of an address or a calendar date), and replaced by another
of the same format under the key. The same value gets the same pseudonym in every document,
and different values of one format get different ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import let, text_of, wrapped

ROUNDS = 8
# The Gregorian calendar repeats after 146,097 days, which is 189 times 773: two halves
# whose product is the whole domain, so that a permuted date is always a date.
FIRST_DAY, DATE_HALVES = "1800-01-01", (189, 773)
ADDRESS_HALVES = (65536, 65536)


# What must not stand before and after a value.
_START, _END = r"(?<![0-9A-Za-z_])(?<![0-9][.,+-])", r"(?![0-9A-Za-z_]|[.,-][0-9])"


@dataclass(frozen=True)
class Kind:
    """Forms of a value: what stands before it, the value, what stands after it.

    A found value is of the first kind whose form it has; ``told`` is that form where it
    is simpler than the values.
    """

    name: str
    forms: tuple[tuple[str, str, str], ...]
    told: str = ""

    @property
    def pattern(self) -> str:
        return "|".join(before + value + after for before, value, after in self.forms)

    @property
    def bare(self) -> str:
        return self.told or "|".join(value for _, value, _ in self.forms)


# Earlier kinds win where two begin at one place.
_OTHERS = (
    Kind("email", (
        (r"(?<![0-9A-Za-z._%+-])", r"[0-9A-Za-z][0-9A-Za-z._%+-]{0,63}@(?:[0-9A-Za-z-]{1,63}[.]){1,8}[A-Za-z]{2,24}", ""),
    )),
    Kind("secret", (
        ("", r"(?i:password)[=:][0-9A-Za-z]{8,128}", ""),
        ("", r"(?i:token) = \"[0-9A-Fa-f]{16,128}", r"(?=\")"),
        (r"(?<![0-9A-Za-z])", r"AKIA[0-9A-Z]{16}", r"(?![0-9A-Za-z])"),
    )),
    Kind("date", (
        (_START, r"[0-9]{4}-[0-9]{2}-[0-9]{2}", _END),
        (_START, r"[0-9]{2}[./][0-9]{2}[./][0-9]{4}", _END),
    )),
    Kind("address", ((_START, r"[0-9]{1,3}(?:[.][0-9]{1,3}){3}", _END),)),
    Kind("phone", (
        # Of eleven digits on a number is whole and takes no more groups; a shorter one takes what follows it.
        (r"(?<![0-9A-Za-z])",
         r"[+][0-9]{1,3}[ .-]?[(]?[0-9]{2,4}[)]?(?:[ .-]?[0-9]{2,4}){2,3}?(?<=[0-9]" + 10 * "[ .()-]{0,3}[0-9]" + ")", _END),
        (r"(?<![0-9A-Za-z])", r"[+][0-9]{1,3}[ .-]?[(]?[0-9]{2,4}[)]?(?:[ .-]?[0-9]{2,4}){2,3}", _END),
        (r"(?<![0-9A-Za-z+])", r"[(][0-9]{3}[)] ?[0-9]{3}[ .-][0-9]{4}", _END),
        (_START, r"[0-9]{3}-[0-9]{3}-[0-9]{4}", _END),
    )),
)
# A card is looked for in the whole run of digit groups it stands in, up to where another kind begins: which
# groups are the card's, only the check digit tells.
_NEXT = f"[ -](?!{'|'.join(k.pattern for k in _OTHERS)})"
_GROUP = "[0-9]++(?![0-9A-Za-z_]|[.,][0-9])"
_RUN = f"(?=[0-9](?:(?:{_NEXT})?[0-9]){{12}}){_GROUP}(?:{_NEXT}{_GROUP})*+"
KINDS = _OTHERS + (Kind("card", ((_START, _RUN, ""),), told="[0-9][0-9 -]{12,}"),)
# Groups of digits in the usual printings of a card number, beside the unbroken one; one mark stands between all of them.
PRINTED = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3))
CARD_FORMS = ("[0-9]{13,19}",) + tuple(
    mark.join(f"[0-9]{{{n}}}" for n in groups) for groups in PRINTED for mark in (" ", "-")
)
# The digits that a card number of each issuer begins with, and how many follow them.
ISSUED = "|".join((
    "4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})",
    "(?:5[1-5][0-9]{2}|222[1-9]|22[3-9][0-9]|2[3-6][0-9]{2}|27[01][0-9]|2720)[0-9]{12}",
    "3[47][0-9]{13}",
    "3(?:0[0-59]|[689][0-9])[0-9]{11,16}",
    "35(?:2[89]|[3-8][0-9])[0-9]{12,15}",
    "(?:6011|64[4-9][0-9]|65[0-9]{2}|62[0-9]{2})[0-9]{12,15}",
    "(?:5018|5020|5038|5893|6304|6759|676[1-3])[0-9]{9,15}",
))
# Digits of a card number that say whose it is; they stay.
ISSUER = 4
# A group of so many digits that no card takes is a number of its own; a run with more of them
# than may stand around cards is a table, whose groups are no card.
NUMBER, NUMBERS_AROUND = 4, 2
# Java's matcher and its split find the same places: gaps and values alternate.
ANY = "|".join(f"(?:{k.pattern})" for k in KINDS)
# Every kind has one of these; most texts have none.
HINT = '[0-9@]|AKIA|(?i:password)[=:]|(?i:token) = "'


def _prf(key: str, tweak: Column, half: Column, size: Column | int) -> Column:
    """A number below ``size``, from the keyed digest of one half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, half), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 14), 16, 10).cast("long"), size)


def _permuted_pair(a: Column, b: Column, sizes: tuple[int, int], key: str, name: str) -> Column:
    """Struct of two numbers, permuted within ``sizes``: each round adds a digest of one half to the other."""
    def one(pair: Column, i: Column) -> Column:
        tweak = F.concat(F.lit(f"{name}|"), i.cast("string"))
        first = F.pmod(pair["a"] + _prf(key, tweak, pair["b"].cast("string"), sizes[0]), sizes[0])
        second = F.pmod(pair["b"] + _prf(key, tweak, pair["a"].cast("string"), sizes[1]), sizes[1])
        even = i % 2 == 0
        return F.struct(F.when(even, first).otherwise(pair["a"]).alias("a"), F.when(even, pair["b"]).otherwise(second).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one)


_CLASSES = (("0", "9"), ("a", "z"), ("A", "Z"))


def _shifted(char: Column, number: Column) -> Column:
    """The character moved by ``number`` within its class; one that is no ASCII digit or letter stays."""
    code, out = F.ascii(char), char
    for low, high in _CLASSES:
        size = ord(high) - ord(low) + 1
        out = F.when(
            char.between(low, high), F.char(F.lit(ord(low)) + F.pmod(code - ord(low) + number, size))
        ).otherwise(out)
    return out


def _shifted_half(half: Column, other: Column, key: str, tweak: Column) -> Column:
    chars = F.filter(F.split(half, ""), lambda c: c != "")
    moved = F.transform(
        chars, lambda c, j: _shifted(c, _prf(key, F.concat(tweak, F.lit("|"), j.cast("string")), other, 1 << 40))
    )
    return F.array_join(moved, "")


def _permuted_text(value: Column, key: str, name: str) -> Column:
    """A string permuted among those with the same character classes in the same places.

    A Feistel network on its two halves: each round moves every character of one half, within
    its class, by a digest of the other half. A string of one character is moved by the key.
    """
    middle = (F.length(value) / 2).cast("int")

    def one(pair: Column, i: Column) -> Column:
        tweak = F.concat(F.lit(f"{name}|"), i.cast("string"))
        even = i % 2 == 0
        return F.struct(
            F.when(even, _shifted_half(pair["a"], pair["b"], key, tweak)).otherwise(pair["a"]).alias("a"),
            F.when(even, pair["b"]).otherwise(_shifted_half(pair["b"], pair["a"], key, tweak)).alias("b"),
        )

    start = F.struct(
        F.substring(value, F.lit(1), middle).alias("a"), F.substring(value, middle + 1, F.length(value)).alias("b")
    )
    pair = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one)
    return let(pair, lambda p: F.concat(p["a"], p["b"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _check_digit(payload: Column) -> Column:
    """The digit that makes a card number valid."""
    def doubled(c: Column, j: Column) -> Column:
        d = c.cast("int") * 2
        return F.when(j % 2 == 0, F.when(d > 9, d - 9).otherwise(d)).otherwise(c.cast("int"))

    places = F.transform(F.filter(F.split(F.reverse(payload), ""), lambda c: c != ""), doubled)
    total = F.aggregate(places, F.lit(0), lambda s, d: s + d)
    return F.pmod(10 - total % 10, 10).cast("string")


def _poured(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced in order."""
    chars = F.filter(F.split(template, ""), lambda c: c != "")
    return F.array_join(
        F.transform(
            chars,
            lambda c, j: F.when(
                c.between("0", "9"),
                F.substring(digits, F.length(_digits(F.substring(template, F.lit(1), j + 1))), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def _valid_card(value: Column) -> Column:
    return let(
        _digits(value),
        lambda d: d.rlike(f"^(?:{ISSUED})$")
        & (_check_digit(F.substring(d, F.lit(1), F.length(d) - 1)) == F.substring(d, F.length(d), F.lit(1))),
    )


def _one_card(value: Column, key: str) -> Column:
    """Another number of the same issuer, with its check digit."""
    def moved(d: Column) -> Column:
        own = F.substring(d, ISSUER + 1, F.length(d) - ISSUER - 1)
        whole = F.concat(F.substring(d, 1, ISSUER), _permuted_text(own, key, "card"))
        return let(whole, lambda m: _poured(value, F.concat(m, _check_digit(m))))

    return let(_digits(value), moved)


def _any_of(values: Column) -> Column:
    """Pattern of the given spans where no digit stands beside them; without any, one that is in no run of digits."""
    return F.concat(F.lit("(?<![0-9])(?:"), F.array_join(F.concat(values, F.array(F.lit("x"))), "|"), F.lit(")(?![0-9])"))


def _cards_pattern(run: Column) -> Column:
    """Pattern of the valid cards of a run of digit groups; in a table of numbers only unbroken ones are."""
    def spans(form: str) -> Column:
        found = F.regexp_extract_all(run, F.lit(f"(?<![0-9])(?=({form})(?![0-9]))"), F.lit(1))
        return F.filter(F.array_distinct(found), _valid_card)

    def sifted(whole: Column) -> Column:
        def both(printed: Column) -> Column:
            rest = F.regexp_replace(run, _any_of(F.concat(whole, printed)), F.lit("x"))
            numbers = F.regexp_count(rest, F.lit(f"(?<![0-9])[0-9]{{{NUMBER},}}"))
            return _any_of(F.when(numbers <= NUMBERS_AROUND, F.concat(whole, printed)).otherwise(whole))

        return let(F.concat(*[spans(form) for form in CARD_FORMS[1:]]), both)

    return let(spans(CARD_FORMS[0]), sifted)


def _card(run: Column, key: str) -> Column:
    """The run with its valid cards replaced."""
    def done(pattern: Column) -> Column:
        made = F.transform(F.regexp_extract_all(run, pattern, F.lit(0)), lambda v: _one_card(v, key))
        return let(
            F.struct(F.split(run, pattern, -1).alias("gaps"), made.alias("made")),
            lambda x: _interleaved(x["gaps"], x["made"]),
        )

    return let(_cards_pattern(run), done)


def _interleaved(gaps: Column, made: Column) -> Column:
    """A gap, a pseudonym, a gap, ..., a gap."""
    return F.array_join(F.transform(gaps, lambda gap, i: F.concat(gap, F.coalesce(F.get(made, i), F.lit("")))), "")


def _address(value: Column, key: str) -> Column:
    def valid(parts: Column) -> Column:
        octets = [parts[i].cast("int") for i in range(4)]
        pair = _permuted_pair(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], ADDRESS_HALVES, key, "address")
        dotted = let(pair, lambda p: F.concat_ws(
            ".", *[x.cast("string") for h in (p["a"], p["b"]) for x in (F.shiftright(h, 8), h.bitwiseAND(F.lit(255)))]
        ))
        # Leading zeros are no address's usual form, and would not come back.
        usual = F.forall(parts, lambda o: (o.cast("int") < 256) & ((F.length(o) == 1) | ~o.startswith("0")))
        return F.when(usual, dotted)

    return let(F.split(value, "[.]"), valid)


def _date(value: Column, key: str) -> Column:
    """Year first, or day or month first (day first where both are possible)."""
    def moved(days: Column) -> Column:
        pair = _permuted_pair(F.floor(days / DATE_HALVES[1]), days % DATE_HALVES[1], DATE_HALVES, key, "date")
        return let(pair, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["a"] * DATE_HALVES[1] + p["b"]).cast("int")))

    def within(day: Column, form) -> Column:
        days = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        inside = days.between(0, DATE_HALVES[0] * DATE_HALVES[1] - 1)
        return F.when(inside, let(days, lambda n: let(moved(n), form)))

    def iso(y: Column, m: Column, d: Column) -> Column:
        return F.concat_ws("-", y, m, d).try_cast("date")

    def spread(day: Column, order: str) -> Column:
        pieces = {"d": F.lpad(F.day(day).cast("string"), 2, "0"), "m": F.lpad(F.month(day).cast("string"), 2, "0"),
                  "y": F.lpad(F.year(day).cast("string"), 4, "0")}
        mark = F.substring(value, 3, 1)
        return F.concat(pieces[order[0]], mark, pieces[order[1]], mark, pieces["y"])

    one, two, year = F.substring(value, 1, 2), F.substring(value, 4, 2), F.substring(value, 7, 4)
    # One order for a text's reader only: a date that reads both ways is taken day first.
    day_first = within(iso(year, two, one), lambda d: spread(d, "dm"))
    month_first = within(iso(year, one, two), lambda d: spread(d, "md"))
    same_mark = F.substring(value, 3, 1) == F.substring(value, 6, 1)
    plain = within(value.try_cast("date"), lambda d: d.cast("string"))
    return F.when(F.substring(value, 5, 1) == "-", plain).otherwise(
        F.when(same_mark, F.coalesce(day_first, month_first))
    )


def _phone(value: Column, key: str) -> Column:
    """All digits but those of the country; a number has 7 to 15."""
    head = F.regexp_extract(value, r"^[+][0-9]{1,3}(?=[ .(-])|^[+]?", 0)
    rest = F.substring(value, F.length(head) + 1, F.length(value))
    enough = F.length(_digits(value)).between(7, 15)
    return F.when(enough, let(rest, lambda r: F.concat(head, _poured(r, _permuted_text(_digits(r), key, "phone")))))


def _email(value: Column, key: str) -> Column:
    """The name; the host stays."""
    at = F.instr(value, "@")
    name = F.substring(value, F.lit(1), at - 1)
    return F.concat(_permuted_text(name, key, "email"), F.substring(value, at, F.length(value)))


def _secret(value: Column, key: str) -> Column:
    """What follows the mark of a secret; of hexadecimal strings too, digits stay digits and letters letters."""
    mark = F.regexp_extract(value, r"^(?:AKIA|(?i:password)[=:]|(?i:token) = \")", 0)
    return F.concat(mark, _permuted_text(F.substring(value, F.length(mark) + 1, F.length(value)), key, "secret"))


_PERMUTE = {"email": _email, "secret": _secret, "date": _date, "address": _address, "phone": _phone, "card": _card}


def pseudonym(value: Column, key: str) -> Column:
    """The replacement of one found value; the value itself where it does not validate."""
    out = value
    for kind in reversed(KINDS):
        out = F.when(
            value.rlike(f"^(?:{kind.bare})$"), F.coalesce(_PERMUTE[kind.name](value, key), value)
        ).otherwise(out)
    return out


def pseudonymized(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` wrapped as ``row``, with ``text`` rewritten, and ``n_found``, ``n_replaced`` (long).

    A value that looks like one of the kinds and does not validate stays as it is. Digit
    groups that a card may stand in count as one value, replaced if any card was. A missing
    text stays missing and has none; an empty one stays empty. Rows are changed one by one
    where they lie, so repeated rows come out repeated, and an empty table stays empty.
    """
    if not key:
        raise ValueError("the pseudonyms need a key")
    rows = wrapped(df, _text=F.col(f"`{text}`"))
    found = rows.withColumn(
        "_found",
        F.when(text_of("_text").rlike(HINT), F.regexp_extract_all(F.col("_text"), F.lit(ANY), F.lit(0)))
        .otherwise(F.array().cast("array<string>")),
    )
    made = found.withColumn(
        "_made", F.when(F.size("_found") > 0, F.transform("_found", lambda v: pseudonym(v, key))).otherwise(F.col("_found"))
    )
    gaps = F.split(F.col("_text"), ANY, -1)
    joined = let(F.struct(gaps.alias("gaps"), F.col("_made").alias("made")), lambda x: _interleaved(x["gaps"], x["made"]))
    changed = F.size(F.filter(F.arrays_zip("_found", "_made"), lambda p: p["_found"] != p["_made"]))
    return made.select(
        "row",
        F.when(F.size("_found") > 0, joined).otherwise(F.col("_text")).alias("text"),
        F.size("_found").cast("long").alias("n_found"),
        changed.cast("long").alias("n_replaced"),
    )


def replaced(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` with its text column rewritten; columns as given."""
    done = pseudonymized(df, key, text)
    return done.select(*[
        F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns
    ])
