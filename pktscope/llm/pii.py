"""Format-preserving pseudonyms for personal numbers, dates and secrets
(native column expressions only).

A match is replaced by a keyed permutation of itself within its own format:
a Feistel network (8 rounds, HMAC-like SHA-256 round function) over the digits
or letters that carry the identity.  A permutation maps equal values to equal
pseudonyms and different values to different ones, so documents stay linked.

Only valid values are taken:
* card: 13-19 digits (plain or grouped) that pass the Luhn check; the new
  number passes it too
* iban: passes mod 97; account part permuted, check digits made anew
* ssn: 123-45-6789 with a possible area, group and serial; permuted among the
  possible ones
* phone: NANP-like numbers with separators; the last seven digits permuted
* ip: four octets of 0-255; permuted as octets
* date: yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy that exist, 1900-01-01 to
  2101-01-27; permuted as the day's number.  dd/mm/yyyy is taken where it can not
  be mm/dd/yyyy, and walks on through the permutation until the new day can not
  either
* email: the local part's letters and digits permuted within their classes,
  the domain stays
* secret: values behind password/token/secret/key and = or :, access keys
  (AKIA...) and long hexadecimal strings, permuted within their classes; of any
  length

Text between matches is kept byte for byte.  Null text stays null; empty text
stays empty; very long texts are handled whole; repeated rows alike; other
columns pass through.  Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, fresh, let

ROUNDS = 8
DEFAULT_KEY = "change-this-key"
_LEFT, _RIGHT = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"

#: Kinds in the order they are tried at a position.
FORMATS: list[tuple[str, str]] = [
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"),
    ("named", r"(?i:password|passwd|pwd|token|secret|api_?key)[ ]{0,2}[=:][ ]{0,2}[\"']?[A-Za-z0-9_+/-]{8,}+"),
    ("access", r"AKIA[A-Z0-9]{16}"),
    ("hex", r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)"),
    ("iban", r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?"),
    ("date", r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})"),
    ("ip", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    ("phone", r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"),
    ("card", r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"),
]
PATTERN = "|".join(f"(?:{_LEFT}{'(?<![+])' * (k == 'phone')}{p}{_RIGHT})" for k, p in FORMATS)
#: A text without one of these has no match.
MAY_HAVE = r"[0-9@=:]|AKIA|[a-f]{32}|[A-F]{32}"
DIGITS, UPPER, LOWER, HEX = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
#: Dates are permuted as 271 x 271 day numbers from 1900-01-01 on.
_SIDE, _FIRST_DAY = 271, "1900-01-01"
#: Steps of a walk; two days in five end it, so 1 in 10^25 does not end.
WALK = 64
#: Possible areas (001-899 without 666), and groups times serials.
_AREAS, _SERIALS = 898, 99 * 9999


def _digest(key: str, tag: str, turn: Column, other: Column) -> Column:
    """128 hexadecimal digits that depend on the key, kind, round and half."""
    inner = F.sha2(F.concat(F.lit(f"{key}|{tag}|"), turn.cast("string"), F.lit("|"), other), 512)
    return F.sha2(F.concat(F.lit(f"{key}|"), inner), 512)


def _amount(digest: Column, at: Column | int) -> Column:
    """The digest's number at a position, 0-65535; positions wrap."""
    at = at if isinstance(at, Column) else F.lit(at)
    return F.conv(F.substr(digest, (at % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _shift(half: Column, digest: Column, sign_alphabets: list[str]) -> Column:
    """Every character of ``half`` moved on within its own alphabet."""
    def moved(c: Column, i: Column) -> Column:
        out = c
        for alphabet in reversed(sign_alphabets):
            at = F.instr(F.lit(alphabet), c) - 1
            out = F.when(F.lit(alphabet).contains(c), F.substr(
                F.lit(alphabet), (at + _amount(digest, i)) % len(alphabet) + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(half, ""), moved), "")


def _turns() -> Column:
    return F.sequence(F.lit(0), F.lit(ROUNDS - 1))


def permute(value: Column, key: str, tag: str, alphabets: list[str]) -> Column:
    """Feistel permutation of a string; each character keeps its alphabet,
    characters of none stay.  Strings of one character are shifted alone.  A
    round shifts the first half by a digest of the other and swaps the two."""
    cut = F.floor(F.length(value) / 2).cast("int")
    halves = F.struct(F.substr(value, F.lit(1), cut).alias("x"),
                      F.substr(value, cut + 1, F.length(value)).alias("y"))

    def turned(p: Column, turn: Column) -> Column:
        moved = let(_digest(key, tag, turn, p["y"]), lambda d: _shift(p["x"], d, alphabets))
        return F.struct(p["y"].alias("x"), F.when(p["x"] == "", "").otherwise(moved).alias("y"))

    return F.aggregate(_turns(), halves, turned, lambda p: F.concat(p["x"], p["y"]))


def _pair_permute(a: Column, b: Column, key: str, tag: str, size_a: int, size_b: int) -> Column:
    """Feistel permutation of two numbers below ``size_a`` and ``size_b``, which
    in turn are moved on by a digest of the other; struct(a, b)."""
    wide = max(size_a, size_b) > 65536

    def turned(p: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        other = F.when(even, p["b"]).otherwise(p["a"]).cast("string")

        def moved(d: Column) -> Column:
            rise = _amount(d, 0).cast("long") * 65536 + _amount(d, 1) if wide else _amount(d, 0).cast("long")
            return F.struct(F.when(even, (p["a"] + rise) % size_a).otherwise(p["a"]).alias("a"),
                            F.when(even, p["b"]).otherwise((p["b"] + rise) % size_b).alias("b"))

        return let(_digest(key, tag, turn, other), moved)

    return F.aggregate(_turns(), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), turned)


def _into(shape: Column, chars: Column, slots: str) -> Column:
    """``chars`` put one by one into the places of ``shape`` that match the
    regular expression ``slots``; other characters stay."""
    parts = F.split(shape, "")
    at = F.transform(parts, lambda c: F.when(c.rlike(slots), 1).otherwise(0))
    place = let(at, lambda a: F.transform(a, lambda x, i: F.when(x == 1, F.aggregate(
        F.slice(a, 1, i + 1), F.lit(0), lambda s, y: s + y))))
    return F.array_join(F.zip_with(parts, place, lambda c, k: F.when(
        k.isNotNull(), F.substr(chars, k, F.lit(1))).otherwise(c)), "")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of all digits, the last being the check digit."""
    def worth(c: Column, i: Column) -> Column:
        d, twice = c.cast("int"), (F.length(digits) - i) % 2 == 0
        return F.when(twice & (d > 4), 2 * d - 9).when(twice, 2 * d).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), worth), F.lit(0), lambda s, x: s + x)


def _mod97(value: Column) -> Column:
    """Remainder of a string of digits and capitals (A = 10 ... Z = 35)."""
    def step(r: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + letter) % 97)

    return F.aggregate(F.split(value, ""), F.lit(0), step)


def _card(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        body = permute(F.substr(d, F.lit(1), F.length(d) - 1), key, "card", [DIGITS])
        whole = let(body, lambda b: F.concat(b, ((10 - _luhn(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(_luhn(d) % 10 == 0, _into(m, whole, "[0-9]")).otherwise(m)

    return let(_digits(m), new)


def _iban(m: Column, key: str) -> Column:
    def new(s: Column) -> Column:
        land, body = F.substr(s, F.lit(1), F.lit(2)), F.substr(s, F.lit(5), F.length(s))
        fits = F.length(s).between(15, 34) & (_mod97(F.concat(body, F.substr(s, F.lit(1), F.lit(4)))) == 1)
        made = let(permute(body, key, "iban", [DIGITS, UPPER]), lambda b: F.concat(
            land, F.lpad((98 - _mod97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0"), b))
        return F.when(fits, _into(m, made, "[A-Z0-9]")).otherwise(m)

    return let(F.replace(m, F.lit(" "), F.lit("")), new)


def _date(m: Column, key: str) -> Column:
    first = F.to_date(F.lit(_FIRST_DAY))

    def moved(n: Column, tag: str) -> Column:
        return let(_pair_permute(F.floor(n / _SIDE), n % _SIDE, key, tag, _SIDE, _SIDE),
                   lambda p: (p["a"] * _SIDE + p["b"]).cast("int"))

    def walked(n: Column) -> Column:
        far = lambda d: F.dayofmonth(F.date_add(first, d)) > 12
        return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.struct(n.alias("n"), F.lit(False).alias("done")),
                           lambda p, _: F.when(p["done"], p).otherwise(let(moved(p["n"], "day first"), lambda d: F.struct(
                               d.alias("n"), far(d).alias("done")))), lambda p: F.when(p["done"], p["n"]).otherwise(n))

    def in_form(form: str, new) -> Column:
        day = F.to_date(F.try_to_timestamp(m, F.lit(form)))
        return let(F.datediff(day, first), lambda n: F.when(
            n.between(0, _SIDE * _SIDE - 1), F.date_format(F.date_add(first, new(n)), form)))

    plain = lambda n: moved(n, "date")
    return F.coalesce(
        F.when(m.contains("-"), in_form("yyyy-MM-dd", plain)).when(m.contains("."), in_form("dd.MM.yyyy", plain))
        .when(F.substr(m, F.lit(1), F.lit(2)) <= "12", in_form("MM/dd/yyyy", plain)).otherwise(in_form("dd/MM/yyyy", walked)), m)


def _ip(m: Column, key: str) -> Column:
    def new(o: Column) -> Column:
        fits = F.forall(o, lambda x: x <= 255)
        part = _pair_permute(o[0] * 256 + o[1], o[2] * 256 + o[3], key, "ip", 65536, 65536)
        text = let(part, lambda p: F.concat_ws(".", F.floor(p["a"] / 256), p["a"] % 256,
                                               F.floor(p["b"] / 256), p["b"] % 256))
        return F.when(fits, text).otherwise(m)

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("int")), new)


def _ssn(m: Column, key: str) -> Column:
    number = lambda at, n: F.substr(m, F.lit(at), F.lit(n)).cast("int")
    area, group, serial = number(1, 3), number(5, 2), number(8, 4)
    fits = ~m.rlike("^(?:000|666|9..)-|-00-|-0000$")

    def written(p: Column) -> Column:
        place = p["a"] + F.when(p["a"] < 665, 1).otherwise(2)  # 666 is left out
        return F.concat(F.lpad(place.cast("string"), 3, "0"), F.lit("-"),
                        F.lpad((F.floor(p["b"] / 9999) + 1).cast("string"), 2, "0"), F.lit("-"),
                        F.lpad((p["b"] % 9999 + 1).cast("string"), 4, "0"))

    moved = _pair_permute(area - F.when(area < 666, 1).otherwise(2), (group - 1) * 9999 + serial - 1,
                          key, "ssn", _AREAS, _SERIALS)
    return F.when(fits, let(moved, written)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    head = F.substr(m, F.lit(1), F.length(m) - 8)
    tail = F.substr(m, F.length(m) - 7, F.lit(8))
    return F.concat(head, _into(tail, permute(_digits(tail), key, "phone", [DIGITS]), "[0-9]"))


def _email(m: Column, key: str) -> Column:
    return F.concat(permute(F.substring_index(m, "@", 1), key, "email", [DIGITS, LOWER, UPPER]),
                    F.lit("@"), F.substring_index(m, "@", -1))


def _secret(m: Column, key: str, head: str) -> Column:
    """The value behind the match of ``head``: hexadecimal strings stay so."""
    start = F.regexp_extract(m, head, 0)
    value = F.substr(m, F.length(start) + 1, F.length(m))
    return F.concat(start, F.when(value.rlike("^[0-9a-f]+$"), permute(value, key, "hex", [HEX])).otherwise(
        permute(value, key, "secret", [DIGITS, LOWER, UPPER])))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match of ``PATTERN`` (itself if not valid)."""
    new = {"email": _email(m, key), "iban": _iban(m, key), "date": _date(m, key), "ip": _ip(m, key),
           "ssn": _ssn(m, key), "phone": _phone(m, key), "card": _card(m, key),
           "named": _secret(m, key, r"^(?i:password|passwd|pwd|token|secret|api_?key)[ ]{0,2}[=:][ ]{0,2}[\"']?"),
           "access": _secret(m, key, "^AKIA"), "hex": _secret(m, key, "^")}
    out = F.when(F.lit(False), m)
    for kind, form in FORMATS:
        out = out.when(m.rlike(f"^{form}$"), new[kind])
    return out.otherwise(m)


def replaced(text: Column, key: str = DEFAULT_KEY) -> Column:
    """struct(text with pseudonyms, number of values replaced)."""
    def join(x: Column) -> Column:
        new = F.concat(x["new"], F.array(F.lit("")))
        whole = F.array_join(F.zip_with(x["between"], new, lambda p, m: F.concat(p, m)), "")
        changed = F.aggregate(F.zip_with(x["old"], x["new"], lambda a, b: (a != b).cast("int")),
                              F.lit(0), lambda s, y: s + y)
        return F.struct(whole.alias("text"), changed.cast("long").alias("n_replaced"))

    def work(old: Column) -> Column:
        found = F.struct(F.split(text, PATTERN).alias("between"), old.alias("old"),
                         F.transform(old, lambda m: pseudonym(m, key)).alias("new"))
        return F.when(F.size(old) == 0, F.struct(text.alias("text"), F.lit(0).cast("long").alias("n_replaced"))
                      ).otherwise(let(found, join))

    same = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n_replaced"))
    return F.when(text.rlike(MAY_HAVE), let(F.regexp_extract_all(text, F.lit(PATTERN), 0), work)).otherwise(same)


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY,
                 count_col: str | None = None, length_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``; ``count_col`` (if given) gets
    the number of values replaced, ``length_col`` (if there) the new length."""
    tmp = fresh(docs.columns, "__new")
    found = docs.withColumn(tmp, replaced(col(text_col).cast("string"), key))
    new = col(tmp)
    columns = [new["text"].alias(c) if c == text_col else
               F.length(new["text"]).cast(docs.schema[c].dataType).alias(c) if c == length_col else
               col(c) for c in docs.columns]
    if count_col:
        columns.append(new["n_replaced"].alias(count_col))
    return found.select(*columns)
