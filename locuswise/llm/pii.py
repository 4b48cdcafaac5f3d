"""Personal data: format-preserving pseudonyms by a keyed Feistel network, in DataFrame expressions only.

A value found in a text is checked (card and account checksums, octets, calendar dates, number plans), read as digits in
mixed radix, permuted by eight Feistel rounds keyed with SHA-512, and written back in its own format. The permutation depends
on the key, the kind and the format alone, so equal values keep equal pseudonyms across documents, and different values of a
kind never share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: calendar dates are permuted among the 250 * 292 days from 1900-01-01 on
EPOCH, DATE_RADICES = "1900-01-01", (250, 292)

# What a candidate looks like, by kind, in the order of trial. Validity is checked afterwards.
CANDIDATES = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "password": r"(?i:\bpassword|\bpasswd|\bpwd)\s?[=:]\s?[^\s\"',;]{6,64}",
    "token": r"(?i:\btoken|\bsecret|\bapi_?key)\s?[=:]\s?\"[A-Za-z0-9_+/=.-]{16,128}\"",
    "access_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "card": r"(?<![\d.-])(?:\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4} \d{6} \d{5}|\d{13,19})(?![\d-])",
}
#: characters of an account number, by country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: candidates of a text are put together in blocks of so many; no result depends on it
TOGETHER = 256
ANY = "|".join(f"(?:{p})" for p in CANDIDATES.values())


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def chars(s: Column) -> Column:
    """The characters of ``s``; none of an empty string."""
    return F.filter(F.split(s, ""), lambda c: c != "")


def _mixed_add(values: Column, radices: Column, stream: Column) -> Column:
    """Adds four hexadecimal digits of ``stream`` to each value, modulo its radix."""
    return F.transform(values, lambda v, j: F.pmod(v + F.conv(F.substring(stream, (j * 4) % 124 + 1, F.lit(4)), 16, 10).cast("int"), F.element_at(radices, j + 1)))


def feistel(values: Column, radices: Column, tag: Column, key: str) -> Column:
    """A permutation of ``values`` (each below its radix), keyed by ``key`` and ``tag``."""

    def run(v: Column, r: Column) -> Column:
        half = F.floor(F.size(v) / 2).cast("int")
        rest = F.size(v) - half
        left_r, right_r = F.slice(r, F.lit(1), half), F.slice(r, half + 1, rest)

        def stream(i: Column, other: Column) -> Column:
            return F.sha2(F.concat_ws("|", F.lit(key), tag, i.cast("string"), F.array_join(F.transform(other, lambda x: x.cast("string")), ",")), 512)

        def step(s: Column, i: Column) -> Column:
            left, right = s["l"], s["r"]
            return F.when(i % 2 == 1, F.struct(_mixed_add(left, left_r, stream(i, right)).alias("l"), right.alias("r"))).otherwise(
                F.struct(left.alias("l"), _mixed_add(right, right_r, stream(i, left)).alias("r"))
            )

        start = F.struct(F.slice(v, F.lit(1), half).alias("l"), F.slice(v, half + 1, rest).alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))

    return let(radices, lambda r: let(values, lambda v: run(v, r)))


def _base(c: Column) -> Column:
    """First code of the character's class; null for a character that stays."""
    return F.when(c.between("0", "9"), 48).when(c.between("A", "Z"), 65).when(c.between("a", "z"), 97)


def permute_text(s: Column, kind: str, key: str) -> Column:
    """Digits among digits, letters among letters of their case; all else stays."""
    letters = chars(s)
    values = F.transform(letters, lambda c: F.when(_base(c).isNull(), 0).otherwise(F.ascii(c) - _base(c)))
    radices = F.transform(letters, lambda c: F.when(_base(c).isNull(), 1).when(_base(c) == 48, 10).otherwise(26))
    mask = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9")
    out = feistel(values, radices, F.concat(F.lit(kind), mask), key)
    return let(letters, lambda old: F.array_join(F.zip_with(old, out, lambda c, v: F.when(_base(c).isNull(), c).otherwise(F.char(_base(c) + v))), ""))


def _refill(pattern: Column, digits: Column) -> Column:
    """``pattern`` with its digits replaced, in order, by the characters of ``digits``."""
    return F.aggregate(
        chars(pattern),
        F.struct(F.lit("").alias("s"), F.lit(1).alias("i")),
        lambda a, c: F.when(c.between("0", "9"), F.struct(F.concat(a["s"], F.substring(digits, a["i"], F.lit(1))).alias("s"), (a["i"] + 1).alias("i"))).otherwise(
            F.struct(F.concat(a["s"], c).alias("s"), a["i"].alias("i"))
        ),
        lambda a: a["s"],
    )


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one plain."""
    return F.aggregate(
        F.transform(F.reverse(chars(digits)), lambda c, j: F.when(j % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c >= "5", 9).otherwise(0))),
        F.lit(0), lambda a, x: a + x,
    )


def _card(m: Column, key: str) -> Column:
    """The first digit stays, the last is the new check digit."""
    d = F.regexp_replace(m, "[ -]", "")
    body = F.concat(F.substring(d, F.lit(1), F.lit(1)), permute_text(F.substring(d, F.lit(2), F.char_length(d) - 2), "card", key))
    full = let(body, lambda b: F.concat(b, F.pmod(F.lit(10) - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string")))
    return F.when((luhn_sum(d) % 10 == 0) & F.char_length(d).between(13, 19) & ~d.rlike("^0+$"), let(full, lambda x: _refill(m, x)))


def _mod97(s: Column) -> Column:
    """Remainder of an account number (letters count 10 to 35) whose first four characters are read last."""
    turned = F.concat(F.substring(s, F.lit(5), F.char_length(s)), F.substring(s, F.lit(1), F.lit(4)))
    return F.aggregate(chars(turned), F.lit(0), lambda a, c: F.when(c.between("0", "9"), (a * 10 + c.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _iban(m: Column, key: str) -> Column:
    """Country stays, check digits are made anew."""
    s = F.replace(m, F.lit(" "), F.lit(""))
    country = F.substring(s, 1, 2)
    body = permute_text(F.substring(s, F.lit(5), F.char_length(s)), "iban", key)
    new = let(body, lambda b: F.concat(country, F.lpad((98 - _mod97(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0"), b))
    spaced = let(new, lambda x: F.when(m.contains(" "), F.rtrim(F.regexp_replace(x, "(.{4})", "$1 "))).otherwise(x))
    return F.when(_mod97(s) == 1, spaced)


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.try_cast("int"))
    out = feistel(octets, F.array(*[F.lit(256)] * 4), F.lit("ip"), key)
    return F.when(F.forall(octets, lambda x: x <= 255), F.array_join(F.transform(out, lambda x: x.cast("string")), "."))


def _day(m: Column, form: str, key: str) -> Column:
    epoch, (a, b) = F.lit(EPOCH).cast("date"), DATE_RADICES
    day = F.datediff(F.try_to_date(m, form), epoch)
    new = feistel(F.array(F.floor(day / b).cast("int"), F.pmod(day, F.lit(b))), F.array(F.lit(a), F.lit(b)), F.lit("date"), key)
    return F.when(day.between(0, a * b - 1), let(new, lambda x: F.date_format(F.date_add(epoch, x[0] * b + x[1]), form)))


def _date(m: Column, key: str) -> Column:
    return F.when(m.contains("-"), _day(m, "yyyy-MM-dd", key)).when(m.contains("."), _day(m, "dd.MM.yyyy", key)).otherwise(_day(m, "MM/dd/yyyy", key))


def _ssn(m: Column, key: str) -> Column:
    """Area 001-899 but 666, group 01-99, serial 0001-9999."""
    area, group, serial = (F.substring(m, i, n).try_cast("int") for i, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    new = feistel(F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1), F.array(F.lit(898), F.lit(99), F.lit(9999)), F.lit("ssn"), key)
    text = let(new, lambda x: F.concat_ws("-", F.lpad((x[0] + F.when(x[0] >= 665, 2).otherwise(1)).cast("string"), 3, "0"), F.lpad((x[1] + 1).cast("string"), 2, "0"), F.lpad((x[2] + 1).cast("string"), 4, "0")))
    return F.when(valid, text)


def _phone(m: Column, key: str) -> Column:
    """Ten digits of the North American plan are permuted with area and exchange starting at 2-9; of other numbers the country digits stay."""
    d = F.regexp_replace(m, "[^0-9]", "")
    ten = F.substring(d, F.char_length(d) - 9, F.lit(10))
    plan = ten.rlike("^[2-9][0-9]{2}[2-9]") & (((F.char_length(d) == 11) & d.startswith("1")) | ((F.char_length(d) == 10) & ~m.startswith("+")))
    first = lambda j: (j == 0) | (j == 3)
    values = F.transform(chars(ten), lambda c, j: c.cast("int") - F.when(first(j), 2).otherwise(0))
    radices = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda j: F.when(first(j), 8).otherwise(10))
    new = let(feistel(values, radices, F.lit("phone"), key), lambda v: F.array_join(F.transform(v, lambda x, j: (x + F.when(first(j), 2).otherwise(0)).cast("string")), ""))
    inland = F.concat(F.substring(d, F.lit(1), F.char_length(d) - 10), new)
    abroad = F.concat(F.substring(d, 1, 2), permute_text(F.substring(d, F.lit(3), F.char_length(d)), "phone", key))
    return F.when(plan, let(inland, lambda x: _refill(m, x))).when(m.startswith("+") & F.char_length(d).between(8, 15), let(abroad, lambda x: _refill(m, x)))


def _email(m: Column, key: str) -> Column:
    """The domain stays."""
    return F.concat(permute_text(F.substring_index(m, "@", 1), "email", key), F.lit("@"), F.substring_index(m, "@", -1))


def _secret(m: Column, kind: str, key: str) -> Column:
    """What stands before the value, and its quotes, stay."""
    head = F.regexp_extract(m, r'^(?:[A-Za-z_]+\s?[=:]\s?"?|AKIA|ASIA)', 0)
    return F.concat(head, permute_text(F.substring(m, F.char_length(head) + 1, F.char_length(m)), kind, key))


def beginning(m: Column) -> Column:
    """The part of a candidate that is tried: an account number without the words behind it, by its country's length, and a phone number without
    the digits behind it (ten after +1, else at most 15 in all); the whole of any other."""
    ends = "(?![A-Z0-9])"
    own = F.regexp_extract(m, "|".join(f"^(?:{'|'.join(c.split())})(?: ?[A-Z0-9]){{{n - 2}}}{ends}" for n, c in IBAN_LENGTHS.items()), 0)
    account = let(own, lambda x: F.when((x != "") & (_mod97(F.replace(x, F.lit(" "), F.lit(""))) == 1), x).otherwise(m))
    one = F.regexp_extract(m, r"^\+1(?:[^0-9]*[0-9]){10}(?![0-9])", 0)
    most = F.regexp_extract(m, r"^\+(?:[^0-9]*[0-9]){8,15}(?![0-9])", 0)
    phone = let(F.coalesce(F.nullif(one, F.lit("")), F.nullif(most, F.lit("")), m), lambda x: F.when(x.rlike(f"^(?:{CANDIDATES['phone']})$"), x).otherwise(m))
    return F.when(m.rlike(f"^(?:{CANDIDATES['iban']})$"), account).when(m.rlike(f"^(?:{CANDIDATES['phone']})$") & m.startswith("+"), phone).otherwise(m)


def pseudonym(m: Column, key: str) -> Column:
    """Pseudonym of a candidate, by the first kind whose pattern it has; null if it isn't valid."""
    make = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}
    out = None
    for kind, pattern in CANDIDATES.items():
        new = make[kind](m, key) if kind in make else _secret(m, kind, key)
        fits = m.rlike(f"^(?:{pattern})$")
        out = F.when(fits, new) if out is None else out.when(fits, new)
    return out


def pseudonymised(docs: DataFrame, key: str, *, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with the values in ``text`` replaced; all other columns, whatever their names, stay.

    Each place where a value may begin is tried, from left to right, but for those inside a value that has been replaced: what
    fails its check stays, and a value inside or behind it is still found. No two kinds whose check can fail begin at one
    place. Null stays null, empty stays empty, an empty table too; texts are read whole; repeated rows are treated each. ``count`` names a column
    for the number of values replaced.
    """
    # the row in a struct: its columns may have any name
    docs_in_struct = docs.select(F.struct(*(F.col(f"`{x}`") for x in docs.columns)).alias("_all"))
    c = F.col(f"_all.`{text}`").cast("string")
    some = c.rlike("[0-9@=:]")
    step = docs_in_struct.withColumn("_found", F.when(some, F.regexp_extract_all(c, F.lit(f"(?=({ANY}))"), F.lit(1))))
    # the text cut before each candidate, so that part and candidate begin at one place
    step = step.withColumn("_parts", F.when(F.size("_found") > 0, F.split(c, f"(?={ANY})", -1)))
    resolved = F.transform("_found", lambda m: let(beginning(m), lambda used: F.struct(F.char_length(used).alias("used"), pseudonym(used, key).alias("new"))))
    step = step.withColumn("_new", F.when(F.size("_found") > 0, resolved))
    head = F.size("_parts") - F.size("_found")  # 1 if a part stands before the first candidate
    items = F.zip_with(F.slice("_parts", head + 1, F.size("_found")), "_new", lambda part, v: F.struct(part.alias("part"), v["used"].alias("used"), v["new"].alias("new")))

    def put(a: Column, x: Column) -> Column:
        """One more part; ``skip`` characters of the value before reach into it."""
        hit = (a["skip"] == 0) & x["new"].isNotNull()
        gone = F.when(hit, x["used"]).otherwise(a["skip"])
        return F.struct(
            F.concat(a["s"], F.when(hit, x["new"]).otherwise(""), F.substring(x["part"], gone + 1, F.char_length(x["part"]))).alias("s"),
            F.greatest(gone - F.char_length(x["part"]), F.lit(0)).alias("skip"),
            (a["n"] + F.when(hit, 1).otherwise(0)).alias("n"),
        )

    def block(a: Column, some_items: Column) -> Column:
        inner = F.aggregate(some_items, F.struct(F.lit("").alias("s"), a["skip"].alias("skip"), a["n"].alias("n")), put)
        return let(inner, lambda b: F.struct(F.concat(a["s"], F.array(b["s"])).alias("s"), b["skip"].alias("skip"), b["n"].alias("n")))

    begin = F.struct(F.when(head > 0, F.slice("_parts", 1, 1)).otherwise(F.array(F.lit(""))).alias("s"), F.lit(0).alias("skip"), F.lit(0).alias("n"))
    joined = let(items, lambda all_: F.aggregate(F.transform(F.sequence(F.lit(1), F.size(all_), F.lit(TOGETHER)), lambda i: F.slice(all_, i, F.lit(TOGETHER))), begin, block))
    step = step.withColumn("_made", F.when(F.size("_found") > 0, joined))
    made = F.when(F.col("_made").isNotNull(), F.array_join("_made.s", "")).otherwise(c)
    out = [made.alias(x) if x == text else F.col(f"_all.`{x}`").alias(x) for x in docs.columns]
    return step.select(*out, *([F.coalesce(F.col("_made.n"), F.lit(0)).cast("long").alias(count)] if count else []))
