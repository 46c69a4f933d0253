"""Format-preserving Feistel pseudonyms for personal numbers, dates and mail names.

The text is cut where a candidate may start. From each such place every kind and every end is tried until
one is valid (Luhn, mod 97, calendar, octets, numbering plan); after a valid one the search goes on behind
it, otherwise at the next place. A valid candidate is turned into a vector of small numbers with a radix
each: digits, letters, octets, a day's place in its century.
A keyed Feistel network permutes the vectors of one kind and shape: the halves take turns in being added,
modulo their radices, to a hash of the other half. So the result is a valid value of the same format,
different values stay different, and equal values, in whatever punctuation, stay linked across
documents. Check digits are computed anew. Only DataFrame functions are used.

An IBAN has its country's length, and any length only if its country is unknown or nothing follows it. A
card next to other numbers is looked for in groups of four or more digits, the last of any length, with one
kind of separator; other groupings are tried once for a stretch of numbers, at its longest, and only if no
other value starts inside. Of several valid ends the longest is taken.

Defined results: null text stays null; candidates that fail their check stay as they are; repeated rows
are treated each on their own and alike; an empty table gives no rows; the caller's columns travel in one
struct, so no name of theirs can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.common import read

KEY = "change-me"  # a deployment passes its own
ROUNDS = 8
KINDS = ("email", "iban", "date", "ip", "ssn", "phone", "card")

EMAIL = r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IBAN = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"
DATE = r"[12][0-9]{3}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[12][0-9]{3}"
IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
NATIONAL = r"(?:\+?1[\x20.-]?)?(?:\([2-9][0-9]{2}\)[\x20.-]?|[2-9][0-9]{2}[\x20.-])[2-9][0-9]{2}[\x20.-]?[0-9]{4}"
ABROAD = r"\+[1-9](?:[\x20.-]?\(?[0-9]\)?){7,14}"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,18}"
GROUPED = r"[0-9]{4,}(?:([\x20-])(?:[0-9]{4,}\1)*[0-9]+)?"
END = "(?![A-Za-z0-9])"
MAIL = rf"(?<![A-Za-z0-9._%+-]){EMAIL}"
START = rf"(?<![A-Za-z0-9._%+-])(?={EMAIL})|(?<![A-Za-z0-9.])(?=(?:{IBAN}|{DATE}|{IP}|{SSN}|{CARD}|{NATIONAL}|{ABROAD}){END})"
REACH = 80  # no candidate but a mail address is as long; pieces between starts have two characters, but for one at a +
IBAN_LENGTHS = {
    k[:2]: int(k[2:])
    for k in """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29
    ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32
    LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22
    RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30""".split()
}


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed, and planned, once."""
    return F.transform(F.array(value), body)[0]


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _numbers(s: Column) -> Column:
    return F.transform(_chars(s), lambda c: F.ascii(c) - 48)


def _const(n: Column, value: int) -> Column:
    return F.array_repeat(F.lit(value), n)


def permuted(vector: Column, radix: Column, kind: str, key: str) -> Column:
    """The keyed permutation of ``vector``; component i is below ``radix[i]``. Up to 64 components."""
    half = F.greatest(F.floor(F.size(vector) / 2), F.lit(1)).cast("int")

    def parts(a: Column) -> tuple[Column, Column]:
        return F.slice(a, F.lit(1), half), F.slice(a, half + 1, F.greatest(F.size(a) - half, F.lit(0)))

    a, b = parts(vector)
    ra, rb = parts(radix)
    start = F.struct(a.alias("a"), b.alias("b"), ra.alias("ra"), rb.alias("rb"))

    def moved(mine: Column, radices: Column, other: Column, r: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), F.array_join(other.cast("array<string>"), ",")), 512)
        return F.transform(
            mine,
            lambda x, i: ((x + F.conv(F.substring(digest, 4 * i + 1, F.lit(4)), 16, 10).cast("int")) % F.get(radices, i)).cast("int"),
        )

    def step(s: Column, r: Column) -> Column:
        left = r % 2 == 0
        return F.struct(
            F.when(left, moved(s["a"], s["ra"], s["b"], r)).otherwise(s["a"]).alias("a"),
            F.when(left, s["b"]).otherwise(moved(s["b"], s["rb"], s["a"], r)).alias("b"),
            s["ra"].alias("ra"),
            s["rb"].alias("rb"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _into(form: Column, fill: Column, keep: Column) -> Column:
    """``form`` with its alphanumeric characters, after the first ``keep``, replaced one by one from ``fill``."""
    start = F.struct(F.lit(0).alias("i"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, c: Column) -> Column:
        takes = c.rlike("[A-Za-z0-9]")
        new = F.when(takes & (s["i"] >= keep), F.get(fill, s["i"] - keep)).otherwise(c)
        return F.struct((s["i"] + takes.cast("int")).alias("i"), F.array_append(s["out"], new).alias("out"))

    return F.aggregate(_chars(form), start, step, lambda s: F.array_join(s["out"], ""))


def _strings(numbers: Column) -> Column:
    return F.transform(numbers, lambda x: x.cast("string"))


def _luhn(numbers: Column, doubled: int) -> Column:
    """Luhn sum, where every second number is doubled, from the last (``doubled`` 1) or the one before it."""
    n = F.size(numbers)
    weighed = F.transform(numbers, lambda x, i: F.when((n - i) % 2 == doubled, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x))
    return F.aggregate(weighed, F.lit(0), lambda s, x: s + x)


def _digits(m: Column) -> Column:
    return _numbers(F.regexp_replace(m, "[^0-9]", ""))


def card(m: Column, key: str) -> Column:
    """The first digit is never zero; the last is the check digit."""

    def made(numbers: Column) -> Column:
        body = F.transform(F.slice(numbers, F.lit(1), F.size(numbers) - 1), lambda x, i: F.when(i == 0, x - 1).otherwise(x))
        radix = F.transform(F.array_repeat(F.lit(10), F.size(numbers) - 1), lambda x, i: F.when(i == 0, 9).otherwise(x))
        out = F.transform(permuted(body, radix, "card", key), lambda x, i: F.when(i == 0, x + 1).otherwise(x))
        checked = _let(out, lambda b: F.array_append(_strings(b), ((10 - _luhn(b, 1) % 10) % 10).cast("string")))
        return F.when((_luhn(numbers, 0) % 10 == 0) & (F.get(numbers, F.lit(0)) > 0), _into(m, checked, F.lit(0)))

    return _let(_digits(m), made)


def phone_at_home(m: Column, key: str) -> Column:
    """Ten digits; area and exchange start with 2 to 9. What stands before them stays."""

    def made(numbers: Column) -> Column:
        low = F.array(*[F.lit(2 if i in (0, 3) else 0) for i in range(10)])
        radix = F.array(*[F.lit(8 if i in (0, 3) else 10) for i in range(10)])
        keep = F.size(numbers) - 10
        body = F.zip_with(F.slice(numbers, keep + 1, F.lit(10)), low, lambda x, y: x - y)
        out = F.zip_with(permuted(body, radix, "phone", key), low, lambda x, y: (x + y).cast("string"))
        return _into(m, out, keep)

    return _let(_digits(m), made)


def phone_abroad(m: Column, key: str) -> Column:
    """All digits but the first two (one, where it is a 1)."""

    def made(numbers: Column) -> Column:
        keep = F.when(F.get(numbers, F.lit(0)) == 1, 1).otherwise(2)
        body = F.slice(numbers, keep + 1, F.size(numbers) - keep)
        return _into(m, _strings(permuted(body, _const(F.size(numbers) - keep, 10), "abroad", key)), keep)

    return _let(_digits(m), made)


def ip(m: Column, key: str) -> Column:
    def made(octets: Column) -> Column:
        out = F.array_join(_strings(permuted(octets, _const(F.lit(4), 256), "ip", key)), ".")
        return F.when(F.forall(octets, lambda o: o < 256), out)

    return _let(F.transform(F.split(m, r"\."), lambda o: o.cast("int")), made)


def ssn(m: Column, key: str) -> Column:
    def made(p: Column) -> Column:
        area, group, serial = p[0], p[1], p[2]
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        vector = F.array(area - 1 - (area > 666).cast("int"), group - 1, serial - 1)
        radix = F.array(F.lit(898), F.lit(99), F.lit(9999))

        def written(x: Column) -> Column:
            return F.format_string("%03d-%02d-%04d", x[0] + 1 + (x[0] >= 665).cast("int"), x[1] + 1, x[2] + 1)

        return F.when(valid, _let(permuted(vector, radix, "ssn", key), written))

    return _let(F.transform(F.split(m, "-"), lambda x: x.cast("int")), made)


def date(m: Column, key: str) -> Column:
    """A day within the hundred years from a year 50 on, written as the day was.

    Of 1/2/2024 the first number is the month, unless it can only be the day; of 1.2.2024 it is the day.
    """

    def placed(p: Column) -> Column:
        first = F.length(p[0]) == 4
        day_first = ~first & (p[1].cast("int") <= 12) & ((p[0].cast("int") > 12) | ~m.contains("/"))
        year = F.when(first, p[0]).otherwise(p[2]).cast("int")
        day = F.when(first, p[2]).when(day_first, p[0]).otherwise(p[1]).cast("int")
        month = F.when(first | day_first, p[1]).otherwise(p[0]).cast("int")
        return F.struct(p.alias("p"), first.alias("first"), day_first.alias("day_first"), year.alias("y"), month.alias("m"), day.alias("d"))

    def day_of(q: Column) -> Column:
        when = F.to_date(F.try_to_timestamp(F.format_string("%04d-%02d-%02d", q["y"], q["m"], q["d"]), F.lit("yyyy-MM-dd")))
        zero = (F.floor((q["y"] + 50) / 100) * 100 - 50).cast("int")
        return F.struct(
            q.alias("q"), when.alias("when"), F.make_date(zero, F.lit(1), F.lit(1)).alias("zero"), F.make_date(zero + 100, F.lit(1), F.lit(1)).alias("end")
        )

    def moved(z: Column) -> Column:
        long = F.datediff(z["end"], z["zero"]) == 36525
        low = F.when(long, 75).otherwise(92)  # 36525 = 75 * 487, 36524 = 92 * 397
        high = F.when(long, 487).otherwise(397)
        at = F.datediff(z["when"], z["zero"])
        vector = F.array(F.floor(at / high).cast("int"), at % high)
        out = _let(permuted(vector, F.array(low, high), "date", key), lambda x: F.date_add(z["zero"], x[0] * high + x[1]))
        return F.when(z["when"].isNotNull(), _let(out, lambda d: written(z["q"], d)))

    def written(q: Column, d: Column) -> Column:
        def like(k: int, value: Column) -> Column:
            text = value.cast("string")
            return F.when(F.length(q["p"][k]) == 2, F.lpad(text, 2, "0")).otherwise(text)

        y, month, day = F.year(d).cast("string"), F.month(d), F.dayofmonth(d)
        parts = (
            F.when(q["first"], F.array(y, like(1, month), like(2, day)))
            .when(q["day_first"], F.array(like(0, day), like(1, month), y))
            .otherwise(F.array(like(0, month), like(1, day), y))
        )
        return F.array_join(parts, "|")

    def dated(p: Column) -> Column:
        return _let(_let(placed(p), day_of), moved)

    return F.replace(_let(F.split(m, "[-/.]"), dated), F.lit("|"), F.regexp_extract(m, "[-/.]", 0))


def _mod97(s: Column) -> Column:
    def step(r: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (r * 10 + code - 48) % 97).otherwise((r * 100 + code - 55) % 97)

    return F.aggregate(_chars(s), F.lit(0), step)


def _letters_and_digits(s: Column, key: str, kind: str) -> Column:
    """Digits among digits, small letters among small ones, capitals among capitals; the rest stays."""

    def base(c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65).otherwise(F.ascii(c))

    def size(c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1)

    chars = _chars(s)
    made = permuted(F.transform(chars, lambda c: F.ascii(c) - base(c)), F.transform(chars, size), kind, key)
    return F.zip_with(chars, made, lambda c, x: F.char(base(c) + x))


def iban(m: Column, key: str) -> Column:
    """Country and format stay; check digits are computed anew."""

    def made(plain: Column) -> Column:
        country, body = F.substring(plain, 1, 2), F.substring(plain, 5, 30)

        def checked(b: Column) -> Column:
            check = 98 - _mod97(F.concat(F.array_join(b, ""), country, F.lit("00")))
            return F.concat(_chars(F.lpad(check.cast("string"), 2, "0")), b)

        new = _into(m, _let(_letters_and_digits(body, key, "iban"), checked), F.lit(2))
        return F.when(_mod97(F.concat(body, F.substring(plain, 1, 4))) == 1, new)

    return _let(F.regexp_replace(m, " ", ""), made)


def email(m: Column, key: str) -> Column:
    """The mailbox name; its domain stays."""
    name = F.substring_index(m, "@", 1)
    return F.concat(F.array_join(_letters_and_digits(name, key, "email"), ""), F.substr(m, F.length(name) + 1))


def pseudonym(m: Column, key: str) -> Column:
    """struct(kind, value): the pseudonym of a candidate, null where it is not valid."""

    def whole(p: str) -> Column:
        return m.rlike(f"^(?:{p})$")

    def of(kind: str, value: Column) -> Column:
        return F.struct(F.when(value.isNotNull(), kind).alias("kind"), value.alias("value"))

    return (
        F.when(m.contains("@"), of("email", email(m, key)))
        .when(whole("[A-Z].*"), of("iban", iban(m, key)))
        .when(whole(DATE), of("date", date(m, key)))
        .when(whole(IP), of("ip", ip(m, key)))
        .when(whole(SSN), of("ssn", ssn(m, key)))
        .when(whole(NATIONAL), of("phone", phone_at_home(m, key)))
        .when(whole(ABROAD), of("phone", phone_abroad(m, key)))
        .otherwise(of("card", card(m, key)))
    )


def _ends(m: Column, separator: str) -> Column:
    """``m``, then what is left of it when its groups are taken off one by one from the end."""
    return _let(
        F.split(m, f"(?={separator})", -1),
        lambda g: F.transform(F.sequence(F.size(g), F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(g, F.lit(1), i), "")),
    )


def _ibans(m: Column) -> Column:
    lengths = F.str_to_map(F.lit(",".join(f"{k}:{n}" for k, n in IBAN_LENGTHS.items())))

    def admitted(length: Column) -> Column:
        def size(x: Column) -> Column:
            return F.length(F.replace(x, F.lit(" "), F.lit("")))

        fits = F.filter(_ends(m, r"\x20"), lambda x: F.when(length.isNull(), size(x) >= 15).otherwise(size(x) == length))
        return F.when(length.isNull(), fits).otherwise(F.concat(fits, F.array(m)))

    return F.when(m != "", _let(F.try_element_at(lengths, F.substring(m, 1, 2)).cast("int"), admitted)).otherwise(F.array().cast("array<string>"))


def _cards(m: Column) -> Column:
    return F.filter(_ends(m, r"[\x20-]"), lambda x: x.rlike(f"^{GROUPED}$") & (F.length(F.regexp_replace(x, "[^0-9]", "")) >= 13))


def _values(text: Column, key: str) -> Column:
    """The valid candidates at the start of ``text``, the first to be preferred: struct(m, any, kind, value).

    ``any`` marks a card in any grouping; that one is there whether it is valid or not.
    """

    def first(p: str) -> Column:
        return F.regexp_extract(text, f"^(?:{p}){END}", 0)

    def listed(card_: Column) -> Column:
        strict = F.concat(
            _let(first(IBAN), _ibans), F.array(*[first(p) for p in (DATE, IP, SSN, NATIONAL)]), _cards(card_), F.array(first(ABROAD))
        )
        marked = F.transform(strict, lambda m: F.struct(m.alias("m"), F.lit(False).alias("any")))
        return F.filter(F.array_append(marked, F.struct(card_.alias("m"), F.lit(True).alias("any"))), lambda c: c["m"] != "")

    def valued(c: Column) -> Column:
        return _let(pseudonym(c["m"], key), lambda v: F.struct(c["m"].alias("m"), c["any"].alias("any"), v["kind"].alias("kind"), v["value"].alias("value")))

    return F.filter(F.transform(_let(first(CARD), listed), valued), lambda c: c["any"] | c["value"].isNotNull())


def _tried(pieces: Column, key: str) -> Column:
    """Of each piece struct(p, hit, loose): itself, its preferred value and the card of any grouping at its start."""
    heads = F.transform(pieces, lambda p: F.left(p, F.lit(REACH)))

    def values(h: Column) -> Column:
        return F.transform(h, lambda _, i: _values(F.left(F.array_join(F.slice(h, i + 1, F.lit(REACH // 2 + 1)), ""), F.lit(REACH)), key))

    return F.zip_with(
        pieces,
        _let(heads, values),
        lambda p, v: F.struct(
            p.alias("p"), F.get(F.filter(v, lambda c: ~c["any"]), F.lit(0)).alias("hit"), F.get(F.filter(v, lambda c: c["any"]), F.lit(0)).alias("loose")
        ),
    )


def _alone(tried: Column) -> Column:
    """``tried`` with ``alone``: no other value starts inside the card of any grouping."""

    def inside(c: Column, i: Column) -> Column:
        start = F.struct(F.length(c["p"]).alias("at"), F.lit(False).alias("met"))
        return F.aggregate(
            F.slice(tried, i + 2, F.lit(REACH // 4)),
            start,
            lambda s, x: F.struct(
                (s["at"] + F.length(x["p"])).alias("at"), (s["met"] | ((s["at"] < F.length(c["loose"]["m"])) & x["hit"].isNotNull())).alias("met")
            ),
            lambda s: s["met"],
        )

    return F.transform(
        tried,
        lambda c, i: F.struct(
            *[c[k].alias(k) for k in ("p", "hit", "loose")], F.when(c["loose"]["value"].isNotNull(), ~inside(c, i)).otherwise(False).alias("alone")
        ),
    )


def _mails(mails: Column, gaps: Column, key: str) -> Column:
    """struct(at, m, kind, value) of each mail address."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,m:string,kind:string,value:string>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        at = s["at"] + F.length(x["gap"])
        mail = F.struct(at.alias("at"), x["m"].alias("m"), F.lit("email").alias("kind"), email(x["m"], key).alias("value"))
        return F.struct((at + F.length(x["m"])).alias("at"), F.array_append(s["out"], mail).alias("out"))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(mails)), mails, lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
    return F.aggregate(pairs, start, step, lambda s: s["out"])


def _woven(tried: Column, mails: Column) -> Column:
    """struct(out, kinds): the new pieces and the kinds of the replaced values, taken from left to right."""
    none = F.array().cast("array<string>")
    start = F.struct(*[F.lit(0).alias(k) for k in ("at", "until", "loose", "mail")], none.alias("out"), none.alias("kinds"))

    def step(s: Column, c: Column) -> Column:
        free = s["at"] >= s["until"]
        mail = F.get(mails, s["mail"])
        is_mail = F.coalesce(mail["at"] == s["at"], F.lit(False))
        tries = free & (s["at"] >= s["loose"]) & c["loose"].isNotNull()

        def pick(x: Column) -> Column:
            return F.struct(x["m"].alias("m"), x["kind"].alias("kind"), x["value"].alias("value"))

        def after(v: Column) -> Column:
            taken = v["value"].isNotNull()
            until = F.when(taken, s["at"] + F.length(v["m"])).otherwise(s["until"])
            rest = F.substr(c["p"], F.greatest(until - s["at"], F.lit(0)) + 1)
            return F.struct(
                (s["at"] + F.length(c["p"])).alias("at"),
                until.alias("until"),
                F.when(tries & ~taken, s["at"] + F.length(c["loose"]["m"])).otherwise(s["loose"]).alias("loose"),
                (s["mail"] + is_mail.cast("int")).alias("mail"),
                F.array_append(s["out"], F.concat(F.coalesce(v["value"], F.lit("")), rest)).alias("out"),
                F.when(taken, F.array_append(s["kinds"], v["kind"])).otherwise(s["kinds"]).alias("kinds"),
            )

        hit = F.when(free & is_mail, pick(mail)).when(free & c["hit"].isNotNull(), pick(c["hit"])).when(tries & c["alone"], pick(c["loose"]))
        return _let(hit, after)

    return F.aggregate(tried, start, step, lambda s: F.struct(F.array_join(s["out"], "").alias("text"), s["kinds"].alias("kinds")))


def pseudonymised(docs: DataFrame, key: str = KEY, text_col: str = "text") -> DataFrame:
    """``doc`` (the whole row), the new ``text``, and ``kinds``, one entry for each value replaced."""
    t = F.col("t")
    none = F.array().cast("array<string>")
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("t"))
    some, mail = t.rlike("[0-9@]") & t.rlike(START), t.contains("@")
    rows = rows.select(
        "doc", "t", F.when(some, F.split(t, START, -1)).alias("pieces"),
        F.when(some & mail, F.regexp_extract_all(t, F.lit(MAIL), F.lit(0))).otherwise(none).alias("mails"),
        F.when(some & mail, F.split(t, MAIL, -1)).otherwise(none).alias("gaps"),
    )
    rows = rows.select("doc", "t", _tried(F.col("pieces"), key).alias("tried"), _mails(F.col("mails"), F.col("gaps"), key).alias("mails"))
    rows = rows.select("doc", "t", _alone(F.col("tried")).alias("tried"), "mails")
    rows = rows.select("doc", "t", _woven(F.col("tried"), F.col("mails")).alias("new"))
    return rows.select("doc", F.when(F.col("new").isNull(), t).otherwise(F.col("new.text")).alias("text"), F.coalesce("new.kinds", none).alias("kinds"))


def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pseudonymised(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(kinds, k -> k = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc.doc_id", "text", *counts)
