from __future__ import annotations

import hashlib
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from intentloom.llm import pseudonyms as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def feistel(vector, radix, kind, key=P.KEY):
    half = max(len(vector) // 2, 1)
    a, b, ra, rb = vector[:half], vector[half:], radix[:half], radix[half:]
    for r in range(P.ROUNDS):
        mine, radices, other = (a, ra, b) if r % 2 == 0 else (b, rb, a)
        digest = hashlib.sha512(f"{key}|{kind}|{r}|{','.join(map(str, other))}".encode()).hexdigest()
        made = [(x + int(digest[4 * i : 4 * i + 4], 16)) % radices[i] for i, x in enumerate(mine)]
        a, b = (made, b) if r % 2 == 0 else (a, made)
    return a + b


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = 2 * d if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10


def fill(form, digits, keep=0):
    it = iter(digits)
    seen = [0]

    def one(m):
        seen[0] += 1
        return m[0] if seen[0] <= keep else str(next(it))

    return re.sub("[0-9]", one, form)


def plain_card(m):
    d = [int(c) for c in m if c.isdigit()]
    if luhn(d) or not d[0]:
        return m
    body = feistel([d[0] - 1, *d[1:-1]], [9] + [10] * (len(d) - 2), "card")
    body = [body[0] + 1, *body[1:]]
    return fill(m, [*body, (10 - luhn([*body, 0])) % 10])


def plain_ip(m):
    o = [int(x) for x in m.split(".")]
    return m if max(o) > 255 else ".".join(map(str, feistel(o, [256] * 4, "ip")))


def plain_phone(m):
    d = [int(c) for c in m if c.isdigit()]
    keep, body = len(d) - 10, d[-10:]
    low = [2 if i in (0, 3) else 0 for i in range(10)]
    made = feistel([x - y for x, y in zip(body, low)], [10 - 2 * bool(y) if y else 10 for y in low], "phone")
    return fill(m, [x + y for x, y in zip(made, low)], keep)


def plain_date(m):
    y, mo, d = map(int, m.split("-"))
    first = (y + 50) // 100 * 100 - 50
    days = (date(first + 100, 1, 1) - date(first, 1, 1)).days
    low, high = (75, 487) if days == 36525 else (92, 397)
    a, b = feistel([(date(y, mo, d) - date(first, 1, 1)).days // high, (date(y, mo, d) - date(first, 1, 1)).days % high], [low, high], "date")
    return str(date(first, 1, 1) + timedelta(a * high + b))


def made(spark, texts):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    return [r["text"] for r in P.pseudonymised(df).orderBy("doc.doc_id").collect()]


def test_values_equal_plain_python(spark):
    rng = random.Random(4)
    cards = []
    for _ in range(40):
        body = [rng.randint(1, 9)] + [rng.randint(0, 9) for _ in range(rng.choice([12, 14, 15, 17]))]
        cards.append("".join(map(str, [*body, (10 - luhn([*body, 0])) % 10])))
    cards += ["4216-7977-4474-8693", "4216 7977 4474 8693", "4216797744748694", "0000000000000000"]
    ips = [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(40)] + ["256.1.1.1", "1.2.3.999"]
    phones = [f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04d}" for _ in range(40)] + ["383-555-6083", "1.383.555.6083"]
    dates = [str(date(1905, 3, 1) + timedelta(rng.randrange(60_000))) for _ in range(40)]
    for plain, values in ((plain_card, cards), (plain_ip, ips), (plain_phone, phones), (plain_date, dates)):
        assert made(spark, [f"é {v} end" for v in values]) == [f"é {plain(v)} end" for v in values]


def test_values_next_to_other_numbers_change(spark):
    card, phones, ibans = "4111 1111 1111 1111", ["212-555-0123", "646-555-0199"], ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"]
    alone = dict(zip([*phones, *ibans], made(spark, [*phones, *ibans])))
    alone[card] = plain_card(card)
    assert all(v != m for v, m in alone.items())
    texts = [
        f"{card} 124", f"{card} 12/26", f"No 12 {card}", f"{card} {card}", f"{card}-7", f"4111111111111112 {card}", f"{phones[0]} {phones[1]}",
        f"{phones[0]} 1234", f"1235 {phones[0]}", f"{ibans[0]} EUR 500", f"{ibans[0]} {ibans[1]} 7", f"AB12 {ibans[1]} USD", f"{card} {phones[1]} {ibans[0]}",
        f"7 x-{card}@mail.org", f"123-45-678 {phones[0]}",
    ]
    for text, new in zip(texts, made(spark, texts)):
        want = text
        for v, m in alone.items():
            want = want.replace(v, m) if "@" not in text else want
        if "@" in text:
            assert "4111 1111 1111" not in new and new.endswith("@mail.org"), (text, new)
        else:
            assert new == want, (text, new)


def test_equal_values_stay_linked_and_others_apart(spark):
    a, b, c, d = made(spark, ["x +1 (383) 555-6083", "y 383-555-6083 z", "383.555.6084", "+1 (383) 555-6083, +1 (383) 555-6083"])
    assert re.sub(r"\D", "", a)[1:] == re.sub(r"\D", "", b) != re.sub(r"\D", "", c)
    first, second = d.split(", ")
    assert first == second == a[2:]


def test_the_permutation_is_one_to_one(spark):
    every = spark.range(75 * 487).select(F.array((F.col("id") / 487).cast("int"), (F.col("id") % 487).cast("int")).alias("v"))
    got = every.select(P.permuted(F.col("v"), F.array(F.lit(75), F.lit(487)), "date", "k").alias("p")).distinct()
    assert got.count() == 75 * 487


def test_formats_stay_valid(spark):
    texts = ["iban DE89370400440532013000 GB82 WEST 1234 5698 7654 32", "ssn 123-45-6789", "mail Joe.x97@mail2.example.com", "29.2.1984 02/29/1984 2/3/1990"]
    out = made(spark, texts)
    for s in (out[0].split(" ")[1], "".join(out[0].split(" ")[2:])):
        assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    assert re.fullmatch(r"ssn (?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", out[1]) and out[1] != texts[1]
    assert re.fullmatch(r"mail [A-Z][a-z]{2}\.[a-z]\d\d@mail2\.example\.com", out[2]) and out[2] != texts[2]
    assert re.fullmatch(r"\d\d\.\d{1,2}\.\d{4} \d\d/\d\d/\d{4} \d{1,2}/\d{1,2}/\d{4}", out[3])


def test_clean_texts_stay(spark):
    texts = [None, "", "no numbers", "1983-02-30 999.1.1.1 000-12-3456 4216797744748694 a@b v1.2.3.4.5 DE00370400440532013000", "x" * 100_000, "7 of 9, 2024, 3.14"]
    assert made(spark, texts) == texts


def test_given_documents(spark, sf_dir):
    rows = P.op1_pseudonyms(spark, sf_dir).collect()
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(before)
    personal = re.compile(r"[\w.+-]+@[\w.-]+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d+\.\d+\.\d+\.\d+\b|\b\d{16}\b")
    hits = 0
    for r in rows:
        found = [v for v in personal.findall(before[r["doc_id"]]) if not v.isdigit() or not luhn(list(map(int, v)))]
        hits += len(found)
        assert not any(v in r["text"] for v in found)
        assert (r["text"] == before[r["doc_id"]]) == (sum(r[f"n_{k}"] for k in P.KINDS) == 0)
        assert len(r["text"]) >= len(before[r["doc_id"]]) - 20
    assert hits


@pytest.mark.parametrize("extra", ["t", "doc", "kinds"])
def test_clashing_names_and_empty_table(spark, extra):
    df = spark.createDataFrame([(1, "1.2.3.4", 5)], f"doc_id long, text string, {extra} int")
    row = P.pseudonymised(df).first()
    assert row["doc"][extra] == 5 and row["text"] == plain_ip("1.2.3.4")
    assert P.pseudonymised(df.limit(0)).count() == 0
