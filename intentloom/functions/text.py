"""Column expressions over text."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import chain

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from intentloom.functions.hashing import hash_int, row_hash

# The stop words of the word-frequency report.
STOPWORDS = (
    "i my me the a an is it to and of in for on was have has do does did can but not with this that be are "
    "from or at by you your how what why when where which who will would could should there been being if so "
    "than too very just about up out no get got am were had don't didn't won't can't t s m re ve d ll"
).split()

# The synonym table of the augmentation step.
SYNONYMS = {
    "money": "funds",
    "transfer": "send",
    "account": "profile",
    "card": "payment card",
    "bank": "financial institution",
    "pay": "remit",
    "cash": "money",
    "check": "verify",
    "lost": "missing",
    "stolen": "taken",
    "block": "freeze",
    "pin": "security code",
    "fee": "charge",
    "balance": "amount",
    "deposit": "credit",
    "withdraw": "debit",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``, also inside nested lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: str | Column) -> Column:
    """Tokens between white space of any kind (Unicode, as in most languages' split())."""
    return F.regexp_extract_all(text, F.lit(r"(?U)(\S+)"), F.lit(1))


TOKEN_CHARACTERS = r"[\p{L}\p{N}_]"
_LETTERS: list[np.ndarray] = []


def tokens(text: str | Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN_CHARACTERS}{{2,}})"), F.lit(1))


def token_letters(spark: SparkSession) -> np.ndarray:
    """The characters of ``tokens`` as ranges of code points (first, last): what Spark takes for a letter or number."""
    if not _LETTERS:
        known = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
        runs = spark.createDataFrame([(known,)], "c string").select(F.regexp_extract_all("c", F.lit(f"({TOKEN_CHARACTERS}+)"), F.lit(1))).first()[0]
        _LETTERS.append(np.array([(ord(r[0]), ord(r[-1])) for r in runs]))
    return _LETTERS[0]


def trim_text(text: str | Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def text_key(text: str | Column) -> Column:
    """Cache key: SHA-256 of the trimmed, lower-cased text."""
    return F.sha2(F.lower(trim_text(text)), 256)


def ngrams(toks: Column, n: int) -> Column:
    """Space-joined runs of ``n`` neighbouring tokens."""
    if n == 1:
        return toks
    return let(
        toks,
        lambda t: F.when(
            F.size(t) >= n,
            F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)), lambda i: F.array_join(F.slice(t, i, n), " ")),
        ).otherwise(F.array().cast("array<string>")),
    )


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of one row's terms, by run lengths of the sorted array."""

    def runs(t: Column) -> Column:
        positions = F.sequence(F.lit(1), F.size(t))
        starts = F.filter(positions, lambda i: (i == 1) | (F.get(t, i - 1) != F.get(t, i - 2)))
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda start, i: F.struct(
                    F.get(t, start - 1).alias("term"),
                    (F.coalesce(F.get(s, i + 1), F.size(t) + 1) - start).cast("long").alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return let(F.sort_array(terms), lambda t: F.when(F.size(t) > 0, runs(t)).otherwise(empty))


def synonym_replace(text: str | Column, n: int = 1, synonyms: Mapping[str, str] = SYNONYMS) -> Column:
    """Replace the first ``n`` words found in ``synonyms`` (whole word, any case)."""
    table = F.create_map(*[F.lit(x) for pair in synonyms.items() for x in pair])
    known = F.array(*[F.lit(k) for k in synonyms])

    def replace(w: Column) -> Column:
        marked = F.transform(w, lambda x, i: F.when(F.array_contains(known, F.lower(x)), i).otherwise(-1))
        hits = F.slice(F.filter(marked, lambda i: i >= 0), 1, n)
        return let(
            hits,
            lambda h: F.array_join(
                F.transform(
                    w,
                    lambda x, i: F.when(F.array_contains(h, i), F.element_at(table, F.lower(x))).otherwise(x),
                ),
                " ",
            ),
        )

    return let(words(text), replace)


def random_swap(text: str | Column, draw: Sequence[str | Column], n: int = 1) -> Column:
    """Swap two different word positions, ``n`` times; texts under two words stay as they are.

    ``draw`` names the columns that key the seeded choice.
    """
    source = F.col(text) if isinstance(text, str) else text

    def one_swap(w: Column, turn: int) -> Column:
        size = F.size(w)
        first = F.pmod(hash_int(row_hash(*draw, seed=f"swap{turn}a")), size).cast("int")
        step = F.pmod(hash_int(row_hash(*draw, seed=f"swap{turn}b")), size - 1).cast("int")
        pair = F.struct(first.alias("i"), F.pmod(first + 1 + step, size).alias("j"))
        return let(
            pair,
            lambda p: F.transform(
                w,
                lambda x, k: F.when(k == p["i"], F.get(w, p["j"])).when(k == p["j"], F.get(w, p["i"])).otherwise(x),
            ),
        )

    def swapped(w: Column) -> Column:
        current = w
        for turn in range(n):
            current = one_swap(current, turn) if turn == 0 else let(current, lambda c, t=turn: one_swap(c, t))
        return F.when(F.size(w) >= 2, F.array_join(current, " ")).otherwise(source)

    return let(words(source), swapped)
