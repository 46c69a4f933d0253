"""Exact byte-pair encoding by one pass of dynamic programming over the prefixes of a word, and decoding.

Merging pairs by rank is replaced by this: the encoding of every prefix of a word ends in one token, and that
token decides the rest. An automaton over all tokens reports, for each prefix, the tokens that are its
suffixes. A candidate t is the last token if it can stand beside the last token of the prefix before it:
merging the two tokens' texts must give these two back. One candidate passes, is stored, and back-pointers
from the whole word give the ids. The work is linear in a word's length, also for words of a million letters.

*Why pairs suffice.* Merges happen in order of rank. Two neighbours a, b stay apart unless some piece x
at the right edge of a and some piece y at the left edge of b merge with each other before either is taken
into its own parent. Pieces at an edge are the token, its right (or left) part, and so on down to a symbol;
``Vocabulary.apart`` walks both edges back in time. Equal ranks go from left to right, so a pair loses
against the merge that makes x's parent and wins against the one that makes y's.

Texts are cut at spaces and line ends, which no token crosses; normal form, lower case and the split into
letters, digits and marks are the tokenizer file's own, taken once for each distinct word of a worker.

Defined results: a null or empty text has no ids and decodes to the empty text; special tokens written out
in a text are their ids; repeated rows are encoded each; an empty table gives no rows; the caller's other
columns are not carried.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.common import read
from intentloom.llm.encode import TAKEN, texts_of

CACHED_WORDS = 250_000  # distinct words in one generation of a worker's cache
CACHED_LENGTH = 100  # longer words are encoded each time
KNOWN_PAIRS = 1_000_000
NEVER = 1 << 40  # the rank of a merge that does not exist
#: Words of visible ASCII characters and the letters of the two Latin blocks after it, but for the one whose
#: lower case has a combining mark. They are in normal form, and these runs are what the split leaves of them.
KNOWN_LETTERS = re.compile("[!-~À-ÖØ-öø-įı-ſ]*")
RUN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-zß-öø-ſ0-9]+")
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"  # the split that RUN stands for
_CODERS: dict[str, Coder] = {}


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if visible, else the next from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return [chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)]


class Vocabulary:
    """Tokens, the merges that made them, and what may be neighbours.

    A token's symbols are written as one character a byte, the last of a word 256 higher.
    """

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}  # when a token comes into being; symbols are always there
        for r, (a, b) in enumerate(pairs):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if whole in self.made or r < max(self.made.get(left, -1), self.made.get(right, -1)):
                raise ValueError("each token must come from one merge of older ones")
            self.parts[whole], self.made[whole] = (left, right), r
        spelled = {vocab[c]: chr(b) for b, c in enumerate(byte_letters())}
        spelled |= {vocab[c + suffix]: chr(b + 256) for b, c in enumerate(byte_letters())}
        self.pairs: dict[int, bool] = {}  # by both ids in one number
        self.length: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        reachable = set(spelled)  # tokens that their own text merges into; no others appear in an encoding
        for token, (left, right) in self.parts.items():
            spelled[token] = spelled[left] + spelled[right]
            if left in reachable and right in reachable and self.apart(left, right, self.made[token]):
                reachable.add(token)
        for token in reachable:
            self.length[token] = len(spelled[token])
            self.automaton.add_word(spelled[token], token)
        self.automaton.make_automaton()

    def apart(self, a: int, b: int, until: int = NEVER) -> bool:
        """Do a and b stay neighbours when their texts are merged together, up to the merge of rank ``until``?"""
        x, y, x_ends, y_ends = a, b, until, until
        while True:
            rank = self.rank.get((x, y), NEVER)
            if rank < x_ends and rank <= y_ends and rank < until:
                return False
            x_made, y_made = self.made.get(x, -1), self.made.get(y, -1)
            if x_made < 0 and y_made < 0:
                return True
            if x_made > y_made:
                x, x_ends = self.parts[x][1], x_made
            else:
                y, y_ends = self.parts[y][0], y_made

    def encode(self, word: str) -> bytes:
        """The little-endian ids of one word, given as one character a byte."""
        length, known = self.length, self.pairs.get
        spelled = word[:-1] + chr(ord(word[-1]) + 256)
        last = [-1] * len(spelled)  # the last token of each prefix
        for at, token in self.automaton.iter(spelled):
            if last[at] >= 0:
                continue
            before = at - length[token]
            if before < 0:
                last[at] = token
                continue
            key = last[before] << 32 | token
            beside = known(key)
            if beside is None:
                beside = self.pairs[key] = self.apart(last[before], token)
            if beside:
                last[at] = token
        if len(self.pairs) > KNOWN_PAIRS:
            self.pairs.clear()
        out, at = [], len(spelled) - 1
        while at >= 0:
            out.append(last[at])
            at -= length[last[at]]
        return array("i", out[::-1]).tobytes()


class Words(dict):
    """What ``make`` gives for a word, kept in two generations: words that are not used again are let go with the old one."""

    def __init__(self, make) -> None:
        self.make, self.old = make, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= CACHED_LENGTH:
            self[word] = ids
        return ids

    def age(self) -> None:
        if len(self) > CACHED_WORDS:
            self.old = dict(self)
            self.clear()


class Coder:
    """Text to ids and back with one tokenizer file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if model["type"] != "BPE" or model["dropout"] or model["continuing_subword_prefix"] or file["decoder"]:
            raise ValueError("a byte-pair tokenizer without drop-out, inner prefixes and decoder is needed")
        if SPLIT not in json.dumps(file["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\") or "Lowercase" not in str(file["normalizer"]):
            raise ValueError("a tokenizer that lowers case and splits as RUN does is needed")
        whole = Tokenizer.from_file(path)
        self.normal, self.split = whole.normalizer, whole.pre_tokenizer
        self.vocabulary = Vocabulary(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.mark = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")") if self.special else None
        names = {i: t for t, i in [*model["vocab"].items(), *self.special.items()]}
        self.names = np.array([names.get(i, "") for i in range(max(names) + 1)], dtype=object)
        self.bytes = {ord(c): chr(b) for b, c in enumerate(byte_letters())}
        self.runs, self.words = Words(self.vocabulary.encode), Words(self._word)

    def _plain(self, text: str) -> bytes:
        if KNOWN_LETTERS.fullmatch(text):  # what the file's normal form and split do to these is sure
            found = RUN.findall(text.lower())
            return b"".join([self.runs[run.encode().decode("latin-1")] for run in found])
        found = self.split.pre_tokenize_str(self.normal.normalize_str(text))
        return b"".join([self.runs[run.translate(self.bytes)] for run, _ in found])

    def _word(self, word: str) -> bytes:
        """The ids of what stands between two spaces."""
        if "<" not in word or not self.mark:
            return self._plain(word) if word else b""
        parts = enumerate(self.mark.split(word))
        return b"".join([array("i", [self.special[p]]).tobytes() if k % 2 else self._plain(p) for k, p in parts if p])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The little-endian ids of each text."""
        self.words.age()
        self.runs.age()
        ids = self.words.__getitem__
        return [b"".join(map(ids, t.replace("\n", " ").split(" "))) for t in texts]

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.names[ids].tolist())


def coder(path: str) -> Coder:
    """One coder for each Python worker."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def parts_of(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs lo..hi of texts of about ``TAKEN`` in all."""
    lo = size = 0
    for hi, n in enumerate(sizes, 1):
        size += n
        if size >= TAKEN or hi == len(sizes):
            yield lo, hi
            lo, size = hi, 0


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row of ``docs``."""

    def rows(batches):
        code = coder(tokenizer)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in parts_of([len(t) for t in texts]):
                made = code.encode(texts[lo:hi])
                offsets = np.concatenate([[0], np.cumsum([len(m) // 4 for m in made])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), "<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), ids], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(rows, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` (doc_id, ids) with ``text``, the tokens of ``ids_col`` joined by spaces, special ones included."""

    def texts(batches):
        code = coder(tokenizer)
        for batch in batches:
            ids = batch.column(1)
            sizes = np.diff(np.asarray(ids.offsets))
            for lo, hi in parts_of((8 * sizes).tolist()):
                part = ids.slice(lo, hi - lo)
                at = np.asarray(part.offsets) - part.offsets[0].as_py()
                flat = np.asarray(part.flatten())
                made = [code.decode(flat[a:b]) for a, b in zip(at, at[1:])]
                arrays = [batch.column(0).slice(lo, hi - lo), part, pa.array(made, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "text"])

    picked = rows.select("doc_id", F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return picked.mapInArrow(texts, "doc_id long, ids array<int>, text string")


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    both = decoded(encoded(read(spark, sf_dir, "documents"), tokenizer), tokenizer)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
