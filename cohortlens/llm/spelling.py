"""Spelling variants by a variable-length gram index.

Words are near if they differ by exactly one inserted, deleted or replaced
character.  They are found in these steps:

1. *Dictionary.*  Grams of two and three characters of the framed words are
   counted by Spark (at most the third power of the alphabet, whatever the size
   of the corpus).  Three-character grams are kept where their beginning is
   frequent (``grams.py``).
2. *Decomposition.*  Every word becomes its variable-length grams, with the
   bound on how many of them one edit can change.
3. *Lists.*  Words that are near share all but ``affected`` grams, so at least
   one of the ``affected + 1`` rarest of each, at the same place or, where one
   word is longer, at the next.  Only these lists are merged: keys of gram,
   length and place are joined, so that long lists are mostly skipped and no
   list holds words that cannot match.
4. *Bounds.*  Each word carries a 64-bit signature of all its grams.  Grams that
   the other word lacks are at most ``affected``, so no more signature bits may
   be missing, on either side; what is left is verified by edit distance.  Both
   happen where a list is merged, as arrays, so pairs that fail are never rows.
5. *Words without a bound.*  Where one edit could change all grams of a word
   (none, or a few short words), the word is looked up through two-character
   grams, of which one edit changes at most two, against all words.

A word's form is its near word of largest count (ties: first in code-point
order) if that is at least ``ratio`` times its own.  Counts grow along forms, so
they end at a root, found by pointer jumping in at most a few rounds.

Null and empty texts have no words; a null id counts as an empty one.  Repeated
rows count repeatedly.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship, stored
from .grams import BEGIN, END, GramDictionary

#: Fixed value: characters of a word.
WORD_PATTERN = "[A-Za-zÀ-ÿ]+"
MIN_CHARS = 5
MIN_COUNT = 3
#: A two-character gram that more places of words begin with is made longer.
FREQUENT = 200
RATIO = 2
#: Words of a list that one task holds.
LIST_ROWS = 50_000
#: Pairs that are compared at once.
PAIRS = 1 << 21
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, key: str = "doc_id", column: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, drop_one_in: int = 97) -> DataFrame:
    """(word, n) of the words of all texts, A-Z lower-cased.

    A run of letters whose crc32 with the document's id is divisible by
    ``drop_one_in`` loses one character (0 drops none)."""
    text = F.translate(F.col(column).cast("string"), _UPPER, _LOWER)
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= min_chars)
    word: Column = F.col("run")
    if drop_one_in:
        h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
        at = F.pmod(h, F.char_length("run")).cast("int")
        word = F.when(h % drop_one_in == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))).otherwise(word)
    return (runs.select(word.alias("word")).where(F.char_length("word") >= min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def gram_counts(words: DataFrame, longest: int) -> dict[str, int]:
    """Counts of the grams of 2 to ``longest`` characters of the framed words."""
    framed = F.concat(F.lit(BEGIN), "word", F.lit(END))
    size = F.char_length("word") + 2
    grams = F.flatten(F.array(*[F.transform(F.sequence(F.lit(1), size - q + 1), lambda i, q=q: F.substring(framed, i, F.lit(q)))
                                for q in range(2, longest + 1)]))
    rows = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).toArrow()
    return dict(zip(rows.column("gram").to_pylist(), rows.column("n").to_pylist()))


def _bits(gram: str) -> int:
    """The signature bit of a gram (a fixed rule, so that all tasks agree)."""
    x = 0
    for c in gram:
        x = (x * 1000003 + ord(c)) & 0xFFFFFFFF
    return (x ^ x >> 15) * 0x9E3779B1 >> 20 & 63


def decomposed(words: DataFrame, grams: GramDictionary, whole: bool = False) -> DataFrame:
    """(word, n, size, lost, signature, listed): the bound, the signature and
    the grams whose lists are merged, each with its place; none where the bound
    leaves no common gram.  ``whole`` lists all grams of such words too."""
    def run(part: dict) -> dict:
        lost, signature, listed, places = [], [], [], []
        for word in part["word"]:
            framed = BEGIN + word + END
            found = grams.decompose(framed)
            k = grams.affected(framed, found)
            ranked = grams.rarest(framed, found)
            bits = 0
            for g, _ in ranked:
                bits |= 1 << _bits(g)
            lost.append(k)
            signature.append(bits - (1 << 64) if bits >> 63 else bits)
            keep = ranked[: k + 1] if k < len(ranked) else []
            listed.append([g for g, _ in keep])
            places.append([p for _, p in keep])
        return {"word": part["word"], "n": part["n"], "lost": np.array(lost, np.int32), "signature": np.array(signature, np.int64),
                "listed": listed, "places": places}

    return map_batches(words.select("word", "n"), run,
                       "word string, n long, lost int, signature long, listed array<string>, places array<int>")


def _entries(words: DataFrame) -> DataFrame:
    """A row for each listed gram of each word."""
    return words.select("word", "n", "lost", "signature", F.char_length("word").alias("size"),
                        F.explode(F.arrays_zip("listed", "places")).alias("at")).select(
        "word", "n", "lost", "signature", "size", F.col("at.listed").alias("gram"), F.col("at.places").alias("place"))


def _joined(probe: DataFrame, lists: DataFrame, shifts: list[tuple[int, int]], once: bool, list_rows: int = LIST_ROWS) -> DataFrame:
    """Pairs (word, other) at edit distance 1 that share a listed gram where
    the other is longer by the first and the gram later by the second number of
    a shift.  ``once`` keeps pairs of one length in code-point order only.

    A list and the words that ask it meet in one task, list first; a list of
    more than ``list_rows`` words is dealt to several, and each gets all that
    ask.  A task holds one list at a time and reads the askers in batches."""
    shift = F.explode(F.array(*[F.struct(F.lit(a).alias("longer"), F.lit(b).alias("later")) for a, b in shifts]))
    columns = ["word", "n", "lost", "signature"]
    asked = probe.withColumn("shift", shift).select(
        F.xxhash64("gram", F.col("size") + F.col("shift.longer"), F.col("place") + F.col("shift.later")).alias("key"),
        F.lit(True).alias("asks"), *columns)
    held = lists.select(F.xxhash64("gram", "size", "place").alias("key"), F.lit(False).alias("asks"), *columns)
    heavy = stored(held.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > list_rows)
                   .select("key", F.ceil(F.col("rows") / list_rows).cast("int").alias("parts")))
    salt = F.lit(0)
    if not heavy.isEmpty():
        parts = F.coalesce("parts", F.lit(1))
        held = held.join(heavy, "key", "left").withColumn("salt", F.pmod(F.xxhash64("word"), parts).cast("int")).drop("parts")
        asked = asked.join(heavy, "key", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    else:
        held, asked = held.withColumn("salt", salt), asked.withColumn("salt", salt)
    met = held.unionByName(asked).repartition("key", "salt").sortWithinPartitions("key", "salt", "asks")
    ship(met.sparkSession)
    return met.select("key", "salt", "asks", *columns).mapInArrow(
        lambda batches: _merged(batches, once), "word string, n long, other string, other_n long")


def _merged(batches: Iterator[pa.RecordBatch], once: bool) -> Iterator[pa.RecordBatch]:
    """Merges each list with the words that ask it; rows come sorted by key,
    salt and side."""
    at: tuple | None = None
    held: list[Words] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        asks = batch.column(2).to_numpy(zero_copy_only=False)
        rows = Words(np.array(batch.column(3).to_pylist()), *(batch.column(i).to_numpy() for i in (4, 5, 6)))
        edge = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1]) | (asks[1:] != asks[:-1])) + 1
        found: list[tuple] = []
        for low, high in zip([0, *edge.tolist()], [*edge.tolist(), len(key)]):
            if at != (name := (key[low], salt[low])):
                at, held = name, []
            if asks[low] and not held:
                continue
            part = rows.rows(slice(low, high))
            if not asks[low]:
                held.append(part)
                continue
            if len(held) > 1:
                held = [Words(*(np.concatenate(x) for x in zip(*held)))]
            found += _near(part, held[0], once)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["word", "n", "other", "other_n"])


class Words(NamedTuple):
    word: np.ndarray
    n: np.ndarray
    lost: np.ndarray
    signature: np.ndarray

    def rows(self, at) -> "Words":
        return Words(*(x[at] for x in self))

    def least(self) -> np.ndarray:
        """Signature bits that a near word must share."""
        return np.maximum(np.bitwise_count(self.signature.view(np.uint64)).astype(np.int16) - self.lost, 0).astype(np.uint8)


def _near(asked: Words, held: Words, once: bool) -> list[tuple]:
    """(word, n, other, other_n) of the pairs that the bounds leave and whose
    distance is 1, in blocks of pairs."""
    out = []
    theirs, need = held.signature.view(np.uint64), held.least()
    step = max(1, PAIRS // len(theirs))
    for low in range(0, len(asked.word), step):
        mine = asked.rows(slice(low, low + step))
        common = np.bitwise_count(mine.signature.view(np.uint64)[:, None] & theirs[None, :])
        i, j = np.nonzero(common >= np.maximum(mine.least()[:, None], need[None, :]))
        if len(i):
            a, b = mine.word[i], held.word[j]
            good = one_edit(a, b)
            if once:
                good &= (np.char.str_len(a) < np.char.str_len(b)) | (a < b)
            good = np.flatnonzero(good)
            if len(good):
                out.append((a[good], mine.n[i[good]], b[good], held.n[j[good]]))
    return out


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether strings differ by exactly one inserted, deleted or replaced
    character, pair by pair."""
    width = max(a.dtype.itemsize, b.dtype.itemsize) // 4 + 1
    x, y = (np.ascontiguousarray(v.astype(f"U{width}")).view(np.uint32).reshape(len(v), width) for v in (a, b))
    n, m = np.char.str_len(a), np.char.str_len(b)
    differ = x != y
    out = (n == m) & (differ.sum(1) == 1)
    for short, long, rows in ((x, y, np.flatnonzero(m == n + 1)), (y, x, np.flatnonzero(n == m + 1))):
        if len(rows):
            # Behind the first difference the longer one is one place later.
            first = differ[rows].argmax(1)
            moved = short[rows][:, :-1] == long[rows][:, 1:]
            out[rows] = (moved | (np.arange(width - 1)[None, :] < first[:, None])).all(1)
    return out


def near_pairs(words: DataFrame, frequent: int = FREQUENT, longest: int = 3) -> DataFrame:
    """(word, n, other, other_n) of all pairs of distinct words at edit
    distance 1, each pair once.  ``words`` has word (distinct, not null) and n."""
    words = stored(words.select("word", "n"))
    counts = gram_counts(words, longest)
    parts = stored(decomposed(words, GramDictionary(counts, frequent, 2, longest)))
    # The shorter word asks; at equal length the first in code-point order.
    entries = _entries(parts)
    found = _joined(entries, entries, [(0, 0), (1, 0), (1, 1)], once=True)
    # Words without a bound: two-character grams only, against all words.
    unbound = parts.where(F.size("listed") == 0).select("word")
    if not unbound.isEmpty():
        pairs = stored(decomposed(words, GramDictionary({g: n for g, n in counts.items() if len(g) == 2}, frequent, 2, 2)))
        lists = _entries(pairs)
        more = _joined(_entries(pairs.join(unbound, "word", "left_semi")), lists, [(0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1)], once=False)
        swap = F.col("word") > F.col("other")
        found = (found.select(*_ordered(F.col("word") > F.col("other")))
                 .unionByName(more.select(*_ordered(swap))))
    return found.distinct()


def _ordered(swap: Column) -> list[Column]:
    def either(a: str, b: str, name: str) -> Column:
        return F.when(swap, F.col(b)).otherwise(F.col(a)).alias(name)

    return [either("word", "other", "word"), either("n", "other_n", "n"), either("other", "word", "other"), either("other_n", "n", "other_n")]


def forms(words: DataFrame, ratio: int = RATIO, frequent: int = FREQUENT, longest: int = 3) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``words``."""
    words = stored(words.select("word", "n"))
    pairs = stored(near_pairs(words, frequent, longest))
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form"))).alias("best"))
    near = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.rank") >= ratio * F.col("n"), F.col("best.form")).alias("form"),
        F.when(-F.col("best.rank") >= ratio * F.col("n"), -F.col("best.rank")).alias("form_n"))
    near = stored(near)
    return near.join(roots(near.where(F.col("form").isNotNull()).select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of every word with a form, by pointer jumping: each round
    doubles the steps, and steps are few as counts grow by ``ratio`` at each."""
    at = stored(links.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("via"), F.col("root").alias("to"))
        moved = stored(at.join(on, F.col("root") == F.col("via"), "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")))
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, key: str = "doc_id", column: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, frequent: int = FREQUENT, longest: int = 3, drop_one_in: int = 97) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    return forms(word_counts(docs, key, column, min_chars, min_count, drop_one_in), ratio, frequent, longest)
