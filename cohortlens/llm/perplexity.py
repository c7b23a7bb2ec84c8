"""Quality rules with n-gram perplexity bands of each language.

A modified Kneser-Ney model of byte n-grams (``ORDER`` bytes, which are the key
of a gram as one 64-bit number) is counted by Spark over all texts, one model
for each language:

* Grams of the highest order have their number of occurrences, shorter ones the
  number of different bytes before them, down to single bytes.
* Every order and language has three discounts from its counts of counts (for
  grams counted once, twice and more often).  Where these counts are too thin
  (one is zero, or a discount would leave its range) they are 0.5, 1 and 1.5.
* A gram's probability is its discounted share among the grams with the same
  beginning plus the mass left over times the probability of the gram without
  its first byte; the last step is the uniform distribution over 256 bytes.

The statistics are then frozen: a table of grams and a table of contexts, both
sorted by language, order and key.  A task holds them as sorted arrays and looks
up by binary search; a table of more than ``ARRAY_ROWS`` rows is joined to the
distinct grams of blocks of documents instead, with the same result.

A text's perplexity is 2 to the power of its bits per byte over the whole text.
The bands of a language are its quartiles of bits per byte (over the documents
that pass the base rules, counted in steps of 1/1000 bit) widened by ``WHISKER``
times their distance on either side: a text below is too predictable, one above
too strange for its language.  The base rules reject texts of fewer than 50
words or with more than half of their words in repeated 3-word windows.

Null or empty texts have no bytes and fail the base rules.  Documents without a
language are a language of their own.  Rows are handled one by one, so repeated
rows come back (and count) repeatedly; ids may be null; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import map_batches, small_enough, stored
from .words import window_hashes, word_hashes

ORDER = 5
#: Bytes that are counted or scored at once; a longer text comes in blocks that share ``ORDER - 1`` bytes.
BLOCK = 1 << 20
#: Rows of a model that each task may hold as arrays (16 bytes a row).
ARRAY_ROWS = 4_000_000
#: Bytes of text of a block of documents, where the model is joined.
SHUFFLE_BLOCK = 8 << 20
WHISKER = 3.0
STEP = 1000
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Fixed value: characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
_PAD = b"\n"


class Model(NamedTuple):
    """``grams``: (lang, k, gram, p); ``contexts``: (lang, k, gram, rest), the
    mass that a context leaves to the shorter gram."""

    grams: DataFrame
    contexts: DataFrame
    order: int


def _windows(raws: list[bytes], order: int, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(grams, rows, sizes): the grams that end at each byte of the texts, of
    which the first ``sizes[0]`` belong to text ``rows[0]`` and so on."""
    own: list[tuple[int, bytes]] = []
    size = 0

    def grams():
        n = np.array([len(x) - order + 1 for _, x in own], np.int64)
        b = np.frombuffer(b"".join(x for _, x in own), np.uint8)
        g = np.zeros(len(b) - order + 1, np.int64)
        for i in range(order):
            g <<= 8
            g |= b[i : i + len(g)]
        first = np.cumsum(n + order - 1) - (n + order - 1)
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return g[at], np.array([i for i, _ in own], np.int64), n

    for i, raw in enumerate(raws):
        padded = _PAD * (order - 1) + raw
        for at in range(0, len(raw), block):
            part = padded[at : at + block + order - 1]
            if own and size + len(part) > block:
                yield grams()
                own, size = [], 0
            own.append((i, part))
            size += len(part)
    if own:
        yield grams()


def _by_language(part: dict) -> Iterator[tuple[str, list[int]]]:
    by: dict[str, list[int]] = {}
    for i, lang in enumerate(part["lang"]):
        by.setdefault(lang, []).append(i)
    yield from by.items()


def _texts(docs: DataFrame, key: str, column: str, lang: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.col(column).cast("binary").alias("text"),
                       F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"))


def _counts(rows: DataFrame, order: int) -> DataFrame:
    """(lang, gram, c) of the highest order over all texts."""
    def count(part: dict) -> Iterator[dict]:
        for lang, at in _by_language(part):
            for grams, _, _ in _windows([part["text"][i] or b"" for i in at], order):
                g, n = np.unique(grams, return_counts=True)
                yield {"lang": pa.array([lang]).take(pa.array(np.zeros(len(g), np.int32))), "gram": g, "c": n}

    return (map_batches(rows.select("lang", "text"), count, "lang string, gram long, c long")
            .groupBy("lang", "gram").agg(F.sum("c").alias("c")))


def _discounts(level: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) of one order, from the counts of counts."""
    n = level.groupBy("lang").agg(*[F.count_if(F.col("c") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    own = [i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}") for i in (1, 2, 3)]
    good = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0)
    own = [F.when(good, x) for x in own]
    fits = F.coalesce(F.lit(True) & good, F.lit(False))
    for i, x in enumerate(own, 1):
        fits = fits & F.coalesce((x > 0) & (x <= i), F.lit(False))
    return n.select("lang", *[F.when(fits, x).otherwise(F.lit(0.5 * i)).alias(f"d{i}") for i, x in enumerate(own, 1)])


def fit(docs: DataFrame, order: int = ORDER, key: str = "doc_id", column: str = "text", lang: str = "lang") -> Model:
    """The frozen model of every language, over all texts of ``docs``."""
    levels = {order: stored(_counts(_texts(docs, key, column, lang), order))}
    for k in range(order - 1, 0, -1):
        # How many different bytes stand before a shorter gram.
        levels[k] = stored(levels[k + 1].groupBy("lang", F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram"))
                           .agg(F.count(F.lit(1)).alias("c")))
    grams, contexts, shorter = [], [], None
    for k in range(1, order + 1):
        # One row for each language.
        own = levels[k].join(F.broadcast(_discounts(levels[k])), "lang").withColumn("context", F.shiftright("gram", 8))
        # At most 256 grams have the same beginning.
        same = Window.partitionBy("lang", "context")
        c = F.col("c")
        discount = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        own = (own.withColumn("total", F.sum("c").over(same).cast("double"))
               .withColumn("rest", (F.col("d1") * F.sum((c == 1).cast("int")).over(same) + F.col("d2") * F.sum((c == 2).cast("int")).over(same)
                                    + F.col("d3") * F.sum((c >= 3).cast("int")).over(same)) / F.col("total"))
               .withColumn("share", F.greatest(c - discount, F.lit(0.0)) / F.col("total")))
        if shorter is None:
            own = own.withColumn("p", F.col("share") + F.col("rest") / 256)
        else:
            low = shorter.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("low"))
            own = (own.withColumn("shorter", F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1)).join(low, ["lang", "shorter"])
                   .withColumn("p", F.col("share") + F.col("rest") * F.col("low")))
        shorter = stored(own.select("lang", "gram", "p", "context", "rest"))
        grams.append(shorter.select("lang", F.lit(k).alias("k"), "gram", "p"))
        contexts.append(shorter.groupBy("lang", F.col("context").alias("gram")).agg(F.max("rest").alias("rest"))
                        .select("lang", F.lit(k).alias("k"), "gram", "rest"))

    def sorted_table(parts: list[DataFrame]) -> DataFrame:
        all_rows = parts[0]
        for x in parts[1:]:
            all_rows = all_rows.unionByName(x)
        return stored(all_rows.repartitionByRange("lang", "k", "gram").sortWithinPartitions("lang", "k", "gram"))

    return Model(sorted_table(grams), sorted_table(contexts), order)


class Arrays:
    """A model as sorted arrays of one language and order each."""

    def __init__(self, model: Model):
        self.order = model.order
        self.grams, self.contexts = self._arrays(model.grams, "p"), self._arrays(model.contexts, "rest")

    @staticmethod
    def _arrays(table: DataFrame, value: str) -> dict:
        rows = table.orderBy("lang", "k", "gram").toArrow()
        gram, number = rows.column("gram").to_numpy(), rows.column(value).to_numpy()
        names = rows.select(["lang", "k"]).group_by(["lang", "k"], use_threads=False).aggregate([([], "count_all")])
        out, at = {}, 0
        for lang, k, n in zip(*(names.column(c).to_pylist() for c in ("lang", "k", "count_all"))):
            out[lang, k] = gram[at : at + n], number[at : at + n]
            at += n
        return out

    @staticmethod
    def _found(table: dict, lang: str, k: int, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where the table has none."""
        have, number = table.get((lang, k), (np.empty(0, np.int64), np.empty(0)))
        if not len(have):
            return np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        return np.where(have[at] == keys, number[at], np.nan)

    def probability(self, lang: str, grams: np.ndarray, k: int | None = None) -> np.ndarray:
        """Of the last byte of each gram, after the bytes before it."""
        k = self.order if k is None else k
        if not k:
            return np.full(len(grams), 1 / 256)
        p = self._found(self.grams, lang, k, grams)
        new = np.flatnonzero(np.isnan(p))
        if len(new):
            rest = self._found(self.contexts, lang, k, grams[new] >> 8)
            p[new] = np.where(np.isnan(rest), 1.0, rest) * self.probability(lang, grams[new] & ((1 << 8 * (k - 1)) - 1), k - 1)
        return p


def text_bits(raws: list[bytes], order: int, bits_of) -> np.ndarray:
    """Code length of every text, where ``bits_of(grams)`` has each byte's."""
    out = np.zeros(len(raws))
    for grams, rows, sizes in _windows(raws, order):
        np.add.at(out, rows, np.add.reduceat(bits_of(grams), np.cumsum(sizes) - sizes))
    return out


def base_counts(raws: list[bytes]) -> dict[str, list[int]]:
    """Counts of whole texts: words, their characters, symbols, repeated lines
    and words in repeated 3-word windows."""
    out: dict[str, list[int]] = {c: [] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    for raw, words in zip(raws, word_hashes(raws)):
        b = np.frombuffer(raw, np.uint8)
        white = (b == 32) | ((b >= 9) & (b <= 13))
        out["n_words"].append(len(words))
        out["word_chars"].append(int(np.count_nonzero(((b & 0xC0) != 0x80) & ~white)))
        out["n_symbols"].append(sum(map(raw.count, _SYMBOL_BYTES)))
        lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        windows = window_hashes(words, 3, 31)
        _, back, n = np.unique(windows, return_inverse=True, return_counts=True)
        at = np.flatnonzero(n[back] > 1)
        covered = np.zeros(len(words) + 1, bool)
        for i in range(3):
            covered[at + i] = True
        out["n_repeat_words"].append(int(np.count_nonzero(covered)))
    return out


_SYMBOL_BYTES = [bytes([x]) for x in SYMBOLS]
_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SCORED = f"id long, lang string, {_COUNTS}, n_bytes long, bits double"


def _scored(part: dict, bits: np.ndarray) -> dict:
    raws = [x or b"" for x in part["text"]]
    return {"id": part["id"], "lang": part["lang"], **base_counts(raws), "n_bytes": [len(x) for x in raws], "bits": bits}


def scored(docs: DataFrame, model: Model, key: str = "doc_id", column: str = "text", lang: str = "lang",
           array_rows: int = ARRAY_ROWS) -> DataFrame:
    """(key, lang, the base counts, n_bytes, bits) of every row."""
    rows = _texts(docs, key, column, lang)
    if small_enough(model.grams, array_rows):
        sent = docs.sparkSession.sparkContext.broadcast(Arrays(model))

        def score(part: dict) -> dict:
            bits = np.zeros(len(part["text"]))
            for name, at in _by_language(part):
                bits[at] = text_bits([part["text"][i] or b"" for i in at], sent.value.order,
                                     lambda g, name=name: -np.log2(sent.value.probability(name, g)))
            return _scored(part, bits)

        out = map_batches(rows, score, _SCORED)
    else:
        out = _scored_by_join(rows, model)
    return out.withColumnRenamed("id", key)


def _scored_by_join(rows: DataFrame, model: Model) -> DataFrame:
    """As ``scored``, for a model beyond arrays: blocks of documents get the
    probabilities of their distinct grams by a join on the gram."""
    order = model.order
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    rows = rows.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(max(1, -(-size // SHUFFLE_BLOCK)))))

    def used(part: dict) -> Iterator[dict]:
        by: dict[tuple, list[int]] = {}
        for i, name in enumerate(zip(part["block"], part["lang"])):
            by.setdefault(name, []).append(i)
        for (block, lang), at in by.items():
            for grams, _, _ in _windows([part["text"][i] or b"" for i in at], order):
                g = np.unique(grams)
                yield {"block": np.full(len(g), block), "lang": [lang] * len(g), "gram": g}

    asked = map_batches(rows.select("block", "lang", "text"), used, "block long, lang string, gram long").distinct()
    asked = stored(asked)
    known = _probabilities(asked.select("lang", "gram").distinct(), model, order)
    values = asked.join(known, ["lang", "gram"]).select(F.col("block").alias("in_block"), F.col("lang").alias("in_lang"), "gram", "p")

    target = to_arrow_schema(StructType.fromDDL(_SCORED))

    def score(mine: pa.Table, grams: pa.Table) -> pa.Table:
        part = {c: mine.column(c).to_pylist() for c in ("id", "lang", "text")}
        names = np.array(grams.column("in_lang").to_pylist(), object)
        keys, p = grams.column("gram").to_numpy(), grams.column("p").to_numpy()
        bits = np.zeros(len(part["text"]))
        for name, at in _by_language(part):
            own = names == name
            turn = np.argsort(keys[own])
            have, number = keys[own][turn], -np.log2(p[own][turn])
            bits[at] = text_bits([part["text"][i] or b"" for i in at], order, lambda g: number[np.searchsorted(have, g)])
        return pa.table(_scored(part, bits), schema=target)

    return (rows.select("block", "id", "lang", "text").groupBy("block").cogroup(values.groupBy("in_block"))
            .applyInArrow(score, _SCORED))


def _probabilities(asked: DataFrame, model: Model, k: int) -> DataFrame:
    """(lang, gram, p) of distinct grams of ``k`` bytes, seen or not."""
    if not k:
        return asked.withColumn("p", F.lit(1 / 256))
    found = stored(asked.join(model.grams.where(F.col("k") == k).select("lang", "gram", "p"), ["lang", "gram"], "left"))
    new = found.where(F.col("p").isNull()).select("lang", "gram")
    if new.isEmpty():
        return found
    new = new.select("lang", "gram", F.shiftright("gram", 8).alias("context"), F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1).alias("shorter"))
    rest = model.contexts.where(F.col("k") == k).select("lang", F.col("gram").alias("context"), "rest")
    low = _probabilities(new.select("lang", F.col("shorter").alias("gram")).distinct(), model, k - 1)
    low = low.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("low"))
    new = (new.join(rest, ["lang", "context"], "left").join(low, ["lang", "shorter"])
           .select("lang", "gram", (F.coalesce("rest", F.lit(1.0)) * F.col("low")).alias("p")))
    return found.where(F.col("p").isNotNull()).unionByName(new)


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def bands(rates: DataFrame, whisker: float = WHISKER) -> DataFrame:
    """(lang, low, high) in bits per byte from (lang, rate), by exact quartiles
    of the rates in steps of 1 / ``STEP``."""
    steps = rates.select("lang", F.floor(F.col("rate") * STEP).alias("step")).groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n"))
    # A language has some ten thousand steps at most: a byte costs few bits.
    total = Window.partitionBy("lang")
    run = total.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    placed = steps.withColumn("below", F.sum("n").over(run)).withColumn("all", F.sum("n").over(total))
    q1, q3 = (F.min(F.when(F.col("below") * 4 >= F.col("all") * i, F.col("step"))) / STEP for i in (1, 3))
    found = placed.groupBy("lang").agg(q1.alias("q1"), q3.alias("q3"))
    wide = whisker * (F.col("q3") - F.col("q1"))
    return found.select("lang", (F.col("q1") - wide).alias("low"), (F.col("q3") + 1 / STEP + wide).alias("high"))


def quality(docs: DataFrame, model: Model | None = None, key: str = "doc_id", column: str = "text", lang: str = "lang",
            whisker: float = WHISKER, array_rows: int = ARRAY_ROWS) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, perplexity, too_low, too_high) of every row; the model is
    that of ``docs`` unless another is given."""
    model = fit(docs, ORDER, key, column, lang) if model is None else model
    rate = F.when(F.col("n_bytes") > 0, F.col("bits") / F.col("n_bytes"))
    rows = stored(scored(docs, model, key, column, lang, array_rows).withColumns({"rate": rate, "base_failed": _base_failed()}))
    # One row for each language.
    out = rows.join(F.broadcast(bands(rows.where(~F.col("base_failed")), whisker)), "lang", "left")
    low = F.coalesce(F.col("rate") < F.col("low"), F.lit(False))
    high = F.coalesce(F.col("rate") > F.col("high"), F.lit(False))
    return out.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~low & ~high).alias("kept"), F.pow(F.lit(2.0), "rate").alias("perplexity"),
                      low.alias("too_low"), high.alias("too_high"))
