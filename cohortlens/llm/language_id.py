"""Language identification by prediction by partial matching (PPM).

One byte context tree per language.  A tree holds how often each symbol
followed each context of 0 to 3 symbols.  A symbol's probability is its share
in the longest context in which it was seen; every shorter step down costs the
escape probability of the context left (escape method C: distinct symbols
against occurrences plus distinct symbols), ending in a uniform order -1.  The
statistics are frozen after the fit, so a text's code length is the sum of
``-log2`` of these probabilities over all of its bytes.  The language with the
shortest code wins; the score is its posterior probability under equal priors.

Symbols are the 256 bytes with A-Z lower-cased.  The trees are kept as sorted
grams.  For speed, every context tree is evaluated once into a table of the
grams made of the ``SYMBOLS - 1`` most frequent bytes of the fit only; grams
with another byte are looked up in the sorted grams, once per distinct gram of
a block.  Both give the same code lengths, so ``SYMBOLS`` changes no result.

The fit reads a bounded, hash-drawn sample of about ``fit_rows`` labelled rows;
counts are aggregated by Spark and the model is at most the distinct grams of
that sample, whatever the size of the corpus.  Every row is scored over its
whole text.

Null text, and text without a letter (Unicode), gives ``und`` with score 0.  A
corpus without labelled rows gives ``und`` everywhere.  Ties go to the
alphabetically first language.  Rows are handled one by one, so repeated rows
come back repeatedly; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Symbols of the dense table; 0 stands for all bytes that are not in it.
SYMBOLS = 40
BYTES = 256
ORDER = 3
FIT_ROWS = 20_000
BLOCK = 1 << 19
UNDEFINED = "und"


def _folded(rows: list[bytes]) -> np.ndarray:
    """Rows behind ``ORDER`` spaces each, A-Z lower-cased, as one array."""
    pad = b" " * ORDER
    b = np.frombuffer(pad + pad.join(rows), np.uint8)
    upper = (b >= 65) & (b <= 90)
    return b + (upper.view(np.uint8) << 5)


def _grams(symbols: np.ndarray, base: int = SYMBOLS) -> np.ndarray:
    """Number of every ``ORDER + 1`` symbols in a row."""
    n = len(symbols) - ORDER
    out = np.zeros(max(n, 0), np.int64)
    for i in range(ORDER + 1):
        out *= base
        out += symbols[i : i + n]
    return out


def _alphabet(counts: np.ndarray) -> np.ndarray:
    """byte -> symbol of the dense table; 0 is any other.  Ties go to the smaller byte."""
    out = np.zeros(256, np.int32)
    for i, b in enumerate(np.argsort(-counts, kind="stable")[: SYMBOLS - 1]):
        if counts[b]:
            out[b] = i + 1
    return out


def context_levels(grams: np.ndarray, counts: np.ndarray, base: int = BYTES) -> list[tuple[np.ndarray, ...]]:
    """Of every order: sorted grams with the probability of their last symbol,
    and sorted contexts with their escape probability (frozen counts, escape
    method C)."""
    out = []
    for order in range(ORDER + 1):
        keys, at = np.unique(grams % base ** (order + 1), return_inverse=True)
        n = np.bincount(at, weights=counts, minlength=len(keys))
        contexts, own, distinct = np.unique(keys // base, return_inverse=True, return_counts=True)
        whole = np.bincount(own, weights=n, minlength=len(contexts)) + distinct
        out.append((keys, (n / whole[own]).astype(np.float32), contexts, (distinct / whole).astype(np.float32)))
    return out


def _found(sorted_keys: np.ndarray, values: np.ndarray, keys: np.ndarray, missing: float) -> np.ndarray:
    if not len(sorted_keys):
        return np.full(len(keys), missing, np.float32)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, values[at], np.float32(missing))


def gram_bits(grams: np.ndarray, levels: list[tuple[np.ndarray, ...]], base: int = BYTES) -> np.ndarray:
    """Code length in bits of the last symbol of each gram."""
    p = np.full(len(grams), 1 / base, np.float32)
    for order, (keys, shares, contexts, escapes) in enumerate(levels):
        own = grams % base ** (order + 1)
        share = _found(keys, shares, own, 0.0)
        p = np.where(share > 0, share, _found(contexts, escapes, own // base, 1.0) * p)
    return -np.log2(p)


def _renumbered(keys: np.ndarray, length: int, base: int, symbols: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), np.int64)
    for i in reversed(range(length)):
        out = out * SYMBOLS + symbols[keys // base**i % base]
    return out


def code_table(grams: np.ndarray, counts: np.ndarray, alphabet: np.ndarray | None = None) -> np.ndarray:
    """Code length in bits of the last of each ``ORDER + 1`` symbols, from the
    frozen counts (PPM without update).  With an ``alphabet`` the grams are of
    bytes and the entries with symbol 0 mean nothing."""
    base, symbols = (SYMBOLS, np.arange(SYMBOLS)) if alphabet is None else (BYTES, alphabet)
    return _dense(context_levels(grams, counts, base), base, symbols)


def _dense(levels: list[tuple[np.ndarray, ...]], base: int, symbols: np.ndarray) -> np.ndarray:
    p = np.full(SYMBOLS, 1 / base, np.float32)
    for order, (keys, shares, contexts, escapes) in enumerate(levels):
        share = np.zeros(SYMBOLS ** (order + 1), np.float32)
        share[_renumbered(keys, order + 1, base, symbols)] = shares
        escape = np.ones(SYMBOLS**order, np.float32)
        escape[_renumbered(contexts, order, base, symbols)] = escapes
        share = share.reshape((SYMBOLS,) * (order + 1))
        p = np.where(share > 0, share, escape.reshape((SYMBOLS,) * order + (1,)) * p)
    return -np.log2(p, out=p).ravel()


def fit(docs: DataFrame, train: Column, key: str = "doc_id", fit_rows: int = FIT_ROWS) -> dict:
    """The frozen model of the rows where ``train`` holds, text and language
    are there.  Rows are drawn by the hash of the key, about ``fit_rows``."""
    rows = docs.where(train & F.col("text").isNotNull() & F.col("lang").isNotNull())
    n = rows.count()
    share = min(1.0, fit_rows / max(n, 1))
    rows = (rows.where(F.pmod(F.xxhash64(F.lit(5), F.col(key)), F.lit(1 << 20)) < int(share * (1 << 20)))
            .select("lang", F.col("text").cast("binary").alias("text")))

    def bytes_seen(part: dict) -> dict:
        total = np.zeros(256, np.int64)
        for row in part["text"]:
            total += np.bincount(_folded([row]), minlength=256)
        return {"byte": np.arange(256), "n": total}

    seen = map_batches(rows, bytes_seen, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(256, np.int64)
    counts[seen["byte"].to_numpy(np.int64)] = seen["n"].to_numpy(np.int64)
    alphabet = _alphabet(counts)

    def grams_seen(part: dict) -> Iterator[dict]:
        by: dict[str, list[bytes]] = {}
        for lang, row in zip(part["lang"], part["text"]):
            by.setdefault(lang, []).append(row)
        for lang, own in by.items():
            # Grams that reach over the end of a row only hold padding spaces at their end.
            g, n = np.unique(_grams(_folded(own), BYTES), return_counts=True)
            yield {"lang": [lang] * len(g), "gram": g, "n": n}

    found = (map_batches(rows, grams_seen, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(found["lang"].unique())
    trees = []
    for lang in langs:
        own = found[found["lang"] == lang].sort_values("gram")
        trees.append((own["gram"].to_numpy(np.int64), own["n"].to_numpy(np.int64)))
    return {"name": uuid.uuid4().hex, "langs": langs, "alphabet": alphabet, "trees": trees}


_TABLES: dict[str, tuple[np.ndarray, list]] = {}


def _table(model: dict) -> tuple[np.ndarray, list]:
    """[gram, language] code lengths of the frequent bytes and the levels of
    every language, built once a Python worker."""
    if model["name"] not in _TABLES:
        _TABLES.clear()
        table = np.empty((SYMBOLS ** (ORDER + 1), len(model["trees"])), np.float32)
        levels = [context_levels(*t) for t in model["trees"]]
        for i, own in enumerate(levels):
            table[:, i] = _dense(own, BYTES, model["alphabet"])
        _TABLES[model["name"]] = table, levels
    return _TABLES[model["name"]]


def _bits(folded: np.ndarray, alphabet: np.ndarray, table: np.ndarray, levels: list | None) -> np.ndarray:
    """[byte, language] code lengths behind the first ``ORDER`` bytes."""
    symbols = alphabet[folded]
    bits = table[_grams(symbols)]
    if levels is not None and len(bits):
        other = symbols == 0
        at = np.flatnonzero(np.logical_or.reduce([other[i : i + len(bits)] for i in range(ORDER + 1)]))
        grams, back = np.unique(_grams(folded, BYTES)[at], return_inverse=True)
        bits[at] = np.stack([gram_bits(grams, x) for x in levels], axis=1)[back]
    return bits


def code_lengths(rows: list[bytes], alphabet: np.ndarray, table: np.ndarray, levels: list | None = None) -> np.ndarray:
    """[row, language] code length in bits of every whole text.  With the
    ``levels`` of the languages, grams with symbol 0 are looked up there."""
    out = np.zeros((len(rows), table.shape[1]))
    start = 0
    while start < len(rows):
        to, size = start, 0
        while to < len(rows) and (to == start or size + len(rows[to]) <= BLOCK):
            size += len(rows[to])
            to += 1
        own = rows[start:to]
        if to == start + 1 and size > BLOCK:  # one long text, in blocks that share ORDER symbols
            folded = _folded(own)
            for at in range(0, size, BLOCK):
                out[start] += _bits(folded[at : at + BLOCK + ORDER], alphabet, table, levels).sum(0, dtype=np.float64)
        else:
            bits = _bits(_folded(own), alphabet, table, levels)
            total = np.zeros((len(bits) + 1, bits.shape[1]))
            np.cumsum(bits, axis=0, dtype=np.float64, out=total[1:])
            size = np.array([len(x) for x in own])
            begin = np.cumsum(size + ORDER) - size - ORDER
            out[start:to] = total[begin + size] - total[begin]
        start = to
    return out


def _has_letter(raw: bytes) -> bool:
    if any(65 <= b <= 90 or 97 <= b <= 122 for b in raw[:64]):
        return True
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def language_id(docs: DataFrame, model: dict, key: str = "doc_id", columns: tuple[str, ...] = (),
                prefix: str = "") -> DataFrame:
    """(key, lang_pred, score, bits_per_byte) of every row, and the row's own
    ``columns``; no shuffle.  ``prefix`` keeps the new names apart from those."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    langs = model["langs"]
    columns = tuple(c for c in columns if c not in (key, "text"))

    def score(part: dict) -> dict:
        raw = [x or b"" for x in part["text"]]
        known = [bool(langs) and _has_letter(x) for x in raw]
        pred, prob, rate = [UNDEFINED] * len(raw), [0.0] * len(raw), [0.0] * len(raw)
        at = [i for i, ok in enumerate(known) if ok]
        if at:
            bits = code_lengths([raw[i] for i in at], sent.value["alphabet"], *_table(sent.value))
            best = bits.argmin(1)
            low = bits[np.arange(len(at)), best]
            share = 1 / np.exp2(-np.minimum(bits - low[:, None], 1000.0)).sum(1)
            for i, b, s, n in zip(at, best.tolist(), share.tolist(), low.tolist()):
                pred[i], prob[i], rate[i] = langs[b], s, n / len(raw[i])
        own = {c: part[c] for c in columns} | ({"text": part["text"]} if columns else {})
        return {key: part[key], f"{prefix}lang_pred": pred, f"{prefix}score": prob, f"{prefix}bits_per_byte": rate} | own

    own = docs.select(F.col(key).cast("long").alias(key), F.col("text").cast("binary").alias("text"), *columns)
    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in columns) + (", text binary" if columns else "")
    out = map_batches(own, score, f"`{key}` long, {prefix}lang_pred string, {prefix}score double, {prefix}bits_per_byte double{kept}")
    return out.withColumn("text", F.col("text").cast("string")) if columns else out


def accepted(docs: DataFrame, train: Column | None = None, key: str = "doc_id", least_score: float = 0.5,
             languages: tuple[str, ...] | None = None) -> DataFrame:
    """The rows whose language is told with at least ``least_score`` (and is one
    of ``languages``, if given); the model is fitted on their own labels."""
    model = fit(docs, F.lit(True) if train is None else train, key)
    out = language_id(docs, model, key, tuple(docs.columns), "_ppm_")
    good = (F.col("_ppm_lang_pred") != UNDEFINED) & (F.col("_ppm_score") >= least_score)
    if languages is not None:
        good = good & F.col("_ppm_lang_pred").isin(*languages)
    return out.where(good).select(*docs.columns)


def held_out(key: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the key as text, modulo 4, is 2."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2
