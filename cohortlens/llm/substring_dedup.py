"""Long repeated passages across documents by recompression.

A document is its sequence of words ``[^\\x20\\x09-\\x0D]+``, unchanged; a
window is ``size`` consecutive words.  A word is removed if a window that covers
it also starts in a document with a smaller id; windows are judged on the
input, not on what is left.

1. *Copies.*  Documents with equal word sequences are one text, kept by the
   smallest id; the others lose all words if they have a window at all.
2. *Recompression.*  Rounds replace maximal runs of a symbol by a name for
   (symbol, length), then neighbouring symbols of a left and a right class,
   which a bit of their names decides, by a name for the pair.  A name is the
   fingerprint of what it stands for, so naming is global without a dictionary
   being exchanged, and equal passages get equal symbols in their interior.
   Every symbol carries the words its formation depended on (itself and the
   neighbours that each round consulted).
3. *Anchors.*  A symbol is certain for a window if all of that lies in the
   window: it then occurs in every copy of the window.  The window's anchor is
   its certain symbol of least name, its key the fingerprint of ``size // 2``
   words beside the anchor's start, inside the window.  A window without a
   certain symbol (long runs, periods) is its own key, so none is missed.
4. Keys in two texts or more are found by a shuffle; only windows with such a
   key are fingerprinted (128 bits) and shuffled, for the smallest id that has
   them.  Counts of keys and windows are partial aggregates, and what a hot
   passage leaves is joined as rows, never gathered.

Texts are handled whole, long ones in segments that overlap by a window.  Null
text has no words.  Rows with a null id are left as they are and remove
nothing.  Repeated rows come back repeatedly; rows with one id are one document
whose parts remove nothing from each other.  An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored, texts
from .words import U, mix, numbers, sequence_key, spans, window_hashes, word_hashes

SIZE = 50
ROUNDS = 3
SEGMENT = 1 << 18
EMPTY = hashlib.sha256(b"").hexdigest()
_MIX = numbers(31, 4)


def _around(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a symbol has a left and a right neighbour in its document."""
    inner = doc[1:] == doc[:-1]
    return np.concatenate(([False], inner)), np.concatenate((inner, [False]))


def recompress(words: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """(name, begin, low, high) of the symbols after ``rounds``: the words
    [low, high) decide the symbol.  A missing neighbour counts as a word
    outside, since elsewhere there may be one."""
    name, d = words, doc
    begin = np.arange(len(words))
    end, low, high = begin + 1, begin, begin + 1
    with np.errstate(over="ignore"):
        for r in range(rounds):
            has_left, has_right = _around(d)
            before = np.where(has_left, np.roll(low, 1), begin - 1)
            after = np.where(has_right, np.roll(high, -1), end + 1)
            first = np.flatnonzero(~(has_left & (name == np.roll(name, 1))))
            count = np.diff(np.append(first, len(name)))
            last = first + count - 1
            name = np.where(count > 1, mix(name[first] * _MIX[0] + count.astype(U) * _MIX[1]), name[first])
            begin, end, low, high, d = begin[first], end[last], before[first], after[last], d[first]

            right = (mix(name ^ U(r + 1)) >> U(63)).astype(bool)
            has_left, has_right = _around(d)
            before = np.where(has_left, np.roll(low, 1), begin - 1)
            after = np.where(has_right, np.roll(high, -1), end + 1)
            low, high = np.where(right, before, low), np.where(right, high, after)
            second = has_left & right & ~np.roll(right, 1)
            head = np.flatnonzero(~second)
            paired = np.append(second[1:], False)[head]
            tail = head + paired
            name = np.where(paired, mix(name[head] * _MIX[2] + name[tail] * _MIX[3]), name[head])
            begin, end, low, high, d = begin[head], end[tail], low[head], high[tail], d[head]
    return name, begin, low, high


def _least(name: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Index of the least name in each range [a, b] (a <= b)."""
    length = b - a + 1
    out = np.empty(len(a), np.int64)
    table, step = np.arange(len(name)), 1
    while True:
        own = np.flatnonzero((length >= step) & (length < 2 * step))
        x, y = table[a[own]], table[b[own] - step + 1]
        out[own] = np.where(name[x] <= name[y], x, y)
        if not (length >= 2 * step).any():
            return out
        x, y = table[: len(table) - step], table[step:]
        table = np.where(name[x] <= name[y], x, y)
        step *= 2


def window_keys(words: np.ndarray, doc: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(start, key) of every window of ``words``, documents side by side."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U)
    start = np.flatnonzero(doc[:n] == doc[size - 1 :])
    if not len(start):
        return start, np.empty(0, U)
    name, begin, low, high = recompress(words, doc)
    a = np.searchsorted(low, start)
    b = np.searchsorted(high, start + size, side="right") - 1
    sure = a <= b
    key = np.empty(len(start), U)
    key[~sure] = mix(window_hashes(words, size, 33)[start[~sure]])
    half = size // 2
    beside = window_hashes(words, half, 34)
    at, p = start[sure], begin[_least(name, a[sure], b[sure])]
    ahead = p - at <= size - half
    key[sure] = beside[np.where(ahead, p, p - half)] ^ ahead.astype(U)
    return start, key


def _segments(rows: list[bytes], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, row, offset of the row's first word here): rows side by side, a
    long row in overlapping segments."""
    group: list[tuple[int, int, np.ndarray]] = []
    total = 0

    def out():
        return (np.concatenate([w for _, _, w in group]), np.repeat([i for i, _, _ in group], [len(w) for _, _, w in group]),
                np.repeat([o for _, o, _ in group], [len(w) for _, _, w in group]))

    for i, w in enumerate(word_hashes(rows)):
        for at in range(0, max(len(w) - size + 1, 1), SEGMENT):
            part = w[at : at + SEGMENT + size - 1]
            if group and total + len(part) > SEGMENT:
                yield out()
                group, total = [], 0
            group.append((i, at, part))
            total += len(part)
    if group:
        yield out()


def _place(row: np.ndarray, offset: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Word number in its row of each position."""
    first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (offset[1:] != offset[:-1]))))
    begin = np.repeat(first, np.diff(np.append(first, len(row))))
    return start - begin[start] + offset[start]


def _survey(docs: DataFrame, key: str, size: int) -> DataFrame:
    def survey(part: dict) -> dict:
        raw = [x or b"" for x in part["text"]]
        keys: list[list] = [[] for _ in raw]
        for words, row, offset in _segments(raw, size):
            unit = row * 2 + (offset // SEGMENT) % 2  # segments of a row stay apart
            start, found = window_keys(words, unit, size)
            if len(start):
                new = np.concatenate(([True], (found[1:] != found[:-1]) | (row[start][1:] != row[start][:-1])))
                for i, k in zip(row[start][new].tolist(), found[new].view(np.int64).tolist()):
                    keys[i].append(k)
        marks = [(len(w), *sequence_key(w)) for w in word_hashes(raw)]
        return {key: part[key], "n_words": [m[0] for m in marks], "f1": [m[1] for m in marks], "f2": [m[2] for m in marks],
                "sha": [hashlib.sha256(b" ".join(x.split())).hexdigest() for x in raw], "keys": [list(set(k)) for k in keys]}

    return map_batches(docs, survey, f"`{key}` long, n_words long, f1 long, f2 long, sha string, keys array<long>")


def _windows(candidates: DataFrame, key: str, size: int) -> DataFrame:
    def windows(part: dict) -> Iterator[dict]:
        raw = [x or b"" for x in part["text"]]
        wanted = [np.sort(np.array(k, np.int64).view(U)) for k in part["keys"]]
        ids = np.array(part[key], np.int64)
        for words, row, offset in _segments(raw, size):
            unit = row * 2 + (offset // SEGMENT) % 2
            start, found = window_keys(words, unit, size)
            if not len(start):
                continue
            h1, h2 = window_hashes(words, size, 35), window_hashes(words, size, 36)
            mine = row[start]
            keep = np.zeros(len(start), bool)
            cut = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1], [True])))
            for x, y in zip(cut[:-1], cut[1:]):
                w = wanted[mine[x]]
                keep[x:y] = w[np.minimum(np.searchsorted(w, found[x:y]), len(w) - 1)] == found[x:y]
            start = start[keep]
            yield {"h1": h1[start].view(np.int64), "h2": h2[start].view(np.int64), key: ids[row[start]],
                   "at": _place(row, offset, start)}

    return map_batches(candidates.select(key, "text", "keys"), windows, f"h1 long, h2 long, `{key}` long, at long")


def find_repeats(docs: DataFrame, key: str = "doc_id", size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """(every, cuts).  Every row of ``docs``: key, n_words, f1, f2, sha and
    ``copy`` (equal to a document of smaller id, with a window).  Cuts: key,
    text, f1, f2 and ``starts`` of the windows to remove, one row a document."""
    docs = texts(docs, key)
    every = stored(_survey(docs, key, size))
    firsts = stored(every.where(f"n_words >= {size}").groupBy("f1", "f2").agg(F.min(key).alias("first")))
    marked = every.drop("keys").join(firsts, ["f1", "f2"], "left").withColumn(
        "copy", F.coalesce(F.col("first") < F.col(key), F.lit(False))).drop("first")
    own = firsts.select(F.col("first").alias(key))
    keys = (every.join(own, key, "left_semi").select(key, F.explode("keys").alias("k")))
    shared = stored(keys.groupBy("k").agg(F.min(key).alias("a"), F.max(key).alias("b")).where("a < b").select("k"))
    wanted = stored(keys.join(shared, "k", "left_semi").groupBy(key).agg(F.collect_set("k").alias("keys")))
    marks = every.select(F.col(key).alias("id"), "f1", "f2")
    candidates = stored(docs.join(wanted, key).dropDuplicates([key]))
    windows = stored(_windows(candidates, key, size))
    least = stored(windows.groupBy("h1", "h2").agg(F.min(key).alias("least"), F.max(key).alias("most"))
                   .where("least < most").select("h1", "h2", "least"))
    starts = (windows.join(least, ["h1", "h2"]).where(F.col(key) > F.col("least"))
              .groupBy(key).agg(F.collect_list("at").alias("starts")))
    cuts = candidates.select(key, "text").join(starts, key)
    return marked, cuts


def covered(n: int, starts: list[int], size: int) -> np.ndarray:
    """Which of ``n`` words the windows cover."""
    edge = np.zeros(n + 1, np.int64)
    at = np.unique(np.array(starts, np.int64))
    edge[at] += 1
    np.subtract.at(edge, np.minimum(at + size, n), 1)
    return np.cumsum(edge[:n]) > 0


def kept_texts(cuts: DataFrame, key: str = "doc_id", size: int = SIZE, layout: bool = False) -> DataFrame:
    """(key, n_removed, kept): kept words joined by one space, or with
    ``layout`` the kept stretches of text as they are, joined by a line feed."""
    def cut(part: dict) -> dict:
        out: dict = {key: part[key], "n_removed": [], "kept": []}
        for raw, starts in zip(part["text"], part["starts"]):
            begin, end = spans(np.frombuffer(raw, np.uint8))
            gone = covered(len(begin), starts, size)
            out["n_removed"].append(int(gone.sum()))
            if layout:
                edge = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True])).view(np.int8)))
                out["kept"].append(b"\n".join(raw[begin[x] : end[y - 1]] for x, y in zip(edge[::2], edge[1::2])))
            else:
                out["kept"].append(b" ".join([raw[begin[i] : end[i]] for i in np.flatnonzero(~gone)]))
        return out

    return map_batches(cuts, cut, f"`{key}` long, n_removed long, kept binary")


def substring_dedup(docs: DataFrame, key: str = "doc_id", size: int = SIZE) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row of ``docs``."""
    every, cuts = find_repeats(docs, key, size)
    kept = stored(kept_texts(cuts, key, size).select(
        F.col(key).alias("of"), F.col("n_removed").alias("gone"), F.sha2("kept", 256).alias("left")))
    return stored(every).join(kept, F.col(key) == F.col("of"), "left").select(
        key, "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(EMPTY)).otherwise(F.coalesce("left", "sha")).alias("kept_sha256"))


def _free_names(docs: DataFrame, n: int) -> list[str]:
    """``n`` column names that ``docs`` does not have, whatever their case."""
    taken = {c.lower() for c in docs.columns}
    names = (f"_own{i}" for i in range(n + len(taken)))
    return [x for x in names if x not in taken][:n]


def without_repeats(docs: DataFrame, key: str = "doc_id", size: int = SIZE) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (and ``n_chars``
    counted anew); rows that lose every word go, all others stay."""
    every, cuts = find_repeats(docs, key, size)
    copies = stored(every.where("copy").select(key).distinct())
    of, left = _free_names(docs, 2)
    kept = stored(kept_texts(cuts, key, size, layout=True).select(
        F.col(key).alias(of), F.col("kept").cast("string").alias(left)))
    out = docs.join(copies, key, "left_anti").join(kept, F.col(key) == F.col(of), "left")
    text = F.coalesce(left, "text")
    changed = F.col(of).isNotNull()
    out = out.where(~changed | (F.length(left) > 0))
    news = {"text": text} | ({"n_chars": F.when(changed, F.length(left).cast("long")).otherwise(F.col("n_chars"))}
                             if "n_chars" in docs.columns else {})
    return out.withColumns(news).select(*docs.columns)
