"""Benchmark decontamination by template canonicalisation.

Texts become tokens (runs of letters, digits and non-ASCII bytes; a point or
comma between digits belongs to a number).  In the template of a text, numbers,
names (tokens with a capital first letter) and units (a unit word behind a
number) are typed placeholders whose words are kept as slot values; all other
tokens are literal and lower-cased.

1. Every ``window`` consecutive template tokens of a benchmark item are hashed,
   if enough of them are literal; an item with fewer tokens is one window of its
   own length.  The same windows without placeholders (all lower-cased) are a
   second view, for passages whose capitals were changed.
2. Windows of whole documents are hashed alike and hash-joined with them.  If
   the benchmark's window hashes are at most ``BROADCAST_WINDOWS`` (checked),
   documents drop other windows before the shuffle; else all are joined.
3. Windows of a document and an item with the same offset form an alignment.
   Its slots must be consistent: one value of the item stands for one value in
   the document, for names also the other way round.  So a question with other
   names and numbers is found, and a chance likeness of templates is not.
4. A document is contaminated by an item if the consistent alignments hold at
   least ``share`` of the item's windows, or ``enough`` of them (13 tokens in a
   row, as decontamination by n-grams asks for).

Null or empty texts and items have no windows.  An item with fewer than
``least_literal`` literal tokens in every window cannot be told from chance and
matches nothing.  Repeated documents are each found once per (id, item);
repeated items count once per item id.  Rows with a null id are left out of the
matches.  Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_enough, stored, texts
from .words import BLOCK, U, cut_blocks, hash_spans, numbers, window_hashes

WINDOW = 8
LEAST_LITERAL = 4
SHARE = 0.4
ENOUGH = 6
BROADCAST_WINDOWS = 200_000
#: Words that are units behind a number (fixed values).
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons tonne tonnes ounce ounces pound pounds lb lbs oz "
         "ml cl l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
         "months year years s min h cent cents dollar dollars euro euros usd eur percent degree degrees watt watts kw kwh volt "
         "volts joule joules newton newtons meter meters metre metres gram grams kilogram kilograms kilometer kilometers")
LITERAL, NAME, NUMBER, UNIT = 0, 1, 2, 3
_PLACE = numbers(41, 4)


def _classes() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = True
    inside[128:] = True
    return inside


_INSIDE = _classes()


def _lowered(b: np.ndarray) -> np.ndarray:
    """A-Z and the Latin-1 capitals of UTF-8 in lower case."""
    upper = (b >= 65) & (b <= 90)
    upper[1:] |= (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)
    return b + (upper.view(np.uint8) << 5)


def _unit_hashes() -> np.ndarray:
    return np.sort(np.concatenate([hash_spans(np.frombuffer(u.encode(), np.uint8), np.array([0]), np.array([len(u)]))
                                   for u in UNITS.split()]))


_UNIT_HASHES = _unit_hashes()


def _tokens(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, kind, first byte offset) of the tokens; units are not yet told."""
    b = np.frombuffer(data, np.uint8)
    inside = _INSIDE[b]
    digit = (b >= 48) & (b <= 57)
    if len(b) > 2:
        inside[1:-1] |= ((b[1:-1] == 46) | (b[1:-1] == 44)) & digit[:-2] & digit[2:]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    first = b[start]
    after = b[np.minimum(start + 1, len(b) - 1)] if len(b) else first
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97))
    kind = np.where(digit[start], NUMBER, np.where(capital, NAME, LITERAL)).astype(np.int8) if len(start) else np.empty(0, np.int8)
    return hash_spans(_lowered(b), start, end), kind, start


def templates(rows: list[bytes]):
    """(value, kind) arrays of each text: token fingerprints and their kinds."""
    group: list[bytes] = []

    def finish(value, kind):
        unit = np.zeros(len(kind), bool)
        if len(kind):
            at = np.minimum(np.searchsorted(_UNIT_HASHES, value), len(_UNIT_HASHES) - 1)
            unit[1:] = ((_UNIT_HASHES[at] == value) & (kind == LITERAL))[1:] & (kind[:-1] == NUMBER)
        return value, np.where(unit, np.int8(UNIT), kind)

    def flush():
        if len(group) == 1 and len(group[0]) > BLOCK:
            parts = [_tokens(x) for x in cut_blocks(group[0])]
            yield finish(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            return
        value, kind, start = _tokens(b"\n".join(group))
        at = 0
        for to in np.searchsorted(start, np.cumsum([len(x) + 1 for x in group])):
            yield finish(value[at:to], kind[at:to])
            at = to

    size = 0
    for row in rows:
        if group and size + len(row) > BLOCK:
            yield from flush()
            group, size = [], 0
        group.append(row)
        size += len(row)
    if group:
        yield from flush()


def _hashed(value: np.ndarray, kind: np.ndarray, length: int, least_literal: int) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """[(hash, position, typed)] of both views' windows of ``length`` tokens."""
    if len(value) < length:
        return []
    typed = np.where(kind == LITERAL, value, _PLACE[kind])
    literal = np.concatenate(([0], np.cumsum(kind == LITERAL)))
    slots = literal[length:] - literal[:-length]
    at = np.arange(len(value) - length + 1)
    enough = slots >= least_literal
    seed = 42 + 2 * length
    out = [(window_hashes(typed, length, seed)[enough], at[enough], True)]
    plain = window_hashes(value, length, seed + 1)
    return out + [(plain, at, False)]


_WINDOWS = "`{key}` long, h long, at long, typed boolean, size int, n long, kinds array<int>, slots array<long>"


def template_windows(rows: DataFrame, key: str, lengths, least_literal: int, wanted=None, items: bool = False) -> DataFrame:
    """Windows of each text: hash, position, view, kinds and slot values.  With
    ``items`` every text has windows of ``lengths[0]`` tokens, or, if it is
    shorter, one of its own; else windows of all ``lengths``, and only those
    with a hash in ``wanted`` (a broadcast sorted array)."""
    def windows(part: dict) -> dict:
        cols = {c: [] for c in (key, "h", "at", "typed", "size", "n", "kinds", "slots")}
        for i, (value, kind) in zip(part[key], templates([x or b"" for x in part["text"]])):
            n = len(value)
            own = ([min(lengths[0], n)] if n >= least_literal else []) if items else lengths
            for length in own:
                for h, at, typed in _hashed(value, kind, length, least_literal):
                    if wanted is not None:
                        w = wanted.value
                        keep = w[np.minimum(np.searchsorted(w, h), len(w) - 1)] == h if len(w) else np.zeros(len(h), bool)
                        h, at = h[keep], at[keep]
                    for x, p in zip(h.view(np.int64).tolist(), at.tolist()):
                        k = kind[p : p + length]
                        slot = np.flatnonzero(k != LITERAL) if typed else np.empty(0, np.int64)
                        cols[key].append(i)
                        cols["h"].append(x)
                        cols["at"].append(p)
                        cols["typed"].append(typed)
                        cols["size"].append(length)
                        cols["n"].append(n - length + 1)
                        cols["kinds"].append(k[slot].tolist())
                        cols["slots"].append(value[p : p + length][slot].view(np.int64).tolist())
        return cols

    return map_batches(rows, windows, _WINDOWS.format(key=key))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", window: int = WINDOW,
                 least_literal: int = LEAST_LITERAL, share: float = SHARE, enough: int = ENOUGH,
                 broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(key, item, n_windows, n_matched, n_changed_slots) of every document and
    item that it holds, re-parameterised or not."""
    spark = docs.sparkSession
    items = texts(benchmark, item).where(F.col(item).isNotNull()).dropDuplicates([item])
    known = stored(template_windows(items, item, [window], least_literal, items=True))
    small = small_enough(known.select("h"), broadcast_windows)
    # Items shorter than a window have windows of their own length.
    lengths = sorted(r["size"] for r in known.select("size").distinct().collect())
    wanted = None
    if small:
        hashes = known.select("h").distinct().toPandas()["h"].to_numpy(np.int64).view(U)
        wanted = spark.sparkContext.broadcast(np.sort(hashes))
    found = stored(template_windows(texts(docs, key).where(F.col(key).isNotNull()), key, lengths, least_literal, wanted))
    right = known.select("h", item, F.col("at").alias("item_at"), F.col("n").alias("n_windows"), F.col("slots").alias("item_slots"))
    pairs = found.drop("n", "size").join(F.broadcast(right) if small else right, "h").withColumn("offset", F.col("at") - F.col("item_at"))
    group = [key, item, "offset", "typed"]
    # Slot consistency of each alignment: at most one item's length of rows.
    slots = (pairs.select(*group, F.explode_outer(F.arrays_zip("kinds", "slots", "item_slots")).alias("s"))
             .groupBy(*group, F.col("s.kinds").alias("kind"), F.col("s.item_slots").alias("theirs")).agg(
                 F.min("s.slots").alias("low"), F.max("s.slots").alias("high"))
             .groupBy(*group, "kind").agg(
                 F.max(F.coalesce(F.col("low") != F.col("high"), F.lit(False))).alias("split"),
                 F.count("theirs").alias("values"), F.count_distinct("low").alias("images"),
                 F.sum(F.coalesce(F.col("low") != F.col("theirs"), F.lit(False)).cast("int")).alias("changed")))
    bad = F.col("split") | ((F.col("kind") == NAME) & (F.col("images") < F.col("values")))
    good = slots.groupBy(*group).agg(F.max(bad).alias("bad"), F.sum("changed").alias("changed")).where("not coalesce(bad, false)")
    fits = pairs.select(*group, "item_at", "n_windows").join(good, group)
    per_item = fits.groupBy(key, item).agg(
        F.max("n_windows").alias("n_windows"), F.count_distinct("item_at").alias("n_matched"),
        F.max("changed").alias("n_changed_slots"))
    return per_item.where(F.col("n_matched") >= F.least(share * F.col("n_windows"), F.lit(float(enough)))).select(
        key, item, "n_windows", "n_matched", F.col("n_changed_slots").cast("long").alias("n_changed_slots"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    bad = stored(contaminated(docs, benchmark, key, item, **options).select(key).distinct())
    return docs.join(F.broadcast(bad) if small_enough(bad, BROADCAST_WINDOWS) else bad, key, "left_anti").select(*docs.columns)
