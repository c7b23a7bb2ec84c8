"""Cross-tokenizer alignment with an identity-map fast path.

Every text is encoded by two vocabularies A and B over the same bytes (a space
and the text).  Byte offsets at which a token of both ends cut the tokens into
groups; two tokens are linked if their byte ranges overlap.  Corpus-wide counts
of linked id pairs tell how ids of A and B stand for each other.

* *Identity map.*  ``same[a]`` is the B id with the bytes of A id ``a``,
  computed once for each pair of vocabularies.  A group of one A and one B
  token that are so related is counted in a vector as long as vocabulary A: a
  task adds up its vector and hands on its non-zero places at its end, so these
  groups (most of all) never enter a shuffle as pairs.
* *Irregular groups.*  All others are named by their ids.  A block of documents
  (the texts that one call gets, about ``PIECE_BYTES``) keeps a dictionary of
  its irregular groups with their counts; documents hold places in it.  Spark
  adds up the dictionaries, takes each distinct group apart into its links and
  counts the pairs.  The values of the groups go back to the blocks by a join
  on the group, which reads one row for each block and group, so a group that
  every document holds is no hot key.
* A long text is encoded in segments that begin at single spaces between
  letters or digits which no piece of B's vocabulary can cross: A's
  pre-tokenizer starts a word there too, so both encodings are those of the
  whole text, and the space of the cut is the one that each segment begins with.

Only vocabulary-length tables (identity counts, highest count of a B id) are
sent to all tasks.

Null or empty texts, and texts whose tokens of A or B do not spell the text
(replaced or dropped characters), have no tokens: zeros and an empty digest.
Rows are handled one by one, so repeated rows come back repeatedly and count
repeatedly; ids may be null; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _pieces, ship, stored, texts

#: Characters of a text that are encoded at once; a longer text is cut.
SEGMENT_CHARS = 1 << 16
#: Bytes of texts that the encoders get at once.
ENCODE_BYTES = 1 << 17
#: Bytes of texts that are aligned at once.
PART_BYTES = 1 << 19
#: Marks a B id in a group's name.
B_SIDE = np.uint32(1 << 31)


def _bytes_of_symbols() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a character: printable Latin-1
    stands for itself, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(other)}


_FAR = re.compile("[^\\x00-\u024f]")
#: Fixed value: the published word pattern of byte-level vocabularies.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranked(described: dict, tokens: list[bytes]):
    """The same vocabulary as ranks, which encode several times faster; None
    unless its merges are in the order of their ids."""
    import tiktoken

    vocab = described["model"]["vocab"]
    ids = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in described["model"]["merges"]]
    if ids != sorted(ids) or described.get("normalizer") or len(ids) + 256 < len(vocab) - len(described["added_tokens"]):
        return None
    added = {x["id"] for x in described["added_tokens"]}
    return tiktoken.Encoding("ranked", pat_str=WORD_PATTERN, special_tokens={},
                             mergeable_ranks={tokens[i]: i for i in vocab.values() if i not in added})


class Vocabulary:
    """Ids and bytes of the tokens of a space and a text, for a byte-level
    ``.json`` vocabulary or a ``.model`` one (which adds the space itself)."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            from .token_counts import _pairs_inside

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda rows: model.encode(rows, num_threads=1)
            self.inside = _pairs_inside(model)
            self.tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                           for i in range(model.get_piece_size()) for p in [model.id_to_piece(i)]]
        else:
            from tokenizers import Tokenizer

            with open(path, encoding="utf-8") as f:
                described = json.load(f)
            splitter = described["pre_tokenizer"] or {}
            if splitter.get("type") != "ByteLevel" or not splitter.get("use_regex"):
                raise ValueError(f"{path}: a .json vocabulary must be byte-level with word splitting")
            hub = Tokenizer.from_file(path)
            hub.no_truncation()
            hub.no_padding()
            hub.encode_special_tokens = True
            self.inside = set()  # a word starts at every single space
            symbols = _bytes_of_symbols()
            names = hub.get_vocab(with_added_tokens=True)
            self.tokens = [b""] * (max(names.values()) + 1)
            for name, i in names.items():
                self.tokens[i] = bytes(symbols[c] for c in name) if all(c in symbols for c in name) else name.encode()
            quick = _ranked(described, self.tokens)

            def encode(rows: list[str]) -> list[list[int]]:
                rows = [" " + r for r in rows]
                if quick is None:
                    return [x.ids for x in hub.encode_batch_fast(rows, add_special_tokens=False)]
                # Beyond these letters the classes of the two libraries could differ.
                far = [i for i, r in enumerate(rows) if _FAR.search(r)]
                out = [None if _FAR.search(r) else quick.encode_ordinary(r) for r in rows] if far else [quick.encode_ordinary(r) for r in rows]
                for i, x in zip(far, hub.encode_batch_fast([rows[i] for i in far], add_special_tokens=False)):
                    out[i] = x.ids
                return out

            self.encode = encode
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)

    def segments(self, text: str, size: int, other: "Vocabulary") -> list[str]:
        """``text`` cut before single spaces that no token can hold inside; the
        space is left out, as each segment is encoded behind one."""
        out, begin, at = [], 0, size
        while at < len(text) - 1:
            at = text.find(" ", at, len(text) - 1)
            if at < 0:
                break
            x = text[at - 1]
            if at > begin and x.isalnum() and text[at + 1].isalnum() and x + "▁" not in self.inside and x + "▁" not in other.inside:
                out.append(text[begin:at])
                begin = at + 1
                at = begin + size
            else:
                at += 1
        return [*out, text[begin:]]


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One a Python worker; the file is on every executor."""
    return Vocabulary(path)


@functools.lru_cache(maxsize=4)
def identity_map(path_a: str, path_b: str) -> np.ndarray:
    """A id -> B id with the same bytes, or -1 (the smallest id of equal ones)."""
    ids: dict[bytes, int] = {}
    for i, t in enumerate(vocabulary(path_b).tokens):
        ids.setdefault(t, i)
    return np.array([ids.get(t, -1) if t else -1 for t in vocabulary(path_a).tokens], np.int64)


class Aligned(NamedTuple):
    """Links of two token sequences over the same bytes, in order."""

    a: np.ndarray       # place of the A token of each link
    b: np.ndarray       # place of the B token
    end: np.ndarray     # byte offset at which the link's overlap ends
    cut: np.ndarray     # the link is the last of its group
    last_a: np.ndarray  # of each A token: it is the last of its group
    last_b: np.ndarray


def aligned(size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    """Two overlapping byte ranges overlap in one stretch, so the stretches
    between neighbouring token ends of either side are the links."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    mark = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.uint8)
    mark[end_a] |= 1
    mark[end_b] |= 2
    end = np.flatnonzero(mark)
    kind = mark[end]
    in_a, in_b = kind & 1, kind >> 1
    return Aligned(np.cumsum(in_a, dtype=np.int64) - in_a, np.cumsum(in_b, dtype=np.int64) - in_b, end, kind == 3,
                   mark[end_a] == 3, mark[end_b] == 3)


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in rows], np.int64)
    return np.concatenate([np.zeros(0, np.uint32), *rows]).astype(np.int64), sizes


def _encoded(voc: Vocabulary, segments: list[list[str]]) -> list[list[int]]:
    """Ids of every text from those of its segments."""
    ids = iter(voc.encode([s for x in segments for s in x]))
    return [next(ids) if len(x) == 1 else list(chain.from_iterable(next(ids) for _ in x)) for x in segments]


def _spelled(raws: list[bytes], va: Vocabulary, vb: Vocabulary, segment: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, ids of A, ids of B) of every text that both sides spell.

    What the encoders return is many times larger than the text, so they get
    ``ENCODE_BYTES`` at a time (a longer text comes alone) and only plain id
    arrays are kept."""
    begin, total = 0, 0
    for end, raw in enumerate(raws):
        total += len(raw)
        if total < ENCODE_BYTES and end + 1 < len(raws):
            continue
        segments = [[t] if len(t) <= segment else va.segments(t, segment, vb)
                    for t in (x.decode("utf-8", "replace") for x in raws[begin : end + 1])]
        for k, (a, b) in enumerate(zip(_encoded(va, segments), _encoded(vb, segments)), begin):
            if b"".join(map(va.tokens.__getitem__, a)) == b" " + raws[k] == b"".join(map(vb.tokens.__getitem__, b)):
                yield k, np.array(a, np.uint32), np.array(b, np.uint32)
        begin, total = end + 1, 0


@functools.lru_cache(maxsize=2)
def _written(n: int) -> np.ndarray:
    """Every id in decimal digits before ``,``, ``|`` and ``;``."""
    out = np.empty(3 * n, object)
    for k, mark in enumerate(",|;"):
        out[k::3] = [f"{i}{mark}".encode() for i in range(n)]
    return out


class Block(NamedTuple):
    """What one call finds: columns of its documents, its dictionary of
    irregular groups (name, count) and the A ids of its regular ones."""

    docs: dict
    names: list[bytes]
    counts: np.ndarray
    regular: np.ndarray


def align_block(raws: list[bytes | None], path_a: str, path_b: str, segment: int = SEGMENT_CHARS) -> Block:
    """The texts are aligned ``PART_BYTES`` at a time, as the id and offset
    arrays take many times their size; all parts share one dictionary."""
    slots: dict[bytes, int] = {}
    parts, begin, total = [], 0, 0
    for end, raw in enumerate(raws):
        total += len(raw or b"")
        if total >= PART_BYTES or end + 1 == len(raws):
            parts.append(_align_part(raws[begin : end + 1], slots, path_a, path_b, segment))
            begin, total = end + 1, 0
    if not parts:
        parts = [_align_part([], slots, path_a, path_b, segment)]
    counts = np.zeros(len(slots), np.int64)
    for p in parts:
        counts[: len(p.counts)] += p.counts
    docs = {c: list(chain.from_iterable(p.docs[c] for p in parts)) if isinstance(v, list) else np.concatenate([p.docs[c] for p in parts])
            for c, v in parts[0].docs.items()}
    return Block(docs, list(slots), counts, np.concatenate([p.regular for p in parts]))


def _align_part(raws: list[bytes | None], slots: dict[bytes, int], path_a: str, path_b: str, segment: int) -> Block:
    """Adds its irregular groups to ``slots``; ``names`` stays empty."""
    va, vb, same = vocabulary(path_a), vocabulary(path_b), identity_map(path_a, path_b)
    n = len(raws)
    rows = [i for i, x in enumerate(raws) if x]
    spelled = list(_spelled([raws[i] for i in rows], va, vb, segment))
    at = np.array([rows[k] for k, _, _ in spelled], np.int64)
    a, n_a = _flat([ids for _, ids, _ in spelled])
    b, n_b = _flat([ids for _, _, ids in spelled])
    x = aligned(va.sizes[a], vb.sizes[b])
    doc = np.searchsorted(np.cumsum([1 + len(raws[i]) for i in at.tolist()]), x.end)
    group = np.cumsum(x.cut) - x.cut
    size = np.bincount(group, minlength=int(group[-1]) + 1 if len(group) else 0)
    single = size[group] == 1
    plain = single & (same[a[x.a]] == b[x.b]) if len(group) else single

    # All ids in the order of the groups, A's before B's.
    of_a, of_b = np.cumsum(x.last_a) - x.last_a, np.cumsum(x.last_b) - x.last_b
    before_a = np.concatenate(([0], np.cumsum(np.bincount(of_a, minlength=len(size)))))
    before_b = np.concatenate(([0], np.cumsum(np.bincount(of_b, minlength=len(size)))))
    place_a, place_b = np.arange(len(a)) + before_b[of_a], np.arange(len(b)) + before_a[of_b + 1]
    named = np.empty(len(a) + len(b), np.uint32)
    named[place_a] = a
    named[place_b] = b.astype(np.uint32) | B_SIDE
    shown = np.empty(len(named), np.int64)
    shown[place_a] = 3 * a + x.last_a
    shown[place_b] = 3 * b + 2 * x.last_b

    odd = np.flatnonzero(x.cut & ~plain)
    start = (before_a + before_b)[:-1][group[odd]]
    stop = (before_a + before_b)[1:][group[odd]]
    whole = named.tobytes()
    places = np.empty(len(odd), np.uint32)
    for k, (s, e) in enumerate(zip((4 * start).tolist(), (4 * stop).tolist())):
        places[k] = slots.setdefault(whole[s:e], len(slots))
    counts = np.bincount(places, minlength=len(slots)).astype(np.int64)

    def of_docs(values: np.ndarray) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[at] = values
        return out

    def split(values: np.ndarray, owner: np.ndarray) -> list[bytes]:
        out, to = [b""] * n, np.searchsorted(owner, np.arange(len(at) + 1))
        for k, i in enumerate(at.tolist()):
            out[i] = values[to[k] : to[k + 1]].tobytes()
        return out

    written = _written(max(len(va.tokens), len(vb.tokens)))
    digests = [""] * n
    to = np.concatenate(([0], np.cumsum(n_a + n_b)))
    for k, i in enumerate(at.tolist()):
        digests[i] = hashlib.sha256(b"".join(written[shown[to[k] : to[k + 1]]].tolist())[:-1]).hexdigest()
    regular = a[x.a[plain]]
    docs = {"n_a": of_docs(n_a), "n_b": of_docs(n_b),
            "n_groups": of_docs(np.bincount(doc[x.cut], minlength=len(at))),
            "n_links": of_docs(np.bincount(doc, minlength=len(at))), "groups_sha256": digests,
            "regular": split(regular.astype(np.uint32), doc[plain]), "odd": split(places, doc[odd])}
    return Block(docs, [], counts, regular)


_PARTS = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("regular", pa.binary()),
                    ("odd", pa.binary()), ("name", pa.binary()), ("slot", pa.int32()), ("pair", pa.int64()), ("n", pa.int64())])
_DOCUMENT, _GROUP, _REGULAR = 0, 1, 2


def _rows(kind: int, rows: int, /, **columns) -> pa.RecordBatch:
    columns["kind"] = np.full(rows, kind, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _PARTS],
                                      schema=_PARTS)


def _parts(docs: DataFrame, path_a: str, path_b: str, key: str) -> DataFrame:
    """Documents, block dictionaries and identity vectors, from one pass over
    the texts."""
    from pyspark.sql.pandas.types import from_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        block = TaskContext.get().partitionId() << 32
        same = identity_map(path_a, path_b)
        vector = np.zeros(len(same), np.int64)
        for batch in batches:
            for piece in _pieces(batch):
                found = align_block(piece.column(1).to_pylist(), path_a, path_b)
                vector += np.bincount(found.regular, minlength=len(vector))
                rows = piece.num_rows
                yield _rows(_DOCUMENT, rows, block=np.full(rows, block), doc_id=piece.column(0), **found.docs)
                k = len(found.names)
                yield _rows(_GROUP, k, block=np.full(k, block), name=found.names, slot=np.arange(k, dtype=np.int32), n=found.counts)
                block += 1
        used = np.flatnonzero(vector)
        yield _rows(_REGULAR, len(used), pair=(used << 32) | same[used], n=vector[used])

    ship(docs.sparkSession)
    return stored(texts(docs, key).mapInArrow(run, from_arrow_schema(_PARTS)))


def _links(groups: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(name, pair, n): a row for every link inside every distinct irregular
    group; a pair is A id * 2**32 + B id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = vocabulary(path_a), vocabulary(path_b)
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0).to_pylist()
            ids = np.frombuffer(b"".join(names), np.uint32)
            group = np.repeat(np.arange(len(names)), [len(x) // 4 for x in names])
            is_b = ids >= B_SIDE
            a, b = ids[~is_b].astype(np.int64), (ids[is_b] & ~B_SIDE).astype(np.int64)
            x = aligned(va.sizes[a], vb.sizes[b])
            owner = group[~is_b][x.a]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array((a[x.a] << 32) | b[x.b]),
                                              batch.column(1).take(pa.array(owner))], names=["name", "pair", "n"])

    return groups.select("name", "n").mapInArrow(run, "name binary, pair long, n long")


class Alignment(NamedTuple):
    """``documents``: a row of each document; ``pairs``: (a, b, n, best) of
    every linked id pair; ``groups``: (name, n) of every irregular group."""

    documents: DataFrame
    pairs: DataFrame
    groups: DataFrame


def alignment(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id") -> Alignment:
    """Aligns the two encodings of every row of ``docs``.

    ``documents`` has the key, n_a, n_b, n_groups, n_links, n_best (links whose
    pair has its B id's highest count, ties included), count_sum (the counts of
    its links added up) and groups_sha256."""
    spark = docs.sparkSession
    parts = _parts(docs, path_a, path_b, key)
    entries = parts.where(F.col("kind") == _GROUP).select("block", "slot", "name", "n")
    groups = entries.groupBy("name").agg(F.sum("n").alias("n"))
    links = stored(_links(groups, path_a, path_b))
    counts = (links.select("pair", "n", F.lit(0).alias("regular"))
              .unionByName(parts.where(F.col("kind") == _REGULAR).select("pair", "n", F.lit(1).alias("regular")))
              .groupBy("pair").agg(F.sum("n").alias("n"), F.max("regular").alias("regular"))
              .withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)))
    counts = stored(counts)
    # At most one row for each id of vocabulary B.
    highest = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("most")))
    pairs = counts.join(highest, "b").select("pair", "n", "regular", (F.col("n") == F.col("most")).cast("long").alias("best"))

    # The identity pairs: at most one for each id of vocabulary A.
    size = len(vocabulary(path_a).tokens)
    known = pairs.where(F.col("regular") == 1).select("pair", "n", "best").toArrow()
    total, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    ids = known.column("pair").to_numpy() >> 32
    total[ids], best[ids] = known.column("n").to_numpy(), known.column("best").to_numpy()
    identity = spark.sparkContext.broadcast((total, best))

    valued = (links.select("name", "pair").join(pairs.select("pair", "n", "best"), "pair")
              .groupBy("name").agg(F.sum("n").alias("total"), F.sum("best").alias("best")))
    values = (entries.select("block", "slot", "name").join(valued, "name")
              .select(F.col("block").alias("in_block"), "slot", "total", "best"))
    out = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def score(mine: pa.Table, groups: pa.Table) -> pa.Table:
        totals, bests = identity.value
        # Places of the dictionary that this block's documents point to.
        slot = groups.column("slot").to_numpy()
        of_total, of_best = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        of_total[slot], of_best[slot] = groups.column("total").to_numpy(), groups.column("best").to_numpy()
        hits, sums = [], []
        for regular, odd in zip(mine.column("regular").to_pylist(), mine.column("odd").to_pylist()):
            r, o = np.frombuffer(regular, np.uint32), np.frombuffer(odd, np.uint32)
            hits.append(int(bests[r].sum() + of_best[o].sum()))
            sums.append(int(totals[r].sum() + of_total[o].sum()))
        new = {"n_best": pa.array(hits, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        return pa.table({"doc_id": mine.column("doc_id"), **{c: new.get(c, mine.column(c) if c in mine.column_names else None) for c in out}})

    documents = (parts.where(F.col("kind") == _DOCUMENT)
                 .select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "regular", "odd")
                 .groupBy("block").cogroup(values.groupBy("in_block"))
                 .applyInArrow(score, "doc_id long, " + ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in out)))
    return Alignment(documents.withColumnRenamed("doc_id", key),
                     pairs.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n",
                                  (F.col("best") == 1).alias("best")), groups)
