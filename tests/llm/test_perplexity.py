import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortlens.llm.perplexity import Arrays, _windows, base_counts, fit, quality, scored

ORDER = 3


def brute_model(rows, order):
    """Modified Kneser-Ney probabilities by dictionaries of byte strings."""
    models = {}
    for lang in {r[2] or "" for r in rows}:
        top = Counter()
        for _, text, own in rows:
            if (own or "") == lang and text:
                b = b"\n" * (order - 1) + text.encode()
                top.update(b[i : i + order] for i in range(len(b) - order + 1))
        levels = {order: top}
        for k in range(order - 1, 0, -1):
            levels[k] = Counter(g[1:] for g in levels[k + 1])
        discounts = {}
        for k, counts in levels.items():
            n = Counter(counts.values())
            d = None
            if n[1] and n[2] and n[3]:
                y = n[1] / (n[1] + 2 * n[2])
                d = [i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)]
                if not all(0 < x <= i for i, x in enumerate(d, 1)):
                    d = None
            discounts[k] = d or [0.5, 1.0, 1.5]
        after = {k: defaultdict(list) for k in levels}
        for k, counts in levels.items():
            for g, c in counts.items():
                after[k][g[:-1]].append(c)
        models[lang] = levels, discounts, after

    def p(lang, g):
        if not g:
            return 1 / 256
        if lang not in models:
            return p(lang, g[1:])
        levels, discounts, after = models[lang]
        own = after[len(g)].get(g[:-1])
        if not own:
            return p(lang, g[1:])
        d = discounts[len(g)]
        total = sum(own)
        rest = sum(d[min(c, 3) - 1] for c in own) / total
        c = levels[len(g)].get(g, 0)
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / total + rest * p(lang, g[1:])

    return p


def brute_bits(p, lang, text, order):
    b = b"\n" * (order - 1) + (text or "").encode()
    return sum(-math.log2(p(lang or "", b[i : i + order])) for i in range(len(b) - order + 1))


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    where = defaultdict(list)
    for i in range(len(words) - 2):
        where[tuple(words[i : i + 3])].append(i)
    covered = {i + j for at in where.values() if len(at) > 1 for i in at for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def sample():
    r = random.Random(4)
    words = {"en": "the of and thing where some nation ertion able".split(), "de": "der die und größe straße über keit".split(), None: ["x", "yy"]}
    rows = []
    for i in range(160):
        lang = r.choice(["en", "en", "de", None])
        rows.append((i % 150, " ".join(r.choice(words[lang]) for _ in range(r.randrange(30, 140))) + r.choice(["", ".\n", "\n\nthe same line\nthe same line"]), lang))
    rows += [(500, None, "en"), (501, "", "de"), (None, "a b c a b c", "en"), (502, "# $ | <b>&", None), (503, "qzj xkw " * 40, "en"),
             (504, "".join(chr(r.randrange(0x4E00, 0x9000)) + " " for _ in range(90)), "en"), (505, "one word", "fr"), (505, "one word", "fr")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1.0, "k") for r in rows], "doc_id long, text string, lang string, bits double, gram string")


def test_base_counts_equal_plain_python():
    texts = [r[1] for r in sample()] + ["a\x0bb\x0cc d   e", "\r\n x \r\n x \r\n", "a a a a", "ab cd ef ab cd", "é ß 漢 " * 5, "\n \n \n"]
    got = base_counts([(t or "").encode() for t in texts])
    assert list(zip(*got.values())) == [brute_base(t) for t in texts]


@pytest.mark.parametrize("array_rows", [10**6, 0])
def test_bits_equal_brute_force(spark, array_rows):
    rows = sample()
    model = fit(frame(spark, rows), ORDER)
    p = brute_model(rows, ORDER)
    # Texts that the model has not seen, and a language that it does not know.
    asked = rows + [(900, "quite new: Ωmega 123", "en"), (901, "neu", "de"), (902, "other", "xx")]
    got = sorted(((r.doc_id is None, r.doc_id, r.lang, r.n_bytes, r.bits) for r in scored(frame(spark, asked), model, array_rows=array_rows).collect()), key=repr)
    want = sorted(((i is None, i, lang or "", len((t or "").encode()), brute_bits(p, lang, t, ORDER)) for i, t, lang in asked), key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], rel=1e-9)


def test_probabilities_add_up_to_one(spark):
    rows = sample()
    arrays = Arrays(fit(frame(spark, rows), ORDER))
    for context in (b"th", b"\n\n", b"zz", b"r "):
        grams = np.array([(context[0] << 16) | (context[1] << 8) | b for b in range(256)], np.int64)
        assert arrays.probability("en", grams).sum() == pytest.approx(1.0)


def test_bands_reject_the_strange_and_the_too_predictable(spark):
    rows = [r for r in sample() if r[2] == "en"] + [(600, "the " + "thing of " * 3 + "nnnnnn " * 1 + "e" * 3000 + " w" * 60, "en")]
    r = random.Random(9)
    rows += [(700 + i, " ".join("".join(r.choice("qxzjkvw") for _ in range(6)) for _ in range(60)), "en") for i in range(2)]
    out = {x.doc_id: x for x in quality(frame(spark, rows)).collect()}
    assert out[700].too_high and not out[700].kept and not out[700].base_failed
    assert out[600].too_low and not out[600].kept
    good = [x for i, x in out.items() if i is not None and i < 150 and not x.base_failed]
    assert sum(x.kept for x in good) >= 0.95 * len(good)
    assert all(x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words) for x in out.values())


def test_long_texts_come_in_blocks():
    text = random.Random(1).randbytes(5000)
    whole = [g for g, _, _ in _windows([b"ab", text], 4)]
    cut = [g for g, _, _ in _windows([b"ab", text], 4, block=300)]
    assert np.array_equal(np.concatenate(whole), np.concatenate(cut)) and len(cut) > 10


def test_empty_table(spark):
    assert quality(frame(spark, sample()).limit(0)).collect() == []


def test_query_columns(spark):
    out = quality(frame(spark, sample()))
    assert len(out.collect()) == len(sample())
    assert {f.name: f.dataType.simpleString() for f in out.schema}["kept"] == "boolean"
