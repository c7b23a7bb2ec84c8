import random
import re
from collections import defaultdict

from cohortlens.llm.templates import UNITS, contaminated, uncontaminated

ITEM = ("Tom has 3 apples and Mary has 12 apples. How many apples do Tom and Mary have together after Tom walks 5 km "
        "to the old market and gives 2 apples to the farmer?")
OTHER = "The train from Berlin leaves at 8 and needs 4 hours to reach the city where the second train departs each day at noon"


def test_leaks_and_parameters(spark):
    new = ITEM.replace("Tom", "Anna").replace("Mary", "Ben").replace(" 3 ", " 7 ").replace("12", "15").replace("5 km", "9 km")
    mixed = ITEM.replace("How many apples do Tom", "How many apples do Zoe").replace("after Tom walks", "after Eve walks")
    docs = [
        (1, "Intro text here. " + ITEM + " And some more."), (2, new), (3, ITEM.lower()), (4, ITEM.upper()),
        (5, "A text about markets and farmers without any question in it, but with apples and 5 km of road."),
        (6, " ".join(w for i, w in enumerate(ITEM.split()) if i < 6)), (7, None), (8, ""), (9, OTHER + ". " + new),
        (10, "Aaa Bbb Ccc Ddd Eee Fff Ggg Hhh Iii Jjj Kkk Lll 1 2 3 4 5 6 7 8 9 " * 20), (11, mixed)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs] + [(1, docs[0][1], 1, "x"), (None, ITEM, 1, "x")],
                               "doc_id long, text string, item_id int, h string")
    bench = spark.createDataFrame([(100, ITEM), (200, OTHER), (300, "Tom 3"), (400, None), (200, OTHER), (None, ITEM)],
                                  "item_id long, text string")
    for limit in (200_000, 0):  # with the broadcast filter, and all windows joined
        rows = contaminated(df, bench, broadcast_windows=limit).collect()
        got = {(r.doc_id, r.item_id): r for r in rows}
        assert len(rows) == len(got)
        assert set(got) >= {(1, 100), (2, 100), (3, 100), (4, 100), (9, 100), (9, 200)}
        assert {5, 6, 7, 8, 10}.isdisjoint(d for d, _ in got)
        assert got[2, 100].n_changed_slots > 0 == got[1, 100].n_changed_slots
        assert got[1, 100].n_matched == got[1, 100].n_windows
        # the same name stands for two others: the alignment of its template is not consistent
        assert (11, 100) not in got or got[11, 100].n_matched < got[2, 100].n_matched
    left = [r.doc_id for r in uncontaminated(df, bench).collect()]
    assert sorted(x for x in left if x) == sorted({5, 6, 7, 8, 10} | ({11} if (11, 100) not in got else set()))


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert contaminated(df.limit(0), bench).collect() == []
    assert contaminated(df, bench.limit(0)).collect() == []
    assert uncontaminated(df, bench.limit(0)).count() == 1


def parts(text):
    """[(value, kind)] with the kinds w(ord), name, number, unit."""
    out = []
    for t in re.findall(r"(?:[A-Za-z0-9]|(?<=[0-9])[.,](?=[0-9]))+", text):
        kind = "number" if t[0].isdigit() else "name" if t[0].isupper() else "w"
        if kind == "w" and t in UNITS.split() and out and out[-1][1] == "number":
            kind = "unit"
        out.append((t.lower(), kind))
    return out


def windows(tokens, length):
    for at in range(len(tokens) - length + 1):
        own = tokens[at : at + length]
        if sum(k == "w" for _, k in own) >= 4:
            yield at, True, tuple(v if k == "w" else (k,) for v, k in own), [x for x in own if x[1] != "w"]
        yield at, False, tuple(v for v, _ in own), []


def brute(docs, items):
    """Every window of every document against every window of every item."""
    own = {i: parts(t) for i, t in items}
    sizes = {i: min(8, len(t)) for i, t in own.items() if len(t) >= 4}
    out = {}
    for d, text in docs:
        tokens = parts(text)
        for i, size in sizes.items():
            runs = defaultdict(list)
            for at, typed, form, slots in windows(tokens, size):
                for iat, ityped, iform, islots in windows(own[i], size):
                    if typed == ityped and form == iform:
                        runs[at - iat, typed].append((iat, list(zip(slots, islots))))
            matched, changed = set(), 0
            for found in runs.values():
                image = defaultdict(set)
                for _, slots in found:
                    for (v, k), (w, _) in slots:
                        image[k, w].add(v)
                names = {w: v for (k, w), v in image.items() if k == "name"}
                if any(len(v) > 1 for v in image.values()) or len(set(map(frozenset, names.values()))) < len(names):
                    continue
                matched |= {iat for iat, _ in found}
                changed = max(changed, sum(v != {w} for (_, w), v in image.items()))
            n = len(own[i]) - size + 1
            if matched and len(matched) >= min(0.4 * n, 6):
                out[d, i] = (n, len(matched), changed)
    return out


def test_against_all_windows(spark):
    r = random.Random(4)
    words, names = "has some old new apples gives takes to and from the market farmer".split(), ["Tom", "Mary", "Zoe", "Ben"]

    def line(n):
        return " ".join(r.choice([r.choice(words), r.choice(words), r.choice(names), f"{r.randrange(1, 40)} km", str(r.randrange(5))]) for _ in range(n))

    items = [(i, line(r.choice([3, 5, 7, 9, 14, 25]))) for i in range(25)]
    docs = []
    for d in range(120):
        text = r.choice(items)[1]
        if d % 3 == 1:  # other names and numbers, mostly one for one
            for x in names:
                text = text.replace(x, r.choice(["Ann", "Eve", "Pia", "Joe", x]))
            text = re.sub(r"\d+", lambda m: str(int(m[0]) + r.choice([5, 5, 5, 6])), text)
        if d % 3 == 2:  # a part of it, in capitals or not
            text = " ".join(text.split()[: r.randrange(1, 25)])
            text = r.choice([text, text.upper(), text.lower()])
        docs.append((d, f"{line(r.randrange(12))}. {text}, {line(r.randrange(12))}"))
    want = brute(docs, items)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (200_000, 0):
        rows = contaminated(df, bench, broadcast_windows=limit).collect()
        assert {(x.doc_id, x.item_id): (x.n_windows, x.n_matched, x.n_changed_slots) for x in rows} == want
    assert len(want) > 60 and any(c for *_, c in want.values())


def test_ties_and_repeats(spark):
    df = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, ITEM + " " + ITEM)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, ITEM), (6, ITEM), (6, ITEM)], "item_id long, text string")
    rows = contaminated(df, bench).collect()
    assert sorted((x.doc_id, x.item_id) for x in rows) == [(1, 5), (1, 6), (2, 5), (2, 6)]
    assert len({(x.n_windows, x.n_matched, x.n_changed_slots) for x in rows}) == 1
