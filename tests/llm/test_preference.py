from cohortlens.llm.preference import conversations, neighbour_pairs, opening_pairs, preferences

SCHEMA = "conv_id long, turn long, role string, text string, chosen string, prompt long"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)  # extra columns with clashing names


def rendered(ts):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in ts)


def brute(good, bad):
    n = 0
    while bad is not None and n < min(len(good), len(bad)) and good[n] == bad[n]:
        n += 1
    return n, rendered(good[:n]), rendered(good[n:]), None if bad is None else rendered(bad[n:])


def test_pairs_against_brute_force(spark):
    u, a = "user", "assistant"
    convs = {
        1: [(u, "hi"), (a, "yes"), (u, "so"), (a, "1")], 2: [(u, "hi"), (a, "yes"), (u, "so"), (a, "two \u00e9")],
        3: [(u, "hi")], 4: [(u, "hi"), (a, "")], 5: [(a, "x")], 6: [(u, "x")], 7: [(u, "hi"), (a, "yes")], 8: [(u, "hi"), (a, "yes")]}
    rows = [(c, i, r, t) for c, ts in convs.items() for i, (r, t) in enumerate(ts)]
    df = turns(spark, rows + [(None, 0, u, "lost"), (9, 0, None, None)])
    pairs = spark.createDataFrame([(1, 1, 2), (2, 3, 4), (3, 5, 6), (4, 7, 8), (5, 9, None)], "pair_id long, chosen long, rejected long")
    got = {r.pair_id: r for r in preferences(df, pairs).collect()}
    convs[9] = [(u, "")]
    for pid, c, d in [(1, 1, 2), (2, 3, 4), (3, 5, 6), (4, 7, 8), (5, 9, None)]:
        r = got[pid]
        assert (r.n_prompt_turns, r.prompt, r.chosen, r.rejected) == brute(convs[c], convs.get(d)), pid
        trained = [t for role, t in convs[c][r.n_prompt_turns:] if role == a]
        assert [r.chosen[s.start:s.end] for s in r.chosen_spans] == trained
    assert got[1].rejected[got[1].rejected_spans[0].start:got[1].rejected_spans[0].end] == "two \u00e9"
    assert got[5].rejected is None and got[5].rejected_spans is None


def test_neighbours_that_open_alike_are_paired(spark):
    rows = [(c, 0, "system", "same" if c % 3 else f"own {c}") for c in range(130)] + [(c, 1, "user", str(c)) for c in range(130)]
    df = turns(spark, rows + [(7, 1, "user", "7")])  # a repeated row is a repeated turn
    convs = conversations(df)
    assert len([r for r in convs.where("conv_id = 7").first().turns]) == 3
    pairs = neighbour_pairs(convs).collect()
    ids = [x for p in pairs for x in (p.chosen, p.rejected) if x is not None]
    assert sorted(ids) == list(range(130))
    alike = sum(p.rejected is not None and p.chosen % 3 > 0 and p.rejected % 3 > 0 for p in pairs)
    assert alike >= 40  # of 86 conversations with the same opening
    assert preferences(df, neighbour_pairs(convs).limit(0)).collect() == []
    empty = df.limit(0)
    assert preferences(empty, neighbour_pairs(conversations(empty))).collect() == []


def test_same_prompts_far_apart_are_paired(spark):
    u, a, s = "user", "assistant", "system"
    convs = {c: [(s, "common"), (u, f"own {c}"), (a, "x")] for c in range(100, 400)}  # a hot first turn
    convs |= {c: [(s, "common"), (u, "asked twice"), (a, str(c))] for c in (105, 390)}
    convs |= {c: [(u, "far"), (a, str(c))] for c in (3, 70_000)}
    convs |= {c: [(u, f"alone {c}")] for c in (5, 6, 2_000_000)}
    df = turns(spark, [(c, i, r, t) for c, ts in convs.items() for i, (r, t) in enumerate(ts)])
    own = conversations(df)
    pairs = opening_pairs(own).collect()
    assert sorted(x for p in pairs for x in (p.chosen, p.rejected) if x is not None) == sorted(convs)
    got = {(p.chosen, p.rejected) for p in pairs}
    assert {(105, 390), (3, 70_000), (5, 6), (2_000_000, None)} <= got
    assert sum(c in range(100, 400) and r in range(100, 400) for c, r in got) == 150  # blocks alone leave an odd one each
    rows = {r.pair_id: r for r in preferences(df, opening_pairs(own)).collect()}
    assert rows[105].n_prompt_turns == 2 and rows[3].n_prompt_turns == 1
    alone = own.where("conv_id in (5, 6, 2000000)")
    assert sorted(map(tuple, opening_pairs(alone).collect())) == sorted(map(tuple, neighbour_pairs(alone).collect()))
    assert opening_pairs(own.limit(0)).collect() == []
