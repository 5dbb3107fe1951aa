from pyspark.sql import functions as F

from crosslink.llm import preference as P


def text(turns):
    return "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns)


def test_pairs(spark):
    convs = {
        0: [("user", "q"), ("assistant", "a"), ("user", "more"), ("assistant", "yes")],
        1: [("user", "q"), ("assistant", "a"), ("user", "else"), ("assistant", "no"), ("assistant", "")],
        2: [("user", "same")], 3: [("user", "same")],
        4: [("user", "alone"), ("assistant", None)],
        7: [(None, "x"), ("assistant", "left out")],
        8: [("user", "q"), ("assistant", "a")], 9: [("user", "q"), ("assistant", "a"), ("user", "é" * 5000), ("assistant", "long")],
    }
    rows = [(i, n, r, t, 5) for i, c in convs.items() for n, (r, t) in reversed(list(enumerate(c)))] + [(None, 0, "user", "lost", 5)]
    got = {r.pair_id: r for r in P.format_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pair_id int")).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    for p, r in got.items():
        c, j = convs.get(2 * p), convs.get(2 * p + 1)
        n = 0
        while c and j and n < min(len(c), len(j)) and c[n] == j[n]:
            n += 1
        assert r.shared_turns == n and r.prompt == text((c or j)[:n])
        for side, whole, mask in ((c, r.chosen, r.chosen_mask), (j, r.rejected, r.rejected_mask)):
            if side is None:
                assert whole is None and mask is None
                continue
            assert whole == text(side[n:])
            spans = [whole[slice(*map(int, s.split("-")))] for s in mask.split(",") if s]
            assert spans == [f"{t or ''}<|im_end|>\n" for role, t in side[n:] if role == "assistant"]


def test_many_on_a_side(spark):
    rows = [(i, 0, "user", "q", i % 2 == 0) for i in range(5)] + [(i, 1, "assistant", f"a{i}", i % 2 == 0) for i in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, good boolean")
    got = P.format_pairs(df, F.lit(7).cast("long"), F.col("good")).collect()
    assert len(got) == 3 and sum(r.shared_turns for r in got) == 2 and {r.chosen is None for r in got} == {False}


def test_empty(spark):
    assert P.format_pairs(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_exchanged_answers(spark):
    convs = {
        0: [("system", "s"), ("user", "q"), ("assistant", "a"), ("user", "more"), ("assistant", "yes")],
        1: [("user", "q"), ("assistant", "no"), ("user", "bye")],
        2: [("user", "no answer")], 3: [("assistant", "answers")],
        4: [("user", "no partner"), ("assistant", None)],
        2**60 + 2: [("assistant", "x")], 2**60 + 3: [("assistant", "y")], 2**60 + 4: [("user", "z"), ("assistant", "w")],
    }
    rows = [(i, n, r, t) for i, c in convs.items() for n, (r, t) in reversed(list(enumerate(c)))] + [(None, 0, "user", "lost")]
    got = {r.pair_id: r for r in P.format_exchanged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    last = lambda c: max((i for i, t in enumerate(c) if t[0] == "assistant"), default=None)
    assert got.keys() == convs.keys()
    for i, c in convs.items():
        k, other = last(c), convs.get(i ^ 1, [])
        j = list(c)
        if k is not None:
            j[k] = ("assistant", other[last(other)][1] if last(other) is not None else "")
        n = next((x for x in range(len(c)) if (c[x][1] or "") != (j[x][1] or "")), len(c))
        r = got[i]
        assert (r.shared_turns, r.prompt, r.chosen, r.rejected) == (n, text(c[:n]), text(c[n:]), text(j[n:]))
    assert got[0].prompt and got[0].rejected == text([("assistant", "no")])


def test_large_ids_stay_pairs(spark):
    big = 2**60 + 2
    rows = [(big + i, 0, "user", f"t{i}") for i in range(4)]
    got = P.format_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.pair_id for r in got} == {big // 2, big // 2 + 1} and all(r.chosen and r.rejected for r in got)


def test_most_prompts_of_the_table_are_shared(spark, sf_dir):
    from crosslink.llm.queries import op8_preference

    rows = op8_preference(spark, sf_dir).collect()
    assert sum(bool(r.prompt) for r in rows) > 0.9 * len(rows)
