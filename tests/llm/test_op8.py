import random

from tidemark.llm import op8_preference as P


def test_prompt_once_and_masked_completions(spark):
    rows = [(0, True, 0, "user", "q"), (0, True, 1, "assistant", "good"), (0, True, 2, "user", "more"), (0, False, 0, "user", "q"), (0, False, 1, "assistant", "bad")]
    out = P.format_preferences(spark.createDataFrame([(*r, "z") for r in rows], "pair_id long, chosen boolean, turn long, role string, text string, segment string")).collect()
    assert sorted((r.part, r.turn, r.segment[r.mask_start:r.mask_end]) for r in out) == [
        ("chosen", 1, "good<|im_end|>"), ("chosen", 2, ""), ("prompt", 0, ""), ("rejected", 1, "bad<|im_end|>")]
    assert [r.segment for r in out if r.part == "prompt"] == ["<|im_start|>user\nq<|im_end|>\n"]


def test_random_conversations_against_a_walk(spark):
    r = random.Random(6)
    pairs, rows = {}, []
    for p in range(120):
        both = [(r.choice(["user", "assistant", None]), r.choice(["a", "b", None, ""])) for _ in range(r.randrange(0, 6))]
        sides = []
        for side in (True, False):
            own = both[:r.randrange(len(both) + 1)] + [(r.choice(["user", "assistant"]), r.choice("abc")) for _ in range(r.randrange(0, 4))]
            sides.append(own)
            rows += [(p, side, t, *x) for t, x in enumerate(own)] * r.choice([1, 1, 2])
        pairs[p] = sides
    r.shuffle(rows)
    out = P.format_preferences(spark.createDataFrame(rows, "pair_id long, chosen boolean, turn long, role string, text string").repartition(5)).collect()
    for p, sides in pairs.items():
        own = [x for x in out if x.pair_id == p]
        show = lambda part: [x.segment for x in sorted((x for x in own if x.part == part), key=lambda x: x.turn)]
        chosen, rejected = ([f"{P.BEGIN}{a or ''}\n{b or ''}{P.END}\n" for a, b in s] for s in sides)
        if not chosen or not rejected:
            assert show("unpaired") == chosen + rejected and len(own) == len(chosen + rejected)
            continue
        n = next((i for i, (x, y) in enumerate(zip(chosen, rejected)) if x != y), min(len(chosen), len(rejected)))
        assert (show("prompt"), show("chosen"), show("rejected")) == (chosen[:n], chosen[n:], rejected[n:])


def test_nulls_and_empty(spark):
    schema = "pair_id long, chosen boolean, turn long, role string, text string"
    assert P.format_preferences(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, True, 0, "user", "a"), (None, False, 0, "user", "b"), (1, None, 0, "user", "c"), (2, True, None, "user", "d"), (2, False, None, "user", "d"), (2, False, 1, "assistant", "x" * 100_000)]
    out = P.format_preferences(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.pair_id), r.part) for r in out) == [("1", "unpaired"), ("2", "prompt"), ("2", "rejected"), ("None", "unpaired"), ("None", "unpaired")]


def test_swapped_replies_share_their_prompt(spark):
    r = random.Random(8)
    convs = {c: [(t, r.choice(["user", "assistant", "system"]), r.choice(["a", "b", None, ""]) if t else "q") for t in range(r.randrange(1, 6))] for c in range(60) if c % 7}
    convs[100] = [(None, "user", "n"), (0, "user", "q"), (1, "assistant", "x" * 50_000), (2, "user", "bye")]
    convs[101] = [(0, "assistant", "y")]
    rows = [(c, *x) for c, turns in convs.items() for x in turns] + [(None, 0, "assistant", "z")]
    both = P.with_swapped_replies(spark.createDataFrame(rows + rows[:20], "conv_id long, turn long, role string, text string"))
    out = P.format_preferences(both, rejected_col="rejected").collect()
    last = {c: [x for x in turns if x[1] == "assistant"][-1] for c, turns in convs.items() if any(x[1] == "assistant" for x in turns)}
    first = lambda x: -1 if x.turn is None else x.turn
    whole = lambda turns: [f"{P.BEGIN}{b}\n{t or ''}{P.END}\n" for _, b, t in turns]
    for c, turns in convs.items():
        own = sorted((x for x in out if x.pair_id == c), key=first)
        show = lambda *parts: [x.segment for x in own if x.part in parts]  # noqa: E731,B023
        if c not in last or c ^ 1 not in last:
            assert show("unpaired") == whole(turns)
            continue
        at = turns.index(last[c])
        assert show("prompt", "chosen") == whole(turns)
        assert show("prompt", "rejected") == whole([*turns[:at], (at, "assistant", last[c ^ 1][2])])
        same = (last[c][2] or "") == (last[c ^ 1][2] or "")
        assert len(show("prompt")) == at + same
    assert [x.part for x in out if x.pair_id is None] == ["unpaired"]


def test_registered_query_renders_prompts(spark):
    parts = {r.part: r.n for r in P.op8(spark, "/root/testdata/sf0.001").groupBy("part").agg({"*": "count"}).toDF("part", "n").collect()}
    assert parts["prompt"] > 0 and parts["chosen"] > 0 and parts["rejected"] > 0
