import itertools
import random

import numpy as np
import pytest

from aerolake.llm import chat_format as cf


def legal(roles):
    if roles and roles[0] == cf.SYSTEM:
        roles = roles[1:]
    return len(roles) % 2 == 0 and bool(roles) and all(r == (cf.USER, cf.ASSISTANT)[i % 2] for i, r in enumerate(roles))


def brute(roles):
    """Cheapest cost over all choices: for every turn a merge or one of three roles, and
    up to two inserted turns before each and at the end."""
    fills = [f for n in range(3) for f in itertools.product((cf.SYSTEM, cf.USER, cf.ASSISTANT), repeat=n)]
    best, todo = float("inf"), [((), 0.0, 0)]
    while todo:
        done, cost, i = todo.pop()
        if cost >= best:
            continue
        if i == len(roles):
            for fill in fills:
                if legal([*done, *fill]):
                    best = min(best, cost + cf.INSERT * len(fill))
            continue
        role = cf._number(roles[i])
        for fill in fills:
            state = [*done, *fill]
            if state:
                todo.append((tuple(state), cost + cf.INSERT * len(fill) + (cf.MERGE if state[-1] == role else cf.MERGE_OTHER), i + 1))
            for new in (cf.SYSTEM, cf.USER, cf.ASSISTANT):
                step = cf.KEEP if new == role else cf.RELABEL_UNKNOWN if role is None else cf.RELABEL
                todo.append(((*state, new), cost + cf.INSERT * len(fill) + step, i + 1))
    return best


@pytest.mark.parametrize("roles", [list(r) for n in (1, 2, 3) for r in itertools.product(("system", "user", "assistant", "?"), repeat=n)][::3])
def test_cost_is_the_cheapest(roles):
    fixed = cf.repair(roles)
    assert sum(cost for *_, cost in fixed) == brute(roles)
    assert legal([r for _, action, r, _ in fixed if action != "merge"])
    assert [i for i, *_ in fixed if i is not None] == list(range(len(roles)))


def test_matrices_compose():
    rng = random.Random(4)
    roles = [rng.choice(["system", "user", "assistant", None]) for _ in range(30)]
    a, b = cf.matrix_of(roles[:11]), cf.matrix_of(roles[11:])
    assert np.array_equal(cf.composed(a, b), cf.matrix_of(roles))


TURNS = "conv_id long, turn long, role string, text string, chunk string"


def rendered(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.conv_id), r.chunk, r.seq)):
        out[r.conv_id] = out.get(r.conv_id, "") + r.piece
    return out


def test_repairs(spark):
    rows = [(1, 0, "user", "a", "x"), (1, 1, "assistant", "b", "x"),
            (2, 0, "assistant", "b", "x"),
            (3, 5, "user", "one", "x"), (3, 7, "user", "two", "x"), (3, 9, " Assistant ", None, "x"),
            (4, 0, None, "who", "x"), (4, 1, "assistant", "b", "x"),
            (5, None, "assistant", "late", "x"), (5, 0, "user", "a", "x"), (5, 0, "user", "a", "x"),
            (None, 0, "user", "", "x"), (None, 1, "assistant", "ok", "x")]
    got = rendered(cf.repair_chats(spark.createDataFrame(rows, TURNS).repartition(3)))
    assert got[1] == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n"
    assert got[2] == "<|user|>\n<|end|>\n<|assistant|>\nb<|end|>\n"
    assert got[3] == "<|user|>\none\n\ntwo<|end|>\n<|assistant|>\n<|end|>\n"
    assert got[4] == "<|user|>\nwho<|end|>\n<|assistant|>\nb<|end|>\n"
    assert got[5] == "<|user|>\na<|end|>\n<|assistant|>\nlate<|end|>\n"
    assert got[None] == "<|user|>\n<|end|>\n<|assistant|>\nok<|end|>\n"


def test_chunks_repair_like_the_whole(spark):
    rng = random.Random(5)
    rows = []
    for conv, n in ((1, 90), (2, 3), (3, 41), (4, 1)):
        rows += [(conv, t, rng.choice(["user", "assistant", "assistant", "system", "tool"]), f"t{t}", "x") for t in range(n)]
    rows.append((3, None, "user", "no number", "x"))
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    whole = cf.repair_chats(df).groupBy("conv_id").sum("cost").collect()
    cut = cf.repair_chats(df, chunk_turns=8)
    assert sorted(cut.groupBy("conv_id").sum("cost").collect()) == sorted(whole)
    for conv, text in rendered(cut).items():
        roles = [cf.ROLES.index(part.split("|>")[0]) + 1 for part in text.split("<|")[1:] if not part.startswith("end")]
        assert legal(roles) and text.endswith("<|end|>\n") and text.count("<|end|>") == len(roles)
        for c, _, _, t, _ in rows:
            if c == conv:
                assert text.count(t) >= 1


@pytest.mark.parametrize("chunk_turns,fan", [(1, 2), (2, 3), (3, 1024), (7, 2)])
def test_rows_do_not_depend_on_the_chunks(spark, chunk_turns, fan):
    """Also where repairs cost the same."""
    rng = random.Random(chunk_turns)
    roles = ["user", "assistant", "system", "tool", None]
    rows = [(conv, t, rng.choice(roles), f"t{t}", "x") for conv in range(150) for t in range(rng.randint(1, 14))]
    rows += [(1000, t, r, "", "x") for t, r in enumerate(["tool", "system", "assistant", "tool", "system", "tool", None, "system"])]
    df = spark.createDataFrame(rows, TURNS).repartition(4)

    def steps(found):
        out = {}
        for r in sorted(found.collect(), key=lambda r: (r.conv_id, r.chunk, r.seq)):
            out.setdefault(r.conv_id, []).append((r.turn, r.role_in, r.action, r.role, r.cost, r.piece))
        return out
    assert steps(cf.repair_chats(df, chunk_turns, fan)) == steps(cf.repair_chats(df))


def test_null_conversation_of_several_chunks(spark):
    rng = random.Random(6)
    roles = [rng.choice(["user", "assistant", "system", "tool"]) for _ in range(50)]
    rows = [(None, t, r, f"t{t}", "x") for t, r in enumerate(roles)] + [(None, None, "user", "no number", "x")]
    rows += [(1, t, r, text, c) for _, t, r, text, c in rows]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    cost = {r[0]: r[1] for r in cf.repair_chats(df, chunk_turns=8).groupBy("conv_id").sum("cost").collect()}
    least = sum(cost for *_, cost in cf.repair([*roles, "user"]))
    assert cost == {None: least, 1: least}
    got = rendered(cf.repair_chats(df, chunk_turns=8))
    assert got[None] == got[1]
    # One null turn beside numbered ones, in chunks of the default size.
    few = spark.createDataFrame([(None, 0, "user", "a", "x"), (None, None, "assistant", "b", "x")], TURNS)
    assert rendered(cf.repair_chats(few)) == {None: "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n"}


@pytest.mark.parametrize("number", [lambda i: i % 8, lambda i: None, lambda i: 10 ** 6 * i])
def test_chunks_are_cut_by_place(spark, number):
    """Repeated, null or far numbers: no chunk has more turns than the bound, and the
    chunks, joined up in levels, cost what the whole does."""
    rng = random.Random(8)
    rows = [(conv, number(i), rng.choice(["user", "assistant", "system", "tool"]), f"t{i:03}", "x")
            for conv, n in ((None, 300), (1, 140), (2, 5)) for i in range(n)]
    df = spark.createDataFrame(rows + rows[:9], TURNS).repartition(4)
    got = sorted(cf.repair_chats(df, chunk_turns=8, fan=3).collect(), key=lambda r: (str(r.conv_id), r.chunk, r.seq))
    for conv in (None, 1, 2):
        mine = [r for r in got if r.conv_id == conv]
        ordered = sorted((t if t is not None else 10 ** 9, r, x) for c, t, r, x, _ in rows if c == conv)
        places = [r.chunk for r in mine if r.role_in is not None]
        assert places == [i // 8 for i in range(len(ordered))]
        assert [r.role_in for r in mine if r.role_in is not None] == [r for _, r, _ in ordered]
        assert sum(r.cost for r in mine) == sum(cost for *_, cost in cf.repair([r for _, r, _ in ordered]))
        text = "".join(r.piece for r in mine)
        roles = [cf.ROLES.index(p.split("|>")[0]) + 1 for p in text.split("<|")[1:] if not p.startswith("end")]
        assert legal(roles) and text.endswith("<|end|>\n") and text.count("<|end|>") == len(roles)


def test_empty(spark):
    assert cf.repair_chats(spark.createDataFrame([], TURNS)).collect() == []
