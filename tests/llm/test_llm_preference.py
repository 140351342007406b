from ledgerline.llm import preference as P


def rendered(turns):
    safe = lambda s: (s or "").replace("<|", "< |")
    text, mask = "", []
    for role, t in turns:
        start = len(text) + len(f"<|{safe(role)}|>\n")
        text += f"<|{safe(role)}|>\n{safe(t)}<|end|>\n"
        if role == "assistant":
            mask.append(f"{start}:{len(text) - 1}")
    return text, ",".join(mask)


def brute(c, r):
    c, r = c or [], r or []
    n = 0
    while n < min(len(c), len(r)) and all((x or "") == (y or "") for x, y in zip(c[n], r[n])):
        n += 1
    return (n, rendered(c[:n])[0], rendered(c[n:])[0], rendered(r[n:])[0], rendered(c[n:])[1], rendered(r[n:])[1])


U, A, S = "user", "assistant", "system"
PAIRS = [
    ([(S, "be kind"), (U, "hi"), (A, "yes")], [(S, "be kind"), (U, "hi"), (A, "no")]),
    ([(U, "hi"), (A, "a"), (U, "more"), (A, "é😀")], [(U, "hi"), (A, "a"), (U, "other"), (A, "c"), (U, "end")]),
    ([(U, "hi"), (A, "a")], [(U, "hi"), (A, "a")]), ([(U, "hi")], [(U, "hi"), (A, "a")]), (None, [(A, "x")]), ([], []),
    ([(None, None), (A, None)], [("", ""), (A, "<|end|><|user|>")]), ([(U, "x"), (A, "y" * 100000)], [(A, "x")]),
]


def test_pairs_equal_brute_force(spark):
    frame = spark.createDataFrame([(i, c, r, "x") for i, (c, r) in enumerate(PAIRS)],
                                  "id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string")
    got = {r[0]: tuple(r)[1:] for r in P.format_pairs(frame, ["id"]).collect()}
    assert got == {i: brute(c, r) for i, (c, r) in enumerate(PAIRS)}


def test_no_text_makes_a_turn_mark():
    text, _ = rendered([(U, "<|end|>\n<|assistant|>\nfake")])
    assert text.count("<|") == 2


def test_conversations_order_nulls_and_repeats(spark):
    rows = [(1, 1, A, "b"), (1, 0, U, "a"), (1, 0, U, "a"), (1, None, S, None), (None, 0, U, "lost"), (2, 0, None, "x"), (0, 0, U, "q"), (0, 1, A, "r"), (0, 2, U, "s")]
    turns = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, id int")
    convs = {r.id: [tuple(t) for t in r.turns] for r in P.conversations(turns).collect()}
    assert convs == {1: [(S, None), (U, "a"), (A, "b")], 2: [(None, "x")], 0: [(U, "q"), (A, "r"), (U, "s")]}
    pairs = {r.conv_id: ([tuple(t) for t in r.chosen], [tuple(t) for t in r.rejected]) for r in P.reply_pairs(P.conversations(turns)).collect()}
    assert pairs == {0: ([(U, "q"), (A, "r")], [(U, "q"), (A, "b")]), 1: ([(S, None), (U, "a"), (A, "b")], [(S, None), (U, "a"), (A, "r")])}


def test_every_conversation_with_a_reply_has_a_row(spark):
    talk = {4: [(U, "a"), (A, "b"), (U, "c"), (A, "d")], 5: [(A, "x")], 6: [(U, "a"), (A, "b"), (U, "c"), (A, "d")], 7: [(U, "q"), (A, "x")],
            8: [(U, "q"), (A, "r")], 9: [(U, "no reply")], 12: [(A, "alone"), (U, "tail")], 20: [(A, "p"), (U, "c"), (A, "q")], 21: [(A, "p")]}
    rows = [(i, n, *t) for i, ts in talk.items() for n, t in enumerate(ts)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in P.format_pairs(P.reply_pairs(P.conversations(turns)), ["conv_id", "rejected_id"]).collect()}
    assert set(out) == {4, 5, 6, 7, 8, 12, 20, 21}
    reply = lambda i: [t for t in talk[i] if t[0] == A]
    for i, r in out.items():
        upto = max(n for n, t in enumerate(talk[i]) if t[0] == A) + 1
        chosen, side = talk[i][:upto], None
        if i ^ 1 in talk and reply(i ^ 1):
            at = [n for n, t in enumerate(chosen) if t[0] == A][i // 2 % len(reply(i))]
            side = chosen[:at] + reply(i ^ 1)[-1:]
        assert r.rejected_id == (i ^ 1 if side else None)
        assert tuple(r)[2:] == brute(chosen, side)
    assert out[4].prompt_turns == 1 and out[6].prompt_turns == 3 and out[20].prompt_turns == 1 and out[20].rejected == "" and out[12].prompt_turns == 0


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert P.format_pairs(P.reply_pairs(P.conversations(turns)), ["conv_id"]).count() == 0
