"""Preference formatting: one prompt, two masked completions.

``chosen`` and ``rejected`` are arrays of ``struct(role, text)``.  Their longest
common prefix of equal turns is rendered once as the prompt; what follows in
each is rendered as its completion.  A turn is rendered as
``<|role|>\\n`` text ``<|end|>\\n``; a ``<|`` inside a role or text becomes ``< |``,
so no text can pass for a turn mark.  A completion's mask lists the ranges of
it (code points, ``start:end`` with the end exclusive, comma-joined) that carry
loss: the text and end mark of the turns of ``TRAINED`` roles.

A null role or text counts as empty.  If one conversation is the whole prefix
of the other its completion is empty, and two equal conversations have two
empty completions.  A pair with a null side is rendered as if it had no turns.
A conversation is one unit of output: its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED = "assistant"
_TURNS = "array<struct<role:string,text:string>>"


def _safe(s: str) -> str:
    return f"replace(coalesce({s}, ''), '<|', '< |')"


def _rendered(turn: str) -> str:
    return f"concat('<|', {_safe(turn + '.role')}, '|>\\n', {_safe(turn + '.text')}, '<|end|>\\n')"


def render(turns: str) -> Column:
    return F.expr(f"array_join(transform({turns}, t -> {_rendered('t')}), '')")


def loss_mask(turns: str) -> Column:
    """The ranges of the rendered turns that carry loss."""
    head, whole = f"4 + char_length({_safe('t.role')}) + 1", f"char_length({_rendered('t')})"
    return F.expr(f"""array_join(aggregate({turns}, named_struct('at', 0, 'out', cast(array() as array<string>)),
        (a, t) -> named_struct('at', a.at + {whole}, 'out', if(t.role = '{TRAINED}',
            array_append(a.out, concat(a.at + {head}, ':', a.at + {whole} - 1)), a.out)), a -> a.out), ',')""")


def format_pairs(pairs: DataFrame, keys: list[str], chosen_col: str = "chosen", rejected_col: str = "rejected") -> DataFrame:
    """``keys`` and ``prompt_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask`` for every row of ``pairs``; other columns are dropped."""
    side = lambda c: F.coalesce(F.col(c).cast(_TURNS), F.array().cast(_TURNS))
    rows = pairs.select(F.struct(*keys).alias("key"), side(chosen_col).alias("c"), side(rejected_col).alias("r"))
    same = F.expr("""zip_with(c, r, (x, y) -> x is not null and y is not null
        and coalesce(x.role, '') = coalesce(y.role, '') and coalesce(x.text, '') = coalesce(y.text, ''))""")
    rows = rows.select("key", "c", "r", F.array_position(same, False).alias("p"))
    rows = rows.select("key", "c", "r", F.expr("cast(if(p = 0, size(c), p - 1) as int)").alias("n"))
    rows = rows.select("key", "n", F.expr("slice(c, 1, n)").alias("p"), F.expr("slice(c, n + 1, size(c))").alias("c"), F.expr("slice(r, n + 1, size(r))").alias("r"))
    return rows.select("key.*", F.col("n").alias("prompt_turns"), render("p").alias("prompt"), render("c").alias("chosen"),
                       render("r").alias("rejected"), loss_mask("c").alias("chosen_mask"), loss_mask("r").alias("rejected_mask"))


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(id, turns)``: each conversation's turns in order.  Repeated rows count
    once; turns of one number are ordered by role and text, nulls first.  Rows
    with a null conversation id belong to none."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    grouped = turns.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.array_sort(F.collect_set(turn)).alias("turns"))
    return grouped.select("id", F.expr("transform(turns, t -> struct(t.role as role, t.text as text))").alias("turns"))


def reply_pairs(convs: DataFrame, role: str = TRAINED) -> DataFrame:
    """Preference pairs for conversations without rated replies: chosen is a
    conversation up to its last turn of ``role``.  Rejected leaves it at one of its
    turns of ``role``, the (id div 2 mod their number)-th from 0, where it has the last
    such turn of its partner instead and ends; so sides part early and late.  The
    ids 2k and 2k + 1 are partners.  ``(conv_id, rejected_id, chosen, rejected)``;
    a conversation whose partner is missing or has no such turn keeps its row,
    with a null id and side; one without such a turn has nothing to choose."""
    places = f"filter(transform(turns, (t, i) -> if(t.role <=> '{role}', i + 1, 0)), i -> i > 0)"
    own = convs.select("id", "turns", F.expr(places).alias("at")).where(F.size("at") > 0)
    own = own.select("id", F.expr("slice(turns, 1, element_at(at, -1))").alias("turns"), F.expr("at[cast(pmod(shiftright(id, 1), size(at)) as int)]").alias("parts"))
    other = own.select(F.col("id").bitwiseXOR(F.lit(1)).alias("id"), F.col("id").alias("rejected_id"), F.expr("element_at(turns, -1)").alias("reply"))
    rejected = F.when(F.col("rejected_id").isNotNull(), F.expr("concat(slice(turns, 1, parts - 1), array(reply))"))
    return own.join(other, "id", "left").select(F.col("id").alias("conv_id"), "rejected_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))
