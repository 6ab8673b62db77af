"""Chat formatting: role repair of least cost over an automaton of legal turns, then rendering.

Legal conversations: at most one system turn, first; then user and assistant
in turn, the user first and the assistant last. For each message, in order, the repair
may take it as a new turn of its own or another role (a relabel), or merge it into the turn
before; before it, and at the end, empty turns may be put in. Each has a cost,
and dynamic programming over the automaton's states finds the least sum.

A conversation may hold any share of the rows. The messages are dealt
into ranges by (conversation, turn) without regard to where conversations end. What a range does
to a conversation that crosses its border is a matrix of least costs from state
to state; the driver multiplies these (min-plus; two small matrices a range at most) to
fix the states at the borders, and each range then repairs its messages on its own,
which gives the same least total as one run over the whole conversation. The text stays out of this:
decisions are narrow rows, joined back to their messages for rendering.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

# Other names of the three roles, and the costs of repairs.
ALIASES = {"system": ("system", "developer", "instruction", "context"), "user": ("user", "human", "prompter", "customer", "question"),
           "assistant": ("assistant", "bot", "gpt", "model", "ai", "agent", "chatgpt", "answer")}
ROLES = ("system", "user", "assistant")
MERGE, RELABEL, UNKNOWN, INSERT = 1.0, 3.0, 0.5, 1.5

# States: nothing yet, or the role of the last turn. NEXT: the turns that may follow.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
LAST = ASSISTANT


def _inserts() -> dict[tuple[int, int], tuple[int, ...]]:
    """Fewest empty turns that lead from a state to another (not none of either: to itself, none)."""
    out = {(s, s): () for s in range(4)}
    todo = list(out.items())
    for (a, b), path in todo:
        for n in NEXT[b]:
            if (a, n) not in out:
                out[a, n] = (*path, n)
                todo.append(((a, n), out[a, n]))
    return out


INSERTS = _inserts()


def _moves(role: int) -> list[tuple[int, int, float, str, tuple[int, ...]]]:
    """(state before, state after, cost, action, empty turns before) for a message of a role (0: unknown), cheapest ways only.

    Ties: merge before insertion, the plain role before a relabel, fewer insertions.
    """
    out = {}
    for before, take in product(range(4), (SYSTEM, USER, ASSISTANT)):
        label = 0.0 if take == role else UNKNOWN if role == 0 else RELABEL
        word = "" if take == role else "relabel"
        ways = [(MERGE + label, "merge" if not word else "relabel+merge", ())] if take == before else []
        for via in range(4):
            path = INSERTS.get((before, via))
            if path is not None and take in NEXT[via]:
                ways.append((label + INSERT * len(path), word or "keep", path))
        if ways:
            cost, action, path = min(ways, key=lambda w: (w[0], len(w[2])))
            if (before, take) not in out or cost < out[before, take][2]:
                out[before, take] = (before, take, cost, action, path)
    return sorted(out.values())


MOVES = {r: _moves(r) for r in range(4)}
#: Cost of the empty turns after the last message, by state.
ENDS = np.array([INSERT * len(INSERTS[s, LAST]) for s in range(4)])


def _matrix(role: int) -> np.ndarray:
    m = np.full((4, 4), np.inf)
    for a, b, cost, _, _ in MOVES[role]:
        m[a, b] = cost
    return m


MATRIX = [_matrix(r) for r in range(4)]


def transfer(roles: list[int]) -> np.ndarray:
    """Least cost from each state to each over a run of messages."""
    m = np.where(np.eye(4) > 0, 0.0, np.inf)
    for r in roles:
        m = (m[:, :, None] + MATRIX[r][None, :, :]).min(axis=1)
    return m


def repair(roles: list[int], start: int = START, end: int | None = None) -> list[tuple[int, str, tuple[int, ...]]]:
    """(role taken, action, empty turns before) for each message. ``end``: the state to end in, or None for the
    end of the conversation, where the empty turns after it count. Ties go to the smaller state."""
    cost, back = np.full(4, np.inf), []
    cost[start] = 0.0
    for r in roles:
        new, way = np.full(4, np.inf), [None] * 4
        for move in MOVES[r]:
            if (c := cost[move[0]] + move[2]) < new[move[1]]:
                new[move[1]], way[move[1]] = c, move
        cost = new
        back.append(way)
    state = int((cost + ENDS).argmin()) if end is None else end
    out = []
    for way in reversed(back):
        before, take, _, action, path = way[state]
        out.append((take, action, path))
        state = before
    return out[::-1]


def border_states(segments: list[tuple[tuple, np.ndarray]]) -> dict[tuple, tuple[int, int | None]]:
    """Start and end state of each segment (name, matrix) of one conversation, in order; the last one's end is open.

    Going back from the end gives the least cost that is still to come; going forth picks the states.
    """
    to_come = [ENDS]
    for _, m in reversed(segments[1:]):
        to_come.append((m + to_come[-1][None, :]).min(axis=1))
    state, out = START, {}
    for (name, m), rest in zip(segments, reversed(to_come)):
        last = name == segments[-1][0]
        end = None if last else int((m[state] + rest).argmin())
        out[name] = (state, end)
        state = end
    return out


def repair_roles(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, text_key, nth, role, new_role, action, inserted (roles before, comma-joined),
    opens (a new turn), is_first and is_last (of the conversation), inserted_after, place (ascending within a conversation).

    Defined cases: messages are ordered by turn (null last), then role and a hash of the text; rows that are equal in all
    of these are messages of their own. A null conversation is one of its own; a null or unknown role is
    relabelled at a lower cost; null and empty texts are empty messages. An empty table gives an empty
    result. Other columns are ignored.
    """
    text = text_or_empty(text_col)
    same = Window.partitionBy("conv", "turn", "role", "text_key").orderBy(F.lit(1))
    name = F.lower(F.trim(F.coalesce(F.col(role_col).cast("string"), F.lit(""))))
    number = F.lit(0)
    for i, r in enumerate(ROLES):
        number = F.when(name.isin(*ALIASES[r]), i + 1).otherwise(number)
    rows = messages.select(F.struct(F.col(conv_col).alias("id")).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                           number.cast("int").alias("r"), F.xxhash64(text).alias("text_key"))
    rows = rows.withColumn("nth", F.row_number().over(same))
    order = [F.col("conv"), F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text_key"), F.col("nth")]
    dealt = materialize(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order)
                        .withColumn("pos", F.monotonically_increasing_id()), "chat-order")
    narrow = dealt.select("part", "pos", F.xxhash64("conv").alias("c"), "r")

    def runs(table: pa.Table) -> list[tuple[int, int, np.ndarray]]:
        """Stretches of one conversation: first row, row after the last; and the rows' order."""
        at = np.argsort(table["pos"].to_numpy(), kind="stable")
        c = table["c"].to_numpy()[at]
        cut = np.concatenate(([0], np.nonzero(c[1:] != c[:-1])[0] + 1, [len(c)]))
        return list(zip(cut[:-1].tolist(), cut[1:].tolist())), at, c

    def borders(table: pa.Table) -> pa.Table:
        cuts, at, c = runs(table)
        r = table["r"].to_numpy()[at]
        ends = cuts[:1] + cuts[-1:] if len(cuts) > 1 else cuts
        return pa.table({"part": pa.array([table["part"][0].as_py()] * len(ends), pa.int32()),
                         "k": pa.array([0 if a == 0 else 1 for a, _ in ends], pa.int32()),
                         "c": pa.array([int(c[a]) for a, _ in ends], pa.int64()),
                         "m": pa.array([transfer(r[a:b].tolist()).ravel().tolist() for a, b in ends], pa.list_(pa.float64()))})

    found = narrow.groupBy("part").applyInArrow(borders, "part int, k int, c long, m array<double>").collect()
    chains: dict[int, list] = {}
    for x in sorted(found, key=lambda x: (x["part"], x["k"])):
        chains.setdefault(x["c"], []).append(((x["part"], x["k"]), np.array(x["m"]).reshape(4, 4)))
    fixed = {}
    for chain in chains.values():
        if len(chain) > 1:
            fixed.update(border_states(chain))

    def decide(table: pa.Table) -> pa.Table:
        cuts, at, _ = runs(table)
        part, r, out = table["part"][0].as_py(), table["r"].to_numpy()[at], []
        for a, b in cuts:
            start, end = fixed.get((part, 0 if a == 0 else 1), (START, None)) if a == 0 or b == len(r) else (START, None)
            steps = repair(r[a:b].tolist(), start, end)
            for i, (take, action, path) in enumerate(steps):
                last = end is None and i == len(steps) - 1
                out.append((ROLES[take - 1], action, ",".join(ROLES[x - 1] for x in path), "merge" not in action, start == START and i == 0, last,
                            ",".join(ROLES[x - 1] for x in INSERTS[take, LAST]) if last else ""))
        columns = list(zip(*out))
        kinds = [pa.string()] * 3 + [pa.bool_()] * 3 + [pa.string()]
        return pa.table({"part": pa.array([part] * len(out), pa.int32()), "pos": pa.array(table["pos"].to_numpy()[at], pa.int64()),
                         **{n: pa.array(v, t) for n, v, t in zip(["new_role", "action", "inserted", "opens", "is_first", "is_last", "inserted_after"],
                                                                 columns, kinds)}})

    steps = narrow.groupBy("part").applyInArrow(
        decide, "part int, pos long, new_role string, action string, inserted string, opens boolean, is_first boolean, is_last boolean, "
                "inserted_after string")
    return dealt.join(steps, ["part", "pos"]).select(
        F.col("conv.id").alias("conv_id"), "turn", "text_key", "nth", "role", "new_role", "action", "inserted", "opens", "is_first",
        "is_last", "inserted_after", F.col("pos").alias("place"))


def render(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           opening: str = "<|{}|>\n", closing: str = "<|end|>\n") -> DataFrame:
    """``repair_roles`` with the message's part of its rendered conversation (column rendered).

    The parts of a conversation, joined in the order of column place, are the whole of it: a part closes the
    turn before if it opens one, writes the empty turns in between, and the last closes its own.
    """
    steps = repair_roles(messages, conv_col, turn_col, role_col, text_col)
    text = text_or_empty(text_col)
    same = Window.partitionBy("conv", "turn_", "role_", "key").orderBy(F.lit(1))
    texts = messages.select(F.struct(F.col(conv_col).alias("id")).alias("conv"), F.struct(F.col(turn_col).alias("id")).alias("turn_"),
                            F.struct(F.col(role_col).alias("id")).alias("role_"), F.xxhash64(text).alias("key"), text.alias("t"))
    texts = texts.withColumn("n", F.row_number().over(same))
    keyed = steps.select("*", F.struct(F.col("conv_id").alias("id")).alias("conv_s"), F.struct(F.col("turn").alias("id")).alias("turn_s"),
                         F.struct(F.col("role").alias("id")).alias("role_s"))
    # the number as bounds, not as a key: the texts lie by the other four already and are not shuffled again
    both = texts.join(keyed, (texts["conv"] == keyed["conv_s"]) & (texts["turn_"] == keyed["turn_s"]) & (texts["role_"] == keyed["role_s"])
                      & (texts["key"] == keyed["text_key"]) & (texts["n"] >= keyed["nth"]) & (texts["n"] <= keyed["nth"]))
    head = lambda role: F.replace(F.lit(opening), F.lit("{}"), role)
    empties = lambda c: F.array_join(F.transform(
        F.filter(F.split(c, ","), lambda r: r != ""), lambda r: F.concat(head(r), F.lit(closing))), "")
    part = F.concat(
        F.when(F.col("opens") & ~F.col("is_first"), F.lit(closing)).otherwise(F.lit("")), F.when(F.col("opens"), empties("inserted")).otherwise(F.lit("")),
        F.when(F.col("opens"), head(F.col("new_role"))).otherwise(F.lit("\n")), F.col("t"),
        F.when(F.col("is_last"), F.concat(F.lit(closing), empties("inserted_after"))).otherwise(F.lit("")))
    return both.select("conv_id", "turn", "role", "new_role", "action", "inserted", "inserted_after", "place", part.alias("rendered"))
