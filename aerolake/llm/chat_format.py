"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns
in alternation from user to assistant. An automaton over the last role emitted
(start, system, user, assistant) accepts these; dynamic programming over its
states finds the cheapest repair of a conversation: keep a turn, relabel it,
merge it into the turn before, or insert an empty turn. The repaired sequence
is rendered turn by turn, so that a conversation is the concatenation of its
pieces in order.

A turn's effect is a small matrix of costs between states, and matrices
compose, so a conversation too long for one task is cut into chunks by the place
of its turns: its rows are sorted by ranges, the ranges' counts give every row
its place, the chunks' matrices are summed up, level by level if they are many,
the cheapest chain of states at the chunk borders follows, and each chunk is
then repaired on its own. Matrices carry the order of equal costs too, so the
repair does not depend on where a conversation is cut. Of a chunk, a task holds the roles and a slice of texts.

Defined cases: null texts are empty; null or unknown roles fit no state and
must be relabelled or merged; roles are compared in lower case without
surrounding spaces; exactly repeated rows count once; turns with equal number
are ordered by role and text; null turn numbers come last; a null
conversation id is one conversation; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import CHUNK_CHARS, bound_batches, broadcast_if_small, materialize, schema, text_chunks

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
# States from which a role may be emitted; its own state follows.
ALLOWED = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
ACCEPTED = ASSISTANT
KEEP, MERGE, RELABEL, INSERT = 0, 2, 3, 4  # costs of a known role's turn
RELABEL_UNKNOWN, MERGE_OTHER = 1, 5        # an unknown role is cheap to relabel; merging across roles is dear
CHUNK_TURNS = 1024  # also the chunks whose borders are found at once
_NO = math.inf


def _inserts() -> dict[tuple[int, int], tuple[int, ...]]:
    """Cheapest emptiest chains: from state to state by inserted turns alone."""
    chains = {(q, q): () for q in range(4)}
    for _ in range(3):
        for (a, b), chain in list(chains.items()):
            for role, sources in ALLOWED.items():
                if b in sources and len(chain) + 1 < len(chains.get((a, role), range(9))):
                    chains[a, role] = (*chain, role)
    return chains


def steps_of(role: int | None) -> dict[tuple[int, int], tuple[float, str, tuple[int, ...], int]]:
    """For a turn of ``role``: (from, to) -> (cost, action, inserted roles, role emitted), the cheapest."""
    out: dict[tuple[int, int], tuple[float, str, tuple[int, ...], int]] = {}
    for (a, b), chain in sorted(_inserts().items()):
        options = [(KEEP if new == role else RELABEL_UNKNOWN if role is None else RELABEL,
                    "keep" if new == role else "relabel", new) for new, sources in ALLOWED.items() if b in sources]
        if b != START:
            options.append((MERGE if b == role else MERGE_OTHER, "merge", b))
        for cost, action, new in options:
            step = (cost + INSERT * len(chain), action, chain, new)
            if step[0] < out.get((a, new), (_NO,))[0]:
                out[a, new] = step
    return out


def ending() -> dict[int, tuple[float, tuple[int, ...]]]:
    """Cost and inserted roles that lead each state to the accepted one."""
    return {a: (INSERT * len(chain), chain) for (a, b), chain in _inserts().items() if b == ACCEPTED}


def _number(role: str | None) -> int | None:
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else None


def composed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Costs and ranks of two stretches of turns, one after the other: (2, 4, 4).

    ``[0, a, c]`` is the cheapest cost from state a to c. Of equal cost, ``repair``
    takes the way whose states, read from the end, are lowest; ``[1, a, c]`` ranks
    the states a by that, among ways into the same c, so that ties fall alike
    wherever a conversation is cut."""
    out = np.full((2, 4, 4), _NO)
    for c in range(4):
        ways = []
        for a in range(4):
            cost, rank, b = min((first[0, a, b] + second[0, b, c], second[1, b, c], b) for b in range(4))
            if cost < _NO:
                out[0, a, c] = cost
                ways.append((rank, first[1, a, b], a))
        for k, (_, _, a) in enumerate(sorted(ways)):
            out[1, a, c] = k
    return out


def _one_turn(role: int | None) -> np.ndarray:
    """Of one turn the way is its two states, so the state before is the rank."""
    costs = np.array([[steps_of(role).get((a, b), (_NO,))[0] for b in range(4)] for a in range(4)])
    return np.stack([costs, np.broadcast_to(np.arange(4.0)[:, None], (4, 4))])


def _nothing() -> np.ndarray:
    return np.stack([np.where(np.eye(4) > 0, 0.0, _NO), np.broadcast_to(np.arange(4.0)[:, None], (4, 4))])


def matrix_of(roles: list[str | None]) -> np.ndarray:
    """Cheapest costs from state to state over some turns, and their ranks: (2, 4, 4)."""
    one = {r: _one_turn(r) for r in (None, SYSTEM, USER, ASSISTANT)}
    total = _nothing()
    for role in roles:
        total = composed(total, one[_number(role)])
    return total


def repair(roles: list[str | None], enter: int = START, leave: int | None = None):
    """The cheapest repair: a list of (turn number or None, action, role, cost).

    ``leave`` fixes the state after the last turn; None means that the
    conversation ends here. Ties go to the lower state number.
    """
    best, back = {enter: 0.0}, []
    table = {r: steps_of(r) for r in (None, SYSTEM, USER, ASSISTANT)}
    for role in roles:
        nxt: dict[int, tuple[float, int]] = {}
        for (a, b), step in table[_number(role)].items():
            if a in best and (best[a] + step[0], a) < nxt.get(b, (_NO, 9)):
                nxt[b] = (best[a] + step[0], a)
        back.append({b: a for b, (_, a) in nxt.items()})
        best = {b: cost for b, (cost, _) in nxt.items()}
    ends = ending()
    state = leave if leave is not None else min(best, key=lambda q: (best[q] + ends[q][0], q))
    out = [(None, "insert", r, float(INSERT)) for r in reversed(ends[state][1])] if leave is None else []
    for i in range(len(roles) - 1, -1, -1):
        before = back[i][state]
        cost, action, chain, new = table[_number(roles[i])][before, state]
        out.append((i, action, new, cost - INSERT * len(chain)))
        out += [(None, "insert", r, float(INSERT)) for r in reversed(chain)]
        state = before
    return out[::-1]


def piece(action: str, role: int, text: str, first: bool) -> str:
    """A turn as it is rendered: a merged one goes on, any other closes the one before."""
    return "\n\n" + text if action == "merge" else ("" if first else "<|end|>\n") + f"<|{ROLES[role - 1]}|>\n" + text


def _compose(chunks: DataFrame, fan: int) -> DataFrame:
    """The summed up costs of every ``fan`` consecutive chunks."""
    def compose(key, pdf):
        import pandas as pd
        total = _nothing()
        for costs in pdf.sort_values("chunk")["costs"]:
            total = composed(total, np.array(costs).reshape(2, 4, 4))
        return pd.DataFrame({"conv_id": pdf["conv_id"].iloc[:1], "chunk": [pdf["up"].iloc[0]], "costs": [total.ravel().tolist()]})
    up = chunks.select("conv_id", F.floor(F.col("chunk") / fan).cast("long").alias("up"), "chunk", "costs")
    return up.groupBy("conv_id", "up").applyInPandas(compose, chunks.schema)


def _borders(chunks: DataFrame, fan: int = CHUNK_TURNS) -> DataFrame:
    """States at the chunk borders: ``conv_id, chunk, enter, leave, last`` from
    ``conv_id, chunk, costs``. More than ``fan`` chunks are first walked in
    groups of ``fan``, whose borders are then those of the walk inside."""
    def walk(key, pdf):
        import pandas as pd
        pdf = pdf.sort_values("chunk")
        enter, leave, last = (pdf[c].iloc[0] for c in ("enter", "leave", "last"))
        best, back = np.where(np.arange(4) == enter, 0.0, _NO), []
        for costs, ranks in (np.array(c).reshape(2, 4, 4) for c in pdf["costs"]):
            through = best[:, None] + costs
            best = through.min(axis=0)
            back.append(np.where(through == best, ranks, _NO).argmin(axis=0))
        ends = ending()
        state = min((q for q in range(4) if best[q] < _NO), key=lambda q: (best[q] + ends[q][0], q)) if last else leave
        rows = []
        for chunk, choice in zip(pdf["chunk"][::-1], back[::-1]):
            rows.append((pdf["conv_id"].iloc[0], chunk, int(choice[state]), int(state), bool(last and not rows)))
            state = choice[state]
        return pd.DataFrame(rows, columns=["conv_id", "chunk", "enter", "leave", "last"])

    many = chunks.where(F.col("chunk") >= fan).limit(1).count() > 0
    up = F.floor(F.col("chunk") / fan).cast("long") if many else F.lit(0).cast("long")
    below = chunks.select("conv_id", "chunk", "costs", up.alias("up"))
    if many:
        above = _borders(materialize(_compose(chunks, fan), "chat-chunks"), fan).withColumnsRenamed({"conv_id": "id", "chunk": "group"})
        below = below.join(above, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("up") == F.col("group"))).drop("id", "group")
    else:
        below = below.withColumns({"enter": F.lit(START), "leave": F.lit(START), "last": F.lit(True)})
    return below.groupBy("conv_id", "up").applyInPandas(
        walk, schema(chunks.schema["conv_id"], "chunk bigint, enter int, leave int, last boolean"))


def _groups(batches):
    """Consecutive rows with equal first two columns: the key, and the other columns row by row."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for key, group in itertools.groupby(rows, lambda row: row[:2]):
        yield key, (row[2:] for row in group)


def _numbered(rows: DataFrame, chunk_turns: int) -> DataFrame:
    """``rows`` with ``at``, which rises in the order of the turns, and their ``chunk``:
    rows are sorted by ranges, and each range goes on where those before it ended."""
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "role", "text")]
    # The id holds the number of the range and the row's place in it.
    rows = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("at", F.monotonically_increasing_id()), "chat-turns")
    rows = rows.withColumn("range", F.shiftright("at", 33))
    before = W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    runs = rows.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count("*").alias("n")).select(
        F.col("conv_id").alias("id"), F.col("range").alias("r"), "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = rows.join(broadcast_if_small(runs), F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("range") == F.col("r")))
    place = F.col("before") + F.col("at") - F.col("first")
    return rows.select("conv_id", F.floor(place / chunk_turns).cast("long").alias("chunk"), "at", "turn", "role", "text")


def repair_chats(turns: DataFrame, chunk_turns: int = CHUNK_TURNS, fan: int = CHUNK_TURNS) -> DataFrame:
    """``conv_id, chunk, seq, turn, role_in, action, role, cost, piece``: one row per
    input turn and per inserted turn; pieces concatenate by ``chunk, seq``."""
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bound_batches(turns.sparkSession)
    conv_id = turns.schema["conv_id"]
    id_arrow = to_arrow_type(conv_id.dataType)
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = materialize(sizes.where((F.col("n") > chunk_turns) | (F.col("bytes") > CHUNK_CHARS))
                       .select(F.col("conv_id").alias("id")), "chat-long")

    def sum_up(batches):
        for (conv, chunk), group in _groups(batches):
            roles = [role for _, role in group]
            yield pa.record_batch([pa.array([conv], id_arrow), pa.array([chunk], pa.int64()),
                                   pa.array([matrix_of(roles).ravel().tolist()], pa.list_(pa.float64())),
                                   pa.array([roles], pa.list_(pa.string()))],
                                  names=["conv_id", "chunk", "costs", "roles"])

    def fixed(group):
        """The rows of one chunk, repaired one after the other."""
        row = next(group)
        enter, leave, last = START, None, True
        if row[0] == 0:  # a border row and the roles come first
            _, enter, leave, last = row[:4]
            roles, leave = next(group)[4], None if last else leave
        else:
            group = [row, *group]
            roles = [r[7] for r in group]
        left, steps = iter(group), repair(roles, enter, leave)
        for k, (i, action, role, cost) in enumerate(steps):
            turn, role_in, text = (None, None, "") if i is None else next(left)[6:]
            end = "<|end|>\n" if last and k == len(steps) - 1 else ""
            yield k, turn, role_in, action, ROLES[role - 1], cost, piece(action, role, text, k == 0 and enter == START) + end

    def render(batches):
        import pyarrow.compute  # noqa: F401
        types = [id_arrow, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.string()]
        names = ["conv_id", "chunk", "seq", "turn", "role_in", "action", "role", "cost", "piece"]
        out, chars = [], 0
        for key, group in _groups(text_chunks(batches)):
            for row in fixed(group):
                if out and (len(out) == 10000 or chars + len(row[-1]) > CHUNK_CHARS):
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out, chars = [], 0
                out.append((*key, *row))
                chars += len(row[-1])
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    columns = {"kind": "int", "enter": "int", "leave": "int", "last": "boolean", "roles": "array<string>",
               "at": "bigint", "turn": "bigint", "role": "string", "text": "string"}

    def tagged(df: DataFrame, kind: int) -> DataFrame:
        return df.withColumn("kind", F.lit(kind)).select("conv_id", "chunk", *(
            (F.col(c) if c in (*df.columns, "kind") else F.lit(None)).cast(t).alias(c) for c, t in columns.items()))

    short = turns
    if not long.isEmpty():
        long = broadcast_if_small(long)
        is_long = F.col("conv_id").eqNullSafe(F.col("id"))
        short = turns.join(long, is_long, "left_anti")
        numbered = _numbered(turns.join(long, is_long, "left_semi").distinct(), chunk_turns)
        chunks = materialize(numbered.select("conv_id", "chunk", "at", "role").repartition("conv_id", "chunk")
                             .sortWithinPartitions("conv_id", "chunk", "at")
                             .mapInArrow(sum_up, schema(conv_id, "chunk bigint, costs array<double>, roles array<string>")), "chat-chunks")
    rows = tagged(short.distinct().withColumn("chunk", F.lit(0).cast("long")), 2)
    if short is not turns:
        borders = _borders(chunks.select("conv_id", "chunk", "costs"), fan)
        rows = rows.unionByName(tagged(numbered, 2)).unionByName(tagged(borders, 0)).unionByName(tagged(chunks.select("conv_id", "chunk", "roles"), 1))
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "chunk", "kind", "at", "turn", "role", "text")]
    return rows.repartition("conv_id", "chunk").sortWithinPartitions(*order).mapInArrow(
        render, schema(conv_id, "chunk bigint, seq bigint, turn bigint, role_in string, action string, role string, "
                                "cost double, piece string"))
