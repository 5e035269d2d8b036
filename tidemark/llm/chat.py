"""Chat formatting in budgeted windows, and reading the formatted windows back."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import encoder
from tidemark.session import staged

BUDGET = 2048
HISTORY = 512
# Tokens of a conversation that are cut into windows in one piece.
CHUNK_WINDOWS = 16

# Strings that chat templates, this one included, read as control.
CONTROL = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"

_RESTS = {c: "|".join(re.escape(s[1:]) for s in CONTROL if s[0] == c) for c in "<["}
_INSIDE = re.compile("|".join(rf"(?:{re.escape(c)}(?=\\*(?:{rest})))" for c, rest in _RESTS.items()))
_ESCAPED = re.compile("|".join(rf"(?:(?<={re.escape(c)})\\(?=\\*(?:{rest})))" for c, rest in _RESTS.items()))
_TURN = re.compile(r"<\|turn\|>(.*?)<\|body\|>(.*?)<\|end\|>", re.S)


def escape(text: str) -> str:
    """A backslash after the first character of every control string, escaped ones included."""
    return _INSIDE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def segment(role: str, text: str) -> str:
    return f"{TURN}{escape(role)}{BODY}{escape(text)}{END}"


WINDOWS = (
    "conv_id {kind}, chunk long, window long, text string, tokens long, context_turns long, "
    "n_turns long, loss_starts array<long>, loss_ends array<long>"
)


def format_conversations(
    turns: DataFrame,
    vocabulary: str,
    budget: int = BUDGET,
    history: int = HISTORY,
    targets: tuple[str, ...] = ("assistant",),
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Windows of at most ``budget`` tokens: ``text`` and the spans of it under the loss mask.

    Turns are ordered by ``turn`` (nulls first; equal ones by role and a hash of the text) and
    null texts and roles are empty; rows with a null conversation are one conversation.  A
    turn's place in its conversation is the sum of the tokens before it.  Every window begins
    with the conversation's opening system turn if there is one, repeats the turns before it as
    far as they fit into ``history`` tokens, and goes on with new turns up to the budget.  A
    turn that exceeds the budget alone makes a longer window; nothing is cut.  Texts of
    ``targets`` are under the mask in the window where they are new, and masked out where they
    are repeated; ``context_turns`` of the window's ``n_turns`` are repeated ones.

    Turns are range-partitioned and summed in two steps, within a range and over ranges, and a
    conversation is cut where its sum passes a multiple of ``CHUNK_WINDOWS`` budgets, so that
    one with very many turns is spread over tasks.  Other columns are ignored, repeated turns are
    turns of their own, and an empty table gives no windows.
    """
    kind = turns.schema[conv_id].dataType.simpleString()
    length = F.lit(CHUNK_WINDOWS * budget).cast("long")
    placed = staged(_placed(turns, vocabulary, kind, conv_id, turn, role, text), "turns")
    chunk = F.floor(F.col("p0") / length).cast("long")
    own = placed.withColumns({"chunk": chunk, "use": F.lit(2)})
    # The last turns before a cut are history for the next chunk.
    near = (F.col("chunk") + 1) * length - F.col("p0") <= history
    before = own.where(near).withColumns({"chunk": F.col("chunk") + 1, "use": F.lit(1)})
    # The system turn goes to all further chunks.
    opening = placed.where((F.col("nth") == 0) & (F.col("role") == "system"))
    spread = (
        placed.groupBy("conv_id")
        .agg(F.max(chunk).alias("chunks"))
        .where(F.col("chunks") > 0)
        .select(F.col("conv_id").alias("known_id"), "chunks")
        .join(opening, F.col("known_id").eqNullSafe(F.col("conv_id")))
        .withColumn("chunk", F.explode(F.sequence(F.lit(1).cast("long"), "chunks")))
        .withColumn("use", F.lit(0))
    )
    names = ["conv_id", "chunk", "use", "nth", "role", "text", "p0", "tokens"]
    rows = own.select(names).unionAll(before.select(names)).unionAll(spread.select(names))
    dealt = rows.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "use", "nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _windows(batches, budget, history, frozenset(targets))

    return dealt.mapInArrow(run, WINDOWS.format(kind=kind))


def _placed(turns, vocabulary, kind, conv_id, turn, role, text) -> DataFrame:
    """``conv_id, nth, role, text, p0, tokens``: number of the turn, tokens before it and its own."""
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    order = ["conv_id", "turn", "role", "tie"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"conv_id {kind}, role string, text string, tokens long, part long, local_p0 long, local_nth long"
    counted = staged(
        ranged.withColumn("part", F.spark_partition_id()).mapInArrow(
            lambda batches: _count_tokens(batches, vocabulary), schema
        ),
        "counted",
    )
    sums = counted.groupBy("conv_id", "part").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("turns")
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sums.select(
            F.col("conv_id").alias("c_id"),
            F.col("part").alias("c_part"),
            F.sum("tokens").over(earlier).alias("c_tokens"),
            F.sum("turns").over(earlier).alias("c_turns"),
        )
        .where(F.col("c_tokens").isNotNull())
    )
    # At most the first conversation of a range goes on from an earlier one: a row per range.
    carried = F.broadcast(staged(carried, "carried"))
    same = F.col("conv_id").eqNullSafe(F.col("c_id")) & (F.col("part") == F.col("c_part"))
    return counted.join(carried, same, "left").select(
        "conv_id",
        (F.col("local_nth") + F.coalesce("c_turns", F.lit(0))).alias("nth"),
        "role",
        "text",
        (F.col("local_p0") + F.coalesce("c_tokens", F.lit(0))).alias("p0"),
        "tokens",
    )


def _count_tokens(batches, vocabulary: str):
    encode = encoder(vocabulary).encode
    current, sum_, nth = object(), 0, 0
    for batch in batches:
        tokens, before, numbers = [], [], []
        columns = (batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))
        for conv, role, text in zip(*columns, strict=True):
            if conv != current:
                current, sum_, nth = conv, 0, 0
            n = len(encode(segment(role, text)))
            tokens.append(n)
            before.append(sum_)
            numbers.append(nth)
            sum_, nth = sum_ + n, nth + 1
        kept = [batch.column(n) for n in ("conv_id", "role", "text")]
        added = [pa.array(tokens, pa.int64()), batch.column("part").cast(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [*kept, *added, pa.array(before, pa.int64()), pa.array(numbers, pa.int64())],
            ["conv_id", "role", "text", "tokens", "part", "local_p0", "local_nth"],
        )


def _windows(batches, budget: int, history: int, targets: frozenset[str]):
    held: list[dict] = []
    for batch in batches:
        done: list[dict] = []
        for row in batch.to_pylist():
            if held and (held[0]["conv_id"], held[0]["chunk"]) != (row["conv_id"], row["chunk"]):
                done += _windows_of(held, budget, history, targets)
                held = []
            held.append(row)
        yield _as_batch(done, batch.schema.field("conv_id").type)
    if held:
        done = _windows_of(held, budget, history, targets)
        yield _as_batch(done, batch.schema.field("conv_id").type)


def _windows_of(rows: list[dict], budget: int, history: int, targets: frozenset[str]) -> list[dict]:
    """Windows of one chunk of a conversation; use 0: system turn, 1: history, 2: new turns."""
    new_from = sum(r["use"] < 2 for r in rows)
    if new_from == len(rows):
        return []
    system = next((r for r in rows if r["nth"] == 0 and r["role"] == "system"), None)
    turns = [r for r in rows if r["use"] > 0]
    first_new = sum(r["use"] == 1 for r in rows)
    begins = [r["p0"] for r in turns]
    ends = [r["p0"] + r["tokens"] for r in turns]
    found, at = [], first_new
    while at < len(turns):
        opening = [system] if system is not None and system["nth"] != turns[at]["nth"] else []
        fixed = sum(r["tokens"] for r in opening)
        earliest = at
        while earliest > 0 and begins[at] - begins[earliest - 1] <= history and turns[earliest - 1] is not system:
            earliest -= 1
        context = [r for r in turns[earliest:at] if not opening or r["nth"] != system["nth"]]
        past = sum(r["tokens"] for r in context)
        # History gives way where the next new turn would not fit beside it.
        while context and fixed + past + turns[at]["tokens"] > budget:
            past -= context.pop(0)["tokens"]
        room = budget - fixed - past
        stop = max(at + 1, bisect_right(ends, begins[at] + room))
        found.append(_window(opening + context, turns[at:stop], len(found), targets))
        at = stop
    return found


def _window(context: list[dict], new: list[dict], number: int, targets: frozenset[str]) -> dict:
    parts, at, starts, ends = [], 0, [], []
    for k, row in enumerate([*context, *new]):
        part = segment(row["role"], row["text"])
        if k >= len(context) and row["role"] in targets:
            starts.append(at + len(TURN) + len(escape(row["role"])) + len(BODY))
            ends.append(at + len(part) - len(END))
        parts.append(part)
        at += len(part)
    return {
        "conv_id": new[0]["conv_id"],
        "chunk": new[0]["chunk"],
        "window": number,
        "text": "".join(parts),
        "tokens": sum(r["tokens"] for r in (*context, *new)),
        "context_turns": len(context),
        "n_turns": len(context) + len(new),
        "loss_starts": starts,
        "loss_ends": ends,
    }


def _as_batch(rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    types = {
        "conv_id": kind,
        "text": pa.string(),
        "loss_starts": pa.list_(pa.int64()),
        "loss_ends": pa.list_(pa.int64()),
    }
    names = [n.split()[0] for n in WINDOWS.split(", ")]
    return pa.RecordBatch.from_pydict(
        {n: pa.array([r[n] for r in rows], types.get(n, pa.int64())) for n in names}
    )


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted window."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(text)]


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What the windows hold, read back from their texts and masks: a row per conversation.

    ``n_turns`` and ``turns_sha256`` come from the turns that are new in their window,
    ``loss_chars`` and ``loss_sha256`` from all text under the mask.  A digest runs over a
    conversation in order, so its windows stream through one task, one at a time.
    """
    kind = windows.schema["conv_id"].dataType.simpleString()
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "window")
    return ordered.mapInArrow(
        _digests,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_windows long",
    )


def _digests(batches):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
    state: list | None = None

    def row(state):
        conv, n, turns, chars, loss, length, count = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length, count

    def out(done, kind):
        columns = list(zip(*done)) or [()] * len(names)
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    kind = None
    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        for w in batch.to_pylist():
            if state is None or state[0] != w["conv_id"]:
                if state is not None:
                    done.append(row(state))
                state = [w["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, text in parse(w["text"])[w["context_turns"] :]:
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for start, end in zip(w["loss_starts"], w["loss_ends"], strict=True):
                text = unescape(w["text"][start:end])
                state[3] += len(text)
                state[4].update(text.encode("utf-8", "surrogatepass"))
            state[5] += len(w["text"])
            state[6] += 1
        yield out(done, kind)
    if state is not None:
        yield out([row(state)], kind)
