"""Chat formatting: turn-aligned windows under a token budget, with limited repeated history and a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template: a turn is OPEN + role + BODY + text + CLOSE, role and text escaped.
OPEN, BODY, CLOSE = "### ", ": ", " </turn>\n"
# A backslash goes before every '#', '<', ':' and backslash of a role or text, so no control string stands inside one.
_ESCAPED = re.compile(r"([\\#<:])")
_UNESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<:]|\\.)*) </turn>\n", re.DOTALL)

_BLOCK = 64  # turns


def escape(text: str) -> str:
    return _ESCAPED.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


def spans(turns: list[tuple[int, int]], budget: int, history: int) -> list[tuple[int, int, int]]:
    """Cuts turns (tokens, is history) into windows (first repeated, first new, end), by prefix sums of their tokens.

    A window takes new turns while they fit beside its repeated history; history gives way, oldest first, before a new
    turn does. A turn larger than the budget has a window of its own.
    """
    sums = [0]
    for tokens, _ in turns:
        sums.append(sums[-1] + tokens)
    new = next((k for k, (_, old) in enumerate(turns) if not old), len(turns))
    out = []
    while new < len(turns):
        first = max(0, new - history)
        while first < new and sums[new + 1] - sums[first] > budget:
            first += 1
        end = new + 1
        while end < len(turns) and sums[end + 1] - sums[first] <= budget:
            end += 1
        out.append((first, new, end))
        new = end
    return out


_WINDOW = "conv long, block long, part int, text string, n_repeated int, loss array<struct<start:int,end:int>>, n_tokens int"


def _windows(budget: int, history: int, target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns = None, []
        rows: list[dict] = []

        def close() -> None:
            head = [t for t in turns if t[0] in (0, 2)]
            rest = [t for t in turns if t[0] in (1, 3)]
            fixed = sum(t[3] for t in head)
            cuts = spans([(t[3], t[0] == 1) for t in rest], max(1, budget - fixed), history)
            for part, (first, new, end) in enumerate(cuts or [(0, 0, 0)]):
                text, loss, at = [], [], 0
                repeated = new - first + sum(t[0] == 0 or part > 0 for t in head)
                for k, (_, role, body, _) in enumerate(head + rest[first:end]):
                    start = f"{OPEN}{escape(role)}{BODY}"
                    shown = escape(body)
                    if k >= repeated and role == target:
                        loss.append({"start": at + len(start), "end": at + len(start) + len(shown)})
                    text.append(start + shown + CLOSE)
                    at += len(text[-1])
                rows.append({"conv": key[0], "block": key[1], "part": part, "text": "".join(text), "n_repeated": repeated, "loss": loss, "n_tokens": fixed + sum(t[3] for t in rest[first:end])})

        for batch in batches:
            for conv, block, kind, role, body, tokens in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (conv, block) != key:
                    if key is not None:
                        close()
                    key, turns = (conv, block), []
                turns.append((kind, role, body, tokens))
            while rows:
                yield pa.RecordBatch.from_pylist(rows[:500], schema=arrow)
                del rows[:500]
        if key is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = pa.schema([("conv", pa.int64()), ("block", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("n_repeated", pa.int32()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("n_tokens", pa.int32())])
    return run


def format_chats(turns: DataFrame, budget: int = 1024, history: int = 2, target: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Training windows: (conv, block, part, text, n_repeated, loss, n_tokens), in the order of (block, part).

    Turns stand in the order of (turn, role, text) and carry a quarter of their bytes + 4 as tokens. A window repeats
    the conversation's system turn (its first row, if that is of role system), then up to `history` turns before it,
    then new turns, up to `budget` tokens; a larger single turn has a window of its own, never cut. `n_repeated` turns
    at the start of a window are repeated and masked; `loss` has the character spans of the new turns of role
    `target`, so each such text is learned once. Windows also break after every 64 turns (or `history`, if more): such a
    block, with the history before it, is the most that a task holds, however long a conversation is. Blocks are of
    ranks, so sparse turn numbers give the same windows as dense ones.

    Null role or text: empty. Null turn: before all others. Null conv: a conversation of its own. Other columns are
    not read. An empty table gives none.
    """
    size = max(_BLOCK, history)
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(-(2**62))).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"),
    ).select("*", F.floor(F.col("turn") / size).cast("long").alias("numbers"), (F.ceil(F.octet_length("body") / 4) + 4).cast("int").alias("tokens"))
    # a turn's rank in its conversation: the rows of smaller ranges of numbers, and its rank in its own range
    counts = rows.groupBy(F.col("conv").alias("c"), F.col("numbers").alias("b")).agg(F.count("*").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = counts.select("c", "b", earlier.alias("before"), F.sum("n").over(Window.partitionBy("c")).alias("total"))
    inside = F.row_number().over(Window.partitionBy("conv", "numbers").orderBy("turn", "role", "body"))
    placed = rows.withColumn("inside", inside).join(ranges, F.col("conv").eqNullSafe(F.col("c")) & (F.col("numbers") == F.col("b"))).withColumn("rank", F.col("before") + F.col("inside") - 1)
    placed = placed.withColumns({"block": F.floor(F.col("rank") / size).cast("long"), "at": F.col("rank") % size + 1})
    is_head = (F.col("rank") == 0) & (F.col("role") == "system")
    later = F.explode(F.sequence(F.lit(1).cast("long"), F.floor((F.col("total") - 1) / size).cast("long")))
    heads = placed.where(is_head & (F.col("total") > size)).select("conv", later.alias("block"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), "role", "body", "tokens")
    own = placed.select("conv", "block", F.when(is_head, 2).otherwise(3).alias("kind"), "at", "role", "body", "tokens")
    follows = (F.col("block") + 1) * size < F.col("total")
    past = placed.where((F.col("at") > size - history) & follows & ~is_head).selectExpr("conv", "block + 1 block", "1 kind", "at", "role", "body", "tokens")
    all_ = heads.unionByName(own).unionByName(past)
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streams = all_.repartition(n, "conv", "block").sortWithinPartitions("conv", "block", "kind", "at").select("conv", "block", "kind", "role", "body", "tokens")
    return streams.mapInArrow(_windows(budget, history, target), _WINDOW)


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation say: the contract's counts and digests, in one sorted stream per task.

    A digest runs along a conversation's windows in order; the stream keeps its running state alone, not the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: list[dict] = []

        def fresh() -> dict:
            return {"n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "formatted_chars": 0, "n_windows": 0}

        def close() -> None:
            done.append({"conv": key[0], "n_turns": state["n_turns"], "turns_sha256": state["turns"].hexdigest(), "loss_chars": state["loss_chars"], "loss_sha256": state["loss"].hexdigest(), "formatted_chars": state["formatted_chars"], "n_windows": state["n_windows"]})

        for batch in batches:
            for conv, text, repeated, loss in zip(*[batch.column(c).to_pylist() for c in ("conv", "text", "n_repeated", "loss")], strict=True):
                if key != (conv,):
                    if key is not None:
                        close()
                    key, state = (conv,), fresh()
                at = 0
                for k, m in enumerate(_TURN.finditer(text)):
                    if m.start() != at:
                        raise ValueError("a window holds text that is no turn")
                    at = m.end()
                    if k >= repeated:
                        state["n_turns"] += 1
                        state["turns"].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                if at != len(text):
                    raise ValueError("a window holds text that is no turn")
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    state["loss_chars"] += len(said)
                    state["loss"].update(said.encode("utf-8", "surrogatepass"))
                state["formatted_chars"] += len(text)
                state["n_windows"] += 1
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done.clear()
        if key is not None:
            close()
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    arrow = pa.schema([("conv", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])
    n = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streams = windows.repartition(n, "conv").sortWithinPartitions("conv", "block", "part")
    return streams.mapInArrow(run, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")
