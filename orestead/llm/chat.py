"""Chat formatting: a hidden Markov model recovers who speaks, then turns are rendered in one form.

States are the roles, and the model's steps are the lines of a transcript: a line's observation is its speaker marker (such
as `User:` or `### Assistant`), how long it is, and whether a row of the table begins with it. Roles change freely where a row
begins, and seldom inside one: there a marker has to say so. The model is counted on labelled rows; Viterbi finds the likeliest
roles of a conversation, and neighbouring lines of one role make a turn. A conversation of any length is cut into blocks of
rows: a block's best scores between all pairs of roles are a small matrix, the matrices of a conversation's blocks are joined,
and each block is then decoded between its outer roles. All blocks of an Arrow batch are decoded in step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, materialize

ROLES = ("system", "user", "assistant")
#: Turn numbers of a block.
BLOCK = 512
SMOOTHING = 0.5
#: Chances that the speaker changes at a line inside a row, without and with a marker, and how sure a marker is of its speaker.
SWITCH, MARKED_SWITCH, MARKED = 0.001, 0.03, 0.999
#: Words of speaker markers, by role.
SPEAKERS = {"system": "system|instructions?", "user": "user|human|question|q|customer", "assistant": "assistant|ai|bot|answer|a|agent"}


def _marker(words: str) -> str:
    """A marker at the start of a line: `User:`, `### Assistant`, `[system]`, `<|user|>`, `**AI**:`."""
    return rf"(?i)^\s*(?:#{{1,4}}\s*|\[|<\|?|\*\*)?(?:{words})(?:(?:\]|\|?>|\*\*)\s*:?|\s*(?::|$))"


MARKERS = {role: _marker(words) for role, words in SPEAKERS.items()}
ANY_MARKER = _marker("|".join(SPEAKERS.values()))
NO_TURN = -1


def _lines(text: Column) -> Column:
    """A text's lines; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _observation(line: Column, at: Column) -> Column:
    """One small string: whether a row begins, marker, length class."""
    marker = F.lit("-")
    for role, pattern in MARKERS.items():
        marker = F.when(line.rlike(pattern), F.lit(role)).otherwise(marker)
    length = F.floor(F.log2(F.length(line) + 1)).cast("string")
    return F.concat(F.when(at == 0, F.lit("row|")).otherwise(F.lit("line|")), marker, F.lit("|"), length)


def fit(turns: DataFrame) -> dict:
    """Log chances from labelled rows (conv_id, turn, role, text): first role, next role, and a line's observation by role.

    Rows with another role, or none, don't count. Counts cover all rows; there are few distinct observations.
    """
    known = turns.where(F.col("role").isin(*ROLES))
    seen = known.select("role", F.explode(F.transform(_lines(F.col("text")), _observation)).alias("o")).groupBy("role", "o").agg(F.count("*").alias("n")).collect()
    per = known.groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    # Turns that follow one another by number, joined on it: no window over a whole conversation.
    a, b = per.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("r")), per.select("conv_id", "turn", F.col("role").alias("s"))
    steps = a.join(b, ["conv_id", "turn"]).groupBy("r", "s").agg(F.count("*").alias("n")).collect()
    first = known.groupBy("conv_id").agg(F.min(F.struct("turn", "role"))["role"].alias("r")).groupBy("r").agg(F.count("*").alias("n")).collect()
    k = len(ROLES)
    start, move = np.full(k, SMOOTHING), np.full((k, k), SMOOTHING)
    for r in first:
        start[ROLES.index(r["r"])] += r["n"]
    for r in steps:
        move[ROLES.index(r["r"]), ROLES.index(r["s"])] += r["n"]
    kinds = sorted({r["o"] for r in seen})
    emit = {o: np.full(k, SMOOTHING) for o in kinds}
    for r in seen:
        emit[r["o"]][ROLES.index(r["role"])] += r["n"]
    total = sum(emit.values(), np.full(k, SMOOTHING))
    # An observation that training hasn't shown says nothing of the role; a marker names its speaker, seen or not.
    rest = (1 - MARKED) / (k - 1)
    loud = {m: np.log(np.array([MARKED if r == m else rest for r in ROLES])) for m in ROLES}
    move = move / move.sum(1, keepdims=True)
    return {
        "start": np.log(start / start.sum()), "move": np.log(move), "inside": np.log((1 - SWITCH) * np.eye(k) + SWITCH * move), "marked": np.log((1 - MARKED_SWITCH) * np.eye(k) + MARKED_SWITCH * move),
        "emit": {o: np.log(e / total) for o, e in emit.items()}, "other": np.zeros(k), "loud": loud,
    }


def _emissions(model: dict, observation: str) -> np.ndarray:
    e = model["emit"].get(observation, model["other"])
    marker = observation.split("|")[1]
    return e + model["loud"][marker] if marker in model["loud"] else e


class _Runs:
    """Consecutive rows of one (conv, block) each, as lines: flat scores, the kind of move to each line, first line and length of each run."""

    def __init__(self, table: pa.Table, model: dict):
        conv, block = table.column("conv").to_numpy(zero_copy_only=False), table.column("block").to_numpy()
        fresh = np.ones(len(conv), dtype=bool)
        fresh[1:] = (conv[1:] != conv[:-1]) | (block[1:] != block[:-1])
        lists = table.column("o").combine_chunks()
        codes = lists.flatten().dictionary_encode()
        listed = np.array([_emissions(model, o) for o in codes.dictionary.to_pylist()]).reshape(-1, len(ROLES))
        self.scores = listed[codes.indices.to_numpy()]
        self.bounds = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        marked = np.array([o.split("|")[1] != "-" for o in codes.dictionary.to_pylist()], dtype=np.int64)
        self.kind = 1 + marked[codes.indices.to_numpy()]
        self.kind[self.bounds[:-1]] = 0
        self.row = np.flatnonzero(fresh)
        self.first = self.bounds[self.row]
        self.length = np.diff(np.append(self.first, len(self.scores)))
        self.table, self.model = table, model

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """From the second line on: the runs that have one there, the lines, and the moves to them."""
        moves = np.stack([self.model[c] for c in ("move", "inside", "marked")])
        for t in range(1, int(self.length.max(initial=0))):
            on = np.flatnonzero(self.length > t)
            line = self.first[on] + t
            yield on, line, moves[self.kind[line]]


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end where a (conv, block) does; rows come sorted by it."""
    held: pa.Table | None = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        conv, block = table.column("conv").to_numpy(zero_copy_only=False), table.column("block").to_numpy()
        last = np.flatnonzero((conv != conv[-1]) | (block != block[-1]))
        end = int(last[-1]) + 1 if len(last) else 0
        if end:
            yield table.slice(0, end)
        held = table.slice(end)
    if held is not None and len(held):
        yield held


def _summaries(model: dict):
    """Per block the best score from the role of its first line to that of its last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(ROLES)
        for table in _whole_runs(batches):
            runs = _Runs(table, model)
            m = np.where(np.eye(k, dtype=bool), runs.scores[runs.first][:, :, None], -np.inf)
            for on, line, moves in runs.steps():
                m[on] = (m[on][:, :, :, None] + moves[:, None]).max(2) + runs.scores[line][:, None]
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * k * k), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays([table.column(c).combine_chunks().take(pa.array(runs.row)) for c in ("conv", "block")] + [flat], names=["conv", "block", "m"])

    return run


def _joiner(model: dict):
    """Per conversation of several blocks: the role before each block (-1: none) and at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(ROLES)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                blocks = sorted(row["blocks"], key=lambda b: b["block"])
                now, backs = model["start"], []
                for i, b in enumerate(blocks):
                    enter = now if i == 0 else (now[:, None] + model["move"]).max(0)
                    came = np.zeros(k, dtype=int) - 1 if i == 0 else (now[:, None] + model["move"]).argmax(0)
                    via = enter[:, None] + np.array(b["m"]).reshape(k, k)
                    backs.append((via.argmax(0), came))
                    now = via.max(0)
                state = int(now.argmax())
                for b, (first, came) in zip(blocks[::-1], backs[::-1], strict=True):
                    before = int(came[first[state]])
                    out.append((row["conv"], b["block"], before, state))
                    state = before
            conv, block, before, last = list(zip(*out, strict=True)) or ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(conv, pa.string()), pa.array(block, pa.int64()), pa.array(before, pa.int32()), pa.array(last, pa.int32())], names=["conv", "block", "before", "last"])

    return run


def _decoder(model: dict):
    """Per row the roles of its lines as runs: from (line, from 0), role, starts (whether the speaker changed there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(ROLES)
        for table in _whole_runs(batches):
            runs = _Runs(table, model)
            n = len(runs.row)
            before, last = (table.column(c).combine_chunks().take(pa.array(runs.row)).fill_null(-1).to_numpy(zero_copy_only=False) for c in ("before", "last"))
            start = np.where((before >= 0)[:, None], model["move"][before], model["start"])
            now = start + runs.scores[runs.first]
            back = np.zeros((len(runs.scores), len(ROLES)), dtype=np.int8)
            for on, line, moves in runs.steps():
                via = now[on][:, :, None] + moves
                back[line] = via.argmax(1)
                now[on] = via.max(1) + runs.scores[line]
            state = np.where(last >= 0, last, now.argmax(1))
            path = np.zeros(len(runs.scores), dtype=np.int64)
            for t in range(int(runs.length.max(initial=0)) - 1, -1, -1):
                on = np.flatnonzero(runs.length > t)
                line = runs.first[on] + t
                path[line] = state[on]
                state[on] = back[line, state[on]]
            previous = np.concatenate([[-1], path[:-1]])
            previous[runs.first] = before[:n]
            starts = path != previous
            cut = starts.copy()
            cut[runs.bounds[:-1]] = True
            at = np.flatnonzero(cut)
            row = np.searchsorted(runs.bounds, at, side="right") - 1
            parts = pa.StructArray.from_arrays([pa.array((at - runs.bounds[row]).astype(np.int32)), pa.array(names[path[at]]), pa.array(starts[at])], names=["from", "role", "starts"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(table) + 1)).astype(np.int32)), parts)
            yield pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks() for c in ("conv", "t", "h")), lists], names=["conv", "t", "h", "parts"])

    return run


def recover_roles(turns: DataFrame, model: dict) -> DataFrame:
    """A row per turn found: conv_id, turn, part (from 0 in its row), role, starts (whether the speaker changed) and rendered.

    Reads conv_id, turn and text; a role column is not looked at. Rows go by number, null first, and those with the same
    number by a hash of the text; lines go in order. A row whose lines have several speakers gives a part for each run of
    one speaker, any other row one part. Rows equal in conversation, number and text are one for the model, and each gets its result. A
    null conv_id is a conversation of its own. Null and empty texts are one empty line; long texts are read whole. rendered
    is the lines without their markers, after a header where the speaker changed. An empty table gives no rows.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    at = F.coalesce(F.col("turn").cast("long"), F.lit(NO_TURN)).cast("long")
    rows = turns.select("conv_id", "turn", "text", key.alias("conv"), at.alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    seen = rows.select("conv", "t", "h", F.transform(_lines(F.col("text")), _observation).alias("o")).dropDuplicates(["conv", "t", "h"])
    seen = materialize(seen.select("conv", "t", "h", F.floor(F.col("t") / BLOCK).alias("block"), "o"), "chat-lines")
    dealt = lambda df: df.repartition("conv", "block").sortWithinPartitions("conv", "block", "t", "h")
    several = seen.groupBy("conv").agg(F.min("block").alias("a"), F.max("block").alias("b")).where("a <> b").select("conv")
    summary = in_arrow(dealt(seen.join(several, "conv", "left_semi")), _summaries(model), "conv string, block long, m array<double>")
    long_ones = summary.groupBy("conv").agg(F.collect_list(F.struct("block", "m")).alias("blocks"))
    outer = in_arrow(long_ones, _joiner(model), "conv string, block long, before int, last int")
    decoded = in_arrow(dealt(seen.join(outer, ["conv", "block"], "left")), _decoder(model), "conv string, t long, h long, parts array<struct<from:int,role:string,starts:boolean>>")
    found = rows.join(decoded, ["conv", "t", "h"]).withColumn("lines", _lines(F.col("text"))).select("conv_id", "turn", "lines", "parts", F.posexplode("parts").alias("part", "p"))
    end = F.coalesce(F.get("parts", F.col("part") + 1)["from"], F.size("lines"))
    body = F.array_join(F.transform(F.slice("lines", F.col("p.from") + 1, end - F.col("p.from")), lambda x: F.regexp_replace(x, ANY_MARKER, "")), "\n")
    header = F.when(F.col("p.starts"), F.concat(F.lit("<|"), F.col("p.role"), F.lit("|>\n"))).otherwise(F.lit(""))
    trimmed = F.regexp_replace(body, r"^\s+|\s+$", "")
    return found.select("conv_id", "turn", "part", F.col("p.role").alias("role"), F.col("p.starts").alias("starts"), F.concat(header, trimmed, F.lit("\n")).alias("rendered"))


def training_turns(turns: DataFrame) -> DataFrame:
    """Labelled turns to fit on: three quarters of the conversations, by crc32 of the id."""
    return turns.where(F.coalesce(F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4)) != 2, F.lit(False)))
