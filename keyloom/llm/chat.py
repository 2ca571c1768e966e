"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

States are (role, first line of a turn) and (role, later line). Emissions are the speaker marker at the
start of a line and features of the line. Viterbi runs in blocks: a block of lines is a max-plus matrix
from the state before it to the state at its end; matrices are combined in groups of bounded size,
level by level, and best paths are handed down again. Blocks are cut by the rank of rows in the order of
all conversations, which range partitions count out, so no conversation, however long, and no turn,
however often it is repeated, meets in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import by_group, checkpointed, exact, exact_longs, written

ROLES = ("system", "user", "assistant")
# Words that mark speakers.
SPEAKERS = {"system": "system", "user": "user", "human": "user", "prompter": "user", "assistant": "assistant", "ai": "assistant", "bot": "assistant"}
MARKER = re.compile(r"^\s*(?:<\|?|\[|\*\*|#+\s*)?\s*(" + "|".join(SPEAKERS) + r")\s*(?:\|?>|\]|\*\*)?\s*(?::|(?<=>)|(?<=\]))\s*", re.I)
S = 2 * len(ROLES)
BEGIN = S  # the state before the first line
#: Number of values of each feature: marker (none or a role), length, ends as a question, first letter upper.
FEATURES = (1 + len(ROLES), 5, 2, 2)


def features(line: str) -> tuple[int, ...]:
    m = MARKER.match(line)
    rest = (line[m.end() :] if m else line).strip()
    marker = 1 + ROLES.index(SPEAKERS[m[1].lower()]) if m else 0
    return marker, min(4, len(rest).bit_length() // 2), int(rest.endswith("?")), int(rest[:1].isupper())


def text_lines(text: str | None) -> list[str]:
    return text.split("\n") if isinstance(text, str) else [""]


class Model:
    """log probabilities: step (states and BEGIN, to states and BEGIN), emit (states x values of each feature)."""

    def __init__(self, step: np.ndarray, emit: list[np.ndarray]):
        self.step, self.emit = step, emit

    def emissions(self, lines: list[str]) -> np.ndarray:
        f = np.array([features(x) for x in lines])
        return np.pad(sum(e[:, f[:, i]].T for i, e in enumerate(self.emit)), ((0, 0), (0, 1)))


def fit(turns: DataFrame, smoothing: float = 0.5) -> Model:
    """Counts over turns (conv_id, turn, role, text) with a known role; lines of the text as a transcript has them.

    Follow-ups are found by a join of turn with turn + 1, so a long conversation is no long group.
    """
    known = turns.filter(F.col("role").isin(*ROLES)).select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int, int], int] = {}
        for b in batches:
            for role, text in zip(b["role"], b["text"], strict=True):
                r = ROLES.index(role)
                for i, line in enumerate(text_lines(text)):
                    for k, v in enumerate(features(line)):
                        key = 2 * r + (i > 0), k, v
                        total[key] = total.get(key, 0) + 1
        yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["state", "feature", "value", "n"])

    seen = known.select("role", "text").mapInPandas(run, "state int, feature int, value int, n long")
    emit = [np.full((S, n), smoothing) for n in FEATURES]
    for r in seen.groupBy("state", "feature", "value").agg(F.sum("n").alias("n")).collect():  # states times values
        emit[r["feature"]][r["state"], r["value"]] += r["n"]
    known_markers = 5.0  # as if so many first lines had been seen with the marker of their own role, and later ones without
    first = np.array([[emit[0][2 * r].sum(), emit[0][2 * r + 1].sum()] for r in range(len(ROLES))])  # first and later lines
    emit[0][range(0, S, 2), range(1, 1 + len(ROLES))] += known_markers
    emit[0][1::2, 0] += known_markers

    after = known.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    change = np.full((len(ROLES), len(ROLES)), smoothing)
    for r in known.select("conv_id", "turn", "role").join(after, ["conv_id", "turn"]).groupBy("role", "next").count().collect():
        change[ROLES.index(r["role"]), ROLES.index(r["next"])] += r["count"]
    opens = np.full(len(ROLES), smoothing)
    for r in known.groupBy("conv_id").agg(F.min(F.struct("turn", "role")).alias("f")).groupBy("f.role").count().collect():
        opens[ROLES.index(r["role"])] += r["count"]

    more = first[:, 1] / first.sum(axis=1)  # that a line is followed by another of its turn
    step = np.full((S + 1, S + 1), -np.inf)
    for a in range(len(ROLES)):
        for i in (0, 1):
            step[2 * a + i, 2 * a + 1] = np.log(more[a])
            step[2 * a + i, 0:S:2] = np.log((1 - more[a]) * change[a] / change[a].sum())
    step[BEGIN, 0:S:2] = np.log(opens / opens.sum())
    return Model(step, [np.log(e / e.sum(axis=1, keepdims=True)) for e in emit])


def max_plus(m: np.ndarray) -> np.ndarray:
    """The max-plus product of matrices (n, states, states) in order, neighbours in pairs."""
    while len(m) > 1:
        even = len(m) // 2 * 2
        pairs = (m[0:even:2, :, :, None] + m[1:even:2, None, :, :]).max(axis=2)
        m = pairs if even == len(m) else np.concatenate([pairs, m[even:]])
    return m[0]


def best_path(enter: np.ndarray, steps: list[np.ndarray], end: int | None) -> list[tuple[np.ndarray, int]]:
    """For each step matrix the scores before it and the best state after it, the last one being ``end`` (None: the best)."""
    scores = [enter]
    for m in steps:
        scores.append((scores[-1][:, None] + m).max(axis=0))
    at = int(np.argmax(scores[-1])) if end is None else end
    out = []
    for before, m in zip(reversed(scores[:-1]), reversed(steps), strict=True):
        out.append((before, at))
        at = int(np.argmax(before + m[:, at]))
    return out[::-1]


def line_matrices(model: Model, lines: list[str]) -> list[np.ndarray]:
    return [model.step + e[None, :] for e in model.emissions(lines)]


def in_parts(lines: list[str], most: int = 2048) -> Iterator[list[str]]:
    return (lines[i : i + most] for i in range(0, len(lines), most))


def line_path(model: Model, lines: list[str], score: np.ndarray, end: int) -> list[int]:
    """The best state of every line, the last one being ``end``; a line keeps one state a state only."""
    back, at = np.empty((len(lines), S + 1), np.int8), 0
    for part in in_parts(lines):
        for e in model.emissions(part):
            met = score[:, None] + model.step
            back[at] = met.argmax(axis=0)
            score, at = met.max(axis=0) + e, at + 1
    out = []
    for came in back[::-1]:
        out.append(end)
        end = int(came[end])
    return out[::-1]


def grouped(df: DataFrame, keys: list[str], order: list[str], f, schema: str) -> DataFrame:
    """f on every group of rows with equal keys, in order; many groups share a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in by_group(batches, keys):
            yield f(g)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def ranked_blocks(turns: DataFrame, rows: int) -> DataFrame:
    """conv_id, no_conv_id, turn, no_turn, text, rank and b0, the block: at most ``rows`` rows of one conversation.

    Rows are range-partitioned and sorted by conversation, turn and text; a partition's ranks start where
    those before it end. Equal rows are told apart by a number of their own, so they can be parted too.
    """
    order = ["no_conv_id", "conv_id", F.desc("no_turn"), "turn", "text", "tie"]
    keyed = turns.select(*exact("conv_id"), *exact("turn"), "text", F.monotonically_increasing_id().alias("tie"))
    keyed = keyed.withColumn("conv_id", F.when(F.col("no_conv_id"), F.col("tie")).otherwise(F.col("conv_id")))  # each its own conversation
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie").withColumn("place", F.monotonically_increasing_id())
    placed = written(placed)  # a place is the partition's number and, in 33 bits, the row's in it
    part = F.shiftright("place", 33).cast("int")
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy(part.alias("part")).count().collect())  # a row per partition
    starts, rank = [], 0
    for number, n in sizes:
        starts.append((number, rank))
        rank += n
    starts = F.broadcast(turns.sparkSession.createDataFrame(starts, "part int, start long"))
    ranked = placed.withColumn("part", part).join(starts, "part").withColumn("rank", F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1))
    return ranked.withColumn("b0", F.floor(F.col("rank") / rows).cast("long")).drop("part", "start", "place")


def parse(turns: DataFrame, model: Model, rows: int = 32, fan_in: int = 64) -> DataFrame:
    """conv_id, turn, role, starts, rendered for every row of turns (conv_id, turn, text).

    The rows of a conversation, in order of turn, are pieces of a transcript; where turns begin is found
    from the lines, not from the rows. role is that of the row's first line, ``starts`` whether it begins
    a turn, and ``rendered`` the row's lines with a canonical header where a turn begins and without
    markers, so the rows of a conversation together are its canonical text. A row with a null
    conv_id is a conversation of its own, null turns come first; null texts are an empty line; equal turns
    are ordered by text, and repeated rows follow each other; an empty table gives no rows. Other columns of
    turns do not matter.
    """
    numbered = ranked_blocks(turns, rows)
    shared = turns.sparkSession.sparkContext.broadcast(model)

    def shorten(g: pd.DataFrame) -> pd.DataFrame:
        lines = [x for text in g["text"] for x in text_lines(text)]
        m = max_plus(np.array([max_plus(shared.value.step + shared.value.emissions(part)[:, None, :]) for part in in_parts(lines)]))
        return g[conv].head(1).assign(b=g["b0"].iloc[0], m=[m.ravel()])

    def combine(g: pd.DataFrame) -> pd.DataFrame:
        m = max_plus(np.stack(g["m"].to_list()).reshape(len(g), S + 1, S + 1))
        return g[conv].head(1).assign(b=g["up"].iloc[0], m=[m.ravel()])

    conv = ["no_conv_id", "conv_id"]
    shape = "no_conv_id boolean, conv_id long, b long, m array<double>"
    levels = [checkpointed(grouped(numbered, [*conv, "b0"], ["rank"], shorten, shape))]
    up = F.floor(F.col("b") / fan_in).cast("long")
    while (levels[-1].groupBy(*conv).count().agg(F.max("count")).first()[0] or 0) > fan_in:
        levels.append(checkpointed(grouped(levels[-1].withColumn("up", up), [*conv, "up"], ["b"], combine, shape)))

    def hand_down(g: pd.DataFrame) -> pd.DataFrame:
        enter, end = (np.asarray(g["enter"].iloc[0]), int(g["end"].iloc[0])) if g["enter"].iloc[0] is not None else (np.r_[np.full(S, -np.inf), 0.0], None)
        path = best_path(enter, [np.asarray(x).reshape(S + 1, S + 1) for x in g["m"]], end)
        return g[[*conv, "b"]].assign(enter=[e for e, _ in path], end=[s for _, s in path])

    shape = "no_conv_id boolean, conv_id long, b long, enter array<double>, end int"
    top = levels[-1].withColumns({"up": F.lit(0).cast("long"), "enter": F.lit(None).cast("array<double>"), "end": F.lit(None).cast("int")})
    states = grouped(top, [*conv, "up"], ["b"], hand_down, shape)
    for below in reversed(levels[:-1]):
        given = states.withColumnRenamed("b", "up")
        met = below.withColumn("up", up).join(given, [*conv, "up"])
        states = grouped(met, [*conv, "up"], ["b"], hand_down, shape)

    def render(g: pd.DataFrame) -> pd.DataFrame:
        texts = [text_lines(t) for t in g["text"]]
        path = line_path(shared.value, [x for t in texts for x in t], np.asarray(g["enter"].iloc[0]), int(g["end"].iloc[0]))
        out, at = [], 0
        for t in texts:
            own, at = path[at : at + len(t)], at + len(t)
            shown = [canonical(line, s) for line, s in zip(t, own, strict=True)]
            out.append((ROLES[own[0] // 2], own[0] % 2 == 0, "\n".join(shown)))
        out = pd.DataFrame(out, columns=["role", "starts", "rendered"])
        out.insert(0, "turn", exact_longs(g, "turn").array)
        out.insert(0, "conv_id", exact_longs(g, "conv_id").array)
        return out

    met = numbered.join(states.withColumnRenamed("b", "b0"), [*conv, "b0"])
    return grouped(met, [*conv, "b0"], ["rank"], render, "conv_id long, turn long, role string, starts boolean, rendered string")


def canonical(line: str, state: int) -> str:
    """A line as canonical turns show it: a header before a turn's first line, speaker markers taken off there."""
    if state % 2:
        return line
    m = MARKER.match(line)
    return f"<|{ROLES[state // 2]}|>\n{line[m.end() :] if m else line}"


def transcript(turns: DataFrame, every: int = 3) -> DataFrame:
    """turns (conv_id, turn, role, text) as pieces of a transcript: "Role: text", but without the marker for one row
    in ``every`` by a hash of its place, so that roles must be recovered."""
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(every)) == 0
    text = F.coalesce("text", F.lit(""))
    return turns.withColumn("text", F.when(bare | F.col("role").isNull(), text).otherwise(F.concat(F.initcap("role"), F.lit(": "), text)))
