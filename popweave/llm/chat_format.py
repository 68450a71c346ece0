"""Chat formatting from raw transcripts (operator 9).

Method: a hidden Markov model over the lines of a transcript. A state is a role and whether
the line begins a turn or goes on with it; a line shows its speaker marker ("User:",
"### Assistant:", ...), its length in words (binary logarithm) and whether it asks. The model
is learned from counts over all labelled lines; Viterbi recovers the most probable states, and
turns are rendered in one canonical form without their markers.

Lines are numbered over the whole table and decoded in blocks of ``block`` lines. A conversation
that crosses blocks (one may hold a third of all rows) is first summed up by one matrix per
block, the best score from each first to each last state; chaining those matrices fixes the
states at the block edges, and every block is then decoded on its own with the same result as in
one piece. The chain of a conversation has one small matrix per ``block`` of its lines.

Defined cases: null and empty texts are one empty line; null or unknown roles give a line
without a known marker, which the model places; repeated rows (same conversation, turn, role
and text) count once, other rows of one turn follow each other by role and text hash; null
conversation ids form one conversation; with no labelled line roles are uniform; very long
turns stay whole in the result; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popweave.llm.common import positions, prepare, read
from popweave.session import materialize

ROLES = ("system", "user", "assistant")
#: Usual spellings of speaker markers.
MARKERS = {
    "system": "system", "instruction": "system", "instructions": "system", "context": "system",
    "user": "user", "human": "user", "prompter": "user", "question": "user", "q": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant",
    "answer": "assistant", "a": "assistant",
}
MARK = r"^\s*[#*<\[|]*\s*(\w+)\s*[*>\]|]*\s*:[*]*\s?"
LENGTHS = 8  # buckets of the number of words
NONE = len(ROLES)  # the marker of a line without a known one
NOISE = 0.02  # share of lines whose marker says nothing, mixed into what was learned
STATES = 2 * len(ROLES)  # 2 * role + (0: begins a turn, 1: goes on)


def lines(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv, turn, role, th, line, raw): the transcript's lines; the first of a turn carries
    the speaker as a marker, as raw transcripts do."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    each = rows.select("conv", "turn", "role", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("line", "l"))
    marked = F.when((F.col("line") == 0) & F.col("role").isNotNull(), F.concat("role", F.lit(": "), "l")).otherwise(F.col("l"))
    return each.select("conv", "turn", "role", "th", "line", marked.alias("raw"))


def observed(df: DataFrame) -> DataFrame:
    """Add what a line shows: ``marker``, ``length``, ``asks``; ``text`` is the line without marker."""
    name = F.lower(F.regexp_extract("raw", MARK, 1))
    marker: Column = F.lit(NONE)
    for spelled, role in MARKERS.items():
        marker = F.when(name == spelled, ROLES.index(role)).otherwise(marker)
    out = df.withColumn("marker", marker)
    out = out.withColumn("text", F.when(F.col("marker") == NONE, F.col("raw")).otherwise(F.regexp_replace("raw", MARK, "")))
    n = F.size(F.split("text", " "))
    return (out.withColumn("length", F.least(F.floor(F.log2(n)), F.lit(LENGTHS - 1)).cast("int"))
            .withColumn("asks", F.col("text").rlike(r"\?\s*$").cast("int")))


class Model:
    """Log probabilities learned from counts; add-one smoothing throughout."""

    def __init__(self, starts: dict, steps: dict, shows: dict):
        n = len(ROLES)
        first = np.array([starts.get(r, 0) + 1.0 for r in range(n)])
        self.start = np.full(STATES, -np.inf)
        self.start[0::2] = np.log(first / first.sum())
        step = np.ones((STATES, STATES))
        for (a, b), c in steps.items():
            step[a, b] += c
        legal = np.array([[t % 2 == 0 or t // 2 == s // 2 for t in range(STATES)] for s in range(STATES)])
        step = np.where(legal, step, 0)
        with np.errstate(divide="ignore"):
            self.step = np.log(step / step.sum(axis=1, keepdims=True))
        self.length, self.asks = np.ones((STATES, LENGTHS)), np.ones((STATES, 2))
        self.mark = np.ones((STATES, n + 1))
        for (s, marker, length, asks), c in shows.items():
            self.mark[s, marker] += c
            self.length[s, length] += c
            self.asks[s, asks] += c
        self.length = np.log(self.length / self.length.sum(axis=1, keepdims=True))
        self.asks = np.log(self.asks / self.asks.sum(axis=1, keepdims=True))
        # transcripts to come may lack markers more often than those learned from
        mark = self.mark / self.mark.sum(axis=1, keepdims=True)
        self.mark = np.log((1 - NOISE) * mark + NOISE / (n + 1))

    def emit(self, marker: np.ndarray, length: np.ndarray, asks: np.ndarray) -> np.ndarray:
        return (self.mark[:, marker] + self.length[:, length] + self.asks[:, asks]).T

    def matrix(self, e: np.ndarray) -> np.ndarray:
        """Best scores from each first to each last state of a stretch."""
        m = np.where(np.eye(STATES, dtype=bool), e[0][None, :], -np.inf)
        for x in e[1:]:
            m = (m[:, :, None] + self.step[None]).max(axis=1) + x[None]
        return m

    def decode(self, e: np.ndarray, first: int | None = None, last: int | None = None) -> np.ndarray:
        """Viterbi; ``first`` and ``last`` fix the states at the ends of a stretch."""
        back = np.zeros(e.shape, np.int64)
        v = self.start + e[0] if first is None else np.where(np.arange(STATES) == first, e[0], -np.inf)
        for i in range(1, len(e)):
            w = v[:, None] + self.step
            back[i] = w.argmax(axis=0)
            v = w.max(axis=0) + e[i]
        states = np.empty(len(e), np.int64)
        states[-1] = int(v.argmax()) if last is None else last
        for i in range(len(e) - 1, 0, -1):
            states[i - 1] = back[i, states[i]]
        return states

    def chain(self, matrices: list[np.ndarray]) -> tuple[list[int], list[int]]:
        """First and last states of consecutive stretches of one conversation."""
        v, back = None, []
        for m in matrices:
            into = self.start if v is None else (v[:, None] + self.step).max(axis=0)
            came = None if v is None else (v[:, None] + self.step).argmax(axis=0)
            w = into[:, None] + m
            back.append((came, w.argmax(axis=0)))
            v = w.max(axis=0)
        first, last = [0] * len(back), [0] * len(back)
        at = int(v.argmax())
        for i in range(len(back) - 1, -1, -1):
            came, start = back[i]
            last[i], first[i] = at, int(start[at])
            if came is not None:
                at = int(came[first[i]])
        return first, last


def learn(numbered: DataFrame) -> Model:
    """Counts over all labelled lines of (pos, conv, role, line, marker, length, asks)."""
    role = F.lit(None).cast("int")
    for i, r in enumerate(ROLES):
        role = F.when(F.lower("role") == r, i).otherwise(role)
    own = numbered.select("pos", "conv", "marker", "length", "asks", (role * 2 + F.least("line", F.lit(1))).alias("s"))
    # neighbours by position: an equi-join, however long a conversation is
    last = own.select((F.col("pos") + 1).alias("pos"), F.col("conv").alias("lc"), F.col("s").alias("ls"), F.lit(True).alias("has"))
    pairs = own.join(last, "pos", "left")
    begins = F.col("has").isNull() | ~F.col("lc").eqNullSafe(F.col("conv"))
    steps = pairs.filter(F.col("s").isNotNull()).groupBy(F.when(begins, -1).otherwise(F.col("ls")).alias("a"), "s").count()
    start, step = {}, {}
    for a, s, c in steps.collect():  # at most seven by six rows
        if a == -1:
            start[s // 2] = start.get(s // 2, 0) + c
        elif a is not None:
            step[a, s] = c
    shows = {tuple(r[:4]): r[4] for r in own.filter("s IS NOT NULL").groupBy("s", "marker", "length", "asks").count().collect()}
    return Model(start, step, shows)


def parse(transcript: DataFrame, block: int = 4096) -> DataFrame:
    """(conv, turn, pos, start_pos, role, text) per line of ``lines``: the recovered role and the
    position of its turn's first line."""
    numbered = materialize(positions(observed(transcript), ["conv", "turn", "role", "th", "line"])
                           .withColumn("block", F.floor(F.col("pos") / block)), "numbered")
    model = learn(numbered)
    shared = transcript.sparkSession.sparkContext.broadcast(model)
    kind = numbered.schema["conv"].dataType.simpleString()

    def stretches(table: pa.Table):
        table = table.sort_by("pos").combine_chunks()
        e = shared.value.emit(*(table.column(c).to_numpy() for c in ("marker", "length", "asks")))
        conv = table.column("conv").to_pylist()
        cuts = [0] + [i for i in range(1, len(conv)) if conv[i] != conv[i - 1]] + [len(conv)]
        return table, e, conv, list(zip(cuts, cuts[1:]))

    def edges(table: pa.Table) -> pa.Table:
        table, e, conv, cut = stretches(table)
        rows = [(conv[i], table.column("block")[0].as_py(), shared.value.matrix(e[i:j]).ravel().tolist())
                for i, j in dict.fromkeys([cut[0], cut[-1]])]
        return pa.table({"conv": pa.array([r[0] for r in rows], table.schema.field("conv").type),
                         "block": pa.array([r[1] for r in rows], pa.int64()),
                         "m": pa.array([r[2] for r in rows], pa.list_(pa.float64()))})

    def chained(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        first, last = shared.value.chain([np.array(m).reshape(STATES, STATES) for m in table.column("m").to_pylist()])
        return pa.table({"conv": table.column("conv"), "block": table.column("block"),
                         "first": pa.array(first, pa.int32()), "last": pa.array(last, pa.int32())})

    narrow = numbered.select("conv", "pos", "block", "marker", "length", "asks")
    matrices = narrow.groupBy("block").applyInArrow(edges, f"conv {kind}, block long, m array<double>")
    fixed = matrices.groupBy("conv").applyInArrow(chained, f"conv {kind}, block long, first int, last int")
    fixed = fixed.select(F.col("conv").alias("fc"), F.col("block").alias("fb"), "first", "last")

    def decoded(table: pa.Table) -> pa.Table:
        table, e, _, cut = stretches(table)
        first, last = table.column("first").to_pylist(), table.column("last").to_pylist()
        states = np.concatenate([shared.value.decode(e[i:j], first[i], last[i]) for i, j in cut])
        pos = table.column("pos").to_numpy()
        start = [None] * len(states)
        for i, j in cut:
            at = None
            for k in range(i, j):
                at = int(pos[k]) if states[k] % 2 == 0 else at
                start[k] = at
        return pa.table({"conv": table.column("conv"), "block": table.column("block"), "pos": table.column("pos"),
                         "r": pa.array(states // 2, pa.int32()), "own_start": pa.array(start, pa.int64())})

    known = narrow.join(fixed, narrow.conv.eqNullSafe(F.col("fc")) & (narrow.block == F.col("fb")), "left").drop("fc", "fb")
    roles = materialize(known.groupBy("block").applyInArrow(
        decoded, f"conv {kind}, block long, pos long, r int, own_start long"), "roles")
    # turns that go on over a block's edge: the last turn begun in an earlier block of the
    # conversation; one row per conversation and block
    seen = roles.groupBy("conv", "block").agg(F.max("own_start").alias("m"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = seen.select(F.col("conv").alias("cc"), F.col("block").alias("cb"), F.max("m").over(before).alias("carried")).filter("carried IS NOT NULL")
    roles = roles.join(carried, roles.conv.eqNullSafe(F.col("cc")) & (roles.block == F.col("cb")), "left")
    named = F.element_at(F.array(*map(F.lit, ROLES)), F.col("r") + 1)
    return (numbered.select("conv", "turn", "pos", "text")
            .join(roles.select("pos", named.alias("role"), F.coalesce("own_start", "carried", "pos").alias("start_pos")), "pos"))


def render(parsed: DataFrame) -> DataFrame:
    """(conv, turn, role, text, rendered, pos): one row per recovered turn, its lines in order."""
    turn = parsed.groupBy("conv", "start_pos", "role").agg(
        F.min("turn").alias("turn"), F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("l"))
    text = F.trim(F.array_join(F.transform("l", lambda x: x["text"]), "\n"))
    return turn.select("conv", "turn", "role", text.alias("text"),
                       F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), text, F.lit("<|im_end|>\n")).alias("rendered"),
                       F.col("start_pos").alias("pos"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return render(parse(lines(read(spark, sf_dir, "conversations")))).select(
        F.col("conv").alias("conv_id"), "turn", "role", "rendered")
