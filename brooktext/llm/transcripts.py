"""Chat transcripts to canonical turns, with roles recovered by a hidden Markov model.

A row is a piece of a transcript: a turn, or many. Its text is cut into parts
at lines that begin with a speaker marker (``User:``, ``### Assistant:``,
``<|im_start|>system`` and the like). The hidden state of a part is its role.
Observed are its marker and features of its lines: length, number of lines,
how they end, and how they begin. Start, transition and emission
probabilities are counted over all rows that have a known role and whose
``crc32(conv_id)`` is not divisible by 5; markers have a prior, so they count
where no row shows any. Given roles are never an input of decoding. Viterbi
decodes a whole conversation, then each part is rendered alike.

Scale. Only features travel to be decoded (some 40 bytes a part); text meets
the roles in one join by conversation and turn. A conversation is decoded in
blocks by different tasks: transfer matrices of the blocks, a pass over these
few numbers for each conversation of several blocks, and the decoding of all
blocks. A block is a range of ``BLOCK`` turn numbers; one of too many parts
(null or repeated turns, long rows) is cut at its turns, a turn at ranges of
the hash that orders its texts, and these at texts and their parts. So no task
holds a whole very long conversation, turn or row of parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooktext.llm.arrays import mix
from brooktext.llm.chains import viterbi
from brooktext.sources.workspace import discard, materialize

ROLES = ("system", "user", "assistant", "tool")
# Other names of the roles, as speakers are marked in transcripts.
NAMES = {
    "system": "system", "context": "system", "instruction": "system", "instructions": "system",
    "user": "user", "human": "user", "customer": "user", "question": "user", "q": "user", "prompter": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant",
    "answer": "assistant", "a": "assistant", "response": "assistant", "agent": "assistant", "chatbot": "assistant",
    "tool": "tool", "function": "tool", "observation": "tool",
}
_WORDS = "|".join(sorted(NAMES, key=len, reverse=True))
# A marker stands at the start of a line: a name with a colon, or a name in a tag or heading.
MARKER = re.compile(
    rf"^[ \t]*(?:(?:<\|im_start\|>|<\|start_header_id\|>)[ \t]*({_WORDS})(?:<\|end_header_id\|>)?[ \t]*$"
    rf"|<\|({_WORDS})\|>|\[({_WORDS})\]:?|#+[ \t]*({_WORDS})[ \t]*:?[ \t]*$|\**({_WORDS})\**[ \t]*:\**)[ \t]*",
    re.IGNORECASE | re.MULTILINE,
)
SLOTS = (len(ROLES) + 1, 24, 8, 8, 4)
MARKER_PRIOR = 20.0
BLOCK = 1024
BLOCK_KEY = ["conv_key", "lone", "turns", "turn_cut", "texts", "text_cut", "part_cut"]
TOLD = 50_000  # rows of parts that are decoded side by side
TIE = 1e-7
_FEATURES = ", ".join(f"f{k} int" for k in range(len(SLOTS)))
_ENDS = {"?": 1, ".": 2, ":": 3, "!": 4}


def split_parts(text: str) -> list[tuple[int, str]]:
    """``(marker, text)`` of each part: 0 for none, else the number of the role plus 1."""
    found = list(MARKER.finditer(text))
    if not found:
        return [(0, text)]
    parts = [(0, text[: found[0].start()])] if text[: found[0].start()].strip() else []
    for m, after in zip(found, [*found[1:], None], strict=True):
        role = NAMES[next(g for g in m.groups() if g).lower()]
        parts.append((ROLES.index(role) + 1, text[m.end() : after.start() if after else len(text)].strip("\n")))
    return parts


def part_features(marker: int, text: str) -> tuple[int, ...]:
    plain = text.strip()
    lines = plain.split("\n")
    begin = 1 if re.match(r"[-*0-9]", plain) else 2 if plain.startswith(("```", "{", "<")) else 3 if not plain else 0
    asks = _ENDS.get(plain[-1:], 0) if "?" not in plain[:-1] else 5
    return marker, min(len(plain).bit_length(), 23), min(len(lines) - 1, 7), asks, begin


@dataclass
class RoleModel:
    """Logarithms of the start, transition and emission probabilities."""

    initial: np.ndarray
    transitions: np.ndarray
    emissions: list[np.ndarray]  # for each feature, [value, role]

    def score(self, features: list[np.ndarray]) -> np.ndarray:
        return sum(table[values] for table, values in zip(self.emissions, features, strict=True))


def _role(column: Column) -> Column:
    """The number of a role given by one of its names; null if it is none."""
    numbers = [x for name, role in NAMES.items() for x in (F.lit(name), F.lit(ROLES.index(role)))]
    return F.element_at(F.create_map(*numbers), F.lower(F.trim(column)))


def learn_roles(rows: DataFrame, parts: DataFrame) -> RoleModel:
    """Counts over the rows of known role: ``rows`` has ``conv_id, turn, role``, ``parts`` their features too."""
    known = F.crc32(F.col("conv_id").cast("string")) % 5 != 0
    roles = rows.where(known & F.col("role").isNotNull()).select("conv_id", "turn", "role")
    initial, transitions = np.ones(len(ROLES)), np.ones((len(ROLES), len(ROLES)))
    first = roles.groupBy("conv_id").agg(F.min_by("role", "turn").alias("role")).groupBy("role").count()
    for row in first.collect():
        initial[row["role"]] += row["count"]
    # Repeated rows meet as counts, not one by one.
    times = roles.groupBy("conv_id", "turn", "role").agg(F.count("*").alias("n"))
    after = times.select(F.col("conv_id").alias("c"), (F.col("turn") - 1).alias("t"), F.col("role").alias("next"), F.col("n").alias("m"))
    steps = times.join(after, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")))
    steps = steps.groupBy("role", "next").agg(F.sum(F.col("n").cast("double") * F.col("m")).alias("count"))
    for row in steps.collect():
        transitions[row["role"], row["next"]] += row["count"]
    tables = [np.ones((size, len(ROLES))) for size in SLOTS]
    tables[0][1:] = 0.1
    tables[0][range(1, len(ROLES) + 1), range(len(ROLES))] = MARKER_PRIOR
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("slot"), F.col(f"f{k}").alias("value")) for k in range(len(SLOTS))]))
    seen = parts.where(known & F.col("role").isNotNull()).select("role", each.alias("f")).groupBy("role", "f").count()
    for row in seen.collect():
        tables[row["f"]["slot"]][row["f"]["value"], row["role"]] += row["count"]
    logs = [np.log(table / table.sum(axis=0)) for table in tables]
    return RoleModel(np.log(initial / initial.sum()), np.log(transitions / transitions.sum(axis=1, keepdims=True)), logs)


def _blocks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Whole blocks of sorted rows, ``least`` rows or more at a time; the last block of a batch waits for the next."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if sum(b.num_rows for b in held) >= least:
                table = pa.Table.from_batches(held).combine_chunks()
                cut = int(_borders(table)[-2])
                if cut:
                    yield table.slice(0, cut).combine_chunks()
                held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _borders(table: pa.Table) -> np.ndarray:
    """Where blocks begin, and the end."""
    keys = [table.column(name).to_numpy(zero_copy_only=False) for name in BLOCK_KEY]
    new = np.ones(table.num_rows, dtype=bool)
    new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    return np.append(np.flatnonzero(new), table.num_rows)


def _counted(parts: DataFrame, key: list[str], least: int) -> DataFrame:
    """``parts`` with ``n``, the number of parts of their group where it is above ``least``, else null.

    The large groups are staged, so that Spark knows how few they are when it plans the join.
    """
    large = materialize(parts.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > least), "chat_large")
    large = large.select(*[F.col(c).alias(f"large_{c}") for c in key], "n")
    same = F.lit(True)
    for c in key:
        same = same & (F.col(c) == F.col(f"large_{c}"))
    return parts.join(large, same, "left").drop(*[f"large_{c}" for c in key])


def blocked(parts: DataFrame) -> DataFrame:
    """``parts`` with their blocks, the columns of ``BLOCK_KEY``, which are in the order of the parts."""
    zero = F.lit(0).cast("long")
    turns = F.floor(F.greatest(F.col("turn_key"), F.lit(-1)) / BLOCK)
    by_turns = _counted(parts.withColumn("turns", turns), ["conv_key", "lone", "turns"], 4 * BLOCK)
    cut = by_turns.where("n IS NOT NULL").drop("n").withColumn("turn_cut", F.col("turn_key"))
    by_turn = _counted(cut, ["conv_key", "lone", "turn_key"], BLOCK)
    # Where the text's hash lies among all, in as many ranges as the turn has blocks of parts.
    ranges = F.ceil(F.col("n") / BLOCK)
    place = F.floor((F.col("text_key").cast("double") / 2.0**64 + 0.5) * ranges)
    in_ranges = by_turn.withColumn("texts", F.coalesce(place, zero)).drop("n")
    by_range = _counted(in_ranges, ["conv_key", "lone", "turn_key", "texts"], 4 * BLOCK)
    text_cut = F.when(F.col("n").isNotNull(), F.col("text_key")).otherwise(zero)
    part_cut = F.when(F.col("n").isNotNull(), F.floor(F.col("part") / BLOCK)).otherwise(zero)
    fine = by_range.withColumn("text_cut", text_cut).withColumn("part_cut", part_cut).drop("n")
    coarse = by_turns.where("n IS NULL").drop("n").select("*", *[zero.alias(c) for c in BLOCK_KEY[3:]])
    return coarse.unionByName(fine)


def _emissions(table: pa.Table, model: RoleModel) -> np.ndarray:
    """The score of each role at each part, with a fraction of ``TIE`` by the part's own hash.

    Paths through parts of like features have equal scores. Rounding would choose among them, another one for other
    blocks; the fraction tells them apart, alike whatever the blocks.
    """
    scores = model.score([table.column(f"f{k}").to_numpy() for k in range(len(SLOTS))])
    own = np.zeros(table.num_rows, dtype=np.uint64)
    for name in ("turn_key", "text_key", "part"):
        own = mix(own + table.column(name).to_numpy().astype(np.uint64))
    chance = mix(own[:, None] + np.arange(1, len(ROLES) + 1, dtype=np.uint64))
    return scores + TIE * (chance.astype(np.float64) / 2.0**64)


def block_transfers(emissions: np.ndarray, borders: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """``[block, first state, last state]``: score of the best path through each block."""
    lengths = np.diff(borders)
    best = np.full((len(lengths), *transitions.shape), -np.inf)
    for state in range(len(transitions)):
        best[:, state, state] = emissions[borders[:-1], state]
    for step in range(1, int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > step)
        moved = (best[live][:, :, :, None] + transitions[None, None]).max(axis=2)
        best[live] = moved + emissions[borders[live] + step][:, None, :]
    return best


def _links(parts: DataFrame, model) -> DataFrame:
    """The blocks of conversations of several, each with the ``first`` and ``last`` state of one best path of the conversation.

    Of equal paths all blocks take the same one, so their decodings fit together.
    """
    block = F.struct(*BLOCK_KEY[2:])
    several = parts.groupBy("conv_key", "lone").agg(F.min(block).alias("low"), F.max(block).alias("high"))
    several = several.where("low < high").select(F.col("conv_key").alias("c"), F.col("lone").alias("l"))
    own = parts.join(several, (F.col("conv_key") == F.col("c")) & (F.col("lone") == F.col("l")), "left_semi")

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, TOLD):
            borders = _borders(table)
            best = block_transfers(_emissions(table, model.value), borders, model.value.transitions)
            first = table.take(pa.array(borders[:-1])).select(BLOCK_KEY).combine_chunks()
            packed = pa.array([matrix.tobytes() for matrix in best], pa.binary())
            yield from first.append_column("transfer", packed).to_batches()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(ROLES)
        for table in _conversations(batches):
            matrices = [np.frombuffer(x, np.float64).reshape(size, size) for x in table.column("transfer").to_pylist()]
            into, reached = [model.value.initial], []
            for matrix in matrices:
                reached.append((into[-1][:, None] + matrix).max(axis=0))
                into.append((reached[-1][:, None] + model.value.transitions).max(axis=0))
            first, last = np.zeros((2, len(matrices)), dtype=np.int32)
            last[-1] = reached[-1].argmax()
            for k in range(len(matrices) - 1, -1, -1):
                first[k] = (into[k] + matrices[k][:, last[k]]).argmax()
                if k:
                    last[k - 1] = (reached[k - 1] + model.value.transitions[:, first[k]]).argmax()
            told = table.select(BLOCK_KEY).append_column("first", pa.array(first)).append_column("last", pa.array(last))
            yield from told.combine_chunks().to_batches()

    ddl = ", ".join(f"{c} long" for c in BLOCK_KEY)
    dealt = own.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY, "turn_key", "text_key", "part")
    matrices = dealt.mapInArrow(transfer, f"{ddl}, transfer binary")
    together = matrices.repartition("conv_key", "lone").sortWithinPartitions(*BLOCK_KEY)
    return together.mapInArrow(link, f"{ddl}, first int, last int")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The blocks of one conversation at a time."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = [table.column(name).to_numpy() for name in ("conv_key", "lone")]
        new = np.ones(table.num_rows, dtype=bool)
        new[1:] = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
        borders = np.append(np.flatnonzero(new), table.num_rows)
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            piece = table.slice(a, b - a)
            if held and (held[-1].column("conv_key")[0], held[-1].column("lone")[0]) != (piece.column("conv_key")[0], piece.column("lone")[0]):
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(piece)
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _decoded(parts: DataFrame, model) -> DataFrame:
    """``conv_key, lone, turn_key, text_key, part, state`` of all parts."""
    links = _links(parts, model)
    linked = links.select(*[F.col(c).alias(f"l_{c}") for c in BLOCK_KEY], "first", "last")
    same = F.lit(True)
    for c in BLOCK_KEY:
        same = same & (F.col(c) == F.col(f"l_{c}"))
    joined = parts.join(linked, same, "left").drop(*[f"l_{c}" for c in BLOCK_KEY])
    dealt = joined.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY, "turn_key", "text_key", "part")
    told = ["conv_key", "lone", "turn_key", "text_key", "part"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(ROLES)
        for table in _blocks(batches, TOLD):
            borders = _borders(table)
            scores = _emissions(table, model.value).copy()
            scores[borders[:-1]] += model.value.initial
            for name, at in (("first", borders[:-1]), ("last", borders[1:] - 1)):
                state = table.column(name).take(pa.array(at)).fill_null(-1).to_numpy()
                given = np.flatnonzero(state >= 0)
                others = np.arange(size)[None] != state[given, None]
                scores[at[given]] = np.where(others, -np.inf, scores[at[given]])
            states = viterbi(scores, borders, model.value.transitions, np.zeros(size))
            yield from table.select(told).append_column("state", pa.array(states, pa.int32())).combine_chunks().to_batches()

    return dealt.mapInArrow(decode, "conv_key long, lone long, turn_key long, text_key long, part int, state int")


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, part, role, rendered`` of every part of every row.

    ``turns`` needs ``conv_id, turn, text``; a ``role`` column, if there is
    one, is learned from (see above) and never copied. Rendered parts read
    ``<|role|>\\n``, the text without its marker, and ``\\n<|end|>``. Rows are in
    order of ``turn``, null first, ties by a hash of the text; rows alike in
    conversation, turn and text are one row with one result each. A null text
    counts as empty and gives one empty part; a row of null ``conv_id`` is a
    conversation of its own; without any known role the prior of the markers
    decides alone; other columns are not read; no rows give no rows.
    """
    role = _role(F.col("role").cast("string")) if "role" in turns.columns else F.lit(None).cast("int")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    rows = rows.select(
        "*",
        F.coalesce("conv_id", F.lit(0).cast("long")).alias("conv_key"),
        F.coalesce("turn", F.lit(-(1 << 62))).alias("turn_key"),
        # Tells rows of null conversation from each other and from conversation 0.
        F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "text").bitwiseOR(F.lit(1).cast("long")))
        .otherwise(F.lit(0).cast("long"))
        .alias("lone"),
    )
    keys = ["conv_key", "lone", "turn_key", "text_key"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, part, features = [], [], []
            for i, value in enumerate(batch.column("text").to_pylist()):
                for k, found in enumerate(split_parts(value)):
                    index.append(i)
                    part.append(k)
                    features.append(part_features(*found))
            if index:
                own = batch.select(["conv_id", "turn", "role", *keys]).take(pa.array(index))
                columns = [pa.array(values, pa.int32()) for values in zip(*features, strict=True)]
                names = [*own.schema.names, "part", *[f"f{k}" for k in range(len(SLOTS))]]
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(part, pa.int32()), *columns], names)

    ddl = "conv_id long, turn long, role int, conv_key long, lone long, turn_key long, text_key long, part int, "
    cut_rows = rows.select("conv_id", "turn", "role", *keys, "text").mapInArrow(cut, ddl + _FEATURES)
    parts = materialize(cut_rows, "chat_parts")
    model = turns.sparkSession.sparkContext.broadcast(learn_roles(rows, parts))
    once = parts.select(*keys, "part", *[f"f{k}" for k in range(len(SLOTS))]).dropDuplicates([*keys, "part"])
    once = materialize(once, "chat_once")
    dealt = materialize(blocked(once), "chat_blocks")
    decoded = materialize(_decoded(dealt, model), "chat_roles")
    discard(once, dealt)
    discard(parts)
    by_row = decoded.groupBy(*[F.col(c).alias(f"d_{c}") for c in keys]).agg(
        F.sort_array(F.collect_list(F.struct("part", "state"))).alias("states")
    )
    same = F.lit(True)
    for c in keys:
        same = same & (F.col(c) == F.col(f"d_{c}"))
    joined = rows.join(by_row, same).select("conv_id", "turn", "text", "states.state")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, part, role, rendered = [], [], [], []
            for i, (value, states) in enumerate(zip(batch.column("text").to_pylist(), batch.column("state").to_pylist(), strict=True)):
                for k, ((_, plain), state) in enumerate(zip(split_parts(value), states, strict=True)):
                    index.append(i)
                    part.append(k)
                    role.append(ROLES[state])
                    rendered.append(f"<|{ROLES[state]}|>\n{plain}\n<|end|>")
            if index:
                own = batch.select(["conv_id", "turn"]).take(pa.array(index))
                columns = [*own.columns, pa.array(part, pa.int32()), pa.array(role), pa.array(rendered, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "part", "role", "rendered"])

    return joined.mapInArrow(render, "conv_id long, turn long, part int, role string, rendered string")
