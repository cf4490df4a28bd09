"""Operator 11: conversation structure repair with Four-Russians block tables.

A conversation's rows become symbols: the initial of the role and whether the row is sound,
truncated or has to go. Repairing means spelling ``(s?(ua)+)?`` at the least cost by keeping,
reroling, deleting and inserting rows. The costs still to come, one for each state of that
pattern, form a vector; less its minimum it is one of a few dozen vectors, so what a block of
BLOCK symbols does to each of them is tabulated once a worker, for every possible block. Costs
are looked up block by block from the end of a conversation to its start. Edits are then read
forward: each block's own vectors are rebuilt from the one behind it, and of equally cheap edits
the ASCII-least is taken, which is safe as every choice is checked against the exact cost to come.

Scale. Rows are sorted by range of (conversation, turn), so that one conversation with a third of
all rows lies in many partitions. Only a partition's first and last conversation can be cut; what
their pieces do to every vector and every state is composed in order (a row for each cut, so
partitions bound them), and then all pieces are edited alike. Texts stay out of this: rows carry
digests, repeated rows are one row with a count, and the texts of kept rows are joined at the end.

Cases. Null roles and texts are one space. Rows of one turn are ordered by role, then by the
SHA-256 of the text. Null turns come first, a null ``conv_id`` is a conversation. Repeated rows
are duplicates of the first one. A conversation whose rows all go has an empty repair. Empty
tables give empty results; columns beside the four are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch

#: Rows of a block; a table has 13 ** BLOCK columns.
BLOCK = 3
#: Conversations of at most so many rows are remembered by their symbols.
SHORT, MEMO_SIZE = 64, 50_000
START, SYSTEM, USER, ASSISTANT = range(4)
INSERTED = (USER, USER, ASSISTANT, USER)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Symbols are 3 * (place of the initial) + fault; REST stands for no row and fills the last block.
INITIALS, SOUND, CUT, GOES, REST = "sua?", 0, 1, 2, 12
SYMBOLS = REST + 1
LEGAL = np.zeros((4, 4), dtype=bool)
LEGAL[0, 1] = LEGAL[1, 2] = LEGAL[2, 1] = True


def _choices(state: int, symbol: int) -> Iterator[tuple[str, int, int]]:
    """Edit, cost and next state of what can be done with a row, in ASCII order but for inserts."""
    initial, fault = INITIALS[symbol // 3], symbol % 3
    yield "D", DELETE, state
    if fault == GOES:
        return
    more = TRUNCATED if fault == CUT else 0
    if (state, initial) in KEPT:
        yield "K", more, KEPT[state, initial]
    yield "R", REROLE + more, INSERTED[state]


def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """The costs to come before a row, from those behind it."""
    if symbol == REST:
        return after
    costs = [min(cost + after[to] for _, cost, to in _choices(state, symbol)) for state in range(4)]
    for _ in range(4):
        costs = [min(costs[state], INSERT + costs[INSERTED[state]]) for state in range(4)]
    return tuple(costs)


#: Costs to come at the end: the pattern may stop at the start or behind an assistant.
END = (0, 2 * INSERT, INSERT, 0)


class Tables:
    """The reachable vectors, their transitions by symbol and by block, and the edits of each step."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors = block, [END]
        self.number, rows = {END: 0}, []
        for vector in self.vectors:  # grows meanwhile
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(vector, symbol)
                least = min(costs)
                plain = tuple(c - least for c in costs)
                if plain not in self.number:
                    self.number[plain] = len(self.vectors)
                    self.vectors.append(plain)
                row.append(self.number[plain])
            rows.append(row)
        self.step = np.array(rows, dtype=np.int32)
        self.blocks = np.arange(len(self.vectors), dtype=np.int32)[:, None]
        for _ in range(block):  # the first symbol of a block is applied last, so it is put in front
            self.blocks = np.concatenate([self.step[self.blocks, s] for s in range(SYMBOLS)], axis=1)
        self.edits = {(v, s, q): self._edit(v, s, q) for v, s, q in product(range(len(self.vectors)), range(REST), range(4))}
        self.exits = np.array([[[self.edits[v, s, q][0] if s < REST else q for q in range(4)] for s in range(SYMBOLS)] for v in range(len(self.vectors))])
        self.ends = [self._inserts(q, END) for q in range(4)]

    def _inserts(self, state: int, costs: tuple[int, ...]) -> tuple[int, str]:
        made = ""
        while costs[state]:
            state = INSERTED[state]
            made += "ua"[state == ASSISTANT]
        return state, made

    def _edit(self, after: int, symbol: int, state: int) -> tuple[int, str, str, str, int]:
        """Next state, initials of inserted rows, edit, initial of the new role, and cost."""
        behind, made, paid = self.vectors[after], "", 0
        costs = _before(behind, symbol)
        while True:
            found = {edit: (cost, to) for edit, cost, to in _choices(state, symbol) if costs[state] == cost + behind[to]}
            if "D" not in found and costs[state] == INSERT + costs[INSERTED[state]]:
                state, paid = INSERTED[state], paid + INSERT
                made += "ua"[state == ASSISTANT]
                continue
            edit = min(found)
            cost, to = found[edit]
            return to, made, edit, "ua"[to == ASSISTANT] if edit == "R" else "", paid + cost

    def coded(self, symbols: np.ndarray) -> np.ndarray:
        """Numbers of the blocks that ``symbols`` fill."""
        full = np.full(-(-len(symbols) // self.block) * self.block, REST, dtype=np.int64)
        full[: len(symbols)] = symbols
        return full.reshape(-1, self.block) @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))

    def borders(self, symbols: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """The vector behind each block, first to last, and in front of the first; by lookups."""
        held = [end]
        for number in self.coded(symbols)[::-1]:
            held.append(self.blocks[held[-1], number])
        return held[::-1]

    def inside(self, symbols: np.ndarray, borders: list) -> Iterator[tuple[int, np.ndarray]]:
        """Each symbol with the vector behind it: every block is expanded backward from its border."""
        for k in range(0, len(symbols), self.block):
            part, behind = symbols[k : k + self.block], [borders[k // self.block + 1]]
            for symbol in part[:0:-1]:
                behind.append(self.step[behind[-1], symbol])
            yield from zip(part.tolist(), reversed(behind), strict=True)

    def effect(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every vector behind a piece: that in front of it, and the state that each state leads to."""
        borders = self.borders(symbols, np.arange(len(self.vectors)))
        states = np.tile(np.arange(4), (len(self.vectors), 1))
        for symbol, behind in self.inside(symbols, borders):
            states = self.exits[behind[:, None], symbol, states]
        return borders[0], states

    def repaired(self, symbols: np.ndarray, end: int = 0, state: int = START) -> tuple[list[tuple], int]:
        """The edits of a piece, row by row, and the state behind it."""
        edits = []
        for symbol, behind in self.inside(symbols, self.borders(symbols, np.int32(end))):
            edits.append(self.edits[int(behind), symbol, state])
            state = edits[-1][0]
        return edits, state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


@lru_cache(maxsize=MEMO_SIZE)
def _short(symbols: bytes) -> tuple[list[tuple], int]:
    return tables().repaired(np.frombuffer(symbols, dtype=np.uint8))


# from rows to symbols


def _order(role: str = "role") -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc(role), F.asc("t")]


def _named(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls as a space, the digest ``t`` and the row's name ``id``."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("t", F.unhex(F.sha2("text", 256)))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("conv_id", "turn")]
    return rows.withColumn("id", F.unhex(F.sha2(F.concat_ws(":", *parts, F.hex("t"), "role"), 256)))


def symbols_of(named: DataFrame) -> DataFrame:
    """One row per distinct row, with its count ``m``, its symbol and its faults, sorted by range; ``pid`` is its partition."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = named.select("id", "conv_id", "turn", "role", "t", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    rows = scratch.save(rows.groupBy(*rows.columns).agg(F.count("*").alias("m")), "turns")
    # of the rows that share role and text the first one's name: they meet by what is unique to it, never by a hot key
    first = F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn", "id")).alias("first")
    firsts = rows.groupBy("conv_id", "role", "t").agg(first).select(F.col("first.id").alias("id"), F.lit(True).alias("new"))
    rows = rows.join(firsts, "id", "left").withColumn("new", F.coalesce("new", F.lit(False)))
    initial = F.when(F.substring("role", 1, 1).isin(*"sua"), F.substring("role", 1, 1)).otherwise("?")
    fault = F.when(F.col("blank") | ~F.col("new"), GOES).when(F.col("cut"), CUT).otherwise(SOUND)
    rows = rows.withColumns({
        "symbol": (3 * F.element_at(F.create_map(*[F.lit(x) for k, c in enumerate(INITIALS) for x in (c, k)]), initial) + fault).cast("int"),
        "n_blank": F.when(F.col("blank"), F.col("m")).otherwise(0),
        "n_twice": F.when(F.col("blank"), 0).otherwise(F.col("m") - F.col("new").cast("int")),
        "n_cut": (F.col("new") & ~F.col("blank") & F.col("cut")).cast("long"),
    })
    rows = rows.drop("blank", "cut", "new").repartitionByRange(*_order()).sortWithinPartitions(*_order())
    return scratch.save(rows.withColumn("pid", F.spark_partition_id()), "symbols")


# pieces: the rows of one conversation in one partition


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The pieces of a sorted stream, each as one table."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, at: int) -> tuple:
        return batch["pid"][at].as_py(), batch["conv_id"][at].as_py()

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and key(held[-1], held[-1].num_rows - 1) != key(batch, 0):
            yield pa.Table.from_batches(held)
            held = []
        pid, conv = batch["pid"].to_numpy(zero_copy_only=False), batch["conv_id"]
        none = conv.is_null().to_numpy(zero_copy_only=False)
        value = pd.factorize(conv.to_pandas(), use_na_sentinel=True)[0]
        cuts = np.flatnonzero((pid[1:] != pid[:-1]) | (none[1:] != none[:-1]) | (value[1:] != value[:-1])) + 1
        at = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(at[:-1], at[1:], strict=True):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in _runs(batches):
        symbols = run["symbol"].to_numpy()
        front, states = tables().effect(symbols)
        yield pa.RecordBatch.from_pydict({
            "conv_id": run["conv_id"].slice(0, 1).combine_chunks(), "pid": run["pid"].slice(0, 1).combine_chunks(),
            "front": pa.array([front], pa.list_(pa.int32())), "states": pa.array([states.ravel()], pa.list_(pa.int32())), "last": pa.array([symbols[-1] // 3], pa.int32()),
        })


def _composed(pieces: pd.DataFrame) -> pd.DataFrame:
    """For the pieces of one cut conversation: the vector behind, the state and the initial in front of each."""
    pieces = pieces.sort_values("pid").reset_index(drop=True)
    ends = [0]
    for front in pieces["front"][:0:-1]:
        ends.append(front[ends[-1]])
    state, states = START, []
    for end, to in zip(reversed(ends), pieces["states"], strict=True):
        states.append(state)
        state = to[4 * end + state]
    out = pieces[["conv_id", "pid"]].copy()
    out["end"], out["state"], out["prev"] = ends[::-1], states, [-1, *pieces["last"][:-1]]
    out["ends"] = [False] * (len(out) - 1) + [True]
    return out


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("pid").sortWithinPartitions("pid", *_order())


def cut_pieces(rows: DataFrame) -> DataFrame:
    """How the pieces of conversations in several partitions join up; at most two rows a partition."""
    conv = F.struct(F.col("conv_id").isNotNull().alias("has"), "conv_id")
    edges = rows.groupBy("pid").agg(F.min(conv).alias("a"), F.max(conv).alias("b"))
    edges = edges.select("pid", F.explode(F.array_distinct(F.array("a", "b"))).alias("c"))
    cut = edges.groupBy("c").agg(F.count("*").alias("k")).filter("k > 1").select(F.col("c.conv_id").alias("of"))
    some = rows.join(F.broadcast(cut), F.col("conv_id").eqNullSafe(F.col("of")), "left_semi")
    kind = dict(rows.dtypes)["conv_id"]
    pieces = _sorted(some.select("pid", "conv_id", "turn", "role", "t", "symbol")).mapInArrow(_effects, f"conv_id {kind}, pid int, front array<int>, states array<int>, last int")
    return pieces.groupBy("conv_id").applyInPandas(_composed, f"conv_id {kind}, pid int, end int, state int, prev int, ends boolean")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row by row: inserted initials in front, whether it is kept, its new role, inserts at the end; by piece: audit, cost, illegal."""
    out: dict[str, list] = {}

    def flush() -> pa.RecordBatch:
        made = {c: pa.chunked_array([x for x in v]).combine_chunks() if c in ("conv_id", "id") else v for c, v in out.items()}
        out.clear()
        return pa.RecordBatch.from_pydict(made, schema=pa.schema([("conv_id", made["conv_id"].type), ("pid", pa.int32()), ("id", pa.binary()), ("front", pa.string()), ("keeps", pa.bool_()), ("as_role", pa.string()), ("back", pa.string()), ("audit", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64())]))

    count = 0
    for run in _runs(batches):
        symbols, many, n = run["symbol"].to_numpy(), run["m"].to_numpy(), run.num_rows
        end, state, prev, ends = (run[c][0].as_py() for c in ("end", "state", "prev", "ends"))
        whole = end is None
        if whole and n <= SHORT:
            edits, state = _short(symbols.astype(np.uint8).tobytes())
        else:
            edits, state = tables().repaired(symbols, *(() if whole else (end, state)))
        back = tables().ends[state][1] if whole or ends else ""
        again = int(many.sum()) - n
        initials = symbols // 3
        illegal = int((~LEGAL[initials[:-1], initials[1:]]).sum()) + again
        if not whole and prev >= 0:
            illegal += int(not LEGAL[prev, initials[0]])
        texts = ["I" * len(e[1]) + e[2] for e in edits]
        if again:
            texts = [t + "D" * (k - 1) for t, k in zip(texts, many.tolist(), strict=True)]
        rest = [None] * (n - 1)
        new = {
            "pid": [run["pid"][0].as_py(), *rest], "front": [e[1] for e in edits], "keeps": [e[2] != "D" for e in edits],
            "as_role": [e[3] for e in edits], "back": [*[""] * (n - 1), back], "audit": ["".join(texts) + "I" * len(back), *rest],
            "cost": [sum(e[4] for e in edits) + DELETE * again + INSERT * len(back), *rest], "illegal": [illegal, *rest],
        }
        for c in ("conv_id", "id"):
            out.setdefault(c, []).extend(run[c].chunks)
        for c, v in new.items():
            out.setdefault(c, []).extend(v)
        count += n
        if count >= 10_000:
            yield flush()
            count = 0
    if out:
        yield flush()


def edits_of(rows: DataFrame) -> DataFrame:
    """The edits of each row of ``symbols_of``, and in each piece's first row those of the piece."""
    cut = scratch.save(cut_pieces(rows), "cut_conversations")
    cut = F.broadcast(cut.select(F.col("conv_id").alias("of"), F.col("pid").alias("at"), "end", "state", "prev", "ends"))
    met = rows.select("pid", "conv_id", "turn", "role", "t", "id", "symbol", "m").join(cut, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("pid") == F.col("at")), "left").drop("of", "at")
    kind = dict(rows.dtypes)["conv_id"]
    return scratch.save(_sorted(met).mapInArrow(_edited, f"conv_id {kind}, pid int, id binary, front string, keeps boolean, as_role string, back string, audit string, cost long, illegal long"), "edits")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audits and repaired rows of ``rows`` (conv_id, turn, role, text).

    The audits have one row per conversation that has rows: gaps, blank, duplicate, truncated,
    illegal, cost and audit. The repaired rows have conv_id, turn, role and text; conv_id, turn,
    old_role, t and k order them, and inserted rows have the turn of the row they stand by.
    """
    named = _named(rows)
    coded = symbols_of(named)
    edits = edits_of(coded)
    counts = coded.groupBy("conv_id", "turn").agg(*[F.sum(c).alias(c) for c in ("n_blank", "n_twice", "n_cut")]).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum("n_blank").alias("blank"), F.sum("n_twice").alias("duplicate"), F.sum("n_cut").alias("truncated"),
    )
    pieces = edits.filter("audit is not null").groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("pid", "audit"))).alias("parts"))
    pieces = pieces.withColumn("audit", F.array_join(F.col("parts.audit"), "")).drop("parts")
    audits = _by_conversation(counts, pieces)
    kept = edits.filter("keeps or back <> ''").select("id", "front", "keeps", "as_role", "back")
    met = named.dropDuplicates(["id"]).join(kept, "id")

    def made(column: str) -> Column:
        return F.transform(F.filter(F.split(column, ""), lambda x: x != ""), lambda x: F.struct(F.when(x == "u", ROLES["u"]).otherwise(ROLES["a"]).alias("role"), F.lit("").alias("text")))

    role = F.when(F.col("as_role") == "", F.col("role")).when(F.col("as_role") == "u", ROLES["u"]).otherwise(ROLES["a"])
    own = F.when(F.col("keeps"), F.array(F.struct(role.alias("role"), F.col("text").alias("text")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    out = met.select("conv_id", "turn", F.col("role").alias("old_role"), "t", F.posexplode(F.concat(made("front"), own, made("back"))).alias("k", "row"))
    return audits, out.select("conv_id", "turn", "old_role", "t", "k", "row.role", "row.text")


def _by_conversation(*parts: DataFrame) -> DataFrame:
    """Tables with at most one row per conversation side by side, null ids included, by one shuffle."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in both.columns if c != "conv_id"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, from a sorted stream; only the open one is held, as a hash."""
    done, made, open_ = [], [], None
    kind = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, role, text in zip(batch["conv_id"].to_pylist(), batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True):
            line = f"{role}:{text}".encode()
            if open_ is not None and open_[0] == conv:
                open_[1].update(b"\n" + line)
                continue
            if open_ is not None:
                done.append(open_[0])
                made.append(open_[1].hexdigest())
            open_ = (conv, sha256(line))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(done, kind), pa.array(made)], ["conv_id", "repaired_sha256"])
            done, made = [], []
    if open_ is not None:
        yield pa.RecordBatch.from_arrays([pa.array([open_[0]], kind), pa.array([open_[1].hexdigest()])], ["conv_id", "repaired_sha256"])


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` lines of each conversation. One hash is one chain, so a conversation streams through one task."""
    scratch.bound_batches(repaired.sparkSession)
    lines = repaired.repartition("conv_id").sortWithinPartitions(*_order("old_role"), "k").select("conv_id", "role", "text")
    return lines.mapInArrow(_digests, f"conv_id {dict(repaired.dtypes)['conv_id']}, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` damaged by the crc32 of ``conv_id:turn``."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fate, text, role = F.crc32(key) % 20, F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = rows.withColumns({"fate": fate, "text": text, "role": F.when(fate == 4, "user").otherwise(role)}).filter("fate <> 0")
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(0), (F.col("fate") == 3).cast("int"))).alias("copy")).drop("copy")


NONE = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": sha256(b"").hexdigest()}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    audits, repaired = repair(damaged(rows))
    out = _by_conversation(rows.select("conv_id").distinct(), audits, digests(repaired))
    return out.select("conv_id", *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in NONE.items()])


SQL = r"""
WITH RECURSIVE
k AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl),
s AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS b FROM conversations),
f AS (SELECT s.*, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda x, y: xor(x >> 8, tbl[(xor(x, y) & 255) + 1])), 4294967295) % 20 AS fate FROM s, k),
d AS (SELECT g, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
             CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS z
      FROM f WHERE fate <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(text), z) AS i,
             row_number() OVER (PARTITION BY g, role, text ORDER BY turn NULLS FIRST, z) AS nth, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS e FROM d),
r AS (SELECT *, CASE WHEN e = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN e NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS c,
             lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS b FROM o),
ins(q, t) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
kept(q, c, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
chain AS (SELECT q, q AS t, 0 AS n FROM ins UNION ALL SELECT chain.q, ins.t, n + 1 FROM chain JOIN ins ON ins.q = chain.t WHERE n < 3),
edge AS (SELECT q, NULL AS c, 'D' AS op, 3 * n + 4 AS cost, t, n FROM chain UNION ALL
         SELECT chain.q, c, 'K', 3 * n, kept.t, n FROM chain JOIN kept ON kept.q = chain.t UNION ALL
         SELECT chain.q, NULL, 'R', 3 * n + 3, ins.t, n FROM chain JOIN ins ON ins.q = chain.t),
w AS (SELECT DISTINCT g, 0::BIGINT AS i, 0 AS q, printf('%09d', 0) AS best FROM d UNION ALL
      SELECT w.g, r.i, edge.t, min(printf('%09d', left(best, 9)::INT + cost + CASE WHEN op <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END) || substr(best, 10) || repeat('I', n) || op)
      FROM w JOIN r ON r.g = w.g AND r.i = w.i + 1 JOIN edge ON edge.q = w.q AND (edge.c IS NULL OR edge.c = r.c) AND (op = 'D' OR fault NOT IN ('blank', 'duplicate'))
      GROUP BY w.g, r.i, edge.t),
a AS (SELECT w.g, min(printf('%09d', left(best, 9)::INT + 3 * n) || substr(best, 10) || repeat('I', n)) AS best
      FROM w JOIN (SELECT g, max(i) AS i FROM r GROUP BY g) USING (g, i) JOIN chain ON chain.q = w.q AND chain.t IN (0, 3) GROUP BY w.g),
p AS (SELECT g, substr(best, 10) AS audit, unnest(range(1, length(best) - 8)) AS p FROM a),
x AS (SELECT g, p, substr(audit, p, 1) AS op, length(replace(left(audit, p), 'I', '')) AS i, length(replace(left(audit, p), 'D', '')) AS e FROM p),
y AS (SELECT x.*, r.role, r.text, max(CASE WHEN x.e = 1 AND op = 'K' AND c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.g) AS sys FROM x LEFT JOIN r ON r.g = x.g AND r.i = x.i WHERE op <> 'D'),
l AS (SELECT g, string_agg(CASE WHEN op = 'K' THEN role WHEN (e - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS t FROM y GROUP BY g),
n AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (b IS NOT NULL AND b || c NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY g)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(best, 9)::BIGINT, 0) AS cost, coalesce(substr(best, 10), '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM s) LEFT JOIN n USING (g) LEFT JOIN a USING (g) LEFT JOIN l USING (g)
"""
