"""Operator 11: conversation structure repair by a persistent audit DP.

A conversation's rows, by turn, are edited at least cost into roles that read ``(s?(ua)+)?`` by their
initials: keep (0), rerole to user or assistant (1), delete (2, required for blank and repeated rows),
insert an empty row (5); a truncated row that stays adds 5. The audit is the string of the edits'
initials; of equally cheap audits the ASCII-least one counts.

The DP holds one audit per state (nothing yet, after s, after u, after a). Audits are linked nodes:
an audit shares the nodes of its prefix, and each node knows its rolling hash and its ancestors at
distances 1, 2, 4, .... Equal costs are compared by the longest common prefix, found by descending the
ancestors while their hashes differ; equal hashes of distinct nodes are verified by walking both down
to a shared node. An audit determines its states, and inserts are counted to the row they precede, so
two audits of the same rows are never prefixes of each other and the least prefix stays the least.

Spread: rows are numbered by a range sort over (conversation, turn, role, text), so a conversation of
any size is cut into blocks of ``2 ** block_bits`` rows. A block is one group: it solves each of its
conversations, and for one that reaches over the block's edge it solves all four start states. Only
the four-by-four cost tables of such pieces meet per conversation (one small row for each block),
where the cheapest way through them is chosen; then each block applies its own edits. Texts take no
part until the end: rows carry a hash of them, and the texts join the repaired rows.

Row cases: a null role or text is one space. Null conv_ids are one conversation. Rows of the same turn
are ordered by role, then the text's first 256 characters, then its hash; null turns come first.
Repeated rows are rows of their own (all but the first are duplicates). Long texts and extra columns
change nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.llm.common import staged, table

BLOCK_BITS = 12
HEAD = 256
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
SPACE = r"\x20\x09-\x0D"
# states: 0 nothing yet, 1 after s, 2 after u, 3 after a; the initials that may follow each
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = ("u", "u", "a", "u")
#: Cost and audit of the inserts that end a conversation in each state.
CLOSING = ((0, ""), (2 * COSTS[INSERT], 2 * INSERT), (COSTS[INSERT], INSERT), (0, ""))
ROLES = {"u": "user", "a": "assistant"}
FORCED = ("", False, True)


class Prefixes:
    """Audits as linked nodes with rolling hashes and binary-lifting ancestors; node 0 is empty."""

    def __init__(self, modulus: int = (1 << 61) - 1, base: int = 1_000_003) -> None:
        self.modulus, self.base = modulus, base
        self.char, self.depth, self.code, self.up = [""], [0], [0], [[0]]

    def extend(self, node: int, edits: str) -> int:
        for edit in edits:
            above = [node]
            while len(self.up[above[-1]]) >= len(above) and self.depth[above[-1]] > 0:
                above.append(self.up[above[-1]][len(above) - 1])
            self.char.append(edit)
            self.depth.append(self.depth[node] + 1)
            self.code.append((self.code[node] * self.base + ord(edit)) % self.modulus)
            self.up.append(above)
            node = len(self.char) - 1
        return node

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            step = min(len(self.up[node]), (self.depth[node] - depth).bit_length()) - 1
            node = self.up[node][step]
        return node

    def same(self, a: int, b: int) -> bool:
        """Are two audits of one length equal?  Equal hashes are verified."""
        if a == b:
            return True
        if self.code[a] != self.code[b]:
            return False
        while a != b:
            if self.char[a] != self.char[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """ASCII order of two audits, by the character after their longest common prefix."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        step = len(self.up[x])
        while step:
            step -= 1
            if step < min(len(self.up[x]), len(self.up[y])):
                above = self.up[x][step], self.up[y][step]
                if not self.same(*above):
                    x, y = above
        return self.char[x] < self.char[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def _moves(initial: str, truncated: bool, forced: bool) -> tuple:
    """For each state after a row: (state before, cost, edits), the cheapest and least per pair."""
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(before: int, after: int, cost: int, edits: str) -> None:
        if (before, after) not in best or (cost, edits) < best[before, after]:
            best[before, after] = (cost, edits)

    for before, inserts in itertools.product(range(4), range(3)):
        state = before
        for _ in range(inserts):
            state = FOLLOWS[state][NEXT[state]]
        cost, edits = inserts * COSTS[INSERT], inserts * INSERT
        offer(before, state, cost + COSTS[DELETE], edits + DELETE)
        if not forced:
            stays = cost + TRUNCATED_COST * truncated
            if initial in FOLLOWS[state]:
                offer(before, FOLLOWS[state][initial], stays + COSTS[KEEP], edits + KEEP)
            offer(before, FOLLOWS[state][NEXT[state]], stays + COSTS[REROLE], edits + REROLE)
    return tuple(tuple((b, *found) for (b, a), found in best.items() if a == after) for after in range(4))


_MOVES = {(i, t, f): _moves(i, t, f) for i in ("s", "u", "a", "") for t in (False, True) for f in (False, True)}


def cheapest(kinds: list[tuple], start: int, prefixes: Prefixes | None = None) -> list[tuple[int, str] | None]:
    """Cost and audit of the best way from ``start`` to each state over rows of kinds
    (initial, truncated, forced); None where there is none."""
    prefixes = prefixes or Prefixes()
    held: list[tuple[int, int] | None] = [None] * 4
    held[start] = (0, 0)
    for kind in kinds:
        after: list[tuple[int, int] | None] = []
        for moves in _MOVES[kind]:
            won = None
            for before, cost, edits in moves:
                if held[before] is not None:
                    total, node = held[before][0] + cost, held[before][1]
                    if won is None or total < won[0] or total == won[0] and prefixes.less(node, won[1]):
                        won = (total, node, edits)
            after.append(won and (won[0], prefixes.extend(won[1], won[2])))
        held = after
    return [h and (h[0], prefixes.text(h[1])) for h in held]


def closed(ways: list[tuple[int, str] | None]) -> tuple[int, str]:
    """The best way that ends a conversation."""
    return min((w[0] + cost, w[1] + edits) for w, (cost, edits) in zip(ways, CLOSING, strict=True) if w)


# ------------------------------------------------------------------------------------ rows and blocks


def _rows(turns: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        F.sha2(text, 256).alias("sha"))


def _faults(rows: DataFrame) -> DataFrame:
    """One row per distinct (conversation, turn, role, text) with its copies and faults, without texts."""
    held = rows.select(
        "conv_id", "turn", "role", "sha", F.substring("text", 1, HEAD).alias("head"),
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("truncated"))
    held = held.groupBy("conv_id", "turn", "role", "sha", "head", "blank", "truncated").agg(
        F.count(F.lit(1)).alias("copies"))
    # a text said before in its conversation and role: its first turn is an aggregate, so copies are
    # combined before they move
    first = held.groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("sha").alias("_s")).agg(
        F.min(F.struct("turn")).alias("_first"))
    return held.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r"))
                     & (F.col("sha") == F.col("_s"))).select(
        "conv_id", "turn", "role", "sha", "head", "blank", "truncated", "copies",
        F.col("turn").eqNullSafe(F.col("_first.turn")).alias("first"))


def _numbered(faults: DataFrame, block_bits: int) -> DataFrame:
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"),
             F.col("sha")]
    at = F.monotonically_increasing_id()  # the task, then the row's place in its sorted part
    placed = faults.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at)
    return staged(placed.drop("head").withColumn("block", F.shiftright("at", block_bits)), "repair-rows")


def _kinds(row: dict) -> Iterator[tuple]:
    """The kinds of a row's copies: the first one may stay, if it is not blank and said for the first time."""
    copies = row["copies"]
    if row["first"] and not row["blank"]:
        initial = row["role"][:1]
        yield (initial if initial in ("s", "u", "a") else "", row["truncated"], False)
        copies -= 1
    yield from itertools.repeat(FORCED, copies)


def _by_conversation(rows: pa.Table) -> list[tuple[int | None, list[dict]]]:
    held = rows.sort_by("at").to_pylist()
    return [(conv, list(part)) for conv, part in itertools.groupby(held, key=lambda r: r["conv_id"])]


_PIECE = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("open", pa.bool_()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("gaps", pa.int64()),
    ("first_role", pa.string()), ("last_role", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
    ("cost", pa.list_(pa.int64())), ("place", pa.list_(pa.int32())), ("audit", pa.list_(pa.string()))])
LEGAL = ("su", "ua", "au")


def _between(turn: int | None, following: int | None) -> int:
    """Turns missing between two rows in order."""
    return 0 if turn is None or following is None else max(following - turn - 1, 0)


def _pieces(rows: pa.Table) -> pa.Table:
    """The conversations of a block, solved; a piece at its edge for all start states."""
    out, groups = [], _by_conversation(rows)
    for k, (conv, part) in enumerate(groups):
        kinds = [kind for row in part for kind in _kinds(row)]
        said = {"conv_id": conv, "block": part[0]["block"], "open": k in (0, len(groups) - 1), "blank": 0,
                "duplicate": 0, "truncated": 0, "illegal": 0, "gaps": 0, "first_role": part[0]["role"][:1],
                "last_role": part[-1]["role"][:1], "first_turn": part[0]["turn"], "last_turn": part[-1]["turn"]}
        for row in part:
            if row["blank"]:
                said["blank"] += row["copies"]
            else:
                said["duplicate"] += row["copies"] - row["first"]
                said["truncated"] += row["first"] and row["truncated"]
            said["illegal"] += row["copies"] - 1  # a copy beside its like
        for row, following in itertools.pairwise(part):
            said["illegal"] += row["role"][:1] + following["role"][:1] not in LEGAL
            said["gaps"] += _between(row["turn"], following["turn"])
        if said["open"]:
            table_ = [cheapest(kinds, start) for start in range(4)]
            said["cost"] = [w and w[0] for ways in table_ for w in ways]
            # the audits' order among those of one start state, all of the same rows
            said["place"] = [sorted(v[1] for v in ways if v).index(w[1]) if w else None
                             for ways in table_ for w in ways]
            said["audit"] = [w and w[1] for ways in table_ for w in ways]
        else:
            cost, audit = closed(cheapest(kinds, 0))
            said |= {"cost": [cost], "place": [0], "audit": [audit]}
        out.append(said)
    return pa.Table.from_pylist(out, _PIECE)


_WAY = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                  ("closing", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()), ("gaps", pa.int64())])


def _through(pieces: pa.Table) -> pa.Table:
    """The way through a conversation's pieces: costs to the end backwards, then the least audits forwards."""
    rows = pieces.sort_by("block").to_pylist()
    rest = [[cost for cost, _ in CLOSING]]
    for row in reversed(rows):
        rest.append([min((row["cost"][4 * s + e] + rest[-1][e] for e in range(4) if row["cost"][4 * s + e] is not None),
                         default=None) for s in range(4)])
        assert None not in rest[-1]
    rest.reverse()
    out, state = [], 0
    for k, row in enumerate(rows):
        cost, place = row["cost"][4 * state:4 * state + 4], row["place"][4 * state:4 * state + 4]
        end = min((e for e in range(4) if cost[e] is not None and cost[e] + rest[k + 1][e] == rest[k][state]),
                  key=place.__getitem__)
        last = k == len(rows) - 1
        after = {} if last else rows[k + 1]
        out.append({
            "conv_id": row["conv_id"], "block": row["block"], "start": state, "end": end,
            "closing": CLOSING[end][1] if last else "", "cost": cost[end] + (CLOSING[end][0] if last else 0),
            "illegal": 0 if last else int(row["last_role"] + after["first_role"] not in LEGAL),
            "gaps": 0 if last else _between(row["last_turn"], after["first_turn"])})
        state = end
    return pa.Table.from_pylist(out, _WAY)


_EDIT = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("step", pa.int32()), ("edit", pa.string()),
                   ("new_role", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("sha", pa.string())])


def _edits(rows: pa.Table, ways: pa.Table) -> pa.Table:
    """The rows that a block's audits leave, in order; deleted rows are gone."""
    chosen = {w["conv_id"]: w for w in ways.to_pylist()}
    out: list[dict] = []
    for conv, part in _by_conversation(rows):
        state, edits = chosen[conv]["start"], chosen[conv]["audit"]
        copies = [(row, kind[0]) for row in part for kind in _kinds(row)]
        place = 0  # of the copy that the next keep, rerole or delete is for
        for step, edit in enumerate(edits):
            row, initial = copies[min(place, len(copies) - 1)]  # closing inserts come after the last row
            if edit != INSERT:
                place += 1
            if edit != DELETE:
                initial = initial if edit == KEEP else NEXT[state]
                state = FOLLOWS[state][initial]
                kept = {"turn": row["turn"], "role": row["role"], "sha": row["sha"]} if edit != INSERT else {}
                out.append({"conv_id": conv, "at": row["at"], "step": step, "edit": edit,
                            "new_role": row["role"] if edit == KEEP else ROLES[initial], **kept})
    return pa.Table.from_pylist(out, _EDIT)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean",
             pa.list_(pa.int64()): "array<long>", pa.list_(pa.int32()): "array<int>",
             pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


@dataclass(frozen=True)
class Repaired:
    """``audits``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``turns``: conv_id, at, step (their order), edit, role, text of the rows after the edits."""

    audits: DataFrame
    turns: DataFrame


def repair(turns: DataFrame, block_bits: int = BLOCK_BITS) -> Repaired:
    """Repair all conversations of rows (conv_id, turn, role, text)."""
    rows = _rows(turns)
    numbered = _numbered(_faults(rows), block_bits)
    pieces = staged(numbered.drop("sha").groupBy("block").applyInArrow(_pieces, _ddl(_PIECE)), "repair-pieces")
    sums = ["blank", "duplicate", "truncated", "illegal", "gaps"]
    whole = pieces.where("not open").select(
        "conv_id", "block", F.lit(0).alias("start"), *sums, F.get("cost", F.lit(0)).alias("cost"),
        F.get("audit", F.lit(0)).alias("audit"))
    cut = pieces.where("open")
    ways = cut.drop("audit").groupBy("conv_id").applyInArrow(_through, _ddl(_WAY)).select(
        F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "start", "end", "closing",
        F.col("cost").alias("_cost"), F.col("illegal").alias("_illegal"), F.col("gaps").alias("_gaps"))
    joined = cut.join(ways, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))).select(
        "conv_id", "block", "start", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("_illegal")).alias(
            "illegal"), (F.col("gaps") + F.col("_gaps")).alias("gaps"), F.col("_cost").alias("cost"),
        F.concat(F.get("audit", F.col("start") * 4 + F.col("end")), "closing").alias("audit"))
    solved = staged(whole.unionByName(joined), "repair-audits")
    audits = solved.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in (*sums, "cost")],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]),
                     "").alias("audit"))
    edits = numbered.groupBy("block").cogroup(solved.select("block", "conv_id", "start", "audit").groupBy(
        "block")).applyInArrow(_edits, _ddl(_EDIT))
    texts = rows.groupBy(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("role").alias("_r"),
                         F.col("sha").alias("_s")).agg(F.first("text").alias("text"))
    # inserted rows have no text to find
    found = edits.join(texts, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
                       & (F.col("role") == F.col("_r")) & (F.col("sha") == F.col("_s")), "left")
    return Repaired(audits, found.select("conv_id", "at", "step", "edit", F.col("new_role").alias("role"),
                                         F.coalesce("text", F.lit("")).alias("text")))


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, SHA-256 of its ``role:text`` lines; read in order, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, out = None, None, []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()),
                                               pa.array([h for _, h in out], pa.string())],
                                              names=["conv_id", "repaired_sha256"])

        for batch in batches:
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if sha is None or conv != now:
                    if sha is not None:
                        out.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield rows()
            out = []
        if sha is not None:
            out.append((now, sha.hexdigest()))
            yield rows()

    order = [F.col("conv_id").asc_nulls_first(), F.col("at"), F.col("step")]
    return turns.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text").mapInArrow(
        run, "conv_id long, repaired_sha256 string")


# -------------------------------------------------------------------------------------------- the query


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage, by the CRC of ``conv_id:turn`` (a null counts as one space)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    hurt = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
                        kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
        F.col("text"))
    return hurt.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(F.array_repeat(F.lit(True), F.when(F.col("kind") == 3, 2).otherwise(1))).alias(
            "_")).drop("_")


def _null_safe(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnRenamed("conv_id", "_c")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair(damaged(turns))
    none: Column = F.lit(0).cast("long")
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = _null_safe(_null_safe(every, found.audits), digests(found.turns))
    return out.select(
        "conv_id", *[F.coalesce(c, none).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal",
                                                            "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _sql_state(after: int) -> str:
    """The least of all ways into a state, over the states ``b0`` to ``b3`` before a row."""
    ways = []  # (allowed, state before, cost, edits, text)
    for before, inserts in itertools.product(range(4), range(3)):
        state, said = before, ""
        for _ in range(inserts):
            said += f" || '{ROLES[NEXT[state]]}:' || chr(10)"
            state = FOLLOWS[state][NEXT[state]]
        cost, edits = f"b{before}.c + {5 * inserts}", "I" * inserts
        if state == after:
            ways.append(("true", before, f"{cost} + 2", edits + "D", said))
        for initial, follows in FOLLOWS[state].items():
            if follows == after:
                stays = f"{cost} + CASE WHEN truncated THEN 5 ELSE 0 END"
                ways.append((f"NOT forced AND initial = '{initial}'", before, stays, edits + "K",
                             f"{said} || role || ':' || text || chr(10)"))
                if initial in ROLES:
                    ways.append(("NOT forced", before, f"{stays} + 1", edits + "R",
                                 f"{said} || '{ROLES[initial]}:' || text || chr(10)"))
    return "least(" + ", ".join(
        f"CASE WHEN {allowed} THEN {{'c': {cost}, 'a': b{before}.a || '{edits}', 'x': b{before}.x{said}}} "
        "ELSE {'c': 1000000000, 'a': '', 'x': ''} END" for allowed, before, cost, edits, said in ways) + ")"


_EMPTY = "{'c': %d, 'a': '', 'x': ''}"
OP11_SQL = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
h AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''),
      lambda ch: ord(ch)::BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS kind FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM h WHERE kind <> 0),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    NOT regexp_matches(text, '[^ \\t-\\r]') AS blank FROM d),
f AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate FROM n),
r AS (
  SELECT conv_id, turn, role, text, i, blank, duplicate, blank OR duplicate AS forced, left(role, 1) AS initial,
    NOT blank AND NOT duplicate AND NOT regexp_matches(text, '[.!?][ \\t-\\r]*$') AS truncated,
    lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following FROM f),
s AS (
  SELECT conv_id, count(*) AS m, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
p AS (
  SELECT conv_id, 0::BIGINT AS i, {_EMPTY % 0} AS b0, {_EMPTY % 10 ** 9} AS b1, {_EMPTY % 10 ** 9} AS b2,
    {_EMPTY % 10 ** 9} AS b3 FROM s
  UNION ALL
  SELECT p.conv_id, p.i + 1, {', '.join(f"{_sql_state(k)} AS b{k}" for k in range(4))}
  FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1),
e AS (
  SELECT p.conv_id, least(b0, b3, {{'c': b2.c + 5, 'a': b2.a || 'I', 'x': b2.x || 'assistant:' || chr(10)}},
    {{'c': b1.c + 10, 'a': b1.a || 'II', 'x': b1.x || 'user:' || chr(10) || 'assistant:' || chr(10)}}) AS w
  FROM p JOIN s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.m = p.i)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.c, 0)::BIGINT AS cost, coalesce(w.a, '') AS audit,
  sha256(coalesce(left(w.x, greatest(length(w.x) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
