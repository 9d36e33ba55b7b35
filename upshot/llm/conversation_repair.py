"""Conversation repair: the cheapest edits that make the roles ``(s?(ua)+)?``, by a grammar-compressed min-plus DP.

Every row becomes a symbol (initial of its role, truncated or not, or a row
that must go), every conversation a string of symbols. Re-Pair rules are
learnt over the distinct strings of all conversations: in each round Spark
counts adjacent pairs and the most frequent ones become rules. A symbol has a
4 x 4 transfer matrix over the states of the role automaton, whose entries are
(cost, audit rope); a rule's matrix is the min-plus product of its two parts,
evaluated bottom-up once and shared by all conversations, whose strings are
then products of few matrices. The grammar decides speed only, never a result.

Ties go to the ASCII-least audit. Two audits of one stretch with equal cost
consume the same rows, so neither is a prefix of the other, and the smaller
one stays smaller whatever is appended: keeping one entry for each pair of
states is exact.

Rows are dealt by ranges of (conversation, turn, ...), so a conversation may
span many tasks; each task cuts its rows into chunks of bounded size. A
conversation inside one chunk, nearly every one, is finished there. Chunks of
the others learn which of their rows stand earlier in another chunk by a
grouping of digests, are multiplied range by range and then together, and the
repaired text is hashed in one stream (SHA-256 is sequential) that holds a chunk at a time.
The audit of one conversation is one value, so the last product holds a few strings of its length.

Defined cases: null role or text is one space; null turns come first and count
for no gap; null conversations form one; rows of one turn are ordered by role,
the text's first 32 characters, a hash of the text; a role without characters
is no valid one and is rerolled or deleted; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upshot.llm.common import cut, prepare

CHUNK_ROWS, CHUNK_CHARS = 512, 4_000_000
#: Rounds of rule learning and rules learnt in each.
ROUNDS, PER_ROUND = 5, 32
WHITE = " \t\n\v\f\r"
STATES, ACCEPT = 4, (0, 3)          # nothing yet, after s, after u, after a
MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
RIGHT_PAIRS = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}


class Rope:
    """Audit as a concatenation; its text is put together only when it is needed, and then kept."""

    __slots__ = ("left", "right", "_text")

    def __init__(self, text: str | None = None, left: Rope | None = None, right: Rope | None = None) -> None:
        self._text, self.left, self.right = text, left, right

    @property
    def text(self) -> str:
        if self._text is None:
            parts, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope._text is None:
                    todo += [rope.right, rope.left]
                else:
                    parts.append(rope._text)
            self._text, self.left, self.right = "".join(parts), None, None
        return self._text


def product(a: list, b: list) -> list:
    """Min-plus product of matrices (rows of entries (cost, rope) or None); equal costs by least audit."""
    out = []
    for row in a:
        line = []
        for j in range(STATES):
            least, ways = None, []
            for k, first in enumerate(row):
                second = b[k][j]
                if first is None or second is None:
                    continue
                cost = first[0] + second[0]
                if least is None or cost < least:
                    least, ways = cost, []
                if cost == least:
                    ways.append(Rope(left=first[1], right=second[1]))
            line.append((least, ways[0] if len(ways) == 1 else min(ways, key=lambda r: r.text)) if ways else None)
        out.append(line)
    return out


def _matrix(entries: dict) -> list:
    return [[(entries[i, j][0], Rope(entries[i, j][1])) if (i, j) in entries else None for j in range(STATES)]
            for i in range(STATES)]


def _insertions() -> list:
    """Cheapest insertions that lead from state to state (a full round trip is never cheapest)."""
    found = {(i, i): (0, "") for i in range(STATES)}
    for _ in range(STATES):
        for (i, k), (cost, audit) in list(found.items()):
            for role in NAMES:
                j = MOVES[role].get(k)
                if j is not None and found.get((i, j), (99, ""))[0] > cost + INSERT:
                    found[i, j] = (cost + INSERT, audit + "I")
    return _matrix(found)


INSERTIONS = _insertions()


def _edits(symbol: str) -> list:
    """Matrix of one row: keep, rerole or delete it, then insert what is cheapest."""
    found = {(i, i): (DELETE, "D") for i in range(STATES)}
    if symbol != "D":
        extra = TRUNCATED if symbol.isupper() else 0
        for role, moves in MOVES.items():
            letter, cost = ("K", extra) if role == symbol.lower() else ("R", REROLE + extra)
            for i, j in moves.items():
                if letter == "K" or role in NAMES:
                    found[i, j] = min(found.get((i, j), (99, "")), (cost, letter))
    return product(_matrix(found), INSERTIONS)


class Grammar:
    """Re-Pair rules over row symbols with their matrices."""

    def __init__(self) -> None:
        self.rules: list[tuple[str, str]] = []
        self.matrices = {c: _edits(c) for c in "sSuUaAoOD"}
        self.start = [INSERTIONS[0]]

    def add(self, pair: str) -> None:
        new = chr(0xE000 + len(self.rules))
        self.rules.append((pair, new))
        self.matrices[new] = product(self.matrices[pair[0]], self.matrices[pair[1]])

    def compress(self, symbols: str) -> str:
        for pair, new in self.rules:
            symbols = symbols.replace(pair, new)
        return symbols

    def multiply(self, left: list, symbols: str) -> list:
        for c in self.compress(symbols):
            left = product(left, self.matrices[c])
        return left

    def solve(self, symbols: str) -> tuple[int, str]:
        return best(self.multiply(self.start, symbols))


def best(row: list) -> tuple[int, str]:
    return min((row[0][s][0], row[0][s][1].text) for s in ACCEPT if row[0][s] is not None)


def learn(strings: DataFrame, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> Grammar:
    """Rules from the distinct symbol strings (column ``symbols``); a bounded number of pairs reaches the driver."""
    grammar = Grammar()
    for _ in range(rounds):
        def pairs(batches: Iterator[pa.RecordBatch], grammar=grammar) -> Iterator[pa.RecordBatch]:
            for b in batches:
                text = grammar.compress("\n".join(b.column(0).to_pylist()))
                codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
                both = (codes[:-1] << 32 | codes[1:])[(codes[:-1] != 10) & (codes[1:] != 10)]
                pair, n = np.unique(both, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], ["pair", "n"])

        found = strings.select("symbols").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = found.where("n > 1").orderBy(F.desc("n"), "pair").limit(4 * per_round).collect()
        firsts, seconds, added = set(), set(), 0
        for r in top:
            a, b = chr(r.pair >> 32), chr(r.pair & 0xFFFFFFFF)
            free = a not in seconds and b not in firsts and a != b     # pairs of one round must not eat each other
            if added < per_round and (free or (a == b and not added)):
                grammar.add(a + b)
                firsts.add(a)
                seconds.add(b)
                added += 1
        if not added:
            break
    return grammar


def _symbol(role: str, text: str, seen: set) -> str:
    text_end = text.rstrip(WHITE)
    if not text_end:
        return "b"
    if (role, text) in seen:
        return "d"
    seen.add((role, text))
    kind = role[:1] if role[:1] in MOVES else "o"
    return kind if text_end[-1] in ".!?" else kind.upper()


def _digest(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


_CHUNK = ("cid long, edge boolean, symbols string, roles array<string>, texts array<string>, digests array<binary>, "
          "first_turn long, last_turn long, turns long")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the sorted rows of a task into chunks; ``edge`` marks those of conversations that may go on elsewhere."""
    cid, kind, first_conv = TaskContext.get().partitionId() << 33, None, True
    held, chars, seen, ready = None, 0, set(), []

    def close(edge: bool) -> None:
        nonlocal held, chars, seen
        held["edge"] = edge
        held["symbols"] = "".join(held["symbols"])
        if edge:
            held["digests"] = [_digest(*r) for s, *r in zip(held["symbols"], held["roles"], held["texts"], strict=True) if s not in "bd"]
        turns = held.pop("all_turns")
        held |= {"first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(turns)}
        ready.append(held)
        held, chars, seen = None, 0, set()

    def flush() -> list[pa.RecordBatch]:
        out = pa.Table.from_pylist(ready, schema=shape).combine_chunks().to_batches()
        ready.clear()
        return out

    for b in batches:
        kind = kind or b.schema.field("conv").type
        shape = pa.schema([
            ("conv", kind), ("cid", pa.int64()), ("edge", pa.bool_()), ("symbols", pa.string()),
            ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("digests", pa.list_(pa.binary())),
            ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64())])
        for conv, turn, role, text in zip(*[b.column(c).to_pylist() for c in ("conv", "turn", "role", "text")], strict=True):
            if held is not None and (held["conv"] != conv or len(held["roles"]) >= CHUNK_ROWS or chars >= CHUNK_CHARS):
                same = held["conv"] == conv
                close(same or first_conv or held["more"])
                first_conv = first_conv and same
                more = same
            else:
                more = False
            if held is None:
                held = {"conv": conv, "cid": cid, "more": more, "symbols": [], "roles": [], "texts": [], "all_turns": []}
                cid += 1
            held["symbols"].append(_symbol(role, text, seen))
            held["roles"].append(role)
            held["texts"].append(text)
            if turn is not None and held["all_turns"][-1:] != [turn]:
                held["all_turns"].append(turn)
            chars += len(text)
        if ready:
            yield from flush()
    if held is not None:
        close(True)
        yield from flush()


def _wanted(symbols: str) -> str:
    """Symbols as the matrices know them: a blank or repeated row must go."""
    return symbols.replace("b", "D").replace("d", "D")


def _walk(audit: str, at: int, state: int, roles: list[str], texts: list[str]) -> tuple[int, int, list[tuple[str, str]]]:
    """Applies ``audit`` from ``at`` on to one chunk's rows; insertions before the next chunk's first row included."""
    out, row = [], 0
    while at < len(audit):
        letter = audit[at]
        if letter != "I" and row == len(roles):
            break
        at += 1
        if letter == "D":
            row += 1
            continue
        role = "a" if state == 2 else "u"
        if letter == "K":
            role = roles[row][:1]
        state = MOVES[role][state]
        out.append((NAMES[role], "") if letter == "I" else (roles[row] if letter == "K" else NAMES[role], texts[row]))
        row += letter != "I"
    return at, state, out


class _Result:
    """Statistics, and the repaired text's hash, of one conversation whose chunks come in order."""

    def __init__(self, conv) -> None:
        self.conv, self.audit, self.cost = conv, None, 0
        self.low = self.high = None
        self.distinct = self.illegal = 0
        self.counts = {"b": 0, "d": 0, "cut": 0}
        self.last_role, self.hash, self.lines, self.at, self.state = None, hashlib.sha256(), 0, 0, 0

    def add(self, chunk: dict) -> list[tuple[str, str]]:
        if chunk["first_turn"] is not None:
            self.distinct += chunk["turns"] - (self.high == chunk["first_turn"])
            self.low = chunk["first_turn"] if self.low is None else self.low
            self.high = chunk["last_turn"]
        marks = [r[:1] for r in chunk["roles"]]
        before = [] if self.last_role is None else [self.last_role]
        around = before + marks
        self.illegal += sum(x + y not in RIGHT_PAIRS for x, y in zip(around, around[1:], strict=False))
        self.last_role = marks[-1]
        symbols = chunk["symbols"]
        self.counts["b"] += symbols.count("b")
        self.counts["d"] += symbols.count("d")
        self.counts["cut"] += sum(symbols.count(c) for c in "SUAO")
        self.at, self.state, rows = _walk(self.audit, self.at, self.state, chunk["roles"], chunk["texts"])
        for role, text in rows:
            self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
            self.lines += 1
        return rows

    def row(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {"conv": self.conv, "gaps": gaps, "blank": self.counts["b"], "duplicate": self.counts["d"],
                "truncated": self.counts["cut"], "illegal": self.illegal, "cost": self.cost, "audit": self.audit,
                "repaired_sha256": self.hash.hexdigest()}


_LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _finish(grammar, rows_out: bool):
    """Arrow function over chunks in (conversation, cid) order; a leading row with cid -1 brings a known audit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, str]] = {}
        now, done, kind = None, [], None

        def result_shape():
            if rows_out:
                turn = pa.struct([("role", pa.string()), ("text", pa.string())])
                return pa.schema([("conv", kind), ("cid", pa.int64()), ("turns", pa.list_(turn))])
            return pa.schema([("conv", kind), *[(c, pa.int64()) for c in _LONGS], ("audit", pa.string()),
                              ("repaired_sha256", pa.string())])

        for b in batches:
            kind = kind or b.schema.field("conv").type
            for chunk in b.to_pylist():
                if now is None or chunk["conv"] != now.conv:
                    if now is not None and not rows_out:
                        done.append(now.row())
                    now = _Result(chunk["conv"])
                    if chunk["cid"] < 0:
                        now.audit, now.cost = chunk["audit"], chunk["cost"]
                        continue
                    wanted = _wanted(chunk["symbols"])
                    if wanted not in known:
                        if len(known) > 50_000:
                            known.clear()
                        known[wanted] = grammar.value.solve(wanted)
                    now.cost, now.audit = known[wanted]
                turns = now.add(chunk)
                if rows_out:
                    done.append({"conv": now.conv, "cid": chunk["cid"], "turns": [{"role": r, "text": t} for r, t in turns]})
            if done:
                yield from pa.Table.from_pylist(done, schema=result_shape()).combine_chunks().to_batches()
                done = []
        if now is not None and not rows_out:
            yield from pa.Table.from_pylist([now.row()], schema=result_shape()).combine_chunks().to_batches()

    return run


_MATRIX = "costs array<long>, audits array<string>"


def _flat(matrix: list) -> dict:
    entries = [e for line in matrix for e in line]
    return {"costs": [None if e is None else e[0] for e in entries],
            "audits": [None if e is None else e[1].text for e in entries]}


def _unflat(costs: list, audits: list) -> list:
    entries = [None if c is None else (c, Rope(a)) for c, a in zip(costs, audits, strict=True)]
    return [entries[i:i + STATES] for i in range(0, len(entries), STATES)]


def _multiplied(keys: list[str]):
    """Arrow function: running product of the matrices of equal ``keys``, in the order they come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shape = None, None, None

        def out():
            row = dict(zip(keys, key, strict=True)) | _flat(held)
            return pa.Table.from_pylist([row], schema=shape).to_batches()

        for b in batches:
            shape = shape or pa.schema([*[b.schema.field(k) for k in keys], ("costs", pa.list_(pa.int64())),
                                        ("audits", pa.list_(pa.string()))])
            for r in b.to_pylist():
                new, matrix = tuple(r[k] for k in keys), _unflat(r["costs"], r["audits"])
                if new == key:
                    held = product(held, matrix)
                else:
                    if held is not None:
                        yield from out()
                    key, held = new, matrix
        if held is not None:
            yield from out()

    return run


def _chunk_matrices(grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one = _matrix({(i, i): (0, "") for i in range(STATES)})
            rows = [_flat(grammar.value.multiply(one, _wanted(s))) for s in b.column("symbols").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("cid"), pa.array([r["costs"] for r in rows], pa.list_(pa.int64())),
                 pa.array([r["audits"] for r in rows], pa.list_(pa.string()))], ["conv", "cid", "costs", "audits"])

    return run


def _final(grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [best(product(grammar.value.start, _unflat(c, a)))
                    for c, a in zip(b.column("costs").to_pylist(), b.column("audits").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
                ["conv", "cost", "audit"])

    return run


def _marked(symbols: str, digests: list[bytes], fresh: list[bytes] | None) -> str:
    """Symbols with the rows that stand in an earlier chunk of the conversation marked as repeated."""
    new, place = set(fresh or ()), iter(digests)
    return "".join(s if s in "bd" or next(place) in new else "d" for s in symbols)


@F.arrow_udf(T.StringType())
def _across(symbols: pa.Array, digests: pa.Array, fresh: pa.Array) -> pa.Array:
    return pa.array([_marked(*r) for r in zip(symbols.to_pylist(), digests.to_pylist(), fresh.to_pylist(), strict=True)], pa.string())


class Repair:
    """Repair of all conversations of a table with columns given as expressions."""

    def __init__(self, rows: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> None:
        prepare(rows.sparkSession)
        space = F.lit(" ")
        rows = rows.select(conv.alias("conv"), turn.cast("long").alias("turn"),
                           F.coalesce(role.cast("string"), space).alias("role"), F.coalesce(text.cast("string"), space).alias("text"))
        rows = rows.withColumn("begin", F.substring("text", 1, 32)).withColumn("h", F.xxhash64("text")).withColumn(
            "uid", F.monotonically_increasing_id())
        order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "begin", "h", "uid")]
        kind = rows.schema["conv"]
        self.conv = T.StructType([T.StructField("conv", kind.dataType)])
        sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text")
        chunks = cut(sorted_rows.mapInArrow(_chunks, self._shape(_CHUNK)), "repair-chunks")
        self.single = chunks.where("NOT edge").drop("edge", "digests")
        self.multi = cut(self._resolved(chunks.where("edge").drop("edge")), "repair-edges")
        strings = self.single.select("symbols").unionByName(self.multi.select("symbols"))
        strings = strings.select(F.translate("symbols", "bd", "DD").alias("symbols")).where("length(symbols) > 1").distinct()
        self.grammar = rows.sparkSession.sparkContext.broadcast(learn(cut(strings, "repair-strings")))
        self.audits = cut(self._multi_audits(), "repair-audits")

    def _shape(self, rest: str) -> T.StructType:
        return T.StructType([*self.conv.fields, *T.DataType.fromDDL(rest).fields])

    def _resolved(self, edges: DataFrame) -> DataFrame:
        """Edge chunks whose symbols know the rows of all earlier chunks; equal rows meet only as digests."""
        homes = edges.select("conv", "cid", F.explode("digests").alias("digest")).groupBy("conv", "digest").agg(
            F.min("cid").alias("cid"))
        fresh = homes.groupBy("cid").agg(F.collect_list("digest").alias("fresh"))
        known = edges.join(fresh, "cid", "left")
        return known.withColumn("symbols", _across("symbols", "digests", "fresh")).drop("digests", "fresh")

    def _multi_audits(self) -> DataFrame:
        """(conv, cost, audit) of the conversations with edge chunks: products by range, then over ranges."""
        one = self._shape("cid long, " + _MATRIX)
        mats = self.multi.select("conv", "cid", "symbols").mapInArrow(_chunk_matrices(self.grammar), one)
        mats = mats.withColumn("part", F.shiftright("cid", 33))
        parts = mats.repartition("conv", "part").sortWithinPartitions("conv", "part", "cid").mapInArrow(
            _multiplied(["conv", "part"]), self._shape("part long, " + _MATRIX))
        whole = parts.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(
            _multiplied(["conv"]), self._shape(_MATRIX))
        return whole.mapInArrow(_final(self.grammar), self._shape("cost long, audit string"))

    def _streamed(self, rows_out: bool, shape: T.StructType) -> DataFrame:
        columns = ["conv", "cid", "symbols", "roles", "texts", "first_turn", "last_turn", "turns"]
        run = _finish(self.grammar, rows_out)
        alone = self.single.select(*columns).mapInArrow(run, shape)
        audits = self.audits.withColumn("cid", F.lit(-1).cast("long"))
        both = self.multi.select(*columns).unionByName(audits, allowMissingColumns=True)
        return alone.unionByName(both.repartition("conv").sortWithinPartitions("conv", "cid").mapInArrow(run, shape))

    def conversations(self) -> DataFrame:
        """One row for each conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        longs = ", ".join(f"{c} long" for c in _LONGS)
        return self._streamed(False, self._shape(f"{longs}, audit string, repaired_sha256 string"))

    def turns(self) -> DataFrame:
        """Repaired rows: (conv, cid, turns): each chunk's array of struct(role, text); chunks in the order of cid."""
        return self._streamed(True, self._shape("cid long, turns array<struct<role:string,text:string>>"))
