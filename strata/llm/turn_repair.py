"""Conversation structure repair: the cheapest edits that give user and assistant turns in turn, by a persistent audit DP.

States are where a repaired conversation stands: nothing yet, after a system turn, after a user turn, after an assistant turn. Each
state keeps its cheapest cost and, as a linked node, its edits; nodes share their prefixes, hold ancestors at powers of two (binary
lifting) and a rolling hash of all edits up to them. Equal costs are decided by the first edit that differs, which the hashes of ancestors
find; equal hashes count only once the edits themselves, or the nodes, are the same.

Two edit strings of one row, state and cost are never prefixes of one another (the longer would be inserts that come back to a state at a
cost), so comparing prefixes early decides as comparing whole audits would.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.tokens import slices

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: Where a reroled or an inserted turn leads: to the only role of the two that may follow.
TURN = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
DELETE, REROLE, INSERT, CUT_OFF = 2, 1, 5, 5
#: Rows between attempts to settle the edits that all states share.
SETTLE = 4096
_PRIME, _BASE = (1 << 61) - 1, 0x1F3A5B7C9D2E4F61 % ((1 << 61) - 1)


class Edits:
    """Edit strings as linked nodes; node 0 is the empty one."""

    def __init__(self, base: int = _BASE, prime: int = _PRIME):
        self.base, self.prime = base, prime
        self.op, self.size, self.hash, self.up = [""], [0], [0], [()]

    def add(self, parent: int, op: str) -> int:
        """The node of ``parent``'s edits and one more."""
        up, lifted = self.up, [parent]
        while len(up[lifted[-1]]) >= len(lifted):
            lifted.append(up[lifted[-1]][len(lifted) - 1])
        self.op.append(op)
        self.size.append(self.size[parent] + 1)
        self.hash.append((self.hash[parent] * self.base + ord(op)) % self.prime)
        up.append(tuple(lifted))
        return len(up) - 1

    def ancestor(self, x: int, size: int) -> int:
        """The first ``size`` edits of ``x``."""
        while self.size[x] > size:
            x = self.up[x][(self.size[x] - size).bit_length() - 1]
        return x

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of one size have the same edits, by the edits themselves."""
        while x != y:
            if self.op[x] != self.op[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def common(self, x: int, y: int) -> int:
        """The length of the longest common prefix of ``x`` and ``y``."""
        size = min(self.size[x], self.size[y])
        a, b = self.ancestor(x, size), self.ancestor(y, size)
        if a == b:
            return size
        if self.hash[a] != self.hash[b]:
            for j in reversed(range(len(self.up[a]))):
                if j < len(self.up[a]) and self.hash[self.up[a][j]] != self.hash[self.up[b][j]]:
                    a, b = self.up[a][j], self.up[b][j]
            a, b = self.up[a][0], self.up[b][0]
        if self.same(a, b):
            return self.size[a]
        while a != b:  # a collision: walk back to the first edit that differs
            if self.op[a] != self.op[b]:
                size = self.size[a] - 1
            a, b = self.up[a][0], self.up[b][0]
        return size

    def less(self, x: int, y: int) -> bool:
        """Whether ``x`` comes before ``y`` in ASCII order."""
        n = self.common(x, y)
        if n == self.size[x] or n == self.size[y]:
            return self.size[x] < self.size[y]
        return self.op[self.ancestor(x, n + 1)] < self.op[self.ancestor(y, n + 1)]

    def after(self, x: int, root: int) -> str:
        """The edits of ``x`` that follow its ancestor ``root``."""
        ops = []
        while x != root:
            ops.append(self.op[x])
            x = self.up[x][0]
        return "".join(reversed(ops))


class Repair:
    """One conversation's repair, row by row."""

    def __init__(self, settle: int = SETTLE):
        self.edits, self.best = Edits(), {NOTHING: (0, 0)}  # state: (cost, node)
        self.rows, self.settle = [], settle
        self.audit, self.state, self.hash, self.any = [], NOTHING, sha256(), False
        self._insert()

    def _offer(self, best: dict, state: int, cost: int, parent: int, op: str) -> bool:
        have = best.get(state)
        if have is None or cost < have[0]:
            best[state] = cost, self.edits.add(parent, op)
            return True
        if cost == have[0] and self.edits.less(node := self.edits.add(parent, op), have[1]):
            best[state] = cost, node
            return True
        return False

    def _insert(self) -> None:
        states = list(self.best)
        for s in states:
            cost, node = self.best[s]
            if self._offer(self.best, TURN[s], cost + INSERT, node, "I"):
                states.append(TURN[s])

    def add(self, role: str, text: str, fault: int) -> None:
        best: dict = {}
        for s, (cost, node) in self.best.items():
            self._offer(best, s, cost + DELETE, node, "D")
            if fault not in (BLANK, DUPLICATE):
                kept = cost + CUT_OFF * (fault == TRUNCATED)
                if (to := KEEP.get((s, role[:1]))) is not None:
                    self._offer(best, to, kept, node, "K")
                self._offer(best, TURN[s], kept + REROLE, node, "R")
        self.best = best
        self._insert()
        self.rows.append((role, text))
        if len(self.rows) % self.settle == 0:
            self._settle()

    def _settle(self) -> None:
        """Write what all states share and forget it; states that another one beats whatever comes are dropped."""
        best, e = self.best, self.edits
        if ASSISTANT in best:  # it can do all that NOTHING (but for keeping one system turn) and SYSTEM can
            cost = best[ASSISTANT][0]
            for s, more in ((NOTHING, DELETE), (SYSTEM, 0)):
                if s in best and best[s][0] > cost + more:
                    del best[s]
        live = [node for _, node in best.values()]
        low = min(e.size[x] for x in live)
        shared = [e.ancestor(x, low) for x in live]
        while len(set(shared)) > 1:  # halve towards the last common ancestor
            step = next((j for j in reversed(range(len(e.up[shared[0]]))) if len({e.up[x][j] for x in shared}) > 1), 0)
            shared = [e.up[x][step] for x in shared]
        root = shared[0]
        self._write(e.after(root, 0))
        fresh = Edits()
        known = {root: 0}
        for s, (cost, node) in best.items():
            chain = []
            while node not in known:
                chain.append(node)
                node = e.up[node][0]
            for x in reversed(chain):
                known[x] = fresh.add(known[node], e.op[x])
                node = x
            best[s] = cost, known[node]
        self.edits = fresh

    def _write(self, ops: str) -> None:
        n = 0
        for op in ops:
            role, text = ("", "") if op == "I" else self.rows[n]
            n += op != "I"
            if op == "D":
                continue
            if op == "K":
                self.state = KEEP[self.state, role[:1]]
            else:
                self.state = TURN[self.state]
                role = ROLE[self.state]
            self.hash.update(f"{chr(10) * self.any}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.any = True
        self.rows = self.rows[n:]
        self.audit.append(ops)

    def done(self) -> tuple[int, str, str]:
        """(cost, audit, SHA-256 of the repaired turns)."""
        ends = [self.best[s] for s in (NOTHING, ASSISTANT) if s in self.best]
        cost, node = ends[0]
        for c, x in ends[1:]:
            if c < cost or (c == cost and self.edits.less(x, node)):
                cost, node = c, x
        self._write(self.edits.after(node, 0))
        return cost, "".join(self.audit), self.hash.hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, dropped): rows damaged by crc32(conv_id:turn) % 20, null fields as one space.

    0 drops a row, 1 empties its text, 2 takes its . ! ? away, 3 repeats it, 4 gives it to the user. Dropped rows stay, marked.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    d = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"), d.alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"), (F.col("d") == 0).alias("dropped"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with fault: 1 blank, 2 a role and text seen earlier, 3 cut off; sorted by conversation, turn (nulls first), role and text, a conversation in one task."""
    rows = rows.repartition("conv_id")
    seen = F.row_number().over(W.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.asc_nulls_first("turn"), "copy"))
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("seen") > 1, DUPLICATE).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z"), TRUNCATED).otherwise(OK)
    return rows.withColumn("seen", seen).withColumn("fault", fault).drop("seen").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "copy")


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _repaired(settle: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = None

        def finished():
            cost, audit, digest = repair.done()
            span = last - first + 1 - turns if turns else 0
            return (conv, span, *faults[1:], illegal, cost, audit, digest)

        def record(out):
            types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["conv_id", *_COUNTS, "audit", "repaired_sha256"])

        out, repair = [], None
        for b in slices(batches, "text"):
            kind = b.schema.field("conv_id").type
            for c, turn, role, text, dropped, fault in zip(*(b[x].to_pylist() for x in ("conv_id", "turn", "role", "text", "dropped", "fault")), strict=True):
                if repair is None or c != conv:
                    if repair is not None:
                        out.append(finished())
                    conv, repair, faults, illegal, before = c, Repair(settle), [0] * 4, 0, None
                    first, last, turns = None, None, 0
                if dropped:
                    continue
                if turn is not None and turn != last:
                    first, last, turns = turn if first is None else first, turn, turns + 1
                faults[fault] += 1
                illegal += before is not None and (before, role[:1]) not in (("s", "u"), ("u", "a"), ("a", "u"))
                before = role[:1]
                repair.add(role, text, fault)
            if len(out) > 1 << 12:
                yield record(out)
                out = []
        if repair is not None:
            out.append(finished())
        if out:
            yield record(out)

    return run


def repair_turns(rows: DataFrame, *, settle: int = SETTLE) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation of damage(), or of rows like its.

    Keep costs 0, Rerole (to user or assistant) 1, Delete 2 (the only edit of blank rows and duplicates), Insert of an empty turn 5, and 5 more for
    a cut-off row that stays. The audit is the cheapest row of edits that leaves an optional system turn and then user and assistant in
    turn, or nothing; of equal costs the first in ASCII order.

    A conversation is edited by one task as its rows stream by, in one pass; every SETTLE rows the edits that all states share are written, so memory
    follows what is still undecided, and the audit's text.

    Defined results: null roles and texts are one space; rows of one turn are ordered by role, then text; null turns come first and make no gaps;
    equal rows are duplicates; rows with a null conv_id are one conversation; a conversation of which no row is left has zeros, an empty audit and
    the hash of an empty text; very long texts are read whole; an empty table gives an empty table; other columns are not read.
    """
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    return with_faults(rows).mapInArrow(_repaired(settle), schema)
