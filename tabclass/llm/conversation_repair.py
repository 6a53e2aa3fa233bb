"""Repair the turn structure of conversations with the cheapest audited edits.

The rows of a conversation, in turn order, are kept (K), given another role (R),
deleted (D) or preceded by an inserted empty row (I), so that the initials of the
roles become ``(s?(ua)+)?``.  A dynamic program over four states (nothing yet,
after s, after u, after a) finds the cheapest edits; among equally cheap ones the
audit string that is least in ASCII wins.

The audit strings of all states are one tree: a node is one edit, linked to the
edit before it, so equal prefixes are shared.  A node has binary-lifting ancestors
and the rolling hash of its whole prefix.  A tie is settled by a search for the
longest common prefix over those hashes; where hashes agree, the prefixes are
compared letter by letter up to their shared node, and a collision falls back to
the strings.  Two equally cheap audits of the same rows are never prefixes of one
another (the longer one would hold more inserts and cost more), so the order of
prefixes is the order of all their completions.  States that can't win any more are
dropped, and what the others' audits share is settled and leaves the tree: a letter
a row, or a few nodes a row where two ways stay equally cheap to the end.

Spark shuffles and sorts the rows by conversation (spilling as needed); a task
reads them as a stream and holds one batch, four hash states and the tree (of no texts).  The
text hash of a conversation is sequential by definition, so one conversation's
rows pass through one task, but are never held there.

Edge cases: null role or text is one space.  Rows of one turn are ordered by role,
then text; null turns come first.  All rows with a null conversation id form one
conversation.  Repeated rows are duplicates of the first.  An empty table gives an
empty table.  Other columns of the input are not looked at.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabclass.llm.common import pick, saved

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Faults of a row, the first that holds.
BLANK, DUPLICATE, CUT = 1, 2, 3
SPACES = " \t\n\x0b\f\r"

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a row of this initial, from each state; None where it can't follow.
FOLLOWS = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: The role that a reroled or inserted row gets in each state, and the state after it.
WANTED = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))

_MOD, _BASE = (1 << 61) - 1, 1_000_003
#: Nodes of the tree between two clean-ups, besides as many as the last one left.
CLEAN_AFTER = 2048

RESULT = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, starts_system boolean"
)


class Audits:
    """Edit strings as a tree of linked nodes; node 0 is the settled prefix."""

    def __init__(self) -> None:
        self.settled = bytearray()
        self.letter, self.depth, self.hash, self.up, self.same = [""], [0], [0], [()], [0]

    def add(self, parent: int, letter: str) -> int:
        up, at = [parent], parent
        while len(self.up[at]) >= len(up):
            at = self.up[at][len(up) - 1]
            up.append(at)
        node = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(letter)) % _MOD)
        self.up.append(tuple(up))
        self.same.append(node)
        return node

    def _climb(self, node: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def _canon(self, node: int) -> int:
        while self.same[node] != node:
            node = self.same[node]
        return node

    def _equal(self, a: int, b: int) -> bool:
        """Letter by letter, up to the node that both share; found equals are remembered."""
        walked = []
        while (x := self._canon(a)) != (y := self._canon(b)):
            if self.letter[x] != self.letter[y] or not x or not y:
                return False
            walked.append((x, y))
            a, b = self.up[x][0], self.up[y][0]
        for x, y in walked:
            self.same[max(x, y)] = min(x, y)
        return True

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def less(self, a: int, b: int) -> bool:
        """Whether a's string is before b's; both are below the same settled prefix."""
        m = min(self.depth[a], self.depth[b])
        x, y = self._climb(a, self.depth[a] - m), self._climb(b, self.depth[b] - m)
        if self.hash[x] == self.hash[y]:
            if self._equal(x, y):
                return self.depth[a] < self.depth[b]
            return self.text(a) < self.text(b)
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if not self._equal(self.up[x][0], self.up[y][0]):
            return self.text(a) < self.text(b)
        return self.letter[x] < self.letter[y]

    def clean(self, live: list[int]) -> list[int]:
        """Keep what the live nodes need; what they all share becomes settled."""
        held: set[int] = set()
        for node in live:
            while node and node not in held:
                held.add(node)
                node = self.up[node][0]
        order = sorted(held)
        children: dict[int, list[int]] = {}
        for node in order:
            children.setdefault(self.up[node][0], []).append(node)
        root, ends = 0, set(live)
        while root not in ends and len(children.get(root, ())) == 1:
            root = children[root][0]
            self.settled += self.letter[root].encode()
        old = self.letter, self.up
        self.letter, self.depth, self.hash, self.up, self.same = [""], [0], [0], [()], [0]
        now = {root: 0}
        for node in order:
            if old[1][node][0] in now and node not in now:
                now[node] = self.add(now[old[1][node][0]], old[0][node])
        return [now[n] for n in live]


class Conversation:
    """The dynamic program over the rows of one conversation, fed in order."""

    def __init__(self) -> None:
        self.tree = Audits()
        #: By state: (cost, node, hash of the repaired text, whether it starts with s), or None.
        self.best = [(0, 0, hashlib.sha256(), False), None, None, None]
        self._inserts(self.best)
        self.count = [0, 0, 0, 0]
        self.clean_at = CLEAN_AFTER
        self.illegal = 0
        self.before: str | None = None
        self.turns: tuple[int, int, int] | None = None

    def _offer(self, table: list, state: int, cost: int, source: tuple, letter: str, text: str | None, began: int, initial: str = "") -> bool:
        """Take this way into ``state`` if it is cheaper, or as cheap and less."""
        now = table[state]
        if now is not None and now[0] < cost:
            return False
        node = self.tree.add(source[1], letter)
        if now is not None and now[0] == cost and not self.tree.less(node, now[1]):
            return False
        done = source[2]
        if text is not None:
            done = done.copy()
            done.update((text if began == START else "\n" + text).encode())
        table[state] = (cost, node, done, initial == "s" if began == START and text is not None else source[3])
        return True

    def _inserts(self, table: list) -> None:
        changed = True
        while changed:
            changed = False
            for state, source in enumerate(table):
                if source is not None:
                    role, to = WANTED[state]
                    changed |= self._offer(table, to, source[0] + INSERT, source, "I", role + ":", state)

    def row(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.count[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None:
            low, high, n = self.turns or (turn, turn - 1, 0)
            self.turns = (low, turn, n + (turn != high))
        after: list = [None] * 4
        extra = TRUNCATED * (fault == CUT)
        for state, source in enumerate(self.best):
            if source is None:
                continue
            cost = source[0]
            self._offer(after, state, cost + DELETE, source, "D", None, state)
            if fault in (BLANK, DUPLICATE):
                continue
            to = FOLLOWS.get(role[:1], (None,) * 4)[state]
            if to is not None:
                self._offer(after, to, cost + KEEP + extra, source, "K", f"{role}:{text}", state, role[:1])
            role_, to = WANTED[state]
            self._offer(after, to, cost + REROLE + extra, source, "R", f"{role_}:{text}", state)
        self._inserts(after)
        # From ``a`` every way on from ``s`` is open at the same cost, and every way on
        # from the start at DELETE more (its leading s): what costs more than that goes.
        for state, more in ((START, DELETE), (SYSTEM, 0)):
            if after[state] and after[ASSISTANT] and after[state][0] > after[ASSISTANT][0] + more:
                after[state] = None
        self.best = after
        if len(self.tree.letter) > self.clean_at:
            there = [i for i, b in enumerate(after) if b is not None]
            for i, node in zip(there, self.tree.clean([after[i][1] for i in there])):
                after[i] = (after[i][0], node, *after[i][2:])
            self.clean_at = 2 * len(self.tree.letter) + CLEAN_AFTER

    def result(self) -> dict:
        low, high, n = self.turns or (0, -1, 0)
        ends = [b for b in (self.best[START], self.best[ASSISTANT]) if b is not None]  # never both dropped
        best = ends[0]
        for other in ends[1:]:
            if other[0] < best[0] or other[0] == best[0] and self.tree.less(other[1], best[1]):
                best = other
        return {
            "gaps": high - low + 1 - n, "blank": self.count[BLANK], "duplicate": self.count[DUPLICATE], "truncated": self.count[CUT],
            "illegal": self.illegal, "cost": best[0], "audit": self.tree.settled.decode() + self.tree.text(best[1]),
            "repaired_sha256": best[2].hexdigest(), "starts_system": best[3],
        }


def _audit_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation -> one result a conversation."""
    now, work, schema, done = None, None, None, []

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pylist(done, schema)
        done.clear()
        return out

    for batch in batches:
        if schema is None:
            kind = batch.schema.field("conv_id").type
            schema = pa.schema(
                [("conv_id", kind), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                 ("audit", pa.string()), ("repaired_sha256", pa.string()), ("starts_system", pa.bool_())]
            )
        for conv, dropped, turn, role, text, fault in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "dropped", "turn", "role", "text", "fault")]):
            if work is None or conv != now:
                if work is not None:
                    done.append({"conv_id": now} | work.result())
                now, work = conv, Conversation()
            if not dropped:
                work.row(turn, role, text, fault)
        if len(done) >= 1000:
            yield flush()
    if work is not None:
        done.append({"conv_id": now} | work.result())
        yield flush()


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, dropped): rows damaged by a fixed rule on
    crc32(``conv_id:turn``) mod 20, for trials of the repair: 0 drops the row, 1
    empties the text, 2 takes its ``.!?`` out, 3 repeats the row, 4 sets the role to
    user.  Nulls (also in the hashed text) are one space; dropped rows stay, marked."""
    rows = pick(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), kind.alias("kind"), shown("role").alias("role"), shown("text").alias("text")
    ).select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """With every row's first fault; a conversation is in one partition, in order."""
    in_turn = F.col("turn").asc_nulls_first()
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    again = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(in_turn)) > 1
    fault = F.when(body == "", BLANK).when(again, DUPLICATE).when(~F.right(body, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(0)
    clear = lambda c: F.when(~F.col("dropped"), F.col(c))
    rows = rows.select("conv_id", "dropped", *[clear(c).alias(c) for c in ("turn", "role", "text")]).repartition("conv_id")
    return rows.withColumn("fault", F.when(F.col("dropped"), 0).otherwise(fault)).sortWithinPartitions("conv_id", in_turn, "role", "text")


def _given(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, dropped: Column | None) -> DataFrame:
    flag = F.lit(False) if dropped is None else F.coalesce(dropped, F.lit(False))
    rows = conversations.withColumn("_dropped", flag)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = pick(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col, dropped="_dropped")
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role"), text("text"), "dropped")


def audits(conversations: DataFrame, dropped: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a conversation: its faults, the cost and audit of the cheapest edits,
    the hash of the repaired text (``role:text``, joined by newlines) and whether that
    begins with a system row.  Rows where ``dropped`` holds only name their
    conversation; one of which no row is left has zeros and an empty audit."""
    rows = _ordered(_given(conversations, conv_col, turn_col, role_col, text_col, dropped))
    return saved(rows.mapInArrow(_audit_stream, RESULT.format(id=rows.schema["conv_id"].dataType.simpleString())), "conversation-audits")


def repaired(conversations: DataFrame, found: DataFrame, dropped: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, position, role, text, edit) of every row of the repaired
    conversations, by the audits that ``audits`` found for the same rows."""
    rows = _ordered(_given(conversations, conv_col, turn_col, role_col, text_col, dropped)).where("NOT dropped")
    in_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.select("conv_id", "role", "text", F.row_number().over(in_turn).cast("long").alias("nth"))
    edits = found.where("audit <> ''").select("conv_id", "starts_system", F.posexplode(F.split("audit", "")).alias("p", "edit"))
    upto = Window.partitionBy("conv_id").orderBy("p")
    edits = edits.select(
        F.col("conv_id").alias("c"), "starts_system", "edit",
        F.sum(F.when(F.col("edit") != "I", 1).otherwise(0)).over(upto).alias("row"),
        F.sum(F.when(F.col("edit") != "D", 1).otherwise(0)).over(upto).alias("position"),
    ).where("edit <> 'D'")
    odd = (F.col("position") - F.col("starts_system").cast("long")) % 2 == 1
    both = edits.join(rows, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("row") == F.col("nth")) & (F.col("edit") != "I"), "left")
    return both.select(
        F.col("c").alias("conv_id"), "position",
        F.when(F.col("edit") == "K", F.col("role")).when(odd, "user").otherwise("assistant").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), "edit",
    )
