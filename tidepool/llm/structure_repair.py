"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?``, by a grammar-compressed program.

A row of a conversation becomes one symbol: its role's initial (system, user,
assistant, other) and whether it ends as a sentence, or "must go" for blank rows
and repetitions.  A machine with four states (start, after system, after user,
after assistant) reads the symbols; for every symbol a 4 x 4 matrix says how
cheaply, and by which audit letters, one state becomes another while the row is
kept, re-roled or deleted, with rows inserted before it.  Matrices multiply in
the min-plus sense over (cost, audit): equal costs are decided by the smaller
audit, which is sound since no audit of a cost is the beginning of another of
the same cost and rows.

Symbol sequences repeat across conversations, so a Re-Pair grammar is drawn from
all of them: in each round Spark counts neighbouring pairs over all different
sequences, weighted by their occurrences, and the most frequent become rules.
One matrix per rule is made bottom-up from its two parts, its audits being ropes
over theirs, and all conversations share them.

A conversation need not fit a task: rows are dealt by ranges of (conversation,
turn, role, text digest), each task turns its stretch into segments of at most
``SEGMENT`` symbols, and the segments of one conversation are multiplied in
order.  Only the final audit (one value of the output) and the SHA-256 over the
repaired texts (serial by nature, streamed row by row in bounded memory) are
made where all of a conversation passes by.

Order of rows: turn (null first), role, SHA-256 of the text; repeated rows stand
together.  Edge cases: null role and text are one space, so such rows are blank
or have an "other" initial; an empty role has no initial and counts as "other";
a null conversation id is a conversation; a conversation without rows gives
zeros, an empty audit and the digest of the empty text; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import read_table, ship_by_value, written

ship_by_value(__name__)

DELETE, KEEP, REROLE, INSERT = "D", "K", "R", "I"
COST = {DELETE: 4, KEEP: 0, REROLE: 3, INSERT: 3}
TRUNCATED_COST = 3
START, SYSTEM, USER, ASSISTANT = range(4)       # what was emitted last
GONE = "X"                                      # a row that must be deleted
SYMBOLS = "suaoSUAOX"                           # clean rows by initial, truncated ones as capitals
SEGMENT = 2048
RULES_PER_ROUND, GRAMMAR_ROUNDS = 32, 6
RULE_LENGTH = 512                               # symbols a rule stands for
SPACE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# --- the machine ---------------------------------------------------------------------------------------------------

class Rope:
    """Audit letters of a rule: those of its left and right part, joined when first read."""

    __slots__ = ("left", "right", "_text")

    def __init__(self, left, right):
        self.left, self.right, self._text = left, right, None

    @property
    def text(self) -> str:
        if self._text is None:
            self._text = self.left.text + self.right.text
        return self._text


class Leaf:
    __slots__ = ("text",)

    def __init__(self, text: str):
        self.text = text


def next_role(state: int) -> str:
    """The role a re-roled or inserted row gets."""
    return "assistant" if state == USER else "user"


def _emit(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _before(state: int):
    """(state, inserted rows) reachable by inserting; more than two only return to a state."""
    out = [(state, 0)]
    for n in (1, 2):
        state = _emit(state)
        if state not in [s for s, _ in out]:
            out.append((state, n))
    return out


def symbol_matrix(symbol: str) -> list:
    """matrix[q][r]: (cost, audit) of the cheapest way from state q to r over one row, or None."""
    late, kind = (TRUNCATED_COST if symbol.isupper() else 0), symbol.lower()
    out = [[None] * 4 for _ in range(4)]
    for q in range(4):
        for p, n in _before(q):
            lead, cost = INSERT * n, COST[INSERT] * n
            ways = [(p, COST[DELETE], DELETE)]
            if symbol != GONE:
                target = next_role(p)[0]
                edit = KEEP if kind == target else REROLE
                ways.append((_emit(p), COST[edit] + late, edit))
                if kind == "s" and p == START:
                    ways.append((SYSTEM, COST[KEEP] + late, KEEP))
            for r, c, edit in ways:
                new = (cost + c, lead + edit)
                if out[q][r] is None or new < (out[q][r][0], out[q][r][1].text):
                    out[q][r] = (new[0], Leaf(new[1]))
    return out


def multiply(a: list, b: list) -> list:
    """Min-plus product; equal costs go to the smaller audit."""
    out = [[None] * 4 for _ in range(4)]
    for q in range(4):
        for r in range(4):
            best = None
            for m in range(4):
                x, y = a[q][m], b[m][r]
                if x is None or y is None:
                    continue
                cost = x[0] + y[0]
                if best is None or cost < best[0]:
                    best = (cost, Rope(x[1], y[1]))
                elif cost == best[0]:
                    new = Rope(x[1], y[1])
                    if new.text < best[1].text:
                        best = (cost, new)
            out[q][r] = best
    return out


def _path(node):
    """Nodes (parent, piece, depth) of a trail, last first."""
    while node is not None:
        yield node
        node = node[0]


def _smaller(a, b) -> bool:
    """Whether trail ``a`` reads smaller than ``b``, compared from where they part."""
    left, right = [], []
    while a is not b:
        if b is None or (a is not None and a[2] >= b[2]):
            left.append(a[1])
            a = a[0]
        else:
            right.append(b[1])
            b = b[0]
    return "".join(reversed(left)) < "".join(reversed(right))


def step(vector: list, matrix: list) -> list:
    """(cost, trail) per state after one more block."""
    out = [None] * 4
    for r in range(4):
        best = None
        for q in range(4):
            x, y = vector[q], matrix[q][r]
            if x is None or y is None:
                continue
            cost = x[0] + y[0]
            if best is not None and cost > best[0]:
                continue
            new = (x[1], y[1].text, x[1][2] + 1 if x[1] else 1)
            if best is None or cost < best[0] or _smaller(new, best[1]):
                best = (cost, new)
        out[r] = best
    return out


BEGIN = [(0, None), None, None, None]


def finish(vector: list) -> tuple[int, str]:
    """Cost and audit at the end, rows inserted there included."""
    best = None
    for q, n in ((START, 0), (SYSTEM, 2), (USER, 1), (ASSISTANT, 0)):
        if vector[q] is not None:
            cost, trail = vector[q]
            new = (cost + COST[INSERT] * n, (trail, INSERT * n, trail[2] + 1 if trail else 1))
            if best is None or new[0] < best[0] or (new[0] == best[0] and _smaller(new[1], best[1])):
                best = new
    return best[0], "".join(reversed([node[1] for node in _path(best[1])]))


class Solver:
    """Matrices of all rules, bottom-up; ``rules`` are (symbol, pair) in the order they were made."""

    def __init__(self, rules: list):
        self.rules = rules
        self.matrix = {s: symbol_matrix(s) for s in SYMBOLS}
        for name, pair in rules:
            self.matrix[name] = multiply(self.matrix[pair[0]], self.matrix[pair[1]])
        self.known: dict = {}

    def compressed(self, seq: str) -> str:
        return rewrite(seq, self.rules)

    def block(self, seq: str) -> list:
        """The matrix of a whole segment, by halves."""
        parts = [self.matrix[s] for s in self.compressed(seq)]
        while len(parts) > 1:
            parts = [multiply(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def whole(self, seq: str) -> tuple[int, str]:
        """(cost, audit) of a whole conversation."""
        if seq not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            vector = BEGIN
            for s in self.compressed(seq):
                vector = step(vector, self.matrix[s])
            self.known[seq] = finish(vector)
        return self.known[seq]


def rewrite(text: str, rules: list) -> str:
    for name, pair in rules:
        if pair in text:
            text = text.replace(pair, name)
    return text


# --- the grammar ---------------------------------------------------------------------------------------------------

def _pairs(rules: list):
    def run(batches):
        for batch in batches:
            found: Counter = Counter()
            seqs = rewrite("\n".join(batch.column("seq").to_pylist()), rules).split("\n")
            for seq, n in zip(seqs, batch.column("n").to_pylist()):
                for i in range(len(seq) - 1):
                    found[seq[i:i + 2]] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                             names=["pair", "n"])
    return run


def draw_grammar(sequences: DataFrame, rounds: int = GRAMMAR_ROUNDS, per_round: int = RULES_PER_ROUND) -> list:
    """Re-Pair rules [(symbol, pair)] from (seq, n): the most frequent pairs of each round over all sequences.

    The rules are bounded (rounds * per_round), whatever the table; what they leave stays as it is.
    """
    rules, length = [], {s: 1 for s in SYMBOLS}
    for _ in range(rounds):
        counts = sequences.mapInArrow(_pairs(rules), "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(per_round).collect()
        new = [r.pair for r in top if length[r.pair[0]] + length[r.pair[1]] <= RULE_LENGTH]
        if not new:
            break
        for pair in new:
            name = chr(0x100 + len(rules))
            rules.append((name, pair))
            length[name] = length[pair[0]] + length[pair[1]]
    return rules


# --- rows to segments ----------------------------------------------------------------------------------------------

def damage(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The contract's damage: (conv_id, turn, role, text, copies); a dropped row has no copies."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn)]
    fate = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    said = F.coalesce(F.col(text), F.lit(" "))
    return turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))


def classified(rows: DataFrame) -> DataFrame:
    """``rows`` with class (initial), ending (blank, open, closed) and text digest."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    return rows.select(
        "*", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        F.when(bare == "", "blank").when(F.substring(bare, -1, 1).isin(".", "!", "?"), "closed").otherwise("open").alias("ending"),
        F.unhex(F.sha2(F.col("text"), 256)).alias("d"))


def slim_rows(rows: DataFrame) -> DataFrame:
    """Different rows with their number of copies and whether they are the text's first turn, without texts."""
    present = F.col("copies") > 0
    keys = classified(rows).select(
        "conv_id", F.when(present, F.col("turn")).alias("turn"), F.when(present, F.col("role")).otherwise("").alias("role"),
        F.when(present, F.col("d")).otherwise(F.lit(b"")).alias("d"), F.when(present, F.col("initial")).otherwise("").alias("initial"),
        F.when(present, F.col("ending")).otherwise("gone").alias("ending"), F.col("copies").cast("long").alias("n"))
    slim = written(keys.groupBy("conv_id", "turn", "role", "d", "initial", "ending").agg(F.sum("n").alias("n")), "turn-keys")
    said = slim.where(F.col("ending").isin("open", "closed"))
    # Texts that a role says in several turns: the first turn is kept, null before all others.
    again = said.groupBy("conv_id", "role", "d").agg(
        F.count(F.lit(1)).alias("turns"), F.min("turn").alias("lo"), F.max(F.col("turn").isNull()).alias("early")).where("turns > 1")
    again = again.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("d").alias("_d"), "lo", "early")
    j = slim.join(again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("d") == F.col("_d"))
                  & F.col("ending").isin("open", "closed"), "left")
    fresh = F.when(F.col("_r").isNull(), True).when(F.col("early"), F.col("turn").isNull()).otherwise(
        F.coalesce(F.col("turn") == F.col("lo"), F.lit(False)))
    return j.select("conv_id", "turn", "role", "d", "initial", "ending", "n", fresh.alias("fresh"))


SEGMENTS = ("part int, seg long, whole boolean, seq string, blank long, duplicate long, truncated long, illegal long, "
            "first string, last string, lo long, hi long, turns long")
COUNTS = ("blank", "duplicate", "truncated", "illegal")


class _Segment:
    def __init__(self):
        self.seq, self.n = [], dict.fromkeys(COUNTS, 0)
        self.first = self.last = ""
        self.lo = self.hi = None
        self.turns = 0

    def add(self, symbol: str, initial: str, fault: str | None, n: int, turn) -> None:
        self.seq.append(symbol * n)
        if fault:
            self.n[fault] += n
        self.n["illegal"] += (n - 1) + (self.last != "" and self.last + initial not in LEGAL)
        self.first, self.last = self.first or initial, initial
        if turn is not None and turn != self.hi:
            self.turns, self.hi = self.turns + 1, turn
            self.lo = turn if self.lo is None else self.lo


def _segments(limit: int):
    """Rows of a stretch in order -> segments; ``whole``: surely all of its conversation."""
    def run(batches):
        part, number, out, kind = TaskContext.get().partitionId(), 0, [], None
        conv, now, length, inner, began = None, None, 0, False, False

        def close(whole):
            nonlocal number
            out.append((conv, part, number, whole, "".join(now.seq), *(now.n[c] for c in COUNTS), now.first, now.last,
                        now.lo, now.hi, now.turns))
            number += 1
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "ending", "n", "fresh")))
            for c, turn, initial, ending, n, fresh in rows:
                if now is None or c != conv:
                    if now is not None:
                        close(inner and not began)
                    # The first conversation of a stretch may have begun in another one.
                    inner, conv, now, length, began = now is not None, c, _Segment(), 0, False
                if ending == "gone":
                    continue
                letter = initial if ending == "closed" else initial.upper()
                runs = [(GONE, "blank", n)] if ending == "blank" else [(GONE, "duplicate", n)] if not fresh else [
                    (letter, "truncated" if ending == "open" else None, 1), (GONE, "duplicate", n - 1)]
                for symbol, fault, k in runs:
                    while k:
                        if length == limit:
                            close(False)
                            now, length, began = _Segment(), 0, True
                        take = min(k, limit - length)
                        now.add(symbol, initial, fault, take, turn)
                        length, k = length + take, k - take
            if len(out) >= 2_000:
                yield _table(out, kind)
                out.clear()
        if now is not None:
            close(False)
            yield _table(out, kind)
    return run


_NAMES = ["conv_id"] + [c.split()[0] for c in SEGMENTS.split(", ")]
_TYPES = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def _table(rows: list, kind, schema: str = SEGMENTS):
    names, types = zip(*(c.split() for c in schema.split(", ")))
    columns = list(zip(*rows)) if rows else [[]] * (len(names) + 1)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(columns, (kind, *(_TYPES[t] for t in types)))], names=["conv_id", *names])


def segments(slim: DataFrame, limit: int = SEGMENT) -> DataFrame:
    """Symbol segments of all conversations, in order of (part, seg), written to the shared folder."""
    order = ["conv_id", "turn", "role", "d"]
    n = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = slim.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv_id", "turn", "initial", "ending", "n", "fresh")
    kind = slim.schema["conv_id"].dataType.simpleString()
    return written(dealt.mapInArrow(_segments(limit), f"conv_id {kind}, {SEGMENTS}"), "turn-segments")


# --- segments to audits --------------------------------------------------------------------------------------------

AUDITS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _solve_whole(rules: list):
    def run(batches):
        solver = Solver(rules)
        for batch in batches:
            out = []
            for r in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", *COUNTS, "lo", "hi", "turns"))):
                gaps = r[7] - r[6] + 1 - r[8] if r[6] is not None else 0
                out.append((r[0], gaps, *r[2:6], *solver.whole(r[1])))
            yield _table(out, batch.schema.field("conv_id").type, AUDITS)
    return run


def _solve_parts(rules: list):
    """Segments of a conversation, in order, folded one after another."""
    def run(batches):
        solver, out, kind = Solver(rules), [], None
        conv, state = None, None

        def close():
            vector, counts, last, lo, hi, turns = state
            gaps = hi - lo + 1 - turns if lo is not None else 0
            out.append((conv, gaps, *counts, *finish(vector)))
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for r in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", *COUNTS, "first", "last", "lo", "hi", "turns"))):
                if state is None or r[0] != conv:
                    if state is not None:
                        close()
                    conv, state = r[0], (BEGIN, [0] * 4, "", None, None, 0)
                vector, counts, last, lo, hi, turns = state
                seq, first, end, lo2, hi2, turns2 = r[1], *r[6:]
                counts = [a + b for a, b in zip(counts, r[2:6])]
                if last and first and last + first not in LEGAL:
                    counts[3] += 1
                vector = step(vector, solver.block(seq)) if seq else vector
                turns += turns2 - (hi is not None and hi == lo2)
                state = (vector, counts, end or last, lo if lo is not None else lo2, hi2 if hi2 is not None else hi, turns)
            if len(out) >= 2_000:
                yield _table(out, kind, AUDITS)
                out.clear()
        if state is not None:
            close()
            yield _table(out, kind, AUDITS)
    return run


def audits(rows: DataFrame, limit: int = SEGMENT) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per conversation in ``rows``."""
    parts = segments(slim_rows(rows), limit)
    rules = draw_grammar(written(parts.where("seq != ''").groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "turn-sequences"))
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {AUDITS}"
    done = parts.where("whole").mapInArrow(_solve_whole(rules), schema)
    order = ["conv_id", "part", "seg"]
    rest = parts.where("NOT whole").repartition("conv_id").sortWithinPartitions(*order)
    return done.unionByName(rest.mapInArrow(_solve_parts(rules), schema))


# --- audits to repaired rows ---------------------------------------------------------------------------------------

class Replay:
    """Rows of one conversation in order -> (position, edit, role, text) of its repaired rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.position = audit, 0, START, 0

    def _put(self, edit: str, role: str, text: str, state: int):
        self.state, self.position = state, self.position + 1
        return self.position - 1, edit, role, text

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.at += 1
            yield self._put(INSERT, next_role(self.state), "", _emit(self.state))

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == REROLE:
            yield self._put(edit, next_role(self.state), text, _emit(self.state))
        elif edit == KEEP:
            yield self._put(edit, role, text, {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]])


class _Digest:
    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def add(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.any = True


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit row, then its rows in order, in one partition; rows are streamed, not gathered."""
    info = [c.split()[0] for c in AUDITS.split(", ")]
    marks = found.select("conv_id", F.lit(0).alias("o"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit(b"").alias("d"), F.lit("").alias("text"), F.lit(0).alias("copies"), *info)
    blank = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in AUDITS.split(", ")]
    body = classified(rows.where("copies > 0")).select("conv_id", F.lit(1).alias("o"), "turn", "role", "d", "text", "copies", *blank)
    return marks.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "o", "turn", "role", "d").drop("turn", "d")


REPORT = AUDITS + ", repaired_sha256 string"


def _report(batches):
    info = [c.split()[0] for c in AUDITS.split(", ")]
    out, kind, replay, digest, head = [], None, None, None, None

    def close():
        for _, _, role, text in replay.inserted():
            digest.add(role, text)
        out.append((*head, digest.sha.hexdigest()))
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for r in zip(*(batch.column(c).to_pylist() for c in ("o", "role", "text", "copies", "conv_id", *info))):
            if r[0] == 0:
                if head is not None:
                    close()
                head, replay, digest = r[4:], Replay(r[-1]), _Digest()
                continue
            for _ in range(r[3]):
                for _, _, role, text in replay.row(r[1], r[2]):
                    digest.add(role, text)
        if len(out) >= 2_000:
            yield _table(out, kind, REPORT)
            out.clear()
    if head is not None:
        close()
        yield _table(out, kind, REPORT)


REPAIRED = "position long, edit string, role string, text string"


def _repaired(batches):
    out, kind, replay, conv, size = [], None, None, None, 0
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for o, role, text, copies, c, audit in zip(*(batch.column(n).to_pylist() for n in ("o", "role", "text", "copies", "conv_id", "audit"))):
            if o == 0:
                out += [(conv, *x) for x in (replay.inserted() if replay else ())]
                conv, replay = c, Replay(audit)
                continue
            for _ in range(copies):
                out += [(conv, *x) for x in replay.row(role, text)]
                size += len(text)
            if size > 8 << 20 or len(out) > 10_000:
                yield _table(out, kind, REPAIRED)
                out.clear()
                size = 0
    if replay is not None:
        out += [(conv, *x) for x in replay.inserted()]
        yield _table(out, kind, REPAIRED)


def named_rows(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Undamaged rows for the operator: nulls as one space, one copy each."""
    return turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
                        F.lit(1).alias("copies"))


def repair(rows: DataFrame, limit: int = SEGMENT) -> DataFrame:
    """(conv_id, position, edit, role, text): the repaired conversations of ``named_rows`` or ``damage``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _stream(rows, audits(rows, limit)).mapInArrow(_repaired, f"conv_id {kind}, {REPAIRED}")


def report(rows: DataFrame, limit: int = SEGMENT) -> DataFrame:
    """Faults, cost, audit and the digest of the repaired text, one row per conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _stream(rows, audits(rows, limit)).mapInArrow(_report, f"conv_id {kind}, {REPORT}")


def op11_structure_repair(spark, sf_dir: str) -> DataFrame:
    """Contract query: all conversations after the contract's damage."""
    return report(damage(read_table(spark, sf_dir, "conversations")))


def _sql() -> str:
    def add(entry, cost, letter):
        return f"{{'c': struct_extract({entry}, 'c') + {cost}, 'a': struct_extract({entry}, 'a') || '{letter}'}}"

    def least(*entries):
        return f"list_min([{', '.join(entries)}])"
    none = "{'c': 1000000000, 'a': ''}"
    late = f"CASE WHEN fault = 'truncated' THEN {TRUNCATED_COST} ELSE 0 END"

    def use(entry, initial):
        keep, rerole = add(entry, late, KEEP), add(entry, f"{COST[REROLE]} + {late}", REROLE)
        return f"CASE WHEN must THEN {none} WHEN initial = '{initial}' THEN {keep} ELSE {rerole} END"
    ins, dele = COST[INSERT], COST[DELETE]
    return f"""
WITH RECURSIVE k AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
f AS (
  SELECT *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::UBIGINT), lambda c, b:
      list_reduce(list_transform(range(8), lambda z: z::UBIGINT), lambda y, z:
        xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END), xor(c, b)),
    4294967295::UBIGINT), 4294967295::UBIGINT) % 20 AS fate FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
         unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy FROM f WHERE fate != 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d),
r AS (
  SELECT *, left(role, 1) AS initial, CASE
    WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' END AS fault,
    coalesce(fault IN ('blank', 'duplicate'), false) AS must,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n,
         list({{'role': role, 'text': text}} ORDER BY i) AS said FROM r GROUP BY conv_id),
p AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': ''}} AS v0, {none} AS v1, {none} AS v2, {none} AS v3 FROM g
  UNION ALL
  SELECT conv_id, i, n0, n1, n2, n3 FROM (
    SELECT p.conv_id, r.i, {least("p.v2", add("p.v0", ins, INSERT), add("p.v1", ins, INSERT), add("p.v3", ins, INSERT))} AS w2,
           {least("p.v3", add("w2", ins, INSERT))} AS w3,
           {add("p.v0", dele, DELETE)} AS n0,
           {least(add("p.v1", dele, DELETE), f"CASE WHEN NOT must AND initial = 's' THEN {add('p.v0', late, KEEP)} ELSE {none} END")} AS n1,
           {least(add("w2", dele, DELETE), use("p.v0", "u"), use("p.v1", "u"), use("w3", "u"))} AS n2,
           {least(add("w3", dele, DELETE), use("w2", "a"))} AS n3
    FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1)),
b AS (
  SELECT g.*, {least("v0", "v3", add("v2", ins, INSERT), add("v1", 2 * ins, INSERT * 2))} AS best
  FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.n = p.i),
e AS (
  SELECT conv_id, best.a AS audit, said, 1::BIGINT AS pos, 0::BIGINT AS i, 0 AS q, []::VARCHAR[] AS done FROM b
  UNION ALL
  SELECT conv_id, audit, said, pos + 1, CASE WHEN audit[pos] = '{INSERT}' THEN i ELSE i + 1 END,
         CASE WHEN audit[pos] = '{DELETE}' THEN q WHEN audit[pos] = '{KEEP}' AND left(said[i + 1].role, 1) = 's' THEN 1
              WHEN q = 2 THEN 3 ELSE 2 END,
         CASE audit[pos] WHEN '{DELETE}' THEN done WHEN '{KEEP}' THEN list_append(done, said[i + 1].role || ':' || said[i + 1].text)
              ELSE list_append(done, CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END ||
                               CASE WHEN audit[pos] = '{REROLE}' THEN said[i + 1].text ELSE '' END) END
  FROM e WHERE pos <= length(audit)),
z AS (SELECT conv_id, array_to_string(done, chr(10)) AS t FROM e WHERE pos > length(audit))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(z.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
"""


OP11_SQL = _sql()
