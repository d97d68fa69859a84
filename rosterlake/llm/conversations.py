"""Repair of conversation structure by aligning turns to the strings of an alternating grammar.

A conversation's repair hangs on one letter a turn: who speaks and what is wrong. Letters are put
together in order from sorted ranges of turns, so that a conversation with most of the rows is many
tasks' work, and equal strings of letters are aligned once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prices of edits; a truncated turn that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
_BLANKS = " \t\n\x0b\x0c\r"
#: Turns up to which targets are aligned one by one; in longer conversations they share columns.
TABLE_TURNS = 256
_FAR = 1 << 40
#: Letters: four for each speaker (system, user, assistant, other): sound, blank, duplicate, truncated.
_SPEAKERS, _FAULTS = "sua-", ("", "blank", "duplicate", "truncated")


def letter(speaker: str, fault: str) -> str:
    return chr(ord("A") + 4 * _SPEAKERS.index(speaker) + _FAULTS.index(fault))


def parted(letters: str) -> tuple[str, list[int]]:
    """(speakers, faults) of a string of letters."""
    numbers = [ord(c) - ord("A") for c in letters]
    return "".join(_SPEAKERS[n // 4] for n in numbers), [n % 4 for n in numbers]


def target(length: int, system: bool) -> str:
    """The string of that length in `(s?(ua)+)?`; an odd one begins with s."""
    return ("s" if system else "") + "ua" * ((length - system) // 2)


def _costs(speakers: str, faults: list[int], goal: str, most: int) -> list[tuple[int, list[int]]] | None:
    """For each turn i, (lowest j, costs of aligning turns i.. with goal[j..]), within the band.

    `most` is the incumbent's cost. Beyond what no alignment avoids (a mandatory deletion, the least
    a truncated turn takes), an insertion costs INSERT and a deletion of a sound turn DELETE, so that
    the diagonals that cheaper alignments can reach are bounded (Ukkonen). None: none is as cheap.
    """
    n, m = len(speakers), len(goal)
    base = sum(DELETE for f in faults if f)
    slack = most - base
    if slack < 0:
        return None
    # after turn i, j lies between i - (mandatory + truncated + slack / DELETE) and i - mandatory + slack / INSERT
    low, high, forced, free = [0], [min(m, slack // INSERT)], 0, 0
    for i, f in enumerate(faults, 1):
        forced += f in (1, 2)
        free += f == 3
        low.append(max(0, i - forced - free - slack // DELETE))
        high.append(min(m, i - forced + slack // INSERT))
    # the same from the end
    forced = free = 0
    low[n], high[n] = max(low[n], m - slack // INSERT), m
    for i in range(n - 1, -1, -1):
        forced += faults[i] in (1, 2)
        free += faults[i] == 3
        left = n - i - forced
        low[i] = max(low[i], m - left - slack // INSERT)
        high[i] = min(high[i], m - left + free + slack // DELETE)
    rows: list[tuple[int, list[int]]] = [(0, [])] * (n + 1)
    if any(a > b for a, b in zip(low, high, strict=True)):
        return None
    rows[n] = (low[n], [INSERT * (m - j) for j in range(low[n], m + 1)])
    for i in range(n - 1, -1, -1):
        below_low, below = rows[i + 1]
        speaker, fault, a, b = speakers[i], faults[i], low[i], high[i]
        extra, own, after = TRUNCATED if fault == 3 else 0, [0] * (b - a + 1), _FAR
        for j in range(b, a - 1, -1):
            at = j - below_low
            best = below[at] + DELETE if 0 <= at < len(below) else _FAR
            if after + INSERT < best and goal[j : j + 1] != "s":
                best = after + INSERT
            if fault in (0, 3) and j < m and 0 <= at + 1 < len(below):
                step = 0 if speaker == goal[j] else REROLE if goal[j] != "s" else _FAR
                best = min(best, below[at + 1] + step + extra)
            own[j - a] = after = best
        rows[i] = (a, own)
    return rows


def _audit(speakers: str, faults: list[int], goal: str, rows: list[tuple[int, list[int]]]) -> str:
    """The ASCII-least edits among the cheapest: D before I before K before R."""
    n, m, i, j, edits = len(speakers), len(goal), 0, 0, []

    def cost(i: int, j: int) -> int:
        low, own = rows[i]
        return own[j - low] if 0 <= j - low < len(own) else _FAR

    while i < n or j < m:
        left = cost(i, j)
        if i < n and cost(i + 1, j) + DELETE == left:
            edits.append("D")
            i += 1
        elif j < m and goal[j] != "s" and cost(i, j + 1) + INSERT == left:
            edits.append("I")
            j += 1
        else:
            edits.append("K" if speakers[i] == goal[j] else "R")
            i, j = i + 1, j + 1
    return "".join(edits)


def aligned(letters: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, by aligning the turns to each feasible target."""
    speakers, faults = parted(letters)
    n = len(letters)
    kept = sum(f in (0, 3) for f in faults)
    base = sum(DELETE for f in faults if f)
    best = (DELETE * n, "D" * n)  # the empty conversation
    sound = sum(f == 0 for f in faults)

    def least(length: int) -> int:
        """No alignment with a target of that length costs less."""
        return base + INSERT * max(0, length - kept) + DELETE * max(0, sound - length)

    longest = kept + (best[0] - base) // INSERT + 1
    # the most likely lengths first: the incumbent they leave narrows the bands of the others
    lengths = sorted(range(2, longest + 1), key=lambda k: (least(k), abs(k - sound)))
    for length in lengths:
        if least(length) > best[0]:
            break
        system = length % 2 == 1
        if system and (length < 3 or "s" not in speakers):
            continue
        goal = target(length, system)
        rows = _costs(speakers, faults, goal, best[0])
        if rows is None:
            continue
        cost = rows[0][1][-rows[0][0]] if -rows[0][0] < len(rows[0][1]) and rows[0][0] <= 0 else _FAR
        if cost <= best[0]:
            best = min(best, (cost, _audit(speakers, faults, goal, rows)))
    return best


#: What is written so far: nothing, s, an odd and an even number of u and a.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {
    _NOTHING: {"s": _SYSTEM, "u": _USER},
    _SYSTEM: {"u": _USER},
    _USER: {"a": _ASSISTANT},
    _ASSISTANT: {"u": _USER},
}
_ENDS = (_NOTHING, _ASSISTANT)


def _before(speaker: str, fault: int, below: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end from each state before a turn, from those after it."""
    own = []
    for state in range(4):
        best = below[state] + DELETE
        if fault in (0, 3):
            for c, to in _NEXT[state].items():
                step = 0 if c == speaker else REROLE if c != "s" else _FAR
                best = min(best, below[to] + step + (TRUNCATED if fault == 3 else 0))
        own.append(best)
    return _inserted(own)


def _inserted(own: list[int]) -> tuple[int, ...]:
    """The costs when u and a may be inserted first."""
    for _ in range(3):
        for state in range(4):
            own[state] = min([own[state], *(INSERT + own[to] for c, to in _NEXT[state].items() if c != "s")])
    return tuple(own)


def aligned_long(letters: str, block: int = 4096) -> tuple[int, str]:
    """What `aligned` returns, in time and space that grow with the turns alone.

    Targets of all lengths share their suffixes, so one column for each state of the grammar stands
    for all of them. Columns are kept at every `block`-th turn and made anew in between.
    """
    speakers, faults = parted(letters)
    n, ends = len(letters), _inserted([0 if state in _ENDS else _FAR for state in range(4)])
    marks, column = {n: ends}, ends
    for i in range(n - 1, -1, -1):
        column = _before(speakers[i], faults[i], column)
        if i % block == 0:
            marks[i] = column
    cost, edits, state = column[_NOTHING], [], _NOTHING
    for start in range(0, n + 1, block):
        stop = min(n, start + block)
        columns = {stop: marks[stop]}
        for i in range(stop - 1, start - 1, -1):
            columns[i] = _before(speakers[i], faults[i], columns[i + 1])
        i = start
        while i < stop or stop == n:
            if i == n and columns[i][state] == 0 and state in _ENDS:
                break
            left, steps = columns[i][state], _NEXT[state].items()
            insert = next((to for c, to in steps if c != "s" and columns[i][to] + INSERT == left), None)
            if i < n and columns[i + 1][state] + DELETE == left:
                edits.append("D")
                i += 1
            elif insert is not None:
                edits.append("I")
                state = insert
            else:
                extra = TRUNCATED if faults[i] == 3 else 0
                price = {to: (0 if c == speakers[i] else REROLE if c != "s" else _FAR, c) for c, to in steps}
                to = min(t for t, (p, _) in price.items() if columns[i + 1][t] + p + extra == left)
                edits.append("K" if price[to][0] == 0 else "R")
                i, state = i + 1, to
        if stop == n:
            break
    return cost, "".join(edits)


@lru_cache(maxsize=1 << 16)
def repair(letters: str) -> tuple[int, str]:
    """(cost, audit) of a conversation."""
    return aligned(letters) if len(letters) <= TABLE_TURNS else aligned_long(letters)


def _order(rows: DataFrame) -> list[Column]:
    """Turns in order, nulls first; equal turns by their role and text."""
    return [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "h1", "h2")]


def _turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    own = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col)]
    named = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), own[0].alias("role"), own[1].alias("text"))
    return named.select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))


def _letters(turns: DataFrame) -> DataFrame:
    """(conv, letters): each conversation's letters in order."""
    known = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    key = ["conv", "role", "h1", "h2"]
    firsts = turns.groupBy(*key).agg(F.min(known).alias("first"))
    trimmed = F.rtrim(F.col("text"), F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    speaker = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    sound = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    narrow = turns.select(*key, "turn", speaker.alias("speaker"), (trimmed == "").alias("blank"), (~sound).alias("truncated"))
    a, b = narrow.alias("a"), firsts.alias("b")
    same = F.lit(True)
    for c in key:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    late = F.struct(F.col("a.turn").isNotNull(), F.col("a.turn")) > F.struct(F.col("b.first.known"), F.col("b.first.turn"))
    marked = a.join(b, same).select("a.*", late.alias("late"))
    ranged = marked.repartitionByRange(*_order(marked)).sortWithinPartitions(*_order(marked))
    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, first, before, own = None, None, None, None
        for batch in batches:
            names, done = batch.schema.names, []
            at = {c: names.index(c) for c in ("conv", "turn", "role", "h1", "h2", "speaker", "blank", "truncated", "late")}
            for row in zip(*(batch.column(i).to_pylist() for i in at.values()), strict=True):
                if own is None or row[0] != conv:
                    if own is not None:
                        done.append((conv, *first, "".join(own)))
                    conv, first, before, own = row[0], row[1:5], None, []
                same_row = before == row[1:5]
                before = row[1:5]
                _, _, _, _, _, speaker, blank, truncated, late = row
                own.append(chr(65 + 4 * speaker + (1 if blank else 2 if late or same_row else 3 if truncated else 0)))
            yield _batch(done, batch)
        if own is not None:
            yield _batch([(conv, *first, "".join(own))], batch)

    def _batch(done: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
        fields = [like.schema.field(c) for c in ("conv", "turn", "role", "h1", "h2")]
        schema = pa.schema([*fields, pa.field("letters", pa.string())])
        return pa.RecordBatch.from_pydict({f.name: [r[i] for r in done] for i, f in enumerate(schema)}, schema=schema)

    ddl = f"conv {kinds['conv']}, turn {kinds['turn']}, role string, h1 long, h2 long, letters string"
    parts = ranged.mapInArrow(run, ddl)
    part = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "h1", "h2", "letters")
    together = F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["letters"]), "")
    return parts.groupBy("conv").agg(together.alias("letters"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _judged(letters: DataFrame) -> DataFrame:
    """(conv, counts of faults and illegal neighbours, cost, audit) of each conversation."""
    kind = letters.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {c: [] for c in (*_COUNTS, "audit")}
            for own in batch["letters"].to_pylist():
                speakers, faults = parted(own)
                legal = sum(a + b in ("su", "ua", "au") for a, b in zip(speakers, speakers[1:], strict=False))
                cost, audit = repair(own)
                values = (*(faults.count(k) for k in (1, 2, 3)), max(0, len(own) - 1) - legal, cost, audit)
                for c, value in zip(found, values, strict=True):
                    found[c].append(value)
            columns = [pa.array(v, pa.string() if c == "audit" else pa.int64()) for c, v in found.items()]
            yield pa.RecordBatch.from_arrays([batch["conv"], *columns], names=["conv", *found])

    return letters.mapInArrow(run, f"conv {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string")


class Replay:
    """A conversation's edits, applied to its turns one after another."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.last = audit, 0, ""

    def _role(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def inserted(self) -> Iterator[tuple[str, str]]:
        """The turns that are inserted next."""
        while self.audit[self.at : self.at + 1] == "I":
            role = self._role()
            self.at, self.last = self.at + 1, role[0]
            yield role, ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """What the next turn becomes, after what is inserted before it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            role = self._role() if edit == "R" else role
            self.last = role[:1]
            yield role, text


def _in_order(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, then its turns in order, in one task that reads them as a stream."""
    rows = turns.select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "h1", "h2", F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv", F.lit(0).alias("kind"), "audit")
    both = rows.unionByName(heads, allowMissingColumns=True).repartition("conv")
    first, *rest = _order(both)
    return both.sortWithinPartitions(first, "kind", *rest).select("conv", "audit", "role", "text")


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """(batch, [(conv, begins, repaired turns)]) of rows that `_in_order` has put in order."""
    replay, conv = None, None
    for batch in batches:
        done = []
        for c, audit, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if audit is not None:
                if replay is not None:
                    done.append((conv, False, [*replay.inserted()]))
                conv, replay = c, Replay(audit)
                done.append((conv, True, []))
            else:
                done.append((conv, False, [*replay.turn(role, text)]))
        yield batch, done
    if replay is not None:
        yield batch, [(conv, False, [*replay.inserted()])]


def audited(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation.

    A conversation is what shares `conv_col`, null included, ordered by turn with nulls first; rows
    of one turn stand by role and text. A null role or text is one space. A turn is blank (no
    character but white space), or else a duplicate (its role and text came before), or else truncated
    (its last character, white space aside, is none of .!?). `gaps` counts the turn numbers that are
    missing between the least and the greatest, `illegal` the neighbours whose roles do not begin
    with su, ua or au. `audit` has the cheapest edits that make the initials `(s?(ua)+)?`: K keeps a
    turn, R gives it the other role of user and assistant (1), D deletes it (2, required if blank or
    duplicate), I inserts an empty one (5); a truncated turn that stays costs 5. Of equally cheap
    ones it is the ASCII-least. A role without initial is never kept. Repeated rows are duplicates;
    an empty table gives no rows; other columns are not looked at.
    """
    turns = _turns(rows, conv_col, turn_col, role_col, text_col)
    numbered = turns.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    judged = _judged(_letters(turns))
    both = judged.unionByName(numbered, allowMissingColumns=True).groupBy("conv")
    found = both.agg(*[F.max(c).alias(c) for c in ("gaps", *_COUNTS, "audit")])
    return found.withColumnRenamed("conv", conv_col)


def repaired_turns(
    rows: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_col, position, role, text): the turns after the edits that `audits` names."""
    turns = _turns(rows, conv_col, turn_col, role_col, text_col)
    ordered = _in_order(turns, audits.select(F.col(conv_col).alias("conv"), "audit"))
    kind = ordered.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position = 0
        for batch, done in _replayed(batches):
            out = []
            for conv, begins, own in done:
                position = 0 if begins else position
                for role, text in own:
                    out.append((conv, position, role, text))
                    position += 1
            kinds = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string()]
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "position", "role", "text"])

    return ordered.mapInArrow(run, f"conv {kind}, position long, role string, text string").withColumnRenamed("conv", conv_col)


def repaired_digests(
    rows: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_col, repaired_sha256): digests of the repaired `role:text`, one turn a line.

    A digest is sequential, so one task reads a conversation, as a stream; it holds its audit only.
    """
    turns = _turns(rows, conv_col, turn_col, role_col, text_col)
    ordered = _in_order(turns, audits.select(F.col(conv_col).alias("conv"), "audit"))
    kind = ordered.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, empty, current = None, True, None

        def made(out: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in out], batch.schema.field("conv").type), pa.array([r[1] for r in out], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["conv", "repaired_sha256"])

        for batch, done in _replayed(batches):
            out = []
            for conv, begins, own in done:
                if begins:
                    if digest is not None:
                        out.append((current, digest.hexdigest()))
                    digest, empty, current = hashlib.sha256(), True, conv
                for role, text in own:
                    digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
            yield made(out)
        if digest is not None:
            yield made([(current, digest.hexdigest())])

    return ordered.mapInArrow(run, f"conv {kind}, repaired_sha256 string").withColumnRenamed("conv", conv_col)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the test damage that their ids decide; nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    made = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return made.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")
