"""Conversation structure repair by Knuth's lightest derivation.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles.  Repairs are deduced:

* axioms: ``Prefix[0, begin]`` at weight (0, ""), and ``Row[i]`` for every row, at no weight;
* ``Prefix[i, q] , Row[i] -> Prefix[i+1, q']`` keeps the row (0), gives it the role that is due
  (1) or deletes it (2; the only way for a blank or a duplicate); a truncated row that stays adds 5;
* ``Prefix[i, q] -> Prefix[i, q']`` inserts the role that is due (5);
* ``Prefix[n, begin or after an assistant] -> Goal``.

An item's weight is (cost, audit), the audit being the edits' initials so far.  Every rule adds
to the cost and to the audit's end, so no conclusion weighs less than its premises: popped
from an agenda by weight, an item is final, and the first Goal is the lightest repair.

A long conversation runs through the agenda in segments.  At a segment's end the weights of the
four states become the next one's axioms, with a short name in the place of each audit that keeps their
order; so the work is linear in the number of rows, whatever their number.

Spark brings each conversation's rows together twice: once without their texts, for the repairs, and
once with them, for the repaired conversation's digest.  Both passes read the sorted rows as a
stream and hold one letter a row (the audit's own size), never a conversation's texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineark.llm.common import Cache

BLANKS = "\x20\x09\x0A\x0B\x0C\x0D"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FINE, CUT, DOUBLE, BLANK = range(4)       # a row's fault; with its initial's number: the row's code
INITIALS = "sua-"
SEGMENT = 512
BEGIN, SYSTEM, USER, ASSISTANT, GOAL = range(5)     # what came last
_DUE = {BEGIN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAME = {USER: "user", ASSISTANT: "assistant"}
#: state, row code -> (cost, letter, next state) of the rules that take the row
_RULES = {}
for _q in _DUE:
    for _fault in range(4):
        for _initial in range(4):
            _rules = [(DELETE, "D", _q)]
            if _fault in (FINE, CUT):
                more = TRUNCATED if _fault == CUT else 0
                if _initial == 0 and _q == BEGIN:
                    _rules.append((KEEP + more, "K", SYSTEM))
                if _initial + 1 == _DUE[_q]:
                    _rules.append((KEEP + more, "K", _DUE[_q]))
                else:
                    _rules.append((REROLE + more, "R", _DUE[_q]))
            _RULES[_q, 4 * _fault + _initial] = tuple(_rules)


def _agenda(codes: bytes, axioms: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str]]:
    """Weights of the items after all of ``codes``: of the goal for the last segment, else of every state."""
    n, done, found = len(codes), set(), {}
    heap = [(cost, audit, 0, q) for q, (cost, audit) in sorted(axioms.items())]
    heap.sort()
    while heap:
        cost, audit, i, q = heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if q == GOAL:
            return {GOAL: (cost, audit)}
        if i == n:
            found[q] = cost, audit
            if last and q in (BEGIN, ASSISTANT):
                heappush(heap, (cost, audit, n, GOAL))
            elif not last and len(found) == 4:
                break
        else:
            for more, letter, to in _RULES[q, codes[i]]:
                if (i + 1, to) not in done:
                    heappush(heap, (cost + more, audit + letter, i + 1, to))
        if (i, _DUE[q]) not in done:
            heappush(heap, (cost + INSERT, audit + "I", i, _DUE[q]))
    return found


def lightest(codes: bytes, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, audit) of the lightest repair of a conversation given by its row codes.

    Two audits of as many rows first differ at a letter, or one is the other with inserts at its end;
    so an audit's name is the rank of its part before the last inserts, and these inserts.
    """
    axioms, stems = {BEGIN: (0, "")}, []
    for at in range(0, max(len(codes), 1), segment):
        last = at + segment >= len(codes)
        found = _agenda(codes[at:at + segment], axioms, last)
        if last:
            cost, audit = found[GOAL]
        else:
            stems.append(sorted({audit.rstrip("I") for _, audit in found.values()}))
            axioms = {q: (c, chr(stems[-1].index(a.rstrip("I"))) + "I" * (len(a) - len(a.rstrip("I")))) for q, (c, a) in found.items()}
    parts = []
    for names in reversed(stems):       # a name leads to the segment before
        parts.append(audit[1:])
        audit = names[ord(audit[0])]
    return cost, audit + "".join(reversed(parts))


def _turns(batches: Iterator) -> Iterator:
    """Of rows (id, turn, code) sorted by conversation and turn: one row of figures and audit for each conversation."""
    import pyarrow as pa
    repair = Cache(lightest, 50_000)
    names = ["id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    legal = {(0, 1), (1, 2), (2, 1)}
    now, codes, low, high, distinct, out, kind = None, None, None, None, 0, [], None

    def close():
        faults = [0] * 4
        for c in codes:
            faults[c >> 2] += 1
        illegal = sum((a & 3, b & 3) not in legal for a, b in zip(codes, codes[1:]))
        key = bytes(codes)
        cost, audit = repair[key] if len(key) <= SEGMENT else lightest(key)
        out.append((now, high - low + 1 - distinct if distinct else 0, faults[BLANK], faults[DOUBLE], faults[CUT], illegal, cost, audit))

    def batch_of():
        cols = list(zip(*out)) or [[]] * len(names)
        types = [kind] + [pa.int64()] * 6 + [pa.string()]
        made = pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names)
        out.clear()
        return made

    for batch in batches:
        kind = batch.schema.field("id").type
        for ident, turn, code in zip(*(batch.column(c).to_pylist() for c in ("id", "turn", "code"))):
            if codes is None or ident != now:
                if codes is not None:
                    close()
                now, codes, low, high, distinct = ident, bytearray(), None, None, 0
            if code is None:                # a row that is gone
                continue
            codes.append(code)
            if turn is not None and turn != high:
                low, high, distinct = turn if low is None else low, turn, distinct + 1
        if out:
            yield batch_of()
    if codes is not None:
        close()
        yield batch_of()


def _digests(batches: Iterator) -> Iterator:
    """Of rows sorted by conversation, the figures' row first and then the rows with their texts: the
    figures' row with the digest of the repaired conversation."""
    import pyarrow as pa
    names = ["id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    head, out, kinds = None, [], None

    class Repaired:
        def __init__(self, audit: str):
            self.audit, self.at, self.state, self.sha, self.any = audit, 0, BEGIN, hashlib.sha256(), False

        def write(self, role: str, text: str) -> None:
            self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            self.any = True

        def inserts(self) -> None:
            while self.at < len(self.audit) and self.audit[self.at] == "I":
                self.at, self.state = self.at + 1, _DUE[self.state]
                self.write(_NAME[self.state], "")

        def row(self, role: str, text: str) -> None:
            self.inserts()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "D":
                return
            self.state = SYSTEM if letter == "K" and role[:1] == "s" else _DUE[self.state]
            self.write(_NAME[self.state] if letter == "R" else role, text)

    def close():
        repaired.inserts()
        out.append((*head, repaired.sha.hexdigest()))

    def batch_of():
        made = pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), kinds)], [*names, "sha"])
        out.clear()
        return made

    for batch in batches:
        kinds = [batch.schema.field(c).type for c in names] + [pa.string()]
        for *figures, first, role, text in zip(*(batch.column(c).to_pylist() for c in (*names, "head", "role", "text"))):
            if first:
                if head is not None:
                    close()
                head, repaired = figures, Repaired(figures[-1])
            else:
                repaired.row(role, text)
        if out:
            yield batch_of()
    if head is not None:
        close()
        yield batch_of()


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           gone_col: str | None = None) -> DataFrame:
    """One row per conversation: its id, ``gaps, blank, duplicate, truncated, illegal, cost`` (LONG), ``audit`` and
    ``repaired_sha256``.

    Rows are taken by turn, nulls first; rows of one turn by role, then by the MD5 of their text (equal rows
    stand together).  A row's first fault counts: blank (nothing but white space), duplicate (role
    and text seen earlier in the conversation; texts are told apart by MD5), truncated (its last
    character that is not white space is none of ``.!?``).  ``gaps`` is the number of turns missing between
    the first and the last; ``illegal`` counts neighbours whose role initials are not su, ua or au.
    ``cost`` and ``audit`` are those of the lightest repair, the ASCII-least of the cheapest; a role
    counts by its first character, so other roles are given a role or deleted.  ``repaired_sha256`` is the
    SHA-256 of the repaired rows as ``role:text``, joined by line ends.

    A null role or text is one space; a null conversation id is a conversation.  Rows for which
    ``gone_col`` is true take no part, but their conversation has a row; without any other row: zeros,
    empty audit, digest of the empty string.  An empty table gives no rows; other columns are ignored.
    """
    gone = F.coalesce(F.col(gone_col), F.lit(False)) if gone_col else F.lit(False)
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), filled(role_col).alias("role"),
                        filled(text_col).alias("text"), gone.alias("gone"))
    rows = rows.withColumn("sign", F.unhex(F.md5(F.col("text").cast("binary"))))
    in_turn = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sign")]

    end = F.rtrim("text", F.lit(BLANKS))
    initial = F.instr(F.lit(INITIALS[:3]), F.left("role", F.lit(1)))        # from 1; 0 for others and for no role
    initial = F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3)
    slim = rows.select("id", "turn", "role", "sign", "gone", initial.alias("initial"), (end == "").alias("blank"),
                       F.right(end, F.lit(1)).isin(*".!?").alias("ended")).repartition("id")
    # the rows of a conversation are together already: neither window nor sort shuffles again
    nth = F.row_number().over(Window.partitionBy("id", "gone", "role", "sign").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(F.col("blank"), BLANK).when(F.col("nth") > 1, DOUBLE).when(~F.col("ended"), CUT).otherwise(FINE)
    code = F.when(~F.col("gone"), fault * 4 + F.col("initial")).alias("code")
    coded = slim.withColumn("nth", nth).sortWithinPartitions(F.col("id").asc_nulls_first(), *in_turn, "nth").select("id", "turn", code)
    kind = dict(rows.dtypes)["id"]
    figures = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    found = coded.mapInArrow(_turns, f"id {kind}, {figures}")

    none = lambda t: F.lit(None).cast(t)
    heads = found.select("*", F.lit(True).alias("head"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("binary").alias("sign"))
    texts = rows.where(~F.col("gone")).select("id", *(none(c.split()[1]).alias(c.split()[0]) for c in figures.split(", ")),
                                              F.lit(False).alias("head"), "turn", "role", "text", "sign")
    both = heads.unionByName(texts).repartition("id").sortWithinPartitions(F.col("id").asc_nulls_first(), F.desc("head"), *in_turn).drop("turn", "sign")
    done = both.mapInArrow(_digests, f"id {kind}, {figures}, sha string")
    return done.select(F.col("id").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))
