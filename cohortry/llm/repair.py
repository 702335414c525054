"""Repair of conversations whose rows are missing, blank, repeated, cut off or out of turn.

A conversation is read as a signature, one letter a row: who speaks and what is wrong with the row.  The
cheapest edits from a row to the end depend on the rest of the signature and on the state of the grammar
``(s?(ua)+)?`` alone.  So signatures are minimised from the end: a node of the automaton is a suffix, shared
by all conversations that end alike, and holds for each state of the grammar the cost to go and the first
edit of the best audit; the edits after it are those of the next node.  Signatures are range-partitioned and
sorted from their ends, so that a task meets each of its suffixes once and keeps one path of nodes.

Texts are not gathered: rows stream in order past the audit of their conversation.  One digest of a whole
conversation is sequential by nature, so its rows do pass one task, one batch at a time.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators import materialise

#: States of the grammar: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or re-assigned row: the only role that may follow.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state after a kept row, by the first letter of its role.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
NO_WAY = 1 << 60
ORDER = ["conv_id", "turn", "role", "text"]  # NULLs first
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the faults of the contract, by crc32 of ``conv_id:turn`` modulo 20:
    0 drops a row, 1 empties its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes its role ``user``.

    NULL role and text become one space; NULL ids and turns count as one space in the key and stay NULL.
    """
    def said(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"),
                                kind.alias("kind")).where("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_")
    ).drop("_")


def marked(rows: DataFrame) -> DataFrame:
    """Different rows of each conversation with ``copies``, the ``letter`` of the first of them (role initial,
    upper case if cut off; ``b`` blank, ``d`` duplicate) and the role's ``initial``.

    Equal rows become one before they are shuffled.  The first turn of a text is an aggregate joined back, so
    that Spark can split a conversation that repeats one text.
    """
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    some = rows.groupBy(*ORDER).agg(F.count("*").alias("copies"))
    first = some.groupBy("conv_id", "role", "text").agg(F.min(turn).alias("first")).select(
        F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("text").alias("_t"), "first")
    both = some.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r"))
                     & (F.col("text") == F.col("_t")))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return both.select(*ORDER, "copies", initial.alias("initial"), F.when(
        ~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "b").when(turn > F.col("first"), "d").when(
        F.col("text").rlike(r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"), F.upper(known)).otherwise(known).alias("letter"))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    keys = ["conv_id", *first, *ORDER[1:]]
    return rows.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in keys])


_SIGNED = pa.schema([("conv_id", pa.int64()), ("ends", pa.string()), *[(c, pa.int64()) for c in COUNTS]])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and signature of each conversation, from its end; rows come in order."""
    out: list[tuple] = []
    here, letters, n, turns, last = (), bytearray(), dict.fromkeys(COUNTS, 0), [], None

    def close():
        span = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        out.append((here[0], letters[::-1].decode(), min(span, (1 << 63) - 1), *[n[c] for c in COUNTS[1:]]))

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _SIGNED.types)], schema=_SIGNED)
        out.clear()
        return batch
    for batch in batches:
        for conv, turn, initial, copies, letter in zip(*(
                batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "copies", "letter"))):
            if here != (conv,):
                if here:
                    close()
                    if len(out) >= 10_000 or sum(len(x[1]) for x in out[-100:]) > 1 << 22:
                        yield flush()
                here, letters, n, turns, last = (conv,), bytearray(), dict.fromkeys(COUNTS, 0), [], None
            if turn is not None:
                if not turns:
                    turns = [turn, turn, 1]
                elif turn != turns[1]:
                    turns[1:] = turn, turns[2] + 1
            again = copies - 1
            n["illegal"] += again + (last is not None and last + initial not in ("su", "ua", "au"))
            last = initial
            if letter == "b":
                n["blank"] += copies
                letters += b"d" * copies
            else:
                n["duplicate"] += again + (letter == "d")
                n["truncated"] += letter.isupper()
                letters += letter.encode() + b"d" * again
    if here:
        close()
    if out:
        yield flush()


class Automaton:
    """Nodes of one suffix path, from the end: node ``d`` is the suffix of ``d`` letters.

    ``cost`` and ``edit`` have four entries a node, one a state.  From one state, edits of different letters
    lead on, so the least of the cheapest first edits begins the least of the cheapest audits.
    """

    def __init__(self):
        self.letters = ""  # from the end
        self.cost = array("q")
        self.edit = bytearray()
        self._add([0, NO_WAY, NO_WAY, 0], ["", "", "", ""])

    def _add(self, cost: list[int], edit: list[str]) -> None:
        """A node from the costs without insertions, to which these are added."""
        then = list(cost)
        for _ in range(2):  # a row of each role at most
            then = [min(cost[q], INSERT + then[NEXT[q]]) for q in range(4)]
        for q in range(4):
            ways = [(cost[q], edit[q]), (INSERT + then[NEXT[q]], "I")]
            best = min(ways)
            self.cost.append(best[0])
            self.edit += (best[1] or ".").encode()

    def move(self, ends: str) -> None:
        """To the path of another suffix: the nodes it shares stay."""
        low, high = 0, min(len(ends), len(self.letters))
        while low < high:  # the longest common beginning, by halves
            mid = (low + high + 1) // 2
            if ends[low:mid] == self.letters[low:mid]:
                low = mid
            else:
                high = mid - 1
        del self.cost[4 * (low + 1):], self.edit[4 * (low + 1):]
        for letter in ends[low:]:
            self._step(letter)
        self.letters = ends

    def _step(self, letter: str) -> None:
        after = self.cost[-4:]
        cost, edit = [], []
        cut = CUT_OFF if letter.isupper() else 0
        kept = KEPT.get(letter.lower(), {})
        for q in range(4):
            ways = [(DELETE + after[q], "D")]
            if letter != "d":
                if q in kept:
                    ways.append((cut + after[kept[q]], "K"))
                ways.append((REROLE + cut + after[NEXT[q]], "R"))
            best = min(ways)
            cost.append(best[0])
            edit.append(best[1])
        self._add(cost, edit)

    def best(self) -> tuple[int, str]:
        """Cost and audit of the whole signature."""
        d, q, out = len(self.letters), START, bytearray()
        while True:
            e = self.edit[4 * d + q]
            if e == 46:  # the end
                return self.cost[4 * len(self.letters)], out.decode()
            out.append(e)
            if e == 75:
                q = KEPT[self.letters[d - 1].lower()][q]
            elif e != 68:
                q = NEXT[q]
            d -= e != 73


_PLANNED = pa.schema([*_SIGNED, ("cost", pa.int64()), ("audit", pa.string())])


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and audit of signatures that come in order of their ends."""
    automaton, best = Automaton(), None
    for batch in batches:
        costs, audits = [], []
        for ends in batch.column("ends").to_pylist():
            if best is None or ends != automaton.letters:
                automaton.move(ends)
                best = automaton.best()
            costs.append(best[0])
            audits.append(best[1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
                                         schema=_PLANNED)


def plans(rows: DataFrame) -> DataFrame:
    """``conv_id``, the counts of faults, ``cost`` and ``audit`` of each conversation of ``marked`` rows.

    A signature that a third of all conversations share is spread over tasks by conversation."""
    kinds = "conv_id long, ends string, " + ", ".join(f"{c} long" for c in COUNTS)
    signed = materialise(_in_order(rows).mapInArrow(_sign, kinds))
    return (signed.repartitionByRange("ends", F.xxhash64("conv_id")).sortWithinPartitions("ends")
            .mapInArrow(_plan, f"{kinds}, cost long, audit string").drop("ends"))


_EDITED = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                     ("text", pa.string())])
_FLUSH_BYTES = 1 << 22


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows in order, after a row of place -1 for each conversation."""
    out, held = [], 0
    conv, audit, at, q, place = None, "", 0, START, 0

    def put(edit, role, text):
        nonlocal place, held
        out.append((conv, place, edit, role, text))
        held += len(text) + 64
        place += 1

    def insert():
        nonlocal at, q
        while audit[at:at + 1] == "I":
            at, q = at + 1, NEXT[q]
            put("I", ROLES[q], "")

    def flush():
        nonlocal held
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _EDITED.types)], schema=_EDITED)
        out.clear()
        held = 0
        return batch
    for batch in batches:
        for this, plan, role, text, copies in zip(*(
                batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "copies"))):
            if plan is not None:
                insert()
                conv, audit, at, q = this, plan, 0, START
                place = -1
                put("", "", "")
                continue
            for _ in range(copies):
                insert()
                edit = audit[at]
                at += 1
                if edit == "K":
                    q = KEPT[role[:1]][q]
                    put("K", role, text)
                elif edit == "R":
                    q = NEXT[q]
                    put("R", ROLES[q], text)
            if held > _FLUSH_BYTES:
                yield flush()
    insert()
    if out:
        yield flush()


def edited(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Repaired rows ``conv_id, at, edit, role, text`` of ``marked`` rows and their ``plans``, in order within
    partitions; each conversation begins with a row ``at`` = -1 of empty strings."""
    none = F.lit(None).cast("string")
    heads = planned.select("conv_id", F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("text"),
                           F.lit(0).cast("long").alias("copies"), "audit", F.lit(0).alias("kind"))
    body = rows.select(*ORDER, "copies", none.alias("audit"), F.lit(1).alias("kind"))
    return _in_order(heads.unionByName(body), "kind").mapInArrow(
        _edit, "conv_id long, at long, edit string, role string, text string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(plans, repaired rows) of conversations ``conv_id, turn, role, text``, by the cheapest edits.

    Rows of a conversation go by turn, NULLs first, then by role and text.  Blank rows and rows whose role and
    text stand earlier are deleted (4), other rows are kept (0), given the role ``user`` or ``assistant`` (3) or
    deleted, and empty ``user`` and ``assistant`` rows inserted (3), until the roles' initials match
    ``(s?(ua)+)?``; a row cut off costs 3 more unless deleted.  Among edits of equal cost the least audit in
    ASCII wins.

    NULL role and text count as one space; NULL ``conv_id`` is a conversation of its own; NULL turns count in
    no gap.  Repeated rows are duplicates.  An empty table gives no rows; other columns are not read.
    """
    clean = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ORDER[2:]])
    with_letters = materialise(marked(clean))
    planned = materialise(plans(with_letters))
    return planned, edited(with_letters, planned)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines; rows come as ``edited`` gives them."""
    out, here, sha = [], (), None

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out])],
                                           names=["conv_id", "repaired_sha256"])
        out.clear()
        return batch
    for batch in batches:
        for conv, at, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "at", "role", "text"))):
            if at < 0:
                if here:
                    out.append((here[0], sha.hexdigest()))
                here, sha = (conv,), hashlib.sha256()
            else:
                sha.update(("\n" * (at > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        if len(out) >= 10_000:
            yield flush()
    if here:
        out.append((here[0], sha.hexdigest()))
        yield flush()


def op12(conversations: DataFrame) -> DataFrame:
    """The contract's counts, audit and digest for every ``conv_id``."""
    planned, rows = repair(damage(conversations))
    digests = rows.mapInArrow(_digest, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "_d")
    ids = conversations.select("conv_id").distinct()
    plan = planned.withColumnRenamed("conv_id", "_p")
    numbers = [*COUNTS, "cost"]
    return (ids.join(plan, F.col("conv_id").eqNullSafe(F.col("_p")), "left")
            .join(digests, F.col("conv_id").eqNullSafe(F.col("_d")), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def _crc32(text: str) -> str:
    """CRC-32 in DuckDB, bit by bit over the bytes of an ASCII text."""
    step = "lambda x, y: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], {step}, xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce({codes}, {byte}, 4294967295::BIGINT), 4294967295)"


def _way(cost: str, edit: str, rest: str, when: str = "true") -> str:
    return f"{{'c': CASE WHEN {when} THEN {cost} + {rest}.c ELSE 1000000000 END, 'a': '{edit}' || {rest}.a}}"


def _state(q: str, keep: str, kept: str, then: str) -> str:
    """Best way on from state ``q`` without insertions: delete, keep or give the next role."""
    ways = [_way("4", "D", q), _way("3 + cut", "R", then, "NOT gone")]
    if keep:
        ways.append(_way("cut", "K", kept, f"NOT gone AND ({keep})"))
    return f"list_min([{', '.join(ways)}])"


SQL = rf"""
WITH RECURSIVE ids AS (
  SELECT conv_id, row_number() OVER () AS cid FROM (SELECT DISTINCT conv_id FROM conversations)),
raw AS (
  SELECT cid, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(c.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations c JOIN ids ON c.conv_id IS NOT DISTINCT FROM ids.conv_id),
damaged AS (
  SELECT cid, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM raw WHERE kind <> 0),
placed AS (
  SELECT *, left(role, 1) AS ini, row_number() OVER (PARTITION BY cid, role, text ORDER BY i) AS nth
  FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY cid ORDER BY i) AS before
  FROM placed),
counts AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY cid),
dp AS (
  SELECT cid, n + 1 AS i, {{'c': 0, 'a': ''}} AS s0, {{'c': 6, 'a': 'II'}} AS s1, {{'c': 3, 'a': 'I'}} AS s2,
         {{'c': 0, 'a': ''}} AS s3 FROM counts
  UNION ALL
  SELECT cid, i, list_min([f0, {_way("3", "I", "g2")}]), list_min([f1, {_way("3", "I", "g2")}]), g2, g3
  FROM (
    SELECT *, list_min([f2, {_way("3", "I", "f3")}]) AS g2, list_min([f3, {_way("3", "I", "f2")}]) AS g3
    FROM (
      SELECT cid, i, {_state("s0", "ini = 's' OR ini = 'u'", "CASE WHEN ini = 's' THEN s1 ELSE s2 END", "s2")} AS f0,
             {_state("s1", "ini = 'u'", "s2", "s2")} AS f1, {_state("s2", "ini = 'a'", "s3", "s3")} AS f2,
             {_state("s3", "ini = 'u'", "s2", "s2")} AS f3
      FROM (
        SELECT f.cid, f.i, ini, fault IN ('blank', 'duplicate') AS gone,
               CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cut, s0, s1, s2, s3
        FROM dp JOIN faults f ON f.cid = dp.cid AND f.i = dp.i - 1)))),
best AS (SELECT cid, s0.c AS cost, s0.a AS audit FROM dp WHERE i = 1),
edits AS (
  SELECT cid, j, substr(audit, j, 1) AS e, j - length(replace(substr(audit, 1, j), 'I', '')) AS inserted,
         length(replace(substr(audit, 1, j), 'D', '')) AS nth_out
  FROM best, unnest(range(1, length(audit) + 1)) AS t(j)),
outs AS (
  SELECT e.*, f.role, f.text,
         max(CASE WHEN nth_out = 1 AND e = 'K' AND f.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.cid) AS sys
  FROM edits e LEFT JOIN faults f ON f.cid = e.cid AND f.i = e.j - e.inserted AND e.e <> 'I'),
done AS (
  SELECT cid, string_agg(CASE WHEN e = 'K' THEN role WHEN (nth_out - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
                         || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS said
  FROM outs WHERE e <> 'D' GROUP BY cid)
SELECT conv_id, {', '.join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in [*COUNTS, "cost"])},
       coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM ids LEFT JOIN counts USING (cid) LEFT JOIN best USING (cid) LEFT JOIN done USING (cid)"""
