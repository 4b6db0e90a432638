"""Cheapest repair of a conversation's structure, by integer dynamic programming.

Legal role initials are ``(s?(ua)+)?``.  Every turn is kept (K), given the role
user or assistant (R, 3), or deleted (D, 4; the only choice for blank and
duplicate turns); user or assistant turns without text may be inserted (I, 3);
a truncated turn that is not deleted costs 3 more.  The edits, in order, spell
the audit; of the cheapest the ASCII-least counts.

A path through the DAG of (turn, state) weighs one integer: the cost in the
high digits, below it one digit a letter at a fixed place for each edit (zero:
the audit has ended).  So the smaller integer is the cheaper path and, of
equally cheap ones, that with the ASCII-least audit, and plain ``min`` decides
everything.  Two paths to one node never differ by further insertions alone at
one cost, so prefixes compare as whole audits do.  Every ``SEGMENT`` turns the
digits start anew: the letters go to a chain of finished segments, and one digit
keeps the order of the (at most four) paths.  A path carries its SHA-256 state,
so turns stream through in order and only letters are held for a conversation.

Damage (``damage``) is a function of the conversation's id and the turn.

Defined results: a null role or text counts as one space, a null id or turn
as one space in the damage key; rows without an id are one conversation; turns
are ordered by turn (nulls first), then role, text; conversations that lost all
turns are returned with zeros; repeated rows are duplicates; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turns whose letters share one integer: three a turn, in digits of 3 bits.
SEGMENT, BITS = 256, 3
WIDTH = 3 * SEGMENT + 3
# Letters by their digit (ASCII order), and the costs of the edits.
LETTERS = "\0DIKR"
D, I, K, R = 1, 2, 3, 4
COST = {K: 0, R: 3, D: 4, I: 3}
TRUNCATED = 3
# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The role that may be inserted (or given) in each state.
DUE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}


class Path:
    """The best path to a state: weight, letters in this segment, finished
    segments (a linked chain), SHA-256 of the turns, pending turns."""

    __slots__ = ("weight", "letters", "done", "sha", "turns", "added")

    def __init__(self, weight, letters, done, sha, turns, added):
        self.weight, self.letters, self.done, self.sha, self.turns, self.added = weight, letters, done, sha, turns, added

    def step(self, letter: int, extra: int, added: tuple[bytes, ...]) -> Path:
        weight = self.weight + ((COST[letter] + extra) << BITS * (WIDTH + 1)) + (letter << BITS * (WIDTH - 1 - self.letters))
        return Path(weight, self.letters + 1, self.done, self.sha, self.turns, self.added + added)

    def settle(self) -> Path:
        """Turns added since go into a SHA-256 of its own."""
        if self.added:
            self.sha = self.sha.copy()
            for turn in self.added:
                self.sha.update(b"\n" + turn if self.turns else turn)
                self.turns += 1
            self.added = ()
        return self

    def audit(self) -> str:
        """Letters of this segment."""
        low = self.weight & ((1 << BITS * WIDTH) - 1)
        return "".join(LETTERS[low >> BITS * (WIDTH - 1 - k) & 7] for k in range(self.letters))


def better(paths: dict[int, Path], state: int, path: Path) -> None:
    if state not in paths or path.weight < paths[state].weight:
        paths[state] = path


class Repair:
    """One conversation, turn by turn."""

    def __init__(self) -> None:
        self.paths = {START: Path(0, 0, None, hashlib.sha256(), 0, ())}
        self.fed = 0

    def gap(self) -> dict[int, Path]:
        """Up to two insertions: more come back to a state at a higher cost."""
        paths = dict(self.paths)
        layer = paths
        for _ in range(2):
            more: dict[int, Path] = {}
            for state, path in layer.items():
                role = DUE[state]
                better(more, NEXT[state, role[0]], path.step(I, 0, (f"{role}:".encode(),)))
            layer = more
            for state, path in more.items():
                better(paths, state, path)
        return paths

    def feed(self, role: str, text: str, fault: str | None) -> None:
        after: dict[int, Path] = {}
        extra = TRUNCATED if fault == "truncated" else 0
        for state, path in self.gap().items():
            better(after, state, path.step(D, 0, ()))
            if fault in ("blank", "duplicate"):
                continue
            if (state, role[:1]) in NEXT:
                better(after, NEXT[state, role[:1]], path.step(K, extra, (f"{role}:{text}".encode(errors="replace"),)))
            due = DUE[state]
            better(after, NEXT[state, due[0]], path.step(R, extra, (f"{due}:{text}".encode(errors="replace"),)))
        self.paths = {state: path.settle() for state, path in after.items()}
        self.fed += 1
        if self.fed % SEGMENT == 0:
            self.renew()

    def renew(self) -> None:
        """Letters to the chains; a digit keeps the order of the paths' audits."""
        digits = (1 << BITS * (WIDTH + 1)) - 1
        order = sorted(self.paths, key=lambda s: self.paths[s].weight & digits)
        for rank, state in enumerate(order):
            p = self.paths[state]
            cost = p.weight >> BITS * (WIDTH + 1)
            self.paths[state] = Path((cost << BITS * (WIDTH + 1)) + (rank << BITS * WIDTH), 0, (p.audit(), p.done), p.sha, p.turns, ())

    def result(self) -> tuple[int, str, str]:
        ends = self.gap()
        best = min((ends[s] for s in (START, ASSISTANT) if s in ends), key=lambda p: p.weight).settle()
        parts, chain = [best.audit()], best.done
        while chain is not None:
            parts.append(chain[0])
            chain = chain[1]
        return best.weight >> BITS * (WIDTH + 1), "".join(reversed(parts)), best.sha.hexdigest()


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with ``copies`` 0, 1 or 2 (0: lost)
    and the text and role that are left."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault`` of a turn's first copy: blank, duplicate (role and
    text seen earlier) or truncated.  The search for earlier turns is dealt by
    role and text, so one long conversation is spread."""
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    kept = F.when(F.col("copies") > 0, F.row_number().over(earlier) > 1)
    last = F.regexp_extract("text", r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (F.when(F.col("copies") == 0, F.lit(None)).when(last == "", "blank").when(F.col("again"), "duplicate").when(~last.rlike("[.!?]"), "truncated"))
    return rows.withColumn("again", kept).withColumn("fault", fault).drop("again")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", *, damaged: bool = False) -> DataFrame:
    """One row a conversation: ``conv_id``, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.
    ``damaged``: apply ``damage`` first."""
    rows = rows.select(F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    if damaged:
        rows = damage(rows)
    else:
        rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(1).alias("copies"))
    # lost turns stay as marks of their conversation
    lost = F.col("copies") == 0
    rows = rows.select("conv_id", "turn", *[F.when(~lost, F.col(c)).alias(c) for c in ("role", "text")], "copies")
    rows = faults(rows).select("conv_id", "turn", "role", "text", "copies", "fault")
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    legal = {"su", "ua", "au"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        now, work, seen, out, id_type = none, None, None, [], None

        def finish() -> None:
            cost, audit, sha = work.result()
            gaps = seen["high"] - seen["low"] + 1 - seen["turns"] if seen["turns"] else 0
            out.append((now, gaps, seen["blank"], seen["duplicate"], seen["truncated"], seen["illegal"], cost, audit, sha))

        def batch_of(done: list) -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), *[pa.array(c, pa.int64()) for c in cols[1:7]], pa.array(cols[7], pa.string()), pa.array(cols[8], pa.string())], names)

        for batch in batches:
            id_type = batch.column(0).type
            for lo in range(0, batch.num_rows, 512):
                for c, t, r, x, copies, fault in zip(*(col.slice(lo, 512).to_pylist() for col in batch.columns), strict=True):
                    if now is none or c != now:
                        if now is not none:
                            finish()
                        now, work = c, Repair()
                        seen = {"low": None, "high": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "role": None}
                    if not copies:
                        continue
                    if t is not None and t != seen["high"]:
                        seen["low"], seen["high"], seen["turns"] = t if seen["low"] is None else seen["low"], t, seen["turns"] + 1
                    for nth in range(copies):
                        if nth and fault != "blank":
                            fault = "duplicate"
                        if fault:
                            seen[fault] += 1
                        if seen["role"] is not None and seen["role"] + r[:1] not in legal:
                            seen["illegal"] += 1
                        seen["role"] = r[:1]
                        work.feed(r, x, fault)
                if len(out) >= 1024:
                    yield batch_of(out)
                    out = []
        if now is not none:
            finish()
        if out:
            yield batch_of(out)

    schema = f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    ordered = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(run, schema)


def repair_sql() -> str:
    """Damage and repair in DuckDB: CRC-32 by its table, and a recursion over
    turns with one (cost, audit, text) string pair for each of the four states."""
    space = "\\x20\\x09-\\x0D"

    def step(path: str, cost: str, letter: str, turn: str | None) -> str:
        text = f"{path}.t" if turn is None else f"{path}.t || CASE WHEN {path}.t = '' THEN '' ELSE chr(10) END || {turn}"
        return (f"CASE WHEN {path} IS NOT NULL THEN {{'k': lpad(CAST(CAST(substr({path}.k, 1, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || substr({path}.k, 13) || '{letter}', "
                f"'t': {text}}} END")

    def gapped(source: str, keep: str) -> str:
        """States after up to two insertions, as g0 to g3."""
        return f"""
  SELECT {keep}, p0 AS g0, p1 AS g1, least(p2, i2, {step('i3', '3', 'I', "'user:'")}) AS g2, least(p3, i3, {step('i2', '3', 'I', "'assistant:'")}) AS g3
  FROM (SELECT {keep}, p0, p1, p2, p3, {step('e', '3', 'I', "'user:'")} AS i2, {step('p2', '3', 'I', "'assistant:'")} AS i3
        FROM (SELECT {keep}, p0, p1, p2, p3, least(p0, p1, p3) AS e FROM {source}))"""

    extra = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    same, user, assistant = "role || ':' || text", "'user:' || text", "'assistant:' || text"

    def kept(path: str, initial: str, turn: str) -> str:
        return f"CASE WHEN free AND initial = '{initial}' THEN {step(path, extra, 'K', turn)} END"

    def given(path: str, turn: str) -> str:
        return f"CASE WHEN free THEN {step(path, f'3 + {extra}', 'R', turn)} END"

    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
hashed AS (
  SELECT k.*, xor(list_reduce(list_transform(string_split(key, ''), lambda s: CAST(ord(s) AS BIGINT)),
         lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM keyed k, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, nth
  FROM hashed, (SELECT unnest([0, 1]) AS nth) WHERE kind <> 0 AND (nth = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, nth) AS again FROM hurt),
rows AS (
  SELECT *, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^{space}]') THEN 'blank' WHEN again > 1 THEN 'duplicate'
              WHEN regexp_extract(text, '([^{space}])[{space}]*\\z', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'k': '000000000000', 't': ''}} AS p0,
         CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR)) AS p1, CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR)) AS p2, CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR)) AS p3
  FROM (SELECT DISTINCT conv_id FROM rows)
  UNION ALL
  SELECT conv_id, i, {step('g0', '4', 'D', None)}, least({step('g1', '4', 'D', None)}, {kept('g0', 's', same)}),
         least({step('g2', '4', 'D', None)}, {kept('u', 'u', same)}, {given('u', user)}),
         least({step('g3', '4', 'D', None)}, {kept('g2', 'a', same)}, {given('g2', assistant)})
  FROM (SELECT *, least(g0, g1, g3) AS u FROM ({gapped('''(
        SELECT r.conv_id, r.i, r.role, r.text, r.initial, r.fault, r.fault NOT IN ('blank', 'duplicate') AS free, w.p0, w.p1, w.p2, w.p3
        FROM walk w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)''', 'conv_id, i, role, text, initial, fault, free')}))),
ends AS (
  SELECT conv_id, least(g0, g3) AS best FROM ({gapped('''(
        SELECT w.* FROM walk w JOIN (SELECT conv_id, max(i) AS i FROM rows GROUP BY conv_id) m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i)''', 'conv_id')})),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(substr(best.k, 1, 12), '0') AS BIGINT) AS cost, coalesce(substr(best.k, 13), '') AS audit,
       sha256(coalesce(best.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM a.conv_id"""
