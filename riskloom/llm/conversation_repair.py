"""Repair of conversations by a shortest path whose weights are scalar big integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

# The costs of edits, white space and the marks that end a turn.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
FINE, CUT_OFF, BLANK, DUPLICATE = range(4)
FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}  # initials that may follow one
DONE = ("", "a")  # initials after which a conversation may end
NAMES = {"u": "user", "a": "assistant"}
LETTERS = "DIKR"  # in ASCII order, so codes compare as letters do; zero pads the end
CODE = {letter: i for i, letter in enumerate(LETTERS, 1)}
BITS = 3  # of a letter's digit
SETTLE = 64  # rows after which the letters so far are written down
ROWS = 256  # rows that are Python objects at a time

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


@cache
def edges(state: str, initial: str, fault: int) -> list[tuple[str, int, str]]:
    """(letter, cost, next state) of what can be done with a row."""
    found = [("D", DELETE, state)]
    if fault < BLANK:
        more = TRUNCATED if fault == CUT_OFF else 0
        if initial and initial in FOLLOWS[state]:
            found.append(("K", more, initial))
        found += [("R", REROLE + more, to) for to in insertions(state)]
    return found


@cache
def insertions(state: str) -> list[str]:
    return [to for to in NAMES if to in FOLLOWS[state]]


def most_insertions(rows: list[tuple[str, int]]) -> int:
    """The most rows that a cheapest repair inserts: what the exact graph must have room for.

    At these costs none ever does, since deleting an inserted row's neighbour is cheaper;
    the graph holds for others too.
    """

    def inserted(best: dict) -> dict:
        for _ in FOLLOWS:
            for state, (cost, n) in list(best.items()):
                for to in insertions(state):
                    best[to] = min(best.get(to, (cost + INSERT, n - 1)), (cost + INSERT, n - 1))
        return best

    best = inserted({"": (0, 0)})
    for row in rows:
        after: dict = {}
        for state, (cost, n) in best.items():
            for _, more, to in edges(state, *row):
                after[to] = min(after.get(to, (cost + more, n)), (cost + more, n))
        best = inserted(after)
    return -min(best[state] for state in DONE if state in best)[1]


def repair(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """The least cost of making (initial, fault) rows legal, and the ASCII-least letters at it.

    A node is (rows inserted, last initial) behind a number of rows, so all paths to it
    have equally many letters. A path's weight is one integer: the cost in the high digits,
    then the letters as digits of fixed width, zero behind the last. The least integer at a
    node, and at the end, is the cheapest repair with the least letters.

    Every ``SETTLE`` rows the letters that all paths have by then are written down, and one
    digit above the others takes their place: the rank of these letters among the paths'.
    Weights compare as before and stay as small however long a conversation is.
    """
    room = most_insertions(rows)
    width = SETTLE + room + 1
    rank_at, cost_at = BITS * width, BITS * width + (4 * (room + 1)).bit_length()
    digits = (1 << rank_at) - 1
    live: dict = {(0, ""): 0}
    told: list[tuple | None] = [None]  # by rank: the letters written down, the last first

    def step(at: dict, n: int, to: str, weight: int, letter: str, cost: int, place: int) -> None:
        weight += (cost << cost_at) + (CODE[letter] << (BITS * (width - 1 - place)))
        at[n, to] = min(at.get((n, to), weight), weight)

    def insert(place: int) -> None:
        for n in range(room):
            for state in FOLLOWS:
                if (n, state) in live:
                    for to in insertions(state):
                        step(live, n + 1, to, live[n, state], "I", INSERT, place + n)

    def letters(codes: int, count: int) -> str:
        found = [codes >> (BITS * i) & ((1 << BITS) - 1) for i in reversed(range(count))]
        return "".join(LETTERS[c - 1] for c in found if c)

    insert(0)
    for i, row in enumerate(rows):
        place, after = i % SETTLE, {}
        for (n, state), weight in live.items():
            for letter, cost, to in edges(state, *row):
                step(after, n, to, weight, letter, cost, place + n)
        live = after
        insert(place + 1)
        if place + 1 == SETTLE:
            rest = BITS * (width - SETTLE)
            prefixes = {node: (weight & ((1 << cost_at) - 1)) >> rest for node, weight in live.items()}
            ranks = {prefix: rank for rank, prefix in enumerate(sorted(set(prefixes.values())))}
            told = [(told[p >> (BITS * SETTLE)], letters(p, SETTLE)) for p in ranks]
            for node, weight in live.items():
                later = (weight & ((1 << rest) - 1)) << (BITS * SETTLE)
                live[node] = (weight >> cost_at << cost_at) + (ranks[prefixes[node]] << rank_at) + later
    least = min(weight for (_, state), weight in live.items() if state in DONE)
    parts, before = [letters(least & digits, width)], told[least >> rank_at & ((1 << (cost_at - rank_at)) - 1)]
    while before:
        before, part = before
        parts.append(part)
    return least >> cost_at, "".join(reversed(parts))


def _row_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy): rows as the checksum of ``conv_id:turn`` leaves them.

    Nulls read as one space. ``copy`` is null for a dropped row, which stays without role
    and text so that its conversation is known.
    """
    kind = F.crc32(F.concat(_row_text("conv_id"), F.lit(":"), _row_text("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_row_text("text"), "[.!?]", "")).otherwise(_row_text("text"))
    dropped = F.array(F.lit(None).cast("int"))
    copies = F.when(kind == 0, dropped).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind != 0, F.when(kind == 4, "user").otherwise(_row_text("role"))).alias("role"),
        F.when(kind != 0, text).alias("text"),
        copies.alias("copies"),
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy"))


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """A conversation's rows in one task and in order: by turn, ties by role and text."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, "turn", "role", "text_key", "copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` without texts, with ``text_key`` and the first ``fault`` that counts."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    keyed = rows.select("conv_id", "turn", "role", "copy", F.md5("text").alias("text_key"), (trimmed == "").alias("blank"), F.right(trimmed, F.lit(1)).alias("last"))
    same = Window.partitionBy("conv_id", "role", "text_key").orderBy("turn", "copy")
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.row_number().over(same) > 1, DUPLICATE)
        .when(~F.col("last").isin(*ENDS), CUT_OFF)
        .otherwise(FINE)
    )
    spread = keyed.repartition("conv_id")
    return spread.withColumn("fault", fault).withColumn("initial", F.left("role", F.lit(1))).drop("blank", "last")


def report(turns: list[int], rows: list[tuple[str, int]]) -> dict:
    """A conversation's figures from its turns and its (initial, fault) rows in order."""
    faults_seen = [fault for _, fault in rows]
    pairs = zip(rows, rows[1:], strict=False)
    cost, audit = repair(rows)
    return {
        "gaps": turns[1] - turns[0] + 1 - turns[2] if turns else 0,
        "blank": faults_seen.count(BLANK),
        "duplicate": faults_seen.count(DUPLICATE),
        "truncated": faults_seen.count(CUT_OFF),
        "illegal": sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in pairs),
        "cost": cost,
        "audit": audit,
    }


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from batch.slice(at, ROWS).to_pylist()


def _reports(id_type: pa.DataType):
    """Rows without texts, conversation by conversation, into a row of figures for each."""
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv_id", id_type), *[(n, pa.int64()) for n in longs], ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}  # (initial, fault) pairs are few; a long conversation holds references
        begun, conv, turns, rows, made = False, None, [], [], []
        for row in _slices(batches):
            if not begun or row["conv_id"] != conv:
                if begun:
                    made.append({"conv_id": conv, **report(turns, rows)})
                begun, conv, turns, rows = True, row["conv_id"], [], []
                if len(made) >= ROWS:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made = []
            if row["copy"] is None:
                continue
            pair = (row["initial"], row["fault"])
            rows.append(seen.setdefault(pair, pair))
            turn = row["turn"]
            if turn is not None:
                # first, last and distinct turns; rows come by turn
                turns = [turns[0], turn, turns[2] + (turn != turns[1])] if turns else [turn, turn, 1]
        if begun:
            made.append({"conv_id": conv, **report(turns, rows)})
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)

    return run


class Repaired:
    """The digest of a repaired conversation, fed row by row."""

    def __init__(self, audit: str):
        self.letters, self.state, self.sha, self.lines = iter(audit), "", hashlib.sha256(), 0

    def line(self, role: str, text: str) -> None:
        self.sha.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1
        self.state = role[:1]

    def expected(self) -> str:
        return NAMES[insertions(self.state)[0]]

    def letter(self) -> str | None:
        """The next row's letter, with insertions before it written."""
        for letter in self.letters:
            if letter != "I":
                return letter
            self.line(self.expected(), "")
        return None

    def row(self, role: str, text: str) -> None:
        letter = self.letter()
        if letter != "D":
            self.line(role if letter == "K" else self.expected(), text)

    def digest(self) -> str:
        self.letter()
        return self.sha.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's report, then its rows with texts, into the report and the digest."""
    head, text, heads = None, None, []
    names = ["conv_id", *[f.split()[0] for f in REPORT.split(", ")]]

    def made() -> pa.RecordBatch:
        done = pa.Table.from_batches([h for h, _ in heads]).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([*done.columns, pa.array([d for _, d in heads], pa.string())], names=[*names, "repaired_sha256"])

    for batch in batches:
        audits, roles, texts = (batch.column(c) for c in ("audit", "role", "text"))
        for i in range(batch.num_rows):
            if audits[i].is_valid:
                if head is not None:
                    heads.append((head, text.digest()))
                if len(heads) >= ROWS:
                    yield made()
                    heads = []
                head, text = batch.select(names).slice(i, 1), Repaired(audits[i].as_py())
            else:
                text.row(roles[i].as_py(), texts[i].as_py())
    if head is not None:
        heads.append((head, text.digest()))
    if heads:
        yield made()


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text, copy) as ``damaged`` gives them.

    The graph is searched over rows without texts, so a conversation in memory is two small
    values per row; texts then pass once more, behind their conversation's letters, and are
    digested as they come. The digest of a conversation is sequential by nature, so one
    task reads it from first to last.
    """
    kind = rows.schema["conv_id"].dataType
    flagged = _ordered(faults(rows)).select("conv_id", "turn", "copy", "initial", "fault")
    found = flagged.mapInArrow(_reports(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, {REPORT}")
    texts = rows.filter("copy IS NOT NULL").withColumn("text_key", F.md5("text"))
    both = texts.withColumn("kind", F.lit(1)).unionByName(found.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return _ordered(both, "kind").mapInArrow(_digests, f"conv_id {kind.simpleString()}, {REPORT}, repaired_sha256 string")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    One row per conv_id of ``conversations`` (a null one is a conversation of its own).
    Rows stand by turn, null first; rows of a turn by role and the digest of their text, so
    repeated rows are neighbours and, but for the first, duplicates. Nulls read as one
    space, so a null text is blank and a null role fits nowhere. A conversation without
    rows after the damage has zeros, no letters and the digest of nothing. An empty table
    gives an empty one; further columns are ignored.
    """
    return repair_conversations(damaged(conversations))


def _sql() -> str:
    def before(letter: str, cost: str | int, then: str) -> str:
        return f"printf('%09d', substr({then}, 1, 9)::BIGINT + {cost}) || '{letter}' || substr({then}, 10)"

    def step(state: str) -> str:
        then = {"b": "u", "s": "u", "u": "a", "a": "u"}[state]
        fits = f"initial = '{then}'"
        keep = f"CASE WHEN {fits} AND fault < 2 THEN {before('K', '5 * (fault = 1)::INT', then)} END"
        rerole = f"CASE WHEN fault < 2 THEN {before('R', '1 + 5 * (fault = 1)::INT', then)} END"
        first = f", CASE WHEN initial = 's' AND fault < 2 THEN {before('K', '5 * (fault = 1)::INT', 's')} END" if state == "b" else ""
        return f"least({before('D', 2, state)}, {keep}, {rerole}{first})"

    insert_ua = f"least(u, {before('I', 5, 'a')}) AS u, least(a, {before('I', 5, 'u')}) AS a"
    return rf"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, s: xor(c >> 1, (c & 1) * 3988292384), i)) AS crc),
r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT),
                 lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind FROM {{conversations}}, t),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM r),
e AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS initial FROM d),
f AS (SELECT conv_id, turn, role, text, initial,
             CASE WHEN body = '' THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 3
                  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM e),
o AS (SELECT conv_id, i, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM f),
j AS (SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM o GROUP BY conv_id),
g AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank,
             count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated FROM f GROUP BY conv_id),
w AS (SELECT conv_id, n + 1 AS i, '000000000' AS b, NULL::VARCHAR AS s, '000000005I' AS u, '000000000' AS a FROM g
      UNION ALL
      SELECT conv_id, i, least(b, {before('I', 5, 'u')}) AS b, least(s, {before('I', 5, 'u')}) AS s, u, a FROM (
        SELECT conv_id, i, b, s, {insert_ua} FROM (
          SELECT w.conv_id, f.i, {step('b')} AS b, {step('s')} AS s, {step('u')} AS u, {step('a')} AS a
          FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i - 1))),
v AS (SELECT conv_id, substr(b, 1, 9)::BIGINT AS cost, substr(b, 10) AS audit FROM w WHERE i = 1),
y AS (SELECT conv_id, unnest(range(1, len(audit) + 1)) AS spot, string_split(audit, '') AS l FROM v WHERE audit <> ''),
z AS (SELECT conv_id, spot, l[spot] AS letter, count(*) FILTER (l[spot] <> 'I') OVER (PARTITION BY conv_id ORDER BY spot) AS i FROM y),
k AS (SELECT z.conv_id, spot, letter, coalesce(f.role, '') AS role, coalesce(f.text, '') AS text, row_number() OVER (PARTITION BY z.conv_id ORDER BY spot) AS place,
             first_value(letter = 'K' AND f.initial = 's') OVER (PARTITION BY z.conv_id ORDER BY spot)::INT AS system
      FROM z LEFT JOIN f ON letter <> 'I' AND f.conv_id IS NOT DISTINCT FROM z.conv_id AND f.i = z.i WHERE letter <> 'D'),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY spot)) AS repaired
      FROM k GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM {{conversations}}) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN j ON j.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""


REPAIR_SQL = _sql().replace("{conversations}", "conversations")
