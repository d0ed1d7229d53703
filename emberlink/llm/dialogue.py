"""Conversation structure: faults of turns, and the cheapest edits that make the roles alternate.

Rows of a conversation are taken by ``turn`` (nulls first; rows of one turn by role, then by a hash of
their text, as their order is not given). A row is blank (white space only), a duplicate
(role and text seen earlier in the conversation) or truncated (no mark at its end); the first that fits counts. The
repair deletes, reroles and inserts rows until the roles' initials are ``(s?(ua)+)?``, by
:mod:`emberlink.llm.glr`; blank rows and duplicates must go.

Rows are dealt out by ranges of (conversation, turn, role, hash, salt) and sorted within their task, so a conversation
that holds much of the table is spread over many tasks. Conversations strictly inside a task's range
are whole and done there, in one pass. The first and last one of each range may go on elsewhere;
their rows are written as *pieces*, and

1. duplicates are found by the first place of each (conversation, role, text), aggregated before the shuffle;
2. each piece is run from every stack the automaton can have, giving costs and orders, no texts and no audits;
3. a conversation's pieces are folded in order, a few numbers each, which tells where each piece starts;
4. each piece is then run once more, from there, and gives its repaired rows.

A hash of a whole conversation runs over its text in order: that one task streams, a piece at a time.

Defined results: ``damage`` reads nulls as one space, so a null text is blank and a null role is no
known role; a null ``turn`` comes first; rows with a null ``conv_id`` are one conversation. Repeated rows are
duplicates of each other. Conversations without rows are whole and empty. Texts of any length
travel whole. Extra columns are not read. An empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from emberlink.llm.common import cut_lineage, table
from emberlink.llm.glr import Back, Kind, Repairer

TASK_BYTES = 16 << 20  # of rows a task takes, roughly
_SALTS = 4096  # equal rows of one place may lie in so many ranges
_SPACE = " \t\n\x0b\x0c\r"
_ENDS = ".!?"
_LEGAL = {"su", "ua", "au"}
_NAMES = {"u": "user", "a": "assistant"}
_TURNS = "array<struct<role:string,text:string>>"
_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_COUNTED = [c.split()[0] for c in _COUNTS.split(", ")]


def damage(conversations: DataFrame) -> DataFrame:
    """Test damage by checksums of conversation and turn: (``conv_id``, ``turn``, ``role``, ``text``, ``gone``).

    Dropped rows stay as ``gone``, so that their conversation is not forgotten.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    damaged = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "kind")
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return damaged.withColumn("copy", copies).select("conv_id", "turn", "role", "text", (kind == 0).alias("gone"))


def as_rows(conversations: DataFrame) -> DataFrame:
    """Rows as they are, for :func:`repair`; null roles and texts count as one space."""
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("gone"))


@dataclass
class Tally:
    """Faults of consecutive rows of a conversation, and what the repair has to know of each row."""

    kinds: list[Kind] = field(default_factory=list)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None

    def add(self, role: str, text: str, seen: bool) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.last = initial
        end = text.rstrip(_SPACE)[-1:]
        truncated = False
        if not end:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        elif end not in _ENDS:
            truncated = True
            self.truncated += 1
        self.kinds.append((initial if initial in ("s", "u", "a") else "", not end or seen, truncated))


def rebuilt(way: list[Back], roles: list[str], texts: list[str], behind: str) -> list[tuple[str, str]]:
    """(role, text) of the rows that edits leave and make."""
    out = []
    for back, role, text in zip(way, roles, texts):
        for edit, symbol in zip(back.edits, back.symbols):
            out.append((_NAMES[symbol], "") if edit == "I" else (role if edit == "K" else _NAMES[symbol], text))
    return out + [(_NAMES[symbol], "") for symbol in behind]


def _gaps(turns: list[int]) -> int:
    return max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0


def repair_one(repairer: Repairer, rows: list[tuple[int | None, str, str]]) -> tuple:
    """(``_COUNTED``.., audit, repaired rows) of one conversation's rows (turn, role, text) in order."""
    tally, seen = Tally(), set()
    for _, role, text in rows:
        tally.add(role, text, (role, text) in seen)
        seen.add((role, text))
    front, cost, trail = repairer.run(repairer.front(repairer.root), tally.kinds)
    state, more, behind = repairer.finish(front)
    way = repairer.trace(trail, state)
    turns = rebuilt(way, [r[1] for r in rows], [r[2] for r in rows], behind)
    audit = "".join(b.edits for b in way) + "I" * len(behind)
    return (_gaps([r[0] for r in rows if r[0] is not None]), tally.blank, tally.duplicate, tally.truncated, tally.illegal, cost + more, audit, turns)


# ---- conversations inside a task's range -----------------------------------------------------

_SORTED = ["conv_id", "turn", "role", "tie", "salt"]
_OUT = f"conv_id long, {_COUNTS}, audit string, turns {_TURNS}, part int, place long, turn long, role string, text string, gone boolean"
_OUT_COLUMNS = ["conv_id", *_COUNTED, "audit", "turns", "part", "place", "turn", "role", "text", "gone"]


def _sorted_rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, list]]:
    """Conversations in order, each as its id and the rows there are; a conversation's rows may come in several lists."""
    for batch in batches:
        batch = batch.astype(object).where(batch.notna(), None)
        held, current = [], None
        for conv, turn, role, text, gone in zip(*(batch[c].tolist() for c in ("conv_id", "turn", "role", "text", "gone"))):
            if held and conv != current:
                yield current, held
                held = []
            current = conv
            held.append((None if turn is None else int(turn), role, text, gone))
        if held:
            yield current, held


def _inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One sorted range: whole conversations are done, rows of the first and the last one go on as pieces."""
    repairer, part = Repairer(), TaskContext.get().partitionId()
    out, place, weight = [], 0, 0

    def loose(conv: str | None, rows: list) -> None:
        nonlocal place
        for turn, role, text, gone in rows:
            out.append((_id(conv), *[None] * (len(_COUNTED) + 2), part, place, turn, role, text, gone))
            place += 1

    def whole(conv: str | None, rows: list) -> None:
        out.append((_id(conv), *repair_one(repairer, [r[:3] for r in rows if not r[3]]), *[None] * 6))

    start, current, held, number = True, None, [], 0
    for conv, rows in _sorted_rows(batches):
        if start or conv != current:
            if number > 1:
                whole(current, held)
            start, current, held = False, conv, []
            number += 1
        if number == 1:
            loose(conv, rows)
        else:
            held += rows
        weight += sum(len(r[2]) + 50 for r in rows)
        if weight > 1 << 21:
            yield pd.DataFrame(out, columns=_OUT_COLUMNS, dtype=object)
            out, weight = [], 0
    if number > 1:
        loose(current, held)
    if out:
        yield pd.DataFrame(out, columns=_OUT_COLUMNS, dtype=object)


def _id(conv: str | None) -> int | None:
    return None if conv is None else int(conv)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows by ranges of place, sorted in each task."""
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("role") + 50)).first()[0] or 0
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumns({"tie": F.xxhash64("text"), "salt": F.monotonically_increasing_id() % _SALTS})
    ranged = keyed.repartitionByRange(max(least, int(size) // TASK_BYTES), *_SORTED).sortWithinPartitions(*_SORTED)
    # Numbers with nulls as strings: pandas would make them inexact.
    return ranged.select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "gone")


# ---- conversations that may lie in several ranges ---------------------------------------------

_PIECE = ["conv", "part"]


def _with_duplicates(loose: DataFrame) -> DataFrame:
    """Rows of pieces with ``seen``: whether role and text came earlier in the conversation."""
    live = loose.where("not gone").withColumn("digest", F.md5(F.col("text").cast("binary")))
    first = live.groupBy("conv", "role", "digest").agg(F.min(F.struct("part", "place")).alias("first"), F.count("*").alias("n"))
    several = cut_lineage(first.where("n > 1").drop("n"), "dialogue-first")
    marked = live.join(several, ["conv", "role", "digest"], "left")
    return marked.select("conv", "part", "place", "turn", "role", "text", F.expr("first is not null and struct(part, place) <> first").alias("seen"))


def _tallied(piece: pd.DataFrame) -> tuple[pd.DataFrame, Tally]:
    piece, tally = piece.sort_values("place"), Tally()
    for role, text, seen in zip(piece["role"], piece["text"], piece["seen"]):
        tally.add(role, text, bool(seen))
    return piece, tally


_WAYS = "conv string, part int, blank long, duplicate long, truncated long, illegal long, first string, last string, ways array<array<long>>"


def _piece_ways(piece: pd.DataFrame) -> pd.DataFrame:
    """From every stack: where a piece can lead (state, cost, rank, stack)."""
    repairer = Repairer()
    _, tally = _tallied(piece)
    ways = []
    for node in list(repairer.nodes):
        front, cost, _ = repairer.run(repairer.front(node), tally.kinds)
        ways += [[node.number, state, cost + more, rank, number] for state, more, rank, number in front]
    row = (piece["conv"].iat[0], piece["part"].iat[0], tally.blank, tally.duplicate, tally.truncated, tally.illegal, tally.first, tally.last, ways)
    return pd.DataFrame([row], columns=[c.split()[0] for c in _WAYS.split(", ")])


_FOLDED = "conv string, part int, blank long, duplicate long, truncated long, illegal long, cost long, node int, state int, behind string"


def _fold(pieces: pd.DataFrame) -> pd.DataFrame:
    """Where each of a conversation's pieces starts and ends; a few numbers a piece. Totals are in the first row."""
    pieces, repairer = pieces.sort_values("part"), Repairer()
    heads = {repairer.root.state: (0, 0, repairer.root.number)}  # state: cost, rank, stack
    trail = []
    for ways in pieces["ways"]:
        by_node: dict[int, list] = {}
        for node, state, cost, rank, number in ways:
            by_node.setdefault(node, []).append((state, cost, rank, number))
        best: dict[int, tuple] = {}
        for entry, (cost, rank, node) in heads.items():
            for state, more, order, number in by_node[node]:
                found = (cost + more, rank, order, number, entry, node)
                if state not in best or found[:3] < best[state][:3]:
                    best[state] = found
        ranks = {r: i for i, r in enumerate(sorted({b[1:3] for b in best.values()}))}
        heads = {state: (b[0], ranks[b[1:3]], b[3]) for state, b in best.items()}
        trail.append({state: (b[4], b[5]) for state, b in best.items()})
    state, cost, behind = repairer.finish(tuple((s, c, r, n) for s, (c, r, n) in heads.items()))
    places = []
    for back in reversed(trail):
        entry, node = back[state]
        places.append((node, state))
        state = entry
    places.reverse()
    out = pieces[["conv", "part", "blank", "duplicate", "truncated", "illegal"]].reset_index(drop=True)
    across = sum(a + b not in _LEGAL for a, b in zip(pieces["last"][:-1], pieces["first"][1:]))
    out.loc[0, "illegal"] += across
    last = len(out) - 1
    return out.assign(cost=[cost] + [0] * last, node=[p[0] for p in places], state=[p[1] for p in places], behind=[""] * last + [behind])


_REPAIRED = f"conv string, part int, audit string, turns {_TURNS}"


def _rebuild(key: tuple, piece: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
    """A piece's edits and repaired rows, now that its start and its end are known."""
    repairer = Repairer()
    piece, tally = _tallied(piece)
    node, state, behind = (ends[c].iat[0] for c in ("node", "state", "behind"))
    _, _, trail = repairer.run(repairer.front(repairer.nodes[node]), tally.kinds)
    way = repairer.trace(trail, state)
    turns = rebuilt(way, piece["role"].tolist(), piece["text"].tolist(), behind)
    audit = "".join(b.edits for b in way) + "I" * len(behind)
    return pd.DataFrame([(key[0], key[1], audit, turns)], columns=["conv", "part", "audit", "turns"])


@dataclass(frozen=True)
class Repaired:
    """What a repair gives.

    ``whole``: conversations that lay in one task, with ``conv_id``, counts, ``audit`` and ``turns``, their repaired rows.
    ``split``: counts of those that may have several pieces. ``pieces``: their ``conv_id``, ``part`` (which
    orders them), ``audit`` and ``turns``.
    """

    whole: DataFrame
    split: DataFrame
    pieces: DataFrame


def repair(rows: DataFrame) -> Repaired:
    """Repair conversations given as (``conv_id``, ``turn``, ``role``, ``text``, ``gone``)."""
    done = cut_lineage(_dealt(rows).mapInPandas(_inside, _OUT), "dialogue-rows")
    loose = done.where("part is not null").withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    marked = cut_lineage(_with_duplicates(loose), "dialogue-pieces")
    ways = marked.groupBy(*_PIECE).applyInPandas(_piece_ways, _WAYS)
    folded = cut_lineage(ways.groupBy("conv").applyInPandas(_fold, _FOLDED), "dialogue-folded")
    places = folded.select("conv", "part", "node", "state", "behind")
    pieces = marked.groupBy(*_PIECE).cogroup(places.groupBy(*_PIECE)).applyInPandas(_rebuild, _REPAIRED)
    # Turns are counted apart, as pieces may share one; conversations without a row are here, too.
    turn = F.expr("if(gone, null, turn)")
    turns = loose.groupBy("conv").agg(F.min(turn).alias("lo"), F.max(turn).alias("hi"), F.count_distinct(turn).alias("n"))
    sums = folded.groupBy("conv").agg(*[F.sum(c).alias(c) for c in _COUNTED[1:]])
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n"), F.lit(0)).alias("gaps")
    conv_id = F.when(F.col("conv") != "", F.col("conv").cast("long")).alias("conv_id")
    split = turns.join(sums, "conv", "left").select(conv_id, gaps, *[F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTED[1:]])
    return Repaired(done.where("part is null").select("conv_id", *_COUNTED, "audit", "turns"), split, pieces.select(conv_id, "part", "audit", "turns"))


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit and hash of conversations whose pieces come in order, one piece at a time."""
    current, audit, digest, empty = None, [], None, True
    row = lambda: pd.DataFrame([(current, "".join(audit), digest.hexdigest())], columns=["conv", "audit", "repaired_sha256"])  # noqa: E731
    for batch in batches:
        for conv, more, turns in zip(batch["conv"], batch["audit"], batch["turns"]):
            if digest is None or conv != current:
                if digest is not None:
                    yield row()
                current, audit, digest, empty = conv, [], hashlib.sha256(), True
            audit.append(more)
            for turn in turns:
                digest.update(f"{'' if empty else chr(10)}{turn['role']}:{turn['text']}".encode("utf-8", "surrogatepass"))
                empty = False
    if digest is not None:
        yield row()


def digests(found: Repaired) -> DataFrame:
    """One row per conversation: ``conv_id``, counts, ``audit`` and ``repaired_sha256`` (of its ``role:text`` lines)."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = found.whole.select("conv_id", *_COUNTED, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    keyed = lambda df: df.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))  # noqa: E731
    pieces = keyed(found.pieces).select("conv", "part", "audit", "turns")
    hashed = pieces.repartition("conv").sortWithinPartitions("conv", "part").mapInPandas(_stream, "conv string, audit string, repaired_sha256 string")
    nothing = hashlib.sha256().hexdigest()
    split = keyed(found.split).join(hashed, "conv", "left").withColumns({"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(nothing))})
    return whole.unionByName(split.select(*whole.columns))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of ``conversations``, damaged, judged and repaired."""
    return digests(repair(damage(table(spark, sf_dir, "conversations"))))


OP13_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(generate_series(1, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k) ORDER BY k) AS t
  FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS k)
),
coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''), lambda x: ord(x)) AS bytes
  FROM conversations
),
kinds AS (SELECT * EXCLUDE (bytes), xor(4294967295, list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % 20 AS kind FROM coded, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(generate_series(1, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
ends AS (
  SELECT *, right(rtrim(text, E' 	
'), 1) AS last, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
         left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
),
rows_ AS (
  SELECT *, last = '' OR seen AS must_go, last <> '' AND NOT seen AND last NOT IN ('.', '!', '?') AS cut FROM ends
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, sum((last = '')::INT)::BIGINT AS blank,
         sum((last <> '' AND seen)::INT)::BIGINT AS duplicate, sum(cut::INT)::BIGINT AS truncated,
         sum((before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au'))::INT)::BIGINT AS illegal, max(i) AS n
  FROM rows_ GROUP BY conv_id
),
moves AS (
  SELECT [{'x': '0', 'y': 'S', 'ins': '', 't': 's'}, {'x': '0', 'y': 'U', 'ins': '', 't': 'u'}, {'x': '0', 'y': 'T', 'ins': 'u', 't': 'a'},
          {'x': 'S', 'y': 'U', 'ins': '', 't': 'u'}, {'x': 'S', 'y': 'T', 'ins': 'u', 't': 'a'}, {'x': 'U', 'y': 'T', 'ins': '', 't': 'a'},
          {'x': 'U', 'y': 'U', 'ins': 'a', 't': 'u'}, {'x': 'T', 'y': 'U', 'ins': '', 't': 'u'}, {'x': 'T', 'y': 'T', 'ins': 'u', 't': 'a'}] AS m
),
fold AS (
  SELECT conv_id, 0::BIGINT AS i, [{'y': '0', 'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}] AS heads FROM counts
  UNION ALL
  SELECT f.conv_id, r.i, list_filter(list_transform(['0', 'S', 'U', 'T'], lambda y: list_min(list_filter(list_concat(
      list_transform(heads, lambda h: {'y': h.y, 'c': h.c + 4, 'a': h.a || 'D', 'o': h.o}),
      CASE WHEN r.must_go THEN [] ELSE flatten(list_transform(heads, lambda h: list_transform(
        list_filter(m, lambda e: e.x = h.y AND (e.t = r.r OR e.t <> 's')),
        lambda e: {'y': e.y, 'c': h.c + 3 * length(e.ins) + CASE WHEN e.t = r.r THEN 0 ELSE 3 END + CASE WHEN r.cut THEN 3 ELSE 0 END,
          'a': h.a || repeat('I', length(e.ins)) || CASE WHEN e.t = r.r THEN 'K' ELSE 'R' END,
          'o': list_concat(h.o, CASE e.ins WHEN 'u' THEN ['user:'] WHEN 'a' THEN ['assistant:'] ELSE [] END,
            [CASE WHEN e.t = r.r THEN r.role WHEN e.t = 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text])}))) END),
      lambda h: h.y = y))), lambda h: h IS NOT NULL)
  FROM fold AS f JOIN rows_ AS r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i + 1, moves
),
closed AS (
  SELECT f.conv_id, list_min(list_transform(heads, lambda h: CASE h.y
    WHEN 'S' THEN {'c': h.c + 6, 'a': h.a || 'II', 'o': list_concat(h.o, ['user:', 'assistant:'])}
    WHEN 'U' THEN {'c': h.c + 3, 'a': h.a || 'I', 'o': list_concat(h.o, ['assistant:'])} ELSE {'c': h.c, 'a': h.a, 'o': h.o} END)) AS best
  FROM fold AS f JOIN counts ON counts.conv_id IS NOT DISTINCT FROM f.conv_id AND i = n
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN closed ON closed.conv_id IS NOT DISTINCT FROM o.conv_id
"""
