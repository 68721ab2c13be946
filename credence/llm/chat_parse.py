"""Conversation structure repair by weighted CYK interval parsing.

A legal conversation has the role initials ``(s?(ua)+)?``. Its states are START,
S, U and A (after that initial), START and A final. The repair grammar in Chomsky
normal form has a nonterminal [p r] for each pair of states with a path from p
to r - it derives the rows, and the edits of them, that lead from p to r:

- [p r] -> [p q] [q r] for every state q;
- [p r] -> row, at the cost of an edit: K keep (0) and R rerole to user or
  assistant (3), each 3 more on a truncated row, and D delete (4, p = r), the only
  edit of blank and of duplicate rows;
- [p r] -> nothing, at the cost of I inserts (3 each) of empty user or assistant
  turns on the least path from p to r.

A cell of the chart holds, by nonterminal, the least (cost, audit) over a span, the
audit being the letters of its edits. Cells of single rows are closed under inserts
before and behind; closed cells make closed cells. Among equal costs of one span
no audit begins another one (each insert costs), so the least audits of two spans
make the least of both. Every rule for [p r] holds at every cut of a span, so the
cells of a span come out the same whichever cut is taken: the chart is filled
bottom-up for spans of 1, 2, 4, ... rows, each from its two halves, and needs n
cells where a grammar without that property needs n * n.

Rows are sorted by range over all tasks; a task parses each conversation that it
holds whole. Of the others - its first, its last, and any beyond ``MANY`` rows -
it passes the rows on; a second round parses each part's segment, joins the cells
of a conversation's segments, and hands every segment its piece of the audit. A
text seen in an earlier part comes to a segment as one row by part and text,
whatever its number of copies. Only codes and audits of a conversation meet in
one task, never its texts; those leave as pieces in order.

Faults: blank (no character but white space), else duplicate (role and text seen
earlier in the conversation), else truncated (last such character not ``.!?``).

Cases: a null role or text is one space; other roles than those with the initials
s, u, a must be reroled or deleted; a null conversation id is one conversation;
rows are ordered by turn (null first), then role, the text's first ``HEAD``
characters and its digest, so repeated rows are neighbours; a conversation of which
no row is present has zeros and empty texts; other columns are ignored, whatever
their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.llm.common import stored, worker_kept

START, S, U, A = range(4)
STEP = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
FINAL = (START, A)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
HEAD, SALTS, MANY, PIECE = 64, 64, 50_000, 1 << 22

Cells = tuple[tuple[int, str] | None, ...]


def _paths() -> list[tuple[int, int, int]]:
    """(p, r, least number of inserts from p to r)."""
    out = []
    for p in range(4):
        far = {p: 0}
        todo = [p]
        for s in todo:
            for role in "ua":
                t = STEP.get((s, role))
                if t is not None and t not in far:
                    far[t] = far[s] + 1
                    todo.append(t)
        out += [(p, r, n) for r, n in far.items()]
    # a kept s is the one step that no insert can make
    return out + [(START, S, None)]


PAIRS = {(p, r): i for i, (p, r, _) in enumerate(_paths())}
EMPTY: Cells = tuple(None if n is None else (INSERT * n, "I" * n) for _, _, n in _paths())
RULES = [[(PAIRS[p, q], PAIRS[q, r]) for q in range(4) if (p, q) in PAIRS and (q, r) in PAIRS] for p, r in PAIRS]


def joined(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two halves."""
    out = []
    for rules in RULES:
        cost, audits = None, []
        for a, b in rules:
            x, y = left[a], right[b]
            if x is not None and y is not None:
                c = x[0] + y[0]
                if cost is None or c < cost:
                    cost, audits = c, [(x[1], y[1])]
                elif c == cost:
                    audits.append((x[1], y[1]))
        out.append(None if cost is None else (cost, min(x + y for x, y in audits)))
    return tuple(out)


def of_row(code: str) -> Cells:
    """Cells of one row. code: 'd' (must go), or the role's initial (else 'o')
    with 't' if truncated."""
    out: list[tuple[int, str] | None] = [None] * len(PAIRS)
    for p in range(4):
        edits = [(DELETE, "D", p)]
        if code != "d":
            more = TRUNCATED if code.endswith("t") else 0
            edits += [(more, "K", STEP.get((p, code[0])))] + [(REROLE + more, "R", STEP.get((p, role))) for role in "ua"]
        for cost, audit, r in edits:
            if r is not None:
                i = PAIRS[p, r]
                out[i] = min(out[i] or (cost, audit), (cost, audit))
    return joined(joined(EMPTY, tuple(out)), EMPTY)


def folded(cells: list[Cells]) -> Cells:
    """Bottom-up over spans of 1, 2, 4, ... cells."""
    while len(cells) > 1:
        pairs = [joined(a, b) for a, b in zip(cells[::2], cells[1::2], strict=False)]
        cells = pairs + cells[len(cells) & ~1:]
    return cells[0] if cells else EMPTY


def parse(codes: list[str]) -> Cells:
    """Cells of the span of some rows; those of a few rows are remembered."""
    known = worker_kept("chat-parse", 0, dict)
    if len(known) > 1 << 16:
        known.clear()

    def of_few(few: tuple[str, ...]) -> Cells:
        if few not in known:
            half = len(few) // 2
            known[few] = joined(of_few(few[:half]), of_few(few[half:])) if half else of_row(few[0])
        return known[few]
    return folded([of_few(tuple(codes[at: at + 4])) for at in range(0, len(codes), 4)])


def best(cells: Cells) -> tuple[int, str]:
    return min(c for r in FINAL if (c := cells[PAIRS[START, r]]) is not None)


class Segment:
    """Codes and counts of neighbouring rows of a conversation."""

    def __init__(self, seen: set[bytes]) -> None:
        self.seen, self.codes = seen, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn: int | None, role: str, digest: bytes, blank: bool, truncated: bool) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if blank:
            self.blank += 1
            code = "d"
        elif digest in self.seen:
            self.duplicate += 1
            code = "d"
        else:
            self.truncated += truncated
            code = (initial if initial in ("s", "u", "a") else "o") + "t" * truncated
        self.seen.add(digest)
        self.codes.append(code)

    def counts(self) -> tuple[int, int, int, int, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return min(gaps, 2**63 - 1), self.blank, self.duplicate, self.truncated, self.illegal

    def then(self, other: Segment) -> None:
        """Adds the counts of the segment behind this one."""
        if self.last is not None and other.first is not None and self.last + other.first not in LEGAL:
            self.illegal += 1
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last
        self.turns += other.turns - (self.high is not None and self.high == other.low)
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))


def repaired(rows: list[tuple[str, str]], audit: str, before: int, system: bool) -> Iterator[str]:
    """The repaired turns, ``role:text``, of (role, text) rows; before: turns ahead of
    them, system: whether the conversation starts with a system turn."""
    at = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(at)
        if edit != "D":
            if edit != "K":
                role = ("user", "assistant")[(before - system) % 2]
            yield f"{role}:{text}"
            before += 1


def starts_with_system(audit: str) -> bool:
    """Pairs of turns are even in number; one more is the system turn."""
    return (len(audit) - audit.count("D")) % 2 == 1


def _shared(audit: str, rows: list[int]) -> list[str]:
    """Pieces of an audit for segments of so many rows; inserts go with the row before."""
    out, at = [], 0
    for n in rows:
        to = at
        while to < len(audit) and (n > 0 or audit[to] == "I"):
            n -= audit[to] != "I"
            to += 1
        out.append(audit[at:to])
        at = to
    out[-1] += audit[at:]
    return out


_OF_ROW = ("turn", "role", "text", "digest", "live", "blank", "truncated")
_ROW = [("key", pa.string()), ("part", pa.int32()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
        ("digest", pa.binary()), ("live", pa.bool_()), ("blank", pa.bool_()), ("truncated", pa.bool_())]
_COUNTS = ("gaps", "n_blank", "n_duplicate", "n_truncated", "n_illegal", "cost")
_DONE = pa.schema([*_ROW, *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired", pa.string())])
_DONE_SQL = ("key string, part int, place long, turn long, role string, text string, digest binary, live boolean, blank boolean, "
             "truncated boolean, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired string")


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _whole(key: str, part: int, rows: list[list]) -> tuple:
    seg, live = Segment(set()), []
    for turn, role, text, digest, present, blank, truncated in rows:
        if present:
            seg.add(turn, role, digest, blank, truncated)
            live.append((role, text))
    cost, audit = best(parse(seg.codes))
    text = "\n".join(repaired(live, audit, 0, starts_with_system(audit)))
    return (key, part, None, *[None] * len(_OF_ROW), *seg.counts(), cost, audit, text)


def _first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted part: each inner conversation parsed, the rows of the others."""
    now, rows, inner, place, out, size = None, [], False, 0, [], 0

    def passed() -> Iterator[tuple]:
        nonlocal place
        for row in rows:
            yield (now[0], now[1], place, *row, *[None] * 8)
            place += 1
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("part", "key", *_OF_ROW)]
        for part, key, *row in zip(*columns, strict=True):
            if now != (key, part):
                out += [_whole(*now, rows)] if inner else passed()
                # of the first conversation of a part, rows may lie in the part before
                inner, now, rows = now is not None, (key, part), []
            rows.append(row)
            size += len(row[2])
            if len(rows) > MANY or size > PIECE and not inner:
                out += passed()
                rows, inner = [], False
            if size > PIECE:
                yield _table(out, _DONE)
                out, size = [], 0
    out += passed()
    yield _table(out, _DONE)


_SEGMENT = pa.schema([("key", pa.string()), ("part", pa.int32()), ("rows", pa.int64()), *((n, pa.int64()) for n in (
    "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")), ("first", pa.string()), ("last", pa.string()),
    ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
_SEGMENT_SQL = ("key string, part int, rows long, blank long, duplicate long, truncated long, illegal long, turns long, low long, "
                "high long, first string, last string, costs array<long>, audits array<string>")
_FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a segment; digests seen in earlier parts come first, without a place."""
    now, seg, out = None, Segment(set()), []

    def row() -> tuple:
        cells = parse(seg.codes)
        return (*now, len(seg.codes), *(getattr(seg, n) for n in _FIELDS), [None if c is None else c[0] for c in cells],
                [None if c is None else c[1] for c in cells])
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("key", "part", "place", "turn", "role", "digest", "live", "blank", "truncated")]
        for key, part, place, turn, role, digest, live, blank, truncated in zip(*columns, strict=True):
            if now != (key, part):
                if now is not None:
                    out.append(row())
                now, seg = (key, part), Segment(set())
            if place is None:
                seg.seen.add(digest)
            elif live:
                seg.add(turn, role, digest, blank, truncated)
        yield _table(out, _SEGMENT)
        out = []
    if now is not None:
        yield _table([row()], _SEGMENT)


_PLAN = pa.schema([("key", pa.string()), ("part", pa.int32()), ("before", pa.int64()), ("system", pa.bool_()), ("piece", pa.string()),
                   *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string())])
_PLAN_SQL = ("key string, part int, before long, system boolean, piece string, " + ", ".join(f"{c} long" for c in _COUNTS)
             + ", audit string")


def _joined_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order by conversation: a row of counts and audit (part -1), and a
    row for each segment with its piece of the audit."""
    now, segs = None, []

    def plan() -> list[tuple]:
        total = Segment(set())
        for s in segs:
            one = Segment(set())
            for n in _FIELDS:
                setattr(one, n, s[n])
            total.then(one)
        cost, audit = best(folded([tuple(None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"], strict=True))
                                   for s in segs]))
        system = starts_with_system(audit)
        out, before = [(now, -1, None, None, None, *total.counts(), cost, audit)], 0
        for s, piece in zip(segs, _shared(audit, [s["rows"] for s in segs]), strict=True):
            out.append((now, s["part"], before, system, piece, *[None] * 7))
            before += len(piece) - piece.count("D")
        return out
    for batch in batches:
        for s in batch.to_pylist():
            if s["key"] != now:
                if segs:
                    yield _table(plan(), _PLAN)
                now, segs = s["key"], []
            segs.append(s)
    if segs:
        yield _table(plan(), _PLAN)


_TEXT = pa.schema([("key", pa.string()), ("part", pa.int32()), ("place", pa.int64()), ("repaired", pa.string())])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a segment, its plan first (no place), to pieces of repaired text."""
    now, piece, at, before, system, held, place, size = None, "", 0, 0, False, [], 0, 0

    def upto() -> str:
        """Turns of the edits whose rows are held."""
        nonlocal at, before, held
        to, n = at, len(held)
        while to < len(piece) and (piece[to] == "I" or n > 0):
            n -= piece[to] != "I"
            to += 1
        turns = list(repaired(held, piece[at:to], before, system))
        text = "".join(("\n" if before + k else "") + t for k, t in enumerate(turns))
        at, held, before = to, [], before + len(turns)
        return text
    for batch in batches:
        out = []
        columns = [batch.column(n).to_pylist() for n in ("key", "part", "place", "role", "text", "live", "before", "system", "piece")]
        for key, part, p, role, text, live, b, s, a in zip(*columns, strict=True):
            if p is None:
                if now is not None:
                    out.append((*now, place, upto()))
                now, piece, at, before, system, held, place, size = (key, part), a, 0, b, s, [], 0, 0
            elif live:
                held.append((role, text))
                size += len(text)
                if size > PIECE:
                    out.append((*now, place, upto()))
                    place, size = place + 1, 0
        yield _table(out, _TEXT)
    if now is not None:
        yield _table([(*now, place, upto())], _TEXT)


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """turns: (conv_id, turn, role, text); rows that are not ``present`` only name
    their conversation. One row for each conversation that a task held whole:
    conv_id, gaps, n_blank, n_duplicate, n_truncated, n_illegal, cost, audit, repaired
    (``role:text`` of each turn, joined by newlines), part null. Of any other
    one row with repaired null and part -1, and its text in pieces: rows with conv_id,
    part, place (the order of the pieces) and repaired alone."""
    kind = turns.schema["conv_id"].dataType
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    bare = F.rtrim(text, F.lit(SPACE))
    live = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = turns.select(
        F.when(F.col("conv_id").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string"))).alias("key"),
        F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"), live.alias("live"),
        (bare == "").alias("blank"), ((bare != "") & ~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.left(text, F.lit(HEAD)).alias("head"))
    # the salt lets one row that repeats very often be in several parts
    order = ["key", "turn", "role", "head", "digest", "salt"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).drop("head")
    first = stored(placed.mapInArrow(_first_round, _DONE_SQL), "chat-parse")
    more = first.where("place is not null")

    seen = more.where("live").select("key", "part", "digest").distinct()
    earliest = seen.groupBy("key", "digest").agg(F.min("part").alias("earliest"))
    earlier = seen.join(earliest, ["key", "digest"]).where("part > earliest").select("key", "part", "digest")
    marks = earlier.select("key", "part", F.lit(None).cast("long").alias("place"), "digest")
    segments = (more.select("key", "part", "place", "turn", "role", "digest", "live", "blank", "truncated")
                .unionByName(marks, allowMissingColumns=True).repartition("part")
                .sortWithinPartitions("part", "key", "place").mapInArrow(_segments, _SEGMENT_SQL))
    plans = stored(segments.repartition("key").sortWithinPartitions("key", "part").mapInArrow(_joined_segments, _PLAN_SQL), "chat-plans")
    pieces = (more.select("key", "part", "place", "role", "text", "live")
              .unionByName(plans.where("part >= 0").select("key", "part", "before", "system", "piece"), allowMissingColumns=True)
              .repartition("part").sortWithinPartitions("part", "key", "place")
              .mapInArrow(_texts, "key string, part int, place long, repaired string"))
    counts = [F.col(c) for c in _COUNTS]
    out = (first.where("place is null").select("key", F.lit(None).cast("int").alias("part"), F.lit(None).cast("long").alias("place"),
                                               *counts, "audit", "repaired")
           .unionByName(plans.where("part < 0").select("key", "part", *counts, "audit"), allowMissingColumns=True)
           .unionByName(pieces, allowMissingColumns=True))
    return out.select(F.when(F.col("key") != "n", F.substr("key", F.lit(2))).cast(kind).alias("conv_id"), *out.columns[1:])


_HASHED = pa.schema([("conv_id", pa.string()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("sha256", pa.string())])


def hashed(repairs: DataFrame) -> DataFrame:
    """One row a conversation of ``repair``: conv_id, the counts, cost, audit, and the
    sha256 of the repaired text. Texts in pieces are hashed as they stream by in
    order, none is put together."""
    kind = repairs.schema["conv_id"].dataType
    one = repairs.where("part is null").select("conv_id", *_COUNTS, "audit", F.sha2("repaired", 256).alias("sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["part"] < 0:
                    if row is not None:
                        out.append((*row, digest.hexdigest()))
                    row, digest = (r["conv_id"], *(r[c] for c in _COUNTS), r["audit"]), hashlib.sha256()
                else:
                    digest.update(r["repaired"].encode())
            yield _table(out, _HASHED)
        if row is not None:
            yield _table([(*row, digest.hexdigest())], _HASHED)
    split = repairs.where("part is not null").withColumn("conv_id", F.col("conv_id").cast("string"))
    many = split.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").mapInArrow(
        run, "conv_id string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, sha256 string")
    return one.unionByName(many.withColumn("conv_id", F.col("conv_id").cast(kind)))
