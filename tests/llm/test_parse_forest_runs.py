"""Chat repair by CYK, nearest neighbours by a forest, and periodic runs against
brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("credence.llm")

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from credence.llm import chat_parse, periodic_runs, queries, vector_forest  # noqa: E402

WS = " \t\n\x0b\x0c\r"


# --- chat repair -----------------------------------------------------------------


def least(rows):
    """(cost, audit) of (initial, fault) rows by a walk over the legal roles; the
    costs are written out here."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(cells):
        grown = True
        while grown:
            grown = False
            for s, (cost, audit) in list(cells.items()):
                for x in "ua":
                    t = step.get((s, x))
                    if t and (t not in cells or (cost + 3, audit + "I") < cells[t]):
                        cells[t], grown = (cost + 3, audit + "I"), True
        return cells
    cells = inserted({"": (0, "")})
    for initial, fault in rows:
        after = {}
        for s, (cost, audit) in cells.items():
            ways = [(s, cost + 4, "D")]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                ways += [(step.get((s, initial)), cost + more, "K")] + [(step.get((s, x)), cost + 3 + more, "R") for x in "ua"]
            for t, c, e in ways:
                if t is not None and (t not in after or (c, audit + e) < after[t]):
                    after[t] = (c, audit + e)
        cells = inserted(after)
    return min(cells[s] for s in ("", "a") if s in cells)


def brute_repair(rows):
    """conv_id -> the columns of op11, of (conv_id, turn, role, text) rows."""
    talks = defaultdict(list)
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        talks[c] += [(t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for c, rs in talks.items():
        rs.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2][:64],
                               hashlib.sha256(f"{len(z[1])}:{z[1]}{z[2]}".encode()).digest()))
        seen, faults = set(), []
        for _, r, x in rs:
            bare = x.rstrip(WS)
            faults.append("blank" if not bare else "duplicate" if (r, x) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((r, x))
        turns = [t for t, _, _ in rs if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:], strict=False))
        cost, audit = least([(r[:1], f) for (_, r, _), f in zip(rs, faults, strict=True)])
        left, done = iter(rs), []
        for e in audit:
            _, r, x = (None, None, "") if e == "I" else next(left)
            if e != "D":
                r = r if e == "K" else "assistant" if done and done[-1].startswith("u") else "user"
                done.append(f"{r}:{x}")
        assert re.fullmatch("(s?(ua)+)?", "".join(d[0] for d in done))
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
                  illegal, cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest())
    return out


def repaired(df):
    rows = chat_parse.hashed(chat_parse.repair(queries.damaged(df), F.col("present"))).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


TALK = "conv_id long, turn long, role string, text string, key string, part int, place long, audit string"


def talks(spark, rows):
    """Rows with columns whose names clash with those used inside."""
    return spark.createDataFrame([(*r, "k", 1, 2, "a") for r in rows], TALK)


def some_talks():
    rng, rows = random.Random(3), []
    for c in [None, *range(120)]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, t, t, t + 1, None]),
                         rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool", "agent"]),
                         rng.choice(["Hi.", "ok", "", None, "  \n", "why?", "see\t", "a. b. ", "x" * 70 + ".", "x" * 70 + "y"])))
    for t in range(400):
        rows.append((7777, rng.choice([t, t, None]), rng.choice(["user", "assistant"]), rng.choice([f"t{t}.", "ok.", f"q{t % 50}"])))
    return rows + [(8888, 5, "user", "same.")] * 500 + [(9999, 1, "user", "word " * 60_000 + ".")]


@pytest.mark.parametrize(("many", "piece"), [(50_000, 1 << 22), (20, 100)])
def test_chat_parse_equals_brute_force(spark, monkeypatch, many, piece):
    """Also with conversations cut into many segments and pieces."""
    monkeypatch.setattr(chat_parse, "MANY", many)
    monkeypatch.setattr(chat_parse, "PIECE", piece)
    rows = some_talks()
    assert repaired(talks(spark, rows).repartition(5)) == brute_repair(rows)


def test_chat_parse_edges(spark):
    assert repaired(talks(spark, []).limit(0)) == {}
    nothing = hashlib.sha256(b"").hexdigest()
    absent = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert absent and set(repaired(talks(spark, absent)).values()) == {(0, 0, 0, 0, 0, 0, "", nothing)}
    named = spark.createDataFrame([("a", 1, "user", "Hi."), ("n", 1, "user", "Hi."), ("", 1, "user", "Hi."), (None, 1, "user", "Hi.")],
                                  "conv_id string, turn int, role string, text string")
    rows = chat_parse.repair(named).where("audit is not null").collect()
    assert sorted(str(r["conv_id"]) for r in rows) == ["", "None", "a", "n"] and {(r["cost"], r["audit"]) for r in rows} == {(3, "KI")}


def every_cut(codes):
    """CYK over all spans and all cuts."""
    cells = {(i, i + 1): chat_parse.of_row(c) for i, c in enumerate(codes)}
    for n in range(2, len(codes) + 1):
        for i in range(len(codes) - n + 1):
            ways = [chat_parse.joined(cells[i, k], cells[k, i + n]) for k in range(i + 1, i + n)]
            cells[i, i + n] = tuple(min((w[p] for w in ways if w[p]), default=None) for p in range(len(chat_parse.PAIRS)))
    return cells[0, len(codes)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["s", "u", "a", "o", "st", "ut", "at", "ot", "d"]), min_size=1, max_size=14))
def test_one_cut_of_a_span_is_enough(codes):
    assert chat_parse.parse(codes) == every_cut(codes)
    faults = {"d": "blank"} | {c + "t": "truncated" for c in "suao"}
    assert chat_parse.best(chat_parse.parse(codes)) == least([(c[0], faults.get(c, "")) for c in codes])


# --- nearest neighbours -----------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, 0, 1, "x") for i, x in rows], "vec_id long, embedding array<float>, label int, row long, x string")


def brute_nearest(rows, k):
    """Sorted (query_id, rank, vec_id, score) over all rows but the query's own."""
    good = [(i, np.array(x, "f4").astype(float)) for i, x in rows
            if i is not None and x and None not in x and np.isfinite(x).all() and np.any(x)]
    width = max((len(x) for _, x in good), default=0)
    good = [(i, np.pad(x, (0, width - len(x)))) for i, x in good]
    out = []
    for n, (i, q) in enumerate(good):
        if i % 50 == 0:
            s = sorted((-round(float(q @ x / np.linalg.norm(q) / np.linalg.norm(x)), 9), j) for m, (j, x) in enumerate(good) if m != n)
            out += [(i, r + 1, j, -d) for r, (d, j) in enumerate(s[:k])]
    return sorted(out)


def found(df, **options):
    rows = vector_forest.nearest(df, F.col("vec_id") % 50 == 0, **options).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in rows)


@pytest.mark.parametrize("block", [16_384, 7])
def test_forest_finds_near_neighbours(spark, monkeypatch, block):
    """In groups of near vectors a small part of the table is enough."""
    monkeypatch.setattr(vector_forest, "LEAF", 12)
    monkeypatch.setattr(vector_forest, "BLOCK", block)
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(60, 24))
    rows = [(i, (middles[i % 60] + 0.2 * rng.normal(size=24)).astype("f4").tolist()) for i in range(1500)]
    want = brute_nearest(rows, 5)
    got = found(vectors(spark, rows), budget=200)
    pairs = {(q, v) for q, _, v, _ in want}
    assert len(pairs & {(q, v) for q, _, v, _ in got}) >= 0.95 * len(pairs)
    scores = {(q, v): s for q, _, v, s in brute_nearest(rows, 1500)}
    assert all(abs(scores[q, v] - s) < 2e-9 for q, _, v, s in got)
    by_query = defaultdict(list)
    for q, r, v, s in got:
        by_query[q].append((r, -s, v))
    assert all([r for r, _, _ in x] == [1, 2, 3, 4, 5] and [y[1:] for y in x] == sorted(y[1:] for y in x) for x in by_query.values())


def test_forest_measures_what_to_read(spark, monkeypatch):
    """On vectors without structure the measured budget keeps the recall."""
    monkeypatch.setattr(vector_forest, "LEAF", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).astype("f4").tolist()) for i in range(2500)]
    want = {(q, v) for q, _, v, _ in brute_nearest(rows, 5)}
    got = {(q, v) for q, _, v, _ in found(vectors(spark, rows))}
    assert len(want & got) >= 0.9 * len(want)


def test_forest_is_exact_where_all_is_read(spark):
    """Ties, repeated ids, repeated rows, and vectors that take no part."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-2, 3, 3).astype(float).tolist()) for i in range(260)]
    rows += [(50, [1.0, 0.0, 0.0]), (50, [1.0, 0.0, 0.0]), (51, [1.0, 0.0, 0.0]), (100, [2.0, 1.0]), (3, [2.0, 1.0, 0.0])]
    rows += [(300, None), (350, [None, 1.0]), (400, [0.0, 0.0, 0.0]), (450, [float("nan"), 1.0]), (None, [1.0, 1.0]), (500, []),
             (550, [float("inf"), 0.0])]
    rows += [(1000, [1.0, 2.0, 2.0])] * 300
    assert found(vectors(spark, rows)) == brute_nearest(rows, 5)
    huge = spark.createDataFrame([(0, [1e300, 1e300]), (1, [3e-300, 3e-300]), (2, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r[1], r[2]) for r in found(huge)] == [(1, 1), (2, 2)]
    assert found(vectors(spark, rows[:1])) == [] and found(vectors(spark, rows).limit(0)) == []


# --- periodic runs ------------------------------------------------------------------


def brute_runs(w):
    """(start, length, period): every period tried at every place."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i > start and i - start + q >= max(6, 4 * q):
                out.setdefault((start, i - start + q), q)
            i += i == start
    return sorted((s, length, q) for (s, length), q in out.items())


def repetitive(rng, letters):
    w = []
    for _ in range(rng.randrange(4)):
        a = [rng.randrange(letters) for _ in range(rng.randrange(1, 18))]
        if rng.random() < 0.5:
            a = (a * rng.randrange(1, 7) + [rng.randrange(letters) for _ in range(rng.randrange(4))]) * rng.randrange(1, 7)
        w += (a * rng.randrange(1, 9))[: rng.randrange(1, 200)] + [rng.randrange(letters) for _ in range(rng.randrange(3))]
    return w


def as_tuples(found):
    return list(zip(*(x.tolist() for x in found), strict=True))


@pytest.mark.parametrize("letters", [1, 2, 3, 10])
def test_runs_equal_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(150):
        texts = [repetitive(rng, letters) for _ in range(rng.randrange(1, 6))]
        got = periodic_runs.find_runs(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts], np.int64))
        want, at = [], 0
        for t in texts:
            want += [(s + at, n, q) for s, n, q in brute_runs(t)]
            at += len(t)
        assert sorted(as_tuples(got)) == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90))
def test_runs_of_any_words(w):
    got = periodic_runs.find_runs(np.array(w, np.int64), np.array([len(w)], np.int64))
    assert sorted(as_tuples(got)) == brute_runs(w)


def test_wavelet_tree():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 64, 333):
        values = rng.permutation(n)
        tree = periodic_runs.WaveletTree(values)
        low = rng.integers(0, n, 200)
        high = low + rng.integers(0, n - low + 1)
        at, below = rng.integers(0, n + 3, 200), rng.integers(0, n + 3, 200)
        got = np.stack(tree.successors(low, high, at, below, 3), 1)
        for i in range(200):
            want = sorted(v for v in values[low[i]:high[i]] if at[i] <= v < below[i])[:3]
            assert got[i].tolist() == want + [-1] * (3 - len(want))


def test_periodic_runs_of_documents(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH", 50)
    rng = random.Random(8)
    texts = [" ".join(f"w{x}" for x in repetitive(rng, 3)) for _ in range(40)]
    texts += [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "é é é é\né é\té é é é  é é z",
              "the long tale goes on " * 20_000, "x" * 100_000, texts[0], texts[0]]
    ids = [*range(len(texts) - 3), 0, 0, None]
    df = spark.createDataFrame([(i, t, 1, "r", "c") for i, t in zip(ids, texts, strict=True)],
                               "doc_id long, text string, n int, runs string, collapsed string")
    got = sorted((str(r["doc_id"]), [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.periodic_runs(df).collect())
    want = []
    for i, t in zip(ids, texts, strict=True):
        w = (t or "").encode().split()
        runs = [(0, 100_000, 5)] if len(w) == 100_000 else brute_runs(w)
        gone = {j for s, n, q in runs for j in range(s + q, s + n)}
        want.append((str(i), runs, b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    assert got == sorted(want)
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0
    best = periodic_runs.periodic_runs(df).select(periodic_runs.longest(F.col("runs")).alias("b"), "runs").collect()
    for r in best:
        runs = [tuple(x) for x in r["runs"]]
        assert (tuple(r["b"]) if r["b"] else None) == (min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None)


def test_planted_runs(spark):
    """The query's input: the words of one row in ten repeat."""
    words = [f"w{i}" for i in range(97)]
    df = spark.createDataFrame([(i, " ".join(words[: i % 98])) for i in range(400)] + [(None, "a b")], "doc_id long, text string")
    for r in queries.with_planted_runs(df).collect():
        if r["doc_id"] is None:
            assert r["text"] == "a b"
            continue
        w = words[: r["doc_id"] % 98]
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert r["text"].split() == w
