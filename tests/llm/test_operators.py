"""Operators of credence.llm against brute force, the libraries they must
equal, round trips and held-out accuracy; and their edge cases."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("credence.llm")

import public_tokenizers as P  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from credence.llm import (  # noqa: E402
    byte_bpe,
    chat_repair,
    components,
    decontaminate,
    id_files,
    minhash,
    queries,
    sharding,
    site_text,
    token_counts,
    toxicity,
    vector_search,
)

RANKS, WORDS, PIECES = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, h1 int, node string"
TEXTS = ["", None, "  \t\n", "Hello, World! it's 3 o'clock\n\n  two  lines ", "a", "naïve Ünïcode çé 漢字 🙂",
         "<|endoftext|> isn't", "x" * 3000, "word " * 4000, "word " * 4000, "\x1c\x85  odd spaces\r\n"]


def docs(spark, texts, ids=None):
    """Rows with columns whose names clash with those used inside."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 0, 0.5, "x", 1, "n") for i, t in zip(ids, texts, strict=True)], DOCS)


def sets(text, width):
    w = [x for x in (text or "").encode().lower().split()]
    return {tuple(w[i: i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_components(texts, width, per_100):
    s = [sets(t, width) for t in texts]
    root = list(range(len(s)))
    for a, b in itertools.combinations(range(len(s)), 2):
        both = len(s[a] & s[b])
        if s[a] and s[b] and 100 * both >= per_100 * len(s[a] | s[b]):
            ra, rb = root[a], root[b]
            root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    return root, [len(x) for x in s]


def test_sharding(spark):
    names = [f"n{i}" for i in range(5)]
    got = {r["slot"]: r["shard"] for r in sharding.lookup_table(spark, names, 101).collect()}

    def number(x):
        return int(hashlib.md5(x.encode()).hexdigest()[:15], 16)
    slots, places = [None] * 101, [0] * 5
    for turn in range(101):
        n = names[turn % 5]
        o, k = number(n + "#offset") % 101, number(n + "#skip") % 100 + 1
        while slots[(o + places[turn % 5] * k) % 101] is not None:
            places[turn % 5] += 1
        slots[(o + places[turn % 5] * k) % 101] = n
    assert [got[i] for i in range(101)] == slots
    counts = [slots.count(n) for n in names]
    assert max(counts) - min(counts) <= 1
    df = docs(spark, ["a", "b", "c"], [None, 7, 7])
    rows = sharding.assign(df, "doc_id", names, 101).collect()
    assert len(rows) == 3 and all(r["shard"] == slots[r["slot"]] for r in rows)
    assert sharding.assign(df.limit(0), "doc_id").count() == 0
    for bad in (["a", "a"], []):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, bad, 101)
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, names, 100)


def corpus(seed):
    """Bases with chains and stars of edited copies, near and below threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for n in (3, 6, 7, 12, 40, 80, 200):
        base = rng.choices(vocabulary, k=n)
        for _ in range(14):
            t = list(base)
            for _ in range(rng.randrange(0, max(2, n // 14))):
                t[rng.randrange(n)] = rng.choice(vocabulary)
            texts.append(" ".join(t))
            if rng.random() < 0.4:
                base = t
    line = " ".join(rng.choices(vocabulary, k=30))
    texts += [line + " " + " ".join(rng.choices(vocabulary, k=20)) for _ in range(15)]
    return [*texts, "", None, "w1", "w1", "W1 w2", "w1 w2"]


@pytest.mark.parametrize(("width", "per_100", "block"), [(3, 85, 256), (3, 85, 4), (5, 80, 256)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, width, per_100, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = corpus(width + block)
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(docs(spark, texts).repartition(3), width, per_100).collect()}
    root, size = brute_components(texts, width, per_100)
    assert [rows[i]["n_shingles"] for i in range(len(texts))] == size
    assert [rows[i]["component_id"] for i in range(len(texts))] == root
    assert all(r["kept"] == (i == root[i]) for i, r in rows.items())


def test_near_duplicates_edges(spark):
    df = docs(spark, ["a b c d", "a b c d", "a b c d", None, ""], [5, 5, None, None, 9])
    rows = minhash.near_duplicates(df, 3, 85).collect()
    assert len(rows) == 5
    assert sorted(str((r["doc_id"], r["component_id"], r["kept"])) for r in rows) == sorted(map(str, [
        (5, 5, True), (5, 5, True), (None, 5, False), (None, None, True), (9, 9, True)]))
    assert minhash.near_duplicates(df.limit(0), 3, 85).count() == 0
    kept = minhash.keep_one(df, 3, 85)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "9", "None"]


def test_keep_one_decides_by_row(spark):
    a, b, c = ("".join(f" {x}{i}" for i in range(40)) for x in "abc")
    rows = [(0, b), (1, a), (1, b + " end"), (2, c), (2, c + " end"), (2, c), (3, a + " end"), (4, ""), (4, None), (4, a)]
    kept = minhash.keep_one(docs(spark, [t for _, t in rows], [i for i, _ in rows]), 3, 85).collect()
    got = sorted((r["doc_id"], (r["text"] or "")[:2]) for r in kept)
    assert got == [(0, " b"), (1, " a"), (2, " c"), (4, ""), (4, "")]


def test_keep_one_of_rows_without_id(spark):
    a, b = ("".join(f" {x}{i}" for i in range(40)) for x in "ab")
    rows = [(None, a), (None, a), (None, a + " end"), (3, b), (None, b), (None, b + " end"), (None, ""), (None, None), (None, "")]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows]).withColumnsRenamed({"h1": "_digest", "node": "_rep"})
    kept = minhash.keep_one(df, 3, 85)
    assert kept.columns == df.columns
    got = kept.collect()
    assert sorted((str(r["doc_id"]), (r["text"] or "")[:2]) for r in got) == [
        ("3", " b"), ("None", ""), ("None", ""), ("None", ""), ("None", " a")]
    assert {(r["_digest"], r["_rep"]) for r in got} == {(1, "n")}


@pytest.mark.parametrize("block", [256, 4])
def test_long_texts_are_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    long = " ".join(f"w{i}" for i in range(60_000))
    texts = [long, long + " end", "x" * 200_000, long.replace("w1", "v1"), *["a b c d e f g"] * 30]
    rows = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs(spark, texts), 3, 85).collect()}
    assert rows == {0: 0, 1: 0, 2: 2, 3: 3} | {i: 4 for i in range(4, 34)}


def test_match_threshold():
    assert minhash.match_threshold(0.85) < 0.85 * minhash.K
    assert minhash.match_threshold(0.999999) > minhash.match_threshold(0.8)


def test_large_groups_are_confirmed_densely():
    rng = np.random.default_rng(3)
    base = rng.choice(1 << 40, 300, replace=False).astype(np.uint64)
    some = [np.unique(np.concatenate([base[rng.random(300) > 0.05], rng.integers(0, 1 << 40, 9).astype(np.uint64)]))
            for _ in range(40)]
    sigs = np.stack([minhash.signature(s) for s in some])
    links = minhash._linked(some, sigs, np.zeros(40, int), False, 1, 85)
    root = list(range(40))
    for a, b in itertools.combinations(range(40), 2):
        if 100 * len(np.intersect1d(some[a], some[b])) >= 85 * len(np.union1d(some[a], some[b])):
            ra, rb = root[a], root[b]
            root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    mine = list(range(40))
    for a, b in links:
        ra, rb = mine[a], mine[b]
        mine = [min(ra, rb) if r in (ra, rb) else r for r in mine]
    assert mine == root and len(links) == 40 - len(set(root))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)] + [(500, i) for i in range(501, 540)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100} | {i: 500 for i in range(500, 540)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def unigram():
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(token_counts.load_vocabulary(PIECES), 0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return t


def test_token_counts(spark, sf):
    whole = unigram()
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    rows = {r["doc_id"]: r for r in token_counts.count_tokens(docs(spark, texts), PIECES).collect()}
    assert [rows[i]["n_tokens"] for i in range(len(texts))] == [len(whole.encode(t or "").ids) for t in texts]
    assert token_counts.count_tokens(docs(spark, texts).limit(0), PIECES).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab th\n\n▁  é漢͸\U000f0000<>unk."), max_size=30))
def test_token_counts_of_any_text(text):
    if not hasattr(test_token_counts_of_any_text, "both"):
        test_token_counts_of_any_text.both = unigram(), token_counts.Counter(token_counts.load_vocabulary(PIECES))
    whole, counter = test_token_counts_of_any_text.both
    assert counter.text(text)[1] == len(whole.encode(text).ids)


def tiktoken_whole():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})


def test_byte_bpe(spark, sf, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 20_000)
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = docs(spark, texts, [None, *range(1, len(texts))])
    enc = tiktoken_whole()
    rows = {r["doc_id"] or 0: r for r in byte_bpe.round_trip(df, RANKS, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS).collect()
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in back} == {
        (i or None): t or "" for i, t in enumerate(texts)}
    assert byte_bpe.round_trip(df.limit(0), RANKS, P.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r'sdre.,1a  \x1c\x85"), st.characters(exclude_categories=["Cs"])), max_size=20))
def test_words_part_where_the_pattern_does(text):
    import regex

    assert [m for w in byte_bpe.WORD.findall(text) for m in regex.findall(P.PATTERN, w)] == regex.findall(P.PATTERN, text)


def test_words_that_do_not_come_back_are_encoded_on_the_spot():
    class Held:
        value = byte_bpe.load_ranks(RANKS)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["to be or not", "to be"]})
    rows = list(byte_bpe._doc_rows(4)([batch]))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    out = list(byte_bpe._reassembled(4, Held, P.PATTERN, lambda i: (i.astype(np.int32),), schema)(rows))
    enc = tiktoken_whole()
    assert [x for b in out for x in b.column(1).to_pylist()] == [enc.encode_ordinary(t) for t in ("to be or not", "to be")]


def brute_repair(roles):
    """Least cost, the table written out: keep 0, relabel 2, merge into the turn
    before 1 more, an empty turn before it 3 more."""
    after = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    best = {"": 0}
    for r in roles:
        new = {}
        for s, c in best.items():
            for t in ("system", "user", "assistant"):
                change = 0 if t == r else 2
                ways = [change] * (t in after[s]) + [1 + change] * (t == s) + [3 + change for mid in after[s] if t in after[mid]]
                if ways:
                    new[t] = min(new.get(t, 1e9), c + min(ways))
        best = new
    return min(best.values())


def legal(roles):
    state = chat_repair.START
    for r in roles:
        if chat_repair.ROLES.index(r) + 1 not in chat_repair.NEXT[state]:
            return False
        state = chat_repair.ROLES.index(r) + 1
    return True


def test_chat_repair(spark):
    rng = random.Random(5)
    rows, lengths = [], [1, 2, 3, 5, 8, 400, 900]
    for c, n in enumerate(lengths * 6):
        rows += [(c if c else None, k, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(["hi", None, "x y"]), "z")
                 for k in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string").repartition(7)
    got = {}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else this little is one part
    try:
        repaired = chat_repair.repair(df).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for r in repaired:
        got.setdefault(r["conv_id"], []).append(r)
    parts = 0
    for c in {r[0] for r in rows}:
        mine = sorted(got[c], key=lambda r: r["place"])
        parts += len({r["place"] >> 33 for r in mine}) > 1
        said = [r for cc, k, r, _, _ in rows if cc == c]
        assert [r["turn"] for r in mine] == list(range(len(said)))
        assert sum(r["cost"] for r in mine) == brute_repair(said)
        sequence = []
        for r in mine:
            if r["inserted"]:
                sequence.append(r["inserted"])
            if not r["action"].endswith("merge"):
                sequence.append(r["role"])
        assert legal(sequence)
        text = "".join(r["rendered"] for r in mine)
        assert text.count("<|im_start|>") == text.count("<|im_end|>") == len(sequence)
        assert text.endswith("<|im_end|>\n")
    assert parts, "no conversation crossed a border"
    assert chat_repair.repair(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", [1, 8])
def test_planes_round_trip(kind, tmp_path):
    import pyarrow.fs as pafs

    rng = np.random.default_rng(1)
    wanted = [(None if i == 0 else i, rng.integers(0, 1 << 32, n, dtype=np.uint32)) for i, n in enumerate([0, 1, 7, 100, 5, 64, 0, 3])]
    fs = pafs.LocalFileSystem()
    writer = id_files.Writer(fs.open_output_stream(str(tmp_path / "f"), compression=None), kind, block=16)
    for doc, ids in wanted:
        writer.add(doc, ids)
    writer.close()
    with fs.open_input_file(str(tmp_path / "f")) as f:
        got = list(id_files.Reader(f).documents())
    assert [(d, i.tolist()) for d, i in got] == [(d, i.tolist()) for d, i in wanted]


ENCODER = id_files.WordEncoder(open(WORDS, encoding="utf-8").read())
SIGNS = [*"ab1ZISJé.,;:!?-#$%&@_|<>'\"’ \t", "İ", "ẞ", "ǰ", "क़", "ড়", "ख", "़", "\u0307", "\u0301", "\u200d", "\u00ad", "½", "Ⅷ", "٣", "漢", "각", "ᄀ",
         "ᅡ", "ᆨ", "ﬁ", "🙂", "\ufe0f", "<|endoftext|>", "<|startoftext|>", "<|", "|>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(SIGNS), max_size=12).map("".join), st.text(max_size=12)), max_size=6))
def test_words_are_encoded_as_by_the_library(texts):
    want = [ENCODER.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in ENCODER(texts)] == want


def test_letters_before_marks():
    """Each letter that normalising takes apart, before each mark."""
    letters = [chr(c) for c in range(0x30000) if chr(c).isalnum() and len(ENCODER.tokenizer.normalizer.normalize_str(chr(c))) > 1]
    texts = [c + mark for c in letters for mark in ".?"] + ["x" + c + ",;" for c in letters]
    want = [x.ids + [2] for x in ENCODER.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert len(letters) > 50 and [np.frombuffer(x, "<u4").tolist() for x in ENCODER(texts)] == want


def test_id_files(spark, sf):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    texts = TEXTS + ["'s 's. it's.,; a'. 5.?!", "ΑΣ. ΑΣ, İstanbul. ß", "x.'s a.b", "<|startoftext|>.,", "é. Å."] + [
        r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(80).collect()]
    ids = [None, *range(1, len(texts))]
    order = sorted(range(len(texts)), key=lambda i: (ids[i] is not None, ids[i] or 0))
    rows = {r["doc_id"]: r for r in id_files.write_and_read(docs(spark, texts, ids).repartition(4), WORDS).collect()}
    start = 0
    for i in order:
        want = [*whole.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        r = rows[ids[i]]
        assert (r["start"], r["n_tokens"]) == (start, len(want)), texts[i]
        assert r["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes()), texts[i]
        start += len(want)
    same = id_files.write_and_read(docs(spark, ["a b", "a b", "c"], [4, 4, 4]), WORDS).collect()
    assert len(same) == 3 and len({r["start"] for r in same}) == 3
    assert id_files.write_and_read(docs(spark, texts, ids).limit(0), WORDS).count() == 0


def brute_hits(text, items, size=10):
    import re

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans(decontaminate.ascii_lower.__globals__["UPPER"], decontaminate.ascii_lower.__globals__["LOWER"])))
    d, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        k = min(len(w), size)
        wins = {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(d) - k + 1) if wins else ():
            if tuple(d[i: i + k]) in wins:
                hit.update(range(i, i + k))
                found.add(item)
    return len(d), len(hit), found - {None}


def test_decontamination(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["é漢", "X9"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 9, 10, 11, 30])))) for i in range(12)]
    items += [(3, items[0][1]), (None, items[5][1]), (50, None), (51, " ,. "), (52, items[7][1].upper())]
    texts = ["", None, "...", "w1"]
    for _ in range(60):
        t = rng.choices(vocabulary, k=rng.randrange(1, 120))
        for _ in range(rng.randrange(3)):
            w = rng.choice(items[:12])[1].split()
            a = rng.randrange(len(w))
            t[rng.randrange(len(t)):0] = w[a: a + rng.choice([9, 10, 15, 30])]
        texts.append(rng.choice([" ", ", ", "\n"]).join(t))
    texts.append(texts[-1])
    bench = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, window string")
    df = docs(spark, texts, [*range(len(texts) - 1), len(texts) - 2])
    hits = decontaminate.find_hits(df, bench).select("*", decontaminate.covered(queries.F.col("spans")).alias("n")).collect()
    assert len(hits) == len(texts)
    for r in hits:
        n, hit, found = brute_hits(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n"], r["items"]) == (n, hit, sorted(map(str, found)))
    clean = {i for i, t in enumerate(texts) if not brute_hits(t, items)[1]}
    kept = decontaminate.drop_contaminated(df.withColumn("doc_id", queries.F.expr("nullif(doc_id, 0)")), bench)
    assert {r["doc_id"] or 0 for r in kept.collect()} == clean and kept.columns == df.columns
    assert decontaminate.find_hits(df, bench.limit(0)).where("size(spans) > 0").count() == 0
    assert decontaminate.find_hits(df.limit(0), bench).count() == 0
    cut = {r["doc_id"]: r["text"].split() for r in decontaminate.cut_spans(df, bench).collect()}
    assert all(len(cut[i]) == brute_hits(t, items)[0] - brute_hits(t, items)[1] for i, t in enumerate(texts[:-1]))


def test_vector_search(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "VECTOR_BLOCK", 64)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 0.1 if i % 9 else 3, 8), 2)], 1) for i in range(500)]
    rows += [(600, None, 1), (650, [1.0, None], 1), (700, [float("nan")] * 8, 1), (750, [float("inf")] * 8, 1), (800, [], 1),
             (None, [9.0] * 8, 1), (850, [3.0], 1), (900, rows[3][1], 1), (3, rows[3][1], 1), (950, [1e17] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    x = df.select("vec_id", vector_search.whole("embedding").alias("x"), "score")
    asks = F.col("vec_id") % 50 == 0
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vector_search.top_k(x, asks).collect())
    part = [(i, [int(np.floor(256 * v)) for v in e]) for i, e, _ in rows
            if i is not None and e is not None and all(v is not None and np.isfinite(v) for v in e)]
    assert got == brute_top_k(part, 50, 5)
    few = x.where("vec_id in (0, 1, 2)")
    assert vector_search.top_k(few, F.lit(True)).count() == 6
    assert vector_search.top_k(x.limit(0), asks).count() == 0


def brute_top_k(rows, step, k):
    """All rows but the query's own are scored."""
    limit, out = 2**63, []
    for n, (q, v) in enumerate(rows):
        if q % step == 0:
            scores = sorted((-max(-limit, min(limit - 1, sum(a * b for a, b in zip(v, w, strict=False)))), i)
                            for m, (i, w) in enumerate(rows) if m != n)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_vector_search_keeps_rows_that_repeat(spark, monkeypatch):
    """An id, or an id and its vector."""
    monkeypatch.setattr(vector_search, "VECTOR_BLOCK", 8)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 2)
    rng = random.Random(5)
    rows = [(i % 30, [rng.randrange(-9, 10) for _ in range(3)]) for i in range(90)]
    rows += [(7, [9, 9, 9])] * 3 + [(20, [9, 9, 8])] * 2 + [(8, [9, 9, 9]), (8, [9, 8, 9])]
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"])
                 for r in vector_search.top_k(df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute_top_k(rows, 10, 5)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p><article>";</script></head><body>
<header class="top">Site</header><nav><ul><li><a href=/>Home</a><li>More</ul></nav><div class="cookie-notice">Cookies!</div>
<!-- <p>gone</p> --><div class="ad">Buy</div><aside>Side</aside><article><h1>Head &amp; more</h1><p><b>First   line<br>
goes on.</b><p>Second &lt;b&gt; caf&eacute; &#8217;<i>x</i>y<form><input value=1>Sign up</form><ul><li>one<li>two</ul>
<section class="comments"><p>Me first</section></article><footer>&copy; Us</footer>"""


def test_site_text(spark):
    assert site_text.main_text(PAGE) == "Head & more\nFirst line\ngoes on.\nSecond <b> café ’xy\none\ntwo"
    plain = ("<html><body><div class=x><p>Same words every time</p></div><div class=main><p>Story {0} of {0}</p><p>and {0} more"
             "</div></body></html>")
    pages = [(i, "https://h.example/%d" % i, plain.format(i), "t") for i in range(30)]
    pages += [(90, None, None, "t"), (91, "http://[bad", "", "t"), (92, "x", "just text & more < this", "t"), (93, "x", PAGE, "t"),
              (93, "x", PAGE, "t"), (None, "u", "<p>a<p>b", "t"), (94, "v", "<p>" + "long " * 50_000, "t")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    rows = site_text.extract(df).collect()
    assert len(rows) == len(pages)
    got = {r["page_id"]: r["text"] for r in rows}
    assert [got[i] for i in range(30)] == [f"Story {i} of {i}\nand {i} more" for i in range(30)]
    assert got[90] == got[91] == "" and got[92] == "just text & more < this" and got[None] == "a\nb"
    assert len(got[94]) == 5 * 50_000 - 1 and all(r["n_chars"] == len(r["text"]) for r in rows)
    copies = spark.createDataFrame([(i, "https://c.example/", PAGE) for i in range(40)], "page_id long, url string, html string")
    assert {r["text"] for r in site_text.extract(copies).collect()} == {site_text.main_text(PAGE)}
    assert site_text.extract(df.limit(0)).count() == 0


def test_site_text_drops_a_repeated_box_inside_articles(spark):
    page = ("<html><body><article><h1>Title {0}</h1><p>Story {0}, <em>not</em> told<br>before</p><div class=box><p>The same words "
            "in every article</p></div><p>End of {0}</p></article></body></html>")
    pages = [(i, "https://h.example/%d" % i, page.format(i)) for i in range(20)]
    # copies of one article outnumber the others of their host, under titles of their own and surrounded by other words
    copied = "<html><body><div>{0}</div><article><h1>News</h1><p>One and the same story</p></article></body></html>"
    pages += [(100 + i, "https://c.example/", copied.format(i)) for i in range(60)]
    pages += [(200 + i, "https://c.example/", copied.replace("the same", f"{i}. other").format(i)) for i in range(9)]
    pages += [(300 + i, "https://n.example/", copied.replace("News", f"News {i}").format(i)) for i in range(20)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in site_text.extract(df).collect()}
    assert [got[i] for i in range(20)] == [f"Title {i}\nStory {i}, not told\nbefore\nEnd of {i}" for i in range(20)]
    assert all(got[100 + i].endswith("One and the same story") for i in range(60))
    assert all(got[200 + i].endswith(f"One and {i}. other story") for i in range(9))
    assert [got[300 + i] for i in range(20)] == [f"News {i}\nOne and the same story" for i in range(20)]


def test_site_text_keeps_a_main_beside_article_cards():
    body = "<h1>Title</h1><p>Lead</p><p>" + "The whole story. " * 5 + "</p>"
    story = "Title\nLead\n" + ("The whole story. " * 5).strip()
    card = "<article><p>Read this too</p></article>"
    assert site_text.main_text(f"<main>{body}{card}</main>") == story + "\nRead this too"
    assert site_text.main_text(f"<main>Filter<article>{body}</article></main>") == story
    assert site_text.main_text(f"<main>{body}</main><main>{card}</main>") == story + "\nRead this too"
    assert site_text.main_text(f"<article>{body}</article><main>{card}</main>") == story + "\nRead this too"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh(rng)
    net.w = {k: v.astype(np.float64) * (20 if k in ("word", "char") else 1) for k, v in net.w.items()}
    feats = toxicity.Features([b"ab", b"idiot", "çé漢".encode(), b"x"])
    x = np.vstack([np.zeros((1, 16)), rng.normal(0, 1, (4, 16))])
    index, y = np.array([[1, 2, 3, 0], [4, 1, 0, 0]]), np.array([1.0, 0.0])

    def loss():
        p = net.forward(net.projected(x), index)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
    tape = {}
    net.forward(net.projected(x), index, tape)
    grads, dx = net.gradients(x, tape, y, np.ones(2))
    assert len(feats) == 4
    for name, g in [*grads.items(), ("x", dx)]:
        w = x if name == "x" else net.w[name]
        for at in [tuple(rng.integers(0, s) for s in w.shape) for _ in range(4)]:
            if name == "x" and at[0] == 0:
                continue
            old = w[at]
            w[at] = old + 1e-3
            up = loss()
            w[at] = old - 1e-3
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-3 - g[at]) < 0.02 * max(0.2, abs(g[at])), name


def test_toxicity(spark):
    rng = random.Random(1)
    vocabulary = [f"{a}{b}" for a in ("tion", "ver", "ion", "ment", "and") for b in ("as", "el", "or", "um", "ix", "os")]
    texts, toxic = [], []
    for i in range(700):
        t = rng.choices(vocabulary, k=rng.randrange(3, 200))
        toxic.append(int(i % 4 == 0))
        if toxic[-1]:
            t.insert(rng.randrange(len(t)), rng.choice(["idiot", "Scum", "zorb" + rng.choice(["a", "ik", "ent"])]))
        texts.append(" ".join(t))
    labels = spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)] + [(None, 1, 1), (3, 0, None)],
                                   "doc_id long, quality int, toxic int")
    extra = ["", None, "...", "fine " * 20_000 + "idiot", "zorbix tionas"]
    df = docs(spark, texts + extra, [*range(700), 1000, 1001, 1002, 1003, None])
    rows = {r["doc_id"]: r for r in toxicity.toxicity(df, labels).collect()}
    out = [i for i in range(700) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(rows[i]["held_out"] == (i in out) for i in range(700)) and not rows[None]["held_out"]
    assert np.mean([rows[i]["predicted"] == toxic[i] for i in out]) >= 0.97
    assert rows[1000]["score"] == rows[1001]["score"] == rows[1002]["score"]
    assert rows[1003]["predicted"] == 1, "a word far from the start counts"
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    kept = toxicity.drop_toxic(df, df, labels)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if not r["predicted"]}
    assert toxicity.toxicity(df.limit(0), labels.limit(0)).count() == 0
    assert all(r["predicted"] == 0 for r in toxicity.toxicity(df, labels.limit(0)).collect())


def test_a_passage_of_half_a_window_lies_in_one_window():
    half = toxicity.WINDOW // 2
    for n in (half, 200, 333):
        windows = [range(s, s + toxicity.WINDOW) for s in toxicity.window_starts(n)]
        assert all(any(at in w and at + half - 1 in w for w in windows) for at in range(n - half + 1))


def test_a_repeated_id_is_one_labelled_row(spark):
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 4 != 2][:3]
    df = docs(spark, ["one", "two", *(f"again {i}" for i in range(300)), None], [*ids, *ids[2:] * 300])
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    assert sorted(r["doc_id"] for r in toxicity.labelled_sample(df, labels).collect()) == ids


def test_pipeline(spark, sf):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    kept = spark.read.parquet(f"{sf}/documents.parquet")
    columns = kept.columns
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    enc = tiktoken_whole()
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in kept.select("doc_id", "text").collect()} if "text" in kept.columns else {}
        kept = corpus_pipeline.stored(stage(spark, kept, sf), "test-" + name)
        after = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert after and after <= set(before)
        if name == "near_duplicates":
            ids = sorted(before)
            root, _ = brute_components([before[i] for i in ids], 5, 80)
            assert after == {ids[r] for r in root}
        elif name == "decontamination":
            assert after == {i for i, t in before.items() if not brute_hits(t, bench)[1]}
        elif name == "byte_bpe":
            assert {r["doc_id"]: r["ids"] for r in kept.collect()} == {i: enc.encode_ordinary(t) for i, t in before.items()}
        if name != "byte_bpe":
            assert kept.columns == columns


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(queries.ORACLES[name])
    names = [c[0] for c in cur.description]
    want = sorted(tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall())
    df = queries.QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in sorted(names)) for r in df.collect()) == want


def pipeline_folder(spark, sf, tmp_path, documents):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_pipeline_of_odd_rows(spark, sf, tmp_path):
    """Nulls, empty and long texts, repeated rows and ids, clashing columns."""
    import corpus_pipeline

    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 80").first()["text"]
    plain = [" ".join(f"{w}{i}" for i in range(60)) for w in ("river", "stone", "cloud", "lamp")]
    rows = [(900_001, plain[0]), (900_002, plain[0] + " end"), (900_002, plain[1]), (900_003, plain[1]), (None, plain[1]), (None, plain[2]),
            (None, plain[2]), (900_004, plain[3] + " " + item), (900_005, " ".join(f"meadow{i % 60}" for i in range(42_000))),
            (900_006, ""), (900_006, ""), (900_007, None), (None, None), (None, "")]
    odd = spark.createDataFrame([(i, t, "d", "r", "k", 0.5) for i, t in rows],
                                "doc_id long, text string, _digest string, _rep string, _key string, score double")
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", *(F.lit(v).alias(c) for c, v in (
        ("_digest", "d"), ("_rep", "r"), ("_key", "k"), ("score", 0.5))))
    folder = pipeline_folder(spark, sf, tmp_path, given.unionByName(odd).repartition(5))
    docs = corpus_pipeline.table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == before.columns and docs.exceptAll(before).count() == 0
        assert docs.where("_digest <> 'd' or _rep <> 'r' or _key <> 'k' or score <> 0.5").count() == 0
    left = sorted((str(r["doc_id"]), (r["text"] or "")[:5]) for r in docs.collect() if r["doc_id"] is None or r["doc_id"] > 900_000)
    empty = [x for x in left if not x[1]]
    assert [x for x in left if x[1]] == [("900001", "river"), ("900002", "stone"), ("900005", "meado"), ("None", "cloud")]
    assert empty in ([("900006", ""), ("900007", ""), ("None", ""), ("None", "")], [])
    out = {str(r["doc_id"]): r for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).where("doc_id > 900000 or doc_id is null").collect()}
    assert len(out["900005"]["ids"]) == out["900005"]["n_tokens"] > 40_000
    assert out["900001"]["decoded_sha256"] == hashlib.sha256(plain[0].encode()).hexdigest()


def test_pipeline_of_empty_tables(spark, sf, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def plain_score(net, text):
    """The greatest of all windows' scores, word by word in plain loops."""
    w = {k: v.astype(float) for k, v in net.w.items()}
    h = toxicity.HIDDEN
    words = toxicity.WORDS.findall(text.encode().lower())

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def vector(word):
        f = toxicity.Features([word])
        return np.concatenate([w["word"][f.own[0]], w["char"][f.grams].mean(0)])

    def states(xs, side):
        state, out = np.zeros(h), []
        for x in xs if side == "f" else reversed(xs):
            p = x @ w["x" + side] + w["c" + side]
            z, r = sigmoid(p[:h] + state @ w["h" + side][:, :h]), sigmoid(p[h: 2 * h] + state @ w["h" + side][:, h: 2 * h])
            state = (1 - z) * state + z * np.tanh(p[2 * h:] + (r * state) @ w["h" + side][:, 2 * h:])
            out.append(state)
        return out if side == "f" else out[::-1]
    scores = []
    for at in range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE):
        xs = [vector(x) for x in words[at: at + toxicity.WINDOW]]
        both = [np.concatenate(x) for x in zip(states(xs, "f"), states(xs, "b"), strict=True)]
        e = np.array([np.tanh(s @ w["att"]) @ w["key"] for s in both])
        weight = np.exp(e - e.max()) / np.exp(e - e.max()).sum() if both else e
        pooled = sum((a * s for a, s in zip(weight, both, strict=True)), np.zeros(2 * h))
        scores.append(float(sigmoid(pooled @ w["out"] + w["bias"][0])))
    return max(scores)


def test_scores_are_the_greatest_of_all_windows():
    rng = random.Random(6)
    net = toxicity.Network.fresh(np.random.default_rng(3))
    net.w |= {k: net.w[k] * 8 for k in ("word", "char", "out")}   # scores that differ
    vocabulary = ["alpha", "beta,", "Gamma", "naïve", "漢字", "x", "it's", "42"] + [f"w{i}" for i in range(40)]
    texts = ["", "  ", "one"] + [" ".join(rng.choices(vocabulary, k=n)) for n in (2, 31, 32, 63, 64, 65, 96, 97, 130, 200, 333)]
    got = toxicity.batch_scores(toxicity.Scorer(net), [t.encode() for t in texts])
    want = [plain_score(net, t) for t in texts]
    assert np.allclose(got, want, atol=2e-4) and np.ptp(want) > 0.05


def test_style_tree_equals_brute_force(spark, sf):
    """Entropies and importance of every (host, path), by plain counting."""
    from collections import Counter, defaultdict
    from urllib.parse import urlsplit

    boxed = [(f"https://user@Box.example:80/{i}?a=1|b", f"<body><div class=x><p>same</p><i>{i % 3}</i></div><article><p>t{i}</p><p>u{i}</p></article>")
             for i in range(12)]
    pages = spark.createDataFrame(boxed * 2, "url string, html string").unionByName(spark.read.parquet(f"{sf}/pages.parquet").select("url", "html"))
    rows, seen = defaultdict(list), set()
    for r in pages.collect():
        host = (urlsplit(r["url"]).hostname or "").lower()
        for copy, path, look, content in site_text.styles(site_text.parse(r["html"])):
            if copy is None or (host, copy, path, look, content) not in seen:
                rows[host, path].append((look, content))
            seen.add((host, copy, path, look, content))

    def entropy(values):
        n = len(values)
        return -sum(c / n * np.log(c / n) for c in Counter(values).values()) / np.log(n) if n > 1 else 1.0
    own = {k: (len(v), (entropy([a for a, _ in v]) + entropy([b for _, b in v])) / 2) for k, v in rows.items()}
    want = {(h, p): (n, round(max(o for (h2, p2), (_, o) in own.items() if h2 == h and (p2 + ">").startswith(p + ">")), 9))
            for (h, p), (n, o) in own.items()}
    got = {(r["host"], r["path"]): (r["n"], round(r["importance"], 9)) for r in site_text.style_tree(pages).collect()}
    assert ("box.example", ">body>div.x") in got and got == want
