"""MinHash near-duplicates by a signature-coordinate inverted join.

A document is the set of its distinct word shingles, each a 64-bit hash, and
gets K min-hash coordinates. It is posted under each (coordinate, value)
pair. Of its K posts only the ``K - T + 1`` rarest are kept (prefix rule: two
documents that agree on T coordinates share one of them); posts that no other
document has fill the prefix first and cost nothing, and the most frequent
values are skipped by it. T is the largest match count that a pair at the
similarity threshold misses with a probability of at most ``MISS``.

Posting lists aren't merged, nor is one skipped while counting: every list is
led by its least member, and members meet in the group of their leader. There
collisions of whole signatures are counted for all pairs, also for those that
share no list; pairs below T matches fall away, and the others are confirmed
on the full sets.
Only links that join two parts are returned, so a group of g copies gives
g - 1 links, not g * g. A group over ``BLOCK`` members is dealt into blocks,
and each pair of blocks is a task of its own.

Cases: exact copies (equal sets) are folded into one node first and never
meet in pairs. Null or empty texts, and texts without words, have an empty
set and no links. Fewer words than a shingle has: the whole sequence is the
one shingle. Repeated rows are copies. A null id can't be a component's
name: such a row has a null component unless copies with ids name it.
Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.llm.common import as_bytes, free_name, stored
from credence.llm.components import components

K = 48            # signature coordinates
MISS = 1e-7       # chance that a pair at the threshold falls below T matches
BLOCK = 256       # members of a leader's group that one task holds on a side
SALTS = 64        # parts that the members of a large group come in
CACHE = 400_000   # words whose hashes a task keeps at once
SEED = 20_240_229

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def match_threshold(similarity: float, k: int = K, miss: float = MISS) -> int:
    """Largest T with P(Binomial(k, similarity) < T) <= miss."""
    tail = 0.0
    for t in range(k + 1):
        tail += math.comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if tail > miss:
            return max(t, 1)
    return k


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, width: int, words: dict) -> np.ndarray:
    """Sorted distinct shingle hashes of a text: A-Z lower-cased, words cut at
    the six ASCII white-space characters (``bytes.split`` cuts at just those)."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.array(list(map(words.__getitem__, found)), np.uint64)
    n = max(1, len(h) - width + 1)
    with np.errstate(over="ignore"):
        out = np.full(n, min(len(h), width), np.uint64)
        for j in range(min(len(h), width)):
            out = _mixed(out * _GOLD + h[j: j + n])
    return np.unique(out)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 2**63, K, np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2**63, K, np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    a, b = _coefficients_cached()
    least = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 4096):
            least = np.minimum(least, (hashes[i: i + 4096, None] * a + b).min(0))
    return (least >> np.uint64(32)).astype(np.uint32)


_KEPT: list = []


def _coefficients_cached() -> tuple[np.ndarray, np.ndarray]:
    if not _KEPT:
        _KEPT.append(_coefficients())
    return _KEPT[0]


def _node(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _signed(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
                        ("signature", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            n, nodes, sigs = [], [], []
            for text in as_bytes(batch.column("text")):
                hashes = shingle_set(text, width, words)
                n.append(len(hashes))
                nodes.append(_node(hashes) if len(hashes) else None)
                sigs.append(signature(hashes).view(np.int32) if len(hashes) else None)
            yield pa.record_batch([batch.column("doc_id"), batch.column("digest"), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()),
                                   pa.array(sigs, pa.list_(pa.int32()))], schema=schema)
    return run


def _posts(reps: DataFrame, prefix: int) -> DataFrame:
    """(token, node): a node's rarest posts that some other node shares."""
    token = F.shiftleft(F.col("c").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    posts = reps.select("node", F.posexplode("signature").alias("c", "v")).select("node", token.alias("token"))
    shared = posts.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    ranked = (posts.join(shared, "token").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("posts")))  # K at most
    room = F.greatest(F.lit(0), F.lit(prefix - K) + F.size("posts"))
    return ranked.select("node", F.explode(F.slice("posts", F.lit(1), room)).alias("p")).select("p.token", "node")


def _meetings(posts: DataFrame) -> DataFrame:
    """(node, leader, i, j): the block pair (i, j) of a leader's group in which
    the node takes part. Each two members of a posting list meet in one."""
    leaders = posts.groupBy("token").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = stored(posts.join(leaders.drop("n"), "token").select("leader", "node").distinct(), "members")
    # the size is asked of large groups only, and joined to each salt of theirs, so
    # that a large group's members come to many tasks
    salt = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(SALTS)).cast("int")
    sizes = (members.groupBy("leader").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    blocks = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / BLOCK).cast("int")
    dealt = (members.withColumn("salt", salt).join(sizes, ["leader", "salt"], "left")
             .select("leader", "node", blocks.alias("blocks"),
                     F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return dealt.select("node", "leader", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                        "own")


def _sets_of(width: int):
    """Rows (node, text, meetings) -> a row with the set for each meeting."""
    schema = pa.schema([("leader", pa.binary()), ("i", pa.int32()), ("j", pa.int32()), ("own", pa.int32()),
                        ("node", pa.binary()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = _WordHashes(), None
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for text, node, meetings in zip(as_bytes(batch.column("text")), batch.column("node").to_pylist(),
                                            batch.column("meetings").to_pylist(), strict=True):
                if node == last:  # a repeated row
                    continue
                hashes, last = shingle_set(text, width, words), node
                if not len(hashes) or _node(hashes) != node:  # another text of the same digest
                    continue
                for m in meetings:
                    out.append((m["leader"], m["i"], m["j"], m["own"], node, hashes.tobytes()))
                    size += 8 * len(hashes)
                    if size > 1 << 24:
                        yield _batch(out, schema)
                        out, size = [], 0
            if out:
                yield _batch(out, schema)
    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                           schema=schema)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 columns of the
    elements that two sets share at least."""
    lens = [len(s) for s in sets]
    _, index, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    owner = np.repeat(np.arange(len(sets)), lens)
    keep = count[index] > 1
    col, owner = rank[index[keep]], owner[keep]
    order = np.argsort(col, kind="stable")
    col, owner = col[order], owner[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    total = int(rank[-1]) + 1 if len(rank) else 0
    for at in range(0, total, 4096):
        lo, hi = np.searchsorted(col, [at, at + 4096])
        x = np.zeros((len(sets), 4096), np.float32)
        x[owner[lo:hi], col[lo:hi] - at] = 1
        out += x @ x.T  # exact: sizes stay below 2**24
    return out.astype(np.int64)


def _linked(sets: list[np.ndarray], sigs: np.ndarray, own: np.ndarray, cross: bool, t: int,
            per_100: int) -> list[tuple[int, int]]:
    """Links that join two parts of a group: pairs of T matching coordinates
    or more, confirmed on the sets."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    pairs = []
    for x in range(n - 1):
        matches = (sigs[x + 1:] == sigs[x]).sum(1)
        rest = size[x + 1:]
        ok = (matches >= t) & (100 * np.minimum(rest, size[x]) >= per_100 * np.maximum(rest, size[x]))
        if cross:
            ok &= own[x + 1:] != own[x]
        for y in np.nonzero(ok)[0]:
            pairs.append((-int(matches[y]), x, x + 1 + int(y)))
    pairs.sort()
    dense = None
    if len(pairs) > 2 * n + 64:
        used = sorted({x for p in pairs for x in p[1:]})
        at = {x: k for k, x in enumerate(used)}
        dense = _overlaps([sets[x] for x in used])
    links = []
    for _, x, y in pairs:
        a, b = root(x), root(y)
        if a == b:
            continue
        if dense is None:
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        else:
            both = int(dense[at[x], at[y]])
        if 100 * both >= per_100 * (int(size[x]) + int(size[y]) - both):
            parent[max(a, b)] = min(a, b)
            links.append((x, y))
    return links


def _confirm(t: int, per_100: int):
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_pylist()
        sets = [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()]
        own = group.column("own").to_numpy()
        sigs = np.stack([signature(s) for s in sets])
        found = _linked(sets, sigs, own, key[1].as_py() != key[2].as_py(), t, per_100)
        return pa.table([pa.array([nodes[x] for x, _ in found], pa.binary()),
                         pa.array([nodes[y] for _, y in found], pa.binary())], schema=schema)
    return run


def _rooted(docs: DataFrame, width: int, per_100: int, id_col: str = "doc_id",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Signed rows; and (node, rep, digest, root) of every node: the least id of
    its rows with the least digest of that id's texts, and its component."""
    text = F.col(text_col).cast("string")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    t = match_threshold(per_100 / 100)
    signed = stored(docs.mapInArrow(_signed(width), "doc_id long, digest long, n_shingles long, node binary, "
                                    "signature array<int>"), "signatures")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest"))   # rows without id last
    reps = stored(signed.where("node is not null").groupBy("node")
                  .agg(least.alias("least"), F.min("signature").alias("signature"))
                  .select("node", F.col("least.doc_id").alias("rep"), F.col("least.digest").alias("digest"), "signature"),
                  "nodes")
    meetings = _meetings(_posts(reps, K - t + 1))
    shipped = (meetings.groupBy("node").agg(F.collect_list(F.struct("leader", "i", "j", "own")).alias("meetings"))
               .join(reps.select("node", "rep", F.col("digest").alias("of")), "node"))
    # the one text of a node: rows that share its id only stay out
    sets = (docs.join(shipped, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("digest") == F.col("of")))
            .select("node", "text", "meetings")
            .mapInArrow(_sets_of(width), "leader binary, i int, j int, own int, node binary, hashes binary"))
    links = sets.groupBy("leader", "i", "j").applyInArrow(_confirm(t, per_100), "u binary, v binary")
    roots = stored(components(links), "roots")
    return signed, (reps.select("node", "rep", "digest").join(roots, "node", "left")
                    .withColumn("root", F.coalesce("root", "node")))


def near_duplicates(docs: DataFrame, width: int = 5, per_100: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id
    reachable over links of similarity >= per_100 / 100), kept."""
    signed, named = _rooted(docs, width, per_100, id_col, text_col)
    full = signed.where("node is not null")
    names = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = named.join(names, "root").select("node", "component_id")
    out = (full.select("doc_id", "n_shingles", "node").join(classes, "node")
           .select("doc_id", "n_shingles", "component_id"))
    empty = signed.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 5, per_100: int = 80) -> DataFrame:
    """Documents without near-duplicates: of each component the row of the
    least doc_id stays (of its texts in the component that with the least digest;
    a row without id only if none has one), once if the row is repeated. Rows
    without words stay, once if id and text are repeated; those without an id
    each."""
    signed, named = _rooted(docs, width, per_100)
    digest, rep, of = (free_name(docs, c) for c in ("_digest", "_rep", "_of"))
    best = (named.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "digest")).alias("best"))
            .select(F.col("best.rep").alias(rep), F.col("best.digest").alias(of)))
    bare = signed.where("node is null").select(F.col("doc_id").alias(rep), F.col("digest").alias(of))
    kept = best.union(bare).distinct()
    mine = F.col("doc_id").cast("long").eqNullSafe(F.col(rep)) & F.col(digest).eqNullSafe(F.col(of))
    chosen = docs.withColumn(digest, F.xxhash64(F.col("text").cast("string"))).join(kept, mine, "left_semi")
    nameless = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").cast("string").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    return (chosen.where(~nameless).dropDuplicates(["doc_id", digest]).select(docs.columns)
            .unionByName(docs.where(nameless)))
