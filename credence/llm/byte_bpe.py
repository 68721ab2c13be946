"""Byte-level BPE over a global distinct-word shuffle.

Texts are cut into words with positions. A word here is a run without white
space with the one space before it, or a white-space run: no match of the
pre-token pattern crosses such a border, so words can be encoded apart.
Documents are taken in chunks of ``CHUNK`` bytes. A chunk's distinct words go
out once, packed by word hash into buckets (as many as shuffle partitions, up to
``BUCKETS``), and meet the same words of every
other chunk in their bucket. There each distinct word is cut by the pattern
and encoded once; its ids go back to the chunks, where documents are
reassembled by word position. A frequent word costs one entry per chunk, not
one per use, so no word makes a hot task.

Both branches read the documents, and a chunk is named by a digest of its own
content. Words whose ids don't come back, because a re-run dealt the rows into
other chunks, are encoded on the spot: results never depend on the dealing.

Decoding joins ids with the token-byte table.

Cases: null and empty texts have no ids; rows may repeat or share ids, and ids
may be null; a text longer than a chunk is a chunk of its own. Columns other
than the id and the text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.llm.common import as_texts, shuffle_partitions, worker_kept

CHUNK = 8 << 20      # characters of text in a chunk
BUCKETS = 512        # at most, so that a chunk gives few rows on any number of partitions
KNOWN = 500_000      # distinct words whose ids a task keeps at once
#: White space as the pre-token pattern's \s sees it.
SPACE = "".join(chr(c) for c in range(0x3001) if regex.match(r"\s", chr(c)))
WORD = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")

_ROW = pa.schema([("chunk", pa.binary()), ("bucket", pa.int32()), ("body", pa.binary())])
_ROW_SQL = "chunk binary, bucket int, body binary"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encoder(ranks: dict[bytes, int], pattern: str):
    """Encodes words; every match of the pattern in a word is encoded apart."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _packed(values: list[bytes]) -> bytes:
    lens = np.array([len(v) for v in values], np.uint32)
    return zstandard.ZstdCompressor(3).compress(np.uint32(len(values)).tobytes() + lens.tobytes() + b"".join(values))


def _unpacked(body: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64)).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends[:-1]], ends, strict=True)] if n else []


def _planes(values: np.ndarray) -> bytes:
    """The four byte planes of 32-bit numbers, which compress better apart."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list, list[str]]]:
    """(name, document ids, texts) of chunks; the name is a digest of both."""
    docs, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), as_texts(batch.column("text")), strict=True):
            docs.append(doc)
            texts.append(text)
            size += len(text) + 64
            if size >= CHUNK:
                yield _name(docs, texts), docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield _name(docs, texts), docs, texts


def _name(docs: list, texts: list[str]) -> bytes:
    name = xxhash.xxh3_128(repr(docs).encode())
    for t in texts:
        name.update(t.encode() + b"\0")
    return name.digest()


def _distinct(words: Iterable[str], buckets: int) -> list[list[bytes]]:
    """A chunk's distinct words by bucket, in the order of their bytes."""
    out: list[list[bytes]] = [[] for _ in range(buckets)]
    digest = xxhash.xxh3_64_intdigest
    for w in sorted(map(str.encode, words)):
        out[digest(w) % buckets].append(w)
    return out


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROW, strict=True)], schema=_ROW)


def _word_rows(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in _chunks(batches):
            words: set[str] = set()
            for t in texts:
                words.update(WORD.findall(t))
            rows = [(name, b, _packed(ws)) for b, ws in enumerate(_distinct(words, buckets)) if ws]
            if rows:
                yield _rows(rows)
    return run


def _doc_rows(buckets: int) -> Callable:
    """A chunk's documents as one row, which sorts after its buckets of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, docs, texts in _chunks(batches):
            index: defaultdict[str, int] = defaultdict(itertools.count().__next__)
            streams = [np.array(list(map(index.__getitem__, WORD.findall(t))), np.uint32) for t in texts]
            words = _distinct(index, buckets)
            place = {w: k for k, w in enumerate(w for ws in words for w in ws)}
            number = np.array([place[w.encode()] for w in index], np.uint32)
            flat = number[np.concatenate(streams).astype(np.int64)] if place else np.empty(0, np.uint32)
            body = _packed([np.array([d or 0 for d in docs], np.int64).tobytes(),
                            np.array([d is None for d in docs], np.bool_).tobytes(),
                            np.array([len(s) for s in streams], np.int64).tobytes(), _planes(flat), *map(_packed, words)])
            yield _rows([(name, buckets, body)])
    return run


def _id_rows(ranks, pattern: str) -> Callable:
    """Packed words -> packed ids; a task encodes each distinct word once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_kept("bpe", pattern, lambda: encoder(ranks.value, pattern)).encode_ordinary
        known: dict[bytes, bytes] = {}
        for batch in batches:
            bodies = []
            for body in batch.column("body").to_pylist():
                words = _unpacked(body)
                if len(known) > KNOWN:
                    known.clear()
                for w in words:
                    if w not in known:
                        known[w] = array("I", encode(w.decode())).tobytes()
                bodies.append(_packed(list(map(known.__getitem__, words))))
            yield pa.record_batch([batch.column("chunk"), batch.column("bucket"), pa.array(bodies, pa.binary())],
                                  schema=_ROW)
    return run


def _gathered(starts: np.ndarray, lens: np.ndarray, values: np.ndarray) -> np.ndarray:
    """values[s : s + n] of each (s, n), one after another."""
    total = int(lens.sum())
    if not total:
        return values[:0]
    before = np.cumsum(lens) - lens
    return values[np.repeat(starts - before, lens) + np.arange(total)]


def _reassembled(buckets: int, ranks, pattern: str, finish: Callable[[np.ndarray], tuple], schema: pa.Schema) -> Callable:
    """Sorted rows of whole chunks -> ``finish(ids)`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, parts = None, {}
        for batch in batches:
            for name, bucket, body in zip(*(batch.column(c).to_pylist() for c in _ROW.names), strict=True):
                if name != of:
                    of, parts = name, {}
                if bucket < buckets:
                    parts[bucket] = body
                    continue
                ids, nulls, lens, planes, *words = _unpacked(body)
                known: list[bytes] = []
                for b, packed in enumerate(words):
                    if b in parts:
                        known += _unpacked(parts[b])
                    else:
                        for w in _unpacked(packed):
                            bpe = worker_kept("bpe", pattern, lambda: encoder(ranks.value, pattern))
                            known.append(array("I", bpe.encode_ordinary(w.decode())).tobytes())
                size = np.array([len(x) // 4 for x in known], np.int64)
                values = np.frombuffer(b"".join(known), np.uint32)
                starts = np.cumsum(size) - size
                flat, ends = _from_planes(planes), np.cumsum(np.frombuffer(lens, np.int64)).tolist()
                docs = pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(nulls, np.bool_))
                out: list[tuple] = []
                done, held = 0, 0
                for k, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
                    mine = flat[lo:hi]
                    out.append(finish(_gathered(starts[mine], size[mine], values)))
                    held += hi - lo
                    if held > 1_000_000 or k == len(ends) - 1:
                        yield pa.record_batch([docs.slice(done, len(out)), *(
                            pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(schema)[1:], strict=True))],
                            schema=schema)
                        done, out, held = k + 1, [], 0
    return run


def _encoded(docs: DataFrame, path: str, pattern: str, finish: Callable, schema: pa.Schema, sql: str,
             id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = min(BUCKETS, max(8, shuffle_partitions(spark)))
    ranks = spark.sparkContext.broadcast(load_ranks(path))  # a vocabulary file: its size doesn't grow with the data
    words = docs.mapInArrow(_word_rows(buckets), _ROW_SQL)
    ids = words.repartition("bucket").mapInArrow(_id_rows(ranks, pattern), _ROW_SQL)
    whole = ids.union(docs.mapInArrow(_doc_rows(buckets), _ROW_SQL))
    return (whole.repartition("chunk").sortWithinPartitions("chunk", "bucket")
            .mapInArrow(_reassembled(buckets, ranks, pattern, finish, schema), sql))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (token ids of the whole text in order)."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return _encoded(docs, path, pattern, lambda ids: (ids.astype(np.int32),), schema, "doc_id long, ids array<int>",
                    id_col, text_col)


class TokenBytes:
    """The token-byte table, for decoding."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.of[i] = token

    def __call__(self, ids) -> bytes:
        return b"".join(map(self.of.__getitem__, ids))


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, bytes (decoded; a null list gives no bytes)."""
    ranks = tokens.sparkSession.sparkContext.broadcast(load_ranks(path))
    schema = pa.schema([("doc_id", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenBytes(ranks.value)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([table(x or []) for x in batch.column(1).to_pylist()],
                                                             pa.binary())], schema=schema)
    return tokens.select(F.col(id_col).cast("long"), ids_col).mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes: doc_id, n_tokens, ids_sha256 (of the ids as
    little-endian 32-bit numbers), decoded_sha256 (of the decoded bytes)."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])
    held: list[TokenBytes] = []

    def finish(ids: np.ndarray) -> tuple:
        if not held:
            held.append(TokenBytes(ranks.value))
        return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(held[0](ids.tolist())).hexdigest())
    return _encoded(docs, path, pattern, finish, schema,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", id_col, text_col)


def encode_checked(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256: the ids with the digest of what
    they decode to, to hold against that of the text."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
                        ("decoded_sha256", pa.string())])
    held: list[TokenBytes] = []

    def finish(ids: np.ndarray) -> tuple:
        if not held:
            held.append(TokenBytes(ranks.value))
        return len(ids), ids.astype(np.int32), hashlib.sha256(held[0](ids.tolist())).hexdigest()
    return _encoded(docs, path, pattern, finish, schema,
                    "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string", id_col, text_col)
