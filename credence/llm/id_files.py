"""Token-id files with bit- or byte-plane blocks.

A file holds the ids of some documents, one after another, cut into blocks of
``BLOCK`` ids. A block's 32-bit ids are transposed into 4 byte planes (or 32
bit planes), so that the high planes are almost constant, and each plane is
compressed with zstandard. A chunk index gives, per block, the number of ids
and the place and size of each plane; an equal index of documents gives ids and
lengths. Blocks can be read one at a time, in any order.

Layout: b"PLN1", plane kind (1 or 8, one byte), the planes, then a zstandard
frame of JSON (the indexes), its size as 8 bytes little-endian, b"PLN1".

Writing: documents are range-partitioned by id (rows that share an id are spread
by a hash of their text, so one id can't fill a task) and sorted; each partition
encodes its texts and writes one file under the shared folder. A file has a name of
its own per attempt; only names that a finished task reports come into the
manifest, so lost executors and repeated tasks leave no doubt what counts.

Cases: null and empty texts have the end id alone; a null document id sorts
first; repeated rows are written each; other columns are ignored, whatever
their names. An empty table gives no file and no rows.
"""

from __future__ import annotations

import json
import re
import string
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.llm.common import as_texts, stored, worker_kept
from credence.session import work_dir

BLOCK = 1 << 16
END_ID = 2
KNOWN = 1_000_000
MAGIC = b"PLN1"
#: Lower-case letters that are letters in every version of Unicode's tables.
LETTERS = re.compile("[a-zß-öø-žα-ωа-ёђ-ќўџ]+")
#: Byte-level pieces spell each byte as one character: printable ones as themselves,
#: the others, in order, from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = dict(zip((b for b in range(256) if b not in PRINTABLE), range(256, 512), strict=False))


class WordEncoder:
    """Ids of whole texts by the tokenizers library. The tokenizer drops white
    space between words, so each distinct word is encoded once while it is
    remembered, many in one call, parted by a special token, ASCII words in lower
    case as the tokenizer takes them. Marks at a word's end, after a letter or
    digit, are a piece of their own and are encoded apart - unless normalising makes the letter end in a sign that joins the marks, which
    the tokenizer itself is asked for, once for each such letter."""

    TAIL = string.punctuation
    MARKS = TAIL.encode()

    def __init__(self, text: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.part, self.part_id = min((t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items())
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.apart: dict[str, bool] = {}

    def stands_apart(self, letter: str) -> bool:
        """Whether a mark behind this character is a piece of its own."""
        if letter not in self.apart:
            normal = self.tokenizer.normalizer.normalize_str(letter)
            pieces = [self.tokenizer.pre_tokenizer.pre_tokenize_str(normal + mark)[-1][0] for mark in self.TAIL]
            self.apart[letter] = letter.isalnum() and pieces == list(self.TAIL)
        return self.apart[letter]

    def _cut(self, word: bytes) -> tuple[bytes, bytes]:
        """A word, in lower case if it is ASCII, and the marks at its end, if they
        are pieces of their own."""
        core = word.rstrip(self.MARKS)
        # ASCII letters and digits are what they are; others are asked for
        if not core or b"<|" in word or not (core[-1:].isalnum() if core[-1] < 128 else self.stands_apart(core.decode()[-1])):
            core = word
        return core.lower() if core.isascii() and b"<|" not in core else core, word[len(core):]

    def _of_piece(self, piece: str) -> bytes:
        """Ids of one piece, as the tokenizer's own parts leave it."""
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _of_letters(self, words: list[bytes]) -> list[bytes]:
        """Encodes the words that are one piece of common letters once normalised,
        without the tokenizer's search for pieces; returns the others."""
        normal = self.tokenizer.normalizer.normalize_str(b" ".join(words).decode()).split(" ")
        if len(normal) != len(words):   # a word holds a space that isn't ASCII
            return words
        out = []
        for w, n in zip(words, normal, strict=True):
            if LETTERS.fullmatch(n):
                self.known[w] = self._of_piece(n.encode().decode("latin-1").translate(BYTES))
            else:
                out.append(w)
        return out

    def __call__(self, texts: list[str], end_id: int = END_ID) -> list[bytes]:
        """Ids of each text, with the end id, as little-endian 32-bit numbers."""
        if len(self.known) > KNOWN:
            self.known.clear()
        words = [t.encode().split() for t in texts]  # at ASCII white space
        known = self.known
        cut = {w: self._cut(w) for w in set().union(*words).difference(known)}
        need = {p for pair in cut.values() for p in pair if p}.difference(known)
        rest = []
        for p in need:
            if p.isalpha() and p.islower():   # ASCII letters: normal as they are, and one piece
                known[p] = self._of_piece(p.decode())
            elif b"<|" not in p:
                rest.append(p)
        between = self.part.encode()
        for at in range(0, len(rest), 1000):
            part = self._of_letters(rest[at: at + 1000])
            if not part:
                continue
            text = between.join(part).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(ids == self.part_id)).tolist()
            raw = ids.tobytes()
            for p, lo, hi in zip(part, [0, *(c + 4 for c in cuts)], [*cuts, len(raw)], strict=True):
                known[p] = raw[lo:hi]
        for p in need:
            if b"<|" in p:
                known[p] = np.array(self.tokenizer.encode(p.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        for w, (core, tail) in cut.items():
            known[w] = known[core] + known[tail] if tail else known[core]
        end = np.array([end_id], "<u4").tobytes()
        return [b"".join(map(known.__getitem__, ws)) + end for ws in words]


def to_planes(ids: np.ndarray, kind: int) -> list[bytes]:
    """Planes of 8 bits (byte planes) or 1 bit of 32-bit ids, compressed."""
    raw = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if kind == 8:
        planes = list(np.ascontiguousarray(raw.T))
    else:
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        planes = list(np.packbits(bits.T, axis=1, bitorder="little"))
    pack = zstandard.ZstdCompressor(level=6)
    return [pack.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int, kind: int) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor()
    raw = np.stack([np.frombuffer(unpack.decompress(p), np.uint8) for p in planes])
    if kind == 8:
        out = np.ascontiguousarray(raw.T)
    else:
        bits = np.unpackbits(raw, axis=1, count=n, bitorder="little")
        out = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return out.view("<u4").ravel()


class Writer:
    """Writes one file, a block at a time."""

    def __init__(self, sink, kind: int = 8, block: int = BLOCK) -> None:
        self.sink, self.kind, self.block = sink, kind, block
        self.held: list[np.ndarray] = []
        self.size = 0
        self.blocks: list[tuple[int, int, list[int]]] = []
        self.docs: list[tuple[int | None, int]] = []
        self.sink.write(MAGIC + bytes([kind]))
        self.at = len(MAGIC) + 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.block:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.block * self.block
            for k in range(0, whole, self.block):
                self._write(flat[k: k + self.block])
            self.held, self.size = [flat[whole:]], len(flat) - whole

    def _write(self, ids: np.ndarray) -> None:
        planes = to_planes(ids, self.kind)
        self.blocks.append((len(ids), self.at, [len(p) for p in planes]))
        for p in planes:
            self.sink.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.size:
            self._write(np.concatenate(self.held))
        index = zstandard.ZstdCompressor(level=6).compress(json.dumps(
            {"blocks": self.blocks, "ids": [d for d, _ in self.docs], "sizes": [n for _, n in self.docs]}).encode())
        self.sink.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.sink.close()


class Reader:
    """Reads a file: its documents in order, a block at a time."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - 12)
        tail = source.read(12)
        if tail[8:] != MAGIC:
            raise ValueError("not a complete file of ids")
        n = int.from_bytes(tail[:8], "little")
        source.seek(size - 12 - n)
        index = json.loads(zstandard.ZstdDecompressor().decompress(source.read(n)))
        self.blocks, self.ids, self.sizes = index["blocks"], index["ids"], index["sizes"]
        source.seek(len(MAGIC))
        self.kind = source.read(1)[0]

    def block(self, k: int) -> np.ndarray:
        n, at, sizes = self.blocks[k]
        self.source.seek(at)
        return from_planes([self.source.read(s) for s in sizes], n, self.kind)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        rest, k = np.empty(0, np.uint32), 0
        for doc, n in zip(self.ids, self.sizes, strict=True):
            parts = [rest]
            have = len(rest)
            while have < n:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            flat = np.concatenate(parts)
            yield doc, flat[:n]
            rest = flat[n:]


def _encoding(tokenizer, key: str) -> Callable:
    """(doc_id, text) -> (doc_id, ids): ids of whole texts with the end id."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_kept("words", key, lambda: WordEncoder(tokenizer.value))
        for batch in batches:
            texts, at, size = as_texts(batch.column("text")), 0, 0
            for k, t in enumerate(texts):
                size += len(t)
                if size > 1 << 20 or k == len(texts) - 1:
                    yield pa.record_batch([batch.column("doc_id").slice(at, k + 1 - at),
                                           pa.array(encode(texts[at: k + 1]), pa.binary())], schema=schema)
                    at, size = k + 1, 0
    return run


def _writing(folder: str, kind: int) -> Callable:
    """(doc_id, ids) of a task, in order -> the manifest's row of its file."""
    schema = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, writer, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if writer is None:
                    path = f"{folder}/ids-{part:06d}-{uuid.uuid4().hex[:12]}.pln"
                    fs, inner = pafs.FileSystem.from_uri(path)
                    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    writer = Writer(fs.open_output_stream(inner, compression=None), kind)
                writer.add(doc, np.frombuffer(ids or b"", "<u4"))
                n += len(ids or b"") // 4
        if writer is not None:
            writer.close()
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([path]), pa.array([n], pa.int64())], schema=schema)
    return run


def _in_order(df: DataFrame, value: str) -> DataFrame:
    """(doc_id, value) in ascending order over all tasks; rows that share an id
    are spread by a hash of the value."""
    spread = F.xxhash64(value)
    return (df.select("doc_id", value).repartitionByRange(F.col("doc_id"), spread)
            .sortWithinPartitions(F.col("doc_id"), spread, F.col(value)))


def write(tokens: DataFrame, folder: str, kind: int = 8) -> DataFrame:
    """Writes (doc_id, ids), ids being binary, in ascending doc_id order as files
    of ``folder``. Returns the stored manifest: part, path, n_ids."""
    return stored(_in_order(tokens, "ids").mapInArrow(_writing(folder, kind), "part int, path string, n_ids long"), "manifest")


def write_texts(docs: DataFrame, tokenizer_path: str, folder: str, kind: int = 8, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Encodes documents and writes their ids as ``write`` does. Texts are put in
    order first, so that each is encoded once, by the task that writes it."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: of fixed size
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    encode, save = _encoding(tokenizer, tokenizer_path), _writing(folder, kind)
    return stored(_in_order(docs, "text").mapInArrow(lambda batches: save(encode(batches)),
                                                     "part int, path string, n_ids long"), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files:
    start counts the ids of all documents before it."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist(), strict=True):
                fs, inner = pafs.FileSystem.from_uri(path)
                out = []
                with fs.open_input_file(inner) as source:
                    for doc, ids in Reader(source).documents():
                        out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)],
                                      schema=schema)
    # one row per file: its window is of files, not of documents
    before = F.expr("coalesce(sum(n_ids) over (order by part rows between unbounded preceding and 1 preceding), 0L)")
    files = manifest.select("part", "path", before.alias("first"))
    spread = files.repartition(max(1, manifest.count()), "part")
    return spread.select("path", "first").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer_path: str, kind: int = 8) -> DataFrame:
    """Encodes documents, writes their ids to files, and reads the files back."""
    folder = work_dir(docs.sparkSession, "id-files")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read(write_texts(docs, tokenizer_path, folder, kind))
