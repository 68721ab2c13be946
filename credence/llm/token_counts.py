"""Token counts of a unigram vocabulary by count-only Viterbi.

A text's spaces become the space mark, one is put before the text, and it is
cut into words before each mark, as a Metaspace pre-tokenizer does. An
Aho-Corasick automaton over the vocabulary lists all pieces that end at each
place of a word; the dynamic program carries, for the best path to each place,
its score, its number of pieces, and whether it starts or ends with unknown
characters - never the path itself. Tie rules are those of the unigram
tokenizer: of paths with equal scores to one place, that with the earliest
start of its last piece stays; a character that is no piece of its own may be
unknown, at the least score of the vocabulary less 10, and neighbouring unknown
characters are one token.

Words are counted once per worker while they are remembered (about ``KNOWN``
words). A line break, which no piece holds, parts a word, so lines don't make new
words.

Cases: null and empty texts have 0 tokens; any text is counted whole; rows may
repeat; other columns are ignored, whatever their names. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.llm.common import as_texts, worker_kept

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KNOWN = 1_000_000


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a SentencePiece file's ordinary pieces, after <unk>."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [i for i in range(sp.get_piece_size())
                if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    return [("<unk>", 0.0), *((sp.id_to_piece(i), sp.get_score(i)) for i in ordinary)]


class Counter:
    """(score, pieces) of whole texts under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.parted = not any("\n" in p for p, _ in vocabulary)
        self.known: dict[str, tuple] = {}

    def word(self, word: str) -> tuple[float, int, bool, bool]:
        """Score and pieces of the best path; whether it starts, and ends,
        with unknown characters."""
        if not self.single.issuperset(word):
            return self._with_unknown(word)
        scores, counts = [0.0], [0]
        at, top, n = 0, 0.0, 0
        for end, (size, score) in self.pieces.iter(word):  # by end; of one end the longest, so the earliest start, first
            start = end + 1 - size
            if end == at:
                total = scores[start] + score
                if n == 0 or total > top:
                    top, n = total, counts[start] + 1
            else:
                scores.append(top)
                counts.append(n)
                at, top, n = end, scores[start] + score, counts[start] + 1
        return top, n, False, False

    def _with_unknown(self, word: str) -> tuple[float, int, bool, bool]:
        ends: list[list] = [[] for _ in word]
        for end, match in self.pieces.iter(word):
            ends[end].append(match)
        best: list[tuple] = [(0.0, 0, False, False)]
        for e, matches in enumerate(ends):
            top = None
            for size, score in matches:
                at = best[e + 1 - size]
                total = at[0] + score
                if top is None or total > top[0]:
                    top = (total, at[1] + 1, at[2], False)
            if word[e] not in self.single:
                at = best[e]
                total = at[0] + self.unknown
                if top is None or total > top[0]:
                    top = (total, at[1] + (not at[3]), at[2] or at[1] == 0, True)
            best.append(top)
        return best[-1]

    def text(self, text: str) -> tuple[float, int, int]:
        """(score, pieces, words)."""
        if not text:
            return 0.0, 0, 0
        text = text.replace(" ", MARK)
        if not text.startswith(MARK):
            text = MARK + text
        score, pieces, words, open_unknown, breaks = 0.0, 0, text.count(MARK), False, 0
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        for line in text.split("\n") if self.parted else (text,):
            if breaks:  # a line break is one more unknown character
                score += self.unknown
                pieces += not open_unknown
                open_unknown = True
            breaks += 1
            first, *marked = line.split(MARK)
            for w in ([first] if first else []) + [MARK + w for w in marked]:
                got = known.get(w)
                if got is None:
                    known[w] = got = self.word(w)
                score += got[0]
                pieces += got[1]
                if got[2] and open_unknown and w[0] != MARK:
                    pieces -= 1
                open_unknown = got[3]
        return score, pieces, words


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens, score (of the best path) per document."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))  # a vocabulary file: of fixed size
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_kept("unigram", path, lambda: Counter(vocabulary.value))
        for batch in batches:
            got = [counter.text(t) for t in as_texts(batch.column("text"))]
            yield pa.record_batch([batch.column("doc_id"), pa.array([w for _, _, w in got], pa.int64()),
                                   pa.array([n for _, n, _ in got], pa.int64()),
                                   pa.array([s for s, _, _ in got], pa.float64())], schema=schema)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_words long, n_tokens long, score double")
