"""Benchmark decontamination with DataFrame functions only.

Texts are normalised to words (A-Z lower-cased, runs of digits, a-z and
non-ASCII characters). A benchmark item gives its windows of ``size``
consecutive words; an item of fewer words, but not none, is one window. The
distinct windows, with the items that hold them, are the hash side of a
broadcast hash join; document windows are the probe side, so no document text
is shuffled. The join key is the normalised window text itself: a hit is
verified by equality, not by a hash. Only hits, and one row per document, go
on to the aggregation.

The windows are broadcast only if they and their items have ``BROADCAST_BYTES``
at most (their bytes are summed first); beyond that the join is an ordinary shuffled one,
which AQE splits where a window is hot.

Cases: null or empty texts and texts without words have 0 words and no hits;
an empty benchmark hits nothing; items with equal windows all count; an item
without id counts as no item but its windows hit; repeated documents each get
their row; columns other than the id and the text are ignored, whatever their
names. An empty table of documents gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.llm.common import ascii_lower, free_name, stored

SIZE = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """Array of normalised words; null or wordless text gives an empty array."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _starts(ws: Column, length: int) -> Column:
    n = F.size(ws) - length
    return F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))


def _probes(ws: Column, length: int) -> Column:
    """All windows of one length, with their places."""
    # single items, not slice(): inside a lambda that copies the whole array for every window
    return F.transform(_starts(ws, length), lambda at: F.struct(
        at.alias("at"), F.lit(length).alias("length"),
        F.concat_ws(" ", *(F.get(ws, at + k) for k in range(length))).alias("window")))


def benchmark_windows(items: DataFrame, size: int = SIZE, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(window, length, items): distinct windows with the ids of their items."""
    ws = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws")).where("size(ws) > 0")
    length = F.least(F.size("ws"), F.lit(size))
    starts = F.sequence(F.lit(0), F.size("ws") - length)
    each = (ws.select("item", "ws", length.alias("length"), F.explode(starts).alias("at"))
            .select("item", "length", F.concat_ws(" ", F.slice("ws", F.col("at") + 1, F.col("length"))).alias("window")))
    return each.groupBy("window", "length").agg(F.collect_set("item").alias("items"))


def find_hits(docs: DataFrame, items: DataFrame, size: int = SIZE, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, spans (sorted (start, end) word
    spans of hits, end exclusive), items (sorted ids of the items hit)."""
    windows = stored(benchmark_windows(items, size), "windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # `size` values at most
    keyed = windows.select("window", "items")
    items_size = F.reduce("items", F.lit(0), lambda a, i: a + F.octet_length(i) + 16)
    held = windows.agg(F.coalesce(F.sum(F.octet_length("window") + 32 + items_size), F.lit(0))).first()[0]
    if held <= BROADCAST_BYTES:
        keyed = F.broadcast(keyed)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    d = d.select("doc_id", F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"), words(F.col("text")).alias("ws"))
    # at = -1 marks the one row that carries the word count; it matches no window
    probes = [F.array(F.struct(F.lit(-1).alias("at"), F.size("ws").alias("length"),
                               F.lit(None).cast("string").alias("window")))]
    probes += [_probes(F.col("ws"), n) for n in lengths]
    rows = (d.select("doc_id", "h1", "h2", F.explode(F.concat(*probes)).alias("p"))
            .select("doc_id", "h1", "h2", "p.at", "p.length", "p.window"))
    joined = rows.join(keyed, "window", "left").where("at = -1 or items is not null")
    span = F.when(F.col("at") >= 0, F.struct(F.col("at").alias("start"), (F.col("at") + F.col("length")).alias("end")))
    one = joined.groupBy("doc_id", "h1", "h2").agg(
        F.max(F.when(F.col("at") < 0, F.col("length"))).alias("n_words"),
        F.count(F.when(F.col("at") < 0, F.lit(1))).alias("copies"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.col("items"))))).alias("items"))
    return (one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id", "n_words", "spans", "items"))


def covered(spans: Column) -> Column:
    """Number of words inside the union of sorted spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(spans, start, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["upto"]))).alias("n"),
        F.greatest(acc["upto"], s["end"]).alias("upto")), lambda acc: acc["n"])


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """Documents in which no benchmark window occurs; all columns stay. Rows
    that share an id are judged by their own texts."""
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text"), F.hash("text"))
    name = free_name(docs, "_key")
    bad = (find_hits(docs.select(key.alias("k"), "text"), items, size, id_col="k")
           .where("size(spans) > 0").select(F.col("doc_id").alias(name)).distinct())
    return docs.withColumn(name, key).join(bad, name, "left_anti").select(docs.columns)


def cut_spans(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id and the normalised words outside every hit, joined by a space:
    the cleaned form for training on normalised text."""
    hits = find_hits(docs, items, size)
    return (docs.select("doc_id", words(F.col("text")).alias("ws")).join(hits.dropDuplicates(["doc_id"]), "doc_id")
            .select("doc_id", F.concat_ws(" ", F.filter("ws", lambda w, i: ~F.exists(
                "spans", lambda s: (s["start"] <= i) & (i < s["end"])))).alias("text")))
