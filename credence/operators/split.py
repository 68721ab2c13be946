"""exact, seeded, stratified train/test split.

Semantics (scikit-learn ``train_test_split(stratify=y)`` counts): with n
rows, ``n_test = ceil(test_size * n)``; ``n - n_test`` training rows are
allotted to classes by largest remainder (ties by class value); each class's
test rows are the rest. Within a class, rows are ranked by a seeded hash of
the key (key breaks ties) and the lowest ``test_c`` ranks go to test.
``sampleBy`` / ``randomSplit`` are Bernoulli and not exact.

Plan at scale (SURVEY H3): a per-class ``row_number`` would put each class
in one task. Instead:

1. per class counts -> quotas (a table of one row per class);
2. a histogram of the hash's top bits per class (<= 65,536 rows per class);
   its running sum finds, per class, the one boundary bucket;
3. rows below the boundary bucket are test, above it train; only rows in
   the boundary bucket (about n_c / 65,536) are ranked by a window.

Everything is deterministic, so lost tasks recompute the same split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .cumulative import running_totals


# a table of at most this many classes is broadcast to the rows
FEW_CLASSES = 10_000
_P31 = 2147483647  # 2^31 - 1
_MINSTD = 48271
BUCKET_BITS = 16


def order_hash(key: str, seed: int, method: str = "xxhash64") -> Column:
    """Seeded 64-bit ordering hash of the key.

    ``xxhash64`` (default) mixes well; ``lehmer`` is the arithmetic hash
    ``(((key + seed) mod p) * 48271) mod p``, p = 2^31 - 1, which SQL engines
    without xxhash can reproduce (used by the DuckDB oracle)."""
    k = F.col(key)
    if method == "xxhash64":
        return F.xxhash64(k, F.lit(int(seed)))
    if method == "lehmer":
        return F.pmod(F.pmod(k.cast("long") + F.lit(int(seed)), F.lit(_P31)) * F.lit(_MINSTD), F.lit(_P31))
    raise ValueError(f"unknown hash method {method}")


def _bucket(h: Column, method: str) -> Column:
    # top bits preserve the hash order
    shift = 64 - BUCKET_BITS if method == "xxhash64" else 31 - BUCKET_BITS
    return F.shiftright(h, shift)


def _join_ns(left: DataFrame, right: DataFrame, label: str, how: str = "inner") -> DataFrame:
    """Join on ``label`` treating NULL as its own class."""
    r = right.withColumnRenamed(label, "_lbl")
    return left.join(r, left[label].eqNullSafe(r["_lbl"]), how).drop("_lbl")


def _few(per_class: DataFrame) -> DataFrame:
    """A written table of one row per class, to be broadcast if it is short:
    joined by a shuffle, all rows of a class would come to one task."""
    return F.broadcast(per_class) if per_class.count() <= FEW_CLASSES else per_class


def class_quotas(df: DataFrame, label: str, test_size: float, counts: DataFrame | None = None) -> DataFrame:
    """``(label, n_c, train_c, test_c)``; one row per class (tiny)."""
    if counts is None:
        counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w_all = Window.partitionBy(F.lit(0))
    n = F.sum("n_c").over(w_all)
    n_test = F.ceil(F.lit(float(test_size)) * n)
    n_train = n - n_test
    cont = F.col("n_c").cast("double") * n_train.cast("double") / n.cast("double")
    q = counts.select(label, "n_c", cont.alias("_cont"), F.floor(cont).alias("_floor"),
                      n_train.alias("_n_train"))
    q = q.select("*", (F.col("_cont") - F.col("_floor")).alias("_rem"),
                 (F.col("_n_train") - F.sum("_floor").over(w_all)).alias("_need"))
    w_rank = Window.partitionBy(F.lit(0)).orderBy(F.col("_rem").desc(), F.col(label).asc())
    q = q.select("*", F.row_number().over(w_rank).alias("_r"))
    train_c = (F.col("_floor") + F.when(F.col("_r") <= F.col("_need"), 1).otherwise(0)).cast("long")
    return q.select(label, F.col("n_c").cast("long").alias("n_c"), train_c.alias("train_c"),
                    (F.col("n_c") - train_c).cast("long").alias("test_c"))


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2,
                     seed: int = 42, method: str = "xxhash64",
                     split_col: str = "split", names=("train", "test")) -> DataFrame:
    """Adds ``split_col`` with ``names[0]`` (train) or ``names[1]`` (test).

    Order within a class: a seeded hash of the key, then a row id, so that
    membership depends on the key alone, whatever the other columns hold
    (``lehmer`` is the SQL-reproducible hash). Rows that share a key share a
    hash: in the boundary bucket they collapse to one (hash, multiplicity)
    group, and only the single group that straddles the quota is ranked, by
    row id, through the distributed running totals, in which a NULL label is a
    class as any other. No window ever sees a hot group."""
    train_name, test_name = names
    cols = df.columns
    if method == "xxhash64":
        g = F.xxhash64(F.col(key), F.lit(int(seed)))
    else:
        g = order_hash(key, seed, method)
    h = df.withColumn("_h", g).withColumn("_b", _bucket(F.col("_h"), method)) \
        .withColumn("_mid", F.monotonically_increasing_id())

    hist = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    quotas = class_quotas(df, label, test_size,
                          counts=hist.groupBy(label).agg(F.sum("_cnt").alias("n_c")))
    w = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.select(label, "_b", "_cnt", F.sum("_cnt").over(w).alias("_cum"))
    hist = _join_ns(hist, quotas.select(label, "test_c"), label)
    # boundary bucket: first bucket whose running count exceeds test_c
    boundary = (hist.where(F.col("_cum") > F.col("test_c"))
                .groupBy(label)
                .agg(F.min(F.struct("_b", (F.col("test_c") - (F.col("_cum") - F.col("_cnt"))).alias("need")))
                     .alias("s"))
                .select(label, F.col("s._b").alias("_bstar"), F.col("s.need").alias("_need")))
    # One row per class (a class whose test quota is the whole class has no
    # boundary: all test). Materialized once, so the histogram scan is not
    # repeated by each branch below.
    table = _few(materialize(_join_ns(quotas.select(label), boundary, label, "left")))

    tagged = _join_ns(h, table, label, "left")
    b, bstar = F.col("_b"), F.col("_bstar")
    decided = tagged.where(bstar.isNull() | (b != bstar)).withColumn(
        split_col, F.when(bstar.isNull() | (b < bstar), F.lit(test_name)).otherwise(F.lit(train_name)))

    # boundary bucket (about n_c / 65,536 rows per class; more only when rows
    # repeat): materialized once, the steps below read it, not the input
    edge = materialize(tagged.where(b == bstar))
    # level 1: distinct hashes with their multiplicity
    groups = edge.groupBy(label, "_h", "_need").agg(F.count(F.lit(1)).alias("_m"))
    wg = Window.partitionBy(label).orderBy("_h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = groups.withColumn("_gcum", F.sum("_m").over(wg))
    cut = (groups.where(F.col("_gcum") > F.col("_need")).groupBy(label)
           .agg(F.min(F.struct("_h", (F.col("_need") - (F.col("_gcum") - F.col("_m"))).alias("r"),
                               F.col("_m").alias("m"))).alias("s"))
           .select(label, F.col("s._h").alias("_hcut"), F.col("s.r").alias("_r"), F.col("s.m").alias("_mcut")))
    cut = _few(materialize(cut))
    edge = _join_ns(edge, cut, label, "left")
    edge_decided = edge.where(F.col("_h") != F.col("_hcut")).withColumn(
        split_col, F.when(F.col("_h") < F.col("_hcut"), F.lit(test_name)).otherwise(F.lit(train_name)))

    # level 2: the straddling group (copies of one row, possibly many) is
    # ranked by row id with distributed running totals
    straddle = edge.where(F.col("_h") == F.col("_hcut")).select(*cols, "_mid", "_r", F.lit(1).cast("long").alias("_one"))
    ranked = running_totals(straddle, [label], "_mid", ["_one"])
    ranked = ranked.withColumn(split_col, F.when(F.col("_one_cum") <= F.col("_r"), F.lit(test_name))
                               .otherwise(F.lit(train_name)))
    out = cols + [split_col]
    return decided.select(*out).unionByName(edge_decided.select(*out)).unionByName(ranked.select(*out))
