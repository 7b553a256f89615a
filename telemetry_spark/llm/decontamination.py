"""Benchmark decontamination by winnowing.

Method. Both sides hash every run of k words and keep the least hash of each window of w consecutive runs, so two texts that share
k + w - 1 words in a row keep a fingerprint in common. k + w - 1 is the length of a benchmark window, so a document that has any
window shares a fingerprint with the item: joining the two sides' fingerprints finds every candidate. Hits are
then extended: the runs around a common fingerprint that are a whole window's length are compared word by word with the items' windows.
An item shorter than a window is one window of its own length, and fingerprints of that length are kept without winnowing.

Documents are read once into fingerprints, written as a table; only documents with a fingerprint in common are read again. The
benchmark's fingerprints are broadcast if there are at most ``broadcast_rows`` of them and joined by hash otherwise; either way every row
is a fingerprint, whatever the size of a document or the number of documents that share a passage.

Defined results: null or empty texts have no words, no items, and the digest of an empty list; an item that is null, has no words or has
a null id is in no document; an item id that repeats counts once, with the windows of all its texts; rows that repeat an id and a text
have equal results; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import ascii_words, bounded, written

WINDOW, GRAM = 10, 5


def runs(words: Column, k: int) -> Column:
    """Hashes of every run of k words, in order."""
    starts = F.sequence(F.lit(0), F.size(words) - k)
    hashed = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k))))
    return F.when(F.size(words) >= k, hashed).otherwise(F.array().cast("array<bigint>"))


def winnowed(hashes: Column, w: int) -> Column:
    """The least of every w consecutive hashes; of fewer, the least of all."""
    if w == 1:
        return F.array_distinct(hashes)
    starts = F.sequence(F.lit(0), F.size(hashes) - w)
    least = F.transform(starts, lambda i: F.least(*(F.get(hashes, i + j) for j in range(w))))
    few = F.filter(F.array(F.array_min(hashes)), lambda h: h.isNotNull())
    return F.array_distinct(F.when(F.size(hashes) >= w, least).otherwise(few))


def profiles(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(k, w) for each length that a window can have, whole windows first; the fingerprints of a length cover spans of it."""
    whole = [(min(GRAM, window), window - min(GRAM, window) + 1)]
    return whole + [(n, 1) for n in sorted(lengths) if n < window]


def fingerprints(rows: DataFrame, kinds: list[tuple[int, int]]) -> DataFrame:
    """Replace ``words`` by ``marks``: the fingerprints of every kind in one array."""
    for n, (k, _) in enumerate(kinds):
        rows = rows.withColumn(f"__runs{n}", runs(F.col("words"), k))
    marks = F.array_distinct(F.concat(*(winnowed(F.col(f"__runs{n}"), w) for n, (_, w) in enumerate(kinds))))
    return rows.withColumn("marks", marks).drop("words", *(f"__runs{n}" for n in range(len(kinds))))


def benchmark_windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """``item_id, span``: every window of every item, as an array of words."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), ascii_words(F.col(text_col)).alias("words"))
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    spans = F.transform(starts, lambda i: F.slice(F.col("words"), i + 1, window))
    return items.where(n > 0).select("item_id", F.explode(spans).alias("span")).distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_rows: int = 200_000,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, row``: spans are the hit (begin, end) places in words, row a
    hash of id and text."""
    windows = written(benchmark_windows(benchmark, window, item_col, text_col), "benchmark-windows")
    lengths = [r[0] for r in windows.select(F.size("span")).distinct().collect()]  # at most ``window`` numbers
    kinds = profiles(lengths, window)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    tokens = rows.select("doc_id", "row", ascii_words(F.col("text")).alias("words"))
    marked = written(fingerprints(tokens.withColumn("n_words", F.size("words").cast("bigint")), kinds), "fingerprints")
    # A window keeps the fingerprints of the kind of its own length; those of other kinds can only add candidates.
    kept = fingerprints(windows.withColumnRenamed("span", "words"), kinds).select(F.explode("marks").alias("mark")).distinct()
    kept = bounded(written(kept, "benchmark-marks"), broadcast_rows)
    common = marked.select("row", F.explode("marks").alias("mark")).join(kept, "mark")
    candidates = written(common.select("row").distinct(), "fingerprint-hits")
    spans = extended(rows, candidates, kept, windows, kinds, window, broadcast_rows)
    found = spans.groupBy("row").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("spans"),
    )
    none = F.array().cast("array<string>")
    joined = marked.select("doc_id", "row", "n_words").join(found, "row", "left")
    items = F.coalesce("items", none)
    return joined.select(
        "doc_id", "n_words", F.coalesce(covered(F.col("spans")), F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"), F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"), "spans", "row",
    )


def without_contaminated(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in which ``contamination`` finds nothing, all columns as they are."""
    dirty = written(found.where("contaminated").select(F.col("row").alias("__dirty")).distinct(), "contaminated-rows")
    rows = docs.withColumn("__row", F.xxhash64(F.col(id_col), F.col(text_col)))
    return rows.join(bounded(dirty, 200_000), F.col("__row") == F.col("__dirty"), "left_anti").drop("__row")


def extended(
    rows: DataFrame, candidates: DataFrame, marks: DataFrame, windows: DataFrame, kinds: list[tuple[int, int]], window: int, broadcast_rows: int,
) -> DataFrame:
    """Grow the hits of candidate documents to whole windows: ``row, begin, end, item_id`` of the runs that are an item's window.

    Runs meet the benchmark's marks one by one, so a text takes time in proportion to its words however many of them are hits.
    """
    tokens = rows.select("row", "text").join(candidates, "row").select("row", ascii_words(F.col("text")).alias("words"))
    spans = []
    for k, w in kinds:
        length = k + w - 1
        near = tokens.select("row", F.posexplode(runs(F.col("words"), k)).alias("at", "mark")).join(marks, "mark")
        begins = near.select("row", F.explode(F.sequence(F.greatest(F.col("at") - (length - k), F.lit(0)), F.col("at"))).alias("begin"))
        at = tokens.join(begins.groupBy("row").agg(F.collect_set("begin").alias("begins")), "row")
        cut = F.transform("begins", lambda b: F.struct(b.alias("begin"), F.slice(F.col("words"), b + 1, length).alias("span")))  # noqa: B023
        spans.append(at.select("row", F.explode(cut).alias("s")).select("row", "s.begin", "s.span").where(F.size("span") == length))
    tried = spans[0]
    for more in spans[1:]:
        tried = tried.unionByName(more)
    met = tried.join(bounded(windows, broadcast_rows), "span")
    return met.select("row", "begin", (F.col("begin") + F.size("span")).alias("end"), "item_id")


def covered(spans: Column) -> Column:
    """How many places sorted (begin, end) spans cover."""
    start = F.struct(F.lit(0).cast("int").alias("reach"), F.lit(0).cast("int").alias("n"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["reach"], s["end"]).alias("reach"),
        (acc["n"] + F.greatest(s["end"] - F.greatest(s["begin"], acc["reach"]), F.lit(0))).alias("n"),
    )
    return F.aggregate(spans, start, step, lambda acc: acc["n"])
