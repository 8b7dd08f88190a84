"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the K smallest 48-bit hashes of a document's distinct five-word shingles (A-Z lower-cased; fewer words:
the whole sequence) and, where there are fewer, all of them. Sketches of parts merge into the sketch of the union. From
two sketches follow resemblance (Jaccard), containment and the number of distinct shingles. A fingerprint is the sketch
as text: the hashes ascending, eight base64 signs each, so equal texts have equal fingerprints.

Null or empty text: an empty sketch; two empty sketches resemble each other fully, an empty and another one not at
all. Repeated rows stand side by side in the order of doc_id, then text; null ids come last. Extra columns are left
alone; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import U64, read_table, shingle_sets, slabs

K = 128
_BITS = 48


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct 48-bit hashes, from sorted distinct 64-bit ones."""
    return np.unique(hashes[:4 * k] >> U64(64 - _BITS))[:k] if len(hashes) else hashes


def merge(*sketches: np.ndarray, k: int = K) -> np.ndarray:
    return np.unique(np.concatenate(sketches))[:k] if sketches else np.empty(0, U64)


def distinct(s: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(s)) if len(s) < k else (k - 1) * float(1 << _BITS) / float(s[k - 1])


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness: the share of the union's sketch that is in both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k=k)
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k=k), k) / distinct(a, k))


def to_text(s: np.ndarray) -> str:
    return base64.b64encode(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode() if len(s) else ""


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    return np.concatenate([np.zeros((len(raw), 2), np.uint8), raw], axis=1).reshape(-1).view(">u8").astype(U64)


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``df`` with each whole text's fingerprint."""
    text, schema = F.col(text_col).cast("string"), df.drop(out_col).schema

    def run(batches):
        for b in batches:
            texts = b.column("_fp_text").cast(pa.binary()).to_pylist()
            rest = b.select([c for c in b.schema.names if c != "_fp_text"])
            for i, j in slabs([len(t or b"") for t in texts]) if texts else ():
                prints = pa.array([to_text(sketch(s)) for s in shingle_sets(texts[i:j])], pa.string())
                yield pa.RecordBatch.from_arrays([*rest.slice(i, j - i).columns, prints], names=[*rest.schema.names, out_col])

    return df.drop(out_col).withColumn("_fp_text", text).mapInArrow(run, schema.add(out_col, "string"))


def merged(df: DataFrame, keys: list[str], col: str = "fingerprint") -> DataFrame:
    """The fingerprint of the union of each group's fingerprints, partial sketches first, so no group meets in one task.

    Hashes are counted down natively: each group's distinct hashes are ranked by partial top-k arrays.
    """
    parts = F.expr(f"transform(sequence(0, greatest(length({col}) div 8 - 1, 0)), i -> substr({col}, i * 8 + 1, 8))")
    # base64 does not sort as bytes do; hexadecimal does.
    rows = df.select(*keys, F.explode(F.when(F.length(col) > 0, parts)).alias("h")).select(*keys, F.hex(F.unbase64("h")).alias("h"))
    salted = rows.withColumn("_s", F.pmod(F.xxhash64("h"), F.lit(64)).cast("int")).distinct()
    some = salted.groupBy(*keys, "_s").agg(F.slice(F.sort_array(F.collect_set("h")), 1, K).alias("hs"))
    top = some.groupBy(*keys).agg(F.slice(F.sort_array(F.flatten(F.collect_list("hs"))), 1, K).alias("hs"))
    return top.select(*keys, F.base64(F.unhex(F.array_join("hs", ""))).alias(col))


def in_order(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``docs`` dealt to ranges of doc_id; each range also holds its successor's first row (``_peek``).

    Range bounds are ids of the table, so the row after a range is known without another pass: its rows are copied to
    the range before; those with the smallest id of all go to the last one, too.
    """
    n = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    q = [i / n for i in range(1, n)]
    row = docs.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.percentile_approx("doc_id", q or [0.5], 10_000).alias("q")).first()
    cuts = sorted({int(x) for x in row["q"] or [] if x > row["lo"]})
    bounds = F.array(*(F.lit(c).cast("long") for c in cuts)) if cuts else F.expr("cast(array() as array<bigint>)")
    # Null ids form the end of the last range.
    part = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))))
    own = docs.withColumn("_part", part.cast("int")).withColumn("_peek", F.lit(False))
    cut = F.array_contains(bounds, F.col("doc_id")) if cuts else F.lit(False)
    first = (F.col("doc_id") == F.lit(row["lo"])) if row["lo"] is not None else F.lit(True)
    where = F.when(cut, F.col("_part") - 1).when(first, F.lit(len(cuts)))
    peeks = own.where(cut | first).withColumn("_part", where.cast("int")).withColumn("_peek", F.lit(True))
    return own.unionByName(peeks).repartition(max(1, len(cuts) + 1), "_part").sortWithinPartitions(
        "_part", "_peek", F.asc_nulls_last("doc_id"), F.asc_nulls_first("text"))


def _edit_batches(batches):
    """Rows in order to (doc_id, text, edited text, next text): each row waits for the one after it."""
    last, out = None, []

    def row(now, nxt):
        text = now[1] or ""
        q = len(text) // 4
        return now[0], text, text[:len(text) - q] + (nxt or "")[:q], nxt or ""

    def emit(rows):
        sets = [[sketch(s) for s in shingle_sets([r[k].encode("utf-8") for r in rows])] for k in (1, 2, 3)]
        digests = [hashlib.sha256(r[2].encode("utf-8")).hexdigest() for r in rows]
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()), pa.array(digests, pa.string()),
            pa.array([to_text(s) for s in sets[0]], pa.string()), pa.array([to_text(s) for s in sets[1]], pa.string()),
            pa.array([resemblance(a, b) for a, b in zip(sets[0], sets[1])], pa.float64()),
            pa.array([resemblance(a, b) for a, b in zip(sets[0], sets[2])], pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    size = 0
    for b in batches:
        ids, parts, peeks = (b.column(c).to_pylist() for c in ("doc_id", "_part", "_peek"))
        texts = b.column("text")
        for k in range(b.num_rows):
            now = (ids[k], texts[k].as_py(), parts[k])
            if last is not None and last[2] == parts[k]:
                out.append(row(last, now[1]))
                size += len(out[-1][1]) + 1
                if size > 1 << 20:
                    yield emit(out)
                    out, size = [], 0
            # Of several copies of the next row the first counts; after it the range is over.
            last = None if peeks[k] else now
    if out:
        yield emit(out)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likeness to the edited and the next document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return in_order(docs).mapInArrow(_edit_batches, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                     "edited_fingerprint string, near_edited double, near_next double")
