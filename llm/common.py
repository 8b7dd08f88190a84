"""Shared helpers of the training-data operators: scratch tables, word and shingle hashes, components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwire.streaming.replay import scratch_path

U64 = np.uint64
#: Bytes of text that a vectorised kernel works on at once; a longer document goes through it in pieces.
SLAB = 1 << 20
#: Bytes of an Arrow batch. Spark's own bound, 10,000 rows or 64 MB, is held several times over by both sides of each task.
BATCH_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_SHINGLE_MULT = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                          0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=U64)


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by BATCH_BYTES, unless it has a bound of its own; a larger row is a batch."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def staged(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, f"llm-{kind}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def utf8_bytes(arr: pa.Array) -> list[bytes | None]:
    """The raw UTF-8 of a string column, without decoding."""
    return arr.cast(pa.binary()).to_pylist() if not pa.types.is_binary(arr.type) else arr.to_pylist()


def slabs(sizes: Iterable[int], limit: int = SLAB) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of items whose sizes add up to about ``limit``; an item above it stands alone."""
    i, total, j = 0, 0, 0
    for j, n in enumerate(sizes):
        if j > i and total + n > limit:
            yield i, j
            i, total = j, 0
        total += n
    if i <= j and total + j - i >= 0:
        yield i, j + 1


def splitmix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        m = max(n, SLAB + 4096)
        with np.errstate(over="ignore"):
            for name, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
                full = np.full(m, base, dtype=U64)
                full[0] = 1
                _POWERS[name] = np.multiply.accumulate(full)
    return _POWERS["p"], _POWERS["i"]


def is_space(buf: np.ndarray) -> np.ndarray:
    return (buf == 32) | ((buf >= 9) & (buf <= 13))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of ``raw``, A-Z lower-cased, and their byte offsets."""
    buf = np.frombuffer(raw, dtype=np.uint8)
    if not len(buf):
        return np.empty(0, U64), np.empty(0, np.int64)
    space = is_space(buf)
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    low = buf + ((buf >= 65) & (buf <= 90)).astype(np.uint8) * np.uint8(32)
    p, inv = _powers(len(buf))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(buf) + 1, dtype=U64)
        np.cumsum((low.astype(U64) + U64(1)) * p[:len(buf)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(U64) * U64(_BASE)
    return splitmix(h), starts


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Cut a long text at white space about every SLAB bytes (a longer word stays whole)."""
    at = 0
    while at < len(raw):
        end = at + SLAB
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1
        yield raw[at:end]
        at = end


def shingle_sets(texts: list[bytes | None], width: int = 5) -> list[np.ndarray]:
    """For each text, the sorted distinct 64-bit hashes of its ``width``-word shingles.

    A text of fewer words gives its whole word sequence as one shingle; null, empty and blank texts none.
    """
    out: list[np.ndarray] = []
    raws = [t or b"" for t in texts]
    for i, j in slabs([len(r) + 1 for r in raws]) if raws else ():
        if j - i == 1 and len(raws[i]) > SLAB:
            words, bounds = np.concatenate([word_hashes(p)[0] for p in _pieces(raws[i])]), None
            bounds = np.array([0, len(words)])
        else:
            words, starts = word_hashes(b"\n".join(raws[i:j]))
            offs = np.cumsum([0] + [len(r) + 1 for r in raws[i:j]])
            bounds = np.searchsorted(starts, offs)
        with np.errstate(over="ignore"):
            n = len(words) - width + 1
            if n > 0:
                acc = words[:n] * _SHINGLE_MULT[0]
                for k in range(1, width):
                    acc = acc + words[k:n + k] * _SHINGLE_MULT[k % 5] * U64(2 * (k // 5) + 1)
                full = splitmix(acc)
            for a, b in zip(bounds[:-1], bounds[1:]):
                if b - a >= width:
                    out.append(np.unique(full[a:b - width + 1]))
                elif b > a:
                    short = (words[a:b] * _SHINGLE_MULT[:b - a] if width <= 5 else words[a:b]).sum(dtype=U64)
                    out.append(splitmix(np.array([short + U64(b - a) * U64(0xC2B2AE3D27D4EB4F)], U64)))
                else:
                    out.append(np.empty(0, U64))
    return out


def contracted(pairs: Iterable[tuple]) -> list[tuple]:
    """Union-find over one batch of links: (node, root) for each node that is not its own root; roots are minima."""
    parent: dict = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return [(x, find(x)) for x in parent]


def _contract_batches(batches):
    for b in batches:
        links = contracted(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()),
                                          pa.array([r for _, r in links], pa.int64())], names=["a", "b"])


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``links`` (long ids): columns node, component (smallest id reachable).

    Union-find contracts each Arrow batch; large-star and small-star rounds (group by node, minimum, join back)
    then merge the forests across partitions until nothing changes. No node's neighbours are gathered in one
    task or on the driver. Every node of ``links`` with another component than itself has a row.
    """
    e = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    e = staged(e.mapInArrow(_contract_batches, "a long, b long").distinct(), "forest")
    mark = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = tuple(now)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
                 .unionByName(low.where("m < a").select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = staged(small, "forest")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], salt: Column, salts: int = 16) -> DataFrame:
    """Left join on ``keys``; a hot key's left rows are dealt over ``salts`` partitions, right rows are repeated.

    ``right`` holds at most one row per key, so it grows by the factor ``salts`` and no more.
    """
    lhs = left.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    rhs = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return lhs.join(rhs, [*keys, "_salt"], "left").drop("_salt")
