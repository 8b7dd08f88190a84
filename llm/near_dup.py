"""MinHash near-duplicates: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

A document's set is its distinct five-word shingles (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``; with fewer
words the whole sequence; null, empty or blank text: an empty set, linked with nothing). Two documents are linked
when ``100 * |A & B| >= percent * |A | B|``; a component's smallest ``doc_id`` names it.

1. One pass over the texts gives each document its SuperMinHash signature (Ertl 2017): an element draws ranks
   along a random permutation of the positions, so a position's minimum comes from distinct ranks and varies
   less than with independent hashes; ranks grow, so a document stops as soon as no later rank can win.
2. Documents with equal sets are one node (pre-aggregated before any shuffle of signatures), so copies never
   become pairs.
3. Bands of signature rows give buckets. Each bucket's members are first held against one pivot only (linear
   in a hot bucket); pairs are verified on the full sets.
4. What the pivots left apart: in buckets that still hold several components, the members outside the largest
   component are held against all others by signature, in blocks of bounded size, and only a spanning forest
   of likely links leaves a block. Clusters of that forest are then compared on full sets, again in blocks and
   skipping pairs that are joined already. So a link between different texts is lost only if no band agrees
   (below 1e-6 at the threshold) or the signature underestimates it by five deviations. Rows, bands and the
   agreement that counts as likely follow from ``percent`` (``banding``, ``likely_at``).

The registered query links at 85 per cent, the pipeline stage at 80.

Null ``doc_id``: the row takes no part, component_id is null and it is kept. Repeated rows of one ``doc_id`` are
one node. Extra columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import U64, components, read_table, shingle_sets, slabs, splitmix, staged

PERCENT = 85
#: The pipeline stage's threshold.
STAGE_PERCENT = 80
#: Chance that no band shows a pair at the threshold.
MISS = 5e-7
#: A position's rank has seven bits.
MAX_WIDTH = 127
BLOCK = 512
#: Bits of the filter that keeps untouched documents out of the shuffle of sets (2 MB, whatever the corpus).
FILTER_BITS = 1 << 24
_FRAC = 25


def banding(percent: int) -> tuple[int, int]:
    """Rows a band and bands: the most rows with which a pair at the threshold is missed with a chance of MISS at most."""
    share = min(percent, 99) / 100
    for rows in range(MAX_WIDTH, 0, -1):
        one = share ** rows
        if 0 < one < 1 and (bands := math.ceil(math.log(MISS) / math.log1p(-one))) * rows <= MAX_WIDTH:
            return rows, bands
    raise ValueError(f"signatures of {MAX_WIDTH} positions cannot show links at {percent} per cent")


def likely_at(percent: int) -> float:
    """Signature agreement from which a pair is verified, five deviations under the threshold, rounded down by a hundredth or more."""
    share = percent / 100
    return math.floor(100 * (share - 5 * math.sqrt(share * (1 - share) / math.prod(banding(percent)))) - 1) / 100


WIDTH = math.prod(banding(PERCENT))


def superminhash(sets: list[np.ndarray], width: int = WIDTH, seed: int = 7) -> np.ndarray:
    """SuperMinHash signatures (one row per set, uint32: 7 bits of rank above 25 random bits); empty sets: all ones."""
    sig = np.full((len(sets), width), 0xFFFFFFFF, dtype=np.uint32)
    for i, j in slabs([len(s) for s in sets], 1 << 16) if sets else ():
        sizes = np.array([len(s) for s in sets[i:j]])
        if not sizes.sum():
            continue
        el = np.concatenate(sets[i:j])
        doc = np.repeat(np.arange(j - i), sizes)
        part = sig[i:j]
        flat = part.reshape(-1)
        perm = None
        for step in range(width):
            with np.errstate(over="ignore"):
                x = splitmix(el ^ U64((seed * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03) & (2**64 - 1)))
            value = (U64(step) << U64(_FRAC) | x >> U64(64 - _FRAC)).astype(np.uint32)
            pick = (step + ((x & U64(0x7FFFFFFF)) * U64(width - step) >> U64(31))).astype(np.intp)
            if step == 0:
                place = pick
            else:
                rows = np.arange(len(el))
                place = perm[rows, pick].astype(np.intp)
                perm[rows, pick] = perm[:, step]
            np.minimum.at(flat, doc * width + place, value)
            # A document goes on while some position could still fall to a later rank.
            on = part.max(axis=1) >= np.uint32((step + 1) << _FRAC) if step + 1 < width else np.zeros(j - i, bool)
            on &= sizes > 0
            keep = on[doc]
            if not keep.any():
                break
            if step == 0:
                el, doc, pick = el[keep], doc[keep], pick[keep]
                perm = np.tile(np.arange(width, dtype=np.uint8), (len(el), 1))
                perm[np.arange(len(el)), pick] = 0
            elif not keep.all():
                el, doc, perm = el[keep], doc[keep], perm[keep]
    return sig


def _lengths(texts: pa.Array) -> list[int]:
    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()


def _signature_maker(width: int):
    def run(batches):
        for b in batches:
            texts, ids = b.column("text").cast(pa.binary()), b.column("doc_id")
            for i, j in slabs(_lengths(texts)) if len(texts) else ():
                sets = shingle_sets(texts.slice(i, j - i).to_pylist())
                sig = superminhash(sets, width)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([x.tobytes() if len(s) else None for x, s in zip(sig, sets)], pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "sig"])
    return run


def _band_maker(rows: int, bands: int):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, bands, rows).astype(U64)
            with np.errstate(over="ignore"):
                key = np.broadcast_to(np.arange(bands, dtype=U64) * U64(0xD1B54A32D192ED03), sig.shape[:2])
                for k in range(rows):
                    key = splitmix(key ^ sig[:, :, k])
            yield pa.RecordBatch.from_arrays([
                pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(np.asarray(b.column("rep")), bands)),
                pa.array(np.repeat(np.asarray(b.column("n_shingles")), bands))], names=["bucket", "rep", "n"])
    return run


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = shared(a, b)
    return len(a) > 0 and len(b) > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _set_maker(bits: np.ndarray | None):
    def run(batches):
        for b in batches:
            ids = np.asarray(b.column("doc_id"))
            if bits is not None and len(ids):
                with np.errstate(over="ignore"):
                    h = splitmix(ids.astype(np.int64).view(U64)) % U64(FILTER_BITS)
                hit = np.flatnonzero(bits[(h >> U64(3)).astype(np.intp)] >> (h & U64(7)).astype(np.uint8) & 1)
                b = b.take(pa.array(hit))
                ids = ids[hit]
            texts = b.column("text").cast(pa.binary())
            for i, j in slabs(_lengths(texts)) if len(texts) else ():
                sets = shingle_sets(texts.slice(i, j - i).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 names=["doc_id", "set"])
    return run


def _mark_batches(batches):
    for b in batches:
        with np.errstate(over="ignore"):
            h = splitmix(np.asarray(b.column(0)).astype(np.int64).view(U64)) % U64(FILTER_BITS)
        words = np.unique(h)
        at, first = np.unique(words >> U64(5), return_index=True)
        masks = np.bitwise_or.reduceat(np.int64(1) << (words & U64(31)).astype(np.int64), first) if len(first) else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(masks, pa.int64())], names=["w", "m"])


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, set) of the documents in ``ids``. A filter of fixed size leaves most others out of the shuffle."""
    marks = ids.mapInArrow(_mark_batches, "w long, m long").groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    words = np.zeros(FILTER_BITS // 32, np.uint32)
    words[marks["w"].to_numpy(np.int64)] = marks["m"].to_numpy(np.int64).astype(np.uint32)
    sets = docs.where("doc_id is not null").mapInArrow(_set_maker(words.view(np.uint8)), "doc_id long, set binary")
    return sets.join(ids, "doc_id", "left_semi")


def _views(sets: pa.BinaryArray) -> list[np.ndarray]:
    """Sets of a column without nulls, as views on its buffer."""
    _, offsets, data = sets.buffers()
    at = np.frombuffer(offsets, np.int32)[sets.offset:sets.offset + len(sets) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return [raw[i:j].view(U64) for i, j in zip(at[:-1], at[1:])]


def _verify_maker(percent: int):
    def run(batches):
        for b in batches:
            ok = [linked(x, y, percent) for x, y in zip(_views(b.column("set_a")), _views(b.column("set_b")))]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def verified(docs: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those ``pairs`` (a, b) of doc ids whose full shingle sets meet the threshold."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    sets = staged(sets_of(docs, ids), "sets")
    both = (pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b")), "b")
            .join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a")), "a"))
    return both.select("a", "b", "set_a", "set_b").mapInArrow(_verify_maker(percent), "a long, b long")


def _blocks(rows: DataFrame, group: str) -> DataFrame:
    """Deal each group's rows (group, id, comp, payload) to block pairs: all rows outside the group's largest component
    (side 0) meet every row (side 1). A block has about BLOCK rows a side, however large the group."""
    sizes = rows.groupBy(group, "comp").agg(F.count("*").alias("n"))
    top = sizes.groupBy(group).agg(F.max(F.struct("n", (-F.col("comp")).alias("c"))).alias("t"), F.sum("n").alias("all"),
                                   F.count("*").alias("k")).where("k > 1")
    top = top.select(group, (-F.col("t.c")).alias("main"), F.ceil(F.col("all") / BLOCK).cast("int").alias("n1"),
                     F.ceil((F.col("all") - F.col("t.n")) / BLOCK).cast("int").alias("n0"))
    r = rows.join(top, group)
    h = F.xxhash64("id")
    right = r.select(group, "id", "comp", "payload", F.lit(1).alias("side"), (F.col("comp") == F.col("main")).alias("ismain"),
                     F.explode(F.sequence(F.lit(0), F.col("n0") - 1)).alias("i"), F.pmod(h, F.col("n1")).cast("int").alias("j"))
    left = r.where("comp <> main").select(
        group, "id", "comp", "payload", F.lit(0).alias("side"), F.lit(False).alias("ismain"),
        F.pmod(h, F.col("n0")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("n1") - 1)).alias("j"))
    return left.unionByName(right)


class _Forest:
    """Union-find of one block, started from the known components."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        while self.parent.get(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def _block_links(pdf, likely: float, width: int, percent: int | None):
    """Links across components of one block: by signature alone (percent None) or on full sets."""
    import pandas as pd
    a, b = pdf[pdf.side == 0], pdf[pdf.side == 1]
    out = []
    if len(a) and len(b):
        if percent is None:
            sets = None
            sa = np.frombuffer(b"".join(a.payload), np.uint32).reshape(len(a), width)
            sb = np.frombuffer(b"".join(b.payload), np.uint32).reshape(len(b), width)
        else:
            sets = [[np.frombuffer(x, U64) for x in side.payload] for side in (a, b)]
            sa, sb = superminhash(sets[0], width), superminhash(sets[1], width)
        ida, idb, ca, cb = a.id.to_numpy(), b.id.to_numpy(), a.comp.to_numpy(), b.comp.to_numpy()
        main = b.ismain.to_numpy()
        uf = _Forest()
        for x in range(len(a)):
            # Two rows outside the main component meet twice; the smaller id keeps the pair.
            ok = np.flatnonzero((cb != ca[x]) & (main | (idb < ida[x])))
            like = (sb[ok] == sa[x]).mean(axis=1) if len(ok) else np.empty(0)
            for y in ok[np.argsort(-like, kind="stable")][: int((like >= likely).sum())]:
                if uf.find(ca[x]) == uf.find(cb[y]):
                    continue
                if sets is None or linked(sets[0][x], sets[1][y], percent):
                    uf.join(ca[x], cb[y])
                    out.append((idb[y], ida[x]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def with_components(reps: DataFrame, comps: DataFrame, col: str = "rep") -> DataFrame:
    c = comps.select(F.col("node").alias(col), F.col("component").alias("_c"))
    return reps.join(c, col, "left").withColumn("comp", F.coalesce("_c", col)).drop("_c")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_rows, n_bands = banding(percent)
    width, agree = n_rows * n_bands, likely_at(percent)
    sigs = staged(docs.mapInArrow(_signature_maker(width), "doc_id long, n_shingles long, digest binary, sig binary"), "sig")
    reps = staged(sigs.where("doc_id is not null and digest is not null").groupBy("digest")
                  .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "reps")
    rows = reps.select("rep", "n_shingles", "sig").mapInArrow(_band_maker(n_rows, n_bands), "bucket long, rep long, n long")
    pivots = rows.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("p"), F.max("rep").alias("last"))
    members = staged(rows.join(pivots.where("p.rep <> last"), "bucket").select(
        "bucket", "rep", "n", F.col("p.rep").alias("pivot"), F.col("p.n").alias("pn")), "members")
    fits = 100 * F.least("n", "pn") >= percent * F.greatest("n", "pn")
    star = staged(members.where((F.col("rep") != F.col("pivot")) & fits)
                  .select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "star")
    links = staged(verified(docs, star, percent), "links")
    comps = components(links)

    # Buckets with several components left: likely links by signature, then full sets inside their clusters.
    left = with_components(members.select("bucket", "rep"), comps)
    open_ = left.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    left = staged(left.join(open_, "bucket", "left_semi"), "open")
    payload = staged(left.join(reps.select("rep", F.col("sig").alias("payload")), "rep").select(
        "bucket", F.col("rep").alias("id"), "comp", "payload"), "payload")
    likely = staged(_blocks(payload, "bucket").groupBy("bucket", "i", "j")
                    .applyInPandas(lambda p: _block_links(p, agree, width, None), "a long, b long").distinct(), "likely")
    joined = with_components(likely.select(F.col("a").alias("rep"), "b"), comps).select(F.col("b").alias("rep"), F.col("comp").alias("a"))
    clusters = components(with_components(joined, comps).select("a", F.col("comp").alias("b")))
    # All open members of the components that a cluster joins take part, not only the ends of the forest.
    in_cluster = with_components(left.select("rep", F.col("comp").alias("c0")).distinct(), clusters, "c0") \
        .withColumnRenamed("comp", "cluster")
    busy = in_cluster.groupBy("cluster").agg(F.min("c0").alias("lo"), F.max("c0").alias("hi")).where("lo <> hi").select("cluster")
    todo = staged(in_cluster.join(busy, "cluster", "left_semi").select(
        "cluster", F.col("rep").alias("doc_id"), F.col("c0").alias("comp")), "todo")
    sets = sets_of(docs, todo.select("doc_id").distinct())
    work = staged(todo.join(sets, "doc_id").select("cluster", F.col("doc_id").alias("id"), "comp", F.col("set").alias("payload")), "work")
    more = staged(_blocks(work, "cluster").groupBy("cluster", "i", "j").applyInPandas(
        lambda p: _block_links(p, agree, width, percent), "a long, b long"), "more")
    all_links = links.unionByName(more).unionByName(comps.select(F.col("node").alias("a"), F.col("component").alias("b")))
    comps = components(all_links)

    named = with_components(reps.select("digest", "rep"), comps).select("digest", F.col("comp").alias("component"))
    out = sigs.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates of all documents."""
    return near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def _nodes(docs: DataFrame) -> DataFrame:
    """``docs`` with a long ``_node`` for each distinct (doc_id, text): the doc_id, or for a text without one and for the
    second and later texts of one id, a number above all ids (an error if the ids leave no room there)."""
    h = F.unhex(F.sha2(F.coalesce(F.concat(F.lit("t"), F.col("text").cast("string")), F.lit("n")), 256))
    rows = docs.withColumn("_node", F.col("doc_id").cast("long")).withColumn("_h", h)
    texts = rows.groupBy("_node").agg(F.min("_h").alias("lo"), F.max("_h").alias("hi"))
    several = texts.where("_node is not null and lo <> hi").select("_node", "lo")
    keys = rows.select("_node", "_h")
    more = (keys.join(several, "_node").where("_h <> lo").drop("lo").unionByName(keys.where("_node is null")).distinct())
    more = staged(more.withColumn("_n", F.monotonically_increasing_id()), "unnamed")
    if more.isEmpty():
        return rows.drop("_h")
    top = max(rows.agg(F.max("_node")).first()[0] or 0, 0)
    named = more.select(F.col("_node").alias("_i"), F.col("_h").alias("_t"), (F.lit(top + 1).cast("long") + F.col("_n")).alias("_s"))
    both = rows.join(named, rows["_node"].eqNullSafe(named["_i"]) & (rows["_h"] == named["_t"]), "left")
    return both.withColumn("_node", F.coalesce("_s", "_node")).drop("_h", "_i", "_t", "_s")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Pipeline stage: one row of each group stays, of its smallest doc_id (a row without one only in a group without any).

    Groups link at STAGE_PERCENT. Rows of one doc_id and one text are copies, of which the smallest row stays; other texts of
    that id, and texts without an id, are documents of their own that come after all ids. An empty or blank text is a group
    by itself, as it is linked with nothing; its copies without an id are one document, too.
    """
    cols = docs.columns
    rows = _nodes(docs)
    found = near_duplicates(rows.select(F.col("_node").alias("doc_id"), "text"), STAGE_PERCENT).where("kept")
    kept = staged(found.groupBy("doc_id").agg(F.count("*").alias("n")).withColumnRenamed("doc_id", "_node"), "kept")
    once = rows.join(kept.where("n = 1"), "_node", "left_semi").select(cols)
    again = kept.where("n > 1").select("_node")
    if again.isEmpty():
        return once
    # Partial minima first, so copies don't meet in one task.
    copies = rows.join(again, "_node", "left_semi").select("_node", F.struct(*cols).alias("_r"))
    return once.unionByName(copies.groupBy("_node").agg(F.min("_r").alias("_r")).select("_r.*"))
