"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's subwords are its character 1- to 4-grams (A-Z lower-cased, words fenced by blanks) hashed to BUCKETS rows of
an embedding table; their average goes through a linear softmax. Both are trained in numpy by stochastic gradient
descent on a bounded sample: at most SAMPLE labelled rows for each of the languages (those with the smallest hash of
doc_id and text), whole texts. A quarter of the sample calibrates: a temperature for the probabilities, and the
probability below which an answer is marked as rejected.

Prediction covers whole texts in Arrow batches. As everything after the table is linear, embedding and softmax rows
are multiplied once after training, so a subword costs one lookup of as many numbers as there are languages.

Null text, or a text without a letter: ``und``, score 0, rejected. Without any labelled row the same. Repeated rows are
predicted one by one; rows with a null label are not learned from; extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import U64, read_table, slabs, splitmix

BUCKETS = 1 << 16
DIM = 16
NGRAMS = (1, 2, 3, 4)
#: Labelled rows per language that training may see; all languages are learned.
SAMPLE = 600
EPOCHS = 12
#: An answer is rejected below the probability that this share of correct calibration answers reaches.
KEEP = 0.99
UNDETERMINED = "und"


def subwords(raw: bytes) -> np.ndarray:
    """Hashed 1- to 4-grams of code points; white space and signs become one blank."""
    cp = np.frombuffer(raw.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    if not len(cp):
        return np.empty(0, np.intp)
    blank = (cp < 65) | ((cp > 90) & (cp < 97)) | ((cp > 122) & (cp < 192)) | (cp == 0xFFFD)
    cp = np.where(blank, 32, cp)
    keep = np.concatenate(([True], ~(blank[1:] & blank[:-1])))
    cp = np.concatenate(([32], cp[keep], [32])).astype(U64)
    out = []
    with np.errstate(over="ignore"):
        h = np.zeros(len(cp), U64)
        for n in NGRAMS:
            if len(cp) < n:
                break
            h = h[:len(cp) - n + 1] * U64(0x100000001B3) + cp[n - 1:] + U64(1)
            out.append((splitmix(h + U64(n)) >> U64(48)).astype(np.intp) % BUCKETS)
    return np.concatenate(out)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, seed: int = 3):
    """SGD over documents, each given as (buckets, weights adding to 1): the embedding table and the softmax."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    soft = np.zeros((DIM, n_labels))
    steps, at = EPOCHS * max(1, len(rows)), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            lr = 1.0 * (1 - at / steps)
            at += 1
            b, w = rows[k]
            mean = w @ table[b]
            z = mean @ soft
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = soft @ p
            soft -= lr * np.outer(mean, p)
            # Subwords share the step by weight; the table's rate is raised since each weight is small.
            table[b] -= lr * 50 * w[:, None] * back
    return table, soft


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """The temperature with the least log loss, and the probability that KEEP of the correct answers reach."""
    if not len(labels):
        return 1.0, 0.0

    def prob(t):
        z = logits / t
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    at = np.arange(len(labels))
    temp = min(np.geomspace(0.05, 20, 60), key=lambda t: -np.log(prob(t)[at, labels] + 1e-12).mean())
    p = prob(temp)
    good = np.sort(p.max(axis=1)[p.argmax(axis=1) == labels])
    return float(temp), float(good[int((1 - KEEP) * len(good))]) if len(good) else 0.0


def _counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    b, n = np.unique(subwords(raw), return_counts=True)
    return b, n / max(1, n.sum())


def _feature_batches(batches):
    for b in batches:
        out = [_counts(t or b"") for t in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            b.column("label"), b.column("h"), pa.array([x.astype(np.int32).tobytes() for x, _ in out], pa.binary()),
            pa.array([w.astype(np.float32).tobytes() for _, w in out], pa.binary())], names=["label", "h", "b", "w"])


def learn(labelled: DataFrame) -> dict:
    """A model from (doc_id, text, label). The sample is drawn by hash: a share first, then the exact smallest, so that
    no language's rows are sorted in one task."""
    rows = labelled.where("label is not null and text is not null").withColumn("h", F.xxhash64(F.col("doc_id"), F.col("text")))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {"labels": [], "scores": np.zeros((BUCKETS, 0)), "temperature": 1.0, "reject": 0.0}
    labels = sorted(sizes)
    share = F.create_map(*(x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, 2 * SAMPLE / n)))))
    # The mean of a hash that is uniform over 64 bits: rows beyond twice the sample's share never leave their task.
    some = rows.where((F.col("h") / F.lit(2.0 ** 64) + 0.5) <= F.element_at(share, F.col("label")))
    from pyspark.sql import Window
    some = some.withColumn("_k", F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id"))).where(F.col("_k") <= SAMPLE)
    got = some.select("label", "h", "text").mapInArrow(_feature_batches, "label string, h long, b binary, w binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["label"], r["h"], r["b"]))
    feats = [(np.frombuffer(r["b"], np.int32).astype(np.intp), np.frombuffer(r["w"], np.float32).astype(np.float64)) for r in got]
    y = np.array([labels.index(r["label"]) for r in got])
    held = np.arange(len(got)) % 4 == 3
    table, soft = train([f for f, x in zip(feats, held) if not x], y[~held], len(labels))
    scores = table @ soft
    logits = np.array([w @ scores[b] for (b, w), x in zip(feats, held) if x]).reshape(-1, len(labels))
    temp, reject = calibrate(logits, y[held])
    return {"labels": labels, "scores": (scores / temp).astype(np.float32), "temperature": temp, "reject": reject}


def predict(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``df`` without its text and with lang_pred, score (calibrated probability) and rejected (below the cut)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers for each label
    names = [c for c in df.columns if c not in (text_col, "lang_pred", "score", "rejected")]
    text, letters = "_text", "_letter"
    # Carried columns are numbered meanwhile: mapInArrow looks its input up by name, and a name may hold a dot.
    frame = df.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)), F.col(text_col).cast("string").alias(text),
                      F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias(letters))

    def run(batches):
        m = shared.value
        scores, labels = m["scores"], m["labels"]
        for b in batches:
            texts, letter = b.column(text).cast(pa.binary()).to_pylist(), b.column(letters).to_pylist()
            for i, j in slabs([len(t or b"") for t in texts]) if texts else ():
                lang, score = [], []
                for t, ok in zip(texts[i:j], letter[i:j]):
                    if not ok or not labels:
                        lang.append(UNDETERMINED)
                        score.append(0.0)
                        continue
                    # A long text goes through in pieces: the average is a sum of sums.
                    total, n = np.zeros(len(labels)), 0
                    for at in range(0, len(t), 1 << 20):
                        sub = subwords(t[at:at + (1 << 20)])
                        total += np.bincount(sub, minlength=BUCKETS) @ scores if len(sub) > BUCKETS else scores[sub].sum(axis=0, dtype=np.float64)
                        n += len(sub)
                    z = total / max(1, n)
                    p = np.exp(z - z.max())
                    p /= p.sum()
                    lang.append(labels[int(p.argmax())])
                    score.append(float(p.max()))
                rest = [b.column(k).slice(i, j - i) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                                  pa.array([x == UNDETERMINED or s < m["reject"] for x, s in zip(lang, score)], pa.bool_())],
                                                 names=[*names, "lang_pred", "score", "rejected"])

    schema = df.select(*(F.col(f"`{c}`") for c in names)).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return frame.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for ids that must not be learned from; a null id counts as the empty text."""
    return (F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document, learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = learn(docs.where(~held_out()).select("doc_id", "text", F.col("lang").alias("label")))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")
