"""Quality by weak labels: heuristic labellers, expectation-maximisation, and a hashed linear scorer.

Each labeller reads one trait of the whole text and votes good (+1), bad (-1) or abstains (0). The votes of all
documents are counted by pattern (at most 3^labellers rows, whatever the corpus). Expectation-maximisation over the
patterns estimates, for good text and each kind of bad text, how each labeller votes, and so each pattern's probability of being good. These
posteriors label a bounded sample (the SAMPLE documents of a hash share, whole texts), on which a logistic scorer
over hashed word shapes and hashed traits is trained in numpy; it then scores every document.

Null, empty and blank texts have no words: score 0, rejected. With no documents, or none with a usable vote, nothing can be
learned and every document with a word is kept with score 0.5. Repeated rows are scored one by one; columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import U64, is_space, read_table, small_batches, unused, word_hashes

LABELLERS = ["symbols", "capitals", "signs", "shouting", "common_words", "repeats", "sentences"]
#: Labellers whose bad vote names a kind of bad text; the others only support.
KINDS = ["symbols", "capitals", "signs", "shouting", "repeats"]
#: Frequent function words of the languages at hand (English, German, French, Spanish).
COMMON = ("the of and to in is that it was for on are as with this be by at from der die das und ist ein eine den von zu mit für auf "
          "le la les de des et un une est en que dans pour du el los las y es una por con para se").split()
BUCKETS = 1 << 14
#: Documents that the scorer is trained on, at most.
SAMPLE = 4000
THRESHOLD = 0.5
EM_ROUNDS = 30

# Byte classes for shapes: lower-case and non-ASCII letters x, capitals X, digits 9, other signs as they are.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[128:], _CLASS[65:91], _CLASS[48:58] = 120, 120, 88, 57
_SENTENCE = np.zeros(256, bool)
_SENTENCE[[ord(c) for c in ".,;:'\"-?()"]] = True


def shapes(buf: np.ndarray) -> np.ndarray:
    """Hash of each word's shape: classes of its bytes, runs as one."""
    cls = _CLASS[buf]
    space = is_space(buf)
    keep = np.concatenate(([True], cls[1:] != cls[:-1])) | space
    packed = np.where(space, np.uint8(32), cls)[keep]
    return word_hashes(packed.tobytes())[0]


def _vote(value: float, good: tuple[float, float], bad: tuple[float, float]) -> int:
    return 1 if good[0] <= value <= good[1] else -1 if bad[0] <= value <= bad[1] else 0


class Traits:
    """Sums over a text, piece by piece, so that a long text needs no large arrays."""

    def __init__(self):
        self.hist, self.words, self.signs, self.common, self.again = np.zeros(256, np.int64), 0, 0, 0, 0
        self.shape = np.zeros(BUCKETS)
        self.stop = np.sort(word_hashes(" ".join(COMMON).encode())[0])

    def add(self, piece: bytes) -> None:
        buf = np.frombuffer(piece, np.uint8)
        self.hist += np.bincount(buf, minlength=256)
        words, starts = word_hashes(piece)
        self.words += len(words)
        if len(words):
            letter = (_CLASS[buf] == 120) | (_CLASS[buf] == 88) | (_CLASS[buf] == 57)
            self.signs += int((np.add.reduceat(letter, starts, dtype=np.int64) == 0).sum())
            at = np.searchsorted(self.stop, words)
            at[at == len(self.stop)] = 0
            self.common += int((self.stop[at] == words).sum())
            self.shape += np.bincount((shapes(buf) >> U64(50)).astype(np.intp), minlength=BUCKETS)
            self.again += int((words[1:] == words[:-1]).sum())

    def votes(self) -> list[int]:
        h, n = self.hist, max(1, self.words)
        letters = max(1, int(h[65:91].sum() + h[97:123].sum() + h[128:].sum()))
        solid = max(1, int(h.sum() - h[9:14].sum() - h[32]))
        ascii_signs = int(h[33:48].sum() + h[58:65].sum() + h[91:97].sum() + h[123:127].sum())
        symbols = (ascii_signs - int(h[_SENTENCE].sum())) / solid
        long_enough = self.words >= 20
        return [
            _vote(symbols, (0, 0.03), (0.08, 1)),
            _vote(int(h[65:91].sum()) / letters, (0, 0.15), (0.3, 1)) if self.words >= 5 else 0,
            _vote(self.signs / n, (0, 0.02), (0.1, 1)) if self.words >= 10 else 0,
            _vote(int(h[33]) / n, (0, 0.02), (0.15, 99)),
            _vote(self.common / n, (0.1, 1), (0, 0.03)) if long_enough else 0,
            _vote(self.again / n, (0, 0.05), (0.15, 1)) if self.words >= 5 else 0,
            _vote(int(h[46]) / n, (0.02, 0.5), (0, 0.002)) if long_enough else 0,
        ]

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashed features: the share of each word shape, and each trait's class."""
        b = np.flatnonzero(self.shape)
        votes = np.array([BUCKETS - 1 - 3 * k - (v + 1) for k, v in enumerate(self.votes())])
        return (np.concatenate([b % (BUCKETS - 3 * len(LABELLERS)), votes]),
                np.concatenate([self.shape[b] / max(1, self.words), np.full(len(votes), 0.5)]))


def _traits(raw: bytes) -> Traits:
    t = Traits()
    at = 0
    while at < len(raw):
        end = at + (1 << 20)
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1
        t.add(raw[at:end])
        at = end
    return t


def _vote_batches(batches):
    for b in batches:
        out = []
        for raw in b.column("text").cast(pa.binary()).to_pylist():
            t = _traits(raw or b"")
            out.append(int(sum((v + 1) * 3 ** k for k, v in enumerate(t.votes()))) if t.words else None)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int32())], names=["pattern"])


def _sample_maker(posteriors: dict[int, float]):
    def run(batches):
        for b in batches:
            rows = []
            for h, raw in zip(b.column("h").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                t = _traits(raw or b"")
                if t.words:
                    f, w = t.features()
                    p = posteriors[int(sum((v + 1) * 3 ** k for k, v in enumerate(t.votes())))]
                    rows.append((h, f.astype(np.int32).tobytes(), w.astype(np.float32).tobytes(), p))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                (pa.int64(), pa.binary(), pa.binary(), pa.float64()))], names=["h", "f", "w", "p"])
    return run


def expectation_maximisation(patterns: dict[int, int], n_labellers: int = len(LABELLERS)) -> tuple[dict[int, float], np.ndarray]:
    """From counts by vote pattern: the probability of good for each pattern, and P(bad vote | class, a vote) as [class, labeller].

    Class 0 is good. Bad text comes in kinds that share little, so each labeller of KINDS has a bad class of its own, where the
    others may well vote good and its own nearly always votes bad; one bad class for all would call their joint good votes proof against the one bad vote.
    """
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    votes = np.array([[k // 3 ** j % 3 for j in range(n_labellers)] for k in keys])
    kinds = [LABELLERS.index(x) for x in KINDS]
    bad = (votes[:, kinds] == 0).astype(float)
    share = np.concatenate([np.where(bad.any(axis=1), 0.05, 0.95)[:, None],
                            np.where(bad.any(axis=1)[:, None], 0.95 * bad / np.maximum(1, bad.sum(axis=1))[:, None], 0.05 / len(kinds))], axis=1)
    for _ in range(EM_ROUNDS):
        weight = n[:, None] * share
        prior = (weight.sum(axis=0) + 1) / (weight.sum() + share.shape[1])
        chance = np.stack([weight.T @ (votes == v) for v in (0, 2)], axis=2) + [0.5, 0.5]
        chance = chance[:, :, 0] / chance.sum(axis=2)  # of a bad vote, given a vote: an abstention says nothing
        chance[0, kinds] = np.minimum(chance[0, kinds], 0.1)
        chance[1 + np.arange(len(kinds)), kinds] = np.maximum(chance[1 + np.arange(len(kinds)), kinds], 0.9)
        z = np.log(prior)[None, :] + (votes == 0) @ np.log(chance).T + (votes == 2) @ np.log1p(-chance).T
        share = np.exp(z - z.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
    return dict(zip(keys, share[:, 0].tolist())), chance


def train(feats: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 20, seed: int = 5) -> tuple[np.ndarray, float]:
    """Logistic scorer by stochastic gradient descent on soft labels; both classes weigh the same."""
    w, bias = np.zeros(BUCKETS), 0.0
    if not len(feats):
        return w, bias
    rng = np.random.default_rng(seed)
    share = float(np.clip(target.mean(), 0.02, 0.98))
    for e in range(epochs):
        for k in rng.permutation(len(feats)):
            f, x = feats[k]
            p = 1 / (1 + np.exp(-(w[f] @ x + bias)))
            cost = target[k] / (2 * share) + (1 - target[k]) / (2 * (1 - share))
            step = 1.0 / (1 + 0.2 * e) * cost * (target[k] - p)
            np.add.at(w, f, step * x)
            bias += 0.1 * step
    return w, bias


def learn(docs: DataFrame) -> dict:
    """The scorer, from the texts alone (column text); labels are never read."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    patterns = {r["pattern"]: r["n"] for r in texts.mapInArrow(_vote_batches, "pattern int").where("pattern is not null")
                .groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    if not patterns:
        return {"w": np.zeros(BUCKETS), "bias": 0.0, "chance": None}
    posteriors, chance = expectation_maximisation(patterns)
    total = sum(patterns.values())
    rows = texts.where("text is not null").withColumn("h", F.xxhash64("text"))
    # Twice the wanted share by hash, then exactly the smallest: bounded, and the same rows in any order.
    share = min(1.0, 2 * SAMPLE / total)
    some = rows.where(F.col("h") / F.lit(2.0 ** 64) + 0.5 <= share).dropDuplicates(["h"])
    got = some.mapInArrow(_sample_maker(posteriors), "h long, f binary, w binary, p double").orderBy("h").limit(SAMPLE).collect()
    feats = [(np.frombuffer(r["f"], np.int32).astype(np.intp), np.frombuffer(r["w"], np.float32).astype(np.float64)) for r in got]
    w, bias = train(feats, np.array([r["p"] for r in got]))
    return {"w": w, "bias": bias, "chance": chance}


def _scorer(shared):
    """The probability of good for each text; only texts travel to Python and only numbers back."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w, bias = shared.value
        for texts in batches:
            out = []
            for raw in texts.cast(pa.binary()).to_pylist():
                t = _traits(raw or b"")
                f, x = t.features()
                out.append(float(1 / (1 + np.exp(-(w[f] @ x + bias)))) if t.words else 0.0)
            yield pa.array(out, pa.float64())
    return F.arrow_udf(run, "double")


def score(df: DataFrame, model: dict, text_col: str = "text", keep_text: bool = False, out: tuple[str, str] = ("quality", "keep")) -> DataFrame:
    """``df`` with the columns ``out``: quality (probability of good, 0 to 1) and keep; without the text unless ``keep_text``."""
    small_batches(df.sparkSession)
    judge = _scorer(df.sparkSession.sparkContext.broadcast((model["w"], model["bias"])))
    names = [c for c in df.columns if c not in out and (keep_text or c != text_col)]
    judged = df.select(*(F.col(f"`{c}`") for c in names), judge(F.col(f"`{text_col}`").cast("string")).alias(out[0]))
    return judged.withColumn(out[1], F.col(out[0]) >= THRESHOLD)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and verdict of all documents."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return score(docs, learn(docs))


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Pipeline stage: documents that the scorer rejects go."""
    quality, keep = unused(docs, "quality"), unused(docs, "keep")
    judged = score(docs, learn(docs), keep_text=True, out=(quality, keep))
    return judged.where(keep).select(*(F.col(f"`{c}`") for c in docs.columns))
