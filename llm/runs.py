"""Periodic run detection by maximal pairs.

A text's words (``[^\\x20\\x09-\\x0D]+``) are sorted by what follows them, and the tree of LCP intervals over that order
is walked bottom-up. A node of depth l holds, in order of place and each with its left word's class, the places where
the same l words begin; two places of different children share exactly l words, and if their left words differ as
well, they are a maximal pair. Such a pair (i, i + d) with l >= (REPEATS - 1) * d and l + d >= SHORTEST is the run
``start i, period d, length l + d``: it can be extended on neither side, so nothing has to be extended. Among pairs of the
same start and end the smallest distance is the period, as the others are its multiples.

Smaller children are merged into larger ones, and only neighbours by place are compared: if a third occurrence stood
between the pair of a run's smallest period, the run would have a smaller one (Fine and Wilf), so that pair is always
adjacent in its node. A text of n words thus costs O(n log^2 n) at worst, also where one word fills it.

Every node that matters is at least ``SEED`` words deep, so only places whose next ``SEED`` words come again in the text
are sorted; most texts have none and end there. Words are compared as numbers given to the distinct words of a text,
not as hashes, so results are exact.

Null, empty and blank texts have no words and no runs. Whole texts are read, however long; the tables of one text
live only as long as it is worked on. Repeated rows give repeated rows; a null id counts as an empty one where the
contract hashes it; columns of the input other than the text stay or are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from llm.common import read_table

#: A run repeats its period at least this often and holds at least this many words.
REPEATS, SHORTEST = 4, 6
#: Depth of the shallowest node with a run: the least l with l >= (REPEATS - 1) * d and l + d >= SHORTEST, for any d.
SEED = min(max((REPEATS - 1) * d, SHORTEST - d) for d in range(1, SHORTEST + 1))
_BLOCK = 1024


class _Places:
    """Sorted places of one node, in blocks, so that putting one in moves few others."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, place: int):
        self.blocks, self.heads, self.size = [[place]], [place], 1

    def put(self, x: int) -> tuple[int, int]:
        """Put ``x`` in; its neighbours by place, -1 where there is none."""
        blocks, heads = self.blocks, self.heads
        k = max(0, bisect_left(heads, x) - 1)
        block = blocks[k]
        at = bisect_left(block, x)
        before = block[at - 1] if at else -1
        after = block[at] if at < len(block) else blocks[k + 1][0] if k + 1 < len(blocks) else -1
        block.insert(at, x)
        heads[k] = block[0]
        self.size += 1
        if len(block) > 2 * _BLOCK:
            blocks[k:k + 1] = [block[:_BLOCK], block[_BLOCK:]]
            heads[k:k + 1] = [block[0], block[_BLOCK]]
        return before, after

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def _ranked(*keys: np.ndarray) -> np.ndarray:
    """Equal keys get equal numbers, in the order of the keys: the number of smaller entries."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), dtype=np.int64)
    first = np.flatnonzero(new)
    rank[order] = np.repeat(first, np.diff(np.append(first, len(order))))
    return rank


def repeated_places(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places whose next SEED words (within their ``text``) come again in it, by rounds of pairing neighbours' ranks."""
    n = len(words)
    if n < SEED:
        return np.empty(0, dtype=np.int64)
    rank, have = _ranked(text, words), 1
    live = np.arange(n - SEED + 1)
    live = live[text[live] == text[live + SEED - 1]]
    while have < SEED:
        step = min(have, SEED - have)
        # The next round's ranks are needed at all places that live ones reach.
        nxt = np.concatenate([rank[step:], np.full(step, -1)])
        rank = _ranked(rank, nxt)
        have += step
    r = rank[live]
    order = np.argsort(r, kind="stable")
    s = r[order]
    same = np.zeros(len(s) + 1, dtype=bool)
    same[1:-1] = s[1:] == s[:-1]
    return np.sort(live[order[same[1:] | same[:-1]]])


def suffix_order(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``places`` sorted by the words that follow them, by prefix doubling over groups that are still tied.

    ``places`` holds all occurrences of some SEED words each, so places outside it differ from each other at once and
    their order among the others follows from their first SEED words.
    """
    n = len(words)
    rank = _ranked(*(np.concatenate([words[k:], np.full(min(k, n), -1, dtype=words.dtype)]) for k in range(SEED)))
    done, tied = SEED, places
    while len(tied):
        follow = tied + done
        nxt = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1)
        own = rank[tied]
        order = np.lexsort((nxt, own))
        tied, own, nxt = tied[order], own[order], nxt[order]
        group = np.concatenate([[True], own[1:] != own[:-1]])
        cut = group | np.concatenate([[True], nxt[1:] != nxt[:-1]])
        at = np.arange(len(tied))
        start, sub = np.maximum.accumulate(np.where(group, at, 0)), np.maximum.accumulate(np.where(cut, at, 0))
        rank[tied] = own + sub - start
        alone = cut & np.concatenate([cut[1:], [True]])
        tied = tied[~alone]
        done *= 2
    return places[np.argsort(rank[places], kind="stable")]


def common_lengths(words: list[int], order: list[int]) -> list[int]:
    """For each place in ``order``, the number of words it shares with the one before it (at least SEED, else 0)."""
    n, lcp = len(words), [0] * len(order)
    at = {p: k for k, p in enumerate(order)}
    have, last = 0, -2
    for p in sorted(order):
        have = have - 1 if p == last + 1 and have > SEED else 0
        last, k = p, at[p]
        if k:
            q = order[k - 1]
            while p + have < n and q + have < n and words[p + have] == words[q + have]:
                have += 1
            if have >= SEED:
                lcp[k] = have
        else:
            have = 0
    return lcp


def maximal_pairs(words: list[int], order: list[int], lcp: list[int]) -> dict[tuple[int, int], int]:
    """Runs by (start, end) with their smallest distance, from the LCP intervals bottom-up."""
    found: dict[tuple[int, int], int] = {}

    def merged(a: _Places, b: _Places, depth: int) -> _Places:
        if a.size < b.size:
            a, b = b, a
        mine = -1
        for x in b:
            before, after = a.put(x)
            before, mine = -1 if before == mine else before, x  # two places of one child share more than ``depth`` words
            for i, j in ((before, x), (x, after)):
                d = j - i
                if i >= 0 and 0 < d and (REPEATS - 1) * d <= depth and depth + d >= SHORTEST and (
                        i == 0 or words[i - 1] != words[j - 1]):
                    key = (i, j + depth)
                    if found.get(key, d) >= d:
                        found[key] = d
        return a

    open_: list[tuple[int, _Places]] = []
    cur = _Places(order[0]) if order else None
    for k in range(1, len(order) + 1):
        depth = lcp[k] if k < len(order) else 0
        while open_ and open_[-1][0] > depth:
            top, places = open_.pop()
            cur = merged(places, cur, top)
        if depth:
            if open_ and open_[-1][0] == depth:
                cur = merged(open_.pop()[1], cur, depth)
            open_.append((depth, cur))
        if k < len(order):
            cur = _Places(order[k])
    return found


def find_runs(words: np.ndarray, places: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one text's word numbers, by start, then period."""
    if places is None:
        places = repeated_places(words, np.zeros(len(words), dtype=np.int64))
    if not len(places):
        return []
    listed = words.tolist()
    order = suffix_order(words, places).tolist()
    found = maximal_pairs(listed, order, common_lengths(listed, order))
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def find_all(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """Runs of many texts, each a list of words: one search for repeated places, then a tree for each text that has some."""
    numbered = []
    for words in texts:
        ids: dict = {}
        numbered.append(np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64))
    sizes = np.array([len(w) for w in numbered], dtype=np.int64)
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return [[] for _ in texts]
    places = repeated_places(np.concatenate(numbered), np.repeat(np.arange(len(texts)), sizes))
    cuts = np.searchsorted(places, np.concatenate([[0], ends]))
    return [find_runs(w, places[a:b] - (e - n)) for w, a, b, e, n in zip(numbered, cuts[:-1], cuts[1:], ends, sizes)]


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run repeats after its first period."""
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d] if runs else words


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length/period, compared exactly; ties: smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2] or (
                r[1] * best[2] == best[1] * r[2] and (r[0], r[2]) < (best[0], best[2])):
            best = r
    return best


def looped(words: list, h: int) -> list:
    """The contract's planted repeats: where 10 divides ``h``, the words from one place on repeat a period."""
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = words[a:a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (period * ((n - a) // len(period) + 1))[:n - a]


def _by_words(texts: list[bytes], limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of texts of about ``limit`` bytes; a longer text stands alone."""
    i = total = 0
    for j, t in enumerate(texts):
        if j > i and total + len(t) > limit:
            yield i, j
            i, total = j, 0
        total += len(t)
    if i < len(texts):
        yield i, len(texts)


def runs_of(df: DataFrame, text_col: str = "text", out_col: str = "runs") -> DataFrame:
    """``df`` with the runs of each whole text: an array of (start, length, period), in words."""
    kept = df.drop(out_col)
    runs_type = T.StructType.fromDDL(f"`{out_col}` array<struct<start:bigint,length:bigint,period:bigint>>")
    at = kept.columns.index(text_col)
    type_ = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column(at).cast(pa.string()).cast(pa.binary()).to_pylist()]
            for i, j in _by_words(texts):
                found = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in find_all([t.split() for t in texts[i:j]])]
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, pa.array(found, type_)], names=[*b.schema.names, out_col])

    return kept.mapInArrow(run, T.StructType([*kept.schema, *runs_type]))


def _digest_batches(batches):
    for b in batches:
        ids = b.column("doc_id").to_pylist()
        texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
        for i, j in _by_words(texts):
            # bytes.split() cuts at just the white space meant here: 0x20 and 0x09 to 0x0D.
            words = [looped(t.split(), crc32(b"" if d is None else str(d).encode())) for d, t in zip(ids[i:j], texts[i:j])]
            found = find_all(words)
            top = [strongest(r) for r in found]
            longs = [[None if t is None else v(t) for t in top] for v in (
                lambda t: t[0], lambda t: t[1], lambda t: t[2], lambda t: 1000 * t[1] // t[2])]
            lists = ["".join(f"{s},{n},{p}\n" for s, n, p in r).encode() for r in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[i:j], pa.int64()), pa.array([len(r) for r in found], pa.int64()), *(pa.array(v, pa.int64()) for v in longs),
                 pa.array([hashlib.sha256(x).hexdigest() for x in lists], pa.string()),
                 pa.array([hashlib.sha256(b" ".join(collapsed(w, r))).hexdigest() for w, r in zip(words, found)], pa.string())],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, some of them looped by the checksum of their id; no shuffle."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.mapInArrow(_digest_batches, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                           "runs_sha256 string, collapsed_sha256 string")
