"""Byte-level BPE by a global shuffle of distinct words, and decoding by a join with the token bytes.

1. Each task cuts its texts into pre-tokens (every match of the pattern) and numbers the distinct words of a chunk
   of whole documents. A document becomes the list of its word numbers by position; the chunk's distinct words
   leave in hash buckets, packed. So a word is sent once per chunk, however often it occurs.
2. The buckets meet: a task sees a bucket's words from all chunks, merges each distinct word once by the ranks,
   and sends the ids back to the chunks that hold the word.
3. Chunk by chunk the ids are joined to the words and put back by position.

Packed rows are zstd-compressed arrays, so what is shuffled stays well below the text. The chunk rows are written once, bucketed
by chunk, so documents are not shuffled at all: words and ids travel, texts stay. A chunk is about
CHUNK_CHARS of text (a longer document is a chunk of its own); a task holds one chunk or one bucket's words.

Null or empty text: no ids. Ties and repeated rows are encoded row by row. Input columns other than the text are
carried along; one with the output column's name is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
import zlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import read_table, slabs, small_batches
from moodwire.streaming.replay import scratch_path

CHUNK_CHARS = 6_000_000
BUCKETS = 128
#: Words that a task remembers of a bucket; beyond that it forgets them and merges a word again.
MEMO_WORDS = 2_000_000
VOCABULARY = "byte_bpe_50k.tiktoken"
# Code points that became letters or numbers after Unicode 16, the version of the encoder whose
# results are matched; the regex module knows them already. As ranges, first and last.
NEWER = ("0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
         "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 "
         "16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 "
         "1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 "
         "1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F")


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes, a space, the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of one word, lowest rank first, leftmost among equals."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 128:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    none = 1 << 60
    score = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while score:
        low = min(score)
        if low == none:
            break
        i = score.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del score[i]
        if i:
            score[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(score):
            score[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n, with a heap and linked parts, for words such as long runs of signs."""
    n = len(word)
    end, nxt, prev = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i]
        if not alive[i] or j >= n or end[j] != stop or word[i:stop] not in ranks:
            continue
        alive[j], end[i], nxt[i] = False, stop, nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
            if (r := ranks.get(word[i:end[nxt[j]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[j]]))
        if prev[i] >= 0 and (r := ranks.get(word[prev[i]:stop])) is not None:
            heapq.heappush(heap, (r, prev[i], stop))
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


def _squeeze(*arrays: np.ndarray | bytes, level: int = 3) -> bytes:
    """Arrays as byte planes, compressed: planes of small numbers are nearly free."""
    import zstandard
    z, out = zstandard.ZstdCompressor(level=level), []
    for a in arrays:
        raw = a if isinstance(a, bytes) else a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
        packed = z.compress(raw)
        out += [len(packed).to_bytes(8, "little"), packed]
    return b"".join(out)


def _expand(blob: bytes, *dtypes) -> list:
    import zstandard
    z, out, at = zstandard.ZstdDecompressor(), [], 0
    for kind in dtypes:
        n = int.from_bytes(blob[at:at + 8], "little")
        raw = z.decompress(blob[at + 8:at + 8 + n])
        at += 8 + n
        if kind is not bytes:
            item = np.dtype(kind).itemsize
            raw = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(item, -1).T).reshape(-1).view(kind)
        out.append(raw)
    return out


def splitter(pattern: str):
    """A function from a text to its pre-tokens, with the character classes of Unicode 16."""
    import regex
    newer = "[" + "".join("-".join(f"\\U{int(x, 16):08x}" for x in r.split("-")) for r in NEWER.split()) + "]"
    usual, rare = regex.compile(pattern), regex.compile(newer)
    strict = regex.compile(pattern.replace(r"\p{L}", r"[\p{L}--%s]" % newer).replace(r"\p{N}", r"[\p{N}--%s]" % newer), regex.V1)

    def words(text: str):
        p = usual
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                p = strict if rare.search(text) else usual
        return p.findall(text) if len(text) < 1 << 20 else (m.group() for m in p.finditer(text))
    return words


def _own(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A copy with memory of its own: columns of a received batch keep all of it, texts too."""
    return batch.take(pa.array(np.arange(batch.num_rows)))


def _cut_maker(pattern: str, text_col: str, buckets: int, chunk_chars: int):
    """Texts to chunk rows (chunk, bucket, blob): bucket >= 0 holds words, -1 the documents."""
    def run(batches):
        split = splitter(pattern)
        part, serial = TaskContext.get().partitionId(), count()
        number: dict[str, int] = {}
        codes: list[np.ndarray] = []
        held: list[pa.RecordBatch] = []
        chars = 0

        def flush():
            chunk = part << 32 | next(serial)
            flat = np.concatenate([*codes, np.empty(0, np.uint32)]).astype(np.uint32)
            # Frequent words get small numbers; among equals, those of a bucket stand together and sorted, so that
            # codes, bucket numbers and words all compress well.
            texts = [w.encode("utf-8") for w in number]
            bucket_of = np.fromiter((zlib.crc32(w) % buckets for w in texts), np.uint32, len(texts))
            lexical = np.empty(len(texts), np.int64)
            lexical[sorted(range(len(texts)), key=texts.__getitem__)] = np.arange(len(texts))
            order = np.lexsort((lexical, bucket_of, -np.bincount(flat, minlength=len(number))))
            rank = np.empty(len(number), np.uint32)
            rank[order] = np.arange(len(number), dtype=np.uint32)
            words, where = [texts[i] for i in order], bucket_of[order]
            by_bucket = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[by_bucket], np.arange(buckets + 1))
            rows = []
            for k in np.flatnonzero(np.diff(cuts)):
                some = [words[i] for i in by_bucket[cuts[k]:cuts[k + 1]]]
                rows.append((int(k), _squeeze(np.array([len(w) for w in some], np.uint32), b"".join(some))))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as out:
                for b in held:
                    out.write_batch(b)
            rows.append((-1, _squeeze(where, np.array([len(c) for c in codes], np.uint64), rank[flat], sink.getvalue().to_pybytes(), level=9)))
            return pa.RecordBatch.from_arrays([pa.array([chunk] * len(rows), pa.int64()), pa.array([k for k, _ in rows], pa.int32()),
                                               pa.array([x for _, x in rows], pa.binary())], names=["chunk", "bucket", "blob"])

        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column(text_col)
            rest = b.select([c for c in b.schema.names if c != text_col])
            i = 0
            for j in range(b.num_rows):
                text = texts[j].as_py() or ""
                codes.append(np.fromiter((number.setdefault(w, len(number)) for w in split(text)), np.uint32))
                chars += len(text)
                if chars >= chunk_chars:
                    held.append(_own(rest.slice(i, j + 1 - i)))
                    yield flush()
                    number, codes, held, chars, i = {}, [], [], 0, j + 1
            if i < b.num_rows:
                held.append(_own(rest.slice(i)))
        if held:
            yield flush()
    return run


def _merge_maker(ranks):
    """Word blobs, sorted by bucket, to blobs of ids: counts, then ids."""
    def run(batches):
        table, memo, current = ranks.value, {}, None
        for b in batches:
            out = []
            for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("blob").to_pylist()):
                if bucket != current or len(memo) > MEMO_WORDS:
                    memo, current = {}, bucket
                sizes, text = _expand(blob, np.uint32, bytes)
                ids, counts, at = [], [], 0
                for n in sizes.tolist():
                    word = text[at:at + n]
                    at += n
                    got = memo.get(word)
                    if got is None:
                        got = memo[word] = merge(word, table)
                    counts.append(len(got))
                    ids += got
                out.append(_squeeze(np.array(counts, np.uint32), np.array(ids, np.uint32)))
            yield pa.RecordBatch.from_arrays([b.column("chunk"), b.column("bucket"), pa.array(out, pa.binary())],
                                             names=["chunk", "bucket", "blob"])
    return run


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The runs flat[start:start + size] of each pick, one after another."""
    n = size[pick]
    ends = np.cumsum(n)
    return flat[np.repeat(start[pick] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


def _rejoin_maker(names: list[str], out_col: str):
    """A chunk's documents and its blobs of ids to documents with ids."""
    def run(batches):
        for b in batches:
            for blob, parts in zip(b.column("blob"), b.column("parts")):
                where, sizes, codes, rest = _expand(blob.as_py(), np.uint32, np.uint64, np.uint32, bytes)
                sizes = sizes.astype(np.int64)
                got = [_expand(x["blob"], np.uint32, np.uint32) for x in sorted(parts.as_py() or [], key=lambda x: x["bucket"])]
                order = np.argsort(where, kind="stable")
                n_ids, start = np.empty(len(where), np.int64), np.empty(len(where), np.int64)
                counts = np.concatenate([p[0] for p in got] or [np.empty(0, np.uint32)]).astype(np.int64)
                flat = np.concatenate([p[1] for p in got] or [np.empty(0, np.uint32)])
                n_ids[order], start[order] = counts, np.cumsum(counts) - counts
                offs = np.concatenate(([0], np.cumsum(sizes)))
                table = pa.ipc.open_stream(rest).read_all().combine_chunks()
                for i, j in slabs(sizes.tolist(), 1 << 18):
                    pick = codes[offs[i]:offs[j]]
                    ids = _gather(flat, start, n_ids, pick)
                    ends = np.concatenate(([0], np.cumsum(n_ids[pick])))[offs[i:j + 1] - offs[i]]
                    col = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
                    some = table.slice(i, j - i)
                    yield pa.RecordBatch.from_arrays([*(some.column(c).combine_chunks() for c in names), col], names=[*names, out_col])
    return run


def _bucketed(chunks: DataFrame) -> DataFrame:
    """Chunk rows as a table bucketed by chunk in the shared folder: the documents' large rows are then joined where they lie."""
    spark = chunks.sparkSession
    name, n = f"llm_bpe_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    (chunks.write.option("path", scratch_path(spark, "llm-bpe")).option("compression", "zstd").bucketBy(n, "chunk").saveAsTable(name))
    return spark.table(name)


def _piped(*steps):
    """Batch functions one after another in one Python worker: each mapInArrow of a chain would hold a worker of its own."""
    def run(batches):
        for step in steps:
            batches = step(batches)
        return batches
    return run


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", out_col: str = "token_ids",
           buckets: int = BUCKETS, chunk_chars: int = CHUNK_CHARS, then: tuple = (), schema: str | T.StructType | None = None) -> DataFrame:
    """``df`` without its text and with ``out_col`` array<int>: the ids that the rank file gives each whole text.

    Special tokens do not exist here: their strings are ordinary text. ``buckets`` bounds the words that one task
    merges (all distinct words / buckets); raise it with the corpus. The ranks are broadcast: a vocabulary's size.
    ``then``: batch functions that take the encoded batches in turn in the same worker; ``schema`` is what they give.
    """
    spark = df.sparkSession
    small_batches(spark)
    if text_col != out_col and out_col in df.columns:
        df = df.drop(out_col)
    df = df.withColumn(text_col, F.col(text_col).cast("string"))
    rest = [f for f in df.schema.fields if f.name != text_col] or [T.StructField("_row", T.IntegerType())]
    if "_row" in [f.name for f in rest] and len(df.columns) == 1:
        df = df.withColumn("_row", F.lit(0))
    chunks = _bucketed(df.mapInArrow(_cut_maker(pattern, text_col, buckets, chunk_chars), "chunk long, bucket int, blob binary"))
    words = chunks.where("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket", "chunk")
    ids = words.mapInArrow(_merge_maker(spark.sparkContext.broadcast(ranks)), "chunk long, bucket int, blob binary")
    parts = ids.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "blob")).alias("parts"))  # at most ``buckets`` a chunk
    back = chunks.where("bucket < 0").join(parts, "chunk", "left").select("blob", "parts")
    encoded = T.StructType([*rest, T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    return back.mapInArrow(_piped(_rejoin_maker([f.name for f in rest], out_col), *then), schema or encoded)


def _decode_maker(tokens, ids_col: str, out_col: str):
    def run(batches):
        sizes, flat = tokens.value
        start = np.cumsum(sizes) - sizes
        for b in batches:
            lists = b.column(ids_col)
            lens = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
            rest = [c for c in b.schema.names if c != out_col]
            for i, j in slabs(lens.tolist(), 1 << 18) if b.num_rows else ():
                ids = lists.slice(i, j - i).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                raw = _gather(flat, start, sizes, ids)
                ends = np.concatenate(([0], np.cumsum(sizes[ids])))[np.concatenate(([0], np.cumsum(lens[i:j])))]
                col = pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw.tobytes())])
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in rest), col], names=[*rest, out_col])
    return run


def decoder(spark: SparkSession, ranks: dict[bytes, int], ids_col: str = "token_ids", out_col: str = "decoded"):
    """The batch function of :func:`decode`.

    The token-byte table is broadcast (its size is the vocabulary's) and joined by position in Arrow batches.
    """
    n = max(ranks.values(), default=-1) + 1
    by_id = [b""] * n
    for token, rank in ranks.items():
        by_id[rank] = token
    table = (np.array([len(t) for t in by_id], np.int64), np.frombuffer(b"".join(by_id), np.uint8))
    return _decode_maker(spark.sparkContext.broadcast(table), ids_col, out_col)


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col`` binary: each id joined with its token's bytes, in order (null ids: empty)."""
    schema = T.StructType([*(f for f in df.schema.fields if f.name != out_col), T.StructField(out_col, T.BinaryType())])
    return df.mapInArrow(decoder(df.sparkSession, ranks, ids_col, out_col), schema)


def _digest_batches(batches):
    for b in batches:
        ids = [x.values.to_numpy(zero_copy_only=False).astype("<u4") for x in b.column("token_ids")]
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(x).hexdigest() for x in b.column("decoded").to_pylist()], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole document, decode the ids, and return the digests of both."""
    import public_tokenizers
    ranks = load_ranks(public_tokenizers.path(VOCABULARY))
    return encode(read_table(spark, sf_dir, "documents", "doc_id", "text"), ranks, public_tokenizers.PATTERN,
                  then=(decoder(spark, ranks), _digest_batches),
                  schema="doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Pipeline stage, the last: documents with ids instead of text, and their number."""
    import public_tokenizers
    ids = encode(docs, load_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)
    return ids.withColumn("n_tokens", F.size("token_ids").cast("long"))
