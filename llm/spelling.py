"""Spelling variant grouping over a variable-length gram index.

A word stands as ``^word$``. From every position runs one gram: it starts with two signs and grows while what it holds
is frequent among all words, up to five signs. The dictionary behind it is pruned by frequency: a gram is worth
lengthening only where more than ``cut`` places hold it, so at most ``FREQUENT`` grams a length are kept and sent to
the tasks. No complete gram begins another one, so a gram depends on nothing outside itself, and one edit changes at
most those grams that cover one place: their greatest number is the word's affected-gram bound. Two words one edit
apart therefore share at least (grams - bound) grams, and by the prefix principle one of the ``bound + 1`` rarest of
each word. A word of five signs has six grams and a bound of five at most, so every word keeps at least one.

Lists of these grams are merged within equal context: an edit lies on one side of an unaffected gram, so up to the
gram's end or from its start both words are alike. Lists of at most ``LONG`` words are merged and each pair verified.
Longer lists are not merged but probed, exactly: each of their words is looked up by its spellings with one sign
left out on the far side of the gram; words that share such a spelling at one place differ there by one sign alone, so
a group holds at most one word for each sign of the alphabet, and all its pairs are results.

A word's form is its near word of largest n (ties: smallest in code-point order), if that is at least twice as frequent;
its root is where the forms lead. n grows along them, so pointers double until none moves.

Words: null text and empty texts give none; whole texts are read, however long; repeated rows count again; a null id
stands as an empty one; ties are settled as stated; an empty table gives an empty result. Only the id and the text
column are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import read_table, salted_left_join, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_GRAM, MAX_GRAM = 2, 5
#: Frequent grams of one length that the dictionary may hold (its size bound); fewer than MIN_CUT places are never frequent.
FREQUENT, MIN_CUT = 1 << 16, 100
#: Longest list that is merged pair by pair.
LONG = 64
#: Words that one task decomposes or merges, about.
WORDS_PER_TASK = 20_000


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal letter runs of whole texts, A-Z lower-cased: columns id (text), run; one row an occurrence."""
    text = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))


def misspelt(id_: Column, run: Column, every: int = 97) -> Column:
    """The run, or (where the checksum of id and run is a multiple of ``every``) the run less one sign."""
    h = F.crc32(F.concat(id_, F.lit(":"), run))
    at = F.pmod(h, F.char_length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, less).otherwise(run)


def vocabulary(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """Distinct words of at least ``min_length`` signs and ``min_count`` occurrences: word, n."""
    return (words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


def frequent_grams(vocab: DataFrame) -> dict[str, int]:
    """The inner grams of the dictionary: those of fewer than MAX_GRAM signs that more than ``cut`` places hold.

    ``cut`` is the share of all places that lets at most FREQUENT grams of a length pass, so the result is bounded.
    """
    places = vocab.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    cut = max(MIN_CUT, places // FREQUENT)
    s = F.concat(F.lit("^"), F.col("word"), F.lit("$")).alias("s")
    size = F.explode(F.array(*(F.lit(q) for q in range(MIN_GRAM, MAX_GRAM)))).alias("q")
    at = F.explode(F.sequence(F.lit(1), F.char_length("s") - F.col("q") + 1)).alias("p")
    grams = vocab.select(s).select("s", size).select("s", "q", at).select(F.substring("s", F.col("p"), F.col("q")).alias("g"))
    return {r[0]: r[1] for r in grams.groupBy("g").count().where(F.col("count") > cut).collect()}


def decompose(word: str, frequent: dict[str, int]) -> tuple[str, list[tuple[int, int]], int]:
    """``^word$``, its grams as (start, end) by position, and the most grams that one edit affects."""
    s = f"^{word}$"
    size, grams = len(s), []
    cover = [0] * (size + 1)
    for p in range(size - MIN_GRAM + 1):
        e = p + MIN_GRAM
        while e < size and e - p < MAX_GRAM and s[p:e] in frequent:
            e += 1
        grams.append((p, e))
        cover[p] += 1
        cover[e] -= 1
    most = here = 0
    for i in range(size - 1):
        here += cover[i]
        if i and here > most:
            most = here
    return s, grams, most


def _entries(frequent: dict[str, int]):
    """Index entries of words: the rarest ``bound + 1`` grams, each by its left and by its right context.

    A gram that is not frequent ranks first; one of the full length ranks by what it grew from; ties by its signs.
    """
    def run(batches):
        for b in batches:
            keys, words, counts, los, his = [], [], [], [], []
            for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
                s, grams, bound = decompose(word, frequent)
                size = len(word)
                ranked = sorted([(frequent.get(s[p:e - 1], 0) if e - p == MAX_GRAM else 0, s[p:e], p, e) for p, e in grams])
                last = ranked[min(bound, len(ranked) - 1)][:2]
                before = len(keys)
                for rarity, gram, p, e in ranked:
                    if (rarity, gram) > last:
                        break
                    # lo..hi are the places (in the word) where an edit may be on that side of the gram.
                    if e <= size + 1:
                        keys.append("<" + s[:e])
                        los.append(e - 1)
                        his.append(size)
                    if p:
                        keys.append(">" + s[p:])
                        los.append(0)
                        his.append(p - 1)
                words += [word] * (len(keys) - before)
                counts += [n] * (len(keys) - before)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64()),
                                              pa.array(los, pa.int32()), pa.array(his, pa.int32())],
                                             names=["key", "word", "n", "lo", "hi"])
    return run


def near_words(vocab: DataFrame) -> DataFrame:
    """All pairs of words exactly one inserted, deleted or replaced sign apart, once each: a, an, b, bn."""
    frequent = frequent_grams(vocab)
    # The work a word brings is much more than its few bytes tell, so the number of tasks follows the words.
    parts = max(int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions")), vocab.count() // WORDS_PER_TASK)
    index = staged(vocab.repartition(parts, "word").mapInArrow(_entries(frequent), "key string, word string, n long, lo int, hi int"), "grams")
    long_lists = index.groupBy("key").count().where(F.col("count") > LONG).select("key", F.lit(True).alias("long"))
    tagged = staged(salted_left_join(index, long_lists, ["key"], F.col("word")), "lists")

    short = tagged.where("long is null").select("key", "word", "n").repartition(parts, "key")
    a, b = short.toDF("key", "a", "an"), short.toDF("key", "b", "bn")
    merged = (a.join(b, "key").where((F.col("a") < F.col("b")) & (F.abs(F.char_length("a") - F.char_length("b")) <= 1)
                                     & (F.levenshtein("a", "b", 1) == 1)).select("a", "an", "b", "bn"))

    place = F.explode(F.sequence(F.col("lo"), F.least(F.col("hi"), F.char_length("word") - 1))).alias("i")
    left = F.concat(F.substring("word", F.lit(1), F.col("i")), F.substring("word", F.col("i") + 2, F.char_length("word")))
    probes = (tagged.where(F.col("long") & (F.col("lo") < F.char_length("word"))).select("word", "n", place).distinct()
              .select("word", "n", "i", left.alias("left")))
    probes = staged(probes, "probes")
    a, b = (probes.repartition(parts, "left", "i").select("left", "i", F.col("word").alias(x), F.col("n").alias(f"{x}n")) for x in "ab")
    replaced = a.join(b, ["left", "i"]).where("a < b").select("a", "an", "b", "bn")
    whole = vocab.select(F.col("word").alias("left"), F.col("n").alias("m"))
    first = F.col("word") < F.col("left")
    removed = (probes.join(whole, "left").select(
        F.least("word", "left").alias("a"), F.when(first, F.col("n")).otherwise(F.col("m")).alias("an"),
        F.greatest("word", "left").alias("b"), F.when(first, F.col("m")).otherwise(F.col("n")).alias("bn")))
    return merged.unionByName(replaced).unionByName(removed).distinct()


def roots(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Where ``form`` leads from each ``word``: word, root. Pointers double, so a chain of m words takes log2(m) rounds."""
    cur = staged(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        hop = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = salted_left_join(cur, hop, ["root"], F.col("word"))
        moved = staged(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        cur = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return cur
    raise RuntimeError(f"forms did not settle in {max_rounds} rounds")


def variant_groups(vocab: DataFrame) -> DataFrame:
    """``vocab`` (word, n) with each word's form, root, number of near words and the form's n."""
    vocab = staged(vocab.select("word", "n"), "words")
    pairs = staged(near_words(vocab), "near")
    both = (pairs.select(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("near"), F.col("bn").alias("m"))
            .unionByName(pairs.select(F.col("b").alias("word"), F.col("bn").alias("n"), F.col("a").alias("near"), F.col("an").alias("m"))))
    # The smallest of (-n, word) is the largest n, then the smallest word.
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("top"))
    joined = vocab.join(best, "word", "left")
    takes = -F.col("top.m") >= 2 * F.col("n")
    found = staged(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(takes, F.col("top.near")).alias("form"), F.when(takes, -F.col("top.m")).alias("form_n")), "forms")
    ends = roots(found.where("form is not null"))
    return (found.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among all words of ``documents``, some of them misspelt by a checksum of document and word."""
    found = runs(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return variant_groups(vocabulary(found.select(misspelt(F.col("id"), F.col("run")).alias("word"))))


def crc32_sql(blob: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a BLOB expression. A byte's table entry is the sum (xor) of its bits' entries."""
    entries = []
    for k in range(8):
        v = 1 << k
        for _ in range(8):
            v = (v >> 1) ^ (0xEDB88320 if v & 1 else 0)
        entries.append(v)
    step = "(acc >> 8)"
    for k, v in enumerate(entries):
        step = f"xor({step}, ((xor(acc, x) >> {k}) & 1) * {v})"
    octets = f"list_transform(regexp_extract_all(hex({blob}), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda acc, x: {step}), 4294967295)"


ORACLE_SQL = f"""
WITH RECURSIVE found AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT id, run, count(*) AS k FROM found GROUP BY ALL),
hashed AS (SELECT run, k, {crc32_sql("encode(id || ':' || run)")} AS h FROM counted),
spelt AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT)
                      ELSE run END AS word, k FROM hashed),
vocab AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS left_ FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocab)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n AS m FROM less a JOIN less b ON a.left_ = b.left_ AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN vocab b ON a.left_ = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN vocab b ON a.left_ = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY m DESC, near) AS top, max(m) AS m FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 2 * v.n THEN b.top END AS form,
         CASE WHEN b.m >= 2 * v.n THEN b.m END AS form_n FROM vocab v LEFT JOIN best b ON v.word = b.word),
walk AS (
  SELECT word, word AS at, form AS nxt FROM forms
  UNION ALL
  SELECT w.word, w.nxt, f.form FROM walk w JOIN forms f ON f.word = w.nxt)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w ON w.word = f.word AND w.nxt IS NULL
"""
