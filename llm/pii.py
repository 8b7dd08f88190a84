"""Personal data by weak supervision, in DataFrame and SQL functions only.

Candidates are the matches of the base patterns (valid or not) and of looser ones: telephone numbers without a
country code, identity numbers, disguised addresses, titled names. Labelers vote on each candidate (+1 personal,
-1 not, 0 abstain): the base check (regex), a gazetteer (top-level domains, card issuers, country codes, reserved
networks, given names), the words before it (context) and its edges (shape). Votes are counted by pattern, a table of at
most KINDS x 3^4 rows whatever the corpus; expectation-maximisation estimates the labelers' accuracies and each
kind's rate from it, and the posteriors train a logistic classifier. The classifier then judges each candidate
outside the base spans; base spans always stay.

Offsets are code points. ``split`` gives the pieces between a pattern's matches, so starts are running sums of the
lengths of pieces and matches. Patterns are possessive and start only where a run starts (or the last match ended),
which keeps them linear on long runs without changing what they match.

Null or empty text: no spans. Repeated rows are judged one by one; columns of the input stay; an empty table gives an
empty result (and a classifier that accepts nothing beyond the base).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import read_table, staged

KINDS = ["email", "ip", "card", "phone", "id", "name"]
LABELERS = ["regex", "gazetteer", "context", "shape"]

_RUN = r"(?=[{0}])(?:(?<![{0}])|\G)[{0}]++"
_LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": _RUN.format(_LOCAL) + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _RUN.format("0-9") + r"\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z0-9-]{1,63}+)++",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z.-])",
    "id": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]{1,30}+(?:\x20[A-Z][a-z]{1,30}+)?",
}
#: A cheap test that must hold before a pattern is tried.
_NEEDS = {"email": "instr({t}, '@') > 0", "loose_email": "instr(lower({t}), 'at)') + instr(lower({t}), 'at]') > 0"}
_GAZETTEER = {
    "email": ("regexp_extract(lower({m}), '([a-z0-9]+)[^a-z0-9]*$', 1)", "com org net edu gov info io co uk de fr es it eu us ca ch at".split()),
    "phone": ("regexp_extract({m}, '^[+]([0-9]{{1,2}})', 1)", "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 55 61 62 63 64 65 81 82 86 90 91".split()),
    "card": ("substr(regexp_replace({m}, '[^0-9]', ''), 1, 1)", "3 4 5 6".split()),
    "name": ("regexp_extract({m}, '([A-Z][a-z]+)$', 1)", "Smith Johnson Brown Miller Davis Garcia Martin Müller Schmidt Schneider Fischer Weber Bernard Dubois Robert Lopez Perez Sanchez Taylor Wilson Anderson Thomas Moore Jackson White Harris Clark Lewis".split()),
}
_NEAR = "(?:e-?mail|mail|contact|reach|tel|phone|call|fax|mobile|ip|host|address|card|visa|credit|ssn|social|name|write to|anruf|telefon|courriel|correo|tarjeta|carte|karte)[^a-z]{0,6}$"
_FAR = "(?:version|v\\\\.|section|fig|figure|isbn|issn|doi|page|chapter|[$€£#]|nr|no)[\\\\x20.:]{0,3}$"
#: Characters before a candidate that the context labeler reads.
WINDOW = 24
THRESHOLD = 0.5
_T = "_pii_"


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _scan(array: str, zero: str, op: str, size: int = 256) -> str:
    """Exclusive running ``op`` of an array, block-wise: linear in its length but for blocks of ``size``."""
    def fold(arr: str, start: str) -> str:
        return (f"aggregate({arr}, named_struct('a', cast(array() as array<bigint>), 's', cast({start} as bigint)), "
                f"(acc, v) -> named_struct('a', concat(acc.a, array(acc.s)), 's', {op.format('acc.s', 'v')}))")
    blocks = f"transform(sequence(0, greatest(size({array}) - 1, 0) div {size}), b -> slice({array}, b * {size} + 1, {size}))"
    totals = f"transform({blocks}, q -> {fold('q', zero)}.s)"
    return (f"transform(array({blocks}), bl -> flatten(zip_with(bl, {fold(totals, zero)}.a, (q, z) -> {fold('q', 'z')}.a)))[0]")


def _matches(df: DataFrame, text: str, kind: str, pattern: str, needs: str | None) -> DataFrame:
    """Adds arrays ``m`` (matches), ``p`` (pieces) and ``s`` (starts) of one pattern."""
    none = "cast(array() as array<string>)"
    found = f"regexp_extract_all({text}, {_sql(pattern)}, 0)"
    df = df.withColumn(_T + "m", F.expr(f"coalesce(case when {needs or 'true'} then {found} end, {none})"))
    df = df.withColumn(_T + "p", F.expr(f"case when size({_T}m) > 0 then split({text}, {_sql(pattern)}, -1) else {none} end"))
    df = df.withColumn(_T + "l", F.expr(f"flatten(zip_with(slice({_T}p, 1, size({_T}m)), {_T}m, (p, m) -> "
                                        f"array(cast(length(p) as bigint), cast(length(m) as bigint))))"))
    return df.withColumn(_T + "s", F.expr(f"case when size({_T}l) > 0 then {_scan(_T + 'l', '0', '{} + {}')} else cast(array() as array<bigint>) end"))


_VALID = {
    "email": "true",
    "ip": "forall(split({m}, '[.]'), x -> length(ltrim('0', x)) <= 3 and coalesce(try_cast(ltrim('0', x) as int), 0) <= 255)",
    "card": ("(length(regexp_replace({m}, '[^0-9]', '')) between 14 and 19 and aggregate(sequence(1, least(length(regexp_replace({m}, '[^0-9]', '')), 19)), 0, "
             "(s, k) -> s + transform(array(cast(substr(regexp_replace({m}, '[^0-9]', ''), -k, 1) as int)), "
             "d -> case when k % 2 = 1 then d when d > 4 then 2 * d - 9 else 2 * d end)[0]) % 10 = 0)"),
    "phone": "length(regexp_replace({m}, '[^0-9]', '')) between 10 and 15",
}


def _votes(kind: str, valid: str, loose: bool) -> str:
    """The struct of one candidate, from its match ``c.m``, the piece before it ``c.p`` and after it ``c.q``, start ``c.s``."""
    m = "c.m"
    if kind in _GAZETTEER:
        what, known = _GAZETTEER[kind]
        inside = f"array_contains(array({', '.join(repr(x) for x in known)}), {what.format(m=m)})"
        gaz = f"case when {inside} then 1 else {-1 if kind == 'card' else 0} end"
    elif kind == "ip":
        gaz = f"case when regexp_like({m}, '^(0|127|255)[.]') then -1 else 1 end"
    else:
        gaz = "0"
    before = f"lower(right(c.p, {WINDOW}))"
    context = f"case when regexp_like({before}, '{_NEAR}') then 1 when regexp_like({before}, '{_FAR}') then -1 else 0 end"
    shape = "case when regexp_like(right(c.p, 1), '[A-Za-z0-9.#$]') or regexp_like(left(c.q, 1), '[A-Za-z0-9%$]') then -1 else 1 end"
    base = "0" if loose else f"case when {valid} then 1 else -1 end"
    return (f"named_struct('start', c.s, 'rank', {KINDS.index(kind)}, 'end', c.s + length({m}), 'base', {'false' if loose else valid}, "
            f"'regex', {base}, 'gazetteer', {gaz}, 'context', {context}, 'shape', {shape})")


def candidates(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_pii_base`` and ``_pii_more``, arrays of candidates with their votes."""
    text = f"`{text_col}`"
    names = []
    for loose, patterns in ((False, PATTERNS), (True, LOOSE)):
        for kind, pattern in patterns.items():
            name = f"{'loose_' if loose else ''}{kind}"
            needs = _NEEDS.get(name)
            df = _matches(df, text, kind, pattern, needs.format(t=text) if needs else None)
            # Arrays meet by zip_with: a column that is indexed inside a lambda may be computed anew for each element.
            rows = (f"zip_with(zip_with({_T}m, slice({_T}p, 1, size({_T}m)), (m, p) -> named_struct('m', m, 'p', p)), "
                    f"zip_with(slice({_T}p, 2, size({_T}m)), filter({_T}s, (x, i) -> i % 2 = 1), (q, s) -> named_struct('q', q, 's', s)), "
                    "(x, y) -> named_struct('m', x.m, 'p', x.p, 'q', y.q, 's', y.s))")
            valid = _VALID[kind].format(m="c.m") if not loose else "false"
            df = df.withColumn(_T + name, F.expr(f"transform({rows}, c -> {_votes(kind, valid, loose)})"))
            names.append(_T + name)
    df = df.drop(*(_T + x for x in "mpls")).withColumn(_T + "all", F.flatten(F.array(*names))).drop(*names)
    df = df.withColumn(_T + "base", F.expr(f"filter({_T}all, c -> c.base)"))
    more = f"filter({_T}all, c -> not c.base and not exists({_T}base, b -> b.start < c.end and c.start < b.end))"
    return df.withColumn(_T + "more", F.expr(more)).drop(_T + "all")


def fit(found: DataFrame, em_rounds: int = 8, steps: int = 12, rate: float = 2.0) -> dict[str, float]:
    """The span classifier's weights, from the votes of all candidates. Each round is one aggregate of the pattern table."""
    votes = (found.select(F.explode(F.concat(_T + "base", _T + "more")).alias("c")).select("c.rank", *(f"c.{x}" for x in LABELERS))
             .groupBy("rank", *LABELERS).agg(F.count("*").cast("double").alias("n")))
    votes = staged(votes.coalesce(1).sort("rank", *LABELERS), "votes")
    accuracy = dict(zip(LABELERS, (0.9, 0.7, 0.8, 0.7)))
    prior = [0.5] * len(KINDS)
    n = F.col("n")

    def posterior() -> Column:
        z = F.element_at(F.array(*(F.lit(math.log(p / (1 - p))) for p in prior)), F.col("rank") + 1)
        for x in LABELERS:
            z = z + F.col(x) * F.lit(math.log(accuracy[x] / (1 - accuracy[x])))
        return 1 / (1 + F.exp(-z))

    for _ in range(em_rounds):
        p = votes.withColumn("p", posterior())
        right = [F.sum(F.when(F.col(x) == 1, n * F.col("p")).when(F.col(x) == -1, n * (1 - F.col("p")))).alias(f"r_{x}") for x in LABELERS]
        cast = [F.sum(F.when(F.col(x) != 0, n)).alias(f"n_{x}") for x in LABELERS]
        kinds = [F.sum(F.when(F.col("rank") == k, n * F.col("p"))).alias(f"p_{k}") for k in range(len(KINDS))]
        sizes = [F.sum(F.when(F.col("rank") == k, n)).alias(f"s_{k}") for k in range(len(KINDS))]
        row = p.agg(*right, *cast, *kinds, *sizes).first().asDict()
        accuracy = {x: min(0.99, max(0.55, ((row[f"r_{x}"] or 0) + 1.4) / ((row[f"n_{x}"] or 0) + 2))) for x in LABELERS}
        prior = [min(0.98, max(0.02, ((row[f"p_{k}"] or 0) + 1) / ((row[f"s_{k}"] or 0) + 2))) for k in range(len(KINDS))]

    soft = posterior()
    weights = {**{f"kind_{k}": 0.0 for k in range(len(KINDS))}, **{x: 0.5 for x in LABELERS}}
    features = {**{f"kind_{k}": (F.col("rank") == k).cast("double") for k in range(len(KINDS))}, **{x: F.col(x).cast("double") for x in LABELERS}}
    for _ in range(steps):
        z = sum((f * F.lit(weights[x]) for x, f in features.items()), F.lit(0.0))
        slope = votes.withColumn("g", n * (soft - 1 / (1 + F.exp(-z))))
        # Each feature's own curvature scales its step, so rare kinds learn as fast as frequent ones.
        row = slope.agg(*(F.sum(F.col("g") * f).alias(x) for x, f in features.items()),
                        *(F.sum(n * f * f).alias(f"c_{x}") for x, f in features.items())).first().asDict()
        weights = {x: w + rate * (row[x] or 0.0) / ((row[f"c_{x}"] or 0.0) + 1) for x, w in weights.items()}
    return weights


def detect(found: DataFrame, weights: dict[str, float], threshold: float = THRESHOLD) -> DataFrame:
    """Replaces the candidates by ``_pii_base`` and ``_pii_spans``: sorted arrays of (start, rank, end)."""
    kind = ", ".join(f"{weights[f'kind_{k}']!r}D" for k in range(len(KINDS)))
    z = f"array({kind})[c.rank] + " + " + ".join(f"c.{x} * {weights[x]!r}D" for x in LABELERS)
    cut = math.log(threshold / (1 - threshold))
    bare = "c -> named_struct('start', c.start, 'rank', c.rank, 'end', c.end)"
    df = found.withColumn(_T + "more", F.expr(f"transform(filter({_T}more, c -> {z} > {cut!r}D), {bare})"))
    df = df.withColumn(_T + "base", F.expr(f"array_sort(transform({_T}base, {bare}))"))
    # Accepted candidates of several patterns may coincide; equal spans count once.
    return df.withColumn(_T + "spans", F.expr(f"array_sort(concat({_T}base, array_distinct({_T}more)))")).drop(_T + "more")


def span_text(col: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({col}, c -> concat(array({names})[c.rank], ':', c.start, ':', c.end)), ',')")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and digest of the base spans, and all spans."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = staged(candidates(docs).drop("text"), "pii")
    out = detect(found, fit(found))
    counts = [F.expr(f"cast(size(filter({_T}base, c -> c.rank = {i})) as bigint)").alias(f"n_{KINDS[i]}") for i in range(4)]
    return out.select("doc_id", *counts, F.sha2(span_text(_T + "base"), 256).alias("base_sha256"), span_text(_T + "spans").alias("spans"))


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The text with each span (overlapping ones joined) replaced by its first kind, as in ``[EMAIL]``."""
    s = _T + "spans"
    ends = _scan(f"transform({s}, c -> c.end)", "0", "greatest({}, {})")
    heads = (f"filter(zip_with({s}, {ends}, (c, e) -> named_struct('start', c.start, 'rank', c.rank, 'from', e)), h -> h.start >= h.from)")
    df = df.withColumn(_T + "h", F.expr(f"case when size({s}) > 0 then {heads} end"))
    tags = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    t = f"`{text_col}`"
    parts = (f"transform({_T}h, h -> concat(substr({t}, cast(h.from + 1 as int), cast(h.start - h.from as int)), array({tags})[h.rank]))")
    tail = f"substr({t}, cast(array_max(transform({s}, c -> c.end)) + 1 as int))"
    return df.withColumn(text_col, F.expr(f"case when size({s}) > 0 then concat(array_join({parts}, ''), {tail}) else {t} end")).drop(_T + "h")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Pipeline stage: all documents stay, personal data replaced; n_chars follows the text where the column exists."""
    found = candidates(docs)
    out = redact(detect(found, fit(found)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
