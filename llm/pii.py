"""Personal data by weak supervision, with DataFrame and SQL functions only.

Patterns propose spans of every kind.  Four labelers vote on each: the pattern's own checks (digits,
Luhn, ranges), a gazetteer (top-level domains, card issuers, calling codes, secret keywords), the words
before the span, and the variety of its characters.  Votes are counted by combination (a table whose
size is bounded by kinds and votes); expectation maximisation estimates each labeler's reliability from
those counts, and a logistic classifier trained on the posteriors scores every span as a SQL expression.

Spans of the four base kinds that pass their checks always stay; the method adds ``secret`` and ``ssn``
spans that score at least one half; a secret may overlap base spans, and both are given.  Offsets are code points, the end is exclusive.

Defined results: a null or empty text has no spans; repeated rows are judged alike; a null doc_id is kept; an
empty table gives an empty table; other columns play no part.  The patterns use possessive
repeats, which match the same strings as the plain ones and need no stack on very long runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.session import materialise, table

#: Kinds in the order of the output, and their patterns.
KINDS = ("email", "ip", "card", "phone", "secret", "ssn")
BASE = 4
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key)[\x20]{0,3}[:=][\x20]{0,3}[\"']?[^\s\"',;]{6,}+[\"']?",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this cannot hold the kind; it spares the pattern.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+", "secret": "", "ssn": "-"}
#: Gazetteers.
TLDS = "com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us|ca|at|ch|nl|be|pt|mx|ar|br|jp|cn|in|au"
ISSUERS = "^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|62)"
CALLING = "^(1|7|20|27|3[0-46-9]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
STRONG_SECRETS = "^(?i)(password|passwd|passphrase|token|api[_-]?key|access[_-]?key)"
CUES = {
    "email": "mail|contact|write|reach|address",
    "ip": "ip|server|host|address|from|login",
    "card": "card|visa|master|credit|pay|account",
    "phone": "tel|phone|call|mobile|fax|contact",
    "secret": "my|the|use|with|login|user",
    "ssn": "ssn|social|security|id",
}
AGAINST = "version|release|chapter|section|figure|rev|isbn|part no"
CONTEXT = 24
#: matches whose lengths are added up together
RUN = 128
VOTES = ("v_check", "v_list", "v_words", "v_shape")


def _matches(kind: str) -> Column:
    """All spans of a pattern: array of (s, e, t, c) from the pieces between matches and the matches themselves."""
    text = F.col("text")
    seen = text.rlike("[0-9]") if kind != "secret" else text.rlike("[=:]")
    if NEEDS[kind]:
        seen = seen & text.contains(NEEDS[kind]) if kind != "email" else text.contains("@")
    found = F.when(seen, F.struct(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)).alias("m"), F.split(text, PATTERNS[kind], -1).alias("g")))
    return found.alias(f"f_{kind}")


def _lengths(kind: str) -> Column:
    """The length of every match with the piece before it."""
    f = f"f_{kind}"
    return F.expr(f"CASE WHEN size({f}.m) > 0 THEN transform(sequence(0, size({f}.m) - 1), i -> length({f}.g[i]) + length({f}.m[i])) ELSE cast(array() as array<int>) END").alias(f"l_{kind}")


def _run_starts(kind: str) -> Column:
    """Where every run of ``RUN`` matches begins, so that no position is a sum over all matches before it."""
    own = f"l_{kind}"
    runs = f"CASE WHEN size({own}) > 0 THEN sequence(0, (size({own}) - 1) div {RUN}) ELSE array() END"
    return F.expr(
        f"""aggregate({runs}, named_struct('p', 0, 'a', cast(array() as array<int>)), (acc, k) -> named_struct(
        'p', acc.p + aggregate(slice({own}, cast(k * {RUN} + 1 as int), {RUN}), 0, (x, y) -> x + y), 'a', concat(acc.a, array(acc.p)))).a"""
    ).alias(f"b_{kind}")


def _spans(kind: str) -> Column:
    f = f"f_{kind}"
    typed = "cast(array() as array<struct<s:int,e:int,t:string,c:string>>)"
    at = f"b_{kind}[cast(i div {RUN} as int)] + aggregate(slice(l_{kind}, cast(i div {RUN} * {RUN} + 1 as int), i % {RUN}), 0, (x, y) -> x + y) + length({f}.g[i])"
    return F.expr(
        f"""CASE WHEN size(l_{kind}) > 0 THEN transform(sequence(0, size(l_{kind}) - 1),
        i -> named_struct('s', {at}, 'e', {at} + length({f}.m[i]), 't', {f}.m[i], 'c', lower(right({f}.g[i], {CONTEXT}))))
        ELSE {typed} END"""
    )


def _check(kind: str) -> str:
    digits = "regexp_replace(x.t, '[^0-9]', '')"
    digit = f"cast(substring(reverse({digits}), k, 1) as int)"
    luhn = f"aggregate(sequence(1, length({digits})), 0, (acc, k) -> acc + CASE WHEN k % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END) % 10 = 0"
    return {
        "email": "true",
        "ip": "forall(split(x.t, '[.]'), p -> p rlike '^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$')",
        "card": f"length({digits}) between 16 and 19 and {luhn}",
        "phone": f"length({digits}) between 8 and 15",
        "secret": "x.t rlike '[0-9]' or x.t rlike '[A-Z].*[a-z]|[a-z].*[A-Z]'",
        "ssn": "not (x.t rlike '^(000|666|9)' or x.t rlike '-00-' or x.t rlike '-0000$')",
    }[kind]


def _listed(kind: str) -> str:
    digits = "regexp_replace(x.t, '[^0-9]', '')"
    vote = lambda yes, no: f"CASE WHEN {yes} THEN 1 WHEN {no} THEN -1 ELSE 0 END"
    return {
        "email": vote(f"lower(x.t) rlike '[.]({TLDS})$'", "false"),
        "ip": vote("not (x.t rlike '^(0|127|255)[.]')", "true"),
        "card": vote(f"{digits} rlike '{ISSUERS}'", "true"),
        "phone": vote(f"{digits} rlike '{CALLING}'", "true"),
        "secret": vote(f"x.t rlike '{STRONG_SECRETS}'", "false"),
        "ssn": vote("x.t rlike '^[0-8]'", "true"),
    }[kind]


def _candidates(kind: str, place: int) -> str:
    """SQL for the kind's spans with their votes."""
    words = f"CASE WHEN x.c rlike '({AGAINST})[^a-z]*$' THEN -1 WHEN x.c rlike '({CUES[kind]})' THEN 1 ELSE 0 END"
    many = "size(array_distinct(split(x.t, '')))"
    shape = f"CASE WHEN {many} >= 6 THEN 1 WHEN {many} <= 3 THEN -1 ELSE 0 END"
    ok = _check(kind)
    return (
        f"transform(s_{kind}, x -> named_struct('kind', {place}, 's', x.s, 'e', x.e, 'ok', {ok}, "
        f"'v_check', CASE WHEN {ok} THEN 1 ELSE -1 END, 'v_list', {_listed(kind)}, 'v_words', {words}, 'v_shape', {shape}))"
    )


def candidate_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): every proposed span of every row with its votes."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = slim.select("doc_id", *[_matches(k) for k in KINDS])
    sized = found.select("*", *[_lengths(k) for k in KINDS])
    begun = sized.select("*", *[_run_starts(k) for k in KINDS])
    placed = begun.select("doc_id", *[_spans(k).alias(f"s_{k}") for k in KINDS])
    return placed.select("doc_id", F.expr("concat(" + ", ".join(_candidates(k, i) for i, k in enumerate(KINDS)) + ")").alias("spans"))


# ---- the label model and the classifier, on the driver over counts of vote combinations ----------


def _sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


def fit_labelers(counts: list[tuple[int, tuple[int, ...], int]], rounds: int = 60) -> tuple[dict[tuple[int, tuple[int, ...]], float], dict[int, float], list[list[list[float]]]]:
    """Expectation maximisation over (kind, votes, count).

    Returns each combination's posterior of being personal data, each kind's share, and each labeler's
    table of vote shares by class; the start trusts a majority of votes, and shares are smoothed.
    """
    post = {(k, v): _sigmoid(1.5 * sum(v)) for k, v, _ in counts}
    share: dict[int, float] = {}
    tables: list[list[list[float]]] = []
    for _ in range(rounds):
        share = {}
        for kind in {k for k, _, _ in counts}:
            rows = [(post[k, v], n) for k, v, n in counts if k == kind]
            share[kind] = (sum(p * n for p, n in rows) + 1) / (sum(n for _, n in rows) + 2)
        tables = []
        for j in range(len(VOTES)):
            own = [[1.0, 1.0, 2.0], [2.0, 1.0, 1.0]]  # personal data: votes -1, 0, 1; then the rest
            for k, v, n in counts:
                own[0][v[j] + 1] += post[k, v] * n
                own[1][v[j] + 1] += (1 - post[k, v]) * n
            tables.append([[x / sum(r) for x in r] for r in own])
        post = {
            (k, v): _sigmoid(math.log(share[k] / (1 - share[k])) + sum(math.log(tables[j][0][v[j] + 1] / tables[j][1][v[j] + 1]) for j in range(len(VOTES)))) for k, v, _ in counts
        }
    return post, share, tables


def fit_classifier(counts: list[tuple[int, tuple[int, ...], int]], post: dict, steps: int = 400, rate: float = 0.5) -> list[float]:
    """Weights of (1, kinds..., votes...) by gradient steps on the posteriors, weighted by square roots of counts."""
    rows = []
    for k, v, n in counts:
        rows.append(([1.0, *[float(k == i) for i in range(len(KINDS))], *map(float, v)], post[k, v], math.sqrt(n)))
    total = sum(r[2] for r in rows) or 1.0
    w = [0.0] * (1 + len(KINDS) + len(VOTES))
    for _ in range(steps):
        g = [0.001 * x for x in w]
        for x, p, n in rows:
            miss = n / total * (_sigmoid(sum(a * b for a, b in zip(w, x, strict=True))) - p)
            for i, xi in enumerate(x):
                g[i] += miss * xi
        w = [a - rate * b for a, b in zip(w, g, strict=True)]
    return w


def find_pii(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, n_secret, n_ssn: one row per input row."""
    found = materialise(candidate_spans(docs))
    votes = found.select(F.explode("spans").alias("x")).groupBy("x.kind", *[f"x.{v}" for v in VOTES]).agg(F.count("*").alias("n"))
    counts = sorted((r["kind"], tuple(r[v] for v in VOTES), r["n"]) for r in votes.collect())  # at most kinds * 3**4 rows
    w = [0.0] * (1 + len(KINDS) + len(VOTES))
    if counts:
        w = fit_classifier(counts, fit_labelers(counts)[0])
    kind_weight = f"element_at(array({', '.join(f'{x!r}D' for x in w[1 : 1 + len(KINDS)])}), x.kind + 1)"
    z = f"{w[0]!r}D + {kind_weight} + " + " + ".join(f"{x!r}D * x.{v}" for x, v in zip(w[1 + len(KINDS) :], VOTES, strict=True))
    least = math.log(threshold / (1 - threshold))
    kept = found.select(
        "doc_id",
        F.expr(f"filter(spans, x -> x.kind < {BASE} and x.ok)").alias("base"),
        F.expr(f"filter(spans, x -> x.kind >= {BASE} and x.ok and {z} >= {least!r}D)").alias("more"),
    ).withColumn("more", F.expr(f"filter(more, x -> x.kind = {KINDS.index('secret')} or not exists(base, b -> b.s < x.e and x.s < b.e))"))
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    joined = lambda c: F.expr(f"array_join(transform({c}, x -> concat(element_at({names}, x.kind + 1), ':', x.s, ':', x.e)), ',')")
    n = lambda c, i: F.expr(f"size(filter({c}, x -> x.kind = {i}))").cast("long")
    return kept.select(
        "doc_id",
        *[n("base", i).alias(f"n_{k}") for i, k in enumerate(KINDS[:BASE])],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("concat(base, more)").alias("spans"),
        *[n("more", i + BASE).alias(f"n_{k}") for i, k in enumerate(KINDS[BASE:])],
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents``."""
    return find_pii(table(spark, sf_dir, "documents"))
