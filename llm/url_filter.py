"""URL filtering with a weighted vocabulary, and a host and path rule list in front of it.

An Aho-Corasick automaton finds all vocabulary terms of a lower-cased url in one walk.  A hit counts
only when the characters beside it are not ASCII letters or digits.  One strict term, or soft terms
whose weights reach the threshold when each distinct term counts once, reject the url.

Defined results: a null url, or one without ``://``, has an empty host and an empty path, fits no rule,
and is judged on its text (null: allow); repeated rows are judged alike; only A-Z are lower-cased; an
empty table gives an empty table; the other columns of the table play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.session import table

#: Terms that reject a url alone.
STRICT = tuple(
    """
    adult anal asstube bdsm blowjob boobs brothel bukkake camgirl camgirls camsex camwhores carding casino crackz creampie
    cumshot cunnilingus deepthroat dildo erotic erotica escort escorts femdom fetish fleshlight gangbang hardcoresex
    hentai hookup hookups keyloggers kinky latinas malware masturbation milf milfs nsfw nude nudes nudist onlyfans orgasm
    orgy phishing phishkit playboy porn porngif pornhub porno pornos pornstar pornstars pornvideos redtube serialz sexcam
    sexcams sexchat sexshop sexting sextoys sexvideos shemale slut sluts spam spambot spammer spankbang stripclub stripper
    strippers striptease swingers threesome threesomes tits titties topless upskirt viagra voyeur warez webcamsex whore
    xhamster xnxx xrated xvideo xvideos xxx xxxvideos youjizz youporn
    """.split()
)
#: Soft terms by weight, from telling ones to ones that ordinary urls hold as well.
_BY_WEIGHT = {
    3: """
    baccarat bet bets betting blackjack bookmaker bookmakers cam cams cialis crack cracked cracks dating gambling jackpot
    keygen keygens levitra loan loans painkillers payday pharma pills poker roulette serials sex sexy slots steroids
    torrent torrents tramadol valium wager xanax
    """,
    2: """
    ads adserver adservers antivirusfree babes binary botox cashback cheats chicks cleavage clickbank cocaine cracker
    dietpills doxxing forex giveaway hacked hacks hot hotties incest kamagra kratom lingerie lottery lotto mlm nudity
    nulled opioid pharmacy pirate pirated popunder popups proxies ransomware replica replicas ringtones rolex rootkit scam
    seo singles spins sweepstakes teen teens tiktokfollowers track tracker trackers unblocked unlocker webcam webcams
    weightloss
    """,
    1: """
    bonus bonuses cash cheap coupon coupons credit deal deals discount discounts earn farm free gift girls instant invest
    luck lucky mature offer offers penny prize prizes profit promo promos quick refinance rich sale sales spin vip win
    winner winners wins
    """,
}
SOFT = {term: weight for weight, terms in _BY_WEIGHT.items() for term in terms.split()}
#: More than any single weight, so that no soft term rejects alone.
THRESHOLD = 4
#: Fixed values: (action, host, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = str.maketrans(_UPPER, _LOWER)
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits, both null where none does."""
    rule = action = None
    for act, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        action = F.when(fits, act) if action is None else action.when(fits, act)
    return rule, action


def automaton(strict: Iterable[str], soft: Mapping[str, int]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term in strict:
        found.add_word(term, (term, True, 0))
    for term, weight in soft.items():
        found.add_word(term, (term, False, weight))
    found.make_automaton()
    return found


def term_hits(found, url: str | None) -> tuple[int, int, int]:
    """(distinct strict terms, distinct soft terms, their weight) with boundaries on both sides."""
    if not url:
        return 0, 0, 0
    low = url.translate(_ASCII_LOWER)
    strict, soft = set(), {}
    for end, (term, is_strict, weight) in found.iter(low):
        start = end - len(term)
        if (start >= 0 and low[start] in _ALNUM) or (end + 1 < len(low) and low[end + 1] in _ALNUM):
            continue
        if is_strict:
            strict.add(term)
        else:
            soft[term] = weight
    return len(strict), len(soft), sum(soft.values())


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    strict: Sequence[str] = STRICT,
    soft: Mapping[str, int] = SOFT,
    threshold: int = THRESHOLD,
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """``keep`` columns and the url, with n_strict, n_soft, soft_weight and vocabulary_verdict."""
    slim = pages.select(*keep, F.col(url).cast("string").alias("url"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(strict, soft)
        for b in batches:
            hits = [term_hits(found, u) for u in b.column("url").to_pylist()]
            counts = [pa.array([h[i] for h in hits], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns, *counts], names=[*b.schema.names, "n_strict", "n_soft", "soft_weight"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields)
    counted = slim.mapInArrow(run, f"{schema}, n_strict long, n_soft long, soft_weight long")
    bad = (F.col("n_strict") >= 1) | (F.col("soft_weight") >= threshold)
    return counted.withColumn("vocabulary_verdict", F.when(bad, "block").otherwise("allow"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, **options) -> DataFrame:
    """page_id, host, path, rule, verdict and the vocabulary's counts; a rule overrides the vocabulary."""
    judged = judge_urls(pages, **options)
    url = F.col("url")
    split = judged.withColumns({"host": host_of(url), "path": path_of(url)})
    rule, action = longest_rule(F.col("host"), F.col("path"), rules)
    return split.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, "vocabulary_verdict").alias("verdict"), "n_strict", "n_soft")


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    """Every url of ``pages``."""
    return filter_urls(table(spark, sf_dir, "pages"))


def _sql() -> str:
    listed = lambda terms: "[" + ", ".join(f"'{t}'" for t in terms) + "]"
    # a term of letters and digits with boundaries on both sides is a whole run of them
    among = lambda terms: f"len(list_intersect(runs, {listed(terms)}))"
    weight = " + ".join(f"{w} * {among([t for t in SOFT if SOFT[t] == w])}" for w in sorted(set(SOFT.values())))
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    order = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in order)
    action = " ".join(f"WHEN {fits(h, p)} THEN '{a}'" for a, h, p in order)
    return f"""
WITH u AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), s AS (
  SELECT page_id, list_distinct(regexp_extract_all(low, '[a-z0-9]+')) AS runs, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), c AS (
  SELECT page_id, host, path, {among(STRICT)}::BIGINT AS n_strict, {among(SOFT)}::BIGINT AS n_soft, {weight} AS soft_weight FROM s
)
SELECT page_id, host, path, CASE {rule} END AS rule,
       coalesce(CASE {action} END, CASE WHEN n_strict >= 1 OR soft_weight >= {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, n_soft
FROM c
"""


OP4_SQL = _sql()
