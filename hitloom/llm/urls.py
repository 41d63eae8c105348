"""URL filter: host and path rules first, then a weighted vocabulary found by Aho-Corasick.

One pass of the automaton counts the vocabulary's terms in a URL.  A term counts
only as a whole token (no ASCII letter or digit directly before or after it).  A strict term rejects alone; soft terms reject when
``soft_needed`` different ones are found whose weights come to ``soft_weight``.  How often a term occurs does not matter.

Defined results
    a null URL, or one without ``://``, has an empty host and path, fits no rule, and
    is judged by the terms in it (null: none, so allowed); a URL of any length is searched to
    its end; repeated rows each get a verdict; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, ship, with_fields, worker_keeps

ship(__name__)

# The vocabulary of the filter, by theme: adult, gambling, medicine sold unseen, loans and schemes, junk traffic.
# A strict term rejects a URL alone.  Soft terms are weighted: 2 for a word that is rarely innocent in a URL,
# 1 for a common word that only counts beside others.
STRICT_TERMS = [
    "porn", "porno", "pornstar", "xxx", "camgirls", "hentai", "escorts", "milf", "webcamsex", "sexcam", "nsfw",
    "casino", "sportsbetting", "sportsbook", "bookmaker", "blackjack", "roulette", "online-slots",
    "viagra", "cialis", "levitra", "tramadol", "xanax", "steroids-online",
    "payday-loans", "payday-loan", "ponzi", "get-rich-quick",
    "warez", "keygen", "clickbait", "linkfarm",
]
SOFT_TERMS = {
    "adult": 2, "cams": 1, "dating": 1, "erotic": 2, "escort": 2, "fetish": 2, "hookup": 2, "naked": 2, "nude": 2, "nudes": 2,
    "sex": 2, "sexy": 2, "singles": 1, "webcam": 1,
    "bet": 2, "bets": 2, "betting": 2, "bingo": 2, "bonus": 1, "deposit": 1, "gamble": 2, "gambling": 2, "jackpot": 2,
    "lottery": 2, "lotto": 2, "odds": 1, "poker": 2, "slots": 2, "spins": 2, "wager": 2, "win": 1, "winner": 1,
    "diet": 1, "drugs": 1, "enlargement": 2, "meds": 2, "pharmacy": 1, "pill": 2, "pills": 2, "prescription": 1, "steroids": 2,
    "bitcoin": 1, "cash": 1, "credit": 1, "debt": 1, "earn": 1, "fast": 1, "forex": 1, "investment": 1, "loan": 1, "loans": 1,
    "mlm": 2, "payday": 2, "profit": 1, "rich": 1,
    "ad": 1, "ads": 2, "banner": 1, "bot": 1, "buy": 1, "cheap": 1, "click": 1, "clicks": 1, "crack": 2, "deals": 1, "discount": 1,
    "doorway": 2, "farm": 1, "free": 1, "pop-under": 2, "popup": 2, "replica": 2, "spam": 2, "torrent": 2, "track": 1,
    "tracker": 1, "tracking": 1, "traffic": 1,
}
#: Different soft terms, and their weight together, that reject a URL.
SOFT_NEEDED, SOFT_WEIGHT = 2, 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(column: Column) -> Column:
    return F.translate(column, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a URL; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def matching_rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; rules are (verdict, host, path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _automaton(strict: Iterable[str], soft: Iterable[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            found.add_word(term, (kind, term))
    if len(found):
        found.make_automaton()
    return found


def _in_token(char: str) -> bool:
    return char.isascii() and char.isalnum()


def term_hits(url: str, automaton: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """The distinct strict and soft terms that stand in ``url`` as whole tokens."""
    hits: dict[str, set[str]] = {"strict": set(), "soft": set()}
    if len(automaton):
        for end, (kind, term) in automaton.iter(url):
            start = end - len(term) + 1
            if not (_in_token(url[start - 1 : start]) or _in_token(url[end + 1 : end + 2])):
                hits[kind].add(term)
    return hits["strict"], hits["soft"]


def filter_urls(
    pages: DataFrame,
    url_col: str = "url",
    rules: Iterable[tuple[str, str, str]] = (),
    strict: Iterable[str] = tuple(STRICT_TERMS),
    soft: Mapping[str, int] = SOFT_TERMS,
    soft_needed: int = SOFT_NEEDED,
    soft_weight: int = SOFT_WEIGHT,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, strict_hits, soft_hits and soft_weight (names that clash get a leading ``_``)."""
    strict, weights, columns = tuple(strict), dict(soft), pages.columns
    names = fresh(pages, "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "soft_weight", "lowered")
    *_, strict_hits, soft_hits, weight, lowered = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_keeps("urls", (strict, *weights), lambda: _automaton(strict, weights))
        for batch in batches:
            hits = [term_hits(u, automaton) for u in batch.column(lowered).to_pylist()]
            arrays = [pa.array([sorted(h[k]) for h in hits], pa.list_(pa.string())) for k in (0, 1)]
            weighed = pa.array([sum(weights[t] for t in h[1]) for h in hits], pa.int64())
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, *arrays, weighed], names=[*columns, strict_hits, soft_hits, weight])

    schema = with_fields(pages, **{strict_hits: "array<string>", soft_hits: "array<string>", weight: "long"})
    found = pages.withColumn(lowered, lower_ascii(F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))))
    found = found.mapInArrow(run, schema)
    host, path = host_and_path(F.col(f"`{url_col}`"))
    found = found.withColumns({names[0]: host, names[1]: path})
    rule, verdict = matching_rule(F.col(names[0]), F.col(names[1]), list(rules))
    rejected = (F.size(strict_hits) > 0) | ((F.size(soft_hits) >= soft_needed) & (F.col(weight) >= soft_weight))
    return found.withColumns({
        names[2]: rule, names[3]: F.coalesce(verdict, F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))),
    })
