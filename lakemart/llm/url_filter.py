"""URL filter: host and path rules, then a weighted vocabulary.

A rule (host, path) fits its host and all subdomains of it when the URL's path
starts with the rule's path; the longest fitting rule decides.  URLs without a
fitting rule are judged by their words: an Aho-Corasick automaton finds all
terms of the vocabulary in one walk over host and path, a hit counts only
between boundaries (the ends, or any character other than a-z and 0-9), and a
URL is blocked on one strict term or on several distinct soft ones.

Each batch of URLs is judged where it is read: no shuffle, and nothing is
broadcast but the rules and the vocabulary, which are parameters of the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Terms that block a URL alone.
STRICT = ("adult", "betting", "camgirl", "casino", "casinos", "escort", "escorts", "gambling", "hentai", "hookup",
          "jackpot", "malware", "milf", "nsfw", "nude", "nudes", "phishing", "porn", "porno", "pornography", "poker",
          "roulette", "sex", "sexcam", "slots", "spam", "viagra", "warez", "webcamsex", "xxx")
#: Terms that block a URL when several different ones stand in it.
SOFT = ("ads", "bet", "bets", "bonus", "buy", "cam", "cams", "cash", "cheap", "click", "crack", "cracked", "dating",
        "deal", "deals", "discount", "drugs", "farm", "free", "girls", "hacked", "hot", "keygen", "loan", "loans",
        "lottery", "meds", "money", "offer", "payday", "pharma", "pharmacy", "pills", "promo", "prize", "rich",
        "sexy", "singles", "torrent", "track", "tracker", "win", "winner", "x")
#: Distinct soft terms from which a URL is blocked.
SOFT_HITS = 2
_LOWER = {c: c + 32 for c in range(65, 91)}
_INNER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class Rule:
    """``verdict`` is 'allow' or 'block'; ``path`` begins with a slash."""
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host stands after the first :// up to a /, ?, # or the
    end, with A-Z lower-cased; the path follows up to a ?, # or the end.  A null
    URL or one without :// has neither."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    at += 3
    stops = [i for i in (url.find(c, at) for c in "/?#") if i >= 0]
    end = min(stops, default=len(url))
    stops = [i for i in (url.find(c, end) for c in "?#") if i >= 0]
    return url[at:end].translate(_LOWER), url[end: min(stops, default=len(url))]


class Rules:
    """Rules by host: a URL looks up its host and each parent domain of it."""

    def __init__(self, rules: Iterable[Rule]):
        self.by_host: dict[str, list[Rule]] = {}
        for r in rules:
            self.by_host.setdefault(r.host, []).append(r)

    def find(self, host: str, path: str) -> Rule | None:
        """The longest fitting rule by the length of host and path together; of
        equally long ones that of the longer host."""
        best, domain = None, host
        while domain:
            for r in self.by_host.get(domain, ()):
                if path.startswith(r.path) and (best is None or len(r.name) > len(best.name)):
                    best = r
            domain = domain.partition(".")[2]
        return best


class Vocabulary:
    """An Aho-Corasick automaton over strict and soft terms (lower case).  A term
    that is both is strict."""

    def __init__(self, weights: Mapping[str, int]):
        """``weights``: how much of the threshold, SOFT_HITS, one term makes up."""
        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            if term:
                self.automaton.add_word(term, (term, weight))
        self.automaton.make_automaton()
        self.size = len(self.automaton)

    def hits(self, text: str) -> dict[str, int]:
        """The distinct terms that stand between boundaries, with their weights."""
        found: dict[str, int] = {}
        if not self.size:
            return found
        for end, (term, weight) in self.automaton.iter(text):
            start = end - len(term) + 1
            if (start == 0 or text[start - 1] not in _INNER) and (end + 1 == len(text) or text[end + 1] not in _INNER):
                found[term] = weight
        return found


def weights(strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_hits: int = SOFT_HITS) -> dict[str, int]:
    """A strict term weighs as much as the threshold, a soft one 1."""
    return {t: 1 for t in soft} | {t: soft_hits for t in strict}


def judge(pages: DataFrame, rules: Sequence[Rule] = (), strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT,
          soft_hits: int = SOFT_HITS, url_col: str = "url", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The columns ``keep`` of every row, host, path, rule (its host and path, or
    null), terms (the distinct vocabulary hits in alphabetical order; empty where
    a rule decided) and verdict.

    A null URL, an empty one and one without :// have an empty host and path, fit
    no rule and are allowed.  Repeated rows and null ids stay as they are; a long
    URL is read whole.  Other columns are not read; ``keep`` must not hold the
    names host, path, rule, terms and verdict.
    """
    table, words, order = Rules(rules), weights(strict, soft, soft_hits), [*keep]

    def run(batches):
        vocabulary = Vocabulary(words)
        for b in batches:
            url = pc.dictionary_encode(b.column(b.num_columns - 1), null_encoding="encode")
            out = {"host": [], "path": [], "rule": [], "terms": [], "verdict": []}
            for u in url.dictionary.to_pylist():  # equal URLs of a batch are judged once
                host, path = split_url(u)
                rule, terms = table.find(host, path), []
                if rule is None:
                    hits = vocabulary.hits((host + path).translate(_LOWER))
                    terms = sorted(hits)
                    verdict = "block" if sum(hits.values()) >= soft_hits else "allow"
                else:
                    verdict = rule.verdict
                for name, value in zip(out, (host, path, rule.name if rule else None, terms, verdict), strict=True):
                    out[name].append(value)
            types = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
            made = [pa.array(v, t).take(url.indices) for v, t in zip(out.values(), types, strict=True)]
            yield pa.record_batch([*b.columns[:-1], *made], names=[*order, *out])

    src = pages.select(*order, F.col(url_col).alias("__url"))
    schema = "".join(f"`{c}` {t}, " for c, t in src.dtypes[:-1]) + "host string, path string, rule string, terms array<string>, verdict string"
    return src.mapInArrow(run, schema)
