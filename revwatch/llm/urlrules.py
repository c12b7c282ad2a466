"""URL filters indexed by each rule's rarest literal token (operator 10).

A pattern rule matches with ``*`` for anything, ``^`` for a separator, ``|`` for an end
of the URL and ``||`` for the start of a host label; ``@@`` makes it an exception. Of the
tokens that any matching URL must contain whole, the one rarest among the URLs is the
rule's key. A URL's tokens fetch the rules kept under them, and only their regular
expressions run; rules without such a token run on every URL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict): fixed values of the contract.
HOST_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

PATTERNS = (
    "||ads.*^",
    "||adserver.",
    "||doubleclick.net^",
    "||tracker.",
    "/ads/",
    "/adserver/",
    "/banner/*/img^",
    "/popunder.",
    "/pixel.gif|",
    "/tracking/pixel",
    "/affiliate/",
    "/casino/",
    "/porn/",
    "/xxx/",
    "/wp-login.php|",
    "/cart/checkout^",
    "/cdn-cgi/challenge",
    ".exe|",
    ".apk|",
    "?sessionid=",
    "&sessionid=",
    "@@/ads/policy^",
    "@@||casino.museum^",
)

_TOKEN = re.compile(r"[a-z0-9]{2,}")
_LITERAL = re.compile(r"(?:(?<=[^a-z0-9*])|(?<=^\|)|(?<=^\|\|))[a-z0-9]{2,}(?=[^a-z0-9*])")
_ASCII = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Pattern:
    text: str

    @property
    def allows(self) -> bool:
        return self.text.startswith("@@")

    @property
    def body(self) -> str:
        return self.text.removeprefix("@@").lower()

    @cached_property
    def regex(self) -> re.Pattern[str]:
        body, start, end = self.body, "", ""
        if body.startswith("||"):
            body, start = body[2:], r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, start = body[1:], "^"
        if body.endswith("|"):
            body, end = body[:-1], r"\Z"
        inner = "".join({"*": ".*", "^": r"(?:[^a-z0-9_.%-]|\Z)"}.get(c) or re.escape(c) for c in body)
        return re.compile(start + inner + end, re.S)

    @property
    def tokens(self) -> list[str]:
        """Tokens that stand whole in every URL the rule matches."""
        return _LITERAL.findall(self.body)


def url_tokens(url: str) -> set[str]:
    return set(_TOKEN.findall(url))


class RuleIndex:
    def __init__(self, patterns: Sequence[str], frequency: dict[str, int]):
        self.by_token: dict[str, list[Pattern]] = {}
        self.always: list[Pattern] = []
        for pattern in map(Pattern, dict.fromkeys(patterns)):
            keys = sorted(set(pattern.tokens), key=lambda t: (frequency.get(t, 0), -len(t), t))
            (self.by_token.setdefault(keys[0], []) if keys else self.always).append(pattern)

    def candidates(self, url: str) -> list[Pattern]:
        return [*self.always, *(p for t in url_tokens(url) for p in self.by_token.get(t, ()))]

    def matches(self, url: str) -> list[Pattern]:
        return [p for p in self.candidates(url) if p.regex.search(url)]


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(_ASCII), re.match(r"[^?#]*", rest[len(host) :])[0]


def host_rule(host: str, path: str, rules: Sequence[tuple[str, str, str]]) -> tuple[str, str] | None:
    """The longest rule that fits a host or one it is below, and starts the path."""
    fits = [
        r for r in rules if path.startswith(r[1]) and (host == r[0] or host.endswith(f".{r[0]}"))
    ]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), default=None)
    return best and (best[0] + best[1], best[2])


def token_frequency(pages: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens; a row per rule token at the most."""
    if not tokens:
        return {}
    own = F.array_intersect(
        F.regexp_extract_all(F.lower("url"), F.lit(_TOKEN.pattern), F.lit(0)), F.array(*map(F.lit, tokens))
    )
    counts = pages.select(F.explode(own).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return {r.token: r.n for r in counts.collect()}


def judge_urls(
    pages: DataFrame,
    host_rules: Sequence[tuple[str, str, str]] = HOST_RULES,
    patterns: Sequence[str] = PATTERNS,
) -> DataFrame:
    """page_id, host, path, rule, verdict and ``matched`` (pattern rules) for each row of ``pages``.

    The longest host rule decides; without one, a URL is blocked if a pattern rule matches
    and no exception does. A null url or one without ``://`` has an empty host and path and
    no host rule. Repeated rows are judged each by itself; other columns are ignored. The
    rules are a list the driver holds already, so sending them to the tasks is bounded.
    """
    frequency = token_frequency(pages, sorted({t for p in map(Pattern, patterns) for t in p.tokens}))
    index = pages.sparkSession.sparkContext.broadcast(RuleIndex(patterns, frequency))
    wanted = pages.select("page_id", "url")
    fixed = tuple(host_rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                rule = host_rule(host, path, fixed)
                found = index.value.matches((url or "").lower())
                blocked = any(not p.allows for p in found) and not any(p.allows for p in found)
                verdict = rule[1] if rule else "block" if blocked else "allow"
                rows.append((host, path, rule and rule[0], verdict, sorted(p.text for p in found)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [*[pa.string()] * 4, pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["page_id", "host", "path", "rule", "verdict", "matched"],
            )

    key = wanted.schema["page_id"].dataType.simpleString()
    return wanted.mapInArrow(
        judge, f"page_id {key}, host string, path string, rule string, verdict string, matched array<string>"
    )
