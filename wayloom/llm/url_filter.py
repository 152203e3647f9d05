"""URL rules found by their rarest literal token.

A rule is a pattern in text form. Its literal tokens (runs of letters and digits) are counted over
the URLs of the whole table, and the rule is filed under the rarest. A URL looks up its own tokens
and runs the regular expressions of the rules filed there, and of no others.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import lower_ascii

TOKEN = re.compile("[0-9a-z]+")


@dataclass(frozen=True)
class Rule:
    """A rule on host + path: `text` is a host and a path prefix, or with stars a pattern over both.

    Prefix rules fit the host and all its subdomains, and the longest one wins. Patterns only judge
    what no prefix rule fits.
    """

    action: str
    text: str

    @property
    def pattern(self) -> bool:
        return "*" in self.text

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that a URL must have whole: those with a delimiter, not a star, at each end."""
        if not self.pattern:
            # The path prefix may end inside a token.
            return re.findall("[0-9a-z]+(?=[^0-9a-z])", self.text)
        return re.findall("(?<![*0-9a-z])[0-9a-z]+(?![*0-9a-z])", f"/{self.text}/".replace("/*", "*").replace("*/", "*"))

    @property
    def regex(self) -> str:
        if self.pattern:
            return "^" + ".*".join(map(re.escape, self.text.split("*"))) + "$"
        return "^(?:[^/]*\\.)?" + re.escape(self.text)


#: The prefix rules of the contract.
PREFIX_RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)
#: Patterns of this library, for what no prefix rule fits.
PATTERN_RULES = (
    Rule("block", "*-pills.*"),
    Rule("block", "*.cheap-*"),
    Rule("block", "spam-*"),
    Rule("block", "*.spam-*"),
    Rule("block", "*-farm.*"),
    Rule("block", "*.casino-*"),
    Rule("block", "*/casino/*"),
    Rule("block", "*/download/free-*"),
)


def located(pages: DataFrame) -> DataFrame:
    """page_id, host (A-Z lower-cased) and path; both empty without a url or without `://` in it."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    parts = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        lower_ascii(F.regexp_extract(url, parts, 1)).alias("host"),
        F.regexp_extract(url, parts, 2).alias("path"),
    )


def token_counts(located_pages: DataFrame, rules: Iterable[Rule]) -> dict[str, int]:
    """In how many URLs each token of the rules occurs; as many rows as the rules have tokens at most."""
    wanted = sorted({t for rule in rules for t in rule.tokens})
    if not wanted:
        return {}
    tokens = F.split(F.concat("host", "path"), "[^0-9a-z]+")
    found = F.array_intersect(tokens, F.array(*map(F.lit, wanted)))
    rows = located_pages.select(F.explode(found).alias("token")).groupBy("token").count().collect()
    return {t: 0 for t in wanted} | {r["token"]: r["count"] for r in rows}


def judge_urls(
    pages: DataFrame,
    prefix_rules: Iterable[Rule] = PREFIX_RULES,
    pattern_rules: Iterable[Rule] = PATTERN_RULES,
    default: str = "allow",
) -> DataFrame:
    """page_id, host, path, rule (the longest fitting prefix rule or null), pattern and verdict of each row.

    One row for each row of `pages`, in whatever number a page_id occurs; null ids stay null and a null
    url has an empty host and path, which no rule fits. Of patterns, the longest that fits decides (the
    first of the list if several are as long), else `default`. Other columns are not looked at.
    """
    prefix_rules, pattern_rules = tuple(prefix_rules), tuple(pattern_rules)
    rows = located(pages)
    counts = token_counts(rows, (*prefix_rules, *pattern_rules))
    index: dict[str, list[Rule]] = defaultdict(list)
    for rule in (*prefix_rules, *pattern_rules):
        # A rule without a whole token is filed under the empty text, which every URL looks up.
        index[min(rule.tokens, key=lambda t: (counts[t], t), default="")].append(rule)
    index = dict(index)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {t: [(r, re.compile(r.regex, re.DOTALL)) for r in rules] for t, rules in index.items()}
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out: list[tuple[str | None, str | None, str]] = []
            for host, path in zip(hosts, paths, strict=True):
                place = host + path
                fits = [
                    r
                    for t in {"", *TOKEN.findall(place)}
                    for r, regex in compiled.get(t, ())
                    if regex.match(place)
                ]
                prefix = max((r for r in fits if not r.pattern), key=lambda r: len(r.text), default=None)
                loose = max(
                    (r for r in fits if r.pattern),
                    key=lambda r: (len(r.text), -pattern_rules.index(r)),
                    default=None,
                )
                chosen = prefix or loose
                out.append(
                    (prefix and prefix.text, loose and loose.text, chosen.action if chosen else default)
                )
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.string()) for c in columns)],
                ["page_id", "host", "path", "rule", "pattern", "verdict"],
            )

    shape = "page_id bigint, host string, path string, rule string, pattern string, verdict string"
    return rows.mapInArrow(run, shape)
