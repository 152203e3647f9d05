"""Secrets in whole texts, with DataFrame functions alone: strong spans, and weak ones that are linked.

Strong spans speak for themselves (assignments to secret names, access identifiers, long hex runs).
Weak candidates - user or client names, random-looking strings, endpoints - are parts of a
credential. They are joined by interval within a scope: a part's scope reaches SCOPE code points beyond both of
its ends. A weak candidate is reported only when a part that completes it touches its scope: an identifier or an
endpoint for a secret, a secret for either of those. Only the gap between the two counts, not where they stand.
The interval join runs over the row's own parts, so it needs no shuffle and never forms pairs: spans of one kind
don't overlap, so of those that begin before a scope's end the last one reaches furthest, and halving finds it.

Positions: Spark gives the matches of a pattern, and by splitting at it what lies between them; both in
the same order. Running sums of their lengths in code points are the spans.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.functions.binding import bind, halvings, leading, let, pick
from wayloom.functions.lines import running_totals
from wayloom.llm.common import text_of

#: Code points that a part's scope reaches beyond its ends.
SCOPE = 256


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_USERS = "|".join(map(_either_case, ("user_?name", "login", "client_?id", "account_?id", "access_?key_?id")))


@dataclass(frozen=True)
class Kind:
    """`pattern` finds matches; those whose `group` is shorter than `least` are dropped.

    `role` is what a match can be in a credential: id, secret or endpoint.
    """

    name: str
    pattern: str
    least: int
    role: str
    group: int = 0
    strong: bool = True


#: The first three kinds are those of the contract, in its order.
KINDS = (
    Kind("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, "secret", 2),
    Kind("access", "AKIA[A-Z0-9]+", 20, "id"),
    Kind("hex", "[0-9a-f]{24,}", 24, "secret"),
    Kind("user", rf"({_USERS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.@-]+)", 3, "id", 2, False),
    Kind("random", "[A-Za-z0-9+/]{40,}={0,2}", 40, "secret", 0, False),
    Kind("endpoint", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[A-Za-z0-9_.:@-]{4,}", 7, "endpoint", 0, False),
)


def _spans(kind: Kind, rank: int) -> Column:
    """Array of struct(start, rank, end) of a kind's matches in column _text, in code points."""
    pattern = F.lit(kind.pattern)
    whole = F.transform(F.regexp_extract_all("_text", pattern, F.lit(0)), F.char_length)
    between = F.transform(F.split("_text", kind.pattern, -1), F.char_length)
    judged = whole
    if kind.group:
        judged = F.transform(F.regexp_extract_all("_text", pattern, F.lit(kind.group)), F.char_length)

    def placed(found: Column) -> Column:
        n = F.size(found["n"])
        each = F.zip_with(F.slice(found["gap"], 1, n), found["n"], lambda gap, own: (gap + own).cast("double"))
        ends = F.transform(F.slice(let(each, running_totals), 2, n), lambda end: end.cast("int"))
        cells = F.arrays_zip(ends.alias("end"), found["n"].alias("n"), found["m"].alias("m"))
        span = lambda c: F.struct((c["end"] - c["n"]).alias("start"), F.lit(rank).alias("rank"), c["end"].alias("end"))
        return F.transform(F.filter(cells, lambda c: c["m"] >= kind.least), span)

    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    found = F.struct(between.alias("gap"), whole.alias("n"), judged.alias("m"))
    return let(found, lambda f: F.when(F.size(f["n"]) > 0, placed(f)).otherwise(none))


def _completed(kind: Kind, part: Column) -> Column:
    """A part of another role, such that the two can be used together, touches the part's scope."""

    def near(rank: int) -> Column:
        spans = F.col(f"_{rank}")
        before = leading(F.col(f"_steps{rank}"), lambda i: pick(spans, i)["start"] <= part["end"] + SCOPE)
        return let(before, lambda n: (n > 0) & F.coalesce(pick(spans, n - 1)["end"] >= part["start"] - SCOPE, F.lit(False)))

    return reduce(lambda a, b: a | b, (near(i) for i, k in enumerate(KINDS) if (k.role == "secret") != (kind.role == "secret")))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k.name) for k in KINDS))
    one = F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, the text as `_text`, and `_base` and `_spans`: arrays of struct(start, rank, end).

    `rank` is the place in KINDS, `end` is exclusive, both arrays go by start, then rank. `_base` has the
    strong spans, `_spans` these and the linked weak ones. One row for each row of `docs`, whatever its
    id; a null or empty text has no spans. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_column), text_of(text_column).alias("_text"))
    rows = bind(rows, **{f"_{i}": _spans(k, i) for i, k in enumerate(KINDS)})
    rows = bind(rows, **{f"_steps{i}": halvings(F.size(f"_{i}")) for i in range(len(KINDS))})
    strong = [F.col(f"_{i}") for i, k in enumerate(KINDS) if k.strong]
    linked = [F.filter(f"_{i}", partial(_completed, k)) for i, k in enumerate(KINDS) if not k.strong]
    base, spans = F.array_sort(F.concat(*strong)), F.array_sort(F.concat(*strong, *linked))
    return rows.select(id_column, "_text", base.alias("_base"), spans.alias("_spans"))


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts of strong spans by kind, the hash of their list, and the list of all spans."""

    def count(rank: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        F.col(id_column).cast("long").alias("doc_id"),
        *(count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if k.strong),
        F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("_spans")).alias("spans"),
    )
