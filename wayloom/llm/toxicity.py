"""Toxicity by a learned lexicon: misspellings by Levenshtein automata on a trie, context windows for quotation.

The lexicon is learned from labelled rows: words and beginnings of words that are far more frequent in
toxic documents. Tokens are looked up in a trie. Beginnings match any continuation; whole words
of some length also match with one edit, by running the Levenshtein automaton of the token over
the trie. Each hit is weighted by its context: in quotation marks or near a reporting verb it
counts as quoted. A logistic model over the sums of a document gives the score.

Training takes a bounded sample (`sample_rows` labelled rows, by a hash of the id); one half gives the
lexicon, the other the model, so that chance entries of the lexicon get no say. Scoring reads whole
texts in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from wayloom.llm.common import giving_back, row_batches, text_of

#: About so many labelled rows are learned from, and so many terms at most.
SAMPLE_ROWS = 30_000
LEXICON_TERMS = 3_000
#: Documents that must have a term, and times it must be likelier in toxic ones.
LEAST_DOCUMENTS = 6
LEAST_RATIO = 20.0
BEGINNINGS = (4, 5, 6)
#: Shortest whole word that may be misspelled.
FUZZY_LENGTH = 5
#: Tokens on each side that a context window has.
CONTEXT = 6
CACHE_WORDS = 300_000
#: From this score on a document counts as toxic.
REJECT_FROM = 0.7
WORD = re.compile(r"[^\W\d_]+")
_QUOTED = re.compile(r"\"[^\"\n]{1,300}\"|“[^”\n]{1,300}”|«[^»\n]{1,300}»|„[^“\n]{1,300}“")
#: Verbs and nouns of reported speech in the languages of the corpus.
REPORTING = frozenset(
    "said says say called calls word words term quote quoted quotes wrote slur insult insults phrase "
    "sagte schrieb wort zitat nannte dit disait mot citation écrit dijo palabra cita escribió llamó".split()
)


@dataclass
class Node:
    next: dict[str, Node] = field(default_factory=dict)
    word: float = 0.0  # weight of the whole word that ends here
    beginning: float = 0.0  # weight of the beginning that ends here


class Lexicon:
    """Trie of terms; a term with `$` at its end is a whole word, any other a beginning."""

    def __init__(self, terms: dict[str, float]) -> None:
        self.root = Node()
        heads, tails = set(), set()
        for term, weight in terms.items():
            node, letters = self.root, term.removesuffix("$")
            for letter in letters:
                node = node.next.setdefault(letter, Node())
            if term.endswith("$"):
                node.word = weight
                if len(letters) >= FUZZY_LENGTH:
                    half = len(letters) // 2
                    heads.add((len(letters), letters[:half]))
                    tails.add((len(letters), letters[half:]))
            else:
                node.beginning = weight
        self.heads, self.tails = frozenset(heads), frozenset(tails)

    def exact(self, word: str) -> float:
        """Weight of the best term that the word is or begins with."""
        node, best = self.root, 0.0
        for letter in word:
            if (node := node.next.get(letter)) is None:
                return best
            best = max(best, node.beginning)
        return max(best, node.word)

    def misspelled(self, word: str) -> float:
        """Weight of the best long whole word within one edit."""
        if len(word) < FUZZY_LENGTH - 1:
            return 0.0
        # One edit leaves one half of the term in place, at the word's start or end.
        if not any(
            (m, word[: m // 2]) in self.heads or (m, word[-(m - m // 2) :]) in self.tails
            for m in range(max(FUZZY_LENGTH, len(word) - 1), len(word) + 2)
        ):
            return 0.0
        best, n = 0.0, len(word)
        # States of the automaton: letters read, edits made. A stack of trie nodes with their states.
        stack = [(self.root, 0, frozenset({(0, 0), (1, 1)}))]
        while stack:
            node, depth, states = stack.pop()
            if node.word > best and depth >= FUZZY_LENGTH and any(n - at <= 1 - made for at, made in states):
                best = node.word
            for letter, child in node.next.items():
                reached = set()
                for at, made in states:
                    if at < n and word[at] == letter:
                        reached.add((at + 1, made))
                        if not made and at + 1 < n:
                            reached.add((at + 2, 1))  # the word's next letter is one too many
                    if not made:
                        reached.add((at, 1))  # the word lacks this letter
                        if at < n:
                            reached.add((at + 1, 1))  # it has another one
                if reached:
                    stack.append((child, depth + 1, frozenset(reached)))
        return best


class Matcher(dict):
    """(exact weight, misspelled weight) by word; emptied when full."""

    def __init__(self, terms: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = Lexicon(terms)

    def __missing__(self, word: str) -> tuple[float, float]:
        exact = self.lexicon.exact(word)
        value = (exact, 0.0 if exact else self.lexicon.misspelled(word))
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value


FEATURES = 5


def features(text: str, matcher: Matcher) -> list[float]:
    """Sums over a text's hits: plain, quoted and misspelled weight, distinct terms, share of tokens."""
    text = text.lower()
    words = WORD.findall(text)
    hits = [i for i, w in enumerate(words) if any(matcher[w])]
    if not hits:
        return [0.0] * FEATURES
    quoted_spans = [m.span() for m in _QUOTED.finditer(text)]
    places = [m.start() for m in WORD.finditer(text)] if quoted_spans else []
    plain = quoted = misspelled = 0.0
    span = 0
    for i in hits:
        exact, fuzzy = matcher[words[i]]
        window = words[max(0, i - CONTEXT) : i + CONTEXT + 1]
        reported = not REPORTING.isdisjoint(window)
        if quoted_spans:
            while span < len(quoted_spans) - 1 and quoted_spans[span][1] <= places[i]:
                span += 1
            reported |= quoted_spans[span][0] < places[i] < quoted_spans[span][1]
        if reported:
            quoted += exact + fuzzy
        else:
            plain += exact
            misspelled += fuzzy
    distinct = len({words[i] for i in hits})
    return [np.log1p(plain), np.log1p(quoted), np.log1p(misspelled), np.log1p(distinct), 10 * len(hits) / len(words)]


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 0.1)
    ridge[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _terms(rows: DataFrame) -> DataFrame:
    """term, toxic and clean: in how many documents of `rows` (text, toxic) each term occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts: dict[str, list[int]]) -> pa.RecordBatch:
            columns = [list(counts), [c[1] for c in counts.values()], [c[0] for c in counts.values()]]
            kinds = (pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["term", "toxic", "clean"]
            )

        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(WORD.findall(text.lower()))
                found = {w[:n] for w in words for n in BEGINNINGS if n < len(w)}
                found.update(w + "$" for w in words if len(w) >= BEGINNINGS[0])
                for term in found:
                    counts.setdefault(term, [0, 0])[toxic] += 1
                if len(counts) > 500_000:
                    yield out(counts)
                    counts = {}
        yield out(counts)

    counted = rows.select("text", "toxic").mapInArrow(giving_back(run), "term string, toxic bigint, clean bigint")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _featured(rows: DataFrame, terms: dict[str, float], carried: list[str]) -> DataFrame:
    """`carried` columns and f (the features) of rows whose last column is the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in row_batches(batches):
            found = [features(t, matcher) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "f"])

    shape = rows.select(*carried).schema.add("f", ArrayType(DoubleType()))
    return rows.select(*carried, "text").mapInArrow(giving_back(run), shape)


def learn(docs: DataFrame, labels: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS) -> tuple[dict, list]:
    """Lexicon and weights from rows with `training` and a label; both empty unless there are rows of either label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    part = min(1.0, sample_rows / max(1, known.count()))
    place = F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1_000_003)) / 1_000_003
    # About sample_rows rows of 12 bytes.
    sample = F.broadcast(known.where(place < part))
    rows = docs.where(training).select(F.col("doc_id").cast("long").alias("_id"), text_of().alias("text"))
    rows = rows.join(sample, "_id").withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "_id"), F.lit(2)))
    first, second = rows.where("half = 0"), rows.where("half = 1")
    n = {r["toxic"]: r["count"] for r in first.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}, []
    ratio = (F.col("toxic") + 0.5) / (n[1] + 1) / ((F.col("clean") + 0.5) / (n[0] + 1))
    terms = _terms(first).where((F.col("toxic") >= LEAST_DOCUMENTS) & (ratio >= LEAST_RATIO))
    terms = terms.select("term", F.log(ratio).alias("weight"), "toxic")
    best = terms.orderBy(F.desc(F.col("weight") * F.col("toxic")), "term").limit(LEXICON_TERMS).collect()
    lexicon = {r["term"]: r["weight"] for r in best}
    table = _featured(second, lexicon, ["toxic"]).toArrow()
    y = table.column("toxic").to_numpy()
    if len(set(y.tolist())) < 2:
        return {}, []
    x = np.array(table.column("f").to_pylist())
    return lexicon, _fit(x, y).tolist()


def score_toxicity(docs: DataFrame, labels: DataFrame, training: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc (all columns of the row), training and score (0 to 1) of every row.

    Only rows with `training` and a label (labels: doc_id, toxic) are learned from; of several labels of a
    doc_id the toxic one counts, null ids and labels don't. Without toxic or without clean rows to
    learn from, every score is 0. A null or empty text has no hits. Columns of any name are carried in `doc`.
    """
    lexicon, weights = learn(docs, labels, training, sample_rows)
    rows = docs.select(F.struct("*").alias("doc"), training.alias("training"), text_of().alias("text"))
    if not weights:
        return rows.select("doc", "training", F.lit(0.0).alias("score"))
    found = _featured(rows, lexicon, ["doc", "training"])
    total = sum((F.col("f")[i] * F.lit(w) for i, w in enumerate(weights[:-1])), F.lit(weights[-1]))
    return found.select("doc", "training", (1 / (1 + F.exp(-total))).alias("score"))
