"""Quality rules: a decision list learned by sequential covering.

Statistics of each text are counted in tasks. On a bounded sample of labelled texts, rules for poor
texts are grown one threshold at a time, pruned on rows held back, and kept only where nearly all
they cover there is poor; what a rule covers is set aside before the next is grown. The list becomes
one ordered Spark conditional over the statistics of every text.

A null or empty text has no words and all its statistics are 0. Labels that are null, and labels of
unknown texts, teach nothing; without labels of both kinds the list is empty and rejects nothing.
Rows that repeat are judged alike. Extra columns are kept by `good_documents`.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.llm.common import documents, per_text

# Labelled rows that the list is learned from, at most: those first by a hash of their id.
SAMPLE = 20_000
# A rule is kept if this share of what it covers among the rows held back is poor.
PRECISION, LEAST_COVERED, MOST_RULES, MOST_TERMS = 0.97, 10, 24, 4

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
    "n_capitals", "n_digits", "n_marks",
]


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur more than once."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times, covered, end = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


def counts_of(text: str | None) -> list[int]:
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip(b" \t\x0b\x0c\r")]
    among = lambda signs: len(data) - len(data.translate(None, signs))
    return [
        len(words),
        len(text) - among(b" \t\n\x0b\x0c\r"),
        among(b"#*$%&|<>"),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        among(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        among(b"0123456789"),
        among(b"!?"),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every whole text."""

    def rows_of(batches):
        for batch in batches:
            counts = [counts_of(text) for text in batch["text"]]
            columns = dict(zip(COUNTS, zip(*counts, strict=True), strict=True)) if counts else dict.fromkeys(COUNTS, ())
            yield {"doc_id": batch["doc_id"]} | columns

    schema = "doc_id bigint, " + ", ".join(f"{name} bigint" for name in COUNTS)
    return per_text(docs, ["doc_id", "text"], rows_of, schema)


def features(at: str = "") -> dict[str, Column]:
    """Shares that rules put thresholds on; 0 where there is nothing to share. The statistics are under `at`."""
    shares = {
        "words": ("n_words", None),
        "word_length": ("word_chars", "n_words"),
        "symbols": ("n_symbols", "word_chars"),
        "same_lines": ("n_dup_lines", "n_lines"),
        "repeats": ("n_repeat_words", "n_words"),
        "line_words": ("n_words", "n_lines"),
        "distinct": ("n_distinct", "n_words"),
        "capitals": ("n_capitals", "word_chars"),
        "digits": ("n_digits", "word_chars"),
        "marks": ("n_marks", "n_words"),
    }
    return {
        name: F.col(at + top).cast("double")
        if below is None
        else F.when(F.col(at + below) > 0, F.col(at + top) / F.col(at + below)).otherwise(F.lit(0.0))
        for name, (top, below) in shares.items()
    }


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool
    limit: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        return values >= self.limit if self.above else values <= self.limit

    def column(self, at: str) -> Column:
        value = features(at)[self.feature]
        return value >= self.limit if self.above else value <= self.limit


Conjunction = tuple[Term, ...]


def _holds(rule: Conjunction, table: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, bool)
    for term in rule:
        out &= term.holds(table)
    return out


def _best_term(table: dict[str, np.ndarray], poor: np.ndarray, inside: np.ndarray) -> Term | None:
    """The threshold with the most information gained about the poor rows inside."""
    p, n = (poor & inside).sum(), (~poor & inside).sum()
    best, most = None, 1e-9
    for name, values in table.items():
        cuts = np.unique(np.quantile(values[inside & poor], np.linspace(0, 1, 41)))
        for above in (True, False):
            hits = values[inside, None] >= cuts if above else values[inside, None] <= cuts
            cp, cn = hits[poor[inside]].sum(0), hits[~poor[inside]].sum(0)
            gain = cp * (np.log2((cp + 1e-9) / (cp + cn + 1e-9)) - np.log2(p / (p + n)))
            at = int(np.argmax(gain))
            if gain[at] > most:
                best, most = Term(name, above, float(cuts[at])), gain[at]
    return best


def _pruned(rule: Conjunction, table: dict[str, np.ndarray], poor: np.ndarray) -> Conjunction:
    """The shortest beginning of the rule that does best on the rows held back."""

    def worth(length: int) -> float:
        covered = _holds(rule[:length], table, len(poor))
        p, n = (poor & covered).sum(), (~poor & covered).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda length: (worth(length), -length))]


def learned(table: dict[str, np.ndarray], poor: np.ndarray, held_back: np.ndarray) -> list[Conjunction]:
    """Ordered rules for poor rows."""
    grow = {name: values[~held_back] for name, values in table.items()}
    test = {name: values[held_back] for name, values in table.items()}
    grow_poor, test_poor = poor[~held_back], poor[held_back]
    grow_left, test_left = np.ones(len(grow_poor), bool), np.ones(len(test_poor), bool)
    rules: list[Conjunction] = []
    while len(rules) < MOST_RULES and (grow_poor & grow_left).any():
        rule: Conjunction = ()
        inside = grow_left.copy()
        while len(rule) < MOST_TERMS and (~grow_poor & inside).any():
            term = _best_term(grow, grow_poor, inside)
            if term is None:
                break
            rule, inside = (*rule, term), inside & term.holds(grow)
        if not rule:
            break
        rule = _pruned(rule, {name: v[test_left] for name, v in test.items()}, test_poor[test_left])
        covered = _holds(rule, test, len(test_poor)) & test_left
        if covered.sum() < LEAST_COVERED or (test_poor & covered).sum() < PRECISION * covered.sum():
            break
        rules.append(rule)
        grow_left &= ~_holds(rule, grow, len(grow_poor))
        test_left &= ~covered
    return rules


def accepts(rules: list[Conjunction], at: str = "") -> Column:
    """False where the first rule that holds rejects a text, else true."""
    out = None
    for rule in rules:
        holds = F.lit(True)
        for term in rule:
            holds = holds & term.column(at)
        out = F.when(holds, False) if out is None else out.when(holds, False)
    return F.lit(True) if out is None else out.otherwise(True)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Conjunction]:
    """Rules from at most `sample` labelled rows, of which a third is held back for pruning."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    rows = (
        statistics(texts)
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "quality", *[column.alias(name) for name, column in features().items()])
        .toPandas()
        .sort_values("doc_id")
    )
    if rows.empty:
        return []
    poor = rows["quality"].to_numpy() == 0
    held_back = (rows["doc_id"].to_numpy() * 2654435761 >> 7) % 3 == 0
    if not (poor & ~held_back).any() or poor.all():
        return []
    return learned({name: rows[name].to_numpy(float) for name in features()}, poor, held_back)


def base_failed(at: str = "") -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    words = F.col(f"{at}n_words")
    return (words < 50) | (100 * F.col(f"{at}n_repeat_words") > 50 * words)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of every text with `base_failed` and `kept`."""
    rules = learn(docs, labels)
    return statistics(docs).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & accepts(rules)
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they are."""
    rules = learn(docs, labels)
    names = docs.columns

    def rows_of(batches):
        for batch in batches:
            yield batch | {"_counts": [dict(zip(COUNTS, counts_of(t), strict=True)) for t in batch["text"]]}

    kinds = ",".join(f"{name}:bigint" for name in COUNTS)
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in docs.schema] + [f"_counts struct<{kinds}>"])
    counted = per_text(docs, names, rows_of, schema)
    return counted.filter(~base_failed("_counts.") & accepts(rules, "_counts.")).select(*names)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
