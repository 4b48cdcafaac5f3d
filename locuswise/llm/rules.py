"""Quality rules: a decision list learned by sequential covering, applied as one ordered Spark expression.

Statistics of all texts are computed in tasks; the list is fitted on the driver from the statistics of a bounded sample of
labelled documents. A rule is a conjunction of thresholds. It is grown on two thirds of the sample by information gain,
pruned on the last third, and accepted only if it is precise there; what it covers is taken out before the next is grown.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.llm.common import BLANKS, whole_text

#: expected number of labelled documents in the fit
TRAIN_ROWS = 20_000
MAX_RULES, MAX_CONDITIONS, CUTS = 12, 4, 64
#: what a rule must reach on the pruning rows to be accepted
LEAST_PRECISION, LEAST_COVER = 0.9, 5

# The symbols that count.
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_digits")

#: features by name, as SQL over the counts; learned rules read these names only
FEATURES = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(word_chars, 1)",
    "digit_rate": "n_digits / greatest(word_chars, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
    "distinct_rate": "n_distinct / greatest(n_words, 1)",
}


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words in a window of three that occurs twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    a = ids.astype(np.int64)
    key = a[:-2] * distinct + a[1:-1]
    if distinct > 2_000_000:  # three numbers would not fit 64 bits
        key = np.unique(key, return_inverse=True)[1].astype(np.int64)
    key = key * distinct + a[2:]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def text_counts(text: str) -> tuple[int, ...]:
    """The values of COUNTS for one text."""
    words = text.encode("utf-8", "surrogatepass").split()  # of bytes, only ASCII white space divides
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
        repeated_words(ids, len(number)), len(number), sum(map(text.count, "0123456789")),
    )


def statistics(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and COUNTS, one row per input row; null counts as empty."""

    def run(batches):
        for b in batches:
            rows = [text_counts(x.as_py()) for x in b.column("text")]
            cols = zip(*rows, strict=True) if rows else [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols)], names=["doc_id", *COUNTS])

    slim = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, " + ", ".join(f"{c} bigint" for c in COUNTS))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def of(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.cut if self.above else x[self.feature] < self.cut

    def sql(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.cut!r}D"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.of(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Adds the condition of most information gain until only bad rows are covered or nothing is gained."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
        if not p0 or not n0:
            break
        base, best, gain = np.log2(p0 / (p0 + n0)), None, 1e-9
        for name, values in x.items():
            v, y = values[inside], bad[inside]
            for cut in np.unique(np.quantile(v, np.linspace(0, 1, CUTS), method="nearest")).tolist():
                over = v >= cut
                for above in (True, False):
                    m = over if above else ~over
                    p = int(y[m].sum())
                    if p:
                        g = p * (np.log2(p / int(m.sum())) - base)
                        if g > gain:
                            best, gain = Condition(name, above, cut), g
        if best is None:
            break
        rule += (best,)
        inside &= best.of(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule with the best balance of bad over good rows."""
    best, worth = rule, -2.0
    for k in range(1, len(rule) + 1):
        m = _covers(rule[:k], x, len(bad))
        p, n = int((m & bad).sum()), int((m & ~bad).sum())
        w = (p - n) / (p + n) if p + n else -1.0
        if w > worth + 1e-12:
            best, worth = rule[:k], w
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray) -> list[Rule]:
    """Ordered rules for bad rows. ``fold`` marks the rows that prune."""
    left, rules = np.ones(len(bad), bool), []
    for _ in range(MAX_RULES):
        g, p = left & ~fold, left & fold
        if not (bad & g).any():
            break
        rule = _grow({k: v[g] for k, v in x.items()}, bad[g])
        if not rule:
            break
        px = {k: v[p] for k, v in x.items()}
        rule = _prune(rule, px, bad[p])
        m = _covers(rule, px, int(p.sum()))
        hit = int((m & bad[p]).sum())
        if hit < LEAST_COVER or hit < LEAST_PRECISION * int(m.sum()):
            break
        rules.append(rule)
        left &= ~_covers(rule, x, len(bad))
    return rules


def as_sql(rules: list[Rule]) -> str:
    """The list as an ordered conditional: the number of the first rule that fits (from 1), null if none does."""
    whens = " ".join(f"WHEN {' AND '.join(c.sql() for c in r)} THEN {i}" for i, r in enumerate(rules, 1))
    return f"CASE {whens} END" if rules else "CAST(NULL AS INT)"


def with_features(stats: DataFrame) -> DataFrame:
    return stats.withColumns({f"f_{k}": F.expr(v) for k, v in FEATURES.items()})


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> list[Rule]:
    """Learns from about ``rows`` labelled documents, chosen by a hash of the id. A document of several labels is bad if most are 0; null labels and ids are left out."""
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg((F.avg(label) < 0.5).alias("bad"))
    n = known.count()
    if not n:
        return []
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    # the sample is bounded by ``rows``, so it may be broadcast
    sample = known.filter(place < min(1.0, rows / n)).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0)
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id", "left_semi")
    seen = with_features(statistics(chosen)).join(F.broadcast(sample), "doc_id").select("doc_id", *(f"f_{k}" for k in FEATURES), "bad", "fold").toPandas()
    seen = seen.sort_values(list(seen.columns), ignore_index=True)
    return learn({f"f_{k}": seen[f"f_{k}"].to_numpy(float) for k in FEATURES}, seen.bad.to_numpy(bool), seen.fold.to_numpy(bool))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_verdicts(docs: DataFrame, rules: list[Rule], *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts, base_failed, rule, kept for each row; ``rule`` is the number of the learned rule that drops the row, else null.

    A null or empty text has zero counts and fails the base rules. Ties between rules go to the first of the list. Repeated
    rows are judged each; extra columns are not read; without labels, or where no rule is precise enough, only the base rules drop.
    """
    out = with_features(statistics(docs, doc_id=doc_id, text=text)).withColumns({"base_failed": base_failed(), "rule": F.expr(as_sql(rules)).cast("int")})
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).select("doc_id", *COUNTS, "base_failed", "rule", "kept")
