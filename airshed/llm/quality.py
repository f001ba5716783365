"""Quality rules: base rules and gradient-boosted trees over document statistics.

Every text is reduced to counts (whole text, in one pass); two base rules reject on counts alone,
the trees judge the rest.  They learn the ``quality`` label from at most ``TRAIN_ROWS`` labelled
documents (those with the smallest hash of their id), held as a table of statistics; scoring uses
flat node arrays.  More symbols, repeated lines, repeated windows or shouting never raise a score:
these features are constrained to be monotonic.

Nulls and edges: a null or empty text has no words and fails the base rule; rows are judged one by
one, so repeated rows and ties get equal verdicts; a null quality is no label, several labels of one
document count as their mean; without labels of both kinds the trees keep all; extra columns pass
through ``keep_good`` unchanged.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm import boosting
from airshed.llm.common import ship_by_value, stored, table, unused

ship_by_value(__name__)

TRAIN_ROWS = 20_000      # bound of the labelled sample
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
THRESHOLD = 0.5
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
UPPER, LOWER, DIGITS = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
MARKS = b"!?.,;:-_'\"()[]{}/\\=+@^~`"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Feature and constraint: -1, more of it never makes a text better.
FEATURES = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1,
            "mark_share": 0, "digit_share": 0, "chars_per_word": 0, "distinct_share": 0, "top_word_share": -1,
            "one_char_share": 0, "letterless_share": -1, "log_words": 0, "words_per_line": 0, "exclaim_share": -1}
CONSTRAINTS = np.array(list(FEATURES.values()))
STATS = ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in FEATURES)
LETTERLESS = re.compile(rb"[^A-Za-z\x80-\xff]+")


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur at least twice in the text."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    hit = np.zeros(len(words) + 1, np.int64)
    starts = np.array([i for i, w in enumerate(windows) if times[w] > 1])
    np.add.at(hit, starts, 1)
    np.add.at(hit, starts + size, -1)
    return int((hit.cumsum()[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """(lines equal to an earlier line, lines), of lines with a word."""
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines)), len(lines)


def statistics(text: bytes) -> tuple:
    """The counts and features of one text."""
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS) + (0.0,) * len(FEATURES)
    without = lambda chars: len(text) - len(text.translate(None, chars))
    spaces, symbols = without(SPACE), without(SYMBOLS)
    code_points = len(text.decode("utf-8", "replace")) - spaces
    dups, lines = duplicate_lines(text)
    repeats = repeated_words(words)
    times = Counter(words)
    upper, lower = without(UPPER), without(LOWER)
    inner = len(text) - spaces
    return (n, code_points, symbols, dups, repeats,
            symbols / n, dups / lines, repeats / n, upper / max(upper + lower, 1), without(MARKS) / inner,
            without(DIGITS) / inner, code_points / n, len(times) / n, max(times.values()) / n,
            sum(c for w, c in times.items() if len(w) == 1) / n,
            sum(c for w, c in times.items() if LETTERLESS.fullmatch(w)) / n,
            float(np.log1p(n)), n / lines, text.count(b"!") / n)


def stats_table(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics(t or b"") for t in texts], columns=COUNTS + list(FEATURES))


def stats_of(text_col: str) -> Column:
    """A struct of the counts and features of a text column."""
    @F.pandas_udf(STATS)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from map(stats_table, texts)

    return run(F.col(text_col).cast("binary"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS) -> boosting.Trees:
    """Trees fitted on the labelled documents with the ``rows`` smallest hashes of their id."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.avg(label_col).alias("_y"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    found = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t")) \
        .join(F.broadcast(sample), "_id")
    stats = stored(found.select("_id", "_y", stats_of("_t").alias("s")).select("_id", "_y", "s.*"), "quality-sample")
    # a document may be repeated in the table; the bound holds for what comes to the driver too
    pdf = stats.dropDuplicates(["_id"]).orderBy("_id").limit(rows).toPandas()
    return boosting.fit(pdf[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)),
                        (pdf["_y"].to_numpy(float) >= 0.5).astype(float), CONSTRAINTS)


def judged(docs: DataFrame, model: boosting.Trees, text_col: str = "text", threshold: float = THRESHOLD,
           verdict_col: str = "_verdict") -> DataFrame:
    """``docs`` with a struct column ``verdict_col``: the counts, base_failed, score and kept."""
    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            rows = stats_table(s)
            failed = (rows["n_words"] < MIN_WORDS) | (100 * rows["n_repeat_words"] > MAX_REPEAT_PERCENT * rows["n_words"])
            score = model.score(rows[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)))
            yield rows[COUNTS].assign(base_failed=failed, score=score, kept=~failed & (score >= threshold))

    return docs.withColumn(verdict_col, judge(F.col(text_col).cast("binary")))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the trees; columns as given."""
    verdict, = unused(docs, "_verdict")
    found = judged(docs, train(docs, labels, id_col, text_col), text_col, verdict_col=verdict)
    return found.filter(F.col(verdict)["kept"]).drop(verdict)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every row of ``documents``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels)
    return judged(docs.select("doc_id", "text"), model).select(
        "doc_id", *(F.col(f"_verdict.{c}") for c in COUNTS), "_verdict.base_failed", "_verdict.kept", "_verdict.score")


QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLE: dict[str, str] = {}
