"""Quality rules kept as a ledger of bits.

Every rule is evaluated once per document; the ledger row holds the
measurements and one bit per failed rule.  A policy is a versioned choice of
rules, so applying one, or asking what a rule costs, reads the ledger only.

All work is done inside the row with array functions: nothing is shuffled but
the few counts of :func:`ablation`.

Defined results: a null text has no words, symbols or lines.  Null ids and
repeated rows each keep their own ledger row; an empty table gives an empty
ledger.  Extra columns never clash, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import packed, text_or_empty, unpacked, words_array

SYMBOLS = "#*$%&|<>"
WINDOW = 3


def _failures() -> dict[str, Column]:
    """Rule name to failure test over the measurements; a rule's place is its bit."""
    words, lines = F.col("n_words"), F.col("n_lines")
    return {
        "too_few_words": words < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * words,
        "symbols": 10 * F.col("n_symbols") > words,
        "repeated_lines": 2 * F.col("n_dup_lines") > lines,
        "short_words": F.col("word_chars") < 2 * words,
        "long_words": F.col("word_chars") > 15 * words,
    }


RULES = ("too_few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Policy:
    """A named version of the rules in force."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(rule) for rule in self.rules)


BASE = Policy("base-1", ("too_few_words", "repeated_words"))
FULL = Policy("full-1", RULES)


def _with_measures(rows: DataFrame) -> DataFrame:
    """Adds the measurements to rows with a non-null ``_text``.

    Steps are separate projections whose results are used more than once each,
    which is what keeps Spark from inlining an array into a lambda body.
    """
    text = F.col("_text")
    plain = text
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    rows = rows.withColumns(
        {
            "_words": words_array(text),
            "_lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            "n_symbols": (F.length(text) - F.length(plain)).cast("long"),
        }
    )
    words = F.col("_words")
    size = F.size(words)
    rows = rows.withColumns(
        {
            "n_words": size.cast("long"),
            "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda total, word: total + F.length(word)),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(
                size >= WINDOW,
                F.sort_array(
                    F.transform(
                        F.sequence(F.lit(0), size - WINDOW),
                        lambda i: F.struct(
                            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("hash"),
                            i.alias("at"),
                        ),
                    )
                ),
            ).otherwise(F.array().cast("array<struct<hash:bigint,at:int>>")),
        }
    )
    windows = F.col("_windows")
    repeated = F.filter(
        F.transform(
            windows,
            lambda window, i: F.when(
                (window["hash"] == F.get(windows, i + 1)["hash"])
                | ((i > 0) & (window["hash"] == F.get(windows, F.greatest(i - 1, F.lit(0)))["hash"])),
                window["at"],
            ),
        ),
        lambda at: at.isNotNull(),
    )
    rows = rows.withColumn("_starts", F.sort_array(repeated))
    starts = F.col("_starts")
    covered = F.aggregate(
        F.zip_with(
            starts,
            F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
            lambda start, following: F.least(F.coalesce(following - start, F.lit(WINDOW)), F.lit(WINDOW)),
        ),
        F.lit(0).cast("long"),
        lambda total, words_covered: total + words_covered,
    )
    # Always true, and no filter is pushed below it: one on the bits would put the whole arrays into lambda bodies.
    covered = F.when(F.monotonically_increasing_id() >= 0, covered)
    return rows.withColumn("n_repeat_words", covered).drop("_words", "_lines", "_windows", "_starts", "_text")


def _with_bits(rows: DataFrame) -> DataFrame:
    failures = _failures()
    bits = F.lit(0).cast("long")
    for place, rule in enumerate(RULES):
        bits = bits + F.when(failures[rule], F.lit(1 << place)).otherwise(F.lit(0)).cast("long")
    return _with_measures(rows).withColumn("failed_bits", bits)


def ledger(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its id, the measurements and ``failed_bits``."""
    return _with_bits(docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("_text")))


def passes(policy: Policy, bits: Column | None = None) -> Column:
    """Whether a ledger row passes the policy."""
    bits = F.col("failed_bits") if bits is None else bits
    return bits.bitwiseAND(F.lit(policy.mask)) == 0


def keep_passing(docs: DataFrame, policy: Policy = FULL, text: str = "text") -> DataFrame:
    """Documents that pass, with all their columns."""
    rows = _with_bits(packed(docs, text_or_empty(text).alias("_text")))
    return unpacked(rows.filter(passes(policy)))


def ablation(entries: DataFrame, policy: Policy = FULL) -> DataFrame:
    """What each rule of a policy costs: documents that fail it, that fail it alone, and all that fail.

    The ledger collapses to one count per combination of bits, at most
    ``2 ** len(RULES)`` rows, before rules are looked at.
    """
    combinations = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).alias("bit")) for r in policy.rules])
    return (
        combinations.select("bits", "n", F.inline(rules))
        .groupBy("rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("n_rejected"),
            F.lit(policy.version).alias("policy"),
        )
    )


def quality_report(docs: DataFrame, policy: Policy = FULL) -> DataFrame:
    """Ledger with the verdicts of the base rules and of ``policy``."""
    return ledger(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
        "failed_bits",
        (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(policy)).alias("kept"),
    )


#: The same in DuckDB SQL, from a relation {docs}; used by the query and by the pipeline.
LEDGER_SQL = r"""
  SELECT d.*, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
     + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
     + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
     + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed_bits
  FROM (SELECT *, row_number() OVER () AS _row FROM {docs}) d
  JOIN (
    SELECT _row, len(w)::BIGINT AS n_words,
      coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines
    FROM (
      SELECT _row, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
      FROM (SELECT row_number() OVER () AS _row, coalesce(text, '') AS t FROM {docs})
    )
  ) m USING (_row)
  JOIN (
    SELECT _row, (count(DISTINCT i) FILTER (WHERE i >= 0))::BIGINT AS n_repeat_words
    FROM (
      SELECT _row, unnest(CASE WHEN seen > 1 THEN [i, i + 1, i + 2] ELSE [-1] END) AS i
      FROM (
        SELECT _row, i, count(*) OVER (PARTITION BY _row, w[i], w[i + 1], w[i + 2]) AS seen
        FROM (
          SELECT _row, w, unnest(CASE WHEN len(w) >= 3 THEN range(1, len(w) - 1) ELSE [-9] END) AS i
          FROM (SELECT row_number() OVER () AS _row, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {docs})
        )
      )
    ) GROUP BY _row
  ) r USING (_row)
"""

QUERY_SQL = (
    "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, failed_bits, "
    "failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept FROM (" + LEDGER_SQL.format(docs="documents") + ")"
)
