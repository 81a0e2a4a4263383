"""Quality rules: a threshold table compiled into one projection.

Everything is a Spark expression over the whole text: words, symbols, stop
words, repeated lines, repeated 8-word windows.  Windows are compared by 64-bit
hash within one text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Common words of the supported languages.
STOP_WORDS = (
    # English
    "the be to of and that have with for was from this are they his her which were not you by at on in is it as an or".split()
    # French
    + "le la les des du une et est que qui dans pour pas sur avec au aux ne se ce il elle par".split()
    # German
    + "der die das und den von zu mit sich auf für ist im dem nicht ein eine auch es werden".split()
    # Spanish
    + "el los las una y en con por para su al lo como más pero sus no se del de".split())


@dataclass(frozen=True)
class Rule:
    """Keep a text if ``metric`` is within [low, high]; texts of fewer than ``from_words`` words pass."""
    name: str
    metric: str  # SQL over the counts below
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: The threshold table.  Counts: n_words, word_chars, n_symbols, n_bangs, n_stop, n_upper, n_echo, n_lines, n_dup_lines.
RULES = (
    Rule("word_length", "word_chars / n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols / n_words", high=0.2),
    Rule("exclamations", "n_bangs / n_words", high=0.3),
    Rule("stop_words", "n_stop", low=2, from_words=100),
    Rule("upper_words", "n_upper / n_words", high=0.6),
    Rule("echoed_words", "n_echo / n_words", high=0.2),
    Rule("repeated_lines", "n_dup_lines / n_lines", high=0.5),
)
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once a row, however often and deep the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, test)).cast("long")


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """Words that lie in an n-word window found at least twice in the text (first finds included)."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def spread(s: Column) -> Column:
            same = F.transform(s, lambda e, k: F.struct(
                e["i"].alias("i"),
                (F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
                 | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))).alias("twice")))
            starts = F.sort_array(F.transform(F.filter(same, lambda e: e["twice"]), lambda e: e["i"]))
            return let(starts, lambda p: F.aggregate(
                F.transform(p, lambda at, k: F.least(F.lit(n), F.coalesce(F.get(p, k + 1) - at, F.lit(n)))),
                F.lit(0).cast("long"), lambda total, x: total + x))

        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, let(placed, spread)).otherwise(F.lit(0).cast("long"))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(F.size(words) >= n, let(windows, covered)).otherwise(F.lit(0).cast("long"))


def counts(text: Column) -> Column:
    """Struct of the counts of a text (null: of the empty one)."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))

    def of(s: Column) -> Column:
        w, line = s["words"], s["lines"]
        lower = F.transform(w, F.lower)
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda total, x: total + F.length(x)).alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.length(text) - F.length(F.translate(text, "!", ""))).cast("long").alias("n_bangs"),
            let(lower, lambda low: F.struct(
                _count(low, lambda x: x.isin(*STOP_WORDS)).alias("n_stop"),
                _count(F.zip_with(low, w, lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
                       lambda p: (p["x"] != p["y"]) & (F.upper(p["y"]) == p["y"])).alias("n_upper"))).alias("case"),
            _count(F.zip_with(F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), w, lambda x, y: x == y),
                   lambda same: F.coalesce(same, F.lit(False))).alias("n_echo"),
            F.size(line).cast("long").alias("n_lines"),
            (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"))

    return let(F.struct(words.alias("words"), lines.alias("lines")), of)


def verdict(c: str) -> dict[str, Column]:
    """base_failed, failed (names of the rules that a text breaks) and kept, from the struct column ``c`` of counts."""
    names = ("n_words", "word_chars", "n_symbols", "n_bangs", "n_echo", "n_lines", "n_dup_lines", "n_repeat_words")
    field = {n: f"{c}.{n}" for n in names} | {n: f"{c}.case.{n}" for n in ("n_stop", "n_upper")}
    base = F.expr(f"{field['n_words']} < {MIN_WORDS} or 100 * {field['n_repeat_words']} > "
                  f"{MAX_REPEAT_PERCENT} * {field['n_words']}")
    broken = []
    for r in RULES:
        part, _, of = r.metric.partition(" / ")
        metric = field[part] + (f" / nullif({field[of]}, 0)" if of else "")
        tests = [f"{metric} < {r.low}"] * (r.low is not None) + [f"{metric} > {r.high}"] * (r.high is not None)
        test = F.expr(f"{field['n_words']} >= {max(1, r.from_words)} and ({' or '.join(tests)})")
        broken.append(F.when(test, F.lit(r.name)))
    failed = F.concat_ws(",", *broken)
    return {"base_failed": base, "failed": failed, "kept": ~base & (failed == "")}


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, failed, kept.

    Null texts have no words and fail.  Rows are independent; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), counts(F.col(text)).alias("c"))
    return rows.select("doc_id", *[f"c.{n}" for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                       *[v.alias(k) for k, v in verdict("c").items()])


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, all columns as they were."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), counts(F.col(text)).alias("c"))
    return whole.where(verdict("c")["kept"]).select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def oracle_sql() -> str:
    """DuckDB SQL for the rows of ``score`` over ``documents``."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    rules = []
    for r in RULES:
        tests = [f"{r.metric} < {r.low}"] * (r.low is not None) + [f"{r.metric} > {r.high}"] * (r.high is not None)
        rules.append(f"CASE WHEN n_words >= {max(1, r.from_words)} AND ({' OR '.join(tests)}) THEN '{r.name}' END")
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY r),
c AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS n_bangs,
         len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop,
         len(list_filter(w, lambda x: lower(x) <> x AND upper(x) = x)) AS n_upper,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echo,
         len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov USING (r)),
v AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         concat_ws(',', {', '.join(rules)}) AS failed
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed,
       NOT base_failed AND failed = '' AS kept
FROM v"""
