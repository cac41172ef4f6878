"""Quality rules as a short-circuit cascade, ordered by what each rule rejects for its cost. Built-in functions only.

A rule is a condition over metrics of a text. ``cascade`` puts conditions into one CASE: a row leaves at its first hit, so
later rules are not evaluated for it. ``plan`` orders the rules: on a bounded sample it measures which rows each rejects and what
it costs, as the time that many evaluations of the very expression add to a job that evaluates none; then it picks again
and again the rule that rejects most of the rows still left per second. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import GAP, let

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows of the sample that ``plan`` takes from the first partitions, and bytes of a text it may hold: what reaches the driver
#: is bounded by their product. The rules themselves read all texts, whole.
SAMPLE_ROWS, SAMPLE_BYTES = 256, 65_536
#: How often a rule is evaluated on each row of the sample to be timed, and the least cost in seconds: less is noise.
REPEATS, LEAST_COST = 4, 0.005

Metrics = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Metrics], Column]


def words(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def _repeated(w: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the same text."""
    def doubled(run, k):  # hashes of runs of 2k words from hashes of runs of k
        return let(run, lambda h: F.zip_with(h, F.slice(h, F.lit(k + 1), F.size(h)), lambda a, b: F.xxhash64(a, b)))

    def covered(windows):
        pairs = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = let(pairs, lambda s: F.transform(
            F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))
        return let(F.sort_array(again), lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda a, x: a + x))

    def over(windows):
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(covered(windows))

    run = F.transform(w, lambda x: F.xxhash64(x))
    for k in (1, 2, 4):
        run = doubled(run, k)
    return F.when(F.size(w) < WINDOW, F.lit(0).cast("long")).otherwise(
        let(run, lambda h: let(F.slice(h, F.lit(1), F.size(h) - (WINDOW - 1)), over)))


def of_text(text: Column, split: Column | None = None) -> dict[str, Column]:
    """Every metric as an expression over a text and its words, if they are known; a null text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))
    w = words(text) if split is None else split
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": let(w, _repeated),
        "n_stutter": let(w, lambda w: F.size(F.filter(w, lambda x, i: x == F.get(w, i + 1))).cast("long")),
        "n_upper": F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"),
        "n_lower": F.length(F.regexp_replace(text, r"\P{Ll}+", "")).cast("long"),
    }


#: Texts below the base line: too short, or mostly repeated passages.
BASE = [
    Rule("short", lambda m: m("n_words") < 20),
    Rule("repeated", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
]
#: Thresholds are far from prose: more than one symbol to four words, most lines copied, three words in ten said twice in a
#: row, more capitals than small letters.
RULES = [
    Rule("symbols", lambda m: 100 * m("n_symbols") > 25 * m("n_words")),
    Rule("copied_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule("stutter", lambda m: 100 * m("n_stutter") > 30 * m("n_words")),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 25 * m("n_words"))),
    Rule("shouting", lambda m: m("n_upper") > m("n_lower")),
]


def plan(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, prepare: Callable[[DataFrame], DataFrame] | None = None,
         metrics: Metrics | None = None) -> list[Rule]:
    """``rules`` in the order of rejections per second on a sample of at most ``sample_rows`` texts of bounded size.

    ``prepare`` adds to the sample the columns that ``metrics`` reads, where rules are run over such columns: they are computed
    before the clock starts. Rules that cost next to nothing are ordered by rejections.
    """
    spark = docs.sparkSession
    short = F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_BYTES
    taken = docs.select("text").filter(short).limit(sample_rows).collect()  # reads only as many partitions as it needs
    if not taken:
        return list(rules)
    sample = spark.createDataFrame(taken, "text string")
    if prepare is not None:
        ready = prepare(sample)
        sample = spark.createDataFrame(ready.collect(), ready.schema)
    metrics = metrics or of_text(F.col("text")).__getitem__
    conditions = {r.name: F.coalesce(r.rejects(metrics), F.lit(False)) for r in rules}
    hits = sample.select([c.alias(n) for n, c in conditions.items()]).collect()
    many = sample.coalesce(1).withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def seconds(condition: Column) -> float:
        runs = []
        for _ in range(2):  # the first run compiles
            start = time.perf_counter()
            many.agg(F.count_if(condition)).collect()
            runs.append(time.perf_counter() - start)
        return min(runs)

    idle = seconds(F.col("_again") < 0)
    cost = {name: max(LEAST_COST, seconds(c) - idle) for name, c in conditions.items()}
    order, left, rest = [], hits, list(rules)
    while rest:
        best = max(rest, key=lambda r: (sum(h[r.name] for h in left) / cost[r.name], -cost[r.name]))
        order.append(best)
        rest.remove(best)
        left = [h for h in left if not h[best.name]]
    return order


def cascade(rules: list[Rule], metrics: Metrics) -> Column:
    """Name of the first rule that rejects, null when none does; evaluated no further than needed."""
    out = None
    for r in rules:
        out = F.when(r.rejects(metrics), F.lit(r.name)) if out is None else out.when(r.rejects(metrics), F.lit(r.name))
    return F.lit(None).cast("string") if out is None else out


def keep_good(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, all columns as they are. A null text has no words and goes."""
    rules = BASE + RULES if rules is None else rules
    text = F.coalesce(F.col("text"), F.lit(""))
    order = plan(docs, rules, prepare=lambda sample: sample.withColumn("w", words(text)), metrics=of_text(text, F.col("w")).__getitem__)
    # Words are split once; the rules that come to be evaluated share them.
    return docs.filter(let(words(text), lambda w: cascade(order, of_text(text, w).__getitem__)).isNull())


def report(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): the metrics, base_failed and kept.

    A null or empty text has no words: all counts are 0, base_failed is true. Repeated rows each get a row, other columns
    are ignored, an empty table gives an empty result.
    """
    rules = RULES if rules is None else rules
    text = F.coalesce(F.col("text"), F.lit(""))
    metrics = of_text(F.col("text"))
    of_words = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).alias("n_repeat_words")))
    names = ("n_words", "n_repeat_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                             (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))

    def with_metrics(rows, *kept):
        return (rows.select(*kept, "text", of_words.alias("w"), of_lines.alias("l"), metrics["word_chars"].alias("word_chars"),
                            metrics["n_symbols"].alias("n_symbols"))
                .select(*kept, "text", "w.*", "l.*", "word_chars", "n_symbols"))

    measured = with_metrics(docs, "doc_id")

    def known(name):
        return F.col(name) if name in names else metrics[name]

    failed = F.lit(False)
    for r in BASE:
        failed = failed | r.rejects(known)
    verdict = cascade(plan(docs, rules, prepare=with_metrics, metrics=known), known).isNull()
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           failed.alias("base_failed"), F.when(failed, False).otherwise(verdict).alias("kept"))


#: DuckDB SQL for ``report`` with the default rules.
SQL = r"""
with base as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l,
         row_number() over () as r
  from documents),
grams as (
  select r, i, array_to_string(w[i:i + 7], ' ') as g
  from (select r, w, unnest(range(1, len(w) - 6)) as i from base where len(w) >= 8)),
marked as (select r, i, count(*) over (partition by r, g) as c from grams),
covered as (
  select r, sum(least(8, coalesce(n - i, 8)))::bigint as n_repeat_words
  from (select r, i, lead(i) over (partition by r order by i) as n from marked where c > 1) group by r),
measured as (
  select doc_id, text, w, len(w) as n_words, len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols, len(l) as n_lines,
         len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from base left join covered using (r)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 100 * n_symbols > 25 * n_words or 2 * n_dup_lines > n_lines
            or 100 * len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) > 30 * n_words or word_chars < 2 * n_words or word_chars > 25 * n_words
            or len(regexp_replace(text, '\P{Lu}+', '', 'g')) > len(regexp_replace(text, '\P{Ll}+', '', 'g'))) as kept
from judged
"""
