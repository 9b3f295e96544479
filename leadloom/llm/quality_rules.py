"""Weak supervision of quality, by built-in expressions alone.

Six rules look at the statistics of a text and vote good (1), bad (-1) or abstain (0). Expectation-maximisation over the
counted vote patterns (at most 3**6 rows, whatever the input) estimates how often each rule is right on good and on bad
texts, and how common good texts are; the posterior probability of a pattern replaces all-must-pass filtering.

Statistics of null texts are those of an empty one; every input row gives one row, null and repeated ids too; further
columns are not read. Of an empty table there is nothing to learn and nothing to return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import keep

ROUNDS, START_GOOD, START_BAD, LOWEST, HIGHEST = 20, 0.9, 0.6, 0.01, 0.999
#: name -> (bad if, good if) over the statistics; neither: the rule abstains
RULES = {
    "length": ("n_words < 50", "n_words >= 80"),
    "symbols": ("10 * n_symbols >= n_words", "100 * n_symbols <= n_words"),
    "repeats": ("100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    "lines": ("n_dup_lines >= 3 AND 10 * n_dup_lines >= 3 * n_lines", "n_dup_lines = 0"),
    "variety": ("10 * n_distinct < 2 * n_words", "10 * n_distinct >= 3 * n_words"),
    "word_size": ("word_chars < 2 * n_words OR word_chars > 12 * n_words", "word_chars BETWEEN 3 * n_words AND 9 * n_words"),
}
VOTES = [f"vote_{r}" for r in RULES]


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and counts of words, characters in words, symbols, lines, repeated lines and repeated words."""
    space = " \t\n\x0b\x0c\r"
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.filter(F.split(whole, "[ \t-\r]+"), lambda w: w != "").alias("words"),
        F.filter(F.split(whole, "\n"), lambda l: F.trim(l, F.lit(space)) != "").alias("lines"),
        (F.length(whole) - F.length(F.regexp_replace(whole, "[#*$%&|<>]+", ""))).alias("n_symbols"),
        F.length(F.regexp_replace(whole, "[ \t-\r]+", "")).alias("word_chars"))
    hashed = split.select(
        "doc_id", "n_symbols", "word_chars", F.size("words").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    width = F.greatest(F.size("h") - 2, F.lit(0))
    triples = hashed.withColumn("h", F.arrays_zip(*[F.slice("h", k, width).alias(f"w{k}") for k in (1, 2, 3)]))
    placed = triples.withColumn("h", F.sort_array(F.transform(
        "h", lambda t, i: F.struct(F.xxhash64(t["w1"], t["w2"], t["w3"]).alias("hash"), i.alias("at")))))
    steps = F.greatest(F.size("h") - 1, F.lit(0))
    none = F.array().cast("array<int>")
    twice = placed.withColumn("h", F.flatten(F.zip_with(
        F.slice("h", 1, steps), F.slice("h", 2, steps),
        lambda a, b: F.when(a["hash"] == b["hash"], F.array(a["at"], b["at"])).otherwise(none))))
    covered = F.array_distinct(F.flatten(F.transform("h", lambda p: F.array(p, p + 1, p + 2))))
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_distinct"]
    return twice.select("doc_id", *[F.col(c).cast("long").alias(c) for c in numbers], F.size(covered).cast("long").alias("n_repeat_words"))


def vote(bad: str, good: str) -> str:
    return f"CAST(CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS INT)"


def posteriors(voted: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per vote pattern: the votes, ``posterior``, and the estimates ``prior`` and ``accuracy``."""
    patterns = (voted.groupBy(*VOTES).agg(F.count("*").cast("double").alias("n"))
                .select(F.array(*VOTES).alias("v"), "n").agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("p")))
    clip = f"greatest({LOWEST}D, least({HIGHEST}D, {{}}))"
    q = ("1D / (1D + exp(-(ln(s.prior / (1D - s.prior)) + aggregate(zip_with(x.v, s.acc, (v, a) -> CASE v "
         "WHEN 1 THEN ln(a.good / (1D - a.bad)) WHEN -1 THEN ln((1D - a.good) / a.bad) ELSE 0D END), 0D, (t, w) -> t + w))))")
    weighed = f"transform(p, x -> named_struct('v', x.v, 'n', x.n, 'q', {q}))"
    right = ("aggregate(z, 0D, (t, x) -> t + CASE x.v[i] WHEN {0} THEN x.n * {1} ELSE 0D END) / "
             "aggregate(z, 0D, (t, x) -> t + CASE x.v[i] WHEN 0 THEN 0D ELSE x.n * {1} END)")
    good, bad = clip.format(right.format(1, "x.q")), clip.format(right.format(-1, "(1D - x.q)"))
    prior = "aggregate(z, 0D, (t, x) -> t + x.n * x.q) / aggregate(z, 0D, (t, x) -> t + x.n)"
    update = (f"transform(array({weighed}), z -> named_struct('prior', {clip.format(prior)}, 'acc', "
              f"transform(sequence(0, {len(VOTES) - 1}), i -> named_struct('good', coalesce({good}, {START_GOOD}D), "
              f"'bad', coalesce({bad}, {START_BAD}D)))))[0]")
    start = f"named_struct('prior', 0.5D, 'acc', array_repeat(named_struct('good', {START_GOOD}D, 'bad', {START_BAD}D), {len(VOTES)}))"
    fitted = patterns.where("size(p) > 0").select("p", F.expr(f"aggregate(sequence(1, {rounds}), {start}, (s, k) -> {update})").alias("s"))
    rows = fitted.select("s", F.explode("p").alias("x"))
    return rows.select(*[F.col("x.v")[i].alias(v) for i, v in enumerate(VOTES)], F.expr(q).alias("posterior"),
                       F.col("s.prior").alias("prior"), F.col("s.acc").alias("accuracy"))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Statistics, votes, ``posterior`` and ``good`` (``posterior >= threshold``) of every document."""
    votes = {f"vote_{name}": F.expr(vote(*cases)) for name, cases in RULES.items()}
    voted = keep(statistics(docs, doc_id, text).withColumns(votes), "rule-votes")
    model = posteriors(voted).select(*VOTES, "posterior")
    joined = voted.join(F.broadcast(model), VOTES)  # at most 3**6 rows
    return joined.withColumn("good", F.col("posterior") >= threshold)


def oracle() -> str:
    """DuckDB SQL of query op1: the same statistics, and the same rounds unrolled."""
    w = [f"v{i}" for i in range(len(RULES))]
    votes = ", ".join(f"{vote(*c)} AS v{i}" for i, c in enumerate(RULES.values()))
    clip = f"greatest({LOWEST}, least({HIGHEST}, {{}}))"
    each = range(len(w))
    steps = ["par0 AS MATERIALIZED (SELECT 0.5::DOUBLE AS prior, "
             + ", ".join(f"{START_GOOD}::DOUBLE AS g{i}, {START_BAD}::DOUBLE AS b{i}" for i in each) + ")"]
    terms = " + ".join(f"CASE v{i} WHEN 1 THEN ln(g{i} / (1 - b{i})) WHEN -1 THEN ln((1 - g{i}) / b{i}) ELSE 0 END" for i in each)
    q = f"1 / (1 + exp(-(ln(prior / (1 - prior)) + {terms})))"
    share = "sum(CASE v{0} WHEN {1} THEN n * {2} ELSE 0 END) / nullif(sum(CASE v{0} WHEN 0 THEN 0 ELSE n * {2} END), 0)"
    for k in range(1, ROUNDS + 1):
        steps.append(f"post{k} AS MATERIALIZED (SELECT p.*, {q} AS q FROM pat p, par{k - 1})")
        accuracy = ", ".join(f"coalesce({clip.format(share.format(i, v, p))}, {start}) AS {name}{i}" for i in each
                             for v, p, start, name in ((1, "q", START_GOOD, "g"), (-1, "(1 - q)", START_BAD, "b")))
        steps.append(f"par{k} AS MATERIALIZED (SELECT {clip.format('sum(n * q) / sum(n)')} AS prior, {accuracy} FROM post{k})")
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
tri AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d),
rep AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM tri),
cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, (VALUES (0), (1), (2)) AS o(k) WHERE c > 1 GROUP BY doc_id),
st AS MATERIALIZED (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         len(list_distinct(w))::BIGINT AS n_distinct, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
vt AS MATERIALIZED (SELECT *, {votes} FROM st),
pat AS MATERIALIZED (SELECT {", ".join(w)}, count(*)::DOUBLE AS n FROM vt GROUP BY {", ".join(w)}),
{("," + chr(10)).join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {q} >= 0.5 AS kept
FROM vt, par{ROUNDS}"""
