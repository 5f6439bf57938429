"""Quality rules under weak supervision, in DataFrame functions alone.

Rules vote that a document is good (1) or bad (-1) or abstain (0). Expectation-maximisation over the counts of
vote patterns (at most 3^rules rows, whatever the corpus) estimates how often each rule votes which way
on good and on bad documents, and the prior; each document gets the posterior probability of being good.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, texts_of, written

SPACE = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
LETTER = r"[\p{L}\p{N}]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rule: (measure, good from, good to, bad under, bad over). Between the two it abstains; so do rules without a measure. All can
#: vote bad on documents that pass the base checks, and one that is bad mostly shows it to several.
RULES = {
    "length": ("n_words", 100, 1e12, 60, 1e12),
    "word_length": ("word_chars / n_words", 3, 6.5, 2.5, 7.2),
    "symbols": ("n_symbols / n_words", -1, 0.02, -1, 0.1),
    "marks": ("n_marks / n_words", -1, 0.1, -1, 0.25),
    "repeats": ("n_repeat_words / n_words", -1, 0.15, -1, 0.3),
    "dup_lines": ("n_dup_lines / n_lines", -1, 0.1, -1, 0.3),
    "capitals": ("n_capitals / word_chars", -1, 0.12, -1, 0.3),
    "exclamations": ("n_exclaims / n_words", -1, 0.05, -1, 0.15),
}
#: First guesses of P(vote | good), P(vote | bad) for votes -1, 0, 1, the prior of good, and their weight as seen documents.
GUESS_GOOD, GUESS_BAD, GUESS_PRIOR, WEIGHT = (0.002, 0.048, 0.95), (0.2, 0.06, 0.74), 0.85, 20.0
#: A good document gets any one rule's bad vote at most this often: what is known of the rules, so that the two
#: classes can't come to mean something else (as short and long documents).
FALSE_ALARMS = 0.01
ROUNDS = 30
KEEP_FROM = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def let(value: Column, body) -> Column:
    """body(value), the value being computed once."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, signs: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, signs, ""))).cast("long")


def repeated_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more.

    Windows are compared by 64-bit hashes, sorted with their places; the places of windows with an equal
    neighbour, in order, each cover up to three words that the one before does not.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def places(ranked: Column) -> Column:
        def same(k: Column, other: Column) -> Column:
            return F.coalesce(F.get(ranked, k)["h"] == F.get(ranked, other)["h"], F.lit(False))

        own = F.transform(ranked, lambda x, k: F.when(same(k, k - 1) | same(k, k + 1), x["i"]))
        return F.sort_array(F.filter(own, lambda x: x.isNotNull()))

    def covered(at: Column) -> Column:
        fresh = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(p - F.get(at, k - 1), F.lit(3))))
        return F.aggregate(fresh, F.lit(0).cast("long"), lambda s, x: s + x)

    def counted(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(let(ranked, places), covered))

    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(let(hashes, counted))


def measures(docs: DataFrame) -> DataFrame:
    """Per document the counts that the rules read. A null text has no words."""
    text = F.col("text")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    with_word = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACE, "")) > 0)
    return texts_of(docs).select(
        "doc_id",
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"), F.size(F.filter(w, lambda x: ~x.rlike(LETTER))).cast("long").alias("n_marks"))).alias("w"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).alias("n_symbols"),
        let(with_word, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
        count_of(text, CAPITALS).alias("n_capitals"),
        count_of(text, "!").alias("n_exclaims"),
    ).select("doc_id", "w.*", "word_chars", "n_symbols", "l.*", "n_capitals", "n_exclaims")


def votes(rules: dict = RULES) -> Column:
    """An array of -1, 0, 1."""

    def vote(measure: str, good_from: float, good_to: float, bad_under: float, bad_over: float) -> Column:
        x = F.expr(measure.replace(" / ", " / nullif(") + ", 0)" if " / " in measure else measure).cast("double")
        return F.when((x < bad_under) | (x > bad_over), -1).when((x >= good_from) & (x <= good_to), 1).otherwise(0)

    return F.array(*(vote(*rule) for rule in rules.values()))


def _likelihood(vote: Column, side: Column) -> Column:
    """P(vote) by a rule's three probabilities."""
    return F.get(side, vote + 1)


def posterior(vote: Column, model: Column) -> Column:
    """P(good | votes) by `model`: struct(prior, good, bad), good and bad being arrays of three probabilities a rule."""

    def log_sum(side: Column) -> Column:
        return F.aggregate(F.zip_with(vote, side, lambda v, p: F.ln(_likelihood(v, p))), F.lit(0.0), lambda s, x: s + x)

    return 1 / (1 + F.exp(log_sum(model["bad"]) - log_sum(model["good"]) + F.ln(1 - model["prior"]) - F.ln(model["prior"])))


def estimate(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> DataFrame:
    """One row, `model`, from patterns (votes, n): expectation-maximisation within one expression."""

    def three(guess: tuple) -> Column:
        return F.array(*map(F.lit, guess))

    guess = F.struct(F.lit(GUESS_PRIOR).alias("prior"), F.array_repeat(three(GUESS_GOOD), n_rules).alias("good"), F.array_repeat(three(GUESS_BAD), n_rules).alias("bad"))
    zero = F.lit(0.0)

    def total(seen: Column, of) -> Column:
        return F.aggregate(seen, zero, lambda s, p: s + of(p))

    def step(seen: Column, model: Column) -> Column:
        def estimated(weighed: Column) -> Column:
            def rates(weight, first: tuple) -> Column:
                return F.transform(
                    F.sequence(F.lit(0), F.lit(n_rules - 1)),
                    lambda j: F.array(
                        *(
                            (total(weighed, lambda p, v=v: F.when(F.get(p["votes"], j) == v, weight(p)).otherwise(zero)) + F.lit(WEIGHT * g)) / (total(weighed, weight) + F.lit(WEIGHT))
                            for v, g in zip((-1, 0, 1), first, strict=True)
                        )
                    ),
                )

            def bounded(rule: Column) -> Column:
                low = F.least(F.get(rule, 0), F.lit(FALSE_ALARMS))
                return F.array(low, *(F.get(rule, k) * (1 - low) / (1 - F.get(rule, 0)) for k in (1, 2)))

            good, bad = lambda p: p["n"] * p["r"], lambda p: p["n"] * (1 - p["r"])
            prior = (total(weighed, good) + F.lit(WEIGHT * GUESS_PRIOR)) / (total(weighed, lambda p: p["n"]) + F.lit(WEIGHT))
            return F.struct(prior.alias("prior"), F.transform(rates(good, GUESS_GOOD), bounded).alias("good"), rates(bad, GUESS_BAD).alias("bad"))

        weighed = F.transform(seen, lambda p: F.struct(p["votes"].alias("votes"), p["n"].cast("double").alias("n"), posterior(p["votes"], model).alias("r")))
        return let(weighed, estimated)

    seen = F.sort_array(F.collect_list(F.struct("votes", "n")))
    return patterns.agg(seen.alias("seen")).select("seen", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), guess, lambda model, _: step(F.col("seen"), model)).alias("model"))


def judge(measured: DataFrame, rules: dict = RULES, keep_from: float = KEEP_FROM) -> DataFrame:
    """measured with votes, posterior, base_failed and kept. It is read twice: give a written table.

    The estimate is over documents that pass the base checks: the others are decided, and being many and alike
    would draw all of what is learnt about bad documents to themselves.
    The table of patterns that is broadcast has at most 3^rules rows.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    voted = measured.withColumn("votes", votes(rules)).withColumn("base_failed", failed)
    patterns = voted.groupBy("votes").agg(F.count(F.when(~F.col("base_failed"), 1)).alias("n"))
    scored = estimate(patterns, len(rules)).select(F.explode("seen.votes").alias("votes"), "model").select("votes", posterior(F.col("votes"), F.col("model")).alias("posterior"))
    return voted.join(F.broadcast(scored), "votes").withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from))


def accuracies(spark: SparkSession, docs: DataFrame, rules: dict = RULES) -> DataFrame:
    """(rule, prior, good_said_bad, bad_said_bad): what the estimate holds of each rule's bad votes on good and on bad documents."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    patterns = measures(docs).where(~failed).groupBy(votes(rules).alias("votes")).agg(F.count("*").alias("n"))
    names = F.array(*map(F.lit, rules))
    rows = F.explode(F.arrays_zip(names.alias("rule"), F.col("model.good").alias("good"), F.col("model.bad").alias("bad")))
    return estimate(patterns, len(rules)).select("model", rows.alias("r")).select("r.rule", "model.prior", F.get("r.good", F.lit(0)).alias("good_said_bad"), F.get("r.bad", F.lit(0)).alias("bad_said_bad"))


def quality_rules(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, its counts, base_failed, kept, posterior.

    A null or empty text has no words and fails; repeated rows, and rows without a doc_id, each have a row and count each; no rows give none;
    other columns stay out. Ties at the threshold are kept.
    """
    found = judge(written(spark, measures(docs), "measures"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("posterior", 4).alias("posterior"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark, table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same in SQL: the rounds of expectation-maximisation are written out one after the other."""

    def vote(measure: str, good_from: float, good_to: float, bad_under: float, bad_over: float) -> str:
        x = measure.replace(" / ", "::DOUBLE / nullif(") + ", 0)" if " / " in measure else measure
        return f"CASE WHEN {x} < {bad_under} OR {x} > {bad_over} THEN -1 WHEN {x} >= {good_from} AND {x} <= {good_to} THEN 1 ELSE 0 END"

    m = len(RULES)
    rate = lambda j, v, g, weight: f"(sum(CASE WHEN votes[{j}] = {v} THEN {weight} ELSE 0 END) + {WEIGHT * g}) / (sum({weight}) + {WEIGHT})"
    rates = lambda first, weight: ", ".join("[" + ", ".join(rate(j, v, g, weight) for v, g in zip((-1, 0, 1), first, strict=True)) + "]" for j in range(1, m + 1))
    bounded = ", ".join(f"[least(u[{j}][1], {FALSE_ALARMS}), " + ", ".join(f"u[{j}][{k}] * (1 - least(u[{j}][1], {FALSE_ALARMS})) / (1 - u[{j}][1])" for k in (2, 3)) + "]" for j in range(1, m + 1))
    logs = lambda side: " + ".join(f"ln({side}[{j}][votes[{j}] + 2])" for j in range(1, m + 1))
    post = f"1 / (1 + exp(({logs('bad')}) - ({logs('good')}) + ln(1 - prior) - ln(prior)))"
    guess = lambda g: "[" + ", ".join(f"[{', '.join(f'{x}::DOUBLE' for x in g)}]" for _ in range(m)) + "]"
    steps = [f"m0 AS (SELECT {GUESS_PRIOR}::DOUBLE AS prior, {guess(GUESS_GOOD)} AS good, {guess(GUESS_BAD)} AS bad)"]
    for k in range(1, ROUNDS + 1):
        steps.append(
            f"m{k} AS MATERIALIZED (SELECT prior, [{bounded}] AS good, bad FROM (SELECT (sum(n * r) + {WEIGHT * GUESS_PRIOR}) / (sum(n) + {WEIGHT}) AS prior, [{rates(GUESS_GOOD, 'n * r')}] AS u, [{rates(GUESS_BAD, 'n * (1 - r)')}] AS bad "
            f"FROM (SELECT votes, n, {post} AS r FROM pat, m{k - 1})))"
        )
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
tri AS (SELECT doc_id, i, w[i : i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT doc_id, unnest(range(i, i + 3)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1
  ) GROUP BY doc_id
),
f AS MATERIALIZED (
  SELECT doc_id, len(w) AS n_words, coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(len(list_filter(w, lambda x: NOT regexp_matches(x, '{LETTER}'))) AS BIGINT) AS n_marks, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals, CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_exclaims
  FROM w LEFT JOIN rep USING (doc_id)
),
v AS MATERIALIZED (SELECT *, [{", ".join(vote(*r) for r in RULES.values())}] AS votes, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f),
pat AS MATERIALIZED (SELECT votes, CAST(count(CASE WHEN NOT base_failed THEN 1 END) AS DOUBLE) AS n FROM v GROUP BY votes),
{", ".join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND p >= {KEEP_FROM} AS kept, round(p, 4) AS posterior
FROM (SELECT *, {post} AS p FROM v, m{ROUNDS})
"""


OP1_SQL = _sql()
