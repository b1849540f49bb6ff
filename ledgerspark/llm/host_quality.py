"""Document rules, and host verdicts from shrunken failure rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import stored, text_or_empty

#: Base rule: fewest words, and the largest share of words in repeated windows, in percent.
MIN_WORDS, MAX_REPEATED = 50, 50
WINDOW = 3
#: Further rules for hosts: most symbols per word and most repeated lines, in percent.
MAX_SYMBOLS, MAX_DUP_LINES = 10, 30
RULES = ["short", "repeated", "symbols", "dup_lines"]
#: A host is rejected when the share of its documents that fail one rule is above this ...
MAX_HOST_RATE = 0.5
#: ... by so many standard deviations of its posterior, which is a probability of 0.95.
CERTAINTY = 1.645
#: Documents at which a host has half the say in the prior that a very large one has.
HALF_SAY = 10
#: Least and largest weight of the prior, in documents, however much alike the hosts are.
PRIOR_WEIGHTS = 1.0, 50.0
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def text_counts(rows: DataFrame, text: str) -> DataFrame:
    """Replace the text by n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Words are runs without white space. word_chars counts their code points, n_symbols the
    characters of SYMBOLS, n_lines the lines with a word, n_dup_lines those of them that equal
    an earlier line, and n_repeat_words the words in three-word windows found twice or more. Null and empty texts
    count 0 everywhere. All is done within the row: whole texts, no shuffle.

    Windows are compared by a 64-bit hash. If all are distinct, nothing is sorted. Otherwise
    (hash, place) pairs are sorted, so that equal windows are neighbours; the places of
    repeated windows, sorted again, cover WINDOW words each, less the overlap with the next.
    """
    others = [c for c in rows.columns if c != text]
    body = text_or_empty(text)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = rows.select(
        *others,
        F.filter(F.split(body, SPACE), lambda w: w != "").alias("words"),
        lines.alias("lines"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).alias("n_symbols"),
    )
    n = F.size("words")
    starts = F.sequence(F.lit(0), n - WINDOW)
    window = F.transform(
        starts, lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW)))
    )
    hashed = split.select(
        *others,
        n.alias("n_words"),
        F.length(F.concat_ws("", "words")).alias("word_chars"),
        "n_symbols",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(n >= WINDOW, window).otherwise(F.expr("array()").cast("array<bigint>")).alias("hashes"),
    )
    counts = [*others, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    pairs = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    sorted_pairs = hashed.select(*counts, F.when(some, pairs).alias("pairs"))

    def repeated(pair: Column, k: Column) -> Column:
        near = [F.get("pairs", at)["h"].eqNullSafe(pair["h"]) for at in (k - 1, k + 1)]
        return near[0] | near[1]

    found = F.transform(F.filter("pairs", repeated), lambda pair: pair["i"])
    placed = sorted_pairs.select(*counts, F.sort_array(found).alias("places"))

    def covered(place: Column, k: Column) -> Column:
        return F.coalesce(F.least(F.get("places", k + 1) - place, F.lit(WINDOW)), F.lit(WINDOW))

    covers = F.aggregate(F.transform("places", covered), F.lit(0), lambda a, b: a + b)
    return placed.select(
        *others,
        *(F.col(c).cast("long") for c in counts[len(others) :]),
        F.coalesce(covers, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def rule_failures() -> dict[str, Column]:
    """For each of RULES, whether a document with the counts of ``text_counts`` fails it."""
    words = F.col("n_words")
    return {
        "short": words < MIN_WORDS,
        "repeated": 100 * F.col("n_repeat_words") > MAX_REPEATED * words,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS * words,
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"),
    }


def beta_prior(sums: dict[str, float | None], rule: str) -> tuple[float, float]:
    """Mean and weight, in documents, of the beta distribution that the hosts' rates come from.

    Moments over hosts that count by their say: what the rates spread beyond the chance of
    drawing their documents is the variance of the distribution.
    """
    least, largest = PRIOR_WEIGHTS
    say, total, squares = (sums[k] or 0.0 for k in ("say", f"{rule}_rate", f"{rule}_square"))
    if not say:
        return 0.0, largest
    mean = total / say
    drawn = sums["say_by_n"] - sums["square_by_n"] / say
    free = say - sums["say_square"] / say - drawn
    between = squares - total * total / say - mean * (1 - mean) * drawn
    if free <= 1e-9 or between <= 0:
        return mean, largest
    return mean, min(max(mean * (1 - mean) * free / between - 1, least), largest)


def host_verdicts(judged: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n, host_rate, host_failed from host and one boolean per rule for every document.

    Failures are summed by host, and every rule's rate is shrunk towards that of all hosts by a
    beta prior. A host fails when some rule's rate is above ``max_host_rate`` with a posterior
    probability of 0.95 (normal approximation), so a few documents are little evidence, and
    the weight of the prior is bounded, so many good hosts do not shield a bad one. host_rate
    is the largest of the shrunken rates. A null host is a host of its own. Sums over all hosts,
    one row, reach the driver.
    """
    failed = [F.sum(F.col(r).cast("long")).alias(r) for r in RULES]
    per_host = judged.groupBy("host").agg(F.count("*").alias("n"), *failed)
    n = F.col("n")
    say = n / (n + HALF_SAY)
    moments = [
        F.sum(say).alias("say"), F.sum(say * say).alias("say_square"),
        F.sum(say / n).alias("say_by_n"), F.sum(say * say / n).alias("square_by_n"),
    ]
    for r in RULES:
        rate = F.col(r) / n
        moments += [F.sum(say * rate).alias(f"{r}_rate"), F.sum(say * rate * rate).alias(f"{r}_square")]
    sums = per_host.agg(*moments).first().asDict()
    rates, bounds = [], []
    for r in RULES:
        mean, weight = beta_prior(sums, r)
        rate = (F.col(r) + mean * weight) / (n + weight)
        spread = F.sqrt(F.greatest(rate * (1 - rate), F.lit(0.0)) / (n + weight + 1))
        rates.append(rate)
        bounds.append(rate - CERTAINTY * spread)
    return per_host.select(
        "host", "n", F.greatest(*rates).alias("host_rate"),
        (F.greatest(*bounds) > max_host_rate).alias("host_failed"),
    )


def host_quality(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
    max_host_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """Judge each document by its own counts and by its host; one row per input row.

    Returns key, the counts of ``text_counts``, base_failed (too few words, or more than half
    of them in repeated windows), kept (false if base_failed or the host failed), host_rate,
    host_failed; see ``host_verdicts``. Failures are summed within tasks, and the texts are read
    once: the counts are stored, and only they meet the host verdicts.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(host).alias("host"), F.col(text).alias("body"))
    counts = text_counts(rows, "body").withColumns(rule_failures())
    judged = stored(counts.withColumn("base_failed", F.col("short") | F.col("repeated")), "counts")
    hosts = host_verdicts(judged, max_host_rate).withColumnRenamed("host", "of").drop("n")
    out = judged.join(hosts, F.col("host").eqNullSafe(F.col("of")), "left")
    return out.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
        "n_lines", "host_rate", "host_failed",
    )
