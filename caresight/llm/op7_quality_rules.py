r"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule looks at one property of a whole text and votes good (1), bad (-1) or abstains (0). The
unknown true quality is a latent class; EM over the counts of vote patterns (at most 3^rules rows,
whatever the corpus) runs until it settles and estimates how often each rule votes either way for good
and for bad texts.
The posterior probability of the good class then replaces filtering by all rules at once. All of
it is DataFrame functions; a run of EM sends a few sums to the driver per round.

Words are ``[^\x20\x09-\x0D]+``. Windows of eight words are compared by 64-bit hashes.

Defined cases: null or empty text: no words, fails the base rules. Null or repeated ids: a row each.
Empty table: no rows (the rules' start values hold). Extra columns, of any name,
are kept by ``keep_good`` and not read otherwise.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caresight.llm.common import checkpointed, column, named_again, plainly_named, table, written

GAP, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
WINDOW = 8
#: Change in the share of good texts that ends EM, rounds after which it is given up as an error, and
#: the start values.
CHANGE, ROUNDS, PRIOR, VOTES_OF_GOOD, VOTES_OF_BAD = 1e-4, 500, 0.8, (0.9, 0.005), (0.65, 0.3)
# Function words of the four languages, common letters of symbol junk.
FUNCTION_WORDS = ["the", "of", "and", "to", "in", "is", "that", "with", "der", "die", "und", "den", "ist", "von",
                  "de", "la", "le", "et", "les", "des", "que", "el", "en", "los", "las"]
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENDS = ".!?"


def _lacking(text: Column, chars: str) -> Column:
    """How many characters of ``chars`` a text holds."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct ``__m`` of each text's measures."""
    t, w = F.col("__t"), F.col("__w")
    words = docs.withColumn("__t", F.coalesce(column(text).cast("string"), F.lit("")))
    words = words.withColumn("__w", F.array_remove(F.split("__t", GAP), "")).withColumn(
        "__l", F.filter(F.split("__t", "\n"), lambda x: x.rlike(WORD)))
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    windows = words.withColumn("__h", F.when(F.size(w) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")))
    # windows found twice or more: neighbours of the sorted hashes; most texts have none and skip this
    h = F.col("__h")
    windows = windows.withColumn("__s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("__s")
    again = F.filter(F.transform(s, lambda x, k: F.when((F.get(s, k + 1)["h"] == x["h"]) | ((k > 0) & (F.get(s, F.greatest(k - 1, F.lit(0)))["h"] == x["h"])), x["i"])), lambda i: i.isNotNull())
    windows = windows.withColumn("__p", F.sort_array(again))
    p = F.col("__p")
    covered = F.aggregate(F.transform(p, lambda x, k: F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), x - F.get(p, F.greatest(k - 1, F.lit(0)))))), F.lit(0), lambda a, x: a + x)
    return windows.withColumn("__m", F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _lacking(t, SYMBOLS).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"), (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        _lacking(t, CAPITALS).cast("long").alias("n_capitals"), _lacking(t, ENDS).cast("long").alias("n_ends"),
        sum([F.contains(t, F.lit(f" {x} ")).cast("int") for x in FUNCTION_WORDS], F.lit(0)).cast("long").alias("n_function_words"),
    )).drop("__t", "__w", "__l", "__h", "__s", "__p")


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def rules(m: str = "__m") -> dict[str, Column]:
    """The votes by rule, from the struct of measures; a rule without evidence abstains."""
    n, chars = F.col(f"{m}.n_words"), F.col(f"{m}.word_chars")
    of = lambda x: F.col(f"{m}.{x}")
    some = n > 0
    return {
        "length": _vote(n < 20, n >= 50),
        "word_length": _vote(some & ((chars > 15 * n) | (chars < 2 * n)), some & (chars <= 10 * n) & (chars >= 3 * n)),
        "symbols": _vote(of("n_symbols") * 10 > n, of("n_symbols") * 50 <= n),
        "many_symbols": _vote(of("n_symbols") * 4 > n, F.lit(False)),
        "dup_lines": _vote(of("n_dup_lines") * 10 > 3 * of("n_lines"), (of("n_lines") > 2) & (of("n_dup_lines") * 10 <= of("n_lines"))),
        "repeats": _vote(of("n_repeat_words") * 10 > 3 * n, of("n_repeat_words") * 50 <= n),
        "capitals": _vote(of("n_capitals") * 10 > 3 * chars, of("n_capitals") * 10 <= chars),
        "function_words": _vote((n >= 50) & (of("n_function_words") < 2), of("n_function_words") >= 3),
        "sentences": _vote((n >= 50) & ((of("n_ends") * 100 < n) | (of("n_ends") * 2 > n)), (of("n_ends") * 40 >= n) & (of("n_ends") * 4 <= n)),
    }


def base_failed(m: str = "__m") -> Column:
    n = F.col(f"{m}.n_words")
    return (n < 20) | (100 * F.col(f"{m}.n_repeat_words") > 30 * n)


class VoteModel:
    """Share of good texts, and for each rule and class the chances of the votes 1 and -1.

    Start: a rule finds some kinds of bad text only, so a vote of 1 says little, while one of -1 is
    rarely wrong.
    """

    def __init__(self, names: list[str]):
        self.good, self.chance = PRIOR, {x: {True: VOTES_OF_GOOD, False: VOTES_OF_BAD} for x in names}

    def posterior(self, vote: dict[str, Column]) -> Column:
        """Probability of the good class; a rule that abstains adds nothing."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for name, c in self.chance.items():
            yes, no = [math.log(max(g, 1e-3) / max(b, 1e-3)) for g, b in zip(c[True], c[False])]
            odds = odds + F.when(vote[name] == 1, yes).when(vote[name] == -1, no).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit(votes: DataFrame, names: list[str]) -> VoteModel:
    """EM over the counts of vote patterns (columns ``names``)."""
    # 3^rules rows at most, brought together once they are counted
    patterns = checkpointed(votes.groupBy(*names).agg(F.count("*").alias("n")).repartition(1))
    model, before = VoteModel(names), None
    vote = {x: F.col(x) for x in names}
    for _ in range(ROUNDS):
        weighed = patterns.withColumn("g", model.posterior(vote) * F.col("n")).withColumn("b", F.col("n") - F.col("g"))
        sums = weighed.agg(F.sum("g").alias("g"), F.sum("b").alias("b"), *[
            F.sum(F.when(vote[x] == v, F.col(k)).otherwise(0)).alias(f"{k}{v}{x}") for x in names for k in "gb" for v in (1, -1)]).first()
        if sums["g"] is None:
            return model
        for x in names:
            for good, k in ((True, "g"), (False, "b")):  # smoothed
                model.chance[x][good] = tuple((sums[f"{k}{v}{x}"] + 1) / (sums[k] + 3) for v in (1, -1))
        model.good = min(max(sums["g"] / (sums["g"] + sums["b"]), 0.05), 0.95)
        if before is not None and abs(before - sums["g"]) <= CHANGE * (sums["g"] + sums["b"]):
            return model
        before = sums["g"]
    raise RuntimeError(f"the votes' weights have not settled in {ROUNDS} rounds")


def judged(docs: DataFrame, text: str = "text", wide: bool = False) -> tuple[DataFrame, Column, Column]:
    """Rows with their measures, the posterior and the verdict (base rules and posterior of 0.5).

    The measures are taken once and kept in the shared folder, with the rows where ``wide``.
    """
    vote = rules()
    marked = measures(docs, text).select("*", F.struct(*[v.alias(k) for k, v in vote.items()]).alias("__v"))
    marked = written(marked) if wide else checkpointed(marked.drop(text))
    model = fit(marked.select("__v.*"), list(vote))
    posterior = model.posterior({x: F.col(f"__v.{x}") for x in vote})
    return marked, posterior, ~base_failed() & (posterior >= 0.5)


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the measures, base_failed, posterior (chance of the good class), votes and kept."""
    marked, posterior, kept = judged(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")))
    return marked.select("doc_id", "__m.*", base_failed().alias("base_failed"), posterior.alias("posterior"), F.col("__v").alias("votes"), kept.alias("kept"))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that the base rules and the weighed votes keep, with all their columns."""
    plain = plainly_named(docs)
    marked, _, kept = judged(plain, f"c{docs.columns.index(text)}", wide=True)
    return named_again(marked.where(kept), docs)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
