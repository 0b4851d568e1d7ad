"""Quality rules as weak supervision: rules vote or abstain and expectation-maximisation weighs them.

All work on texts is column expressions. A document's votes form a pattern; documents are counted by
pattern, which gives at most ``3 ** len(RULES)`` rows however large the corpus is. EM runs over these
counts: it estimates how often each rule votes for good, votes for bad or abstains, given a good or a bad
document. The posterior of a document is then a sum of its rules' log-odds.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import staged, table

SPACE = r"[\x20\x09-\x0D]+"
NONSPACE = r"[^\x20\x09-\x0D]"

GOOD, BAD, ABSTAIN = "1", "2", "0"

#: name -> (votes for bad, votes for good), each a condition over the features; neither: the rule abstains.
#: Rules for one defect vote for bad or abstain; rules for the look of prose vote for good or abstain.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("n_symbols > 0.1 * n_words", "false"),
    "shouting": ("n_upper > 0.3 * word_chars", "false"),
    "exclaiming": ("n_exclaim > 0.3 * n_words", "false"),
    "repeating": ("n_repeat_words > 0.45 * n_words", "false"),
    "repeated_lines": ("n_dup_lines > 0.5 * n_lines", "false"),
    "few_words": ("n_distinct < 0.2 * n_words and n_words < 5000", "false"),
    "odd_lengths": ("word_chars < 3 * n_words or word_chars > 12 * n_words", "false"),
    "plain_marks": ("false", "n_symbols <= 0.03 * n_words and n_exclaim <= 0.05 * n_words"),
    "plain_words": ("false", "word_chars between 3.5 * n_words and 7 * n_words and n_upper <= 0.15 * word_chars and n_symbols <= 0.1 * n_words"),
    "plain_flow": ("false", "n_repeat_words <= 0.45 * n_words and n_dup_lines <= 0.3 * n_lines and n_words <= 80 * n_stops and n_exclaim <= 0.3 * n_words and n_symbols <= 0.1 * n_words"),
}

PRIOR_GOOD = 0.8
#: The estimated share of good documents is held between these; below one half, rules would trade their meanings.
PRIOR_LEAST, PRIOR_MOST = 0.5, 0.999
SMOOTHING = 1.0


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once: a lambda's variable holds it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Maximal runs of other than ASCII white space.

    A split at one plain character costs half of a split at a class; texts whose white space is
    only blanks and line feeds, which is most, get it.
    """
    rare = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\r")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\x0c"))
    plain = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")
    return F.array_remove(F.when(rare, F.split(text, SPACE)).otherwise(plain), "")


def repeated_window_words(hashes: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found twice or more in the text; ``hashes``: of its words.

    A window's hash and its position are packed into one long, which sorts fast, the position in as many bits
    as the text needs. Equal windows are then neighbours, but where two windows share the packed bits of their hashes;
    there a window is compared with all of those bits. Windows are equal if their words' 64-bit hashes are. The windows'
    positions are sorted and each adds what it doesn't share with the next.
    """

    def window(w: Column, x: Column, i: Column) -> Column:
        return F.xxhash64(x, *[F.get(w, i + k) for k in range(1, width)])

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))),
            F.lit(0),
            lambda a, x: a + x,
        )

    def counted(w: Column, bits: Column) -> Column:
        left = lambda x: F.call_function("shiftleft", x, bits)
        high = lambda x: F.call_function("shiftrightunsigned", x, bits)
        place = lambda x: F.call_function("shiftrightunsigned", F.call_function("shiftleft", x, 64 - bits), 64 - bits).cast("int")
        keys = F.transform(w, lambda x, i: left(window(w, x, i)).bitwiseOR(i.cast("long")))
        keys = F.slice(keys, F.lit(1), F.size(w) - (width - 1))

        def equal(x: Column, y: Column) -> Column:
            i, j = place(x), place(y)
            out = F.get(w, i) == F.get(w, j)
            for k in range(1, width):
                out = out & (F.get(w, i + k) == F.get(w, j + k))
            return out

        def positions(s: Column) -> Column:
            def again(x: Column, k: Column) -> Column:
                before, after = F.when(k > 0, F.get(s, k - 1)), F.get(s, k + 1)
                near = lambda y: F.coalesce(high(y) == high(x), F.lit(False))
                beside = (near(before) & equal(before, x)) | (near(after) & equal(after, x))
                among = F.exists(s, lambda y: (high(y) == high(x)) & (y != x) & equal(y, x))
                return F.when(~near(before) & ~near(after), False).when(beside, True).otherwise(among)

            return F.filter(s, again)

        return _let(F.sort_array(keys), lambda s: _let(F.sort_array(F.transform(positions(s), place)), covered))

    # as many bits as the last position has
    bits = lambda w: F.length(F.bin(F.size(w).cast("long")))
    return F.when(F.size(hashes) <= width, F.lit(0)).otherwise(_let(hashes, lambda w: _let(bits(w), lambda b: counted(w, b))))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one struct column ``_q`` of counts over the whole text; a null text has no words."""
    body = F.coalesce(F.col(text), F.lit(""))
    made = (
        docs.withColumn("_w", words(body))
        .withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
        .withColumn("_l", F.filter(F.split(body, "\n"), lambda x: x.rlike(NONSPACE)))
        .withColumn("_m", F.regexp_replace(body, r"[^#*$%&|<>!.?\p{Lu}]+", ""))
    )
    count = lambda c: c.cast("long")
    marks = lambda pattern: count(F.regexp_count("_m", F.lit(pattern)))
    return made.withColumn(
        "_q",
        F.struct(
            count(F.size("_w")).alias("n_words"),
            count(F.length(F.array_join("_w", ""))).alias("word_chars"),
            marks(r"[#*$%&|<>]").alias("n_symbols"),
            count(F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
            count(repeated_window_words(F.col("_h"))).alias("n_repeat_words"),
            count(F.size("_l")).alias("n_lines"),
            count(F.size(F.array_distinct("_h"))).alias("n_distinct"),
            marks(r"\p{Lu}").alias("n_upper"),
            marks("!").alias("n_exclaim"),
            marks(r"[.?!]").alias("n_stops"),
        ),
    ).drop("_w", "_h", "_l", "_m")


def base_failed(q: str = "_q") -> Column:
    return (F.col(f"{q}.n_words") < 50) | (100 * F.col(f"{q}.n_repeat_words") > 50 * F.col(f"{q}.n_words"))


def _over(sql: str, q: str) -> Column:
    return F.expr(re.sub(r"\bn_\w+|\bword_chars\b", lambda m: f"{q}.{m[0]}", sql))


def vote_pattern(q: str = "_q") -> Column:
    """A digit per rule: 1 good, 2 bad, 0 abstains. A text without words gets abstentions only."""
    votes = [F.when(_over(bad, q), BAD).when(_over(good, q), GOOD).otherwise(ABSTAIN) for bad, good in RULES.values()]
    return F.when(F.col(f"{q}.n_words") == 0, ABSTAIN * len(RULES)).otherwise(F.concat(*votes))


@dataclass(frozen=True)
class LabelModel:
    """Of each rule, the probability of each vote for good and for bad documents."""

    prior: float
    good: tuple[dict[str, float], ...]
    bad: tuple[dict[str, float], ...]

    def log_odds(self, pattern: str) -> float:
        return math.log(self.prior / (1 - self.prior)) + sum(math.log(g[v] / b[v]) for g, b, v in zip(self.good, self.bad, pattern, strict=True))

    def posterior(self, q: str = "_q") -> Column:
        """Probability of good quality, as a column."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for g, b, (bad, good) in zip(self.good, self.bad, RULES.values(), strict=True):
            ratio = {v: F.lit(math.log(g[v] / b[v])) for v in (GOOD, BAD, ABSTAIN)}
            vote = F.when(_over(bad, q), ratio[BAD]).when(_over(good, q), ratio[GOOD]).otherwise(ratio[ABSTAIN])
            odds = odds + F.when(F.col(f"{q}.n_words") == 0, ratio[ABSTAIN]).otherwise(vote)
        return 1 / (1 + F.exp(-odds))


def fit(counts: dict[str, int], rounds: int = 100, tolerance: float = 1e-9, least: float = PRIOR_LEAST, most: float = PRIOR_MOST) -> LabelModel:
    """EM over the numbers of documents by vote pattern. A rule starts as right in 7 of 10 votes.

    ``least`` and ``most`` bound the share of good documents: on a corpus known to be mostly bad, lower the first.
    """
    m = len(next(iter(counts), "0" * len(RULES)))
    total = sum(counts.values())
    start = lambda right, wrong: tuple({right: 0.5, wrong: 0.2, ABSTAIN: 0.3} for _ in range(m))
    model = LabelModel(PRIOR_GOOD, start(GOOD, BAD), start(BAD, GOOD))
    last = -math.inf
    for _ in range(rounds if total else 0):
        share, likelihood = {}, 0.0
        for p, n in counts.items():
            g = math.log(model.prior) + sum(math.log(d[v]) for d, v in zip(model.good, p, strict=True))
            b = math.log(1 - model.prior) + sum(math.log(d[v]) for d, v in zip(model.bad, p, strict=True))
            top = max(g, b)
            norm = top + math.log(math.exp(g - top) + math.exp(b - top))
            share[p] = math.exp(g - norm)
            likelihood += n * norm
        mass = {p: (n * share[p], n * (1 - share[p])) for p, n in counts.items()}
        tables = []
        for side, right in ((0, GOOD), (1, BAD)):
            rows = []
            for k in range(m):
                # a rule that is seldom cast against keeps the direction that its author gave it
                seen = {v: SMOOTHING * (2 if v == right else 1) for v in (GOOD, BAD, ABSTAIN)}
                for p, part in mass.items():
                    seen[p[k]] += part[side]
                whole = sum(seen.values())
                rows.append({v: c / whole for v, c in seen.items()})
            tables.append(tuple(rows))
        good = sum(part[0] for part in mass.values())
        model = LabelModel(min(most, max(least, (good + 4 * SMOOTHING) / (total + 5 * SMOOTHING))), *tables)
        if abs(likelihood - last) <= tolerance * abs(likelihood):
            break
        last = likelihood
    return model


def learn(scored: DataFrame) -> LabelModel:
    """Fit on all rows of a frame that has ``_q``: one aggregation to at most 3 ** rules rows."""
    rows = scored.groupBy(vote_pattern().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    return fit({r["p"]: r["n"] for r in sorted(rows)})


def judge(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``_q``, ``_pattern``, ``_posterior`` and ``_kept``.

    The counts are written once to the shared folder with the columns of ``docs`` (drop the text
    from the result's use and only counts are read again). Null and empty texts have no words and
    fail the base rule; equal rows get equal verdicts; an empty table gives an empty result; columns
    of ``docs`` named like these are replaced.
    """
    scored = staged(features(docs, text), "quality")
    return verdicts(scored, learn(scored), threshold)


def verdicts(scored: DataFrame, model: LabelModel, threshold: float = 0.5) -> DataFrame:
    out = scored.withColumn("_pattern", vote_pattern())
    return out.withColumn("_posterior", model.posterior()).withColumn("_kept", ~base_failed() & (F.col("_posterior") >= threshold))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose verdict is to keep them, with the columns of ``docs``."""
    return judge(docs, text, threshold).filter("_kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """A row per document with the base counts and the verdict; see ``judge``."""
    docs = table(spark, sf_dir, "documents")
    thin = staged(features(docs.select("doc_id", "text")).select("doc_id", "_q"), "quality")
    judged = verdicts(thin, learn(thin))
    return judged.select(
        "doc_id", "_q.n_words", "_q.word_chars", "_q.n_symbols", "_q.n_dup_lines", "_q.n_repeat_words",
        base_failed().alias("base_failed"), F.col("_kept").alias("kept"),
        F.col("_pattern").alias("votes"), F.round("_posterior", 6).alias("posterior"),
    )
