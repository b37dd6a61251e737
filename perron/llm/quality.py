"""Quality rules with host verdicts, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perron.llm.tables import bounded_broadcast, saved

SPACES = r"[\x20\x09-\x0D]"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
POSITION_BITS = 31


@dataclass(frozen=True)
class Rules:
    """A document fails below ``min_words`` or above ``max_repeat_percent``.

    A host fails when its shrunk failure rate is above ``max_host_rate``.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.5


def _window_codes() -> Column:
    """Per 3-word window: 33 bits of its hash above its position, so that sorting brings equal ones together."""

    def code(word: Column, i: Column) -> Column:
        h = F.xxhash64(word, F.get("q_words", i + 1), F.get("q_words", i + 2))
        return F.shiftleft(h, POSITION_BITS).bitwiseOR(i.cast("long"))

    return F.transform(F.slice("q_words", 1, F.greatest(F.size("q_words") - 2, F.lit(0))), code)


def _high(code: Column) -> Column:
    return F.shiftright(code, POSITION_BITS)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base measures of ``text``; null texts have no words.

    Adds q_n_words, q_word_chars, q_n_symbols, q_n_dup_lines, q_n_repeat_words
    (long). Repeated 3-word windows are found inside the row: candidates by
    sorted short codes, then confirmed by their words.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD_CHARACTER))
    step = docs.withColumns(
        {
            "q_words": F.filter(F.split(whole, SPACES + "+", -1), lambda word: word != ""),
            "q_lines": lines,
            "q_n_symbols": (F.size(F.split(whole, SYMBOLS, -1)) - 1).cast("long"),
        }
    )
    step = step.withColumn("q_codes", F.sort_array(_window_codes()))
    position = (1 << POSITION_BITS) - 1
    twins = F.filter(
        "q_codes",
        lambda code, i: (_high(code) == _high(F.get("q_codes", i + 1))) | (_high(code) == _high(F.get("q_codes", i - 1))),
    )
    step = step.withColumn("q_twins", twins)
    # the words themselves decide; this array is short unless the text repeats itself
    step = step.withColumn(
        "q_twins",
        F.sort_array(
            F.transform(
                "q_twins",
                lambda code: F.struct(
                    F.concat_ws(" ", F.slice("q_words", (code.bitwiseAND(position) + 1).cast("int"), 3)).alias("w"),
                    code.bitwiseAND(position).alias("at"),
                ),
            )
        ),
    )
    step = step.withColumn(
        "q_at",
        F.sort_array(
            F.transform(
                F.filter(
                    "q_twins",
                    lambda x, i: (x["w"] == F.get("q_twins", i + 1)["w"]) | (x["w"] == F.get("q_twins", i - 1)["w"]),
                ),
                lambda x: x["at"],
            )
        ),
    )
    # windows at p and q > p cover min(3, q - p) words before q's own three
    covered = F.aggregate(
        F.transform("q_at", lambda at, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("q_at", i + 1) - at, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, one: total + one,
    )
    return step.withColumns(
        {
            "q_n_words": F.size("q_words").cast("long"),
            "q_word_chars": F.length(F.array_join("q_words", "")).cast("long"),
            "q_n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
            "q_n_repeat_words": covered,
        }
    ).drop("q_words", "q_lines", "q_codes", "q_twins", "q_at")


def base_failed(rules: Rules) -> Column:
    few = F.col("q_n_words") < rules.min_words
    return few | (F.col("q_n_repeat_words") * 100 > F.col("q_n_words") * rules.max_repeat_percent)


def host_rates(judged: DataFrame, host: str) -> DataFrame:
    """(host, host_docs, host_failed, host_rate): failure rates shrunk by a beta prior fitted to all hosts.

    The prior Beta(m * s, (1 - m) * s) has the hosts' mean rate m, and its size s
    follows from their variance beyond binomial noise (method of moments). One
    host, or hosts without more than noise between them, are shrunk wholly to m.
    Rows without a host belong to none.
    """
    hosts = judged.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
    hosts = hosts.agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    moments = hosts.agg(
        (F.sum("host_failed") / F.sum("host_docs")).alias("mean"),
        F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("spread"),
        F.avg(1 / F.col("host_docs")).alias("per_doc"),
    )
    prior = moments.first()  # three numbers
    mean = prior["mean"] or 0.0
    noise = mean * (1 - mean)
    between = prior["spread"] - noise * (prior["per_doc"] or 0.0)
    if between > 0:
        # Var = m (1 - m) / (s + 1)
        size = max(noise / between - 1, 0.0)
        shrunk = (F.col("host_failed") + F.lit(mean) * size) / (F.col("host_docs") + size)
    else:
        # no difference between hosts
        shrunk = F.lit(mean)
    return hosts.select("host", "host_docs", "host_failed", shrunk.alias("host_rate"))


def judge(docs: DataFrame, host: str = "source", text: str = "text", rules: Rules = Rules(), carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: ``carry`` columns, measures, base_failed, host_rate and kept.

    Rows without a host (null) are judged by the base rules alone and have a null
    host_rate; null texts have no words and fail. Repeated rows count, and come
    out, as often as they go in. An empty table gives an empty result. Carried
    columns may have any name.
    """
    taken = F.struct(*carry).alias("q_row"), F.col(host).alias("q_host"), F.col(text).alias("q_text")
    stats = measured(docs.select(*taken), "q_text").drop("q_text")
    stats = saved(stats.withColumn("base_failed", base_failed(rules)), "quality-measures")
    hosts = saved(host_rates(stats, "q_host").select(F.col("host").alias("q_host"), "host_rate"), "quality-hosts")
    verdict = F.coalesce(F.col("host_rate") <= rules.max_host_rate, F.lit(True))
    joined = stats.join(bounded_broadcast(hosts), "q_host", "left")
    return joined.select(
        "q_row.*",
        *[F.col(f"q_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed",
        F.round("host_rate", 9).alias("host_rate"),
        (~F.col("base_failed") & verdict).alias("kept"),
    )


def kept_documents(docs: DataFrame, host: str = "source", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``.

    Measured rows are stored once; hosts are judged from their narrow columns, and
    texts are not shuffled. The table also keeps the optimizer from pushing the
    verdict through the measures, which would multiply their expressions.
    """
    rows = docs.select(F.struct("*").alias("q_row"), F.col(host).alias("q_host"), F.col(text).alias("q_text"))
    stats = measured(rows, "q_text").drop("q_text")
    stats = saved(stats.withColumn("base_failed", base_failed(rules)), "quality-measures")
    bad = host_rates(stats, "q_host").filter(F.col("host_rate") > rules.max_host_rate).select(F.col("host").alias("q_host"))
    bad = saved(bad, "quality-hosts")
    good = stats.filter("not base_failed").select("q_host", "q_row")
    return good.join(bounded_broadcast(bad), "q_host", "left_anti").select("q_row.*")
