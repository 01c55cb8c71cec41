"""URL filter: host and path rules, and for URLs that no rule fits the ratio of
two character language models.

URLs that the rules accept and those that they reject train one smoothed
variable-order Markov model each: the probability of a character after up to
three others interpolates the counts of the longest context with those of the
shorter ones, so a context never seen falls through to the next shorter. A
URL's score is the difference of the two log-likelihoods per character, of the
whole URL or of its host and path. The
cut between the classes is calibrated on the scores of the rules' own URLs:
it lies equally many standard deviations from either mean.

Everything is DataFrame expressions. Counts are grouped over all distinct
URLs of the input; the model is a table with a row per distinct group of four
characters, joined to the URLs' groups. Both are written tables, so a group
that nearly all URLs hold (that of ``.com``, say) is split by adaptive
execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroframe.llm.common import named, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDER = 4
#: weight of the shorter context against one observation, and the least character probability
SMOOTHING, FLOOR = 2.0, 1 / 256
START, END = "\x02", "\x03"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: from there up to ``?``, ``#`` or the end. Both are empty
    for a null or a URL without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substr(whole, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule is
    ``host/path-prefix``; it fits its host and all subdomains. Of rules of
    the same length the earlier one counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, prefix = text.split("/", 1)
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + prefix))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def groups(texts: DataFrame) -> DataFrame:
    """A row per character of ``text`` and its end: ``gram`` is the character
    with the three before it."""
    chars = texts.withColumn("chars", F.regexp_extract_all(F.concat(F.lit(START * (ORDER - 1)), "text", F.lit(END)), F.lit("(?s)."), F.lit(0)))
    zipped = F.arrays_zip(*(F.slice("chars", i + 1, F.size("chars") - (ORDER - 1)).alias(f"c{i}") for i in range(ORDER)))
    return chars.select("id", "label", F.inline(zipped).alias(*(f"c{i}" for i in range(ORDER)))).select(
        "id", "label", F.concat(*(f"c{i}" for i in range(ORDER))).alias("gram"))


def log_ratios(grams: DataFrame) -> DataFrame:
    """(gram, ratio): log of the accepted model's probability of the last
    character over the rejected model's, for every gram of the input."""
    counts = stored(grams.groupBy("gram").agg(F.count_if(F.col("label") == "allow").alias("a"), F.count_if(F.col("label") == "block").alias("b")), "grams")
    by_order = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        longer = by_order[n + 1]
        by_order[n] = longer.groupBy(F.right("gram", F.lit(n)).alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    lower = None
    for n in range(1, ORDER + 1):
        context = F.left("gram", F.lit(n - 1))
        around = by_order[n].groupBy(context.alias("context")).agg(F.sum("a").alias("ca"), F.sum("b").alias("cb"))
        here = by_order[n].withColumn("context", context).join(around, "context")
        if lower is None:
            here = here.withColumn("la", F.lit(FLOOR)).withColumn("lb", F.lit(FLOOR))
        else:
            here = here.withColumn("suffix", F.right("gram", F.lit(n - 1))).join(lower.select(F.col("gram").alias("suffix"), F.col("pa").alias("la"), F.col("pb").alias("lb")), "suffix")
        lower = here.select("gram", ((F.col("a") + SMOOTHING * F.col("la")) / (F.col("ca") + SMOOTHING)).alias("pa"),
                            ((F.col("b") + SMOOTHING * F.col("lb")) / (F.col("cb") + SMOOTHING)).alias("pb"))
    return lower.select("gram", (F.log("pa") - F.log("pb")).alias("ratio"))


def judge(df: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
          whole_url: bool = False) -> DataFrame:
    """One row per row of ``df``: page_id, host, path, rule, verdict, score.

    verdict is the longest fitting rule's; else ``allow`` if the score (log
    likelihood of accepted over rejected, per character) reaches the
    calibrated cut, ``block`` below it. If the rules accept or reject nothing
    there is no model: all other URLs are allowed with a null score. The models
    read the URL as it is with ``whole_url``, else host and path only, which
    leaves out scheme, query and fragment and all of a URL without ``://``. Null
    URLs count as empty ones, which the models judge like any other; repeated rows get equal results; an empty table gives an empty one.
    Other columns are not read."""
    host, path = host_and_path(named(url_col))
    text = F.coalesce(named(url_col), F.lit("")) if whole_url else F.concat(host, path)
    rows = df.select(named(id_col).alias("page_id"), host.alias("host"), path.alias("path"), text.alias("text"))
    rule, label = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), label.alias("label"))
    texts = stored(rows.select("text", "label").distinct().withColumn("id", F.monotonically_increasing_id()), "urls")
    model = stored(log_ratios(groups(texts)), "model")
    scores = groups(texts).join(model, "gram").groupBy("id").agg(F.avg("ratio").alias("score"))
    scored = stored(texts.join(stored(scores, "scores"), "id").select("text", "label", "score"), "scored-urls")

    def of(label: str, what) -> Column:
        return what(F.when(F.col("label") == label, F.col("score")))

    s = scored.agg(*(of(x, f).alias(f"{x}_{f.__name__}") for x in ("allow", "block") for f in (F.avg, F.stddev_pop))).first()
    known = s.allow_avg is not None and s.block_avg is not None
    if known:
        spread = s.allow_stddev_pop + s.block_stddev_pop
        share = s.allow_stddev_pop / spread if spread > 0 else 0.5
        cut = s.allow_avg + (s.block_avg - s.allow_avg) * share
    score = F.col("score") if known else F.lit(None).cast("double")
    by_model = F.when(score < F.lit(cut), "block").otherwise("allow") if known else F.lit("allow")
    return rows.join(scored.select("text", "score"), "text").select(
        "page_id", "host", "path", "rule", F.coalesce("label", by_model).alias("verdict"), score.alias("score"))
