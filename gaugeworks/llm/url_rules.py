"""URL filters: pattern rules indexed by their rarest literal token.

A rule is ``host/path`` with ``*`` for anything in the path. It fits its host and all subdomains, and
paths that start with the rule's. Its literal tokens are the runs of letters and digits that are whole
tokens of any URL it can fit. The rule is filed under the one that the fewest URLs have; a URL
fetches the rules filed under its own tokens, and only those run their regular expression. Rules
without a literal token are tried on every URL. The longest rule that fits decides.

Work is done once per distinct host and path. DataFrame functions throughout.

Edge cases: NULL and URLs without ``://`` have an empty host and path and fit no rule; repeated
rows and equal URLs are judged alike; equal rules count once (``block`` wins); an empty table gives an
empty result; other columns are kept.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import OWN, set_aside, small, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_regex(rule: str) -> str:
    """The regular expression of a rule, on host and path put together."""
    host, slash, path = rule.partition("/")
    return (
        r"(?s)^(?:[^/]*\.)?"
        + re.escape(host)
        + "".join(".*" if c == "*" else re.escape(c) for c in slash + path)
        + ("" if slash else "(?:/|$)")
    )


def rule_tokens(rule: str) -> list[str]:
    """Literal tokens (lower case) that every URL the rule fits has as whole tokens."""
    open_end = rule + ("\0" if rule[-1:].isalnum() and "/" in rule else "")
    found = re.finditer(r"[a-z0-9]+", open_end.translate(str.maketrans(UPPER, LOWER)))
    return sorted(
        {
            m[0]
            for m in found
            if open_end[m.end() : m.end() + 1] not in ("\0", "*")
            and open_end[max(0, m.start() - 1) : m.start()] != "*"
        }
    )


def _tokens(text: Column) -> Column:
    """Distinct runs of letters and digits of ASCII, and the empty token that open rules use."""
    parts = F.split(F.translate(text, UPPER, LOWER), "[^a-z0-9]+")
    return F.array_distinct(F.array_append(parts, F.lit("")))


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    url_column: str = "url",
    host_column: str = "host",
    path_column: str = "path",
    rule_column: str = "rule",
    verdict_column: str = "verdict",
    default: str = ALLOW,
) -> DataFrame:
    """Adds host, path, the longest rule that fits (else NULL) and the verdict of every URL.

    ``rules`` are (rule, verdict) pairs; of rules of one length the first in the alphabet counts.
    """
    spark = pages.sparkSession
    url = F.col(url_column)
    pages = set_aside(pages, host_column, path_column, rule_column, verdict_column)
    parsed = pages.withColumns({host_column: url_host(url), path_column: url_path(url)})
    keys = [host_column, path_column]
    distinct = written(parsed.select(*keys).distinct(), "url-distinct").withColumn(
        f"{OWN}tokens", _tokens(F.concat_ws("", *keys))
    )
    known = {rule: BLOCK if (rule, BLOCK) in rules else verdict for rule, verdict in rules}
    table = spark.createDataFrame(
        [(r, v, rule_regex(r), rule_tokens(r)) for r, v in sorted(known.items())],
        "rule string, verdict string, regex string, tokens array<string>",
    )
    wanted = table.select(F.explode("tokens").alias("token")).distinct()
    often = (
        distinct.select(F.explode(f"{OWN}tokens").alias("token"))
        .join(small(wanted, sum(len(rule_tokens(r)) for r in known)), "token")
        .groupBy("token")
        .agg(F.count("*").alias("urls"))
    )
    index = written(
        table.select("rule", "verdict", "regex", F.explode_outer("tokens").alias("token"))
        .join(often, "token", "left")
        .groupBy("rule", "verdict", "regex")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("rarest"))
        .select(
            "verdict", "regex", F.col("rule").alias(f"{OWN}rule"),
            F.coalesce("rarest.token", F.lit("")).alias("token"),
        ),
        "url-rules",
    )
    fitting = (
        distinct.select(*keys, F.explode(f"{OWN}tokens").alias("token"))
        .join(small(index, len(known)), "token")
        .filter(F.expr(f"concat({host_column}, {path_column}) RLIKE regex"))
        .filter(F.col(host_column) != "")
        .groupBy(*keys)
        .agg(
            F.min(
                F.struct(
                    (-F.length(f"{OWN}rule")).alias("order"),
                    F.col(f"{OWN}rule").alias("rule"),
                    "verdict",
                )
            ).alias(f"{OWN}best")
        )
    )
    best = written(fitting, "url-best")
    return (
        parsed.join(best, keys, "left")
        .withColumns(
            {
                rule_column: F.col(f"{OWN}best")["rule"],
                verdict_column: F.coalesce(F.col(f"{OWN}best")["verdict"], F.lit(default)),
            }
        )
        .drop(f"{OWN}best")
    )
