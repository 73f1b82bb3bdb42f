"""Mixing sources to target weights by iterative proportional fitting (raking).

Every document falls into a cell (source, language, topic).  The token weights
of the cells are raked in turn to target shares of each margin, with every cell
capped at what sampling without repeats can give, and each document is then
kept with its cell's calibrated probability: raked weight over natural weight.

Only the table of cells is iterated; it has at most sources x languages x topics
rows whatever the number of documents, and is made with map-side sums.  It is
kept as a table and joined back, never collected.  The draw is a hash of the
doc_id, so it is repeatable and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored, text_or_empty

MARGINS = ("source", "lang", "topic")
RATE = 0.5  # share of all tokens to keep
TEMPERATURE = 0.7  # target share of a margin value: its natural share to this power, normalised
ROUNDS = 8
SEED = "mix-1"

# Content classes, first match wins; a document with none of these marks is prose.
TOPICS = (("legal", "(?i)licen[sc]e|copyright"), ("contact", "@|555-"), ("table", " \\| "), ("shout", "!! "))


def topic_of(text: str = "text") -> Column:
    """Content class of a text by its surface marks."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, pattern in TOPICS:
        out = out.when(F.col(text).rlike(pattern), F.lit(name))
    return out.otherwise(F.lit("prose"))


def count_tokens(text: str = "text") -> Column:
    """Words between blanks; the weight of a document."""
    return F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def rake(cells: DataFrame, margins=MARGINS, rate: float = RATE, temperature: float = TEMPERATURE, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (margin columns, ``tokens``) plus ``raked`` and ``probability``.

    Each margin value's target is its natural token share to the power
    ``temperature``, normalised, times the total.  After each margin a cell is
    capped at ``tokens / rate``, where its probability is 1.
    """
    cells = stored(cells, "cells")
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    targets = {}
    for m in margins:
        sums = cells.groupBy(m).agg(F.sum("tokens").cast("double").alias("natural"))
        power = sums.agg(F.sum(F.pow(F.col("natural"), F.lit(temperature)))).first()[0] or 1.0
        targets[m] = stored(sums.select(F.col(m).alias("value"), (F.pow("natural", F.lit(temperature)) / power * float(total)).alias("target")), f"target-{m}")
    w = cells.withColumn("raked", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for m in margins:
            now = w.groupBy(F.col(m).alias("value")).agg(F.sum("raked").alias("now"))
            by = now.join(targets[m], "value").select("value", F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(F.lit(1.0)).alias("by"))
            w = w.join(by, w[m] == by["value"]).select(
                *margins, "tokens", F.least(F.col("raked") * F.col("by"), F.col("tokens") / F.lit(rate)).alias("raked")
            )
        w = stored(w, "raked")
    share = F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens") * rate).otherwise(F.lit(rate))
    return w.withColumn("probability", F.round(F.least(share, F.lit(1.0)), 6))


def draw(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """A number in [0, 1) that only depends on the doc_id and the seed."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def _celled(docs: DataFrame) -> DataFrame:
    t = docs.withColumn("text", text_or_empty())
    return t.withColumns({
        "topic": topic_of("text"),
        "tokens": count_tokens("text"),
        "source": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
    })


def mix(docs: DataFrame, rate: float = RATE, temperature: float = TEMPERATURE, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """``(doc_id, source, lang, topic, tokens, weight, probability, kept)``, one row per row of ``docs``.

    ``weight`` is the raked token weight of the document's cell over its
    natural one.  Null source, language and text count as the empty string;
    documents without words weigh nothing and are kept with the plain rate.
    Repeated rows share their draw.  Other columns are not read.
    """
    c = _celled(docs.select("doc_id", "text", "source", "lang")).select("doc_id", *MARGINS, "tokens")
    probs = rake(c.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), rate=rate, temperature=temperature, rounds=rounds)
    return c.join(probs.select(*MARGINS, "probability"), list(MARGINS)).select(
        "doc_id", *MARGINS, "tokens", F.round(F.col("probability") / F.lit(rate), 6).alias("weight"), "probability",
        (draw("doc_id", seed) < F.col("probability")).alias("kept"),
    )


def mixed(docs: DataFrame, rate: float = RATE, temperature: float = TEMPERATURE, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """Pipeline stage: the drawn documents, with all their columns as they are."""
    row = "row"
    c = _celled(docs.select(F.col("doc_id"), F.col("text"), F.col("source"), F.col("lang"), F.struct(*[F.col(f"`{k}`") for k in docs.columns]).alias(row)))
    probs = rake(c.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), rate=rate, temperature=temperature, rounds=rounds)
    u = fresh(c.columns, "u")
    return (
        c.select(*MARGINS, row, draw("doc_id", seed).alias(u))
        .join(probs.select(*MARGINS, "probability"), list(MARGINS))
        .where(F.col(u) < F.col("probability"))
        .select(f"{row}.*")
    )


def mix_sql(rate: float = RATE, temperature: float = TEMPERATURE, rounds: int = ROUNDS, seed: str = SEED) -> str:
    """The same rows in DuckDB SQL: the raking steps as a chain of tables."""
    whens = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS)
    out = [
        f"""docs AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, CASE {whens} ELSE 'prose' END AS topic,
  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents))""",
        "cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM docs GROUP BY ALL)",
    ]
    for m in MARGINS:
        out.append(
            f"target_{m} AS MATERIALIZED (SELECT {m}, pow(sum(tokens), {temperature}) / (SELECT sum(pow(n, {temperature})) FROM "
            f"(SELECT sum(tokens) AS n FROM cells GROUP BY {m})) * (SELECT sum(tokens) FROM cells) AS target FROM cells GROUP BY {m})"
        )
    last = "(SELECT *, tokens AS raked FROM cells)"
    for k in range(rounds):
        for m in MARGINS:
            out.append(
                f"w_{k}_{m} AS MATERIALIZED (SELECT source, lang, topic, tokens, least(raked * CASE WHEN now > 0 THEN target / now ELSE 1 END, tokens / {rate}) AS raked "
                f"FROM (SELECT *, sum(raked) OVER (PARTITION BY {m}) AS now FROM {last}) JOIN target_{m} USING ({m}))"
            )
            last = f"w_{k}_{m}"
    return (
        "WITH " + ",\n".join(out) + f""", probs AS (SELECT source, lang, topic,
  round(least(CASE WHEN tokens > 0 THEN raked / tokens * {rate} ELSE {rate} END, 1.0), 6) AS probability FROM {last})
SELECT doc_id, source, lang, topic, CAST(tokens AS BIGINT) AS tokens, round(probability / {rate}, 6) AS weight, probability,
  CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 < probability AS kept
FROM docs JOIN probs USING (source, lang, topic)"""
    )
