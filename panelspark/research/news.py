"""News as factors: annotation of texts by a user's model, and daily aggregates joined to a panel."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Shape of a model's reply.
REPLY = "sentiment double, event_type string, impact double, summary string, keywords array<string>"


def annotate(news: DataFrame, model: Callable[[list[str]], list[str]], least_chars: int = 10, max_chars: int | None = 2000, done: DataFrame | None = None) -> DataFrame:
    """(id, entity, dt, sentiment, event_type, impact, summary, keywords, raw_response) of texts the model can read.

    Texts under ``least_chars`` are skipped, longer ones cut for the model; ids in ``done`` are not asked again. A reply may
    stand in a code fence; one that is not JSON is dropped; missing fields get defaults.
    """
    todo = news.filter(F.length("text") >= least_chars).select("id", "entity", "dt", (F.substring("text", 1, max_chars) if max_chars else F.col("text")).alias("text"))
    if done is not None:
        todo = todo.join(done.select("id").distinct(), "id", "left_anti")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(raw_response=model(b["text"].tolist()) if len(b) else pd.Series([], dtype=str))[["id", "entity", "dt", "raw_response"]]

    key = ", ".join(f"{c} {t}" for c, t in news.select("id", "entity", "dt").dtypes)
    raw = todo.mapInPandas(ask, f"{key}, raw_response string")
    fenced = F.regexp_extract("raw_response", r"```(?:json)?\s*([\s\S]*?)```", 1)
    body = F.trim(F.when(fenced != "", fenced).otherwise(F.col("raw_response")))
    parsed = raw.withColumn("j", F.from_json(body, REPLY)).withColumn("ok", F.get_json_object(body, "$").isNotNull())
    fields = {"sentiment": F.coalesce("j.sentiment", F.lit(0.0)), "event_type": F.coalesce("j.event_type", F.lit("other")), "impact": F.coalesce("j.impact", F.lit(0.0)), "summary": F.coalesce("j.summary", F.lit("")), "keywords": F.coalesce("j.keywords", F.array().cast("array<string>"))}
    return parsed.filter("ok").select("id", "entity", "dt", *(c.alias(n) for n, c in fields.items()), "raw_response")


def news_factors(panel: DataFrame, annotations: DataFrame, days: int = 5) -> DataFrame:
    """entity, dt and the news factors of each panel row: mean sentiment and count of its day (missing without news), rolling
    impact-weighted sentiment (days without news count 0), and flags of earnings and merger news."""
    flag = lambda kind: F.max(F.when(F.col("event_type") == kind, 1).otherwise(0))
    weight = F.sum("impact")
    day = annotations.groupBy("entity", "dt").agg(
        F.avg("sentiment").alias("news_sentiment"),
        F.count("*").alias("news_count"),
        F.when(weight != 0, F.sum(F.col("sentiment") * F.col("impact")) / weight).alias("weighted"),
        flag("earnings").alias("earnings"),
        flag("merger").alias("merger"),
    )
    both = panel.select("entity", "dt").join(day, ["entity", "dt"], "left")
    recent = F.avg(F.coalesce("weighted", F.lit(0.0))).over(Window.partitionBy("entity").orderBy("dt").rowsBetween(1 - days, 0))
    return both.select("entity", "dt", "news_sentiment", "news_count", recent.alias("news_sentiment_5d"), F.coalesce("earnings", F.lit(0)).alias("news_earnings_flag"), F.coalesce("merger", F.lit(0)).alias("news_merger_flag"))
