"""Run summaries and reports over the call log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.operators.features import first_per_group


def closure_summary(cases: DataFrame, closed: str = "closed") -> DataFrame:
    """Total and closed cases, and the closed percentage (NULL without cases)."""
    return cases.agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.count_if(F.col(closed)).alias("closed_cases"),
        F.try_divide(F.count_if(F.col(closed)) * 100.0, F.count(F.lit(1))).alias("closed_pct"),
    )


def cause_breakdown(cases: DataFrame, cause: str = "primary_cause", first_by: list[str] | None = None) -> DataFrame:
    """Cases per cause, most frequent first, ties by first appearance."""
    first_by = first_by or ["case_id"]
    # A single column stays a plain minimum, which hash aggregation can hold.
    first = F.min(first_by[0] if len(first_by) == 1 else F.struct(*first_by))
    counted = cases.groupBy(cause).agg(F.count(F.lit(1)).alias("n_cases"), first.alias("_first"))
    return counted.orderBy(F.desc("n_cases"), "_first").drop("_first")


def call_metrics(log: DataFrame, agent: str = "agent", model_id: str | None = None) -> DataFrame:
    """Invocations per agent, with the model id when the log has one."""
    aggregates: list[Column] = [F.count(F.lit(1)).alias("total_invocations")]
    if model_id:
        aggregates.append(F.max(model_id).alias("model_id"))
    return log.groupBy(agent).agg(*aggregates)


def recent_exchanges(log: DataFrame, order: list[str], agent: str = "agent", prompt: str = "prompt",
                     response: str = "response", n: int = 5, chars: int = 100) -> DataFrame:
    """The last n exchanges per agent, oldest of them numbered 1, texts cut for display."""
    def shortened(c: str) -> Column:
        return F.concat(F.substring(c, 1, chars), F.lit("..."))

    last = first_per_group(log, [agent], [F.desc(c) for c in order], n, out="_back")
    sizes = log.groupBy(agent).agg(F.count(F.lit(1)).alias("_calls"))
    return last.join(sizes, agent).select(
        agent,
        (F.least("_calls", F.lit(n)) + 1 - F.col("_back")).cast("int").alias("item"),
        shortened(prompt).alias("prompt"),
        shortened(response).alias("response"),
    )


def history_summary(log: DataFrame, agents: DataFrame, order: list[str], agent: str = "agent",
                    prompt: str = "prompt", response: str = "response", n: int = 5) -> DataFrame:
    """The recent exchanges of each agent as one display text (n short items each)."""
    items = recent_exchanges(log, order, agent, prompt, response, n)
    line = F.concat(
        F.lit("\n"), F.col("item").cast("string"), F.lit(". Prompt: "), F.col("prompt"),
        F.lit("\n   Response: "), F.col("response"), F.lit("\n"),
    )
    texts = items.groupBy(agent).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("item", line.alias("line")))),
                                 lambda x: x["line"]), "").alias("_text")
    )
    totals = log.groupBy(agent).agg(F.count(F.lit(1)).alias("_calls"))
    head = F.concat(F.lit("Conversation History ("), F.col("_calls").cast("string"), F.lit(" exchanges):\n"))
    return agents.join(texts, agent, "left").join(totals, agent, "left").select(
        agent, F.coalesce(F.concat(head, F.col("_text")), F.lit(fv.EMPTY_HISTORY)).alias("summary")
    )
