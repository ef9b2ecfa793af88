"""Mixing documents to target domain weights, with soft membership.

A classifier fitted on the labelled table gives every document a posterior over domains.
Rates r >= 0 for the documents are then fitted so that the expected share of each
domain's tokens, sum of r * tokens * posterior over all tokens, meets its target:

    minimise  sum_k (share_k(r) - target_k)^2 / s_k  +  stay * sum_d w_d (r_d - 1)^2

with w_d the document's share of all tokens and s_k the domain's share at r = 1.  The
gradient of a document needs only the K residuals, so a step of projected gradient is one
aggregation over a narrow table; every rate is recomputed from the residuals of the steps
so far (written after every few steps), and only K numbers a step reach the driver.  Documents
of a domain that isn't to be thinned out have rates of at least 1: the projection is onto
those, and all targets are for so many times the tokens that this can be.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanload.llm import text_model
from spanload.llm.common import stage


#: Steps folded into one expression; then the rates are written and read again.
TOGETHER = 10


def _rate(steps: list[list[float]], stay: float, size: float) -> Column:
    """``rate0`` after these steps; each step's numbers are residual / s_k of every domain."""
    rate = F.col("rate0")
    for step in steps:
        slope = F.lit(0.0)
        for i, e in enumerate(step):
            slope = slope + F.lit(float(e)) * F.element_at("p", i + 1)
        # rate - size * (slope + stay * (rate - 1)), with the rate named once
        rate = F.greatest(F.col("floor"), rate * F.lit(1 - size * stay) + F.lit(size * stay) - F.lit(size) * slope)
    return rate


def fit_rates(table: DataFrame, targets: list[float | None], stay: float = 1e-3, whole: int | None = None,
              close: float = 5e-4, still: float = 1e-6, most_steps: int = 1000) -> tuple[DataFrame, list[float]]:
    """``table`` (posteriors ``p``, ``tokens``) with ``rate``, and the shares of the mixed tokens.

    A target of None leaves the domain free.  Documents of domain ``whole`` (from 0; a posterior
    above 0.5) have rates of at least 1.  Steps go on until every target is met within
    ``close``, or until nothing moves any more (by ``still`` a step): the targets can't all be met
    then, what comes back is the nearest, and a warning says so.
    """
    k = len(targets)

    def sums(rate: Column) -> list[float]:
        row = table.select("p", "tokens", rate.alias("r")).agg(F.sum("tokens").alias("n"), *[
            F.sum(F.col("r") * F.col("tokens") * F.element_at("p", i + 1)).alias(f"s{i}") for i in range(k)]).first()
        return [float(row["n"] or 0), *(float(row[f"s{i}"] or 0) for i in range(k))]

    least = F.lit(0.0) if whole is None else F.when(F.element_at("p", whole + 1) > 0.5, 1.0).otherwise(0.0)
    table = table.withColumn("rate0", F.lit(1.0)).withColumn("floor", least)
    total, *shares = sums(F.col("rate0"))
    shares = [s / total if total else 0.0 for s in shares]
    base = [max(s, 1e-9) for s in shares]
    times = max(1.0, base[whole] / targets[whole]) if whole is not None and targets[whole] else 1.0
    goals = [None if t is None else t * times for t in targets]
    steps: list[list[float]] = []
    size, done, before = 1 / (1 + stay), 0, None
    while total:
        residual = [0.0 if t is None or b <= 1e-9 else s - t for s, t, b in zip(shares, goals, base, strict=True)]
        if max(map(abs, residual)) < close:
            break
        if before is not None and max(abs(x - y) for x, y in zip(shares, before, strict=True)) < still:
            warnings.warn(f"targets {goals} can't be met, nearest shares {shares}", stacklevel=2)
            break
        if done == most_steps:
            raise RuntimeError(f"targets {goals} neither met nor given up in {most_steps} steps: shares {shares}")
        if len(steps) == TOGETHER:
            table = stage(table.withColumn("rate0", _rate(steps, stay, size)), "rates")
            steps = []
        steps.append([r / b for r, b in zip(residual, base, strict=True)])
        before, shares, done = shares, [s / total for s in sums(_rate(steps, stay, size))[1:]], done + 1
    mixed = sum(shares) or 1.0
    return table.withColumn("rate", _rate(steps, stay, size)).drop("floor"), [s / mixed for s in shares]


def mix(df: DataFrame, labels: DataFrame, targets: Mapping[str, float], doc: str = "doc_id", text: str = "text",
        label_doc: str = "doc_id", label: str = "domain", stay: float = 1e-3, whole: str | None = None) -> DataFrame:
    """Rows ``doc_id, row_key, n_tokens, posteriors, rate, copies``, one for each row.

    ``labels``: documents and their domain; ``targets``: the share of tokens each domain is
    to have, scaled to sum to one (domains without a target are left free).  ``posteriors``: a
    map by domain.  ``rate``: how often the document is to be taken; ``copies``: the rate
    rounded up or down by chance with that expectation, the same chance for the same row.
    Tokens are words; null and empty texts have none, their rate has no bearing on the
    shares.  Repeated rows all come back, with one rate.  Without labels or tokens all
    rates are 1.  A domain that no document belongs to cannot reach its target.  ``whole``: a
    domain of which no document is to be thinned out: its documents have rates of at least 1.
    """
    docs = df.select(F.col(f"`{doc}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    known = labels.select(F.col(f"`{label_doc}`").alias("doc"), F.col(f"`{label}`").cast("string").alias("label"))
    model = text_model.fit(docs, known)
    scored = text_model.score(docs.withColumn("row_key", text_model.row_key(F.col("doc"), F.col("text"))), model)
    table = stage(scored.select("doc", "row_key", F.col("words").alias("tokens"), F.col("posteriors").alias("p")),
                  "posteriors")
    total = sum(max(0.0, float(targets[c])) for c in model.classes if c in targets)
    goals = [max(0.0, float(targets[c])) / total if c in targets and total else None for c in model.classes]
    if len(goals) > 1 and total:
        table, _ = fit_rates(table, goals, stay, model.classes.index(whole) if whole in model.classes else None)
    else:
        table = table.withColumn("rate", F.lit(1.0))
    chance = F.pmod(F.xxhash64(F.col("row_key"), F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    names = F.array(*[F.lit(c) for c in model.classes])
    return (table.select(F.col("doc").alias("doc_id"), "row_key", F.col("tokens").alias("n_tokens"),
                         F.map_from_arrays(names, "p").alias("posteriors"), "rate",
                         (F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0))
                         .cast("long").alias("copies")))
