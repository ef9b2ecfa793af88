"""Quality classifier by hierarchical empirical Bayes.

A document's own evidence is the classifier's likelihood ratio (posterior odds over the
odds in its training sample).  Its prior comes from where it was found: for each host, and
each path of a host, a posterior share of good documents is counted by grouped
aggregation, from labels (weight 1) and from the classifier's posterior of unlabelled
documents (weight ``soft``).  A host's share is shrunk toward the global one, a path's
toward its host's, the more the fewer documents it has; both strengths are fitted by moments
from how much the shares differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanload.llm import text_model
from spanload.llm.common import stage

#: Site tables of up to so many rows (some 100 bytes each) are broadcast, larger ones shuffled.
SMALL_SITES = 20_000
LEAST, MOST = 1e-3, 1 - 1e-3


def _strength(groups: DataFrame, n: str, good: str, toward) -> float:
    """How many documents a prior counts for: the moments' estimate for beta-binomial shares."""
    share = F.col(good) / F.col(n)
    row = (groups.where(F.col(n) > 0).select(F.col(n).alias("n"), share.alias("s"), toward.alias("t"))
           .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(F.col("s") - F.col("t"), 2)).alias("ss"),
                F.sum(F.col("n") * F.col("t") * (1 - F.col("t"))).alias("within"),
                F.sum(F.col("t") * (1 - F.col("t"))).alias("noise")).first())
    if not row["n"]:
        return 10.0
    # E[n (s - t)^2] = t (1 - t) (1 + (n - 1) rho) for a group of n
    rest = (row["within"] or 0) - (row["noise"] or 0)
    rho = ((row["ss"] or 0) - (row["noise"] or 0)) / rest if rest > 0 else 0.0
    rho = min(max(rho, 1e-3), 0.5)
    return 1 / rho - 1


def site_shares(judged: DataFrame) -> DataFrame:
    """Rows ``host, path, share``: from ``host, path, weight, good`` of every document."""
    paths = stage(judged.groupBy("host", "path").agg(F.sum("weight").alias("n"), F.sum("good").alias("k")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("k").alias("hk"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hk").alias("k")).first()
    prior = ((total["k"] or 0) + 1) / ((total["n"] or 0) + 2)
    s = _strength(hosts, "hn", "hk", F.lit(prior))
    hosts = hosts.withColumn("ht", (F.col("hk") + s * prior) / (F.col("hn") + s))
    both = paths.join(hosts, "host")
    s2 = _strength(both, "n", "k", F.col("ht"))
    return both.select("host", "path", ((F.col("k") + s2 * F.col("ht")) / (F.col("n") + s2)).alias("share"))


def classify(df: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", host: str = "source",
             path: str = "lang", label: str = "quality", label_doc: str = "doc_id", soft: float = 0.2,
             threshold: float = 0.5) -> DataFrame:
    """Rows ``doc_id, row_key, host, path, text_prob, site_share, good_prob, kept``, one for each row.

    ``labels``: documents with 1 (good) or 0.  ``kept``: ``good_prob >= threshold``.  Null
    hosts or paths are a site of their own; null and empty texts are judged by their
    features, all zero; a null id has no label.  Repeated rows all come back.  Without labels
    everything has a probability of one half and is kept.  Other columns are not looked at.
    """
    docs = df.select(F.col(f"`{doc}`").alias("doc"), F.col(f"`{text}`").alias("text"),
                     F.coalesce(F.col(f"`{host}`"), F.lit("")).alias("host"),
                     F.coalesce(F.col(f"`{path}`"), F.lit("")).alias("path"))
    known = (labels.select(F.col(f"`{label_doc}`").alias("doc"), F.col(f"`{label}`").alias("q"))
             .where("doc is not null and q in (0, 1)").groupBy("doc").agg(F.avg("q").alias("q")))
    model = text_model.fit(docs.select("doc", "text"), known.select(
        "doc", F.when(F.col("q") >= 0.5, F.lit("1")).otherwise(F.lit("0")).alias("label")))
    good = model.classes.index("1") if "1" in model.classes else None
    scored = text_model.score(docs.withColumn("row_key", text_model.row_key(F.col("doc"), F.col("text"))), model)
    p = F.element_at("posteriors", good + 1) if good is not None and len(model.classes) > 1 else F.lit(0.5)
    scored = stage(scored.select("doc", "row_key", "host", "path", F.greatest(
        F.lit(LEAST), F.least(F.lit(MOST), p)).alias("text_prob")), "quality-scores")
    judged = (scored.join(known, "doc", "left")
              .select("host", "path", F.when(F.col("q").isNotNull(), F.lit(1.0)).otherwise(F.lit(soft)).alias("weight"),
                      F.coalesce("q", F.lit(soft) * F.col("text_prob")).alias("good")))
    sites = stage(site_shares(judged), "sites")
    base = known.agg(F.avg("q")).first()[0]
    base = min(max(base if base is not None else 0.5, LEAST), MOST)
    if sites.count() <= SMALL_SITES:
        sites = F.broadcast(sites)
    share = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.col("share")))
    odds = (F.col("text_prob") / (1 - F.col("text_prob"))) * ((1 - base) / base) * (share / (1 - share))
    probability = odds / (1 + odds) if good is not None and len(model.classes) > 1 else F.lit(0.5)
    return (scored.join(sites, ["host", "path"], "left")
            .select(F.col("doc").alias("doc_id"), "row_key", "host", "path", "text_prob",
                    F.col("share").alias("site_share"), probability.alias("good_prob"))
            .withColumn("kept", F.col("good_prob") >= threshold))
