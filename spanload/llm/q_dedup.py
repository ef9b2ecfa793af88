"""Queries on vectors and near-duplicates: op3, op4 and op8."""

from __future__ import annotations

from spanload.llm import hnsw, minhash, vector_dedup
from spanload.llm.common import read_table
from spanload.llm.queries import register


@register("op4_minhash")
def op4(spark, sf_dir):
    """All documents; links at 85 % of 3-word shingles."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=3, percent=85)


@register("op8_vector_dedup")
def op8(spark, sf_dir):
    """All vectors; links at a cosine of 0.9."""
    return vector_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"), cosine=0.9)


@register("op3_hnsw")
def op3(spark, sf_dir):
    """Every vector whose id is divisible by 20, against all others."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hnsw.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)
