"""Registered queries of the corpus operators and, where SQL can express them, their counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm import (
    centroids, embedding_dedup, exact_dedup, license_scan, line_dedup, merkle, mixing, near_dedup, packing,
    personal_data, secret_scan, substring_dedup, toxicity,
)
from punctua.llm.common import table
from punctua.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "keep_id", "group_size", "uid = keep_uid AS kept", "digest AS text_sha256")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_shingles", "component_id", "doc_id <=> component_id AS kept")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.summary(secret_scan.scan(table(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings")).selectExpr(
        "vec_id", "n_links", "component_id", "vec_id <=> component_id AS kept")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clusters(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2(F.array_join("centroid", ","), 256)).drop("centroid")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.summary(personal_data.scan(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_secret_scan": op6_secret_scan,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_centroids": op11_centroids,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_personal_data": op13_personal_data,
}
