"""Registered queries: each operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import decontaminate, discriminant, embedding_whitening, language, maxent, mixing, periodic_runs, secret_scan, simhash, substring_dedup, supervision, surrogates, warc
from tidemark.llm.common import fold, read

_BASE_HITS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op1_secret_scan(spark, sf_dir):
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op2_warc(spark, sf_dir):
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op3_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(*_BASE_HITS)


def language_model(docs):
    """Trained on the documents that are not held out."""
    return language.train(language.sample(docs.where(fold(F.col("doc_id"), 4) != 2), "doc_id", "text", "lang"))


def op4_language(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = language.identify(docs, language_model(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op5_quality_rules(spark, sf_dir):
    return supervision.judge(read(spark, sf_dir, "documents"))


def op6_maxent(spark, sf_dir):
    return maxent.score(read(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) != 2)


def op7_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).drop("copies")


def op8_surrogates(spark, sf_dir):
    return surrogates.pseudonymize(read(spark, sf_dir, "documents")).select("doc_id", "n_entities", "text")


def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_discriminant(spark, sf_dir):
    found = discriminant.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return found.select("doc_id", (~F.col("trained")).alias("held_out"), "score", "predicted")


def op11_whitening(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = embedding_whitening.fit(rows)
    found = embedding_whitening.whiten(rows, model).select("vec_id", F.col("whitened.deviation").try_cast("long").alias("deviation"), F.posexplode("whitened.values"))
    explained = F.array(*[F.lit(e) for e in model.explained]) if model else F.array().cast("array<double>")
    return found.select(
        "vec_id",
        (F.col("pos") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        F.col("col").alias("whitened"),
        F.get(explained, F.col("pos")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs.find_runs(periodic_runs.looped(read(spark, sf_dir, "documents")))
    return found.select("doc_id", *[c.alias(n) for n, c in periodic_runs.digest(F.col("found")).items()])


def op13_substring_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_warc,
        op3_decontaminate,
        op4_language,
        op5_quality_rules,
        op6_maxent,
        op7_mixing,
        op8_surrogates,
        op9_simhash,
        op10_discriminant,
        op11_whitening,
        op12_periodic_runs,
        op13_substring_dedup,
    )
}
ORACLES = {
    "op2_warc": warc.ORACLE_SQL,
    "op3_decontaminate": decontaminate.ORACLE_SQL,
    "op7_mixing": mixing.ORACLE_SQL,
    "op13_substring_dedup": substring_dedup.ORACLE_SQL,
}
