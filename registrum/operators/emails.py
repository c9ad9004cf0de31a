"""Candidate addresses of companies and their verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.email import candidates, final_verdict, interpret_smtp, mail_domain, offline_verdict
from ..functions.steps import staged


def derive(companies: DataFrame) -> DataFrame:
    """external_id, domain, verdict: three addresses per company with a domain, judged by themselves."""
    sites = companies.filter("site is not null").select("external_id", mail_domain(F.col("site")).alias("domain")).filter("domain is not null")
    each = sites.select("external_id", "domain", F.explode(candidates(F.col("domain"))).alias("e"))
    each, at = staged(each, verdict=offline_verdict.steps(F.col("e")))
    return each.select("external_id", "domain", at["verdict"].alias("verdict"))


def domains_to_ask(derived: DataFrame) -> DataFrame:
    """domain: those that still have an address that is not rejected, each once."""
    live = derived.filter("verdict.status <> 'rejected'").select(F.col("verdict.domain").alias("live"))
    return derived.select("domain").distinct().join(live, F.col("domain") == F.col("live"), "left_semi")


def judge(derived: DataFrame, domain_facts: DataFrame, smtp_facts: DataFrame | None = None) -> DataFrame:
    """The table of e-mail candidates: one row per company and address. domain_facts and smtp_facts have a row per domain and address."""
    facts = domain_facts.select(F.col("domain").alias("f_domain"), "has_mx", "existence")
    j = derived.join(facts, F.col("verdict.domain") == F.col("f_domain"), "left")
    if smtp_facts is None:
        j = j.withColumn("smtp", F.lit(None).cast("string"))
    else:
        answers = smtp_facts.select(F.col("email").alias("s_email"), interpret_smtp(F.col("real"), F.col("control")).alias("smtp"))
        j = j.join(answers, F.col("verdict.normalized") == F.col("s_email"), "left")
    j, at = staged(j, final=final_verdict.steps(F.col("verdict"), F.col("has_mx"), F.col("existence"), F.col("smtp")))
    out = j.withColumn("final", at["final"]).select("external_id", F.col("verdict.normalized").alias("email"), F.col("verdict.local_part").alias("local_part"), F.col("verdict.domain").alias("domain"), F.lit("derived_from_site").alias("source"), F.col("final.status").alias("status"), F.col("final.stage_failed").alias("stage_failed"), F.col("final.issues").alias("issues"))
    return out.dropDuplicates(["external_id", "email"])


def counters(judged: DataFrame) -> DataFrame:
    """kind (status or stage), name, rows."""
    status = judged.groupBy(F.lit("status").alias("kind"), F.col("status").alias("name")).agg(F.count("*").alias("rows"))
    stage = judged.filter("stage_failed is not null").groupBy(F.lit("stage").alias("kind"), F.col("stage_failed").alias("name")).agg(F.count("*").alias("rows"))
    return status.unionByName(stage)
