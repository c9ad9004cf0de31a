"""E-mail addresses: domains of sites, repairs, syntax, and the verdict by stages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import DERIVED_LOCAL_PARTS, DISPOSABLE_DOMAINS, DOMAIN_TYPOS, ROLE_LOCAL_PARTS
from .fields import issues
from .steps import Steps, inline
from .text import BLANK, strip


def site_domain(site: Column) -> Column:
    """Of an address: no scheme, no www., lower case; the path stays."""
    return F.lower(F.regexp_replace(F.regexp_replace(site, "^https?://", ""), r"^www\.", ""))


def mail_domain(site: Column) -> Column:
    """The host of an address for mail, without www.; null unless it has a dot inside."""
    host = F.regexp_extract(F.regexp_replace(F.lower(strip(site)), "^https?://", ""), "^[^/?#:]*", 0)
    host = F.regexp_replace(host, r"^www\.", "")
    return F.when(host.contains(".") & ~host.startswith(".") & ~host.endswith("."), host)


def candidates(domain: Column) -> Column:
    """The addresses that are tried at a domain, as an array."""
    return F.when(domain.isNotNull(), F.array(*[F.concat(F.lit(f"{p}@"), domain) for p in DERIVED_LOCAL_PARTS]))


def local_part(email: Column) -> Column:
    """Before the last @; the whole text without one."""
    return F.regexp_replace(email, "@[^@]*$", "")


def domain_part(email: Column) -> Column:
    """Behind the last @; empty without one."""
    return F.when(email.contains("@"), F.substring_index(email, "@", -1)).otherwise("")


@inline
def fix_domain(email: Column) -> Steps:
    """struct(email, fixed): known misspellings, then repeated dots and a dot at either end."""
    at = yield {"domain0": F.lower(domain_part(email))}
    domain = at["domain0"]
    known = F.create_map(*[F.lit(x) for kv in DOMAIN_TYPOS.items() for x in kv])[domain]
    tidy = F.regexp_replace(F.regexp_replace(domain, r"\.{2,}", "."), r"^\.|\.$", "")
    at = yield {"known": known, "tidy": tidy}
    at = yield {"better": F.coalesce(at["known"], F.when(at["tidy"] != domain, at["tidy"]))}
    better = at["better"]
    at = yield {"fixed": email.contains("@") & better.isNotNull()}
    fixed = at["fixed"]
    return F.struct(F.when(fixed, F.concat(local_part(email), F.lit("@"), better)).otherwise(email).alias("email"), fixed.alias("fixed"))


@inline
def syntax(email: Column) -> Steps:
    """What is wrong with the form of an address, in order."""
    at = yield {"local": local_part(email), "domain": domain_part(email)}
    local, domain = at["local"], at["domain"]
    top = F.substring_index(domain, ".", -1)
    found = issues(
        (F.length(email) > 254, "syntax_too_long"),
        (local == "", "syntax_empty_local"),
        (F.length(local) > 64, "syntax_local_too_long"),
        (domain == "", "syntax_empty_domain"),
        (email.rlike(BLANK), "syntax_whitespace"),
        (local.contains("@"), "syntax_multiple_at"),
        (local.startswith(".") | local.endswith(".") | local.contains(".."), "syntax_bad_dots_in_local"),
        (~local.rlike(r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~.-]+\z"), "syntax_bad_local_chars"),
        (~domain.contains("."), "syntax_domain_without_dot"),
        (~domain.rlike(r"^[A-Za-z0-9.-]+\z"), "syntax_bad_domain_chars"),
        (domain.rlike(r"^-|-\z|\.-|-\."), "syntax_bad_hyphen_in_domain"),
        (~top.rlike(r"^[A-Za-z]{2,}\z"), "syntax_bad_tld"),
    )
    return F.when(email.contains("@"), found).otherwise(F.array(F.lit("syntax_no_at")))


def is_role(email: Column) -> Column:
    return F.regexp_replace(F.lower(local_part(email)), r"(?s)[.+].*$", "").isin(*ROLE_LOCAL_PARTS)


def is_disposable(email: Column) -> Column:
    return F.lower(F.substring_index(email, "@", -1)).isin(*DISPOSABLE_DOMAINS)


@inline
def offline_verdict(email: Column) -> Steps:
    """struct(email, normalized, local_part, domain, status, stage_failed, issues) from the address alone. A role is noted and does not reject."""
    at = yield {"raw": strip(email)}
    raw = at["raw"]
    at = yield {"low": F.lower(raw)}
    mended = yield from fix_domain.steps(at["low"])
    at = yield {"norm": mended["email"], "mended": mended["fixed"]}
    norm, repaired = at["norm"], at["mended"]
    wrong = yield from syntax.steps(norm)
    at = yield {"wrong": wrong, "throw_away": is_disposable(norm), "role": is_role(norm)}
    wrong, throw_away, role = at["wrong"], at["throw_away"], at["role"]
    at = yield {"bad": F.size(wrong) > 0}
    bad = at["bad"]
    notes = issues((repaired, "domain_typo_fixed"))
    more = F.when(bad, wrong).otherwise(issues((throw_away, "disposable_domain"), (~throw_away & role, "role_account")))
    return F.struct(
        raw.alias("email"),
        norm.alias("normalized"),
        local_part(norm).alias("local_part"),
        domain_part(norm).alias("domain"),
        F.when(bad | throw_away, "rejected").otherwise("unknown").alias("status"),
        F.when(bad, "syntax").when(throw_away, "disposable").alias("stage_failed"),
        F.concat(notes, more).alias("issues"),
    )


def interpret_smtp(real: Column, control: Column) -> Column:
    """What an answer means when a mailbox that cannot exist was asked for as well."""
    return F.when((real == "accepted") & (control == "accepted"), "catch_all").otherwise(real)


@inline
def final_verdict(verdict: Column, has_mx: Column, existence: Column, smtp: Column) -> Steps:
    """struct(status, stage_failed, issues) from the offline verdict and facts of the network; null facts were not asked for."""
    rejected = verdict["status"] == "rejected"
    unknown = ~rejected & (existence.isNull() | (existence == "unknown"))
    no_mx = ~rejected & ~unknown & ~F.coalesce(has_mx, F.lit(False))
    asked = ~rejected & ~unknown & ~no_mx
    role = F.array_contains(verdict["issues"], "role_account")
    answer = F.coalesce(smtp, F.lit("unknown"))
    case = (
        F.when(rejected, F.struct(verdict["status"].alias("status"), verdict["stage_failed"].alias("stage_failed"), F.lit(None).cast("string").alias("note")))
        .when(unknown, F.struct(F.lit("unknown").alias("status"), F.lit(None).cast("string").alias("stage_failed"), F.lit("dns_lookup_failed").alias("note")))
        .when(no_mx, F.struct(F.lit("rejected").alias("status"), F.lit("mx").alias("stage_failed"), F.lit("domain_has_no_mx").alias("note")))
        .when(asked & (answer == "rejected"), F.struct(F.lit("rejected").alias("status"), F.lit("smtp").alias("stage_failed"), F.lit("smtp_mailbox_rejected").alias("note")))
        .when(asked & (answer == "catch_all"), F.struct(F.lit("quarantined").alias("status"), F.lit("smtp").alias("stage_failed"), F.lit("smtp_catch_all").alias("note")))
        .when(asked & (answer == "accepted"), F.struct(F.when(role, "quarantined").otherwise("valid").alias("status"), F.lit(None).cast("string").alias("stage_failed"), F.lit(None).cast("string").alias("note")))
        .otherwise(F.struct(F.lit("unknown").alias("status"), F.lit(None).cast("string").alias("stage_failed"), F.lit("smtp_not_checked").alias("note")))
    )
    at = yield {"case": case}
    case = at["case"]
    extra = F.array_compact(F.array(case["note"], F.when(existence == "absent", "domain_does_not_exist")))
    return F.struct(case["status"].alias("status"), case["stage_failed"].alias("stage_failed"), F.concat(verdict["issues"], extra).alias("issues"))
